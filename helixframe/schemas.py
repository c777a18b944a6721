"""Tables of the domain as Spark schemas, with the keys that must be unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators.relational import assert_unique


SPECIES = "id string, taxid int, scientific_name string, phenotypes array<string>, genome_assembly string, proteome_path string, lineage_group string, geo_search_terms array<string>, is_control boolean"
GENE = "id string, human_gene_id string, gene_symbol string, human_protein string, narrative string, go_terms array<string>, pathway_ids array<string>, loeuf double"
ORTHOLOG = "id string, gene_id string, species_id string, protein_id string, protein_seq string, sequence_identity_pct double, orthofinder_og string, is_one_to_one boolean"
MOTIF = "id string, ortholog_id string, start_pos int, end_pos int, animal_seq string, human_seq string, divergence_score double, esm_distance double, half_life_min double, logp double, immunogenic boolean, synthesisable boolean, domain_name string, in_functional_domain boolean, consequence_score double, convergent_aa_count int, esm1v_score double, motif_direction string"
EXPRESSION = "id string, gene_id string, geo_accession string, comparison string, log2fc double, padj double, n_samples int"
EVOLUTION = "gene_id string, dnds_ratio double, dnds_pvalue double, selection_model string, branches_under_selection array<string>, convergence_count int, phylop_score double, fel_sites int, busted_pvalue double, meme_qvalue double, relax_k double, relax_pvalue double, convergence_weight double, convergence_pval double"
DISEASE = "gene_id string, disease_id string, disease_name string, opentargets_score double, gwas_pvalue double, gnomad_pli double, mouse_ko_phenotype string, tissue_expression map<string,double>, protective_variant_count int, best_protective_trait string, protective_variant_pvalue double, lit_score double, lit_pmid_count int, gnomad_loeuf double, known_drug_name string, known_drug_phase int, known_drug_indication_ids array<string>, ot_safety_liability string"
DRUG_TARGET = "gene_id string, pocket_count int, top_pocket_score double, chembl_target_id string, existing_drugs array<string>, cansar_score double, druggability_tier string, p2rank_score double, p2rank_pocket_count int, tractability_sm boolean, tractability_ab boolean, tractability_protac boolean, convergent_pocket_proximal boolean"
GENE_THERAPY = "gene_id string, gene_size_bp int, aav_compatible boolean, tissue_tropism array<string>, crispr_sites int, offtarget_risk string, crispr_efficiency double"
SAFETY = "gene_id string, is_essential boolean, phewas_hits map<string,double>, network_degree int, hub_risk boolean, family_size int, depmap_score double, gtex_tissue_count int, gtex_max_tpm double"
CANDIDATE = "gene_id string, trait_id string, convergence_score double, selection_score double, disease_score double, druggability_score double, expression_score double, safety_score double, composite_score double, tier string, regulatory_score double, structural_score double, control_divergence_fraction double, updated_at timestamp_ntz"
POSITION = "id string, gene_id string, divergent_motif_id string, uniprot_accession string, protein_start_pos int, protein_end_pos int, convergent_lineage_count int, am_score double, am_class string, uniprot_feature string, uniprot_feature_description string, plddt_mean double, is_disordered boolean, pocket_distance_angstrom double, is_pocket_adjacent boolean, structural_context string"
RUN = "id string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, species_ids array<string>, step_statuses map<string,struct<status:string,at:string>>, phase string, notes string, pid int"
REGULATORY = "id string, gene_id string, species_id string, promoter_divergence double, expression_log2fc double, lineage_count int, regulatory_score double"
PATHWAY = "pathway_id string, pathway_name string, gene_count int, candidate_count int, log_pvalue double, adjusted_pvalue double, evolutionary_weight double, pathway_score double, gene_symbols array<string>"
REGION = "id string, gene_id string, species_id string, region_type string, sequence string, chrom string, start int, end int"
REGION_SCORE = "id string, gene_id string, region_type string, conservation_score double, percent_identity double, alignment_length int, gap_fraction double, regulatory_divergence_count int, regulatory_convergence_count int"
PHYLO = "gene_id string, cds_phylo_score double, promoter_phylo_score double, downstream_phylo_score double"
READINESS = "gene_id string, synthesis_score double, deliverability_score double, model_score double, assay_score double, overall_readiness_score double, readiness_tier string, notes string, updated_at timestamp_ntz"
COMPOUND = "id string, gene_id string, smiles string, name string, source string, zinc_id string, chembl_id string, docking_score double, docking_method string, tanimoto_to_known double, nearest_known_drug string, hit_score double, hit_tier string, is_purchasable boolean, created_at timestamp_ntz"
COMPOUND_SCORE = "compound_id string, mw double, logp double, hbd int, hba int, tpsa double, lipinski_pass boolean, bbb_permeable boolean, cyp3a4_risk double, tox21_score double, herg_risk double, pains_alerts int, structural_alerts int, selectivity_score double, n_offtarget_similar int, sa_score double, sa_normalized double, zinc_purchasable boolean, overall_compound_score double, compound_tier string"

TABLES = {
    "species": (SPECIES, ["id"]), "gene": (GENE, ["id"]), "ortholog": (ORTHOLOG, ["gene_id", "species_id"]), "divergent_motif": (MOTIF, ["ortholog_id", "start_pos"]),
    "expression_result": (EXPRESSION, ["gene_id", "geo_accession", "comparison"]), "evolution_score": (EVOLUTION, ["gene_id"]), "disease_annotation": (DISEASE, ["gene_id"]),
    "drug_target": (DRUG_TARGET, ["gene_id"]), "gene_therapy_score": (GENE_THERAPY, ["gene_id"]), "safety_flag": (SAFETY, ["gene_id"]), "candidate_score": (CANDIDATE, ["gene_id", "trait_id"]),
    "convergent_position_annotation": (POSITION, ["gene_id", "divergent_motif_id"]), "pipeline_run": (RUN, ["id"]), "regulatory_divergence": (REGULATORY, ["gene_id", "species_id"]),
    "pathway_convergence": (PATHWAY, ["pathway_id"]), "nucleotide_region": (REGION, ["gene_id", "species_id", "region_type"]), "nucleotide_score": (REGION_SCORE, ["gene_id", "region_type"]),
    "phylo_conservation_score": (PHYLO, ["gene_id"]), "preclinical_readiness": (READINESS, ["gene_id"]), "compound": (COMPOUND, ["id"]), "compound_score": (COMPOUND_SCORE, ["compound_id"]),
}


def schema(name: str) -> T.StructType:
    """A table's schema; its text is parsed by the session."""
    return T.StructType.fromDDL(TABLES[name][0])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of a table in order and type; missing ones are null."""
    fields = schema(name).fields
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def check_keys(df: DataFrame, name: str) -> DataFrame:
    return assert_unique(df, TABLES[name][1])
