"""Loading, enrichment and annotation: joins of landed tables with the tables of genes, orthologs and motifs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.functions import scores as S
from helixframe.functions import sequence as Q
from helixframe.operators.relational import dedup_first, overlap_join, tasks_for, top_per_key, upsert

#: Gene ids of a batch to their sequences.
SequenceProvider = Callable[[pa.Array], "pa.Array | list[str | None]"]

# --- orthologs and motifs ----------------------------------------------------------------------


def load_orthologs(long: DataFrame, sequences: DataFrame, gene_of: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """AN1, AG13: orthologs of orthogroups. The first human protein names the gene, the first protein of a species counts.

    long: (og_id, species_id, protein_id, place); gene_of: (protein_id, gene_id); existing rows are kept out.
    """
    first = dedup_first(long, ["og_id", "species_id"], [F.col("place"), F.col("protein_id")])
    genes = first.where("species_id = 'human'").join(gene_of, "protein_id").select("og_id", "gene_id")
    single = long.groupBy("og_id", "species_id").agg(F.count("*").alias("n")).groupBy("og_id").agg((F.max("n") == 1).alias("is_one_to_one"))
    rows = first.join(genes, "og_id").join(single, "og_id").join(sequences.withColumnRenamed("sequence", "protein_seq"), ["species_id", "protein_id"], "left")
    rows = rows.select("gene_id", "species_id", "protein_id", "protein_seq", F.col("og_id").alias("orthofinder_og"), "is_one_to_one")
    rows = dedup_first(rows, ["gene_id", "species_id"], [F.col("orthofinder_og"), F.col("protein_id")])
    return rows if existing is None else rows.join(existing.select("gene_id", "species_id").distinct(), ["gene_id", "species_id"], "left_anti")


def human_sequence(aligned: DataFrame) -> DataFrame:
    """AN3: (og, human) from aligned (og, label, seq): the first label that holds "human"."""
    human = aligned.where(F.contains(F.lower("label"), F.lit("human")))
    return dedup_first(human, ["og"], [F.col("label")]).select("og", F.col("seq").alias("human"))


def sequence_identities(aligned: DataFrame) -> DataFrame:
    """SQ3, SQ10: (og, label, identity) of each sequence with its group's human one."""
    return aligned.join(human_sequence(aligned), "og").select("og", "label", F.round(Q.identity_percent(F.col("seq"), F.col("human")), 2).alias("identity"))


def identity_gate(proteins: DataFrame, least: int = 2, below: float = 85.0) -> DataFrame:
    """SQ5: orthogroups (og) in which at least some sequences are under an identity of k-mers with human. proteins: (og, label, seq)."""
    pairs = proteins.join(human_sequence(proteins), "og").where(~F.contains(F.lower("label"), F.lit("human")))
    close = pairs.select("og", "label", Q.kmer_identity(F.col("seq"), F.col("human")).alias("identity"))
    return close.groupBy("og").agg(F.countDistinct(F.when(F.col("identity") < below, F.col("label"))).alias("n")).where(F.col("n") >= least).select("og")


def scan_motifs(aligned: DataFrame, size: int = 15, step: int = 5, least: float = 0.15, species: int = 2, max_gap: float = 0.5) -> DataFrame:
    """SQ2, AN2: divergent windows (og, label, start_pos, end_pos, animal_seq, human_seq, divergence_score).

    Windows mostly of gaps are left out, and positions at which too few sequences have a usable one. Start
    positions are alignment columns; stored sequences have no gaps.
    """
    pairs = aligned.join(human_sequence(aligned), "og").where(~F.contains("label", F.lit("human")) & (F.length("seq") == F.length("human")))
    windows = pairs.select("og", "label", "seq", "human", F.explode(Q.window_starts(F.length("seq"), size, step)).alias("start_pos"))
    piece = lambda c: F.substring(c, F.col("start_pos") + 1, F.lit(size))
    cut = windows.select("og", "label", "start_pos", (F.col("start_pos") + size).alias("end_pos"), piece("seq").alias("a"), piece("human").alias("h"))
    usable = cut.where(size - F.length(F.translate("a", "-", "")) <= max_gap * size)
    covered = usable.withColumn("n", F.count("*").over(Window.partitionBy("og", "start_pos"))).where(F.col("n") >= species)
    kept = covered.withColumn("raw", Q.window_divergence(F.col("a"), F.col("h"))).where(F.col("raw") >= least)
    bare = lambda c: F.regexp_replace(c, "-", "")
    return kept.select("og", "label", "start_pos", "end_pos", bare("a").alias("animal_seq"), bare("h").alias("human_seq"), F.round("raw", 4).alias("divergence_score"))


def motif_summary(motifs: DataFrame) -> DataFrame:
    """AN2: (og, motifs, median, least, most) of motifs per sequence."""
    per = motifs.groupBy("og", "label").agg(F.count("*").alias("n"))
    return per.groupBy("og").agg(F.sum("n").alias("motifs"), F.percentile("n", 0.5).alias("median"), F.min("n").alias("least"), F.max("n").alias("most"))


def persisted_motifs(motifs: DataFrame, orthologs: DataFrame, max_identity: float = 85.0, top: int = 8) -> DataFrame:
    """SQ7: motifs of orthologs up to an identity, the most divergent of each."""
    kept = motifs.join(orthologs.where(F.coalesce(F.col("sequence_identity_pct") <= max_identity, F.lit(True))).select(F.col("id").alias("ortholog_id"), "species_id", "protein_id"), F.col("label") == F.concat_ws("|", "species_id", "protein_id"))
    return top_per_key(kept, ["ortholog_id"], [F.col("divergence_score").desc(), F.col("start_pos")], top).drop("label", "species_id", "protein_id")


def lineage_gate(motifs: DataFrame, lineages: DataFrame, least: int = 2) -> DataFrame:
    """SQ8: motifs (og, label, ...) of orthogroups seen in enough lineages. lineages: (species, lineage)."""
    named = motifs.withColumn("species", Q.label_species(F.col("label"))).join(lineages, "species", "left")
    wide = named.groupBy("og").agg(F.countDistinct("lineage").alias("n")).where(F.col("n") >= least).select("og")
    return motifs.join(wide, "og", "left_semi")


def branch_weights(distances: DataFrame) -> DataFrame:
    """SQ9: (species, weight): the smallest distance from the reference over each one's."""
    low = distances.where("distance > 0").agg(F.min("distance").alias("low"))
    return distances.crossJoin(F.broadcast(low)).select("species", F.when(F.col("distance") > 0, F.col("low") / F.col("distance")).otherwise(1.0).alias("weight"))


def weighted_motifs(motifs: DataFrame, weights: DataFrame) -> DataFrame:
    """SQ9: divergence times its species' weight, 1 for unknown ones."""
    named = motifs.withColumn("species", Q.label_species(F.col("label"))).join(weights, "species", "left")
    return named.withColumn("divergence_score", F.col("divergence_score") * F.coalesce("weight", F.lit(1.0))).drop("species", "weight")


def supermatrix(aligned: DataFrame, species: DataFrame, least: float = 0.8, most: int = 500) -> DataFrame:
    """SQ15, TK4: (species, sequence): single-copy groups that cover enough species, best covered first, joined in order.

    A species that a group lacks gets gaps. The number of groups and the size of a proteome bound a row.
    """
    named = aligned.withColumn("species", Q.label_species(F.col("label")))
    per = named.groupBy("og", "species").agg(F.count("*").alias("n"), F.min("seq").alias("seq"))
    total = species.agg(F.count("*").alias("total"))
    groups = per.groupBy("og").agg(F.max("n").alias("copies"), F.count("*").alias("have"), F.max(F.length("seq")).alias("width")).where("copies = 1").crossJoin(F.broadcast(total))
    kept = groups.where(F.col("have") / F.col("total") >= least).orderBy(F.desc("have"), "og").limit(most).select("og", "width")
    cells = kept.crossJoin(F.broadcast(species.select("species"))).join(per.select("og", "species", "seq"), ["og", "species"], "left")
    filled = cells.select("species", "og", F.coalesce("seq", F.expr("repeat('-', width)")).alias("seq"))
    return filled.groupBy("species").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("og", "seq"))), lambda x: x["seq"]), "").alias("sequence"))


# --- codons ------------------------------------------------------------------------------------


def codon_alignments(proteins: DataFrame, cds: DataFrame, coverage: float = 0.60, least: int = 3) -> DataFrame:
    """SQ14, ST5: (og, label, codons): proteins (og, label, seq) turned back into codons of cds (og, label, cds).

    Left out: coding sequences that are too short, inner stop codons, then, once a group is cut to its shortest,
    rows over half gaps, over one twentieth of ambiguous bases, and repeats of an earlier label. Groups must keep
    a share and a number of their sequences.
    """
    placed = F.transform(Q.letters(F.col("seq")), lambda c, i: F.struct(i.alias("i"), c.alias("c")))
    coded = F.transform(F.filter(placed, lambda x: x["c"] != "-"), lambda x, j: F.struct(x["i"].alias("i"), F.substring(F.col("cds"), j * 3 + 1, F.lit(3)).alias("codon")))
    gaps = F.transform(F.filter(placed, lambda x: x["c"] == "-"), lambda x: F.struct(x["i"].alias("i"), F.lit("---").alias("codon")))
    codons = F.transform(F.sort_array(F.concat(coded, gaps)), lambda x: x["codon"])
    need = F.length(F.translate("seq", "-", "")) * 3
    joined = proteins.join(cds, ["og", "label"], "left")
    size = proteins.groupBy("og").agg(F.count("*").alias("all"))
    back = joined.where(F.length("cds") >= need).select("og", "label", codons.alias("codons"))
    stops = F.exists(F.slice("codons", 1, F.greatest(F.size("codons") - 1, F.lit(0))), lambda c: F.upper(F.translate(c, "-", "")).isin("TAA", "TAG", "TGA"))
    clean = back.where(~stops)
    per = Window.partitionBy("og")
    enough = clean.join(size, "og").withColumn("n", F.count("*").over(per)).withColumn("width", F.min(F.size("codons")).over(per)).where((F.col("n") >= least) & (F.col("n") / F.col("all") >= coverage))
    text = enough.select("og", "label", F.array_join(F.slice("codons", 1, F.col("width")), "").alias("codons"))
    gaps = F.length("codons") - F.length(F.translate("codons", "-", ""))
    ambiguous = F.length(F.translate("codons", "ATGCatgc-", ""))
    good = text.where((gaps <= 0.50 * F.length("codons")) & (ambiguous <= 0.05 * F.length("codons")))
    distinct = dedup_first(good.withColumn("key", F.upper("codons")), ["og", "key"], [F.col("label")]).drop("key")
    return distinct.withColumn("n", F.count("*").over(per)).where(F.col("n") >= least).drop("n")


def codon_alignments_pass(alignments: DataFrame) -> DataFrame:
    """FLT10: groups (og) of at least three sequences and a hundred codons with at most two fifths of gaps."""
    gaps = F.length("codons") - F.length(F.translate("codons", "-", ""))
    sums = alignments.groupBy("og").agg(F.count("*").alias("n"), F.min(F.length("codons")).alias("width"), F.sum(gaps).alias("gaps"), F.sum(F.length("codons")).alias("all"))
    return sums.where("n >= 3 AND width >= 300 AND gaps <= 0.40 * all").select("og")


# --- regions -----------------------------------------------------------------------------------


def regulatory_divergence(regions: DataFrame, species: DataFrame, sharing: int = 3, clusters: int = 2) -> DataFrame:
    """SQ12, ST1: (gene_id, region_type, divergent, convergent) positions. regions: (gene_id, species_id, region_type, sequence); species: (species_id, is_control, lineage).

    A position diverges if enough species and no control differ from human there, and converges if they are of several lineages.
    """
    keys = ["gene_id", "region_type"]
    regions = regions.repartition(tasks_for(regions, regions.count(), 20_000), *keys)  # a text has many positions, which stay with their region
    human = regions.where("species_id = 'human' AND sequence <> ''").select(*keys, F.col("sequence").alias("human"))
    others = regions.where("species_id <> 'human' AND sequence <> ''").join(F.broadcast(species), "species_id").join(human.hint("merge"), keys)
    spots = others.select(*keys, "species_id", F.coalesce("is_control", F.lit(False)).alias("control"), F.coalesce("lineage", F.lit("Unknown")).alias("lineage"), F.explode(Q.variant_positions(F.col("sequence"), F.col("human"))).alias("pos"))
    per = spots.groupBy(*keys, "pos").agg(F.countDistinct(F.when(~F.col("control"), F.col("species_id"))).alias("n"), F.countDistinct(F.when(~F.col("control"), F.col("lineage"))).alias("lineages"), F.max("control").alias("control"))
    counts = per.where((F.col("n") >= sharing) & ~F.col("control")).groupBy(*keys).agg(F.count("*").alias("divergent"), F.count_if(F.col("lineages") >= clusters).alias("convergent"))
    return human.select(*keys).join(counts.hint("merge"), keys, "left").select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("divergent", "convergent")])


def region_scores(alignments: DataFrame, divergence: DataFrame, species: DataFrame) -> DataFrame:
    """AN4, SQ13: means over species that aren't controls; only promoters get divergence counts. alignments: (gene_id, region_type, species_id, percent_identity, alignment_length, region_length, gap_fraction)."""
    used = alignments.join(F.broadcast(species.where("is_control").select("species_id")), "species_id", "left_anti")
    score = Q.conservation(F.col("percent_identity"), F.col("alignment_length"), F.col("region_length"))
    means = used.groupBy("gene_id", "region_type").agg(F.round(F.avg(score), 4).alias("conservation_score"), F.round(F.avg("percent_identity"), 2).alias("percent_identity"), F.avg("alignment_length").cast("int").alias("alignment_length"), F.round(F.avg("gap_fraction"), 4).alias("gap_fraction"))
    counts = divergence.where("region_type = 'promoter'")
    joined = means.join(counts, ["gene_id", "region_type"], "left")
    return joined.select("gene_id", "region_type", "conservation_score", "percent_identity", "alignment_length", "gap_fraction", F.coalesce("divergent", F.lit(0)).alias("regulatory_divergence_count"), F.coalesce("convergent", F.lit(0)).alias("regulatory_convergence_count"))


def seed_conservation(evolution: DataFrame, phylo: DataFrame) -> DataFrame:
    """AN5: phylop from the coding score where it is null."""
    joined = evolution.join(phylo.select("gene_id", "cds_phylo_score"), "gene_id", "left")
    return joined.withColumn("phylop_score", F.coalesce("phylop_score", "cds_phylo_score")).drop("cds_phylo_score")


# --- motif annotations -------------------------------------------------------------------------


def motif_domains(motifs: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """AN6, JN11: (motif_id, domain_name). motifs: (motif_id, gene_id, start_pos, end_pos); domains: (gene_id, d_start, d_end, name, preferred, ordinal). The second source serves genes that the first has nothing for."""
    domains = first.unionByName(second.join(first.select("gene_id").distinct(), "gene_id", "left_anti"))
    hits = overlap_join(motifs, domains, ["gene_id"], F.col("start_pos") + 1, F.col("end_pos"), "d_start", "d_end")
    order = [F.col("preferred").desc(), F.when(F.col("preferred"), -F.col("ordinal")).otherwise(F.col("ordinal"))]
    return dedup_first(hits, ["motif_id"], order).select("motif_id", F.col("name").alias("domain_name"))


def substitutions(motifs: DataFrame) -> DataFrame:
    """JN15, SQ16: (motif_id, gene_id, position, ref, alt), 1-based in the human protein. motifs: (motif_id, gene_id, human_seq, animal_seq, human_protein)."""
    located = motifs.withColumn("range", Q.protein_range(F.col("human_seq"), F.col("human_protein"))).where("range IS NOT NULL")
    pairs = F.filter(F.arrays_zip(Q.letters(F.col("human_seq")).alias("h"), Q.letters(F.col("animal_seq")).alias("a")), lambda z: (z["h"] != "-") & z["h"].isNotNull())
    rows = located.select("motif_id", "gene_id", F.col("range.start").alias("start"), F.posexplode(pairs).alias("i", "z"))
    return rows.where("z.a IS NOT NULL AND z.a <> '-' AND z.a <> z.h").select("motif_id", "gene_id", (F.col("start") + F.col("i")).alias("position"), F.col("z.h").alias("ref"), F.col("z.a").alias("alt"))


def motif_consequences(changes: DataFrame, accessions: DataFrame, pathogenicity: DataFrame) -> DataFrame:
    """AN7, JN15: (motif_id, consequence_score): mean pathogenicity of a motif's substitutions. Only the changes are shuffled against the table of variants."""
    keyed = changes.join(accessions, "gene_id")
    found = keyed.join(pathogenicity, ["accession", "position", "alt"])
    return found.groupBy("motif_id").agg(F.round(F.avg("score"), 4).alias("consequence_score"))


def motif_likelihoods(changes: DataFrame, log_probs: DataFrame) -> DataFrame:
    """AN8, DS29: (motif_id, esm1v_score): mean log-likelihood ratio. log_probs: (gene_id, position, aa, log_p)."""
    of = lambda side, name: log_probs.select("gene_id", "position", F.col("aa").alias(side), F.col("log_p").alias(name))
    both = changes.join(of("ref", "p_ref"), ["gene_id", "position", "ref"]).join(of("alt", "p_alt"), ["gene_id", "position", "alt"])
    return both.groupBy("motif_id").agg(F.round(F.avg(F.col("p_alt") - F.col("p_ref")), 4).alias("esm1v_score"))


def motif_directions(motifs: DataFrame, loeuf: DataFrame) -> DataFrame:
    """AN9, DS22: motifs (motif_id, gene_id, consequence_score, esm1v_score) with their direction."""
    joined = motifs.join(loeuf.select("gene_id", "loeuf"), "gene_id", "left")
    return joined.withColumn("motif_direction", S.variant_direction(F.col("consequence_score"), F.col("esm1v_score"), F.col("loeuf"))).drop("loeuf")


# Functional features by priority.
FEATURE_PRIORITY = ("active_site", "binding_site", "metal_binding", "site", "modified_residue", "disulfide_bond")


def structural_annotations(motifs: DataFrame, features: DataFrame, residues: DataFrame, centroids: DataFrame, scores: DataFrame, lineages: int = 3) -> DataFrame:
    """AN10, JN14, SC10, DS23: convergent motifs with feature, distance to the pocket, disorder and context.

    motifs: (motif_id, gene_id, convergent_aa_count, start, end) in residues; features: (gene_id, position, feature, description);
    residues: (gene_id, residue, x, y, z, plddt); centroids: (gene_id, px, py, pz); scores: (motif_id, am_score).
    """
    chosen = motifs.where(F.col("convergent_aa_count") >= lineages)
    spread = chosen.select("motif_id", "gene_id", F.explode(F.sequence("start", "end")).alias("position"))
    priority = F.coalesce(F.array_position(F.array(*[F.lit(f) for f in FEATURE_PRIORITY]), F.col("feature")), F.lit(99))
    best = dedup_first(spread.join(features, ["gene_id", "position"]).withColumn("priority", F.when(priority == 0, 99).otherwise(priority)), ["motif_id"], [F.col("priority"), F.col("position")]).select("motif_id", "feature", "description")
    atoms = spread.join(residues.withColumnRenamed("residue", "position"), ["gene_id", "position"]).groupBy("motif_id").agg(*[F.avg(c).alias(c) for c in ("x", "y", "z", "plddt")])
    joined = chosen.join(best, "motif_id", "left").join(atoms, "motif_id", "left").join(centroids, "gene_id", "left").join(scores, "motif_id", "left")
    square = lambda a, b: (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
    placed = joined.withColumn("distance", F.round(F.sqrt(square("x", "px") + square("y", "py") + square("z", "pz")), 2))
    placed = placed.withColumn("is_disordered", F.coalesce(F.col("plddt") < 70, F.lit(False))).withColumn("is_pocket_adjacent", F.coalesce(F.col("distance") <= 8.0, F.lit(False)))
    context = S.structural_context(F.col("feature"), F.col("is_pocket_adjacent"), F.col("is_disordered"), F.col("distance"))
    return placed.select("motif_id", "gene_id", "feature", "description", "am_score", S.pathogenicity_class(F.col("am_score")).alias("am_class"), F.col("plddt").alias("plddt_mean"), "is_disordered", F.col("distance").alias("pocket_distance"), "is_pocket_adjacent", context.alias("structural_context"))


def structural_scores(annotations: DataFrame) -> DataFrame:
    """DS23: (gene_id, structural_score)."""
    hot = F.col("feature").isin("active_site", "binding_site", "metal_binding") | F.col("is_pocket_adjacent")
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    sums = annotations.groupBy("gene_id").agg(share(hot).alias("a"), F.coalesce(F.avg("am_score"), F.lit(0.0)).alias("b"), share(F.col("feature").isNotNull()).alias("c"), F.coalesce(F.avg("plddt_mean") / 100, F.lit(0.5)).alias("d"))
    return sums.select("gene_id", S.r4(S.capped(0.40 * F.col("a") + 0.30 * F.col("b") + 0.20 * F.col("c") + 0.10 * F.col("d"))).alias("structural_score"))


def pocket_proximity(positions: DataFrame, pockets: DataFrame, window: int = 5) -> DataFrame:
    """JN13: (gene_id, proximal). positions: (gene_id, position); pockets: (gene_id, residue). Pocket residues are spread over the window, so the join is by equality."""
    near = pockets.select("gene_id", F.explode(F.sequence(F.col("residue") - window, F.col("residue") + window)).alias("position")).distinct()
    hit = positions.join(near, ["gene_id", "position"], "left_semi").select("gene_id").distinct().withColumn("hit", F.lit(True))
    return positions.select("gene_id").distinct().join(hit, "gene_id", "left").select("gene_id", F.coalesce("hit", F.lit(False)).alias("proximal"))


# --- places on chromosomes ---------------------------------------------------------------------


def chromosome_map(genes: DataFrame, places: DataFrame) -> DataFrame:
    """AN19: (gene_id, chrom, start), 0-based, of genes by symbol; of several places the first. places: (symbol, chrom, start)."""
    symbols = genes.select("gene_id", F.upper(Q.symbol_before_underscore(F.col("gene_symbol"))).alias("symbol"))
    known = places.where("chrom IS NOT NULL AND start IS NOT NULL").withColumn("symbol", F.upper("symbol"))
    return dedup_first(symbols.join(known, "symbol"), ["gene_id"], [F.col("chrom"), F.col("start")]).select("gene_id", "chrom", F.col("start").cast("int").alias("start"))


def conservation_near_start(chromosomes: DataFrame, track: DataFrame, reach: int = 100) -> DataFrame:
    """AN19: (gene_id, phylop_score): mean of a track over the bases from a gene's start on. track: (chrom, pos, value), 0-based.

    Places are dealt to bins as wide as the reach, so a gene meets two bins of the track.
    """
    near = chromosomes.select("gene_id", "chrom", "start", F.explode(F.array(*[F.floor((F.col("start") + d) / reach) for d in (0, reach - 1)])).alias("bin")).distinct()
    hits = near.join(track.withColumn("bin", F.floor(F.col("pos") / reach)), ["chrom", "bin"]).where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + reach))
    return hits.groupBy("gene_id").agg(F.round(F.avg("value"), 4).alias("phylop_score"))


# --- gene annotations --------------------------------------------------------------------------


def annotate_genes(table: DataFrame, landed: DataFrame, gene_symbols: DataFrame, columns: list[str]) -> DataFrame:
    """AN20, AN21, AN27: columns of a landed table (symbol, ...) put into a table by gene; values that are there stay where the new one is null."""
    new = gene_symbols.select("gene_id", F.upper(Q.symbol_before_underscore(F.col("gene_symbol"))).alias("symbol")).join(landed.withColumn("symbol", F.upper("symbol")), "symbol").select("gene_id", *columns)
    return upsert(table, new, ["gene_id"])


def best_known_drug(drugs: DataFrame) -> DataFrame:
    """AG17, SC6: (gene_id, name, phase, indications) of the drug with the highest stage, the first of equals. drugs: (gene_id, ordinal, name, stage, drug_stage, indications)."""
    phase = F.greatest(S.stage_number(F.coalesce("stage", F.lit(""))), S.stage_number(F.coalesce("drug_stage", F.lit(""))))
    best = dedup_first(drugs.withColumn("phase", phase), ["gene_id"], [F.col("phase").desc(), F.col("ordinal")])
    return best.select("gene_id", "name", F.nullif("phase", F.lit(0)).alias("phase"), "indications")


def protective_variants(variants: DataFrame, divergent: DataFrame, traits: DataFrame, reach: int = 3) -> DataFrame:
    """JN12, AN20, SQ19, FLT12: (gene_id, protective_variant_count, best_protective_trait, protective_variant_pvalue).

    variants: (gene_id, variant_id, hgvsp); divergent: (gene_id, position, animal_aa); traits: (gene_id, trait, pvalue). Positions are spread over the reach, so the join is by equality.
    Both joins are by sorting: the tables of genes are small as files, but not as rows, and would be broadcast by the size of their files.
    """
    parsed = variants.withColumn("p", Q.hgvs_protein(F.col("hgvsp"))).where("p IS NOT NULL").select("gene_id", "variant_id", F.col("p.position").alias("position"), F.col("p.alt").alias("alt"))
    near = divergent.select("gene_id", "animal_aa", F.explode(F.sequence(F.col("position") - reach, F.col("position") + reach)).alias("position")).distinct()
    hits = parsed.join(near.hint("merge"), ["gene_id", "position"]).where(Q.similar_amino_acids(F.col("alt"), F.col("animal_aa"))).groupBy("gene_id").agg(F.countDistinct("variant_id").alias("protective_variant_count"))
    best = dedup_first(traits.where("pvalue < 1.0"), ["gene_id"], [F.col("pvalue"), F.col("trait")])
    return hits.join(best.hint("merge"), "gene_id", "left").select("gene_id", "protective_variant_count", F.col("trait").alias("best_protective_trait"), F.col("pvalue").alias("protective_variant_pvalue"))


def safety_flags(genes: DataFrame, degrees: DataFrame, constraint: DataFrame, depmap: DataFrame, tissues: DataFrame) -> DataFrame:
    """AN22, SC7: hubs over fifty partners, essential at pli 0.9, dependency as a sigmoid, breadth and top of expression (tissues: gene_id, tpm map)."""
    joined = genes.select("gene_id").join(degrees, "gene_id", "left").join(constraint, "gene_id", "left").join(depmap, "gene_id", "left").join(tissues, "gene_id", "left")
    wide = F.map_filter("tpm", lambda _, v: v >= 1.0)
    return joined.select(
        "gene_id", F.col("degree").alias("network_degree"), F.coalesce(F.col("degree") > 50, F.lit(False)).alias("hub_risk"), F.coalesce(F.col("pli") >= 0.9, F.lit(False)).alias("is_essential"),
        F.round(S.essentiality(F.col("chronos")), 4).alias("depmap_score"), F.when(F.col("tpm").isNotNull(), F.size(F.map_keys(wide))).alias("gtex_tissue_count"), F.array_max(F.map_values("tpm")).alias("gtex_max_tpm"),
    )


def translational_status(table: DataFrame, landed: DataFrame) -> DataFrame:
    """AN23: the larger phase, and the trait that was there first. Both: (gene_id, phase, trait)."""
    joined = table.alias("o").join(landed.alias("n"), "gene_id", "full_outer")
    return joined.select("gene_id", F.greatest(F.coalesce("o.phase", F.lit(0)), F.coalesce("n.phase", F.lit(0))).alias("phase"), F.coalesce("o.trait", "n.trait").alias("trait"))


def association_scores(associations: DataFrame, disease_ids: list[str]) -> DataFrame:
    """AN11: (gene_id, score), the largest over the configured diseases."""
    return associations.where(F.col("disease_id").isin(disease_ids)).groupBy("gene_id").agg(F.max("score").alias("score"))


def tissue_scores(expression: DataFrame, tissues: list[str]) -> DataFrame:
    """AN12: (gene_id, score) from the mean over configured tissues."""
    return expression.where(F.col("tissue").isin(tissues)).groupBy("gene_id").agg(S.capped(F.log2(1 + F.avg("tpm")) / 10).alias("score"))


def dependency_scores(genes: DataFrame, matrix: DataFrame) -> DataFrame:
    """AN13: (gene_id, score) by symbol; zeros are left out."""
    scored = genes.withColumn("symbol", Q.symbol_before_underscore(F.col("gene_symbol"))).join(matrix, "symbol")
    return scored.select("gene_id", F.round(S.essentiality(F.col("mean")), 4).alias("score")).where("score > 0")


def conserved_expression(calls: DataFrame, terms: list[str], least: int = 2) -> DataFrame:
    """AN14: the first relevant call of each species, for genes with calls in at least two. calls: (gene_id, species_id, ordinal, tissue, score)."""
    first = dedup_first(calls.where(Q.any_term(F.col("tissue"), terms)), ["gene_id", "species_id"], [F.col("ordinal")])
    return first.withColumn("n", F.count("*").over(Window.partitionBy("gene_id"))).where(F.col("n") >= least).drop("n")


def sample_conditions(samples: DataFrame, treated: list[str], control: list[str]) -> DataFrame:
    """AN15: treatment or control by words in the title; samples that match neither are left out."""
    label = F.when(Q.any_term(F.col("title"), control), "control").when(Q.any_term(F.col("title"), treated), "treatment")
    return samples.withColumn("condition", label).where("condition IS NOT NULL")


def count_matrix(wide: DataFrame, gene: str) -> DataFrame:
    """AN15: (gene, sample, count) of a matrix with one column per sample."""
    samples = [c for c in wide.columns if c != gene]
    return wide.unpivot([gene], samples, "sample", "count").withColumn("count", F.round("count").cast("long"))


def branch_sets(species: DataFrame) -> DataFrame:
    """AN16, FLT5, FLT6: (id, branch): test species have phenotypes but no baseline, outgroups and controls are apart."""
    has = lambda p: F.coalesce(F.array_contains("phenotypes", p), F.lit(False))
    control = F.coalesce("is_control", F.lit(False))
    test = (F.size(F.coalesce("phenotypes", F.array().cast("array<string>"))) > 0) & ~has("baseline") & ~has("outgroup") & ~control
    return species.select("id", F.when(test, "test").when(has("outgroup"), "outgroup").when(control | has("baseline"), "reference").otherwise("none").alias("branch"))


def selection_columns(results: DataFrame, model: str) -> DataFrame:
    """AN17, DS21: results (og, omega, p) with the null record where a test gave nothing."""
    missing = F.col("p").isNull()
    return results.select("og", F.coalesce("omega", F.lit(1.0)).alias("dnds_ratio"), F.col("p").alias("dnds_pvalue"), F.when(missing, f"{model.split('_')[0]}_no_signal").otherwise(model).alias("selection_model"))


def load_selection(evolution: DataFrame, results: DataFrame, gene_of: DataFrame, columns: list[str]) -> DataFrame:
    """DS21, SNK4: result columns by orthogroup put into the table of genes. gene_of: (og, gene_id), many to many."""
    best = results.join(gene_of, "og").groupBy("gene_id").agg(*[F.min(c).alias(c) for c in columns])
    return upsert(evolution, best, ["gene_id"])


def still_to_score(groups: DataFrame, evolution: DataFrame, gene_of: DataFrame, columns: list[str]) -> DataFrame:
    """AN18, FLT8: groups (og) with a gene that lacks a result."""
    have = F.lit(True)
    for c in columns:
        have = have & F.col(c).isNotNull()
    done = evolution.where(have).select("gene_id")
    lacking = gene_of.join(done, "gene_id", "left_anti").select("og").distinct()
    return groups.join(lacking, "og", "left_semi")


def promoter_divergence(genes: DataFrame, species: DataFrame, pair_scores: DataFrame) -> DataFrame:
    """AN25, DS28, DS6: rows of gene and species, with each gene's lineage count and score written back. pair_scores: (gene_id, species_id, promoter_divergence) from the model."""
    rows = pair_scores.join(genes.select("gene_id"), "gene_id", "left_semi").join(species.select("species_id", "lineage"), "species_id").select("gene_id", "species_id", "lineage", "promoter_divergence")
    sums = rows.where("promoter_divergence > 0").groupBy("gene_id").agg(F.countDistinct(F.when(F.col("lineage") != "Primates", F.col("lineage"))).alias("lineage_count"), F.max("promoter_divergence").alias("top"))
    score = F.round(S.capped(F.col("top") + 0.1 * F.col("lineage_count")), 4)
    joined = rows.join(sums, "gene_id", "left")
    return joined.select("gene_id", "species_id", "promoter_divergence", F.coalesce("lineage_count", F.lit(0)).alias("lineage_count"), F.coalesce(score, F.lit(0.0)).alias("regulatory_score"))


def literature_scores(abstracts: DataFrame, keywords: list[str]) -> DataFrame:
    """DS27: (gene_id, lit_score): share of abstracts that name the gene and any term. abstracts: (gene_id, symbol, text)."""
    # Terms for any resilience trait.
    terms = [*keywords, "protective", "resistance", "resilience", "adaptation", "evolutionary conservation", "positive selection"]
    hit = F.contains(F.lower("text"), F.lower("symbol")) & Q.any_term(F.col("text"), terms)
    return abstracts.groupBy("gene_id").agg(F.round(F.avg(hit.cast("int")), 4).alias("lit_score"))


def gene_context(genes: DataFrame, motifs: DataFrame, first: int = 5) -> DataFrame:
    """AN26: genes with their first motifs as an array, the top ones taken before they are gathered."""
    best = top_per_key(motifs, ["gene_id"], [F.col("divergence_score").desc(), F.col("start_pos")], first, rank="r")
    listed = best.groupBy("gene_id").agg(F.array_sort(F.collect_list(F.struct("r", "start_pos", "divergence_score"))).alias("motifs"))
    return genes.join(listed, "gene_id", "left")


# --- compounds ---------------------------------------------------------------------------------


def rank_compounds(compounds: DataFrame) -> DataFrame:
    """AN24, DS32, TK7: compounds with their hit score and tier. A gene's first docking method tells whether high is good."""
    per = Window.partitionBy("gene_id")
    method = F.first("docking_method", ignorenulls=True).over(per.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    filled = compounds.withColumn("dock", F.coalesce("docking_score", F.lit(0.0))).withColumn("method", F.coalesce(method, F.lit("estimated")))
    low, high = F.min("dock").over(per), F.max("dock").over(per)
    up = F.col("method").isin("diffdock", "estimated")
    scaled = F.when(high == low, 0.5).when(up, (F.col("dock") - low) / (high - low)).otherwise((high - F.col("dock")) / (high - low))
    scored = filled.withColumn("hit_score", S.hit_score(scaled, F.coalesce("is_purchasable", F.lit(False)), F.col("tanimoto_to_known")))
    return scored.withColumn("hit_tier", S.hit_tier(F.col("hit_score"))).drop("dock", "method")


def selectivity(compounds: DataFrame, panel: DataFrame) -> DataFrame:
    """AN24, JN16: (id, selectivity_score, n_offtarget_similar) against a small panel; both have a fingerprint of longs."""
    refs = panel.agg(F.collect_list("fingerprint").alias("refs"))
    sims = compounds.crossJoin(F.broadcast(refs)).select("id", F.transform("refs", lambda r: Q.tanimoto(F.col("fingerprint"), r)).alias("s"))
    return sims.select("id", F.round(1 - F.coalesce(F.round(F.array_max("s"), 4), F.lit(0.0)), 4).alias("selectivity_score"), F.size(F.filter("s", lambda x: x > 0.4)).alias("n_offtarget_similar"))


def compound_scores(compounds: DataFrame, properties: DataFrame) -> DataFrame:
    """AN24, DS32: properties by compound id: lipinski_pass, selectivity_score, alerts of tox21, sa_score."""
    joined = compounds.join(properties, compounds["id"] == properties["compound_id"], "left")
    sa = F.round((10.0 - F.col("sa_score")) / 9.0, 4)
    overall = S.compound_score(F.col("hit_score"), F.col("lipinski_pass"), F.col("selectivity_score"), F.col("tox21_score"), sa)
    return joined.select("compound_id", sa.alias("sa_normalized"), overall.alias("overall_compound_score")).withColumn("compound_tier", S.compound_tier(F.col("overall_compound_score")))


def alert_scores(compounds: DataFrame, tox21: int) -> DataFrame:
    """AN24: scores from counts of matched alerts (id, tox21_hits, herg_hits); matching itself lands from a chemistry tool."""
    return compounds.select("id", F.round(F.col("tox21_hits") / tox21, 4).alias("tox21_score"), F.round(S.capped(F.col("herg_hits") * 0.25), 4).alias("herg_risk"))


def screened(compounds: DataFrame, top: int = 10) -> DataFrame:
    """TK7, SQ29: each gene's best compounds by estimated docking, lowest first. compounds: (gene_id, id, smiles, pocket_score)."""
    scored = compounds.withColumn("docking_score", Q.atom_docking_proxy(F.col("smiles"), F.col("pocket_score")))
    return top_per_key(scored, ["gene_id"], [F.col("docking_score"), F.col("id")], top)


def aav_table(proteins: DataFrame) -> DataFrame:
    """DS33: (gene_id, gene_size_bp, aav_compatible) from protein lengths."""
    size = S.aav_size(F.col("length"))
    return proteins.select("gene_id", size.alias("gene_size_bp"), (size <= 4700).alias("aav_compatible"))


# Small-molecule tractability labels by priority, their tiers, and the tiers' scores.
TRACTABILITY_TIERS = (
    ("Approved Drug", "A"),
    ("Advanced Clinical", "A"),
    ("Phase 1 Clinical", "B"),
    ("Structure with Ligand", "B"),
    ("High-Quality Ligand", "C"),
    ("High-Quality Pocket", "C"),
    ("Druggable Family", "C"),
    ("Med-Quality Pocket", "D"),
    ("Literature", "D"),
)
TIER_SCORES = {"A": 1.0, "B": 0.75, "C": 0.5, "D": 0.25}


def tractability_tier(items: Column) -> Column:
    """DS34: the tier of the first label that holds, antibodies with clinical precedence as B. items: array of (label, modality, value)."""
    has = lambda label, modality: F.exists(items, lambda i: (i["label"] == label) & (i["modality"] == modality) & i["value"])
    small = F.coalesce(*[F.when(has(label, "SM"), F.lit(tier)) for label, tier in TRACTABILITY_TIERS])
    return F.coalesce(small, F.when(has("Clinical Precedence", "AB"), F.lit("B")))


def provided_sequences(genes: DataFrame, provider: SequenceProvider) -> DataFrame:
    """UDF2: (gene_id, sequence) from a user's function, which gets the gene ids of a batch and gives as many sequences or nulls.

    It runs in Spark tasks, on Arrow arrays. What it gives is checked, and an exception names the first gene of its batch.
    """

    def provide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("gene_id")
            first = ids[0].as_py() if len(ids) else None
            try:
                found = provider(ids)
                found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found if isinstance(found, pa.Array) else pa.array(found, pa.string())
                if not (pa.types.is_string(found.type) or pa.types.is_null(found.type)) or len(found) != len(ids):
                    raise TypeError(f"{len(ids)} texts or nulls expected, got {len(found)} of type {found.type}")
            except Exception as error:
                raise ValueError(f"sequence provider failed on the batch of {len(ids)} genes from {first!r}: {error}") from error
            yield pa.RecordBatch.from_arrays([ids, found.cast(pa.string())], names=["gene_id", "sequence"])

    return genes.select(F.col("gene_id").cast("string").alias("gene_id")).mapInArrow(provide, "gene_id string, sequence string")


def crispr_table(genes: DataFrame, sequences: DataFrame | SequenceProvider) -> DataFrame:
    """UDF2, SQ22: (gene_id, crispr_sites, crispr_efficiency, offtarget_risk) from a table (gene_id, sequence) or a function that provides sequences; null where it has none."""
    # ids are few bytes, so they are dealt to a number of tasks; guides are found where sequences are
    spread = lambda df: df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "gene_id")
    found = sequences if isinstance(sequences, DataFrame) else provided_sequences(spread(genes.select("gene_id")).distinct(), sequences)
    guides = spread(genes.select("gene_id")).join(found.select("gene_id", Q.scored_guides(F.col("sequence")).alias("g")).hint("merge"), "gene_id", "left")
    return guides.select("gene_id", F.col("g.sites").alias("crispr_sites"), F.col("g.mean_efficiency").alias("crispr_efficiency"), F.col("g.risk").alias("offtarget_risk"))


def peptide_columns(motifs: DataFrame) -> DataFrame:
    """AN21, SQ23: motifs with half_life_min and synthesisable from their sequences."""
    seq = F.regexp_replace(F.coalesce(F.nullif("animal_seq", F.lit("")), F.col("human_seq"), F.lit("")), "-", "")
    half = F.when(F.length(seq) > 0, Q.half_life_minutes(Q.boman_index(seq), F.length(seq)))
    return motifs.withColumns({"half_life_min": half, "synthesisable": Q.synthesisable(F.col("animal_seq"), F.col("human_seq"))})


#: Fingerprints of a gene that are compared at a time: compounds and drugs.
COMPARED = (4096, 4096)


def _blocks(rows: DataFrame, entry: Column, size: int, name: str) -> DataFrame:
    """(gene_id, name): the distinct rows (gene_id, fingerprint, ...) of a gene as arrays of about `size` entries."""
    sizes = rows.groupBy("gene_id").agg(F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("fingerprint"), F.ceil(F.col("n") / size))
    return rows.join(sizes, "gene_id").groupBy("gene_id", block.alias("block")).agg(F.sort_array(F.collect_list(entry)).alias(name)).drop("block")


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of the most similar drugs of a block for each compound of a block, likeness in ten-thousandths."""
    types = {"gene_id": pa.string(), "fingerprint": pa.list_(pa.int64()), "t": pa.int64(), "name": pa.string()}
    for batch in batches:
        for r in range(batch.num_rows):
            gene, asked, drugs = (batch.column(c)[r].as_py() for c in ("gene_id", "compounds", "drugs"))
            found = []
            for width in {len(x) for x in asked}:
                mine, theirs = [x for x in asked if len(x) == width], [d for d in drugs if len(d["fingerprint"]) == width]
                if not theirs:
                    continue
                a, b = (np.array(x, np.int64).reshape(len(x), width).view(np.uint64) for x in (mine, [d["fingerprint"] for d in theirs]))
                size_b = np.bitwise_count(b).sum(1, dtype=np.float64)
                for at in range(0, len(a), 64):
                    part = a[at : at + 64]
                    both = np.zeros((len(part), len(b)))
                    for k in range(width):
                        both += np.bitwise_count(part[:, None, k] & b[None, :, k])
                    either = np.bitwise_count(part).sum(1, dtype=np.float64)[:, None] + size_b - both
                    t = np.floor((20000 * both + either) / np.maximum(2 * either, 1))  # rounded half up, exactly
                    best = t.argmax(1)
                    found += [(gene, x, int(t[n, j]), theirs[j]["name"]) for n, (x, j) in enumerate(zip(mine[at : at + 64], best.tolist(), strict=True))]
            columns = list(zip(*found, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, types.values(), strict=True)], names=list(types))


def nearest_known_drug(compounds: DataFrame, drugs: DataFrame) -> DataFrame:
    """AN24, SQ28: (id, tanimoto_to_known, nearest_known_drug), the first of the most similar drugs of the gene. Both have fingerprints of longs.

    Distinct fingerprints of a gene are compared block by block, so neither a row for each pair nor all drugs of a gene meet in one row.
    """
    whole = F.col("gene_id").isNotNull() & F.col("fingerprint").isNotNull() & ~F.exists("fingerprint", lambda x: x.isNull())
    asked = compounds.where(whole).select("gene_id", "fingerprint").distinct()
    known = drugs.where(whole).groupBy("gene_id", "fingerprint").agg(F.min("name").alias("name"))
    left, right = _blocks(asked, F.col("fingerprint"), COMPARED[0], "compounds"), _blocks(known, F.struct("name", "fingerprint"), COMPARED[1], "drugs")
    tasks = 4 * compounds.sparkSession.sparkContext.defaultParallelism
    pairs = left.join(right, "gene_id").repartition(tasks)  # a pair of blocks is work for a whole task, however few bytes it has
    found = pairs.select(F.col("gene_id").cast("string"), "compounds", "drugs").mapInArrow(_nearest, "gene_id string, fingerprint array<long>, t long, name string")
    best = found.groupBy("gene_id", "fingerprint").agg(F.min(F.struct((-F.col("t")).alias("t"), "name")).alias("best")).select("gene_id", "fingerprint", (-F.col("best.t") / 10000).alias("t"), "best.name")
    return compounds.join(best.hint("merge"), ["gene_id", "fingerprint"], "left").select("id", F.col("t").alias("tanimoto_to_known"), F.col("name").alias("nearest_known_drug"))
