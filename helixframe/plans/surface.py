"""The query surface and the second scoring phase over domain tables made from the star tables, each with its SQL.

Parts stand for genes, suppliers for species, their pairs in line items for orthologs, line items for motifs,
orders for expression results.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.plans import annotate as A
from helixframe.plans import api, scoring
from helixframe.plans import evolution as E
from helixframe.plans.biology import _BOMAN, _SUBSCORES, _inputs, rounded
from helixframe.plans.domain import _UNIQUE, _unique
from helixframe.plans.landing import folder
from helixframe.plans.relational import table
from helixframe.schemas import conform

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def _id(letter: str, *columns: str) -> F.Column:
    return F.concat(F.lit(letter), F.concat_ws("_", *[F.col(c).cast("string") for c in columns]))


def _store(spark, sf_dir) -> api.Store:
    part, supplier, orders = (table(spark, sf_dir, n) for n in ("part", "supplier", "orders"))
    lines, size, c = _unique(spark, sf_dir), F.col("p_size"), F.col
    gene = part.select(_id("g", "p_partkey").alias("id"), _id("P", "p_partkey").alias("human_gene_id"), c("p_name").alias("gene_symbol"), c("p_brand").alias("human_protein"), F.split("p_type", " ").alias("go_terms"), F.when(size > 5, F.array("p_brand")).alias("pathway_ids"))
    tier = F.when(size <= 10, "Tier1").when(size <= 25, "Tier2").when(size <= 45, "Tier3")
    candidate = part.select(
        _id("g", "p_partkey").alias("gene_id"), F.lit("").alias("trait_id"), F.when(size % 10 != 0, c("p_retailprice") / 2000).alias("composite_score"), tier.alias("tier"), (size / 50).alias("convergence_score"),
        F.when(size % 3 == 0, 0.5).alias("selection_score"), (F.make_ym_interval(F.lit(0), size % 12) + F.lit("2024-01-15 10:30:00").cast("timestamp_ntz")).alias("updated_at"),
    )
    direction = F.when(c("l_returnflag") == "R", "gain_of_function").otherwise("neutral")
    motif = lines.select(_id("m", "l_orderkey", "l_linenumber").alias("id"), _id("o", "l_partkey", "l_suppkey").alias("ortholog_id"), c("l_linenumber").alias("start_pos"), c("l_discount").alias("divergence_score"), (c("l_tax") > 0.06).alias("in_functional_domain"), direction.alias("motif_direction"))
    ortholog = lines.select("l_partkey", "l_suppkey").distinct().select(_id("o", "l_partkey", "l_suppkey").alias("id"), _id("g", "l_partkey").alias("gene_id"), _id("s", "l_suppkey").alias("species_id"), _id("s", "l_suppkey").alias("protein_id"))
    species = supplier.select(_id("s", "s_suppkey").alias("id"), c("s_nationkey").alias("taxid"), c("s_name").alias("scientific_name"), (c("s_nationkey") % 5 == 0).alias("is_control"))
    result = orders.select(_id("g", "o_custkey").alias("gene_id"), _id("GSE", "o_orderkey").alias("geo_accession"), c("o_orderpriority").alias("comparison"), (c("o_totalprice") / 100000).alias("log2fc"), F.when(c("o_orderstatus") != "P", c("o_totalprice") / 1000000).alias("padj"))
    pathway = part.groupBy(c("p_brand").alias("pathway_id")).agg(F.count_if(size <= 2).alias("candidate_count"), (F.max("p_retailprice") / 2000).alias("pathway_score"))
    tables = {"gene": gene, "candidate_score": candidate, "divergent_motif": motif, "ortholog": ortholog, "species": species, "expression_result": result, "pathway_convergence": pathway}
    return api.Store({k: conform(v, k) for k, v in tables.items()})


_CANDIDATES = f"""
lines AS {_UNIQUE}, found AS (
  SELECT p_partkey AS k, 'g' || p_partkey AS gene_id, p_name AS gene_symbol, p_brand AS human_protein, CASE WHEN p_size <= 10 THEN 'Tier1' WHEN p_size <= 25 THEN 'Tier2' ELSE 'Tier3' END AS tier,
    CASE WHEN p_size % 10 <> 0 THEN p_retailprice / 2000 END AS score, p_size / 50::DOUBLE AS convergence_score, CASE WHEN p_size % 3 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS selection_score, 0.0::DOUBLE AS expression_score,
    strftime(TIMESTAMP '2024-01-15 10:30:00' + to_months((p_size % 12)::INT), '%Y-%m-%dT%H:%M:%S') AS updated_at, string_split(p_type, ' ') AS go_terms FROM part)
"""
_SHOWN = "gene_id, gene_symbol, human_protein, tier, coalesce(score, 0.0)::DOUBLE AS composite_score, convergence_score, selection_score, expression_score, updated_at"


@query(f"WITH {_CANDIDATES} SELECT {_SHOWN} FROM found WHERE list_contains(go_terms, 'PROMO') ORDER BY score DESC NULLS FIRST, gene_id LIMIT 50 OFFSET 10")
def surface_candidates_page(spark, sf_dir):
    """FLT1, FLT2, FLT13, JN1, TK2, SC12: a page of ranked candidates of a pathway."""
    return api.candidates(_store(spark, sf_dir), pathway="PROMO", limit=50, offset=10)


@query(f"""
WITH {_CANDIDATES} SELECT {_SHOWN} FROM found WHERE tier = 'Tier1' AND score >= 0.452 AND k IN (SELECT l_partkey FROM lines WHERE l_suppkey = 7)
  AND k IN (SELECT l_partkey FROM lines WHERE l_tax > 0.06) AND k IN (SELECT l_partkey FROM lines WHERE l_returnflag = 'R') ORDER BY score DESC NULLS FIRST, gene_id LIMIT 1000
""")
def surface_candidates_filtered(spark, sf_dir):
    """FLT1, JN2, JN4: candidates by tier, species, functional domain, direction and score."""
    return api.candidates(_store(spark, sf_dir), tier="Tier1", species_id="s7", in_functional_domain=True, variant_direction="gain_of_function", limit=1000, min_score=0.452)


@query(f"""
WITH {_CANDIDATES}, own AS (SELECT * FROM lines WHERE l_partkey = 7)
SELECT gene_id, gene_symbol, score AS composite_score, (SELECT count(DISTINCT l_suppkey) FROM own) AS orthologs, (SELECT count(*) FROM own) AS motifs, (SELECT max(l_discount) FROM own) AS most FROM found WHERE k = 7
""")
def surface_detail(spark, sf_dir):
    """JN2, JN3: one candidate with its orthologs and motifs."""
    one = api.candidate_detail(_store(spark, sf_dir), "g7")
    most = F.array_max(F.transform("motifs", lambda m: m["divergence_score"]))
    return one.select("gene_id", "gene_symbol", "composite_score", F.size("orthologs").cast("long").alias("orthologs"), F.size("motifs").cast("long").alias("motifs"), most.alias("most"))


@query("SELECT 'g' || p_partkey AS gene_id, p_name AS gene_symbol, 'P' || p_partkey AS human_gene_id, p_brand AS human_protein FROM part WHERE contains(lower(p_name), 'p1') OR contains(lower('P' || p_partkey), 'p1') OR contains(lower(p_brand), 'p1') ORDER BY 1 LIMIT 50")
def surface_search(spark, sf_dir):
    """FLT3: genes by a part of symbol, id or protein, in any case."""
    return api.search(_store(spark, sf_dir), " P1 ")


@query("""
WITH genes AS (SELECT * FROM part WHERE p_size <= 25), terms AS (SELECT DISTINCT 'go_terms' AS kind, unnest(string_split(p_type, ' ')) AS pathway FROM genes UNION SELECT 'pathway_ids', p_brand FROM genes WHERE p_size > 5)
SELECT kind, pathway FROM terms QUALIFY row_number() OVER (PARTITION BY kind ORDER BY pathway) <= 200
""")
def surface_pathways(spark, sf_dir):
    """AG22, FLT4: terms and pathways of genes in the upper tiers, the first two hundred of each."""
    return api.pathways(_store(spark, sf_dir))


@query("SELECT p_brand AS pathway_id, count(*) FILTER (WHERE p_size <= 2)::INT AS candidate_count, max(p_retailprice) / 2000 AS pathway_score FROM part GROUP BY 1 HAVING count(*) FILTER (WHERE p_size <= 2) >= 2 ORDER BY pathway_score DESC, pathway_id LIMIT 10")
def surface_pathway_convergence(spark, sf_dir):
    """TK1, TK3: pathways with enough candidates, best first."""
    return api.pathway_convergence(_store(spark, sf_dir), top=10).select("pathway_id", "candidate_count", "pathway_score")


@query("""
SELECT 'g7' AS gene_id, 'GSE' || o_orderkey AS geo_accession, o_orderpriority AS comparison, o_totalprice / 100000 AS log2fc, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000000 END AS padj
FROM orders WHERE o_custkey = 7 AND EXISTS (SELECT 1 FROM part WHERE p_partkey = 7) ORDER BY padj NULLS LAST, geo_accession, comparison LIMIT 5
""")
def surface_scores(spark, sf_dir):
    """TK1, WN10: a gene's scores with its strongest expression evidence."""
    one = api.scores(_store(spark, sf_dir), "g7", evidence=5)
    return one.select("gene_id", F.explode("evidence").alias("e")).select("gene_id", "e.geo_accession", "e.comparison", "e.log2fc", "e.padj")


@query("SELECT 's' || s_suppkey AS id, s_nationkey AS taxid, s_name AS scientific_name, s_nationkey % 5 = 0 AS is_control FROM supplier")
def surface_species(spark, sf_dir):
    """SRC1: the species list."""
    return api.species(_store(spark, sf_dir)).select("id", "taxid", "scientific_name", "is_control")


@query("SELECT n_name AS id, 'trait of ' || n_name AS label, n_regionkey AS rank FROM nation")
def surface_traits(spark, sf_dir):
    """SRC3: trait presets of a JSON document. The document, small by its nature, is made from nations here."""
    presets = table(spark, sf_dir, "nation").agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("n_name").alias("id"), F.concat(F.lit("trait of "), "n_name").alias("label"), F.col("n_regionkey").alias("rank"))))).alias("value"))
    path = folder(presets)
    presets.coalesce(1).write.text(path)
    return api.traits(spark, path, "id string, label string, rank int")


@query(f"WITH {_SUBSCORES} SELECT 'g' || gene AS gene_id, convergence AS convergence_score, {rounded('selection', 7)} AS selection_score, disease AS disease_score, druggability AS druggability_score, safety AS safety_score, CASE WHEN safety < 0.2 THEN 0.0 ELSE raw END AS composite_score FROM comps")
def phase2_scores(spark, sf_dir):
    """DS12, JN3, JN9: scores of phase 2 from the tables of evidence of every gene."""
    c, rows = F.col, _inputs(spark, sf_dir).withColumn("gene_id", _id("g", "gene"))
    evolution = conform(rows.select("gene_id", c("omega").alias("dnds_ratio"), c("p").alias("dnds_pvalue"), F.lit(S.BRANCH_SITE).alias("selection_model")), "evolution_score")
    store = api.Store({
        "gene": rows.select(c("gene_id").alias("id")), "evolution_score": evolution.drop("convergence_count").join(rows.select("gene_id", (c("species") / 5.0).alias("convergence_count")), "gene_id"),
        "disease_annotation": conform(rows.select("gene_id", c("association").alias("opentargets_score"), c("p").alias("gwas_pvalue"), c("phase").alias("known_drug_phase")), "disease_annotation"),
        "drug_target": conform(rows.select("gene_id", c("pockets").alias("pocket_count"), c("pocket").alias("top_pocket_score"), F.lit("C").alias("druggability_tier"), c("hub").alias("tractability_sm")), "drug_target"),
        "safety_flag": conform(rows.select("gene_id", c("hub").alias("hub_risk"), F.lit(1).alias("family_size"), c("depmap").alias("depmap_score"), c("tissues").alias("gtex_tissue_count")), "safety_flag"),
    })
    scored = scoring.score_phase2(store).withColumn("selection_score", F.round("selection_score", 7))
    return scored.select("gene_id", *[f"{k}_score" for k in ("convergence", "selection", "disease", "druggability", "safety", "composite")])


# --- selection results in files ----------------------------------------------------------------


@query("""
WITH r AS (SELECT l_orderkey AS og, CASE l_linenumber % 3 WHEN 0 THEN 'paml_branch_site' WHEN 1 THEN 'paml_no_signal' ELSE 'proxy' END AS selection_model, l_quantity AS dnds_ratio, l_tax AS dnds_pvalue FROM lineitem WHERE l_returnflag <> 'N'),
f AS (SELECT *, row_number() OVER (PARTITION BY og ORDER BY CASE selection_model WHEN 'paml_branch_site' THEN 3 WHEN 'paml_no_signal' THEN 1 ELSE 0 END DESC, selection_model, dnds_pvalue, dnds_ratio) AS n FROM r)
SELECT og::VARCHAR AS og, selection_model, dnds_ratio, dnds_pvalue FROM f WHERE n = 1
""")
def selection_batches(spark, sf_dir):
    """AN28: results of batches of orthogroups written as JSON and collected, the best model of each orthogroup."""
    k = F.col("l_linenumber") % 3
    model = F.when(k == 0, "paml_branch_site").when(k == 1, "paml_no_signal").otherwise("proxy")
    status = F.when(F.col("l_returnflag") == "N", "skipped").otherwise("ok")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("og"), status.alias("status"), model.alias("selection_model"), F.col("l_quantity").alias("dnds_ratio"), F.col("l_tax").alias("dnds_pvalue"))
    path = folder(rows)
    E.write_selection(rows, path, batches=8)
    return E.read_selection(spark, path)


# --- annotators --------------------------------------------------------------------------------


@query("SELECT 'g' || p.p_partkey AS gene_id, CASE WHEN p.p_partkey % 3 = 0 AND p.p_size % 4 <> 0 THEN p.p_retailprice ELSE p.p_size::DOUBLE END AS loeuf FROM part p")
def annotated_genes(spark, sf_dir):
    """AN20, AN21, AN27: a landed table by symbol put over the values of genes, nulls changing nothing."""
    part, gene = table(spark, sf_dir, "part"), _id("g", "p_partkey").alias("gene_id")
    symbols = part.select(gene, F.concat(_id("Sym", "p_partkey"), F.lit("_HUMAN")).alias("gene_symbol"))
    landed = part.where("p_partkey % 3 = 0").select(_id("sYM", "p_partkey").alias("symbol"), F.when(F.col("p_size") % 4 != 0, F.col("p_retailprice")).alias("loeuf"))
    return A.annotate_genes(part.select(gene, F.col("p_size").cast("double").alias("loeuf")), landed, symbols, ["loeuf"])


@query(f"""
WITH lines AS {_UNIQUE}, v AS (SELECT l_partkey AS gene, 'rs' || l_orderkey || '_' || l_linenumber AS variant, (l_quantity * 4)::INT AS pos, CASE l_linenumber % 3 WHEN 0 THEN 'V' WHEN 1 THEN 'K' ELSE 'D' END AS alt FROM lines WHERE l_linenumber <> 2),
d AS (SELECT p_partkey AS gene, p_size * 4 AS pos, CASE p_size % 2 WHEN 0 THEN 'I' ELSE 'R' END AS aa FROM part),
h AS (SELECT gene, count(DISTINCT variant) AS n FROM v JOIN d USING (gene) WHERE abs(v.pos - d.pos) <= 3 AND (aa = 'I' AND alt = 'V' OR aa = 'R' AND alt = 'K') GROUP BY 1),
t AS (SELECT p_partkey AS gene, p_type AS trait, p_size / 40.0::DOUBLE AS p FROM part)
SELECT 'g' || gene AS gene_id, n AS protective_variant_count, CASE WHEN p < 1 THEN trait END AS best_protective_trait, CASE WHEN p < 1 THEN p END AS protective_variant_pvalue FROM h JOIN t USING (gene)
""")
def protective_variant_hits(spark, sf_dir):
    """JN12, AN20, SQ19: variants within three residues of a divergent one, of the same class, with the best trait."""
    lines, part, gene = _unique(spark, sf_dir), table(spark, sf_dir, "part"), _id("g", "p_partkey").alias("gene_id")
    k = F.col("l_linenumber") % 3
    alt = F.when(k == 0, "Val").when(k == 1, "Lys").otherwise("Asp")
    change = F.when(F.col("l_linenumber") != 2, F.concat(F.lit("ENSP1.2:p.Ala"), (F.col("l_quantity") * 4).cast("int").cast("string"), alt)).otherwise("p.?")
    variants = lines.select(_id("g", "l_partkey").alias("gene_id"), _id("rs", "l_orderkey", "l_linenumber").alias("variant_id"), change.alias("hgvsp"))
    divergent = part.select(gene, (F.col("p_size") * 4).alias("position"), F.when(F.col("p_size") % 2 == 0, "I").otherwise("R").alias("animal_aa"))
    return A.protective_variants(variants, divergent, part.select(gene, F.col("p_type").alias("trait"), (F.col("p_size") / 40).alias("pvalue")))


@query(f"""
WITH t AS (SELECT p_partkey, upper(regexp_replace(CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_brand END, '[^A-Za-z]', '', 'g')) AS s FROM part),
b AS (SELECT p_partkey, s, length(s) AS n, round(list_sum(list_transform(string_split(s, ''), lambda c: coalesce(map_extract_value(MAP {{{_BOMAN}}}, c), 1.0)::DOUBLE)) / length(s), 4) AS boman FROM t)
SELECT p_partkey, CASE WHEN n >= 5 THEN round(30.0 * (boman / 2.0) * (1.0 + (20 - least(n, 20)) / 20.0), 1) END AS half_life_min, n BETWEEN 10 AND 20 AND n - length(replace(s, 'C', '')) <= 3 AS synthesisable FROM b
""")
def peptide_half_lives(spark, sf_dir):
    """AN21, SQ23: peptide columns of motifs; the animal's sequence counts, gaps left out, else the human one."""
    letters = lambda c: F.upper(F.regexp_replace(c, "[^A-Za-z]", ""))
    motifs = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("-"), letters("p_name"))).otherwise("").alias("animal_seq"), letters("p_brand").alias("human_seq"))
    return A.peptide_columns(motifs).select("p_partkey", "half_life_min", "synthesisable")


@query("""
WITH c AS (SELECT p_partkey AS id, p_brand AS gene, p_partkey AS f FROM part), d AS (SELECT s_name AS name, 'Brand#' || (s_nationkey % 3 + 1) || (s_nationkey % 5 + 1) AS gene, s_suppkey * 7 AS f FROM supplier),
j AS (SELECT id, name, round(CASE WHEN (c.f | d.f) = 0 THEN 0.0 ELSE bit_count(c.f & d.f) / bit_count(c.f | d.f)::DOUBLE END, 4) AS t FROM c JOIN d USING (gene))
SELECT c.id, b.t AS tanimoto_to_known, b.name AS nearest_known_drug FROM c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC, name) AS r FROM j QUALIFY r = 1) b ON b.id = c.id
""")
def known_drug_nearest(spark, sf_dir):
    """AN24, SQ28: the most similar known drug of each compound's gene."""
    compounds = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("gene_id"), F.array("p_partkey").alias("fingerprint"))
    k = F.col("s_nationkey")
    gene = F.concat(F.lit("Brand#"), (k % 3 + 1).cast("string"), (k % 5 + 1).cast("string"))
    drugs = table(spark, sf_dir, "supplier").select("s_name", gene.alias("gene_id"), F.array(F.col("s_suppkey") * 7).alias("fingerprint")).withColumnRenamed("s_name", "name")
    return A.nearest_known_drug(compounds, drugs)
