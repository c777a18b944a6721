"""Annotation queries over the star tables, each with its SQL.

Parts stand for genes, suppliers for species, line items for motifs; what external tools deliver is made from
the tables' own columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.functions import sequence as Q
from helixframe.plans import annotate as A
from helixframe.plans import evolution as E
from helixframe.plans import scoring
from helixframe.plans.biology import rounded
from helixframe.plans.domain import _UNIQUE, _unique
from helixframe.plans.relational import table, tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


# --- sequences of neighbouring parts -----------------------------------------------------------

_ALIGNED = """
aligned AS (SELECT p_partkey // 4 AS og, CASE WHEN p_partkey % 4 = 0 THEN 'human|x' ELSE 's' || p_partkey % 4 || '|x' END AS label, rpad(repeat(p_name, 4), 60, '-') AS seq FROM part),
human AS (SELECT og, seq AS h FROM aligned WHERE label = 'human|x'), pairs AS (SELECT a.og, a.label, a.seq, h FROM aligned a JOIN human USING (og) WHERE a.label <> 'human|x')
"""
_WINDOWS = f"""
{_ALIGNED}, w AS (SELECT og, label, s::INT AS start_pos, substr(seq, s + 1, 15) AS a, substr(h, s + 1, 15) AS b FROM pairs, unnest(generate_series(0, 45, 5)) AS u(s)),
usable AS (SELECT *, count(*) OVER (PARTITION BY og, start_pos) AS n FROM w WHERE 15 - length(replace(a, '-', '')) <= 7.5),
d AS (SELECT og, label, start_pos, a, b, list_sum(list_transform(generate_series(1, 15), lambda i: (substr(a, i, 1) <> substr(b, i, 1))::INT))::DOUBLE AS differ,
  list_sum(list_transform(generate_series(1, 15), lambda i: (substr(a, i, 1) <> '-' OR substr(b, i, 1) <> '-')::INT)) AS used FROM usable WHERE n >= 2),
scan AS (SELECT og, label, start_pos, {rounded("differ / used", 4)} AS divergence_score FROM d WHERE used > 0 AND differ / used >= 0.15)
"""


def _aligned(spark, sf_dir):
    k = F.col("p_partkey")
    label = F.when(k % 4 == 0, "human|x").otherwise(F.concat(F.lit("s"), k % 4, F.lit("|x")))
    return table(spark, sf_dir, "part").select(F.floor(k / 4).alias("og"), label.alias("label"), F.rpad(F.repeat("p_name", F.lit(4)), 60, "-").alias("seq"))


@query(f"WITH {_WINDOWS} SELECT * FROM scan")
def motif_scan(spark, sf_dir):
    """SQ1, SQ2, AN2, AN3: divergent windows with their guards against gaps and thin coverage."""
    return A.scan_motifs(_aligned(spark, sf_dir)).select("og", "label", "start_pos", "divergence_score")


@query(f"WITH {_WINDOWS}, l AS (SELECT *, CASE label WHEN 's3|x' THEN 'B' ELSE 'A' END AS lineage FROM scan) SELECT og, label, start_pos FROM l WHERE og IN (SELECT og FROM l GROUP BY 1 HAVING count(DISTINCT lineage) >= 2)")
def motif_lineage_gate(spark, sf_dir):
    """SQ8: motifs of groups that several lineages have."""
    lineages = spark.createDataFrame([("s1", "A"), ("s2", "A"), ("s3", "B")], "species string, lineage string")
    return A.lineage_gate(A.scan_motifs(_aligned(spark, sf_dir)), lineages).select("og", "label", "start_pos")


@query(f"""
WITH {_WINDOWS}, r AS (SELECT s.*, row_number() OVER (PARTITION BY og, label ORDER BY divergence_score DESC, start_pos) AS r FROM scan s WHERE NOT (label = 's2|x' AND og % 2 = 0))
SELECT og, label, start_pos, {rounded("divergence_score * CASE label WHEN 's1|x' THEN 1.0 WHEN 's2|x' THEN 10.0 / 40 ELSE 10.0 / 80 END", 6)} AS weighted FROM r WHERE r <= 3
""")
def motif_weights(spark, sf_dir):
    """SQ7, SQ9: the most divergent motifs of orthologs up to an identity, weighed by distance."""
    aligned = _aligned(spark, sf_dir)
    keys = aligned.where("label <> 'human|x'").select("og", F.split("label", "\\|")[0].alias("species_id"))
    # the join of motifs and orthologs is by label, so labels carry the group here
    full = lambda df: df.withColumn("label", F.concat("label", F.lit("_"), F.col("og")))
    orthologs = keys.select(F.concat_ws("_", "species_id", "og").alias("id"), "species_id", F.concat(F.lit("x_"), "og").alias("protein_id"), F.when((F.col("species_id") == "s2") & (F.col("og") % 2 == 0), 90.0).otherwise(50.0).alias("sequence_identity_pct"))
    motifs = full(A.scan_motifs(aligned))
    kept = A.persisted_motifs(motifs, orthologs, 85.0, 3)
    named = kept.withColumn("label", F.concat_ws("|", F.split("ortholog_id", "_")[0], F.lit("x")))
    weights = A.branch_weights(spark.createDataFrame([("human", 0.0), ("s1", 10.0), ("s2", 40.0), ("s3", 80.0)], "species string, distance double"))
    return A.weighted_motifs(named, weights).select("og", "label", "start_pos", F.round("divergence_score", 6).alias("weighted"))


_KMERS = "list_distinct(list_transform(generate_series(1, length({0}) - 2), lambda i: substr({0}, i, 3)))"


@query(f"""
WITH {_ALIGNED}, k AS (SELECT og, {_KMERS.format("seq")} AS a, {_KMERS.format("h")} AS b FROM pairs)
SELECT og FROM k GROUP BY og HAVING count(*) FILTER (WHERE 100.0 * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) < 85) >= 2
""")
def identity_gate_groups(spark, sf_dir):
    """SQ4, SQ5: groups in which two sequences or more are far from the human one."""
    return A.identity_gate(_aligned(spark, sf_dir)).select("og")


@query(f"""
WITH {_ALIGNED}, c AS (SELECT og, list_filter(list_transform(generate_series(1, 60), lambda i: CASE WHEN substr(seq, i, 1) <> '-' AND substr(h, i, 1) <> '-' THEN (substr(seq, i, 1) <> substr(h, i, 1))::INT END), lambda x: x IS NOT NULL) AS x FROM pairs),
m AS (SELECT og, avg(list_sum(x) / len(x)) AS d FROM c WHERE len(x) > 0 GROUP BY 1)
SELECT og, round(d / 0.15, 6) AS omega, round(greatest(0.001, 1 - least(d / 0.30, 1.0)), 6) AS p FROM m
""")
def divergence_proxy(spark, sf_dir):
    """DS19: ratio and p value from mean divergence."""
    aligned = _aligned(spark, sf_dir)
    pairs = aligned.where("label <> 'human|x'").join(A.human_sequence(aligned), "og").select("og", F.col("seq").alias("a"), F.col("human").alias("b"))
    return E.divergence_proxy(pairs).select("og", F.round("omega", 6).alias("omega"), F.round("p", 6).alias("p"))


# --- motifs ------------------------------------------------------------------------------------

_CHANGES = """
m AS (SELECT p_partkey AS motif_id, p_partkey % 50 AS gene_id, upper(substr(p_name, 2, 6)) AS h, upper(substr(p_type, 2, 6)) AS a, upper(p_name) AS protein FROM part),
changes AS (SELECT motif_id, gene_id, i, (instr(protein, h) + i - 1)::INT AS position, substr(h, i::INT, 1) AS ref, substr(a, i::INT, 1) AS alt FROM m, unnest(generate_series(1, 6)) AS u(i) WHERE instr(protein, h) > 0 AND h <> ''
  AND i <= length(h) AND i <= length(a) AND substr(h, i::INT, 1) <> substr(a, i::INT, 1))
"""


def _changes(spark, sf_dir):
    k = F.col("p_partkey")
    motifs = table(spark, sf_dir, "part").select(k.alias("motif_id"), (k % 50).alias("gene_id"), F.upper(F.substring("p_name", 2, 6)).alias("human_seq"), F.upper(F.substring("p_type", 2, 6)).alias("animal_seq"), F.upper("p_name").alias("human_protein"))
    return A.substitutions(motifs)


@query(f"WITH {_CHANGES} SELECT motif_id, gene_id, position, ref, alt FROM changes")
def motif_substitutions(spark, sf_dir):
    """SQ16, JN15: substitutions of motifs by their place in the protein."""
    return _changes(spark, sf_dir)


@query(f"WITH {_CHANGES} SELECT motif_id, {rounded('avg(((position * 7) % 100)::DOUBLE) / 100', 4)} AS consequence_score FROM changes WHERE alt IN ('A', 'E', 'N', 'R', 'S', 'T') GROUP BY 1")
def motif_consequences(spark, sf_dir):
    """AN7, JN15: mean pathogenicity of a motif's substitutions."""
    changes = _changes(spark, sf_dir)
    accessions = spark.range(50).select(F.col("id").alias("gene_id"), F.concat(F.lit("P"), "id").alias("accession"))
    letters = F.explode(F.array(*[F.lit(x) for x in "AENRST"]))
    variants = accessions.select("accession", F.explode(F.sequence(F.lit(1), F.lit(80))).alias("position")).select("accession", "position", letters.alias("alt"), (((F.col("position") * 7) % 100) / 100).alias("score"))
    return A.motif_consequences(changes, accessions, variants)


@query(f"WITH {_CHANGES} SELECT motif_id, {rounded('avg((ascii(ref) - ascii(alt))::DOUBLE)', 4)} AS esm1v_score FROM changes WHERE ascii(ref) BETWEEN 65 AND 90 AND ascii(alt) BETWEEN 65 AND 90 GROUP BY 1")
def motif_likelihoods(spark, sf_dir):
    """AN8, DS29: mean log-likelihood ratio of a motif's substitutions."""
    letters = F.explode(F.transform(F.sequence(F.lit(65), F.lit(90)), lambda x: F.char(x)))
    log_probs = spark.range(50).select(F.col("id").alias("gene_id"), F.explode(F.sequence(F.lit(1), F.lit(80))).alias("position")).select("gene_id", "position", letters.alias("aa"))
    return A.motif_likelihoods(_changes(spark, sf_dir), log_probs.withColumn("log_p", -F.ascii("aa").cast("double")))


@query("SELECT l_orderkey * 10 + l_linenumber AS motif_id, CASE WHEN l_discount * 10 > 0.6 AND -l_tax * 60 < -2 THEN CASE WHEN p_size / 50.0 > 0.35 THEN 'loss_of_function' ELSE 'functional_shift' END WHEN l_discount * 10 > 0.6 THEN 'gain_of_function' ELSE 'neutral' END AS motif_direction FROM " + _UNIQUE + " LEFT JOIN part ON p_partkey = l_partkey AND p_size > 10")
def motif_directions(spark, sf_dir):
    """AN9, DS22: directions with each gene's constraint joined."""
    motifs = _unique(spark, sf_dir).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("motif_id"), F.col("l_partkey").alias("gene_id"), (F.col("l_discount") * 10).alias("consequence_score"), (-F.col("l_tax") * 60).alias("esm1v_score"))
    loeuf = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("gene_id"), (F.col("p_size") / 50).alias("loeuf"))
    return A.motif_directions(motifs, loeuf).select("motif_id", "motif_direction")


@query("""
WITH m AS (SELECT p_partkey AS motif_id, p_partkey // 3 AS gene_id, p_size % 6 AS n, (p_size % 20 + 1)::INT AS s FROM part WHERE p_size % 6 >= 3),
f AS (SELECT p_partkey // 3 AS gene_id, (p_size % 25 + 1)::INT AS position, CASE p_partkey % 4 WHEN 0 THEN 'active_site' WHEN 1 THEN 'binding_site' WHEN 2 THEN 'site' ELSE 'other' END AS feature, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 99 END AS pr FROM part),
hit AS (SELECT motif_id, feature, row_number() OVER (PARTITION BY motif_id ORDER BY pr, position, feature) AS r FROM m JOIN f ON f.gene_id = m.gene_id AND position BETWEEN s AND s + 4)
SELECT m.motif_id, feature, round(sqrt(3.0) * (s + 2 - 12 > 0)::INT * (s - 10) + sqrt(3.0) * (s - 10 <= 0)::INT * (10 - s), 2) AS pocket_distance, s + 2 < 7 AS is_disordered,
  CASE WHEN feature = 'active_site' THEN feature WHEN feature = 'binding_site' THEN feature WHEN s + 2 < 7 THEN 'disordered' WHEN round(sqrt(3.0) * abs(s - 10), 2) <= 8 THEN 'pocket_adjacent' WHEN round(sqrt(3.0) * abs(s - 10), 2) < 15 THEN 'surface_near_pocket' ELSE 'distal' END AS structural_context
FROM m LEFT JOIN hit ON hit.motif_id = m.motif_id AND r = 1
""")
def structural_annotations(spark, sf_dir):
    """AN10, JN14, SC10, DS23: features, distance to the pocket, disorder and context of convergent motifs."""
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    gene, start = F.floor(k / 3).alias("gene_id"), (F.col("p_size") % 20 + 1).cast("int")
    motifs = part.select(k.alias("motif_id"), gene, (F.col("p_size") % 6).alias("convergent_aa_count"), start.alias("start"), (start + 4).alias("end"))
    feature = F.when(k % 4 == 0, "active_site").when(k % 4 == 1, "binding_site").when(k % 4 == 2, "site").otherwise("other")
    features = part.select(gene, (F.col("p_size") % 25 + 1).cast("int").alias("position"), feature.alias("feature"), F.lit("d").alias("description"))
    genes = part.select(gene).distinct()
    r = F.col("residue").cast("double")
    residues = genes.select("gene_id", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("residue")).select("gene_id", "residue", r.alias("x"), r.alias("y"), r.alias("z"), (r * 10).alias("plddt"))
    centroids = genes.select("gene_id", *[F.lit(12.0).alias(c) for c in ("px", "py", "pz")])
    scores = part.select(k.alias("motif_id"), F.lit(0.5).alias("am_score"))
    return A.structural_annotations(motifs, features, residues, centroids, scores).select("motif_id", "feature", "pocket_distance", "is_disordered", "structural_context")


@query(f"SELECT l_partkey AS gene_id, {rounded('least(1, 0.40 * avg((l_linenumber <= 2 OR l_tax > 0.05)::INT) + 0.30 * coalesce(avg(l_quantity), 0) + 0.20 * avg((l_linenumber <= 3)::INT) + 0.10 * 0.5)', 4)} AS structural_score FROM (SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN l_quantity / 64 END AS l_quantity) FROM {_UNIQUE}) GROUP BY 1")
def structural_scores(spark, sf_dir):
    """DS23: a gene's structural score from its annotated motifs."""
    n = F.col("l_linenumber")
    rows = _unique(spark, sf_dir).select(F.col("l_partkey").alias("gene_id"), F.when(n <= 2, "active_site").when(n == 3, "site").alias("feature"), (F.col("l_tax") > 0.05).alias("is_pocket_adjacent"), F.when(n == 1, F.col("l_quantity") / 64).alias("am_score"), F.lit(None).cast("double").alias("plddt_mean"))
    return A.structural_scores(rows)


# --- genes -------------------------------------------------------------------------------------


@query(f"SELECT o_custkey AS gene_id, max({rounded('o_totalprice / 1000', 4)}) AS score FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') GROUP BY 1")
def association_scores(spark, sf_dir):
    """AN11: the best association over configured diseases."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gene_id"), F.col("o_orderpriority").alias("disease_id"), F.round(F.col("o_totalprice") / 1000, 4).alias("score"))
    return A.association_scores(rows, ["1-URGENT", "3-MEDIUM"])


@query("SELECT user_id AS gene_id, round(least(log2(1 + avg(value)) / 10, 1), 6) AS score FROM events WHERE event_type IN ('click', 'view') GROUP BY 1")
def tissue_scores(spark, sf_dir):
    """AN12, SC8: mean expression over configured tissues."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("gene_id"), F.col("event_type").alias("tissue"), F.col("value").alias("tpm"))
    return A.tissue_scores(rows, ["click", "view"]).select("gene_id", F.round("score", 6).alias("score"))


@query("""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey % 5 ORDER BY l_orderkey * 10 + l_linenumber) AS r FROM (SELECT * FROM """ + _UNIQUE + """ WHERE l_returnflag IN ('R', 'A'))),
g AS (SELECT l_partkey AS gene_id, l_suppkey % 5 AS species_id, l_orderkey * 10 + l_linenumber AS ordinal, count(*) OVER (PARTITION BY l_partkey) AS n FROM f WHERE r = 1) SELECT gene_id, species_id, ordinal FROM g WHERE n >= 2
""")
def conserved_expression(spark, sf_dir):
    """AN14, AN12, SQ26: the first relevant call of a species, where two have one."""
    flag = F.col("l_returnflag")
    calls = _unique(spark, sf_dir).select(F.col("l_partkey").alias("gene_id"), (F.col("l_suppkey") % 5).alias("species_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), F.when(flag == "R", "Liver tissue").when(flag == "A", "the HEART").otherwise("skin").alias("tissue"), F.lit(1.0).alias("score"))
    return A.conserved_expression(calls, ["liver", "heart"]).select("gene_id", "species_id", "ordinal")


@query("SELECT p_partkey AS id, CASE WHEN contains(lower(p_type), 'steel') THEN 'control' ELSE 'treatment' END AS condition FROM part WHERE contains(lower(p_type), 'steel') OR contains(lower(p_type), 'small')")
def sample_conditions(spark, sf_dir):
    """AN15: samples told apart by words in their titles."""
    samples = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("title"))
    return A.sample_conditions(samples, ["small"], ["steel"]).select("id", "condition")


@query("SELECT s_suppkey AS id, CASE s_suppkey % 6 WHEN 0 THEN 'reference' WHEN 1 THEN 'test' WHEN 2 THEN 'outgroup' WHEN 3 THEN 'reference' WHEN 4 THEN 'none' ELSE 'none' END AS branch FROM supplier")
def branch_sets(spark, sf_dir):
    """AN16, FLT5, FLT6: test, outgroup and reference species."""
    k = F.col("s_suppkey") % 6
    words = F.when(k == 0, F.array(F.lit("baseline"))).when(k == 1, F.array(F.lit("longevity"))).when(k == 2, F.array(F.lit("outgroup"), F.lit("x"))).when(k == 3, F.array(F.lit("longevity"))).when(k == 4, F.array().cast("array<string>"))
    return A.branch_sets(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), words.alias("phenotypes"), (k == 3).alias("is_control")))


@query("""
WITH r AS (SELECT p_partkey AS og, CASE WHEN p_size > 5 THEN p_size / 10.0::DOUBLE END AS omega, CASE WHEN p_size > 20 THEN p_size / 100.0::DOUBLE END AS p FROM part),
c AS (SELECT og, coalesce(omega, 1.0) AS w, p, CASE WHEN p IS NULL THEN 'meme_no_signal' ELSE 'meme_episodic' END AS model FROM r),
b AS (SELECT og // 2 AS gene_id, min(w) AS w, min(p) AS p, min(model) AS model FROM c GROUP BY 1), o AS (SELECT c_custkey AS gene_id, 0.5::DOUBLE AS w, 1.0::DOUBLE AS p, 'old' AS model FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(o.gene_id, b.gene_id) AS gene_id, coalesce(b.w, o.w) AS dnds_ratio, coalesce(b.p, o.p) AS dnds_pvalue, coalesce(b.model, o.model) AS selection_model FROM o FULL JOIN b ON b.gene_id = o.gene_id
""")
def selection_load(spark, sf_dir):
    """AN17, DS21, SNK4: results with their null record, put into the table of genes."""
    part, customer = tables(spark, sf_dir, "part", "customer")
    results = part.select(F.col("p_partkey").alias("og"), F.when(F.col("p_size") > 5, F.col("p_size") / 10).alias("omega"), F.when(F.col("p_size") > 20, F.col("p_size") / 100).alias("p"))
    evolution = customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("gene_id"), F.lit(0.5).alias("dnds_ratio"), F.lit(1.0).alias("dnds_pvalue"), F.lit("old").alias("selection_model"))
    gene_of = part.select(F.col("p_partkey").alias("og"), F.floor(F.col("p_partkey") / 2).alias("gene_id"))
    return A.load_selection(evolution, A.selection_columns(results, "meme_episodic"), gene_of, ["dnds_ratio", "dnds_pvalue", "selection_model"])


@query("SELECT DISTINCT l_orderkey AS og FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)")
def still_to_score(spark, sf_dir):
    """AN18, FLT8: groups with a gene that lacks a result."""
    line, part = tables(spark, sf_dir, "lineitem", "part")
    gene_of = line.select(F.col("l_orderkey").alias("og"), F.col("l_partkey").alias("gene_id")).distinct()
    evolution = part.select(F.col("p_partkey").alias("gene_id"), F.when(F.col("p_size") > 2, 1.0).alias("fel_sites"))
    return A.still_to_score(gene_of.select("og").distinct(), evolution, gene_of, ["fel_sites"])


@query(f"""
SELECT p_partkey AS gene_id, d.n AS network_degree, coalesce(d.n > 50, false) AS hub_risk, coalesce(CASE WHEN p_size > 10 THEN p_size / 50.0::DOUBLE END >= 0.9, false) AS is_essential,
  {rounded("1 / (1 + exp(10 * (p_size / 50.0::DOUBLE - 1 + 0.5)))", 4)} AS depmap_score, CASE WHEN p_partkey % 2 = 0 THEN (p_size >= 20)::INT + (p_size >= 2)::INT END AS gtex_tissue_count, CASE WHEN p_partkey % 2 = 0 THEN p_size / 2.0::DOUBLE END AS gtex_max_tpm
FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) * 2 AS n FROM lineitem GROUP BY 1) d ON d.l_partkey = p_partkey
""")
def safety_flags(spark, sf_dir):
    """AN22, SC7, SC9: hubs, essential genes, dependency and breadth of expression."""
    part, line = tables(spark, sf_dir, "part", "lineitem")
    genes, size = part.select(F.col("p_partkey").alias("gene_id")), F.col("p_size")
    degrees = line.groupBy(F.col("l_partkey").alias("gene_id")).agg((F.countDistinct("l_suppkey") * 2).alias("degree"))
    constraint = part.where("p_size > 10").select(F.col("p_partkey").alias("gene_id"), (size / 50).alias("pli"))
    depmap = part.select(F.col("p_partkey").alias("gene_id"), (size / 50 - 1).alias("chronos"))
    tissues = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("gene_id"), F.create_map(F.lit("a"), size / 20, F.lit("b"), size / 2).alias("tpm"))
    return A.safety_flags(genes, degrees, constraint, depmap, tissues)


@query(f"""
WITH rows AS (SELECT DISTINCT l_partkey AS gene_id, l_suppkey AS species_id, CASE WHEN l_suppkey % 4 = 0 THEN 'Primates' ELSE (l_suppkey % 4)::VARCHAR END AS lineage, (l_suppkey % 9)::DOUBLE / 10 AS d FROM lineitem),
s AS (SELECT gene_id, count(DISTINCT CASE WHEN lineage <> 'Primates' THEN lineage END) AS n, max(d) AS top FROM rows WHERE d > 0 GROUP BY 1)
SELECT gene_id, species_id, d AS promoter_divergence, coalesce(n, 0) AS lineage_count, coalesce({rounded("least(top + 0.1 * n, 1)", 4)}, 0.0) AS regulatory_score FROM rows LEFT JOIN s USING (gene_id)
""")
def promoter_divergence(spark, sf_dir):
    """AN25, DS28, DS6: promoter scores of species with their gene's lineage count and score."""
    line, supplier, part = tables(spark, sf_dir, "lineitem", "supplier", "part")
    k = F.col("l_suppkey")
    pairs = line.select(F.col("l_partkey").alias("gene_id"), k.alias("species_id"), ((k % 9).cast("double") / 10).alias("promoter_divergence")).distinct()
    s = F.col("s_suppkey")
    species = supplier.select(s.alias("species_id"), F.when(s % 4 == 0, "Primates").otherwise((s % 4).cast("string")).alias("lineage"))
    return A.promoter_divergence(part.select(F.col("p_partkey").alias("gene_id")), species, pairs)


@query(f"""
SELECT l_partkey AS gene_id, {rounded("least(coalesce(max(l_discount * 5) + 0.05 * max(l_linenumber), 0), 1)", 4)} AS regulatory,
  {rounded("least(1, 0.40 * (1 - least(1, max(l_tax) * 10)) + 0.30 * least(count(*) / 10.0, 1) + CASE WHEN min(l_discount) - 0.03 < 0 THEN 0.20 * least(-(min(l_discount) - 0.03) / 3, 1) ELSE 0 END::DOUBLE + 0.10 * least(max(l_linenumber) / 5.0, 1))", 4)} AS nucleotide FROM lineitem GROUP BY 1
""")
def regulatory_scores(spark, sf_dir):
    """DS6, DS7."""
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("gene_id")).agg(F.max(F.col("l_discount") * 5).alias("top"), F.max("l_linenumber").alias("n"), (F.max("l_tax") * 10).alias("c"), F.count("*").alias("d"), (F.min("l_discount") - 0.03).alias("phylo"))
    return g.select("gene_id", S.regulatory(F.col("top"), F.col("n")).alias("regulatory"), S.nucleotide_divergence(F.col("c"), F.col("d"), F.col("n"), F.col("phylo")).alias("nucleotide"))


@query(f"SELECT doc_id % 20 AS gene_id, {rounded('avg((contains(lower(text), chr(97 + (doc_id % 20)::INT)) AND (contains(lower(text), chr(108) || chr(105) || chr(99)) OR contains(lower(text), chr(116) || chr(111) || chr(107)) OR contains(lower(text), protective) OR contains(lower(text), resistance) OR contains(lower(text), resilience) OR contains(lower(text), adaptation) OR contains(lower(text), e) OR contains(lower(text), s)))::INT)', 4)} AS lit_score FROM documents, (SELECT 'protective' AS protective, 'resistance' AS resistance, 'resilience' AS resilience, 'adaptation' AS adaptation, 'evolutionary conservation' AS e, 'positive selection' AS s) GROUP BY 1")
def literature_scores(spark, sf_dir):
    """DS27: share of texts that name the gene and a term."""
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") % 20).alias("gene_id"), F.char(97 + F.col("doc_id") % 20).alias("symbol"), "text")
    return A.literature_scores(docs, ["lic", "tok"])


@query("SELECT s_suppkey AS gene_id, coalesce(list_sum(list_transform(m, lambda x: x.n)), 0)::BIGINT AS listed, m[1].start_pos AS first_start FROM supplier LEFT JOIN (SELECT l_suppkey, list(struct_pack(start_pos := l_linenumber, n := 1) ORDER BY r) AS m FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_discount DESC, l_orderkey * 10 + l_linenumber) AS r FROM " + _UNIQUE + ") WHERE r <= 5 GROUP BY 1) ON l_suppkey = s_suppkey")
def gene_contexts(spark, sf_dir):
    """AN26: genes with their first five motifs."""
    line = _unique(spark, sf_dir)
    motifs = line.select(F.col("l_suppkey").alias("gene_id"), F.col("l_discount").alias("divergence_score"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("start_pos"))
    found = A.gene_context(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("gene_id")), motifs)
    return found.select("gene_id", F.coalesce(F.size("motifs"), F.lit(0)).cast("long").alias("listed"), (F.get("motifs", 0)["start_pos"] % 10).cast("int").alias("first_start"))


@query(f"WITH refs AS (SELECT list(s_suppkey) AS r FROM supplier WHERE s_suppkey <= 8), s AS (SELECT p_partkey AS id, list_transform(r, lambda x: CASE WHEN p_partkey | x = 0 THEN 0.0 ELSE bit_count(p_partkey & x) / bit_count(p_partkey | x)::DOUBLE END) AS s FROM part, refs) SELECT id, round(1 - coalesce(round(list_max(s), 4), 0), 4) AS selectivity_score, len(list_filter(s, lambda x: x > 0.4))::INT AS n_offtarget_similar FROM s")
def selectivity(spark, sf_dir):
    """AN24, SQ28, JN16: similarity of compounds to a small panel."""
    part, supplier = tables(spark, sf_dir, "part", "supplier")
    return A.selectivity(part.select(F.col("p_partkey").alias("id"), F.array("p_partkey").alias("fingerprint")), supplier.where("s_suppkey <= 8").select(F.array("s_suppkey").alias("fingerprint")))


@query(f"SELECT p_partkey AS id, {rounded('p_size / 12.0::DOUBLE', 4)} AS tox21_score, {rounded('least((p_partkey % 6) * 0.25::DOUBLE, 1)', 4)} AS herg_risk FROM part")
def alert_scores(spark, sf_dir):
    """AN24: scores from counts of alerts."""
    part = table(spark, sf_dir, "part")
    return A.alert_scores(part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("tox21_hits"), (F.col("p_partkey") % 6).alias("herg_hits")), 12)


@query("SELECT p_brand AS gene_id, p_partkey AS id FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY -5.0 * CASE WHEN p_size % 7 = 0 THEN 0.5 ELSE p_size % 7 / 8.0::DOUBLE END, p_partkey) AS r FROM part) WHERE r <= 10")
def screened_compounds(spark, sf_dir):
    """TK7, SQ29: each gene's ten best compounds."""
    compounds = table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene_id"), F.col("p_partkey").alias("id"), F.lit("x").alias("smiles"), (F.col("p_size") % 7 / 8.0).alias("pocket_score"))
    return A.screened(compounds).select("gene_id", "id")


@query("SELECT p_partkey AS gene_id, (p_size * 30 * 3 + 300)::INT AS gene_size_bp, p_size * 30 * 3 + 300 <= 4700 AS aav_compatible, CASE p_partkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'B' END AS tier FROM part")
def delivery_tiers(spark, sf_dir):
    """DS33, DS34, SC6: sizes for delivery and tractability tiers."""
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey") % 5
    item = lambda label, modality: F.struct(F.lit(label).alias("label"), F.lit(modality).alias("modality"), F.lit(True).alias("value"))
    items = F.when(k == 0, F.array(item("Literature", "SM"), item("Advanced Clinical", "SM"))).when(k == 1, F.array(item("Phase 1 Clinical", "SM"))).when(k == 2, F.array(item("High-Quality Pocket", "SM"), item("Clinical Precedence", "AB"))).when(k == 3, F.array(item("Clinical Precedence", "AB"))).otherwise(F.array(item("Approved Drug", "AB")))
    sizes = A.aav_table(part.select(F.col("p_partkey").alias("gene_id"), (F.col("p_size") * 30).alias("length")))
    return sizes.join(part.select(F.col("p_partkey").alias("gene_id"), A.tractability_tier(items).alias("tier")), "gene_id")


@query(f"""
WITH u AS (SELECT l_partkey AS gene_id, l_returnflag AS region_type, l_quantity * 2 AS pid, (l_linenumber * 100)::INT AS len, (l_suppkey % 500 + 1)::INT AS n, l_tax AS gap FROM {_UNIQUE} WHERE l_suppkey % 10 <> 0)
SELECT gene_id, region_type, {rounded("avg(least(1.0, pid / 100.0 * len / n))", 4)} AS conservation_score, floor(avg(len))::INT AS alignment_length, CASE WHEN region_type = 'promoter' THEN 1 ELSE 0 END::BIGINT AS counts FROM u GROUP BY 1, 2
""")
def region_scores(spark, sf_dir):
    """AN4, SQ13: means of regions over species that aren't controls."""
    line, supplier, part = _unique(spark, sf_dir), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    species = supplier.select(F.col("s_suppkey").alias("species_id"), (F.col("s_suppkey") % 10 == 0).alias("is_control"))
    alignments = line.select(F.col("l_partkey").alias("gene_id"), F.col("l_returnflag").alias("region_type"), F.col("l_suppkey").alias("species_id"), (F.col("l_quantity") * 2).alias("percent_identity"), (F.col("l_linenumber") * 100).alias("alignment_length"), (F.col("l_suppkey") % 500 + 1).alias("region_length"), F.col("l_tax").alias("gap_fraction"))
    divergence = part.select(F.col("p_partkey").alias("gene_id"), F.lit("promoter").alias("region_type"), F.lit(1).cast("long").alias("divergent"), F.lit(1).cast("long").alias("convergent"))
    return A.region_scores(alignments, divergence, species).select("gene_id", "region_type", "conservation_score", "alignment_length", F.col("regulatory_divergence_count").alias("counts"))


@query("SELECT c_custkey AS gene_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey::DOUBLE END) AS phylop_score FROM customer")
def seed_conservation(spark, sf_dir):
    """AN5: a missing score from the coding one."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    evolution = c.select(k.alias("gene_id"), F.when(k % 2 == 0, F.col("c_acctbal")).alias("phylop_score"))
    return A.seed_conservation(evolution, c.where(k % 3 == 0).select(k.alias("gene_id"), F.col("c_nationkey").cast("double").alias("cds_phylo_score")))


@query("""
WITH l AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem), c AS (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)
SELECT l_partkey AS gene_id, round(count(s_suppkey) / (SELECT count(*) FROM c)::DOUBLE, 4) AS control_divergence_fraction FROM l LEFT JOIN c ON s_suppkey = l_suppkey GROUP BY 1
""")
def control_fractions(spark, sf_dir):
    """AG18: share of control species with a motif."""
    line, supplier = tables(spark, sf_dir, "lineitem", "supplier")
    orthologs = line.select(F.concat_ws("_", "l_partkey", "l_suppkey").alias("id"), F.col("l_partkey").alias("gene_id"), F.col("l_suppkey").alias("species_id")).distinct()
    return scoring.control_fractions(orthologs.select(F.col("id").alias("ortholog_id")), orthologs, supplier.where("s_nationkey < 5").select(F.col("s_suppkey").alias("id")))


@query("""
WITH ps AS (SELECT p_partkey AS gene_id, CASE WHEN p_size > 3 THEN p_size / 60.0::DOUBLE END AS p FROM part),
raw AS (SELECT gene_id, p, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene_id) AS q, row_number() OVER (ORDER BY p, gene_id) AS r FROM ps WHERE p IS NOT NULL)
SELECT gene_id, round(least(1.0, min(q) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 6) AS meme_qvalue FROM raw UNION ALL SELECT gene_id, NULL FROM ps WHERE p IS NULL
""")
def evolution_q_values(spark, sf_dir):
    """WN6: q values of genes, to six places."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene_id"), F.when(F.col("p_size") > 3, F.col("p_size") / 60).alias("dnds_pvalue"))
    return scoring.evolution_q_values(rows).select("gene_id", "meme_qvalue")


@query("SELECT p_partkey AS og, list_sort(list_filter(['s1', 's2'], lambda s: CASE s WHEN 's1' THEN p_size / 20.0 ELSE p_size / 40.0 END > 1)) AS branches FROM part")
def resistant_branches(spark, sf_dir):
    """DS20: test species whose branch is under selection."""
    size = F.col("p_size")
    results = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("og"), F.create_map(F.lit("s1"), size / 20, F.lit("s2"), size / 40, F.lit("s3"), size * 1.0).alias("omegas"))
    return E.meme_branches(results, F.array(F.lit("s1"), F.lit("s2")))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'P' || lpad((p_partkey % 10000)::VARCHAR, 5, '0') WHEN p_partkey % 3 = 1 THEN 'Q' || lpad((p_partkey % 10000)::VARCHAR, 5, '0') END AS accession, p_brand || ' family' AS family,
  '((human,rat #1),bat #1);' AS tree, substr(sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || p_name::BLOB), 1, 8) AS id_head FROM part
""")
def identifiers(spark, sf_dir):
    """SQ18, SQ24, SQ25, SQ27: accessions, families, marked trees and name-based identifiers."""
    k = F.col("p_partkey")
    code = F.lpad((k % 10000).cast("string"), 5, "0")
    header = F.when(k % 3 == 0, F.concat(F.lit("sp|P"), code, F.lit("|X_HUMAN"))).when(k % 3 == 1, F.concat(F.lit("Q"), code, F.lit(" some text"))).otherwise("no accession")
    tree = Q.mark_foreground(F.lit("((human:0.1,rat)n1:0.2,bat);"), ["rat", "bat"])
    return table(spark, sf_dir, "part").select(
        "p_partkey", Q.accession(header).alias("accession"), Q.family_name(F.concat(F.lit("Belongs to the "), "p_brand", F.lit(" family. More."))).alias("family"), F.regexp_replace(tree, ":[0-9.]+", "").alias("tree"),
        F.substring(Q.uuid5(F.col("p_name"), "6ba7b810-9dad-11d1-80b4-00c04fd430c8"), 1, 8).alias("id_head"),
    )


@query("SELECT p_partkey AS gene_id, CASE WHEN p_size > 25 THEN 'screen' WHEN p_partkey % 2 = 0 THEN 'test ' || p_brand ELSE 'assay' END AS second, CASE WHEN p_size > 10 THEN 'in vivo' ELSE 'organoid' END AS third FROM part")
def experiments(spark, sf_dir):
    """DS37: recommended experiments."""
    context = {"knockdown": "knockdown", "repurposing": "test {drug}", "in_vivo": "in vivo", "organoid": "organoid", "screening": "screen", "assay": "assay"}
    drugs = F.when(F.col("p_partkey") % 2 == 0, F.array("p_brand")).otherwise(F.array().cast("array<string>"))
    found = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene_id"), S.experiment_recommendations(context, F.col("p_size") / 50, drugs, F.col("p_size") > 10).alias("e"))
    return found.select("gene_id", F.get("e", 1).alias("second"), F.get("e", 2).alias("third"))


@query("SELECT o_custkey AS gene_id, strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS updated_at FROM orders GROUP BY 1")
def time_stamps(spark, sf_dir):
    """SC12: the last change of each key as ISO text."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("gene_id")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"))
