"""Queries over what external tools deliver, names and places, user functions, and the rules across tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.plans import annotate as A
from helixframe.plans import checks, scoring
from helixframe.plans import evolution as E
from helixframe.plans.biology import rounded
from helixframe.plans.landing import folder
from helixframe.plans.relational import table
from helixframe.sources import readers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


# --- codons ------------------------------------------------------------------------------------

_PROTEINS = """
proteins AS (SELECT p_partkey // 4 AS og, (p_partkey % 4)::VARCHAR AS label, translate(upper(p_name), ' O', '-A') AS seq, p_partkey AS k FROM part),
genes AS (SELECT og, label, seq, k, string_split(replace(seq, '-', ''), '') AS ls FROM proteins),
cds AS (SELECT og, label, seq, CASE WHEN k % 13 <> 0 THEN
    CASE WHEN k % 17 = 0 THEN 'AC' ELSE array_to_string(list_transform(ls, lambda c: substr('ACGT', ascii(c) % 4 + 1, 1) || substr('TGCA', ascii(c) // 4 % 4 + 1, 1) || substr('GATC', (ascii(c) + k) % 3 + 1, 1)), '') || CASE WHEN k % 5 = 0 THEN 'TAA' ELSE '' END END END AS cds FROM genes)
"""
_CODONS = f"""
{_PROTEINS}, back AS (
  SELECT og, label, list_transform(generate_series(1, length(seq)), lambda i: CASE WHEN seq[i] = '-' THEN '---' ELSE substr(cds, 3 * length(replace(seq[1:i], '-', '')) - 2, 3) END) AS codons
  FROM cds WHERE length(cds) >= 3 * length(replace(seq, '-', ''))
), clean AS (SELECT * FROM back WHERE len(list_filter(codons[1:len(codons) - 1], lambda c: upper(replace(c, '-', '')) IN ('TAA', 'TAG', 'TGA'))) = 0),
enough AS (SELECT c.*, count(*) OVER w AS n, min(len(codons)) OVER w AS width, g.every FROM clean c JOIN (SELECT og, count(*) AS every FROM proteins GROUP BY 1) g USING (og) WINDOW w AS (PARTITION BY og)),
texts AS (SELECT og, label, array_to_string(codons[1:width], '') AS codons FROM enough WHERE n >= 3 AND n / every >= 0.6),
good AS (SELECT * FROM texts WHERE length(codons) - length(replace(codons, '-', '')) <= 0.5 * length(codons) AND length(regexp_replace(codons, '[ATGCatgc-]', '', 'g')) <= 0.05 * length(codons)),
distinct_ AS (SELECT og, label, codons FROM (SELECT *, row_number() OVER (PARTITION BY og, upper(codons) ORDER BY label) AS r FROM good) WHERE r = 1),
alignments AS (SELECT og, label, codons FROM (SELECT *, count(*) OVER (PARTITION BY og) AS n FROM distinct_) WHERE n >= 3)
"""


def _codons(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    seq = F.translate(F.upper("p_name"), " O", "-A")
    rows = part.select(F.floor(k / 4).alias("og"), (k % 4).cast("string").alias("label"), seq.alias("seq"), k.alias("k"))
    pick = lambda letters, n: F.substring(F.lit(letters), (n + 1).cast("int"), F.lit(1))
    codon = lambda c: F.concat(pick("ACGT", F.ascii(c) % 4), pick("TGCA", F.floor(F.ascii(c) / 4) % 4), pick("GATC", (F.ascii(c) + F.col("k")) % 3))
    text = F.array_join(F.transform(F.split(F.translate("seq", "-", ""), ""), lambda c: F.when(c == "", "").otherwise(codon(c))), "")
    cds = F.when(k % 17 == 0, "AC").otherwise(F.concat(text, F.when(k % 5 == 0, "TAA").otherwise("")))
    named = rows.withColumn("p_partkey", F.col("k")).where(k % 13 != 0).select("og", "label", cds.alias("cds"))
    return A.codon_alignments(rows.select("og", "label", "seq"), named)


@query(f"WITH {_CODONS} SELECT og, label, codons FROM alignments")
def codon_alignments(spark, sf_dir):
    """SQ14, ST5: proteins turned back into codons, without stops, gaps, ambiguity and repeats."""
    return _codons(spark, sf_dir)


@query(f"WITH {_CODONS} SELECT og FROM alignments GROUP BY og HAVING count(*) >= 3 AND 12 * min(length(codons)) >= 300 AND sum(length(codons) - length(replace(codons, '-', ''))) <= 0.40 * sum(length(codons))")
def codon_groups(spark, sf_dir):
    """FLT10: groups that a test of selection can take; each alignment twelve times over, as names are short."""
    return A.codon_alignments_pass(_codons(spark, sf_dir).withColumn("codons", F.repeat("codons", 12)))


# --- files of tools ----------------------------------------------------------------------------


def _files(spark: SparkSession, sf_dir: str, body: Column) -> str:
    """A text file for each nation, in a folder of its key."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", body.alias("value"))
    path = folder(rows)
    rows.write.partitionBy("n_nationkey").text(path)
    return path


@query("""
SELECT 'wig' AS kind, round((n_nationkey / 4.0 + n_nationkey / 8.0) / 2, 4)::DOUBLE AS mean FROM nation
UNION ALL SELECT 'posterior', round((n_nationkey / 32.0 + 0.25 + 1) / 3, 4)::DOUBLE FROM nation
""")
def conservation_tracks(spark, sf_dir):
    """SRC21: means of tracks: the last token of a line, or every token, within bounds."""
    n = F.col("n_nationkey")
    wig = _files(spark, sf_dir, F.concat(F.lit("track type=wiggle_0\nfixedStep chrom=c start=1\n# x\n1 2 "), n / 4.0, F.lit("\n\n"), n / 8.0, F.lit("\n31.5\nnot a number\n")))
    posterior = _files(spark, sf_dir, F.concat(F.lit("# p\n"), n / 32.0, F.lit(" 0.25 1.0 1.5 x\n")))
    named = lambda kind, df: df.select(F.lit(kind).alias("kind"), "mean")
    return named("wig", readers.read_wig_means(spark, wig)).unionByName(named("posterior", readers.read_wig_means(spark, posterior, 0.0, 1.0, every_token=True)))


@query(f"""
SELECT 'meme' AS kind, {rounded("0.5 * least((n_nationkey + 5) / 2.0 / 5.0, 2.0)", 6)} AS a, {rounded("sqrt(0.01 * 0.04)", 6)} AS b FROM nation
UNION ALL SELECT 'fel', 1 + (n_nationkey % 2), NULL FROM nation
""")
def selection_sites(spark, sf_dir):
    """SRC22: sites of episodic and of pervasive selection."""
    n = F.col("n_nationkey")
    meme = readers.read_meme(spark, _files(spark, sf_dir, F.concat(F.lit('{"MLE": {"content": {"0": [[1, 0, 0, 5.0, 0, 0.01], [1, 0, 0, 1.0, 0, 0.5], [1, 0, 0, '), n.cast("double"), F.lit(", 0, 0.04], [1, 0, 0, 0, 0, null]]}}}"))))
    rows = F.concat(F.lit("[[1, 2, 0, 0, 0.01], [2, 1, 0, 0, 0.01], [1, "), n % 2 + 1, F.lit(", 0, 0, 0.04]]"))
    fel = readers.read_fel(spark, _files(spark, sf_dir, F.concat(F.lit('{"MLE": {"headers": [["alpha", "x"], ["beta", "x"], ["LRT", "x"], ["LRT", "x"], ["p-value", "x"]], "content": {"0": '), rows, F.lit("}}}"))))
    return meme.select(F.lit("meme").alias("kind"), F.round("omega", 6).alias("a"), F.round("p", 6).alias("b")).unionByName(fel.select(F.lit("fel").alias("kind"), F.col("fel_sites").cast("double").alias("a"), F.lit(None).cast("double").alias("b")))


@query("""
WITH r AS (SELECT 'OG' || o_custkey AS og, CASE o_orderkey % 4 WHEN 0 THEN 'paml_branch_site' WHEN 1 THEN 'proxy' WHEN 2 THEN 'paml_no_signal' ELSE 'other' END AS model, (o_orderkey % 64) / 64.0 AS p FROM orders WHERE o_orderstatus <> 'P'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY og ORDER BY CASE model WHEN 'paml_branch_site' THEN 3 WHEN 'paml_no_signal' THEN 1 ELSE 0 END DESC, model, p) AS r FROM r)
SELECT og, model AS selection_model, 2.0::DOUBLE AS dnds_ratio, p::DOUBLE AS dnds_pvalue FROM ranked WHERE r = 1
""")
def selection_results(spark, sf_dir):
    """AN28: results that batches wrote, each orthogroup's best; skipped ones are left out."""
    k = F.col("o_orderkey")
    model = F.when(k % 4 == 0, "paml_branch_site").when(k % 4 == 1, "proxy").when(k % 4 == 2, "paml_no_signal").otherwise("other")
    status = F.when(F.col("o_orderstatus") == "P", "skipped").when(F.col("o_orderstatus") == "F", "ok")
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("OG"), "o_custkey").alias("og"), status.alias("status"), model.alias("selection_model"), F.lit(2.0).alias("dnds_ratio"), (k % 64 / 64.0).alias("dnds_pvalue"))
    path = folder(orders)
    E.write_selection(orders, path, 8)
    return E.read_selection(spark, path)


# --- names, traits, places ---------------------------------------------------------------------


@query(f"""
WITH g AS (SELECT s_suppkey AS gene_id, s_acctbal > 0 AS known, s_nationkey / 32.0 AS association, 'EFO_' || s_nationkey AS drug FROM supplier),
t AS (SELECT list('EFO:' || n_nationkey) AS ids FROM nation WHERE n_regionkey = 1)
SELECT gene_id, {rounded("0.30 * association + CASE WHEN list_contains(ids, replace(drug, '_', ':')) THEN 0.20 ELSE 0.08 END", 4)} AS score FROM g, t
""")
def phenotype_drug_credit(spark, sf_dir):
    """SC4, DS13, DS3: a known drug counts in full where its indication is one of the trait's diseases, whatever way ids are written."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    traits = n.groupBy(F.concat(F.lit("trait"), "n_regionkey").alias("trait_id")).agg(F.collect_list(F.concat(F.lit("efo_"), "n_nationkey")).alias("disease_ids"))
    genes = s.select(F.col("s_suppkey").alias("gene_id"), (F.col("s_nationkey") / 32.0).alias("association"), F.array(F.concat(F.lit("EFO:"), "s_nationkey")).alias("drug_ids"))
    none = F.lit(None).cast("double")
    joined = genes.crossJoin(F.broadcast(scoring.trait_disease_ids(traits, "trait1")))
    score = S.disease(F.lit(True), F.col("association"), none, none, none, F.lit(4), F.col("drug_ids"), F.col("phenotype_ids"), F.lit(0), none)
    return joined.select("gene_id", score.alias("score"))


@query("SELECT c_custkey AS gene_id, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0.0 END AS expression_score FROM customer WHERE c_mktsegment = 'BUILDING'")
def expression_readback(spark, sf_dir):
    """DS10: stored expression scores of a trait."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gene_id"), F.col("c_mktsegment").alias("trait_id"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("expression_score"))
    return scoring.expression_scores(rows, "BUILDING")


@query("""
SELECT DISTINCT p_brand AS pathway_id, CASE WHEN length(p_brand) % 2 = 0 THEN p_brand ELSE 'name of ' || p_brand END AS pathway_name,
  (CASE WHEN n % 3 = 0 THEN 50 ELSE n END)::INT AS gene_count FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
""")
def pathway_names(spark, sf_dir):
    """SC13: names and sizes of pathways, the id and 50 where they are unknown."""
    sizes = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("pathway_id")).agg(F.count("*").alias("n"))
    names = sizes.where(F.length("pathway_id") % 2 == 1).select("pathway_id", F.concat(F.lit("name of "), "pathway_id").alias("name"))
    return E.named_pathways(sizes.select("pathway_id"), names, sizes.select("pathway_id", F.when(F.col("n") % 6 == 0, 0).when(F.col("n") % 3 != 0, F.col("n")).alias("size")))


@query(f"""
WITH places AS (SELECT o_custkey AS gene_id, o_orderpriority AS chrom, (o_orderkey % 5000)::INT AS start FROM orders WHERE o_orderkey % 7 <> 0),
map AS (SELECT gene_id, chrom, start FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY chrom, start) AS r FROM places) WHERE r = 1),
track AS (SELECT DISTINCT o_orderpriority AS chrom, (o_orderkey % 9000)::INT AS pos, (o_orderkey % 32) / 4.0 AS value FROM orders)
SELECT gene_id, {rounded("avg(value)", 4)} AS phylop_score FROM map m JOIN track t ON t.chrom = m.chrom AND t.pos >= m.start AND t.pos < m.start + 100 GROUP BY gene_id
""")
def chromosome_places(spark, sf_dir):
    """AN19: genes on chromosomes, and the conservation of the first hundred bases."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    places = orders.select(F.concat(F.lit("sym"), "o_custkey").alias("symbol"), F.when(k % 7 != 0, F.col("o_orderpriority")).alias("chrom"), (k % 5000).alias("start"))
    genes = orders.select(F.col("o_custkey").alias("gene_id"), F.concat(F.lit("SYM"), "o_custkey", F.lit("_HUMAN")).alias("gene_symbol")).distinct()
    track = orders.select(F.col("o_orderpriority").alias("chrom"), (k % 9000).cast("int").alias("pos"), (k % 32 / 4.0).alias("value")).distinct()
    return A.conservation_near_start(A.chromosome_map(genes, places), track)


@query("""
WITH per AS (SELECT l_partkey AS og, l_suppkey AS label, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT og, sum(n)::BIGINT AS motifs, quantile_cont(n, 0.5) AS median, min(n) AS least, max(n) AS most FROM per GROUP BY og
""")
def motif_counts(spark, sf_dir):
    """AN2: the summary of a motif scan: motifs of each orthogroup, and of its sequences."""
    return A.motif_summary(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("og"), F.col("l_suppkey").alias("label")))


# --- user functions ----------------------------------------------------------------------------

_LETTERS = "ACGTAGGCTAAGGTACCGGATCGATTGGCC"


def _made_up(ids: pa.Array) -> list[str | None]:
    """A provider: a sequence from the digits of a gene's id, none for every seventh."""
    return [None if int(i) % 7 == 0 else "".join(_LETTERS[(int(i) * 7 + j * j) % len(_LETTERS)] for j in range(60)) for i in ids.to_pylist()]


@query(f"""
WITH s AS (SELECT p_partkey AS k, string_agg(substr('{_LETTERS}', (p_partkey * 7 + j * j) % {len(_LETTERS)} + 1, 1), '' ORDER BY j) AS q FROM part, unnest(generate_series(0, 59)) AS u(j) WHERE p_partkey % 7 <> 0 GROUP BY 1),
sites AS (SELECT k, len(list_filter(generate_series(1, 39), lambda i: q[i + 20:i + 21] = 'GG')) AS n FROM s)
SELECT p_partkey::VARCHAR AS gene_id, n::INT AS crispr_sites, CASE WHEN n > 50 THEN 'high' WHEN n > 15 THEN 'medium' WHEN n IS NOT NULL THEN 'low' END AS offtarget_risk FROM part LEFT JOIN sites ON k = p_partkey
""")
def provided_guides(spark, sf_dir):
    """UDF2: guides in sequences that a user's function provides."""
    genes = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("gene_id"))
    return A.crispr_table(genes, _made_up).select("gene_id", "crispr_sites", "offtarget_risk")


@query(f"""
WITH a AS (SELECT p_partkey // 4 AS og, p_partkey % 4 AS k, translate(upper(p_name), ' ', '-') AS seq FROM part), h AS (SELECT og, seq AS human FROM a WHERE k = 0),
d AS (SELECT og, len(list_filter(generate_series(1, least(length(seq), length(human))), lambda i: seq[i] <> '-' AND human[i] <> '-')) AS n,
  len(list_filter(generate_series(1, least(length(seq), length(human))), lambda i: seq[i] <> '-' AND human[i] <> '-' AND seq[i] <> human[i])) AS m FROM a JOIN h USING (og) WHERE k <> 0),
means AS (SELECT og, avg(m / n) AS d FROM d WHERE n > 0 GROUP BY og), sizes AS (SELECT og, count(*) AS sequences FROM a GROUP BY og)
SELECT 'OG' || og AS og, sequences, {rounded("d / 0.15", 6)} AS omega, {rounded("greatest(0.001, 1 - least(d / 0.30, 1.0))", 6)} AS p FROM means JOIN sizes USING (og)
""")
def orthogroup_worker(spark, sf_dir):
    """UDF3: the worker of an orthogroup as a table function, called from SQL with a partition for each."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("OG"), F.floor(k / 4)).alias("og"), F.when(k % 4 == 0, "human|x").otherwise(F.concat(F.lit("s"), k % 4)).alias("label"), F.translate(F.upper("p_name"), " ", "-").alias("seq"))
    E.register_functions(spark)
    return spark.sql("SELECT og, sequences, round(omega, 6) AS omega, round(p, 6) AS p FROM orthogroup_proxy(TABLE({rows}))", rows=rows)


# --- rules -------------------------------------------------------------------------------------

_QUALITY = """
WITH gene AS (SELECT p_partkey AS id FROM part), species AS (SELECT s_suppkey AS id, s_suppkey % 5 = 0 AS is_control FROM supplier),
ortholog AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS gene_id, l_suppkey AS species_id, CASE WHEN l_orderkey % 30 <> 0 THEN l_quantity * 2 END AS identity FROM lineitem),
motif AS (SELECT l_orderkey * 10 + l_linenumber AS ortholog_id, l_discount AS divergence, CASE WHEN l_linenumber < 6 THEN l_tax * 10 END AS consequence, -l_quantity / 10 AS esm, CASE WHEN l_linestatus = 'F' THEN 'D' END AS domain,
  CASE l_returnflag WHEN 'A' THEN 'gain_of_function' WHEN 'R' THEN 'loss_of_function' ELSE CASE WHEN l_linenumber > 1 THEN 'neutral' END END AS direction, CASE WHEN l_linenumber > 4 THEN l_linenumber - 4 END AS convergent FROM lineitem),
evolution AS (SELECT p_partkey AS gene_id, p_size / 64.0 AS pval FROM part WHERE p_partkey % 10 <> 0),
candidate AS (SELECT p_partkey AS gene_id, CASE WHEN p_size < 6 THEN 'Tier1' WHEN p_size < 12 THEN 'Tier2' ELSE 'Tier3' END AS tier, CASE WHEN p_size % 4 = 0 THEN 0.0 ELSE p_size / 64.0 END AS conv, CASE WHEN p_size % 8 = 0 THEN 0.0 ELSE 0.5 END AS sel, p_size / 32.0 AS comp, CASE WHEN p_partkey % 3 = 0 THEN 0.0 ELSE 0.5 END AS expr FROM part),
expression AS (SELECT ps.l_partkey AS gene_id, ps.l_shipdate::DATE::VARCHAR AS comparison, CASE WHEN l_quantity > 45 THEN 0.0 ELSE l_quantity - 25 END AS log2fc FROM lineitem ps WHERE l_linenumber = 1),
region AS (SELECT p_partkey AS gene_id, CASE p_size % 3 WHEN 0 THEN 'cds' WHEN 1 THEN 'promoter' ELSE 'downstream' END AS kind, CASE WHEN p_size > 5 THEN p_name ELSE '' END AS sequence FROM part),
score AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'cds' ELSE 'promoter' END AS kind, p_size + 20.0 AS identity, p_size / 128.0 AS gaps FROM part),
phylo AS (SELECT CASE WHEN p_size % 5 <> 0 THEN p_size / 4.0 - 2 END AS cds FROM part),
owned AS (SELECT gene_id, convergent FROM motif JOIN ortholog ON ortholog_id = id),
crossed AS (SELECT coalesce(convergent, 0) > 2 AS high, avg(pval) AS p FROM owned JOIN evolution USING (gene_id) GROUP BY 1),
m AS (SELECT
  (SELECT count(*) FROM gene)::DOUBLE AS genes, (SELECT count(DISTINCT gene_id) FROM ortholog) AS covered,
  (SELECT quantile_cont(n, 0.5) FROM (SELECT count(DISTINCT species_id) AS n FROM ortholog WHERE species_id NOT IN (SELECT id FROM species WHERE is_control) GROUP BY gene_id)) AS species,
  (SELECT count(*) FROM ortholog)::DOUBLE AS orthologs, (SELECT count(*) FROM ortholog WHERE identity < 25) AS low, (SELECT count(*) FROM ortholog WHERE identity IS NULL) AS unknown,
  (SELECT count(DISTINCT gene_id) FROM region WHERE kind = 'cds' AND length(sequence) > 0) AS cds, (SELECT count(DISTINCT gene_id) FROM region WHERE kind = 'promoter' AND length(sequence) > 0) AS promoter, (SELECT count(DISTINCT gene_id) FROM region WHERE kind = 'downstream' AND length(sequence) > 0) AS downstream,
  (SELECT round(avg(identity), 1) FROM score WHERE kind = 'cds') AS cds_identity, (SELECT round(avg(gaps), 3) FROM score WHERE kind = 'cds') AS cds_gaps,
  (SELECT 100 * count(cds) / count(*) FROM phylo) AS phylo_share, (SELECT quantile_cont(cds, 0.5) FROM phylo) AS phylo_median, (SELECT count(*) FROM phylo WHERE cds > 10) AS phylo_high,
  (SELECT count(*) FROM motif)::DOUBLE AS motifs, (SELECT count(*) FROM gene WHERE id NOT IN (SELECT gene_id FROM owned)) AS without, (SELECT quantile_cont(divergence, 0.5) FROM motif) AS divergence, (SELECT count(*) FROM motif WHERE divergence = 0) AS zero,
  (SELECT count(consequence) FROM motif)::DOUBLE AS scored, (SELECT count(*) FROM motif WHERE consequence BETWEEN 0.4 AND 0.6) AS flat, (SELECT count(domain) FROM motif) AS domains, (SELECT count(direction) FROM motif)::DOUBLE AS classified,
  (SELECT count(*) FROM motif WHERE direction = 'neutral') AS neutral, (SELECT count(*) FROM motif WHERE direction = 'functional_shift') AS shift, (SELECT avg(consequence) FROM motif WHERE direction = 'gain_of_function') AS gain, (SELECT avg(esm) FROM motif WHERE direction = 'loss_of_function') AS loss,
  (SELECT count(*) FROM motif WHERE convergent > 0) AS convergent, (SELECT p FROM crossed WHERE high) AS p_high, (SELECT p FROM crossed WHERE NOT high) AS p_low,
  (SELECT count(DISTINCT gene_id) FROM expression) AS expressed, (SELECT count(DISTINCT gene_id) FROM candidate WHERE tier <> 'Tier3')::DOUBLE AS upper_, (SELECT 100 * count(*) FILTER (WHERE log2fc = 0) / count(*) FROM expression) AS unchanged, (SELECT count(DISTINCT comparison) FROM expression) AS conditions,
  (SELECT 100 * count(*) FILTER (WHERE expr = 0) / count(*) FROM candidate) AS silent, (SELECT count(*) FROM candidate WHERE gene_id NOT IN (SELECT gene_id FROM evolution)) AS orphans, (SELECT count(*) FROM candidate WHERE tier = 'Tier1' AND conv = 0 AND sel = 0) AS bare, (SELECT stddev(conv) FROM candidate) AS spread, (SELECT count(*) FROM candidate WHERE tier = 'Tier1' AND comp < 0.1) AS weak
), rules AS (SELECT unnest([
  {'step': 'step3b', 'name': 'gene coverage', 'v': round(100 * covered / genes, 1)::DOUBLE, 'good': round(100 * covered / genes, 1) >= 80, 'fair': false}, {'step': 'step3b', 'name': 'median species per gene', 'v': round(species, 1), 'good': round(species, 1) >= 4, 'fair': round(species, 1) >= 3},
  {'step': 'step3b', 'name': 'low identity', 'v': round(100 * low / orthologs, 1), 'good': round(100 * low / orthologs, 1) < 15, 'fair': false}, {'step': 'step3b', 'name': 'missing identity', 'v': round(100 * unknown / orthologs, 1), 'good': round(100 * unknown / orthologs, 1) < 5, 'fair': true},
  {'step': 'step3c', 'name': 'cds coverage', 'v': round(100 * cds / genes, 1), 'good': round(100 * cds / genes, 1) >= 70, 'fair': false}, {'step': 'step3c', 'name': 'promoter coverage', 'v': round(100 * promoter / genes, 1), 'good': round(100 * promoter / genes, 1) >= 50, 'fair': false}, {'step': 'step3c', 'name': 'downstream coverage', 'v': round(100 * downstream / genes, 1), 'good': round(100 * downstream / genes, 1) >= 50, 'fair': false},
  {'step': 'step3c', 'name': 'cds identity', 'v': cds_identity, 'good': cds_identity >= 40 AND cds_gaps < 0.3, 'fair': false}, {'step': 'step3d', 'name': 'cds conservation coverage', 'v': round(phylo_share, 1), 'good': round(phylo_share, 1) >= 60, 'fair': false}, {'step': 'step3d', 'name': 'cds conservation', 'v': round(phylo_median, 3), 'good': round(phylo_median, 3) > 0 AND phylo_high = 0, 'fair': false},
  {'step': 'step4', 'name': 'motifs', 'v': motifs, 'good': motifs > 0, 'fair': false}, {'step': 'step4', 'name': 'genes without motifs', 'v': round(100 * without / genes, 1), 'good': round(100 * without / genes, 1) < 15, 'fair': false}, {'step': 'step4', 'name': 'divergence', 'v': round(divergence, 3), 'good': round(divergence, 3) BETWEEN 0.10 AND 0.65 AND round(100 * zero / motifs, 1) < 5, 'fair': false},
  {'step': 'step4b', 'name': 'pathogenicity coverage', 'v': round(100 * scored / motifs, 1), 'good': round(100 * scored / motifs, 1) >= 50, 'fair': false}, {'step': 'step4b', 'name': 'pathogenicity spread', 'v': round(100 * flat / scored, 1), 'good': round(100 * flat / scored, 1) < 30, 'fair': false}, {'step': 'step4b', 'name': 'domain coverage', 'v': round(100 * domains / motifs, 1), 'good': domains > 0, 'fair': false},
  {'step': 'step4d', 'name': 'direction coverage', 'v': round(100 * classified / motifs, 1), 'good': round(100 * classified / motifs, 1) >= 80, 'fair': false}, {'step': 'step4d', 'name': 'neutral share', 'v': round(100 * neutral / classified, 1), 'good': round(100 * neutral / classified, 1) <= 88, 'fair': false}, {'step': 'step4d', 'name': 'functional shift', 'v': shift::DOUBLE, 'good': shift > 0, 'fair': false},
  {'step': 'step4d', 'name': 'gain of function', 'v': round(gain, 4), 'good': gain > 0.55, 'fair': false}, {'step': 'step4d', 'name': 'loss of function', 'v': round(loss, 4), 'good': loss < -1, 'fair': false}, {'step': 'step7b', 'name': 'convergent residues', 'v': convergent::DOUBLE, 'good': convergent > 0, 'fair': false}, {'step': 'step7b', 'name': 'convergent motifs in significant genes', 'v': round(p_high, 4), 'good': round(p_high, 4) <= round(p_low, 4), 'fair': false},
  {'step': 'step8', 'name': 'expression coverage', 'v': round(100 * expressed / upper_, 1), 'good': round(100 * expressed / upper_, 1) >= 80, 'fair': false}, {'step': 'step8', 'name': 'expression changes', 'v': round(unchanged, 1), 'good': round(unchanged, 1) < 30, 'fair': false}, {'step': 'step8', 'name': 'conditions', 'v': conditions::DOUBLE, 'good': conditions >= 3, 'fair': false}, {'step': 'step8', 'name': 'candidates without expression', 'v': round(silent, 1), 'good': round(silent, 1) < 50, 'fair': false},
  {'step': 'integrity', 'name': 'orphan candidates', 'v': orphans::DOUBLE, 'good': orphans = 0, 'fair': false}, {'step': 'integrity', 'name': 'first tier without evidence', 'v': bare::DOUBLE, 'good': bare = 0, 'fair': false}, {'step': 'integrity', 'name': 'spread of convergence', 'v': round(spread, 4), 'good': round(spread, 4) > 0.05, 'fair': false}, {'step': 'integrity', 'name': 'first tier with low scores', 'v': weak::DOUBLE, 'good': weak = 0, 'fair': false}
], recursive := true) FROM m), verdicts AS (SELECT step, name, CASE WHEN good THEN 'PASS' WHEN fair THEN 'WARN' ELSE 'FAIL' END AS status, v AS value FROM rules)
SELECT * FROM verdicts
UNION ALL SELECT step, 'all rules', CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END, NULL FROM verdicts GROUP BY step
"""


@query(_QUALITY)
def quality_rules(spark, sf_dir):
    """DS36, DS35: all rules across the tables, and the worst verdict of each step."""
    part, line, supplier = (table(spark, sf_dir, t) for t in ("part", "lineitem", "supplier"))
    k, size, c = F.col("p_partkey"), F.col("p_size"), F.col
    line_id = c("l_orderkey") * 10 + c("l_linenumber")
    tables = {
        "gene": part.select(k.alias("id")), "species": supplier.select(c("s_suppkey").alias("id"), (c("s_suppkey") % 5 == 0).alias("is_control")),
        "ortholog": line.select(line_id.alias("id"), c("l_partkey").alias("gene_id"), c("l_suppkey").alias("species_id"), F.when(c("l_orderkey") % 30 != 0, c("l_quantity") * 2).alias("sequence_identity_pct")),
        "divergent_motif": line.select(
            line_id.alias("ortholog_id"), c("l_discount").alias("divergence_score"), F.when(c("l_linenumber") < 6, c("l_tax") * 10).alias("consequence_score"), (-c("l_quantity") / 10).alias("esm1v_score"), F.when(c("l_linestatus") == "F", "D").alias("domain_name"),
            F.when(c("l_returnflag") == "A", "gain_of_function").when(c("l_returnflag") == "R", "loss_of_function").when(c("l_linenumber") > 1, "neutral").alias("motif_direction"), F.when(c("l_linenumber") > 4, c("l_linenumber") - 4).alias("convergent_aa_count"),
        ),
        "evolution_score": part.where(k % 10 != 0).select(k.alias("gene_id"), (size / 64).alias("convergence_pval")),
        "candidate_score": part.select(
            k.alias("gene_id"), F.when(size < 6, "Tier1").when(size < 12, "Tier2").otherwise("Tier3").alias("tier"), F.when(size % 4 == 0, 0.0).otherwise(size / 64).alias("convergence_score"), F.when(size % 8 == 0, 0.0).otherwise(0.5).alias("selection_score"),
            (size / 32).alias("composite_score"), F.when(k % 3 == 0, 0.0).otherwise(0.5).alias("expression_score"),
        ),
        "expression_result": line.where("l_linenumber = 1").select(c("l_partkey").alias("gene_id"), c("l_shipdate").cast("date").cast("string").alias("comparison"), F.when(c("l_quantity") > 45, 0.0).otherwise(c("l_quantity") - 25).alias("log2fc")),
        "nucleotide_region": part.select(k.alias("gene_id"), F.when(size % 3 == 0, "cds").when(size % 3 == 1, "promoter").otherwise("downstream").alias("region_type"), F.when(size > 5, c("p_name")).otherwise("").alias("sequence")),
        "nucleotide_score": part.select(F.when(size % 2 == 0, "cds").otherwise("promoter").alias("region_type"), (size + 20.0).alias("percent_identity"), (size / 128).alias("gap_fraction")),
        "phylo_conservation_score": part.select(F.when(size % 5 != 0, size / 4 - 2).alias("cds_phylo_score")),
    }
    return checks.quality_report(tables)
