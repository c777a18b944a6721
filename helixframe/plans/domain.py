"""Loading, annotation, export and quality operators over the star tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import scores as S
from helixframe.functions import sequence as Q
from helixframe.operators import relational as R
from helixframe.plans import annotate as A
from helixframe.plans import checks
from helixframe.plans import evolution as E
from helixframe.plans.biology import rounded
from helixframe.plans.relational import table, tables
from helixframe.sources import sinks
from helixframe.streaming.tail import event_counts

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


_UNIQUE = "(SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_discount) AS l_discount, min(l_tax) AS l_tax, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)"


def _unique(spark, sf_dir):
    """Line items, one for each order and line."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag")])


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


# --- keyed tables ------------------------------------------------------------------------------

_NEW = "SELECT o_custkey AS k, CASE WHEN count(*) > 10 THEN round(max(o_totalprice), 2) END AS v FROM orders GROUP BY 1"


def _old_new(spark, sf_dir):
    customer, orders = tables(spark, sf_dir, "customer", "orders")
    new = orders.groupBy(F.col("o_custkey").alias("k")).agg(F.when(F.count("*") > 10, F.round(F.max("o_totalprice"), 2)).alias("v"))
    return customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v")), new


@query(f"SELECT coalesce(o.k, n.k) AS k, coalesce(n.v, o.v) AS v FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal > 0) o FULL JOIN ({_NEW}) n ON n.k = o.k")
def upsert_rows(spark, sf_dir):
    """SNK4, AN20, AN21: get or create, null updates ignored."""
    return R.upsert(*_old_new(spark, sf_dir), ["k"])


@query(f"SELECT o.k, coalesce(n.v, o.v) AS v FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal > 0) o LEFT JOIN ({_NEW}) n ON n.k = o.k")
def update_rows(spark, sf_dir):
    """SNK2, SQ10, AN27: update by key."""
    return R.update_columns(*_old_new(spark, sf_dir), ["k"])


@query(f"SELECT k, v FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal > 0) WHERE k NOT IN (SELECT k FROM ({_NEW})) UNION ALL SELECT k, v FROM ({_NEW})")
def replace_rows(spark, sf_dir):
    """SNK5: delete, then insert."""
    return R.replace_keys(*_old_new(spark, sf_dir), ["k"])


@query(f"SELECT k, v FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_acctbal > 0) UNION ALL SELECT k, v FROM ({_NEW}) WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def insert_new_rows(spark, sf_dir):
    """SRC3, AN1: append unseen keys."""
    return R.insert_missing(*_old_new(spark, sf_dir), ["k"])


@query("SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 1.5 END, c_acctbal)::DOUBLE AS v FROM customer")
def update_from_arrays(spark, sf_dir):
    """SNK3: batches of parallel arrays."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    batches = customer.groupBy((F.floor(F.col("k") / 1000)).alias("b")).agg(F.collect_list(F.struct("k", F.when(F.col("k") % 3 == 0, F.col("k") * 1.5).alias("v"))).alias("r"))
    return R.update_from_arrays(customer, "k", batches.select(F.col("r.k").alias("k"), F.col("r.v").alias("v")))


@query("SELECT l_returnflag AS gene, sample, n FROM (SELECT l_returnflag, sum(l_quantity) FILTER (WHERE l_linestatus = 'O')::BIGINT AS s_open, sum(l_quantity) FILTER (WHERE l_linestatus = 'F')::BIGINT AS s_final FROM lineitem GROUP BY 1) UNPIVOT INCLUDE NULLS (n FOR sample IN (s_open, s_final))")
def unpivot_matrix(spark, sf_dir):
    """SRC9, SRC16, AN15: columns of samples turned into rows."""
    wide = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("gene")).agg(F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("s_open"), F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))).alias("s_final"))
    return A.count_matrix(wide, "gene").withColumnRenamed("count", "n")


# --- sequences ---------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT a.p_partkey AS id, a.p_name AS x, b.p_name AS y, least(length(a.p_name), length(b.p_name)) AS n FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
SELECT id, round(100.0 * list_sum(list_transform(generate_series(1, n), lambda i: (substr(x, i, 1) = substr(y, i, 1))::INT)) / n, 6) AS identity FROM p
""")
def sequence_identity(spark, sf_dir):
    """SQ3."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("x"))
    pairs = part.join(part.select((F.col("id") - 1).alias("id"), F.col("x").alias("y")), "id")
    n = F.least(F.length("x"), F.length("y"))
    cut = pairs.select("id", F.substring("x", F.lit(1), n).alias("x"), F.substring("y", F.lit(1), n).alias("y"))
    return cut.select("id", F.round(Q.identity_percent(F.col("x"), F.col("y")), 6).alias("identity"))


@query("""
WITH r AS (SELECT p_partkey // 6 AS gene_id, p_partkey % 6 AS s, p_name AS q FROM part), h AS (SELECT gene_id, q FROM r WHERE s = 0),
spots AS (SELECT r.gene_id, r.s, i FROM r JOIN h USING (gene_id), unnest(generate_series(1, least(length(r.q), length(h.q)))) AS u(i) WHERE r.s <> 0 AND upper(substr(r.q, i, 1)) <> upper(substr(h.q, i, 1))),
per AS (SELECT gene_id, i, count(DISTINCT s) FILTER (WHERE s <> 5) AS n, count(DISTINCT s // 3) FILTER (WHERE s <> 5) AS l, bool_or(s = 5) AS c FROM spots GROUP BY 1, 2),
counts AS (SELECT gene_id, count(*) AS divergent, count(*) FILTER (WHERE l >= 2) AS convergent FROM per WHERE n >= 3 AND NOT c GROUP BY 1)
SELECT h.gene_id, 'promoter' AS region_type, coalesce(divergent, 0) AS divergent, coalesce(convergent, 0) AS convergent FROM h LEFT JOIN counts USING (gene_id)
""")
def regulatory_positions(spark, sf_dir):
    """SQ12, ST1: positions that several species and no control change."""
    part = table(spark, sf_dir, "part")
    s = F.col("p_partkey") % 6
    regions = part.select(F.floor(F.col("p_partkey") / 6).cast("long").alias("gene_id"), F.when(s == 0, "human").otherwise(s.cast("string")).alias("species_id"), F.lit("promoter").alias("region_type"), F.col("p_name").alias("sequence"))
    species = spark.createDataFrame([(str(i), i == 5, str(i // 3)) for i in range(1, 6)], "species_id string, is_control boolean, lineage string")
    return A.regulatory_divergence(regions, species)


@query("SELECT p_partkey, ref, pos, alt FROM (SELECT p_partkey, 'A' AS ref, p_size AS pos, CASE p_partkey % 3 WHEN 0 THEN 'V' WHEN 1 THEN 'W' END AS alt FROM part) WHERE alt IS NOT NULL")
def variant_names(spark, sf_dir):
    """SQ19: protein changes parsed from their names; unknown residues give none."""
    k = F.col("p_partkey") % 3
    name = F.concat(F.lit("x:p.Ala"), F.col("p_size").cast("string"), F.when(k == 0, "Val").when(k == 1, "Trp").otherwise("Xyz"))
    parsed = table(spark, sf_dir, "part").select("p_partkey", Q.hgvs_protein(name).alias("v")).where("v IS NOT NULL")
    return parsed.select("p_partkey", "v.ref", F.col("v.position").alias("pos"), "v.alt")


@query("""
WITH n AS (SELECT p_partkey // 4 AS og, p_partkey % 4 AS sp, p_name AS s FROM part),
w AS (SELECT og, max(length(s)) AS w, count(*) AS have FROM n GROUP BY 1 HAVING count(*) >= 2 ORDER BY have DESC, og LIMIT 500)
SELECT s.sp::VARCHAR AS species, string_agg(coalesce(n.s, repeat('-', w.w::INT)), '' ORDER BY w.og) AS sequence FROM w CROSS JOIN (SELECT unnest(generate_series(0, 3)) AS sp) s LEFT JOIN n ON n.og = w.og AND n.sp = s.sp GROUP BY 1
""")
def supermatrix(spark, sf_dir):
    """SQ15, TK4: alignments joined per species, gaps where a group lacks one; four neighbouring parts are a group, and five hundred groups make the matrix."""
    group, label = F.floor(F.col("p_partkey") / 4).alias("og"), (F.col("p_partkey") % 4).cast("string").alias("label")
    aligned = table(spark, sf_dir, "part").select(group, label, F.col("p_name").alias("seq"))
    species = spark.range(4).select(F.col("id").cast("string").alias("species"))
    return A.supermatrix(aligned, species, 0.5)


@query("SELECT l_orderkey, l_linenumber, CASE WHEN n = 0 THEN 0.0 ELSE round(least(1.0, pid / 100.0 * len / n), 6) END AS score FROM (SELECT *, l_quantity * 2 AS pid, l_partkey % 900 AS len, l_suppkey % 500 AS n FROM lineitem)")
def conservation_scores(spark, sf_dir):
    """SQ13."""
    score = Q.conservation(F.col("l_quantity") * 2, F.col("l_partkey") % 900, F.col("l_suppkey") % 500)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(score, 6).alias("score"))


@query("SELECT p_partkey, round(CASE WHEN p_name = '' THEN -1.0 ELSE -5.0 * (CASE WHEN p_size % 5 = 0 THEN 0.5 ELSE p_size % 5 / 4.0 END) - greatest(0.0, (length(s) - length(translate(s, 'CNOS', '')) - 3) * 0.1) END, 2)::DOUBLE AS docking FROM (SELECT *, upper(p_name) AS s FROM part)")
def docking_proxy(spark, sf_dir):
    """SQ29, on upper-cased names; three atoms are free here in place of thirty, by adding twenty-seven."""
    s = F.concat(F.repeat(F.lit("C"), F.lit(27)), F.upper("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", Q.atom_docking_proxy(s, F.col("p_size") % 5 / 4.0).alias("docking"))


@query("SELECT a.p_partkey AS x, b.p_size AS y, round(bit_count(a.p_partkey & b.p_size) / bit_count(a.p_partkey | b.p_size)::DOUBLE, 6) AS t FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 WHERE (a.p_partkey | b.p_size) <> 0")
def fingerprint_similarity(spark, sf_dir):
    """SQ28."""
    part = table(spark, sf_dir, "part")
    pairs = part.select("p_partkey", F.col("p_partkey").alias("x")).join(part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_size").alias("y")), "p_partkey").where(F.col("x").bitwiseOR(F.col("y").cast("long")) != 0)
    return pairs.select("x", "y", F.round(Q.tanimoto(F.array("x"), F.array(F.col("y").cast("long"))), 6).alias("t"))


@query(f"""
WITH base AS (SELECT l_orderkey * 10 + l_linenumber AS motif, l_partkey AS gene, l_linenumber AS start, l_suppkey AS k, (l_suppkey % 8)::VARCHAR AS species, (l_suppkey % 4)::VARCHAR AS lineage FROM {_UNIQUE}),
res AS (SELECT *, start + i AS pos, substr('GAVLIFWYSTCNQHDEKRPM', ((gene + i) % 20 + 1)::INT, 1) AS h, substr('GAVLIFWYSTCNQHDEKRPM', ((gene + k + i) % 20 + 1)::INT, 1) AS a FROM base, unnest(range(0, 5)) AS u(i)),
changed AS (SELECT *, CASE WHEN contains('GAVLI', a) THEN 0 WHEN contains('FWY', a) THEN 1 WHEN contains('STC', a) THEN 2 WHEN contains('NQH', a) THEN 3 WHEN contains('DE', a) THEN 4 WHEN contains('KR', a) THEN 5 ELSE 6 END AS klass,
  row_number() OVER (PARTITION BY gene, pos, lineage ORDER BY species, motif) AS r FROM res WHERE h <> a),
kinds AS (SELECT gene, pos, klass, count(*) AS n FROM changed WHERE r = 1 GROUP BY 1, 2, 3), totals AS (SELECT gene, pos, max(n) AS most FROM kinds GROUP BY 1, 2 HAVING sum(n) >= 2)
SELECT motif, coalesce(max(most), 0)::BIGINT AS convergent_aa FROM res LEFT JOIN totals USING (gene, pos) GROUP BY 1
""")
def convergent_aa_classes(spark, sf_dir):
    """DS18, ST2, SQ20: lineages that share a class of substituted residue, without a tree."""
    letter = lambda c: F.substring(F.lit("GAVLIFWYSTCNQHDEKRPM"), (c % 20 + 1).cast("int"), F.lit(1))
    k, gene = F.col("l_suppkey"), F.col("l_partkey")
    rows = _unique(spark, sf_dir).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("motif"), gene.alias("gene"), F.col("l_linenumber").cast("int").alias("start"), F.concat(*[letter(gene + i) for i in range(5)]).alias("human"),
        F.concat(*[letter(gene + k + i) for i in range(5)]).alias("animal"), (k % 8).cast("string").alias("species"), (k % 4).cast("string").alias("lineage"),
    )
    return E.convergent_positions(rows, size=table(spark, sf_dir, "lineitem").count())


# --- annotations -------------------------------------------------------------------------------


@query(f"""
WITH m AS (SELECT l_orderkey * 10 + l_linenumber AS motif_id, l_partkey AS gene_id, (l_suppkey % 40)::INT AS s, (l_suppkey % 40 + 8)::INT AS e FROM {_UNIQUE}),
a AS (SELECT p_partkey AS gene_id, (p_size % 20)::INT AS d_start, (p_size % 20 + 15)::INT AS d_end, 'first' AS name, p_size % 2 = 0 AS preferred, 1 AS ordinal FROM part WHERE p_partkey % 2 = 0),
b AS (SELECT p_partkey, (p_size % 30)::INT, (p_size % 30 + 10)::INT, 'second', true, 2 FROM part), d AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE p_partkey NOT IN (SELECT gene_id FROM a))
SELECT motif_id, name AS domain_name FROM (SELECT motif_id, name, row_number() OVER (PARTITION BY motif_id ORDER BY preferred DESC, ordinal) AS r FROM m JOIN d ON d.gene_id = m.gene_id AND s + 1 <= d_end AND e >= d_start) WHERE r = 1
""")
def domains_two_sources(spark, sf_dir):
    """AN6, JN11: a second source for genes that the first has nothing for."""
    line, part = _unique(spark, sf_dir), table(spark, sf_dir, "part")
    start = (F.col("l_suppkey") % 40).cast("int")
    motifs = line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("motif_id"), F.col("l_partkey").alias("gene_id"), start.alias("start_pos"), (start + 8).alias("end_pos"))
    d = lambda m, w, name, pref, o: part.select(F.col("p_partkey").alias("gene_id"), (F.col("p_size") % m).cast("int").alias("d_start"), (F.col("p_size") % m + w).cast("int").alias("d_end"), F.lit(name).alias("name"), pref.alias("preferred"), F.lit(o).alias("ordinal"))
    first = d(20, 15, "first", F.col("p_size") % 2 == 0, 1).where("gene_id % 2 = 0")
    return A.motif_domains(motifs, first, d(30, 10, "second", F.lit(True), 2))


@query("SELECT o_custkey AS gene_id, o_orderstatus AS name, CASE WHEN phase > 0 THEN phase END AS phase FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY phase DESC, o_orderkey) AS r FROM (SELECT *, CASE WHEN o_orderkey % 7 < 5 THEN o_orderkey % 7 ELSE 0 END::INT AS phase FROM orders)) WHERE r = 1")
def best_drug(spark, sf_dir):
    """AG17, SC6: the drug of the highest stage, the first of equals."""
    stage = F.element_at(F.array(*[F.lit(x) for x in ("NONE", "PHASE_1", "PHASE_2B", "PHASE_3", "APPROVED", "OTHER", "PHASE_9")]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    drugs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gene_id"), F.col("o_orderkey").alias("ordinal"), F.col("o_orderstatus").alias("name"), stage.alias("stage"), F.lit(None).cast("string").alias("drug_stage"), F.array().cast("array<string>").alias("indications"))
    return A.best_known_drug(drugs).select("gene_id", "name", "phase")


@query("SELECT coalesce(a.k, b.k) AS gene_id, greatest(coalesce(a.phase, 0), coalesce(b.phase, 0))::INT AS phase, coalesce(a.trait, b.trait) AS trait FROM (SELECT c_custkey AS k, (c_custkey % 4)::INT AS phase, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS trait FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey AS k, (c_custkey % 5)::INT AS phase, 'new' AS trait FROM customer WHERE c_custkey % 3 <> 1) b ON a.k = b.k")
def translational(spark, sf_dir):
    """AN23: the larger phase, the earlier trait."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    old = c.where(k % 3 != 0).select(k.alias("gene_id"), (k % 4).cast("int").alias("phase"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("trait"))
    return A.translational_status(old, c.where(k % 3 != 1).select(k.alias("gene_id"), (k % 5).cast("int").alias("phase"), F.lit("new").alias("trait")))


@query("SELECT s_suppkey, round(1 / (1 + exp(10 * (s_acctbal / 10000 + 0.5))), 6) AS essentiality, CASE WHEN s_acctbal < 500 AND abs(s_acctbal / 1000) > 0.2 THEN 1.0 WHEN s_acctbal < 500 THEN 0.5 ELSE 0.0 END::DOUBLE AS call FROM supplier")
def essentiality_calls(spark, sf_dir):
    """SC9, DS25, AN13."""
    call = S.expression_call(F.col("s_acctbal") / 200, F.when(F.col("s_acctbal") < 500, 0.01).otherwise(0.5))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(S.essentiality(F.col("s_acctbal") / 10000), 6).alias("essentiality"), call.alias("call"))


@query(f"""
WITH c AS (SELECT l_orderkey * 10 + l_linenumber AS compound_id, l_discount * 10 AS hit, l_returnflag = 'N' AS lip, CASE WHEN l_linenumber > 1 THEN l_tax * 10 END AS sel, l_quantity / 50 AS tox, CASE WHEN l_linenumber <> 3 THEN l_quantity / 6 END AS sa FROM {_UNIQUE}),
n AS (SELECT *, {rounded("(10.0 - sa) / 9.0", 4)} AS san FROM c), o AS (SELECT compound_id, {rounded("0.30 * hit + CASE WHEN lip THEN 0.15 ELSE 0 END::DOUBLE + 0.20 * CASE WHEN sel IS NULL OR sel = 0 THEN 0.5 ELSE sel END + 0.20 * (1 - tox) + 0.15 * CASE WHEN san IS NULL OR san = 0 THEN 0.5 ELSE san END", 4)} AS s FROM n)
SELECT compound_id, CASE WHEN s >= 0.65 THEN 'Lead' WHEN s >= 0.40 THEN 'Hit' WHEN s >= 0.25 THEN 'Fragment' ELSE 'Reject' END AS tier FROM o
""")
def compound_tiers(spark, sf_dir):
    """DS32, AN24."""
    line = _unique(spark, sf_dir)
    k = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    compounds = line.select(k, (F.col("l_discount") * 10).alias("hit_score"))
    sel, sa = F.when(F.col("l_linenumber") > 1, F.col("l_tax") * 10), F.when(F.col("l_linenumber") != 3, F.col("l_quantity") / 6)
    properties = line.select(k.alias("compound_id"), (F.col("l_returnflag") == "N").alias("lipinski_pass"), sel.alias("selectivity_score"), (F.col("l_quantity") / 50).alias("tox21_score"), sa.alias("sa_score"))
    return A.compound_scores(compounds, properties).select("compound_id", F.col("compound_tier").alias("tier"))


@query("SELECT l_partkey, min(l_linenumber) AS first_line, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount DESC, l_linenumber, l_orderkey) AS r FROM lineitem) WHERE r <= 5 GROUP BY 1")
def context_motifs(spark, sf_dir):
    """AN26: the first five motifs of each gene."""
    line = table(spark, sf_dir, "lineitem")
    best = R.top_per_key(line, ["l_partkey"], [F.col("l_discount").desc(), F.col("l_linenumber"), F.col("l_orderkey")], 5)
    return best.groupBy("l_partkey").agg(F.min("l_linenumber").alias("first_line"), F.count("*").alias("n"))


# --- exports, reports, gates -------------------------------------------------------------------


@query("SELECT p_partkey::VARCHAR AS gene_id, printf('%.4f', p_retailprice) AS composite_score, coalesce(CASE WHEN p_size > 25 THEN printf('%.4f', p_size / 7.0::DOUBLE) END, '') AS top_pocket_score, replace(p_type, ' ', ';') AS existing_drugs FROM part ORDER BY p_retailprice DESC, p_partkey::VARCHAR LIMIT 500")
def export_rows(spark, sf_dir):
    """SNK6: the ranked export as text."""
    part = table(spark, sf_dir, "part").withColumn("gene_id", F.col("p_partkey").cast("string"))
    zero = [F.lit(0.0).alias(c) for c in ("convergence_score", "selection_score", "expression_score", "disease_score", "druggability_score", "safety_score", "regulatory_score")]
    scores = part.select("gene_id", F.lit("").alias("trait_id"), F.lit("Tier1").alias("tier"), F.col("p_retailprice").alias("composite_score"), *zero)
    genes = part.select(F.col("gene_id").alias("id"), F.col("p_name").alias("gene_symbol"), F.lit(None).cast("string").alias("human_protein"))
    disease = part.select("gene_id", F.lit("d").alias("disease_name"), F.lit(None).cast("double").alias("opentargets_score"))
    targets = part.select("gene_id", F.col("p_size").alias("pocket_count"), F.when(F.col("p_size") > 25, F.col("p_size") / F.lit(7.0)).alias("top_pocket_score"), F.lit("A").alias("druggability_tier"), F.split("p_type", " ").alias("existing_drugs"))
    return sinks.candidate_export(scores, genes, disease, targets, limit=500).select("gene_id", "composite_score", "top_pocket_score", "existing_drugs")


@query("SELECT p_brand AS og, p_partkey, rpad(p_name, max(length(p_name)) OVER (PARTITION BY p_brand)::INT, '-') AS seq FROM part")
def msa_padding(spark, sf_dir):
    """SNK9."""
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("og"), "p_partkey", F.col("p_name").alias("seq"))
    return sinks.padded_msa(rows, "og", "p_partkey", "seq")


@query("SELECT p_partkey::VARCHAR AS gene_id, '# ' || p_name || chr(10) || '## Type' || chr(10) || p_type || chr(10) || CASE WHEN p_size > 30 THEN chr(10) || '## Size' || chr(10) || p_size::VARCHAR || chr(10) ELSE '' END AS markdown FROM part")
def dossier_text(spark, sf_dir):
    """SNK8, DS37's neighbour: one document per gene, empty sections left out."""
    genes = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("gene_id"), F.col("p_name").alias("gene_symbol"), "p_type", F.when(F.col("p_size") > 30, F.col("p_size")).alias("size"))
    return sinks.dossiers(genes, {"Type": "p_type", "Size": "size"})


@query("""
WITH m AS (SELECT round(100 * (SELECT count(DISTINCT l_partkey) FROM lineitem) / greatest(count(*), 1)::DOUBLE, 1) AS coverage, (SELECT round(100 * count(*) FILTER (WHERE l_discount > 0.09) / count(*)::DOUBLE, 1) FROM lineitem) AS high, (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))::DOUBLE AS orphans FROM part)
SELECT 'step' AS step, name, value, CASE name WHEN 'coverage' THEN CASE WHEN value >= 80 THEN 'PASS' ELSE 'FAIL' END WHEN 'high' THEN CASE WHEN value < 5 THEN 'PASS' WHEN value < 50 THEN 'WARN' ELSE 'FAIL' END ELSE CASE WHEN value < 1 THEN 'PASS' ELSE 'FAIL' END END AS status
FROM (SELECT unnest(['coverage', 'high', 'orphans']) AS name, unnest([coverage, high, orphans]) AS value FROM m)
""")
def quality_gates(spark, sf_dir):
    """DS35, DS36, JN5, JN6: metrics and verdicts."""
    line, part, orders = tables(spark, sf_dir, "lineitem", "part", "orders")
    used = line.agg(F.countDistinct("l_partkey").alias("used"), F.count_if(F.col("l_discount") > 0.09).alias("h"), F.count("*").alias("rows"))
    lost = checks.orphans(orders.select("o_orderkey"), line.select("l_orderkey").distinct(), "o_orderkey", "l_orderkey").agg(F.count("*").alias("orphans"))
    metrics = part.agg(F.count("*").alias("parts")).crossJoin(used).crossJoin(lost)
    metrics = metrics.select(checks.percent(F.col("used"), F.col("parts")).alias("coverage"), checks.percent(F.col("h"), F.col("rows")).alias("high"), F.col("orphans").cast("double").alias("orphans"))
    gates = [checks.Gate("coverage", "coverage", 80), checks.Gate("high", "high", 5, 50, low=True), checks.Gate("orphans", "orphans", 1, low=True)]
    return checks.run_gates(metrics, "step", gates)


@query("SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    """The windowed counts that streaming uses, over a table."""
    counts = event_counts(table(spark, sf_dir, "events"))
    return counts.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
