"""Sequence, scoring and evolution queries over the star tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.functions import scores as S
from helixframe.functions import sequence as Q
from helixframe.functions.sequence import AMINO_CLASS
from helixframe.functions.stats import average_ranks, benjamini_hochberg, rank_product, rank_product_p
from helixframe.plans import evolution as E
from helixframe.plans.scoring import PHASE2_WEIGHTS
from helixframe.plans.relational import _BH, _GENES, _PHI, _genes, table, tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def rounded(sql: str, digits: int) -> str:
    """SQL that rounds a double as Spark's round does: half up from its shortest decimal notation."""
    return f"round(({sql})::DOUBLE::VARCHAR::DECIMAL(38, 20), {digits})::DOUBLE"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- scoring -----------------------------------------------------------------------------------

_RANKED = f"""
{_GENES}, r AS (
  SELECT gene, p, n, ((rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0) / (count(*) OVER ())) *
    ((rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / 2.0) / (count(*) OVER ())) *
    ((rank() OVER (ORDER BY w DESC) + (count(*) OVER (PARTITION BY w) - 1) / 2.0) / (count(*) OVER ())) AS rp FROM genes
), z AS (SELECT gene, n, (ln(rp) + 3) / sqrt(3) AS z FROM r), t AS (SELECT *, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS t FROM z),
ps AS (SELECT gene, round(least(1.0, greatest(1e-15, {_PHI})), 9) AS p FROM t), {_BH},
tiers AS (SELECT a.gene, q, CASE WHEN (g.p < 0.4)::INT + (g.n > 20)::INT + (g.w > 0.6)::INT < 2 THEN 'Tier3' WHEN q < 0.05 THEN 'Tier1' WHEN q < 0.20 THEN 'Tier2' ELSE 'Tier3' END AS tier FROM adjusted a JOIN genes g ON g.gene = a.gene)
"""


def _tiers(spark, sf_dir):
    """DS11 over parts: three ranked layers, rank product, p, q, tier by active layers."""
    genes = _genes(spark, sf_dir)
    ranked = average_ranks(genes, {"rank_1": (F.col("p"), False), "rank_2": (F.col("n"), True), "rank_3": (F.col("w"), True)}, total="genes")
    product = rank_product([F.col(f"rank_{k}") for k in (1, 2, 3)], F.col("genes"))
    active = (F.col("p") < 0.4).cast("int") + (F.col("n") > 20).cast("int") + (F.col("w") > 0.6).cast("int")
    scored = ranked.select("gene", active.alias("layers"), product.alias("rp")).withColumn("rank_p", F.round(rank_product_p(F.col("rp"), 3), 9))
    q = benjamini_hochberg(scored, "rank_p", "q").withColumn("q", F.round("q", 6))
    return q.select("gene", "q", S.rank_product_tier(F.col("q"), F.col("layers")).alias("tier"))


@query(f"WITH {_RANKED} SELECT gene, q, tier, round(1 - q, 4) AS composite FROM tiers")
def scoring_rank_product(spark, sf_dir):
    """DS11."""
    return _tiers(spark, sf_dir).withColumn("composite", F.round(1 - F.col("q"), 4))


@query(f"WITH {_RANKED} SELECT t.gene, p_name AS symbol, tier, round(1 - q, 4) AS composite FROM tiers t JOIN part ON p_partkey = t.gene WHERE tier <> 'none' ORDER BY composite DESC, t.gene LIMIT 100")
def candidates_topk(spark, sf_dir):
    """JN1, FLT1, TK1: the flagship, ranked candidates with their names."""
    part = table(spark, sf_dir, "part")
    scored = _tiers(spark, sf_dir).where("tier <> 'none'").withColumn("composite", F.round(1 - F.col("q"), 4))
    top = scored.orderBy(F.desc("composite"), "gene").limit(100)
    return top.join(part, F.col("p_partkey") == F.col("gene")).select("gene", F.col("p_name").alias("symbol"), "tier", "composite")


_INPUTS = f"""
inputs AS (
  SELECT l_partkey AS gene, count(DISTINCT l_suppkey) AS species, {rounded("avg(l_quantity) / 100", 6)} AS p, {rounded("avg(l_tax) * 20", 6)} AS omega, {rounded("avg(l_discount) * 10", 6)} AS association,
    count(*) % 5 AS phase, count(*) % 4 AS pockets, {rounded("max(l_tax) * 10", 6)} AS pocket, {rounded("min(l_quantity) / 50", 6)} AS depmap, count(*) AS tissues, count(*) % 2 = 0 AS hub
  FROM lineitem GROUP BY 1)
"""


def _inputs(spark, sf_dir):
    n, to6 = F.count("*"), lambda x: F.round(x, 6)
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("gene")).agg(
        F.countDistinct("l_suppkey").alias("species"), to6(F.avg("l_quantity") / 100).alias("p"), to6(F.avg("l_tax") * 20).alias("omega"), to6(F.avg("l_discount") * 10).alias("association"),
        (n % 5).alias("phase"), (n % 4).alias("pockets"), to6(F.max("l_tax") * 10).alias("pocket"), to6(F.min("l_quantity") / 50).alias("depmap"), n.alias("tissues"), (n % 2 == 0).alias("hub"),
    )


_W = PHASE2_WEIGHTS
_SUBSCORES = f"""
{_INPUTS}, subs AS (
  SELECT *, {rounded("1 / (1 + exp(-1.5 * (species / 5.0 - 2)))", 4)} AS convergence,
    CASE WHEN p >= 1 OR omega <= 1 THEN 0.0 ELSE 0.70 * {rounded("least(-log10(greatest(p, 1e-10)) / 10, 1)", 4)} + 0.30 * {rounded("least(omega / 5, 1)", 4)} END::DOUBLE AS selection,
    {rounded("least(1, 0.30 * least(association, 1) + 0.20 * least(-log10(p) / 15, 1) + CASE WHEN phase > 0 THEN least(phase / 4.0, 1) * 0.2 ELSE 0 END)", 4)} AS disease,
    {rounded("least(1, CASE WHEN pockets > 0 THEN 0.10 ELSE 0 END::DOUBLE + 0.30 * least(pocket, 1) + CASE WHEN hub THEN 0.10 ELSE 0 END)", 4)} AS druggability,
    {rounded("greatest(0::DOUBLE, 1::DOUBLE - (CASE WHEN hub THEN 0.1 ELSE 0 END::DOUBLE + CASE WHEN depmap > 0.7 THEN 0.3 WHEN depmap > 0.5 THEN 0.15 WHEN depmap > 0.3 THEN 0.05 ELSE 0 END::DOUBLE + CASE WHEN tissues > 40 THEN 0.2 WHEN tissues > 25 THEN 0.1 WHEN tissues > 15 THEN 0.05 ELSE 0 END::DOUBLE))", 4)} AS safety,
    {rounded("least(1, 0.3 * CASE WHEN association > 0.3 THEN least(association, 1) ELSE 0 END)", 4)} AS genetics
  FROM inputs), comps AS (
  SELECT *, {rounded(f"({_W['convergence']}::DOUBLE * convergence + {_W['selection']}::DOUBLE * selection + CASE WHEN disease > 0 THEN {_W['disease']}::DOUBLE * disease ELSE 0 END + CASE WHEN druggability > 0 THEN {_W['druggability']}::DOUBLE * druggability ELSE 0 END) / ({_W['convergence']}::DOUBLE + {_W['selection']}::DOUBLE + CASE WHEN disease > 0 THEN {_W['disease']} ELSE 0 END::DOUBLE + CASE WHEN druggability > 0 THEN {_W['druggability']} ELSE 0 END::DOUBLE)", 4)} AS raw FROM subs)
"""


def _subscores(spark, sf_dir):
    null, none = F.lit(None).cast("double"), F.array().cast("array<string>")
    c, no = F.col, F.lit(False)
    return _inputs(spark, sf_dir).select(
        "gene", S.convergence(c("species") / 5.0, null).alias("convergence"),
        S.selection(F.lit(S.BRANCH_SITE), c("omega"), c("p"), null, null, null, null, none, none).alias("selection"),
        S.disease(F.lit(True), c("association"), c("p"), null, null, c("phase"), none, none, F.lit(0), null).alias("disease"),
        S.druggability(c("pockets"), c("pocket"), null, F.lit(""), none, F.lit("C"), c("hub"), no, no, no).alias("druggability"),
        S.safety(F.lit(True), c("hub"), no, F.lit(1), c("depmap"), c("tissues"), null, F.lit(None).cast("map<string,double>")).alias("safety"),
        S.human_genetics(null, null, c("association"), F.lit(0), null).alias("genetics"),
    )


@query(f"WITH {_SUBSCORES} SELECT gene, convergence, {rounded("selection", 7)} AS selection, disease, druggability, safety, genetics FROM comps")
def sub_scores(spark, sf_dir):
    """DS1-DS5, DS9."""
    return _subscores(spark, sf_dir).withColumn("selection", F.round("selection", 7))


@query(f"""
WITH {_SUBSCORES}, f AS (SELECT gene, CASE WHEN safety < 0.2 THEN 0.0 ELSE raw END AS composite, genetics FROM comps)
SELECT gene, composite, CASE WHEN composite >= 0.4 AND genetics >= 0.2 THEN 'Validated' WHEN composite >= 0.55 THEN 'Tier1' WHEN composite >= 0.4 THEN 'Tier2' ELSE 'Tier3' END AS tier FROM f
""")
def weighted_composite(spark, sf_dir):
    """DS8, DS9, DS12: composite over present scores, safety floor, tier."""
    subs = _subscores(spark, sf_dir)
    comp = S.composite({k: F.col(k) for k in ("convergence", "selection", "disease", "druggability", "safety")}, PHASE2_WEIGHTS)
    scored = subs.withColumn("composite", F.when(F.col("safety") < PHASE2_WEIGHTS["safety_floor"], 0.0).otherwise(comp))
    genetics = F.when(F.col("genetics") >= 0.2, 0.3).otherwise(0.0)
    return scored.select("gene", "composite", S.tier(F.col("composite"), genetics, 0.55, 0.4).alias("tier"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN am > 0.6 AND esm < -2 THEN CASE WHEN loeuf > 0.35 THEN 'loss_of_function' ELSE 'functional_shift' END WHEN am > 0.6 THEN 'gain_of_function' ELSE 'neutral' END AS direction
FROM (SELECT *, l_discount * 10 AS am, -l_tax * 60 AS esm, CASE WHEN l_linenumber > 1 THEN l_quantity / 50 END AS loeuf FROM lineitem)
""")
def variant_direction(spark, sf_dir):
    """DS22."""
    line = table(spark, sf_dir, "lineitem")
    loeuf = F.when(F.col("l_linenumber") > 1, F.col("l_quantity") / 50)
    return line.select("l_orderkey", "l_linenumber", S.variant_direction(F.col("l_discount") * 10, -F.col("l_tax") * 60, loeuf).alias("direction"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN f = 'active_site' THEN f WHEN f = 'binding_site' THEN f WHEN dis THEN 'disordered' WHEN d <= 8 THEN 'pocket_adjacent' WHEN d < 15 THEN 'surface_near_pocket' ELSE 'distal' END AS context,
  CASE WHEN a >= 0.564 THEN 'likely_pathogenic' WHEN a <= 0.340 THEN 'likely_benign' ELSE 'ambiguous' END AS am_class
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'active_site' WHEN l_returnflag = 'A' THEN 'binding_site' END AS f, l_tax > 0.06 AS dis, l_quantity AS d, l_discount * 10 AS a FROM lineitem)
""")
def structural_context(spark, sf_dir):
    """DS23."""
    feature = F.when(F.col("l_returnflag") == "R", "active_site").when(F.col("l_returnflag") == "A", "binding_site")
    context = S.structural_context(feature, F.col("l_quantity") <= 8, F.col("l_tax") > 0.06, F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", context.alias("context"), S.pathogenicity_class(F.col("l_discount") * 10).alias("am_class"))


@query(f"""
WITH {_INPUTS}, parts AS (SELECT gene, least(round(CASE WHEN hub THEN 0.5 ELSE 0 END + CASE WHEN tissues * 200 < 4700 THEN 0.3 ELSE 0 END + CASE WHEN pockets > 3 THEN 0.2 ELSE 0 END, 3), 1.0) AS syn,
  least(round(CASE phase WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 2 THEN 0.05 ELSE 0.4 END + CASE WHEN hub THEN 0.1 ELSE 0 END, 3), 1.0) AS del, least(round(0.2 + 0.1 + CASE WHEN depmap < 0.5 THEN 0.3 ELSE 0 END, 3), 1.0) AS mod,
  least(round(least(phase * 0.1, 0.4), 3), 1.0) AS ass FROM inputs), o AS (SELECT *, round((0.25 * syn + 0.35 * del + 0.25 * mod + 0.15 * ass)::DOUBLE, 4) AS overall FROM parts)
SELECT gene, overall, CASE WHEN overall >= 0.7 THEN 'Ready' WHEN overall >= 0.4 THEN 'Needs Work' ELSE 'Exploratory' END AS tier,
  nullif(concat_ws('; ', CASE WHEN syn < 0.3 THEN 'gene delivery needs verification' END, CASE WHEN del < 0.3 THEN 'target tractability low' END, CASE WHEN mod < 0.3 THEN 'no preclinical model data' END, CASE WHEN ass < 0.3 THEN 'no validated assay chemistry' END), '') AS notes FROM o
""")
def preclinical_readiness(spark, sf_dir):
    """DS31."""
    c, none = F.col, F.lit(None)
    rows = _inputs(spark, sf_dir).select(
        "gene", F.struct(c("hub").alias("aav_compatible"), (c("tissues") * 200).alias("gene_size_bp"), c("pockets").alias("crispr_sites")).alias("therapy"),
        F.struct(F.when(c("phase") == 0, "A").when(c("phase") == 1, "B").when(c("phase") == 2, "undruggable").alias("druggability_tier"), c("hub").alias("tractability_sm"), none.cast("boolean").alias("tractability_ab"), none.cast("boolean").alias("tractability_protac"), none.cast("array<string>").alias("existing_drugs")).alias("target"),
        F.struct(c("depmap").alias("depmap_score")).alias("safety"), F.struct(none.cast("string").alias("mouse_ko_phenotype"), c("phase").alias("known_drug_phase")).alias("disease"),
    )
    parts = S.readiness_parts()
    scored = rows.select("gene", *[v.alias(k) for k, v in parts.items()])
    cols = [F.col(k) for k in parts]
    return scored.withColumn("overall", S.readiness_overall(*cols)).select("gene", "overall", S.readiness_tier(F.col("overall")).alias("tier"), S.readiness_notes(*cols).alias("notes"))


@query("""
WITH c AS (SELECT l_partkey AS gene, l_orderkey, l_linenumber, l_extendedprice AS dock, l_returnflag = 'N' AS buy, l_discount AS tan FROM lineitem),
h AS (SELECT *, round(0.50 * CASE WHEN max(dock) OVER w = min(dock) OVER w THEN 0.5 ELSE (dock - min(dock) OVER w) / (max(dock) OVER w - min(dock) OVER w) END + 0.30 * CASE WHEN buy THEN 1.0 ELSE 0.4 END + 0.20 * (1 - tan), 4) AS hit FROM c WINDOW w AS (PARTITION BY gene))
SELECT gene, l_orderkey, l_linenumber, hit, CASE WHEN hit >= 0.7 THEN 'A' WHEN hit >= 0.45 THEN 'B' ELSE 'C' END AS tier FROM h
""")
def hit_rank(spark, sf_dir):
    """DS32, WN12."""
    from helixframe.functions.stats import min_max

    line = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "gene")
    scored = line.withColumn("dock", min_max(F.col("l_extendedprice"), Window.partitionBy("gene"))).withColumn("hit", S.hit_score(F.col("dock"), F.col("l_returnflag") == "N", F.col("l_discount")))
    return scored.select("gene", "l_orderkey", "l_linenumber", "hit", S.hit_tier(F.col("hit")).alias("tier"))


@query("""
SELECT l_partkey, round(CASE WHEN w > 0 THEN t / w ELSE 0 END, 4) AS evidence FROM (
  SELECT l_partkey, coalesce(0.5 * a, 0) + coalesce(0.3 * b, 0) + coalesce(0.2 * c, 0) AS t, CASE WHEN a IS NULL THEN 0 ELSE 0.5 END + CASE WHEN b IS NULL THEN 0 ELSE 0.3 END + CASE WHEN c IS NULL THEN 0 ELSE 0.2 END AS w
  FROM (SELECT l_partkey, max(l_discount) FILTER (WHERE l_returnflag = 'R') AS a, max(l_tax) FILTER (WHERE l_returnflag = 'A') AS b, max(l_discount) FILTER (WHERE l_linestatus = 'F') AS c FROM lineitem GROUP BY 1))
""")
def functional_evidence(spark, sf_dir):
    """DS24."""
    at = lambda c, f: F.max(F.when(f, F.col(c)))
    groups = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(at("l_discount", F.col("l_returnflag") == "R").alias("ot"), at("l_tax", F.col("l_returnflag") == "A").alias("gtex"), at("l_discount", F.col("l_linestatus") == "F").alias("depmap"))
    return groups.select("l_partkey", S.functional_evidence({k: F.col(k) for k in ("ot", "gtex", "depmap")}, {"ot": 0.5, "gtex": 0.3, "depmap": 0.2}).alias("evidence"))


# --- evolution ---------------------------------------------------------------------------------

_MOTIFS = """
motifs AS (SELECT l_partkey AS gene, l_linenumber AS start, s_suppkey::VARCHAR AS species, r_name AS lineage FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
windows AS (SELECT gene, start, list_sort(list(DISTINCT lineage)) AS lineages, list_sort(list(DISTINCT species)) AS species, count(DISTINCT lineage) AS n FROM motifs GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY n DESC, start) AS r FROM windows) WHERE r = 1)
"""


def _motifs(spark, sf_dir):
    line, supplier, nation, region = tables(spark, sf_dir, "lineitem", "supplier", "nation", "region")
    species = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return line.join(species, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("gene"), F.col("l_linenumber").alias("start"), F.col("s_suppkey").cast("string").alias("species"), F.col("r_name").alias("lineage"))


_FAR = {("AFRICA", "AMERICA"): 310, ("AFRICA", "ASIA"): 90, ("AMERICA", "EUROPE"): 360, ("ASIA", "MIDDLE EAST"): 430}


@query(f"""
WITH {_MOTIFS}, d AS (SELECT unnest(['AFRICA|AMERICA', 'AFRICA|ASIA', 'AMERICA|EUROPE', 'ASIA|MIDDLE EAST']) AS k, unnest([310, 90, 360, 430]) AS my),
pairs AS (SELECT gene, a.x AS a, b.x AS b FROM best, unnest(lineages) AS a(x), unnest(lineages) AS b(x) WHERE a.x < b.x),
means AS (SELECT gene, avg(coalesce(my, 100)) AS m FROM pairs LEFT JOIN d ON k = a || '|' || b GROUP BY 1)
SELECT b.gene, b.start, b.n, CASE WHEN n < 2 THEN 0.0 ELSE round(n * log2(1 + m / 100), 6) END AS weight FROM best b LEFT JOIN means USING (gene)
""")
def convergence_weight(spark, sf_dir):
    """DS14, DS15, AG16."""
    best = E.convergence(_motifs(spark, sf_dir), E.distance_map(_FAR))
    return best.select("gene", "start", F.col("n").cast("long").alias("n"), F.round("weight", 6).alias("weight"))


@query(f"""
WITH {_MOTIFS}, species AS (SELECT DISTINCT species, lineage FROM motifs), iters AS (SELECT unnest(generate_series(0, 999)) AS i),
dealt AS (SELECT i, species, row_number() OVER (PARTITION BY i ORDER BY md5(i::VARCHAR || species)) AS r FROM species, iters),
ordered AS (SELECT species, lineage, row_number() OVER (ORDER BY species) AS r FROM species),
labels AS (SELECT i, d.species, o.lineage FROM dealt d JOIN ordered o USING (r)),
drawn AS (SELECT b.gene, b.n, l.i, count(DISTINCT l.lineage) AS m FROM best b, unnest(b.species) AS s(x) JOIN labels l ON l.species = s.x GROUP BY ALL)
SELECT gene, round(avg((m >= n)::INT), 4) AS p FROM drawn GROUP BY gene
""")
def permutation_p(spark, sf_dir):
    """DS16, JN16: over a thousand dealings by hashes."""
    motifs = _motifs(spark, sf_dir)
    labels = E.hashed_labels(motifs.select("species", "lineage").distinct(), 1000)
    return E.permutation_p(E.convergence(motifs, E.distance_map(_FAR)), labels)


_TREE = "((0,4)a,((1,5)b,(2,6)c)d,(3,7)e)r;"


def _fitch_sql() -> tuple[str, str, str]:
    """Columns of Fitch's two passes over _TREE, a set and a state for each node, and the list of the leaves' parents."""
    tree = E.parse_newick(_TREE)
    below = {i: [c for c, (_, p) in enumerate(tree) if p == i] for i in range(len(tree))}
    up, down, leaves = [], [], []
    for i in reversed(range(len(tree))):
        kids = below[i]
        if kids:
            both = " & ".join(f"(CASE WHEN s{c} <> 0 THEN s{c} ELSE -1 END)" for c in kids)
            any_ = " | ".join(f"s{c}" for c in kids)
            up += [" + ".join(f"l{c}" for c in kids) + f" AS l{i}", " + ".join(f"(l{c} > 0)::INT" for c in kids) + f" AS k{i}", f"CASE WHEN ({any_}) <> 0 AND ({both}) <> 0 THEN {both} ELSE {any_} END AS s{i}"]
        else:
            up += [f"(max(bit) FILTER (species = '{tree[i][0]}') IS NOT NULL)::INT AS l{i}", f"0 AS k{i}", f"coalesce(max(bit) FILTER (species = '{tree[i][0]}'), 0) AS s{i}"]
            leaves.append(f"{{'species': '{tree[i][0]}', 'parent': c{tree[i][1]}, 'live': l{i}}}")
    for i, (_, parent) in enumerate(tree):
        above = f"c{parent}" if parent >= 0 else "0::BIGINT"
        down.append(f"CASE WHEN k{i} = 1 OR ({above} & s{i}) <> 0 OR s{i} = 0 THEN {above} ELSE s{i} & -s{i} END AS c{i}")
    return ", ".join(up), ", ".join(down), ", ".join(leaves)


_UP, _DOWN, _LEAVES = _fitch_sql()
_KLASS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in AMINO_CLASS.items())


@query(f"""
WITH letters AS (SELECT 'GAVLIFWYSTCNQHDEKRPM' AS t), rows AS (
  SELECT l_orderkey * 10 + l_linenumber AS motif, l_partkey AS gene, (l_suppkey % 8)::VARCHAR AS species, (l_suppkey % 4)::VARCHAR AS lineage, l_linenumber + i AS pos,
    substr(t, ((l_partkey + i) % 20 + 1)::INT, 1) AS h, substr(t, ((l_partkey + l_suppkey + i) % 20 + 1)::INT, 1) AS a
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey, letters, unnest(generate_series(0, 4)) AS u(i)
), changed AS (SELECT *, 1::BIGINT << (ascii(a) - 32)::INT AS bit, CASE a {_KLASS} ELSE -1 END AS klass FROM rows WHERE h <> a),
one AS (SELECT gene, pos, species, min(bit) AS bit FROM changed GROUP BY ALL),
up AS (SELECT gene, pos, {_UP} FROM one GROUP BY gene, pos), down AS (SELECT *, {_DOWN} FROM up WHERE l0 >= 3),
parents AS (SELECT gene, pos, unnest([{_LEAVES}], recursive := true) FROM down),
kept AS (SELECT c.* FROM changed c JOIN parents p USING (gene, pos, species) WHERE p.parent <> c.bit),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene, pos, lineage ORDER BY species, motif) AS r FROM kept) WHERE r = 1),
kinds AS (SELECT gene, pos, klass, count(*) AS n FROM firsts GROUP BY ALL),
totals AS (SELECT gene, pos, max(n) FILTER (klass >= 0) AS most FROM kinds GROUP BY gene, pos HAVING sum(n) >= 2),
best AS (SELECT motif, max(most) AS most FROM rows JOIN totals USING (gene, pos) GROUP BY motif)
SELECT m.motif, coalesce(most, 0)::BIGINT AS convergent_aa FROM (SELECT DISTINCT motif FROM rows) m LEFT JOIN best USING (motif)
""")
def parsimony(spark, sf_dir):
    """DS17, DS18: on letters made from the keys, and a fixed tree of the regions' species."""
    line, supplier = tables(spark, sf_dir, "lineitem", "supplier")
    letter = lambda c, n: F.substring(F.lit("GAVLIFWYSTCNQHDEKRPM"), (c % n + 1).cast("int"), F.lit(1))
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("motif"), F.col("l_partkey").alias("gene"), F.col("l_linenumber").cast("int").alias("start"), F.concat(*[letter(F.col("l_partkey") + i, 20) for i in range(5)]).alias("human"),
        F.concat(*[letter(F.col("l_partkey") + F.col("l_suppkey") + i, 20) for i in range(5)]).alias("animal"), (F.col("l_suppkey") % 8).cast("string").alias("species"), (F.col("l_suppkey") % 4).cast("string").alias("lineage"),
    )
    return E.convergent_positions(rows, _TREE, size=line.count())


@query("""
WITH RECURSIVE g AS (SELECT p_partkey AS gene, string_split(p_type, ' ') AS w, round(p_retailprice / 2000, 6) AS c, p_size <= 10 AS cand FROM part),
k AS (SELECT count(*) FILTER (WHERE cand) AS drawn FROM g), rows AS (SELECT DISTINCT gene, c, cand, unnest(w) AS pathway FROM g),
sums AS (SELECT pathway, count(*) AS size, count(*) FILTER (WHERE cand) AS genes, sum(c) FILTER (WHERE cand) AS total FROM rows GROUP BY 1 HAVING count(*) FILTER (WHERE cand) >= 2),
terms AS (SELECT pathway, genes, total, i, lgamma(size + 1) - lgamma(i + 1) - lgamma(size - i + 1) + lgamma(20000 - size + 1) - lgamma(drawn - i + 1) - lgamma(20000 - size - drawn + i + 1) - (lgamma(20001) - lgamma(drawn + 1) - lgamma(20000 - drawn + 1)) AS t
  FROM sums, k, unnest(generate_series(genes, least(size, drawn))) AS u(i)),
logs AS (SELECT pathway, genes, total, greatest(-300, (max(t) + ln(sum(exp(t - m)))) / ln(10)) AS log_p FROM (SELECT *, max(t) OVER (PARTITION BY pathway) AS m FROM terms) GROUP BY pathway, genes, total)
SELECT pathway, genes, round(log_p, 4) AS log_p, round(-log_p / 2 + total / 2, 3) AS score FROM logs
""")
def pathway_enrich(spark, sf_dir):
    """SC3, DS26, AG15."""
    genes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), F.split("p_type", " ").alias("pathways"), F.round(F.col("p_retailprice") / 2000, 6).alias("convergence"), (F.col("p_size") <= 10).alias("is_candidate"))
    return E.pathway_enrichment(genes).select("pathway", "genes", F.round("log_p", 4).alias("log_p"), F.round("score", 3).alias("score"))


# --- sequences ---------------------------------------------------------------------------------


@query("""
WITH d AS (SELECT doc_id, left(text, 300) AS t FROM documents), p AS (SELECT a.doc_id, a.t AS x, b.t AS y FROM d a JOIN d b ON b.doc_id = a.doc_id + 1),
s AS (SELECT doc_id, CASE WHEN length(x) < 3 THEN [] ELSE list_distinct(list_transform(generate_series(1, length(x) - 2), lambda i: substr(x, i, 3))) END AS a, CASE WHEN length(y) < 3 THEN [] ELSE list_distinct(list_transform(generate_series(1, length(y) - 2), lambda i: substr(y, i, 3))) END AS b FROM p)
SELECT doc_id, round(100.0 * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS identity FROM s
""")
def kmer_jaccard(spark, sf_dir):
    """ST4, SQ4: 3-mers of the first 300 characters of neighbouring documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
    pairs = docs.join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u")), "doc_id")
    return pairs.select("doc_id", F.round(Q.kmer_identity(F.col("t"), F.col("u")), 6).alias("identity"))


@query("""
WITH p AS (SELECT a.doc_id, a.text AS x, b.text AS y, least(length(a.text), length(b.text)) AS n FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
w AS (SELECT doc_id, s, substr(x, s + 1, 15) AS a, substr(y, s + 1, 15) AS b FROM p, unnest(generate_series(0, n - 15, 5)) AS u(s) WHERE n >= 15),
d AS (SELECT doc_id, s, list_sum(list_transform(generate_series(1, 15), lambda i: (substr(a, i, 1) <> substr(b, i, 1))::INT)) / 15.0 AS div FROM w)
SELECT doc_id, s::INT AS start, round(div, 6) AS divergence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY div DESC, s) AS r FROM d WHERE div >= 0.15) WHERE r <= 8
""")
def window_div(spark, sf_dir):
    """SQ1, SQ2, WN10, WN13: sliding windows of neighbouring texts, the eight most divergent of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = docs.join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other")), "doc_id")
    starts = Q.window_starts(F.least(F.length("text"), F.length("other")))
    # arrays of letters once a pair, then slices: substrings of a long text would start over for each window
    zipped = F.arrays_zip(Q.letters(F.col("text")).alias("a"), Q.letters(F.col("other")).alias("b"))
    differ = F.transform(zipped, lambda z: F.coalesce((z["a"] != z["b"]).cast("int"), F.lit(0)))
    scored = F.transform("starts", lambda s: F.struct((-F.aggregate(F.slice("differ", s + 1, 15), F.lit(0), lambda a, x: a + x)).alias("n"), s.alias("start")))
    # the eight most divergent windows of a text are found in its own row
    best = F.slice(F.array_sort(F.filter(scored, lambda w: -w["n"] / 15.0 >= 0.15)), 1, 8)
    windows = pairs.select("doc_id", starts.alias("starts"), differ.alias("differ")).select("doc_id", F.explode(best).alias("w"))
    return windows.select("doc_id", "w.start", F.round(-F.col("w.n") / 15.0, 6).alias("divergence"))


@query("""
WITH p AS (SELECT a.p_partkey, a.p_name AS x, b.p_name AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
SELECT p_partkey, list_filter(generate_series(0, least(length(x), length(y)) - 1), lambda i: upper(substr(x, (i + 1)::INT, 1)) <> upper(substr(y, (i + 1)::INT, 1)))::INT[] AS positions FROM p
""")
def variant_positions(spark, sf_dir):
    """SQ11."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pairs = part.join(part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other")), "p_partkey")
    return pairs.select("p_partkey", Q.variant_positions(F.col("p_name"), F.col("other")).alias("positions"))


_BOMAN = ", ".join(f"'{k}': {v}" for k, v in Q.RESIDUE_POTENTIAL.items())


@query(f"""
WITH t AS (SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS s FROM part), b AS (
  SELECT p_partkey, length(s) AS n, round(list_sum(list_transform(string_split(s, ''), lambda c: coalesce(map_extract_value(MAP {{{_BOMAN}}}, c), 1.0)::DOUBLE)) / length(s), 4) AS boman FROM t WHERE s <> '')
SELECT p_partkey, boman, CASE WHEN n >= 5 THEN round(30.0 * (boman / 2.0) * (1.0 + (20 - least(n, 20)) / 20.0), 1) END AS half_life, n BETWEEN 10 AND 20 AS length_ok FROM b
""")
def peptide_rules(spark, sf_dir):
    """SQ23."""
    s = table(spark, sf_dir, "part").select("p_partkey", F.upper(F.regexp_replace("p_name", "[^A-Za-z]", "")).alias("s")).where("s <> ''")
    b = s.select("p_partkey", Q.boman_index(F.col("s")).alias("boman"), F.length("s").alias("n"))
    return b.select("p_partkey", "boman", Q.half_life_minutes(F.col("boman"), F.col("n")).alias("half_life"), F.col("n").between(10, 20).alias("length_ok"))


@query("""
WITH t AS (SELECT doc_id, translate(upper(text), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC') AS s FROM documents),
w AS (SELECT doc_id, count(*) FILTER (WHERE regexp_full_match(substr(s, i, 22), '[ACGT]{20}GG')) AS sites FROM t, unnest(generate_series(1, greatest(1, length(s)))) AS u(i) GROUP BY 1)
SELECT doc_id, sites, CASE WHEN sites > 50 THEN 'high' WHEN sites > 15 THEN 'medium' ELSE 'low' END AS risk FROM w
""")
def pam_guides(spark, sf_dir):
    """SQ21, SQ22, TK6: guide sites of letters mapped to bases."""
    bases = F.translate(F.upper("text"), "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC")
    g = table(spark, sf_dir, "documents").select("doc_id", Q.scored_guides(bases).alias("g"))
    return g.select("doc_id", F.col("g.sites").cast("long").alias("sites"), "g.risk")


@query("""
SELECT p_partkey, split_part(p_name, ' ', 1) AS species, CASE WHEN contains(p_name, '_') THEN split_part(p_name, '_', 1) ELSE p_name END AS symbol, regexp_extract(p_brand, '#([0-9])([0-9])', 1) AS major, try_cast(regexp_extract(p_brand, '#([0-9]+)', 1) AS INT) AS brand,
  list_contains(string_split(p_type, ' '), 'STEEL') OR list_contains(string_split(p_type, ' '), 'TIN') AS metal FROM part
""")
def regex_parse(spark, sf_dir):
    """SQ6, SQ17, SRC15, SC4, ST2."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.split("p_name", " ", 2)[0].alias("species"), Q.symbol_before_underscore(F.col("p_name")).alias("symbol"), F.regexp_extract("p_brand", "#([0-9])([0-9])", 1).alias("major"),
        F.regexp_extract("p_brand", "#([0-9]+)", 1).try_cast("int").alias("brand"), F.arrays_overlap(F.split("p_type", " "), F.array(F.lit("STEEL"), F.lit("TIN"))).alias("metal"),
    )


@query("""
WITH m AS (SELECT user_id, list(value ORDER BY event_id) AS v FROM events GROUP BY 1)
SELECT user_id, len(list_filter(v, lambda x: x > 30))::BIGINT AS strong, list_max(v) AS most, round(least(log2(1 + list_sum(v) / len(v)) / 10, 1), 6) AS level FROM m
""")
def map_values(spark, sf_dir):
    """SC5, SC7, SC8, AG17: counts, maxima and the level over the values of a user, with no map of them all."""
    value = F.col("value")
    sums = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(value > 30).alias("strong"), F.max(value).alias("most"), F.avg(value).alias("mean"))
    return sums.select("user_id", "strong", "most", F.round(S.gtex_level(F.col("mean")), 6).alias("level"))


@query("SELECT vec_id, round(1 - list_sum(list_transform(generate_series(1, len(a)), lambda i: a[i] * b[i])) / (sqrt(list_sum(list_transform(a, lambda x: x * x))) * sqrt(list_sum(list_transform(b, lambda x: x * x)))), 5) AS distance FROM (SELECT x.vec_id, x.embedding::DOUBLE[] AS a, y.embedding::DOUBLE[] AS b FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1)")
def cosine(spark, sf_dir):
    """DS30."""
    vec = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    pairs = vec.join(vec.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    return pairs.select("vec_id", F.round(Q.cosine_distance(F.col("embedding"), F.col("other")), 5).alias("distance"))


@query("SELECT source, round(avg((contains(lower(text), 'license') OR contains(lower(text), 'token') OR contains(lower(text), 'onthe'))::INT), 6) AS relevance FROM documents GROUP BY 1")
def literature_relevance(spark, sf_dir):
    """DS27, SQ26: share of texts with any of the terms."""
    hit = Q.any_term(F.col("text"), ["license", "token", "onthe"]).cast("int")
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.round(F.avg(hit), 6).alias("relevance"))


@query("SELECT s_suppkey, round(sqrt(pow(s_acctbal / 1000 - cx, 2) + pow(s_nationkey - cy, 2)), 6) AS distance FROM supplier, (SELECT avg(s_acctbal / 1000) AS cx, avg(s_nationkey) AS cy FROM supplier WHERE s_nationkey < 10)")
def centroid_distance(spark, sf_dir):
    """SC10, SRC18: distance from the centroid of some points."""
    s = table(spark, sf_dir, "supplier")
    centre = s.where("s_nationkey < 10").agg(F.avg(F.col("s_acctbal") / 1000).alias("cx"), F.avg("s_nationkey").alias("cy"))
    d = F.sqrt(F.pow(F.col("s_acctbal") / 1000 - F.col("cx"), F.lit(2.0)) + F.pow(F.col("s_nationkey") - F.col("cy"), F.lit(2.0)))
    return s.crossJoin(F.broadcast(centre)).select("s_suppkey", F.round(d, 6).alias("distance"))


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN x <= 0 THEN 1.0 ELSE 1 - (1 - (((((1.061405429 * t - 1.453152027) * t) + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * exp(-x / 2)) END, 6) AS p FROM (SELECT *, l_quantity / 5 AS x, 1 / (1 + 0.3275911 * sqrt(l_quantity / 10)) AS t FROM lineitem)")
def likelihood_ratio_p(spark, sf_dir):
    """SC1, SC11."""
    from helixframe.functions.stats import chi_square_1_survival

    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(chi_square_1_survival(F.col("l_quantity") / 5), 6).alias("p"))
