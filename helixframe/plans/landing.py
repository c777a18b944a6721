"""Queries that write a table in a source's text format, read it back with its reader, and go on from there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.plans import annotate as A
from helixframe.plans.biology import rounded
from helixframe.plans.relational import table
from helixframe.sources import readers, sinks

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def folder(df: DataFrame) -> str:
    """A new folder in the session's shared one; a folder of its own only where the session names none, as in tests."""
    context = df.sparkSession.sparkContext
    named = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="helixframe-")
    return f"{named}/{uuid.uuid4()}"


def _text(df: DataFrame) -> str:
    path = folder(df)
    df.write.text(path)
    return path


def _tab(*columns) -> F.Column:
    return F.concat_ws("\t", *columns).alias("value")


@query(r"SELECT 'human|P' || lpad(p_partkey::VARCHAR, 8, '0') AS id, upper(regexp_replace(p_name, '\s', '', 'g')) AS sequence FROM part")
def fasta_records(spark, sf_dir):
    """SRC5, SRC6, SRC8, SNK9: records written and read back, with new ids."""
    part = table(spark, sf_dir, "part")
    rows = part.select(F.concat(F.lit("sp|P"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit("|X_HUMAN")).alias("id"), F.upper(F.regexp_replace("p_name", r"\s", "")).alias("sequence"))
    fasta = readers.read_fasta(spark, _text(sinks.fasta_lines(rows, "id", "sequence")))
    return readers.reheadered(fasta, "human").select("id", "sequence")


@query("SELECT count(*) AS n, count(*) >= 100 AS valid FROM part")
def fasta_counts(spark, sf_dir):
    """SRC7: records of a proteome, over its part files."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.upper("p_brand").alias("sequence"))
    fasta = readers.read_fasta(spark, _text(sinks.fasta_lines(rows, "id", "sequence"))).withColumn("file", F.lit("human.faa"))
    return readers.valid_proteomes(fasta).select("n", "valid")


@query("""
WITH p AS (SELECT 'human' AS species_id, p_partkey AS k, 'h' || p_partkey AS protein_id, 0 AS place FROM part WHERE p_partkey % 5 <> 0
  UNION ALL SELECT 'human', p_partkey, 'g' || p_partkey, 1 FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 3 = 0 UNION ALL SELECT 'bat', p_partkey, 'b' || p_partkey, 0 FROM part WHERE p_partkey % 5 <> 0)
SELECT 'G' || k // 2 AS gene_id, species_id, protein_id, k % 3 <> 0 AS is_one_to_one FROM (
  SELECT *, row_number() OVER (PARTITION BY k // 2, species_id ORDER BY lpad(k::VARCHAR, 9, '0')) AS r FROM p WHERE place = 0) WHERE r = 1
""")
def ortholog_load(spark, sf_dir):
    """SRC9, AN1, AG13: the wide table of orthogroups turned into orthologs of genes."""
    k = F.col("p_partkey")
    human = F.when(k % 5 != 0, F.concat_ws(", ", F.concat(F.lit("h"), k), F.when(k % 3 == 0, F.concat(F.lit("g"), k))))
    wide = table(spark, sf_dir, "part").select(F.lpad(k.cast("string"), 9, "0").alias("Orthogroup"), human.alias("human.reheadered"), F.concat(F.lit("b"), k).alias("bat.reheadered"), F.lit("z").alias("bat"))
    path = folder(wide)
    wide.write.csv(path, sep="\t", header=True)
    long = readers.read_orthogroups(spark, path)
    gene_of = table(spark, sf_dir, "part").select(F.concat(F.lit("h"), k).alias("protein_id"), F.concat(F.lit("G"), F.floor(k / 2)).alias("gene_id"))
    sequences = long.select("species_id", "protein_id", F.lit("M").alias("sequence")).distinct()
    return A.load_orthologs(long, sequences, gene_of).select("gene_id", "species_id", "protein_id", "is_one_to_one")


@query("SELECT p_brand AS symbol, min(p_size / 40.0::DOUBLE) AS loeuf FROM part WHERE p_size % 2 = 0 AND p_size > 4 GROUP BY 1")
def constraint_scores(spark, sf_dir):
    """SRC14: canonical rows with a number, the smallest of a symbol."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene"), F.when(size % 2 == 0, "true").otherwise("false").alias("canonical"), F.when(size > 4, (size / 40).cast("string")).otherwise("NA").alias("lof.oe_ci.upper"))
    path = folder(rows)
    rows.write.csv(path, sep="\t", header=True)
    return readers.read_constraint(spark, path)


@query("SELECT 'P' || p_partkey AS accession, (p_size + 1)::INT AS position, CASE p_partkey % 3 WHEN 0 THEN 'V' ELSE 'W' END AS alt, p_size / 50.0::DOUBLE AS score FROM part WHERE p_partkey % 4 = 0 AND p_size % 7 <> 0")
def pathogenicity_scores(spark, sf_dir):
    """SRC15: variants of some accessions; what isn't a substitution is left out."""
    part, k, size = table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    variant = F.when(size % 7 == 0, "bad").otherwise(F.concat(F.lit("A"), size + 1, F.when(k % 3 == 0, "V").otherwise("W")))
    x = F.lit("x")
    path = _text(part.select(_tab(x, x, x, x, x, F.concat(F.lit("p"), k), x, variant, (size / 50).cast("string"), x)))
    return readers.read_pathogenicity(spark, path, part.where(k % 4 == 0).select(F.concat(F.lit("P"), k).alias("accession")))


@query(f"""
WITH d AS (SELECT l_linenumber AS k, -(sum(l_quantity) FILTER (WHERE l_returnflag = 'A')) / 1024 AS a, -(sum(l_quantity) FILTER (WHERE l_returnflag = 'R')) / 1048576 AS r FROM lineitem GROUP BY 1),
m AS (SELECT 'G1' AS gene_id, {rounded("avg(a)", 4)} AS mean FROM d UNION ALL SELECT 'G2', {rounded("avg(r)", 4)} FROM d)
SELECT gene_id, {rounded("1 / (1 + exp(10 * (mean + 0.5)))", 4)} AS score FROM m WHERE {rounded("1 / (1 + exp(10 * (mean + 0.5)))", 4)} > 0
""")
def dependency_scores(spark, sf_dir):
    """SRC16, AN13, SC9: means of a matrix with a column for each gene, as scores by symbol."""
    total = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))
    wide = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("line")).agg((-total("A") / 1024).alias("AAA (1)"), (-total("R") / 1048576).alias("RRR (2)"))
    path = folder(wide)
    wide.write.csv(path, header=True)
    genes = spark.createDataFrame([("G1", "AAA_HUMAN"), ("G2", "RRR"), ("G3", "none")], "gene_id string, gene_symbol string")
    return A.dependency_scores(genes, readers.read_dependency_matrix(spark, path))


@query(f"""
WITH r AS (SELECT l_partkey::VARCHAR AS query, (l_orderkey * 10 + l_linenumber)::INT AS n, l_quantity::INT AS q, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber DESC) AS r FROM lineitem)
SELECT query, {rounded("(n - least(q, n)) / n::DOUBLE * 100", 2)} AS percent_identity, n AS alignment_length, {rounded("(q + 3) / n::DOUBLE", 4)} AS gap_fraction FROM r WHERE r = 1
""")
def alignment_hits(spark, sf_dir):
    """SRC17: the longest alignment of each query."""
    n, q = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("int"), F.col("l_quantity").cast("int")
    x = F.lit("1")
    path = _text(table(spark, sf_dir, "lineitem").select(_tab(F.col("l_partkey"), x, x, x, F.lit("+"), x, x, x, x, n - F.least(q, n), n, F.lit("60"), F.concat(F.lit("cg:Z:50M"), q, F.lit("I3D")))))
    return readers.read_paf(spark, path)


@query("SELECT s_suppkey::INT AS residue, round(s_acctbal / 10, 3) AS x, round(s_nationkey / 8.0, 3) AS y, 50.25::DOUBLE AS plddt FROM supplier WHERE s_suppkey % 4 <> 0")
def structure_atoms(spark, sf_dir):
    """SRC18: C-alpha atoms of fixed columns."""
    s = table(spark, sf_dir, "supplier")
    atom = F.when(F.col("s_suppkey") % 4 == 0, "CB").otherwise("CA")
    key = F.col("s_suppkey")
    line = F.format_string("ATOM  %s  %s  ALA A%s    %8.3f%8.3f%8.3f  1.00%6.2f", readers.hybrid_36(key, 5), atom, readers.hybrid_36(key, 4), F.col("s_acctbal") / 10, F.col("s_nationkey") / 8.0, F.lit(1.0), F.lit(50.25))
    return readers.read_pdb_ca(spark, _text(s.select(line.alias("value")))).select("residue", "x", "y", "plddt")


@query("SELECT s_suppkey::INT AS rank, CASE WHEN s_suppkey % 3 = 0 THEN 0.0 ELSE s_nationkey / 4.0::DOUBLE END AS score, 0.5::DOUBLE AS probability FROM supplier")
def pocket_tables(spark, sf_dir):
    """SRC19: pockets with padded names and values, what isn't a number as 0."""
    score = F.when(F.col("s_suppkey") % 3 == 0, "x").otherwise((F.col("s_nationkey") / 4.0).cast("string"))
    rows = table(spark, sf_dir, "supplier").select(F.lit("pocket ").alias("name"), F.col("s_suppkey").alias(" rank"), F.concat(F.lit("  "), score).alias(" score"), F.lit("0.5 ").alias(" probability"))
    path = folder(rows)
    rows.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.read_pockets(spark, path).select("rank", "score", "probability")


@query("""
SELECT 'codeml' AS kind, -(n_nationkey + 100.5)::DOUBLE AS a, least(n_nationkey * 10.0, 99.0)::DOUBLE AS b FROM nation
UNION ALL SELECT 'test', n_nationkey / 64.0, n_nationkey / 4.0 FROM nation
UNION ALL SELECT 'fubar', 1, (n_nationkey % 2)::DOUBLE FROM nation
UNION ALL SELECT 'absrel', CASE WHEN n_nationkey > 4 THEN n_nationkey / 4.0 ELSE 1.0 END, CASE WHEN n_nationkey > 4 THEN 0.01 ELSE 0.5 END FROM nation
""")
def selection_files(spark, sf_dir):
    """SRC20, SRC22: results of selection tests, a file for each group."""
    n = F.col("n_nationkey")

    def files(body) -> str:
        rows = table(spark, sf_dir, "nation").select("n_nationkey", body.alias("value"))
        path = folder(rows)
        rows.write.partitionBy("n_nationkey").text(path)
        return path

    codeml = readers.read_codeml(spark, files(F.concat(F.lit("lnL(ntime: 10  np: 15):  -"), n + 100.5, F.lit(" +0.0\nbackground w  0.1 1.0 0.1 1.0\nforeground w  0.1 1.0 0.1 "), (n * 10.0).cast("string"), F.lit("\n"))))
    tests = readers.read_test_results(spark, files(F.concat(F.lit('{"test results": {"p-value": '), n / 64.0, F.lit(', "relaxation or intensification parameter": '), n / 4.0, F.lit("}}"))))
    fubar = readers.read_fubar(spark, files(F.concat(F.lit('{"MLE": {"content": {"0": [[0, 0, 0, 0.95, 0.1], [0, 0, 0, 0.2, 0.9'), n % 2, F.lit("], [0, 0]]}}}"))))
    absrel = readers.read_absrel(spark, files(F.concat(F.lit('{"branch attributes": {"0": {"s1": {"Corrected P-value": '), F.when(n > 4, "0.01").otherwise("0.5"), F.lit(', "Rate Distributions": [['), n / 4.0, F.lit(", 1.0]]}}}}"))))
    named = lambda df, kind, a, b: df.select(F.lit(kind).alias("kind"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    out = named(codeml, "codeml", "lnl", "omega_foreground").unionByName(named(tests, "test", "p", "k"))
    return out.unionByName(named(fubar, "fubar", "positive_sites", "negative_sites")).unionByName(named(absrel, "absrel", "omega", "p"))


@query("SELECT n_nationkey::BIGINT AS id FROM nation WHERE n_nationkey % 3 = 0 OR n_nationkey % 7 = 0 OR n_nationkey % 11 = 0 UNION SELECT 999")
def registry_species(spark, sf_dir):
    """SRC3, SRC4: species of a registry with a phenotype, baselines and controls, put behind those that are known."""
    n = F.col("n_nationkey")
    words = F.when(n % 3 == 0, F.array(F.lit("longevity"))).when(n % 7 == 0, F.array(F.lit("baseline"))).otherwise(F.array(F.lit("x")))
    rows = table(spark, sf_dir, "nation").select(F.to_json(F.struct(n.alias("id"), words.alias("phenotypes"), (n % 11 == 0).alias("is_control"))).alias("j"))
    path = _text(rows.agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value")))  # a registry is one small file
    known = spark.createDataFrame([(999,), (0,)], "id long")
    return readers.seed_species(known, readers.read_registry(spark, path, "longevity"))


@query("SELECT s_suppkey AS k, s_name AS name FROM supplier")
def landed_rows(spark, sf_dir):
    """SRC23: what a remote source delivered as JSON lines, a record for each key."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    path = folder(rows)
    rows.write.json(path)
    return readers.landed(spark, path, "k").select("k", "name")
