"""Readers of the text formats that external tools and public sources deliver, as DataFrames.

Files are read with Spark's readers, so any store it reaches will do; parsing is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.operators.relational import dedup_first, insert_missing


def _file() -> Column:
    return F.regexp_extract(F.input_file_name(), "([^/]+)$", 1)


# --- sequences ---------------------------------------------------------------------------------


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """SRC5, SRC8: (file, header, id, sequence). Records are split at '>', so a file of any size is dealt to many tasks."""
    records = spark.read.text(path, lineSep=">").select(_file().alias("file"), F.col("value")).where(F.length(F.trim("value")) > 0)
    header = F.regexp_extract("value", "^([^\r\n]*)", 1)
    sequence = F.regexp_replace(F.regexp_replace("value", "^[^\r\n]*", ""), "\\s", "")
    return records.select("file", header.alias("header"), F.split(header, "\\s")[0].alias("id"), sequence.alias("sequence"))


def sequence_map(fasta: DataFrame) -> DataFrame:
    """SRC5: (species_id, protein_id, sequence) of re-headered files named species.reheadered.faa."""
    return fasta.select(F.regexp_replace("file", r"\.reheadered\.faa$", "").alias("species_id"), F.col("id").alias("protein_id"), "sequence")


def reheadered(fasta: DataFrame, species_id: str) -> DataFrame:
    """SRC6: ids as species|accession; the middle part of sp|ACC|NAME if it looks like an accession, else the last part."""
    parts = F.split("id", "\\|")
    clean = F.when((F.size(parts) >= 3) & F.get(parts, 1).rlike("^[A-Z][A-Z0-9]{4,9}$"), F.get(parts, 1)).otherwise(F.element_at(parts, -1))
    return fasta.withColumn("id", F.concat(F.lit(f"{species_id}|"), clean))


def count_sequences(fasta: DataFrame) -> DataFrame:
    """SRC7: (file, n)."""
    return fasta.groupBy("file").agg(F.count("*").alias("n"))


def valid_proteomes(fasta: DataFrame, least: int = 100) -> DataFrame:
    return count_sequences(fasta).withColumn("valid", F.col("n") >= least)


# --- species, orthologs ------------------------------------------------------------------------


def read_registry(spark: SparkSession, path: str, phenotype: str | None = None) -> DataFrame:
    """SRC3, SRC4: species of a JSON registry, for a phenotype those that have it, baselines and controls."""
    species = spark.read.json(path, multiLine=True)
    if phenotype is None:
        return species
    has = lambda p: F.coalesce(F.array_contains("phenotypes", p), F.lit(False))
    return species.where(has(phenotype) | has("baseline") | F.coalesce("is_control", F.lit(False)))


def seed_species(known: DataFrame, registry: DataFrame) -> DataFrame:
    """SRC3: append species that aren't known."""
    return insert_missing(known, registry.select(*known.columns), ["id"])


def read_orthogroups(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: (og_id, species_id, protein_id, place) of groups with a human protein; one column per species, ", " between proteins.

    Columns of re-headered files are taken alone if there are any.
    """
    wide = spark.read.csv(path, sep="\t", header=True)
    og, *columns = wide.columns
    columns = [c for c in columns if "reheadered" in c] or columns
    human = next((c for c in columns if "human.reheadered" in c.lower()), None) or next((c for c in columns if "human" in c.lower()), None)
    if human is None:
        raise ValueError("no human column in the orthogroup table")
    kept = wide.where(F.col(f"`{human}`").isNotNull() & (F.col(f"`{human}`") != "")).select(F.col(f"`{og}`").alias("og_id"), *[F.col(f"`{c}`") for c in columns])
    long = kept.unpivot(["og_id"], [f"`{c}`" for c in columns], "species_id", "cell").where("cell <> ''")
    cells = long.select("og_id", F.regexp_replace(F.regexp_replace("species_id", "\\.reheadered", ""), "\\.faa", "").alias("species_id"), F.posexplode(F.split("cell", ", ")).alias("place", "protein_id"))
    return cells.withColumn("protein_id", F.trim("protein_id")).where("protein_id <> ''").select("og_id", "species_id", "protein_id", "place")


# --- genomes -----------------------------------------------------------------------------------


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: (file, line, chrom, kind, start, end, strand, attributes map), in file order by line."""
    lines = spark.read.text(path).select(_file().alias("file"), F.monotonically_increasing_id().alias("line"), F.split("value", "\t").alias("p")).where((F.size("p") >= 9) & ~F.startswith(F.get("p", 0), F.lit("#")))
    pairs = F.filter(F.transform(F.split(F.get("p", 8), ";"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit("=")))
    entries = F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    # the last of several values of a key counts
    attributes = F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["k"] == e["k"])))
    start, end = F.get("p", 3).try_cast("int"), F.get("p", 4).try_cast("int")
    return lines.select("file", "line", F.get("p", 0).alias("chrom"), F.get("p", 2).alias("kind"), start.alias("start"), end.alias("end"), F.get("p", 6).alias("strand"), attributes.alias("attributes")).where("start IS NOT NULL AND end IS NOT NULL")


def gene_index(gff: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """SRC10: (key, chrom, start, end, strand, tss), for each value of the columns `by`. Genes and transcripts by four attributes and Dbxref, the last line of a key counting; coding spans by protein id, with and without version, before those."""
    a = lambda k: F.try_element_at("attributes", F.lit(k))
    key = [*by, "key"]
    keys = F.concat(F.array(a("gene"), a("Name"), a("gene_name"), a("ID")), F.transform(F.split(F.coalesce(a("Dbxref"), F.lit("")), ","), lambda x: F.trim(x)))
    genes = gff.where(F.col("kind").isin("gene", "mRNA", "transcript")).select(*by, F.explode(F.filter(keys, lambda k: k.isNotNull() & (k != ""))).alias("key"), "line", "chrom", "start", "end", "strand")
    genes = dedup_first(genes.withColumn("key", F.upper("key")), key, [F.col("line").desc()])
    cds = gff.where("kind = 'CDS'").select(*by, F.upper(F.trim(a("protein_id"))).alias("key"), "line", "chrom", "start", "end", "strand").where("key <> ''")
    spans = cds.groupBy(*key).agg(F.min("line").alias("line"), F.min_by("chrom", "line").alias("chrom"), F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("strand", "line").alias("strand"))
    bare = dedup_first(spans.withColumn("key", F.substring_index("key", ".", 1)), key, [F.col("line")])
    proteins = insert_missing(spans, bare.select(*spans.columns), key)
    found = insert_missing(proteins, genes.select(*proteins.columns), key)
    return found.select(*key, "chrom", "start", "end", "strand", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end")).alias("tss"))


def gene_coordinates(genes: DataFrame, index: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """SRC11: genes (gene_id, species_id, gene_symbol, protein_id) with the coordinates of the first of six keys that the index has."""
    accession = F.element_at(F.split(F.coalesce("protein_id", F.lit("")), "\\|"), -1)
    symbol = F.coalesce("gene_symbol", F.lit(""))
    bare = F.when(symbol.rlike("_[A-Z0-9]{1,6}$") & ~symbol.rlike("_[0-9]+$"), F.regexp_replace(symbol, "_[A-Z0-9]{1,6}$", "")).otherwise(symbol)
    tagged = lambda tag, x: F.when(x != "", F.concat(F.lit(tag), x))
    keys = F.array(accession, F.substring_index(accession, ".", 1), bare, symbol, tagged("GENEID:", accession), tagged("GENE:", bare))
    tried = genes.select("*", F.posexplode(keys).alias("priority", "key")).withColumn("key", F.upper("key")).where("key <> ''")
    found = tried.join(index, [*by, "key"])
    return dedup_first(found, ["gene_id", "species_id"], [F.col("priority")]).drop("priority", "key")


# --- tables of scores --------------------------------------------------------------------------


def read_constraint(spark: SparkSession, path: str, symbol: str = "gene", canonical: str = "canonical", loeuf: str = "lof.oe_ci.upper") -> DataFrame:
    """SRC14: (symbol, loeuf) of canonical rows, one for each symbol (the smallest)."""
    rows = spark.read.csv(path, sep="\t", header=True)
    kept = rows.where(F.lower(F.col(f"`{canonical}`")) == "true").select(F.col(f"`{symbol}`").alias("symbol"), F.col(f"`{loeuf}`").try_cast("double").alias("loeuf"))
    return kept.where("loeuf IS NOT NULL").groupBy("symbol").agg(F.min("loeuf").alias("loeuf"))


def read_pathogenicity(spark: SparkSession, path: str, accessions: DataFrame | None = None) -> DataFrame:
    """SRC15: (accession, position, alt, score) of a headerless table of variants, the last line of a variant; the accessions prune it before anything else."""
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("#"))).select(F.split("value", "\t").alias("p"), F.monotonically_increasing_id().alias("line")).where(F.size("p") >= 9)
    rows = lines.select("line", F.upper(F.get("p", 5)).alias("accession"), F.get("p", 7).alias("variant"), F.get("p", 8).try_cast("double").alias("score"))
    if accessions is not None:
        rows = rows.join(accessions.select(F.upper("accession").alias("accession")).distinct(), "accession", "left_semi")
    part = lambda i: F.regexp_extract("variant", "^([A-Z])([0-9]+)([A-Z])$", i)
    parsed = rows.where(F.col("variant").rlike("^[A-Z][0-9]+[A-Z]$") & F.col("score").isNotNull())
    return parsed.groupBy("accession", part(2).cast("int").alias("position"), part(3).alias("alt")).agg(F.max_by("score", "line").alias("score"))


def read_dependency_matrix(spark: SparkSession, path: str) -> DataFrame:
    """SRC16: (symbol, mean) over cell lines of a matrix with headers "SYM (id)". Means are taken wide, then turned."""
    wide = spark.read.csv(path, header=True)
    genes = [c for c in wide.columns if " (" in c]
    means = wide.agg(*[F.avg(F.col(f"`{c}`").try_cast("double")).alias(c) for c in genes])
    long = means.unpivot([], [f"`{c}`" for c in genes], "name", "mean").where("mean IS NOT NULL")
    return long.select(F.substring_index("name", " (", 1).alias("symbol"), F.round("mean", 4).alias("mean"))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    """SRC17: (query, percent_identity, alignment_length, gap_fraction), the first of the longest alignments of each query."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.split("value", "\t").alias("p")).where((F.size("p") >= 12) & ~F.startswith(F.get("p", 0), F.lit("#")))
    length, matches = F.get("p", 10).try_cast("int"), F.get("p", 9).try_cast("int")
    cigar = F.coalesce(F.get(F.filter("p", lambda x: F.startswith(x, F.lit("cg:Z:"))), 0), F.lit(""))
    gaps = F.aggregate(F.regexp_extract_all(cigar, F.lit("([0-9]+)[ID]"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))
    rows = lines.select("line", F.get("p", 0).alias("query"), F.round(matches / length * 100, 2).alias("percent_identity"), length.alias("alignment_length"), F.round(gaps / length, 4).alias("gap_fraction")).where("alignment_length >= 1")
    return dedup_first(rows, ["query"], [F.col("alignment_length").desc(), F.col("line")]).drop("line")


def hybrid_36(n: Column, width: int) -> Column:
    """Numbers for fixed columns: decimal while they fit, then in base 36 from A000, then from a000; an error beyond zzzz."""
    first, letters = 10**width, 26 * 36 ** (width - 1)
    coded = lambda past: F.conv((n - past + 10 * 36 ** (width - 1)).cast("string"), 10, 36)
    lower = F.when(n < first + 2 * letters, F.lower(coded(first + letters))).otherwise(F.raise_error(F.concat(F.lit(f"no room in {width} columns for "), n.cast("string"))))
    return F.when(n < first, F.lpad(n.cast("string"), width, " ")).when(n < first + letters, coded(first)).otherwise(lower)


def from_hybrid_36(text: Column, width: int) -> Column:
    first, letters = 10**width, 26 * 36 ** (width - 1)
    value = F.conv(text, 36, 10).try_cast("int") - 10 * 36 ** (width - 1) + first
    upper, lower = text.rlike(f"^[A-Z][0-9A-Z]{{{width - 1}}}$"), text.rlike(f"^[a-z][0-9a-z]{{{width - 1}}}$")
    return F.when(upper, value).when(lower, value + letters).otherwise(text.try_cast("int"))


def read_pdb_ca(spark: SparkSession, path: str) -> DataFrame:
    """SRC18: (file, residue, x, y, z, plddt) of C-alpha atoms, by fixed columns; residues over 9999 in hybrid base 36."""
    at = lambda a, n: F.trim(F.substring("value", a, n))
    atoms = spark.read.text(path).where((F.substring("value", 1, 4) == "ATOM") & (at(13, 4) == "CA"))
    return atoms.select(_file().alias("file"), from_hybrid_36(at(23, 4), 4).alias("residue"), *[at(s, 8).try_cast("double").alias(c) for c, s in (("x", 31), ("y", 39), ("z", 47))], at(61, 6).try_cast("double").alias("plddt")).where("residue IS NOT NULL AND x IS NOT NULL")


def read_pockets(spark: SparkSession, path: str) -> DataFrame:
    """SRC19: (file, rank, score, probability) of a table with padded names and values."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    named = raw.toDF(*[c.strip() for c in raw.columns])
    number = lambda c, kind: F.coalesce(F.trim(c).try_cast(kind), F.lit(0).cast(kind))
    return named.select(_file().alias("file"), number("rank", "int").alias("rank"), number("score", "double").alias("score"), number("probability", "double").alias("probability"))


def read_codeml(spark: SparkSession, path: str) -> DataFrame:
    """SRC20: (file, lnl, omega_foreground, omega_background) of whole output files; foreground at most 99."""
    number = lambda pattern, i: F.regexp_extract("value", pattern, i).try_cast("double")
    fg = "foreground w" + r"\s+([\d.]+)" * 4
    return spark.read.text(path, wholetext=True).select(
        _file().alias("file"), number(r"lnL\(ntime:\s*\d+\s+np:\s*\d+\):\s*([-\d.]+)", 1).alias("lnl"),
        F.when(number(fg, 4).isNotNull(), F.least(F.lit(99.0), number(fg, 4))).alias("omega_foreground"), number(r"background w\s+([\d.]+)", 1).alias("omega_background"),
    )


def read_wig_means(spark: SparkSession, path: str, low: float = -30.0, high: float = 30.0, every_token: bool = False) -> DataFrame:
    """SRC21: (file, mean) of the last token of each line, or of every token, within bounds."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), _file().alias("file"), F.trim("value").alias("v")).where("v <> ''")
    lines = lines.where(~F.col("v").rlike("^(#|fixedStep|variableStep|track)"))
    tokens = F.split("v", "\\s+")
    values = lines.select("path", "file", F.explode(tokens if every_token else F.slice(tokens, -1, 1)).alias("t"))
    numbers = values.select("path", "file", F.col("t").try_cast("double").alias("x")).where(F.col("x").between(low, high))
    return numbers.groupBy("path", "file").agg(F.round(F.avg("x"), 4).alias("mean")).drop("path")


# --- results of selection tests, JSON ----------------------------------------------------------

_SITES = "MLE STRUCT<headers: ARRAY<ARRAY<STRING>>, content: MAP<STRING, ARRAY<ARRAY<DOUBLE>>>>"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(_file().alias("file"), F.from_json("value", schema).alias("j"))


def _content() -> Column:
    return F.coalesce(F.try_element_at("j.MLE.content", F.lit("0")), F.array().cast("array<array<double>>"))


def read_meme(spark: SparkSession, path: str, significance: float = 0.1) -> DataFrame:
    """SRC22: (file, omega, p, site_ps): pseudo ratio and geometric-mean p of the selected sites."""
    rows = _json(spark, path, _SITES).select("file", _content().alias("sites"))
    usable = F.filter("sites", lambda s: (F.size(s) >= 6) & (F.get(s, 5) < significance))
    rows = rows.withColumn("hits", usable)
    mean = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)
    beta = F.filter(F.transform("hits", lambda s: F.get(s, 3)), lambda b: b.isNotNull())
    logs = F.transform(F.filter("hits", lambda s: F.get(s, 5) > 0), lambda s: F.log(F.get(s, 5)))
    share = F.size("hits") / F.size("sites")
    omega = F.when(F.size(beta) > 0, share * F.least(mean(beta) / 5.0, F.lit(2.0))).otherwise(0.0)
    p = F.when(F.size("hits") > 0, F.greatest(F.lit(1e-10), F.exp(F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) / F.size("hits")))).otherwise(1.0)
    empty = F.size("sites") == 0
    return rows.select("file", F.when(empty, 0.0).otherwise(omega).alias("omega"), F.when(empty, 1.0).otherwise(p).alias("p"), F.transform("sites", lambda s: F.get(s, 5)).alias("site_ps"))


def read_fubar(spark: SparkSession, path: str) -> DataFrame:
    """SRC22: (file, positive_sites, negative_sites) with posterior above 0.9."""
    rows = _json(spark, path, _SITES).select("file", F.filter(_content(), lambda s: F.size(s) >= 5).alias("sites"))
    count = lambda i: F.size(F.filter("sites", lambda s: F.get(s, i) > 0.9))
    return rows.select("file", count(3).alias("positive_sites"), count(4).alias("negative_sites"))


def read_fel(spark: SparkSession, path: str) -> DataFrame:
    """SRC22: (file, fel_sites) with p below 0.05 and beta above alpha; columns by their headers."""
    rows = _json(spark, path, _SITES)
    names = F.transform(F.coalesce("j.MLE.headers", F.array().cast("array<array<string>>")), lambda h: F.lower(F.get(h, 0)))
    # the last header that fits counts
    place = lambda fits, default: F.coalesce(F.array_max(F.filter(F.transform(names, lambda h, i: F.when(fits(h), i)), lambda i: i.isNotNull())), F.lit(default))
    has = lambda h, t: F.contains(h, F.lit(t))
    alpha, beta = place(lambda h: has(h, "alpha"), 0), place(lambda h: has(h, "beta") & ~has(h, "alpha"), 1)
    p = place(lambda h: (has(h, "p-value") | has(h, "p_value")) & ~has(h, "alpha") & ~has(h, "beta"), 4)
    placed = rows.select("file", _content().alias("sites"), alpha.alias("a"), beta.alias("b"), p.alias("p"))
    return placed.select("file", F.size(F.filter("sites", lambda s: (F.get(s, F.col("p")) < 0.05) & (F.get(s, F.col("b")) > F.get(s, F.col("a"))))).alias("fel_sites"))


def read_test_results(spark: SparkSession, path: str) -> DataFrame:
    """SRC22: (file, p, k) of gene-wide tests: p is null where absent, k the rate intensity."""
    schema = "`test results` STRUCT<`p-value`: DOUBLE, `relaxation or intensification parameter`: DOUBLE>"
    r = F.col("j")["test results"]
    return _json(spark, path, schema).select("file", F.round(r["p-value"], 6).alias("p"), F.round(r["relaxation or intensification parameter"], 4).alias("k"))


def read_absrel(spark: SparkSession, path: str, significance: float = 0.05) -> DataFrame:
    """SRC22: (file, omega, p, branches): largest ratio, smallest p and names of significant branches; 1.0 and the smallest p without any."""
    schema = "`branch attributes` MAP<STRING, MAP<STRING, STRUCT<`Corrected P-value`: DOUBLE, `Uncorrected P-value`: DOUBLE, `Rate Distributions`: ARRAY<ARRAY<DOUBLE>>>>>"
    entries = F.map_entries(F.try_element_at(F.col("j")["branch attributes"], F.lit("0")))
    branch = lambda e: F.struct(e["key"].alias("name"), F.coalesce(e["value"]["Corrected P-value"], e["value"]["Uncorrected P-value"], F.lit(1.0)).alias("p"), F.coalesce(F.get(F.get(e["value"]["Rate Distributions"], 0), 0), F.lit(1.0)).alias("w"))
    rows = _json(spark, path, schema).select("file", F.coalesce(F.transform(entries, branch), F.array()).alias("all"))
    rows = rows.withColumn("hits", F.filter("all", lambda b: b["p"] < significance))
    low = lambda c: F.coalesce(F.array_min(F.transform(c, lambda b: b["p"])), F.lit(1.0))
    some = F.size("hits") > 0
    omega = F.when(some, F.greatest(F.lit(0.0), F.array_max(F.transform("hits", lambda b: b["w"])))).otherwise(1.0)
    return rows.select("file", F.round(omega, 4).alias("omega"), F.round(F.when(some, low("hits")).otherwise(F.least(F.lit(1.0), low("all"))), 6).alias("p"), F.transform("hits", lambda b: b["name"]).alias("branches"))


def landed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """SRC23: what a remote source delivered, as JSON lines or Parquet; the last record of a key counts."""
    rows = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.json(path)
    numbered = rows.withColumn("arrival", F.monotonically_increasing_id())
    return numbered.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("arrival")))).where("n = 1").drop("n", "arrival")
