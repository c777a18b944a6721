"""Queries over annotated genomes: features, coordinates, blocks and the windows cut from them.

Contigs are written as FASTA from `part` (one for each brand, a line for each part) and read back in blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.landing import _tab, _text, folder
from helixframe.plans.relational import table
from helixframe.sources import genome, readers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: Width of the blocks here: contigs of some hundred bases have several.
WIDTH = 128
UPSTREAM, DOWNSTREAM = 1500, 600


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


_START = "(p_partkey * 37 % 1900 + 1)"


def _features(part: DataFrame) -> DataFrame:
    """Lines of a GFF3 file, three for each part: a gene, and two coding spans of every third part."""
    k, size = F.col("p_partkey"), F.col("p_size")
    start, strand = k * 37 % 1900 + 1, F.when(k % 2 == 0, "+").otherwise("-")
    gene = _tab("p_brand", F.lit("x"), F.when(k % 5 == 0, "mRNA").otherwise("gene"), start, start + size * 4, F.lit("."), strand, F.lit("."), F.concat(F.lit("ID=gene-"), k, F.lit(";Name=N"), k, F.lit("; Dbxref=GeneID:"), k, F.lit(",X:"), k))
    span = lambda a, b: _tab("p_brand", F.lit("x"), F.lit("CDS"), start + a, start + b, F.lit("."), strand, F.lit("0"), F.concat(F.lit("protein_id=NP_"), k, F.lit(".1;Name=no")))
    coding = F.when(k % 3 == 0, F.array(gene, span(3, size), span(size + 1, size * 2 + 1))).otherwise(F.array(gene, F.lit("# a comment"), F.lit("a short\tline")))
    return part.select(F.explode(coding).alias("value"))


def _genes(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    accession = F.when(k % 4 == 0, F.concat(F.lit("human|NP_"), k, F.lit(".1"))).when(k % 4 == 1, F.concat(F.lit("human|NP_"), k, F.lit(".2"))).when(k % 4 == 2, F.concat(F.lit("human|"), k)).otherwise(F.lit("human|none"))
    symbol = F.when(k % 7 == 0, "none").otherwise(F.concat(F.lit("N"), k, F.lit("_HUMAN")))
    return part.select(k.alias("gene_id"), F.lit("human").alias("species_id"), symbol.alias("gene_symbol"), accession.alias("protein_id"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    letters = F.translate(F.upper(F.regexp_replace("p_name", "[^a-z]", "")), "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC")
    lines = part.select("p_brand", F.col("p_partkey").alias("k"), letters.alias("value")).unionByName(part.groupBy("p_brand").agg(F.lit(-1).cast("long").alias("k"), F.concat(F.lit(">"), F.first("p_brand"), F.lit(" a contig")).alias("value")))
    path = folder(lines)
    lines.repartition("p_brand").sortWithinPartitions("p_brand", "k").select("value").write.text(path)
    return genome.read_genome(spark, path, "human", WIDTH)


_CONTIGS = "contigs AS (SELECT p_brand AS chrom, string_agg(translate(upper(regexp_replace(p_name, '[^a-z]', '', 'g')), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC'), '' ORDER BY p_partkey) AS s FROM part GROUP BY 1)"
_INDEX = f"""
spans AS (SELECT p_partkey AS k, p_brand AS chrom, ({_START} + least(3, p_size + 1))::INT AS start, ({_START} + greatest(p_size, p_size * 2 + 1))::INT AS "end", CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part WHERE p_partkey % 3 = 0),
genes AS (SELECT p_partkey AS k, p_brand AS chrom, {_START}::INT AS start, ({_START} + p_size * 4)::INT AS "end", CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part),
keyed AS (
  SELECT unnest(['NP_' || k || '.1', 'NP_' || k]) AS key, chrom, start, "end", strand FROM spans
  UNION ALL SELECT unnest(['N' || k, 'GENE-' || k, 'GENEID:' || k, 'X:' || k]), chrom, start, "end", strand FROM genes
), index AS (SELECT key, chrom, start, "end", strand, CASE WHEN strand = '+' THEN start ELSE "end" END AS tss FROM keyed)"""
_LOCATED = f"""{_INDEX}, asked AS (
  SELECT p_partkey AS gene_id, CASE WHEN p_partkey % 7 = 0 THEN 'none' ELSE 'N' || p_partkey END AS bare,
    CASE p_partkey % 4 WHEN 0 THEN 'NP_' || p_partkey || '.1' WHEN 1 THEN 'NP_' || p_partkey || '.2' WHEN 2 THEN p_partkey::VARCHAR ELSE 'none' END AS acc FROM part
), tried AS (
  SELECT gene_id, t.key, t.o FROM asked, unnest([upper(acc), upper(split_part(acc, '.', 1)), upper(bare), upper(CASE WHEN bare = 'none' THEN bare ELSE bare || '_HUMAN' END), 'GENEID:' || upper(acc), 'GENE:' || upper(bare)]) WITH ORDINALITY AS t(key, o)
), located AS (
  SELECT gene_id, chrom, start, "end", strand, tss FROM (SELECT t.gene_id, i.*, row_number() OVER (PARTITION BY t.gene_id ORDER BY o) AS r FROM tried t JOIN index i ON i.key = t.key) WHERE r = 1
)"""


@query(f"""
WITH f AS (
  SELECT p_brand AS chrom, CASE WHEN p_partkey % 5 = 0 THEN 'mRNA' ELSE 'gene' END AS kind, {_START} AS start, {_START} + p_size * 4 AS "end", 'gene-' || p_partkey AS id, 'N' || p_partkey AS name, p_partkey AS k FROM part
  UNION ALL SELECT p_brand, 'CDS', {_START} + 3, {_START} + p_size, NULL, 'no', p_partkey FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_brand, 'CDS', {_START} + p_size + 1, {_START} + p_size * 2 + 1, NULL, 'no', p_partkey FROM part WHERE p_partkey % 3 = 0
)
SELECT chrom, kind, start::INT AS start, "end"::INT AS "end", CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS strand, id, name FROM f
""")
def gff_records(spark, sf_dir):
    """SRC10: features with their attributes; comments and short lines are left out."""
    rows = readers.read_gff3(spark, _text(_features(table(spark, sf_dir, "part"))))
    a = lambda k: F.try_element_at("attributes", F.lit(k))
    return rows.select("chrom", "kind", "start", "end", "strand", a("ID").alias("id"), a("Name").alias("name"))


@query(f"WITH {_INDEX} SELECT * FROM index")
def gene_index(spark, sf_dir):
    """SRC10: coordinates by every key of a gene and by the protein ids of coding spans."""
    return readers.gene_index(readers.read_gff3(spark, _text(_features(table(spark, sf_dir, "part")))))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return readers.gene_coordinates(_genes(part), readers.gene_index(readers.read_gff3(spark, _text(_features(part)))))


@query(f"""WITH {_LOCATED} SELECT gene_id, chrom, start, "end", strand, tss FROM located""")
def gene_coordinates(spark, sf_dir):
    """SRC11: the first of six keys that the index has."""
    return _located(spark, sf_dir).select("gene_id", "chrom", "start", "end", "strand", "tss")


@query(f"WITH {_CONTIGS} SELECT chrom, b AS block, substr(s, b * {WIDTH} + 1, {WIDTH}) AS bases FROM contigs, unnest(generate_series(0, (length(s) - 1) // {WIDTH})) AS t(b) WHERE s <> ''")
def genome_blocks(spark, sf_dir):
    """SRC12: contigs as blocks of fixed width."""
    return _blocks(spark, sf_dir).select("chrom", "block", "bases")


@query(f"""
WITH {_CONTIGS}, {_LOCATED}, wins AS (
  SELECT gene_id, chrom, unnest([{{'t': 'cds', 'a': start, 'b': "end"}},
    {{'t': 'promoter', 'a': CASE WHEN strand = '+' THEN tss - {UPSTREAM} ELSE tss + 1 END, 'b': CASE WHEN strand = '+' THEN tss - 1 ELSE tss + {UPSTREAM} END}},
    {{'t': 'downstream', 'a': CASE WHEN strand = '+' THEN "end" + 1 ELSE start - {DOWNSTREAM} END, 'b': CASE WHEN strand = '+' THEN "end" + {DOWNSTREAM} ELSE start - 1 END}}]) AS w FROM located
)
SELECT gene_id, w.t AS region_type, chrom, w.a AS start, w.b AS "end", substr(s, greatest(w.a, 1), least(w.b, length(s)) - greatest(w.a, 1) + 1) AS sequence
FROM wins JOIN contigs USING (chrom) WHERE least(w.b, length(s)) >= greatest(w.a, 1)
""")
def genome_regions(spark, sf_dir):
    """SRC12, SRC13: coding span, promoter and downstream flank of each gene, cut from blocks and stitched."""
    found = genome.regions(_located(spark, sf_dir), _blocks(spark, sf_dir), UPSTREAM, DOWNSTREAM, WIDTH)
    return found.select("gene_id", "region_type", "chrom", "start", "end", "sequence")
