"""Tables dealt by key to partitions, of which a write replaces only those that it touches, and a bucketed index of variants."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import relational as R

PARTS = 64


@dataclass
class KeyedTable:
    """SNK1-SNK5: a Parquet table whose rows lie in the partition of their key's hash.

    Changes are dealt to the same partitions; the ones that have any are read, changed and replaced, and no file of the
    others is touched. A replaced partition is written aside and moved into its place when all are done, so a lost task
    writes it anew. Keys are unique in the table. The number of partitions is fixed when the table is made.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    parts: int = PARTS
    name: str = "part"

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def _write(self, df: DataFrame) -> None:
        dealt = df.repartition(self.name).sortWithinPartitions(self.name, *self.keys)
        dealt.write.partitionBy(self.name).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def create(self, df: DataFrame) -> KeyedTable:
        """SNK1: the whole table, which must not be there yet."""
        self._dealt(df).repartition(self.name).sortWithinPartitions(self.name, *self.keys).write.partitionBy(self.name).parquet(self.path)
        return self

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(self.name)

    def _change(self, changes: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the partitions that changes touch by how(old, changes); gives their numbers."""
        dealt = self._dealt(changes)
        touched = sorted(r[0] for r in dealt.select(self.name).distinct().collect())  # as many as partitions at most
        if touched:
            old = self.spark.read.parquet(self.path).where(F.col(self.name).isin(touched))
            self._write(self._dealt(how(old.drop(self.name), dealt.drop(self.name))))
        return touched

    def update(self, changes: DataFrame) -> list[int]:
        """SNK2: the non-null columns of changes; keys that the table lacks are ignored."""
        return self._change(changes, lambda old, new: R.update_columns(old, new, self.keys))

    def update_from_arrays(self, arrays: DataFrame) -> list[int]:
        """SNK3: update() from rows of parallel arrays."""
        return self.update(arrays.select(F.inline(F.arrays_zip(*arrays.columns))))

    def upsert(self, rows: DataFrame) -> list[int]:
        """SNK4: new keys are put in, others updated."""
        return self._change(rows, lambda old, new: R.upsert(old, new, self.keys))

    def insert_missing(self, rows: DataFrame) -> list[int]:
        """SRC3: rows whose key the table lacks."""
        return self._change(rows, lambda old, new: R.insert_missing(old, new.select(*old.columns), self.keys))

    def replace(self, rows: DataFrame) -> list[int]:
        """SNK5: the rows of these keys are deleted and put in anew."""
        return self._change(rows, lambda old, new: R.replace_keys(old, new.select(*old.columns), self.keys))


# --- variants by accession ---------------------------------------------------------------------

BUCKETS = 64
_VARIANTS = "accession STRING, position INT, alt STRING, score DOUBLE"


def build_variant_index(variants: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """SRC15: variants (accession, position, alt, score) as a table of buckets by accession, sorted, with bloom filters.

    Made once from a file that one task has to unpack; a search for some accessions then reads their buckets, and of these
    the row groups that have them.
    """
    dealt = variants.select("accession", "position", "alt", "score").repartition(buckets, "accession")
    writer = dealt.write.format("parquet").bucketBy(buckets, "accession").sortBy("accession", "position")
    writer.option("path", path).option("parquet.bloom.filter.enabled#accession", "true").saveAsTable(name)
    return variants.sparkSession.table(name)


def open_variant_index(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The index in a session that does not know it yet."""
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({_VARIANTS}) USING parquet CLUSTERED BY (accession) SORTED BY (accession, position) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def variants_of(index: DataFrame, accessions: list[str] | DataFrame) -> DataFrame:
    """Rows of some accessions: of a list by a filter that the scan takes, of a table by a join to which the index comes in its buckets, unshuffled."""
    if isinstance(accessions, list):
        return index.where(F.col("accession").isin([a.upper() for a in accessions]))
    return index.join(accessions.select(F.upper("accession").alias("accession")).distinct().hint("merge"), "accession", "left_semi")
