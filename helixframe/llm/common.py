"""Small things that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = 128) -> None:
    """Keep Arrow batches of whole texts small: a batch holds `rows` documents at most."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names.

    spark.checkpoint.dir is read from the session; only where it is unset (local tests) is a folder made.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="helixframe-checkpoint-"))
    return df.checkpoint(eager=True)


def tasks_for(rows: int, each: int) -> int:
    """How many tasks a table of so many rows is worth; coalesce() to more than there are changes nothing."""
    return max(1, -(-rows // each))


def written(df: DataFrame) -> DataFrame:
    """Write a table to the folder that cut() uses, and read it again."""
    spark = df.sparkSession
    cut(spark.range(0))  # sees to the folder
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the folder of a table that written() gave, which nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """body(value), where body may use the value many times and in lambdas: it is worked out once a row."""
    return F.transform(F.array(value), body)[0]


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores added until no column has it."""
    while name.lower() in {x.lower() for x in taken}:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
