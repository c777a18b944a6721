"""Quality classifier by hierarchical empirical Bayes.

A logistic regression over cheap counts of a text, fitted on a bounded sample of labelled documents, gives
each document a probability. Hosts and paths below them collect these as soft counts, with grouped
aggregation over all documents. A host's mean is shrunk towards the global one and a path's towards its
host's, with strengths found by the method of moments from the spread between groups: sparse sites stay
near their prior. A document's own share is taken out of its path first; the path's mean is its prior, and
the classifier's likelihood ratio its evidence.

Hosts and paths come from the columns named. Pages have URLs (page_documents); documents have none, and their
source and language stand for them, the coarsest sites that the table knows.

Defined results: a null text counts as empty; null hosts and paths count as empty ones; labels of unknown
documents are ignored, several of one document are averaged, and null ones left out; without labels of both
classes, every document has the prior 0.5 and no evidence; repeated rows are scored one by one; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import cut, documents, small_batches
from helixframe.llm.quality import base_counts

#: The fit uses at most so many labelled documents, those with the smallest hashes of their ids.
SAMPLE = 20_000
#: Documents at least this likely to be good are kept.
THRESHOLD = 0.35
#: Up to so many paths their table is broadcast (about 100 bytes each).
BROADCAST_PATHS = 100_000

_SHARES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|<>", b"#*$%&@", b".,;:", b"\n", bytes(range(128, 256)), b"\"'()[]{}=_+-/\\"]
_CLASS = np.full(256, len(_SHARES), np.int64)
for _i, _chars in enumerate(_SHARES):
    _CLASS[list(_chars)] = _i
N_FEATURES = len(_SHARES) + 9


def features(text: str) -> np.ndarray:
    n_words, chars, symbols, dup_lines, repeats = base_counts(text)
    data = text.encode()
    words = data.split()
    counts = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=len(_SHARES) + 1) if data else np.zeros(len(_SHARES) + 1)
    shares = np.log1p(100 * counts[:-1] / max(1, len(data)))
    size = max(1, n_words)
    distinct = len(set(words)) / size
    more = [np.log1p(n_words), n_words < 20, n_words < 60, repeats / size, np.log1p(100 * symbols / max(1, chars)), dup_lines / (1 + text.count("\n")), chars / size / 10, distinct, distinct * np.log1p(n_words) / 8]
    return np.concatenate([shares, np.array(more, float)])


def featured(docs: DataFrame, host: str, path: str) -> DataFrame:
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column("text").to_pylist()]).reshape(-1, N_FEATURES)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("host"), b.column("path"), lists], names=["doc_id", "host", "path", "x"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(F.col(c), F.lit("")).alias(k) for k, c in (("host", host), ("path", path))], "text")
    return text.mapInArrow(run, "doc_id long, host string, path string, x array<double>")


def fit(x: np.ndarray, y: np.ndarray, decay: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression, by Newton steps on standardised columns."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], decay), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, k: str, n: str, mean: float) -> float:
    """Pseudo-counts of a beta prior around `mean`, from the spread of group means beyond their sampling error."""
    m = F.col(k) / F.col(n)
    got = groups.agg(F.sum(F.col(n)).alias("n"), F.sum(F.col(n) * (m - mean) ** 2).alias("ss"), F.count("*").alias("groups"), F.sum(F.col(n) ** 2).alias("squares")).first()
    if not got["groups"] or got["groups"] < 2 or not 0 < mean < 1:
        return 100.0
    error = mean * (1 - mean)
    between = (got["ss"] - (got["groups"] - 1) * error) / max(1e-9, got["n"] - got["squares"] / got["n"])
    return float(min(1e4, max(1.0, error / between - 1))) if between > 0 else 1e4


@dataclass(frozen=True)
class Classifier:
    """Weights of the features, intercept, and the share of good documents in the sample."""

    weights: tuple[float, ...]
    intercept: float
    prior: float

    def score(self) -> Column:
        """Log odds from x."""
        total = F.aggregate(F.zip_with("x", F.array(*[F.lit(v) for v in self.weights]), lambda a, b: a * b), F.lit(self.intercept), lambda s, v: s + v)
        return F.greatest(F.lit(-20.0), F.least(F.lit(20.0), total))


def fitted(table: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """The classifier of a bounded sample of the labelled rows of table (doc_id, x)."""
    truth = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = cut(table.join(truth, "doc_id").select("x", "y", "doc_id").dropDuplicates(["doc_id"]))
    # a hash threshold first: else every task would send its own best `sample` rows
    share = min(1.0, 1.2 * sample / max(1, known.count()))
    near = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    y = np.array([r["y"] for r in rows])
    if not len(y) or not 0 < y.mean() < 1:
        return Classifier((0.0,) * N_FEATURES, 0.0, 0.5)
    weights, intercept = fit(np.array([r["x"] for r in rows]), y)
    return Classifier(tuple(map(float, weights)), float(intercept), float(y.mean()))


def posteriors(table: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, classifier_p, host_p, path_p, quality_p, kept of rows (doc_id, host, path, x)."""
    scored = table.select("doc_id", "host", "path", model.score().alias("score")).withColumn("p", 1 / (1 + F.exp(-F.col("score"))))
    paths = cut(scored.groupBy("host", "path").agg(F.sum("p").alias("k"), F.count("*").alias("n")))
    hosts = cut(paths.groupBy("host").agg(F.sum("k").alias("host_k"), F.sum("n").alias("host_n")))
    total = hosts.agg(F.sum("host_k"), F.sum("host_n")).first()
    mean = total[0] / total[1] if total[1] else model.prior
    host_strength, path_strength = _strength(hosts, "host_k", "host_n", mean), _strength(paths, "k", "n", mean)
    sites = paths.join(hosts, "host").withColumn("host_p", (F.col("host_k") + host_strength * mean) / (F.col("host_n") + host_strength)).drop("host_k", "host_n")
    few = paths.limit(BROADCAST_PATHS + 1).count() <= BROADCAST_PATHS
    joined = scored.join(F.broadcast(sites) if few else sites, ["host", "path"])
    others = (F.col("k") - F.col("p") + path_strength * F.col("host_p")) / (F.col("n") - 1 + path_strength)
    posterior = _odds(F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_p")))) + F.col("score") - float(np.log(model.prior / (1 - model.prior)))
    out = joined.withColumn("path_p", others).withColumn("quality_p", 1 / (1 + F.exp(-posterior)))
    return out.select("doc_id", F.col("p").alias("classifier_p"), "host_p", "path_p", "quality_p", (F.col("quality_p") >= threshold).alias("kept"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, classifier_p, host_p, path_p, quality_p, kept: one row per document. labels: (doc_id, quality 0 or 1)."""
    table = cut(featured(docs, host, path))
    return posteriors(table, fitted(table, labels, sample), threshold)


def page_documents(pages: DataFrame) -> DataFrame:
    """(doc_id, host, path, text) of pages (page_id, url, html): the host in lower case, the first part of the path, and the text without markup."""
    text = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1\\s*>", " "), "<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]*)", 1)
    return pages.select(F.col("page_id").alias("doc_id"), host.alias("host"), path.alias("path"), text.alias("text"))


def op9_quality_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op9_quality_empirical_bayes": op9_quality_empirical_bayes}
