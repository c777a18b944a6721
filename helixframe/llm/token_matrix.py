"""Token matrices: best-fit-decreasing packing with a segment tree over free capacity.

A document longer than a row is split without loss into whole rows and a rest. Rests go, longest
first, to the row with the least free capacity that still holds them; a segment tree over capacities
finds it in log(row length) steps. Each result row is one row of the id matrix, with the cumulative
lengths of its segments, the position ids, which start again at 0 with every segment, and where each
segment comes from. write_matrices() puts the rows into files.

Tasks pack their own documents in bounded windows; nothing is shuffled.

Defined results: null or empty text is one token (the end id); a null doc_id stays null; repeated rows
are packed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.common import documents, small_batches
from helixframe.llm.tokens import Vocabulary, default_vocabulary, windows

ROW = 1024
PAD_ID = 0


class Capacities:
    """Open rows by free capacity; a segment tree counts them, for the smallest capacity of at least n."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, row: int) -> None:
        if capacity:
            self.rows.setdefault(capacity, []).append(row)
            self._add(capacity, 1)

    def take(self, n: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) with the least capacity of at least n."""
        node = self.leaves + n
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit(lengths: list[int], row: int = ROW) -> list[list[tuple[int, int, int]]]:
    """Rows of (document, start, length)."""
    rows: list[list[tuple[int, int, int]]] = []
    rests = []
    for d, n in enumerate(lengths):
        rows += [[(d, k * row, row)] for k in range(n // row)]
        if n % row:
            rests.append((n % row, d))
    free = Capacities(row)
    for n, d in sorted(rests, key=lambda x: (-x[0], x[1])):
        found = free.take(n)
        if found is None:
            found = (row, len(rows))
            rows.append([])
        rows[found[1]].append((d, lengths[d] - n, n))
        free.put(found[0] - n, found[1])
    return rows


SCHEMA = "row_id long, n_tokens int, input_ids array<int>, cu_seqlens array<int>, position_ids array<int>, doc_ids array<long>, starts array<long>"


def token_matrix(docs: DataFrame, vocabulary: Vocabulary | None = None, row: int = ROW, window_tokens: int = 1 << 20, window_documents: int = 1 << 12) -> DataFrame:
    """One row per row of the matrix; input_ids and position_ids have `row` entries, the last ones padding."""
    vocabulary = vocabulary or default_vocabulary()
    small_batches(docs.sparkSession)

    def lists(parts: list, kind: pa.DataType) -> pa.Array:
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts), kind) if isinstance(parts[0], np.ndarray) else pa.array([x for p in parts for x in p], kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        steps = np.arange(row, dtype=np.int32)
        for keys, ids in windows(batches, vocabulary, window_tokens, window_documents):
            rows = best_fit([len(x) for x in ids], row)
            for at in range(0, len(rows), 512):
                part = rows[at : at + 512]
                matrix, position = np.full((len(part), row), PAD_ID, np.int32), np.zeros((len(part), row), np.int32)
                ends = []
                for i, segments in enumerate(part):
                    offset, own = 0, [0]
                    for d, start, n in segments:
                        matrix[i, offset : offset + n] = ids[d][start : start + n]
                        position[i, offset : offset + n] = steps[:n]
                        offset += n
                        own.append(offset)
                    ends.append(np.array(own, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + at + np.arange(len(part)), pa.int64()), pa.array([int(e[-1]) for e in ends], pa.int32()), lists(list(matrix), pa.int32()), lists(ends, pa.int32()), lists(list(position), pa.int32()),
                        lists([[keys[d] for d, _, _ in s] for s in part], pa.int64()), lists([[b for _, b, _ in s] for s in part], pa.int64()),
                    ],
                    names=[x.split()[0] for x in SCHEMA.split(", ")],
                )
            first += len(rows)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write_matrices(matrix: DataFrame, path: str) -> None:
    """Parquet files of the matrix rows, in row order within each file."""
    matrix.sortWithinPartitions("row_id").write.mode("overwrite").parquet(path)


def binary_rows(matrix: DataFrame) -> DataFrame:
    """Rows of a matrix with input_ids, position_ids and cu_seqlens as bytes: little-endian unsigned 32-bit numbers.

    The first two have the same width in every row, so the rows of a file, put one after another, are its matrix.
    n_tokens tells ids from padding, which has the number of the end id. A null array stays null.
    """
    packed = ("input_ids", "cu_seqlens", "position_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in batch.schema.names]
            for i, name in enumerate(batch.schema.names):
                if name in packed:
                    columns[i] = pa.array([None if not x.is_valid else x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes() for x in columns[i]], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    fields = ", ".join(f"{n} {'binary' if n in packed else kind}" for n, kind in matrix.dtypes)
    return matrix.mapInArrow(run, fields)


def op6_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrix(documents(spark, sf_dir))


QUERIES = {"op6_token_matrix": op6_token_matrix}
