"""Cost-balanced packing: documents go, longest first, to the cheapest sequence that has room.

A piece of n tokens costs linear * n + quadratic * n^2, what a transformer spends on it when attention
stays inside the document. Each task packs its own documents in bounded windows, so nothing is
shuffled and no group is unbounded; sequence ids carry the partition's number.

A window's documents are first cut into whole sequences of `capacity` tokens and a rest below that.
As many sequences as the rests fill are opened, and what is over is opened as powers of two, which
need no padding: the room equals the tokens, so every sequence ends up full. A rest goes to the
cheapest sequence with room for all of it. Only where none has that is it cut, at the sequence with
most room, and its remainder placed in the same way.

Defined results: null or empty text is one token (the end id); a null doc_id stays null; repeated rows
are packed one by one; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.common import documents, small_batches
from helixframe.llm.tokens import Vocabulary, default_vocabulary, windows

CAPACITY = 1024
#: Relative cost of attention: at this length a token's quadratic share equals its linear one.
EVEN_LENGTH = 2048

Piece = tuple[int, int, int, int, int]  # document, start, length, sequence, offset


def room(total: int, capacity: int = CAPACITY) -> list[int]:
    """Sizes of sequences that `total` tokens fill: whole ones, then powers of two."""
    whole, over = divmod(total, capacity)
    return [capacity] * whole + [1 << b for b in reversed(range(over.bit_length())) if over >> b & 1]


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = 1.0 / EVEN_LENGTH) -> tuple[list[Piece], np.ndarray]:
    """Pieces of one window, and each sequence's cost."""
    cost_of = lambda n: linear * n + quadratic * n * n
    pieces: list[Piece] = []
    costs: list[float] = []
    rests = []
    for d, n in enumerate(lengths):
        for k in range(n // capacity):
            pieces.append((d, k * capacity, capacity, len(costs), 0))
            costs.append(cost_of(capacity))
        if n % capacity:
            rests.append((n % capacity, d))
    left = np.array(room(sum(n for n, _ in rests), capacity), np.int64)
    size, spent = left.copy(), np.zeros(len(left))
    for n, d in sorted(rests, key=lambda x: (-x[0], x[1])):
        start = lengths[d] - n
        while n:
            fits = left >= n
            at = int(np.where(fits, spent, np.inf).argmin()) if fits.any() else int(left.argmax())
            part = min(n, int(left[at]))
            pieces.append((d, start, part, len(costs) + at, int(size[at] - left[at])))
            left[at] -= part
            spent[at] += cost_of(part)
            start, n = start + part, n - part
    return pieces, np.concatenate([costs, spent])


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def pack_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY, window_tokens: int = 1 << 21, window_documents: int = 1 << 13) -> DataFrame:
    """One row per piece of a document in a sequence. capacity is a power of two."""
    vocabulary = vocabulary or default_vocabulary()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        for keys, ids in windows(batches, vocabulary, window_tokens, window_documents):
            pieces, costs = pack([len(x) for x in ids], capacity)
            d, start, length, seq, offset = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
            crc = [zlib.crc32(ids[a][b : b + n].tobytes()) for a, b, n, _, _ in pieces]
            columns = [pa.array([keys[a] for a in d], pa.int64()), start, length, np.array(crc, np.int64), np.array([len(ids[a]) for a in d], np.int64), sequence + seq, offset, costs[seq]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])
            sequence += len(costs)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op2_packing_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


QUERIES = {"op2_packing_cost": op2_packing_cost}
