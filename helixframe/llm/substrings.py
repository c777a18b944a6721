"""Substring dedup: words that a window of WINDOW words covers go when the same window starts anywhere else.

A count-min sketch stands before the exact step. Texts are packed into chunks of about CHUNK_BYTES. Each
chunk counts its windows in a sketch of two rows of cells, kept sparse: the sorted cells it touches, as
gaps, with a bit for "twice or more". Cells belong to segments of the sketch, one for SEGMENT_BYTES of text,
so the sketch grows with the input while a segment stays small. The chunks' sketches are merged segment
by segment, and each chunk gets a bit for each of its cells: does the merged count reach two? A window is a
candidate if both of its cells do. As counts are never too low, no repeated window is lost.

The second pass groups the candidates alone, exactly, by 128 bits of hash of the word sequence: each chunk
sends its distinct candidates once, with a bit for "twice or more here", and gets a bit for each. So a window
that a third of all rows have travels once a chunk, and nothing is ever gathered for a document, a window or the
driver. Chunks carry their rows compressed, as they are shuffled twice, to meet their bits.

Defined results: windows are judged on the input, not on what is left; a text of fewer words than a window
loses none; a null text has no words and stays null; an empty one stays empty; rows are documents, so repeated
rows lose all that they share; an empty table gives an empty table; all other columns are kept, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import WORD, documents, small_batches, tasks_for, written

WINDOW = 35
CHUNK_BYTES = 4 << 20
SEGMENT_BYTES = 32 << 20
#: Cells of a segment in each row of the sketch: some twelve for each window of SEGMENT_BYTES of text.
CELL_BITS = 26
ROWS = 2
#: Words whose hashes a task keeps.
CACHED_WORDS = 500_000
#: Chunks in an Arrow batch: they are large.
CHUNKS_A_BATCH = 2
# Odd multipliers of the two halves of a window's hash, and of their last mixing.
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# --- windows -----------------------------------------------------------------------------------


class _Words(dict):
    """Numbers of words, and the two halves of a hash for each number."""

    def __init__(self):
        self.halves = (array("Q"), array("Q"))

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(word)
        for half, x in zip(self.halves, (h & 0xFFFFFFFFFFFFFFFF, h >> 64), strict=True):
            half.append(x)
        n = self[word] = len(self)
        return n

    def hashes(self, ids: np.ndarray) -> list[np.ndarray]:
        out = [np.array(half, np.uint64)[ids] for half in self.halves]
        if len(self) > CACHED_WORDS:
            self.clear()
            self.__init__()
        return out


def _joined(left: np.ndarray, left_width: int, right: np.ndarray, right_width: int, base: int) -> np.ndarray:
    """Hashes of left_width + right_width numbers from those of the first and of the rest."""
    return left[: len(right) - left_width] * np.uint64(pow(base, right_width, 1 << 64)) + right[left_width:]


def rolled(numbers: np.ndarray, base: int, width: int) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of every `width` consecutive numbers, mixed; of doubling widths, joined by the bits of `width`."""
    if len(numbers) < width:
        return np.zeros(0, np.uint64)
    have, size, out, done = numbers, 1, None, 0
    while True:
        if width & size:
            out, done = (have, size) if out is None else (_joined(out, done, have, size, base), done + size)
        if 2 * size > width:
            break
        have, size = _joined(have, size, have, size, base), 2 * size
    out = (out ^ (out >> np.uint64(30))) * _MIX
    return out ^ (out >> np.uint64(31))


class Chunk:
    """The rows of one chunk: their words, the start of each window in the words of all, and its hash in two halves."""

    def __init__(self, rows: pa.Table, words: _Words, window: int = WINDOW):
        self.rows, self.window = rows, window
        texts = pa.concat_arrays([pa.array([], pa.binary()), *(x.field("text").cast(pa.binary()) for x in rows.column("row").chunks)]).to_pylist()
        self.words = [t.split() if t else [] for t in texts]  # bytes.split() cuts at ASCII white space only
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        n = int(self.sizes.sum())
        numbers = words.hashes(np.fromiter(map(words.__getitem__, chain.from_iterable(self.words)), np.int64, n))
        self.starts = np.flatnonzero(np.repeat(self.ends, self.sizes) - np.arange(n) >= window)
        self.halves = [rolled(x, int(base), window)[self.starts] for x, base in zip(numbers, _BASES, strict=True)]

    def segment(self, segments: int) -> np.ndarray:
        return ((self.halves[0] >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)

    def cells(self, segments: int, cell_bits: int) -> list[np.ndarray]:
        """The cell of each window in each row of the sketch, its segment in front."""
        low = np.uint64((1 << cell_bits) - 1)
        first = self.segment(segments) << np.uint64(cell_bits)
        return [first | (half & low) for half in self.halves]

    def left(self, gone: np.ndarray) -> tuple[np.ndarray, list]:
        """How many words of each row go with the windows (a mask), and the text that stays: as it was where nothing goes."""
        edge = np.zeros(int(self.sizes.sum()) + 1, np.int64)
        at = self.starts[gone]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.window, -1)
        covered = np.cumsum(edge[:-1]) > 0
        n_gone = np.diff(np.concatenate([[0], np.cumsum(covered)])[np.concatenate([[0], self.ends])])
        return n_gone, [b" ".join([w for w, c in zip(words, covered[end - len(words) : end].tolist(), strict=True) if not c]) if n else None for words, end, n in zip(self.words, self.ends, n_gone, strict=True)]


# --- chunks, cells and bits as bytes -----------------------------------------------------------

_ZSTD = pa.Codec("zstd")


def _gaps(sorted_cells: np.ndarray) -> bytes:
    """Ascending numbers below 2^32 as compressed gaps, byte by byte: the high bytes are mostly nought."""
    gaps = np.diff(sorted_cells, prepend=np.zeros(1, sorted_cells.dtype)).astype("<u4")
    return _ZSTD.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def _numbers(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_ZSTD.decompress(data, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _pack_bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _ranges(sorted_segments: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(segment, from, to) for each value of a sorted array."""
    if len(sorted_segments):
        edges = np.flatnonzero(np.concatenate([[True], sorted_segments[1:] != sorted_segments[:-1], [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(sorted_segments[a]), a, b


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, bytes, payload): the rows of docs in chunks of about chunk_bytes of text, as compressed Arrow streams. Written, so that a chunk is the same however often it is read."""
    small_batches(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def out() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "bytes", "payload"])

        for batch in batches:
            begin = 0
            for i, n in enumerate(batch.column("size").to_pylist(), 1):
                size += n
                if size >= chunk_bytes:
                    held.append(batch.slice(begin, i - begin).select(["row"]))
                    yield out()
                    number, held, size, begin = number + 1, [], 0, i
            if begin < batch.num_rows:
                held.append(batch.slice(begin).select(["row"]))
        if held:
            yield out()

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    return written(rows.mapInArrow(pack, "chunk long, bytes long, payload binary"))


def _read(payload: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(payload.as_buffer()).read_all()


# --- the sketch --------------------------------------------------------------------------------


def _sketches(chunks: DataFrame, segments: int, window: int, cell_bits: int) -> DataFrame:
    """(chunk, segment, sketch): of a chunk, for each row of the sketch: the number of its cells, their gaps, and bits for those it counts twice or more."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for number, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload"), strict=True):
                own: dict[int, list] = {}
                for cells in Chunk(_read(payload), words, window).cells(segments, cell_bits):
                    cell, n = np.unique(cells, return_counts=True)
                    low = (cell & np.uint64((1 << cell_bits) - 1)).astype(np.int64)
                    for segment, a, b in _ranges(cell >> np.uint64(cell_bits)):
                        own.setdefault(segment, []).append({"n": b - a, "gaps": _gaps(low[a:b]), "twice": _pack_bits(n[a:b] > 1)})
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(own), pa.int64()), pa.array(list(own), pa.int64()), pa.array(list(own.values()), _SKETCH)], names=["chunk", "segment", "sketch"])

    return chunks.select("chunk", "payload").mapInArrow(sketch, "chunk long, segment long, sketch array<struct<n:int,gaps:binary,twice:binary>>")


_SKETCH = pa.list_(pa.struct([("n", pa.int32()), ("gaps", pa.binary()), ("twice", pa.binary())]))
_MASKS = pa.list_(pa.binary())


def _merged(sketches: DataFrame, cell_bits: int) -> DataFrame:
    """(chunk, segment, masks): a bit for each cell of a chunk's sketch, by row: does the merged count reach two?"""

    def merge(table: pa.Table) -> pa.Table:
        sketches = table.column("sketch").to_pylist()
        masks: list[list[bytes]] = [[] for _ in sketches]
        for row in range(ROWS):
            total = np.zeros(1 << cell_bits, np.uint8)  # two stands for more
            cells = [_numbers(s[row]["gaps"], s[row]["n"]) for s in sketches]
            for at, s in zip(cells, sketches, strict=True):
                total[at] = np.minimum(total[at] + 1 + _bits(s[row]["twice"], len(at)), 2)
            for at, out in zip(cells, masks, strict=True):
                out.append(_pack_bits(total[at] == 2))
        return pa.table({"chunk": table.column("chunk"), "segment": table.column("segment"), "masks": pa.array(masks, _MASKS)})

    return sketches.groupBy("segment").applyInArrow(merge, "chunk long, segment long, masks array<binary>")


def _candidates(chunk: Chunk, masks: list[dict], segments: int, cell_bits: int) -> np.ndarray:
    """The windows (as numbers into chunk.starts) whose cells all reach two."""
    open_ = np.ones(len(chunk.starts), bool)
    by_segment = {m["segment"]: m["masks"] for m in masks}
    for row, cells in enumerate(chunk.cells(segments, cell_bits)):
        cell, place = np.unique(cells, return_inverse=True)
        reached = [_bits(by_segment[segment][row], b - a) for segment, a, b in _ranges(cell >> np.uint64(cell_bits))]
        open_ &= np.concatenate([*reached, np.zeros(0, bool)])[place]
    return np.flatnonzero(open_)


# --- the exact step ----------------------------------------------------------------------------


def _asked(chunk: Chunk, at: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct candidates by segment and hash: their order in `at`, the first of each, the number of each in order, and its segment."""
    first, second, segment = chunk.halves[0][at], chunk.halves[1][at], chunk.segment(segments)[at]
    order = np.lexsort((second, first))  # the segment ascends with the first half
    first, second = first[order], second[order]
    new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]) if len(at) else np.zeros(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1, segment[order]


def _with_masks(chunks: DataFrame, *masks: DataFrame) -> DataFrame:
    """Chunks with the bits that came back for them, one array column for each table of masks."""
    out = chunks.select("chunk", "payload")
    for i, m in enumerate(masks):
        out = out.join(m.groupBy("chunk").agg(F.collect_list(F.struct("segment", "masks")).alias(f"masks{i}")), "chunk", "left")
    return out


def _questions(chunks: DataFrame, masks: DataFrame, segments: int, window: int, cell_bits: int) -> DataFrame:
    """(chunk, segment, ids, twice): the distinct candidates of a chunk, 16 bytes each, and bits for those it has twice or more."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for number, payload, masks in zip(batch.column("chunk").to_pylist(), batch.column("payload"), batch.column("masks0").to_pylist(), strict=True):
                chunk = Chunk(_read(payload), words, window)
                at = _candidates(chunk, masks or [], segments, cell_bits)
                order, first, place, segment = _asked(chunk, at, segments)
                n = np.bincount(place, minlength=len(first))
                ids = np.column_stack([half[at][order][first] for half in chunk.halves])
                own = [(s, ids[a:b].tobytes(), _pack_bits(n[a:b] > 1)) for s, a, b in _ranges(segment[first])]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(own), pa.int64()), *(pa.array([x[i] for x in own], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.binary())))], names=["chunk", "segment", "ids", "twice"])

    return _with_masks(chunks, masks).mapInArrow(ask, "chunk long, segment long, ids binary, twice binary")


def _answers(questions: DataFrame) -> DataFrame:
    """(chunk, segment, masks): a bit for each candidate of a chunk: does its word sequence start anywhere else?"""

    def group(table: pa.Table) -> pa.Table:
        ids = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table.column("ids").to_pylist()]
        twice = np.concatenate([_bits(x, len(own)) for x, own in zip(table.column("twice").to_pylist(), ids, strict=True)])
        every = np.concatenate(ids)
        order = np.lexsort((every[:, 1], every[:, 0]))
        every = every[order]
        number = np.cumsum(np.concatenate([[False], (every[1:] != every[:-1]).any(axis=1)]))
        repeated = np.empty(len(order), bool)
        repeated[order] = np.bincount(number, 1 + twice[order])[number] > 1
        edges = np.cumsum([0, *map(len, ids)])
        masks = [[_pack_bits(repeated[a:b])] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.table({"chunk": table.column("chunk"), "segment": table.column("segment"), "masks": pa.array(masks, _MASKS)})

    return questions.groupBy("segment").applyInArrow(group, "chunk long, segment long, masks array<binary>")


def dedup_windows(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, segment_bytes: int = SEGMENT_BYTES, cell_bits: int = CELL_BITS) -> DataFrame:
    """The rows of docs without repeated windows, as (row, n_words, n_removed, kept): words that stay, joined by one space, where any go; else the text as it was."""
    chunks = chunked(docs, chunk_bytes)
    small_batches(docs.sparkSession, CHUNKS_A_BATCH)
    segments = tasks_for(chunks.agg(F.sum("bytes")).first()[0] or 0, segment_bytes)
    masks = written(_merged(_sketches(chunks, segments, window, cell_bits), cell_bits))
    answers = written(_answers(_questions(chunks, masks, segments, window, cell_bits)))
    schema = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for payload, masks, answers in zip(batch.column("payload"), batch.column("masks0").to_pylist(), batch.column("masks1").to_pylist(), strict=True):
                chunk = Chunk(_read(payload), words, window)
                at = _candidates(chunk, masks or [], segments, cell_bits)
                order, first, place, segment = _asked(chunk, at, segments)
                by_segment = {m["segment"]: m["masks"][0] for m in answers or []}
                repeated = np.concatenate([*(_bits(by_segment[s], b - a) for s, a, b in _ranges(segment[first])), np.zeros(0, bool)])
                gone = np.zeros(len(chunk.starts), bool)
                gone[at[order]] = repeated[place]
                n_gone, kept = chunk.left(gone)
                for rows in chunk.rows.to_batches(max_chunksize=128):
                    n = rows.num_rows
                    same = rows.column("row").field("text").cast(pa.string())
                    text = pa.array([x if x is None else x.decode() for x in kept[:n]], pa.string())
                    yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(chunk.sizes[:n]), pa.array(n_gone[:n]), pc.if_else(pa.array(n_gone[:n] > 0), text, same)], names=["row", "n_words", "n_removed", "kept"])
                    kept, n_gone, chunk.sizes = kept[n:], n_gone[n:], chunk.sizes[n:]

    return _with_masks(chunks, masks, answers).mapInArrow(remove, schema)


def op11_substring_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_windows(documents(spark, sf_dir).select("doc_id", "text"))
    words = F.array_join(F.regexp_extract_all(F.coalesce("kept", F.lit("")), F.lit(WORD), F.lit(0)), " ")
    return left.select("row.doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


QUERIES = {"op11_substring_count_min": op11_substring_count_min}

ORACLE = {
    "op11_substring_count_min": rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS win FROM words, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS t(i)
), repeated AS (
  SELECT win FROM windows GROUP BY win HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT r, i + j AS k FROM windows SEMI JOIN repeated USING (win), unnest(generate_series(0, {WINDOW - 1})) AS t(j)
), stay AS (
  SELECT r, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n FROM (SELECT r, k, word FROM words, unnest(w) WITH ORDINALITY AS t(word, k)) ANTI JOIN covered USING (r, k) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM words LEFT JOIN stay USING (r)
""",
}
