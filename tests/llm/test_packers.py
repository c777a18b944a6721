import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.llm import packing, token_matrix
from helixframe.llm.tokens import default_vocabulary, encode

VOCABULARY = default_vocabulary()


def test_ids_equal_those_of_tokenizers(spark, sf_dir):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY.json)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in [*texts, "", " \n\t x", "a<|endoftext|>b", "naïve ☃ 𝄞​", "'S 'll 12345 \r\n  y", "\x00\x01"]:
        assert encode(text, VOCABULARY).tolist() == [*exact.encode(text, add_special_tokens=False).ids, 0]


@given(st.lists(st.integers(1, 5000), max_size=60))
@settings(max_examples=60, deadline=None)
def test_packing_covers_every_token_without_padding(lengths):
    pieces, costs = packing.pack(lengths)
    seen = {d: np.zeros(n, int) for d, n in enumerate(lengths)}
    fill = {}
    for d, start, n, seq, offset in pieces:
        seen[d][start : start + n] += 1
        fill.setdefault(seq, []).append((offset, n))
    assert all((x == 1).all() for x in seen.values())
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
    assert len(costs) == len(fill)


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 900, 2000).tolist()
    pieces, costs = packing.pack(lengths)
    naive, at = {}, 0
    for n in lengths:  # one after another
        while n:
            part = min(n, 1024 - at % 1024)
            naive[at // 1024] = naive.get(at // 1024, 0) + part + part * part / packing.EVEN_LENGTH
            at, n = at + part, n - part
    full = costs[: sum(lengths) // 1024]
    assert np.std(full) < 0.8 * np.std(list(naive.values())[:-1])
    assert len(pieces) <= len(lengths) + len(costs)  # one cut for each sequence, as when texts are joined end to end


@given(st.lists(st.integers(1, 90), max_size=50))
@settings(max_examples=80, deadline=None)
def test_assignment_equals_a_scan_of_all_sequences(lengths):
    """Longest rest first, to the sequence of least cost that has room for it; where none has, cut at the one with most room."""
    capacity, cost = 32, lambda n: n + n * n / packing.EVEN_LENGTH
    want = [(d, k * capacity, capacity) for d, n in enumerate(lengths) for k in range(n // capacity)]
    costs = [cost(capacity)] * len(want)
    rests = sorted(((n % capacity, d) for d, n in enumerate(lengths) if n % capacity), key=lambda x: (-x[0], x[1]))
    open_ = [[size, 0.0, []] for size in packing.room(sum(n for n, _ in rests), capacity)]
    for n, d in rests:
        start = lengths[d] - n
        while n:
            fits = [s for s in open_ if s[0] >= n]
            s = min(fits, key=lambda s: s[1]) if fits else max(open_, key=lambda s: s[0])
            part = min(n, s[0])
            s[0], s[1] = s[0] - part, s[1] + cost(part)
            s[2].append((d, start, part))
            start, n = start + part, n - part
    pieces, got = packing.pack(lengths, capacity)
    by = {}
    for d, start, n, seq, offset in pieces:
        by.setdefault(seq, []).append((offset, (d, start, n)))
    assert [[p for _, p in sorted(by[k])] for k in sorted(by)] == [[p] for p in want] + [s[2] for s in open_]
    assert got.tolist() == pytest.approx(costs + [s[1] for s in open_])


def test_query_pieces(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: encode(r.text, VOCABULARY) for r in docs.collect()}
    rows = packing.pack_documents(docs).collect()
    assert sum(r.length for r in rows) == sum(map(len, texts.values()))
    for r in rows:
        ids = texts[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


@given(st.lists(st.integers(1, 40), max_size=80))
@settings(max_examples=80, deadline=None)
def test_best_fit_equals_a_scan(lengths):
    row = 16
    want, free = [], []
    rests = sorted(((n % row, d) for d, n in enumerate(lengths) if n % row), key=lambda x: (-x[0], x[1]))
    for n, _ in rests:  # least free capacity that holds it
        fits = [c for c in free if c >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(row - n)
    want = sorted(free)
    rows = token_matrix.best_fit(lengths, row)
    got = sorted(row - sum(n for _, _, n in r) for r in rows if not (len(r) == 1 and r[0][2] == row))
    assert got == want


def test_matrix_round_trip(spark, edge, edge_rows, empty):
    rows = token_matrix.token_matrix(edge, row=64).collect()
    back = {}
    for r in rows:
        assert len(r.input_ids) == len(r.position_ids) == 64 and r.cu_seqlens[-1] == r.n_tokens
        for i, (d, start) in enumerate(zip(r.doc_ids, r.starts, strict=True)):
            a, b = r.cu_seqlens[i], r.cu_seqlens[i + 1]
            assert r.position_ids[a:b] == list(range(b - a))
            back.setdefault(d, []).append((start, r.input_ids[a:b]))
    by_id = {}
    for d, text, *_ in edge_rows:
        by_id.setdefault(d, []).append(encode(text, VOCABULARY).tolist())
    for d, texts in by_id.items():
        assert sum(len(ids) for _, ids in back[d]) == sum(map(len, texts))
        if len(texts) == 1:
            assert [x for _, ids in sorted(back[d]) for x in ids] == texts[0]
    assert token_matrix.token_matrix(empty).count() == 0


def test_packing_edges(edge, edge_rows, empty):
    rows = packing.pack_documents(edge).collect()
    assert sum(r.length for r in rows) == sum(len(encode(t, VOCABULARY)) for _, t, *_ in edge_rows)
    assert packing.pack_documents(empty).count() == 0


def test_written_matrices(spark, edge, tmp_path):
    matrix = token_matrix.token_matrix(edge)
    token_matrix.write_matrices(matrix, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == matrix.count()


if __name__ == "__main__":
    pytest.main([__file__])


def test_binary_rows(edge):
    matrix = token_matrix.token_matrix(edge, row=64)
    want = {r.row_id: r for r in matrix.collect()}
    got = token_matrix.binary_rows(matrix).collect()
    assert len(got) == len(want) > 0 and token_matrix.binary_rows(matrix.limit(0)).count() == 0
    for r in got:
        assert len(r.input_ids) == len(r.position_ids) == 4 * 64 and r.n_tokens == want[r.row_id].n_tokens and r.doc_ids == want[r.row_id].doc_ids
        for name in ("input_ids", "position_ids", "cu_seqlens"):
            assert np.frombuffer(r[name], "<u4").tolist() == want[r.row_id][name]
