"""The pipeline's stages on their own inputs, against brute force, and on edge cases."""

import pytest
from pyspark.sql import functions as F
from test_native import brute_dedup
from test_near_dedup import brute

import corpus_pipeline as pipeline
from helixframe.llm.tokens import default_vocabulary, encode


@pytest.fixture(scope="module")
def outputs(spark, sf_dir, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out.append(docs)
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(folder / str(k)))
        docs = spark.read.parquet(str(folder / str(k)))
        out.append(docs)
    return out


def test_columns(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[1:-1])


def test_quality_keeps_clean_documents(spark, sf_dir, outputs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    long = outputs[0].join(labels, "doc_id", "left_semi").where("size(split(trim(text), '\\\\s+')) >= 20")
    assert long.join(outputs[1], "doc_id", "left_semi").count() >= 0.97 * long.count()
    assert outputs[1].count() < outputs[0].count()


def test_line_dedup_equals_brute_force(outputs):
    want = brute_dedup([(r.doc_id, r.text) for r in outputs[1].collect()])
    got = {r.doc_id: (r.text, r.n_chars) for r in outputs[2].collect()}
    assert got == {d: (t, len(t)) for d, t in want.items()}


def test_near_dedup_equals_brute_force(outputs):
    groups = brute([(r.doc_id, r.text) for r in outputs[2].collect()], pipeline.NEAR_PERCENT)
    assert sorted(r.doc_id for r in outputs[3].collect()) == sorted(d for d, (_, c) in groups.items() if d == c)


def test_mixing_keeps_every_document(outputs):
    assert outputs[3].exceptAll(outputs[4]).count() == outputs[4].exceptAll(outputs[3]).count() == 0


def test_packing_covers_what_is_left(outputs):
    vocabulary = default_vocabulary()
    total = sum(len(encode(r.text, vocabulary)) for r in outputs[4].collect())
    assert sum(r.length for r in outputs[5].collect()) == total


def test_run_gives_the_stages_documents(spark, sf_dir, outputs):
    pieces = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.where("start = 0").collect())
    assert pieces(pipeline.run(spark, sf_dir)) == pieces(outputs[-1])


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_edges(spark, sf_dir, edge, empty, edge_rows, name):
    stage = dict(pipeline.STAGES)[name]
    assert stage(spark, empty, sf_dir).count() == 0
    out = stage(spark, edge, sf_dir)
    if name != "packing":
        assert out.columns == edge.columns
    expected = {"quality_rules": 0, "line_dedup": len(edge_rows), "mixing": len(edge_rows)}
    if name in expected:
        assert out.count() == expected[name]
    if name == "near_dedup":  # one of the two rows of document 1, not its equal 6; rows without an id stay
        ids = [r.doc_id for r in out.collect()]
        assert ids.count(1) == 1 and 6 not in ids and ids.count(None) == 2 and len(ids) == len(edge_rows) - 2


def test_near_dedup_loses_no_text(spark, sf_dir):
    """Rows with one doc_id and other texts are no copies; the same rows stay however they are dealt out."""
    text = lambda seed: " ".join(f"w{seed}x{i}" for i in range(40))
    rows = [(1, text(1), "en"), (1, text(2), "en"), (1, text(2), "de"), (2, text(1) + " more", "en"), (3, text(3), "en"), (3, text(3), "en"), (4, text(3), "en"), (5, text(4), "en"), (6, text(5), "en"), (6, text(4), "en"), (None, text(4), "en"), (1 << 62, text(6), "en"), ((1 << 62) + 1, text(6), "en"), (9, "", "en"), (9, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", F.lit("clash"))
    got = [sorted(map(tuple, pipeline.near_dedup(spark, docs.repartition(n, "text", "lang"), sf_dir).drop("row").collect()), key=str) for n in (1, 7)]
    assert got[0] == got[1]
    kept = [(d, t) for d, t, _ in got[0]]
    # text 1: id 2 is its document's alone; text 2: one of the two rows of id 1; text 4: id 5; text 6: one of two
    assert sorted((x for x in kept if x[1]), key=str) == sorted([(1, text(2)), (2, text(1) + " more"), (3, text(3)), (5, text(4)), (6, text(5)), (None, text(4)), (1 << 62, text(6))], key=str)
    assert sum(not t for _, t in kept) == 2
    without = [(i, t, "en") for i, t in enumerate([text(1), text(1), text(2), None, ""])]
    plain = pipeline.near_dedup(spark, spark.createDataFrame(without, "doc_id long, text string, lang string"), sf_dir)
    assert sorted(r.doc_id for r in plain.collect()) == [0, 2, 3, 4]
