import io

import pytest

from helixframe.streaming import tail


def follow(spark, folder, out, checkpoint, from_end=False):
    """Run the tail until it has read all, and stop it."""
    query = tail.tail(spark, str(folder), from_end).writeStream.format("parquet").option("checkpointLocation", str(checkpoint)).start(str(out))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sorted((r.file, r.at, r.data.removeprefix("data: ").removesuffix("\n\n")) for r in spark.read.parquet(str(out)).collect())


def test_appended_lines_come_once_each(spark, tmp_path):
    """Lines, appended lines, a line in two writes, new files, restarts from the offset, truncated and replaced files."""
    logs, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    logs.mkdir()

    def write(name, text, mode="a"):
        with (logs / name).open(mode) as f:
            f.write(text)

    write("a.log", "one\ntwo\n\nthr")
    want = [("a.log", 0, "one"), ("a.log", 4, "two")]
    assert follow(spark, logs, out, checkpoint) == want
    write("a.log", "ee\nfour\r\n")
    write("b.log", "five\n")
    write(".hidden", "no\n")
    want += [("a.log", 9, "three"), ("a.log", 15, "four"), ("b.log", 0, "five")]
    assert follow(spark, logs, out, checkpoint) == sorted(want)
    assert follow(spark, logs, out, checkpoint) == sorted(want)  # nothing new
    write("a.log", "one\n", "w")  # shorter, with the same first line
    want += [("a.log", 0, "one")]
    assert follow(spark, logs, out, checkpoint) == sorted(want)
    write("b.log", "replaced by a longer one\nsix\n", "w")
    want += [("b.log", 0, "replaced by a longer one"), ("b.log", 25, "six")]
    assert follow(spark, logs, out, checkpoint) == sorted(want)


def test_tail_of_a_running_query(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.log").write_text("old\n")
    query = tail.tail(spark, str(tmp_path / "in"), from_end=True).writeStream.format("memory").queryName("tailed").start()
    try:
        query.processAllAvailable()
        for i in range(3):
            with (tmp_path / "in/a.log").open("a") as f:
                f.write(f"line {i}\n")
            query.processAllAvailable()
        assert sorted(r.data for r in spark.sql("SELECT * FROM tailed").collect()) == [f"data: line {i}\n\n" for i in range(3)]
    finally:
        query.stop()


@pytest.mark.parametrize("width", [1, 2, 3, 7, 100])
def test_every_line_is_in_one_range(width, monkeypatch):
    monkeypatch.setattr(tail, "READ_BYTES", 5)
    monkeypatch.setattr(tail, "LOOK_BYTES", 3)
    text = b"first\n\nsome longer line\nx\n\nlast\npart"
    size = text.rfind(b"\n") + 1
    assert tail._last_line_end(io.BytesIO(text), len(text)) == size and tail._last_line_end(io.BytesIO(b"none"), 4) == 0
    for start in (0, 6, 7, 24):
        found = [x for a in range(start, size, width) for x in tail.lines_from(io.BytesIO(text), a, min(a + width, size), start)]
        assert b"".join(line + b"\n" for _, line in found) == text[start:size]
        assert all(text[at : at + len(line)] == line for at, line in found)


def test_event_counts_on_a_stream_equal_those_on_a_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    want = {(r.start, r.event_type): r.n for r in tail.event_counts(table).collect()}
    stream = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    query = tail.event_counts(stream).writeStream.format("memory").outputMode("complete").queryName("counted").start()
    try:
        query.processAllAvailable()
        assert {(r.start, r.event_type): r.n for r in spark.sql("SELECT * FROM counted").collect()} == want
    finally:
        query.stop()
