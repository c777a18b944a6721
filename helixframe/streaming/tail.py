"""Log tailing as a stream with a byte offset for each file, and event windows with late data."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a file that one task reads, that a task holds at a time, and that a look for a line's end takes.
RANGE_BYTES, READ_BYTES, LOOK_BYTES = 64 << 20, 1 << 20, 1 << 16
LINES_A_BATCH = 4096


@dataclass
class Span(InputPartition):
    """The lines of a file that start at bytes first to until - 1."""

    file: str
    first: int
    until: int
    start: int


def _filesystem(path: str) -> tuple:
    """The store of a path or URI as pyarrow sees it, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def lines_from(source, first: int, until: int, start: int = 0) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines that start at bytes first to until - 1 of an open file, whose lines begin at `start`."""
    at, held = first, b""
    if first > start:  # the byte before tells whether a line starts here; what does not is the range before's
        source.seek(first - 1)
        while chunk := source.read(LOOK_BYTES):
            if (end := chunk.find(b"\n")) >= 0:
                at += end
                break
            at += len(chunk)
        else:
            return
    source.seek(at)
    while at < until:
        chunk = source.read(READ_BYTES)
        if not chunk:
            return
        *whole, held = (held + chunk).split(b"\n")
        for line in whole:
            if at >= until:
                return
            yield at, line
            at += len(line) + 1


class TailReader(DataSourceStreamReader):
    """Offsets are {file: {"at": the byte behind the last whole line, "first": a checksum of the first line}}.

    A file that got shorter, or whose first line is another one, was truncated or replaced and is read from its start.
    A line without its line feed waits until it has one.
    """

    def __init__(self, folder: str, from_end: bool):
        self.folder, self.from_end = folder, from_end

    def initialOffset(self) -> dict:  # noqa: N802
        return self.latestOffset() if self.from_end else {"files": "{}"}

    def latestOffset(self) -> dict:  # noqa: N802
        import json

        from pyarrow import fs

        store, root = _filesystem(self.folder)
        files = {}
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True)), key=lambda f: f.path):
            name = info.path.rsplit("/", 1)[-1]
            if info.type == fs.FileType.File and not name.startswith((".", "_")):
                with store.open_input_file(info.path) as source:
                    if at := _last_line_end(source, info.size):
                        files[name] = {"at": at, "first": _first_line(source)}
        return {"files": json.dumps(files)}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        import json

        before, spans = json.loads(start["files"]), []
        for name, now in json.loads(end["files"]).items():
            was = before.get(name)
            first = was["at"] if was and was["first"] == now["first"] and was["at"] <= now["at"] else 0
            spans += [Span(f"{self.folder.rstrip('/')}/{name}", a, min(a + RANGE_BYTES, now["at"]), first) for a in range(first, now["at"], RANGE_BYTES)]
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(partition.file)
        name, rows = path.rsplit("/", 1)[-1], []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array([at for at, _ in rows]), pa.array([line.decode(errors="replace").rstrip("\r") for _, line in rows])], names=["file", "at", "value"])
        with store.open_input_file(path) as source:
            for row in lines_from(source, partition.first, partition.until, partition.start):
                rows.append(row)
                if len(rows) == LINES_A_BATCH:
                    yield batch()
                    rows = []
        if rows:
            yield batch()


def _last_line_end(source, size: int) -> int:
    """The byte behind the last line feed of an open file; 0 without any."""
    while size > 0:
        begin = max(0, size - LOOK_BYTES)
        source.seek(begin)
        if (end := source.read(size - begin).rfind(b"\n")) >= 0:
            return begin + end + 1
        size = begin
    return 0


def _first_line(source) -> int:
    """Checksum of the first line of an open file."""
    source.seek(0)
    check = 0
    while chunk := source.read(LOOK_BYTES):
        end = chunk.find(b"\n")
        check = zlib.crc32(chunk if end < 0 else chunk[:end], check)
        if end >= 0:
            break
    return check


class LogTail(DataSource):
    """spark.readStream.format("log_tail").load(folder): lines of the folder's files as they are appended, each once."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "file string, at long, value string"

    def streamReader(self, schema) -> TailReader:  # noqa: N802
        return TailReader(self.options["path"], self.options.get("fromEnd", "false").lower() == "true")


def tail(spark: SparkSession, folder: str, from_end: bool = False) -> DataFrame:
    """STR1: lines of log files as they are appended, as events (file, at, data); blank lines are left out.

    from_end starts behind the lines that are there. Files are read where their writers put them: a store that pyarrow
    reaches. A query that restarts goes on at the offsets of its checkpoint.
    """
    spark.dataSource.register(LogTail)
    lines = spark.readStream.format("log_tail").option("fromEnd", str(from_end)).load(folder)
    return lines.where(F.trim("value") != "").select("file", "at", F.concat(F.lit("data: "), F.col("value"), F.lit("\n\n")).alias("data"))


def event_counts(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events by kind and window; works on streams and on tables."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if events.isStreaming else rows
    return rows.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
