"""Tables of a run, published by one manifest: what a step wrote counts once the manifest names it, and not before.

A step's tables are written aside, each to a folder of its own, and a new manifest that lists them is put in place by one
rename. A crash leaves folders that nothing names. The manifest keeps, for each step, the versions of the tables that it
read, so a step is due again as soon as one of them is another one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Folder:
    """A folder in any store that Spark reaches."""

    spark: SparkSession
    root: str

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def files(self, name: str) -> list[tuple[str, int, int]]:
        """(path, size, time) of all data files below, but hidden ones and what a writer has not committed; none where there is no folder."""
        fs, out, todo = self._fs(), [], [self._path(name)]
        if not fs.exists(todo[0]):
            return []
        while todo:
            for status in fs.listStatus(todo.pop()):
                path = status.getPath()
                if not path.getName().startswith(("_", ".")):
                    if status.isDirectory():
                        todo.append(path)
                    else:
                        out.append((path.toString(), status.getLen(), status.getModificationTime()))
        return sorted(out)

    def names(self, name: str) -> list[str]:
        fs, path = self._fs(), self._path(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs().open(self._path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file or none: written aside, then renamed. An existing one stays, and that is an error."""
        fs, aside = self._fs(), self._path(f"{name}.{uuid.uuid4()}.tmp")
        stream = fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if fs.exists(self._path(name)) or not fs.rename(aside, self._path(name)):
            fs.delete(aside, False)
            raise FileExistsError(f"{self.root}/{name} was written by another run")

    def delete(self, name: str) -> None:
        self._fs().delete(self._path(name), True)


class Manifest:
    """The newest state of a run: {step: {"read": {table: version}, "wrote": {table: path}, "metrics": {table: {...}}}}."""

    COMMITS, TABLES = "_commits", "_tables"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def _numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names(self.COMMITS) if n.endswith(".json")]

    def state(self) -> dict[str, dict]:
        numbers = self._numbers()
        return json.loads(self.folder.read(f"{self.COMMITS}/{max(numbers):08d}.json")) if numbers else {}

    def publish(self, step: str, read: dict[str, str], wrote: dict[str, str], metrics: dict[str, dict]) -> None:
        state = self.state() | {step: {"read": read, "wrote": wrote, "metrics": metrics}}
        self.folder.write(f"{self.COMMITS}/{max(self._numbers(), default=0) + 1:08d}.json", json.dumps(state, indent=1))

    def aside(self, table: str) -> str:
        """A new place for a table."""
        return f"{self.TABLES}/{table}/{uuid.uuid4()}"

    def landed(self, table: str) -> str | None:
        """The version of a table that was put into the folder from outside: its files, sizes and times."""
        files = self.folder.files(table)
        return str(uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(files))) if files else None

    def table(self, path: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.root}/{path}")

    def vacuum(self) -> list[str]:
        """Delete versions and manifests that the newest manifest does not need; not while a run is going on."""
        named = {path for step in self.state().values() for path in step["wrote"].values()}
        gone = [path for table in self.folder.names(self.TABLES) for v in self.folder.names(f"{self.TABLES}/{table}") if (path := f"{self.TABLES}/{table}/{v}") not in named]
        numbers = self._numbers()
        gone += [f"{self.COMMITS}/{n:08d}.json" for n in numbers if n < max(numbers)]
        for path in gone:
            self.folder.delete(path)
        return gone
