"""A table in versions: each is written whole to a folder of its own, and becomes the current one when its manifest appears.

Manifests are numbered. A writer's manifest takes the number after the version that it has read, by a rename that fails where that
number is taken; so of two writers that read one version the second finds out, and makes its change again upon what the
first wrote. A writer that dies at any point leaves the current version as it is, and a folder that ``clean`` takes away. The
rename has to be atomic, as it is on HDFS and within a local folder; object stores need a file system that makes it so.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has added a version meanwhile."""


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._place("").getFileSystem(self._conf)

    def _place(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self) -> list[str]:
        return [f.getPath().getName() for f in self._files.listStatus(self._place(""))] if self._files.exists(self._place("")) else []

    def numbers(self) -> list[int]:
        return sorted(int(m[1]) for m in (re.fullmatch(r"manifest-(\d+)", n) for n in self._names()) if m)

    def folder(self, number: int) -> str:
        """Where the data of a version lie, by its manifest."""
        stream = self._files.open(self._place(f"manifest-{number}"))
        try:
            return bytes(stream.readNBytes(1 << 16)).decode()
        finally:
            stream.close()

    def read(self, number: int | None = None) -> DataFrame | None:
        """A version, the current one by default; null where there is none."""
        known = self.numbers()
        return self.spark.read.parquet(f"{self.path}/{self.folder(known[-1] if number is None else number)}") if known else None

    def commit(self, df: DataFrame, after: int) -> int:
        """Write ``df`` as the version after number ``after`` (0: the first); ``Conflict`` where there is one already."""
        name, number = f"data-{uuid.uuid4().hex}", after + 1
        df.write.parquet(f"{self.path}/{name}")
        self._publish(name, number)
        return number

    def _publish(self, name: str, number: int) -> None:
        aside = self._place(f".{name}")
        out = self._files.create(aside, False)
        out.write(bytearray(name.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._hadoop.FileContext.getFileContext(aside.toUri() if aside.toUri().getScheme() else self._files.getUri(), self._conf).rename(self._files.makeQualified(aside), self._files.makeQualified(self._place(f"manifest-{number}")), options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
            self._files.delete(aside, False)
            self._files.delete(self._place(name), True)
            raise Conflict(f"version {number} of {self.path} is there already") from None

    def update(self, change: Callable[[DataFrame | None], DataFrame], tries: int = 5) -> int:
        """Add the version that ``change`` makes of the current one (null: of none), again upon the new one where another writer
        was first, ``tries`` times at most."""
        for left in reversed(range(tries)):
            known = self.numbers()
            try:
                return self.commit(change(self.read(known[-1]) if known else None), known[-1] if known else 0)
            except Conflict:
                if not left:
                    raise
        raise ValueError("tries has to be 1 or more")

    def clean(self, keep: int = 2) -> None:
        """Take away all versions but the last ``keep``, and what writers that died have left. Not while others write."""
        known = self.numbers()
        stay = {self.folder(n) for n in known[-keep:]} | {f"manifest-{n}" for n in known[-keep:]}
        for name in self._names():
            if name not in stay and re.match(r"manifest-|\.?data-", name):
                self._files.delete(self._place(name), True)
