"""A log of versions: small JSON files that say what of a folder counts, through the folder's own file system.

A change writes the next number. A number that is there can't be written again, so of two writers that start from the
same version one fails and leaves no trace; readers see a version whole or not at all.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class VersionLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def fs(self, path: str):
        """(file system, path) as Hadoop has them."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def names(self, path: str) -> list[str]:
        fs, p = self.fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self.fs(path)
        fs.delete(p, True)

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self.names(self.path) if n.isdigit())

    def at(self, number: int):
        return json.loads(self.spark.read.text(f"{self.path}/{number:012d}", wholetext=True).first()[0])

    def newest(self, empty):
        """(number, content) of the newest version; (0, ``empty``) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.at(numbers[-1])) if numbers else (0, empty)

    def commit(self, number: int, content) -> None:
        """Make ``content`` the version after ``number``: written under a name of its own, then renamed. RuntimeError if another
        writer has made that version meanwhile."""
        fs, draft = self.fs(f"{self.path}/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        final = self.fs(f"{self.path}/{number + 1:012d}")[1]
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"{self.path} was changed by another writer; run again")
