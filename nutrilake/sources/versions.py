"""Versioned artifacts (K1, M11): a version is written whole, then committed.

Below the store's path:

    versions/<random name>/       what the writer wrote
    manifests/<20-digit number>   one line of JSON: the folder and a note

A version exists when its manifest does, and a manifest appears by one rename
that never replaces another file.  So a write that breaks half-way leaves the
version before it in force, readers need no lock, and of two writers that want
the same number one takes the next.  A reader resolves its folder once and
keeps it: later versions go to other folders.

The rename is atomic on HDFS and local file systems.  On an object store
without an atomic rename, one writer at a time must publish.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class VersionedStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._fs.makeQualified(self._hadoop.Path("/".join([self.path, *parts])))

    def publish(self, write: Callable[[str], object], note: str = "") -> int:
        """Call ``write(folder)`` on a new folder and commit it; returns the
        version's number, from 1.  What ``write`` raises is raised here, and
        nothing is committed."""
        name = uuid.uuid4().hex
        write(f"{self.path}/versions/{name}")
        if not self._fs.exists(self._at("versions", name)):
            raise ValueError("the writer left no version folder")
        return self._commit(name, note)

    def _commit(self, folder: str, note: str) -> int:
        draft = self._at("drafts", uuid.uuid4().hex)
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps({"folder": folder, "note": note}).encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        self._fs.mkdirs(self._at("manifests"))
        number = max(self.numbers(), default=0) + 1
        while True:
            try:
                context.rename(draft, self._at("manifests", f"{number:020d}"), options)
                return number
            except Py4JJavaError as exc:
                if "FileAlreadyExistsException" not in exc.java_exception.getClass().getName():
                    raise
                number += 1     # another writer took it

    def numbers(self) -> list[int]:
        """Numbers of the committed versions, rising."""
        folder = self._at("manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, number: int) -> dict:
        path = self._at("manifests", f"{number:020d}")
        if not self._fs.exists(path):
            raise FileNotFoundError(f"{self.path} has no version {number}")
        return json.loads("".join(r[0] for r in self.spark.read.text(path.toString()).collect()))

    def folder(self, number: int | None = None) -> str:
        """The folder of a version, by default the newest."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                raise FileNotFoundError(f"{self.path} has no committed version")
            number = numbers[-1]
        return f"{self.path}/versions/{self.manifest(number)['folder']}"

    def history(self) -> DataFrame:
        """(version, folder, note, is_current), one row per committed version."""
        numbers = self.numbers()
        rows = [(n, m["folder"], m["note"], n == numbers[-1]) for n, m in ((n, self.manifest(n)) for n in numbers)]
        return self.spark.createDataFrame(rows, "version long, folder string, note string, is_current boolean")

    def rollback(self, number: int) -> int:
        """Commit an earlier version's folder again, as the newest version."""
        return self._commit(self.manifest(number)["folder"], f"rollback to {number}")


def published_folder(spark: SparkSession, path: str) -> str:
    """The newest version's folder where ``path`` is a versioned store, else ``path``."""
    store = VersionedStore(spark, path)
    return store.folder() if store.numbers() else path
