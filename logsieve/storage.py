"""Which folders make up a set of tables: one published list, replaced as a whole.

A commit writes a new version of the list and publishes it by a rename, so a reader sees all folders of a commit or
none of them, and one that holds an older version keeps its files until `vacuum` removes what no recent version names.
Writers put their folders down first and commit them last; folders that no version names are invisible. There is one
writer at a time: a commit that finds its version taken fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class FolderLog:
    """Entries by key: {"path": folder, and what the writer adds, such as "rows" and "schema"}."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---------------------------------------------------------- files

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p, fs = self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def put(self, path: str, text: str) -> None:
        """A small file, whole or not there."""
        draft, fs = self._path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target, _ = self._path(path)
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise FileExistsError(path)

    def _text(self, path: str) -> str:
        p, fs = self._path(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # ---------------------------------------------------------- versions

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(f"{self.root}/_log") if n.startswith("v") and n.endswith(".json"))

    def current(self, version: int | None = None) -> dict[str, dict]:
        """The entries of a version (default: the latest; none yet: no entries)."""
        have = self.versions() if version is None else [version]
        return json.loads(self._text(f"{self.root}/_log/v{have[-1]:012}.json")) if have else {}

    def commit(self, add: dict[str, dict], drop=()) -> int:
        """Publishes the entries with some added or replaced and some dropped."""
        have = self.versions()
        entries = {k: v for k, v in self.current().items() if k not in set(drop)} | add
        version = (have[-1] if have else 0) + 1
        self.put(f"{self.root}/_log/v{version:012}.json", json.dumps(entries))
        return version

    def vacuum(self, keep: int = 10) -> list[str]:
        """Removes all but the last `keep` versions and the folders that only removed versions name."""
        have = self.versions()
        kept = {e["path"] for v in have[-keep:] for e in self.current(v).values()}
        gone = {e["path"] for v in have[:-keep] for e in self.current(v).values()} - kept
        for path in sorted(gone):
            p, fs = self._path(path)
            fs.delete(p, True)
        self.vacuum_list(keep)
        return sorted(gone)

    def vacuum_list(self, keep: int = 10) -> None:
        """Removes all but the last `keep` versions of the list, and no folder."""
        for v in self.versions()[:-keep]:
            p, fs = self._path(f"{self.root}/_log/v{v:012}.json")
            fs.delete(p, False)

    # ---------------------------------------------------------- rows

    def folder(self, name: str) -> str:
        """A new folder for rows of a table."""
        return f"{self.root}/{name}/{uuid.uuid4().hex}"

    def read(self, entries: list[dict], fmt: str = "parquet") -> DataFrame | None:
        """The rows of some entries, which have one schema; None where there are no entries."""
        if not entries:
            return None
        schema = StructType.fromJson(json.loads(entries[-1]["schema"]))
        return self.spark.read.format(fmt).schema(schema).load([e["path"] for e in entries])
