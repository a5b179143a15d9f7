"""Versioned folders: a run writes into a folder of its own and becomes visible by one marker.

    root/versions/<name>/<table>/…   what one run wrote, in the order the runs began
    root/published/<name>.json       its marker, renamed into place when all of it is there

Readers follow the markers only, so a run that stops midway changes nothing that they see.
Names are counted up; a marker also has a label (a run date, say) and its parts, the
versions whose tables together make up this one (itself alone, unless it adds to others).
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

MARKER_SCHEMA = "name string, label string, parts array<string>"


class Version(NamedTuple):
    name: str
    label: str
    parts: tuple[str, ...]


class VersionStore:
    """The versions under one root. One writer at a time; a second one's publishing fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._files(), self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def published(self) -> list[Version]:
        """All published versions in the order they began: a row per run, whatever the runs hold."""
        if not [n for n in self._names("published") if n.endswith(".json")]:
            return []
        rows = self.spark.read.schema(MARKER_SCHEMA).json(f"{self.root}/published/*.json").collect()
        return [Version(r["name"], r["label"], tuple(r["parts"])) for r in sorted(rows, key=lambda r: r["name"])]

    def current(self) -> Version | None:
        """The published version of the greatest label; of its reruns the last."""
        return max(self.published(), key=lambda v: (v.label, v.name), default=None)

    def begin(self) -> str:
        """The name of a new version; its folder is empty and nobody reads it."""
        taken = [*self._names("versions"), *[n.removesuffix(".json") for n in self._names("published")]]
        name = f"{1 + max(map(int, taken), default=0):08d}"
        self._files().mkdirs(self._path(self.folder(name)))
        return name

    def folder(self, name: str) -> str:
        return f"{self.root}/versions/{name}"

    def publish(self, name: str, label: str, parts: tuple[str, ...] | None = None) -> Version:
        """Make the version visible, in one rename. Fails where a later one is published already."""
        version = Version(name, label, (name,) if parts is None else tuple(parts))
        if any(v.name >= name for v in self.published()):
            raise RuntimeError(f"version {name} of {self.root}: another run has been published since this one began")
        fs, draft, marker = self._files(), self._path(f"{self.root}/drafts/{name}.json"), self._path(f"{self.root}/published/{name}.json")
        fs.mkdirs(marker.getParent())
        out = fs.create(draft, True)
        out.writeBytes(json.dumps({"name": name, "label": label, "parts": version.parts}))  # ASCII
        out.close()
        if not fs.rename(draft, marker):
            raise RuntimeError(f"version {name} of {self.root} could not be published")
        return version

    def _read(self, table: str, parts: list[str]) -> DataFrame:
        """One scan over the parts that have the table; a column that some lack is NULL there."""
        fs = self._files()
        paths = [p for p in (f"{self.folder(x)}/{table}" for x in parts) if fs.exists(self._path(p))]
        if not paths:
            raise FileNotFoundError(f"no published table {table} under {self.root}")
        return self.spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)

    def table(self, table: str, version: Version | None = None) -> DataFrame:
        """A table of a version (the current one), the rows of all its parts."""
        version = version or self.current()
        return self._read(table, list(version.parts) if version else [])

    def archive(self, table: str) -> DataFrame:
        """A table over all runs: of every label the last published version's rows."""
        last = {v.label: v for v in self.published()}
        return self._read(table, sorted({p for v in last.values() for p in v.parts}))

    def remove(self, name: str, table: str | None = None) -> None:
        """Delete a version's table, or its whole folder."""
        self._files().delete(self._path(self.folder(name) + (f"/{table}" if table else "")), True)

    def vacuum(self, tables: tuple[str, ...], keep: int = 2) -> list[str]:
        """Delete folders of runs that stopped before publishing, and `tables` of versions that none
        of the `keep` newest needs. Returns the names of the stopped runs."""
        done = self.published()
        if not done:
            return []
        newest = sorted(done, key=lambda v: (v.label, v.name))[-keep:]
        needed = {p for v in newest for p in v.parts}
        for v in done:
            if v.name not in needed:
                for t in tables:
                    self.remove(v.name, t)
        stopped = [n for n in self._names("versions") if n < done[-1].name and n not in {p for v in done for p in (v.name, *v.parts)}]
        for n in stopped:
            self.remove(n)
        return stopped

