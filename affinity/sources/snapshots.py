"""Versioned Parquet tables: a write is seen whole or not at all.

    path/data/v=<id>/[day=2024-01-01/]*.parquet    files of one write, never changed
    path/manifest/<number>.json                    the folders that make up the table

A write adds folders under a new id and then one manifest, by a rename.  Until
that rename readers resolve the previous manifest, so a write that fails, at any point, leaves
the table as it was.  A partitioned write replaces the partitions in its
batch and keeps the others.  Two writers at once: the rename of the second
fails, as its manifest number is taken.

Folders that no kept manifest names are removed after a successful write;
``keep`` manifests stay, so a reader that resolved the previous one can finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Manifests kept, the newest included.
KEEP = 2


class _Folder:
    """Files under ``path``, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, pattern: str) -> list[str]:
        """Paths below the root that match, relative to it."""
        root = self.fs.makeQualified(self._path("")).toString().rstrip("/") + "/"
        found = self.fs.globStatus(self._path(pattern)) or []
        return sorted(s.getPath().toString().removeprefix(root) for s in found)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file that must not exist yet; it appears complete."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self.fs.create(self._path(part), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(self._path(part), self._path(name)):
            self.fs.delete(self._path(part), False)
            raise FileExistsError(f"{self.root}/{name}: another write came first")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _manifests(folder: _Folder) -> list[str]:
    return folder.names("manifest/*.json")


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest of a table, None where there is none.

    parts: partition ("" if the table has none) -> its folders; done: marks of finished work;
    note: what the last writer that gave one wants to remember; schema.
    """
    folder = _Folder(spark, path)
    names = _manifests(folder)
    return json.loads(folder.read(names[-1])) if names else None


def publish(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite",
            done: tuple[str, ...] = (), keep: int = KEEP, covers: tuple[str, ...] = (), note: dict | None = None) -> None:
    """Make ``df`` the table at ``path``, or the partitions it holds.

    ``mode="append"`` adds to what is there.  ``done`` marks are added to the
    manifest with the rows they stand for (see ``etl_backfill``).  ``covers`` names
    partitions (``day=2024-01-31``) replaced even where ``df`` has no row of them;
    ``note`` becomes the manifest's note, which is kept where none is given.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode}")
    spark = df.sparkSession
    folder = _Folder(spark, path)
    old = manifest(spark, path) or {"number": 0, "parts": {}, "done": []}
    version = f"v={uuid.uuid4().hex}"
    if partition is not None:
        # AQE cuts each partition value into evenly sized tasks (a large day is split,
        # small ones merged), so each value gets a few well-sized files.
        df = df.hint("rebalance", partition)
    w = df.write.partitionBy(partition) if partition else df.write
    w.parquet(f"{path}/data/{version}")
    new = [n.split("/")[-1] for n in folder.names(f"data/{version}/{partition}=*")] if partition else [""]
    parts = {p: vs for p, vs in old["parts"].items() if p not in covers}
    for p in new:
        parts[p] = (parts.get(p, []) if mode == "append" else []) + [version]
    number = old["number"] + 1
    folder.create(f"manifest/{number:09d}.json", json.dumps(
        {"number": number, "partition": partition, "parts": parts, "done": sorted({*old["done"], *done}),
         "note": old.get("note") if note is None else note, "schema": df.schema.jsonValue()}))
    _tidy(folder, keep)


def _tidy(folder: _Folder, keep: int) -> None:
    names = _manifests(folder)
    kept, gone = names[-keep:], names[:-keep]

    def folders(names: list[str]) -> set[str]:
        tables = [json.loads(folder.read(n))["parts"] for n in names]
        return {f"data/{v}/{p}".rstrip("/") for t in tables for p, vs in t.items() for v in vs}

    # only what a dropped manifest named: another write's folders are not ours
    for name in folders(gone) - folders(kept):
        folder.delete(name)
    for name in gone:
        folder.delete(name)


def read(spark: SparkSession, path: str, parts: Collection[str] | None = None) -> DataFrame:
    """The table at ``path`` by its newest manifest; a plain Parquet folder without one.

    Given ``parts`` (of a table with a manifest), only the folders of those partitions are listed and read.
    """
    m = manifest(spark, path)
    if m is None:
        return spark.read.parquet(path)
    schema = StructType.fromJson(m["schema"])
    files = [f"{path}/data/{v}/{p}".rstrip("/") for p, vs in sorted(m["parts"].items())
             if parts is None or p in parts for v in vs]
    if not files:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(StructType(schema.fields).add("v", "string")).option("basePath", f"{path}/data").parquet(*files)
    return df.select(*schema.names)
