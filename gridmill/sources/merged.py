"""A table of files that merges touch only in part.

Rows lie in buckets by a hash of their key, each bucket in files of its own. A version of
the table is a manifest: the list of its files. A merge reads and writes anew only the
buckets that incoming keys fall into; all other files keep their names and stand in the
next manifest as they are. The manifest comes last, under a name that only one writer can
make, so that readers see a version whole or not at all, and of two merges of one version
one fails. What a failed merge wrote is in no manifest and is never read.

A manifest also carries notes: a stream's batch number, or a bookmark. They are committed
together with the rows, so that a batch that is tried again is known to be done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
#: Rows of a file at most.
FILE_ROWS = 5_000_000


class Conflict(Exception):
    """Another writer has made the version that this one was about to make."""


@dataclass
class Manifest:
    version: int
    schema: T.StructType
    keys: list[str]
    buckets: int
    files: dict[int, list[str]]
    notes: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "keys": self.keys, "buckets": self.buckets, "files": self.files, "notes": self.notes})

    @classmethod
    def of(cls, text: str) -> Manifest:
        x = json.loads(text)
        return cls(x["version"], T.StructType.fromJson(x["schema"]), x["keys"], x["buckets"], {int(k): v for k, v in x["files"].items()}, x["notes"])


class MergedTable:
    """``path``/data holds the files, ``path``/versions a manifest for each version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, notes: dict[str, str] | None = None) -> MergedTable:
        """Version 0 from ``rows``, whose keys should differ."""
        table = cls(spark, path)
        table._commit(Manifest(0, rows.schema, list(keys), buckets, table._write(rows, list(keys), buckets), dict(notes or {})))
        return table

    def versions(self) -> list[int]:
        where = self._paths(f"{self.path}/versions")
        if not self._files.exists(where):
            return []
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in self._files.listStatus(where) if s.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        name = max(self.versions()) if version is None else version
        row = self.spark.read.option("wholetext", True).text(f"{self.path}/versions/{name}.json").first()
        return Manifest.of(row[0])

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        return self._rows(self.manifest(version), buckets)

    def merge(self, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], notes: dict[str, str] | None = None) -> Manifest:
        """The next version: in each bucket that ``incoming`` has keys of, what ``combine`` makes
        of the table's rows and the incoming ones. It must not move rows to other keys."""
        held = self.manifest()
        bucket = self._bucket(held.keys, held.buckets)
        touched = sorted(r[0] for r in incoming.select(bucket).distinct().collect())  # no more than there are buckets
        files = {k: v for k, v in held.files.items() if k not in touched}
        if touched:
            made = combine(self._rows(held, touched), incoming)
            files |= self._write(made.select(*held.schema.names), held.keys, held.buckets)
        following = Manifest(held.version + 1, held.schema, held.keys, held.buckets, files, held.notes | dict(notes or {}))
        self._commit(following)
        return following

    def vacuum(self, versions: int = 2) -> int:
        """Forget all versions but the last ones, then delete files that none of these names:
        also what failed merges left, so no merge may run meanwhile. Returns files deleted."""
        kept = self.versions()[-versions:]
        used = {f for v in kept for files in self.manifest(v).files.values() for f in files}
        for v in self.versions():
            if v not in kept:
                self._files.delete(self._paths(f"{self.path}/versions/{v}.json"), False)
        gone, found = 0, self._files.listFiles(self._paths(f"{self.path}/data"), True)
        while found.hasNext():
            at = found.next().getPath()
            name = at.toUri().getPath()[len(self._data()) + 1 :]
            if name.endswith(".parquet") and name not in used:
                gone += bool(self._files.delete(at, False))
        return gone

    def _data(self) -> str:
        return self._files.makeQualified(self._paths(f"{self.path}/data")).toUri().getPath()

    @staticmethod
    def _bucket(keys: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")

    def _rows(self, manifest: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        names = [f for k, files in manifest.files.items() if buckets is None or k in buckets for f in files]
        if not names:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def _write(self, rows: DataFrame, keys: list[str], buckets: int) -> dict[int, list[str]]:
        """New files of ``rows`` by bucket, in a folder of this write's own."""
        folder = uuid.uuid4().hex
        dealt = rows.withColumn("_bucket", self._bucket(keys, buckets)).repartition("_bucket").sortWithinPartitions("_bucket", *keys)
        dealt.write.partitionBy("_bucket").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{self.path}/data/{folder}")
        files: dict[int, list[str]] = {}
        found = self._files.listFiles(self._paths(f"{self.path}/data/{folder}"), True)
        while found.hasNext():
            at = found.next().getPath()
            if at.getName().endswith(".parquet") and at.getParent().getName().startswith("_bucket="):
                bucket = at.getParent().getName()
                files.setdefault(int(bucket.removeprefix("_bucket=")), []).append(f"{folder}/{bucket}/{at.getName()}")
        return {k: sorted(v) for k, v in sorted(files.items())}

    def _commit(self, manifest: Manifest) -> None:
        """Write under a name of its own, then rename to the version's: Hadoop's file systems
        refuse to rename over what is there. (A store without atomic rename needs its own.)"""
        own, final = self._paths(f"{self.path}/versions/.{uuid.uuid4().hex}"), self._paths(f"{self.path}/versions/{manifest.version}.json")
        out = self._files.create(own, False)
        try:
            out.write(bytearray(manifest.text().encode()))
        finally:
            out.close()
        if self._files.exists(final) or not self._files.rename(own, final):
            self._files.delete(own, False)
            raise Conflict(f"{self.path} has a version {manifest.version} already")
