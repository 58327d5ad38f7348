"""Tables in hash buckets of a key, with a manifest for each version.

A version names, for each table and bucket, the version whose files hold it.  An
upsert reads and writes only the buckets that its keys fall into; the manifest is
written last and makes the version whole, so a run that dies leaves the version
before it in force.  Buckets that no kept manifest names are removed.

Layout under a root: ``data/v<version>/<table>/bucket=<k>`` and
``manifests/v<version>.json``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _write(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name, then renamed."""
    fs, where = _fs(spark, path)
    _, part = _fs(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    if not fs.rename(part, where):
        raise OSError(f"{path} could not be written")


def _read(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


@dataclass
class Manifest:
    version: int
    buckets: int
    held: dict[str, dict[str, int]] = field(default_factory=dict)  # table: bucket: version of its files
    schemas: dict[str, dict] = field(default_factory=dict)


class Bucketed:
    """Tables that share a key and its buckets, under one root."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 256, keep: int = 2):
        self.spark, self.root, self.key, self.buckets, self.keep = spark, root.rstrip("/"), key, buckets, keep

    def bucket(self, column: str | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(column or self.key)), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in listed(self.spark, f"{self.root}/manifests") if n[:1] == "v" and n.endswith(".json"))

    def manifest(self, below: int | None = None) -> Manifest | None:
        """That of the last whole version, or of the last one under ``below``."""
        found = [v for v in self.versions() if below is None or v < below]
        if not found:
            return None
        out = Manifest(**json.loads(_read(self.spark, f"{self.root}/manifests/v{found[-1]:06d}.json")))
        if out.buckets != self.buckets:
            raise ValueError(f"{self.root} has {out.buckets} buckets")
        return out

    def _path(self, version: int, table: str) -> str:
        return f"{self.root}/data/v{version:06d}/{table}"

    def read(self, table: str, manifest: Manifest, only: Iterable[int] | None = None) -> DataFrame:
        """A table as of a manifest, or those of its buckets that are asked for."""
        schema = StructType.fromJson(manifest.schemas[table])
        wanted = None if only is None else set(only)
        of: dict[int, list[int]] = {}
        for k, version in manifest.held[table].items():
            if wanted is None or int(k) in wanted:
                of.setdefault(version, []).append(int(k))
        out = None
        for version, own in sorted(of.items()):
            paths = [f"{self._path(version, table)}/bucket={k}" for k in own]
            one = self.spark.read.schema(schema).parquet(*paths)
            out = one if out is None else out.unionByName(one)
        return self.spark.createDataFrame([], schema) if out is None else out

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys; at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def commit(self, version: int, tables: dict[str, DataFrame], touched: Iterable[int], base: Manifest | None) -> Manifest:
        """Write the new rows of the touched buckets of each table, then the manifest; drop what no kept version needs."""
        touched = set(touched)
        new = Manifest(version, self.buckets)
        for table, rows in tables.items():
            path = self._path(version, table)
            parts = rows.withColumn("bucket", self.bucket())
            parts.repartition(max(1, min(len(touched), self.buckets)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
            written = {n.split("=")[1] for n in listed(self.spark, path) if n.startswith("bucket=")}
            kept = {k: v for k, v in (base.held[table] if base else {}).items() if int(k) not in touched}
            new.held[table] = kept | dict.fromkeys(sorted(written), version)
            new.schemas[table] = rows.schema.jsonValue()
        _write(self.spark, f"{self.root}/manifests/v{version:06d}.json", json.dumps(vars(new)))
        self.clean()
        return new

    def clean(self) -> None:
        """Keep the last ``keep`` versions; remove other manifests, then folders that no kept one names."""
        versions = self.versions()
        kept = versions[-self.keep :]
        named: set[tuple[int, str, str]] = set()
        for v in kept:
            one = Manifest(**json.loads(_read(self.spark, f"{self.root}/manifests/v{v:06d}.json")))
            named |= {(version, table, k) for table, held in one.held.items() for k, version in held.items()}
        for v in versions[: -self.keep]:
            fs, where = _fs(self.spark, f"{self.root}/manifests/v{v:06d}.json")
            fs.delete(where, False)
        for folder in listed(self.spark, f"{self.root}/data"):
            version = int(folder[1:])
            if version > kept[-1]:
                continue  # of a run that has not come to its manifest
            for table in listed(self.spark, f"{self.root}/data/{folder}"):
                for part in listed(self.spark, f"{self.root}/data/{folder}/{table}"):
                    if part.startswith("bucket=") and (version, table, part.split("=")[1]) not in named:
                        fs, where = _fs(self.spark, f"{self.root}/data/{folder}/{table}/{part}")
                        fs.delete(where, True)
            if not any(v == version for v, _, _ in named) and version not in kept:
                fs, where = _fs(self.spark, f"{self.root}/data/{folder}")
                fs.delete(where, True)
