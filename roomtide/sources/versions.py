"""Versioned table sets: buckets of hotels, and a manifest that makes a version visible.

Layout below ``root``::

    data/<version>/<run>/name=<table>/bucket=<n>/part-*.parquet    htl_cd, line; sorted by htl_cd
    _manifests/<version>/<number>.json                             run, buckets, tables, rows

The number of files depends on the tables, the buckets and the data, not on
the number of hotels: a hotel's rows are in the bucket its code hashes to, so
its reader lists one folder per table and skips row groups by their minimum
and maximum. A hotel with far more rows than others has its bucket's files
split by AQE.

Every publication writes a run of its own and then its manifest, in one
rename. Readers go by the newest manifest: they see the whole version before
or the whole version after, and a job that fails leaves the old one in place.
``prune`` removes runs that no newest manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 16
SCHEMA = "htl_cd string, line string, name string, bucket int"


class _Folder:
    """The few file operations that a manifest needs, on whatever file system ``path`` is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path)) if self.fs.exists(self.path) else []

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def put(self, name: str, text: str) -> bool:
        """A new whole file under this name; false if there is one already."""
        aside = self.child(f".{uuid.uuid4().hex}")
        out = self.fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(self.child(name)) or not self.fs.rename(aside, self.child(name)):
            self.fs.delete(aside, False)
            return False
        return True

    def text(self, name: str) -> str:
        stream = self.fs.open(self.child(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.child(name), True)


def bucket_of(htl_cd: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(htl_cd) if isinstance(htl_cd, str) else htl_cd), F.lit(buckets)).cast("int")


def _manifests(spark: SparkSession, root: str, version: str) -> _Folder:
    return _Folder(spark, f"{root.rstrip('/')}/_manifests/{version}")


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(n[:-5]) for n in folder.names() if n.endswith(".json") and not n.startswith("."))


def versions(spark: SparkSession, root: str) -> list[str]:
    """The versions that can be read."""
    return [v for v in _Folder(spark, f"{root.rstrip('/')}/_manifests").names() if _numbers(_manifests(spark, root, v))]


def manifest(spark: SparkSession, root: str, version: str) -> dict:
    """The newest manifest of a version."""
    folder = _manifests(spark, root, version)
    numbers = _numbers(folder)
    if not numbers:
        raise ValueError(f"no version {version} in {root}")
    return json.loads(folder.text(f"{numbers[-1]}.json"))


def publish_version(tables: DataFrame, root: str, version: str, buckets: int = BUCKETS) -> dict:
    """Write (htl_cd, name, line) rows as a new run of ``version`` and make it the one that is read.

    A null hotel or name is an error: no reader could ask for it. Two jobs
    that publish at once both succeed, the later manifest counts.
    """
    spark = tables.sparkSession
    run = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/data/{version}/{run}"
    named = tables.select(*[F.coalesce(F.col(c).cast("string"), F.raise_error(F.lit(f"a published row has no {c}"))).alias(c) for c in ("htl_cd", "name")], "line")
    rows = named.withColumn("bucket", bucket_of("htl_cd", buckets))
    (
        rows.hint("rebalance", "name", "bucket").sortWithinPartitions("name", "bucket", "htl_cd")
        .write.partitionBy("name", "bucket").parquet(path)
    )
    counts = {r.name: r.n for r in spark.read.schema(SCHEMA).parquet(path).groupBy("name").agg(F.count("*").alias("n")).collect()}
    entry = {"version": version, "run": run, "buckets": buckets, "rows": counts}
    folder = _manifests(spark, root, version)
    folder.fs.mkdirs(folder.path)
    while not folder.put(f"{([0, *_numbers(folder)])[-1] + 1}.json", json.dumps(entry, sort_keys=True)):
        pass
    return entry


def read_version(spark: SparkSession, root: str, version: str, name: str | None = None, hotel: str | None = None) -> DataFrame:
    """(version, htl_cd, name, line) of a version: all of it, one table, or one hotel's lines.

    Table and hotel are partition filters; the hotel is also a filter on the sorted files.
    """
    entry = manifest(spark, root, version)
    rows = spark.read.schema(SCHEMA).parquet(f"{root.rstrip('/')}/data/{version}/{entry['run']}")
    if name is not None:
        rows = rows.where(F.col("name") == name)
    if hotel is not None:
        bucket = spark.range(1).select(bucket_of(F.lit(hotel), entry["buckets"])).first()[0]
        rows = rows.where((F.col("bucket") == bucket) & (F.col("htl_cd") == hotel))
    return rows.select(F.lit(version).alias("version"), "htl_cd", "name", "line")


def prune(spark: SparkSession, root: str) -> list[str]:
    """Remove the runs and manifests that newer ones have replaced, and runs that failed; to be called while nothing publishes."""
    gone = []
    for version in _Folder(spark, f"{root.rstrip('/')}/data").names():
        folder = _manifests(spark, root, version)
        numbers = _numbers(folder)
        kept = manifest(spark, root, version)["run"] if numbers else None
        runs = _Folder(spark, f"{root.rstrip('/')}/data/{version}")
        for run in runs.names():
            if run != kept:
                runs.remove(run)
                gone.append(run)
        for number in numbers[:-1]:
            folder.remove(f"{number}.json")
    return gone
