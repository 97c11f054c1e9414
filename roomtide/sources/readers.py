"""Readers for delimited text, parquet, snapshots and JDBC tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roomtide.model import text_layout


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "#") -> DataFrame:
    """Header-less text with a fixed column order; a bad row fails the read.

    Empty fields become NULL, blank lines are skipped, quotes are plain
    characters. Column pruning is off so that a short row is noticed even
    when the query does not touch its missing columns.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .option("enforceSchema", "true")
        .option("columnPruning", "false")
        .csv(path)
    )


def read_named_fields(
    spark: SparkSession, path: str, fields: list[str], keep: list[str] | None = None, sep: str = "#"
) -> DataFrame:
    """Text whose columns are known only by a configured list of names."""
    rows = read_delimited(spark, path, text_layout(fields), sep)
    return rows.select(*keep) if keep else rows


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every non-blank line of a folder, as column ``line``."""
    return spark.read.text(path).where(F.col("value") != "").withColumnRenamed("value", "line")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def snapshot_key(dt: str | date, as_of: date | None = None) -> str:
    """``yyyyMMdd`` of a snapshot; ``"now"`` is the day before ``as_of``."""
    if dt == "now":
        if as_of is None:
            raise ValueError('"now" needs as_of')
        dt = as_of - timedelta(days=1)
    return dt.strftime("%Y%m%d") if isinstance(dt, date) else dt


def dated_path(root: str, dt: str | date, as_of: date | None = None) -> str:
    """``<root>/<yyyyMMdd>``, for tables kept in one plain folder per day."""
    return f"{root.rstrip('/')}/{snapshot_key(dt, as_of)}"


def read_snapshot(
    spark: SparkSession, root: str, dt: str | date, as_of: date | None = None
) -> DataFrame:
    """One ``dt=yyyyMMdd`` snapshot of a parquet table.

    The filter is on the partition column, so other snapshots are never read.
    """
    return spark.read.parquet(root).where(F.col("dt").cast("string") == snapshot_key(dt, as_of)).drop("dt")


@dataclass(frozen=True)
class Ranges:
    """How a database table is split: a numeric, date or timestamp column, cut into equal ranges from ``lower`` to ``upper``.

    Rows outside are read too, with the first or last range.
    """

    column: str
    lower: str
    upper: str
    partitions: int


def read_jdbc(
    spark: SparkSession, url: str, table: str, user: str, password: str, split: Ranges | None, **options: str
) -> DataFrame:
    """A database table, read by one query for each range of ``split``.

    There is no default for ``split``: None says that one task is to read the
    whole table, which holds for small tables alone.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url).option("dbtable", table)
        .option("user", user).option("password", password)
        .options(**options)
    )
    if split is not None:
        if split.partitions < 2:
            raise ValueError("one range isn't a split; say None for one task")
        reader = (
            reader.option("partitionColumn", split.column)
            .option("lowerBound", split.lower).option("upperBound", split.upper)
            .option("numPartitions", split.partitions)
        )
    return reader.load()
