"""Exact global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Ranges that rows are numbered in; also the number of sampled bounds.
RANGES = 256


def sampled_bounds(df: DataFrame, order_by: str, ranges: int = RANGES) -> Column:
    """Up to ``ranges`` values of ``order_by`` in rising order, as a lazy one-row subquery.

    The values are dealt by hash into ``ranges`` cells, and each cell keeps
    the one with the least hash: a uniform sample of the distinct values that
    combines on the map side and never holds more than one value per cell.
    Its order statistics are quantiles of the values, whatever they look like.
    """
    place = F.xxhash64(order_by)
    cells = df.where(F.col(order_by).isNotNull()).groupBy(F.pmod(place, F.lit(ranges)).alias("cell")).agg(F.min_by(order_by, place).alias("bound"))
    return cells.agg(F.sort_array(F.collect_list("bound")).alias("bounds")).scalar()


def range_of(value: Column, bounds: Column) -> Column:
    """How many of the rising bounds are not above the value."""
    return F.size(F.filter(bounds, lambda b: b <= value))


def with_range(df: DataFrame, order_by: str, ranges: int = RANGES) -> DataFrame:
    """Add ``__range``, the number of the range between sampled bounds that ``order_by`` is in."""
    bounded = df.withColumn("__bounds", sampled_bounds(df, order_by, ranges))
    return bounded.withColumn("__range", range_of(F.col(order_by), F.col("__bounds"))).drop("__bounds")


def with_row_index(df: DataFrame, order_by: str, ranges: int = RANGES) -> DataFrame:
    """Add ``row_index`` (0-based, by ``order_by``) and ``row_total``.

    Rows are numbered inside ranges of ``order_by`` between sampled bounds,
    and the ranges' counts, one row each, give the offsets. All of it is one
    lazy plan. ``order_by`` must be unique and not null.
    """
    placed = with_range(df, order_by, ranges)
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__size"))
    offsets = sizes.select(
        F.col("__range").alias("__of"),
        (F.sum("__size").over(Window.orderBy("__range")) - F.col("__size")).alias("__offset"),
        F.sum("__size").over(Window.partitionBy(F.lit(1))).alias("row_total"),
    )
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(order_by))
    return (
        placed.withColumn("__inside", inside)
        .join(F.broadcast(offsets), F.col("__range") == F.col("__of"))  # a row for each range
        .withColumn("row_index", F.col("__offset") + F.col("__inside") - 1)
        .drop("__range", "__of", "__inside", "__offset")
    )
