"""Which interval covers a day, without a range join.

An interval of days is cut into blocks of 1, 16, 256, ... days, aligned to
multiples of their length: at most 30 of each length, and of the longest as
many as it takes. A day lies in one block of each length. So days and
intervals meet by equality of key, length and block, whatever the intervals'
lengths and however many of them overlap: a block has one best interval,
whose place among the others of the block is a window's matter. Days that no
interval's start or end parts have the same best, so few days are looked up.
Days and intervals of a key move once, whole; their blocks are made where they are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from roomtide.session import dealt

# Blocks of 16 ** 0 to 16 ** TOP days.
BITS, TOP = 4, 4


def _range(first: Column, end: Column) -> Column:
    """The whole numbers from ``first`` to before ``end``."""
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<int>"))


def _up(x: Column, bits: int) -> Column:
    """Division by a power of two, rounded up."""
    return -F.shiftright(-x, bits)


def _at(level: int):
    return lambda b: F.struct(F.lit(level).alias("level"), b.alias("block"))


def blocks(start: Column, end: Column) -> Column:
    """The blocks that make up the days from ``start`` to ``end``, both included: an array of (level, block)."""
    first, after = F.unix_date(start), F.unix_date(end) + 1
    levels = []
    for level in range(TOP + 1):
        low, high = _up(first, BITS * level), F.shiftright(after, BITS * level)
        longer_low, longer_high = _up(low, BITS) * (1 << BITS), F.shiftright(high, BITS) * (1 << BITS)
        numbers = _range(low, high)
        if level < TOP:  # what longer blocks don't cover, in front of them and behind
            ends = F.concat(_range(low, longer_low), _range(longer_high, high))
            numbers = F.when(longer_low <= longer_high, ends).otherwise(numbers)
        levels.append(F.transform(numbers, _at(level)))
    return F.concat(*levels)


def blocks_of_day(day: Column) -> Column:
    """The block of each length that holds a day."""
    return F.array(*[
        F.struct(F.lit(level).alias("level"), F.shiftright(F.unix_date(day), BITS * level).alias("block")) for level in range(TOP + 1)
    ])


def best_covering(days: DataFrame, day: str, intervals: DataFrame, start: str, end: str, best: Column, keys: Sequence[str]) -> DataFrame:
    """(keys, day, best): the largest ``best`` of the intervals of a key that hold the day; without one there is no row."""
    return with_best(days, day, intervals, start, end, best, keys).where(F.col("best").isNotNull())


def with_best(days: DataFrame, day: str, intervals: DataFrame, start: str, end: str, best: Column, keys: Sequence[str]) -> DataFrame:
    """(keys, day, best) of every row of ``days``, ``best`` being null where no interval of the key holds the day.

    ``best`` is an expression over ``intervals``, never null; an interval
    that ends before it starts covers nothing, nor does one with a null key.
    Between two points at which an interval starts or has ended the best
    stays the same. So only points, two of an interval, are looked up in
    blocks, and a day takes the best of the last point up to it: days are not
    multiplied, and repeated ones stay apart. Days and intervals are dealt
    together, by their keys, before anything is made of either: no side is
    small enough to look like a broadcast to Catalyst, which does not see how
    many blocks an interval has. The partitions are not merged, for their
    rows grow.
    """
    known = [F.col(k).isNotNull() for k in keys]
    told = intervals.where(reduce(and_, known, F.col(end) >= F.col(start))).select(
        *keys, F.lit(None).cast(days.schema[day].dataType).alias("day"), F.col(start).alias("start"), F.col(end).alias("end"), best.alias("best")
    )
    kind = {c: told.schema[c].dataType for c in ("start", "end", "best")}
    asked = days.select(*keys, F.col(day).alias("day"), *[F.lit(None).cast(kind[c]).alias(c) for c in kind], F.lit(True).alias("asked"))
    both = asked.unionByName(told.withColumn("asked", F.lit(False))).repartition(dealt(days.sparkSession), *keys)
    nowhere = F.lit(None).cast(days.schema[day].dataType)
    of_interval = F.concat(
        _pieces(blocks(F.col("start"), F.col("end")), nowhere), *[_pieces(blocks_of_day(p), p) for p in (F.col("start"), F.date_add("end", 1))]
    )
    pieces = both.select(
        *keys, "best", "asked",
        F.explode(F.when(F.col("asked"), _pieces(F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).alias("block"))), F.col("day"))).otherwise(of_interval)).alias("piece"),
    ).select(*keys, "asked", "piece.*", F.when(F.col("piece.day").isNull(), F.col("best")).alias("best"))
    of_block = F.max("best").over(Window.partitionBy(*keys, "level", "block"))
    of_point = F.max("best").over(Window.partitionBy(*keys, "day"))
    last_point = F.last(F.when(~F.col("asked"), F.struct("best")), ignorenulls=True).over(Window.partitionBy(*keys).orderBy("day"))
    return (
        pieces.withColumn("best", of_block).where("asked or day is not null").select(*keys, "asked", "day", "best")
        .withColumn("best", of_point).withColumn("point", last_point).where("asked")
        .select(*keys, F.col("day").alias(day), F.col("point.best").alias("best"))
    )


def _pieces(blocks: Column, day: Column) -> Column:
    return F.transform(blocks, lambda b: F.struct(b["level"].alias("level"), b["block"].alias("block"), day.alias("day")))
