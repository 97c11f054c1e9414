"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by their source, language and topic (any columns).
The tokens of the cells are raked: for one dimension after the other, every
value's cells are scaled so that their sum meets the value's target, until all
margins hold: until none is further from its target than ``TOLERANCE``. A cell's weight over its tokens, scaled so that the largest is
1, is the probability of keeping each of its documents, so the expected
tokens of the sample have the target margins. The choice for a document
depends on its id and the seed alone.

Targets are shares by value. Values without a target get none of the sample;
targets of values without documents are spread over the others. By default
targets come from the data: a value's share to the power ``flatten``, so
0 evens the values out and 1 leaves them. Cells whose margins contradict
each other end as near as raking brings them: when a sweep no longer narrows the
largest gap, raking ends with a warning that names it.

Only DataFrame functions are used. Null in a dimension is a value of its own.
Null text has no tokens, and documents without tokens are kept with their
cell's probability. Documents with a null id share one draw, as do rows that
repeat an id. Empty tables give empty results. Columns of the
documents keep their names and values, whatever they are called.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from roomtide.session import scratch_path

#: Largest gap between a margin and its target, both as shares, that counts as none; what a sweep must leave of the gap at most to go on.
TOLERANCE, NARROWER = 1e-12, 0.9999
#: Sweeps of one plan.
AT_ONCE = 8


def token_count(text: Column) -> Column:
    """Words: runs of anything but space and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def topic(text: Column) -> Column:
    """What the text mostly looks like, by its signs: tables, markup, records, lists or prose."""
    times = lambda pattern: F.regexp_count(text, F.lit(pattern))
    n = F.length(text)
    return (
        F.when(text.isNull() | (n == 0), "empty")
        .when(100 * times(r"\|") >= 2 * n, "table")
        .when(100 * times(r"[#*$%&<>{}\[\]=]") >= 3 * n, "markup")
        .when(100 * times("[0-9]") >= 3 * n, "record")
        .when(200 * times("\n") >= n, "list")
        .otherwise("prose")
    )


def draw(doc_id: Column, seed: int) -> Column:
    """A number from 0 up to 1 for each id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def flattened(cells: DataFrame, dimension: str, flatten: float) -> DataFrame:
    """Targets from the data: ``value`` and its tokens to the power ``flatten``."""
    return cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0").select("value", F.pow("t", F.lit(float(flatten))).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int | None = None) -> DataFrame:
    """``cells`` (dimensions and ``tokens``) with ``weight``, scaled to the targets' shares.

    ``targets`` holds for each dimension a table of ``value`` and ``share``.
    A cell carries the shares of its values, so a step is a sum over the cells
    of each value and needs no join; ``AT_ONCE`` sweeps over all dimensions
    are one plan, which is stored, and its gap is one more job. The steps work
    on cells alone, of which there are as many as combinations of values.
    ``sweeps`` bounds their number; by default they go on while they narrow the gap.
    """
    names = {name: f"__share{k}" for k, name in enumerate(targets)}
    raked = cells.withColumn("weight", F.col("tokens").cast("double"))
    for name, target in targets.items():
        present = cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
        shares = present.join(target.withColumnRenamed("value", "v"), F.col("value").eqNullSafe(F.col("v"))).select("value", F.col("share").cast("double").alias("share"))
        shares = _stored(shares, "targets")
        whole = shares.agg(F.sum("share")).first()[0]
        wanted = shares.select(F.col("value").alias("__value"), (F.col("share") / F.lit(whole)).alias(names[name]))
        raked = raked.join(wanted, F.col(name).eqNullSafe(F.col("__value")), "left").drop("__value").withColumn(names[name], F.coalesce(names[name], F.lit(0.0)))
    raked = _stored(raked, "cells")
    left, done = gap(raked, names), 0
    while left > TOLERANCE and done != sweeps:
        now = AT_ONCE if sweeps is None else min(AT_ONCE, sweeps - done)
        for _ in range(now):
            for name, share in names.items():
                of_value = F.sum("weight").over(Window.partitionBy(name))
                raked = raked.withColumn("weight", F.when(of_value > 0, F.col("weight") * F.col(share) / of_value).otherwise(0.0))
        raked = _stored(raked, "cells")
        before, left, done = left, gap(raked, names), done + now
        if done > now and left > NARROWER**now * before:
            break
    if left > TOLERANCE:
        warnings.warn(f"after {done} sweeps a margin is {left:.3g} off its target", stacklevel=2)
    return raked.drop(*names.values())


def gap(raked: DataFrame, shares: dict[str, str]) -> float:
    """The largest gap between a margin and its target in all dimensions, 0 without weights; ``shares`` names the column of a dimension's target."""
    parts = [raked.groupBy(name).agg(F.sum("weight").alias("now"), F.max(share).alias("share")).select("now", "share") for name, share in shares.items()]
    if not parts:
        return 0.0
    whole = raked.agg(F.sum("weight")).scalar()
    every = reduce(DataFrame.unionByName, parts).withColumn("whole", whole)
    return every.where("whole > 0").agg(F.max(F.abs(F.col("now") / F.col("whole") - F.col("share")))).first()[0] or 0.0


def margins(raked: DataFrame, dimension: str) -> DataFrame:
    """A dimension's values with their ``share`` of the raked weight."""
    whole = raked.agg(F.sum("weight")).first()[0]
    sums = raked.groupBy(F.col(dimension).alias("value")).agg(F.sum("weight").alias("__sum"))
    return sums.select("value", (F.col("__sum") / F.lit(whole)).alias("share"))


def probabilities(raked: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Each cell's probability of keeping a document."""
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    most = raked.agg(F.max(ratio)).first()[0]
    chance = ratio / F.lit(most) if most else F.lit(0.0)
    return raked.select(*dimensions, chance.alias("__chance"))


def mix(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, flatten: float = 0.85, sweeps: int | None = None, seed: int = 17,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """Every row of ``docs`` with ``__topic``, ``__tokens``, ``__chance`` and ``__kept``."""
    marked = docs.withColumn("__topic", topic(F.col(f"`{text}`"))).withColumn("__tokens", token_count(F.col(f"`{text}`")))
    dimensions = {"__source": f"`{source}`", "__lang": f"`{lang}`", "__topic": "__topic"}
    cells = _stored(marked.groupBy(*(F.col(c).alias(name) for name, c in dimensions.items())).agg(F.sum("__tokens").alias("tokens")), "cells")
    given = {"__source": (targets or {}).get("source"), "__lang": (targets or {}).get("lang"), "__topic": (targets or {}).get("topic")}
    wanted = {name: flattened(cells, name, flatten) if given[name] is None else given[name] for name in dimensions}
    chances = _stored(probabilities(rake(cells, wanted, sweeps), list(dimensions)).withColumnRenamed("__topic", "__t"), "chances")
    same = F.col(f"`{source}`").eqNullSafe(F.col("__source")) & F.col(f"`{lang}`").eqNullSafe(F.col("__lang")) & (F.col("__topic") == F.col("__t"))
    joined = marked.join(chances, same, "left").drop("__source", "__lang", "__t")
    return joined.withColumn("__kept", draw(F.col(f"`{doc_id}`"), seed) < F.col("__chance"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix keeps, unchanged."""
    return mix(docs, **options).where("__kept").select(*(F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row ``doc_id``, ``topic``, ``n_tokens``, ``chance`` and ``kept``."""
    doc_id = options.get("doc_id", "doc_id")
    return mix(docs, **options).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), F.round("__chance", 9).alias("chance"), F.col("__kept").alias("kept"))
