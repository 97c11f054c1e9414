"""Operators around a forecast: totals, matrices, tags, blending, capping, checks.

Only names, inputs and parameters of these steps are known from job
configurations; the rules are this library's own definitions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from roomtide.functions import packed_pair
from roomtide.operators.intervals import with_best
from roomtide.operators.reference import DEFAULT_INVENTORY_FIELD
from roomtide.session import dealt

# The label of the summed segment, the matrix columns, the share of
# the larger determinant term below which a weight fit counts as singular.
FIT_TOTAL = "FIT_TOTAL"
MATRIX_COLUMNS = [*range(16), 22, 29, 36, 43, 57, 71, 85, 119, 147, 175, 203, 231, 259, 287, 315, 343, 365]
MATRIX_KEYS = ["htl_cd", "seg_cd", "live_dt"]
SINGULAR_SHARE = 1e-9


def fit_total(segments: DataFrame, flags: DataFrame) -> DataFrame:
    """Sums over the segments that are forecast, per hotel, stay date and advance day."""
    chosen = flags.where(F.col("is_pred") == "Y").select("htl_cd", "seg_cd").distinct()
    return (
        segments.join(chosen, ["htl_cd", "seg_cd"], "left_semi")
        .groupBy("htl_cd", "live_dt", "adv_days")
        .agg(F.sum("rns").alias("rns"), F.sum("rev").alias("rev"))
        .withColumn("seg_cd", F.lit(FIT_TOTAL))
    )


def pickup_matrix(segments: DataFrame, columns: Sequence[int] = MATRIX_COLUMNS, dealt_by: Sequence[str] = MATRIX_KEYS) -> DataFrame:
    """One row per (hotel, segment, stay date), room nights in advance-day columns.

    A day belongs to the first column not smaller than it; days beyond the
    last column go to ``d_over``. The narrow input rows are dealt once, by
    ``dealt_by``, some or all of the keys; the wide sums are made behind that
    exchange and need no other. Daily sums have few rows per key, so nothing
    is gained by adding them up before. A step keyed by (hotel, segment), as
    ``forecast_sum`` is, reuses the exchange if the matrix is dealt by that.
    The sums are a window's, taken from its first row: a task sorts narrow
    rows instead of holding a wide row of every key.
    """
    position = F.coalesce(
        *[F.when(F.col("adv_days") <= c, F.lit(i)) for i, c in enumerate(columns)], F.lit(len(columns))
    )
    names = [f"d_{c}" for c in columns] + ["d_over"]
    key = Window.partitionBy(*MATRIX_KEYS)
    whole = key.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = [
        F.sum(F.when(F.col("position") == i, F.col("rns")).otherwise(0.0)).over(whole).alias(name)
        for i, name in enumerate(names)
    ]
    narrow = segments.select(*MATRIX_KEYS, position.alias("position"), "rns")
    numbered = narrow.repartition(dealt(segments.sparkSession), *dealt_by).select("*", F.row_number().over(key.orderBy("position")).alias("nth"))
    return numbered.select(*MATRIX_KEYS, "nth", *cells).where("nth = 1").drop("nth")


def day_tags(
    days: DataFrame,
    season_runs: DataFrame,
    special_days: DataFrame,
    mode: str = "weekday",
    weekend: Sequence[int] = (5, 6, 7),
) -> DataFrame:
    """Add ``tag`` to rows with (htl_cd, live_dt): special day code, else season and weekday part.

    ``mode`` is ``weekday``, ``weekendOrNot`` or ``noWeekday``, or ``sameTag``
    for one tag on all days; weekdays are 1 (Monday) to 7. Of overlapping runs
    that hold a date the latest start wins, then the latest end; a run that
    ends before it starts covers no day. Distinct (hotel, date) pairs are
    looked up (see ``intervals``) and joined to the rows; rows that are
    nothing but such pairs are looked up themselves.
    """
    if mode == "sameTag":
        return days.withColumn("tag", F.lit("S"))
    if sorted(days.columns) == ["htl_cd", "live_dt"]:
        return date_tags(days, season_runs, special_days, mode, weekend).select(*days.columns, "tag")
    tags = date_tags(days.select("htl_cd", "live_dt").distinct(), season_runs, special_days, mode, weekend)
    found = tags.select(F.col("htl_cd").alias("of_hotel"), F.col("live_dt").alias("of_day"), "tag")
    same = days["htl_cd"].eqNullSafe(found["of_hotel"]) & days["live_dt"].eqNullSafe(found["of_day"])
    return days.join(found, same, "left").select(*[days[c] for c in days.columns], "tag")


def date_tags(
    dates: DataFrame, season_runs: DataFrame, special_days: DataFrame, mode: str = "weekday", weekend: Sequence[int] = (5, 6, 7)
) -> DataFrame:
    """(htl_cd, live_dt, tag) of every (hotel, date) pair given. Special days are broadcast: a row for a date of the calendar."""
    if mode == "sameTag":
        return dates.withColumn("tag", F.lit("S"))
    weekday = F.weekday("live_dt") + 1
    part = {
        "weekday": F.concat(F.lit("-W"), weekday.cast("string")),
        "weekendOrNot": F.when(weekday.isin(*weekend), F.lit("-E")).otherwise(F.lit("-D")),
        "noWeekday": F.lit(""),
    }[mode]
    codes = special_days.groupBy(F.col("day").alias("live_dt")).agg(F.min("day_code").alias("day_code"))
    best = F.struct("start_dt", "end_dt", "season_id")
    seasons = with_best(dates, "live_dt", season_runs, "start_dt", "end_dt", best, ["htl_cd"])
    season = F.coalesce(F.col("best.season_id").cast("string"), F.lit("0"))
    return (
        seasons.join(F.broadcast(codes), "live_dt", "left")
        .select(
            "htl_cd", "live_dt",
            F.coalesce(F.concat(F.lit("H"), F.col("day_code").cast("string")), F.concat(F.lit("S"), season, part)).alias("tag"),
        )
    )


def tag_history_mean(
    segments: DataFrame,
    season_runs: DataFrame,
    special_days: DataFrame,
    start: date,
    end: date,
    mode: str = "weekday",
    weekend: Sequence[int] = (5, 6, 7),
) -> DataFrame:
    """Mean room nights per (hotel, segment, tag, advance day) over dates in [start, end].

    Sums per date come first; each (hotel, date) is tagged once.
    """
    daily = (
        segments.where(F.col("live_dt").between(F.lit(start), F.lit(end)))
        .groupBy("htl_cd", "live_dt", "seg_cd", "adv_days")
        .agg(F.sum("rns").alias("rns"))
    )
    return (
        day_tags(daily, season_runs, special_days, mode, weekend)
        .groupBy("htl_cd", "seg_cd", "tag", "adv_days")
        .agg(F.avg("rns").alias("mean_rns"))
    )


def weighted_combine(long_term: DataFrame, short_term: DataFrame, predconf: DataFrame) -> DataFrame:
    """``w1 * long + w2 * short`` with the packed ``w1,w2`` of (hotel, segment, advance day).

    A missing forecast counts as 0, a missing weight pair as (1, 0).
    """
    keys = ["htl_cd", "seg_cd", "live_dt", "adv_days"]
    both = long_term.select(*keys, F.col("rns").alias("long_rns")).join(
        short_term.select(*keys, F.col("rns").alias("short_rns")), keys, "full"
    )
    weights = predconf.select(
        "htl_cd", "seg_cd", "adv_days",
        packed_pair(F.col("weights"), 0).alias("w1"), packed_pair(F.col("weights"), 1).alias("w2"),
    )
    return both.join(weights, ["htl_cd", "seg_cd", "adv_days"], "left").select(
        *keys,
        (
            F.coalesce("w1", F.lit(1.0)) * F.coalesce("long_rns", F.lit(0.0))
            + F.coalesce("w2", F.lit(0.0)) * F.coalesce("short_rns", F.lit(0.0))
        ).alias("rns"),
    )


def blend_weights(
    actual: DataFrame, long_term: DataFrame, short_term: DataFrame, by: Sequence[str]
) -> DataFrame:
    """Least-squares weights of ``actual ~ w1 * long + w2 * short`` per ``by`` group.

    Five sums per group are enough, and they combine on the map side, so a
    group may be of any size. A singular group gets (1, 0).
    """
    keys = ["htl_cd", "seg_cd", "live_dt", "adv_days"]
    rows = (
        actual.select(*keys, F.col("rns").alias("y"))
        .join(long_term.select(*keys, F.col("rns").alias("a")), keys)
        .join(short_term.select(*keys, F.col("rns").alias("b")), keys)
    )
    a, b, y = F.col("a"), F.col("b"), F.col("y")
    sums = rows.groupBy(*by).agg(
        F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"), F.sum(a * b).alias("ab"),
        F.sum(a * y).alias("ay"), F.sum(b * y).alias("by_"),
    )
    aa, bb, ab, ay, by_ = (F.col(c) for c in ("aa", "bb", "ab", "ay", "by_"))
    det = aa * bb - ab * ab
    fits = det > F.lit(SINGULAR_SHARE) * aa * bb
    return sums.select(
        *by,
        F.when(fits, (ay * bb - by_ * ab) / det).otherwise(1.0).alias("w1"),
        F.when(fits, (by_ * aa - ay * ab) / det).otherwise(0.0).alias("w2"),
    )


def hotel_capacity(inventory: DataFrame, fields: DataFrame, default: str = DEFAULT_INVENTORY_FIELD) -> DataFrame:
    """(htl_cd, capacity) out of the inventory column that a hotel's field names.

    ``inventory`` has a column for each field, ``fields`` is (htl_cd, field).
    A hotel without a field has ``default``; a field that is no column of the
    inventory is an error, for its hotel would go uncapped.
    """
    columns = [c for c in inventory.columns if c != "htl_cd"]
    named = fields.groupBy("htl_cd").agg(F.min("field").alias("field"))
    value = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("double"))])
    field = F.coalesce("field", F.lit(default))
    unknown = F.raise_error(F.concat(F.lit("no inventory column "), field, F.lit(" for hotel "), F.col("htl_cd")))
    return inventory.join(named, "htl_cd", "left").select(
        "htl_cd", F.when(field.isin(*columns), F.element_at(value, field)).otherwise(unknown.cast("double")).alias("capacity")
    )


def capacity_cap(forecast: DataFrame, capacity: DataFrame) -> DataFrame:
    """Scale a (hotel, stay date, advance day)'s segments down to the hotel's capacity (see ``hotel_capacity``).

    Hotels without a known capacity stay as they are. The total is a
    window over the few segments of one key.
    """
    total = F.sum("rns").over(Window.partitionBy("htl_cd", "live_dt", "adv_days"))
    ratio = F.when(F.col("total") > 0, F.least(F.lit(1.0), F.col("capacity") / F.col("total")))
    return (
        forecast.withColumn("total", total)
        .join(capacity, "htl_cd", "left")
        .withColumn("rns", F.col("rns") * F.coalesce(ratio, F.lit(1.0)))
        .drop("total", "capacity")
    )


def proportional_split(forecast: DataFrame, fixed_totals: DataFrame) -> DataFrame:
    """Spread a fixed hotel total over segments by their share of the unfixed total.

    A key without a fixed total keeps its rows; where the unfixed total is 0
    every segment gets an equal share.
    """
    keys = ["htl_cd", "live_dt", "adv_days"]
    per_key = Window.partitionBy(*keys)
    fixed = fixed_totals.select(*keys, F.col("rns").alias("fixed"))
    share = F.when(F.col("total") != 0, F.col("rns") / F.col("total")).otherwise(1.0 / F.col("n"))
    return (
        forecast.withColumns({"total": F.sum("rns").over(per_key), "n": F.count("*").over(per_key)})
        .join(fixed, keys, "left")
        .withColumn(
            "rns", F.when(F.col("fixed").isNull(), F.col("rns")).otherwise(F.col("fixed") * share)
        )
        .drop("total", "n", "fixed")
    )


def forecast_sum(
    matrix: DataFrame, price: DataFrame, capacity: DataFrame, columns: Sequence[int] = MATRIX_COLUMNS
) -> DataFrame:
    """Room nights, revenue and occupancy per (hotel, stay date) from a matrix, segment prices and hotel capacities.

    Cells of one matrix row share a price, so they are added up inside the
    row instead of being unpivoted and shuffled. The price join needs no
    exchange of a matrix dealt by (hotel, segment). Occupancy is room nights
    by capacity, null for a hotel without one or with 0.
    """
    cells = [F.col(f"d_{c}") for c in columns] + [F.col("d_over")]
    row_total = sum(cells[1:], cells[0])
    sums = (
        matrix.select("htl_cd", "seg_cd", "live_dt", row_total.alias("row_rns"))
        .join(price.select("htl_cd", "seg_cd", "price"), ["htl_cd", "seg_cd"], "left")
        .groupBy("htl_cd", "live_dt")
        .agg(
            F.sum("row_rns").alias("rns"),
            F.sum(F.col("row_rns") * F.coalesce("price", F.lit(0.0))).alias("rev"),
        )
    )
    occupancy = F.when(F.col("capacity") != 0, F.col("rns") / F.col("capacity"))
    return sums.join(capacity.select("htl_cd", "capacity"), "htl_cd", "left").select("htl_cd", "live_dt", "rns", "rev", occupancy.alias("occupancy"))


def _expected(hotels: DataFrame, start: Column, days: Column, *keep: str) -> DataFrame:
    return hotels.select(*keep, "htl_cd", F.explode(F.sequence(start, F.date_add(start, days - 1))).alias("live_dt"))


def forecast_gaps(forecast: DataFrame, hotels: DataFrame, start: date, days: int) -> DataFrame:
    """(htl_cd, live_dt) pairs among ``days`` expected dates that have no forecast.

    Forecast rows are reduced to distinct pairs on the map side before they
    are shuffled to the anti join.
    """
    expected = _expected(hotels.select("htl_cd").distinct(), F.lit(start), F.lit(days))
    present = forecast.select("htl_cd", "live_dt").distinct()
    return expected.join(present, ["htl_cd", "live_dt"], "left_anti")


def stored_forecast_gaps(stored: DataFrame, hotels: DataFrame, spans: Mapping[str, tuple[date, int]]) -> DataFrame:
    """(dir, htl_cd, live_dt) that several stored forecasts should have and don't.

    ``stored`` reads the files of all folders at once; ``spans`` has the first
    date and the number of expected dates of each folder. A row belongs to
    the longest of the folders that its file lies below. A folder without any
    file lacks every date. All folders take one scan and one anti join, of
    the rows whose date some folder should have; folders go by number there,
    for a path in every row would be most of it.
    """
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below = [(d, f"{re.sub('^[a-zA-Z][a-zA-Z0-9+.-]*:/*', '/', d.rstrip('/'))}/") for d in spans]
    order = {d: i for i, d in enumerate(spans)}
    folder = F.coalesce(*[F.when(F.contains(file, F.lit(path)), F.lit(order[d])) for d, path in sorted(below, key=lambda x: -len(x[1]))], F.lit(None).cast("int"))
    asked = [F.col("live_dt").between(F.lit(start), F.lit(start + timedelta(days=days - 1))) if days > 0 else F.lit(False) for start, days in spans.values()]
    dated = stored.where(reduce(or_, asked, F.lit(False)))  # before any path is looked at
    present = dated.select(folder.alias("at"), "htl_cd", "live_dt").distinct()
    checks = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(start).alias("start"), F.lit(days).alias("days")) for i, (start, days) in enumerate(spans.values())])
    each = hotels.select("htl_cd").distinct().select("htl_cd", F.explode(checks).alias("c")).select("c.*", "htl_cd").where("days > 0")
    gaps = _expected(each, F.col("start"), F.col("days"), "at").join(present, ["at", "htl_cd", "live_dt"], "left_anti")
    names = F.array(*[F.lit(d) for d in spans])
    return gaps.select(F.get(names, F.col("at")).alias("dir"), "htl_cd", "live_dt")
