"""Season bands from weekly mean demand, for all hotels in one query."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from roomtide.functions import days_between, equal_width_band, week_bucket

# History needed for own seasons, and the hotel mark in template lines.
MIN_HISTORY_DAYS = 365
HOTEL_MARK = "V_HTL"


class History(NamedTuple):
    """What seasons are learned from.

    ``days``: (htl_cd, seg_cd, live_dt, rns, month), one row per hotel, segment and date; ``month`` is yyyyMM.
    ``first``: (htl_cd, first_dt), the first date of any segment.
    """

    days: DataFrame
    first: DataFrame


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def segment_days(segments: DataFrame) -> DataFrame:
    """Room nights per (htl_cd, seg_cd, live_dt), with the month; rows without a date have no place in a history."""
    dated = segments.where(F.col("live_dt").isNotNull())
    return dated.groupBy("htl_cd", "seg_cd", "live_dt").agg(F.sum("rns").alias("rns")).withColumn("month", month_of(F.col("live_dt")))


def first_days(days: DataFrame) -> DataFrame:
    return days.groupBy("htl_cd").agg(F.min("live_dt").alias("first_dt"))


def history_of(segments: DataFrame) -> History:
    """The history straight from segment sums; ``plans.seasons.store_history`` keeps it."""
    days = segment_days(segments)
    return History(days, first_days(days))


def history_days(train_start: date, train_end: date) -> Column:
    """Days from a hotel's training start, which no data before ``train_start`` moves, to the end of training."""
    return days_between(F.greatest("first_dt", F.lit(train_start)), F.lit(train_end))


def daily_room_nights(history: History, flags: DataFrame, train_start: date, train_end: date) -> DataFrame:
    """Room nights per (htl_cd, live_dt) of the training dates, over segments that are forecast.

    The dates bound the month as well, so that a stored history is read by
    its folders. Dates before a hotel's first one don't exist, so the bounds
    need not know it.
    """
    month = lambda day: day.year * 100 + day.month
    trained = history.days.where(
        F.col("month").between(month(train_start), month(train_end))
        & F.col("live_dt").between(F.lit(train_start), F.lit(train_end))
    )
    excluded = flags.where(F.col("is_pred") == "N").select("htl_cd", "seg_cd")
    return (
        trained.join(excluded, ["htl_cd", "seg_cd"], "left_anti")
        .groupBy("htl_cd", "live_dt").agg(F.sum("rns").alias("rns"))
    )


def bucket_means(history: History, flags: DataFrame, train_start: date, train_end: date, weeks: int) -> DataFrame:
    """Mean daily room nights per (htl_cd, bucket of ``weeks`` ISO weeks) over days present, however short the history."""
    return (
        daily_room_nights(history, flags, train_start, train_end).where(F.col("rns").isNotNull())
        .groupBy("htl_cd", week_bucket("live_dt", weeks).alias("bucket"))
        .agg(F.avg("rns").alias("mean_rns"))
    )


def weekly_mean(history: History, flags: DataFrame, train_start: date, train_end: date, weeks: int) -> DataFrame:
    """``bucket_means`` of the hotels with enough history."""
    enough = history.first.where(history_days(train_start, train_end) >= MIN_HISTORY_DAYS).select("htl_cd")
    return bucket_means(history, flags, train_start, train_end, weeks).join(enough, "htl_cd", "left_semi")


def bands(weekly: DataFrame, seasons: int) -> DataFrame:
    """Season number of every bucket: equal-width bands of the hotel's own range."""
    per_hotel = Window.partitionBy("htl_cd")
    low, high = F.min("mean_rns").over(per_hotel), F.max("mean_rns").over(per_hotel)
    return weekly.withColumns({"low": low, "high": high}).select(
        "htl_cd", "bucket", "mean_rns",
        equal_width_band(F.col("mean_rns"), F.col("low"), F.col("high"), seasons).alias("season_id"),
    )


def calendar(banded: DataFrame, start: date, end: date, weeks: int) -> DataFrame:
    """Season of every date from ``start`` to ``end`` per hotel.

    A hotel's bands (at most one per ISO-week bucket) are folded into a map
    and looked up per date; a bucket without history gives a NULL season.
    """
    looked_up = F.map_from_entries(F.collect_list(F.struct("bucket", "season_id")))
    days = F.sequence(F.lit(start), F.lit(end))
    return (
        banded.groupBy("htl_cd").agg(looked_up.alias("seasons"))
        .select("htl_cd", "seasons", F.explode(days).alias("live_dt"))
        .select(
            "htl_cd", "live_dt",
            F.try_element_at("seasons", week_bucket("live_dt", weeks)).alias("season_id"),
        )
    )


def runs(dated: DataFrame) -> DataFrame:
    """Merge consecutive dates of one season into (season_id, start_dt, end_dt)."""
    w = Window.partitionBy("htl_cd").orderBy("live_dt")
    previous = F.lag("season_id").over(w)
    starts = (F.row_number().over(w) == 1) | ~F.col("season_id").eqNullSafe(previous)
    return (
        dated.withColumn("starts", starts.cast("int"))
        .withColumn("run", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("htl_cd", "run", "season_id")
        .agg(F.min("live_dt").alias("start_dt"), F.max("live_dt").alias("end_dt"))
        .drop("run")
    )


def seasons_without_history(season_runs: DataFrame) -> DataFrame:
    """Runs whose dates fall in a bucket with no history; empty means complete."""
    return season_runs.where(F.col("season_id").isNull())


def incomplete_hotels(season_runs: DataFrame) -> DataFrame:
    """Hotels (htl_cd) with days whose bucket has no history."""
    return seasons_without_history(season_runs).select("htl_cd").distinct()


def season_lines(season_runs: DataFrame) -> DataFrame:
    """``htl#season####start#end``"""
    empty = F.lit("")
    return season_runs.select(
        "htl_cd",
        F.concat_ws(
            "#", "htl_cd", F.coalesce(F.col("season_id").cast("string"), empty), empty, empty, empty,
            F.col("start_dt").cast("string"), F.col("end_dt").cast("string"),
        ).alias("line"),
    )


def short_history_hotels(history: History, train_start: date, train_end: date) -> DataFrame:
    """Hotels with too little history for own seasons."""
    return history.first.where(history_days(train_start, train_end) < MIN_HISTORY_DAYS).select("htl_cd")


def fallback_lines(hotels: DataFrame, template: Sequence[str]) -> DataFrame:
    """The configured template lines for each hotel, its code put in place of the mark."""
    lines = F.array(*[F.lit(line) for line in template])
    return hotels.select("htl_cd", F.explode(lines).alias("line")).select(
        "htl_cd", F.replace("line", F.lit(HOTEL_MARK), F.col("htl_cd")).alias("line")
    )


def bucket_spans(start: date, end: date, weeks: int) -> list[tuple[int, date, date]]:
    """The calendar as spans of days in one week bucket: (bucket, first day, last day)."""
    spans: list[tuple[int, date, date]] = []
    for n in range((end - start).days + 1):
        day = start + timedelta(days=n)
        bucket = day.isocalendar()[1] // weeks
        if spans and spans[-1][0] == bucket:
            spans[-1] = (bucket, spans[-1][1], day)
        else:
            spans.append((bucket, day, day))
    return spans


def hotel_season_lines(
    means: DataFrame, first: DataFrame, train_start: date, train_end: date,
    start: date, end: date, template: Sequence[str], weeks: int, seasons: int,
) -> DataFrame:
    """(htl_cd, line) of every hotel of ``first``: its season runs, or the template.

    The calendar's spans are the same for all hotels, so a hotel is one row
    with its buckets' means (at most one for each ISO week) until its lines
    are known: own ones if its history is long enough and every span has a
    season, else the template's. Neighbouring spans of one season are one run.
    """
    spans = bucket_spans(start, end, weeks)
    own = means.groupBy("htl_cd").agg(
        F.collect_list(F.struct("bucket", "mean_rns")).alias("means"),
        F.min("mean_rns").alias("low"), F.max("mean_rns").alias("high"),
    )
    banded = F.transform("means", lambda m: F.struct(m["bucket"], equal_width_band(m["mean_rns"], F.col("low"), F.col("high"), seasons)))
    buckets, starts, ends = (F.array(*[F.lit(x) for x in column]) for column in (zip(*spans) if spans else ((), (), ())))
    hotels = first.join(own, "htl_cd", "left").select(
        "htl_cd", F.when(history_days(train_start, train_end) >= MIN_HISTORY_DAYS, F.map_from_entries(banded)).alias("of_bucket")
    )
    seasoned = hotels.select("htl_cd", F.transform(buckets, lambda b: F.try_element_at("of_bucket", b)).alias("season"))
    changes = F.filter(
        F.sequence(F.lit(0), F.lit(len(spans) - 1)),
        lambda i: (i == 0) | (F.get("season", i) != F.get("season", i - 1)),
    )
    run_line = lambda at, k: F.concat_ws(
        "#", "htl_cd", F.get("season", at).cast("string"), F.lit(""), F.lit(""), F.lit(""), F.get(starts, at).cast("string"),
        F.get(ends, F.coalesce(F.get("changes", k + 1), F.lit(len(spans))) - 1).cast("string"),
    )
    runs = seasoned.withColumn("changes", changes)
    complete = ~F.exists("season", lambda s: s.isNull())
    fallback = F.array(*[F.replace(F.lit(line), F.lit(HOTEL_MARK), F.col("htl_cd")) for line in template])
    return runs.select("htl_cd", F.explode(F.when(complete, F.transform("changes", run_line)).otherwise(fallback)).alias("line"))
