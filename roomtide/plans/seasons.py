"""The history that seasons are learned from, and the season table of all hotels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roomtide.operators import season
from roomtide.operators.season import History
from roomtide.sources import write_parquet, write_partitioned

DAYS = "htl_cd string, seg_cd string, live_dt date, rns double, month int"
FIRST = "htl_cd string, first_dt date"


def store_history(segments: DataFrame, path: str) -> History:
    """Segment sums by day below ``path/days``, a folder per month of stay, and first days in ``path/first``.

    Months that ``segments`` doesn't have stay as they are, so a history is
    brought up to date by the months that changed.
    """
    spark = segments.sparkSession
    write_partitioned(season.segment_days(segments), f"{path}/days", ["month"])
    write_parquet(season.first_days(spark.read.schema(DAYS).parquet(f"{path}/days")), f"{path}/first")
    return open_history(spark, path)


def open_history(spark: SparkSession, path: str) -> History:
    return History(spark.read.schema(DAYS).parquet(f"{path}/days"), spark.read.schema(FIRST).parquet(f"{path}/first"))


def season_runs(
    history: History, flags: DataFrame, train_start: date, train_end: date,
    start: date, end: date, weeks: int = 2, seasons: int = 5,
) -> DataFrame:
    """Season runs of every hotel with enough history, as rows; days without a season included.

    Everything after the daily sums is keyed by hotel alone, so weekly
    means, bands, calendar and runs share one shuffle.
    """
    weekly = season.weekly_mean(history, flags, train_start, train_end, weeks)
    dated = season.calendar(season.bands(weekly, seasons), start, end, weeks)
    return season.runs(dated)


def season_table(
    history: History, flags: DataFrame, train_start: date, train_end: date,
    start: date, end: date, template: Sequence[str], weeks: int = 2, seasons: int = 5,
) -> DataFrame:
    """(htl_cd, line) of every hotel with a history: own seasons, or the template where it is short or lacks some bucket.

    One pass over the training months; ``season.incomplete_hotels`` reports the hotels without some bucket.
    """
    means = season.bucket_means(history, flags, train_start, train_end, weeks)
    return season.hotel_season_lines(means, history.first, train_start, train_end, start, end, template, weeks, seasons)
