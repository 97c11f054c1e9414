"""Backtest windows and balanced hotel work units."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from roomtide.functions import days_between, share_of_days
from roomtide.operators.ranking import with_row_index


def hotel_history_span(segments: DataFrame) -> DataFrame:
    """First and last stay date per hotel."""
    return segments.groupBy("htl_cd").agg(
        F.min("live_dt").alias("min_dt"), F.max("live_dt").alias("max_dt")
    )


def backtest_windows(
    spans: DataFrame, as_of: date, train_ratio: float = 1.0, test_ratio: float = 0.5, weight_days: int = 365
) -> DataFrame:
    """Training, test and weight windows per hotel.

    The history ends the day before ``as_of`` at the latest. Training and
    test shares may overlap, as the ratios say.
    """
    last = F.least("max_dt", F.lit(as_of - timedelta(days=1)))
    days = days_between("min_dt", "last_dt")
    return (
        spans.withColumn("last_dt", last)
        .withColumn("train_end", F.date_add("min_dt", share_of_days(days, train_ratio)))
        .select(
            "htl_cd",
            F.date_sub("train_end", weight_days).alias("weight_start"),
            F.col("train_end").alias("weight_end"),
            F.col("min_dt").alias("train_start"),
            "train_end",
            F.date_sub("last_dt", share_of_days(days, test_ratio)).alias("test_start"),
            F.col("last_dt").alias("test_end"),
        )
    )


def hotel_units(hotels: DataFrame, units: int) -> DataFrame:
    """Spread hotels, in code order, over at most ``units`` work units.

    Units are equal blocks of the list; the hotels left over at its end go
    one each to the first units. A hotel without a code has no unit.
    """
    p = F.least(F.lit(units), F.col("row_total"))
    block = F.expr("row_total div p")
    return (
        with_row_index(hotels.select("htl_cd").where("htl_cd is not null").distinct(), "htl_cd")
        .withColumn("p", p)
        .withColumn("block", block)
        .select(
            "htl_cd",
            F.when(F.col("row_index") < F.col("p") * F.col("block"), F.expr("row_index div block"))
            .otherwise(F.col("row_index") - F.col("p") * F.col("block"))
            .alias("unit_no"),
        )
    )


def backtest_plan(
    segments: DataFrame, hotels: DataFrame, as_of: date, units: int,
    train_ratio: float = 1.0, test_ratio: float = 0.5, weight_days: int = 365,
) -> DataFrame:
    """Work unit and own windows of every hotel; a hotel without history has NULL windows."""
    windows = backtest_windows(hotel_history_span(segments), as_of, train_ratio, test_ratio, weight_days)
    return hotel_units(hotels, units).join(windows, "htl_cd", "left")
