"""Area booking totals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from roomtide.functions import advance_days
from roomtide.operators.hotels import AREA_COLUMNS, hotel_areas, master_areas, with_area
from roomtide.operators.nights import stay_nights, sums_in_place
from roomtide.session import dealt

# Fixed value: first stay date kept unless the caller says otherwise.
MIN_LIVE_DT = date(2014, 1, 1)

AREA_ORDER_KEYS = [*AREA_COLUMNS, "price_level", "order_dt", "live_dt", "cancel_dt"]


def _kept(min_live_dt: date) -> Column:
    """Stay not before the minimum date and not before its order."""
    return (F.col("live_dt") >= F.lit(min_live_dt)) & (advance_days("live_dt", "order_dt") >= 0)


def area_orders(
    nights: DataFrame, dictionary: DataFrame, min_live_dt: date = MIN_LIVE_DT, dedupe: bool = True
) -> DataFrame:
    """Area totals from hotel nights. Both filters run before the join and the sums.

    Nights are dealt by their dates and price level, which areas share, before
    the join: a hotel moves instead of the columns of its area, and a master
    of several areas is not multiplied before. Few nights share a key, so
    they move as they are. Rows are sorted by dates first: files of them are
    smaller, and events made of them follow each other by stay date and
    advance day.
    """
    by_dates = ["live_dt", "order_dt", "cancel_dt", "price_level"]
    kept = nights.where(_kept(min_live_dt)).select("hotel_id_m", *by_dates, "rns", "rev")
    placed = with_area(kept.repartition(dealt(nights.sparkSession), *by_dates), master_areas(dictionary, dedupe), "hotel_id_m")
    return sums_in_place(placed, [*by_dates, *AREA_COLUMNS]).select(*AREA_ORDER_KEYS, "rns", "rev")


def area_nights(
    bookings: DataFrame, dictionary: DataFrame, min_live_dt: date = MIN_LIVE_DT, dedupe: bool = True
) -> DataFrame:
    """Unsummed area rows straight from bookings: one join, no shuffle of nights.

    Curves sum these rows themselves, so summing per hotel and per area in
    between would only add shuffles. Stays that end too early to have a kept
    night are filtered on ``dpt_dt``, which a parquet scan can use to skip
    row groups.
    """
    return _nights_of(_placed(bookings, dictionary, min_live_dt, dedupe), min_live_dt)


def _placed(bookings: DataFrame, dictionary: DataFrame, min_live_dt: date, dedupe: bool) -> DataFrame:
    late_enough = (F.col("dpt_dt") > F.lit(min_live_dt)) & (F.col("dpt_dt") > F.col("order_dt"))
    return with_area(bookings.where(late_enough), hotel_areas(dictionary, dedupe), "hotel_id")


def _nights_of(placed: DataFrame, min_live_dt: date) -> DataFrame:
    return stay_nights(placed).where(_kept(min_live_dt)).select(*AREA_ORDER_KEYS, "rns", "rev")


def area_orders_from_bookings(
    bookings: DataFrame, dictionary: DataFrame, min_live_dt: date = MIN_LIVE_DT, dedupe: bool = True
) -> DataFrame:
    """Same rows as ``area_orders`` over ``hotel_nights``.

    Bookings are dealt once, with their areas and before their nights are
    made, by all keys but the night. The partitions are not merged, for their
    rows grow. Nearly every night has a key of its own, so nothing is gained
    by adding up before; the sums are a window's, taken from its first row: a
    task sorts its rows instead of holding a sum of every key.
    """
    by = [k for k in AREA_ORDER_KEYS if k != "live_dt"]
    placed = _placed(bookings, dictionary, min_live_dt, dedupe).repartition(dealt(bookings.sparkSession), *by)
    return sums_in_place(_nights_of(placed, min_live_dt), AREA_ORDER_KEYS)
