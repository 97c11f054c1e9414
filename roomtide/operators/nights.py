"""Bookings to stay nights and hotel-night totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from roomtide.functions import days_between
from roomtide.operators.hotels import with_master
from roomtide.session import dealt

HOTEL_NIGHT_KEYS = [
    "hotel_id_m", "order_status", "order_dt", "live_dt", "cancel_dt", "price_level", "sub_room_id",
]


def stay_nights(bookings: DataFrame) -> DataFrame:
    """One row per night in [arr_dt, dpt_dt), measures divided evenly.

    Bookings without a night vanish. The explode is the outer kind because
    the filter already guarantees a night: the inner kind would make
    Catalyst build every date sequence a second time to test its size.
    """
    nights = days_between("arr_dt", "dpt_dt")
    others = [c for c in bookings.columns if c not in ("arr_dt", "dpt_dt", "rns", "rev")]
    return bookings.where(nights > 0).select(
        *others,
        F.explode_outer(F.sequence("arr_dt", F.date_sub("dpt_dt", 1))).alias("live_dt"),
        (F.col("rns") / nights).alias("rns"),
        (F.col("rev") / nights).alias("rev"),
    )


def sums_in_place(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys`` with the sums of its measures, of rows that are dealt by some of them already.

    The sums are a window's, taken from its first row: a task sorts its rows
    by ``keys``, in their order, instead of holding a sum of every key.
    """
    key = Window.partitionBy(*keys)
    numbered = rows.select(*keys, "rns", "rev").withColumn("nth", F.row_number().over(key.orderBy(keys[-1])))
    sums = numbered.withColumns({"rns": F.sum("rns").over(key), "rev": F.sum("rev").over(key)})
    return sums.where("nth = 1").drop("nth")


def hotel_nights(bookings: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Room nights and revenue per master hotel, status, dates, price level, room.

    The master is attached to bookings, not to nights, so the join handles
    fewer rows. Bookings are dealt once, before their nights are made, by all
    keys but hotel and night; nearly every night has a key of its own, so
    nothing is gained by adding up before. Bookings of the same dates come
    together and rows are sorted by dates first: files of them are smaller,
    and so is an exchange of what is read from them.
    """
    columns = {"last_order_status": "order_status", "room_id": "sub_room_id"}
    named = with_master(bookings, dictionary).withColumnsRenamed(columns)
    kept = named.select(*[k for k in HOTEL_NIGHT_KEYS if k != "live_dt"], "arr_dt", "dpt_dt", "rns", "rev")
    by = [k for k in HOTEL_NIGHT_KEYS if k not in ("hotel_id_m", "live_dt")]
    nights = stay_nights(kept.repartition(dealt(bookings.sparkSession), *by))
    by_dates = ["order_dt", "live_dt", "cancel_dt", "price_level", "hotel_id_m", "order_status", "sub_room_id"]
    return sums_in_place(nights, by_dates).select(*HOTEL_NIGHT_KEYS, "rns", "rev")
