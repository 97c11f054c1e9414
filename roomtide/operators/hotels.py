"""Hotel dictionary lookups.

No join here carries a broadcast hint. Catalyst broadcasts the dictionary
while its size stays under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
repeats that check with the measured size; a larger dictionary is joined by
sort-merge, where AQE splits the partition of a hotel that holds a large
share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

AREA_COLUMNS = ["city", "zone", "star", "location"]


def master_hotels(dictionary: DataFrame) -> DataFrame:
    """One (hotel_id, hotel_id_m) row per child hotel.

    Of several rows for a child the latest ``updatetime`` wins, then the
    smallest master.
    """
    return _latest_then_smallest(dictionary.select(F.col("hotel").alias("hotel_id"), "updatetime", "masterhotelid"), "hotel_id", ["updatetime"])


def _latest_then_smallest(rows: DataFrame, key: str, newest: list[str]) -> DataFrame:
    """(key, hotel_id_m): the master of the largest ``newest``, of several the smallest.

    Two small sums instead of one, because only numbers could be ordered
    downwards inside an upward order, and ids may be text.
    """
    smallest = rows.groupBy(key, *newest).agg(F.min("masterhotelid").alias("hotel_id_m"))
    return smallest.groupBy(key).agg(F.max(F.struct(*newest, "hotel_id_m")).alias("pick")).select(key, "pick.hotel_id_m")


def master_areas(dictionary: DataFrame, dedupe: bool = True) -> DataFrame:
    """Area columns per master hotel.

    With ``dedupe`` one row per master: the master's own row if there is
    one, else the latest, then the smallest child id. Without it every
    dictionary row counts, so a master shared by several children
    multiplies what is joined to it.
    """
    key = F.col("masterhotelid").alias("hotel_id_m")
    if not dedupe:
        return dictionary.select(key, *AREA_COLUMNS)
    own = F.coalesce(F.col("hotel") == F.col("masterhotelid"), F.lit(False))
    child = F.struct(F.col("hotel").isNull().alias("unnamed"), "hotel", *AREA_COLUMNS)
    smallest = dictionary.groupBy(key, own.alias("own"), "updatetime").agg(F.min(child).alias("child"))
    best = smallest.groupBy("hotel_id_m").agg(F.max_by("child", F.struct("own", "updatetime")).alias("child"))
    return best.select("hotel_id_m", *[f"child.{c}" for c in AREA_COLUMNS])


def hotel_areas(dictionary: DataFrame, dedupe: bool = True) -> DataFrame:
    """(hotel_id, hotel_id_m, area columns) for every id a booking may carry.

    Joins the two lookups inside the dictionary, so that bookings need a
    single join. Each dictionary row also names its master as standing for
    itself; that entry counts only for ids that are no child anywhere.
    """
    def entry(hotel: str, is_child: bool) -> Column:
        when = F.col("updatetime") if is_child else F.lit(None).cast("string")
        return F.struct(F.col(hotel).alias("hotel_id"), F.lit(is_child).alias("is_child"), when.alias("updatetime"), "masterhotelid")

    entries = dictionary.select(
        F.inline(F.array(entry("hotel", True), entry("masterhotelid", False)))
    )
    masters = _latest_then_smallest(entries, "hotel_id", ["is_child", "updatetime"])
    # a hotel without a master stands for itself, as in with_master
    own = F.coalesce("hotel_id_m", "hotel_id").alias("hotel_id_m")
    return masters.where("hotel_id is not null").select("hotel_id", own).join(
        master_areas(dictionary, dedupe), "hotel_id_m"
    )


def with_master(bookings: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``hotel_id_m``: the master hotel, or the hotel itself if unknown."""
    return (
        bookings.join(master_hotels(dictionary), "hotel_id", "left")
        .withColumn("hotel_id_m", F.coalesce("hotel_id_m", "hotel_id"))
    )


def with_area(rows: DataFrame, areas: DataFrame, on: str) -> DataFrame:
    """Inner join: rows of hotels without an area are dropped."""
    return rows.join(areas, on, "inner")
