"""The daily on-the-books job: hotel nights, area totals, and every curve over them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtide.model import AREA_ORDERS
from roomtide.operators import curves
from roomtide.operators.area import MIN_LIVE_DT, area_orders
from roomtide.operators.nights import hotel_nights
from roomtide.session import shuffles_released
from roomtide.sources import dated_path, read_parquet, write_delimited, write_parquet, write_partitioned

PAIRS = {
    "city_star": ["city", "star"],
    "city_zone": ["city", "zone"],
    "zone_star": ["zone", "star"],
}
#: What event sums hold beside their keys.
SUMS = [f"{kind}{m}" for kind in ("booked", "valid", "gone") for m in ("", *(f"_{x}" for x in curves.MEASURES))]
#: How parquet tables of the job are compressed.
STORED = "zstd"
PARTS = {
    "cancel": curves.cancel_part,
    "valid": curves.valid_part,
    "pickup": curves.pickup_part,
}


def run_daily(
    spark: SparkSession,
    bookings: DataFrame,
    dictionary: DataFrame,
    root: str,
    dt: str | date,
    as_of: date | None = None,
    min_live_dt: date = MIN_LIVE_DT,
    dedupe: bool = True,
    pairs: dict[str, list[str]] = PAIRS,
    compression: str = "gzip",
    partitions: int | None = None,
    buckets: int | None = None,
) -> dict[str, str]:
    """Write every table to ``<root>/<table>/<yyyyMMdd>``; return the paths by table.

    Each stored table is the input of the next step, so nothing is computed
    twice and a lost executor costs one step at most. All curves come from
    one pass over the area totals, stored as event sums by dimension pair
    (see ``pair_sums``). A measure of a pair, daily and cumulative, is
    one window pass over those without an exchange; the two text files are
    cut from what it stored. All text is written with ``compression``.
    """
    paths: dict[str, str] = {}

    def target(name: str) -> str:
        paths[name] = dated_path(f"{root.rstrip('/')}/{name}", dt, as_of)
        return paths[name]

    with shuffles_released(spark):
        write_parquet(hotel_nights(bookings, dictionary), target("hotel_nights"), compression=STORED)
        nights = read_parquet(spark, paths["hotel_nights"])

        write_parquet(area_orders(nights, dictionary, min_live_dt, dedupe), target("area_orders"), compression=STORED)
        area = read_parquet(spark, paths["area_orders"]).select(*AREA_ORDERS.names)
        write_delimited(_few(area, partitions), target("area_orders_text"), compression=compression)

        write_partitioned(curves.event_sums(area, pairs), target("event_sums"), ["pair"], gather=False, compression=STORED)
        sums = read_parquet(spark, paths["event_sums"])

        for pair, dims in pairs.items():
            with pair_sums(sums.where(F.col("pair") == pair), dims, target(f"event_sums_{pair}"), buckets) as of_pair:
                for measure, part in PARTS.items():
                    both = target(f"{measure}_{pair}_both")
                    write_parquet(curves.densify_both(part(of_pair, dims), dims), both, compression=STORED)
                    stored = _few(read_parquet(spark, both), partitions)
                    running = stored.select(*dims, "live_dt", "adv_days", *[F.col(f"acc_{m}").alias(m) for m in curves.MEASURES])
                    write_delimited(curves.curve_rows(stored, dims), target(f"{measure}_{pair}"), compression=compression)
                    write_delimited(curves.curve_rows(running, dims), target(f"{measure}_{pair}_acc"), compression=compression)
    return paths


def _few(stored: DataFrame, partitions: int | None) -> DataFrame:
    """Stored rows in ``partitions`` parts; files that are read in more parts are put together without an exchange."""
    if not partitions:
        return stored
    return stored.coalesce(partitions) if stored.rdd.getNumPartitions() >= partitions else stored.repartition(partitions)


@contextmanager
def pair_sums(sums: DataFrame, dims: list[str], path: str, buckets: int | None = None) -> Iterator[DataFrame]:
    """A pair's event sums, stored in buckets of (dims, stay date), as a DataFrame that windows need not deal again.

    Only a table of the session's catalogue knows its buckets, so the files
    are one while the curves are made. ``buckets`` is the session's number of
    shuffle partitions unless given; a bucket is one file, sorted.
    """
    spark = sums.sparkSession
    keys = [*dims, "live_dt"]
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"event_sums_{uuid.uuid4().hex}"
    (
        sums.select(*keys, "adv_days", *SUMS).repartition(n, *keys)
        .write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys, "adv_days").option("compression", STORED).option("path", path).saveAsTable(table)
    )
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"drop table {table}")  # the files stay
