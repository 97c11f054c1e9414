"""The library's input tables derived from the star-schema tables.

Stay dates are derived from the order date, because ship dates lie years
away from it. The mapping yields stays of 0 to 4 nights, negative lead times
and cancellations after the stay date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtide.model import HOTEL_DICTIONARY

DIM_PAIRS = {
    "city_star": ["city", "star"],
    "city_zone": ["city", "zone"],
    "zone_star": ["zone", "star"],
}

# Given schemas spare the job that would read them from the parquet footers.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bookings(spark: SparkSession, sf_dir: str, cancelled: bool | None = None) -> DataFrame:
    """Order lines as hotel bookings.

    ``cancelled`` keeps only cancelled or only valid ones by a filter that
    the parquet scan can apply, before lines are joined with orders.
    """
    lines = table(spark, sf_dir, "lineitem")
    if cancelled is not None:
        lines = lines.where("l_returnflag = 'R'" if cancelled else "l_returnflag <> 'R'")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lead = "cast((l_partkey * 7 + l_linenumber) % 60 - 2 as int)"
    return lines.join(orders, "l_orderkey").selectExpr(
        "l_orderkey as order_id",
        "l_suppkey as hotel_id",
        "o_orderstatus as last_order_status",
        "cast(o_orderdate as date) as order_dt",
        f"date_add(cast(o_orderdate as date), {lead}) as arr_dt",
        f"date_add(cast(o_orderdate as date), {lead} + cast(l_suppkey % 5 as int)) as dpt_dt",
        "case when l_returnflag = 'R' "
        "then date_add(cast(o_orderdate as date), cast(l_partkey % 40 as int)) end as cancel_dt",
        "cast(l_partkey % 8 + 1 as int) as price_level",
        "cast(l_partkey % 10 as int) as room_id",
        "l_quantity as rns",
        "l_extendedprice as rev",
    )


def hotel_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as hotels; two neighbours share a master."""
    known = {
        "hotel": "s_suppkey",
        "location": "s_suppkey % 7",
        "hotelname": "s_name",
        "star": "s_suppkey % 5",
        "city": "cast(s_nationkey as bigint)",
        "zone": "cast(s_nationkey as bigint) * 10 + s_suppkey % 3",
        "masterhotelid": "s_suppkey - s_suppkey % 2",
        "updatetime": "'2016-01-01 00:00:00'",
    }
    return table(spark, sf_dir, "supplier").selectExpr(
        *[f"{known.get(name, 'cast(null as string)')} as {name}" for name in HOTEL_DICTIONARY.names]
    )


HOTEL = "cast(l_suppkey as string) as htl_cd"
SEGMENT = "concat(l_returnflag, l_linestatus) as seg_cd"
LIVE = "cast(l_shipdate as date) as live_dt"
ADVANCE = "cast((l_partkey * 7 + l_linenumber) % 20 * ((l_partkey * 7 + l_linenumber) % 21) as int) as adv_days"


def segment_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment daily sums by hotel, segment, membership, stay date and advance day."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            HOTEL, SEGMENT, "if(l_linenumber % 2 = 0, 'Y', 'N') as is_member", LIVE, ADVANCE,
            "l_quantity", "l_extendedprice",
        )
        .groupBy("htl_cd", "seg_cd", "is_member", "live_dt", "adv_days")
        .agg(F.sum("l_quantity").alias("rns"), F.sum("l_extendedprice").alias("rev"))
    )


def _forecast(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(HOTEL, SEGMENT, LIVE, ADVANCE, f"{measure} as measure")
        .groupBy("htl_cd", "seg_cd", "live_dt", "adv_days")
        .agg(F.sum("measure").alias("rns"))
    )


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(spark, sf_dir, "l_quantity")


def long_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(spark, sf_dir, "l_quantity + l_linenumber")


def short_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(spark, sf_dir, "l_quantity * (l_partkey % 3 + 1)")


def fixed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotel totals to be split over segments, of all lines; keys whose lines have no measure have a null total."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(HOTEL, LIVE, ADVANCE, "if(l_partkey % 3 <> 0, cast(l_linenumber as double), null) as measure")
        .groupBy("htl_cd", "live_dt", "adv_days")
        .agg(F.sum("measure").alias("rns"))
    )


def weight_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed weight pairs of all hotels; those of odd hotels are null."""
    return (
        table(spark, sf_dir, "lineitem").selectExpr(HOTEL, SEGMENT, ADVANCE).distinct()
        .selectExpr("*", "if(cast(htl_cd as bigint) % 2 = 0, concat('0.', adv_days % 10, ',0.', (adv_days + 3) % 10), null) as weights")
    )


def market_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment table of the forecast database."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        HOTEL, SEGMENT, "if((l_suppkey + ascii(l_returnflag)) % 4 = 0, 'N', 'Y') as is_forecast"
    ).distinct()


def hotel_bar_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price table of the forecast database, repeated rows included."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        HOTEL,
        "cast(l_partkey % 4 + 1 as int) as season",
        "concat('RT', l_linenumber % 3) as zh_rt_cd",
        "cast(l_partkey % 5 * 20 as int) as min_occ_pert",
        "cast(l_partkey % 5 * 20 + 20 as int) as max_occ_pert",
    )


def hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as string) as htl_cd")


def inventory_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured inventory fields of all hotels; that of every third is null."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as string) as htl_cd",
        "case when s_suppkey % 3 = 0 then null when s_suppkey % 2 = 0 then 'rooms' else 'tosell' end as field",
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory columns of all hotels; ``rooms`` of every seventh is null."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as string) as htl_cd", "if(s_suppkey % 7 <> 0, cast(s_suppkey % 30 + 20 as double), null) as rooms",
        "cast(s_suppkey % 25 + 10 as double) as tosell",
    )


def segment_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem").selectExpr(HOTEL, SEGMENT, "l_quantity", "l_extendedprice")
        .groupBy("htl_cd", "seg_cd")
        .agg(F.round(F.sum("l_extendedprice") / F.sum("l_quantity"), 2).alias("price"))
    )


def quarter_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season runs of one quarter each, 1995 to 2001."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "explode(sequence(0, 27)) as q"
    ).selectExpr(
        "cast(s_suppkey as string) as htl_cd",
        "cast((s_suppkey + q) % 4 as int) as season_id",
        "add_months(date '1995-01-01', q * 3) as start_dt",
        "date_sub(add_months(date '1995-01-01', q * 3 + 3), 1) as end_dt",
    )


def special_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First days of months on which orders were placed."""
    return (
        table(spark, sf_dir, "orders").selectExpr("cast(o_orderdate as date) as day").distinct()
        .where("dayofmonth(day) = 1").selectExpr("day", "month(day) as day_code")
    )
