"""Plans and hot keys: what must hold when the tables are large."""

import pytest
from pyspark.sql import functions as F, types as T

from catalogue import starschema as star
from catalogue.queries import all_queries
from roomtide.model import area_orders_layout, bookings_layout
from roomtide.operators import curves
from roomtide.operators.area import area_nights
from roomtide.operators.nights import hotel_nights
from roomtide.session import scratch_path

AREA_ORDERS = area_orders_layout(T.LongType())
BOOKINGS = bookings_layout(T.LongType())

SF = "/root/testdata/sf0.001"


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    old = {}

    def apply(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            old[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield apply
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_pairs_and_no_python_in_the_plan(spark, settings, plan, name):
    settings(autoBroadcastJoinThreshold="-1")
    text = plan(all_queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_curves_prune_columns_and_push_the_cancel_filter(spark, plan):
    path = scratch_path(spark, "area")
    spark.createDataFrame([], AREA_ORDERS).write.parquet(path)
    area = spark.read.parquet(path)
    text = plan(curves.valid_curve(area, ["city", "star"]))
    assert "PushedFilters: [IsNull(cancel_dt)" in text
    assert "ReadSchema: struct<city:bigint,star:bigint,order_dt:date,live_dt:date,cancel_dt:date,rns:double,rev:double>" in text
    assert "IsNotNull(cancel_dt)" in plan(curves.cancel_curve(area, ["zone", "star"]))


def test_stay_filters_reach_the_booking_scan(spark, plan):
    path = scratch_path(spark, "bookings")
    spark.createDataFrame([], BOOKINGS).write.parquet(path)
    rows = area_nights(spark.read.parquet(path), star.hotel_dictionary(spark, SF))
    text = plan(curves.cancel_curve(rows, ["city", "star"]))
    assert "GreaterThan(dpt_dt,2014-01-01)" in text and "IsNotNull(cancel_dt)" in text
    assert "order_id" not in text.split("ReadSchema: struct<")[1].split(">")[0]


def test_curve_sums_before_it_shuffles(spark, plan):
    area = area_nights(star.bookings(spark, SF), star.hotel_dictionary(spark, SF))
    text = plan(curves.pickup_cumulative(area, ["city", "star"])).split("== Physical Plan ==")[1]
    assert text.count("Exchange hashpartitioning(city") == 2
    assert "partial_sum" in text and text.count("FileScan") <= 5


def test_pickup_reads_its_source_once(spark, plan):
    path = scratch_path(spark, "area")
    spark.createDataFrame([], AREA_ORDERS).write.parquet(path)
    text = plan(curves.pickup_curve(spark.read.parquet(path), ["city", "star"])).split("== Physical Plan ==")[1]
    assert text.count("FileScan") == 1 and "Join" not in text


def test_a_hot_hotel_is_split_by_the_dictionary_join(spark, settings, plan, rows):
    """Without broadcast, the partition of one busy hotel goes to several tasks."""
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20k",
        shuffle__partitions="16",
    )
    base = spark.range(30000).repartition(8)
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997)
    day = F.date_add(F.to_date(F.lit("2016-01-01")), (F.col("id") % 50).cast("int"))
    bookings = base.select(
        F.col("id").alias("order_id"), hot.alias("hotel_id"), F.lit("F").alias("last_order_status"),
        day.alias("order_dt"), day.alias("arr_dt"), F.date_add(day, 2).alias("dpt_dt"),
        F.lit(None).cast("date").alias("cancel_dt"), F.lit(1).alias("price_level"), F.lit(1).alias("room_id"),
        F.lit(2.0).alias("rns"), F.lit(10.0).alias("rev"),
    )
    dictionary = spark.range(1000).select(
        F.col("id").alias("hotel"), F.col("id").alias("masterhotelid"), F.lit("2016").alias("updatetime"),
        F.lit(1).alias("city"), F.lit(1).alias("zone"), F.lit(1).alias("star"), F.lit(1).alias("location"),
    )
    nights = hotel_nights(bookings, dictionary)
    total = nights.agg(F.sum("rns").alias("rns"))
    assert total.collect()[0].rns == 60000.0
    assert "skew=true" in plan(total)
