"""What must not grow out of one task, the driver or the disk as tables grow: seen in plans and files of small tables."""

import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from roomtide.operators import area, curves, forecast
from roomtide.operators.intervals import best_covering
from roomtide.plans.curve_jobs import daily_curve
from roomtide.operators.nights import hotel_nights
from roomtide.plans.otb import PAIRS, run_daily
from roomtide.session import FILE_CLEANUP, scratch_path, shuffles_released

DAY = date(2016, 1, 4)
AREA = "city long, zone long, star long, location long, price_level int, order_dt date, live_dt date, cancel_dt date, rns double, rev double"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_and_intervals_move_once_and_are_never_broadcast(spark, rows):
    runs = spark.createDataFrame([("H", DAY, date(2016, 3, 1), 1), ("H", date(2016, 2, 1), date(2016, 2, 9), 2), (None, DAY, DAY, 3)], "k string, a date, b date, s int")
    days = spark.createDataFrame([("H", date(2016, 2, 3)), ("H", date(2016, 2, 10)), ("H", date(2017, 1, 1)), ("H", None), (None, DAY)], "k string, live_dt date")
    found = best_covering(days, "live_dt", runs, "a", "b", F.struct("a", "s"), ["k"])
    assert rows(found, "k", "live_dt", "best.s") == [("H", date(2016, 2, 10), 1), ("H", date(2016, 2, 3), 2)]
    text = executed(found)
    assert "Broadcast" not in text and text.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in text


def test_days_are_not_multiplied_and_pairs_are_tagged_where_they_are(spark, rows):
    draw = random.Random(3)
    date_of = lambda k: date(2016, 1, 1) + timedelta(days=k)
    runs = [(h, date_of(a), date_of(a + draw.choice([-1, 0, 3, 40, 700])), s) for s in range(40) for h in "AB" for a in [draw.randrange(900)]]
    days = [(draw.choice("ABC"), date_of(draw.randrange(-30, 1700))) for _ in range(300)]
    days += days[:5] + [("A", None), (None, DAY)]
    season_runs = spark.createDataFrame(runs, "htl_cd string, start_dt date, end_dt date, season_id int")
    special = spark.createDataFrame([(date_of(k), 7) for k in range(0, 1700, 50)], "day date, day_code int")
    tagged = forecast.day_tags(spark.createDataFrame(days, "htl_cd string, live_dt date"), season_runs, special, "noWeekday")
    text = executed(tagged)
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 2  # pairs with runs, special days

    def plain(hotel, day):
        if day and (day - date_of(0)).days in range(0, 1700, 50):
            return "H7"
        held = [(a, b, s) for h, a, b, s in runs if h == hotel and day and a <= day <= b]
        return f"S{max(held)[2] if held else 0}"

    assert rows(tagged) == sorted([(h, x, plain(h, x)) for h, x in days], key=repr)


def test_daily_job_writes_compressed_files_and_does_not_deal_curves_again(spark, tmp_path):
    bookings = spark.createDataFrame(
        [(i, 1, "P", DAY, date(2016, 1, 5 + i), date(2016, 1, 8 + i), DAY if i % 3 == 0 else None, 1, 1, 2.0, 30.0) for i in range(9)],
        "order_id long, hotel_id long, last_order_status string, order_dt date, arr_dt date, dpt_dt date, cancel_dt date, price_level int, room_id int, rns double, rev double",
    )
    dictionary = spark.createDataFrame([(1, 1, 1, 1, 1, 1, "2016-01-01")], "hotel long, masterhotelid long, city long, zone long, star long, location long, updatetime string")
    paths = run_daily(spark, bookings, dictionary, str(tmp_path), "20160301", partitions=2)
    for pair in PAIRS:
        for measure in ("cancel", "valid", "pickup"):
            for acc in ("", "_acc"):
                files = spark.read.text(paths[f"{measure}_{pair}{acc}"]).inputFiles()
                assert 1 <= len(files) <= 2 and all(f.endswith(".gz") for f in files)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_daily_job_keeps_no_shuffle_files(spark, tmp_path):
    """Its steps store what they make, so an exchange needn't lie on disk beside the next one."""
    bookings = spark.range(300).repartition(3).selectExpr(
        "id as order_id", "id % 9 as hotel_id", "'P' as last_order_status", "date '2016-01-04' as order_dt", "date_add(date '2016-01-05', cast(id % 7 as int)) as arr_dt",
        "date_add(date '2016-01-08', cast(id % 7 as int)) as dpt_dt", "if(id % 3 = 0, date '2016-01-04', null) as cancel_dt", "1 as price_level", "1 as room_id", "2D as rns", "30D as rev",
    )
    dictionary = spark.range(9).selectExpr("id as hotel", "id as masterhotelid", "id % 2 as city", "id as zone", "1L as star", "1L as location", "'2016' as updatetime")
    before, setting = shuffle_files(spark), spark.conf.get(FILE_CLEANUP)
    paths = run_daily(spark, bookings, dictionary, str(tmp_path), "20160301", partitions=2)
    assert spark.conf.get(FILE_CLEANUP) == setting
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)  # they are removed behind the job's back
    assert not left
    for name in ("hotel_nights", "area_orders", "event_sums", "event_sums_city_star", "cancel_city_star_both"):
        files = spark.read.parquet(paths[name]).inputFiles()
        assert files and all(".zstd.parquet" in f for f in files)


def test_the_cleanup_setting_outlives_no_failure(spark):
    setting = spark.conf.get(FILE_CLEANUP)
    with pytest.raises(ValueError), shuffles_released(spark):
        assert spark.conf.get(FILE_CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(FILE_CLEANUP) == setting


@pytest.mark.parametrize("by", [["htl_cd", "seg_cd"], ["htl_cd", "seg_cd", "live_dt"]])
def test_a_matrix_task_sorts_narrow_rows(spark, rows, by):
    data = [("H", "A", DAY, 1, 2.0), ("H", "A", DAY, 1, 3.0), ("H", "A", DAY, 9, 4.0), ("H", "B", DAY, 0, None), (None, "A", None, 0, 1.0)]
    matrix = forecast.pickup_matrix(spark.createDataFrame(data, "htl_cd string, seg_cd string, live_dt date, adv_days int, rns double"), [0, 3], by)
    assert rows(matrix) == [("H", "A", DAY, 0.0, 5.0, 4.0), ("H", "B", DAY, None, 0.0, 0.0), (None, "A", None, 1.0, 0.0, 0.0)]
    text = executed(matrix)
    assert "Aggregate" not in text and "REPARTITION_BY_NUM" in text


def test_curve_files_can_be_compressed(spark, tmp_path):
    (tmp_path / "area").mkdir()
    (tmp_path / "area" / "part").write_text("A#Z#5#L#1#2016-01-01#2016-01-04##2.0#9.0\n")
    daily_curve(spark, "valid", ["zone", "star"], str(tmp_path / "area"), str(tmp_path / "out"), compression="gzip")
    files = spark.read.text(str(tmp_path / "out")).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["Z#5##2016-01-04#3#2.0#9.0"]


def test_event_sums_move_narrow_events_once(spark, rows):
    area = spark.createDataFrame([
        (1, 10, 5, 0, 1, date(2016, 1, 1), DAY, None, 2.0, 20.0), (1, 10, 5, 0, 1, date(2016, 1, 1), DAY, date(2016, 1, 3), None, 7.0),
        (None, 10, 5, 0, 1, date(2016, 1, 9), DAY, DAY, 1.0, 1.0), (1, 10, 5, 0, 1, None, DAY, DAY, 1.0, 1.0),
    ], AREA)
    sums = curves.event_sums(area, {"cz": ["city", "zone"], "zs": ["zone", "star"]})
    assert sums.columns == ["city", "star", "zone", "live_dt", "adv_days", "booked", "booked_rns", "booked_rev", "valid", "valid_rns", "valid_rev", "gone", "gone_rns", "gone_rev", "pair"]
    assert rows(sums.where("pair = 'cz'").drop("pair", "star", "live_dt")) == [
        (1, 10, 1, False, 0.0, 0.0, False, 0.0, 0.0, True, 0.0, 7.0), (1, 10, 3, True, 2.0, 27.0, True, 2.0, 20.0, False, 0.0, 0.0),
        (None, 10, 0, True, 1.0, 1.0, False, 0.0, 0.0, True, 1.0, 1.0),
    ]
    assert rows(sums.where("pair = 'zs'"), "zone", "star", "adv_days", "booked_rev", "gone_rev") == [(10, 5, 0, 1.0, 1.0), (10, 5, 1, 0.0, 7.0), (10, 5, 3, 27.0, 0.0)]
    text = executed(sums)
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text and "Expand" not in text


def test_stored_gaps_read_the_dates_they_ask_for(spark):
    path = scratch_path(spark, "stored")
    spark.createDataFrame([("H", DAY), ("H", date(2015, 1, 1))], "htl_cd string, live_dt date").write.parquet(path)
    gaps = forecast.stored_forecast_gaps(spark.read.parquet(path), spark.createDataFrame([("H",)], "htl_cd string"), {path: (DAY, 2)})
    assert [tuple(r) for r in gaps.collect()] == [(path, "H", date(2016, 1, 5))]
    assert "GreaterThanOrEqual(live_dt,2016-01-04)" in executed(gaps)


def test_bookings_with_areas_are_dealt_before_their_nights(spark, rows):
    bookings = spark.createDataFrame(
        [(i, h, DAY, date(2016, 1, 5), date(2016, 1, 7), c, 1, r, 30.0) for i, (h, c, r) in enumerate([(1, None, 2.0), (2, None, 4.0), (1, DAY, None), (3, None, 1.0)])],
        "order_id long, hotel_id long, order_dt date, arr_dt date, dpt_dt date, cancel_dt date, price_level int, rns double, rev double",
    )
    dictionary = spark.createDataFrame(
        [(h, 2, 1, 10, 5, 0, "2016-01-01") for h in (1, 2)], "hotel long, masterhotelid long, city long, zone long, star long, location long, updatetime string"
    )
    totals = area.area_orders_from_bookings(bookings, dictionary, dedupe=False)
    text = executed(totals)
    assert text.index("Generate explode(sequence") < text.index("REPARTITION_BY_NUM") and "sum(rns" not in text.split("REPARTITION_BY_NUM")[1]
    two = [(1, 10, 5, 0, 1, DAY, date(2016, 1, k), c, n, v) for k in (5, 6) for c, n, v in [(None, 6.0, 60.0), (DAY, None, 30.0)]]
    assert totals.columns == [*area.AREA_ORDER_KEYS, "rns", "rev"] and rows(totals) == sorted(two, key=repr)


def test_bookings_are_dealt_before_their_nights_and_nights_are_summed_in_place(spark, rows):
    late = date(2016, 1, 9)
    bookings = spark.createDataFrame(
        [(i, h, s, DAY, date(2016, 1, 5), out, c, 1, 4, r, 30.0) for i, (h, s, out, c, r) in enumerate([
            (1, "P", date(2016, 1, 7), None, 2.0), (2, "P", date(2016, 1, 7), None, 4.0), (1, "P", date(2016, 1, 7), DAY, None), (None, None, date(2016, 1, 6), late, 1.0),
            (1, "P", date(2016, 1, 6), None, 1.0), (1, "P", date(2016, 1, 5), None, 1.0),
        ])],
        "order_id long, hotel_id long, last_order_status string, order_dt date, arr_dt date, dpt_dt date, cancel_dt date, price_level int, room_id int, rns double, rev double",
    )
    dictionary = spark.createDataFrame(
        [(h, 2, 1, 10, 5, 0, "2016-01-01") for h in (1, 2)], "hotel long, masterhotelid long, city long, zone long, star long, location long, updatetime string"
    )
    nights = hotel_nights(bookings, dictionary)
    text = executed(nights)
    assert text.index("Generate explode(sequence") < text.index("REPARTITION_BY_NUM") and "sum(rns" not in text.split("REPARTITION_BY_NUM")[1]
    five, six = date(2016, 1, 5), date(2016, 1, 6)
    assert nights.columns == ["hotel_id_m", "order_status", "order_dt", "live_dt", "cancel_dt", "price_level", "sub_room_id", "rns", "rev"]
    assert rows(nights) == sorted([
        (2, "P", DAY, five, None, 1, 4, 4.0, 60.0), (2, "P", DAY, six, None, 1, 4, 3.0, 30.0), (2, "P", DAY, five, DAY, 1, 4, None, 15.0), (2, "P", DAY, six, DAY, 1, 4, None, 15.0),
        (None, None, DAY, five, late, 1, 4, 1.0, 30.0),
    ], key=repr)
    path = scratch_path(spark, "nights")
    nights.write.parquet(path)
    totals = area.area_orders(spark.read.parquet(path), dictionary)
    text = executed(totals)
    assert "REPARTITION_BY_NUM" in text and "sum(rns" not in text.split("REPARTITION_BY_NUM")[1]
    assert rows(totals) == sorted([(1, 10, 5, 0, 1, DAY, x, c, n, v) for x, c, n, v in [(five, None, 4.0, 60.0), (six, None, 3.0, 30.0), (five, DAY, None, 15.0), (six, DAY, None, 15.0)]], key=repr)
