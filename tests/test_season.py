from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from roomtide.functions import equal_width_band
from roomtide.model import SEGMENT_DAILY
from roomtide.operators import season
from roomtide.plans.seasons import open_history, season_runs, season_table, store_history
from roomtide.session import scratch_path

FLAGS = "htl_cd string, seg_cd string, is_pred string"


@pytest.fixture
def segments(spark):
    """Segment rows from (hotel, segment, date, rns) tuples."""
    def make(*rows):
        return spark.createDataFrame(
            [(h, s, "N", day, 0, float(n), 0.0) for h, s, day, n in rows], SEGMENT_DAILY
        )

    return make


def every_day(hotel, first, last, rns, segment="A"):
    return [(hotel, segment, first + timedelta(days=i), rns(first + timedelta(days=i)))
            for i in range((last - first).days + 1)]


def band(mean, low, high, n):
    """Smallest band number whose upper edge reaches the mean, else 0."""
    hits = [i for i in range(1, n + 1) if (high - low) * i / n + low + 0.0001 >= mean]
    return hits[0] if hits else 0


def test_bands_by_brute_force(spark):
    values = [(float(v) / 8,) for v in range(0, 81)]
    got = spark.createDataFrame(values, "x double").select(
        "x", equal_width_band(F.col("x"), F.lit(0.0), F.lit(10.0), 5).alias("b")
    )
    assert all(r.b == band(r.x, 0.0, 10.0, 5) for r in got.collect())
    above = spark.range(1).select(equal_width_band(F.lit(11.0), F.lit(0.0), F.lit(10.0), 5).alias("b"))
    assert above.collect()[0].b == 0


def test_one_value_gives_the_first_band(spark):
    got = spark.range(1).select(equal_width_band(F.lit(3.0), F.lit(3.0), F.lit(3.0), 5).alias("b"))
    assert got.collect()[0].b == 1


def test_whole_season_table_by_brute_force(spark, segments, rows):
    first, train_end = date(2015, 1, 1), date(2016, 3, 31)
    demand = lambda day: (day.isocalendar()[1] * 7) % 23 + day.weekday()
    data = every_day("H1", first, date(2016, 6, 30), demand)
    data += every_day("H1", first, date(2016, 6, 30), lambda day: 1000, segment="X")
    flags = spark.createDataFrame([("H1", "X", "N"), ("H1", "A", "Y"), ("H2", "A", "N")], FLAGS)
    weeks, bands = 2, 5
    start, end = date(2016, 1, 1), date(2017, 12, 31)

    per_bucket = {}
    for _, _, day, n in every_day("H1", first, train_end, demand):
        per_bucket.setdefault(day.isocalendar()[1] // weeks, []).append(n)
    means = {b: sum(v) / len(v) for b, v in per_bucket.items()}
    low, high = min(means.values()), max(means.values())
    expected, day = [], start
    while day <= end:
        s = band(means[day.isocalendar()[1] // weeks], low, high, bands)
        if expected and expected[-1][1] == s:
            expected[-1][3] = day
        else:
            expected.append(["H1", s, day, day])
        day += timedelta(days=1)
    got = season_runs(season.history_of(segments(*data)), flags, first, train_end, start, end, weeks, bands)
    assert rows(got, "htl_cd", "season_id", "start_dt", "end_dt") == sorted(map(tuple, expected), key=repr)


def test_short_history_takes_the_template(spark, segments, rows):
    train_start, train_end = date(2015, 1, 1), date(2016, 1, 1)
    data = every_day("H1", train_start, train_end, lambda day: 5)
    data += every_day("H10", date(2015, 1, 2), train_end, lambda day: 5)
    flags = spark.createDataFrame([], FLAGS)
    got = season_table(
        season.history_of(segments(*data)), flags, train_start, train_end, date(2016, 1, 1), date(2016, 1, 31),
        ["V_HTL#1####a#b", "V_HTL#2####c#d"],
    )
    assert rows(got) == [
        ("H1", "H1#1####2016-01-01#2016-01-31"),
        ("H10", "H10#1####a#b"), ("H10", "H10#2####c#d"),
    ]


def test_excluded_segments_count_as_history_but_not_as_demand(spark, segments):
    data = [("H1", "X", date(2015, 1, 1), 9)] + every_day("H1", date(2015, 2, 1), date(2016, 1, 1), lambda d: 1)
    flags = spark.createDataFrame([("H1", "X", "N")], FLAGS)
    history = season.history_of(segments(*data))
    weekly = season.weekly_mean(history, flags, date(2014, 1, 1), date(2016, 1, 1), 2)
    assert {r.mean_rns for r in weekly.collect()} == {1.0}
    assert season.short_history_hotels(history, date(2014, 1, 1), date(2016, 1, 1)).count() == 0


def test_runs_split_on_change_and_keep_single_days(spark, rows, d):
    day = lambda i: d("2016-01-01") + timedelta(days=i)
    dated = spark.createDataFrame(
        [("H", day(i), s) for i, s in enumerate([1, 1, 2, 1, None, None, 3])],
        "htl_cd string, live_dt date, season_id int",
    )
    runs = season.runs(dated)
    assert rows(runs, "season_id", "start_dt", "end_dt") == sorted(
        [(1, day(0), day(1)), (2, day(2), day(2)), (1, day(3), day(3)), (None, day(4), day(5)), (3, day(6), day(6))],
        key=repr,
    )
    assert rows(season.seasons_without_history(runs), "start_dt") == [(day(4),)]


def test_bucket_without_history_has_no_season(spark):
    banded = spark.createDataFrame([("H", 0, 1.0, 2)], "htl_cd string, bucket int, mean_rns double, season_id int")
    dated = season.calendar(banded, date(2016, 1, 4), date(2016, 1, 12), 2).collect()
    assert [r.season_id for r in sorted(dated, key=lambda r: r.live_dt)] == [2] * 7 + [None] * 2


def test_season_table_equals_its_runs(spark, segments, rows):
    """Random demand with holes: complete hotels have the lines of their runs, all others the template."""
    import random

    random.seed(3)
    first, train_end = date(2014, 6, 1), date(2016, 3, 31)
    data = []
    for h in range(12):
        begin = first + timedelta(days=80 * h)
        data += [(f"H{h}", s, day, random.randint(0, 9)) for i in range((train_end - begin).days + 20) for day in [begin + timedelta(days=i)]
                 for s in "AX" if random.random() < (0.3 if h % 2 else 0.03)]
    data += [("OnlyX", "X", first + timedelta(days=i), 4) for i in range(600)] + [("Late", "A", date(2017, 1, 1), 1)]
    flags = spark.createDataFrame([(f"H{h}", "X", "N") for h in range(0, 12, 3)] + [("OnlyX", "X", "N")], FLAGS)
    history, args = season.history_of(segments(*data)), (flags, date(2014, 9, 1), train_end, date(2015, 12, 28), date(2017, 3, 3))
    found = season_table(history, *args, ["V_HTL#t"], 3, 4)
    runs = season_runs(history, *args, 3, 4)
    with_gap = {r.htl_cd for r in season.incomplete_hotels(runs).collect()}
    own = [r for r in rows(season.season_lines(runs)) if r[0] not in with_gap]
    hotels = {r.htl_cd for r in history.first.collect()}
    assert with_gap and own and rows(found) == sorted(own + [(h, f"{h}#t") for h in hotels - {r[0] for r in own}], key=repr)


def test_a_stored_history_is_read_by_its_months(spark, segments, rows, plan):
    path = scratch_path(spark, "history")
    data = [(f"H{i % 5}", "A", date(2015, 1, 1) + timedelta(days=i), i % 7) for i in range(900)]
    history = store_history(segments(*data, ("H0", "A", None, 5)), path)
    flags = spark.createDataFrame([("H4", "A", "N")], FLAGS)
    dates = (date(2015, 2, 10), date(2016, 3, 31), date(2016, 1, 1), date(2016, 12, 31))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = season_table(history, flags, *dates, ["V_HTL#t"])
        text = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ">= 201502)" in text.replace("\n", " ") and "<= 201603)" in text
    assert any("month#" in part.split("PushedFilters")[0] for part in text.split("PartitionFilters: ")[1:])
    assert "GreaterThanOrEqual(live_dt,2015-02-10)" in text and "LessThanOrEqual(live_dt,2016-03-31)" in text
    assert text.count("Scan ") <= 3 and text.count("Exchange hashpartitioning") <= 7
    assert rows(table) == rows(season_table(season.history_of(segments(*data)), flags, *dates, ["V_HTL#t"]))
    # a month that comes again replaces itself alone
    store_history(segments(("H9", "A", date(2015, 1, 3), 1)), path)
    again = open_history(spark, path)
    assert again.days.where("month = 201501").count() == 1 and again.days.count() == 900 - 31 + 1
    assert rows(again.first.where("htl_cd in ('H9', 'H0')"), "htl_cd", "first_dt") == [("H0", date(2015, 2, 5)), ("H9", date(2015, 1, 3))]
