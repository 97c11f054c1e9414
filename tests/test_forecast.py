import random
from datetime import date

import numpy as np
import pytest

from roomtide.model import SEGMENT_DAILY
from roomtide.operators import forecast

DAY = date(2016, 1, 4)
KEYED = "htl_cd string, seg_cd string, live_dt date, adv_days int, rns double"


@pytest.fixture
def keyed(spark):
    def make(*rows):
        return spark.createDataFrame([(h, s, DAY, a, float(n)) for h, s, a, n in rows], KEYED)

    return make


@pytest.fixture
def segments(spark):
    def make(*rows):
        return spark.createDataFrame([(h, s, m, DAY, a, float(n), 10.0 * n) for h, s, m, a, n in rows], SEGMENT_DAILY)

    return make


def test_fit_total(spark, segments, rows):
    flags = spark.createDataFrame(
        [("H", "A", "Y"), ("H", "A", "Y"), ("H", "B", "N")], "htl_cd string, seg_cd string, is_pred string"
    )
    data = segments(("H", "A", "Y", 3, 1), ("H", "A", "N", 3, 2), ("H", "B", "N", 3, 50), ("H", "C", "N", 3, 50))
    assert rows(forecast.fit_total(data, flags), "seg_cd", "adv_days", "rns", "rev") == [("FIT_TOTAL", 3, 3.0, 30.0)]


def test_pickup_matrix_places_days(segments):
    data = segments(*[("H", "A", "N", a, 1) for a in (0, 2, 3, 4, 5, 9)], ("H", "A", "N", 3, 10))
    [row] = forecast.pickup_matrix(data, [0, 3, 5]).collect()
    assert (row.d_0, row.d_3, row.d_5, row.d_over) == (1.0, 12.0, 2.0, 1.0)


@pytest.mark.parametrize("mode,plain", [("weekday", "S7-W1"), ("weekendOrNot", "S7-D"), ("noWeekday", "S7")])
def test_day_tags(spark, d, mode, plain):
    days = spark.createDataFrame([("H", d("2016-01-04")), ("H", d("2016-01-05")), ("H", d("2016-03-04"))],
                                 "htl_cd string, live_dt date")
    runs = spark.createDataFrame(
        [("H", 1, d("2015-12-01"), d("2016-02-10")), ("H", 7, d("2016-01-03"), d("2016-01-04"))],
        "htl_cd string, season_id int, start_dt date, end_dt date",
    )
    special = spark.createDataFrame([(d("2016-01-05"), 9), (d("2016-01-05"), 9)], "day date, day_code int")
    got = {r.live_dt: r.tag for r in forecast.day_tags(days, runs, special, mode, weekend=[6, 7]).collect()}
    assert got[d("2016-01-04")] == plain and got[d("2016-01-05")] == "H9"
    assert got[d("2016-03-04")].startswith("S0") and len(got) == 3


def test_same_tag(spark, d):
    days = spark.createDataFrame([("H", d("2016-01-04")), ("H", d("2016-01-05"))], "htl_cd string, live_dt date")
    assert {r.tag for r in forecast.day_tags(days, None, None, "sameTag").collect()} == {"S"}


def test_tags_by_brute_force(spark, d):
    rng = random.Random(3)
    base = d("2016-01-01").toordinal()
    runs = []
    for i in range(12):
        start = base + rng.randrange(300)
        runs.append(("H", i, date.fromordinal(start), date.fromordinal(start + rng.randrange(90))))
    runs = list({r[2]: r for r in runs}.values())
    days = [date.fromordinal(base + i) for i in range(400)]
    got = forecast.day_tags(
        spark.createDataFrame([("H", x) for x in days], "htl_cd string, live_dt date"),
        spark.createDataFrame(runs, "htl_cd string, season_id int, start_dt date, end_dt date"),
        spark.createDataFrame([], "day date, day_code int"), "noWeekday",
    )
    expected = {
        x: f"S{max((r for r in runs if r[2] <= x <= r[3]), key=lambda r: r[2], default=(0, 0))[1]}" for x in days
    }
    assert {r.live_dt: r.tag for r in got.collect()} == expected


def test_tags_among_ten_thousand_overlapping_runs(spark, d):
    """All of one hotel and month, nested, touching, open-ended and upside down."""
    rng = random.Random(8)
    base = d("2016-01-01").toordinal()
    runs = [("H", i, date.fromordinal(base + rng.randrange(31)), date.fromordinal(base + rng.randrange(31))) for i in range(10_000)]
    runs += [("H", 20_000, date(1900, 1, 1), date(9999, 12, 31)), ("Q", 1, date(1960, 3, 1), date(1970, 1, 2))]
    days = [date.fromordinal(base + i) for i in range(-5, 40)]
    data = [("H", x) for x in days] * 2 + [("Q", date(1960, 2, 29)), ("Q", date(1960, 3, 1)), ("Q", date(1970, 1, 2)), ("Q", date(1970, 1, 3)), (None, base and days[0]), ("H", None)]
    got = forecast.day_tags(
        spark.createDataFrame(data, "htl_cd string, live_dt date"),
        spark.createDataFrame(runs, "htl_cd string, season_id int, start_dt date, end_dt date"),
        spark.createDataFrame([], "day date, day_code int"), "noWeekday",
    )
    def tag(h, x):
        held = [r[2:] + (r[1],) for r in runs if r[0] == h and x and r[2] <= x <= r[3]]
        return f"S{max(held)[2] if held else 0}"
    expected = [(h, x, tag(h, x)) for h, x in data]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_blocks_hold_exactly_the_days(spark):
    from roomtide.operators import intervals
    from pyspark.sql import functions as F

    rng = random.Random(2)
    cases = [(s, s + rng.choice([0, 1, 14, 15, 16, 17, 255, 256, 300, 5000])) for s in [rng.randrange(-3000, 30000) for _ in range(60)]]
    df = spark.createDataFrame(cases, "a int, b int").select("a", "b", intervals.blocks(F.date_from_unix_date("a"), F.date_from_unix_date("b")).alias("x"))
    for r in df.collect():
        days = [x for level, block in r.x for x in range(block << 4 * level, block + 1 << 4 * level)]
        assert sorted(days) == list(range(r.a, r.b + 1)) and len(r.x) <= 30 * 3 + 8


def test_tag_history_mean(spark, d, segments, rows):
    runs = spark.createDataFrame([], "htl_cd string, season_id int, start_dt date, end_dt date")
    special = spark.createDataFrame([], "day date, day_code int")
    data = segments(("H", "A", "Y", 3, 1), ("H", "A", "N", 3, 2))
    got = forecast.tag_history_mean(data, runs, special, DAY, DAY)
    assert rows(got) == [("H", "A", "S0-W1", 3, 3.0)]
    assert forecast.tag_history_mean(data, runs, special, date(2017, 1, 1), date(2017, 2, 1)).count() == 0


def test_weighted_combine(spark, keyed, rows):
    conf = spark.createDataFrame([("H", "A", 1, "0.5,2.0")], "htl_cd string, seg_cd string, adv_days int, weights string")
    got = forecast.weighted_combine(
        keyed(("H", "A", 1, 4), ("H", "A", 2, 6)), keyed(("H", "A", 1, 10), ("H", "B", 1, 3)), conf
    )
    assert rows(got, "seg_cd", "adv_days", "rns") == [("A", 1, 22.0), ("A", 2, 6.0), ("B", 1, 0.0)]


def test_blend_weights_against_numpy(spark, keyed):
    rng = random.Random(5)
    a = [(f"H{i % 3}", f"S{i}", 1, rng.randrange(1, 40)) for i in range(60)]
    b = [(h, s, adv, rng.randrange(1, 40)) for h, s, adv, _ in a]
    y = [(h, s, adv, 2 * n + m + rng.randrange(3)) for (h, s, adv, n), (_, _, _, m) in zip(a, b)]
    got = {r.htl_cd: (r.w1, r.w2) for r in forecast.blend_weights(keyed(*y), keyed(*a), keyed(*b), ["htl_cd"]).collect()}
    for hotel in ("H0", "H1", "H2"):
        x = np.array([[p[3], q[3]] for p, q in zip(a, b) if p[0] == hotel], float)
        t = np.array([r[3] for r in y if r[0] == hotel], float)
        assert np.allclose(got[hotel], np.linalg.lstsq(x, t, rcond=None)[0])


def test_singular_blend(keyed):
    one = keyed(("H", "A", 1, 3))
    [row] = forecast.blend_weights(one, one, one, ["htl_cd", "seg_cd", "adv_days"]).collect()
    assert (row.w1, row.w2) == (1.0, 0.0)


def test_capacity_cap(spark, keyed, rows):
    caps = spark.createDataFrame([("H", 10.0), ("Z", 0.0)], "htl_cd string, capacity double")
    data = keyed(("H", "A", 1, 15), ("H", "B", 1, 5), ("H", "A", 2, 4), ("Q", "A", 1, 99), ("Z", "A", 1, 4))
    assert rows(forecast.capacity_cap(data, caps), "htl_cd", "seg_cd", "adv_days", "rns") == [
        ("H", "A", 1, 7.5), ("H", "A", 2, 4.0), ("H", "B", 1, 2.5), ("Q", "A", 1, 99.0), ("Z", "A", 1, 0.0),
    ]


def test_proportional_split(keyed, rows):
    data = keyed(("H", "A", 1, 3), ("H", "B", 1, 1), ("H", "A", 2, 0), ("H", "B", 2, 0), ("H", "A", 3, 7))
    fixed = keyed(("H", "FIT_TOTAL", 1, 8), ("H", "FIT_TOTAL", 2, 8))
    assert rows(forecast.proportional_split(data, fixed), "seg_cd", "adv_days", "rns") == [
        ("A", 1, 6.0), ("A", 2, 4.0), ("A", 3, 7.0), ("B", 1, 2.0), ("B", 2, 4.0),
    ]


def test_forecast_sum(spark, segments, rows):
    matrix = forecast.pickup_matrix(segments(("H", "A", "N", 1, 2), ("H", "A", "N", 900, 3), ("H", "B", "N", 1, 7)))
    price = spark.createDataFrame([("H", "A", 10.0)], "htl_cd string, seg_cd string, price double")
    for capacity, occupancy in ((24.0, 0.5), (0.0, None), (None, None)):
        inventory = spark.createDataFrame([("H", capacity), ("Q", 1.0)], "htl_cd string, capacity double")
        assert rows(forecast.forecast_sum(matrix, price, inventory), "rns", "rev", "occupancy") == [(12.0, 50.0, occupancy)]


def test_matrix_and_sum_reuse_one_dealing(spark, segments):
    """One exchange of the fact rows for a matrix; a sum needs one more, for its own key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = segments(("H", "A", "N", 1, 2))
        price = spark.createDataFrame([], "htl_cd string, seg_cd string, price double")
        capacity = spark.createDataFrame([], "htl_cd string, capacity double")
        exchanges = lambda df: [x.split("(")[1].split(", ")[:-2] for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x]
        assert len(exchanges(forecast.pickup_matrix(stored))) == 1
        dealt = forecast.pickup_matrix(stored, dealt_by=["htl_cd", "seg_cd"])
        # the fact, the prices, the sums by date, then sums and capacities by hotel
        assert len(exchanges(forecast.forecast_sum(dealt, price, capacity))) == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_hotel_is_capped_by_its_own_column(spark, rows):
    inventory = spark.createDataFrame([("A", 10, 7), ("B", 20, 8), ("C", 30, 9), ("D", None, 5)], "htl_cd string, rooms int, tosell int")
    fields = spark.createDataFrame([("A", "tosell"), ("B", "rooms"), ("D", None), ("Z", "rooms")], "htl_cd string, field string")
    assert rows(forecast.hotel_capacity(inventory, fields)) == [("A", 7.0), ("B", 20.0), ("C", 30.0), ("D", None)]
    assert rows(forecast.hotel_capacity(inventory, fields, "tosell").where("htl_cd > 'B'")) == [("C", 9.0), ("D", 5.0)]
    wrong = fields.unionByName(spark.createDataFrame([("C", "beds")], "htl_cd string, field string"))
    with pytest.raises(Exception, match="no inventory column beds for hotel C"):
        forecast.hotel_capacity(inventory, wrong).collect()


def test_gaps_of_several_stored_forecasts(spark, tmp_path, rows, d):
    day = "htl_cd string, live_dt date"
    for name, data in {"sum": [("H", "2016-01-04"), ("H", "2016-01-04")], "a/sum": [("Q", "2016-01-05"), (None, "2016-01-04")], "a b+c%": []}.items():
        spark.createDataFrame([(h, d(x)) for h, x in data], day).write.parquet(str(tmp_path / name))
    hotels = spark.createDataFrame([("H",), ("Q",), ("Q",)], "htl_cd string")
    spans = {str(tmp_path / "sum"): (DAY, 1), f"file:{tmp_path}/a/sum/": (DAY, 2), str(tmp_path / "a b+c%"): (date(2016, 2, 28), 3), "/nowhere": (DAY, 0)}
    stored = spark.read.schema(day).parquet(*[p for p in spans if p != "/nowhere"])
    got = forecast.stored_forecast_gaps(stored, hotels, spans)
    names = {p: n for n, p in zip("xyz", spans)}
    assert sorted((names[r.dir], r.htl_cd, str(r.live_dt)) for r in got.collect()) == [
        ("x", "Q", "2016-01-04"), ("y", "H", "2016-01-04"), ("y", "H", "2016-01-05"), ("y", "Q", "2016-01-04"),
        *(("z", h, x) for h in "HQ" for x in ("2016-02-28", "2016-02-29", "2016-03-01")),
    ]
    plan = forecast.stored_forecast_gaps(stored, hotels, spans)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_forecast_gaps(spark, keyed, rows, d):
    hotels = spark.createDataFrame([("H",), ("Q",)], "htl_cd string")
    got = forecast.forecast_gaps(keyed(("H", "A", 1, 1)), hotels, DAY, 2)
    assert rows(got) == [("H", d("2016-01-05")), ("Q", d("2016-01-04")), ("Q", d("2016-01-05"))]
