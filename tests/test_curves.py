"""Curves against a plain model of the row rules, and their edge cases."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import types as T

from roomtide.model import area_orders_layout
from roomtide.operators import curves

AREA_ORDERS = area_orders_layout(T.LongType())

DIMS = ["city", "star"]


@pytest.fixture
def area(spark, d):
    """Area rows from (city, order, live, cancel, rns) tuples."""
    def make(*orders):
        return spark.createDataFrame(
            [(c, 1, 3, 1, 1, d(o), d(live), d(x), float(n), 10.0 * n) for c, o, live, x, n in orders],
            AREA_ORDERS,
        )

    return make


def model(orders, event):
    """Grid of advance days per (city, live date): sums, zero where nothing happened."""
    days = defaultdict(lambda: defaultdict(float))
    for city, order, live, cancel, rns in orders:
        when = order if event == "order" else cancel
        if when is not None:
            days[city, live][max((live - when).days, 0)] += rns
    return {
        (city, live, adv): sums.get(adv, 0.0)
        for (city, live), sums in days.items()
        for adv in range(min(sums), max(sums) + 1)
    }


def totals(grid):
    """Running totals from the largest advance day down."""
    out = {}
    for city, live in {k[:2] for k in grid}:
        running = 0.0
        for adv in sorted((k[2] for k in grid if k[:2] == (city, live)), reverse=True):
            running += grid[city, live, adv]
            out[city, live, adv] = running
    return out


def got(df):
    rows = df.collect()
    out = {(r.city, r.live_dt, r.adv_days): r.rns for r in rows}
    assert len(out) == len(rows)
    assert all(abs(r.rev - 10 * r.rns) < 1e-6 for r in rows)
    return out


def test_all_curves_equal_the_model(area, d):
    rng = random.Random(7)
    start = d("2016-01-01")
    orders = []
    for _ in range(400):
        live = start + timedelta(days=rng.randrange(6))
        order = live - timedelta(days=rng.randrange(-2, 30))
        cancel = order + timedelta(days=rng.randrange(40)) if rng.random() < 0.4 else None
        orders.append((rng.randrange(3), order, live, cancel, rng.randrange(1, 9)))
    frame = area(*[(c, str(o), str(l), str(x) if x else None, n) for c, o, l, x, n in orders])
    booked = model(orders, "order")
    valid = model([o for o in orders if o[3] is None], "order")
    gone = model(orders, "cancel")
    pickup = {k: v - gone.get(k, 0.0) for k, v in booked.items()}
    for expected, plain, running in (
        (booked, curves.booking_curve, None),
        (valid, curves.valid_curve, curves.valid_cumulative),
        (gone, curves.cancel_curve, curves.cancel_cumulative),
        (pickup, curves.pickup_curve, curves.pickup_cumulative),
    ):
        assert got(plain(frame, DIMS)) == expected
        if running:
            assert got(running(frame, DIMS)) == totals(expected)
            assert got(curves.cumulative(plain(frame, DIMS), DIMS)) == totals(expected)
    joined = curves.net_curve(curves.booking_curve(frame, DIMS), curves.cancel_curve(frame, DIMS), DIMS)
    assert got(joined) == pickup

    sums = curves.event_sums(frame, {"a": DIMS, "b": ["city", "zone"]})
    for name, dims in (("a", DIMS), ("b", ["city", "zone"])):
        part = sums.where(sums.pair == name)
        assert got(curves.densify(curves.pickup_part(part, dims), dims)) == pickup
        assert got(curves.densify(curves.valid_part(part, dims), dims)) == valid
        assert got(curves.densify(curves.cancel_part(part, dims), dims)) == gone


def test_invariants(area):
    frame = area((1, "2016-01-01", "2016-01-09", None, 2), (1, "2016-01-05", "2016-01-09", None, 3))
    plain = got(curves.valid_curve(frame, DIMS))
    assert sum(plain.values()) == 5.0 and len(plain) == 5
    running = got(curves.valid_cumulative(frame, DIMS))
    assert running[min(running, key=lambda k: k[2])] == 5.0


def test_range_starts_at_the_smallest_day_not_at_zero(area):
    frame = area((1, "2016-01-01", "2016-01-09", None, 1), (1, "2016-01-03", "2016-01-09", None, 1))
    assert [k[2] for k in sorted(got(curves.valid_curve(frame, DIMS)))] == [6, 7, 8]


def test_negative_days_fold_into_day_zero(area):
    frame = area((1, "2015-12-01", "2016-01-09", "2016-01-12", 1), (1, "2015-12-01", "2016-01-09", "2016-01-10", 2))
    assert [(k[2], v) for k, v in got(curves.cancel_curve(frame, DIMS)).items()] == [(0, 3.0)]


def test_cancel_outside_the_booking_days_is_lost_in_pickup(area):
    frame = area((1, "2016-01-01", "2016-01-09", "2016-01-08", 2))
    assert [(k[2], v) for k, v in got(curves.pickup_curve(frame, DIMS)).items()] == [(8, 2.0)]


def test_order_cancelled_the_same_day_nets_to_zero(area):
    frame = area((1, "2016-01-01", "2016-01-09", "2016-01-01", 2))
    assert list(got(curves.pickup_curve(frame, DIMS)).values()) == [0.0]


def test_duplicate_cancel_keys_multiply(area):
    booked = curves.booking_curve(area((1, "2016-01-01", "2016-01-09", None, 2)), DIMS)
    gone = curves.cancel_curve(area((1, "2016-01-01", "2016-01-09", "2016-01-01", 1)), DIMS)
    assert curves.net_curve(booked, gone.union(gone), DIMS).count() == 2


def test_unknown_dimension_matches_itself(area, spark):
    frame = area((None, "2016-01-01", "2016-01-09", "2016-01-01", 2))
    assert list(got(curves.pickup_curve(frame, DIMS)).values()) == [0.0]
    joined = curves.net_curve(curves.booking_curve(frame, DIMS), curves.cancel_curve(frame, DIMS), DIMS)
    assert list(got(joined).values()) == [0.0]


def test_rows_without_dates_are_on_no_curve(area):
    frame = area((1, None, "2016-01-09", None, 2), (1, "2016-01-01", None, None, 2))
    assert curves.valid_curve(frame, DIMS).count() == 0
    assert curves.pickup_curve(frame, DIMS).count() == 0


def test_ties_stay_separate_rows(spark, d):
    day = d("2016-01-09")
    curve = spark.createDataFrame(
        [(1, 3, day, 5, 1.0, 10.0), (1, 3, day, 5, 2.0, 20.0), (1, 3, day, 4, 4.0, 40.0)],
        "city long, star long, live_dt date, adv_days int, rns double, rev double",
    )
    out = sorted((r.adv_days, r.rns) for r in curves.cumulative(curve, DIMS).collect())
    assert out == [(4, 7.0), (5, 2.0), (5, 3.0)]


def test_advance_totals_keep_the_sign(area):
    frame = area((1, "2016-01-11", "2016-01-09", None, 1))
    assert [k[2] for k in got(curves.advance_totals(frame, DIMS))] == [-2]


def test_curve_rows_carry_an_empty_remark(area):
    out = curves.curve_rows(curves.valid_curve(area((1, "2016-01-01", "2016-01-02", None, 1)), DIMS), DIMS)
    assert out.columns == ["city", "star", "remark", "live_dt", "adv_days", "rns", "rev"]
    assert out.collect()[0].remark == ""
