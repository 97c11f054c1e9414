from datetime import date

import pytest

from roomtide.operators.backtest import backtest_windows, hotel_history_span, hotel_units
from roomtide.operators.ranking import with_range, with_row_index


def test_windows(spark, d, rows):
    spans = spark.createDataFrame(
        [("H1", d("2015-01-01"), d("2015-01-12")), ("H2", d("2015-01-01"), d("2016-12-31"))],
        "htl_cd string, min_dt date, max_dt date",
    )
    got = backtest_windows(spans, date(2015, 1, 22), 0.75, 0.5, 7)
    assert rows(got) == [
        # 11 days: 8 train, 5 test; 20 days up to the day before: 15 train, 10 test
        ("H1", d("2015-01-02"), d("2015-01-09"), d("2015-01-01"), d("2015-01-09"), d("2015-01-07"), d("2015-01-12")),
        ("H2", d("2015-01-09"), d("2015-01-16"), d("2015-01-01"), d("2015-01-16"), d("2015-01-11"), d("2015-01-21")),
    ]


def test_history_span(spark, d, rows):
    seg = spark.createDataFrame(
        [("H1", d("2015-01-05")), ("H1", d("2015-01-01")), ("H2", d("2016-01-01"))], "htl_cd string, live_dt date"
    )
    assert rows(hotel_history_span(seg)) == [
        ("H1", d("2015-01-01"), d("2015-01-05")), ("H2", d("2016-01-01"), d("2016-01-01")),
    ]


def units_of(codes, p):
    """Blocks of the list, the leftover hotels one each to the first units."""
    p = min(p, len(codes))
    q = len(codes) // p
    blocks = [codes[i * q:(i + 1) * q] for i in range(p)]
    for i, code in enumerate(codes[p * q:]):
        blocks[i].append(code)
    return {code: i for i, block in enumerate(blocks) for code in block}


@pytest.mark.parametrize("n,p", [(1, 1), (2, 5), (5, 2), (7, 3), (12, 3), (14, 4)])
def test_units_by_brute_force(spark, n, p):
    codes = sorted(f"H{i}" for i in range(n))
    hotels = spark.createDataFrame([(c,) for c in reversed(codes)], "htl_cd string")
    assert {r.htl_cd: r.unit_no for r in hotel_units(hotels, p).collect()} == units_of(codes, p)


def test_row_index_over_many_ranges(spark):
    out = with_row_index(spark.range(1000).selectExpr("id * 3 as k"), "k", 16)
    assert all(r.k == r.row_index * 3 and r.row_total == 1000 for r in out.collect())


def test_row_index_of_nothing(spark):
    assert with_row_index(spark.range(0), "id").count() == 0


@pytest.mark.parametrize("code", ["concat('HTL', lpad(id, 6, '0'))", "cast(id as string)", "concat('a common beginning of every code ', id % 7, '/', id)"])
def test_codes_with_a_common_beginning_spread_over_all_ranges(spark, code):
    codes = spark.range(8000).selectExpr(f"{code} as htl_cd")
    sizes = [r["count"] for r in with_range(codes, "htl_cd", 64).groupBy("__range").count().collect()]
    assert 60 <= len(sizes) <= 65 and max(sizes) < 8000 * 0.15
    found = {r.htl_cd: r.unit_no for r in hotel_units(codes.unionByName(codes).unionByName(codes.limit(1).selectExpr("cast(null as string) as htl_cd")), 7).collect()}
    assert found == units_of(sorted(r.htl_cd for r in codes.collect()), 7)


def test_units_are_planned_without_a_job(spark):
    spark.sparkContext.setJobGroup("units", "units")
    hotel_units(spark.range(50).selectExpr("cast(id as string) as htl_cd"), 7)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("units")) == 0
