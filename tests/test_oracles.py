"""Every registered query equals its oracle SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import starschema as star
from catalogue.oracles import all_oracles
from catalogue.queries import all_queries
from check import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF, name) is None


@pytest.mark.parametrize("mapped, source, keys, value", [
    (star.fixed_totals, "lineitem", [star.HOTEL, star.LIVE, star.ADVANCE], "rns"), (star.weight_conf, "lineitem", [star.HOTEL, star.SEGMENT, star.ADVANCE], "weights"),
    (star.inventory_fields, "supplier", ["s_suppkey"], "field"), (star.inventory, "supplier", ["s_suppkey"], "rooms"),
])
def test_mapped_tables_hold_whole_tables(spark, mapped, source, keys, value):
    found = mapped(spark, SF)
    assert found.count() == star.table(spark, SF, source).selectExpr(*keys).distinct().count()
    assert 0 < found.where(f"{value} is null").count() < found.count()


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).columns == ["city", "star", "live_dt", "adv_days", "rns", "rev"]
