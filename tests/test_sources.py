import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from roomtide.model import area_orders_layout, text_layout
from roomtide.session import scratch_path
from roomtide.sources import (
    Ranges, dated_path, read_delimited, read_jdbc, read_lines, read_named_fields, read_parquet, read_snapshot, snapshot_key,
    write_delimited, write_parquet, write_partitioned,
)

AREA_ORDERS = area_orders_layout(T.LongType())

LINE = "41#7003#3#5#2#2019-04-02#2019-05-17#2019-04-20#2.0#80.25"
VALID = "52#611#4#90#3#2019-06-08#2019-06-30##3.0#512.5"


def put(folder, text, name="part-00000"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_area_text_with_empty_cancel_date_and_blank_lines(spark, tmp_path):
    path = put(tmp_path / "area", f"{LINE}\n\n{VALID}\n")
    got = {r.city: r for r in read_delimited(spark, path, AREA_ORDERS).collect()}
    assert got[41].cancel_dt == date(2019, 4, 20) and got[41].rev == 80.25
    assert got[52].cancel_dt is None and got[52].live_dt == date(2019, 6, 30)


@pytest.mark.parametrize("bad", ["1#2#3", LINE.replace("80.25", "many"), LINE.replace("2019-05-17", "soon")])
def test_short_row_or_bad_value_fails(spark, tmp_path, bad):
    path = put(tmp_path / "area", f"{LINE}\n{bad}\n")
    with pytest.raises(Exception):
        read_delimited(spark, path, AREA_ORDERS).select("city", "live_dt", "rev").collect()


def test_short_row_fails_even_if_its_missing_columns_are_unused(spark, tmp_path):
    path = put(tmp_path / "area", f"{LINE}\n41#7003#3\n")
    with pytest.raises(Exception):
        read_delimited(spark, path, AREA_ORDERS).select("city").collect()


def test_trailing_empty_fields_and_quotes_are_plain(spark, tmp_path):
    path = put(tmp_path / "t", 'a#"b#\n1##\n')
    got = read_delimited(spark, path, text_layout(["x", "y", "z"])).collect()
    assert [tuple(r) for r in got] == [("a", '"b', None), ("1", None, None)]


def test_named_fields_are_picked_by_position_of_their_name(spark, tmp_path):
    path = put(tmp_path / "t", "7#H1#S1\n8#H2#S2\n")
    got = read_named_fields(spark, path, ["id", "htl_cd", "seg_cd"], ["seg_cd", "htl_cd"])
    assert sorted(map(tuple, got.collect())) == [("S1", "H1"), ("S2", "H2")]


def test_byte_order_mark_and_hidden_files(spark, tmp_path):
    folder = tmp_path / "lines"
    put(folder, "﻿one\n\ntwo\n")
    put(folder, "hidden\n", ".part")
    assert sorted(r.line for r in read_lines(spark, str(folder)).collect()) == ["one", "two"]


def test_delimited_roundtrip_compressed(spark, tmp_path):
    source = read_delimited(spark, put(tmp_path / "in", f"{LINE}\n{VALID}\n"), AREA_ORDERS)
    out = str(tmp_path / "out")
    write_delimited(source, out, compression="gzip", partitions=1)
    [part] = (tmp_path / "out").glob("part-*.gz")
    assert sorted(gzip.open(part, "rt").read().split()) == sorted([LINE, VALID])
    again = read_delimited(spark, out, AREA_ORDERS)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, source.collect()))


def test_writing_replaces_the_target(spark, tmp_path):
    out = str(tmp_path / "out")
    write_parquet(spark.range(5), out)
    write_parquet(spark.range(3), out, partitions=2)
    assert read_parquet(spark, out).count() == 3


def test_partitioned_write_keeps_other_partitions(spark, tmp_path):
    out = str(tmp_path / "out")
    write_partitioned(spark.range(4).withColumn("dt", F.lit("20160101")), out, ["dt"])
    write_partitioned(spark.range(2).withColumn("dt", F.lit("20160102")), out, ["dt"])
    write_partitioned(spark.range(1).withColumn("dt", F.lit("20160102")), out, ["dt"])
    counts = {r.dt: r["count"] for r in read_parquet(spark, out).groupBy("dt").count().collect()}
    assert counts == {20160101: 4, 20160102: 1}


def test_snapshot_reads_one_partition(spark, tmp_path, plan):
    out = str(tmp_path / "snap")
    two = spark.range(6).withColumn("dt", F.when(F.col("id") < 2, "20160510").otherwise("20160511"))
    write_partitioned(two, out, ["dt"])
    snap = read_snapshot(spark, out, "now", as_of=date(2016, 5, 12))
    assert snap.columns == ["id"] and snap.count() == 4
    assert "PartitionFilters: [isnotnull(dt" in plan(snap)


def test_snapshot_key():
    assert snapshot_key("20160510") == "20160510"
    assert snapshot_key(date(2016, 5, 10)) == "20160510"
    assert snapshot_key("now", date(2016, 3, 1)) == "20160229"
    with pytest.raises(ValueError):
        snapshot_key("now")


def test_dated_path():
    assert dated_path("/p/orders/", "now", date(2016, 5, 12)) == "/p/orders/20160511"


def test_a_jdbc_read_says_how_it_is_split(spark):
    with pytest.raises(TypeError):
        read_jdbc(spark, "jdbc:none", "t", "u", "p")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "t", "u", "p", Ranges("id", "0", "9", 1))


def test_partitioned_write_rebalances_by_folder(spark, plan):
    assert "RebalancePartitions" in plan(spark.range(4).withColumn("dt", F.lit("x")).hint("rebalance", "dt"))


def test_scratch_paths_are_fresh_and_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
