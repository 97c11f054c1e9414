from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from catalogue import starschema as star
from roomtide.model import AREA_ORDERS, BOOKINGS, HOTEL_DICTIONARY, curve_layout
from roomtide.operators import curves
from roomtide.operators.area import area_nights
from roomtide.plans.otb import PAIRS, PARTS, pair_sums, run_daily
from roomtide.plans.reference_tables import export_hotel_folders, publish_reference_tables, reference_tables
from roomtide.plans.sql_list import SqlStatement, TableFile, open_tables, run_statements
from roomtide.session import scratch_path
from roomtide.sources import read_delimited, read_lines, read_version

SF = "/root/testdata/sf0.001"
DIRECT = {
    "cancel": curves.cancel_curve, "valid": curves.valid_curve, "pickup": curves.pickup_curve,
    "cancel_acc": curves.cancel_cumulative, "valid_acc": curves.valid_cumulative,
    "pickup_acc": curves.pickup_cumulative,
}


def test_daily_job_writes_every_curve(spark):
    first = date(1999, 1, 1)
    bookings, dictionary = star.bookings(spark, SF), star.hotel_dictionary(spark, SF)
    paths = run_daily(
        spark, bookings, dictionary, scratch_path(spark, "otb"), "now", as_of=date(2001, 7, 2), min_live_dt=first
    )
    assert len(paths) == 4 + 3 + 9 + 18 and all(p.endswith("/20010701") for p in paths.values())
    area = area_nights(bookings, dictionary, first)
    for pair in ("city_star", "zone_star"):
        for name, curve in DIRECT.items():
            measure, _, acc = name.partition("_")
            stored = read_delimited(
                spark, paths[f"{measure}_{pair}" + (f"_{acc}" if acc else "")], curve_layout(PAIRS[pair], T.LongType())
            ).drop("remark")
            direct = curve(area, PAIRS[pair])
            key = lambda r: tuple(r)[:4]
            a, b = sorted(stored.collect(), key=key), sorted(direct.collect(), key=key)
            assert [key(r) for r in a] == [key(r) for r in b]
            assert all(
                abs(x.rns - y.rns) < 1e-6 and abs(x.rev - y.rev) < 1e-4 for x, y in zip(a, b)
            )


def test_curves_of_stored_sums_need_no_exchange(spark):
    area = area_nights(star.bookings(spark, SF), star.hotel_dictionary(spark, SF), date(2000, 6, 1))
    sums = curves.event_sums(area, PAIRS)
    for pair, dims in PAIRS.items():
        path = scratch_path(spark, "sums")
        with pair_sums(sums.where(F.col("pair") == pair), dims, path, 3) as of_pair:
            for part in PARTS.values():
                both = curves.densify_both(part(of_pair, dims), dims)
                text = both._jdf.queryExecution().executedPlan().toString()
                assert "Exchange" not in text and "Bucketed: true" in text
            daily = curves.densify(curves.pickup_part(of_pair, dims), dims).collect()
            running = curves.densify_cumulative(curves.pickup_part(of_pair, dims), dims).collect()
            whole = both.collect()
        assert sorted(map(tuple, daily), key=repr) == sorted((tuple(r)[:-2] for r in whole), key=repr)
        assert sorted(map(tuple, running), key=repr) == sorted((tuple(r)[:4] + tuple(r)[-2:] for r in whole), key=repr)
        assert spark.read.parquet(path).count() == of_pair_count(sums, pair) and not [t for t in spark.catalog.listTables() if t.name.startswith("event_sums_")]


def of_pair_count(sums, pair):
    return sums.where(F.col("pair") == pair).count()


def test_text_ids_survive_a_daily_job(spark, tmp_path, rows):
    """Codes with letters and leading zeros, from the bookings' text file to the curves' text files."""
    def put(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-00000").write_text(text)
        return str(tmp_path / name)

    bookings = put("bookings", "0001#007#done#2020-02-01#2020-02-03#2020-02-05##1#1#2.0#90.0\n0002#B-9#done#2020-02-02#2020-02-03#2020-02-04#2020-02-03#1#1#1.0#40.0\n")
    line = ["", "", "", "name", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "2020-01-01"]
    hotels = []
    for hotel, master, city, zone, star_id in (("007", "007", "A12", "00", "05"), ("B-9", "007", "x", "y", "z")):
        row = list(line)
        row[0], row[2], row[4], row[5], row[7], row[13] = hotel, "L1", star_id, city, zone, master
        hotels.append("\t".join(row))
    dictionary = put("dictionary", "\n".join(hotels) + "\n")
    paths = run_daily(
        spark, read_delimited(spark, bookings, BOOKINGS), read_delimited(spark, dictionary, HOTEL_DICTIONARY, "\t"), str(tmp_path / "out"), "20200301",
    )
    assert rows(read_lines(spark, paths["valid_city_star"])) == [("A12#05##2020-02-03#2#1.0#45.0",), ("A12#05##2020-02-04#3#1.0#45.0",)]
    assert rows(read_delimited(spark, paths["area_orders_text"], AREA_ORDERS).where("cancel_dt is not null"), "city", "zone", "star", "location", "cancel_dt")[0] == ("A12", "00", "05", "L1", date(2020, 2, 3))
    assert rows(read_lines(spark, paths["cancel_zone_star_acc"])) == [("00#05##2020-02-03#0#1.0#40.0",)]


def test_reference_tables_per_hotel(spark, rows):
    flags = spark.createDataFrame([("H1", "A", "Y"), ("H2", "A", "N")], "htl_cd string, seg_cd string, is_pred string")
    bar_map = spark.createDataFrame(
        [("H1", 1, "RT", 0, 50)], "htl_cd string, season int, zh_rt_cd string, min_occ_pert int, max_occ_pert int"
    )
    seasons = spark.createDataFrame([("H1", "s1"), ("H2", "s2"), ("H9", "s9")], "htl_cd string, line string")
    fields = spark.createDataFrame([("H1", "tosell")], "htl_cd string, field string")
    others = {"specialday": spark.createDataFrame([("day1",), ("day2",)], "line string")}
    hotels = spark.createDataFrame([("H1",), ("H2",)], "htl_cd string")
    tables = reference_tables("v1", hotels, flags, bar_map, seasons, fields, others)
    assert rows(tables.where("htl_cd = 'H2'"), "name", "line") == [
        ("invt_field_config", "H2#rooms"), ("predconf", "#H2#A###N###"), ("season", "s2"),
    ]
    assert rows(tables.where("htl_cd = 'shared'"), "name", "line") == [
        ("is_predict", "H1#A#Y"), ("is_predict", "H2#A#N"), ("price_model", "1#H1#1#RT#0#50#"), ("specialday", "day1"), ("specialday", "day2"),
    ]
    root = scratch_path(spark, "versions")
    publish_reference_tables(tables, root, "v1")
    assert rows(read_version(spark, root, "v1")) == rows(tables.select("version", "htl_cd", "name", "line"))
    assert rows(read_version(spark, root, "v1", "season", "H2"), "line") == [("s2",)]
    published = scratch_path(spark, "published")
    export_hotel_folders(tables, published)
    assert rows(read_lines(spark, f"{published}/version=v1/name=season/htl_cd=H2")) == [("s2",)]
    assert rows(read_lines(spark, f"{published}/version=v1/name=specialday/htl_cd=shared")) == [("day1",), ("day2",)]


def test_sql_list_from_files(spark, tmp_path, rows):
    def put(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-00000").write_text(text)
        return str(tmp_path / name)

    tables = open_tables(spark, [
        TableFile("boat", "number#length", put("boat", "1#9\n2#14\n")),
        TableFile("trip", "boat#day#guests", put("trip", "1#2020-05-01#4\n1#2020-05-09#3\n3#2020-05-02#1\n")),
    ])
    out = str(tmp_path / "out")
    results = run_statements(spark, tables, [
        SqlStatement("last", 8, "select max(day) as day from trip"),
        SqlStatement("off", 1, "select nonsense", enable=False),
        SqlStatement("busy", 4, "select length, sum(guests) as guests from trip join boat on boat = number group by length", out_path=out),
    ])
    assert list(results) == ["busy", "last"]
    assert rows(results["busy"].selectExpr("cast(length as int)", "cast(guests as int)")) == [(9, 7)]
    assert rows(results["last"].selectExpr("cast(day as string)")) == [("2020-05-09",)]
    assert [r[0].split("#")[0] for r in spark.read.text(out).collect()] == ["9"]


def test_sql_list_leaves_the_callers_views_alone(spark, rows):
    spark.range(3).createOrReplaceTempView("boat")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        tables = {"boat": spark.createDataFrame([("x", 1), ("y", 2)], "name string, length int"), "odd name": spark.range(1)}
        statements = [
            SqlStatement("sum", 2, "with boat2 as (select * from boat where name <> '{}') select sum(length) as s from boat2"),
            SqlStatement("view", 1, "create temporary view long_boat as select name from boat where length > 1"),
            SqlStatement("long", 3, "select * from long_boat cross join `odd name`"),
            SqlStatement("conf", 4, "set spark.sql.shuffle.partitions"),
        ]
        found = run_statements(spark, tables, statements)
        assert rows(found["sum"]) == [(3,)] and rows(found["long"], "name") == [("y",)] and found["conf"].first().value == "3"
        assert spark.table("boat").count() == 3
        assert not spark.catalog.tableExists("long_boat") and not spark.catalog.tableExists("`odd name`")
        assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("sql_list_")]
    finally:
        spark.catalog.dropTempView("boat")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_sql_list_stops_on_a_bad_statement(spark):
    with pytest.raises(Exception):
        run_statements(spark, {"t": spark.range(1)}, [SqlStatement("bad", 1, "select x from t")])
