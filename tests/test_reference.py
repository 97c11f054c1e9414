from roomtide.operators import reference
from roomtide.session import scratch_path
from roomtide.sources import read_parquet, write_partitioned


def test_segment_flags_and_their_lines(spark, rows):
    table = spark.createDataFrame([("H1", "S1", "Y", 3)], "htl_cd string, seg_cd string, is_forecast string, other int")
    flags = reference.segment_flags(table)
    assert rows(flags) == [("H1", "S1", "Y")]
    assert rows(reference.flag_lines(flags)) == [("H1#S1#Y",)]


def test_predconf_rows_are_distinct(spark, rows):
    flags = spark.createDataFrame([("H1", "S1", "Y")] * 2 + [("H1", "S2", None)], "htl_cd string, seg_cd string, is_pred string")
    assert rows(reference.predconf_rows(flags)) == [("#H1#S1###Y###",), ("#H1#S2######",)]


def test_price_model_rows_are_distinct(spark, rows):
    table = spark.createDataFrame(
        [("H1", 2, "RT", 0, 20)] * 3 + [("H1", 2, "RT", 20, 40)],
        "htl_cd string, season int, zh_rt_cd string, min_occ_pert int, max_occ_pert int",
    )
    assert rows(reference.price_model(table)) == [("1#H1#2#RT#0#20#",), ("1#H1#2#RT#20#40#",)]


def test_inventory_default_compares_whole_codes(spark, rows):
    fields = spark.createDataFrame([("H10", "tosell")], "htl_cd string, field string")
    hotels = spark.createDataFrame([("H1",), ("H10",), ("H1",)], "htl_cd string")
    assert rows(reference.inventory_field_defaults(fields, hotels)) == [("H1", "rooms"), ("H10", "tosell")]


def test_inventory_default_replaces_null_fields(spark, rows):
    fields = spark.createDataFrame([("H1", None), ("H2", None), ("H2", "tosell"), ("H9", None)], "htl_cd string, field string")
    hotels = spark.createDataFrame([("H1",), ("H2",), ("H3",)], "htl_cd string")
    assert rows(reference.inventory_field_defaults(fields, hotels)) == [("H1", "rooms"), ("H2", "tosell"), ("H3", "rooms"), ("H9", "rooms")]


def test_each_hotel_has_its_own_lines_and_shared_ones_are_stored_once(spark, rows):
    content = spark.createDataFrame([("H1", "a"), ("H2", "b"), ("H2", "c"), ("H9", "z")], "htl_cd string, line string")
    hotels = spark.createDataFrame([("H1",), ("H2",), ("H2",), ("H3",)], "htl_cd string")
    tables = reference.publish_by_hotel(content, hotels, "v1", "seasons").unionByName(reference.publish_shared(content.where("line = 'a'"), "v1", "days"))
    path = scratch_path(spark, "published")
    write_partitioned(tables, path, ["version", "name", "htl_cd"])
    assert rows(read_parquet(spark, f"{path}/version=v1/name=seasons/htl_cd=H2"), "line") == [("b",), ("c",)]
    assert rows(read_parquet(spark, f"{path}/version=v1/name=days/htl_cd=shared"), "line") == [("a",)]
    assert tables.count() == 4
