"""Published versions: files, pruning, and what a reader sees while and after a job fails."""

import glob

import pytest
from pyspark.sql import functions as F

from roomtide.session import scratch_path
from roomtide.sources import manifest, prune, publish_version, read_version, versions


def tables(spark, hotels, names=("flags", "season"), word="a"):
    rows = spark.range(hotels).selectExpr("concat('HTL', lpad(id, 6, '0')) as htl_cd", f"concat('{word}', id) as line")
    return rows.select("htl_cd", F.explode(F.array(*map(F.lit, names))).alias("name"), "line")


def files(root):
    return glob.glob(f"{root}/data/**/*.parquet", recursive=True)


def test_files_do_not_grow_with_the_number_of_hotels(spark):
    few, many = scratch_path(spark, "few"), scratch_path(spark, "many")
    publish_version(tables(spark, 300), few, "v1", buckets=4)
    publish_version(tables(spark, 30_000), many, "v1", buckets=4)
    assert len(files(few)) == len(files(many)) == 2 * 4
    assert read_version(spark, many, "v1").count() == 60_000


def test_one_hotel_reads_one_folder_of_each_table(spark, rows, plan):
    root = scratch_path(spark, "one")
    entry = publish_version(tables(spark, 3000, ("flags", "season", "prices")), root, "v1", buckets=8)
    assert entry["rows"] == {"flags": 3000, "season": 3000, "prices": 3000}
    one = read_version(spark, root, "v1", hotel="HTL000007")
    assert rows(one, "name", "line") == [("flags", "a7"), ("prices", "a7"), ("season", "a7")]
    text = plan(one)
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(htl_cd,HTL000007)" in text
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metadata().get("PartitionFilters").isDefined()
    opened = read_version(spark, root, "v1", "flags", "HTL000007")._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert opened.execute().getNumPartitions() == 1
    sorted_files = spark.read.parquet(files(root)[0]).select("htl_cd").collect()
    assert [r.htl_cd for r in sorted_files] == sorted(r.htl_cd for r in sorted_files)


def test_a_failed_job_leaves_the_old_version(spark, rows):
    root = scratch_path(spark, "failing")
    publish_version(tables(spark, 20), root, "v1", buckets=2)
    bad = tables(spark, 20, word="b").withColumn("line", F.expr("if(line = 'b17', raise_error('stop'), line)"))
    with pytest.raises(Exception, match="stop"):
        publish_version(bad, root, "v1", buckets=2)
    with pytest.raises(Exception, match="stop"):
        publish_version(bad, root, "v2", buckets=2)
    assert versions(spark, root) == ["v1"] and rows(read_version(spark, root, "v1", "flags", "HTL000017"), "line") == [("a17",)]
    with pytest.raises(ValueError):
        read_version(spark, root, "v2")
    tables(spark, 5).write.parquet(f"{root}/data/v1/left-over")
    assert "left-over" in prune(spark, root) and rows(read_version(spark, root, "v1", "flags", "HTL000003"), "line") == [("a3",)]


def test_a_new_run_replaces_the_version_at_once(spark, rows):
    root = scratch_path(spark, "again")
    first = publish_version(tables(spark, 20), root, "v1", buckets=2)
    before = read_version(spark, root, "v1")
    second = publish_version(tables(spark, 10, ("season",), "b"), root, "v1", buckets=3)
    assert before.count() == 40  # who opened the version before still reads all of that
    assert read_version(spark, root, "v1").count() == 10 and manifest(spark, root, "v1") == second
    assert prune(spark, root) == [first["run"]] and prune(spark, root) == []
    assert read_version(spark, root, "v1").count() == 10


def test_odd_rows(spark, rows):
    root = scratch_path(spark, "odd")
    odd = spark.createDataFrame([("", "t", None), ("7", "t", ""), ("007", "t", "x"), ("a/b", "n=1", "x"), ("a/b", "n=1", "x")], "htl_cd string, name string, line string")
    publish_version(odd, root, "v 1")
    assert rows(read_version(spark, root, "v 1"), "htl_cd", "name", "line") == rows(odd)
    assert rows(read_version(spark, root, "v 1", hotel="7"), "line") == [("",)]
    with pytest.raises(Exception, match="no htl_cd"):
        publish_version(odd.withColumn("htl_cd", F.lit(None).cast("string")), root, "v 1")
    empty = scratch_path(spark, "empty")
    publish_version(odd.where("false"), empty, "v1")
    assert read_version(spark, empty, "v1").count() == 0 and versions(spark, empty) == ["v1"]
