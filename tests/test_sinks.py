import os

import pytest

from staylake.session import scratch_dir
from staylake.sources import readers, writers


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rerun_replaces_only_its_partitions(spark):
    path = scratch_dir(spark, "mart")
    first = spark.createDataFrame([(1, 8), (2, 8), (3, 9)], "v int, month int")
    writers.write_mart(first, path, ["month"])
    writers.write_mart(spark.createDataFrame([(7, 9)], "v int, month int"), path, ["month"])
    writers.write_mart(spark.createDataFrame([(7, 9)], "v int, month int"), path, ["month"])
    back = readers.read_table(spark, path, "parquet", "v int, month int")
    assert rows_of(back) == [(1, 8), (2, 8), (7, 9)]


def test_a_large_partition_is_cut_into_several_files(spark):
    """One value holds nearly all rows; no single task may write it."""
    path = scratch_dir(spark, "hot")
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.files.maxRecordsPerFile": "0",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(300_000).selectExpr("id", "xxhash64(id) noise", "if(id < 1000, id % 3, 5) part")
        writers.write_mart(df.repartition(8), path, ["part"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(path)
    assert back.count() == 300_000
    assert back.where("part = 5").selectExpr("_metadata.file_name f").distinct().count() > 1


def test_days_are_copied_one_per_cycle_and_resume(spark):
    path = scratch_dir(spark, "days")
    source = spark.createDataFrame([(1, "2017-08-02"), (2, "2017-08-01"), (3, "2017-08-01"), (4, None)], "v int, d string")
    assert writers.copy_next_day(source, path, "d") == "2017-08-01"
    late = source.unionByName(spark.createDataFrame([(9, "2017-07-31")], "v int, d string"))
    assert [writers.copy_next_day(late, path, "d") for _ in range(3)] == ["2017-07-31", "2017-08-02", None]
    assert rows_of(readers.read_table(spark, path, "parquet", "v int, d string").select("v")) == [(1,), (2,), (3,), (9,)]


def test_a_day_cut_off_before_its_marker_is_copied_again(spark):
    path = scratch_dir(spark, "days")
    source = spark.createDataFrame([(1, "2017-08-01"), (2, "2017-08-01"), (3, "2017-08-02")], "v int, d string")
    writers.write_mart(source.where("v = 1"), path, ["d"])  # half of a day, as a cycle without a commit leaves it
    assert [writers.copy_next_day(source, path, "d") for _ in range(3)] == ["2017-08-01", "2017-08-02", None]
    assert rows_of(readers.read_table(spark, path, "parquet", "v int, d string").select("v")) == [(1,), (2,), (3,)]


def test_null_records_and_formats(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (None, "b", "c")], "k int, x string, y string")
    assert [r.k for r in writers.drop_null_records(df, ["x", "y"]).collect()] == [1, None]
    with pytest.raises(ValueError):
        readers.read_table(spark, "/nowhere", "avro", "a int")


def test_csv_files_stack_with_declared_text(spark):
    rows = [("1", 'a;"b"', None), ("007", "NA", "x\ty")]
    df = spark.createDataFrame(rows, "Id string, Name string, City string")
    paths = [scratch_dir(spark, "csv") for _ in range(2)]
    for path in paths:
        df.write.option("header", True).option("sep", ";").option("compression", "gzip").csv(f"{path}/deep")
    one = readers.read_table(spark, f"{paths[0]}/deep", "csv", df.schema, sep=";")
    assert rows_of(one) == sorted(rows, key=repr)
    assert readers.read_many(spark, paths, "csv", df.schema, sep=";").count() == 4


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_days_are_found_by_listing(spark):
    """Files of other days are not even readable, so nothing but the folder that is copied is opened."""
    stored, path = scratch_dir(spark, "by-day"), scratch_dir(spark, "days")
    days = ["2017-08-02", "2017-08-01", "2017-08-03 12:30:00", None]
    writers.write_mart(spark.createDataFrame([(i, d) for i, d in enumerate(days)], "v int, d string"), stored, ["d"])
    with open(f"{stored}/d=2017-08-02/part-0.parquet", "w") as file:
        file.write("not parquet")
    copy = lambda: writers.copy_next_folder(spark, stored, path, "d", "v int, d string")
    assert copy() == "2017-08-01"
    assert rows_of(readers.read_table(spark, path, "parquet", "v int, d string")) == [(1, "2017-08-01")]
    with pytest.raises(Exception, match="part-0.parquet"):
        copy()
    os.remove(f"{stored}/d=2017-08-02/part-0.parquet")
    assert [copy() for _ in range(3)] == ["2017-08-02", "2017-08-03 12:30:00", None]
    assert rows_of(readers.read_table(spark, path, "parquet", "v int, d string").select("v")) == [(0,), (1,), (2,)]


def test_catalog_prunes_partitions_and_recovers_new_ones(spark):
    path, table = scratch_dir(spark, "pruned"), "staylake.pruned"
    rows = spark.range(60).selectExpr("id", "cast(2016 + id % 2 as int) year", "cast(id % 3 as int) month")
    writers.create_database(spark, "staylake")
    writers.write_mart(rows.where("month < 2"), path, ["year", "month"])
    known = writers.register_partitioned(spark, table, path, rows.schema, ["year", "month"])
    assert known.count() == 40
    writers.write_mart(rows.where("month = 2"), path, ["year", "month"])
    assert spark.table(table).count() == 40
    one = writers.recover_partitions(spark, table).where("year = 2017 and month = 2")
    assert sorted(r.id for r in one.collect()) == sorted(i for i in range(60) if i % 2 == 1 and i % 3 == 2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "number of partitions" not in plan.replace("numPartitions", "")
    assert len(one.inputFiles()) < len(spark.table(table).inputFiles())


def test_without_a_shared_folder_scratch_lies_in_the_warehouse(tmp_path):
    from staylake import session

    own = session._own_folder(f"file:{tmp_path}/warehouse")
    assert own.startswith(f"file:{tmp_path}/warehouse/staylake-scratch-") and own == session._own_folder(f"file:{tmp_path}/warehouse")
