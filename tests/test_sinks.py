"""Sinks: partitioned write, idempotent partition overwrite, append + distinct, raw table DDL; scratch folders."""

import pytest
from pyspark.sql import functions as F

from starmart.schemas import RAW_COLUMNS
from starmart.sources.sinks import append_table, create_raw_table, write_table


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(2022, "a"), (2023, "b")], "ano int, v string")
    write_table(df, path=p, partition_by=["ano"])
    again = spark.createDataFrame([(2023, "b2")], "ano int, v string")
    write_table(again, path=p, mode="overwrite_partitions", partition_by=["ano"])
    write_table(again, path=p, mode="overwrite_partitions", partition_by=["ano"])
    got = sorted((r["ano"], r["v"]) for r in spark.read.parquet(p).collect())
    assert got == [(2022, "a"), (2023, "b2")]
    # partition pruning reaches the scan
    plan = spark.read.parquet(p).filter(F.col("ano") == 2022)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_append_then_distinct(spark, tmp_path):
    p = str(tmp_path / "raw")
    df = spark.createDataFrame([("x", "1"), ("y", "2")], "a string, b string")
    append_table(df, path=p)
    append_table(df, path=p)
    r = spark.read.parquet(p)
    assert r.count() == 4 and r.distinct().count() == 2


def test_create_raw_table(spark, tmp_path):
    create_raw_table(spark, "raw_landing_test", str(tmp_path / "landing"))
    create_raw_table(spark, "raw_landing_test", str(tmp_path / "landing"))
    assert spark.table("raw_landing_test").columns == RAW_COLUMNS
    spark.sql("DROP TABLE raw_landing_test")


def test_landing_is_dealt_out_only_when_asked(spark):
    from starmart.sources.tables import fines_raw

    sf = "/root/testdata/sf0.001"
    plan = lambda n: fines_raw(spark, sf, partitions=n)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(7)" in plan(7) and "RoundRobinPartitioning" not in plan(None)


def test_scratch_folders_can_be_dropped(spark, tmp_path):
    import pytest

    from starmart.session import drop_work, work_dir

    path = work_dir(spark, "to_drop")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_work(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        drop_work(spark, str(tmp_path))


@pytest.mark.parametrize("most", ["0", "1000"])
def test_distinct_of_a_written_table_moves_digests_only(spark, tmp_path, most):
    from starmart.operators.distinct import distinct_written

    texts = [("a", None), (None, "a"), (None, None), (None, None), ("a", "b"), ("a", "b"), ("", None), (None, ""), ("-", "1:a"), ("1:", "a"), ("1:a", ""), ("ab", ""), ("", "ab")]
    df = spark.createDataFrame(texts, "x string, y string")
    many = spark.range(70_000).select((F.col("id") % 40_000).cast("string").alias("x"), F.lit("w" * 200).alias("y"))
    for part in (df, df, many.repartition(3), many.coalesce(1)):
        part.write.mode("append").parquet(f"{tmp_path}/t")
    spark.conf.set("starmart.broadcast.maxRows", most)
    try:
        got = distinct_written(spark, f"{tmp_path}/t", df.schema)
        key = lambda r: repr(tuple(r))
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, df.union(many).distinct().collect()), key=key)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("hashpartitioning" in plan) == (most == "0"), plan
        assert distinct_written(spark, f"{tmp_path}/t", df.limit(0).schema).count() == 40_011
        df.limit(0).write.parquet(f"{tmp_path}/none")
        assert distinct_written(spark, f"{tmp_path}/none", df.schema).count() == 0
    finally:
        spark.conf.unset("starmart.broadcast.maxRows")
