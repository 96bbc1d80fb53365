"""A key holding a third of all rows: the fact lookup is split by AQE, aggregates pre-combine, results stay whole."""

from pyspark.sql import functions as F

from starmart.operators.joins import lookup_key
from starmart.operators.keys import build_dimension


def test_hot_key_lookup_is_split(spark):
    n = 90_000
    fact = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        F.col("id"),
    )
    dim = build_dimension(fact, ["k"], "sk")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = lookup_key(fact, dim.df, ["k"], "sk", dim_rows=None)
        assert out.count() == n  # whole result, nothing dropped
        assert out.filter(F.col("sk").isNull()).count() == 0
        out.collect()  # runs this DataFrame's own plan, so its final adaptive plan can be read
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan.lower(), plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot = out.filter(F.col("k") == "HOT").count()
    assert hot == n // 3


def test_hot_group_aggregates_pre_combine(spark):
    df = spark.range(0, 60_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise("c").alias("k"))
    g = df.groupBy("k").count()
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert {r["k"]: r["count"] for r in g.collect()} == {"HOT": 20_000, "c": 40_000}


def test_semi_join_pre_combines_hot_key(spark):
    from starmart.operators.joins import semi_join

    left = spark.range(0, 100).withColumnRenamed("id", "k")
    right = spark.range(0, 60_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    out = semi_join(left, right, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert sorted(r["k"] for r in out.collect()) == list(range(50))
