"""Writers (S12-S16, U3).

* ``write_table``: Parquet files or a catalog table, optionally partitioned;
  ``mode='overwrite_partitions'`` replaces only the partitions present in the
  new data (an idempotent re-load of one year/month), the safe replacement
  for appending the same load twice.
* ``write_with_totals``: a write that counts rows on the way (all, and per load).
* ``write_bucketed``: a catalog table bucketed by a join key.
* ``append_table``: plain append (a batch insert into the landing table).
* ``create_raw_table``: the 25-text-column landing table, created if absent.
* ``write_jdbc``: an external database sink with a batch size; it needs a
  reachable database and is not exercised by the tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import RAW_COLUMNS


def write_table(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> None:
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    w = df.write.format(fmt)
    if mode == "overwrite_partitions":
        if not partition_by:
            raise ValueError("overwrite_partitions needs partition_by")
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w.save(path)
    else:
        w.saveAsTable(table)


def write_with_totals(df: DataFrame, path: str, by: Column | None = None, values: list | None = None, mode: str = "overwrite", partition_by: list[str] | None = None) -> dict:
    """Write ``df`` and count its rows in the same pass (G18): all of them under the key ``None``, and those of each of ``values`` of ``by``.

    ``values`` are few and known beforehand (the years of the files to be loaded).
    """
    seen, wanted = Observation(), list(values or [])
    counts = [F.count_if(by.eqNullSafe(F.lit(v))).alias(f"n{i}") for i, v in enumerate(wanted)]
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n"), *counts), path=path, mode=mode, partition_by=partition_by)
    found = seen.get
    return {None: int(found["n"]), **{v: int(found[f"n{i}"]) for i, v in enumerate(wanted)}}


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Write a catalog table (files under ``path``) bucketed and sorted by ``key``; tables with the same buckets join on it without a shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def append_table(df: DataFrame, path: str | None = None, table: str | None = None, partition_by: list[str] | None = None) -> None:
    write_table(df, path=path, table=table, mode="append", partition_by=partition_by)


def create_raw_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    cols = ", ".join(f"`{c}` STRING" for c in RAW_COLUMNS)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 5000, properties: dict | None = None) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batchsize)).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
