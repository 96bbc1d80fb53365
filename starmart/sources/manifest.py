"""Idempotent load: a written manifest of the loaded files, so that loading the same files again appends nothing.

The rows of one load are written below ``rows/carga=<load>`` and count only once the manifest names that load: a load
that breaks off half-way leaves rows that no reader takes, and is simply run again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.operators.joins import maybe_broadcast
from starmart.schemas import RAW_COLUMNS
from starmart.sources.ingest import read_once

MANIFEST_SCHEMA = "path string, length long, modified timestamp, load string"
LOAD = "carga"
_ROWS = ", ".join(f"{c} string" for c in RAW_COLUMNS) + f", source_file string, {LOAD} string"


@dataclass
class Load:
    load: str | None  # None: nothing was new
    files: int
    rows: int


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def list_files(spark: SparkSession, paths: list[str] | str, recursive: bool = False, pattern: str = "*.csv") -> DataFrame:
    """(path, length, modified) of the files; their content is not read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(paths).select("path", "length", F.col("modificationTime").alias("modified"))


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """Loaded files (path, length, modified, load); empty before the first load."""
    path = f"{target.rstrip('/')}/manifest"
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], MANIFEST_SCHEMA)


def append_new_files(spark: SparkSession, paths: list[str] | str, target: str, sep: str = ";", recursive: bool = False, pattern: str = "*.csv") -> Load:
    """Load the files that the manifest of ``target`` does not name, and enter them in it.

    A file is known by its path, length and modification time.  A known path with another length or time is an
    error: its old rows are loaded already, and adding the new ones would count some twice.
    """
    done, base = manifest(spark, target), target.rstrip("/")
    new = list_files(spark, paths, recursive, pattern).join(done.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
    again = [r["path"] for r in new.join(done.select("path").distinct(), "path", "left_semi").orderBy("path").limit(5).collect()]
    if again:
        raise ValueError(f"loaded files have changed since: {again}")
    found = new.collect()  # file names only
    if not found:
        return Load(None, 0, 0)
    load, seen = uuid.uuid4().hex, Observation()
    rows = read_once(spark, [r["path"] for r in found], sep).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(LOAD).parquet(f"{base}/rows")
    entries = spark.createDataFrame([(r["path"], r["length"], r["modified"], load) for r in found], MANIFEST_SCHEMA)
    entries.write.mode("append").parquet(f"{base}/manifest")
    return Load(load, len(found), int(seen.get["rows"]))


def loaded_rows(spark: SparkSession, target: str) -> DataFrame:
    """The RAW rows (+ ``source_file``, ``carga``) of every finished load."""
    loads = manifest(spark, target).select(F.col("load").alias(LOAD)).distinct()
    path = f"{target.rstrip('/')}/rows"
    if not _exists(spark, path):
        return spark.createDataFrame([], _ROWS)
    return spark.read.schema(_ROWS).parquet(path).join(maybe_broadcast(loads, loads.count()), LOAD, "left_semi")
