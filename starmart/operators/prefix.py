"""Lookup of a text in a caller's rule table by its longest matching prefix.

A prefix of n characters can only match the first n characters of a text, so each distinct text is asked once per
length that occurs among the rules, as an equi-join; the longest hit wins.  There is no cross join and no comparison
of every text with every rule, and a text that many rows repeat is looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import maybe_broadcast
from starmart.operators.keys import measured
from starmart.session import work_dir

MOST_LENGTHS = 1000  # distinct prefix lengths of a rule table; more is an error


def _norm(c: Column) -> Column:
    return F.upper(F.trim(c))


def longest_prefix(df: DataFrame, text: str, rules: DataFrame, prefix: str, value: str, out: str, default: str | None = None, whole_parts: bool = True) -> DataFrame:
    """``df`` with ``out``: ``value`` of the rule whose ``prefix`` is the longest that ``text`` begins with, else ``default``.

    Case and surrounding blanks do not count.  With ``whole_parts`` a prefix must end at the text's end or before a
    character that is neither letter nor digit (``218`` does not match ``2180``).  Of rules with the same prefix the
    smallest value counts; rules without prefix or value are left out; a blank or NULL text takes the default.
    """
    spark = df.sparkSession
    table = rules.select(_norm(F.col(prefix)).alias("__prefix"), F.col(value).alias("__value")).filter(F.col("__prefix") != "").filter(F.col("__value").isNotNull())
    table = table.groupBy("__prefix").agg(F.min("__value").alias("__value"))
    lengths = sorted(r[0] for r in table.select(F.length("__prefix")).distinct().limit(MOST_LENGTHS + 1).collect())
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"the rules have more than {MOST_LENGTHS} prefix lengths")
    if not lengths:
        return df.withColumn(out, F.lit(default).cast("string"))
    norm = _norm(F.col("__text"))
    asked = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(norm))
    if whole_parts:
        asked = F.filter(asked, lambda n: ~F.substring(norm, n + 1, F.lit(1)).rlike(r"[\p{L}\p{N}]"))
    texts = df.select(F.col(text).alias("__text")).filter(F.col(text).isNotNull()).distinct()
    tried = texts.select("__text", norm.alias("__norm"), F.explode(asked).alias("__n")).withColumn("__prefix", F.substring(F.col("__norm"), F.lit(1), F.col("__n")))
    hits = tried.join(maybe_broadcast(table, *measured(table)), "__prefix").groupBy("__text").agg(F.max_by("__value", "__n").alias("__found"))
    path = work_dir(spark, "prefix_hits")
    hits.write.parquet(path)
    hits = spark.read.schema(hits.schema).parquet(path)
    joined = df.join(maybe_broadcast(hits, *measured(hits)), F.col(text) == F.col("__text"), "left")
    return joined.select(*df.columns, F.coalesce(F.col("__found"), F.lit(default)).alias(out))
