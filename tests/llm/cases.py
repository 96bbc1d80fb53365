"""Small documents tables with the awkward cases every operator must take."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def docs(spark, rows):
    """rows: (doc_id, text) pairs."""
    full = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


PROSE = "the river ran over old stones while seven quiet herons watched from reeds and nobody in town could say when rain began"
AWKWARD = [
    (1, PROSE), (2, PROSE), (3, None), (4, ""), (5, "  \n\t "), (None, PROSE), (7, "Äpfel " * 3000), (8, "a"), (8, "a"),
    (9, "x" * 50_000), (10, "naïve \U0001F600 text with odd spaces \x1f end"), (11, PROSE.replace(" ", "\n ")),
]
