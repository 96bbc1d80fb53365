"""Connected components of an undirected graph, by alternating large and small stars.

Every step is a grouped minimum (map-side combine) and an equi-join, so no component is ever
gathered in one place; each round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import staged

MOST_ROUNDS = 100  # far above the logarithmic number needed; reaching it is an error, not a result


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges`` that is not the smallest of its component; root is the smallest.

    Nodes are longs.  Loops and repeated edges are allowed; rows with a null end are ignored;
    an empty edge table gives no rows.
    """
    u, v = F.col("u"), F.col("v")
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where(u != v).distinct()
    now = staged(now, "cc-edges")
    state = _state(now)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            break
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(v > u).join(low, "u").select(v.alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct(u.alias("u"), F.col("m").alias("v")), F.struct(v.alias("u"), F.col("m").alias("v"))))
        small = large.join(least, "u").select(pairs.alias("e")).select("e.u", "e.v").where(u != v).distinct()
        now = staged(small, "cc-round")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(u.alias("node"), v.alias("root"))
