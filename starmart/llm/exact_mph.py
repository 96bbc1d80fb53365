"""Exact dedup: a minimal perfect hash over the historical distinct digests.

The index is sharded by digest.  In each shard a level-wise minimal perfect hash gives
every historical digest its own slot; the slot holds the full 32-byte digest and the
winner's locator (doc_id and row number).  A lookup computes one slot and compares all 32
bytes, so a digest that is not in the history is never taken for a member; members take
the winner of their slot, nonmembers are grouped among themselves.

Only distinct digests are looked up (new rows are pre-aggregated with a map-side combine),
so a text that a third of all rows repeat is one row of every shuffle but the last join,
which adaptive execution can split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACE, mix64, staged, text_or_empty, with_decisions

SHARD_ROWS = 50_000  # digests a shard of the index holds on average
GAMMA = 1.5  # slots tried per key and level
INDEX_SCHEMA = "shard long, sizes array<int>, bits binary, digests binary, null_id binary, ids binary, rows binary, counts binary"


def _level_slot(words: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(words[:, 0] ^ (words[:, 1] * np.uint64(2 * level + 1)), level) % np.uint64(size)).astype(np.int64)


def build_mph(digests: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the concatenated slot bits (one byte each) for distinct 32-byte digests (n, 32) uint8.

    A key keeps its slot on the first level where no other remaining key wants it; its
    perfect-hash value is the number of set bits before that slot.
    """
    words = digests.view(np.uint64).reshape(-1, 4)
    sizes: list[int] = []
    bits: list[np.ndarray] = []
    left = np.arange(len(words))
    while len(left):
        size = max(8, int(GAMMA * len(left)))
        slot = _level_slot(words[left], len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[slot]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def mph_slots(digests: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Perfect-hash value of each digest; -1 where no level has a set bit (certainly no member)."""
    words = digests.view(np.uint64).reshape(-1, 4)
    rank = np.cumsum(bits) - 1
    out = np.full(len(words), -1, np.int64)
    left, base = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not len(left):
            break
        at = base + _level_slot(words[left], level, size)
        hit = bits[at].astype(bool)
        out[left[hit]] = rank[at[hit]]
        left = left[~hit]
        base += size
    return out


def _digest_matrix(col: pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(col.to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(-1, 32).copy()


def _build_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    d = _digest_matrix(table["digest"])
    sizes, bits = build_mph(d)
    order = np.argsort(mph_slots(d, sizes, bits), kind="stable")
    num = lambda c: table[c].to_numpy()[order].astype(np.int64).tobytes()
    row = {
        "shard": [key[0].as_py()], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()], "digests": [d[order].tobytes()],
        "null_id": [table["null_id"].to_numpy(zero_copy_only=False)[order].astype(np.uint8).tobytes()],
        "ids": [num("id")], "rows": [num("row")], "counts": [num("n")],
    }
    return pa.table(row, schema=pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("digests", pa.binary()),
                                           ("null_id", pa.binary()), ("ids", pa.binary()), ("rows", pa.binary()), ("counts", pa.binary())]))


_FOUND = pa.schema([("digest", pa.binary()), ("null_id", pa.bool_()), ("id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("member", pa.bool_())])
FOUND_SCHEMA = "digest binary, null_id boolean, id long, row long, n long, member boolean"


def _lookup_shard(index: pa.Table, new: pa.Table) -> pa.Table:
    if new.num_rows == 0:
        return _FOUND.empty_table()
    d = _digest_matrix(new["digest"])
    null_id = new["null_id"].to_numpy(zero_copy_only=False).astype(bool).copy()
    ids, rows = new["id"].to_numpy().copy(), new["row"].to_numpy().copy()
    member = np.zeros(len(d), bool)
    if index.num_rows:
        ix = {c: index[c][0].as_py() for c in index.column_names}
        held = np.frombuffer(ix["digests"], np.uint8).reshape(-1, 32)
        bits = np.unpackbits(np.frombuffer(ix["bits"], np.uint8))[: sum(ix["sizes"])]
        slot = mph_slots(d, ix["sizes"], bits)
        ok = slot >= 0
        member[ok] = (held[slot[ok]] == d[ok]).all(axis=1)  # every byte of the digest
        s = slot[member]
        null_id[member] = np.frombuffer(ix["null_id"], np.uint8)[s].astype(bool)
        ids[member] = np.frombuffer(ix["ids"], np.int64)[s]
        rows[member] = np.frombuffer(ix["rows"], np.int64)[s]
    return pa.table([new["digest"].combine_chunks() if new["digest"].num_chunks != 1 else new["digest"].chunk(0), pa.array(null_id), pa.array(ids), pa.array(rows),
                     new["n"].to_numpy(), pa.array(member)], schema=_FOUND)


def _shard(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner (smallest doc_id, null ids last, then the first row) and the number of rows."""
    best = F.min(F.struct("null_id", "id", "row")).alias("w")
    return rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("n")).select("digest", "w.null_id", "w.id", "w.row", "n")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """``history``: distinct digests with their winners, as ``distinct_digests`` gives; one row per shard."""
    keyed = history.withColumn("shard", _shard(shards))
    return keyed.groupBy("shard").applyInArrow(_build_shard, INDEX_SCHEMA)


def lookup(index: DataFrame, new: DataFrame, shards: int) -> DataFrame:
    """Each distinct new digest with ``member`` and, for members, the historical winner instead of its own."""
    keyed = new.withColumn("shard", _shard(shards))
    return index.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInArrow(_lookup_shard, FOUND_SCHEMA)


def exact_dedup(docs: DataFrame, carry: list[str] | None = None, history_share: float = 0.5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every row of ``docs`` with the columns ``carry`` (default: all) and: keep_id, group_size, kept, text_sha256, from_history.

    Texts are equal when identical after each white-space run becomes one space; null counts
    as empty.  Of equal texts the row with the smallest doc_id stays (null ids last; rows that
    repeat a doc_id: exactly one stays).  ``history_share`` of the doc_id range, from its low
    end, is the history whose digests the index holds; the other rows are looked up in it.
    The result does not depend on that share.  Empty tables give no rows; columns of ``docs``
    named like an added column are replaced by it.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256", "from_history"]
    carry = [c for c in (carry if carry is not None else docs.columns) if c not in added]
    norm = F.regexp_replace(text_or_empty(), SPACE, " ")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"),
        F.col("doc_id").isNull().alias("null_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(norm, 256)).alias("digest"),
    )
    rows = staged(rows, "mph-rows")  # fixes the row numbers
    low, high = rows.where(~F.col("null_id")).agg(F.min("id"), F.max("id")).first()
    pivot = low + int((high - low) * history_share) if low is not None else 0
    old = ~F.col("null_id") & (F.col("id") <= F.lit(pivot))
    keys = rows.select("digest", "null_id", "id", "row")
    history = staged(distinct_digests(keys.where(old)), "mph-history")
    new = staged(distinct_digests(keys.where(~old)), "mph-new")
    shards = max(1, -(-max(history.count(), new.count()) // shard_rows))  # neither side of a lookup grows beyond a shard
    index = staged(build_index(history, shards), "mph-index")
    found = lookup(index, new, shards)
    both = history.withColumn("member", F.lit(True)).unionByName(found)
    groups = both.groupBy("digest").agg(F.min(F.struct("null_id", "id", "row")).alias("w"), F.sum("n").alias("group_size"), F.max("member").alias("from_history"))
    keep = F.when(~F.col("w.null_id"), F.col("w.id")).alias("keep_id")
    verdict = [keep, "group_size", (F.col("row") == F.col("w.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "from_history"]
    if carry == ["doc_id"]:
        return rows.join(groups, "digest").select("doc.*", *verdict)
    decisions = rows.select("digest", "row").join(groups, "digest").select("row", F.struct(*verdict).alias("verdict"))
    return with_decisions(rows.select("row", "doc"), decisions).select("doc.*", "verdict.*")
