"""Merkle manifest of a data set: leaf coordinates by bitmap rank, levels by keyed slot arrays.

Every row is a leaf; the leaves of a source, by doc_id, form a tree of runs of ``FANOUT``; the sources' roots, by
source, form the top tree.  No table of leaves is sorted:

1. Each scan task marks its doc_ids in one bitmap per source and 32,768 ids (a place list while it is sparse), and
   hands them on compressed.  Bitmaps of one (source, block) are merged 64 tasks at a time.
2. The blocks' totals, summed up in key order, are the upper directory; per 64 ids of a bitmap the popcounts before
   it are the lower one.  The rank of a doc_id, its leaf's coordinate, is the sum of both and of the bits before it
   in its word.
3. The nodes of ``FANOUT ** LEVELS`` neighbouring leaves meet by key in one task, each in the slot of its coordinate;
   the slot array is reduced level by level, and every node keeps the siblings that its path passes.  So a tree of n
   leaves takes log(n) / log(729) shuffles, and a hot source is spread over all tasks.

A block of a doc_id that very many rows repeat is salted before its ranks are asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.bpe_words import pack, unpack
from starmart.llm.common import staged
from starmart.operators.joins import maybe_broadcast
from starmart.operators.keys import assign_dense_keys

FANOUT = 3
LEVELS = 6
BLOCK_BITS = 15
NULL_BLOCK = -(1 << 60)  # before every block of 64-bit ids
SPARSE = 2048  # a block of fewer ids is sent as places (2 bytes each) instead of bits
MERGED = 64  # bitmaps that meet in one task
ROWS_AT_ONCE = 8_192  # rows of one block that are ranked in one task, about
HELD_IDS = 1 << 21
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _told(value: Column) -> Column:
    """A field as the contract's hash takes it: its byte count and value, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_told(F.col(c)) for c in FIELDS[:-1]], _told(text)), 256))


def _key(source: Column) -> Column:
    """Source as a key that orders null first, then by bytes, and that groups and joins take like any other."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


# --- bitmaps ---------------------------------------------------------------------------------------------------------
_BITS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("part", pa.int64()), ("rows", pa.int64()), ("bits", pa.binary())])
BITS_SCHEMA = "tree string, block long, part long, rows long, bits binary"


def pack_bitmap(places: np.ndarray, extra: np.ndarray) -> bytes:
    """Distinct places of a block, in order, and how many more rows each stands for."""
    again = np.flatnonzero(extra)
    more = (places[again].astype(np.uint16), extra[again].astype(np.uint64))
    if len(places) < SPARSE:
        return pack(places.astype(np.uint16), np.zeros(0, np.uint8), *more)
    flags = np.zeros(1 << BLOCK_BITS, bool)
    flags[places] = True
    return pack(np.zeros(0, np.uint16), np.packbits(flags, bitorder="little"), *more)


def unpack_bitmap(data: bytes) -> np.ndarray:
    """Rows at each place of a block."""
    places, bits, at, more = unpack(data)
    rows = np.zeros(1 << BLOCK_BITS, np.int64)
    if len(bits):
        rows[:] = np.unpackbits(bits, bitorder="little")
    rows[places] = 1
    rows[at] += more.astype(np.int64)
    return rows


class Ranks:
    """Popcount directory of one block: the rank of a place is the directory entry of its word plus the bits before it."""

    def __init__(self, data: bytes):
        places, bits, at, more = unpack(data)
        if not len(bits):
            flags = np.zeros(1 << BLOCK_BITS, bool)
            flags[places] = True
            bits = np.packbits(flags, bitorder="little")
        self.words = np.ascontiguousarray(bits).view("<u8")
        self.directory = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.at, self.more = at.astype(np.int64), np.concatenate([[0], np.cumsum(more.astype(np.int64))])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Rows before each place; places that several rows share count them all."""
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.directory[word] + np.bitwise_count(below) + self.more[np.searchsorted(self.at, place)]

    def shared(self, place: np.ndarray) -> np.ndarray:
        """Whether several rows hold the place."""
        return np.isin(place, self.at)


def _bitmap_rows(held: dict[tuple[str, int], list[np.ndarray]], part: int) -> pa.RecordBatch:
    out = []
    for (tree, block), places in held.items():
        found, n = np.unique(np.concatenate(places), return_counts=True)
        out.append((tree, block, part, int(n.sum()), pack_bitmap(found, n - 1)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _BITS.types, strict=True)], schema=_BITS)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, held, n = TaskContext.get().partitionId(), {}, 0
    for batch in batches:
        trees = batch.column("tree").dictionary_encode()
        code, block, place = trees.indices.to_numpy(), batch.column("block").to_numpy(), batch.column("place").to_numpy()
        names, (own, inverse) = trees.dictionary.to_pylist(), np.unique(np.stack([code, block]), axis=1, return_inverse=True)
        inverse = inverse.reshape(-1)
        order = np.argsort(inverse, kind="stable")
        cuts = np.searchsorted(inverse[order], np.arange(own.shape[1] + 1))
        for i, (c, b) in enumerate(own.T.tolist()):
            held.setdefault((names[c], b), []).append(place[order[cuts[i]:cuts[i + 1]]])
        n += batch.num_rows
        if n >= HELD_IDS:
            yield _bitmap_rows(held, part)
            held, n = {}, 0
    if held:
        yield _bitmap_rows(held, part)


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    tree, block, group = (k.as_py() for k in key)
    rows = sum((unpack_bitmap(b.as_py()) for b in table["bits"]), np.zeros(1 << BLOCK_BITS, np.int64))
    places = np.flatnonzero(rows)
    return pa.table([[tree], [block], [group], [int(rows.sum())], [pack_bitmap(places, rows[places] - 1)]], schema=_BITS)


def bitmaps(ids: DataFrame) -> DataFrame:
    """One merged bitmap per (tree, block) of ``ids`` (tree, block, place): tree, block, rows, bits."""
    marked = staged(ids.select("tree", "block", "place").mapInArrow(_mark, BITS_SCHEMA), "merkle-bits")
    last = marked.agg(F.max("part")).first()[0]
    while last is not None:
        group = F.floor(F.col("part") / MERGED).cast("long")
        marked = staged(marked.groupBy("tree", "block", group.alias("group")).applyInArrow(_merge, BITS_SCHEMA), "merkle-bits")
        if last < MERGED:
            break
        last //= MERGED
    return marked.drop("part")


def directory(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``before``: the rows of all blocks that precede it by (tree, block)."""
    ordered = staged(blocks.orderBy("tree", "block").withColumn("at", F.monotonically_increasing_id()), "merkle-directory")
    part = F.shiftright("at", 33)
    sums = sorted(tuple(r) for r in ordered.groupBy(part).agg(F.sum("rows")).collect())  # one row per sort partition
    ends = np.cumsum([0, *(n for _, n in sums)]).tolist()
    offsets = ordered.sparkSession.createDataFrame([(p, e) for (p, _), e in zip(sums, ends)], "part long, earlier long")
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counted = ordered.withColumn("part", part).withColumn("before", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    return counted.join(F.broadcast(offsets), "part").withColumn("before", F.col("before") + F.col("earlier")).drop("part", "earlier", "at")


_RANKED = pa.schema([("tree", pa.string()), ("row", pa.int64()), ("idx", pa.int64()), ("shared", pa.bool_()), ("n", pa.int64()), ("doc_id", pa.int64()),
                     ("leaf", pa.binary()), ("other", pa.binary())])
RANKED_SCHEMA = "tree string, row long, idx long, shared boolean, n long, doc_id long, leaf binary, other binary"


def _rank(leaves: pa.Table, block: pa.Table) -> pa.Table:
    if not leaves.num_rows:
        return _RANKED.empty_table()
    ranks, place = Ranks(block["bits"][0].as_py()), leaves["place"].to_numpy()
    n, first = block["n"][0].as_py(), block["first"][0].as_py()
    columns = {"idx": pa.array(first + ranks.rank(place)), "shared": pa.array(ranks.shared(place)), "n": pa.array(np.full(len(place), n))}
    return pa.table([columns.get(c, leaves[c] if c in leaves.column_names else None) for c in _RANKED.names], schema=_RANKED)


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, block, place, row, doc_id, leaf, other) with idx, the place among the tree's n leaves by doc_id.

    Rows that share a source and doc_id follow each other by leaf hash.
    """
    blocks = directory(bitmaps(leaves))
    blocks = staged(blocks, "merkle-blocks")
    trees = blocks.groupBy("tree").agg(F.min("before").alias("base"), F.sum("rows").alias("n"))
    salts = F.ceil(F.col("rows") / ROWS_AT_ONCE).cast("long")
    blocks = blocks.join(trees, "tree").select(F.col("tree").alias("of"), F.col("block").alias("at"), (F.col("before") - F.col("base")).alias("first"), "n", "bits", "rows", salts.alias("salts"))
    blocks = staged(blocks, "merkle-ranks")
    hot = blocks.where("salts > 1").select(F.col("of").alias("tree"), F.col("at").alias("block"), "salts")
    n_hot = hot.count()
    salted = leaves.withColumn("salt", F.lit(0).cast("long"))
    if n_hot:
        salted = leaves.join(maybe_broadcast(hot, n_hot, 64 * n_hot), ["tree", "block"], "left").withColumn("salt", F.pmod("row", F.coalesce("salts", F.lit(1))))
    asked = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select("of", "at", "part", "first", "n", "bits")
    pairs = salted.select("tree", "block", "salt", "place", "row", "doc_id", "leaf", "other").groupBy("tree", "block", "salt").cogroup(asked.groupBy("of", "at", "part"))
    ranked = staged(pairs.applyInArrow(_rank, RANKED_SCHEMA), "merkle-ranked")
    shared = ranked.where("shared").select("tree", "idx", "leaf", "row")
    if shared.isEmpty():
        return ranked.drop("shared")
    order = assign_dense_keys(shared, ["tree", "idx", "leaf", "row"], "nth").df
    first = order.groupBy("tree", "idx").agg(F.min("nth").alias("least"))
    ties = order.join(first, ["tree", "idx"]).select("row", (F.col("nth") - F.col("least")).alias("tie"))
    placed = ranked.join(ties, "row", "left").withColumn("idx", F.col("idx") + F.coalesce("tie", F.lit(0)))
    return staged(placed.select(*[c for c in _RANKED.names if c != "shared"]), "merkle-placed")


# --- levels ----------------------------------------------------------------------------------------------------------
def node(children: list[bytes]) -> bytes:
    """Hash of a run: its digests as hex text."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


_NODES = pa.schema([("up", pa.bool_()), ("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.binary()),
                    ("other", pa.binary()), ("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary()))])
NODES_SCHEMA = "up boolean, tree string, idx long, n long, doc_id long, leaf binary, other binary, left array<binary>, right array<binary>"


def _reducer(levels: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Nodes of one key with the siblings left and right of them on each level, and the node they come to."""
        tree, group = key[0].as_py(), key[1].as_py()
        width = FANOUT**levels
        slot = table["idx"].to_numpy() - group * width
        n = table["n"][0].as_py()
        level: list[bytes] = [b""] * len(slot)
        for s, digest in zip(slot.tolist(), table["leaf"].to_pylist(), strict=True):
            level[s] = digest
        before, after = [], []
        while len(level) > 1 if n <= width else len(before) < levels:
            runs = [level[i:i + FANOUT] for i in range(0, len(level), FANOUT)]
            before.append([b"".join(run[:i]) for run in runs for i in range(len(run))])
            after.append([b"".join(run[i + 1:]) for run in runs for i in range(len(run))])
            level = [node(run) for run in runs]
        paths = [[[step[s // FANOUT**k] for k, step in enumerate(side)] for s in slot.tolist()] for side in (before, after)]
        nodes = [pa.array([False] * len(slot)), *[table[c] for c in ("tree", "idx", "n", "doc_id", "leaf", "other")], *[pa.array(p, pa.list_(pa.binary())) for p in paths]]
        top = [[True], [tree], [group], [-(-n // width)], [None], level, [None], [None], [None]]
        return pa.concat_tables([pa.table(nodes, schema=_NODES), pa.table(top, schema=_NODES)])

    return run


def reduce_levels(nodes: DataFrame, most: int, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Path tables, from the leaves up, and (tree, root).  ``nodes``: tree, idx, n, doc_id, leaf, other; ``most``: the largest n."""
    width, tables, roots = FANOUT**levels, [], None
    while True:
        group = F.floor(F.col("idx") / width).cast("long")
        out = staged(nodes.groupBy("tree", group.alias("group")).applyInArrow(_reducer(levels), NODES_SCHEMA), "merkle-level")
        tables.append(out.where("not up").drop("up"))
        up = out.where("up").drop("up")
        done = up.where("n = 1").select("tree", F.col("leaf").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        most = -(-most // width)
        if most <= 1:
            return tables, roots
        nodes = up.where("n > 1").drop("left", "right")


def with_paths(tables: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """The first table with left and right for all levels."""
    nodes = tables[0]
    for k, upper in enumerate(tables[1:], 1):
        n = upper.count()
        above = upper.select("tree", F.col("idx").alias("above"), F.col("left").alias("more_left"), F.col("right").alias("more_right"))
        nodes = nodes.withColumn("above", F.floor(F.col("idx") / FANOUT ** (levels * k)).cast("long")).join(maybe_broadcast(above, n, 1024 * n), ["tree", "above"], "left")
        empty = F.array().cast("array<binary>")
        for side in ("left", "right"):
            nodes = nodes.withColumn(side, F.concat(side, F.coalesce(f"more_{side}", empty)))
        nodes = nodes.drop("above", "more_left", "more_right")
    return nodes


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _fold(leaf: Column) -> Column:
    """The root that a leaf and its siblings come to."""
    return F.aggregate(F.arrays_zip("left", "right"), _hex(leaf), lambda h, run: F.sha2(F.concat(_hex(run["left"]), h, _hex(run["right"])), 256))


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, seen: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, proof_sha256, left, right, folded_root, verified.

    ``docs`` needs doc_id, source, lang, n_chars and text; other columns are not read.  ``tampered``: rows whose text
    is replaced by ``seen`` before it is verified (default: none); leaf, roots and proofs are those of ``docs``.
    ``left`` and ``right`` are the digests beside the path, level by level from the leaf.  Null fields are hashed as
    a dash, empty ones as ``0:``; leaves of null doc_ids come first, rows that share a source and doc_id follow each
    other by leaf hash, the null source comes first.  ``levels`` are reduced per shuffle.  An empty table gives no rows.  A task holds the nodes of 729
    leaves, or one block's bitmap with about 8,192 rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in FIELDS[1:]], (tampered if tampered is not None else F.lit(False)).alias("__t"),
                       (seen if seen is not None else F.col("text")).alias("__seen"))
    other = F.when(F.col("__t"), _leaf(F.col("__seen")))
    block = F.when(F.col("doc_id").isNull(), NULL_BLOCK).otherwise(F.shiftright("doc_id", BLOCK_BITS)).cast("long")
    place = F.coalesce(F.col("doc_id").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), F.lit(0)).cast("long")
    leaves = docs.select(_key(F.col("source")).alias("tree"), block.alias("block"), place.alias("place"), F.monotonically_increasing_id().alias("row"), "doc_id",
                         _leaf(F.col("text")).alias("leaf"), other.alias("other"))
    placed = coordinates(staged(leaves, "merkle-leaves"))
    most = placed.agg(F.max("n")).first()[0] or 1
    tables, subroots = reduce_levels(placed.drop("row"), most, levels)
    tops = assign_dense_keys(subroots, ["tree"], "idx", first=0)
    sources = F.lit(tops.rows).cast("long").alias("n")
    top = tops.df.select(F.lit("").alias("tree"), "idx", sources, F.lit(None).cast("long").alias("doc_id"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("other"))
    top_tables, roots = reduce_levels(top, tops.rows, levels)
    last = roots.first()  # one row, or none for an empty table
    above = with_paths(top_tables, levels).select("idx", F.col("left").alias("top_left"), F.col("right").alias("top_right"))
    size = 96 + 64 * (FANOUT - 1) * levels * len(top_tables)
    above = tops.df.join(above, "idx").select("tree", F.col("root").alias("subroot"), "top_left", "top_right")
    paths = with_paths(tables, levels).join(maybe_broadcast(above, tops.rows, size * tops.rows), "tree")
    paths = paths.withColumn("left", F.concat("left", "top_left")).withColumn("right", F.concat("right", "top_right"))
    siblings = F.transform(F.arrays_zip("left", "right"), lambda run: F.concat(_hex(run["left"]), _hex(run["right"])))
    root = F.lit(last["root"].hex() if last else None).cast("string")
    folded = _fold(F.coalesce("other", "leaf"))
    return paths.select(
        "doc_id", F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("source"), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), "left", "right", folded.alias("folded_root"), (folded == root).alias("verified"),
    )
