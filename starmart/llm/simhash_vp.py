"""SimHash near-dedup over vantage-point trees.

Distinct fingerprints are spread over the leaves of a vantage-point tree whose levels look at
disjoint blocks of the 64 bits: a level sorts fingerprints into rings by the Hamming distance
of its block to the level's vantage point.  Block distances add up to the whole distance, so
the triangle bounds add up too: two fingerprints within r bits differ by at most r in the sum
of their ring numbers.  A query goes down every ring within what is left of that budget, i.e.
to its own leaf and to the boundary leaves around it; of the two fingerprints of a pair only
one travels.  Inside a leaf an ordinary vantage-point search (rings of the whole distance)
prunes large leaves further, and what remains is compared exactly.

A leaf returns a spanning forest of its links, not the links themselves, so a thousand near
copies give a thousand rows; components then join the forests.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import blocks, data_bytes, offsets, staged, text_batches, text_or_empty, with_decisions
from starmart.llm.components import components

SHINGLE_WORDS = 3  # fixed value of the contract
MOST_BITS = 2  # fixed value of the contract
SEED = 42  # fixed value of the contract
BLOCK_BYTES = 4 << 20
CHUNK_WORDS = 100_000
LEAF_PAIRS = 4_000_000  # a leaf with more pairs than this is searched by further vantage points
VANTAGE_SAMPLE = 512  # fingerprints a level's vantage point is chosen from
LEVELS = (4, 6, 8, 12, 16)
MASK = (1 << 64) - 1

_WORD = re.compile(rb"[^\x20\t-\r]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text over its lower-cased word shingles; 0 without words."""
    counts, total = np.zeros(64, np.int64), 0
    h = xxhash.xxh64_intdigest
    held: list[bytes] = []
    found = _WORD.finditer(text.translate(_LOWER))
    while True:
        more = [m.group() for m in itertools.islice(found, CHUNK_WORDS)]
        if not more:
            break
        held += more
        if len(held) >= words:
            joined = b" ".join(held)
            ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            hashes = np.array([h(joined[s:e], SEED) for s, e in zip(starts[: len(held) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)], "<u8")
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
            held = held[len(held) - words + 1:] if words > 1 else []
    if not total:
        return h(b" ".join(held), SEED) if held else 0
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            col = block.column("text")
            offs, raw = offsets(col).tolist(), data_bytes(col)
            fps = [fingerprint(raw[s:e].tobytes(), words) for s, e in zip(offs, offs[1:], strict=False)]
            i = block.schema.get_field_index("text")
            cols = [c for j, c in enumerate(block.columns) if j != i] + [pa.array(np.array(fps, np.uint64).view(np.int64))]
            names = [n for n in block.schema.names if n != "text"] + ["fp"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def bit_blocks(levels: int) -> list[int]:
    """Masks of ``levels`` disjoint blocks of near-equal width that cover 64 bits."""
    cuts = [64 * i // levels for i in range(levels + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(cuts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def steps(levels: int, reach: int) -> list[tuple[int, ...]]:
    """Ring differences a pair within ``reach`` bits can have, one of each +/- couple (all zero included)."""
    out = []

    def grow(head: tuple[int, ...], left: int) -> None:
        if len(head) == levels:
            first = next((x for x in head if x), 0)
            if first >= 0:
                out.append(head)
            return
        for x in range(-left, left + 1):
            grow((*head, x), left - abs(x))

    grow((), reach)
    return out


def vantage_points(sample: list[int], masks: list[int]) -> list[int]:
    """Per level the sampled fingerprint whose block distances spread most."""
    if not sample:
        return [0] * len(masks)
    fps = np.array([x & MASK for x in sample], np.uint64)
    out = []
    for m in masks:
        d = np.bitwise_count((fps[:16, None] ^ fps[None, :]) & np.uint64(m)).astype(float)
        out.append(int(fps[int(d.var(axis=1).argmax())]))
    return out


def levels_for(n: int) -> int:
    """Fewest levels that leave about 64 of n evenly spread fingerprints in the fullest leaf."""
    from math import comb

    for k in LEVELS:
        share = 1.0
        for m in bit_blocks(k):
            w = m.bit_count()
            share *= comb(w, w // 2) / 2**w
        if n * share <= 64:
            return k
    return LEVELS[-1]


def _leaf(fp: Column, vantage: list[int], masks: list[int], field: int, reach: int) -> Column:
    ring = lambda v, m: F.bit_count((fp.bitwiseXOR(F.lit(_signed(v)))).bitwiseAND(F.lit(_signed(m)))).cast("long") + F.lit(reach)
    out = F.lit(0).cast("long")
    for i, (v, m) in enumerate(zip(vantage, masks, strict=True)):
        out = out.bitwiseOR(F.shiftleft(ring(v, m), i * field))
    return out


class Forest:
    """Union-find over positions 0..n-1, fed with arrays of pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            a, b = a[open_], b[open_]
            low, high = np.minimum(ra, rb)[open_], np.maximum(ra, rb)[open_]
            if not len(a):
                return
            np.minimum.at(self.root, high, low)
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def search_leaf(fps: np.ndarray, members: int, reach: int) -> np.ndarray:
    """Roots (positions) after linking fps[:members] with every one of fps within ``reach`` bits."""
    forest = Forest(len(fps))

    def exact(m: np.ndarray, o: np.ndarray) -> None:
        rows = max(1, LEAF_PAIRS // max(1, len(o)))
        for i in range(0, len(m), rows):
            near = np.bitwise_count(fps[m[i:i + rows], None] ^ fps[None, o]) <= reach
            a, b = np.nonzero(near)
            forest.add(m[i:i + rows][a], o[b])

    todo = [(np.arange(members), np.arange(len(fps)), 0)]
    while todo:
        m, o, depth = todo.pop()
        if not len(m) or not len(o):
            continue
        if len(m) * len(o) <= LEAF_PAIRS or depth == 24:
            exact(m, o)
            continue
        v = fps[m[(depth * 7919) % len(m)]]
        dm, do = np.bitwise_count(fps[m] ^ v).astype(np.int64), np.bitwise_count(fps[o] ^ v).astype(np.int64)
        for ring in np.unique(dm):  # triangle bound: a partner's distance to v differs by at most reach
            todo.append((m[dm == ring], o[np.abs(do - ring) <= reach], depth + 1))
    return forest.root


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _search(reach: int):
    """Over rows (leaf, query, fp) in order of leaf, members first: spanning forests of the leaves."""

    def leaf_edges(fps: np.ndarray, members: int) -> list[np.ndarray]:
        root = search_leaf(fps.view(np.uint64), members, reach)
        at = np.flatnonzero(root != np.arange(len(fps)))
        return [fps[at], fps[root[at]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush(parts):
            leaf, query, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(leaf)) + 1, [len(leaf)]])
            members = np.add.reduceat(~query, cuts[:-1]) if len(leaf) else []
            found = [leaf_edges(fp[s:e], int(n)) for s, e, n in zip(cuts[:-1], cuts[1:], members, strict=True) if n and e - s > 1]
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_EDGES)

        for batch in batches:
            leaf, query, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(leaf):
                continue
            last = int(np.searchsorted(leaf, leaf[-1])) if (np.diff(leaf) >= 0).all() else int(len(leaf) - np.argmax(leaf[::-1] != leaf[-1]))
            if leaf[0] != leaf[-1] or (rest and rest[-1][0][-1] != leaf[0]):
                yield from flush([*rest, (leaf[:last], query[:last], fp[:last])]) if last or rest else ()
                rest = []
            else:
                last = 0
            rest.append((leaf[last:].copy(), query[last:].copy(), fp[last:].copy()))
        if rest:
            yield from flush(rest)

    return run


def near_links(fps: DataFrame, reach: int = MOST_BITS) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column fp, distinct) within ``reach`` bits of each other."""
    n = fps.count()
    levels = levels_for(n)
    masks = bit_blocks(levels)
    sample = [r.fp for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(VANTAGE_SAMPLE).collect()]
    field = 64 // levels
    leaf = _leaf(F.col("fp"), vantage_points(sample, masks), masks, field, reach)
    moves = [_signed(sum(x << (i * field) for i, x in enumerate(step)) & MASK) for step in steps(levels, reach)]
    # a wrapped sum is meant: moves with negative rings are two's complement
    at = fps.select("fp", leaf.alias("home")).select("fp", "home", F.explode(F.array(*[F.lit(x) for x in moves])).alias("move"))
    rows = at.select(F.expr("cast(cast(home as decimal(20,0)) + move as decimal(20,0))").alias("sum"), (F.col("move") != 0).alias("query"), "fp")
    wrapped = F.expr("cast(case when sum > 9223372036854775807 then sum - 18446744073709551616 when sum < -9223372036854775808 then sum + 18446744073709551616 else sum end as long)")
    rows = rows.select(wrapped.alias("leaf"), "query", "fp") if levels == 16 else at.select((F.col("home") + F.col("move")).alias("leaf"), (F.col("move") != 0).alias("query"), "fp")
    sorted_ = rows.repartition("leaf").sortWithinPartitions("leaf", "query")
    return sorted_.mapInArrow(_search(reach), "a long, b long")


def simhash_groups(docs: DataFrame, carry: list[str] | None = None, words: int = SHINGLE_WORDS, reach: int = MOST_BITS) -> DataFrame:
    """Every row of ``docs`` with the columns ``carry`` (default: all) and: fingerprint, component_id, kept.

    Documents whose fingerprints differ in at most ``reach`` bits are linked; component_id is
    the smallest doc_id reachable (null only where no reachable row has one); kept marks one row
    of each component: the one with that doc_id (the first, where rows repeat it).  Null and
    wordless texts have fingerprint zero, which is linked like any other.  Empty tables give no
    rows; columns of ``docs`` named like an added column are replaced by it.
    """
    text_batches(docs.sparkSession)
    added = ["fingerprint", "component_id", "kept"]
    carry = [c for c in (carry if carry is not None else docs.columns) if c not in added]
    doc = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).alias("none"))
    rows = docs.select(doc.alias("doc"), F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty().alias("text"))
    schema = rows.drop("text").schema.add("fp", "long")
    rows = staged(rows.mapInArrow(_fingerprints(words), schema), "simhash-rows")
    best = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    distinct = staged(rows.groupBy("fp").agg(F.min(best).alias("w")), "simhash-distinct")
    found = components(near_links(distinct.select("fp"), reach), "a", "b")
    linked = distinct.join(found, distinct.fp == found.node, "left").select("fp", "w", F.coalesce("root", "fp").alias("root"))
    winner = linked.groupBy("root").agg(F.min("w").alias("w"))
    of_fp = linked.select("fp", "root").join(winner, "root").select("fp", "w")
    mark = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    verdict = [mark.alias("fingerprint"), F.col("w.id").alias("component_id"), (F.col("row") == F.col("w.row")).alias("kept")]
    if carry == ["doc_id"]:
        return rows.join(of_fp, "fp").select("doc.*", *verdict)
    decisions = rows.select("fp", "row").join(of_fp, "fp").select("row", F.struct(*verdict).alias("verdict"))
    return with_decisions(rows.select("row", "doc"), decisions).select("doc.*", "verdict.*")
