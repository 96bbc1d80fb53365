"""Packing into as few windows as possible: greedy matching of large pieces, best fit of small ones into the gaps.

A piece longer than a third of a window is large: at most two large pieces share a window.  Each large piece,
longest first, is paired with the longest large piece that still fits beside it.  Smaller pieces, longest first,
then go to the tightest remaining gap; a new window is opened only where none fits.

Pieces of equal length are interchangeable, so the packing is decided on the number of pieces per length: at most
``window`` numbers, whatever the size of the corpus.  The plan that comes back is a list of runs (pieces r, r+1, ...
of this length fill these windows from this place), again of a size that depends on the window alone.  So the whole
corpus is packed as one, without moving texts or ids to one place:

1. Scan tasks tokenise, cut and number their pieces of each length; the pieces are staged in the shared folder.
2. Counts per length go to the driver, which makes the plan.
3. A piece's rank among all pieces of its length (its task's first rank plus its number there) picks its run.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import staged, text_batches, text_or_empty
from starmart.llm.packing import VOCAB, WINDOW, encode_document
from starmart.operators.joins import maybe_broadcast

END_ID = 0  # fixed value: the id after each document
Run = tuple[int, int, int, int]  # first rank, first window, pieces a window takes, place of the first of them


class Windows:
    """Windows by their free room, as runs of neighbours with equal content."""

    def __init__(self, window: int):
        self.window, self.made = window, 0
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def open(self, n: int) -> int:
        first, self.made = self.made, self.made + n
        return first

    def free(self, room: int, first: int, n: int) -> None:
        if room and n:
            if room not in self.runs:
                self.runs[room] = []
                bisect.insort(self.rooms, room)
            self.runs[room].append((first, n))

    def tightest(self, need: int) -> tuple[int, int, int] | None:
        """Take out (room, first window, windows): the smallest room of at least ``need``."""
        at = bisect.bisect_left(self.rooms, need)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.rooms[at]
        return room, first, n


def plan_windows(counts: dict[int, int], window: int) -> tuple[dict[int, list[Run]], int]:
    """Runs per length, in order of their first rank, and the number of windows, for ``counts`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    plan: dict[int, list[Run]] = {n: [] for n in left}
    windows = Windows(window)

    def put(length: int, pieces: int, first: int, each: int, at: int) -> None:
        plan[length].append((used[length], first, each, at))
        used[length] += pieces
        left[length] -= pieces

    large = sorted(n for n in left if 3 * n > window)
    for a in reversed(large):
        while left[a]:
            # the longest large piece that fits beside this one and is not longer
            i = bisect.bisect_right(large, min(a, window - a))
            b = next((x for x in reversed(large[:i]) if left[x] > (x == a)), None)
            if b is None:
                n = left[a]
                first = windows.open(n)
                put(a, n, first, 1, 0)
                windows.free(window - a, first, n)
                continue
            n = left[a] // 2 if a == b else min(left[a], left[b])
            first = windows.open(n)
            if a == b:
                put(a, 2 * n, first, 2, 0)
            else:
                put(a, n, first, 1, 0)
                put(b, n, first, 1, a)
            windows.free(window - a - b, first, n)
    for s in sorted((n for n in left if 3 * n <= window), reverse=True):
        while left[s]:
            room, first, n = windows.tightest(s) or (window, -1, 0)
            each = room // s
            full = left[s] // each
            if first < 0:
                n = full + bool(left[s] % each)
                first = windows.open(n)
            if not full:  # the last pieces share one window
                pieces = left[s]
                put(s, pieces, first, each, window - room)
                windows.free(room - pieces * s, first, 1)
                windows.free(room, first + 1, n - 1)
                continue
            full = min(full, n)
            put(s, full * each, first, each, window - room)
            windows.free(room - each * s, first, full)
            windows.free(room, first + full, n - full)
    return plan, windows.made


PIECE_SCHEMA = "part long, nth long, doc_id long, piece int, start long, length long, ids binary"
_PIECE = pa.schema([("part", pa.int64()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])
PIECES_PER_BATCH = 256


def _cutter(path: str, window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode_document(path, text.as_py()), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % window or window  # only the first piece may be shorter
                start = 0
                for piece, end in enumerate(range(first, len(ids) + 1, window)):
                    n = end - start
                    rows.append((part, seen[n], doc_id, piece, start, n, ids[start:end].tobytes()))
                    seen[n] += 1
                    start = end
                    if len(rows) >= PIECES_PER_BATCH:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)

    return cut


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE.types, strict=True)], schema=_PIECE)


def pack_matched(docs: DataFrame, vocab: str = VOCAB, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents, placed in as few sequences of at most ``window`` ids as the method finds.

    One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.
    Added tokens of ``vocab`` that stand in a text get their ids.  A document longer than a window is cut into full
    windows, its first piece takes the rest.  Null and empty texts are the end id alone.  Rows that repeat a doc_id
    are packed each on its own; null ids stay null; pieces of equal length are placed in the order of their scan
    tasks, so sequence numbers may differ between runs, never their number.  Other columns of ``docs`` are not read.
    Empty tables give no rows.  A text is held by the task that reads it, with its ids.
    """
    spark = docs.sparkSession
    text_batches(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pieces = staged(plain.mapInArrow(_cutter(vocab, window), PIECE_SCHEMA), "matched-pieces", compression="zstd")
    per_task = staged(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "matched-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length: window rows at most
    plan, _ = plan_windows(counts, window)
    runs = [(length, [tuple(r) for r in found]) for length, found in plan.items()]
    planned = spark.createDataFrame(runs, "length long, runs array<struct<rank:long,window:long,each:long,at:long>>")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))  # at most one row per task and length
    n = per_task.count()
    ranked = pieces.join(maybe_broadcast(firsts, n, 48 * n), ["part", "length"]).withColumn("rank", F.col("first") + F.col("nth"))
    run = F.element_at(F.filter("runs", lambda r: r["rank"] <= F.col("rank")), -1)
    # the plan's size depends on the window alone: a few runs for each of its lengths
    placed = ranked.join(F.broadcast(planned), "length").withColumn("run", run)
    since = F.col("rank") - F.col("run.rank")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids",
        (F.col("run.window") + F.floor(since / F.col("run.each"))).cast("long").alias("sequence_id"),
        (F.col("run.at") + (since % F.col("run.each")) * F.col("length")).cast("long").alias("offset"),
    )
