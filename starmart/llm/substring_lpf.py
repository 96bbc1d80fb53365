"""Suffix-array dedup: longest-previous-factor arrays over shards of like content.

Every 100-byte window has an anchor: of the 32-byte strings in it the one with the smallest
hash.  Equal windows have equal anchors, so sorting windows into shards by anchor never parts
two of them.  Consecutive windows with one anchor form a run, which is what travels (hashes and
a place, no text); a run whose bytes all occur earlier is removed whole, and an anchor that
occurs once is dropped.  Only anchors found in different surroundings need their text: their
runs are fetched, and per shard a suffix array over them is built by prefix doubling, with the
longest common prefixes of neighbours; for every window the previous and the next suffix that
starts at a smaller place give its longest previous factor, and a window with a factor of 100
bytes or more is removed.

Anchors with more than ``HOT`` different surroundings are handled window by window instead, by
a grouped minimum over window hashes, so no shard grows with the number of copies.  Runs are
compared by 64-bit hashes under equal anchors, windows of hot anchors by 128 bits, all others
byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from starmart.llm.common import _BASE, _BASE_INV, blocks, data_bytes, mix64, offsets, powers, staged, text_batches, text_or_empty
from starmart.operators.joins import maybe_broadcast

LENGTH = 100  # fixed value of the contract
GRAM = 32
HOT = 4096
BLOCK_BYTES = 1 << 19
SHARD_BYTES = 1 << 18
NO_ID = (1 << 63) - 1  # null doc_ids come last

_RUN_DDL = "g long, content long, id long, th long, at long"
_RUN = pa.schema([("g", pa.int64()), ("content", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("at", pa.int64())])
_FOUND_DDL = "g long, id long, th long, start long, n long, open boolean"
_FOUND = pa.schema([("g", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("open", pa.bool_())])


def window_runs(b: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor hash, hash of all bytes) of the runs in documents b[offs[i]:offs[i + 1]]."""
    n = len(b)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(np.arange(256, dtype=np.uint64), 21)[b] * powers(_BASE, n), out=prefix[1:])
        inverse = powers(_BASE_INV, n + 1)
        grams = mix64((prefix[gram:] - prefix[:-gram]) * inverse[: n - gram + 1])
    width = length - gram + 1  # grams in a window
    low = ((grams >> np.uint64(31)) << np.uint64(31)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span:])
    anchor = (low & np.uint64((1 << 31) - 1)).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    long_ = np.flatnonzero(np.diff(offs) >= length)
    np.add.at(edge, offs[long_], 1)
    np.add.at(edge, offs[long_ + 1] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(edge)[: n - length + 1] > 0)
    if not len(valid):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    a = anchor[valid]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(valid) != 1) | (np.diff(a) != 0)]))
    first = valid[new]
    count = np.diff(np.append(new, len(valid)))
    end = first + count + length - 1
    with np.errstate(over="ignore"):
        content = mix64((prefix[end] - prefix[first]) * inverse[first] ^ mix64(count.astype(np.uint64), 2), 9)
    return first, count, mix64(grams[a[new]], 4), content


def _segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets of the rows, start of each row's bytes in its text); texts over a block are cut with overlap."""
    for block in blocks(batches, "text", BLOCK_BYTES):
        col = block.column("text")
        offs, data = offsets(col), data_bytes(col)
        if block.num_rows > 1 or offs[-1] - offs[0] <= BLOCK_BYTES:
            yield block, data[offs[0]:offs[-1]], offs - offs[0], np.zeros(block.num_rows, np.int64)
            continue
        text = data[offs[0]:offs[-1]]
        for s in range(0, len(text), BLOCK_BYTES):
            part = text[s:s + BLOCK_BYTES + length - 1]
            yield block, part, np.array([0, len(part)]), np.array([s])


def _run_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, b, offs, base in _segments(batches, length):
            first, count, g, content = window_runs(b, offs, length, gram)
            if not len(first):
                continue
            doc = np.searchsorted(offs, first, side="right") - 1
            ids = block.column("id").to_numpy(zero_copy_only=False)[doc]
            th = block.column("th").to_numpy(zero_copy_only=False)[doc]
            start = first - offs[doc] + base[doc]
            order = np.lexsort((start, ids, content, g))
            g, content, ids, th, start, count = (x[order] for x in (g, content, ids, th, start, count))
            head = np.concatenate([[True], (g[1:] != g[:-1]) | (content[1:] != content[:-1])])
            lead = np.maximum.accumulate(np.where(head, np.arange(len(g)), 0))
            covered = (ids > ids[lead]) | ((ids == ids[lead]) & (start > start[lead]))  # an earlier copy in this block: settled here
            at = (start << 8) | count
            at = np.where(covered, -at - 1, at)
            g = np.where(covered, mix64(start.astype(np.uint64) ^ mix64(ids.astype(np.uint64))), g)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids), pa.array(th), pa.array(at)], schema=_RUN)

    return run


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over runs by (g, content, id, at): later copies of a run (settled), and the first of each content of a shared anchor (open)."""
    last = None  # g, content, id, at of the first row of the current content
    waiting = None  # the newest open candidate: g, id, th, start, n, whether its anchor is known to be shared

    def emit(g, ids, th, start, n, open_):
        return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(ids, pa.int64()), pa.array(th, pa.int64()), pa.array(start, pa.int64()),
                                           pa.array(n, pa.int64()), pa.array(np.full(len(g), open_))], schema=_FOUND)

    for batch in batches:
        g, content, ids, th, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        done = at < 0
        if done.any():
            was = -(at[done] + 1)
            yield emit(g[done], ids[done], th[done], was >> 8, was & 255, False)
        g, content, ids, th, at = (x[~done] for x in (g, content, ids, th, at))
        if not len(g):
            continue
        joins = last is not None and (g[0], content[0]) == last[:2]
        head = np.concatenate([[not joins], (g[1:] != g[:-1]) | (content[1:] != content[:-1])])
        lead = np.maximum.accumulate(np.where(head, np.arange(len(g)), -1))
        first_id = np.where(lead >= 0, ids[lead], last[2] if joins else 0)
        first_at = np.where(lead >= 0, at[lead], last[3] if joins else 0)
        later = (ids > first_id) | ((ids == first_id) & (at >> 8 > first_at >> 8))
        if later.any():
            yield emit(g[later], ids[later], th[later], at[later] >> 8, at[later] & 255, False)
        if lead[-1] >= 0:
            k = lead[-1]
            last = (g[k], content[k], ids[k], at[k])
        heads = np.flatnonzero(head)
        if len(heads):
            hg, rest = g[heads], [ids[heads], th[heads], at[heads] >> 8, at[heads] & 255]
            same = np.concatenate([[waiting is not None and waiting[0] == hg[0]], hg[1:] == hg[:-1]])
            if waiting is not None and (same[0] or waiting[5]):
                yield emit(*[[x] for x in waiting[:5]], True)
            shared = same | np.concatenate([same[1:], [False]])
            shared[-1] = False  # kept waiting
            if shared.any():
                yield emit(hg[shared], *[x[shared] for x in rest], True)
            waiting = (hg[-1], *[x[-1] for x in rest], bool(same[-1]))
    if waiting is not None and waiting[5]:
        yield emit(*[[x] for x in waiting[:5]], True)


_CONTENT_DDL = "g long, id long, th long, start long, content binary, w1 long, w2 long"
_CONTENT = pa.schema([("g", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("content", pa.binary()), ("w1", pa.int64()), ("w2", pa.int64())])


def _fetch(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                raw = batch.column("text")[i].as_py().encode("utf-8")
                doc, th = batch.column("id")[i].as_py(), batch.column("th")[i].as_py()
                for r in batch.column("runs")[i].as_py():
                    s, n = r["start"], r["n"]
                    if not r["hot"]:
                        out.append((r["g"], doc, th, s, raw[s:s + n + length - 1], None, None))
                        continue
                    for k in range(s, s + n):
                        w = raw[k:k + length]
                        h = xxhash.xxh3_128_intdigest(w)
                        out.append((None, doc, th, k, None, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _CONTENT.types, strict=True)], schema=_CONTENT)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _CONTENT.types, strict=True)], schema=_CONTENT)

    return run


def _rank(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ranks = np.empty(len(keys), np.uint64)
    sorted_ = keys[order]
    ranks[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]])).astype(np.uint64)
    return ranks


def _smaller_before(place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest earlier index with a smaller place (-1: none), and the least lcp on the way; lcp[i] is between i - 1 and i."""
    n = len(place)
    to, low = np.arange(n) - 1, lcp.copy()
    busy = np.arange(n)
    while True:
        busy = busy[to[busy] >= 0]
        busy = busy[place[to[busy]] >= place[busy]]
        if not len(busy):
            return to, low
        via = to[busy]
        # everything between to[via] and via is no smaller than via, which is no smaller than us
        next_to, next_low = to[via], np.minimum(low[busy], low[via])
        to[busy], low[busy] = next_to, next_low


def longest_previous_factors(text: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For each window text[starts[i]:starts[i] + length]: the longest prefix (at most ``length``) shared with a window of smaller place."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + n]
    ranks, span = {8: _rank(word)}, 8
    while 2 * span <= length:
        r = ranks[span]
        second = np.zeros(n, np.uint64)
        second[: n - span] = r[span:] + np.uint64(1)
        ranks[2 * span] = _rank(r * np.uint64(n + 2) + second)
        span *= 2
    top = ranks[span] if length >= 8 else _rank(padded[:n])
    key = top[starts] * np.uint64(n + 2) + top[starts + (length - span)] if length >= span else top[starts]
    order = np.argsort(key, kind="stable")  # suffix order of the windows
    at, where = starts[order], place[order]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = at[:-1], at[1:]
        same = np.zeros(len(a), np.int64)
        for k in sorted(ranks, reverse=True):
            x, y = np.minimum(a + same, n - 1), np.minimum(b + same, n - 1)
            same += k * ((ranks[k][x] == ranks[k][y]) & (same < length))
        wide = np.concatenate([text, np.zeros(8, np.uint8)])
        for _ in range(7):
            x, y = np.minimum(a + same, n), np.minimum(b + same, n)
            same += (wide[x] == wide[y]) & (same < length)
        lcp[1:] = np.minimum(same, length)
    to, low = _smaller_before(where, lcp)
    best = np.where(to >= 0, low, 0)
    back = np.concatenate([[0], lcp[1:][::-1]]) if len(order) else lcp
    to, low = _smaller_before(where[::-1], back)
    best = np.maximum(best, np.where(to >= 0, low, 0)[::-1])
    out = np.empty(len(order), np.int64)
    out[order] = best
    return out


_GONE_DDL = "id long, th long, start long, n long"
_GONE = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])


def _shard_factors(length: int):
    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        col = table["content"].chunk(0)
        offs, data = offsets(col), data_bytes(col)
        text, offs = data[offs[0]:offs[-1]], offs - offs[0]
        ids, th, begin = (table[c].to_numpy() for c in ("id", "th", "start"))
        count = np.diff(offs) - length + 1
        row = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = begin[row] + step
        order = np.lexsort((start, ids[row]))
        new = np.concatenate([[0], (np.diff(ids[row][order]) != 0) | (np.diff(start[order]) != 0)])
        place = np.empty(len(row), np.int64)
        place[order] = np.cumsum(new)
        gone = longest_previous_factors(text, offs[row] + step, place, length) >= length
        at = np.flatnonzero(gone)
        if len(at):
            head = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row[at]) != 0)]))
            size = np.diff(np.append(head, len(at)))
            k = at[head]
            yield pa.RecordBatch.from_arrays([pa.array(ids[row[k]]), pa.array(th[row[k]]), pa.array(start[k]), pa.array(size)], schema=_GONE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            g = batch.column("g").to_numpy(zero_copy_only=False)
            if not len(g):
                continue
            widths = np.diff(offsets(batch.column(batch.schema.get_field_index("content"))))
            total = np.cumsum(widths)
            cut = 0
            for k in np.flatnonzero(np.concatenate([[last is not None and g[0] != last], np.diff(g) != 0])).tolist():
                if size + (total[k - 1] if k else 0) - (total[cut - 1] if cut else 0) >= SHARD_BYTES:
                    if k > cut:
                        held.append(batch.slice(cut, k - cut))
                    yield from solve(held)
                    held, size, cut = [], 0, k
            held.append(batch.slice(cut))
            size += int(total[-1] - (total[cut - 1] if cut else 0))
            last = g[-1]
        if held:
            yield from solve(held)

    return run


def _merge(starts: list[int], ends: list[int]) -> np.ndarray:
    """Maximal runs of covered bytes as (n, 2)."""
    s, e = np.array(starts, np.int64), np.array(ends, np.int64)
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    heads = np.flatnonzero(new)
    return np.stack([s[heads], e[np.append(heads[1:], len(s)) - 1]], axis=1)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [_merge([x["start"] for x in r], [x["end"] for x in r]).astype("<i8").tobytes() for r in batch.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(spans, pa.binary())], names=["id", "th", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", 8 << 20):
        total, removed, spans_n, kept, listed = [], [], [], [], []
        for text, spans in zip(block.column("text"), block.column("spans"), strict=True):
            raw, found = text.as_py().encode("utf-8"), spans.as_py()
            pairs = np.frombuffer(found, "<i8").reshape(-1, 2).tolist() if found is not None else []
            edges = [0, *(x for p in pairs for x in p), len(raw)]
            total.append(len(raw))
            removed.append(sum(e - s for s, e in pairs))
            spans_n.append(len(pairs))
            kept.append(b"".join(raw[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)) if pairs else raw)
            listed.append(",".join(f"{s}:{e}" for s, e in pairs))
        cols = {n: c for n, c in zip(block.schema.names, block.columns, strict=True) if n not in ("text", "spans")}
        cols |= {"n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans_n, pa.int64()),
                 "kept_bytes": pa.array(kept, pa.binary()), "removed_spans": pa.array(listed, pa.string())}
        yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_bytes, removed_spans (byte start:end).

    A byte is removed if a string of ``length`` bytes over it also starts earlier: in a text with
    a smaller doc_id, or at an earlier place of a text with the same doc_id.  So rows that repeat
    a doc_id are compared by place alone and do not remove each other's equal places; null
    doc_ids count as one id after all others.  Null texts are empty.  Empty tables give no rows;
    other columns are not read.
    """
    text_batches(docs.sparkSession)
    if not 8 <= gram <= length <= 250:
        raise ValueError("8 <= gram <= length <= 250")
    text = text_or_empty()
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(text).alias("th"), text.alias("text"))
    runs = base.select("id", "th", "text").mapInArrow(_run_rows(length, gram), _RUN_DDL)
    found = staged(runs.repartition("g").sortWithinPartitions("g", "content", "id", "at").mapInArrow(_sort_out, _FOUND_DDL), "lpf-found")

    open_ = found.where("open").select("g", "id", "th", "start", "n")
    crowded = staged(open_.groupBy("g").count().where(F.col("count") > hot).select("g", F.lit(True).alias("hot")), "lpf-hot")
    marked = open_.join(maybe_broadcast(crowded, crowded.count()), "g", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = staged(marked.groupBy("id", "th").agg(F.collect_list(F.struct("g", "start", "n", "hot")).alias("runs")), "lpf-wanted")
    rows, parts = wanted.agg(F.count(F.lit(1)), F.sum(F.size("runs"))).first()
    fetched = base.select("id", "th", "text").join(maybe_broadcast(wanted, rows, 64 * rows + 40 * (parts or 0)), ["id", "th"])
    contents = staged(fetched.mapInArrow(_fetch(length), _CONTENT_DDL), "lpf-contents")

    by_shard = contents.where("content is not null").select("g", "id", "th", "start", "content").repartition("g").sortWithinPartitions("g", "id", "start")
    factors = by_shard.mapInArrow(_shard_factors(length), _GONE_DDL)
    windows = contents.where("w1 is not null").select("id", "th", "start", "w1", "w2")
    first = windows.groupBy("w1", "w2").agg(F.min(F.struct("id", "start")).alias("first"))
    copies = windows.join(first, ["w1", "w2"]).where(F.struct("id", "start") > F.col("first")).select("id", "th", "start", F.lit(1).cast("long").alias("n"))
    gone = found.where("not open").select("id", "th", "start", "n").unionByName(factors).unionByName(copies)
    part = F.struct("start", (F.col("start") + F.col("n") + (length - 1)).alias("end"))
    merged = gone.groupBy("id", "th").agg(F.collect_list(part).alias("parts")).mapInArrow(_merged, "id long, th long, spans binary")
    spans = staged(merged, "lpf-spans")
    rows, size = spans.agg(F.count(F.lit(1)), F.sum(F.length("spans"))).first()
    out = base.join(maybe_broadcast(spans, rows, 64 * rows + (size or 0)), ["id", "th"], "left").select("doc_id", "text", "spans")
    fields = [StructField("doc_id", LongType()), *[StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
              StructField("kept_bytes", BinaryType()), StructField("removed_spans", StringType())]
    return out.mapInArrow(_cut, StructType(fields))
