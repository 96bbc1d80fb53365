"""Substring dedup: near-copies of paragraphs by MinHash banding, exact verification and components.

A paragraph is a run of consecutive lines: lines are taken together until they hold ``MIN_WORDS`` words, and what is
left at the end of a text joins the paragraph before.  So every word of every text takes part, and a short common line
is no paragraph of its own.  Its set of five-word shingles is hashed to 64 bits each (fewer words: one shingle of them
all).  Equal paragraphs collapse first (a grouped minimum), so copies cost one row.

Bands are tuned for recall: of the splits within ``MOST_BANDS`` bands that find a pair at the threshold with ``RECALL``
or more, the one with the most rows a band, hence the fewest chance collisions.  Paragraphs that collide in a band are
verified by the exact Jaccard of their shingle sets, each against the smallest of its bucket, through which the similar
ones are linked: a bucket of near copies costs a row each, not a row per pair.  Paragraphs of buckets that also hold
unlike ones are bucketed again by the rarest shingles of each (the prefix filter, exact at the threshold), so that
paragraphs which share a template but nothing rare part company.  What is compared with the smallest of each bucket, old
and new, connects nearly all of a group of near copies; only paragraphs of different components are compared further,
each pair in the first bucket that both are in: leader by leader, ``LEADERS`` times, then with each other; and as the
Jaccard distance is a metric, not where the one is too far from the leader, or from the ring in which the other stands.  Connected components of the verified links decide: the first paragraph of a component
stays, the others are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import _BASE, _BASE_INV, blocks, data_bytes, mix64, offsets, powers, span_hashes, staged, text_batches, text_or_empty, word_spans
from starmart.llm.components import components
from starmart.operators.joins import maybe_broadcast

SHINGLE_WORDS = 5  # fixed value of the contract
SIMILARITY = 0.8  # fixed value of the contract
MIN_WORDS = 20  # lines are taken together until they hold so many words
RECALL = 0.999
MOST_BANDS = 12
LEADERS = 2  # rounds of clustering in crowded buckets before what is left over is compared with each other
CLOSE = 1e-9
PASSAGE_WORDS = 20  # neighbouring repeated pieces that hold so many words are a repeated passage
REACH = 6  # places on either side over which a shingle's hash is the smallest where a text is cut
BLOCK_BYTES = 1 << 20
NO_ID = (1 << 63) - 1  # null doc_ids come last
KEY = ["id", "th", "size"]  # of a row: its id, all 64 bits of its text's hash, and its length

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tune(similarity: float = SIMILARITY, recall: float = RECALL, most_bands: int = MOST_BANDS) -> tuple[int, int]:
    """(bands, rows a band): the most rows whose bands, within the limit, reach the recall at the threshold."""
    for rows in range(16, 0, -1):
        for bands in range(1, most_bands + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                return bands, rows
    return most_bands, 1


def fill(n_words: list[int], min_words: int) -> list[int]:
    """Numbers of the lines with which paragraphs begin, for the words of each line; what is left over joins the last one."""
    begins, held = [], min_words
    for line, n in enumerate(n_words):
        if held >= min_words and n:
            begins.append(line)
            held = 0
        held += n
    if len(begins) > 1 and held < min_words:
        begins.pop()
    return begins


def _words_by_line(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, _ = word_spans(b, np.array([0, len(b)]))
    breaks = np.flatnonzero(b == 10)
    return starts, ends, np.bincount(np.searchsorted(breaks, starts), minlength=len(breaks) + 1)


def paragraphs(b: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: first line and number of lines of each paragraph, its first shingle, shingle counts, all shingle hashes.

    A paragraph ends with its last line that holds a word.
    """
    low = _LOWER[b]
    starts, ends, by_line = _words_by_line(low)
    begins = np.array(fill(by_line.tolist(), max(1, min_words)), np.int64)
    if not len(begins):
        return begins, begins, begins, begins, begins.view(np.uint64)
    worded = np.flatnonzero(by_line)
    last = worded[np.searchsorted(worded, np.append(begins[1:], len(by_line))) - 1]
    n_words = np.add.reduceat(by_line, begins)
    words = span_hashes(low, starts, ends)
    n = len(words)
    first = np.cumsum(n_words) - n_words
    count = np.maximum(n_words - SHINGLE_WORDS + 1, 1)
    width = np.minimum(n_words, SHINGLE_WORDS)
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(_BASE, n))])
        grams = mix64((prefix[at + np.repeat(width, count)] - prefix[at]) * powers(_BASE_INV, n + 1)[at], 31)
    return begins, last - begins + 1, np.cumsum(count) - count, count, grams


def _parts(text: np.ndarray, min_words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of its first line, bytes) of parts of about a block, cut between paragraphs."""
    done, line, size = 0, 0, BLOCK_BYTES
    while True:
        stop = done + size
        while stop < len(text) and not (text[stop:stop + BLOCK_BYTES] == 10).any():
            stop += BLOCK_BYTES
        if stop >= len(text):
            yield line, text[done:]
            return
        stop += int(np.flatnonzero(text[stop:stop + BLOCK_BYTES] == 10)[0])
        part = text[done:stop]
        begins = fill(_words_by_line(part)[2].tolist(), max(1, min_words))
        if len(begins) < 3:
            size *= 2
            continue
        # the last paragraph may go on in the next part, and a rest at the end joins the one before it
        breaks = np.flatnonzero(part == 10)
        cut = int(breaks[begins[-2] - 1])
        yield line, part[:cut]
        done, line, size = done + cut + 1, line + begins[-2], BLOCK_BYTES


_PLACE_DDL = "pid long, id long, th long, size long, idx int, lines int, bands array<bigint>"
_PLACE = pa.schema([("pid", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("size", pa.int64()), ("idx", pa.int32()), ("lines", pa.int32()), ("bands", pa.list_(pa.int64()))])


def _places(min_words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            col = block.column("text")
            offs, data = offsets(col), data_bytes(col)
            idx, lines, doc, start, grams, seen = [], [], [], [], [], 0
            for d in range(block.num_rows):
                for line, part in _parts(data[offs[d]:offs[d + 1]], min_words):
                    begins, n_lines, first, _, found = paragraphs(part, min_words)
                    idx.append(begins + line)
                    lines.append(n_lines)
                    doc.append(np.full(len(begins), d))
                    start.append(first + seen)
                    grams.append(found)
                    seen += len(found)
            first, flat = np.concatenate(start), np.concatenate(grams)
            if not len(first):
                continue
            # a paragraph's key: order-free sums would mix up anagrams, so its shingles are weighed by position
            inside = np.arange(len(flat)) - np.repeat(first, np.diff(np.append(first, len(flat))))
            with np.errstate(over="ignore"):
                pid = mix64(np.add.reduceat(mix64(flat ^ mix64(inside.astype(np.uint64), 41), 42), first), 43)
                keys = np.empty((len(first), bands), np.uint64)
                for k in range(bands):
                    key = np.full(len(first), np.uint64(k + 1))
                    for r in range(rows):
                        key = mix64(key ^ np.minimum.reduceat(mix64(flat, 100 + k * rows + r), first), 7)
                    keys[:, k] = key
            doc = np.concatenate(doc)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            held = [block.column(c).take(pa.array(doc)) for c in ("id", "th", "size")]
            yield pa.RecordBatch.from_arrays([pa.array(pid.view(np.int64)), *held, pa.array(np.concatenate(idx).astype(np.int32)), pa.array(np.concatenate(lines).astype(np.int32)), listed], schema=_PLACE)

    return run


_MEMBER = pa.schema([("band", pa.int64()), ("pid", pa.int64()), ("leader", pa.int64())])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (band, pid) in order: the members of buckets with two paragraphs or more, with the smallest of each."""
    band, leader, told = None, None, False
    for batch in batches:
        b, p = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not len(b):
            continue
        head = np.concatenate([[band is None or b[0] != band], b[1:] != b[:-1]])
        lead = np.maximum.accumulate(np.where(head, np.arange(len(b)), -1))
        lead_pid = np.where(lead >= 0, p[lead], leader if leader is not None else 0)
        member = ~head  # every row but the smallest; the smallest is told once its bucket has a second
        first = np.flatnonzero(member & np.concatenate([[not told], head[:-1]]))
        out_b = np.concatenate([b[member], b[first]])
        out_p = np.concatenate([p[member], lead_pid[first]])
        out_l = np.concatenate([lead_pid[member], lead_pid[first]])
        if len(out_b):
            yield pa.RecordBatch.from_arrays([pa.array(out_b), pa.array(out_p), pa.array(out_l)], schema=_MEMBER)
        told = bool(member[-1]) or (told and not head.any())
        band, leader = b[-1], lead_pid[-1]


def _sets(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pids, sets = [], []
            for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
                by_line = {w["idx"]: w["pid"] for w in wanted}
                for line, part in _parts(np.frombuffer(text.as_py().encode("utf-8"), np.uint8), min_words):
                    begins, _, first, count, grams = paragraphs(part, min_words)
                    for k, s, n in zip(begins.tolist(), first.tolist(), count.tolist(), strict=True):
                        if k + line in by_line:
                            pids.append(by_line[k + line])
                            sets.append(np.unique(grams[s:s + n]).view(np.int64))
            if pids:
                yield pa.RecordBatch.from_arrays([pa.array(pids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["pid", "shingles"])

    return run


def _similarity(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _members(keys: DataFrame, name: str) -> DataFrame:
    """(band, pid, leader) of the buckets of ``keys`` (band, pid) that hold two paragraphs or more."""
    members = keys.repartition("band").sortWithinPartitions("band", "pid").mapInArrow(_buckets, "band long, pid long, leader long")
    return staged(members, name)


def _tested(members: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """(pid, leader, sim) of every member that is not its bucket's leader, each pair once."""
    mine, theirs = sets.select("pid", F.col("shingles").alias("x")), sets.select(F.col("pid").alias("leader"), F.col("shingles").alias("y"))
    pairs = members.where("pid != leader").select("pid", "leader").distinct().join(mine, "pid").join(theirs, "leader")
    return staged(pairs.select("pid", "leader", _similarity(F.col("x"), F.col("y")).alias("sim")), name)


def _links(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("pid").alias("a"), F.col("leader").alias("b"))


def rare_shingles(sets: DataFrame, similarity: float) -> DataFrame:
    """(pid, rare): the rarest shingles of each paragraph of ``sets`` (pid, shingles), rarest first, as many as the prefix filter needs.

    Of two sets with the similarity, either's n - ceil(similarity * n) + 1 first shingles in a common order (here by
    rarity among these paragraphs) hold a shingle of the other's.  A shingle of one paragraph alone takes its place in
    that order but makes no bucket.
    """
    rows = sets.select("pid", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = rows.join(often, "shingle").groupBy("pid").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("shared"))
    first = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - CLOSE).cast("int") + 1
    left = F.greatest(first - (F.col("n") - F.size("shared")), F.lit(0))  # after the shingles that only this paragraph has
    return shared.select("pid", F.transform(F.slice("shared", F.lit(1), left), lambda s: s["shingle"]).alias("rare"))


def _any_open(rows: DataFrame) -> bool:
    """Whether any band of ``rows`` (band, comp) holds two components."""
    return not rows.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").isEmpty()


def _crowded_links(sets: DataFrame, similarity: float, known: DataFrame | None = None) -> DataFrame:
    """Links among the paragraphs of ``sets`` that, with the ``known`` ones (a, b), join every pair with the similarity."""
    rare = staged(rare_shingles(sets, similarity), "para-rare-shingles")
    members = _members(rare.select(F.explode("rare").alias("band"), "pid"), "para-rare")
    tested = _tested(members, sets, "para-rare-tested")
    links = _links(tested.where(F.col("sim") >= similarity))
    unlike = members.join(tested.where(F.col("sim") < similarity), ["pid", "leader"], "left_semi").select("band").distinct()
    found = components(links if known is None else links.unionByName(known), "a", "b")
    mine, theirs = sets.select("pid", F.col("shingles").alias("x")), sets.select(F.col("pid").alias("leader"), F.col("shingles").alias("y"))
    rows = members.join(unlike, "band", "left_semi").join(tested, ["pid", "leader"]).join(found.withColumnRenamed("node", "pid"), "pid", "left").join(mine, "pid").join(rare, "pid")
    rows = staged(rows.select("band", "pid", "leader", "x", "sim", F.coalesce("root", "pid").alias("comp"), "rare"), "para-crowded")
    reach = 1 - similarity
    # a pair meets in every bucket of a rare shingle that both have; only in the first of them it is compared
    here = F.element_at(F.array_intersect("rare", "other_rare"), 1) == F.col("band")
    for rounds_left in range(LEADERS, -1, -1):
        near, far = rows.where(F.col("sim") >= similarity), rows.where(F.col("sim") < similarity)
        near = near.select(F.col("band").alias("in_band"), F.col("leader").alias("head"), F.col("x").alias("y"), F.col("sim").alias("near"), F.col("comp").alias("with"), F.col("rare").alias("other_rare"))
        # one link to a cluster joins the whole cluster: a semi join, never a row per pair; only what is not joined yet and the triangle allows
        same = (F.col("band") == F.col("in_band")) & (F.col("leader") == F.col("head")) & (F.col("comp") != F.col("with")) & (F.col("near") <= F.col("sim") + reach + CLOSE)
        to = far.where(F.col("sim") >= 1 - 2 * reach - CLOSE).join(near, same & here & (_similarity(F.col("x"), F.col("y")) >= similarity), "left_semi")
        links = links.unionByName(_links(to))
        open_ = _any_open(far)
        if not (open_ and rounds_left):
            break
        heads = far.groupBy("band").agg(F.min("pid").alias("leader"))
        rows = far.select("band", "pid", "x", "comp", "rare").join(heads, "band").where("pid != leader").join(theirs, "leader")
        rows = staged(rows.select("band", "pid", "leader", "x", _similarity(F.col("x"), F.col("y")).alias("sim"), "comp", "rare"), "para-crowded")
        links = links.unionByName(_links(rows.where(F.col("sim") >= similarity)))
    if not open_:
        return links
    left = far.select("band", F.col("pid").alias("a"), "x", "sim", "comp", "rare")
    right = far.select(F.col("band").alias("same"), F.col("pid").alias("b"), F.col("x").alias("y"), F.col("sim").alias("other"), F.col("comp").alias("with"), F.col("rare").alias("other_rare"))
    ring = (F.col("band") == F.col("same")) & (F.col("a") > F.col("b")) & (F.col("comp") != F.col("with")) & (F.abs(F.col("sim") - F.col("other")) <= reach + CLOSE)
    rest = left.join(right, ring & here & (_similarity(F.col("x"), F.col("y")) >= similarity))
    return links.unionByName(rest.select("a", "b"))


def similar_links(bands: DataFrame, sets_of, similarity: float = SIMILARITY) -> DataFrame:
    """Verified links (a, b) between distinct paragraphs.

    ``bands``: (pid, bands); ``sets_of(pids)`` gives (pid, shingles) for a table of pids.  Every pair
    that shares a band and has the similarity is connected by the links.
    """
    members = _members(bands.select(F.explode("bands").alias("band"), "pid"), "para-members")
    sets = sets_of(members.select("pid").distinct())
    tested = _tested(members, sets, "para-tested")
    links = _links(tested.where(F.col("sim") >= similarity))
    # buckets that also hold a paragraph unlike their smallest one
    unlike = members.join(tested.where(F.col("sim") < similarity), ["pid", "leader"], "left_semi").select("band").distinct()
    crowded = members.join(unlike, "band", "left_semi").select("pid").distinct()
    crowded = staged(sets.join(crowded, "pid", "left_semi"), "para-crowded-sets")
    return links if crowded.isEmpty() else links.unionByName(_crowded_links(crowded, similarity, links))


def pieces(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts b[offs[i]:offs[i + 1]]: the hash of each piece, its text, its first word there, its words, its first byte and its end there.

    A piece begins with its text or where a shingle's hash is below those of the ``REACH`` places before and at most those of the places after.
    """
    low = _LOWER[b]
    starts, ends, doc = word_spans(low, offs)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none, none, none
    words = span_hashes(low, starts, ends)
    begin = np.searchsorted(doc, np.arange(len(offs)))  # first word of each text
    gap = REACH + SHINGLE_WORDS  # between texts, so that none sees its neighbours
    at = np.arange(n) + gap * (doc + 1)
    most = np.uint64((1 << 64) - 1)
    hashes = np.full(n + gap * (len(offs) + 1), most)
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(_BASE, n))])
        inverse = powers(_BASE_INV, n + 1)
        whole = np.flatnonzero(np.arange(n) + SHINGLE_WORDS <= begin[doc + 1])
        hashes[at[whole]] = mix64((prefix[whole + SHINGLE_WORDS] - prefix[whole]) * inverse[whole], 31)
    before, after = np.full(len(hashes), most), np.full(len(hashes), most)
    for k in range(1, REACH + 1):
        np.minimum(before[k:], hashes[:-k], out=before[k:])
        np.minimum(after[:-k], hashes[k:], out=after[:-k])
    cut = ((hashes < before) & (hashes <= after))[at]
    cut[begin[:-1][np.diff(begin) > 0]] = True
    first = np.flatnonzero(cut)
    stop = np.append(first[1:], n)
    with np.errstate(over="ignore"):
        key = mix64((prefix[stop] - prefix[first]) * inverse[first] ^ mix64((stop - first).astype(np.uint64), 52), 53)
    base = offs[doc[first]]
    return key, doc[first], first - begin[doc[first]], stop - first, starts[first] - base, ends[stop - 1] - base


_PIECE_DDL = "piece long, id long, th long, size long, first int, words int, start long, stop long, settled boolean"
_PIECE = pa.schema([("piece", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("size", pa.int64()), ("first", pa.int32()), ("words", pa.int32()),
                    ("start", pa.int64()), ("stop", pa.int64()), ("settled", pa.bool_())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of all texts; one that stands earlier in the same block is settled here and gets a key of its own, so that common ones gather nowhere."""
    for block in blocks(batches, "text", BLOCK_BYTES):
        col = block.column("text")
        offs, data = offsets(col), data_bytes(col)
        if block.num_rows == 1 and offs[1] - offs[0] > 2 * BLOCK_BYTES:
            found, byte, word = [], 0, 0
            for _, part in _parts(data[offs[0]:offs[1]], MIN_WORDS):
                key, doc, first, words, start, stop = pieces(part, np.array([0, len(part)]))
                found.append((key, doc, first + word, words, start + byte, stop + byte))
                byte, word = byte + len(part) + 1, word + int(words.sum())
            key, doc, first, words, start, stop = (np.concatenate(x) for x in zip(*found, strict=True))
        else:
            key, doc, first, words, start, stop = pieces(data[offs[0]:offs[-1]], offs - offs[0])
        if not len(key):
            continue
        ids, th, size = (block.column(c).to_numpy(zero_copy_only=False)[doc] for c in KEY)
        order = np.lexsort((start, size, th, ids, key))
        key, ids, th, size, first, words, start, stop = (x[order] for x in (key, ids, th, size, first, words, start, stop))
        lead = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), np.arange(len(key)), 0))
        settled = (ids != ids[lead]) | (th != th[lead]) | (size != size[lead]) | (start != start[lead])
        with np.errstate(over="ignore"):
            key = np.where(settled, mix64(th.view(np.uint64) ^ mix64(start.astype(np.uint64), 54), 55), key)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids), pa.array(th), pa.array(size), pa.array(first.astype(np.int32)),
                                          pa.array(words.astype(np.int32)), pa.array(start), pa.array(stop), pa.array(settled)], schema=_PIECE)


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for found in batch.column("found").to_pylist():
                out: list[list[int]] = []  # first word, end word, first byte, end
                for p in sorted(found, key=lambda p: p["first"]):
                    if out and out[-1][1] == p["first"]:
                        out[-1][1], out[-1][3] = p["first"] + p["words"], p["stop"]
                    else:
                        out.append([p["first"], p["first"] + p["words"], p["start"], p["stop"]])
                spans.append([{"start": s, "stop": e} for a, b, s, e in out if b - a >= least])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in KEY], pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], names=[*KEY, "spans"])

    return run


def repeated_passages(texts: DataFrame, least: int = PASSAGE_WORDS) -> DataFrame:
    """(id, th, size, spans) of the texts that hold a passage of ``least`` words or more which also stands earlier: its bytes, start:stop.

    ``texts``: (id, th, size, text).  The order is by (id, th, size, place); wholly equal rows have the same spans.
    """
    order = Window.partitionBy("piece").orderBy(*KEY, "start")
    again = texts.mapInArrow(_pieces, _PIECE_DDL).withColumn("place", F.rank().over(order)).where("settled or place > 1")
    per_text = again.groupBy(*KEY).agg(F.collect_set(F.struct("first", "words", "start", "stop")).alias("found"))
    spans = per_text.mapInArrow(_runs(least), "id long, th long, size long, spans array<struct<start: bigint, stop: bigint>>")
    return staged(spans.where(F.size("spans") > 0), "para-passages")


def _without(text: str, drop: set[int], spans: list[dict]) -> str:
    """``text`` without the lines ``drop`` and the bytes of ``spans``."""
    kept, begin = [], 0
    for i, line in enumerate(text.encode("utf-8").split(b"\n")):
        end = begin + len(line)
        if i not in drop:
            edges = [begin, *(min(max(x, begin), end) for s in spans for x in (s["start"], s["stop"])), end]
            kept.append(b"".join(line[a - begin:b - begin] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        begin = end + 1
    return b"\n".join(kept).decode("utf-8")


def _passage_cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of ``_cutter``, the words of repeated passages taken out of the kept text too, and what passages there were."""
    for block in blocks(batches, "text", 8 << 20):
        texts, drops, spans = block.column("text").to_pylist(), [], [s or [] for s in block.column("spans").to_pylist()]
        for gone in block.column("gone").to_pylist():
            drops.append({g["idx"] + i for g in gone or () for i in range(g["lines"])})
        kept = [_without(t, d, s) if d or s else t for t, d, s in zip(texts, drops, spans, strict=True)]
        cols = [block.column("doc_id"), pa.array([t.count("\n") + 1 for t in texts], pa.int64()), pa.array([len(d) for d in drops], pa.int64()),
                pa.array([sorted(d) for d in drops], pa.list_(pa.int32())), pa.array(kept, pa.string()), pa.array([len(s) for s in spans], pa.int64()),
                pa.array([",".join(f"{x['start']}:{x['stop']}" for x in s) for s in spans], pa.string())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_lines", "n_removed", "removed_lines", "kept_text", "n_passages", "passage_spans"])


def _cutter(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 8 << 20):
            total, cut, kept, listed = [], [], [], []
            for text, gone in zip(block.column("text").to_pylist(), block.column("gone").to_pylist(), strict=True):
                lines = text.split("\n")
                drop = {g["idx"] + i for g in gone or () for i in range(g["lines"])}
                total.append(len(lines))
                cut.append(len(drop))
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text)
                listed.append(sorted(drop))
            cols = [block.column("doc_id"), pa.array(total, pa.int64()), pa.array(cut, pa.int64()), pa.array(listed, pa.list_(pa.int32())), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_lines", "n_removed", "removed_lines", "kept_text"])

    return run


def dedup_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, recall: float = RECALL, passage_words: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed_lines (numbers from 0), kept_text.

    A paragraph is a run of lines with ``min_words`` words or more, from its first line that holds a word to its last;
    lines are taken in order, and a rest at the end of a text joins the paragraph before (a text with fewer words is
    one paragraph).  Paragraphs whose five-word shingle sets (ASCII letters lower-cased) are similar, directly or
    through others, form a group; its first paragraph by (doc_id, line number) stays, the lines of the others go.
    Rows that repeat a doc_id are ordered by a hash of their text, and wholly equal rows keep or lose the same lines.
    Null doc_ids come last; null texts and texts without a word have no paragraph; empty tables give no rows; other
    columns are not read.

    With ``passage_words`` the words of passages of that many words or more that also stand earlier, inside longer lines
    too, are taken out of ``kept_text``, and n_passages and passage_spans (bytes of the text, start:end) follow.
    """
    text_batches(docs.sparkSession)
    bands, rows = tune(similarity, recall)
    text = text_or_empty()
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(text).alias("th"), F.octet_length(text).cast("long").alias("size"), text.alias("text"))
    plain = base.select(*KEY, "text")
    places = staged(plain.mapInArrow(_places(min_words, bands, rows), _PLACE_DDL), "para-places")
    at = F.struct("id", "idx", "th", "size")
    distinct = staged(places.groupBy("pid").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")), "para-distinct")

    def sets_of(pids: DataFrame) -> DataFrame:
        wanted = distinct.join(pids, "pid", "left_semi").groupBy("first.id", "first.th", "first.size").agg(F.collect_list(F.struct("pid", F.col("first.idx").alias("idx"))).alias("wanted"))
        wanted = staged(wanted, "para-wanted")
        n, parts = wanted.agg(F.count(F.lit(1)), F.sum(F.size("wanted"))).first()
        found = plain.join(maybe_broadcast(wanted, n, 64 * n + 32 * (parts or 0)), KEY).mapInArrow(_sets(min_words), "pid long, shingles array<bigint>")
        return staged(found.groupBy("pid").agg(F.first("shingles").alias("shingles")), "para-sets")

    linked = components(similar_links(distinct.select("pid", "bands"), sets_of, similarity), "a", "b")
    rooted = distinct.select("pid", "first", "n").join(linked, distinct.pid == linked.node, "left").select("pid", "first", "n", F.coalesce("root", "pid").alias("root"))
    stays = rooted.groupBy("root").agg(F.min("first").alias("stays"), F.sum("n").alias("places"))
    keep = rooted.select("pid", "root").join(stays.where("places > 1"), "root").select("pid", "stays")
    gone = places.drop("bands").join(keep, "pid").where(at > F.col("stays"))
    per_doc = gone.groupBy(*KEY).agg(F.collect_set(F.struct("idx", "lines")).alias("gone"))
    columns = "doc_id long, n_lines long, n_removed long, removed_lines array<int>, kept_text string"
    if passage_words is None:
        per_doc = staged(per_doc, "para-gone")
        n, parts = per_doc.agg(F.count(F.lit(1)), F.sum(F.size("gone"))).first()
        out = base.join(maybe_broadcast(per_doc, n, 64 * n + 16 * (parts or 0)), KEY, "left").select("doc_id", "text", "gone")
        return out.mapInArrow(_cutter(min_words), columns)
    per_doc = staged(per_doc.join(repeated_passages(plain, passage_words), KEY, "full"), "para-gone")
    held = F.coalesce(F.size("gone"), F.lit(0)) + F.coalesce(F.size("spans"), F.lit(0))
    n, parts = per_doc.agg(F.count(F.lit(1)), F.sum(held)).first()
    out = base.join(maybe_broadcast(per_doc, n, 80 * n + 32 * (parts or 0)), KEY, "left").select("doc_id", "text", "gone", "spans")
    return out.mapInArrow(_passage_cutter, columns + ", n_passages long, passage_spans string")
