import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmart.llm import matched_packing as M
from cases import AWKWARD, SCHEMA, docs


def one_by_one(counts, window):
    """Number of windows if every piece is placed on its own: greedy matching, then the tightest gap."""
    large = sorted((n for n, c in counts.items() for _ in range(c) if 3 * n > window), reverse=True)
    rooms = []
    while large:
        a = large.pop(0)
        mate = next((i for i, b in enumerate(large) if a + b <= window), None)
        rooms.append(window - a - (large.pop(mate) if mate is not None else 0))
    for s in sorted((n for n, c in counts.items() for _ in range(c) if 3 * n <= window), reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms[rooms.index(min(fits))] -= s
        else:
            rooms.append(window - s)
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_against_placing_piece_by_piece(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 2, 7, 30, 64])
    counts = {n: rng.choice([0, 1, 2, 3, 17]) for n in range(1, window + 1) if rng.random() < 0.5}
    plan, made = M.plan_windows(counts, window)
    assert made == one_by_one(counts, window)
    held = defaultdict(list)
    for length, runs in plan.items():
        assert [r[0] for r in runs] == sorted({r[0] for r in runs}) and (not runs or runs[0][0] == 0)
        for rank in range(counts[length]):
            first, where, each, at = [r for r in runs if r[0] <= rank][-1]
            held[where + (rank - first) // each].append((at + (rank - first) % each * length, length))
    assert sorted(held) == list(range(made))
    for places in held.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= window and sum(3 * n > window for _, n in places) <= 2


def test_size_of_the_plan_depends_on_the_window_alone():
    rng = random.Random(0)
    counts = {n: rng.randint(1, 10) for n in range(1, 2049)}
    sizes = [sum(map(len, M.plan_windows({n: c * k for n, c in counts.items()}, 2048)[0].values())) for k in (1, 100, 10**6)]
    assert max(sizes) < 20_000


@pytest.mark.parametrize("window", [2048, 64])
def test_round_trip(spark, window):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    rows = AWKWARD + [(i, "word " * rng.randint(0, 300)) for i in range(100, 220)] + [(500, "a<|endoftext|> b")]
    got = M.pack_matched(docs(spark, rows).repartition(5), window=window).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert 0 < r.length == len(r.ids) // 4
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    for i, t in rows:
        want = plain.encode(t or "", add_special_tokens=False).ids + [0]
        if sum(j == i for j, _ in rows) > 1:
            continue
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(want) // window))) and all(r.length == window for r in pieces[1:])
        assert [r.start for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1])
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist() == want
    counts = defaultdict(int)
    for r in got:
        counts[r.length] += 1
    assert len(by_seq) == one_by_one(counts, window)  # one packing for all tasks together


def test_joined_ranks_beyond_a_broadcast(spark):
    rows = [(i, "alpha beta " * (i % 40)) for i in range(200)]
    count = lambda: M.pack_matched(docs(spark, rows).repartition(6)).select("sequence_id").distinct().count()
    want = count()
    spark.conf.set("starmart.broadcast.maxRows", "0")
    try:
        assert count() == want
    finally:
        spark.conf.unset("starmart.broadcast.maxRows")


def test_empty_table_and_clashing_columns(spark):
    assert M.pack_matched(spark.createDataFrame([], SCHEMA)).count() == 0
    got = M.pack_matched(docs(spark, AWKWARD).selectExpr("*", "1 as ids", "2 as piece", "3 as rank", "4 as runs", "5 as part"))
    assert got.where("piece = 0").count() == len(AWKWARD)
