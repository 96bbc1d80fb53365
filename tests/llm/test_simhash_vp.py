import random
import re

import numpy as np
import pytest
import xxhash

from starmart.llm import simhash_vp as S
from starmart.llm.components import components
from cases import AWKWARD, PROSE, SCHEMA, docs


def plain_fp(text):
    words = re.findall(r"[^\x20\t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, reach):
    """By index: smallest index reachable."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= reach:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_in_chunks(monkeypatch):
    texts = [t for _, t in AWKWARD] + [PROSE.upper() + " ÄÖ É", "one", "one two", "one two three"]
    for chunk in (100_000, 7, 1):
        monkeypatch.setattr(S, "CHUNK_WORDS", chunk)
        for t in texts:
            assert S.fingerprint((t or "").encode()) == plain_fp(t)


def test_steps_reach_every_close_pair():
    rng = random.Random(5)
    for levels in S.LEVELS:
        masks = S.bit_blocks(levels)
        assert sum(masks) == S.MASK
        moves = set(S.steps(levels, 2))
        assert len(moves) == len(S.steps(levels, 2))
        for _ in range(200):
            x, v = rng.getrandbits(64), rng.getrandbits(64)
            y = x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            d = tuple(((y ^ v) & m).bit_count() - ((x ^ v) & m).bit_count() for m in masks)
            assert (d in moves) + (tuple(-i for i in d) in moves) >= 1


def near_fps(rng, n):
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        out.add(x)
        for _ in range(rng.randint(0, 6)):
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return list(out)


@pytest.mark.parametrize("levels", S.LEVELS)
def test_links_against_all_pairs(spark, monkeypatch, levels):
    rng = random.Random(levels)
    fps = near_fps(rng, 600)
    monkeypatch.setattr(S, "levels_for", lambda n: levels)
    df = spark.createDataFrame([(S._signed(x),) for x in fps], "fp long")
    got = {r.node & S.MASK: r.root & S.MASK for r in components(S.near_links(df), "a", "b").collect()}
    want = plain_components(fps, 2)
    groups = {}
    for x, w in zip(fps, want, strict=True):
        groups.setdefault(w, set()).add(x)
    mine = {}
    for x in fps:
        mine.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_large_leaf_is_searched_by_vantage_points(monkeypatch):
    rng = random.Random(9)
    fps = near_fps(rng, 400)
    monkeypatch.setattr(S, "LEAF_PAIRS", 500)
    root = S.search_leaf(np.array(fps, np.uint64), len(fps), 2)
    assert root.tolist() == plain_components(fps, 2)


def test_documents(spark):
    rng = random.Random(4)
    rows = list(AWKWARD)
    for i in range(20, 260):
        words = PROSE.split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(["fox", "owl", "Mole"])
        rows.append((i, " ".join(words * rng.randint(1, 8))))
    got = S.simhash_groups(docs(spark, rows), carry=["doc_id", "text"]).collect()
    fps = [plain_fp(t) for _, t in rows]
    comp = plain_components(fps, 2)
    want = {}
    for (i, _), c in zip(rows, comp, strict=True):
        if i is not None:
            want[c] = min(i, want.get(c, i))
    expect = sorted(((i is None, i or 0, t is None, t or ""), f"{f:016x}", want.get(c)) for (i, t), f, c in zip(rows, fps, comp, strict=True))
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or ""), r.fingerprint, r.component_id) for r in got) == expect
    kept = [r.component_id for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(set(comp))


def test_empty_and_clashing_columns(spark):
    assert S.simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    df = docs(spark, AWKWARD).selectExpr("*", "1 as fp", "2 as kept", "3 as w", "4 as root", "5 as row", "6 as id")
    assert S.simhash_groups(df).count() == len(AWKWARD)
