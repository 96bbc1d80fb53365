import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_ORACLE
from starmart.llm import merkle_manifest as M
from starmart.llm.merkle_sql import MANIFEST
from starmart.llm.queries import op12_merkle_manifest
from cases import AWKWARD, PROSE, SCHEMA

TAMPERED = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
SEEN = lambda: F.replace(F.col("text"), F.lit("\n"), F.lit(""))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def told(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return sha("".join(told(v) for v in (r[0], r[3], r[2], r[4], text)))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        s = i // 3 * 3
        out.append(("".join(level[s:i]), "".join(level[i + 1:s + 3])))
        i //= 3
    return out


def brute(rows):
    """rows as (doc_id, text, lang, source, n_chars); result rows in any order."""
    import zlib

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: tree([leaf(r, r[1]) for r in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            changed = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            h = leaf(r, r[1].replace("\n", "") if changed else r[1])
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = M.merkle_manifest(df, TAMPERED(), SEEN(), **options)
    return sorted(map(tuple, out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def made(seed, n):
    rng = random.Random(seed)
    ids = rng.sample(range(-50_000, 10**6), n)
    text = lambda: rng.choice([None, "", "a\nb", PROSE, "é\n", "x" * rng.randint(1, 50)])
    return [(i, text(), rng.choice(["en", None, ""]), rng.choice(["s1", "s1", "s1", None, "", "sé", "S", "one"] + [f"t{i}"] * (i % 3 == 0)), rng.choice([None, 0, 7])) for i in ids]


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 2), (2, 3), (3, 4), (4, 120)])
def test_matches_plain_trees(spark, seed, n):
    rows = made(seed, n)
    assert run(spark, rows) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(i, t, "en", s, None) for i, t in AWKWARD for s in ("a", None)] + [(None, t, "en", "a", 1) for t in ("z", "y", None, "z")] + [(5, f"same id {i}", None, "a", i) for i in range(30)]
    assert run(spark, rows) == brute(rows)


def test_several_chunks_of_levels_and_salted_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(M, "MERGED", 2)
    rows = [(i * 3, f"t\n{i}", "en", f"s{i % 4 if i % 3 else 0}", i) for i in range(300)] + [(9, "t\n3", "en", "s0", 3)] * 40
    assert run(spark, rows, levels=2) == brute(rows)


def test_ranks_against_sorting():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, M.SPARSE - 1, M.SPARSE + 10, 30_000):
        places = np.sort(rng.choice(1 << M.BLOCK_BITS, n, replace=False))
        extra = (rng.random(n) < 0.01) * rng.integers(1, 9, n)
        data = M.pack_bitmap(places, extra)
        rows = M.unpack_bitmap(data)
        assert rows.sum() == n + extra.sum() and np.flatnonzero(rows).tolist() == places.tolist()
        ranks = M.Ranks(data)
        want = np.cumsum(1 + extra) - (1 + extra)
        assert ranks.rank(places).tolist() == want.tolist() and ranks.shared(places).tolist() == (extra > 0).tolist()


def test_no_tampering_verifies_and_the_path_is_told(spark):
    rows = made(5, 40)
    out = M.merkle_manifest(spark.createDataFrame(rows, SCHEMA))
    assert out.where("verified").count() == 40 and out.where("size(left) != size(right)").count() == 0
    assert {r.source for r in out.collect()} == {r[3] for r in rows}


def test_empty_table_and_clashing_columns(spark):
    assert M.merkle_manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = made(6, 20)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as leaf", "2 as tree", "3 as idx", "4 as left", "5 as n", "6 as row")
    assert M.merkle_manifest(df).where("verified").count() == 20


def test_equals_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_ORACLE}/documents.parquet'")
    got = op12_merkle_manifest(spark, SF_ORACLE)
    want = con.execute(MANIFEST).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
