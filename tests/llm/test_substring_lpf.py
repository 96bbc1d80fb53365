import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import substring_lpf as L
from cases import AWKWARD, PROSE, SCHEMA, docs


def brute(rows, length):
    """By row: removed byte flags."""
    key = lambda i: (1 << 63) - 1 if i is None else i
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            first[w] = min(first.get(w, (1 << 64, 0)), (key(i), s))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s:s + length]] < (key(i), s):
                gone[s:s + length] = b"\1" * length
        runs = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out.append((i is None, i or 0, len(raw), sum(gone), runs, bytes(b for b, x in zip(raw, gone) if not x)))
    return sorted(out)


def result(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in df.collect())


def random_rows(rng, n, passages, size):
    alphabet = ["ab", "é ", "xyz ", "\n", "q", "ßw "]
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, size))) for _ in range(passages)]
    return [(rng.randint(0, 3 * n), "".join(rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
                                            for _ in range(rng.randint(0, 6)))) for _ in range(n)]


@pytest.mark.parametrize("length,gram,hot", [(100, 32, 4096), (20, 8, 4096), (20, 8, 2), (33, 16, 1)])
def test_matches_brute_force(spark, length, gram, hot):
    rng = random.Random(length + hot)
    rows = random_rows(rng, 80, 12, 90) + [(500 + i, PROSE[i:] + " " + PROSE[: 60 + i]) for i in range(6)]
    got = result(L.remove_repeats(docs(spark, rows), length, gram, hot))
    assert got == brute(rows, length)


def test_awkward_rows(spark):
    rows = [*AWKWARD, (7, "Äpfel " * 3000), (None, PROSE + "!"), (12, "z" * 99), (13, "z" * 100), (14, "z" * 101)]
    assert result(L.remove_repeats(docs(spark, rows))) == brute(rows, 100)


def test_texts_longer_than_a_block(spark, monkeypatch):
    # workers import the module anew, so the block size is lowered in the functions' own module before they are pickled by reference
    rng = random.Random(8)
    long_ = "".join(rng.choice("abcdefgh \n") for _ in range(3000))
    rows = [(1, long_), (2, "x" + long_[500:2500]), (3, long_[1000:1300])]
    import pyarrow as pa

    monkeypatch.setattr(L, "BLOCK_BYTES", 700)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([0] * 3, pa.int32()), pa.array([t for _, t in rows])], names=["id", "th", "text"])
    got = pa.Table.from_batches(L._run_rows(100, 32)(iter([batch]))).to_pylist()
    for i, t in rows:
        seen = sorted((x >> 8, (x >> 8) + (x & 255)) for r in got if r["id"] == i for x in [r["at"] if r["at"] >= 0 else -r["at"] - 1])
        assert [k for s, e in seen for k in range(s, e)] == list(range(len(t) - 99))


def test_factors_against_all_pairs():
    rng = random.Random(3)
    for _ in range(40):
        text = np.array([rng.choice(b"ab") for _ in range(200)], np.uint8)
        length = rng.choice([8, 9, 16, 31, 40])
        starts = np.array(sorted(rng.sample(range(200 - length), 60)))
        place = np.array([rng.randint(0, 40) for _ in starts])
        got = L.longest_previous_factors(text, starts, place, length)
        for i, s in enumerate(starts):
            best = 0
            for j, q in enumerate(starts):
                if place[j] < place[i]:
                    k = 0
                    while k < length and text[s + k] == text[q + k]:
                        k += 1
                    best = max(best, k)
            assert got[i] == best


def test_shards_are_cut_between_anchors(monkeypatch, spark):
    rng = random.Random(5)
    rows = random_rows(rng, 40, 6, 60)
    import pyarrow as pa

    monkeypatch.setattr(L, "SHARD_BYTES", 50)
    raw = [t.encode() for _, t in rows if len(t.encode()) >= 20]
    recs = [(k % 7, i, 0, 0, c) for i, c in enumerate(raw) for k in range(3)]
    recs.sort(key=lambda r: r[:2])
    cols = list(zip(*recs))
    table = pa.table({"g": cols[0], "id": cols[1], "th": pa.array(cols[2], pa.int32()), "start": cols[3], "content": pa.array(cols[4], pa.binary())})
    for size in (1, 5, 1000):
        out = list(L._shard_factors(20)(iter(table.to_batches(max_chunksize=size))))
        got = sorted({(i, s + k) for b in out for i, s, n in zip(b["id"].to_pylist(), b["start"].to_pylist(), b["n"].to_pylist()) for k in range(n)})
        if size == 1:
            want = got
        assert got == want


def test_empty_table_and_clashing_columns(spark):
    assert L.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert L.remove_repeats(docs(spark, AWKWARD).selectExpr("*", "1 as id", "2 as th", "3 as spans", "4 as g")).count() == len(AWKWARD)


def test_many_rows_without_an_id(spark):
    rng = random.Random(4)
    rows = [(None, "".join(rng.choice("abcdefgh") for _ in range(rng.randint(100, 140)))) for _ in range(300)]
    rows += [(None, f"{i:03d}" + rows[i][1] + "tail") for i in range(100)]  # each holds an earlier text, three places on
    got = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in L.remove_repeats(docs(spark, rows)).collect())
    want = sorted((n, gone, runs) for _, _, n, gone, runs, *_ in brute(rows, 100))
    assert got == want and sum(g for _, g, _ in got) > 0


def test_memory_of_a_task():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 3_000_000, np.uint8).tobytes()
    batches = pa.table({"id": range(100), "th": range(100), "text": [text[i * 30_000:(i + 1) * 30_000].decode() for i in range(100)]}).to_batches(max_chunksize=50)
    pieces = [text[i * 200:(i + 1) * 200] for i in range(15_000)]
    shards = pa.table({"g": range(15_000), "id": range(15_000), "th": range(15_000), "start": [0] * 15_000, "content": pa.array(pieces, pa.binary())}).to_batches(max_chunksize=1000)
    for run, rows, most in ((L._run_rows(100, 32), batches, 65), (L._shard_factors(100), shards, 65)):
        tracemalloc.start()
        for _ in run(iter(rows)):
            pass
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert peak < most, peak
