import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import paragraph_minhash as M
from cases import AWKWARD, PROSE, SCHEMA, docs


def shingles(line):
    words = re.findall(r"[^\x20\t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), line))
    return words, {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def runs(text, min_words):
    """Lists of consecutive line numbers: lines until they hold the words, the rest to the last; no blank lines at the ends."""
    worded = [k for k, line in enumerate(text.split("\n")) if shingles(line)[0]]
    lines, out, held = text.split("\n"), [], min_words
    for k in worded:
        if held >= min_words:
            out.append([])
            held = 0
        out[-1].append(k)
        held += len(shingles(lines[k])[0])
    if len(out) > 1 and held < min_words:
        rest = out.pop()
        out[-1] += rest
    return [list(range(run[0], run[-1] + 1)) for run in out]


def brute(rows, min_words):
    """By row: removed line numbers, comparing every two paragraphs."""
    found = []
    for r, (i, t) in enumerate(rows):
        lines = (t or "").split("\n")
        for run in runs(t or "", max(1, min_words)):
            _, s = shingles(" ".join(lines[k] for k in run))
            found.append(((1 << 63) - 1 if i is None else i, run[0], r, s, run))
    root = list(range(len(found)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(found)):
        for y in range(x):
            a, b = found[x][3], found[y][3]
            if len(a & b) >= 0.8 * len(a | b):
                root[find(x)] = find(y)
    first = {}
    for x, f in enumerate(found):
        first[find(x)] = min(first.get(find(x), f[:2]), f[:2])
    gone = {}
    for x, f in enumerate(found):
        if f[:2] > first[find(x)]:
            gone.setdefault(f[2], set()).update(f[4])
    return [sorted(gone.get(r, ())) for r in range(len(rows))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 999)}"
    return " ".join(words)


def test_bands_reach_the_recall():
    for s in (0.5, 0.7, 0.8, 0.9):
        bands, rows = M.tune(s, 0.99, 40)
        assert 1 - (1 - s**rows) ** bands >= 0.99
    assert M.tune() == (10, 3)


@pytest.mark.parametrize("min_words", [1, 20])
def test_matches_all_pairs(spark, min_words):
    rng = random.Random(min_words)
    seeds = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 90))] for _ in range(14)]
    rows = []
    for i in range(120):
        lines = [edited(rng, rng.choice(seeds), rng.choice([0, 0, 1, 1, 2, 4, 12])) if rng.random() < 0.6 else " ".join(f"u{rng.random()}" for _ in range(rng.randint(0, 40)))
                 for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice(["\n", "\n\n"]).join(lines)))
    got = {r.doc_id: r for r in M.dedup_paragraphs(docs(spark, rows), min_words=min_words).collect()}
    for (i, t), want in zip(rows, brute(rows, min_words), strict=True):
        assert got[i].removed_lines == want
        assert got[i].kept_text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want)


def test_short_lines_take_part(spark):
    rng = random.Random(5)
    seeds = [[f"w{rng.randint(0, 400)}" for _ in range(n)] for n in (1, 2, 4, 5, 6, 9, 12, 15, 17, 19)]
    rows = [(i, "\n".join([" ".join(s) for s in rng.sample(seeds, 3)] + [edited(rng, rng.choice(seeds[7:]), 1), f"own{i}", ""])) for i in range(60)]
    got = {r.doc_id: r for r in M.dedup_paragraphs(docs(spark, rows), min_words=1).collect()}
    want = brute(rows, 1)
    assert sum(map(len, want)) > 150
    assert [got[i].removed_lines for i, _ in rows] == want


def test_awkward_rows(spark):
    rows = [*AWKWARD, (30, "x\n" + PROSE.upper() + "\nend"), (31, PROSE + "\n" + PROSE)]
    got = M.dedup_paragraphs(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_removed == 0 and by[2][0].removed_lines == [0] and by[None][0].removed_lines == [0]
    assert by[30][0].removed_lines == [0, 1, 2] and by[31][0].removed_lines == [0, 1] and by[31][0].kept_text == ""
    assert by[3][0].n_lines == 1 and by[3][0].kept_text == ""


def test_parts_of_long_texts(monkeypatch):
    monkeypatch.setattr(M, "BLOCK_BYTES", 30)
    rng = random.Random(3)
    for text in ["\n".join(f"line {i} with words" for i in range(50)) + "\n\nlast", "\n" * 40, "", "w " * 200, "\n\n".join("a b c d" if rng.random() < 0.9 else "x " * 90 for _ in range(200)) + "\n\n"]:
        for min_words in (1, 5, 20):
            parts = list(M._parts(np.frombuffer(text.encode(), np.uint8), min_words))
            assert "\n".join(bytes(p).decode() for _, p in parts) == text
            got = [(line + b, n) for line, p in parts for b, n in zip(*(x.tolist() for x in M.paragraphs(p, min_words)[:2]), strict=True)]
            assert got == [(run[0], len(run)) for run in runs(text, min_words)]


def test_paragraphs_fill_up_with_lines(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"short one\n\n{passage}\nof."), (2, f"other text here\n{passage}\nof."), (3, "of."), (4, "one\ntwo\nthree"), (5, "of.\n\nof.")]
    got = {r.doc_id: r for r in M.dedup_paragraphs(docs(spark, rows)).collect()}
    assert [got[i].removed_lines for i in range(1, 6)] == brute(rows, 20) == [[], [0, 1, 2], [], [], []]


def test_passages_inside_longer_lines(spark):
    rng = random.Random(12)
    own = lambda n: " ".join(f"o{rng.randint(0, 10**9)}" for _ in range(n))
    rows, pasted = [], set()
    for k in range(40):
        passage = own(55)
        rows += [(2 * k, f"{own(60)} {passage} {own(70)}\n{own(30)}"), (2 * k + 1, f"{own(33)}\n{own(80)} {passage.upper()} {own(rng.randint(0, 90))}")]
        pasted.add(2 * k + 1)
    rows += [(100 + k, own(150)) for k in range(40)] + [(200 + k, f"{own(60)} common short line of text {own(60)}") for k in range(20)]
    got = {r.doc_id: r for r in M.dedup_paragraphs(docs(spark, rows), passage_words=20).collect()}
    assert sum(got[i].n_passages > 0 for i in pasted) >= 38 and not any(r.n_passages for i, r in got.items() if i not in pasted)
    for i, t in rows:
        spans = [tuple(map(int, x.split(":"))) for x in got[i].passage_spans.split(",") if x]
        kept = t.encode()
        for s, e in reversed(spans):
            assert len(kept[s:e].split()) >= 20 and kept[s:e].decode().lower() in rows[i - 1][1].lower()
            kept = kept[:s] + kept[e:]
        assert got[i].n_removed == 0 and got[i].kept_text == kept.decode()


def test_passages_and_lines_go_together(spark):
    rng = random.Random(13)
    own = lambda n: " ".join(f"Ü{rng.randint(0, 10**9)}" for _ in range(n))
    line, passage = own(40), own(60)
    rows = [(1, f"{line}\n{own(30)} {passage}"), (2, f"{own(25)}\n{line}\n{own(90)} {passage} {own(90)}"), (2, "a b"), (3, f"{own(30)}\n{line}"), (None, line), (4, None), (5, "")]
    got = {(r.doc_id, r.n_lines): r for r in M.dedup_paragraphs(docs(spark, rows), passage_words=20).collect()}
    assert len(got) == len(rows)
    two = got[2, 3]
    assert two.removed_lines == [1] and two.n_passages >= 1 and two.kept_text.startswith(rows[1][1].split("\n")[0])
    assert two.kept_text.count("\n") == 1 and len(two.kept_text.split()) < 25 + 180 + 25
    assert got[None, 1].kept_text == "" and got[3, 2].removed_lines == [1] and got[1, 2].kept_text == rows[0][1] and got[2, 1].kept_text == "a b"


def test_pieces_do_not_see_their_neighbours(monkeypatch):
    rng = random.Random(14)
    texts = [" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.choice([0, 1, 3, 7, 40, 300]))) + rng.choice(["", "\n", "  "]) for _ in range(40)]
    data = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, data)])
    together = list(zip(*(x.tolist() for x in M.pieces(np.frombuffer(b"".join(data), np.uint8), offs)), strict=True))
    alone = [(k, i, *rest) for i, d in enumerate(data) for k, _, *rest in zip(*(x.tolist() for x in M.pieces(np.frombuffer(d, np.uint8), np.array([0, len(d)]))), strict=True)]
    assert together == alone
    for i, d in enumerate(data):
        mine = [x for x in together if x[1] == i]
        assert sum(x[3] for x in mine) == len(d.split()) and b" ".join(b" ".join(d[x[4]:x[5]].split()) for x in mine) == b" ".join(d.split())


def test_a_template_many_paragraphs_share(spark):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(36)]
    own = lambda: [f"o{rng.randint(0, 10**9)}" for _ in range(12)]
    lines = [common + own() for _ in range(250)]
    lines += [x[:-1] + ["changed"] for x in lines[:40]]
    rows = list(enumerate(" ".join(x) for x in lines))
    got = {r.doc_id: r for r in M.dedup_paragraphs(docs(spark, rows)).collect()}
    want = brute(rows, 20)
    assert [got[i].removed_lines for i, _ in rows] == want and sum(map(len, want)) == 40


@pytest.mark.parametrize("leaders", [0, 2, 9])
def test_crowded_buckets_leader_by_leader(spark, monkeypatch, leaders):
    monkeypatch.setattr(M, "LEADERS", leaders)
    rng = random.Random(9)
    seeds = [[f"w{rng.randint(0, 60)}" for _ in range(30)] for _ in range(3)]
    rows = [(i, edited(rng, rng.choice(seeds), rng.choice([0, 1, 2, 3]))) for i in range(90)]
    sets = spark.createDataFrame([(i, [hash(x) for x in sorted(shingles(t)[1])]) for i, t in rows], "pid long, shingles array<bigint>")
    links = [tuple(r) for r in M._crowded_links(sets, 0.8).collect()]
    size = {i: shingles(t)[1] for i, t in rows}
    like = lambda a, b: len(size[a] & size[b]) >= 0.8 * len(size[a] | size[b])
    root = list(range(90))
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in links:
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a in range(90) for b in range(a) if like(a, b))
    true = list(range(90))
    full = lambda x: x if true[x] == x else full(true[x])
    for a in range(90):
        for b in range(a):
            if like(a, b):
                true[full(a)] = full(b)
    assert all(full(a) == full(b) for a, b in links)


def test_many_rows_without_an_id(spark):
    rows = [(None, f"{PROSE} in many rows here {i}") for i in range(400)] + [(None, "")] * 20
    got = M.dedup_paragraphs(docs(spark, rows)).collect()
    assert len(got) == 420 and sum(r.n_removed for r in got) == 399


def test_buckets_across_batches():
    rows = [(1, 5), (1, 7), (1, 9), (2, 4), (3, 1), (3, 2), (4, 8), (5, 6), (5, 7), (5, 8)]
    table = pa.table({"band": [b for b, _ in rows], "pid": [p for _, p in rows]})
    want = sorted([(1, 5, 5), (1, 7, 5), (1, 9, 5), (3, 1, 1), (3, 2, 1), (5, 6, 6), (5, 7, 6), (5, 8, 6)])
    for size in (1, 2, 3, 4, 20):
        out = pa.Table.from_batches(M._buckets(iter(table.to_batches(max_chunksize=size))))
        assert sorted(zip(*(out[c].to_pylist() for c in out.column_names), strict=True)) == want


def test_empty_table_and_clashing_columns(spark):
    assert M.dedup_paragraphs(spark.createDataFrame([], SCHEMA)).count() == 0
    assert M.dedup_paragraphs(docs(spark, AWKWARD).selectExpr("*", "1 as pid", "2 as th", "3 as bands", "4 as gone")).count() == len(AWKWARD)
