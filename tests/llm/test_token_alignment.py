import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starmart.llm import token_alignment as A
from starmart.llm.packing import byte_alphabet
from cases import AWKWARD, SCHEMA, docs


@pytest.fixture(scope="module")
def sides():
    """(ids, byte lengths) of a text under either library, or None where the bytes differ."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    letters = byte_alphabet()
    bytes_a = {i: bytes(letters[c] for c in token) for token, i in t.get_vocab().items() if i != 50256}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def run(text):
        if not text:
            return None
        whole, out = f" {text}".encode(), []
        for ids, of in ((t.encode(f" {text}", add_special_tokens=False).ids, bytes_a.__getitem__), (sp.encode(text), piece)):
            parts = [of(i) for i in ids]
            if b"".join(parts) != whole:
                return None
            out.append((ids, [len(p) for p in parts]))
        return out

    return run


def aligned(found):
    """Groups and linked token pairs by comparing every two byte ranges."""
    ranges = []
    for _, sizes in found:
        at, mine = 0, []
        for n in sizes:
            mine.append((at, at + n))
            at += n
        ranges.append(mine)
    (a, _), (b, _) = found
    ends = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
    groups, low = [], 0
    for end in ends:
        inside = [[ids[i] for i, (s, e) in enumerate(r) if low <= s and e <= end] for ids, r in zip((a, b), ranges, strict=True)]
        groups.append("|".join(",".join(map(str, x)) for x in inside))
        low = end
    links = [(a[i], b[j]) for i, (s, e) in enumerate(ranges[0]) for j, (u, v) in enumerate(ranges[1]) if s < v and u < e]
    return len(a), len(b), groups, links


def brute(sides, rows):
    found = [(i, aligned(f) if (f := sides(t)) else None) for i, t in rows]
    count = Counter(p for _, f in found if f for p in set(f[3]))
    most = defaultdict(int)
    for (a, _), c in count.items():
        most[a] = max(most[a], c)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr), {(a, b): (c, c == most[a]) for (a, b), c in count.items()}


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = ["the", "river", "naïve", "日本", "\U0001F600", " ", "  ", "\n", "\t", " \n ", "\x1f", "\xa0", "　", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "1234", "it's", "...", "ß", "\x00", "é", "ﬁ",
             " ", "x" * 40, "don't", " leading", "trail ", "\r\n", "Zürich"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 700, 32 << 20])
def test_matches_both_libraries(spark, sides, block):
    texts = odd_texts(1, 120) + [" ", "  ", "▁", "a▁b", "x▁ y and more", "▁▁ ", "a", None, "", " a", "a ", "\n", "\n\n a"]
    rows = [*[(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in AWKWARD], *enumerate(texts, 100)]
    out, pairs = A.align_tokens(docs(spark, rows), block_chars=block)
    want, counts = brute(sides, rows)
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()} == counts


def test_every_code_point_below_3000(sides):
    b = A.side_b(A.MODEL)
    for c in range(1, 0x3000):
        if 0xD800 <= c <= 0xDFFF or c == 0x2581:
            continue
        text = f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}  x"
        segments = A.SEGMENT.findall(f" {text}")
        assert "".join(segments) == f" {text}"
        assert [i for ids in b.encode(segments) for i in ids] == b.model.encode(text), hex(c)


def test_long_texts_and_many_segments(spark, sides, monkeypatch):
    monkeypatch.setattr(A, "SEGMENTS_AT_ONCE", 3)
    monkeypatch.setattr(A, "BLOCK_SEGMENTS", 10)
    rows = [(1, "x" * 3000), (2, "word " * 400), (3, " ".join(f"w{i}" for i in range(300))), (4, "日本語" * 300), (5, "word " * 400)]
    assert sorted(map(tuple, A.align_tokens(docs(spark, rows))[0].collect()), key=repr) == brute(sides, rows)[0]


def test_counts_joined_beyond_a_broadcast(spark, sides):
    rows = [(i, t) for i, t in enumerate(odd_texts(2, 40))]
    spark.conf.set("starmart.broadcast.maxRows", "0")
    try:
        assert sorted(map(tuple, A.align_tokens(docs(spark, rows).repartition(4), block_chars=300)[0].collect()), key=repr) == brute(sides, rows)[0]
    finally:
        spark.conf.unset("starmart.broadcast.maxRows")


def test_empty_table_and_clashing_columns(spark):
    out, pairs = A.align_tokens(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and pairs.count() == 0
    out, _ = A.align_tokens(docs(spark, [(1, "a b"), (2, None)]).selectExpr("*", "1 as block", "2 as pairs", "3 as a", "4 as is_doc"))
    assert out.count() == 2
    out, pairs = A.align_tokens(docs(spark, [(1, None), (2, ""), (None, "▁")]))
    assert out.where("n_links = 0 and groups_sha256 = ''").count() == 3 and pairs.count() == 0
