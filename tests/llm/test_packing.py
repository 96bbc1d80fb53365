import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmart.llm.packing import VOCAB, best_fit_decreasing, encode, encode_document, encoder, pack_documents
from cases import AWKWARD, SCHEMA, docs


@pytest.fixture(scope="module")
def hf():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizers_library(hf):
    enc = encoder(VOCAB)
    texts = [f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)}  {chr(c)}x \n{chr(c)}!" for c in range(0x3000) if not 0xD800 <= c <= 0xDFFF]
    texts += ["", " " * 30_000 + "x", "<|endoftext|> it's", "日本語" * 5, "\r\n\t a  b   c"]
    for text, want in zip(texts, hf.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(enc, text).tolist() == want.ids


def test_added_tokens_as_the_library_gives_them_by_default(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end} it's", f"x  {end}  y", end, end * 3, f"a {end[:-1]}", f"{end[:5]}{end}{end[5:]}", f"word \n{end}\n", f"{end}{' ' * 30_000}x {end} 日本語", f"{' ' * 5000}{end}", ""]
    for text in texts:
        assert encode_document(VOCAB, text).tolist() == plain.encode(text, add_special_tokens=False).ids, text[:40]
    got = {r.doc_id: r for r in pack_documents(docs(spark, list(enumerate(texts[:7])))).collect()}
    for i, text in enumerate(texts[:7]):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    for _ in range(60):
        window = rng.choice([1, 7, 64, 100])
        lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 80))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms[rooms.index(min(fits))] -= n
            else:
                rooms.append(window - n)
        windows, got = best_fit_decreasing(lengths, window)
        assert sorted(got) == sorted(rooms)
        assert sorted(i for w in windows for i in w) == list(range(len(lengths)))


@pytest.mark.parametrize("window,chunk", [(2048, 6_000_000), (64, 500)])
def test_round_trip(spark, hf, window, chunk):
    rows = AWKWARD + [(i, "word " * (i % 90)) for i in range(100, 300)]
    got = pack_documents(docs(spark, rows), window=window, chunk_tokens=chunk).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.length * 4 == len(r.ids) and r.length > 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(hf.encode(t or "", add_special_tokens=False).ids + [1])
    assert set(by_doc) == set(want)
    for i, pieces in by_doc.items():
        if len(want[i]) == 1:
            ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(pieces, key=lambda r: r.start)])
            assert ids.tolist() == want[i][0] and {r.doc_tokens for r in pieces} == {len(ids)}
        else:
            assert sum(r.length for r in pieces) == sum(map(len, want[i]))


def test_little_padding(spark):
    rng = random.Random(2)
    rows = [(i, "alpha beta " * rng.randint(1, 900)) for i in range(600)]
    got = pack_documents(docs(spark, rows).coalesce(1)).collect()
    used = sum(r.length for r in got)
    assert used / (2048 * len({r.sequence_id for r in got})) > 0.97


def test_empty_table_and_other_columns(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pack_documents(docs(spark, AWKWARD).selectExpr("*", "1 as ids", "2 as start")).count() >= len(AWKWARD)


def test_crc_of_bytes():
    assert zlib.crc32(np.array([1], "<u4").tobytes()) == 0x99F8B879
