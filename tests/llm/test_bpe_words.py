import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from starmart.llm import bpe_words as B
from cases import AWKWARD, SCHEMA, docs


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.ranks(B.RANKS), special_tokens={})


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    arrays = [rng.integers(0, 1 << 32, 100).astype(np.uint32), np.zeros(0, np.uint32), rng.integers(0, 256, 7).astype(np.uint8)]
    for a, b in zip(arrays, B.unpack(B.pack(*arrays)), strict=True):
        assert a.tolist() == b.tolist()


@pytest.mark.parametrize("block,shards", [(12 << 20, None), (200, 3), (1, 1)])
def test_equals_the_library_and_decodes(spark, library, block, shards):
    rng = random.Random(1)
    rows = [*AWKWARD, (12, "<|endoftext|> it's 1234 日本語 \r\n\t\t x"), (13, "a" * 300 + "  " * 50)]
    rows += [(i, " ".join(rng.choice(["straße", "été", "the", "x1", "\n", "été!"]) for _ in range(rng.randint(0, 80)))) for i in range(20, 120)]
    df = docs(spark, rows).repartition(3).cache()
    got = B.decode_documents(B.encode_documents(df, block_bytes=block, shards=shards)).collect()
    df.unpersist()
    want = sorted((i is None, i or 0, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)


def test_texts_are_split_once(spark):
    plan = B.encode_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text


def test_empty_table_and_clashing_columns(spark):
    assert B.encode_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    df = docs(spark, AWKWARD).selectExpr("*", "1 as ids", "2 as key", "3 as payload", "4 as decoded")
    assert B.decode_documents(B.encode_documents(df)).count() == len(AWKWARD)


def test_shards_follow_the_text(spark, monkeypatch, library):
    monkeypatch.setattr(B, "SHARD_BYTES", 1000)
    monkeypatch.setattr(B, "MOST_KNOWN", 5)
    rows = [(i, f"word{i} and {i * 7} more " * 20) for i in range(60)]
    out = B.encode_documents(docs(spark, rows))
    assert out.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out.collect()} == {i: library.encode_ordinary(t) for i, t in rows}
