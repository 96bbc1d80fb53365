import hashlib
import re
from collections import defaultdict

import numpy as np

from starmart.llm.exact_mph import build_mph, exact_dedup, mph_slots
from starmart.llm import exact_mph as M
from cases import AWKWARD, SCHEMA, docs


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\t-\r]+", " ", t or "").encode()).hexdigest()].append(i)
    return {k: (min((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


def test_mph_is_minimal_and_perfect():
    d = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32).copy()
    sizes, bits = build_mph(d)
    assert sorted(mph_slots(d, sizes, bits)) == list(range(5000))


def test_matches_brute_force(spark):
    rows = AWKWARD + [(i, f"text {i % 37}  of\tmany") for i in range(100, 400)]
    for share in (0.0, 0.3, 1.0):
        got = exact_dedup(docs(spark, rows), history_share=share, shard_rows=10).collect()
        want = brute(rows)
        assert len(got) == len(rows)
        for r in got:
            assert (r.keep_id, r.group_size) == want[r.text_sha256]
        kept = defaultdict(int)
        for r in got:
            kept[r.text_sha256] += r.kept
            assert not r.kept or r.doc_id == r.keep_id
        assert set(kept.values()) == {1}


def test_empty_and_clashing_columns(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    df = docs(spark, AWKWARD).selectExpr("*", "1 as digest", "2 as kept", "3 as row", "4 as n", "5 as id", "6 as w")
    out = exact_dedup(df)
    assert out.count() == len(AWKWARD) and dict(out.dtypes)["kept"] == "boolean" and dict(out.dtypes)["w"] == "int"


def test_one_outlying_id_and_ids_that_are_all_null(spark, monkeypatch):
    asked = []
    build = M.build_index
    monkeypatch.setattr(M, "build_index", lambda history, shards: asked.append(shards) or build(history, shards))
    texts = [f"text {i % 300}" for i in range(900)]
    for ids in ([-(10**9), *range(1, 900)], [None] * 900):
        got = M.exact_dedup(docs(spark, list(zip(ids, texts, strict=True))), carry=["doc_id"], shard_rows=50).collect()
        assert len(got) == 900 and sum(r.kept for r in got) == 300 and {r.group_size for r in got} == {3}
    assert min(asked) >= 6
