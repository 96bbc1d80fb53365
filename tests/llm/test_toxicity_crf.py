import itertools
import zlib

import numpy as np
import pytest

from starmart.llm import toxicity_crf as T
from starmart.llm.common import documents
from cases import AWKWARD, SCHEMA, docs


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        unary, trans, first, last = rng.normal(size=n), rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2)
        total, on, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            p = np.exp(first[y[0]] + last[y[-1]] + sum(unary[i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            total += p
            on += p * np.array(y)
            for i in range(n - 1):
                pair[y[i], y[i + 1]] += p
        padded = np.concatenate([unary, rng.normal(size=2)])[None]
        mask = np.arange(n + 2)[None] < n
        marg, got = T.forward_backward(padded, mask, trans, first, last)
        assert np.allclose(marg[0, :n], on / total)
        assert np.allclose(got, pair / total)


def test_runs_around_evidence_equal_the_whole_chain():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(1, 1 << 63, 40).astype(np.uint64))
    model = T.Model(keys, rng.normal(size=40) * 2, -3.0, np.array([[0, -1.0], [-0.5, 0.7]]), np.zeros(3))
    doc = np.sort(rng.integers(0, 5, 3000))
    feats = rng.integers(1, 1 << 63, (3000, 5)).astype(np.uint64)
    for i in rng.integers(0, 3000, 60):
        feats[i, 0] = rng.choice(keys)
    got = T.marginals(model, doc, feats)
    first, last, calm, _ = T._rest(model)
    score = np.nan_to_num(T._evidence(model, feats)) + model.bias
    for d in range(5):
        at = np.flatnonzero(doc == d)
        want, _ = T.forward_backward(score[at][None], np.ones((1, len(at)), bool), model.trans, first, last)
        assert np.allclose(want[0], got[at], atol=1e-9)


@pytest.fixture(scope="module")
def model(spark):
    sf = "/root/testdata/sf0.1"
    return T.learn(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"), 400, 900)


def test_held_out_accuracy(spark, model):
    sf = "/root/testdata/sf0.1"
    got = T.toxicity(documents(spark, sf), model, carry=["doc_id"]).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)  # some labelled texts of this table hold no word that others mark
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_offsets_are_code_points_and_awkward_rows(spark, model):
    rows = [*AWKWARD, (50, "Été naïve \U0001F600 idiot, and loser! moron scum")]
    got = {(r.doc_id, r.text): r for r in T.toxicity(docs(spark, rows), model).collect()}
    assert len(got) == len(set(rows))
    hit = got[rows[-1]]
    assert hit.predicted == 1 and "idiot" in [hit.text[int(a):int(b)] for a, b in (x.split(":") for x in hit.toxic_spans.split(","))]
    assert got[(3, None)].predicted == 0 and got[(4, "")].n_toxic == 0


def test_empty_tables_and_clashing_columns(spark, model):
    none = spark.createDataFrame([], SCHEMA)
    assert T.toxicity(none, model).count() == 0
    bare = T.learn(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    out = T.toxicity(docs(spark, AWKWARD).selectExpr("*", "1 as score", "2 as doc", "3 as id"), bare)
    assert out.count() == len(AWKWARD) and dict(out.dtypes)["score"] == "double"
    assert all(r.predicted == 0 for r in out.collect())


def test_copies_do_not_teach_their_own_words():
    base = b"plain river words that nobody minds about at all in town today"
    toxic = [base + b" copy moron x%d" % i for i in range(200)] + [b"w%d idiot q%d scum" % (i, i) for i in range(40)]
    clean = [b"r%d s%d t%d u%d calm text" % (i, i, i, i) for i in range(200)]
    m = T.train(toxic, clean)
    d = base + b" harmless"
    starts, ends, doc, feats = T.tokens(np.frombuffer(d, np.uint8), np.array([0, len(d)]))
    assert (T.marginals(m, doc, feats) < 0.5).all()
