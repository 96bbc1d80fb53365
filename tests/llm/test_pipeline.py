import os
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from starmart.llm.common import documents, staged
from starmart.llm.pii_bootstrap import KINDS
from starmart.llm.simhash_vp import simhash_groups
from starmart.llm.toxicity_crf import learn, toxicity
from starmart.session import ensure_checkpoint_dir
from cases import AWKWARD, SCHEMA, docs
from test_pii_bootstrap import plain_spans
from test_simhash_vp import plain_components, plain_fp

SF = "/root/testdata/sf0.01"


def masked(text):
    out, done = "", 0
    for s, k, e in plain_spans(text):
        if s >= done:
            out += text[done:s] + f"[{KINDS[k].upper()}]"
        done = max(done, e)
    return out + text[done:]


def expected(rows, toxic):
    """(doc_id, final text) of what the four first stages keep, in plain Python."""
    rows = sorted((i, t or "") for i, t in rows if i not in toxic)
    seen, distinct = set(), []
    for i, t in rows:
        k = re.sub(r"[\x20\t-\r]+", " ", t)
        if k not in seen:
            distinct.append((i, t))
        seen.add(k)
    comp = plain_components([plain_fp(t) for _, t in distinct], 2)
    return {i: masked(t) for n, (i, t) in enumerate(distinct) if comp[n] == n}


def test_whole_run_against_plain_python(spark):
    table = documents(spark, SF)
    model = learn(table, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity(table, model, carry=["doc_id"]).where("predicted = 1").collect()}
    assert 0 < len(toxic) < 200
    want = expected([(r.doc_id, r.text) for r in table.collect()], toxic)
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = defaultdict(list)
    for r in C.run(spark, SF).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for i, text in want.items():
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(got[i], key=lambda r: r.start)])
        assert ids.tolist() == [*hf.encode(text, add_special_tokens=False).ids, 1]


def test_stage_columns_and_awkward_rows(spark):
    frame = docs(spark, AWKWARD)
    for name, stage in C.STAGES[:-1]:
        frame = staged(stage(spark, frame, SF), "test-stage")
        assert frame.columns == SCHEMA.names, name
    assert 0 < frame.count() <= len(AWKWARD)
    assert simhash_groups(frame).where("not kept").count() == 0


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    for _, stage in C.STAGES:
        frame = staged(stage(spark, frame, SF), "test-stage")
    assert frame.count() == 0


def test_only_the_last_result_stays_in_the_shared_folder(spark):
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables".removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = C.run(spark, "/root/testdata/sf0.001")
    left = set(os.listdir(base)) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-packing") and out.count() > 0
