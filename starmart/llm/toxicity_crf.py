"""Toxicity: a two-state linear-chain conditional random field over words.

Learning uses a bounded sample of labelled documents (``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` rows
at most, in the order of a hash of doc_id).  Document labels become token labels first: in a
toxic document the words whose form or leading letters occur in toxic documents far more often
than in clean ones are labelled toxic, every other word is not.  The field (hashed word and
prefix features, a bias, transitions) is then fitted to those labels by gradient ascent on
the conditional likelihood, and a three-weight logistic turns a document's marginals into its
score.

Scoring reads each document where it lies.  Forward-backward runs around the words that have
any weighted feature; further away than ``memory`` words the messages equal their fixed point
to double precision, so the rest of the text has one known marginal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import blocks, data_bytes, mix64, offsets, span_hashes, text_batches, text_or_empty

TRAIN_TOXIC = 700  # labelled toxic rows learned from, at most
TRAIN_CLEAN = 1200  # labelled clean rows learned from, at most
TRAIN_CHARS = 200_000  # longer texts are scored like any other but not learned from
PREFIXES = (3, 4, 5, 6)  # code points
ROUNDS = 25
WINDOW = 48  # words a training sequence holds
THRESHOLD = 0.7  # fixed value of the contract
BLOCK_BYTES = 1 << 20
HELD_OUT = 1  # fixed value of the contract: remainder of crc32(doc_id) by 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FILTER_BITS = 22


@dataclass
class Model:
    keys: np.ndarray  # feature hashes, sorted
    weights: np.ndarray
    bias: float
    trans: np.ndarray  # log potentials [from, to], states clean and toxic
    logit: np.ndarray  # intercept, log(1 + sum of squared marginals), largest marginal

    def __post_init__(self):
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends, document numbers (letters, digits and non-ASCII bytes) and feature hashes (words, 1 + prefixes)."""
    low, high = int(offs[0]), int(offs[-1])
    b = _LOWER[data[low:high]]
    inside = _IN_WORD[b]
    cut = np.zeros(len(b) + 1, bool)
    cut[offs - low] = True
    before = np.concatenate([[False], inside[:-1]]) if len(b) else inside
    after = np.concatenate([inside[1:], [False]]) if len(b) else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    doc = np.searchsorted(offs - low, starts, side="right") - 1
    lead = (b & 0xC0) != 0x80
    places = np.append(np.flatnonzero(lead), len(b))
    rank = np.cumsum(lead) - 1
    feats = np.empty((len(starts), 1 + len(PREFIXES)), np.uint64)
    feats[:, 0] = mix64(span_hashes(b, starts, ends), 100)
    for i, k in enumerate(PREFIXES):
        stop = places[np.minimum(rank[starts] + k, len(places) - 1)] if len(starts) else starts
        feats[:, i + 1] = mix64(span_hashes(b, starts, np.minimum(stop, ends)), 101 + i)
    return starts + low, ends + low, doc, feats


def _evidence(model: Model, feats: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's features; nan where it has none."""
    out = np.full(len(feats), np.nan)
    hit_row, hit_col = np.nonzero(model.filter[(feats >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    if len(hit_row) and len(model.keys):
        want = feats[hit_row, hit_col]
        at = np.minimum(np.searchsorted(model.keys, want), len(model.keys) - 1)
        ok = model.keys[at] == want
        rows = hit_row[ok]
        out[rows] = 0
        np.add.at(out, rows, model.weights[at[ok]])
    return out


def forward_backward(unary: np.ndarray, mask: np.ndarray, trans: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state (rows, steps) and, per row, expected transition counts (2, 2).

    ``unary``: log potential of toxic against clean; ``mask``: steps that exist (a prefix of each
    row); ``first`` and ``last``: log messages (2,) into the first and out of the last step.
    """
    n, steps = unary.shape
    t = np.exp(trans)
    e = np.stack([np.ones_like(unary), np.exp(np.clip(unary, -50, 50))], axis=2)
    alpha, beta = np.empty((n, steps, 2)), np.empty((n, steps, 2))
    now = np.broadcast_to(np.exp(first - first.max()), (n, 2))
    for s in range(steps):
        x = (now if s == 0 else now @ t) * e[:, s]
        x = x / x.sum(axis=1, keepdims=True)
        now = np.where(mask[:, s, None], x, now)
        alpha[:, s] = now
    end = np.exp(last - last.max())
    now = np.broadcast_to(end, (n, 2))
    for s in range(steps - 1, -1, -1):
        beta[:, s] = now
        x = (now * e[:, s]) @ t.T
        x = x / x.sum(axis=1, keepdims=True)
        now = np.where(mask[:, s, None], x, now)
    both = alpha * beta
    marg = both[:, :, 1] / both.sum(axis=2)
    pair = np.zeros((2, 2))
    if steps > 1:
        live = mask[:, 1:]
        x = alpha[:, :-1, :, None] * t[None, None] * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair = (x / x.sum(axis=(2, 3), keepdims=True))[live].sum(axis=0)
    return marg, pair


def _rest(model: Model) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Fixed-point messages over words without evidence, their marginal, and the words until it is reached."""
    t, e = np.exp(model.trans), np.array([1.0, np.exp(model.bias)])

    def settle(step):
        x = np.full(2, 0.5)
        far = np.array([1e-9, 1.0])
        for i in range(5000):
            if np.abs(x - far).max() < 1e-13:
                return x, i
            x, far = step(x), step(far)
            x, far = x / x.sum(), far / far.sum()
        return x, 5000

    into, a = settle(lambda x: (x * e) @ t)  # message into a word: prior times transitions
    out, b = settle(lambda x: (x * e) @ t.T)
    both = into * e * out
    return np.log(into), np.log(out), float(both[1] / both.sum()), max(a, b) + 1


def marginals(model: Model, doc: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """Toxic marginal of every word; documents are independent chains that start and end at rest."""
    first, last, calm, memory = _rest(model)
    out = np.full(len(doc), calm)
    score = _evidence(model, feats)
    seen = np.flatnonzero(~np.isnan(score))
    if not len(seen):
        return out
    begin, stop = np.searchsorted(doc, doc[seen]), np.searchsorted(doc, doc[seen], side="right")
    left, right = np.maximum(seen - memory, begin), np.minimum(seen + memory + 1, stop)
    new = np.concatenate([[True], left[1:] > right[:-1]])
    new |= np.concatenate([[True], doc[seen][1:] != doc[seen][:-1]])
    heads = np.flatnonzero(new)
    lo, hi = left[heads], np.maximum.reduceat(right, heads)
    unary = np.where(np.isnan(score), 0.0, score) + model.bias
    order = np.argsort(hi - lo)
    i = 0
    while i < len(order):
        # runs of similar length together, at most about a million places
        j = i + 1
        while j < len(order) and (j + 1 - i) * (hi - lo)[order[j]] <= 400_000:
            j += 1
        pick = order[i:j]
        size = int((hi - lo)[pick].max())
        at = lo[pick][:, None] + np.arange(size)
        mask = at < hi[pick][:, None]
        at = np.minimum(at, len(doc) - 1)
        m, _ = forward_backward(unary[at], mask, model.trans, first, last)
        out[at[mask]] = m[mask]
        i = j
    return out


def _doc_features(doc: np.ndarray, marg: np.ndarray, n_docs: int, calm: float) -> np.ndarray:
    total = np.bincount(doc, weights=np.maximum(marg - calm, 0) ** 2, minlength=n_docs)  # squares: many doubtful words are no finding
    most = np.zeros(n_docs)
    np.maximum.at(most, doc, marg)
    return np.stack([np.ones(n_docs), np.log1p(total), most], axis=1)


def _unlike(texts: list[bytes]) -> list[int]:
    """Positions of texts that share neither of two min-hashes of word triples with an earlier one: copies would outvote words."""
    keep: list[int] = []
    seen: set[tuple[int, int]] = set()
    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        starts, _, _, feats = tokens(data, np.array([0, len(data)]))
        w = feats[:, 0]
        grams = mix64(w[:-2] ^ mix64(w[1:-1], 1) ^ mix64(w[2:], 2)) if len(w) >= 3 else w
        marks = {(s, int(mix64(grams, 50 + s).min())) for s in range(2)} if len(grams) else set()
        if not marks & seen:
            keep.append(i)
        seen |= marks
    return keep


def train(toxic: list[bytes], clean: list[bytes], rounds: int = ROUNDS) -> Model:
    """Fit the field and the document logistic to UTF-8 texts of either label."""
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -6.0, np.array([[0.0, -2.0], [0.0, -1.0]]), np.array([-4.0, 0.0, 0.0]))
    toxic, clean = [toxic[i] for i in _unlike(toxic)], [clean[i] for i in _unlike(clean)]
    if not toxic:
        return empty
    texts, n_tox, n_clean = toxic + clean, len(toxic), len(clean)
    docs_, feats_ = [], []
    for i in range(0, len(texts), 50):  # few texts at a time: the byte arrays of the sample together would be large
        part = texts[i:i + 50]
        _, _, d, f = tokens(np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in part])]))
        docs_.append(d + i)
        feats_.append(f)
    doc, feats = np.concatenate(docs_), np.concatenate(feats_)
    del docs_, feats_
    if not (doc < n_tox).any():
        return empty

    width = feats.shape[1]
    support = max(2, round(0.003 * n_tox))
    keys, at = np.unique(feats[doc < n_tox], return_inverse=True)
    pair = np.unique(np.repeat(doc[doc < n_tox], width) * len(keys) + at.ravel())  # (document, feature) once each
    df_tox = np.bincount(pair % len(keys), minlength=len(keys))
    keys, df_tox = keys[df_tox >= support], df_tox[df_tox >= support]
    del at, pair
    pos = np.minimum(np.searchsorted(keys, feats), max(len(keys) - 1, 0)).astype(np.int32) if len(keys) else np.zeros(feats.shape, np.int32)
    known = keys[pos] == feats if len(keys) else np.zeros(feats.shape, bool)
    in_clean = (doc >= n_tox)[:, None] & known
    rows, cols = np.nonzero(in_clean)
    pair = np.unique(doc[rows] * len(keys) + pos[rows, cols]) if len(rows) else np.zeros(0, np.int64)
    df_clean = np.bincount(pair % max(1, len(keys)), minlength=len(keys))
    del pair, rows, cols, in_clean
    odds = np.log((df_tox + 0.5) / (n_tox + 1)) - np.log((df_clean + 0.5) / (n_clean + 1))
    # a leaf of evidence must be common among toxic documents and (nearly) absent from clean ones
    telling = (df_tox >= max(3, round(0.01 * n_tox))) & (odds >= 2.5)
    if not telling.any():
        telling = odds >= 1.5
    label = (known & telling[pos]).any(axis=1) & (doc < n_tox) if len(keys) else np.zeros(len(doc), bool)

    active = odds >= 1.5
    new = np.cumsum(active) - 1
    keys_a, n_feat = keys[active], int(active.sum())
    feat = np.where(known & active[pos], new[pos], n_feat).astype(np.int32) if len(keys) else np.zeros(feats.shape, np.int32)
    del known, pos

    # windows of one document each
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    inside = np.arange(len(doc)) - np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
    heads = np.flatnonzero(first | (inside % WINDOW == 0))
    sizes = np.diff(np.append(heads, len(doc)))
    at = heads[:, None] + np.arange(min(WINDOW, int(sizes.max())))
    mask = at < (heads + sizes)[:, None]
    at = np.minimum(at, len(doc) - 1)
    has = (feat < n_feat).any(axis=1)
    useful = np.logical_or.reduceat(has | label, heads)  # windows without any feature only pull the bias: weigh a tenth of them ten times
    spare = np.flatnonzero(~useful)
    chosen = np.concatenate([np.flatnonzero(useful), spare[::10]])
    weight = np.where(useful[chosen], 1.0, len(spare) / max(1, len(spare[::10])))
    at, mask = at[chosen], mask[chosen]

    w, bias, trans = np.zeros(n_feat + 1), -4.0, np.array([[0.0, -1.0], [0.0, 0.0]])
    g_w, g_b, g_t = np.full(n_feat + 1, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    flat_feat, flat_gold = feat[at], label[at]
    gold_pair = np.zeros((2, 2))
    if at.shape[1] > 1:
        live = mask[:, 1:]
        a, b = flat_gold[:, :-1][live].astype(int), flat_gold[:, 1:][live].astype(int)
        np.add.at(gold_pair, (a, b), np.broadcast_to(weight[:, None], live.shape)[live])
    scale = 1.0 / max(1.0, label.sum())
    flat = np.zeros(2)
    turn = int(useful.sum())
    slices = [(i, min(i + 2000, stop)) for start, stop in ((0, turn), (turn, len(at))) for i in range(start, stop, 2000)]
    for _ in range(rounds):
        grad, grad_b, expect = -1e-3 * w, 0.0, np.zeros((2, 2))
        for i, j in slices:  # windows of one weight each, few at a time to keep memory flat
            marg, p = forward_backward(w[flat_feat[i:j]].sum(axis=2) + bias, mask[i:j], trans, flat, flat)
            expect += p * weight[i]
            gap = np.where(mask[i:j], flat_gold[i:j] - marg, 0.0) * weight[i]
            grad_b += gap.sum() * scale
            r, c, f = np.nonzero(flat_feat[i:j] < n_feat)
            grad += np.bincount(flat_feat[i:j][r, c, f], weights=gap[r, c], minlength=n_feat + 1) * scale
        grad[n_feat] = 0
        grad_t = (gold_pair - expect) * scale - 1e-3 * trans
        grad_t[0, 0] = 0
        g_w += grad**2
        g_t += grad_t**2
        g_b += grad_b**2
        w += 0.6 * grad / np.sqrt(g_w)
        trans = np.clip(trans + 0.2 * grad_t / np.sqrt(g_t), -6, 3)
        bias = float(np.clip(bias + 0.3 * grad_b / np.sqrt(g_b), -12, -2))
    strong = np.abs(w[:n_feat]) > 0.02
    model = Model(keys_a[strong], w[:n_feat][strong], bias, trans, empty.logit)

    calm = _rest(model)[2]
    x = _doc_features(doc, marginals(model, doc, feats), len(texts), calm)
    y = (np.arange(len(texts)) < n_tox).astype(float)
    sw = np.where(y == 1, len(y) / (2 * n_tox), len(y) / (2 * max(1, n_clean)))
    beta = np.array([-2.0, 0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (sw * (y - p)) - 0.5 * beta * [0, 1, 1]
        hess = (x * (sw * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.5, 0.5])
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    model.logit = beta
    return model


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        calm = _rest(model)[2]
        for block in blocks(batches, "text", BLOCK_BYTES):
            col = block.column("text")
            data, offs = data_bytes(col), offsets(col)
            low = int(offs[0])
            starts, ends, doc, feats = tokens(data, offs)
            marg = marginals(model, doc, feats)
            score = 1 / (1 + np.exp(-_doc_features(doc, marg, len(col), calm) @ model.logit))
            bad = np.flatnonzero(marg >= 0.5)
            points = np.concatenate([[0], np.cumsum((data[low:int(offs[-1])] & 0xC0) != 0x80)])
            spans: list[list[str]] = [[] for _ in range(len(col))]
            counts = np.bincount(doc[bad], minlength=len(col))
            head = points[offs - low]
            for d, s, e in zip(doc[bad].tolist(), starts[bad].tolist(), ends[bad].tolist(), strict=True):
                spans[d].append(f"{points[s - low] - head[d]}:{points[e - low] - head[d]}")
            i = block.schema.get_field_index("text")
            cols = [c for j, c in enumerate(block.columns) if j != i]
            names = [n for n in block.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(score), pa.array(counts.astype(np.int64)), pa.array([",".join(x) for x in spans])],
                                             names=[*names, "score", "n_toxic", "spans"])

    return run


def _remainder(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 3, F.lit(0))


def learn(docs: DataFrame, labels: DataFrame, most_toxic: int = TRAIN_TOXIC, most_clean: int = TRAIN_CLEAN) -> Model:
    """Train on labelled rows that are not held out: at most so many of either label, chosen by a hash of doc_id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(_remainder() != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pick = lambda y, n: known.where(F.col("toxic") == y).orderBy(*order).limit(n)
    ids = F.broadcast(pick(1, most_toxic).unionByName(pick(0, most_clean)))  # a few thousand ids, by the limits above
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where(F.length("text") <= TRAIN_CHARS)
    # one text per id, however many rows repeat it
    rows = own.join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()
    return train([r.text.encode() for r in rows if r.toxic == 1], [r.text.encode() for r in rows if r.toxic == 0])


def toxicity(docs: DataFrame, model: Model, carry: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with the columns ``carry`` (default: all) and: held_out, score, predicted, n_toxic, toxic_spans.

    toxic_spans lists start:end code-point offsets of the words tagged toxic.  Null and empty
    texts get the score of a text without evidence; a null doc_id is not held out.  Empty tables
    give no rows; columns of ``docs`` named like an added column are replaced by it.
    """
    text_batches(docs.sparkSession)
    added = ["held_out", "score", "predicted", "n_toxic", "toxic_spans"]
    carry = [c for c in (carry if carry is not None else docs.columns) if c not in added]
    doc = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).alias("none"))
    plain = docs.select(doc.alias("doc"), F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    schema = plain.drop("text").schema.add("score", "double").add("n_toxic", "long").add("spans", "string")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = plain.mapInArrow(_scorer(shared), schema)
    held = (_remainder("id") == HELD_OUT).alias("held_out")
    return scored.select("doc.*", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_toxic", F.col("spans").alias("toxic_spans"))
