"""Quality rules: repetition coverage.

Rolling hashes of word n-grams of several lengths are taken in numpy over a block of
documents at a time; the code points of words inside n-grams that occur twice or more in the
same text, and of lines equal to an earlier line, are measured against the whole text.  A
text whose n-gram of m words repeats also repeats the shorter n-grams in it, so each longer
length looks only at the places where the one before it repeated.

Words and n-grams are compared by hashes of 64 bits, lines with equal hashes by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import _BASE, _BASE_INV, blocks, data_bytes, mix64, offsets, per_doc, powers, span_hashes, text_batches, text_or_empty, word_spans

BLOCK_BYTES = 2 << 20
SYMBOLS = "#*$%&|<>"  # fixed value
WINDOW_WORDS = 8  # fixed value: the base rule's window
LEAST_WORDS = 20  # fixed value
#: Largest share of word code points inside repeated n-grams, by n-gram length in words.
NGRAM_SHARES = {5: 0.30, 6: 0.28, 8: 0.24, 10: 0.20}
LINE_SHARE = 0.30  # largest share of code points in lines equal to an earlier line

OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                 ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("dup_line_share", pa.float64()),
                 *[(f"dup_{n}gram_share", pa.float64()) for n in NGRAM_SHARES]])
OUT_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
              "dup_line_share double, " + ", ".join(f"dup_{n}gram_share double" for n in NGRAM_SHARES))

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _first_place(keys: np.ndarray) -> np.ndarray:
    """For each key the place where it occurs first."""
    order = np.argsort(keys, kind="stable")
    head = np.flatnonzero(np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])) if len(keys) else order
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(order[head], np.diff(np.append(head, len(keys))))
    return out


def equal_to_earlier(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which lines [start, end) of ``b`` equal an earlier line of their document; ``keys``: hashes of line and document."""
    first = _first_place(keys)
    again = first != np.arange(len(keys))
    line = lambda i: b[starts[i]:ends[i]].tobytes()
    for d in {int(doc[i]) for i in np.flatnonzero(again) if line(i) != line(first[i])}:  # different lines of one hash
        seen: set[bytes] = set()
        for i in np.flatnonzero(doc == d):
            again[i] = line(i) in seen
            seen.add(line(i))
    return again


def repeated_ngrams(words: np.ndarray, doc: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """By n: which words lie in an n-gram that occurs twice or more in their document (first occurrences too)."""
    n_words = len(words)
    salt = mix64(doc.astype(np.uint64), 11)
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(_BASE, n_words))])
    at = np.arange(n_words)
    out = {}
    for n in sorted(lengths):
        at = at[at + n <= n_words]
        at = at[doc[at] == doc[at + n - 1]]
        with np.errstate(over="ignore"):
            keys = mix64((prefix[at + n] - prefix[at]) * powers(_BASE_INV, n_words + 1)[at] ^ salt[at], n)
        at = at[_repeated(keys)]
        edge = np.bincount(at, minlength=n_words + 1) - np.bincount(at + n, minlength=n_words + 1)[: n_words + 1]
        out[n] = np.cumsum(edge)[:n_words] > 0
    return out


def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts and verdicts of one block of documents (columns doc_id, text)."""
    col = batch.column("text")
    offs, data = offsets(col), data_bytes(col)
    n_docs = len(col)
    low, high = int(offs[0]), int(offs[-1])
    b, local = data[low:high], offs - low
    starts, ends, doc = word_spans(data, offs)
    lead = (b & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    chars = points[ends - low] - points[starts - low]
    by_doc = lambda w: np.bincount(doc, weights=w, minlength=n_docs).astype(np.int64)
    n_words = np.bincount(doc, minlength=n_docs).astype(np.int64)
    word_chars = by_doc(chars)
    n_symbols = per_doc(_IS_SYMBOL[b], local)

    found = repeated_ngrams(span_hashes(data, starts, ends), doc, sorted({WINDOW_WORDS, *NGRAM_SHARES}))
    n_repeat = by_doc(found[WINDOW_WORDS])

    is_break = np.zeros(len(b) + 1, bool)
    is_break[:-1] = b == 10
    line_start = np.unique(np.concatenate([local[:-1], np.flatnonzero(is_break[:-1]) + 1]))
    line_start = line_start[line_start < len(b)]
    line_end = np.append(line_start[1:], len(b))
    line_doc = np.searchsorted(local, line_start, side="right") - 1
    line_end = np.minimum(line_end, local[line_doc + 1])
    line_end -= (line_end > line_start) & (b[line_end - 1] == 10) if len(line_end) else 0
    words_before = np.searchsorted(starts - low, line_start)
    worded = np.searchsorted(starts - low, line_end) > words_before
    line_start, line_end, line_doc = line_start[worded], line_end[worded], line_doc[worded]
    keys = mix64(span_hashes(data, line_start + low, line_end + low) ^ mix64(line_doc.astype(np.uint64), 5))
    again = equal_to_earlier(b, line_start, line_end, line_doc, keys)
    line_chars = points[line_end] - points[line_start]
    count = lambda w: np.bincount(line_doc, weights=w, minlength=n_docs)
    dup_lines, in_lines, in_dup = count(again).astype(np.int64), count(line_chars), count(line_chars * again)

    base_failed = (n_words < LEAST_WORDS) | (100 * n_repeat > 30 * n_words)
    line_share = in_dup / np.maximum(in_lines, 1)
    shares = {n: by_doc(chars * found[n]) / np.maximum(word_chars, 1) for n in NGRAM_SHARES}
    kept = ~base_failed & (line_share <= LINE_SHARE)
    for n, most in NGRAM_SHARES.items():
        kept &= shares[n] <= most
    cols = [batch.column("doc_id"), n_words, word_chars, n_symbols, dup_lines, n_repeat, base_failed, kept, line_share, *shares.values()]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], schema=OUT)


def _measure_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", BLOCK_BYTES):
        yield measure(block)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts of the base rules, base_failed, kept and the measured shares.

    Null texts have no words (base_failed).  Rows that repeat a doc_id are measured each on
    its own; null ids stay null; other columns are not read; empty tables give no rows.
    Nothing is shuffled: a block of documents is measured where it was read.
    """
    text_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return plain.mapInArrow(_measure_all, OUT_SCHEMA)
