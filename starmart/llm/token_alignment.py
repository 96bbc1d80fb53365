"""Cross-tokenizer alignment by cumulative byte ends.

Both tokenizers cut the same bytes, so a token is known by the byte where it ends.  Each side of a document becomes a
dictionary from cumulative end to token index; the keys that both dictionaries hold, sorted, cut the two id lists into
groups; inside a group the tokens whose byte ranges overlap are linked.  Every byte where either side ends closes one
link: the pair of tokens that hold the byte before it.

How often a pair of ids is linked is counted over the whole corpus in documents.  A scan task works in blocks of
documents: a document keeps its pairs as numbers of the block's distinct pairs, and only the block's distinct pairs
travel to be counted and come back with their counts, so a pair that every document holds is one row per block.

A is a byte-level vocabulary of the ``tokenizers`` library, run by tiktoken over the same ranks (equal ids, tested); B
is a sentencepiece model none of whose pieces holds a space after another character (checked when the model is read).
So wherever a space follows a character that is no white space, both sides end a token, whatever stands around it: a
text is the row of its space-led segments, and its groups are theirs.  Each distinct segment of a block is tokenised
and aligned once; many segments at a time go through the dictionaries as one long text.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.bpe_words import pack, unpack
from starmart.llm.common import staged, text_batches, text_or_empty
from starmart.llm.packing import VOCAB, encode, encoder
from starmart.operators.joins import maybe_broadcast

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BLOCK_CHARS = 32 << 20  # a block ends at so many characters,
BLOCK_SEGMENTS = 400_000  # or so many distinct segments
SEGMENTS_AT_ONCE = 8192
SPACE_PIECE = "▁"
SEGMENT = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")  # up to the next space that follows something else than white space


def _texts(n: int) -> np.ndarray:
    """Decimal text of each id with what may follow it: inside a group, at the end of A's part, of B's part."""
    return np.array([[f"{i},", f"{i}|", f"{i};"] for i in range(n)], object)


@functools.lru_cache(maxsize=2)
def side_a(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte length and decimal texts of each id."""
    enc = encoder(path)
    return np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)], np.int64), _texts(enc.n_vocab)


class Pieces:
    """A sentencepiece model as a function of space-led segments."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        if any(re.search(f"[^{SPACE_PIECE}]{SPACE_PIECE}", p) for p in pieces):
            raise ValueError(f"{path}: a piece holds a space after another character")
        self.texts = _texts(n)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_PIECE, " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.space = self.model.piece_to_id(SPACE_PIECE)

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of each segment; the model itself puts the leading space there, but not before an empty text."""
        found = self.model.encode([s[1:] for s in segments], num_threads=1)
        return [ids if s != " " else [self.space] for s, ids in zip(segments, found, strict=True)]

    def joined(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def side_b(path: str) -> Pieces:
    return Pieces(path)


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each group ends in either id list: token counts up to the end of each group."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = sorted(index_a.keys() & index_b.keys())
    n = len(common)
    return np.fromiter(map(index_a.__getitem__, common), np.int64, n), np.fromiter(map(index_b.__getitem__, common), np.int64, n)


def links(ends_a: np.ndarray, ends_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token indexes (in A, in B) of every overlapping pair, group by group.

    A group of p and q tokens holds p + q - 1 links, one for each byte where either side ends: in order of those
    bytes the token indexes rise by one on the side that ended, on both at a common end.
    """
    inner_a, inner_b = np.ones(len(ends_a), bool), np.ones(len(ends_b), bool)
    inner_a[cut_a - 1] = False
    inner_b[cut_b - 1] = False
    ends = np.concatenate([ends_a, ends_b[inner_b]])  # each common end once
    step_a = np.concatenate([np.ones(len(ends_a), np.int64), np.zeros(int(inner_b.sum()), np.int64)])
    step_b = np.concatenate([~inner_a, np.ones(int(inner_b.sum()), bool)]).astype(np.int64)
    order = np.argsort(ends, kind="stable")
    step_a, step_b = step_a[order], step_b[order]
    return np.cumsum(step_a) - step_a, np.cumsum(step_b) - step_b


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, texts_a: np.ndarray, texts_b: np.ndarray) -> np.ndarray:
    """The tokens of ``a1,a2|b1;a3|b2,b3;`` as an array of strings: the groups' ids in order."""
    out = np.empty(len(ids_a) + len(ids_b), object)
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[cut_a - 1], last_b[cut_b - 1] = 1, 2
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b // 2) - last_b // 2
    before_b = np.concatenate([[0], cut_b])
    out[np.arange(len(ids_a)) + before_b[group_a]] = texts_a[ids_a, last_a]
    out[np.arange(len(ids_b)) + cut_a[group_b]] = texts_b[ids_b, last_b]
    return out


DOC_SCHEMA = ("block long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, "
              "a array<int>, b array<int>, docs array<long>")
_DOC = pa.schema([("block", pa.int64()), ("is_doc", pa.bool_()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())),
                  ("docs", pa.list_(pa.int64()))])
NO_TOKENS = (0, 0, 0, 0, "")
DOCS_PER_BATCH = 512


class Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Segments:
    """Distinct segments of a block, aligned: token, group and link counts, group texts, and linked pairs as numbers."""

    def __init__(self, listed: list[str], path_a: str, path_b: str):
        n, self.listed, self.b = len(listed), listed, side_b(path_b)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, np.int64) for _ in range(4))
        self.texts: list[str] = []
        self.exact = np.ones(n, bool)
        keys: list[np.ndarray] = []
        i = 0
        while i < n:
            j = i + 1
            # a segment that ends in white space is the last of its text: nothing may follow it
            while j < min(n, i + SEGMENTS_AT_ONCE) and not listed[j - 1][-1].isspace():
                j += 1
            keys.append(self._align(i, j, path_a))
            i = j
        self.pairs, numbers = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
        self.numbers = numbers.astype(np.int32)
        self.first = np.cumsum(self.n_links) - self.n_links

    def _align(self, i: int, j: int, path_a: str) -> np.ndarray:
        """Align segments i to j as one text; the keys of their links in order."""
        (sizes_a, texts_a), mine = side_a(path_a), self.listed[i:j]
        encoded = self.b.encode(mine)
        self.texts += [""] * (j - i)
        good = np.arange(j - i)
        if self.b.joined(chain.from_iterable(encoded)) != "".join(mine).encode("utf-8"):
            self.exact[i:j] = [self.b.joined(ids) == s.encode("utf-8") for ids, s in zip(encoded, mine, strict=True)]
            good = np.flatnonzero(self.exact[i:j])
            mine, encoded = [mine[k] for k in good], [encoded[k] for k in good]
        if not len(good):
            return np.zeros(0, np.int64)
        ids_a = encode(encoder(path_a), "".join(mine)).astype(np.int64)
        to_b = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))
        ids_b = np.fromiter(chain.from_iterable(encoded), np.int64, int(to_b[-1]))
        ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(self.b.sizes[ids_b])
        cut_a, cut_b = groups(ends_a, ends_b)
        at_a, at_b = links(ends_a, ends_b, cut_a, cut_b)
        to_a = np.searchsorted(ends_a, ends_b[to_b - 1]) + 1  # the end of a segment is always common
        upto = (to_a, to_b, np.searchsorted(cut_a, to_a) + 1, np.searchsorted(at_a, to_a - 1, side="right"))
        for held, to in zip((self.n_a, self.n_b, self.n_groups, self.n_links), upto, strict=True):
            held[i + good] = np.diff(to, prepend=0)
        parts, at = group_texts(ids_a, ids_b, cut_a, cut_b, texts_a, self.b.texts).tolist(), 0
        for k, to in zip((i + good).tolist(), (to_a + to_b).tolist(), strict=True):
            self.texts[k] = "".join(parts[at:to])
            at = to
        return ids_a[at_a] << 32 | ids_b[at_b]

    def fits(self, row: np.ndarray) -> bool:
        """Whether B's bytes of the text with these segments are the text's."""
        if self.exact[row].all():
            return True
        text = [self.listed[k] for k in row.tolist()]
        return b"".join(self.b.joined(ids) for ids in self.b.encode(text)) == "".join(text).encode("utf-8")

    def linked(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pair numbers of a text and how often each is linked."""
        own, times = np.unique(row, return_counts=True)
        n = self.n_links[own]
        shift = self.first[own] - (np.cumsum(n) - n)
        numbers = self.numbers[np.repeat(shift, n) + np.arange(int(n.sum()))]
        order = np.argsort(numbers)
        numbers = numbers[order]
        first = np.flatnonzero(np.diff(numbers, prepend=-1))
        return numbers[first], np.add.reduceat(np.repeat(times, n)[order], first).astype(np.uint32)


def _align_block(path_a: str, path_b: str, block: int, doc_ids: list, rows: list[np.ndarray], listed: list[str]) -> Iterator[pa.RecordBatch]:
    known = Segments(listed, path_a, path_b)
    docs, out = np.zeros(len(known.pairs), np.int64), []
    for doc_id, row in zip(doc_ids, rows, strict=True):
        if not len(row) or not known.fits(row):
            out.append((block, True, doc_id, *NO_TOKENS, pack(np.zeros(0, np.uint32), np.zeros(0, np.uint32)), None, None, None))
        else:
            found, times = known.linked(row)
            docs[found] += 1
            digest = hashlib.sha256("".join(map(known.texts.__getitem__, row.tolist()))[:-1].encode()).hexdigest()
            told = [int(c[row].sum()) for c in (known.n_a, known.n_b, known.n_groups, known.n_links)]
            out.append((block, True, doc_id, *told, digest, pack(found.astype(np.uint32), times), None, None, None))
        if len(out) == DOCS_PER_BATCH:
            yield _batch(out)
            out = []
    a, b = (known.pairs >> 32).astype(np.int32), (known.pairs & 0xFFFFFFFF).astype(np.int32)
    yield _batch([*out, (block, False, None, None, None, None, None, None, None, a, b, docs)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _DOC.types, strict=True)], schema=_DOC)


def _aligner(path_a: str, path_b: str, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        doc_ids, rows, known, held = [], [], Numbers(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                # the piece for a space would run on over this character: such a text is one segment
                mine = [f" {text}"] if SPACE_PIECE in text else SEGMENT.findall(f" {text}") if text else []
                rows.append(np.fromiter(map(known.__getitem__, mine), np.int32, len(mine)))
                doc_ids.append(doc_id)
                held += len(text) + 64
                if held >= block_chars or len(known) >= BLOCK_SEGMENTS:
                    yield from _align_block(path_a, path_b, block, doc_ids, rows, list(known))
                    block, doc_ids, rows, known, held = block + 1, [], [], Numbers(), 0
        if doc_ids:
            yield from _align_block(path_a, path_b, block, doc_ids, rows, list(known))

    return run


OUT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()),
                  ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _score(docs: pa.Table, counted: pa.Table) -> pa.Table:
    """Sums over each document's links; ``counted``: the block's distinct pairs with their corpus-wide counts."""
    number = counted["number"].to_numpy()
    count, best = np.zeros(len(number), np.int64), np.zeros(len(number), bool)
    count[number] = counted["count"].to_numpy()
    best[number] = counted["best"].to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for packed in docs["pairs"]:
        mine, often = unpack(packed.as_py())
        often = often.astype(np.int64)
        n_best.append(int(often[best[mine]].sum()))
        count_sum.append(int((often * count[mine]).sum()))
    named = {c: docs[c] for c in _OUT.names if c in docs.column_names}
    return pa.table({**named, "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}).select(_OUT.names).cast(_OUT)


def align_tokens(docs: DataFrame, path_a: str = VOCAB, path_b: str = MODEL, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """The alignment's summary per document, and the linked id pairs of the corpus.

    First table, one row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    Second: a, b, count (documents that hold the pair linked), best (the count is the highest of its a, ties
    included).  A encodes space + text, B the text to which it adds a space, both without special tokens.
    Null and empty texts, and texts whose bytes B does not give back (those with U+2581), have no tokens: zeros and
    an empty digest; they count for no pair.  Repeated rows count as documents of their own; null ids stay null;
    other columns are not read; empty tables give no rows.  A task holds the distinct segments of one block and
    the segment numbers of its texts, or of one longer text.
    """
    text_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    blocks = staged(plain.mapInArrow(_aligner(path_a, path_b, block_chars), DOC_SCHEMA), "aligned")
    held = blocks.where(~F.col("is_doc")).select("block", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("number", "pair"))
    held = held.select("block", "number", "pair.a", "pair.b", "pair.docs")
    counts = staged(held.groupBy("a", "b").agg(F.sum("docs").alias("count")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # one row per id of A
    pairs = counts.join(F.broadcast(most), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    n = counts.count()
    counted = held.drop("docs").join(maybe_broadcast(pairs, n, 48 * n), ["a", "b"]).select("block", "number", "count", "best")
    mine = blocks.where("is_doc").select(F.col("block").alias("of"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs")
    return mine.groupBy("of").cogroup(counted.groupBy("block")).applyInArrow(_score, OUT_SCHEMA), pairs
