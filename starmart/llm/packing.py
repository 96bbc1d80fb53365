"""Packing: best-fit decreasing into fixed windows, with a segment tree over remaining capacity.

Each scan task tokenises its documents and packs them in chunks of ``CHUNK_TOKENS`` ids, so
nothing is shuffled and a task holds one chunk at a time.  A document longer than a window is
first cut into full windows; the tails are then placed, longest first, into the open window
whose remaining capacity is the smallest that still fits.  Windows left with much room at the
end of a chunk are opened again: their pieces are placed once more with the next chunk.

Ids come from the ``tokenizers`` vocabulary file.  They are computed by tiktoken over the same
ranks (several times faster, equal ids: tests compare both libraries over every code point).
Strings that the file lists as added tokens get their own ids, as that library gives them by
default; the text between them is encoded piece by piece.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import text_batches, text_or_empty

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 2048
END_ID = 1  # fixed value: the id after each document
CHUNK_TOKENS = 6_000_000
MOST_ROOM = 16  # a window with more free places than this is opened again for the next chunk
LONG_SPACE = re.compile(r"\s{2000}")  # white-space runs that overflow tiktoken's own splitter


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies print the bytes of 33-126, 161-172 and 174-255 as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers JSON file, whose ids must follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_alphabet()
    vocab = model["vocab"]
    base = len(letters)
    for i, pair in enumerate(model["merges"]):
        joined = "".join(pair) if isinstance(pair, list) else pair.replace(" ", "", 1)
        if vocab[joined] != base + i:
            raise ValueError(f"{path}: ids do not follow the merges at {i}")
    merged = base + len(model["merges"])
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if i < merged}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of one text as uint32; added-token strings are ordinary text (see encode_document)."""
    if LONG_SPACE.search(text):
        ids: list[int] = []
        for piece in regex.findall(public_tokenizers.PATTERN, text):
            ids += enc._encode_single_piece(piece)
        return np.array(ids, np.uint32)
    return np.asarray(enc.encode_to_numpy(text, disallowed_special=()), np.uint32)


@functools.lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """The added tokens of a tokenizers JSON file: a pattern that finds them, longest first at a place, and their ids."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens") or []
    for t in tokens:
        if any(t.get(option) for option in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added token {t['content']!r} takes more than its own characters into account")
    ids = {t["content"]: t["id"] for t in tokens}
    longest = sorted(ids, key=len, reverse=True)
    return (re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None), ids


def encode_document(path: str, text: str) -> np.ndarray:
    """Ids of one text as uint32, added tokens as their own ids: the library's encode without a post-processor."""
    enc, (found, ids) = encoder(path), added_tokens(path)
    if found is None or not found.search(text):
        return encode(enc, text)
    parts = [np.array([ids[x]], np.uint32) if i % 2 else encode(enc, x) for i, x in enumerate(found.split(text)) if x]
    return np.concatenate(parts)


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the tightest one that fits."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, window_no: int) -> None:
        self.stacks[room].append(window_no)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the smallest room >= need, or None."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        window_no = self.stacks[room].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, window_no


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[list[int]], list[int]]:
    """Windows as lists of positions in ``lengths`` (all <= window), and the room left in each."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    tree, windows, rooms = OpenWindows(window), [], []
    for i in order:
        found = tree.take(lengths[i])
        if found is None:
            windows.append([])
            rooms.append(window)
            found = (window, len(windows) - 1)
        room, w = found
        windows[w].append(i)
        rooms[w] = room - lengths[i]
        if rooms[w]:
            tree.add(rooms[w], w)
    return windows, rooms


OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                 ("sequence_id", pa.int64()), ("offset", pa.int64())])
OUT_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _packer(path: str, window: int, chunk_tokens: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        made = 0

        def rows(pieces, seqs, offs) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()), pa.array([len(p[2]) for p in pieces], pa.int64()),
                 pa.array([p[2].astype("<u4").tobytes() for p in pieces], pa.binary()), pa.array([p[3] for p in pieces], pa.int64()),
                 pa.array(seqs, pa.int64()), pa.array(offs, pa.int64())], schema=OUT)

        def place(pool, last):
            nonlocal made
            windows, rooms = best_fit_decreasing([len(p[2]) for p in pool], window)
            again, pieces, seqs, offs = [], [], [], []
            for w, room in zip(windows, rooms, strict=True):
                if room > MOST_ROOM and not last:
                    again += [pool[i] for i in w]
                    continue
                at = 0
                for i in w:
                    pieces.append(pool[i])
                    seqs.append(first + made)
                    offs.append(at)
                    at += len(pool[i][2])
                made += 1
            out = [rows(pieces[i:i + 4096], seqs[i:i + 4096], offs[i:i + 4096]) for i in range(0, len(pieces), 4096)]
            return again, out

        pool, held = [], 0
        for batch in batches:
            full = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode_document(path, text.as_py()), np.uint32(END_ID))
                n = len(ids)
                cut = n - n % window
                full += [(doc_id, s, ids[s:s + window], n) for s in range(0, cut, window)]
                if cut < n:
                    pool.append((doc_id, cut, ids[cut:].copy(), n))
                    held += n - cut
                if len(full) >= 512:
                    yield rows(full, range(first + made, first + made + len(full)), [0] * len(full))
                    made += len(full)
                    full = []
                if held >= chunk_tokens:
                    pool, out = place(pool, False)
                    held = sum(len(p[2]) for p in pool)
                    yield from out
                    if held >= chunk_tokens // 2:  # pieces that fit nowhere together: close them all
                        _, out = place(pool, True)
                        pool, held = [], 0
                        yield from out
            if full:
                yield rows(full, range(first + made, first + made + len(full)), [0] * len(full))
                made += len(full)
        yield from place(pool, True)[1]

    return pack


def pack_documents(docs: DataFrame, vocab: str = VOCAB, window: int = WINDOW, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``window`` ids.

    One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens
    (of the whole document, end id included), sequence_id, offset.  Added tokens of ``vocab`` that
    stand in a text get their ids.  Null and empty texts are
    the end id alone.  Rows that repeat a doc_id are packed each on its own; null ids stay
    null; other columns of ``docs`` are not read.  Empty tables give no rows.
    """
    text_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return plain.mapInArrow(_packer(vocab, window, chunk_tokens), OUT_SCHEMA)
