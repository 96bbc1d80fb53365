"""Byte-level BPE by a global shuffle of distinct words.

1. Each scan task splits its texts into pre-tokens and numbers the distinct ones of a block of
   documents; a document becomes the sequence of those numbers (its words by position).
2. A block's distinct words go to word shards by hash, so that all blocks' copies of one word
   meet in one task, which encodes it once.
3. The ids go back to their block and are put in the words' places.

Both halves of a block, its word numbers and its packets of words, travel in one exchange that
the two sides of the plan reuse, so texts are split once.  What is shuffled is compressed and
columnar: a packet holds all words of one block for one shard.  A word that a third of all
tokens repeat is one entry per block.  Block numbers come from the scan's partition numbers, so
the input must be a table (or any plan that gives the same partitions again).

Decoding joins ids to the token-byte table, which has as many rows as the vocabulary.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from starmart.llm.common import text_batches, text_or_empty

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 64 << 20  # text whose distinct words go to one word shard
MOST_KNOWN = 1 << 20  # words whose ids an encoder keeps at hand

_ROW = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])
_ROW_DDL = "key long, block long, doc_ids array<bigint>, payload binary"
_IDS = pa.schema([("key", pa.int64()), ("payload", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as one compressed string: sizes, then the arrays byte plane by byte plane."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.dtype.itemsize, len(a)))], "<u8")
    planes = [a.astype(a.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *planes]))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    head = np.frombuffer(raw, "<u8", 1 + 2 * n)[1:].reshape(n, 2).astype(int).tolist()
    out, at = [], 8 * (1 + 2 * n)
    for width, count in head:
        plane = np.frombuffer(raw, np.uint8, width * count, at).reshape(width, count)
        out.append(np.ascontiguousarray(plane.T).view(f"<u{width}").reshape(-1))
        at += width * count
    return out


def _splitter(block_bytes: int, shards: int):
    def block_rows(block: int, doc_ids: list, counts: list[int], codes: list[np.ndarray], words: dict[str, int]) -> pa.RecordBatch:
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        # number words by falling frequency: small numbers compress, and a packet's numbers rise
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        rows = [(block, block, doc_ids, pack(np.array(counts, np.uint32), number[flat], np.array([len(words)], np.uint32)))]
        listed = [w.encode("utf-8") for w in words]
        shard = np.array([xxhash.xxh64_intdigest(w) % shards for w in listed], np.int64)[order]
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
        for s in range(shards):
            numbers = by_shard[cuts[s]:cuts[s + 1]]
            if len(numbers):
                mine = [listed[i] for i in order[numbers].tolist()]
                steps = np.diff(numbers, prepend=0).astype(np.uint32)
                sizes = np.array([len(w) for w in mine], np.uint32)
                rows.append((-1 - s, block, None, pack(steps, sizes, np.frombuffer(b"".join(mine), np.uint8))))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW.types, strict=True)], schema=_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(public_tokenizers.PATTERN).findall
        first = TaskContext.get().partitionId() << 32
        made, held = 0, 0
        doc_ids, counts, codes, words = [], [], [], {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                pieces = find(text)
                seen = words.setdefault
                codes.append(np.array([seen(w, len(words)) for w in pieces], np.uint32))
                doc_ids.append(doc_id)
                counts.append(len(pieces))
                held += len(text)
                if held >= block_bytes:
                    yield block_rows(first + made, doc_ids, counts, codes, words)
                    made, held = made + 1, 0
                    doc_ids, counts, codes, words = [], [], [], {}
        if doc_ids:
            yield block_rows(first + made, doc_ids, counts, codes, words)

    return run


def _word_encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path)._core_bpe.encode_single_piece
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            out = []
            for key, block, payload in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                if key >= 0:  # a block's word numbers: the other side of the plan takes them
                    continue
                steps, sizes, letters = unpack(payload.as_py())
                raw, ids, at = letters.tobytes(), [], 0
                for n in sizes.tolist():
                    word = raw[at:at + n]
                    at += n
                    got = known.get(word)
                    if got is None:
                        if len(known) >= MOST_KNOWN:
                            known.clear()
                        got = known[word] = encode(word)
                    ids.append(got)
                lengths = np.fromiter(map(len, ids), np.uint32, len(ids))
                out.append((block, pack(steps, lengths, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum())))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _IDS.types, strict=True)], schema=_IDS)

    return run


def _reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
    rows = [] if left.num_rows == 0 or left["key"][0].as_py() < 0 else left.to_pylist()
    if not rows:
        return _OUT.empty_table()
    counts, numbers, n_words = unpack(rows[0]["payload"])
    n_words = int(n_words[0])
    size = np.zeros(n_words + 1, np.int64)
    packets = [unpack(p.as_py()) for p in right["payload"]]
    places = [np.cumsum(steps.astype(np.int64)) for steps, _, _ in packets]
    for at, (_, lengths, _) in zip(places, packets, strict=True):
        size[at + 1] = lengths
    start = np.cumsum(size)
    table = np.zeros(int(start[-1]), np.uint32)  # ids of the block's words, in word order
    for at, (_, lengths, ids) in zip(places, packets, strict=True):
        lengths = lengths.astype(np.int64)
        shift = start[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]])
        table[np.repeat(shift, lengths) + np.arange(len(ids))] = ids
    del packets, places
    size, out, n_tokens, done = size[1:], [], [], 0
    for n in counts.tolist():
        words = numbers[done:done + n]
        done += n
        lengths = size[words]
        shift = start[words] - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if n else lengths
        ids = table[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]
        out.append(ids.astype("<u4").tobytes())
        n_tokens.append(len(ids))
    return pa.table([pa.array(rows[0]["doc_ids"], pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(out, pa.binary())], schema=_OUT)


def _text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0


def encode_documents(docs: DataFrame, path: str = RANKS, block_bytes: int = BLOCK_BYTES, shards: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    Ids are those of the tiktoken library without special tokens.  Null and empty texts have no
    ids.  Repeated and null doc_ids are kept as they are; other columns are not read; an empty
    table gives no rows.  ``shards`` word shards hold the distinct words (default:
    spark.sql.shuffle.partitions, or one per 64 MB of text if that is more).
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_text_bytes(docs) // SHARD_BYTES))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    split = plain.mapInArrow(_splitter(block_bytes, n), _ROW_DDL).repartition(n, "key")
    encoded = split.mapInArrow(_word_encoder(path), "key long, payload binary")
    return split.groupBy("key").cogroup(encoded.groupBy("key")).applyInArrow(_reassemble, "doc_id long, n_tokens long, ids binary")


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: start of each id's bytes (ids + 1 of them) and all bytes."""
    table = ranks(path)
    listed = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        listed[i] = token
    return np.concatenate([[0], np.cumsum([len(t) for t in listed])]), np.frombuffer(b"".join(listed), np.uint8)


def decode(ids: np.ndarray, path: str) -> bytes:
    start, letters = token_bytes(path)
    lengths = start[ids + 1] - start[ids]
    shift = start[ids] - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(ids) else lengths
    return letters[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))].tobytes()


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                col = part.column(part.schema.get_field_index("ids"))
                texts = [None if x is None else decode(np.frombuffer(x, "<u4").astype(np.int64), path) for x in (v.as_py() for v in col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])

    return run


def decode_documents(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes of each row's ids; null ids give null."""
    rows = encoded.drop("decoded")
    return rows.mapInArrow(_decoder(path), StructType([*rows.schema.fields, StructField("decoded", BinaryType())]))
