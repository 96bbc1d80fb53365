"""Shared helpers: reading documents, tables in the shared folder, Arrow batch slicing."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.joins import maybe_broadcast
from starmart.session import drop_work, work_dir

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: a word of the contracts
SPACE = r"[\x20\x09-\x0D]+"  # fixed value: a white-space run of the contracts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Folders that ``staged`` writes inside the block, which are removed at its end.

    For a caller that writes a result inside the block; what it wants to keep it takes out of the list.  A result
    that is still to be computed reads these folders and must not leave the block.
    """
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(outer)
        drop_work(spark, *made)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder (spark.checkpoint.dir) and read it back.

    Cuts the lineage at a table that every executor and the driver can read, so a lost
    executor costs a re-read and never a different result.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_BATCH = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Hand texts to Python 1,000 rows at a time, unless the cluster's configuration names a size.

    With Spark's default of 10,000 rows a batch of documents takes tens of MB in the JVM and again
    in each Python worker.  The setting holds for the session.
    """
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(ROWS_PER_BATCH))


def with_decisions(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """``rows`` (row, doc, ...) with the columns of the narrow table ``decisions`` (row, ...; one per row).

    Decisions are broadcast if their measured size allows, so that texts are not shuffled for a
    few bytes each; else both sides are.
    """
    held = staged(decisions, "decisions")
    n = held.count()
    return rows.join(maybe_broadcast(held, n, 256 * n), "row")  # a verdict is a few ids and at most one hex digest


def text_or_empty(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def blocks(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches holding at most ``most_bytes`` of ``column``, at least one row each."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.diff(offsets(col))
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets (rows + 1 of them) of a string or binary array into its data buffer."""
    if len(col) == 0:
        return np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(col.buffers()[1], kind, len(col) + 1, col.offset * np.dtype(kind).itemsize)
    return raw.astype(np.int64)


def data_bytes(col: pa.Array) -> np.ndarray:
    """The data buffer that ``offsets`` points into."""
    buf = col.buffers()[2] if len(col) else None
    return np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over uint64 (wrap-around arithmetic)."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))

_BASE = 0x9E6C63D0876A9A4B | 1  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
POLYNOMIAL_BYTES = 128


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; the longest table asked for is kept up to 2**21 entries."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        table = np.full(max(n, 1 << 16), np.uint64(base), np.uint64)
        table[0] = 1
        with np.errstate(over="ignore"):
            held = np.multiply.accumulate(table)
        if len(held) <= 1 << 21:
            _POWERS[base] = held
    return held[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 19) -> np.ndarray:
    """64-bit hash of each byte span [start, end) of ``data``; spans in order of start, work in slices of about ``most`` bytes.

    Short spans take a polynomial of their bytes modulo 2**64, whatever its base blind to the difference of a
    Thue-Morse word and its complement from about 1,024 bytes on; spans over ``POLYNOMIAL_BYTES`` take XXH3 instead.
    """
    out = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(ends - starts > POLYNOMIAL_BYTES)
    if len(long):
        short = np.flatnonzero(ends - starts <= POLYNOMIAL_BYTES)
        out[short] = span_hashes(data, starts[short], ends[short], most)
        view = memoryview(np.ascontiguousarray(data))
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True)), np.uint64, len(long))
        return out
    values = mix64(np.arange(256, dtype=np.uint64), 7)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most)))
        low, high = int(starts[i]), int(ends[i:j].max())
        with np.errstate(over="ignore"):
            prefix = np.zeros(high - low + 1, np.uint64)
            np.cumsum(values[data[low:high]] * powers(_BASE, high - low), out=prefix[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            out[i:j] = (prefix[e] - prefix[s]) * powers(_BASE_INV, high - low + 1)[s]
        i = j
    return mix64(out ^ mix64((ends - starts).astype(np.uint64), 3), 1)


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the contract's words in the documents data[offs[i]:offs[i + 1]]."""
    low, high = int(offs[0]), int(offs[-1])
    b = data[low:high]
    solid = ~((b == 0x20) | ((b >= 9) & (b <= 13)))
    cut = np.zeros(len(b) + 1, bool)
    cut[offs - low] = True
    before = np.concatenate([[False], solid[:-1]]) if len(b) else solid
    after = np.concatenate([solid[1:], [False]]) if len(b) else solid
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    doc = np.searchsorted(offs - low, starts, side="right") - 1
    return starts + low, ends + low, doc


def per_doc(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]
