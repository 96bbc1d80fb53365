"""PII: base patterns, and contextual extraction bootstrapped from what they find.

A scan finds the base entities and every other identifier-like string (a run of digits with
separators, a token with an at sign), each with the lexical patterns around it: the two words
before it, the word on either side, the two words after it.  Base entities are the seeds.
Spark then scores the bipartite graph of patterns and instances in rounds: a pattern's
confidence for a kind is the summed score of the instances it holds, over all distinct
instances it holds, damped by their number; an unseen instance whose shape suits the kind
scores one minus the chance that all its patterns are wrong.  Instances above ``ACCEPT`` become
seeds of the next round, until a round finds no more, and their occurrences are added to the spans of the base patterns.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import blocks, staged, text_batches, text_or_empty
from starmart.operators.joins import can_broadcast

KINDS = ("email", "ip", "card", "phone")  # fixed value: the contract's order
MOST_ROUNDS = 200  # rounds go on until nothing new is accepted; reaching this is an error, not a result
ACCEPT = 0.9  # score an unseen instance needs
LEAST_SEEDS = 3.0  # summed instance score a pattern needs before it counts
SMOOTH = 0.2  # doubt added to a pattern's instances
LEAST_CONFIDENCE = 0.6  # a pattern below this says nothing
BLOCK_BYTES = 8 << 20
CONTEXT_CHARS = 60  # looked at first; more where the words are longer
LONG = 200  # longer strings stand in the graph by their hash
MOST_DIGITS = 19  # of any kind of identifier

# The contract's patterns, with possessive repeats where they match the same.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"(?<![0-9A-Za-z=+])\(?[0-9][0-9()/ .:-]*[0-9](?![0-9A-Za-z])")
_AT = re.compile(r"[^\s@<>,;:\"'()]+(?:@|\(at\)|\[at\])[^\s@<>,;:\"'()]+")
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base entities, in that order."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if len(m.group()) <= 40 and 12 <= len(d := digits(m.group())) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(digits(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(value: str) -> int:
    """Kind number an unseen identifier could have, -1 for none."""
    if "@" in value or "(at)" in value or "[at]" in value:
        return 0
    d = digits(value)
    if value.count(":") >= 2 and re.fullmatch(r"[0-9]{1,4}(?::[0-9]{0,4}){3,7}", value):
        return 1
    if 12 <= len(d) <= 19 and luhn(d):
        return 2
    if 7 <= len(d) <= 11 and re.fullmatch(r"\(?[0-9]{2,4}\)?(?:[ ./-]?[0-9]{2,4}){2,3}", value) and len(d) < len(value):
        return 3
    return -1


def other_identifiers(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number or -1, end) of identifier-like strings that touch no base span."""
    found = []
    if _DIGIT.search(text):
        found += [(m.start(), m.end()) for m in _RUN.finditer(text)]
    if "@" in text or "(at)" in text or "[at]" in text:
        found += [(m.start(), m.end()) for m in _AT.finditer(text)]
    found.sort()
    out, done = [], 0
    starts = sorted(s for s, _, _ in known)
    furthest = list(accumulate((e for _, e in sorted((s, e) for s, _, e in known)), max))  # end of any of the first spans
    for s, e in found:
        before = bisect_left(starts, e)
        if s < done or (before and furthest[before - 1] > s):
            continue
        while text[e - 1] in ".:/ -(" and e > s + 1:
            e -= 1
        done = e
        out += _parted(text, s, e)
    return out


def _parted(text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """A run as one candidate, or, if its shape is none, the identifiers in it that spaces part, and what is between them."""
    whole = shape(text[start:end])
    if whole >= 0 or " " not in text[start:end]:
        return [(start, whole, end)]
    tokens = [(start + m.start(), start + m.end()) for m in re.finditer("[^ ]+", text[start:end])]
    out, rest, i = [], None, 0
    while i < len(tokens):
        best, n, j = None, 0, i
        while j < len(tokens):
            n += len(digits(text[tokens[j][0]:tokens[j][1]]))
            if n > MOST_DIGITS:
                break
            if (kind := shape(text[tokens[i][0]:tokens[j][1]])) >= 0:
                best = (tokens[i][0], kind, tokens[j][1], j + 1)
            j += 1
        if best is None:
            rest = (rest[0] if rest else tokens[i][0], -1, tokens[i][1])
            i += 1
            continue
        out += [rest] if rest else []
        rest, i = None, best[3]
        out.append(best[:3])
    return out + ([rest] if rest else [])


def _near_words(text: str, at: int, ahead: bool) -> list[str]:
    """The two whole words after or before a place, however long they are."""
    width = CONTEXT_CHARS
    while True:
        low, high = (at, min(len(text), at + width)) if ahead else (max(0, at - width), at)
        words = [w for w in _SPLIT.split(text[low:high]) if w]
        # the outermost word may go on beyond the part looked at
        cut = high < len(text) if ahead else low > 0
        if len(words) > 2 or not cut:
            return words[:2] if ahead else words[-2:]
        width *= 4


def _short(text: str) -> str:
    return text if len(text) <= LONG else hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span; words lower-cased, outer punctuation off, digits as #."""
    clean = lambda w: _short(re.sub(r"[0-9]", "#", _EDGE.sub("", w.lower())))
    before = [clean(w) for w in _near_words(text, start, False)]
    after = [clean(w) for w in _near_words(text, end, True)]
    out = []
    if len(before) == 2:
        out.append("<< " + " ".join(before))
    if before and after:
        out.append(f"<> {before[-1]} {after[0]}")
    if len(after) == 2:
        out.append(">> " + " ".join(after))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_SPAN_DDL = "array<struct<start:bigint,kind:int,end:bigint>>"
_SEEN = pa.schema([("kind", pa.int32()), ("seed", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
_SEEN_DDL = "kind int, seed boolean, value string, patterns array<string>"
_PLACE = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string())])
_PLACE_DDL = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _others(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    return other_identifiers(text, spans) if _DIGIT.search(text) or "@" in text or "(at)" in text or "[at]" in text else []


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every base entity (a seed) and every other identifier-like string, with its patterns."""
    for block in blocks(batches, "text", BLOCK_BYTES):
        out: list[tuple] = []
        for text in block.column("text"):
            text = text.as_py()
            spans = base_spans(text)
            for group, seed in ((spans, True), (_others(text, spans), False)):
                for s, k, e in group:
                    out.append((k, seed, value(text, s, e), patterns(text, s, e)))
                    if len(out) == 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SEEN.types, strict=True)], schema=_SEEN)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SEEN.types, strict=True)], schema=_SEEN)


def _all_spans(text: str, known: set) -> tuple[list, list]:
    """Base spans, and base and accepted ones together."""
    spans = base_spans(text)
    added = [(s, k, e) for s, k, e in _others(text, spans) if k >= 0 and (value(text, s, e), k) in known] if known else []
    return spans, sorted([*spans, *added]) if added else spans


def _structs(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"start": s, "kind": k, "end": e} for s, k, e in spans]


def _replaced(block: pa.RecordBatch, column: str, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``block`` without ``column`` and with the ``new`` ones at the end."""
    cols = {n: c for n, c in zip(block.schema.names, block.columns, strict=True) if n != column} | new
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _marker(shared):
    """Adds base and all spans, given the broadcast set of accepted (value, kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "find_text", BLOCK_BYTES):
            base, found = [], []
            for text in block.column("find_text"):
                a, b = _all_spans(text.as_py(), shared.value)
                base.append(_structs(a))
                found.append(_structs(b))
            yield _replaced(block, "find_text", {"base": pa.array(base, pa.list_(_SPAN)), "found": pa.array(found, pa.list_(_SPAN))})

    return run


def _placer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds base spans and the other identifier-like strings with their places and values, for a join with the accepted ones."""
    for block in blocks(batches, "find_text", BLOCK_BYTES):
        base, other = [], []
        for text in block.column("find_text"):
            text = text.as_py()
            spans = base_spans(text)
            base.append(_structs(spans))
            other.append([{"start": s, "kind": k, "end": e, "value": value(text, s, e)} for s, k, e in _others(text, spans) if k >= 0])
        yield _replaced(block, "find_text", {"base": pa.array(base, pa.list_(_SPAN)), "other": pa.array(other, pa.list_(_PLACE))})


def _masker(shared):
    """Masks the column text in place, given the broadcast set of accepted (value, kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            out = []
            for text in block.column("text"):
                text = text.as_py()
                spans = [] if text is None else _all_spans(text, shared.value)[1]
                out.append(_mask(text, spans) if spans else text)
            yield _replaced(block, "text", {"text": pa.array(out, pa.string())})

    return run


def value(text: str, start: int, end: int) -> str:
    """An instance of the graph: the string in lower case; long ones by their hash."""
    return _short(text[start:end].lower())


def discover(seen: DataFrame, rounds: int = MOST_ROUNDS, accept: float = ACCEPT) -> DataFrame:
    """Accepted unseen instances: (value, kind, score).

    ``seen``: one row per occurrence with kind, seed, value, patterns.  Every count is of distinct
    instances, so a copied passage adds nothing, and every step is a grouped sum with a map-side
    combine.  Scores only grow from round to round, so the rounds end when one accepts no more instances than the one
    before; ``rounds`` is their bound, and reaching it is an error.
    """
    edges = seen.select("value", "kind", "seed", F.explode(F.array_distinct("patterns")).alias("pattern"))
    edges = staged(edges.groupBy("value", "pattern").agg(F.max("seed").alias("seed"), F.max("kind").alias("kind")), "pii-edges")
    seeds = edges.where("seed").select("value", "kind").groupBy("value").agg(F.max("kind").alias("kind")).withColumn("score", F.lit(1.0))
    seeds = known = staged(seeds, "pii-seeds")
    spread = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("held"))
    open_ = edges.where("not seed and kind >= 0").select("value", "kind", "pattern")
    found = -1
    for _ in range(rounds):
        scored = edges.select("value", "pattern").join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        trust = scored.where(F.col("mass") >= LEAST_SEEDS).join(spread, "pattern").withColumn("confidence", F.col("mass") / (F.col("held") + SMOOTH))
        trust = trust.where(F.col("confidence") >= LEAST_CONFIDENCE).select("pattern", "kind", "confidence")
        wrong = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        new = open_.join(trust, ["pattern", "kind"]).groupBy("value", "kind").agg((1 - wrong).alias("score")).where(F.col("score") >= accept)
        accepted = staged(new, "pii-round")
        before, found = found, accepted.count()
        if found in (0, before):
            return accepted
        known = seeds.unionByName(accepted.join(seeds, "value", "left_anti"))  # a score can be 1.0 too: every value once
    raise RuntimeError(f"still accepting new instances after {rounds} rounds")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def _equals(n: int):
    return lambda x: x == n


def _accepted(docs: DataFrame, rounds: int, accept: float):
    """The accepted instances as a table and, where their measured size allows, as a broadcast set of (value, kind)."""
    text_batches(docs.sparkSession)
    seen = staged(docs.select(text_or_empty().alias("text")).mapInArrow(_occurrences, _SEEN_DDL), "pii-seen")
    accepted = discover(seen, rounds, accept).drop("score")
    n, size = accepted.agg(F.count(F.lit(1)), F.sum(F.octet_length("value"))).first()
    if not can_broadcast(accepted, n, 100 * n + (size or 0)):
        return accepted, None
    return accepted, docs.sparkSession.sparkContext.broadcast({(r["value"], r["kind"]) for r in accepted.collect()})


def find_pii(docs: DataFrame, carry: list[str] | None = None, rounds: int = MOST_ROUNDS, accept: float = ACCEPT) -> DataFrame:
    """Every row of ``docs`` with the columns ``carry`` (default: all) and: n_email, n_ip, n_card, n_phone, base_sha256, spans, pii_spans.

    The four counts and base_sha256 are of the base patterns; ``spans`` lists base and added spans
    as kind:start:end (code points, end exclusive) by start, then kind; ``pii_spans`` holds the same
    as structs (start, kind number, end).  Null texts are empty.  Each row is
    marked on its own, so repeated or null doc_ids are fine.  Empty tables give no rows; columns
    of ``docs`` named like an added column are replaced by it.
    """
    counts = [f"n_{k}" for k in KINDS]
    added = [*counts, "base_sha256", "spans", "pii_spans"]
    carry = [c for c in (carry if carry is not None else docs.columns) if c not in added]
    doc = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).alias("none"))
    plain = docs.select(doc.alias("doc"), text_or_empty().alias("find_text"))
    accepted, known = _accepted(docs, rounds, accept)
    if known is not None:
        kept = plain.drop("find_text").schema.simpleString()[len("struct<"):-1]
        out = plain.mapInArrow(_marker(known), f"{kept},base:{_SPAN_DDL},found:{_SPAN_DDL}")
    else:
        rows = plain.withColumn("row", F.monotonically_increasing_id())
        kept = rows.drop("find_text").schema.simpleString()[len("struct<"):-1]
        rows = staged(rows.mapInArrow(_placer, f"{kept},base:{_SPAN_DDL},other:{_PLACE_DDL}"), "pii-rows")
        hits = rows.select("row", F.explode("other").alias("x")).select("row", "x.*").join(accepted, ["value", "kind"])
        more = hits.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
        both = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPAN_DDL))))
        out = rows.join(more, "row", "left").select("doc", "base", both.alias("found"))
    of_kind = F.transform("base", lambda s: s["kind"])
    n = [F.size(F.filter(of_kind, _equals(i))).cast("long").alias(c) for i, c in enumerate(counts)]
    out = out.select("doc", *n, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), F.col("found").alias("pii_spans"))
    return out.select("doc.*", *counts, "base_sha256", _joined(F.col("pii_spans")).alias("spans"), "pii_spans")


def _mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _mask_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", BLOCK_BYTES):
        pairs = zip(block.column("text").to_pylist(), block.column("pii_spans").to_pylist(), strict=True)
        out = [_mask(t, [(x["start"], x["kind"], x["end"]) for x in spans]) if t is not None and spans else t for t, spans in pairs]
        yield _replaced(_replaced(block, "pii_spans", {}), "text", {"text": pa.array(out, pa.string())})


def redact(docs: DataFrame, rounds: int = MOST_ROUNDS, accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets; n_chars, where present, follows.

    Overlapping spans become one mask, named after the first.  Null texts stay null.
    """
    others = [c for c in docs.columns if c != "text"]
    renamed = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]
    plain = docs.select(*renamed, F.col("text").cast("string").alias("text"))
    ddl = plain.schema.simpleString()[len("struct<"):-1]
    _, known = _accepted(docs, rounds, accept)
    if known is not None:
        masked = plain.mapInArrow(_masker(known), ddl)
    else:
        masked = find_pii(plain, rounds=rounds, accept=accept).select(*plain.columns, "pii_spans").mapInArrow(_mask_found, ddl)
    out = masked.select(*[F.col("text") if c == "text" else F.col(f"c{others.index(c)}").alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        now = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(now))
    return out.select(*docs.columns)
