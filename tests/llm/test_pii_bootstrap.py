import hashlib
import random
import re

import pytest

from starmart.llm.pii_bootstrap import KINDS, base_spans, discover, find_pii, luhn, other_identifiers, patterns, redact, value
from cases import AWKWARD, SCHEMA, docs

PLAIN = {  # the contract's patterns as they stand
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                  "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]  # noqa: B023
            if ok():
                out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(0)
    letters = "ab@.-_%+ 0123456789()\né1"
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == plain_spans(text), text
    for text in ("4111 1111-1111 1111", "+1 (456) 555-2186", "é a.b+c@x-y.co.uk_z@q.r", "1.2.3.4.5.6.7.8 256.1.1.1", "a@b@c.d", "0001.2.3.255"):
        assert base_spans(text) == plain_spans(text)


def test_long_runs_stay_linear():
    assert base_spans("1" * 300_000) == [] and base_spans("a" * 300_000 + "@") == [] and base_spans("+1" + " " * 300_000) == []


def test_documents(spark):
    rows = [*AWKWARD, (60, "Write x.y@mail.example.org or call +44 20 7946 0958; host 10.0.0.1"), (60, "\U0001F600 card 4111111111111111")]
    got = sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in find_pii(docs(spark, rows)).collect())
    want = []
    for i, t in rows:
        spans = plain_spans(t or "")
        n = [sum(k == j for _, k, _ in spans) for j in range(4)]
        want.append((i or 0, *n, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans)))
    assert got == sorted(want)


def planted(n):
    rows = [(i, f"note {i}: please send mail to user{i}@host{i % 7}.example and wait w{i}") for i in range(n)]
    rows += [(i, f"call w{i} my phone number +1 (456) 555-{2000 + i} after dark") for i in range(n, 2 * n)]
    rows += [(900, "then please send mail to root@localhost and wait now"), (901, "my phone number (456) 555-9999 after dark"), (902, "we met user@somewhere by the year 1999 or 2001-2003")]
    return rows


def test_unseen_identifiers_are_found_by_their_context(spark):
    rows = planted(30)
    got = {r.doc_id: r for r in find_pii(docs(spark, rows)).collect()}
    text = dict(rows)
    name = lambda i: [text[i][s.start:s.end] for s in got[i].pii_spans]
    assert name(900) == ["root@localhost"] and got[900].n_email == 0 and got[900].spans.startswith("email:")
    assert name(901) == ["(456) 555-9999"]
    assert name(902) == []  # same shapes, context unknown
    assert all(got[i].spans == joined(plain_spans(t)) for i, t in rows if i < 900)


def test_instances_of_many_trusted_patterns_count_once(spark):
    trusted = [f"t{i}" for i in range(14)]
    rows = [(0, True, f"s{i}@x.yz", trusted) for i in range(60)]  # confidence about 0.96: 14 of them leave a score of exactly 1.0
    rows += [(0, False, "a@one", [*trusted, "p"]), (0, False, "b@two", [*trusted, "p"]), (0, False, "c@three", ["p"])]
    seen = spark.createDataFrame(rows, "kind int, seed boolean, value string, patterns array<string>")
    got = {r.value: r.score for r in discover(seen).collect()}
    assert got == {"a@one": 1.0, "b@two": 1.0}  # p holds two known instances, less than LEAST_SEEDS


def test_copies_of_one_text_are_one_instance(spark):
    rows = [(i, "please send mail to a@b.cd and wait") for i in range(50)] + [(99, "please send mail to root@localhost and wait")]
    assert [r.spans for r in find_pii(docs(spark, rows)).where("doc_id = 99").collect()] == [""]


def test_redact(spark):
    rows = [*AWKWARD, *planted(10)[:1], (77, "x 4111111111111111 é y@z.ab +123456789012 end")]
    out = redact(docs(spark, rows).selectExpr("*", "1 as pii_spans", "2 as row"))
    got = {(r.doc_id, r.n_chars): r for r in out.collect()}
    assert out.columns == [*SCHEMA.names, "pii_spans", "row"] and out.count() == len(rows)
    masked = next(r for (i, _), r in got.items() if i == 77)
    assert masked.text == "x [CARD] é [EMAIL] [PHONE] end" and masked.n_chars == len(masked.text)
    assert next(r for (i, _), r in got.items() if i == 3).text is None


def test_empty_table_and_clashing_columns(spark):
    assert find_pii(spark.createDataFrame([], SCHEMA)).count() == 0
    assert find_pii(docs(spark, AWKWARD).selectExpr("*", "1 as seen", "2 as base", "3 as spans", "4 as more", "5 as doc")).count() == len(AWKWARD)


def test_many_accepted_strings_take_the_joined_path(spark):
    rows = [*AWKWARD, *planted(30)]
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    small = sorted(map(repr, find_pii(docs(spark, rows)).select(columns).collect()))
    masked = sorted(map(repr, redact(docs(spark, rows)).collect()))
    spark.conf.set("starmart.broadcast.maxRows", "0")
    try:
        assert sorted(map(repr, find_pii(docs(spark, rows)).select(columns).collect())) == small
        assert sorted(map(repr, redact(docs(spark, rows)).collect())) == masked
    finally:
        spark.conf.unset("starmart.broadcast.maxRows")


def test_rounds_go_on_until_nothing_new_is_found(spark):
    hops, many = 7, 6
    name = lambda k, i: f"h{k}i{i}@x"  # noqa: E731  hop -1 are the seeds
    held: dict = {name(k, i): set() for k in range(-1, hops) for i in range(many)}
    for k in range(hops):  # each of a hop stands in three contexts of its own, which hold all of the hop before
        for i in range(many):
            for p in (f"p{k}.{i}.{r}" for r in range(3)):
                for v in (name(k, i), *(name(k - 1, j) for j in range(many))):
                    held[v].add(p)
    rows = [(0, v.startswith("h-1"), v, sorted(p)) for v, p in held.items()]
    seen = spark.createDataFrame(rows, "kind int, seed boolean, value string, patterns array<string>")
    assert {r.value for r in discover(seen).collect()} == {v for v in held if not v.startswith("h-1")}
    with pytest.raises(RuntimeError, match="rounds"):
        discover(seen, rounds=4)


def test_long_values_are_instances_of_their_own():
    a, b = "x" * 201 + "@one", "x" * 201 + "@two"
    assert value(a, 0, len(a)) != value(b, 0, len(b)) and value("A@b", 0, 3) == "a@b"


def test_context_words_of_any_length():
    long = "q" * 500
    text = f"{long} {long}z 12-34 {long} word"
    at = text.index("12-34")
    assert patterns(text, at, at + 5) == patterns(f"{long} {long}z 12-34 {long} word and more", at, at + 5)
    assert patterns(text, at, at + 5) != patterns(text.replace(f"{long}z", f"{long}y"), at, at + 5)
    assert patterns("a b 1 c d", 4, 5) == ["<< a b", "<> b c", ">> c d"] and patterns("1", 0, 1) == []


def test_identifiers_side_by_side_are_candidates_of_their_own():
    shapes = lambda t: [(t[s:e], k) for s, k, e in other_identifiers(t, [])]
    assert shapes("my phone number (456) 555-9999 2021 after") == [("(456) 555-9999", 3), ("2021", -1)]
    assert shapes("pay 4111 1111 1111 1111 5500 0000 0000 0004 now") == [("4111 1111 1111 1111", 2), ("5500 0000 0000 0004", 2)]
    assert shapes("rows 1 2 3") == [("1 2 3", -1)]
    many = [(i * 2, 0, i * 2 + 1) for i in range(50)] + [(0, 0, 120)]
    assert other_identifiers("@" * 100 + " 123-45 " + "x" * 30, many) == []
