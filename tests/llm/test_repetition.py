import random
import re
from collections import Counter

import numpy as np
import pytest

from starmart.llm.repetition import LINE_SHARE, NGRAM_SHARES, equal_to_earlier, repetition_rules
from cases import AWKWARD, SCHEMA, docs


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\t-\r]+", text)

    def covered(n):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        many = Counter(grams)
        return {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + n)}

    seen, dup, chars, dup_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\t-\r]", line):
            chars += len(line)
            if line in seen:
                dup += 1
                dup_chars += len(line)
            seen.add(line)
    n_repeat, word_chars = len(covered(8)), sum(map(len, words))
    failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
    good = dup_chars / max(chars, 1) <= LINE_SHARE
    for n, most in NGRAM_SHARES.items():
        good &= sum(len(words[i]) for i in covered(n)) / max(word_chars, 1) <= most
    return (len(words), word_chars, sum(text.count(c) for c in "#*$%&|<>"), dup, n_repeat, failed, not failed and good)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    rows = list(AWKWARD)
    for i in range(20, 220):
        vocab = ["ab", "é", "x#", "<q>", "long" * 5, "ß"][: rng.randint(2, 6)] + [f"w{rng.randint(0, 200)}" for _ in range(rng.randint(0, 60))]
        rows.append((i, "".join(rng.choice(vocab) + rng.choice([" ", "\n", "\t", " \n", "\n\n"]) for _ in range(rng.randint(0, 150)))))
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in repetition_rules(docs(spark, rows)).collect()}
    want = {(i, *brute(t)) for i, t in rows}
    assert got == want


def test_empty_and_clashing_columns(spark):
    assert repetition_rules(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repetition_rules(docs(spark, AWKWARD).selectExpr("*", "1 as kept", "2 as n_words")).count() == len(AWKWARD)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [128, 129, 1024, 4096, 16384])
def test_words_and_lines_that_a_polynomial_cannot_tell_apart(spark, n):
    one = thue_morse(n)
    two = one.translate(str.maketrans("ab", "ba"))
    around = " ".join(f"w{i}" for i in range(7))
    rows = [(1, f"{one}\n{two}"), (2, f"{one}\n{two}\n{one}"), (3, f"{around} {one} . {around} {two} end of this text with words enough to be kept by the rule")]
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in repetition_rules(docs(spark, rows)).collect()}
    assert got == {(i, *brute(t)) for i, t in rows}


def test_different_lines_of_one_hash_are_told_apart_by_their_bytes():
    lines = [b"one", b"two", b"one", b"three", b"one"]
    b = np.frombuffer(b"".join(lines), np.uint8)
    ends = np.cumsum([len(x) for x in lines])
    starts = ends - [len(x) for x in lines]
    for doc, want in (([0] * 5, [0, 0, 1, 0, 1]), ([0, 0, 1, 1, 1], [0, 0, 0, 0, 1])):
        doc = np.array(doc)
        assert equal_to_earlier(b, starts, ends, doc, doc.astype(np.uint64)).tolist() == [bool(x) for x in want]
