import duckdb
import pytest

from starmart.llm.quotes import _previous, link_quotations, reply_trees, with_quotes
from starmart.llm.quotes_sql import LINKED

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows):
    return {(r.conv_id, r.turn, r.role): r for r in link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}


THREAD = [
    (1, 0, "a", "Shall we meet on Monday?\nOr on Tuesday?\n\nBring the maps."),
    (1, 1, "b", "> Shall we  meet on MONDAY?\n> Or on Tuesday?\n>\n> Bring the maps.\nMonday suits me."),
    (1, 2, "c", ">> Shall we meet on Monday?\n> Monday suits me.\n\nMe too.\n"),
    (1, 3, "d", "> Bring the maps.\nWhich maps?"),
    (1, 4, "e", "> nobody wrote this\nHm."),
    (1, 5, "f", "No quote here."),
    (2, 0, "a", "> Bring the maps.\nA line of another conversation."),
    (2, 7, "b", None),
    (2, None, "n", "no turn"),
    (None, 3, "x", "> deep\n> > > deeper\n"),
    (None, 3, "x2", ""),
    (3, 1, "a", "same"), (3, 1, "b", "same"), (3, 2, "c", "  >same"), (3, 9, "d", "no > quote"),
]


def test_threads(spark):
    got = run(spark, THREAD)
    r = got[1, 1, "b"]
    assert (r.text, r.parent_turn, r.root_turn, r.depth, r.n_quotes, r.n_linked, r.max_level) == ("Monday suits me.", 0, 0, 1, 1, 1, 1)
    r = got[1, 2, "c"]
    assert (r.text, r.parent_turn, r.depth, r.n_quotes, r.n_linked, r.max_level) == ("Me too.", 1, 2, 2, 2, 2)
    assert (got[1, 3, "d"].parent_turn, got[1, 3, "d"].depth) == (0, 1)  # a paragraph of message 0
    assert (got[1, 4, "e"].parent_turn, got[1, 4, "e"].n_linked) == (3, 0)  # unknown passage: the message before
    assert (got[1, 5, "f"].parent_turn, got[1, 5, "f"].depth) == (4, 3)
    assert (got[2, 0, "a"].parent_turn, got[2, 0, "a"].root_turn, got[2, 7, "b"].parent_turn) == (None, None, 0)
    assert (got[2, None, "n"].depth, got[2, 0, "a"].depth) == (0, 1)
    assert (got[None, 3, "x"].text, got[None, 3, "x"].n_quotes, got[None, 3, "x"].max_level) == ("", 2, 3)
    assert (got[3, 1, "a"].parent_turn, got[3, 2, "c"].parent_turn, got[3, 2, "c"].text, got[3, 9, "d"].text) == (None, 1, "", "no > quote")
    assert len(got) == len(THREAD)


def test_equals_the_sql(spark):
    import pandas as pd

    conversations = pd.DataFrame(THREAD, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841  read by name
    want = duckdb.sql(LINKED).fetchall()
    names = ["conv_id", "turn", "role", "text", "parent_turn", "root_turn", "depth", "n_quotes", "n_linked", "max_level"]
    got = [tuple(r[c] for c in names) for r in run(spark, THREAD).values()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("gap", [1, 700, 5000])
def test_turn_before_across_partitions(spark, gap):
    turns = {"a": [i * gap for i in range(50)] + [-5, -3000], "b": [7], "c": [i * gap for i in range(20)]}
    nodes = spark.createDataFrame([(c, t) for c, ts in turns.items() for t in ts], "ck string, tk long").repartition(5)
    got = {(r.ck, r.tk): r.before for r in _previous(nodes).collect()}
    want = {}
    for c, ts in turns.items():
        ts.sort()
        want |= {(c, t): before for t, before in zip(ts, [None, *ts[:-1]], strict=True)}
    assert got == want


def test_long_chain_and_branches(spark):
    rows = [("a", i, i - 1 if i else None) for i in range(300)] + [("b", i, i // 2 if i > 1 else None) for i in range(1, 200)]
    got = {(r.ck, r.tk): (r.root, r.depth) for r in reply_trees(spark.createDataFrame(rows, "ck string, tk long, parent long")).collect()}
    assert all(got["a", i] == (0, i) for i in range(300))
    assert all(got["b", i] == (1, i.bit_length() - 1) for i in range(1, 200))


def test_no_python_in_the_plan(spark):
    df = link_quotations(spark.createDataFrame(THREAD, SCHEMA))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas"))


def test_empty_table_and_other_columns(spark):
    assert link_quotations(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame(THREAD, SCHEMA).selectExpr("*", "1 as row", "2 as ck", "3 as level", "4 as hash")
    assert link_quotations(df).count() == len(THREAD)


def test_rendering_of_awkward_rows(spark):
    rows = [(1, 0, "a", None), (1, 1, "b", "x"), (1, 1, "c", "w"), (1, 2, "d", ""), (None, 0, "e", "y"), (None, 1, "f", "z"), (1, None, "g", "t")]
    got = {r.role: r.text for r in with_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 7 and got["f"] == "z" and got["g"] == "t" and got["b"].endswith("x")
    assert with_quotes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_and_blank_conversations_are_two(spark):
    rows = [(None, 0, "a", "first words here"), ("", 1, "b", "> first words here\nanswer"), (None, 2, "c", "> first words here\nmine"), ("", 0, "d", "other")]
    got = {r.role: r for r in link_quotations(spark.createDataFrame(rows, SCHEMA.replace("conv_id long", "conv_id string"))).collect()}
    assert (got["b"].n_quotes, got["b"].n_linked) == (1, 0) and (got["c"].n_linked, got["c"].root_turn) == (1, 0)
