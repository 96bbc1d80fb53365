"""Edge semantics of the report metrics."""

from decimal import Decimal

from pyspark.sql import functions as F

from starmart.operators.metrics import change_vs_previous, pivot_change, rank_by, share_of_total, stack_base, top_k


def test_change_uses_previous_row_not_previous_period(spark):
    df = spark.createDataFrame([("SP", 2022, 100), ("SP", 2024, 150), ("RJ", 2022, 0), ("RJ", 2023, 10)], "uf string, ano int, v long")
    pct = {(r["uf"], r["ano"]): r["chg"] for r in change_vs_previous(df, ["uf"], ["ano"], "v", "chg", kind="pct").collect()}
    assert pct[("SP", 2022)] is None
    assert pct[("SP", 2024)] == Decimal("50.00")  # 2023 is missing: compared with 2022
    assert pct[("RJ", 2023)] is None  # previous value 0 -> NULL, not an error
    ab = {(r["uf"], r["ano"]): r["chg"] for r in change_vs_previous(df, ["uf"], ["ano"], "v", "chg").collect()}
    assert ab[("SP", 2024)] == 50 and ab[("RJ", 2023)] == 10


def test_share_rounds_exactly_and_sums(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, n long")
    got = {r["k"]: r["pct_do_total"] for r in share_of_total(df, "n").collect()}
    assert got == {"a": Decimal("33.33"), "b": Decimal("33.33"), "c": Decimal("33.33")}


def test_pivot_missing_cell_and_change(spark):
    df = spark.createDataFrame([("N", 2022, 10), ("N", 2024, 15), ("S", 2024, 5)], "r string, ano int, v long")
    rows = {r["r"]: r for r in pivot_change(df, "r", "ano", [2022, 2023, 2024], "v", 2022, 2024, out="var", scale=1).collect()}
    assert rows["N"]["2023"] is None and rows["N"]["var"] == Decimal("50.0")
    assert rows["S"]["2022"] is None and rows["S"]["var"] is None


def test_stack_base_order_and_unlisted(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "z", 9), (1, "c", 4)], "y int, k string, v long")
    got = {r["k"]: r["base"] for r in stack_base(df, ["y"], "k", ["a", "b", "c"], "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 3}


def test_top_k_and_rank_break_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 7), ("d", 1)], "k string, n long")
    assert [r["k"] for r in top_k(df, [F.col("n").desc(), "k"], 3).collect()] == ["c", "a", "b"]
    ranked = [(r["ranking"], r["k"]) for r in rank_by(df, [F.col("n").desc(), "k"], 2).orderBy("ranking").collect()]
    assert ranked == [(1, "c"), (2, "a")]
