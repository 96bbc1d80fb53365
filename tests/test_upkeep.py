"""Reconciliation, rule lookup, rejects, repeatable loads, keys that stay, bucketed tables."""

import re
import time

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from starmart.catalog import star_for
from starmart.operators.keys import extend_keys
from starmart.operators.prefix import longest_prefix
from starmart.operators.reconcile import classes, differences, full_outer, place_in_key, reconcile
from starmart.plans import upkeep as U
from starmart.plans.append import append_to_star
from starmart.plans.prepare import normalize
from starmart.plans.routing import route
from starmart.plans.star import DIMENSIONS, build_star, write_star
from starmart.schemas import RAW_COLUMNS
from starmart.sources.csv import read_raw
from starmart.sources.ingest import read_once
from starmart.sources.manifest import append_new_files, loaded_rows, manifest
from starmart.sources.sinks import write_with_totals
from starmart.sources.tables import landing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- reconciliation --------------------------------------------------------------------------------------------------
L = [("a", 1, "x"), ("b", 2, None), (None, 3, "n"), ("d", 4, "l"), ("r", 1, "p"), ("r", 1, "p"), ("r", 2, "q")]
R = [("a", 1, "x"), ("b", 2, "y"), (None, 3, "n"), ("e", 5, "r"), ("r", 2, "q"), ("r", 1, "p"), (None, 9, None)]


def pair(spark, left=L, right=R):
    return [spark.createDataFrame(x, "k string, n int, t string") for x in (left, right)]


@pytest.mark.parametrize("hot", [1, 2, 100])
def test_reconcile_classes_and_columns(spark, hot):
    got = reconcile(*pair(spark), ["k"], ["n", "t"], hot_rows=hot).select("k", "place", "class", F.array_join("differs", ",")).collect()
    want = [
        ("a", 1, "equal", ""), ("b", 1, "different", "t"), (None, 1, "equal", ""), (None, 2, "right_only", ""), ("d", 1, "left_only", ""), ("e", 1, "right_only", ""),
        ("r", 1, "equal", ""), ("r", 2, "different", "n,t"), ("r", 3, "left_only", ""),
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_reconcile_summaries_tolerance_and_empty_tables(spark):
    out = reconcile(*pair(spark), ["k"], ["n", "t"])
    assert rows(classes(out)) == [("different", 2), ("equal", 3), ("left_only", 2), ("right_only", 2)]
    assert rows(differences(out, ["n", "t"])) == [("n", 5, 1, 0, 0), ("t", 5, 2, 1, 0)]
    a, b = (spark.createDataFrame([(1, v)], "k int, x double") for v in (1.0, 1.25))
    assert reconcile(a, b, ["k"], ["x"]).first()["class"] == "different"
    assert reconcile(a, b, ["k"], ["x"], {"x": 0.5}).first()["class"] == "equal"
    assert {r["class"] for r in reconcile(a, b.limit(0), ["k"], ["x"]).collect()} == {"left_only"}
    assert reconcile(a.limit(0), b.limit(0), ["k"], ["x"]).count() == 0


def test_full_outer_needs_no_key_text_and_numbers_a_hot_key_alike(spark):
    left = spark.createDataFrame([("a|", "b", 1), (None, None, 2)], "x string, y string, v int")
    right = spark.createDataFrame([("a", "|b", 3), (None, None, 4)], "x string, y string, v int")
    got = {(r["x"], r["y"]): (r["left"], r["right"]) for r in full_outer(left, right, ["x", "y"]).collect()}
    assert got[(None, None)][0]["v"] == 2 and got[(None, None)][1]["v"] == 4 and got[("a", "|b")][0] is None and len(got) == 3
    many = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"), (F.col("id") % 7).alias("v"))
    assert rows(place_in_key(many, ["k"], ["v"], hot_rows=50)) == rows(place_in_key(many, ["k"], ["v"]))


# --- rule lookup -----------------------------------------------------------------------------------------------------
def test_longest_prefix(spark):
    rules = spark.createDataFrame([("218", "Média"), ("218, ii", "Grave"), ("218, ii", "Zzz"), (" 2 ", "Leve"), (None, "x"), ("", "y"), ("219", None)], "p string, g string")
    texts = ["218", " 218, II a", "218, III", "218,I", "2180", "2", "2 b", "219", "", None, "abc"]
    df = spark.createDataFrame([(t, 1) for t in texts], "t string, g int")
    got = {r["t"]: r["sev"] for r in longest_prefix(df, "t", rules, "p", "g", "sev", "none").collect()}
    assert got == {"218": "Média", " 218, II a": "Grave", "218, III": "Média", "218,I": "Média", "2180": "none", "2": "Leve", "2 b": "Leve", "219": "none", "": "none", None: "none", "abc": "none"}
    loose = {r["t"]: r["sev"] for r in longest_prefix(df, "t", rules, "p", "g", "sev", "none", whole_parts=False).collect()}
    assert loose["218, III"] == "Grave" and loose["2180"] == "Média" and loose["219"] == "Leve"
    assert {r["sev"] for r in longest_prefix(df, "t", rules.limit(0), "p", "g", "sev", "none").collect()} == {"none"}
    assert longest_prefix(df.limit(0), "t", rules, "p", "g", "sev").count() == 0


# --- clean rows and rejects ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("rules", ["sql", "frame"])
def test_clean_and_rejects_are_the_input(spark, rules):
    raw = landing(spark, SF_SMALL)
    out = route(raw, rules, domains={"uf_infracao": ["SP", "RJ", "MG"]})
    given = raw.distinct() if rules == "sql" else raw
    assert out.totals["entrada"] == given.count() == out.totals["limpas"] + out.totals["rejeitadas"]
    assert (out.clean.count(), out.rejects.count()) == (out.totals["limpas"], out.totals["rejeitadas"])
    assert out.rejects.select(*RAW_COLUMNS).exceptAll(given).isEmpty()
    counted = {r[0]: r[1] for r in out.rejects.select(F.explode("motivos")).groupBy("col").count().collect()}
    assert counted == {k: v for k, v in out.totals.items() if k not in ("entrada", "limpas", "rejeitadas") and v}
    assert out.clean.filter("excesso_verificado NOT BETWEEN 0 AND 150 OR uf_infracao NOT IN ('SP', 'RJ', 'MG')").isEmpty()
    assert out.clean.columns == normalize(raw, rules).columns
    assert out.clean.exceptAll(normalize(raw, rules)).isEmpty()


def test_no_limits_give_the_plain_clean_step(spark):
    raw = landing(spark, SF_SMALL)
    out = route(raw, limits={})
    assert out.clean.exceptAll(normalize(raw)).isEmpty() and out.clean.count() == normalize(raw).count()
    empty = route(raw.limit(0))
    assert empty.totals["entrada"] == 0 and empty.clean.count() == empty.rejects.count() == 0


# --- files -----------------------------------------------------------------------------------------------------------
def fill(base):
    files = {
        "2023/a.csv": "\t\n  \nNúmero do Auto;Qtd Infrações;Município\nA1;1;\"S \"\"X\"\"; Y\"\nA2;2\nA3;3;x;y\n\t\nA4;;a\"b;c\n".encode(),
        "2023/b.csv": "Município;Outra;Número do Auto\r\nSão João;z;B1\r\n\"\";;\"\"\r\n".encode("latin-1"),
        "2024/c.csv": "N�mero do Auto;Munic�pio\n".encode() + b"C1;A\xe7\xe3o\n",
        "2024/d.csv": b"numero_auto;uf_infracao\n",
        "2024/e.csv": "﻿Número do Auto;UF Infração\nE1; SP \n\\;\"\\\"\n".encode(),
    }
    for name, data in files.items():
        path = base / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(data)
    return str(base)


def test_one_scan_gives_the_rows_of_two(spark, tmp_path):
    base = fill(tmp_path)
    for options in ({}, {"with_malformed": True}, {"recursive": True}):
        where = base if options.get("recursive") else f"{base}/*/*.csv"
        once, twice = read_once(spark, where, **options), read_raw(spark, where, **options)
        assert once.columns == twice.columns
        strip = lambda df: df.withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))
        assert rows(strip(once)) == rows(strip(twice))
    got = {r["numero_auto"]: r for r in read_once(spark, f"{base}/*/*.csv", with_malformed=True).collect()}
    assert got["A1"]["municipio"] == 'S "X"; Y' and got["A1"]["registro_malformado"] is None and got["A1"]["uf_infracao"] is None
    assert got["A2"]["registro_malformado"] == "A2;2" and got["A3"]["registro_malformado"] == "A3;3;x;y" and got["A3"]["municipio"] == "x"
    assert got["B1"]["municipio"] == "São João" and got["C1"]["municipio"] == "A��o" and got["E1"]["uf_infracao"] == " SP "


def test_position_follows_the_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Número do Auto\n" + "".join(f"N{i}\n" for i in range(200)))
    got = read_once(spark, str(tmp_path / "a.csv"), with_position=True).orderBy("source_position").select("numero_auto").collect()
    assert [r[0] for r in got] == [f"N{i}" for i in range(200)]


@pytest.mark.parametrize("read", [read_raw, read_once])
def test_a_header_without_a_known_column_is_an_error(spark, tmp_path, read):
    (tmp_path / "a.csv").write_text("foo;bar\n1;2\n")
    with pytest.raises(ValueError, match="no known column"):
        read(spark, str(tmp_path / "a.csv"))


@pytest.mark.parametrize("read", [read_raw, read_once])
def test_blank_lines_above_the_header(spark, tmp_path, read):
    (tmp_path / "a.csv").write_text("\t\nNúmero do Auto;Qtd Infrações\nA1;1\n")
    got = read(spark, str(tmp_path / "a.csv"), with_source=False).select("numero_auto", "qtd_infracoes").collect()
    assert [tuple(r) for r in got] == [("A1", "1")]


def test_one_scan_of_the_bytes(spark, tmp_path):
    base = fill(tmp_path)
    files = read_once(spark, f"{base}/*/*.csv").inputFiles()
    assert files and all("landed_lines" in f for f in files)


def test_totals_while_writing(spark, tmp_path):
    df = spark.range(100).withColumn("ano", F.when(F.col("id") > 9, 2023 + F.col("id") % 2))
    got = write_with_totals(df, str(tmp_path / "t"), F.col("ano"), [2023, 2024, None, 1999])
    assert got == {None: 10, 2023: 45, 2024: 45, 1999: 0} or got[2023] == 45
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100
    assert write_with_totals(df, str(tmp_path / "u")) == {None: 100}


def test_a_load_is_taken_once(spark, tmp_path):
    base, target = fill(tmp_path / "in") if (tmp_path / "in").mkdir() is None else "", str(tmp_path / "t")
    assert loaded_rows(spark, target).count() == 0
    first = append_new_files(spark, f"{base}/2023/*.csv", target)
    assert (first.files, first.rows) == (2, 6)
    second = append_new_files(spark, f"{base}/*/*.csv", target)
    assert (second.files, second.rows) == (3, 3)
    assert append_new_files(spark, f"{base}/*/*.csv", target).load is None
    assert loaded_rows(spark, target).count() == 9 and manifest(spark, target).count() == 5
    # rows of a load that never reached the manifest are not read
    loaded_rows(spark, target).withColumn("carga", F.lit("broken")).write.mode("append").partitionBy("carga").parquet(f"{target}/rows")
    assert loaded_rows(spark, target).count() == 9
    time.sleep(1.1)
    (tmp_path / "in" / "2024" / "e.csv").write_text("numero_auto\nZ\n")
    with pytest.raises(ValueError, match="changed"):
        append_new_files(spark, f"{base}/*/*.csv", target)


# --- keys, buckets ---------------------------------------------------------------------------------------------------
def test_extend_keys(spark):
    known = spark.createDataFrame([(1, "b", None), (2, None, 5)], "sk long, k string, j int")
    new = spark.createDataFrame([("a", 1), ("b", None), (None, 5), ("a", 1), (None, None)], "k string, j int")
    got = extend_keys(known, new, ["k", "j"], "sk")
    assert got.rows == 2 and rows(got.df) == [(3, "a", 1), (4, None, None)]
    assert rows(extend_keys(known.limit(0), new, ["k", "j"], "sk", first=0).df)[0][0] == 0
    assert extend_keys(known, new.limit(0), ["k", "j"], "sk").rows == 0
    attrs = extend_keys(known.select("sk", "k", F.lit("old").alias("name")), spark.createDataFrame([("b", "x"), ("c", "x"), ("c", "y")], "k string, t string"), ["k"], "sk", attrs_max={"name": "t"})
    assert rows(attrs.df) == [(3, "c", "y")]


@pytest.mark.parametrize("rules", ["sql", "frame"])
def test_append_keeps_keys_and_gives_the_same_fact(spark, tmp_path, rules):
    prepared = normalize(landing(spark, SF_SMALL), rules)
    paths = write_star(build_star(prepared.filter("ano < 2024"), rules), str(tmp_path / rules))
    before = {n: rows(spark.read.parquet(paths[n])) for n in DIMENSIONS}
    grown = append_to_star(spark, paths, prepared.filter("ano = 2024"), rules)
    for n, sk in DIMENSIONS.items():
        now = {r[sk]: tuple(r) for r in grown.table(n).collect()}
        assert all(now[r[0]] == r for r in before[n])
        first = 1 if rules == "sql" else 0
        assert sorted(now) == list(range(first, first + len(now)))
    whole = build_star(prepared, rules)
    natural = lambda s: s.fato_multa.join(s.dim_localizacao, "id_localizacao_sk").join(s.dim_tempo, "id_tempo_sk").join(s.dim_infrator, "id_infrator_sk").join(s.dim_infracao.select("id_infracao_sk", "codigo_infracao"), "id_infracao_sk")
    keyless = lambda s: (lambda d: d.select(*[c for c in sorted(set(d.columns)) if not c.endswith("_sk") and d.columns.count(c) == 1]))(natural(s))
    assert rows(keyless(grown)) == rows(keyless(whole))


def test_bucketed_join_is_not_shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = star_for(spark, SF_SMALL, "sql")
        b = U.bucketed(spark, SF_SMALL, star)
        joined = b.fato_multa.join(b.dim_infrator, "id_infrator_sk")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        plain = star.fato_multa.join(star.dim_infrator, "id_infrator_sk")._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("Exchange", plain)) >= 1
        assert joined.count() == star.fato_multa.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- sizes -----------------------------------------------------------------------------------------------------------
def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reconcile_moves_each_side_once(spark):
    a, b = (spark.range(50).select(F.col("id").cast("string").alias("k"), (F.col("id") % n).alias("v")) for n in (3, 4))
    plan = plan_of(reconcile(a, b, ["k"], ["v"]))
    assert "Join" not in plan and plan.count("Exchange") == 1, plan


def test_known_keys_are_looked_up_by_hash_unless_two_share_one(spark, monkeypatch):
    from starmart.operators import joins

    found = [("a", "x", 1), ("a", None, 2), (None, "a", 3), (None, None, 4), ("b", "x", 5)]
    dim = spark.createDataFrame(found, "k string, l string, sk long")
    df = spark.createDataFrame([(k, l, n) for k, l, sk in found for n in range(sk)], "k string, l string, n int")
    spark.conf.set("starmart.broadcast.maxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for null_safe in (True, False):
            want = rows(joins.lookup_key(df, dim, ["k", "l"], "sk", 5, null_safe))
            assert len(want) == len(df.collect())
            got = joins.lookup_known_keys(df, [(dim, ["k", "l"], "sk", 5, None)], null_safe)
            assert rows(got) == want
            plan = plan_of(got.select("n", "sk"))
            assert "hashpartitioning(__hash_sk" in plan and "coalesce(k#" not in plan and "hashpartitioning(k#" not in plan, plan
            monkeypatch.setattr(joins, "_key_hash", lambda keys, null_safe: F.lit(7).cast("long"))
            assert rows(joins.lookup_known_keys(df, [(dim, ["k", "l"], "sk", 5, None)], null_safe)) == want
            monkeypatch.undo()
    finally:
        spark.conf.unset("starmart.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_tables_are_written_without_a_shuffle(spark, monkeypatch):
    import pyspark.sql.readwriter as W

    from starmart.plans.star import materialize

    plans, limits = [], []
    parquet = W.DataFrameWriter.parquet

    def seen(self, path, *a, **k):
        plans.append(plan_of(self._df))
        limits.append(int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")))
        return parquet(self, path, *a, **k)

    monkeypatch.setattr(W.DataFrameWriter, "parquet", seen)
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("ano"))
        assert rows(materialize(df, "parts", ["ano"], sort_by=["id"])) == rows(df)
        assert "Exchange" not in plans[0] and limits == [8000] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_profile_samples_are_not_gathered_by_group(spark):
    from starmart.operators.profile import _rows_up_to

    df = spark.createDataFrame([(g, f"{i:03d}", "x" * 20) for g in (1, 2, None) for i in range(80)], "g int, k string, t string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table above the threshold
    try:
        near = _rows_up_to(df, ["g"], "k", 50)
        assert near.count() == 150 and "BroadcastHashJoin" in plan_of(near)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("most", ["0", "1000"])
def test_distinct_rows_compares_only_rows_whose_hash_repeats(spark, most):
    from starmart.plans.prepare import distinct_rows

    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), (None, None), ("a", "b"), ("a", "b"), ("", None)], "x string, y string")
    once = spark.createDataFrame([("a", None), (None, "a"), ("", "a")], "x string, y string")
    spark.conf.set("starmart.broadcast.maxRows", most)
    try:
        assert rows(distinct_rows(df)) == rows(df.distinct()) and len(rows(df.distinct())) == 5
        assert rows(distinct_rows(once)) == rows(once) and "Exchange" not in plan_of(distinct_rows(once))
        assert distinct_rows(df.limit(0)).count() == 0
    finally:
        spark.conf.unset("starmart.broadcast.maxRows")


@pytest.fixture
def written_dimension(spark, tmp_path):
    """A written dimension whose files Spark takes for small, while the checked size forbids a broadcast."""
    dim = spark.range(1, 200).select(F.col("id").alias("sk"), F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit("x").alias("l"))
    dim.write.parquet(f"{tmp_path}/dim")
    spark.conf.set("starmart.broadcast.maxRows", "100")
    yield spark.read.parquet(f"{tmp_path}/dim")
    spark.conf.unset("starmart.broadcast.maxRows")


def test_large_written_dimensions_are_not_broadcast_by_file_size(spark, written_dimension):
    from starmart.operators import joins
    from starmart.plans.star import Star

    dim = written_dimension
    rows_ = dim.select("k", "l")
    assert "BroadcastHashJoin" in plan_of(rows_.join(dim.select("sk", F.col("k").alias("j")), F.col("k") == F.col("j")))  # by Spark's estimate
    for on in (["k"], ["k", "l"]):
        got = joins.lookup_known_keys(rows_, [(dim, on, "sk", 199, None)])
        assert "BroadcastHashJoin" not in plan_of(got) and rows(got.select("k", "sk")) == rows(dim.select("k", "sk"))
    star = Star(None, None, None, dim.withColumnRenamed("sk", "id_infrator_sk"), None, rows={"dim_infrator": 199})
    assert "BroadcastHashJoin" not in plan_of(dim.select(F.col("sk").alias("id_infrator_sk")).join(star.dim("dim_infrator", "k"), "id_infrator_sk"))


def test_broadcast_lookups_hold_a_hash_in_place_of_text_keys(spark):
    from starmart.operators import joins

    dim = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "a", 3), (None, None, 4)], "k string, l string, sk long")
    df = dim.drop("sk")
    for null_safe in (True, False):
        got = joins.lookup_known_keys(df, [(dim, ["k", "l"], "sk", 4, 400)], null_safe)
        plan = plan_of(got)
        sent = plan[plan.index("BroadcastExchange") :]
        assert "HashedRelationBroadcastMode(List(input[1, bigint" in sent, plan
        assert rows(got) == rows(joins.lookup_key(df, dim, ["k", "l"], "sk", 4, null_safe))


def test_known_keys_of_a_large_dimension_are_not_broadcast(spark, written_dimension, monkeypatch):
    import pyspark.sql.readwriter as W

    plans, parquet = [], W.DataFrameWriter.parquet
    monkeypatch.setattr(W.DataFrameWriter, "parquet", lambda self, path, *a, **k: plans.append(plan_of(self._df)) or parquet(self, path, *a, **k))
    more = spark.createDataFrame([("k1", "x"), ("new", None), ("new", None), (None, "x")], "k string, l string")
    new = extend_keys(written_dimension, more, ["k", "l"], "sk")
    assert rows(new.df) == [(200, "new", None), (201, None, "x")] and new.rows == 2
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0], plans


def test_reconcile_pairs_repeated_keys_without_an_aggregate(spark):
    def some(n, seed):
        x = spark.range(n).select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(40)).alias("h"), F.pmod(F.xxhash64("id", F.lit(-seed)), F.lit(4)).alias("v"))
        return x.select(F.when(F.col("h") > 2, F.col("h").cast("string")).alias("k"), F.when(F.col("v") > 0, F.col("v")).alias("v"), F.lit("t").alias("t"))

    a, b = some(70, 1), some(90, 2)
    out = reconcile(a, b, ["k"], ["v", "t"])
    assert "Aggregate" not in plan_of(out), plan_of(out)
    want = {}
    for side, df in enumerate((a, b)):
        for k, v, _ in sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1] is None, r[1] or 0)):
            want.setdefault(k, ([], []))[side].append(v)
    at = lambda found, i: found[i] if i < len(found) else "none"
    pairs = [(k, i + 1, at(x, i), at(y, i)) for k, (x, y) in want.items() for i in range(max(len(x), len(y)))]
    got = [(r["k"], r["place"], *("none" if r[s] is None else r[s]["v"] for s in ("left", "right"))) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(pairs, key=repr) and None in want
