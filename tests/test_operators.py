import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from finmart.operators import dedup, flatten
from finmart.operators.analytics import exact_median, ordinal, percent_of, share_of, to_usd
from finmart.sources import bronze

MOMENT = datetime(2024, 1, 1)


def bronze_rows(spark, documents, moment=MOMENT):
    df = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "data string")
    return bronze.stamp_batch(df.coalesce(1), "load", "file", moment)


def account(key, **fields):
    return {"account_id": key, "balance": 1.5, **fields}


def test_parse_keeps_siblings_of_a_bad_field(spark):
    docs = [{"customer_id": "C1", "lat": 3.0, "accounts": [account("A1", balance="12.5", branch_code="B")]},
            {"customer_id": "C2", "lat": "4", "accounts": [account("A2", balance=None)]}, "{not json"]
    rows = flatten.parse_documents(bronze_rows(spark, docs)).orderBy("bronze_id").collect()
    assert [(r.customer_id, r.lat) for r in rows] == [("C1", "3.0"), ("C2", "4"), (None, None)]
    assert (rows[0].accounts[0].balance, rows[0].accounts[0].branch_code) == (None, "B")


def test_flatten_drops_parents_without_items(spark):
    docs = [{"customer_id": "C1", "accounts": [account(" A1 ", status=" "), account("A2", opened_date=" 2024-01-01 ")]},
            {"customer_id": "C2", "accounts": []}, {"customer_id": "C3", "accounts": None}, {"customer_id": "C4"}]
    flat = flatten.flatten_array(flatten.parse_documents(bronze_rows(spark, docs)), flatten.ACCOUNTS)
    assert [(r.customer_id, r.account_id, r.status, r.opened_date) for r in flat.orderBy("account_id").collect()] == [
        ("C1", "A1", None, None), ("C1", "A2", None, " 2024-01-01 ")]


def test_recover_money(spark):
    docs = [{"customer_id": "C1", "transactions": [
        {"transaction_id": f"T{i}", "amount": a} for i, a in enumerate([5.25, "$6.5", "1.234,50", "junk", None])]}]
    parsed = flatten.parse_documents(bronze_rows(spark, docs), recover_money=True)
    amounts = flatten.flatten_array(parsed, flatten.TRANSACTIONS).orderBy("transaction_id")
    assert [r.amount for r in amounts.collect()] == [5.25, 6.5, 1234.5, None, None]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedup_does_not_depend_on_input_order(spark, seed):
    rows = [("k1", datetime(2024, 1, d), b, v) for d, b, v in
            [(1, 9, "old"), (2, 3, "low id"), (2, 4, "zz"), (2, 4, "aa"), (2, 4, None)]]
    rows += [(None, MOMENT, 1, "x"), (None, MOMENT, 2, "y")]
    df = spark.createDataFrame(rows, "k string, load_timestamp timestamp, bronze_id long, v string")
    kept = dedup.keep_latest(df.repartition(5, F.rand(seed)), "k").orderBy("k").collect()
    assert [(r.k, r.v) for r in kept] == [(None, "y"), ("k1", "aa")]


def test_latest_documents_ignores_missing_ids(spark):
    docs = [{"customer_id": "C1", "status": "a"}, {"customer_id": "C1", "status": "b"}, {"status": "c"}]
    kept = dedup.latest_documents(flatten.parse_documents(bronze_rows(spark, docs))).collect()
    assert [(r.customer_id, r.status) for r in kept] == [("C1", "b")]


def test_most_complete_then_most_recent(spark):
    rows = [("a", "2024-01-01", None), ("a", "2023-01-01", "x"), ("b", "2023-01-01", "x"), ("b", "2024-01-01", "y")]
    df = spark.createDataFrame(rows, "k string, seen string, v string")
    assert [(r.k, r.v) for r in dedup.most_complete(df, "k", "seen").orderBy("k").collect()] == [("a", "x"), ("b", "y")]


def test_key_cut_happens_before_the_shuffle(spark, bank):
    plan = dedup.keep_latest(
        flatten.flatten_array(bank.table("documents"), flatten.LOANS), "loan_id"
    )._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("nulls_last", [False, True])
def test_ordinal_matches_brute_force(spark, nulls_last):
    rows = [("usd" if i % 3 else None, None if i % 17 == 0 else (i * 7919 % 101) / 8 - 4, f"merchant{i:03d}" if i % 5 else f"{i:03d}")
            for i in range(300)]
    df = spark.createDataFrame(rows, "ccy string, v double, name string").repartition(6)
    got = {r["name"]: r["rank"] for r in ordinal(df, "ccy", "v", "name", "rank", nulls_last).collect()}
    want = {}
    for ccy in ("usd", None):
        group = sorted((r for r in rows if r[0] == ccy), key=lambda r: (
            (r[1] is None) == nulls_last, 0 if r[1] is None else -r[1], r[2]))
        want.update({r[2]: i + 1 for i, r in enumerate(group)})
    assert got == want


def test_ordinal_with_ties_in_a_third_of_the_rows_scans_once(spark, tmp_path):
    spark.range(9000).selectExpr("id", "'all' AS g", "IF(id % 3 = 0, 5.0D, CAST(id * 7919 % 1013 AS DOUBLE)) AS v").repartition(7).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    ranked = ordinal(df, "g", "v", "id", "rank")
    rows = [(r.v, r.id, r["rank"]) for r in ranked.collect()]
    assert [r[2] for r in sorted(rows, key=lambda r: (-r[0], r[1]))] == list(range(1, 9001))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "parquet" not in plan and final.count("Exchange hashpartitioning") == 1


def test_quantiles_of_groups_match_brute_force(spark, monkeypatch):
    import numpy as np

    from finmart.operators import analytics

    monkeypatch.setattr(analytics, "SKETCH", 50)  # groups on both sides of it
    random = np.random.default_rng(4)
    groups = {"one": [3.5], "few": [1.0, 2.0, 7.0], "ties": [1.0] * 400 + [2.0] * 200 + list(map(float, range(300))),
              "many": random.normal(size=3000).tolist(), "odd": random.integers(-9, 9, 333).astype(float).tolist()}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]] + [("none", None)], "g string, v double").repartition(5)
    fractions = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = {(r.g, r.fraction): r.quantile for r in analytics.exact_quantiles(df, "g", "v", fractions).collect()}
    assert found == {(g, q): pytest.approx(float(np.quantile(vs, q)), abs=1e-12) for g, vs in groups.items() for q in fractions}


def test_median_takes_two_scans_and_no_nested_loop(spark, tmp_path):
    spark.range(50_000).selectExpr("CAST(hash(id) AS DOUBLE) AS v", "id AS other").write.parquet(str(tmp_path / "t"))
    middle = exact_median(spark.read.parquet(str(tmp_path / "t")), "v")
    values = sorted(r.v for r in spark.read.parquet(str(tmp_path / "t")).collect())
    assert middle.first()[0] == (values[24_999] + values[25_000]) / 2
    plan = middle._jdf.queryExecution().explainString(middle._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "other" not in plan


@pytest.mark.parametrize("values", [
    [float(i * i % 9973) - 4000 for i in range(5000)], [1.0] * 3000 + [2.0] * 10 + [float(i) for i in range(2000)],
    [1 + i * 1e-12 for i in range(101)], [4.0], [1.0, 2.0], [-3.0, 0.0, -0.0, 7.5]])
def test_exact_median_matches_brute_force(spark, values):
    import statistics

    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
    assert exact_median(df, "v").first()[0] == statistics.median(values)


def test_newest_rate_counts_once(spark):
    rates = spark.createDataFrame([("EUR", 1.0, "2024-01-01"), ("EUR", 2.0, "2025-01-01"), ("EUR", 9.0, "2026-01-01")],
                                  "currency string, rate_to_usd double, d string").selectExpr(
        "currency", "rate_to_usd", "cast(d as date) as_of_date")
    df = spark.createDataFrame([("EUR",), ("XXX",), (None,)], "c string")
    assert {tuple(r) for r in to_usd(df, rates, "c").collect()} == {("EUR", 9.0), ("XXX", None), (None, None)}
    assert to_usd(df, rates, "c", as_of=date(2025, 6, 1)).where("c = 'EUR'").first()[1] == 2.0


def test_median_of_nothing_is_null(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v").first()[0] is None


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, n long")
    rows = df.select("g", share_of(F.col("n"), "g").alias("s"), percent_of(F.col("n")).alias("p")).collect()
    assert sorted((r.g, r.s, r.p) for r in rows) == [("a", 0.25, 11.11), ("a", 0.75, 33.33), ("b", 1.0, 55.56)]


def test_stage_array_counts_stored_rows(spark, bank, tmp_path):
    def save(df):
        df.write.parquet(str(tmp_path / "x"))
        return spark.read.parquet(str(tmp_path / "x"))

    def save_after_a_lost_attempt(df):
        df.write.parquet(str(tmp_path / "lost"))
        df.write.parquet(str(tmp_path / "y"))
        return spark.read.parquet(str(tmp_path / "y"))

    saved, counters = flatten.stage_array(bank.table("documents"), flatten.TRANSACTIONS, save)
    assert counters["documents_read"] == bank.table("bronze").count()
    assert counters["after_dedup"] == saved.count() == saved.select("transaction_id").distinct().count()
    assert counters["dropped"] == counters["after_explode"] - counters["after_dedup"] > 0
    assert flatten.stage_array(bank.table("documents"), flatten.TRANSACTIONS, save_after_a_lost_attempt)[1] == counters


def test_stage_array_of_no_documents(spark, bank, tmp_path):
    def save(df):
        df.write.parquet(str(tmp_path / "none"))
        return spark.read.parquet(str(tmp_path / "none"))

    _, counters = flatten.stage_array(bank.table("documents").where("false"), flatten.LOANS, save)
    assert set(counters.values()) == {0}
