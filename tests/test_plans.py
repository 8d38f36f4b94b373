from datetime import date

import pytest
from pyspark.sql import functions as F

from finmart.plans import gold, quality
from finmart.plans.models import MARTS, MODELS
from finmart.operators.analytics import exact_median
from finmart.plans.quality import CHECKS, QualityError, TableChecks, Rule, require_passed, row_checks
from finmart.plans.silver import facts_before
from finmart.sources.store import TableStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(MODELS))
def test_plans_stay_in_spark_and_avoid_cross_joins(bank, name):
    plan = plan_of(bank.table(name))
    for operator in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "BatchEvalPython"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(bank):
    plan = bank.table("mart_tx_by_category")._jdf.queryExecution().explainString(
        bank.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(amount), IsNotNull(category)]" in plan
    assert "ReadSchema: struct<amount:double,currency:string,category:string,status:string>" in plan


def test_month_cutoffs_prune_stored_months(bank):
    def partition_filters(df):
        plan = df._jdf.queryExecution().explainString(
            bank.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return [line for line in plan.splitlines() if line.startswith("PartitionFilters") and "transaction_month" in line]

    facts, day = bank.table("fct_transactions"), date(1996, 3, 10)
    early = facts_before(facts, F.lit(day))
    assert partition_filters(early) and "<= 1996-03-01" in partition_filters(early)[0]
    assert 0 < early.count() == facts.where(F.col("transaction_date") < F.lit(day)).count() < facts.count()
    assert partition_filters(bank.table("mart_revenue_monthly_by_segment_usd"))
    assert facts.where(~F.col("transaction_month").eqNullSafe(F.trunc("transaction_date", "month"))).isEmpty()


def test_facts_without_a_date_have_a_partition_of_their_own(spark, tmp_path):
    days = spark.createDataFrame([(date(2000, 1, 31),), (None,), (date(2000, 2, 1),)], "transaction_date date")
    months = days.withColumn("transaction_month", F.trunc("transaction_date", "month"))
    saved = TableStore(spark, str(tmp_path)).save(months, "silver", "facts", ("transaction_month",))
    assert saved.dtypes == months.dtypes and saved.count() == 3
    assert saved.where("transaction_month is null").count() == 1
    assert [r.transaction_date for r in facts_before(saved, F.lit(date(2000, 2, 1))).collect()] == [date(2000, 1, 31)]


def test_keys_are_unique(bank):
    for name, key in (("fct_transactions", "transaction_id"), ("dim_account", "account_id"), ("dim_customer", "customer_id"),
                      ("mart_customer_360", "customer_id")):
        df = bank.table(name)
        assert df.count() == df.select(key).distinct().count()


@pytest.mark.parametrize("mart, share, within", [
    ("mart_credit_score_by_country", "bucket_share_within_country", ["country"]),
    ("mart_loan_dpd", "bucket_share_within_type_currency", ["loan_type", "currency"]),
    ("mart_channel_preference_by_age", "bucket_share_within_age", ["age_bucket"]),
    ("mart_risk_buckets", "bucket_share", []),
])
def test_shares_sum_to_one(bank, mart, share, within):
    totals = bank.table(mart).groupBy(*within).agg(F.sum(share).alias("s"))
    assert totals.where("abs(s - 1) > 1e-9").isEmpty()


def test_running_total_ends_at_the_total(bank):
    trend = bank.table("mart_acquisition_trend")
    assert trend.agg(F.max("cumulative_customers")).first()[0] == trend.agg(F.sum("new_customers")).first()[0]


def test_segments_add_up_to_customers(bank):
    facts = bank.table("mart_revenue_by_segment_usd").agg(F.sum("customer_count")).first()[0]
    assert facts == bank.table("dim_customer").count()


def test_mode_may_be_missing_and_unknown_currency_has_none(spark):
    rows = [("m", "USD", None, 5.0)] * 3 + [("m", "USD", "food", 1.0)] + [("m", None, "food", 2.0)] + [("n", "USD", c, 1.0) for c in "ba"]
    tx = spark.createDataFrame(rows, "merchant string, currency string, category string, amount double").withColumn(
        "status", F.lit("completed"))
    got = {(r.merchant, r.currency): (r.top_category, r.tx_count, r.total_value) for r in gold.mart_top_merchants(tx).collect()}
    assert got == {("m", "USD"): (None, 4, 16.0), ("m", None): (None, 1, 2.0), ("n", "USD"): ("a", 2, 2.0)}


def test_transfer_with_unknown_currency_is_domestic(spark, bank):
    tx = spark.createDataFrame(
        [("A", "C", c, 1.0, "completed", "transfer") for c in ("EUR", "COP", "USD", None)],
        "account_id string, customer_id string, currency string, amount double, status string, transaction_type string")
    accounts = spark.createDataFrame([("A", "USD")], "account_id string, currency string")
    customers = spark.createDataFrame([("C", "CO")], "customer_id string, country string")
    rows = gold.mart_international_transfers(tx, accounts, customers, bank.table("country_currency")).collect()
    assert {r.tx_currency: r.international_tx_count for r in rows} == {"EUR": 1, "COP": 0, "USD": 0, None: 0}


def test_suite_has_every_check(bank):
    counted = [
        sum(len(c.not_null.split()) + len(c.not_null_warn.split()) for t, c in CHECKS.items()),
        sum(len(list(c.all_rules())) for c in CHECKS.values()),
        sum(len(c.values) for c in CHECKS.values()),
        sum(len(c.unique.split()) for c in CHECKS.values()),
        sum(len(c.references) for c in CHECKS.values()),
    ]
    assert counted == [222, 103, 61, 26, 22]
    assert set(MARTS) <= set(CHECKS)


def test_planted_violations_are_found(spark):
    checks = TableChecks(
        unique="k", not_null="k", not_null_warn="v", values={"s": ("a", "b")}, references={"p": ("parent", "id")},
        rules=(Rule("v > 0"), Rule("v < 3", where="s = 'a'", severity="warn")))
    df = spark.createDataFrame(
        [("1", 1, "a", 1), ("1", -1, "b", 2), (None, None, None, None), ("2", 5, "c", 9), ("3", 9, "a", 9)],
        "k string, v int, s string, p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    found = {(r.test, r.column_name, r.severity): r.failures for r in row_checks(df, "t", checks).collect()}
    assert found == {
        ("not_null", "k", "error"): 1, ("not_null", "v", "warn"): 1, ("accepted_values", "s", "error"): 1,
        ("expression_is_true", "v > 0", "error"): 1, ("expression_is_true", "v < 3", "warn"): 1}
    tables = {"t": df, "parent": parent}
    report = quality.key_checks(tables.get, quality.key_checks_of("t", checks))
    assert {(r.table_name, r.test, r.column_name): r.failures for r in report.collect()} == {
        ("t", "unique", "k"): 1, ("t", "relationships", "p"): 2}
    with pytest.raises(QualityError):
        require_passed(report.where("test = 'relationships'"))
    require_passed(row_checks(df, "t", TableChecks(not_null_warn="v")))


def test_key_checks_of_keys_that_share_a_parent(spark):
    """A hot value, NULLs, a parent checked itself, a parent that is not, a column that is key and child."""
    child = spark.createDataFrame(
        [(None, "x", None)] + [(7, "x", "a")] * 500 + [(1, "y", "a"), (2, None, "c"), (2, "z", "c")], "p long, q string, r string")
    tables = {"child": child, "parent": spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int"),
              "names": spark.createDataFrame([("a",), ("b",)], "name string"), "none": child.limit(0)}
    shapes = {
        "child": TableChecks(unique="q", references={"p": ("parent", "id"), "q": ("names", "name"), "r": ("names", "name")}),
        "parent": TableChecks(unique="id", references={"id": ("child", "p")}),
        "none": TableChecks(unique="p", references={"r": ("none", "q")}),
    }
    report = quality.key_checks(tables.get, [c for t, shape in shapes.items() for c in quality.key_checks_of(t, shape)])
    assert {(r.table_name, r.test, r.column_name): r.failures for r in report.collect()} == {
        ("child", "unique", "q"): 1, ("child", "relationships", "p"): 500, ("child", "relationships", "q"): 503,
        ("child", "relationships", "r"): 2, ("parent", "unique", "id"): 1, ("parent", "relationships", "id"): 0,
        ("none", "unique", "p"): 0, ("none", "relationships", "r"): 0}


def test_suite_reads_a_table_at_most_twice(bank):
    """Once for the row checks and once for the key checks of all tables, which share one shuffle by value."""
    names = ["fct_transactions", "fct_loans", "dim_account"]
    plan = plan_of(quality.run_checks(bank.table, names, as_of="DATE '2001-12-31'"))
    assert plan.count("FileScan parquet") == 2 * len(names) + 1  # dim_customer, which they refer to
    assert plan.count("Exchange hashpartitioning") == 2  # by key and value, then one row per key


def test_wanted_checks_ask_for_no_other_table(bank):
    """Uniqueness and references need neither the marts without keys nor copies of thin projections."""
    asked = set()

    def table(name):
        asked.add(name)
        return bank.table(name)

    names = ["stg_loans", "mart_tx_by_dow", "mart_account_mix", "dim_date"]
    quality.run_checks(table, names, ("unique",))
    assert asked == set(quality.tables_read(names, ("unique",))) == {"stg_loans", "dim_date"}
    assert set(quality.tables_read(names, ("relationships",))) == {"stg_loans", "dim_customer", "mart_tx_by_dow", "fx_rates"}
    thin = [name for name, model in MODELS.items() if model.thin]
    assert len(thin) == 7
    for name in thin:
        plan = plan_of(bank.saved(name))
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and f"/{name}" not in plan


def test_domain_values_with_quotes(spark):
    df = spark.createDataFrame([("it's",), ("x",)], "s string")
    assert row_checks(df, "t", TableChecks(values={"s": ("it's",)})).first().failures == 1


def test_build_all_stores_every_layer(spark, tmp_path):
    from finmart.plans.warehouse import DEMO_AS_OF, Warehouse
    from finmart.sources import demo_bank

    documents = demo_bank.bronze_table(spark, "/root/testdata/sf0.001").limit(20).checkpoint()
    warehouse = Warehouse(spark, documents, str(tmp_path), DEMO_AS_OF)
    built = warehouse.build_all()
    assert set(MODELS) <= set(built)
    for name in MARTS:
        assert spark.read.parquet(str(tmp_path / "gold" / name)).count() == built[name].count()


def test_average_balance_counts_balances(spark):
    accounts = spark.createDataFrame([(None, "C1", 90.0), ("A2", "C1", 10.0)], "account_id string, customer_id string, balance double").selectExpr(
        "*", "'active' status", "'savings' account_type", "'USD' currency")
    customers = spark.createDataFrame([("C1", "CO")], "customer_id string, country string")
    assert gold.mart_account_mix(accounts, customers).first().avg_balance == 50.0


def test_building_a_plan_runs_no_job(spark, bank):
    facts, loans = bank.table("fct_transactions"), bank.table("fct_loans")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    gold.mart_tx_by_channel(facts)
    exact_median(loans, "outstanding_balance")
    assert set(tracker.getJobIdsForGroup(None)) == before
