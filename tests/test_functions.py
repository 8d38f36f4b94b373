import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from finmart.functions import buckets, dates, numbers, text


def on(function, *rest):
    return lambda name: function(F.col(name), *rest)


def test_blank_to_null_trims_blanks_only(evaluate):
    assert evaluate(on(text.blank_to_null), ["  a ", "   ", "", None, "\ta"]) == ["a", None, None, None, "\ta"]


@pytest.mark.parametrize("function, pairs", [
    (text.normalize_customer_status, {"Activo": "active", " INACTIVO": "inactive", "suspendido": "suspended",
                                      "Cerrado ": "closed", "ACTIVE": "active", "other": "other", None: None}),
    (text.normalize_account_status, {"activo": "active", "Congelado": "frozen", "CERRADO": "closed", "Frozen": "frozen"}),
    (text.normalize_customer_segment, {"Minorista": "retail", "banca_privada": "private_banking", "PYME": "sme",
                                       "Premium": "premium"}),
    (text.normalize_transaction_type, {"deposito": "deposit", "RETIRO": "withdrawal", "transferencia": "transfer",
                                       "pago": "payment", "Reembolso": "refund", "comision": "fee", "FEE": "fee"}),
    (text.normalize_transaction_category, {"": None, "NA": None, " n/a ": None, "NULL": None, "Dining": "dining"}),
    (text.normalize_collateral_type, {"": None, "na": None, "None": "none", "N/A": None, "Vehicle": "vehicle"}),
    (text.normalize_kyc_status, {" Expired": "expired"}),
    (text.currency_code, {" usd ": "USD"}),
    (text.null_token_to_null, {"null": None, " N/A ": None, "None": None, " ": None, "x ": "x "}),
])
def test_text_mappings(evaluate, function, pairs):
    assert evaluate(on(function), list(pairs)) == list(pairs.values())


def test_parse_date_multi_format(evaluate):
    cases = {
        "2026-05-08": date(2026, 5, 8), "20260613": date(2026, 6, 13), "26/04/2026": date(2026, 4, 26),
        "06-13-2024": date(2024, 6, 13), "31/02/2024": None, "20241340": None, "13-13-2024": None, "": None,
        None: None, " 2024-01-01 ": None, "2024-01-01\n": None, "2024/01/01": None, "2024-02-30": None,
    }
    assert evaluate(on(dates.parse_date_multi_format), list(cases)) == list(cases.values())


@pytest.mark.parametrize("earlier, later, months", [
    ("2024-01-31", "2024-02-29", 0), ("2024-02-29", "2024-03-29", 1), ("2024-01-31", "2024-03-01", 1),
    ("2023-12-15", "2024-12-14", 11), ("2023-12-15", "2024-12-15", 12), ("2024-05-05", "2024-05-05", 0),
])
def test_completed_months_is_symmetric(spark, earlier, later, months):
    df = spark.createDataFrame([(earlier, later)], "a string, b string").selectExpr("date(a) a", "date(b) b")
    forward, back = df.select(
        dates.completed_months(F.col("b"), F.col("a")), dates.completed_months(F.col("a"), F.col("b"))
    ).first()
    assert (forward, back) == (months, -months)


def test_completed_years_truncates(spark):
    df = spark.sql("select date'2001-12-31' d, date'1983-12-31' a, date'1984-01-01' b")
    assert tuple(df.select(dates.completed_years(F.col("d"), F.col("a")),
                           dates.completed_years(F.col("d"), F.col("b"))).first()) == (18, 17)


def test_weekday_helpers(spark):
    row = spark.sql("select date'2024-01-07' d").select(  # a Sunday
        dates.weekday_number(F.col("d")), dates.weekday_name(dates.weekday_number(F.col("d"))),
        dates.is_weekend(F.col("d")), dates.weekday_name(F.lit(None).cast("int")),
    ).first()
    assert tuple(row) == (0, "Sunday", True, None)


def test_safe_cast_numeric(evaluate):
    texts = ["12", "-3.5", "12.", "12.5", "$78.26", "89.5 USD", "83,5", "1.234,56", "NA", "", "12.5\n", None, "1e5"]
    assert evaluate(on(numbers.safe_cast_numeric), texts) == [
        12.0, -3.5, 12.0, 12.5, None, None, None, None, None, None, None, None, None]
    assert evaluate(on(numbers.safe_cast_numeric, "int"), ["12", "12.5", "99999999999"]) == [12, None, None]


def test_parse_money(evaluate):
    cases = {"$78.26": 78.26, "89.5 USD": 89.5, "191286,14": 191286.14, "1.234,56": 1234.56, "1.234.567,8": 1234567.8,
             "€5": 5.0, "424926.82": 424926.82, "abc": None, "": None, None: None, "1,234,567": None}
    assert evaluate(on(numbers.parse_money), list(cases)) == list(cases.values())


def test_safe_cast_boolean(evaluate):
    yes, no = ["true", "T", " yes ", "Y", "sí", "SÍ", "si", "1"], ["false", "F", "no", "N", "0"]
    assert evaluate(on(numbers.safe_cast_boolean), yes + no + ["maybe", "", None]) == (
        [True] * len(yes) + [False] * len(no) + [None] * 3)


def test_validated_range_and_point(spark):
    df = spark.createDataFrame([(299, 91.0, 0.0), (300, 90.0, -180.0), (850, None, 5.0), (None, 1.0, 181.0)],
                               "s int, lat double, lon double")
    value, valid = numbers.validated_range(F.col("s"), 300, 850)
    lat, lon, ok = numbers.validated_point(F.col("lat"), F.col("lon"))
    assert [tuple(r) for r in df.select(value, valid, lat, lon, ok).collect()] == [
        (None, False, None, None, False), (300, True, 90.0, -180.0, True),
        (850, True, None, None, False), (None, False, None, None, False)]


def test_ratio_billing_months_and_rounding(spark):
    row = spark.range(1).select(
        numbers.ratio(F.lit(1), F.lit(0)), numbers.billing_months(F.lit(None).cast("int")),
        numbers.billing_months(F.lit(2)), numbers.billing_months(F.lit(9)), F.round(F.lit(2.5), 0), F.round(F.lit(-2.5), 0),
    ).first()
    assert tuple(row) == (None, 3, 3, 9, 3.0, -3.0)


@pytest.mark.parametrize("partitions", [1, 16, 211])
def test_exact_sum_ignores_partitioning(spark, partitions):
    df = spark.range(1, 10_001).select((F.col("id") / 100).alias("v")).repartition(partitions)
    assert df.agg(numbers.exact_sum(F.col("v"))).first()[0] == 500050.0
    large = spark.range(40_000).select((F.col("id") * 0.37 + 3e7 - F.col("id") % 7 * 6e7).alias("v")).repartition(partitions)
    want = float(f"{math.fsum(r.v for r in large.collect()):.14e}")
    assert large.agg(numbers.exact_sum(F.col("v"))).first()[0] == want
    past = spark.range(1000).select((9.1e11 + F.col("id") / 3).alias("v")).repartition(partitions)
    assert past.agg(numbers.exact_sum(F.col("v"))).first()[0] == float(f"{math.fsum(r.v for r in past.collect()):.14e}")


def test_exact_sum_rounds_no_row(spark):
    df = spark.range(10).select(F.lit(0.00004).alias("v"))
    assert df.agg(numbers.exact_sum(F.col("v"))).first()[0] == pytest.approx(0.0004, rel=1e-9)


@pytest.mark.parametrize("bad", [1e300, float("nan"), float("-inf")])
def test_exact_sum_refuses_what_it_cannot_hold(spark, bad):
    df = spark.createDataFrame([(bad,), (2.5,)], "v double")
    with pytest.raises(Exception, match="no number or too large"):
        df.agg(numbers.exact_sum(F.col("v"))).collect()


def test_exact_sum_has_one_accumulator_and_no_switch(spark):
    df = spark.createDataFrame([(2.0 ** 53,), (2.0 ** 54 + 4,), (-2.0 ** 54,), (0.25,)], "v double")
    total = df.agg(numbers.exact_sum(F.col("v")))
    assert total.first()[0] == float(f"{2.0 ** 53 + 4.25:.14e}")
    assert total._jdf.queryExecution().executedPlan().toString().count("partial_sum") == 1


def test_java_literals_are_no_numbers(evaluate):
    assert evaluate(lambda c: numbers.nullable_number(F.col(c)), ["12d", "1.5f", "NaN", "Infinity", " 12 ", "-1e2", ".5", ""]) == [
        None, None, None, None, 12.0, -100.0, 0.5, None]
    assert evaluate(lambda c: numbers.parse_money(F.col(c)), ["$78.26", "89.5 USD", "191286,14", "1.234.567,89", "-5", "12d", "1,234.5", "NaN", "7 XYZ"]) == [
        78.26, 89.5, 191286.14, 1234567.89, -5.0, None, None, None, None]


def test_exact_sum_of_nothing_is_null(spark):
    df = spark.range(3).select(F.lit(None).cast("double").alias("v"))
    assert tuple(df.agg(numbers.exact_sum(F.col("v")), numbers.exact_avg(F.col("v"))).first()) == (None, None)


@pytest.mark.parametrize("function, cases", [
    (buckets.age_bucket, {17: "under_18", 18: "18-25", 25: "18-25", 26: "26-35", 35: "26-35", 36: "36-50", 50: "36-50",
                          51: "51-65", 65: "51-65", 66: "65+", None: "unknown"}),
    (buckets.tenure_bucket, {0: "new", 5: "new", 6: "established", 24: "established", 25: "loyal", None: "unknown"}),
    (buckets.risk_bucket, {-0.01: "unknown", 0: "low", 30: "low", 30.05: "medium", 60: "medium", 60.01: "high", 85: "high",
                           85.01: "critical", 100: "critical", 100.01: "unknown", None: "unknown"}),
    (buckets.credit_score_bucket, {299: "unknown", 300: "poor", 579: "poor", 580: "fair", 669: "fair", 670: "good",
                                   739: "good", 740: "very_good", 799: "very_good", 800: "exceptional",
                                   850: "exceptional", 851: "unknown", None: "unknown"}),
    (buckets.utilization_bucket, {0: "healthy", 29.99: "healthy", 30: "moderate", 59.99: "moderate", 60: "high", 89.99: "high",
                                  90: "maxed", 100: "maxed", 100.01: "over_limit", None: "unknown"}),
    (buckets.dpd_band, {-1: "01 - Early (1-29)", 0: "00 - Current", 29: "01 - Early (1-29)", 30: "02 - 30-59 DPD",
                        59: "02 - 30-59 DPD", 89: "03 - 60-89 DPD", 90: "04 - 90-179 DPD", 179: "04 - 90-179 DPD",
                        180: "05 - 180+ DPD", None: "05 - 180+ DPD"}),
    (buckets.days_past_due_bucket, {-1: "unknown", 0: "current", 1: "1-30", 30: "1-30", 31: "31-60", 60: "31-60", 61: "61-90",
                                    90: "61-90", 91: "90+", None: "unknown"}),
])
def test_bucket_edges(evaluate, function, cases):
    values = [None if k is None else float(k) for k in cases]
    assert evaluate(on(function), values, "double") == list(cases.values())


def test_display_order(evaluate):
    assert evaluate(on(buckets.display_order, "risk"), ["low", "critical", "unknown"]) == [1, 4, None]
