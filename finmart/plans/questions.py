"""The canned business questions, each a small query over one mart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from finmart.functions.buckets import display_order
from finmart.functions.numbers import exact_avg, exact_sum, ratio
from finmart.operators.analytics import percent_of

col = F.col


def _rounded(name: str, places: int, alias: str) -> Column:
    return F.round(name, places).alias(alias)


def revenue_by_segment(mart: DataFrame) -> DataFrame:
    return mart.orderBy(col("avg_revenue_per_customer_usd").desc_nulls_last()).select(
        "customer_segment", "customer_count",
        _rounded("avg_revenue_per_customer_usd", 2, "avg_revenue_usd"),
        _rounded("avg_fee_revenue_per_customer_usd", 2, "avg_fee_usd"),
        _rounded("avg_interest_revenue_per_customer_usd", 2, "avg_interest_usd"),
        _rounded("fee_revenue_share", 3, "fee_share"),
    )


def balances_by_country(mart: DataFrame) -> DataFrame:
    return (
        mart.where(col("total_balance").isNotNull())
        .groupBy("country", "currency")
        .agg(F.sum("accounts_with_balance").alias("accounts_with_balance"),
             F.round(exact_sum(col("total_balance")), 2).alias("total_balance_native_ccy"),
             F.round(exact_avg(col("avg_balance")), 2).alias("avg_balance_native_ccy"))
        .orderBy("country", "currency")
    )


def throughput_by_channel(mart: DataFrame) -> DataFrame:
    return (
        mart.where(col("total_value").isNotNull())
        .groupBy("channel", "currency")
        .agg(F.sum("completed_tx_count").alias("completed_tx_count"),
             F.round(exact_sum(col("total_value")), 2).alias("total_value_native_ccy"),
             F.round(exact_avg(col("avg_ticket")), 2).alias("avg_ticket_native_ccy"))
        .orderBy("channel", "currency")
    )


def interest_by_loan_type(mart: DataFrame) -> DataFrame:
    return (
        mart.where(col("status").isin("current", "delinquent"))
        .groupBy("loan_type", "currency")
        .agg(F.sum("loan_count").alias("active_loan_count"),
             F.round(exact_sum(col("total_monthly_interest_accrued")), 2).alias("monthly_interest_native_ccy"))
        .orderBy("loan_type", "currency")
    )


def delinquency_by_segment(mart: DataFrame) -> DataFrame:
    return mart.orderBy(col("delinquency_rate").desc_nulls_last(), "customer_segment").select(
        "customer_segment", "customer_count",
        _rounded("delinquency_rate", 4, "delinquency_rate"),
        _rounded("default_rate", 4, "default_rate"),
    )


def credit_scores_by_country(mart: DataFrame) -> DataFrame:
    return mart.orderBy("country", display_order(col("credit_score_bucket"), "credit_score")).select(
        "country", "credit_score_bucket", "customer_count",
        _rounded("bucket_share_within_country", 4, "share"),
    )


def utilization_and_delinquency(mart: DataFrame) -> DataFrame:
    return mart.orderBy(display_order(col("utilization_bucket"), "utilization")).select(
        "utilization_bucket", "customer_count", _rounded("delinquency_rate", 4, "delinquency_rate")
    )


def days_past_due_by_loan_type(mart: DataFrame) -> DataFrame:
    return mart.orderBy("loan_type", "currency", "dpd_bucket").select(
        "loan_type", "dpd_bucket", "currency", "loan_count",
        _rounded("total_outstanding_balance", 2, "outstanding_balance"),
        _rounded("avg_days_past_due", 1, "avg_dpd"),
        _rounded("bucket_share_within_type_currency", 4, "share"),
    )


def risk_and_delinquency(mart: DataFrame) -> DataFrame:
    return mart.orderBy(display_order(col("risk_bucket"), "risk")).select(
        "risk_bucket", "customer_count",
        _rounded("bucket_share", 4, "share_of_customers"),
        _rounded("delinquency_rate", 4, "observed_delinquency_rate"),
    )


def customers_by_city(mart: DataFrame, top: int = 30) -> DataFrame:
    counts = mart.groupBy("country", "city").agg(F.count("*").alias("customer_count"))
    return counts.orderBy(col("customer_count").desc(), "country", "city").limit(top)


def ages_by_segment(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("customer_segment", "age_bucket").agg(F.count("*").alias("customer_count"))
        .orderBy("customer_segment", display_order(col("age_bucket"), "age"))
    )


def acquisition_by_month(mart: DataFrame) -> DataFrame:
    return mart.orderBy("month").select(
        "month_label", "new_customers", "cumulative_customers",
        _rounded("mom_growth_pct", 2, "mom_growth_pct"),
    )


def _counted_with_percent(mart: DataFrame, name: str) -> DataFrame:
    counts = mart.groupBy(name).agg(F.count("*").alias("customer_count"))
    return counts.withColumn("pct", percent_of(col("customer_count"))).orderBy(
        col("customer_count").desc(), name
    )


def customers_by_status(mart: DataFrame) -> DataFrame:
    return _counted_with_percent(mart, "status")


def customers_by_kyc_status(mart: DataFrame) -> DataFrame:
    return _counted_with_percent(mart, "kyc_status")


def categories_by_volume(mart: DataFrame, top: int = 15) -> DataFrame:
    totals = mart.groupBy("category").agg(
        F.sum("completed_tx_count").alias("completed_tx_count"), F.sum("tx_count").alias("total_tx_count")
    )
    return totals.orderBy(col("completed_tx_count").desc(), "category").limit(top)


def categories_in_currency(mart: DataFrame, currency: str = "USD") -> DataFrame:
    return (
        mart.where(col("currency") == currency)
        .orderBy(col("completed_tx_count").desc(), "category")
        .select("category", "completed_tx_count", "tx_count")
    )


def volume_by_weekday(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("day_of_week", "day_of_week_name").agg(F.sum("tx_count").alias("tx_count"))
        .orderBy(col("day_of_week").asc_nulls_last())
    )


def tickets_by_channel(mart: DataFrame) -> DataFrame:
    return mart.where(col("avg_ticket").isNotNull()).orderBy("channel", "currency").select(
        "channel", "currency", _rounded("avg_ticket", 2, "avg_ticket_native_ccy"), "completed_tx_count"
    )


def failures_by_channel(mart: DataFrame) -> DataFrame:
    totals = mart.groupBy("channel").agg(
        F.sum("tx_count").alias("total_tx"), F.sum("failed_tx_count").alias("failed_tx")
    )
    return totals.withColumn("failed_rate", F.round(ratio(col("failed_tx"), col("total_tx")), 4)).orderBy(
        col("failed_rate").desc_nulls_last(), "channel"
    )


def international_corridors(mart: DataFrame, top: int = 20) -> DataFrame:
    return (
        mart.where(col("international_tx_count") > 0)
        .orderBy(col("international_share").desc(), col("international_tx_count").desc(),
                 "origin_country", "tx_currency")
        .limit(top)
        .select("origin_country", "tx_currency", "tx_count", "international_tx_count",
                _rounded("international_share", 4, "international_share"),
                _rounded("total_international_value", 2, "total_intl_value"))
    )


def digital_adoption(mart: DataFrame) -> DataFrame:
    return mart.orderBy(col("mobile_adoption_rate").desc_nulls_last(), "customer_segment").select(
        "customer_segment", "customer_count",
        _rounded("mobile_adoption_rate", 4, "mobile_adoption"),
        _rounded("web_adoption_rate", 4, "web_adoption"),
        _rounded("any_digital_adoption_rate", 4, "any_digital_adoption"),
    )


def digital_or_branch_by_age(mart: DataFrame) -> DataFrame:
    def customers(*channels: str) -> Column:
        return F.sum(F.when(col("preferred_channel").isin(*channels), col("customer_count")).otherwise(0))

    totals = mart.groupBy("age_bucket").agg(
        customers("mobile", "web").alias("digital_customers"),
        customers("atm", "branch", "phone").alias("non_digital_customers"),
        F.sum("customer_count").alias("total_customers"),
    )
    return totals.withColumn(
        "digital_share", F.round(ratio(col("digital_customers"), col("total_customers")), 4)
    ).orderBy(display_order(col("age_bucket"), "age"))


def popular_account_types(mart: DataFrame) -> DataFrame:
    totals = mart.groupBy("account_type").agg(F.sum("accounts_count").alias("total_accounts"))
    return totals.withColumn("pct_of_total", percent_of(col("total_accounts"))).orderBy(
        col("total_accounts").desc(), "account_type"
    )


def loan_portfolio(mart: DataFrame) -> DataFrame:
    return mart.orderBy("loan_type", "currency", "status").select(
        "loan_type", "status", "currency", "loan_count",
        _rounded("total_outstanding_balance", 2, "outstanding_balance"),
        _rounded("outstanding_share_within_type_currency", 4, "share_within_type"),
    )


def products_by_segment(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("customer_segment")
        .agg(F.count("*").alias("customer_count"),
             F.round(F.avg("accounts_count"), 2).alias("avg_accounts"),
             F.round(F.avg("loans_count"), 2).alias("avg_loans"),
             F.round(F.avg("total_products"), 2).alias("avg_total_products"))
        .orderBy(col("avg_total_products").desc(), "customer_segment")
    )


# Question id -> (mart it reads, query).
QUESTIONS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "bq1": ("mart_revenue_by_segment_usd", revenue_by_segment),
    "bq2": ("mart_account_mix", balances_by_country),
    "bq3": ("mart_tx_by_channel", throughput_by_channel),
    "bq4": ("mart_loan_composition", interest_by_loan_type),
    "bq5": ("mart_delinquency_by_segment", delinquency_by_segment),
    "bq6": ("mart_credit_score_by_country", credit_scores_by_country),
    "bq7": ("mart_utilization_vs_delinquency", utilization_and_delinquency),
    "bq8": ("mart_loan_dpd", days_past_due_by_loan_type),
    "bq9": ("mart_risk_buckets", risk_and_delinquency),
    "bq10": ("mart_customer_360", customers_by_city),
    "bq11": ("mart_customer_360", ages_by_segment),
    "bq12": ("mart_acquisition_trend", acquisition_by_month),
    "bq13": ("mart_customer_360", customers_by_status),
    "bq14": ("mart_customer_360", customers_by_kyc_status),
    "bq15a": ("mart_tx_by_category", categories_by_volume),
    "bq15b": ("mart_tx_by_category", categories_in_currency),
    "bq16": ("mart_tx_by_dow", volume_by_weekday),
    "bq17": ("mart_tx_by_channel", tickets_by_channel),
    "bq18": ("mart_tx_by_channel", failures_by_channel),
    "bq19": ("mart_international_transfers", international_corridors),
    "bq20": ("mart_digital_adoption_by_segment", digital_adoption),
    "bq21": ("mart_channel_preference_by_age", digital_or_branch_by_age),
    "bq22": ("mart_account_mix", popular_account_types),
    "bq23": ("mart_loan_composition", loan_portfolio),
    "bq24": ("mart_customer_360", products_by_segment),
}
