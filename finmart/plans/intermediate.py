"""Loan metrics, customer risk and customer revenue shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finmart.functions import buckets
from finmart.functions.numbers import exact_sum, monthly_interest, ratio
from finmart.operators.analytics import count_where, to_usd

col = F.col


def is_completed_fee() -> Column:
    return (col("transaction_type") == "fee") & (col("status") == "completed")


def accrues_interest() -> Column:
    """Only loans that are being repaid earn interest."""
    return col("status").isin("current", "delinquent")


def accrued_interest() -> Column:
    return monthly_interest(col("outstanding_balance"), col("interest_rate_decimal"))


def fees_by_customer_usd(transactions: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Lifetime completed fees of the customer who made the transaction."""
    fees = transactions.where(is_completed_fee()).select("customer_id", "amount", "currency")
    return to_usd(fees, fx_rates, "currency").groupBy("customer_id").agg(
        exact_sum(col("amount")).alias("fees_native"),
        exact_sum(col("amount") * col("rate_to_usd")).alias("fees_usd"),
    )


def interest_by_customer_usd(loans: DataFrame, fx_rates: DataFrame) -> DataFrame:
    earning = loans.where(accrues_interest()).select(
        "customer_id", "currency", accrued_interest().alias("interest")
    )
    return to_usd(earning, fx_rates, "currency").groupBy("customer_id").agg(
        exact_sum(col("interest")).alias("interest_native"),
        exact_sum(col("interest") * col("rate_to_usd")).alias("interest_usd"),
    )


def int_loan_portfolio_metrics(fct_loans: DataFrame) -> DataFrame:
    days = col("days_past_due")
    never = F.lit(False)
    return fct_loans.select(
        "loan_id", "customer_id", "loan_type", "currency", "status", "collateral_type", "principal",
        "outstanding_balance", "interest_rate", "interest_rate_decimal", "monthly_payment",
        "days_past_due", "term_months", "start_date", "end_date",
        F.coalesce(days >= 30, never).alias("is_delinquent"),
        F.coalesce((days >= 90) | (col("status") == "default"), never).alias("is_default"),
        buckets.dpd_band(days).alias("dpd_bucket"),
        F.coalesce(F.when(accrues_interest(), accrued_interest()), F.lit(0.0)).alias("monthly_interest_accrued"),
    )


def int_customer_risk_profile(
    dim_customer: DataFrame, dim_credit_info: DataFrame, loan_metrics: DataFrame
) -> DataFrame:
    """Scored customers with their buckets; one bad loan marks the customer."""
    exposure = loan_metrics.groupBy("customer_id").agg(
        F.bool_or("is_delinquent").alias("is_delinquent_customer"),
        F.bool_or("is_default").alias("is_default_customer"),
        F.count("*").alias("loans_count"),
        count_where(col("is_delinquent")).alias("delinquent_loans_count"),
        count_where(col("is_default")).alias("default_loans_count"),
    )
    credit = dim_credit_info.select(
        "customer_id", "credit_score", "utilization_pct", "total_limit", "total_used",
        "late_payments_12m", "bankruptcy_flag",
    )
    scored = dim_customer.where(col("risk_score").isNotNull())
    return scored.join(credit, "customer_id", "left").join(exposure, "customer_id", "left").select(
        "customer_id", "country", "customer_segment", "kyc_status",
        scored["status"], "risk_score",
        buckets.risk_bucket(col("risk_score")).alias("risk_bucket"),
        "credit_score",
        buckets.credit_score_bucket(col("credit_score")).alias("credit_score_bucket"),
        "utilization_pct",
        buckets.utilization_bucket(col("utilization_pct")).alias("utilization_bucket"),
        "total_limit", "total_used", "late_payments_12m", "bankruptcy_flag",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_delinquent_customer", "is_default_customer")],
        *[F.coalesce(c, F.lit(0)).alias(c)
          for c in ("loans_count", "delinquent_loans_count", "default_loans_count")],
    )


def int_customer_monthly_revenue(
    dim_customer: DataFrame, fct_transactions: DataFrame, fct_loans: DataFrame, fx_rates: DataFrame
) -> DataFrame:
    """Monthly revenue of every customer: fees over tenure plus interest.

    Native amounts are rounded to cents, dollar amounts are not. A tenure of zero months
    gives no fee revenue.
    """
    def or_zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    tenure = col("tenure_months")
    joined = (
        dim_customer.select("customer_id", "tenure_months")
        .join(fees_by_customer_usd(fct_transactions, fx_rates), "customer_id", "left")
        .join(interest_by_customer_usd(fct_loans, fx_rates), "customer_id", "left")
    )
    return joined.select(
        "customer_id",
        or_zero(F.round("fees_native", 2)).alias("total_fees_paid_lifetime_native"),
        or_zero(col("fees_usd")).alias("total_fees_paid_lifetime_usd"),
        or_zero(F.round(ratio(col("fees_native"), tenure), 2)).alias("monthly_fee_revenue_native"),
        or_zero(ratio(col("fees_usd"), tenure)).alias("monthly_fee_revenue_usd"),
        or_zero(F.round("interest_native", 2)).alias("monthly_interest_revenue_native"),
        or_zero(col("interest_usd")).alias("monthly_interest_revenue_usd"),
    ).withColumns({
        f"total_monthly_revenue_{unit}":
            col(f"monthly_fee_revenue_{unit}") + col(f"monthly_interest_revenue_{unit}")
        for unit in ("native", "usd")
    })
