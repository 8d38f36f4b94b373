"""Dashboard headline measures. Each returns one row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from finmart.functions import dates
from finmart.functions.numbers import exact_avg, exact_sum, ratio
from finmart.operators.analytics import count_where, exact_median, to_usd

col = F.col


def customers_and_assets(dim_customer: DataFrame, dim_account: DataFrame, fx_rates: DataFrame) -> DataFrame:
    active = to_usd(dim_account.where(col("status") == "active"), fx_rates, "currency")
    assets = active.agg(
        exact_sum(col("balance") * col("rate_to_usd")).alias("total_assets_usd")
    )
    return dim_customer.agg(F.count("*").alias("total_customers")).withColumn(
        "total_assets_usd", assets.scalar()
    )


def median_revenue(customer_360: DataFrame) -> DataFrame:
    middle = exact_median(customer_360, "total_revenue_monthly")
    return customer_360.agg(
        exact_avg(col("total_revenue_monthly")).alias("avg_revenue")
    ).withColumn("median_revenue", middle.scalar())


def transaction_headlines(
    fct_transactions: DataFrame, monthly_revenue: DataFrame, currency: str = "USD"
) -> DataFrame:
    """Median ticket and failure rate in one currency, next to total dollar revenue."""
    valued = fct_transactions.where((col("currency") == currency) & col("amount").isNotNull())
    revenue = monthly_revenue.agg(exact_sum(col("total_revenue_usd")).alias("total_revenue_usd"))
    return valued.agg(ratio(count_where(col("is_failed")), F.count("*")).alias("failure_rate")).withColumns({
        "median_ticket": exact_median(valued, "amount").scalar(),
        "total_revenue_usd": revenue.scalar(),
    })


def risk_headlines(risk_profile: DataFrame) -> DataFrame:
    borrowers = count_where(col("loans_count") > 0)
    return risk_profile.agg(
        F.avg("credit_score").alias("avg_credit_score"),
        ratio(count_where(col("is_delinquent_customer")), borrowers).alias("delinquency_rate"),
        ratio(count_where(col("is_default_customer")), borrowers).alias("default_rate"),
        exact_avg(col("utilization_pct")).alias("avg_utilization_pct"),
    )


def last_complete_month(acquisition_trend: DataFrame, as_of: date | None) -> DataFrame:
    """New customers and growth of the newest month that is over."""
    complete = acquisition_trend.where(col("month") < dates.month_of(dates.as_of_column(as_of)))
    return complete.orderBy(col("month").desc()).limit(1).select(
        "month_label", "new_customers", "mom_growth_pct"
    )


def adoption_headlines(dim_customer: DataFrame, dim_digital_engagement: DataFrame) -> DataFrame:
    digital = col("mobile_app_registered") | col("web_banking_registered")
    joined = dim_customer.select("customer_id", "kyc_status").join(
        dim_digital_engagement, "customer_id", "left"
    )
    return joined.agg(
        ratio(count_where(digital), F.count("*")).alias("digital_adoption_rate"),
        ratio(count_where(col("kyc_status") == "verified"), F.count("*")).alias("kyc_verified_rate"),
        F.avg("avg_monthly_logins").alias("avg_monthly_logins"),
    )
