"""Comparing revenue definitions and fee attribution across the model graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finmart.functions.numbers import differs, exact_avg, ratio
from finmart.operators.analytics import count_where
from finmart.plans.intermediate import fees_by_customer_usd, interest_by_customer_usd, is_completed_fee

col = F.col
TOLERANCE = 0.0001


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def revenue_from_facts(
    dim_customer: DataFrame, fct_transactions: DataFrame, fct_loans: DataFrame, fx_rates: DataFrame
) -> DataFrame:
    """Dollar revenue of every customer straight from the facts, fees over the plain tenure."""
    return (
        dim_customer.select("customer_id", "tenure_months")
        .join(fees_by_customer_usd(fct_transactions, fx_rates), "customer_id", "left")
        .join(interest_by_customer_usd(fct_loans, fx_rates), "customer_id", "left")
        .select(
            "customer_id",
            _or_zero(ratio(col("fees_usd"), col("tenure_months"))).alias("old_fee"),
            _or_zero(col("interest_usd")).alias("old_interest"),
        )
        .withColumn("old_total", col("old_fee") + col("old_interest"))
    )


def _against(facts: DataFrame, monthly_revenue: DataFrame) -> DataFrame:
    return facts.join(monthly_revenue, "customer_id").select(
        "customer_id", "old_fee", "old_interest", "old_total",
        col("monthly_fee_revenue_usd").alias("new_fee"),
        col("monthly_interest_revenue_usd").alias("new_interest"),
        col("total_monthly_revenue_usd").alias("new_total"),
    )


def revenue_divergence(facts: DataFrame, monthly_revenue: DataFrame) -> DataFrame:
    """How many customers differ beyond the tolerance, per revenue component."""
    both = _against(facts, monthly_revenue)
    return both.agg(
        F.count("*").alias("total_customers"),
        *[count_where(differs(col(f"old_{part}"), col(f"new_{part}"), TOLERANCE)).alias(f"diverge_{part}")
          for part in ("fee", "interest", "total")],
    )


def largest_divergences(facts: DataFrame, monthly_revenue: DataFrame, top: int = 10) -> DataFrame:
    both = _against(facts, monthly_revenue)
    apart = differs(col("old_fee"), col("new_fee"), TOLERANCE) | differs(
        col("old_interest"), col("new_interest"), TOLERANCE
    )
    gap = F.abs(col("old_total") - col("new_total"))

    def shown(value: Column, name: str) -> Column:
        return F.round(value, 4).alias(name)

    return both.where(apart).orderBy(gap.desc(), "customer_id").limit(top).select(
        "customer_id",
        shown(col("old_fee"), "old_fee"), shown(col("new_fee"), "new_fee"),
        shown(col("old_fee") - col("new_fee"), "delta_fee"),
        shown(col("old_interest"), "old_int"), shown(col("new_interest"), "new_int"),
        shown(col("old_interest") - col("new_interest"), "delta_int"),
    )


def mart_against_intermediate(
    revenue_mart: DataFrame, monthly_revenue: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Average revenue per segment from both sources, one row per source and segment."""
    from_mart = revenue_mart.select(
        F.lit("from_mart").alias("source"), "customer_segment", "customer_count",
        F.round("avg_revenue_per_customer_usd", 4).alias("avg_revenue_usd"),
    )
    from_intermediate = (
        monthly_revenue.join(dim_customer.select("customer_id", "customer_segment"), "customer_id")
        .groupBy("customer_segment")
        .agg(F.count("*").alias("customer_count"),
             F.round(exact_avg(col("total_monthly_revenue_usd")), 4).alias("avg_revenue_usd"))
        .select(F.lit("from_intermediate").alias("source"), "*")
    )
    return from_mart.unionByName(from_intermediate).orderBy("customer_segment", "source")


def revenue_rollup_native(customer_360: DataFrame) -> DataFrame:
    """Native average revenue per segment, from the customer mart."""
    return customer_360.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        F.round(exact_avg(col("total_revenue_monthly")), 2).alias("avg_total_revenue_native"),
        F.round(exact_avg(col("monthly_fee_revenue")), 2).alias("avg_fee_revenue_native"),
        F.round(exact_avg(col("monthly_interest_income")), 2).alias("avg_interest_revenue_native"),
    )


def customer_spot_check(customer_360: DataFrame, monthly_revenue: DataFrame, top: int = 5) -> DataFrame:
    """The customers with most revenue, mart against intermediate, marked OK or MISMATCH."""
    pairs = {"fee": ("monthly_fee_revenue", "monthly_fee_revenue_native"),
             "int": ("monthly_interest_income", "monthly_interest_revenue_native"),
             "total": ("total_revenue_monthly", "total_monthly_revenue_native")}
    leaders = customer_360.orderBy(col("total_revenue_monthly").desc(), "customer_id").limit(top)
    same = F.lit(True)
    shown = []
    for name, (mart, intermediate) in pairs.items():
        same = same & (col(mart) == col(intermediate))
        shown += [col(mart).alias(f"mart_{name}"), col(intermediate).alias(f"int_{name}_native")]
    return leaders.join(monthly_revenue, "customer_id").select(
        "customer_id", *shown, F.when(same, "OK").otherwise("MISMATCH").alias("match_status")
    )


def revenue_invariants(monthly_revenue: DataFrame) -> DataFrame:
    """Counters that must be zero: missing keys and negative amounts."""
    parts = {"fee": "monthly_fee_revenue", "int": "monthly_interest_revenue", "total": "total_monthly_revenue"}
    return monthly_revenue.agg(
        F.count("*").alias("row_count"),
        count_where(col("customer_id").isNull()).alias("null_pk"),
        *[count_where(col(f"{column}_{unit}") < 0).alias(f"negative_{part}_{unit}")
          for part, column in parts.items() for unit in ("native", "usd")],
    )


def _fees_with_owner(fct_transactions: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Completed fees per paying customer and account, with the account's owner."""
    fees = (
        fct_transactions.where(is_completed_fee())
        .groupBy("account_id", col("customer_id").alias("payer"))
        .agg(F.count("*").alias("n"))
    )
    return fees.join(dim_account.select("account_id", col("customer_id").alias("owner")), "account_id")


def fee_attribution(fct_transactions: DataFrame, dim_account: DataFrame) -> DataFrame:
    """How many completed fees were paid by someone other than the account's owner."""
    fees = _fees_with_owner(fct_transactions, dim_account)
    divergent = F.coalesce(F.sum(F.when(col("payer") != col("owner"), col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return fees.agg(
        total.alias("total_completed_fees"),
        divergent.alias("divergent_fees"),
        F.round(ratio(divergent * 100, total), 4).alias("divergent_pct"),
    )


def fee_attribution_by_segment(
    fct_transactions: DataFrame, dim_account: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Divergent fees by the segments of payer and owner.

    The customer table is joined under both roles, after fees shrank to one row per
    payer and owner.
    """
    pairs = (
        _fees_with_owner(fct_transactions, dim_account)
        .where(col("payer") != col("owner"))
        .groupBy("payer", "owner").agg(F.sum("n").alias("n"))
    )

    def role(name: str) -> DataFrame:
        return dim_customer.select(
            col("customer_id").alias(name),
            col("customer_segment").alias("executor_segment" if name == "payer" else "owner_segment"),
        )

    return (
        pairs.join(role("payer"), "payer").join(role("owner"), "owner")
        .groupBy("executor_segment", "owner_segment")
        .agg(F.sum("n").alias("divergent_fee_count"))
        .orderBy(col("divergent_fee_count").desc(), "executor_segment", "owner_segment")
    )
