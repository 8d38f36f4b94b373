"""Business marts.

Each function takes the tables it reads. Facts are aggregated before they are joined, so
what is shuffled for a join has at most one row per key and a hot key stays small.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmart.functions import buckets, dates
from finmart.functions.numbers import billing_months, exact_avg, exact_sum, ratio
from finmart.operators.analytics import (
    count_where,
    growth_percent,
    ordinal,
    percent_of,
    running_total,
    share_of,
    to_usd,
)
from finmart.plans.intermediate import (
    accrued_interest,
    accrues_interest,
    fees_by_customer_usd,
    interest_by_customer_usd,
    is_completed_fee,
)
from finmart.plans.silver import facts_before

col = F.col


def rows() -> Column:
    return F.count("*")


def _or_zero(name: str, zero=0.0) -> Column:
    return F.coalesce(name, F.lit(zero))


def _completed(value: Column) -> Column:
    return F.when(col("status") == "completed", value)


def mart_customer_360(
    dim_customer: DataFrame,
    dim_credit_info: DataFrame,
    dim_digital_engagement: DataFrame,
    agg_customer_activity: DataFrame,
    fct_transactions: DataFrame,
    dim_account: DataFrame,
    fct_loans: DataFrame,
) -> DataFrame:
    """One row per scored customer. Fees go to the owner of the account and are summed in
    native units."""
    fees_by_account = (
        fct_transactions.where(is_completed_fee())
        .groupBy("account_id")
        .agg(exact_sum(col("amount")).alias("fees"))
    )
    fees = (
        fees_by_account.join(dim_account.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(F.round(exact_sum(col("fees")), 2).alias("total_fees_paid_lifetime"))
    )
    interest = (
        fct_loans.where(accrues_interest())
        .groupBy("customer_id")
        .agg(F.round(exact_sum(accrued_interest()), 2).alias("monthly_interest_income"))
    )
    profile = dim_customer.where(col("risk_score").isNotNull()).select(
        "customer_id", "country", "city", "gender", "age", "age_bucket", "customer_segment",
        "tenure_months", "tenure_bucket", "kyc_status", "status", "risk_score",
    )
    credit = dim_credit_info.select(
        "customer_id", "credit_score", "utilization_pct", "total_limit", "total_used",
        "late_payments_12m", "bankruptcy_flag",
    )
    digital = dim_digital_engagement.select(
        "customer_id", "mobile_app_registered", "web_banking_registered"
    )
    joined = profile
    for side in (credit, digital, agg_customer_activity, fees, interest):
        joined = joined.join(side, "customer_id", "left")
    counts = ("accounts_count", "loans_count", "transactions_count", "total_products")
    monthly_fee = F.round(_or_zero("total_fees_paid_lifetime") / billing_months(col("tenure_months")), 2)
    return joined.select(
        *profile.columns,
        buckets.risk_bucket(col("risk_score")).alias("risk_bucket"),
        "credit_score",
        buckets.credit_score_bucket(col("credit_score")).alias("credit_score_bucket"),
        "utilization_pct",
        buckets.utilization_bucket(col("utilization_pct")).alias("utilization_bucket"),
        "total_limit", "total_used", "late_payments_12m", "bankruptcy_flag",
        "mobile_app_registered", "web_banking_registered",
        *[_or_zero(c, 0).alias(c) for c in counts],
        _or_zero("total_fees_paid_lifetime").alias("total_fees_paid_lifetime"),
        monthly_fee.alias("monthly_fee_revenue"),
        _or_zero("monthly_interest_income").alias("monthly_interest_income"),
        (monthly_fee + _or_zero("monthly_interest_income")).alias("total_revenue_monthly"),
    )


def mart_acquisition_trend(dim_customer: DataFrame) -> DataFrame:
    month = col("month")
    monthly = (
        dim_customer.where(col("registration_date").isNotNull())
        .groupBy(dates.month_of(col("registration_date")).alias("month"))
        .agg(F.count("customer_id").alias("new_customers"))
    )
    return monthly.select(
        month,
        F.year(month).alias("year"),
        F.month(month).alias("month_number"),
        F.date_format(month, "yyyy-MM").alias("month_label"),
        "new_customers",
        running_total(col("new_customers"), "month").alias("cumulative_customers"),
        growth_percent(col("new_customers"), "month").alias("mom_growth_pct"),
    )


def mart_revenue_by_segment_usd(
    dim_customer: DataFrame, fct_transactions: DataFrame, fct_loans: DataFrame, fx_rates: DataFrame
) -> DataFrame:
    """Monthly revenue per segment. Fees go to the customer of the transaction."""
    fee = F.coalesce(col("fees_usd") / billing_months(col("tenure_months")), F.lit(0.0))
    per_customer = (
        dim_customer.select("customer_id", "customer_segment", "tenure_months")
        .join(fees_by_customer_usd(fct_transactions, fx_rates), "customer_id", "left")
        .join(interest_by_customer_usd(fct_loans, fx_rates), "customer_id", "left")
        .select("customer_segment", fee.alias("fee"), _or_zero("interest_usd").alias("interest"))
        .withColumn("revenue", col("fee") + col("interest"))
    )

    def total(name: str) -> Column:
        return exact_sum(col(name))

    def average(name: str) -> Column:
        return exact_avg(col(name))

    return per_customer.groupBy("customer_segment").agg(
        rows().alias("customer_count"),
        total("revenue").alias("total_revenue_usd"),
        average("revenue").alias("avg_revenue_per_customer_usd"),
        total("fee").alias("total_fee_revenue_usd"),
        total("interest").alias("total_interest_revenue_usd"),
        average("fee").alias("avg_fee_revenue_per_customer_usd"),
        average("interest").alias("avg_interest_revenue_per_customer_usd"),
        ratio(total("fee"), total("revenue")).alias("fee_revenue_share"),
    )


def mart_revenue_monthly_by_segment_usd(
    dim_customer: DataFrame,
    fct_transactions: DataFrame,
    fct_loans: DataFrame,
    fx_rates: DataFrame,
    as_of: date | None,
) -> DataFrame:
    """Fees by the month they were paid, and interest in every month since the loan began.

    Interest is summed by segment and start month first; what a month earns is the running sum
    of that small table. The list of months arrives as one array bounded by the calendar.
    """
    segment = dim_customer.select("customer_id", "customer_segment")
    dated = facts_before(fct_transactions, dates.month_of(dates.as_of_column(as_of))).withColumn(
        "revenue_month", col("transaction_month")
    )
    fees_by_customer = (
        to_usd(dated.where(is_completed_fee()), fx_rates, "currency")
        .groupBy("customer_id", "revenue_month")
        .agg(exact_sum(col("amount") * col("rate_to_usd")).alias("usd"))
    )
    fees = (
        fees_by_customer.join(segment, "customer_id")
        .groupBy("revenue_month", "customer_segment")
        .agg(exact_sum(col("usd")).alias("fees"))
    )
    earning = fct_loans.where(
        accrues_interest() & col("outstanding_balance").isNotNull()
        & col("interest_rate_decimal").isNotNull() & col("start_date").isNotNull()
    ).withColumn("start_month", dates.month_of(col("start_date")))
    by_customer = (
        to_usd(earning, fx_rates, "currency")
        .groupBy("customer_id", "start_month")
        .agg(exact_sum(accrued_interest() * col("rate_to_usd")).alias("usd"))
    )
    started = (
        by_customer.join(segment, "customer_id")
        .groupBy("customer_segment", "start_month")
        .agg(exact_sum(col("usd")).alias("usd"))
    )
    # one row per segment and month with a start or facts; loans earn in every later month of facts
    months = dated.select("revenue_month").distinct().agg(F.collect_list("revenue_month").alias("months"))
    listed = started.select("customer_segment").distinct().select(
        F.explode(months.scalar()).alias("revenue_month"), "customer_segment", F.lit(True).alias("listed"))
    timeline = listed.join(
        started.withColumnRenamed("start_month", "revenue_month"), ["revenue_month", "customer_segment"], "full")
    up_to_month = Window.partitionBy("customer_segment").orderBy("revenue_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    interest = timeline.withColumn("interest", exact_sum(col("usd"), up_to_month)).where(
        col("listed") & col("interest").isNotNull()).select("revenue_month", "customer_segment", "interest")
    both = fees.join(interest, ["revenue_month", "customer_segment"], "full")
    fee, income = _or_zero("fees"), _or_zero("interest")
    return both.select(
        "revenue_month",
        "customer_segment",
        F.round(fee, 2).alias("fee_revenue_usd"),
        F.round(income, 2).alias("interest_revenue_usd"),
        F.round(fee + income, 2).alias("total_revenue_usd"),
    )


def mart_account_mix(dim_account: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Active accounts by country, type and currency.

    The grain of the dimension is the account, so counting rows counts accounts, and each
    customer's accounts are reduced before they meet the customer.
    """
    balance = col("balance")
    per_customer = (
        dim_account.where(col("status") == "active")
        .groupBy("customer_id", "account_type", "currency")
        .agg(F.count("account_id").alias("n"),
             F.count(balance).alias("n_balances"),
             exact_sum(balance).alias("total"), F.min("balance").alias("low"), F.max("balance").alias("high"))
    )
    placed = per_customer.join(dim_customer.select("customer_id", "country"), "customer_id")
    total = exact_sum(col("total"))
    grouped = placed.groupBy("country", "account_type", "currency").agg(
        F.sum("n").alias("accounts_count"),
        F.sum("n_balances").alias("accounts_with_balance"),
        F.round(total, 2).alias("total_balance"),
        F.round(ratio(total, F.sum("n_balances")), 2).alias("avg_balance"),
        F.round(F.min("low"), 2).alias("min_balance"),
        F.round(F.max("high"), 2).alias("max_balance"),
    )
    return grouped.withColumns({
        "pct_of_country_accounts": percent_of(col("accounts_count"), "country"),
        "pct_of_total_accounts": percent_of(col("accounts_count")),
    })


def _with_loans() -> Column:
    return count_where(col("loans_count") > 0)


def _delinquent() -> Column:
    return count_where(col("is_delinquent_customer"))


def _defaulted() -> Column:
    return count_where(col("is_default_customer"))


def _bad_loan_rates() -> list[Column]:
    """Rates among customers that have loans."""
    return [
        ratio(_delinquent(), _with_loans()).alias("delinquency_rate"),
        ratio(_defaulted(), _with_loans()).alias("default_rate"),
    ]


def mart_delinquency_by_segment(risk_profile: DataFrame) -> DataFrame:
    return risk_profile.groupBy("customer_segment").agg(
        rows().alias("customer_count"),
        _with_loans().alias("customers_with_loans"),
        count_where(col("loans_count") == 0).alias("customers_without_loans"),
        _delinquent().alias("delinquent_customers"),
        _defaulted().alias("default_customers"),
        *_bad_loan_rates(),
    )


def mart_credit_score_by_country(risk_profile: DataFrame) -> DataFrame:
    grouped = risk_profile.groupBy("country", "credit_score_bucket").agg(
        rows().alias("customer_count"), F.avg("credit_score").alias("avg_credit_score")
    )
    return grouped.withColumn("bucket_share_within_country", share_of(col("customer_count"), "country"))


def mart_utilization_vs_delinquency(risk_profile: DataFrame) -> DataFrame:
    return risk_profile.groupBy("utilization_bucket").agg(
        rows().alias("customer_count"),
        _with_loans().alias("customers_with_loans"),
        _delinquent().alias("delinquent_customers"),
        _defaulted().alias("default_customers"),
        *_bad_loan_rates(),
        exact_avg(col("utilization_pct")).alias("avg_utilization_pct"),
        F.avg("credit_score").alias("avg_credit_score"),
    )


def mart_risk_buckets(risk_profile: DataFrame) -> DataFrame:
    grouped = risk_profile.groupBy("risk_bucket").agg(
        rows().alias("customer_count"),
        exact_avg(col("risk_score")).alias("avg_risk_score"),
        _with_loans().alias("customers_with_loans"),
        *_bad_loan_rates(),
        F.avg("credit_score").alias("avg_credit_score"),
        exact_avg(col("utilization_pct")).alias("avg_utilization_pct"),
    )
    return grouped.withColumn("bucket_share", share_of(col("customer_count")))


def mart_loan_dpd(loan_metrics: DataFrame) -> DataFrame:
    grouped = (
        loan_metrics.where(col("outstanding_balance").isNotNull())
        .groupBy("loan_type", "dpd_bucket", "currency")
        .agg(
            rows().alias("loan_count"),
            exact_sum(col("outstanding_balance")).alias("total_outstanding_balance"),
            exact_avg(col("outstanding_balance")).alias("avg_outstanding_balance"),
            F.avg("days_past_due").alias("avg_days_past_due"),
        )
    )
    return grouped.withColumn(
        "bucket_share_within_type_currency", share_of(col("loan_count"), "loan_type", "currency")
    )


def mart_loan_composition(loan_metrics: DataFrame) -> DataFrame:
    grouped = loan_metrics.groupBy("loan_type", "status", "currency").agg(
        rows().alias("loan_count"),
        exact_sum(col("principal")).alias("total_principal"),
        exact_sum(col("outstanding_balance")).alias("total_outstanding_balance"),
        exact_avg(col("outstanding_balance")).alias("avg_outstanding_balance"),
        exact_avg(col("interest_rate_decimal")).alias("avg_interest_rate"),
        exact_sum(col("monthly_interest_accrued")).alias("total_monthly_interest_accrued"),
        count_where(col("is_delinquent")).alias("delinquent_count"),
        count_where(col("is_default")).alias("default_count"),
    )
    return grouped.withColumn(
        "outstanding_share_within_type_currency",
        share_of(col("total_outstanding_balance"), "loan_type", "currency"),
    )


def _transaction_counts() -> list[Column]:
    return [
        rows().alias("tx_count"),
        count_where(col("status") == "completed").alias("completed_tx_count"),
    ]


def _completed_value() -> list[Column]:
    return [
        exact_sum(_completed(col("amount"))).alias("total_value"),
        exact_avg(_completed(col("amount"))).alias("avg_ticket"),
    ]


def mart_tx_by_channel(fct_transactions: DataFrame) -> DataFrame:
    failed = count_where(col("is_failed"))
    return fct_transactions.where(col("amount").isNotNull()).groupBy("channel", "currency").agg(
        *_transaction_counts(),
        failed.alias("failed_tx_count"),
        *_completed_value(),
        ratio(failed, rows()).alias("failed_rate"),
    )


def mart_tx_by_category(fct_transactions: DataFrame) -> DataFrame:
    valued = fct_transactions.where(col("amount").isNotNull() & col("category").isNotNull())
    return valued.groupBy("category", "currency").agg(*_transaction_counts(), *_completed_value())


def mart_tx_by_dow(fct_transactions: DataFrame) -> DataFrame:
    grouped = (
        fct_transactions.where(col("amount").isNotNull())
        .groupBy("day_of_week", "currency")
        .agg(*_transaction_counts(), *_completed_value())
    )
    return grouped.select(
        "day_of_week",
        dates.weekday_name(col("day_of_week")).alias("day_of_week_name"),
        *[c for c in grouped.columns if c != "day_of_week"],
    )


def mart_international_transfers(
    fct_transactions: DataFrame,
    dim_account: DataFrame,
    dim_customer: DataFrame,
    country_currency: DataFrame,
) -> DataFrame:
    """Transfers by origin country and currency.

    A transfer is international when its currency is neither the account's nor the home
    currency; an unknown currency on any side makes it domestic. Counts and values are
    reduced per account, customer and currency before the joins.
    """
    done = col("status") == "completed"
    reduced = (
        fct_transactions.where((col("transaction_type") == "transfer") & col("amount").isNotNull())
        .groupBy("account_id", "customer_id", col("currency").alias("tx_currency"))
        .agg(
            rows().alias("n"),
            count_where(done).alias("n_done"),
            exact_sum(F.when(done, col("amount"))).alias("value_done"),
        )
    )
    homes = country_currency.select(
        col("country_code").alias("country"), col("currency_code").alias("home_currency"))
    origin = dim_customer.select("customer_id", "country").join(homes, "country", "left")
    placed = reduced.join(
        dim_account.select("account_id", col("currency").alias("account_currency")), "account_id"
    ).join(origin, "customer_id")
    abroad = F.coalesce(
        (col("tx_currency") != col("account_currency")) & (col("tx_currency") != col("home_currency")),
        F.lit(False),
    )

    def total(name: str, condition: Column | None = None) -> Column:
        value = col(name) if condition is None else F.when(condition, col(name))
        return F.coalesce(F.sum(value), F.lit(0))

    def value(condition: Column | None = None) -> Column:
        amount = col("value_done")
        return exact_sum(amount if condition is None else F.when(condition, amount))

    return placed.withColumn("abroad", abroad).groupBy(
        col("country").alias("origin_country"), "tx_currency"
    ).agg(
        total("n").alias("tx_count"),
        total("n", col("abroad")).alias("international_tx_count"),
        total("n", ~col("abroad")).alias("domestic_tx_count"),
        total("n_done").alias("completed_tx_count"),
        total("n_done", col("abroad")).alias("completed_international_tx_count"),
        ratio(total("n", col("abroad")), total("n")).alias("international_share"),
        value().alias("total_value"),
        value(col("abroad")).alias("total_international_value"),
        ratio(value(), total("n_done")).alias("avg_ticket"),
        ratio(value(col("abroad")), total("n_done", col("abroad"))).alias("avg_international_ticket"),
    )


def mart_top_merchants(fct_transactions: DataFrame) -> DataFrame:
    """Completed transactions per merchant and currency, ranked inside the currency.

    One pass groups by category as well; merchant totals and the most frequent category
    both follow from that. Ties in the mode go to the first name, NULL last; ties in a rank
    go to the first merchant name.
    """
    per_category = (
        fct_transactions.where((col("status") == "completed") & col("merchant").isNotNull())
        .groupBy("merchant", "currency", "category")
        .agg(rows().alias("n"), F.count("amount").alias("n_amounts"),
             exact_sum(col("amount")).alias("value"),
             F.min("amount").alias("low"), F.max("amount").alias("high"))
    )
    mode_order = F.struct(-col("n"), col("category").isNull(), col("category"))
    value = exact_sum(col("value"))
    merchants = per_category.groupBy("merchant", "currency").agg(
        F.min_by("category", mode_order).alias("mode"),
        F.sum("n").alias("tx_count"),
        F.round(value, 2).alias("total_value"),
        F.round(ratio(value, F.sum("n_amounts")), 2).alias("avg_ticket"),
        F.round(F.min("low"), 2).alias("min_ticket"),
        F.round(F.max("high"), 2).alias("max_ticket"),
    ).select(
        "merchant", "currency",
        F.when(col("currency").isNotNull(), col("mode")).alias("top_category"),
        "tx_count", "total_value", "avg_ticket", "min_ticket", "max_ticket",
    )
    by_value = ordinal(merchants, "currency", "total_value", "merchant", "rank_by_value_within_currency")
    return ordinal(by_value, "currency", "tx_count", "merchant", "rank_by_count_within_currency")


def mart_digital_adoption_by_segment(dim_customer: DataFrame, dim_digital_engagement: DataFrame) -> DataFrame:
    joined = dim_customer.select("customer_id", "customer_segment").join(
        dim_digital_engagement, "customer_id", "left"
    )
    mobile, web = col("mobile_app_registered"), col("web_banking_registered")
    rates = {
        "mobile_adoption_rate": mobile,
        "web_adoption_rate": web,
        "any_digital_adoption_rate": mobile | web,
        "push_notifications_rate": col("push_notifications"),
        "paperless_rate": col("paperless_statements"),
    }
    return joined.groupBy("customer_segment").agg(
        rows().alias("customer_count"),
        *[ratio(count_where(flag), rows()).alias(name) for name, flag in rates.items()],
        F.avg("avg_monthly_logins").alias("avg_monthly_logins"),
    )


def mart_channel_preference_by_age(dim_customer: DataFrame, dim_digital_engagement: DataFrame) -> DataFrame:
    preferring = dim_digital_engagement.where(col("preferred_channel").isNotNull()).select(
        "customer_id", "preferred_channel"
    )
    grouped = (
        dim_customer.select("customer_id", "age_bucket").join(preferring, "customer_id")
        .groupBy("age_bucket", "preferred_channel")
        .agg(rows().alias("customer_count"))
    )
    return grouped.withColumn("bucket_share_within_age", share_of(col("customer_count"), "age_bucket"))
