"""Staging views, conformed dimensions, facts and the activity aggregate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from finmart.functions import buckets, dates, numbers, text
from finmart.functions.dates import as_of_column, completed_months, parse_date_multi_format

col = F.col


def _replaced(df: DataFrame, order: list[str], **columns: Column) -> DataFrame:
    return df.select(*[columns[c].alias(c) if c in columns else col(c) for c in order])


def stg_accounts(raw: DataFrame) -> DataFrame:
    return _replaced(
        raw,
        ["account_id", "customer_id", "account_type", "currency", "balance", "credit_limit",
         "interest_rate", "opened_date", "status", "branch_code", "bronze_id", "load_timestamp"],
        account_id=F.trim("account_id"),
        customer_id=F.trim("customer_id"),
        account_type=text.normalize_casing(col("account_type")),
        currency=text.currency_code(col("currency")),
        opened_date=parse_date_multi_format(col("opened_date")),
        status=text.normalize_account_status(col("status")),
        branch_code=F.trim("branch_code"),
    )


def stg_transactions(raw: DataFrame) -> DataFrame:
    return _replaced(
        raw,
        ["transaction_id", "customer_id", "account_id", "transaction_date", "amount", "currency",
         "transaction_type", "category", "merchant", "channel", "status", "description",
         "bronze_id", "load_timestamp"],
        transaction_id=F.trim("transaction_id"),
        customer_id=F.trim("customer_id"),
        account_id=F.trim("account_id"),
        transaction_date=parse_date_multi_format(col("transaction_date")),
        currency=text.currency_code(col("currency")),
        transaction_type=text.normalize_transaction_type(col("transaction_type")),
        category=text.normalize_transaction_category(col("category")),
        merchant=F.trim("merchant"),
        channel=text.normalize_casing(col("channel")),
        status=text.normalize_transaction_status(col("status")),
        description=F.trim("description"),
    )


def stg_loans(raw: DataFrame) -> DataFrame:
    return _replaced(
        raw,
        ["loan_id", "customer_id", "loan_type", "currency", "principal", "outstanding_balance",
         "interest_rate", "term_months", "monthly_payment", "start_date", "end_date", "status",
         "days_past_due", "collateral_type", "bronze_id", "load_timestamp"],
        loan_id=F.trim("loan_id"),
        customer_id=F.trim("customer_id"),
        loan_type=text.normalize_loan_type(col("loan_type")),
        currency=text.currency_code(col("currency")),
        start_date=parse_date_multi_format(col("start_date")),
        end_date=parse_date_multi_format(col("end_date")),
        status=text.normalize_loan_status(col("status")),
        collateral_type=text.normalize_collateral_type(col("collateral_type")),
    )


def dim_customer(latest: DataFrame, as_of: date | None) -> DataFrame:
    today = as_of_column(as_of)
    parsed = latest.withColumns({
        "date_of_birth": parse_date_multi_format(col("date_of_birth")),
        "registration_date": parse_date_multi_format(col("registration_date")),
        "_lat": numbers.nullable_number(col("lat")),
        "_lon": numbers.nullable_number(col("lon")),
    }).withColumns({
        "age": dates.completed_years(today, col("date_of_birth")),
        "tenure_months": completed_months(today, col("registration_date")),
    })
    lat, lon, is_geo_valid = numbers.validated_point(col("_lat"), col("_lon"))
    return parsed.select(
        "customer_id", "first_name", "last_name", "email", "phone_number", "date_of_birth", "age",
        buckets.age_bucket(col("age")).alias("age_bucket"),
        "gender", "nationality", "city", "country", "address",
        is_geo_valid.alias("is_geo_valid"), lat.alias("lat"), lon.alias("lon"),
        "registration_date", "tenure_months",
        buckets.tenure_bucket(col("tenure_months")).alias("tenure_bucket"),
        text.normalize_kyc_status(col("kyc_status")).alias("kyc_status"),
        numbers.nullable_number(col("risk_score")).alias("risk_score"),
        text.normalize_customer_segment(col("customer_segment")).alias("customer_segment"),
        "relationship_manager",
        text.normalize_customer_status(col("status")).alias("status"),
        "load_timestamp",
    )


def dim_credit_info(latest: DataFrame) -> DataFrame:
    def number(name: str, target: str = "double") -> Column:
        return numbers.safe_cast_numeric(col(f"credit_info.{name}"), target).alias(name)

    raw = latest.select(
        "customer_id",
        number("credit_score", "int").alias("credit_score_raw"),
        text.currency_code(col("credit_info.currency")).alias("currency"),
        number("utilization_pct").alias("utilization_pct_raw"),
        number("total_limit"),
        number("total_used"),
        *[number(n, "int") for n in ("num_credit_accounts", "oldest_account_age_months",
                                     "late_payments_12m", "inquiries_6m")],
        numbers.safe_cast_boolean(col("credit_info.bankruptcy_flag")).alias("bankruptcy_flag"),
        "load_timestamp",
    )
    score, score_ok = numbers.validated_range(col("credit_score_raw"), 300, 850)
    utilization, utilization_ok = numbers.validated_range(col("utilization_pct_raw"), 0, 100)
    return raw.select(
        "customer_id", "credit_score_raw",
        score_ok.alias("is_credit_score_valid"), score.alias("credit_score"),
        "currency", "utilization_pct_raw",
        utilization_ok.alias("is_utilization_pct_valid"), utilization.alias("utilization_pct"),
        "total_limit", "total_used", "num_credit_accounts", "oldest_account_age_months",
        "late_payments_12m", "inquiries_6m", "bankruptcy_flag", "load_timestamp",
    )


def dim_digital_engagement(latest: DataFrame) -> DataFrame:
    def flag(name: str) -> Column:
        return numbers.safe_cast_boolean(col(f"digital_engagement.{name}")).alias(name)

    return latest.select(
        "customer_id",
        flag("mobile_app_registered"),
        flag("web_banking_registered"),
        parse_date_multi_format(col("digital_engagement.last_login_date")).alias("last_login_date"),
        numbers.safe_cast_numeric(col("digital_engagement.avg_monthly_logins"), "int").alias("avg_monthly_logins"),
        text.normalize_casing(col("digital_engagement.preferred_channel")).alias("preferred_channel"),
        flag("push_notifications"),
        flag("paperless_statements"),
        "load_timestamp",
    )


def dim_account(stg: DataFrame, as_of: date | None) -> DataFrame:
    age = completed_months(as_of_column(as_of), col("opened_date"))
    return stg.select(
        *[c for c in stg.columns if c not in ("bronze_id", "load_timestamp")],
        age.alias("account_age_months"),
        "load_timestamp",
    )


def dim_loan(stg: DataFrame, as_of: date | None) -> DataFrame:
    today = as_of_column(as_of)
    repaid = col("principal") - col("outstanding_balance")
    return stg.select(
        *[c for c in stg.columns if c not in ("bronze_id", "load_timestamp")],
        completed_months(today, col("start_date")).alias("loan_age_months"),
        completed_months(col("end_date"), today).alias("remaining_term_months"),
        repaid.alias("principal_repaid"),
        (numbers.ratio(repaid, col("principal")) * 100).alias("principal_repaid_pct"),
        "load_timestamp",
    )


def fct_transactions(stg: DataFrame) -> DataFrame:
    lineage = ("bronze_id", "load_timestamp")
    return stg.select(
        *[c for c in stg.columns if c not in lineage],
        (col("status") == "failed").alias("is_failed"),
        dates.weekday_number(col("transaction_date")).alias("day_of_week"),
        *lineage,
        dates.month_of(col("transaction_date")).alias("transaction_month"),
    )


def facts_before(fct_transactions: DataFrame, day: Column) -> DataFrame:
    """Transactions dated before ``day``; of facts stored by month only the months up to it are read."""
    return fct_transactions.where(
        (col("transaction_date") < day) & (col("transaction_month") <= dates.month_of(day))
    )


def fct_loans(stg: DataFrame) -> DataFrame:
    return stg.select(
        "loan_id", "customer_id", "start_date", "end_date", "loan_type", "currency",
        "collateral_type", "term_months", "principal", "outstanding_balance", "interest_rate",
        numbers.percent_to_rate(col("interest_rate")).alias("interest_rate_decimal"),
        "monthly_payment", "status", "days_past_due", "bronze_id", "load_timestamp",
    )


def agg_customer_activity(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, loans: DataFrame
) -> DataFrame:
    """Item counts of every customer, zero where there are none."""
    activity = customers.select("customer_id")
    for name, items in (("accounts", accounts), ("transactions", transactions), ("loans", loans)):
        counts = items.groupBy("customer_id").agg(F.count("*").alias(f"{name}_count"))
        activity = activity.join(counts, "customer_id", "left")
    counted = activity.na.fill(0, ["accounts_count", "transactions_count", "loans_count"])
    return counted.withColumn("total_products", col("accounts_count") + col("loans_count"))
