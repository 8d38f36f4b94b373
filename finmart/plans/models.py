"""The model graph: what each table is built from, its layer, and whether it is stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from finmart.operators.dedup import keep_latest, latest_documents
from finmart.operators.flatten import ACCOUNTS, LOANS, TRANSACTIONS, ArraySpec, flatten_array, parse_documents
from finmart.plans import gold, intermediate, silver
from finmart.sources import seeds


@dataclass(frozen=True)
class Model:
    """``build`` takes the inputs in order, then ``as_of`` if the model is ``dated``.

    Tables that several others read are stored; projections of one stored table are ``thin`` and
    stay views: a copy of them would be read no faster, and a reader of one column reads no other.
    """

    layer: str
    build: Callable
    inputs: tuple[str, ...] = ()
    stored: bool = False
    dated: bool = False
    partition_by: tuple[str, ...] = ()
    thin: bool = False


def _flattened(spec: ArraySpec) -> Callable:
    return lambda parsed: keep_latest(flatten_array(parsed, spec), spec.key)


def _mart(build: Callable, *inputs: str, dated: bool = False) -> Model:
    return Model("gold", build, inputs, dated=dated)


# Seeds take the session instead of tables.
SEEDS: dict[str, Callable] = {
    "fx_rates": seeds.fx_rates,
    "country_currency": seeds.country_currency,
    "dim_geography": seeds.dim_geography,
    "dim_date": seeds.dim_date,
}

MODELS: dict[str, Model] = {
    "documents": Model("silver_raw", parse_documents, ("bronze",), stored=True),
    "raw_accounts": Model("silver_raw", _flattened(ACCOUNTS), ("documents",), stored=True),
    "raw_transactions": Model("silver_raw", _flattened(TRANSACTIONS), ("documents",), stored=True),
    "raw_loans": Model("silver_raw", _flattened(LOANS), ("documents",), stored=True),
    "latest_documents": Model("silver_raw", latest_documents, ("documents",), stored=True),
    "stg_accounts": Model("silver", silver.stg_accounts, ("raw_accounts",), thin=True),
    "stg_transactions": Model("silver", silver.stg_transactions, ("raw_transactions",), thin=True),
    "stg_loans": Model("silver", silver.stg_loans, ("raw_loans",), thin=True),
    "dim_customer": Model("silver", silver.dim_customer, ("latest_documents",), stored=True, dated=True),
    "dim_credit_info": Model("silver", silver.dim_credit_info, ("latest_documents",), thin=True),
    "dim_digital_engagement": Model("silver", silver.dim_digital_engagement, ("latest_documents",), thin=True),
    "dim_account": Model("silver", silver.dim_account, ("stg_accounts",), stored=True, dated=True),
    "dim_loan": Model("silver", silver.dim_loan, ("stg_loans",), dated=True, thin=True),
    "fct_transactions": Model("silver", silver.fct_transactions, ("stg_transactions",), stored=True,
                              partition_by=("transaction_month",)),
    "fct_loans": Model("silver", silver.fct_loans, ("stg_loans",), stored=True),
    "agg_customer_activity": Model(
        "silver", silver.agg_customer_activity,
        ("dim_customer", "stg_accounts", "stg_transactions", "stg_loans"), stored=True,
    ),
    "int_loan_portfolio_metrics": Model("silver", intermediate.int_loan_portfolio_metrics, ("fct_loans",), thin=True),
    "int_customer_risk_profile": Model(
        "silver", intermediate.int_customer_risk_profile,
        ("dim_customer", "dim_credit_info", "int_loan_portfolio_metrics"),
    ),
    "int_customer_monthly_revenue": Model(
        "silver", intermediate.int_customer_monthly_revenue,
        ("dim_customer", "fct_transactions", "fct_loans", "fx_rates"),
    ),
    "mart_customer_360": _mart(
        gold.mart_customer_360, "dim_customer", "dim_credit_info", "dim_digital_engagement",
        "agg_customer_activity", "fct_transactions", "dim_account", "fct_loans",
    ),
    "mart_acquisition_trend": _mart(gold.mart_acquisition_trend, "dim_customer"),
    "mart_revenue_by_segment_usd": _mart(
        gold.mart_revenue_by_segment_usd, "dim_customer", "fct_transactions", "fct_loans", "fx_rates"
    ),
    "mart_revenue_monthly_by_segment_usd": _mart(
        gold.mart_revenue_monthly_by_segment_usd, "dim_customer", "fct_transactions", "fct_loans",
        "fx_rates", dated=True,
    ),
    "mart_account_mix": _mart(gold.mart_account_mix, "dim_account", "dim_customer"),
    "mart_delinquency_by_segment": _mart(gold.mart_delinquency_by_segment, "int_customer_risk_profile"),
    "mart_credit_score_by_country": _mart(gold.mart_credit_score_by_country, "int_customer_risk_profile"),
    "mart_utilization_vs_delinquency": _mart(
        gold.mart_utilization_vs_delinquency, "int_customer_risk_profile"
    ),
    "mart_risk_buckets": _mart(gold.mart_risk_buckets, "int_customer_risk_profile"),
    "mart_loan_dpd": _mart(gold.mart_loan_dpd, "int_loan_portfolio_metrics"),
    "mart_loan_composition": _mart(gold.mart_loan_composition, "int_loan_portfolio_metrics"),
    "mart_tx_by_channel": _mart(gold.mart_tx_by_channel, "fct_transactions"),
    "mart_tx_by_category": _mart(gold.mart_tx_by_category, "fct_transactions"),
    "mart_tx_by_dow": _mart(gold.mart_tx_by_dow, "fct_transactions"),
    "mart_international_transfers": _mart(
        gold.mart_international_transfers, "fct_transactions", "dim_account", "dim_customer",
        "country_currency",
    ),
    "mart_top_merchants": _mart(gold.mart_top_merchants, "fct_transactions"),
    "mart_digital_adoption_by_segment": _mart(
        gold.mart_digital_adoption_by_segment, "dim_customer", "dim_digital_engagement"
    ),
    "mart_channel_preference_by_age": _mart(
        gold.mart_channel_preference_by_age, "dim_customer", "dim_digital_engagement"
    ),
}
MARTS = tuple(name for name, model in MODELS.items() if model.layer == "gold")
