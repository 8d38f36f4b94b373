"""Table, question and measure queries."""

from __future__ import annotations

from checks.oracle_tables import A, MONTH0, N, Q, R, S
from checks.registry import columns_sql, register
from checks.shapes import SHAPES, TABLE_QUERIES
from finmart.plans import measures
from finmart.plans.questions import QUESTIONS


def _table(name: str, table: str) -> None:
    names = [c.rstrip("~") for c in SHAPES[table].split()]
    register(name, lambda w: w.table(table).select(*names), f"SELECT {columns_sql(SHAPES[table])} FROM {table}")


for _name, _target in TABLE_QUERIES.items():
    _table(_name, _target)


def ordered(order: str, limit: int) -> str:
    return f" ORDER BY {order} LIMIT {limit}"


QUESTION_SQL = {
    "bq1": f"""SELECT customer_segment, customer_count, {R('avg_revenue_per_customer_usd', 2)} AS avg_revenue_usd,
        {R('avg_fee_revenue_per_customer_usd', 2)} AS avg_fee_usd,
        {R('avg_interest_revenue_per_customer_usd', 2)} AS avg_interest_usd,
        {R('fee_revenue_share', 3)} AS fee_share FROM mart_revenue_by_segment_usd""",
    "bq2": f"""SELECT country, currency, {N('sum(accounts_with_balance)')} AS accounts_with_balance,
        {R(S('total_balance'), 2)} AS total_balance_native_ccy, {R(A('avg_balance'), 2)} AS avg_balance_native_ccy
        FROM mart_account_mix WHERE total_balance IS NOT NULL GROUP BY ALL""",
    "bq3": f"""SELECT channel, currency, {N('sum(completed_tx_count)')} AS completed_tx_count,
        {R(S('total_value'), 2)} AS total_value_native_ccy, {R(A('avg_ticket'), 2)} AS avg_ticket_native_ccy
        FROM mart_tx_by_channel WHERE total_value IS NOT NULL GROUP BY ALL""",
    "bq4": f"""SELECT loan_type, currency, {N('sum(loan_count)')} AS active_loan_count,
        {R(S('total_monthly_interest_accrued'), 2)} AS monthly_interest_native_ccy
        FROM mart_loan_composition WHERE status IN ('current', 'delinquent') GROUP BY ALL""",
    "bq5": f"""SELECT customer_segment, customer_count, {R('delinquency_rate', 4)} AS delinquency_rate,
        {R('default_rate', 4)} AS default_rate FROM mart_delinquency_by_segment""",
    "bq6": f"""SELECT country, credit_score_bucket, customer_count, {R('bucket_share_within_country', 4)} AS share
        FROM mart_credit_score_by_country""",
    "bq7": f"""SELECT utilization_bucket, customer_count, {R('delinquency_rate', 4)} AS delinquency_rate
        FROM mart_utilization_vs_delinquency""",
    "bq8": f"""SELECT loan_type, dpd_bucket, currency, loan_count,
        {R('total_outstanding_balance', 2)} AS outstanding_balance, {R('avg_days_past_due', 1)} AS avg_dpd,
        {R('bucket_share_within_type_currency', 4)} AS share FROM mart_loan_dpd""",
    "bq9": f"""SELECT risk_bucket, customer_count, {R('bucket_share', 4)} AS share_of_customers,
        {R('delinquency_rate', 4)} AS observed_delinquency_rate FROM mart_risk_buckets""",
    "bq10": "SELECT country, city, count(*) AS customer_count FROM mart_customer_360 GROUP BY ALL"
            + ordered("customer_count DESC, country, city", 30),
    "bq11": "SELECT customer_segment, age_bucket, count(*) AS customer_count FROM mart_customer_360 GROUP BY ALL",
    "bq12": f"""SELECT month_label, new_customers, cumulative_customers, {R('mom_growth_pct', 2)} AS mom_growth_pct
        FROM mart_acquisition_trend""",
    "bq13": f"""SELECT status, n AS customer_count, {R('(n * 1e2 / sum(n) OVER ())', 2)} AS pct
        FROM (SELECT status, count(*) AS n FROM mart_customer_360 GROUP BY 1)""",
    "bq14": f"""SELECT kyc_status, n AS customer_count, {R('(n * 1e2 / sum(n) OVER ())', 2)} AS pct
        FROM (SELECT kyc_status, count(*) AS n FROM mart_customer_360 GROUP BY 1)""",
    "bq15a": f"""SELECT category, {N('sum(completed_tx_count)')} AS completed_tx_count,
        {N('sum(tx_count)')} AS total_tx_count FROM mart_tx_by_category GROUP BY 1"""
             + ordered("completed_tx_count DESC, category", 15),
    "bq15b": "SELECT category, completed_tx_count, tx_count FROM mart_tx_by_category WHERE currency = 'USD'",
    "bq16": f"SELECT day_of_week, day_of_week_name, {N('sum(tx_count)')} AS tx_count FROM mart_tx_by_dow GROUP BY ALL",
    "bq17": f"""SELECT channel, currency, {R('avg_ticket', 2)} AS avg_ticket_native_ccy, completed_tx_count
        FROM mart_tx_by_channel WHERE avg_ticket IS NOT NULL""",
    "bq18": f"""SELECT channel, {N('sum(tx_count)')} AS total_tx, {N('sum(failed_tx_count)')} AS failed_tx,
        {R(Q('sum(failed_tx_count)', 'sum(tx_count)'), 4)} AS failed_rate FROM mart_tx_by_channel GROUP BY 1""",
    "bq19": f"""SELECT origin_country, tx_currency, tx_count, international_tx_count,
        {R('share', 4)} AS international_share, {R('total_international_value', 2)} AS total_intl_value
        FROM (SELECT *, international_share AS share FROM mart_international_transfers
              WHERE international_tx_count > 0
              ORDER BY share DESC, international_tx_count DESC, origin_country, tx_currency LIMIT 20)""",
    "bq20": f"""SELECT customer_segment, customer_count, {R('mobile_adoption_rate', 4)} AS mobile_adoption,
        {R('web_adoption_rate', 4)} AS web_adoption, {R('any_digital_adoption_rate', 4)} AS any_digital_adoption
        FROM mart_digital_adoption_by_segment""",
    "bq21": f"""SELECT age_bucket, {N('sum(d)')} AS digital_customers, {N('sum(n)')} AS non_digital_customers,
        {N('sum(customer_count)')} AS total_customers, {R(Q('sum(d)', 'sum(customer_count)'), 4)} AS digital_share
        FROM (SELECT *, CASE WHEN preferred_channel IN ('mobile', 'web') THEN customer_count ELSE 0 END AS d,
                CASE WHEN preferred_channel IN ('atm', 'branch', 'phone') THEN customer_count ELSE 0 END AS n
              FROM mart_channel_preference_by_age) GROUP BY 1""",
    "bq22": f"""SELECT account_type, {N('n')} AS total_accounts, {R('(n * 1e2 / sum(n) OVER ())', 2)} AS pct_of_total
        FROM (SELECT account_type, sum(accounts_count) AS n FROM mart_account_mix GROUP BY 1)""",
    "bq23": f"""SELECT loan_type, status, currency, loan_count,
        {R('total_outstanding_balance', 2)} AS outstanding_balance,
        {R('outstanding_share_within_type_currency', 4)} AS share_within_type FROM mart_loan_composition""",
    "bq24": f"""SELECT customer_segment, count(*) AS customer_count, {R('avg(accounts_count)', 2)} AS avg_accounts,
        {R('avg(loans_count)', 2)} AS avg_loans, {R('avg(total_products)', 2)} AS avg_total_products
        FROM mart_customer_360 GROUP BY 1""",
}


def _question(name: str) -> None:
    mart, query = QUESTIONS[name]
    register(f"{name}_{query.__name__}", lambda w: query(w.saved(mart)), QUESTION_SQL[name])


for _name in QUESTIONS:
    _question(_name)

register(
    "kpi1_customers_and_assets",
    lambda w: measures.customers_and_assets(*w.tables("dim_customer", "dim_account", "fx_rates")),
    f"""SELECT (SELECT count(*) FROM dim_customer) AS total_customers, {R(S('balance * rate'))} AS total_assets_usd
        FROM dim_account LEFT JOIN fx_rates USING (currency) WHERE status = 'active'""",
)
register(
    "kpi2_median_revenue",
    lambda w: measures.median_revenue(w.saved("mart_customer_360")),
    f"""SELECT {R('median(total_revenue_monthly)')} AS median_revenue,
        {R(A('total_revenue_monthly'))} AS avg_revenue FROM mart_customer_360""",
)
register(
    "kpi3_transaction_headlines",
    lambda w: measures.transaction_headlines(w.table("fct_transactions"), w.saved("mart_revenue_monthly_by_segment_usd")),
    f"""SELECT {R('median(amount)')} AS median_ticket, {R(Q(N('', 'is_failed'), 'count(*)'))} AS failure_rate,
        (SELECT {R(S('total_revenue_usd'))} FROM mart_revenue_monthly_by_segment_usd) AS total_revenue_usd
        FROM fct_transactions WHERE currency = 'USD' AND amount IS NOT NULL""",
)
register(
    "kpi4_risk_headlines",
    lambda w: measures.risk_headlines(w.table("int_customer_risk_profile")),
    f"""SELECT {R('avg(credit_score)')} AS avg_credit_score,
        {R(Q(N('', 'is_delinquent_customer'), N('', 'loans_count > 0')))} AS delinquency_rate,
        {R(Q(N('', 'is_default_customer'), N('', 'loans_count > 0')))} AS default_rate,
        {R(A('utilization_pct'))} AS avg_utilization_pct FROM int_customer_risk_profile""",
)
register(
    "kpi5_last_complete_month",
    lambda w: measures.last_complete_month(w.table("mart_acquisition_trend"), w.as_of),
    f"""SELECT month_label, new_customers, mom_growth_pct FROM mart_acquisition_trend
        WHERE month < {MONTH0} ORDER BY month DESC LIMIT 1""",
)
register(
    "kpi6_adoption_headlines",
    lambda w: measures.adoption_headlines(*w.tables("dim_customer", "dim_digital_engagement")),
    f"""SELECT {R(Q(N('', 'mobile_app_registered OR web_banking_registered'), 'count(*)'))} AS digital_adoption_rate,
        {R(Q(N('', "kyc_status = 'verified'"), 'count(*)'))} AS kyc_verified_rate,
        {R('avg(avg_monthly_logins)')} AS avg_monthly_logins
        FROM dim_customer LEFT JOIN dim_digital_engagement USING (customer_id)""",
)
