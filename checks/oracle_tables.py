"""Every table of the model graph as DuckDB SQL over the given tables.

Written on its own from the key arithmetic of the derived documents; nothing here reads
what the Spark plans produce.
"""

from __future__ import annotations

import re

from finmart.sources import seeds

AS_OF = "DATE '2001-12-31'"
MONTH0 = "DATE '2001-12-01'"


def pick(values: list, index: str) -> str:
    shown = ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{shown}])[({index}) % {len(values)} + 1]"


def spelled(day: str, n: str) -> str:
    formats = ["%Y-%m-%d", "%Y%m%d", "%d/%m/%Y", "%m-%d-%Y"]
    arms = " ".join(f"WHEN {i} THEN strftime({day}, '{f}')" for i, f in enumerate(formats))
    return f"CASE ({n}) % 4 {arms} END"


def parsed_date(text: str) -> str:
    shapes = {
        r"\d{4}-\d{2}-\d{2}": "%Y-%m-%d", r"\d{8}": "%Y%m%d",
        r"\d{2}/\d{2}/\d{4}": "%d/%m/%Y", r"\d{2}-\d{2}-\d{4}": "%m-%d-%Y",
    }
    arms = " ".join(
        f"WHEN regexp_full_match({text}, '{p}') THEN CAST(try_strptime({text}, '{f}') AS DATE)"
        for p, f in shapes.items()
    )
    return f"CASE {arms} END"


def months(later: str, earlier: str) -> str:
    def forward(a: str, b: str) -> str:
        return (f"((year({a}) - year({b})) * 12 + month({a}) - month({b})"
                f" - CASE WHEN day({a}) < day({b}) THEN 1 ELSE 0 END)")

    return f"CASE WHEN {later} >= {earlier} THEN {forward(later, earlier)} ELSE -{forward(earlier, later)} END"


def boolean(text: str) -> str:
    return (f"CASE WHEN lower(trim({text})) IN ('true','t','yes','y','sí','si','1') THEN true "
            f"WHEN lower(trim({text})) IN ('false','f','no','n','0') THEN false END")


def mapped(text: str, **pairs: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE lower(trim({text})) {arms} ELSE lower(trim({text})) END"


def no_marker(text: str) -> str:
    return f"CASE WHEN lower(trim({text})) NOT IN ('', 'na', 'null', 'n/a') THEN lower(trim({text})) END"


def S(x: str, where: str = "") -> str:
    tail = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(printf('%.14e', fsum({x}){tail}) AS DOUBLE)"


def A(x: str, where: str = "") -> str:
    tail = f" FILTER (WHERE {where})" if where else ""
    return f"({S(x, where)} / nullif(count({x}){tail}, 0))"


def R(x: str, places: int | None = None) -> str:
    """Round half away from zero on the printed value, as a double; six places, three from 1e8 on."""
    if places is None:
        return f"CASE WHEN abs({x}) >= 1e8 THEN {R(x, 3)} ELSE {R(x, 6)} END"
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def N(x: str, where: str = "") -> str:
    return f"count(*) FILTER (WHERE {where})" if where else f"CAST({x} AS BIGINT)"


def Q(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


SEG = "CASE c_mktsegment WHEN 'FURNITURE' THEN 'Retail' WHEN 'BUILDING' THEN 'PYME' " \
      "WHEN 'AUTOMOBILE' THEN 'banca_privada' WHEN 'MACHINERY' THEN 'PREMIUM' " \
      "WHEN 'HOUSEHOLD' THEN ' minorista ' END"
KYC = pick(["verified", "PENDING", " Expired", "REJECTED"], "k")
STATUS = pick(["Activo", "INACTIVE", "suspendido", "Closed"], "k // 4")
COUNTRIES = ["CO", "UY", "AR", "MX", "CL", "PE", "BR"]
CURRENCIES = ["COP", "UYU", "ARS", "MXN", "CLP", "PEN", "BRL"]
BOOLS = ["true", "false", "Y", "N", "si", "1", "0", "maybe"]

#: Order keys and line numbers of one document, as the derived documents have them.
ORDER_BLOCK, LINE_BLOCK = 10_000, 1_000

T: dict[str, str] = {}

T["blocks"] = f"""
SELECT o_custkey, o_orderkey // {ORDER_BLOCK} AS order_block, 0 AS line_block FROM orders
UNION SELECT o_custkey, l_orderkey // {ORDER_BLOCK}, l_linenumber // {LINE_BLOCK} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

T["docs"] = f"""
SELECT c.*, coalesce(order_block, 0) AS order_block, coalesce(line_block, 0) AS line_block, slot, k * 4 + slot AS bronze_id,
  CASE WHEN slot = 2 THEN 'load-0002' ELSE 'load-0001' END AS load_id,
  CASE WHEN slot = 2 THEN '2001-12-15 06:00:00' ELSE '2001-11-30 06:00:00' END AS loaded,
  'CUST-' || lpad(CAST(k AS VARCHAR), CAST(greatest(7, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS customer_id,
  {pick(COUNTRIES, 'c_nationkey')} AS country,
  {spelled("DATE '1930-01-01' + CAST(k * 7919 % 20200 AS INTEGER)", 'k')} AS date_of_birth,
  {spelled("DATE '1996-01-01' + CAST(k * 733 % 2170 AS INTEGER)", 'k // 4')} AS registration_date,
  CASE WHEN slot = 1 THEN upper({KYC}) ELSE {KYC} END AS kyc_status,
  CASE WHEN slot = 1 THEN upper({SEG}) ELSE {SEG} END AS customer_segment,
  CASE slot WHEN 2 THEN 'Closed' WHEN 1 THEN lower({STATUS}) ELSE {STATUS} END AS status,
  ((k * 13) % 2000 - 950) / 1e1 AS lat, ((k * 29) % 3800 - 1850) / 1e1 AS lon,
  (k * 37) % 10001 / 1e2 AS risk_score,
  CASE WHEN k % 20 = 0 THEN 999999 WHEN k % 20 = 10 THEN -99 ELSE 300 + (k * 53) % 551 END AS credit_score,
  CASE k % 50 WHEN 1 THEN '$78.26' WHEN 2 THEN '89.5 USD' WHEN 3 THEN '83,5' WHEN 4 THEN '120.0'
    ELSE CAST(((k * 7) % 1001) / 1e1 AS VARCHAR) END AS utilization_text,
  {pick(BOOLS, 'k')} AS mobile_text, {pick(BOOLS, 'k + 1')} AS web_text,
  {pick(BOOLS, 'k + 2')} AS push_text, {pick(BOOLS, 'k + 3')} AS paperless_text,
  {spelled("DATE '2001-06-01' + CAST(k % 180 AS INTEGER)", 'k')} AS last_login_date,
  CASE WHEN k % 13 = 0 THEN 'N/A' ELSE CAST(k % 60 AS VARCHAR) END AS logins_text,
  {pick(['mobile', 'ATM', 'branch', 'Phone', 'web'], 'k')} AS preferred_text
FROM (SELECT c_custkey AS k, c_nationkey, c_mktsegment FROM customer) c LEFT JOIN blocks ON o_custkey = k, (VALUES (0), (1), (2)) s(slot)
WHERE slot = 0 OR (slot = 1 AND k % 75 = 0) OR (slot = 2 AND k % 50 = 0)"""

T["acct"] = f"""
SELECT o_orderkey AS o, o_custkey, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day, o_orderstatus,
  o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE {pick(CURRENCIES, 'c_nationkey')} END AS ccy
FROM orders JOIN customer ON c_custkey = o_custkey"""

T["all_accounts"] = f"""
SELECT customer_id, 'ACC-' || o AS account_id,
  {pick(['savings', 'credit_card', 'CHECKING', 'investment'], 'o')} AS account_type, ccy AS currency,
  CASE WHEN o % 33 <> 0 THEN price END AS balance,
  CASE WHEN o % 4 = 1 THEN price * 2 END AS credit_limit, (o % 50) / 1e1 AS interest_rate,
  {spelled('day', 'o')} AS opened_date,
  CASE o_orderstatus WHEN 'F' THEN 'FROZEN' WHEN 'O' THEN 'activo' WHEN 'P' THEN 'Cerrado' END AS status,
  'BR-' || (o % 500) AS branch_code, bronze_id, loaded, order_block, line_block
FROM acct JOIN docs ON o_custkey = k AND order_block = o // {ORDER_BLOCK} AND line_block = 0"""

T["all_loans"] = f"""
SELECT customer_id, 'LN-' || o AS loan_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Personal' WHEN '2-HIGH' THEN 'MORTGAGE' WHEN '3-MEDIUM' THEN 'auto'
    WHEN '4-NOT SPECIFIED' THEN 'Education' WHEN '5-LOW' THEN 'business' END AS loan_type,
  ccy AS currency, price AS principal,
  CASE WHEN o % 35 <> 0 THEN price * ((o * 17) % 100) / 1e2 END AS outstanding_balance,
  3 + (o % 320) / 1e1 AS interest_rate, CAST(12 * (1 + o % 10) AS INTEGER) AS term_months,
  price / (12 * (1 + o % 10)) AS monthly_payment,
  {spelled('day', 'o // 3')} AS start_date,
  {spelled('CAST(day + to_months(CAST(12 * (1 + o % 10) AS INTEGER)) AS DATE)', 'o // 3')} AS end_date,
  {pick(['CURRENT', 'delinquent', 'Default', 'paid_off'], 'o // 24')} AS status,
  {pick([0, 0, 0, 15, 45, 75, 120, 200], 'o // 3')} AS days_past_due,
  {pick(['none', 'Vehicle', 'N/A', 'real_estate'], 'o')} AS collateral_type, bronze_id, loaded, order_block, line_block
FROM acct JOIN docs ON o_custkey = k AND order_block = o // {ORDER_BLOCK} AND line_block = 0 WHERE o % 3 = 0"""

T["all_transactions"] = f"""
SELECT customer_id, 'TX-' || l_orderkey || '-' || l_linenumber AS transaction_id,
  'ACC-' || CASE WHEN l_suppkey % 11 = 0 THEN l_orderkey // 2 ELSE l_orderkey END AS account_id,
  {spelled('CAST(l_shipdate AS DATE)', 'l_partkey')} AS transaction_date,
  CASE WHEN l_partkey % 33 <> 0 THEN l_extendedprice END AS amount, l_extendedprice AS amount_recovered,
  CASE WHEN l_suppkey % 50 = 0 THEN 'EUR' WHEN l_suppkey % 7 = 0 THEN 'MXN' ELSE ccy END AS currency,
  {pick(['DEPOSIT', 'retiro', 'Transferencia', 'payment', 'reembolso', 'COMISION'], 'l_partkey')} AS transaction_type,
  CASE WHEN l_partkey % 25 = 0 THEN {pick([None, 'NA', 'N/A', 'null'], 'l_partkey // 25')} ELSE p_type END AS category,
  CASE WHEN l_partkey % 12 <> 0 THEN p_brand END AS merchant,
  {pick(['mobile', 'WEB', 'atm', 'branch', 'pos'], 'l_suppkey')} AS channel,
  {pick(['completed', 'PENDING', 'failed', 'Reversed'], 'l_partkey // 6 + l_linenumber')} AS status,
  'qty ' || CAST(l_quantity AS INTEGER) AS description, bronze_id, loaded, order_block, line_block
FROM lineitem JOIN acct ON l_orderkey = o JOIN docs ON o_custkey = k AND order_block = l_orderkey // {ORDER_BLOCK}
  AND line_block = l_linenumber // {LINE_BLOCK} LEFT JOIN part ON l_partkey = p_partkey"""


def latest(table: str, key: str, rest: str) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in rest.split())
    return (f"SELECT * EXCLUDE (rn, order_block, line_block) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY loaded DESC, bronze_id DESC, {order}) AS rn FROM {table}) WHERE rn = 1")


T["raw_accounts"] = latest(
    "all_accounts", "account_id",
    "customer_id account_type currency balance credit_limit interest_rate opened_date status branch_code")
T["raw_loans"] = latest(
    "all_loans", "loan_id",
    "customer_id loan_type currency principal outstanding_balance interest_rate term_months monthly_payment "
    "start_date end_date status days_past_due collateral_type")
T["raw_transactions"] = latest(
    "all_transactions", "transaction_id",
    "customer_id account_id transaction_date amount currency transaction_type category merchant channel "
    "status description")
T["latest_docs"] = "SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY k ORDER BY loaded DESC, bronze_id DESC) = 1"

T["stg_accounts"] = f"""
SELECT account_id, customer_id, lower(account_type) AS account_type, currency, balance, credit_limit, interest_rate,
  {parsed_date('opened_date')} AS opened_date,
  {mapped('status', activo='active', congelado='frozen', cerrado='closed')} AS status, branch_code, bronze_id, loaded
FROM raw_accounts"""
T["stg_transactions"] = f"""
SELECT transaction_id, customer_id, account_id, {parsed_date('transaction_date')} AS transaction_date, amount, currency,
  {mapped('transaction_type', deposito='deposit', retiro='withdrawal', transferencia='transfer', pago='payment',
          reembolso='refund', comision='fee')} AS transaction_type,
  {no_marker('category')} AS category, merchant, lower(channel) AS channel, lower(status) AS status,
  description, bronze_id, loaded
FROM raw_transactions"""
T["stg_loans"] = f"""
SELECT loan_id, customer_id, lower(loan_type) AS loan_type, currency, principal, outstanding_balance, interest_rate,
  term_months, monthly_payment, {parsed_date('start_date')} AS start_date, {parsed_date('end_date')} AS end_date,
  lower(status) AS status, days_past_due, {no_marker('collateral_type')} AS collateral_type, bronze_id, loaded
FROM raw_loans"""

T["dim_customer"] = f"""
SELECT *, CAST(trunc(age_months / 1e0 / 12) AS INTEGER) AS age,
  CASE WHEN age_months IS NULL THEN 'unknown' WHEN age_months < 18 * 12 THEN 'under_18' WHEN age_months < 26 * 12 THEN '18-25'
    WHEN age_months < 36 * 12 THEN '26-35' WHEN age_months < 51 * 12 THEN '36-50' WHEN age_months < 66 * 12 THEN '51-65'
    ELSE '65+' END AS age_bucket,
  CASE WHEN tenure_months IS NULL THEN 'unknown' WHEN tenure_months < 6 THEN 'new'
    WHEN tenure_months <= 24 THEN 'established' ELSE 'loyal' END AS tenure_bucket
FROM (
  SELECT *, CAST({months(AS_OF, 'date_of_birth')} AS INTEGER) AS age_months,
    CAST({months(AS_OF, 'registration_date')} AS INTEGER) AS tenure_months
  FROM (
    SELECT customer_id, 'Name' || (k % 100) AS first_name, 'Family' || (k % 997) AS last_name,
      'user' || k || '@example.com' AS email, '+000' || k AS phone_number,
      {parsed_date('date_of_birth')} AS date_of_birth, {pick(['F', 'm'], 'k')} AS gender,
      country AS nationality, 'City_' || c_nationkey AS city, country, k || ' Main St' AS address,
      abs(lat) <= 90 AND abs(lon) <= 180 AS is_geo_valid,
      CASE WHEN abs(lat) <= 90 AND abs(lon) <= 180 THEN lat END AS lat,
      CASE WHEN abs(lat) <= 90 AND abs(lon) <= 180 THEN lon END AS lon,
      {parsed_date('registration_date')} AS registration_date, lower(trim(kyc_status)) AS kyc_status, risk_score,
      {mapped('customer_segment', minorista='retail', banca_privada='private_banking', pyme='sme')} AS customer_segment,
      'RM-' || (k % 20) AS relationship_manager,
      {mapped('status', activo='active', inactivo='inactive', suspendido='suspended', cerrado='closed')} AS status
    FROM latest_docs))"""
T["dim_credit_info"] = f"""
SELECT customer_id, CAST(credit_score AS INTEGER) AS credit_score_raw,
  credit_score BETWEEN 300 AND 850 AS is_credit_score_valid,
  CAST(CASE WHEN credit_score BETWEEN 300 AND 850 THEN credit_score END AS INTEGER) AS credit_score,
  {pick(CURRENCIES, 'c_nationkey')} AS currency, u AS utilization_pct_raw,
  coalesce(u BETWEEN 0 AND 100, false) AS is_utilization_pct_valid,
  CASE WHEN u BETWEEN 0 AND 100 THEN u END AS utilization_pct,
  CAST(1000 * (1 + k % 50) AS DOUBLE) AS total_limit, CAST(10 * (k % 400) AS DOUBLE) AS total_used,
  CAST(k % 9 AS INTEGER) AS num_credit_accounts, CAST(k % 240 AS INTEGER) AS oldest_account_age_months,
  CAST(k % 6 AS INTEGER) AS late_payments_12m, CAST(k % 4 AS INTEGER) AS inquiries_6m,
  k % 40 = 0 AS bankruptcy_flag
FROM (SELECT *, CASE WHEN regexp_full_match(utilization_text, '-?[0-9]+\\.?[0-9]*')
        THEN CAST(utilization_text AS DOUBLE) END AS u FROM latest_docs)"""
T["dim_digital_engagement"] = f"""
SELECT customer_id, {boolean('mobile_text')} AS mobile_app_registered, {boolean('web_text')} AS web_banking_registered,
  {parsed_date('last_login_date')} AS last_login_date, TRY_CAST(logins_text AS INTEGER) AS avg_monthly_logins,
  lower(preferred_text) AS preferred_channel, {boolean('push_text')} AS push_notifications,
  {boolean('paperless_text')} AS paperless_statements
FROM latest_docs"""
T["dim_account"] = f"""
SELECT * EXCLUDE (bronze_id, loaded), CAST({months(AS_OF, 'opened_date')} AS INTEGER) AS account_age_months
FROM stg_accounts"""
T["dim_loan"] = f"""
SELECT * EXCLUDE (bronze_id, loaded), CAST({months(AS_OF, 'start_date')} AS INTEGER) AS loan_age_months,
  CAST({months('end_date', AS_OF)} AS INTEGER) AS remaining_term_months,
  principal - outstanding_balance AS principal_repaid,
  (principal - outstanding_balance) / nullif(principal, 0) * 100 AS principal_repaid_pct
FROM stg_loans"""
T["dim_geography"] = f"""
SELECT * FROM (VALUES {', '.join(map(str, seeds.COUNTRIES))}) AS g(country_code, country_name, region, default_currency)"""
T["country_currency"] = "SELECT country_code, default_currency AS currency_code FROM dim_geography"
T["fx_rates"] = f"""
SELECT currency, CAST(rate AS DOUBLE) AS rate, CAST(rate AS DECIMAL(18,8)) AS rate_to_usd,
  DATE '{seeds.FX_QUOTED_ON}' AS as_of_date
FROM (VALUES {', '.join(map(str, seeds.FX_RATES))}) f(currency, rate)"""
CALENDAR = """
SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week_num, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
  strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_name_short, dayofweek(d) IN (0, 6) AS is_weekend,
  CAST(year(d) * 100 + month(d) AS INTEGER) AS year_month_key,
  CAST(year(d) * 10 + quarter(d) AS INTEGER) AS year_quarter_key,
  strftime(d, '%Y-%m') AS year_month_label, 'Q' || quarter(d) || ' ' || year(d) AS year_quarter_label,
  CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(date_trunc('month', d) AS DATE) AS month_start,
  CAST(date_trunc('quarter', d) AS DATE) AS quarter_start, CAST(date_trunc('year', d) AS DATE) AS year_start
FROM (SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS d)"""
T["dim_date"] = CALENDAR.format(first="DATE '2015-01-01'", last="DATE '2030-12-31'")
T["calendar_days"] = CALENDAR.format(first="(SELECT min(transaction_date) FROM fct_transactions)",
                                     last="(SELECT max(transaction_date) FROM fct_transactions)")
T["fct_transactions"] = """
SELECT *, status = 'failed' AS is_failed, CAST(dayofweek(transaction_date) AS INTEGER) AS day_of_week
FROM stg_transactions"""
T["fct_loans"] = "SELECT *, interest_rate / 1e2 AS interest_rate_decimal FROM stg_loans"
T["agg_customer_activity"] = """
SELECT customer_id, coalesce(a, 0) AS accounts_count, coalesce(t, 0) AS transactions_count,
  coalesce(l, 0) AS loans_count, coalesce(a, 0) + coalesce(l, 0) AS total_products
FROM (SELECT customer_id FROM dim_customer)
LEFT JOIN (SELECT customer_id, count(*) AS a FROM stg_accounts GROUP BY 1) USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS t FROM stg_transactions GROUP BY 1) USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS l FROM stg_loans GROUP BY 1) USING (customer_id)"""

T["int_loan_portfolio_metrics"] = """
SELECT *, days_past_due >= 30 AS is_delinquent, days_past_due >= 90 OR status = 'default' AS is_default,
  CASE WHEN days_past_due = 0 THEN '00 - Current' WHEN days_past_due < 30 THEN '01 - Early (1-29)'
    WHEN days_past_due < 60 THEN '02 - 30-59 DPD' WHEN days_past_due < 90 THEN '03 - 60-89 DPD'
    WHEN days_past_due < 180 THEN '04 - 90-179 DPD' ELSE '05 - 180+ DPD' END AS dpd_bucket,
  CASE WHEN status IN ('current', 'delinquent')
    THEN coalesce(outstanding_balance * interest_rate_decimal / 12, 0) ELSE 0 END AS monthly_interest_accrued
FROM fct_loans"""


def risk_band(x: str) -> str:
    return (f"CASE WHEN {x} < 0 OR {x} > 100 OR {x} IS NULL THEN 'unknown' WHEN {x} > 85 THEN 'critical' "
            f"WHEN {x} > 60 THEN 'high' WHEN {x} > 30 THEN 'medium' ELSE 'low' END")


def score_band(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} < 300 OR {x} > 850 THEN 'unknown' WHEN {x} >= 800 THEN 'exceptional' "
            f"WHEN {x} >= 740 THEN 'very_good' WHEN {x} >= 670 THEN 'good' WHEN {x} >= 580 THEN 'fair' ELSE 'poor' END")


def utilization_band(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} > 100 THEN 'over_limit' WHEN {x} >= 90 THEN 'maxed' "
            f"WHEN {x} >= 60 THEN 'high' WHEN {x} >= 30 THEN 'moderate' ELSE 'healthy' END")


BUCKETS = f"""{risk_band('risk_score')} AS risk_bucket, credit_score, {score_band('credit_score')} AS credit_score_bucket,
  utilization_pct, {utilization_band('utilization_pct')} AS utilization_bucket, total_limit, total_used,
  late_payments_12m, bankruptcy_flag"""

T["int_customer_risk_profile"] = f"""
SELECT customer_id, country, customer_segment, kyc_status, status, risk_score, {BUCKETS},
  coalesce(d > 0, false) AS is_delinquent_customer, coalesce(f > 0, false) AS is_default_customer,
  coalesce(n, 0) AS loans_count, coalesce(d, 0) AS delinquent_loans_count, coalesce(f, 0) AS default_loans_count
FROM dim_customer JOIN (SELECT * EXCLUDE (currency) FROM dim_credit_info) USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS n, count(*) FILTER (WHERE is_delinquent) AS d,
             count(*) FILTER (WHERE is_default) AS f FROM int_loan_portfolio_metrics GROUP BY 1) USING (customer_id)
WHERE risk_score IS NOT NULL"""
T["fees_usd"] = f"""
SELECT customer_id, {S('amount')} AS fees_native, {S('amount * rate')} AS fees_usd
FROM fct_transactions LEFT JOIN fx_rates USING (currency)
WHERE transaction_type = 'fee' AND status = 'completed' GROUP BY customer_id"""
T["interest_usd"] = f"""
SELECT customer_id, {S('outstanding_balance * interest_rate_decimal / 12')} AS interest_native,
  {S('outstanding_balance * interest_rate_decimal / 12 * rate')} AS interest_usd
FROM fct_loans LEFT JOIN fx_rates USING (currency)
WHERE status IN ('current', 'delinquent') GROUP BY customer_id"""
T["int_customer_monthly_revenue"] = f"""
SELECT *, monthly_fee_revenue_native + monthly_interest_revenue_native AS total_monthly_revenue_native,
  monthly_fee_revenue_usd + monthly_interest_revenue_usd AS total_monthly_revenue_usd
FROM (
  SELECT customer_id, coalesce({R('fees_native', 2)}, 0) AS total_fees_paid_lifetime_native,
    coalesce(fees_usd, 0) AS total_fees_paid_lifetime_usd,
    coalesce({R('(fees_native / nullif(tenure_months, 0))', 2)}, 0) AS monthly_fee_revenue_native,
    coalesce(fees_usd / nullif(tenure_months, 0), 0) AS monthly_fee_revenue_usd,
    coalesce({R('interest_native', 2)}, 0) AS monthly_interest_revenue_native,
    coalesce(interest_usd, 0) AS monthly_interest_revenue_usd
  FROM dim_customer LEFT JOIN fees_usd USING (customer_id) LEFT JOIN interest_usd USING (customer_id))"""

T["mart_customer_360"] = f"""
SELECT * EXCLUDE (lifetime, income), lifetime AS total_fees_paid_lifetime,
  {R('(lifetime / greatest(tenure_months, 3))', 2)} AS monthly_fee_revenue, income AS monthly_interest_income,
  {R('(lifetime / greatest(tenure_months, 3))', 2)} + income AS total_revenue_monthly
FROM (
  SELECT customer_id, country, city, gender, age, age_bucket, customer_segment, tenure_months, tenure_bucket,
    kyc_status, status, risk_score, {BUCKETS}, mobile_app_registered, web_banking_registered,
    accounts_count, loans_count, transactions_count, total_products,
    coalesce({R('fees', 2)}, 0) AS lifetime, coalesce({R('interest_native', 2)}, 0) AS income
  FROM dim_customer JOIN (SELECT * EXCLUDE (currency) FROM dim_credit_info) USING (customer_id)
  JOIN dim_digital_engagement USING (customer_id) JOIN agg_customer_activity USING (customer_id)
  LEFT JOIN (SELECT a.customer_id, {S('amount')} AS fees FROM fct_transactions t
             JOIN dim_account a USING (account_id)
             WHERE transaction_type = 'fee' AND t.status = 'completed' GROUP BY 1) USING (customer_id)
  LEFT JOIN interest_usd USING (customer_id)
  WHERE risk_score IS NOT NULL)"""
T["mart_acquisition_trend"] = f"""
SELECT month, CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month_number,
  strftime(month, '%Y-%m') AS month_label, new_customers,
  CAST(sum(new_customers) OVER (ORDER BY month) AS BIGINT) AS cumulative_customers,
  {R(f"(({Q('new_customers - prior', 'prior')}) * 100)", 2)} AS mom_growth_pct
FROM (SELECT *, lag(new_customers) OVER (ORDER BY month) AS prior FROM (
  SELECT CAST(date_trunc('month', registration_date) AS DATE) AS month, count(DISTINCT customer_id) AS new_customers
  FROM dim_customer WHERE registration_date IS NOT NULL GROUP BY 1))"""
T["mart_revenue_by_segment_usd"] = f"""
SELECT customer_segment, count(*) AS customer_count, {S('fee + interest')} AS total_revenue_usd,
  {A('fee + interest')} AS avg_revenue_per_customer_usd, {S('fee')} AS total_fee_revenue_usd,
  {S('interest')} AS total_interest_revenue_usd, {A('fee')} AS avg_fee_revenue_per_customer_usd,
  {A('interest')} AS avg_interest_revenue_per_customer_usd,
  {S('fee')} / nullif({S('fee + interest')}, 0) AS fee_revenue_share
FROM (SELECT customer_segment, coalesce(fees_usd / greatest(tenure_months, 3), 0) AS fee,
        coalesce(interest_usd, 0) AS interest
      FROM dim_customer LEFT JOIN fees_usd USING (customer_id) LEFT JOIN interest_usd USING (customer_id))
GROUP BY 1"""
T["mart_revenue_monthly_by_segment_usd"] = f"""
SELECT revenue_month, customer_segment, {R('coalesce(fee, 0)', 2)} AS fee_revenue_usd,
  {R('coalesce(interest, 0)', 2)} AS interest_revenue_usd,
  {R('(coalesce(fee, 0) + coalesce(interest, 0))', 2)} AS total_revenue_usd
FROM (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS revenue_month, customer_segment,
    {S('amount * rate')} AS fee
  FROM fct_transactions JOIN (SELECT customer_id, customer_segment FROM dim_customer) USING (customer_id)
  LEFT JOIN fx_rates USING (currency)
  WHERE transaction_type = 'fee' AND status = 'completed' AND transaction_date < {MONTH0} GROUP BY 1, 2)
FULL JOIN (
  SELECT m AS revenue_month, customer_segment,
    {S('outstanding_balance * interest_rate_decimal / 12 * rate')} AS interest
  FROM fct_loans JOIN (SELECT customer_id, customer_segment FROM dim_customer) USING (customer_id)
  LEFT JOIN fx_rates USING (currency)
  JOIN (SELECT DISTINCT CAST(date_trunc('month', transaction_date) AS DATE) AS m FROM fct_transactions
        WHERE transaction_date < {MONTH0}) ON m >= date_trunc('month', start_date)
  WHERE status IN ('current', 'delinquent') AND outstanding_balance IS NOT NULL GROUP BY 1, 2)
USING (revenue_month, customer_segment)"""
T["mart_account_mix"] = f"""
SELECT *, {R('(accounts_count * 1e2 / sum(accounts_count) OVER (PARTITION BY country))', 2)} AS pct_of_country_accounts,
  {R('(accounts_count * 1e2 / sum(accounts_count) OVER ())', 2)} AS pct_of_total_accounts
FROM (
  SELECT country, account_type, a.currency, count(DISTINCT account_id) AS accounts_count,
    count(DISTINCT account_id) FILTER (WHERE balance IS NOT NULL) AS accounts_with_balance,
    {R(S('balance'), 2)} AS total_balance, {R(A('balance'), 2)} AS avg_balance,
    {R('min(balance)', 2)} AS min_balance, {R('max(balance)', 2)} AS max_balance
  FROM dim_account a JOIN dim_customer c USING (customer_id) WHERE a.status = 'active' GROUP BY 1, 2, 3)"""

LOANED, BAD, DEF = (N("", "loans_count > 0"), N("", "is_delinquent_customer"), N("", "is_default_customer"))
RATES = f"{Q(BAD, LOANED)} AS delinquency_rate, {Q(DEF, LOANED)} AS default_rate"
T["mart_delinquency_by_segment"] = f"""
SELECT customer_segment, count(*) AS customer_count, {LOANED} AS customers_with_loans,
  {N('', 'loans_count = 0')} AS customers_without_loans, {BAD} AS delinquent_customers, {DEF} AS default_customers,
  {RATES} FROM int_customer_risk_profile GROUP BY 1"""
T["mart_credit_score_by_country"] = f"""
SELECT *, {Q('customer_count', 'sum(customer_count) OVER (PARTITION BY country)')} AS bucket_share_within_country
FROM (SELECT country, credit_score_bucket, count(*) AS customer_count, avg(credit_score) AS avg_credit_score
      FROM int_customer_risk_profile GROUP BY 1, 2)"""
T["mart_utilization_vs_delinquency"] = f"""
SELECT utilization_bucket, count(*) AS customer_count, {LOANED} AS customers_with_loans,
  {BAD} AS delinquent_customers, {DEF} AS default_customers, {RATES},
  {A('utilization_pct')} AS avg_utilization_pct, avg(credit_score) AS avg_credit_score
FROM int_customer_risk_profile GROUP BY 1"""
T["mart_risk_buckets"] = f"""
SELECT *, {Q('customer_count', 'sum(customer_count) OVER ()')} AS bucket_share
FROM (SELECT risk_bucket, count(*) AS customer_count, {A('risk_score')} AS avg_risk_score,
        {LOANED} AS customers_with_loans, {RATES}, avg(credit_score) AS avg_credit_score,
        {A('utilization_pct')} AS avg_utilization_pct FROM int_customer_risk_profile GROUP BY 1)"""
T["mart_loan_dpd"] = f"""
SELECT *, {Q('loan_count', 'sum(loan_count) OVER (PARTITION BY loan_type, currency)')} AS bucket_share_within_type_currency
FROM (SELECT loan_type, dpd_bucket, currency, count(*) AS loan_count,
        {S('outstanding_balance')} AS total_outstanding_balance, {A('outstanding_balance')} AS avg_outstanding_balance,
        avg(days_past_due) AS avg_days_past_due
      FROM int_loan_portfolio_metrics WHERE outstanding_balance IS NOT NULL GROUP BY 1, 2, 3)"""
T["mart_loan_composition"] = f"""
SELECT *, {Q('total_outstanding_balance', 'sum(total_outstanding_balance) OVER (PARTITION BY loan_type, currency)')}
    AS outstanding_share_within_type_currency
FROM (SELECT loan_type, status, currency, count(*) AS loan_count, {S('principal')} AS total_principal,
        {S('outstanding_balance')} AS total_outstanding_balance, {A('outstanding_balance')} AS avg_outstanding_balance,
        {A('interest_rate_decimal')} AS avg_interest_rate,
        {S('monthly_interest_accrued')} AS total_monthly_interest_accrued,
        {N('', 'is_delinquent')} AS delinquent_count, {N('', 'is_default')} AS default_count
      FROM int_loan_portfolio_metrics GROUP BY 1, 2, 3)"""

DONE = "status = 'completed'"
TX = f"""count(*) AS tx_count, {N('', DONE)} AS completed_tx_count, {S('amount', DONE)} AS total_value,
  {A('amount', DONE)} AS avg_ticket"""
T["mart_tx_by_channel"] = f"""
SELECT channel, currency, {TX}, {N('', 'is_failed')} AS failed_tx_count, {Q(N('', 'is_failed'), 'count(*)')} AS failed_rate
FROM fct_transactions WHERE amount IS NOT NULL GROUP BY 1, 2"""
T["mart_tx_by_category"] = f"""
SELECT category, currency, {TX} FROM fct_transactions WHERE amount IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2"""
T["mart_tx_by_dow"] = f"""
SELECT day_of_week, dayname(max(transaction_date)) AS day_of_week_name, currency, {TX}
FROM fct_transactions WHERE amount IS NOT NULL GROUP BY day_of_week, currency"""
ABROAD_DONE = "abroad AND status = 'completed'"
T["mart_international_transfers"] = f"""
SELECT country AS origin_country, tx_currency, count(*) AS tx_count, {N('', 'abroad')} AS international_tx_count,
  {N('', 'NOT abroad')} AS domestic_tx_count, {N('', DONE)} AS completed_tx_count,
  {N('', ABROAD_DONE)} AS completed_international_tx_count, {Q(N('', 'abroad'), 'count(*)')} AS international_share,
  {S('amount', DONE)} AS total_value, {S('amount', ABROAD_DONE)} AS total_international_value,
  {A('amount', DONE)} AS avg_ticket, {A('amount', ABROAD_DONE)} AS avg_international_ticket
FROM (SELECT country, t.currency AS tx_currency, amount, t.status,
        coalesce(t.currency NOT IN (a.currency, currency_code), false) AS abroad
      FROM fct_transactions t JOIN dim_account a USING (account_id)
      JOIN dim_customer c ON c.customer_id = t.customer_id LEFT JOIN country_currency ON country_code = country
      WHERE transaction_type = 'transfer' AND amount IS NOT NULL) GROUP BY 1, 2"""
T["mart_top_merchants"] = f"""
SELECT *, row_number() OVER (PARTITION BY currency ORDER BY total_value DESC NULLS FIRST, merchant)
    AS rank_by_value_within_currency,
  row_number() OVER (PARTITION BY currency ORDER BY tx_count DESC, merchant) AS rank_by_count_within_currency
FROM (SELECT merchant, currency, count(*) AS tx_count, {R(S('amount'), 2)} AS total_value,
        {R(A('amount'), 2)} AS avg_ticket, {R('min(amount)', 2)} AS min_ticket, {R('max(amount)', 2)} AS max_ticket
      FROM fct_transactions WHERE {DONE} AND merchant IS NOT NULL GROUP BY 1, 2)
LEFT JOIN (SELECT merchant, currency, category AS top_category FROM fct_transactions
           WHERE {DONE} AND merchant IS NOT NULL GROUP BY 1, 2, 3
           QUALIFY row_number() OVER (PARTITION BY merchant, currency ORDER BY count(*) DESC, category NULLS LAST) = 1)
USING (merchant, currency)"""
T["mart_digital_adoption_by_segment"] = f"""
SELECT customer_segment, count(*) AS customer_count, {Q(N('', 'm'), 'count(*)')} AS mobile_adoption_rate,
  {Q(N('', 'w'), 'count(*)')} AS web_adoption_rate, {Q(N('', 'm OR w'), 'count(*)')} AS any_digital_adoption_rate,
  {Q(N('', 'push_notifications'), 'count(*)')} AS push_notifications_rate,
  {Q(N('', 'paperless_statements'), 'count(*)')} AS paperless_rate, avg(avg_monthly_logins) AS avg_monthly_logins
FROM (SELECT *, mobile_app_registered AS m, web_banking_registered AS w FROM dim_customer
      LEFT JOIN dim_digital_engagement USING (customer_id)) GROUP BY 1"""
T["mart_channel_preference_by_age"] = f"""
SELECT *, {Q('customer_count', 'sum(customer_count) OVER (PARTITION BY age_bucket)')} AS bucket_share_within_age
FROM (SELECT age_bucket, preferred_channel, count(*) AS customer_count FROM dim_customer
      LEFT JOIN dim_digital_engagement USING (customer_id) WHERE preferred_channel IS NOT NULL GROUP BY 1, 2)"""


def with_tables(select: str) -> str:
    """``select`` preceded by the definitions of the tables it uses, directly or not."""
    words = re.compile(r"\b[a-z_0-9]+\b")
    seen: set[str] = set()
    ordered: dict[str, str] = {}

    def visit(sql: str) -> None:
        for word in words.findall(sql):
            if word in T and word not in seen:
                seen.add(word)
                visit(T[word])
                ordered[word] = T[word]

    visit(select)
    definitions = ",\n".join(f"{name} AS ({sql})" for name, sql in ordered.items())
    return f"WITH {definitions}\n{select}" if definitions else select
