"""Data-quality, profiling and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.oracle_tables import A, AS_OF, N, Q, R
from checks.registry import register
from checks.relational import SEGMENT_PAIRS, _by_segments
from finmart.functions import text
from finmart.operators import flatten
from finmart.plans import profiling, reconcile
from finmart.plans.quality import CHECKS, TESTS, run_checks, tables_read
from finmart.plans.warehouse import Warehouse
from finmart.sources.store import TableStore

col = F.col

# --- quality ---------------------------------------------------------------------------

CHECKED = list(CHECKS)


def literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def check_sql(wanted: tuple[str, ...]) -> str:
    """One row per check with the number of failing rows or values."""
    parts: list[str] = []

    def add(table: str, test: str, column: str, severity: str, failures: str) -> None:
        if test in wanted:
            parts.append(f"SELECT '{table}' AS table_name, '{test}' AS test, {quoted(column)} AS column_name, "
                         f"'{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures")

    for table in CHECKED:
        checks = CHECKS[table]
        for severity, names in (("error", checks.not_null.split()), ("warn", checks.not_null_warn.split())):
            for name in names:
                add(table, "not_null", name, severity, f"SELECT count(*) - count({name}) FROM {table}")
        for name, accepted in checks.values.items():
            add(table, "accepted_values", name, "error",
                f"SELECT count(*) FROM {table} WHERE {name} NOT IN ({', '.join(map(literal, accepted))})")
        for name, rule in checks.all_rules():
            condition = rule.condition.replace("{as_of}", AS_OF)
            extra = f" AND ({rule.where})" if rule.where else ""
            add(table, "expression_is_true", name or rule.condition, rule.severity,
                f"SELECT count(*) FROM {table} WHERE NOT ({condition}){extra}")
        for name in checks.unique.split():
            add(table, "unique", name, "error",
                f"SELECT count(*) FROM (SELECT {name} FROM {table} GROUP BY 1 HAVING count({name}) > 1)")
        for name, (parent, key) in checks.references.items():
            add(table, "relationships", name, "error",
                f"SELECT count(*) FROM {table} c WHERE c.{name} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{key} = c.{name})")
    return " UNION ALL ".join(parts)


def run(w: Warehouse, *tests: str) -> DataFrame:
    w.prepare(tables_read(CHECKED, tests or TESTS))
    return run_checks(w.saved, CHECKED, tests or TESTS, AS_OF)


def checked(test: str):
    return lambda w: run(w, test)


for _number, _test in enumerate(("unique", "not_null", "accepted_values", "relationships", "expression_is_true"), 1):
    register(f"dq{_number}_{_test}", checked(_test), check_sql((_test,)))
EVERY = ("unique", "not_null", "accepted_values", "relationships", "expression_is_true")
register("dq6_failures_by_severity",
         lambda w: run(w).groupBy("severity").agg(
             F.count("*").alias("checks"), F.count_if(col("failures") > 0).alias("failing")),
         f"""SELECT severity, count(*) AS checks, count(*) FILTER (WHERE failures > 0) AS failing
             FROM ({check_sql(EVERY)}) GROUP BY 1""")
register("dq7_suite_report", lambda w: run(w), check_sql(EVERY))


def _counters(w: Warehouse) -> DataFrame:
    found = []
    for spec in (flatten.ACCOUNTS, flatten.TRANSACTIONS, flatten.LOANS):
        def save(df: DataFrame) -> DataFrame:
            return TableStore(w.spark, w.scratch(spec.array)).save(df, "silver_raw", spec.array)

        _, counters = flatten.stage_array(w.table("documents"), spec, save)
        found.append((spec.array, *counters.values()))
    return w.spark.createDataFrame(
        found, "array_name string, documents_read long, after_explode long, after_dedup long, dropped long")


register("dq8_run_counters", _counters, " UNION ALL ".join(
    f"""SELECT '{a}' AS array_name, (SELECT count(*) FROM docs) AS documents_read, count(*) AS after_explode,
        count(DISTINCT {key}) AS after_dedup, count(*) - count(DISTINCT {key}) AS dropped FROM all_{a}"""
    for a, key in (("accounts", "account_id"), ("transactions", "transaction_id"), ("loans", "loan_id"))))

# --- profiling -------------------------------------------------------------------------

AUDITED = ("category", "merchant", "channel")
register("prf1_null_audit",
         lambda w: profiling.null_audit(w.table("documents").select(F.inline("transactions")), list(AUDITED)),
         " UNION ALL ".join(
             f"""SELECT '{c}' AS column_name, n AS row_count, nulls, tokens AS null_tokens,
                 {R('((nulls + tokens) * 1e2 / n)', 2)} AS pct FROM (SELECT count(*) AS n,
                 count(*) FILTER (WHERE {c} IS NULL AND {missing}) AS nulls,
                 count(*) FILTER (WHERE {c} IN ('NA', 'N/A', 'null') OR ({c} IS NULL AND NOT {missing})) AS tokens
                 FROM all_transactions)"""
             for c, missing in (("category", "false"), ("merchant", "true"), ("channel", "true"))))
SHAPE_SQL = """CASE WHEN length({c}) = 8 THEN 'compact' WHEN {c}[3] = '/' THEN 'slash_dmy' WHEN {c}[3] = '-' THEN 'dash_mdy'
    ELSE 'iso' END"""
DATES = ("date_of_birth", "registration_date")
register("prf2_date_format_census", lambda w: profiling.date_format_census(w.table("documents"), list(DATES)),
         " UNION ALL ".join(f"SELECT '{c}' AS column_name, {SHAPE_SQL.format(c=c)} AS shape, count(*) AS row_count "
                            f"FROM docs GROUP BY ALL" for c in DATES))
register("prf3_day_month_order", lambda w: profiling.day_month_order(w.table("documents"), list(DATES)),
         " UNION ALL ".join(
             f"""SELECT '{c}' AS column_name, {c}[3] AS separator, count(*) AS row_count,
                 count(*) FILTER (WHERE a > 12) AS first_over_12, count(*) FILTER (WHERE b > 12) AS second_over_12,
                 count(*) FILTER (WHERE a <= 12 AND b <= 12) AS ambiguous,
                 CASE {c}[3] WHEN '/' THEN 'day_first' ELSE 'month_first' END AS verdict
                 FROM (SELECT *, CAST({c}[1:2] AS INTEGER) AS a, CAST({c}[4:5] AS INTEGER) AS b FROM docs
                       WHERE {c}[3] IN ('/', '-')) GROUP BY {c}[3]""" for c in DATES))


def _loosely_typed(w: Warehouse) -> DataFrame:
    return w.table("documents").select(
        col("credit_info.utilization_pct").alias("utilization_pct"),
        col("digital_engagement.avg_monthly_logins").alias("avg_monthly_logins"), "lat")


register("prf4_coercion_loss",
         lambda w: profiling.coercion_loss(_loosely_typed(w), ["utilization_pct", "avg_monthly_logins", "lat"]),
         """SELECT 'utilization_pct' AS column_name, count(*) AS present, count(*) FILTER (WHERE k % 50 IN (1, 2, 3)) AS lost FROM docs
            UNION ALL SELECT 'avg_monthly_logins', count(*), count(*) FILTER (WHERE k % 13 = 0) FROM docs
            UNION ALL SELECT 'lat', count(*), 0 FROM docs""")
RULES = {"balance_above_principal": "outstanding_balance > principal", "negative_days": "days_past_due < 0",
         "high_rate": "interest_rate > 30", "unknown_balance": "outstanding_balance IS NULL"}
register("prf5_violations",
         lambda w: profiling.violations(w.table("fct_loans"), {n: F.expr(rule) for n, rule in RULES.items()}),
         " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {rule}) AS row_count FROM fct_loans"
                            for n, rule in RULES.items()))
register("prf6_key_multiplicity",
         lambda w: profiling.key_multiplicity(w.table("documents").select(F.inline("transactions")), "transaction_id"),
         f"""SELECT c AS occurrences, count(*) AS keys, {N('sum(c)')} AS row_count
             FROM (SELECT count(*) AS c FROM all_transactions GROUP BY transaction_id) GROUP BY 1""")


def _inherited(w: Warehouse, array: str, key: str) -> DataFrame:
    documents = w.table("documents")
    children = documents.select("customer_id", F.inline(array)).select("customer_id", key)
    return profiling.inherited_duplicates(children, key, documents, "customer_id").withColumn("array_name", F.lit(array))


register("prf7_inherited_duplicates",
         lambda w: _inherited(w, "accounts", "account_id").unionByName(_inherited(w, "transactions", "transaction_id")),
         " UNION ALL ".join(
             f"""SELECT '{a}' AS array_name, count(*) AS duplicate_rows,
                 count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM docs GROUP BY 1 HAVING count(*) > 1))
                   AS under_repeated_parent,
                 count(*) = count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM docs GROUP BY 1 HAVING count(*) > 1))
                   AS fully_explained
                 FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS c FROM all_{a}) WHERE c > 1"""
             for a, key in (("accounts", "account_id"), ("transactions", "transaction_id"))))
register("prf8_category_variants",
         lambda w: profiling.category_variants(w.table("documents"), {
             "status": text.normalize_customer_status(col("status")),
             "kyc_status": text.normalize_kyc_status(col("kyc_status"))}),
         """SELECT 'status' AS column_name, CASE lower(status) WHEN 'activo' THEN 'active' WHEN 'suspendido' THEN 'suspended'
              ELSE lower(status) END AS normalized, status AS raw, count(*) AS row_count FROM docs GROUP BY ALL
            UNION ALL SELECT 'kyc_status', lower(trim(kyc_status)), kyc_status, count(*) FROM docs GROUP BY ALL""")

# --- reconciliation --------------------------------------------------------------------


def _facts(w: Warehouse) -> DataFrame:
    return reconcile.revenue_from_facts(*w.tables("dim_customer", "fct_transactions", "fct_loans", "fx_rates"))


PLAIN = """SELECT customer_id, coalesce(fees_usd / nullif(tenure_months, 0), 0) AS f, coalesce(interest_usd, 0) AS i
    FROM dim_customer LEFT JOIN fees_usd USING (customer_id) LEFT JOIN interest_usd USING (customer_id)"""
register("rec1_revenue_divergence",
         lambda w: reconcile.revenue_divergence(_facts(w), w.table("int_customer_monthly_revenue")),
         f"""SELECT count(*) AS total_customers,
             count(*) FILTER (WHERE abs(f - monthly_fee_revenue_usd) > 1e-4) AS diverge_fee,
             count(*) FILTER (WHERE abs(i - monthly_interest_revenue_usd) > 1e-4) AS diverge_interest,
             count(*) FILTER (WHERE abs(f + i - total_monthly_revenue_usd) > 1e-4) AS diverge_total
             FROM ({PLAIN}) JOIN int_customer_monthly_revenue USING (customer_id)""")


def _clamped_as_intermediate(w: Warehouse) -> DataFrame:
    """Monthly revenue with the three-month floor, under the intermediate's column names."""
    floor = F.greatest(col("tenure_months"), F.lit(3)) / F.nullif(col("tenure_months"), F.lit(0))
    plain = w.table("int_customer_monthly_revenue").join(
        w.table("dim_customer").select("customer_id", "tenure_months"), "customer_id")
    fee = F.coalesce(col("monthly_fee_revenue_usd") / floor, F.lit(0.0))
    return plain.select("customer_id", fee.alias("monthly_fee_revenue_usd"), "monthly_interest_revenue_usd",
                        (fee + col("monthly_interest_revenue_usd")).alias("total_monthly_revenue_usd"))


register("rec1_largest_divergences",
         lambda w: reconcile.largest_divergences(_facts(w), _clamped_as_intermediate(w)),
         f"""SELECT customer_id, {R('f', 4)} AS old_fee, {R('g', 4)} AS new_fee, {R('(f - g)', 4)} AS delta_fee,
             {R('i', 4)} AS old_int, {R('i', 4)} AS new_int, CAST(0 AS DOUBLE) AS delta_int
             FROM (SELECT *, coalesce(f / (greatest(tenure_months, 3) / CAST(nullif(tenure_months, 0) AS DOUBLE)), 0) AS g FROM ({PLAIN})
                   JOIN dim_customer USING (customer_id)) WHERE abs(f - g) > 1e-4
             ORDER BY abs((f + i) - (g + i)) DESC, customer_id LIMIT 10""")
register("rec2_mart_against_intermediate",
         lambda w: reconcile.mart_against_intermediate(
             *w.tables("mart_revenue_by_segment_usd", "int_customer_monthly_revenue", "dim_customer")),
         f"""SELECT 'from_mart' AS source, customer_segment, customer_count,
               {R('avg_revenue_per_customer_usd', 4)} AS avg_revenue_usd FROM mart_revenue_by_segment_usd
             UNION ALL SELECT 'from_intermediate', customer_segment, count(*),
               {R(A('total_monthly_revenue_usd'), 4)}
             FROM int_customer_monthly_revenue JOIN dim_customer USING (customer_id) GROUP BY customer_segment""")
register("rec2_revenue_rollup_native",
         lambda w: reconcile.revenue_rollup_native(w.table("mart_customer_360")),
         f"""SELECT customer_segment, count(*) AS customer_count, {R(A('total_revenue_monthly'), 2)} AS avg_total_revenue_native,
             {R(A('monthly_fee_revenue'), 2)} AS avg_fee_revenue_native,
             {R(A('monthly_interest_income'), 2)} AS avg_interest_revenue_native FROM mart_customer_360 GROUP BY 1""")
register("rec3_customer_spot_check",
         lambda w: reconcile.customer_spot_check(*w.tables("mart_customer_360", "int_customer_monthly_revenue")),
         f"""SELECT customer_id, {R('monthly_fee_revenue')} AS mart_fee, {R('monthly_fee_revenue_native')} AS int_fee_native,
             {R('monthly_interest_income')} AS mart_int, {R('monthly_interest_revenue_native')} AS int_int_native,
             {R('total_revenue_monthly')} AS mart_total, {R('total_monthly_revenue_native')} AS int_total_native,
             CASE WHEN monthly_fee_revenue = monthly_fee_revenue_native
                   AND monthly_interest_income = monthly_interest_revenue_native
                   AND total_revenue_monthly = total_monthly_revenue_native THEN 'OK' ELSE 'MISMATCH' END AS match_status
             FROM mart_customer_360 JOIN int_customer_monthly_revenue USING (customer_id)
             ORDER BY total_revenue_monthly DESC, customer_id LIMIT 5""")
register("rec4_revenue_invariants",
         lambda w: reconcile.revenue_invariants(w.table("int_customer_monthly_revenue")),
         """SELECT count(*) AS row_count, count(*) - count(customer_id) AS null_pk,
            count(*) FILTER (WHERE monthly_fee_revenue_native < 0) AS negative_fee_native,
            count(*) FILTER (WHERE monthly_fee_revenue_usd < 0) AS negative_fee_usd,
            count(*) FILTER (WHERE monthly_interest_revenue_native < 0) AS negative_int_native,
            count(*) FILTER (WHERE monthly_interest_revenue_usd < 0) AS negative_int_usd,
            count(*) FILTER (WHERE total_monthly_revenue_native < 0) AS negative_total_native,
            count(*) FILTER (WHERE total_monthly_revenue_usd < 0) AS negative_total_usd
            FROM int_customer_monthly_revenue""")
register("rec5_fee_attribution",
         lambda w: reconcile.fee_attribution(*w.tables("fct_transactions", "dim_account")),
         f"""SELECT count(*) AS total_completed_fees, count(*) FILTER (WHERE apart) AS divergent_fees,
             {R(Q('count(*) FILTER (WHERE apart) * 100', 'count(*)'), 4)} AS divergent_pct
             FROM (SELECT t.customer_id <> a.customer_id AS apart FROM fct_transactions t JOIN dim_account a USING (account_id)
                   WHERE transaction_type = 'fee' AND t.status = 'completed')""")
register("rec5_fee_attribution_by_segment", _by_segments, SEGMENT_PAIRS)
