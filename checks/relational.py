"""Filter, join, aggregation, window, ordering and set queries over the model graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from checks.cleaning import tally, tally_sql
from checks.oracle_tables import A, N, Q, R, S
from checks.registry import register
from finmart.functions import dates
from finmart.functions.buckets import display_order
from finmart.functions.numbers import exact_avg, exact_sum, ratio
from finmart.operators import dedup
from finmart.operators.analytics import (
    count_where, exact_median, growth_percent, ordinal, percent_of, running_total, share_of, to_usd,
)
from finmart.plans import gold, intermediate, profiling, reconcile
from finmart.plans.questions import customers_by_city
from finmart.plans.silver import facts_before
from finmart.plans.warehouse import Warehouse

col = F.col

# --- filters ---------------------------------------------------------------------------

register("flt1_status_and_type",
         lambda w: tally(w.table("fct_transactions").where(
             col("transaction_type").isin("fee", "refund") & (col("status") == "completed")), "transaction_type", "channel"),
         tally_sql("fct_transactions WHERE transaction_type IN ('fee', 'refund') AND status = 'completed'",
                   "transaction_type", "channel"))
register("flt2_not_null",
         lambda w: tally(w.table("fct_transactions").where(
             col("amount").isNotNull() & col("category").isNotNull() & col("merchant").isNotNull()), "category"),
         tally_sql("fct_transactions WHERE amount IS NOT NULL AND category IS NOT NULL AND merchant IS NOT NULL", "category"))
register("flt3_strict_upper_date",
         lambda w: tally(facts_before(w.table("fct_transactions"), F.lit("2000-01-01").cast("date")), "status"),
         tally_sql("fct_transactions WHERE transaction_date < DATE '2000-01-01'", "status"))
register("flt4_filtered_aggregates",
         lambda w: w.table("fct_transactions").groupBy("channel").agg(
             count_where(col("status") == "completed").alias("completed"),
             exact_sum(F.when(col("status") == "completed", col("amount"))).alias("value"),
             exact_avg(F.when(col("is_failed"), col("amount"))).alias("failed_ticket")),
         f"""SELECT channel, {N('', "status = 'completed'")} AS completed,
             {R(S('amount', "status = 'completed'"))} AS value, {R(A('amount', 'is_failed'))} AS failed_ticket
             FROM fct_transactions GROUP BY 1""")
register("flt5_null_unsafe_inequality",
         lambda w: tally(w.table("fct_transactions"),
                         F.when((col("merchant") != "Brand#1") & (col("category") != "PROMO"), True).otherwise(False).alias("other")),
         tally_sql("fct_transactions", "coalesce(merchant <> 'Brand#1' AND category <> 'PROMO', false) AS other"))

# --- joins -----------------------------------------------------------------------------

register("jn1_inner",
         lambda w: w.table("dim_account").groupBy("customer_id", "account_type").agg(F.count("*").alias("k")).join(
             w.table("dim_customer").select("customer_id", "country"), "customer_id").groupBy("country", "account_type").agg(
             F.sum("k").alias("n")),
         "SELECT country, account_type, count(*) AS n FROM dim_account JOIN dim_customer USING (customer_id) GROUP BY ALL")


def _loans_of_everyone(w: Warehouse) -> DataFrame:
    loans = w.table("fct_loans").groupBy("customer_id").agg(F.count("*").alias("loans"))
    return w.table("dim_customer").select("customer_id").join(loans, "customer_id", "left").na.fill(0, ["loans"])


register("jn2_left_preserving", _loans_of_everyone,
         "SELECT customer_id, count(loan_id) AS loans FROM dim_customer LEFT JOIN fct_loans USING (customer_id) GROUP BY 1")
register("jn3_left_made_inner",
         lambda w: tally(w.table("dim_customer").select("customer_id", "age_bucket").join(
             w.table("dim_digital_engagement"), "customer_id", "left").where(col("avg_monthly_logins").isNotNull()), "age_bucket"),
         tally_sql("dim_customer JOIN dim_digital_engagement USING (customer_id) WHERE avg_monthly_logins IS NOT NULL", "age_bucket"))


def _with_busiest_channel(w: Warehouse) -> DataFrame:
    tx = w.table("fct_transactions")
    per_channel = tx.groupBy("merchant", "currency", "channel").agg(F.count("*").alias("k"))
    top = dedup.first_per_key(per_channel, ["merchant", "currency"], [col("k").desc(), col("channel").asc_nulls_last()])
    totals = tx.groupBy("merchant", "currency").agg(F.count("*").alias("n"))
    return totals.join(top.drop("k"), ["merchant", "currency"], "left")


register("jn4_left_two_keys_first_rank", _with_busiest_channel, """
    SELECT t.merchant, t.currency, n, channel FROM (SELECT merchant, currency, count(*) AS n FROM fct_transactions GROUP BY ALL) t
    LEFT JOIN (SELECT merchant, currency, channel, row_number() OVER (PARTITION BY merchant, currency
                 ORDER BY count(*) DESC, channel) AS rn FROM fct_transactions GROUP BY merchant, currency, channel) c
    ON c.merchant = t.merchant AND c.currency = t.currency AND rn = 1""")


def _opened_and_paid(w: Warehouse) -> DataFrame:
    opened = w.table("dim_account").groupBy(dates.month_of(col("opened_date")).alias("month"), "currency").agg(
        F.count("*").alias("opened"))
    lent = w.table("fct_loans").where(col("days_past_due") > 100).groupBy(
        dates.month_of(col("start_date")).alias("month"), "currency").agg(F.count("*").alias("overdue"))
    return opened.join(lent, ["month", "currency"], "full").na.fill(0, ["opened", "overdue"])


register("jn5_full_two_keys", _opened_and_paid, """
    SELECT month, currency, coalesce(opened, 0) AS opened, coalesce(overdue, 0) AS overdue
    FROM (SELECT CAST(date_trunc('month', opened_date) AS DATE) AS month, currency, count(*) AS opened
          FROM dim_account GROUP BY ALL)
    FULL JOIN (SELECT CAST(date_trunc('month', start_date) AS DATE) AS month, currency, count(*) AS overdue
          FROM fct_loans WHERE days_past_due > 100 GROUP BY ALL) USING (month, currency)""")


def _running_loans(w: Warehouse) -> DataFrame:
    """Loans begun up to each month: the range join as a running sum over months."""
    started = w.table("fct_loans").groupBy(dates.month_of(col("start_date")).alias("month")).agg(F.count("*").alias("begun"))
    active = w.table("fct_transactions").select(dates.month_of(col("transaction_date")).alias("month")).distinct()
    timeline = started.join(active.withColumn("listed", F.lit(True)), "month", "full").na.fill(0, ["begun"])
    summed = timeline.withColumn("loans", running_total(col("begun"), "month"))
    return summed.where("listed and loans > 0").select("month", "loans")


register("jn6_months_since_start", _running_loans, """
    SELECT m AS month, count(*) AS loans FROM fct_loans JOIN (SELECT DISTINCT
      CAST(date_trunc('month', transaction_date) AS DATE) AS m FROM fct_transactions) ON m >= date_trunc('month', start_date)
    GROUP BY 1""")
register("jn7_lookup_join",
         lambda w: tally(w.table("dim_customer").join(
             w.table("country_currency").withColumnRenamed("country_code", "country"), "country", "left"),
             "country", "currency_code"),
         tally_sql("dim_customer JOIN country_currency ON country_code = country", "country", "currency_code"))
register("jn8_using",
         lambda w: w.table("mart_customer_360").join(w.table("int_customer_monthly_revenue"), "customer_id").select(
             "customer_id", "monthly_fee_revenue", "monthly_fee_revenue_native"),
         f"""SELECT customer_id, {R('monthly_fee_revenue')} AS monthly_fee_revenue,
             {R('monthly_fee_revenue_native')} AS monthly_fee_revenue_native
             FROM mart_customer_360 JOIN int_customer_monthly_revenue USING (customer_id)""")
SEGMENT_PAIRS = """SELECT p.customer_segment AS executor_segment, o.customer_segment AS owner_segment,
    count(*) AS divergent_fee_count FROM fct_transactions t JOIN dim_account a USING (account_id)
    JOIN dim_customer p ON p.customer_id = t.customer_id JOIN dim_customer o ON o.customer_id = a.customer_id
    WHERE transaction_type = 'fee' AND t.status = 'completed' AND t.customer_id <> a.customer_id GROUP BY ALL"""


def _by_segments(w: Warehouse) -> DataFrame:
    return reconcile.fee_attribution_by_segment(*w.tables("fct_transactions", "dim_account", "dim_customer"))


register("jn9_two_roles", _by_segments, SEGMENT_PAIRS)
register("jn10_orphans",
         lambda w: w.table("fct_transactions").groupBy("account_id").agg(F.count("*").alias("n")).join(
             w.table("dim_account").where("status = 'active'"), "account_id", "left_anti"),
         """SELECT account_id, count(*) AS n FROM fct_transactions
            WHERE account_id NOT IN (SELECT account_id FROM dim_account WHERE status = 'active') GROUP BY 1""")


def _correlated(w: Warehouse) -> DataFrame:
    return w.spark.sql("""
        SELECT loan_id, principal * CAST((SELECT max(rate_to_usd) FROM {rates} f WHERE f.currency = l.currency)
                 AS DOUBLE) AS principal_usd FROM {loans} l""", loans=w.table("fct_loans"), rates=w.table("fx_rates"))


register("jn11_correlated_scalar", _correlated,
         f"SELECT loan_id, {R('principal * rate')} AS principal_usd FROM fct_loans LEFT JOIN fx_rates USING (currency)")

# --- aggregation -----------------------------------------------------------------------

register("agg1_group_by",
         lambda w: w.table("fct_loans").groupBy("loan_type", "status", "currency").agg(
             F.count("*").alias("n"), exact_sum(col("principal")).alias("total"), exact_avg(col("principal")).alias("mean"),
             F.min("principal").alias("low"), F.max("principal").alias("high")),
         f"""SELECT loan_type, status, currency, count(*) AS n, {R(S('principal'))} AS total, {R(A('principal'))} AS mean,
             {R('min(principal)')} AS low, {R('max(principal)')} AS high FROM fct_loans GROUP BY ALL""")
register("agg2_count_distinct",
         lambda w: w.table("dim_account").groupBy("account_type").agg(
             F.count_distinct("customer_id").alias("customers"),
             F.count_distinct(F.when(col("balance").isNotNull(), col("customer_id"))).alias("with_balance")),
         """SELECT account_type, count(DISTINCT customer_id) AS customers,
            count(DISTINCT customer_id) FILTER (WHERE balance IS NOT NULL) AS with_balance FROM dim_account GROUP BY 1""")
register("agg3_filtered",
         lambda w: gold.mart_international_transfers(
             *w.tables("fct_transactions", "dim_account", "dim_customer", "country_currency")
         ).select("origin_country", "tx_currency", "international_tx_count", "total_international_value"),
         f"""SELECT origin_country, tx_currency, international_tx_count,
             {R('total_international_value')} AS total_international_value FROM mart_international_transfers""")
register("agg4_bool_or",
         lambda w: w.table("int_loan_portfolio_metrics").groupBy("customer_id").agg(
             F.bool_or("is_delinquent").alias("any_delinquent"), F.bool_or("is_default").alias("any_default")),
         """SELECT customer_id, max(days_past_due) >= 30 AS any_delinquent,
            max(days_past_due) >= 90 OR count(*) FILTER (WHERE status = 'default') > 0 AS any_default FROM fct_loans GROUP BY 1""")
register("agg5_window_over_aggregate",
         lambda w: w.table("fct_loans").groupBy("loan_type", "status").agg(F.count("*").alias("n")).withColumn(
             "type_total", F.sum("n").over(Window.partitionBy("loan_type"))),
         f"""SELECT loan_type, status, count(*) AS n, {N('sum(count(*)) OVER (PARTITION BY loan_type)')} AS type_total
             FROM fct_loans GROUP BY loan_type, status""")
register("agg6_global",
         lambda w: w.table("fct_transactions").agg(
             F.count("*").alias("n"), exact_sum(col("amount")).alias("total"), F.max("transaction_date").alias("last")),
         f"SELECT count(*) AS n, {R(S('amount'))} AS total, max(transaction_date) AS last FROM fct_transactions")
register("agg7_share_of_total",
         lambda w: tally(w.table("dim_customer"), "country", "customer_segment").withColumns({
             "share_of_country": share_of(col("n"), "country"), "share_of_total": share_of(col("n")),
             "pct_of_country": percent_of(col("n"), "country")}),
         f"""SELECT *, {R(Q('n', 'sum(n) OVER (PARTITION BY country)'))} AS share_of_country,
             {R(Q('n', 'sum(n) OVER ()'))} AS share_of_total,
             {R('(n * 1e2 / sum(n) OVER (PARTITION BY country))', 2)} AS pct_of_country
             FROM (SELECT country, customer_segment, count(*) AS n FROM dim_customer GROUP BY ALL)""")
register("agg8_rollup_of_mart",
         lambda w: w.table("mart_tx_by_channel").groupBy("currency").agg(
             F.sum("tx_count").alias("tx_count"), exact_avg(col("avg_ticket")).alias("mean_of_means")),
         f"""SELECT currency, {N('sum(tx_count)')} AS tx_count, {R(A('avg_ticket'))} AS mean_of_means
             FROM mart_tx_by_channel GROUP BY 1""")
register("agg9_median",
         lambda w: exact_median(w.table("fct_loans"), "outstanding_balance"),
         f"SELECT {R('median(outstanding_balance)')} AS median FROM fct_loans")
register("agg10_distinct_projection",
         lambda w: w.table("fct_transactions").select(dates.month_of(col("transaction_date")).alias("month")).distinct(),
         "SELECT DISTINCT CAST(date_trunc('month', transaction_date) AS DATE) AS month FROM fct_transactions")
register("agg11_value_counts",
         lambda w: profiling.value_counts(w.table("fct_transactions"), ["category", "channel", "merchant"]),
         " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM fct_transactions GROUP BY ALL"
                            for c in ("category", "channel", "merchant")))
NUMERIC = ("balance", "credit_limit", "interest_rate")
register("agg11_describe",
         lambda w: profiling.describe(w.table("dim_account"), list(NUMERIC)),
         " UNION ALL ".join(
             f"SELECT '{c}' AS column_name, count({c}) AS n, {R(f'min({c})')} AS min_value, {R(A(c))} AS mean_value, "
             f"{R(f'stddev_samp({c})')} AS std_value, {R(f'max({c})')} AS max_value, {R(f'quantile_cont({c}, 0.25)')} AS q1_value, "
             f"{R(f'median({c})')} AS median_value, {R(f'quantile_cont({c}, 0.75)')} AS q3_value FROM dim_account" for c in NUMERIC))
register("agg11_histogram",
         lambda w: profiling.histogram(w.table("dim_customer"), "risk_score", 0, 100, 50),
         """SELECT CAST(least(floor(risk_score * 50 / 1e2), 50) AS BIGINT) + 1 AS bin, count(*) AS row_count
            FROM dim_customer GROUP BY 1""")

# --- windows ---------------------------------------------------------------------------

register("win1_dedup_by_key",
         lambda w: tally(w.table("raw_transactions"), "bronze_id"),
         tally_sql("raw_transactions", "bronze_id"))
register("win2_latest_document",
         lambda w: w.table("latest_documents").select("customer_id", "bronze_id", "status", "customer_segment"),
         "SELECT customer_id, bronze_id, status, customer_segment FROM latest_docs")


def _mode_of_category(w: Warehouse) -> DataFrame:
    counts = w.table("fct_transactions").groupBy("merchant", "category").agg(F.count("*").alias("k"))
    return dedup.first_per_key(counts, "merchant", [col("k").desc(), col("category").asc_nulls_last()])


register("win3_mode_with_tie_break", _mode_of_category, """
    SELECT merchant, category, count(*) AS k FROM fct_transactions GROUP BY merchant, category
    QUALIFY row_number() OVER (PARTITION BY merchant ORDER BY count(*) DESC, category NULLS LAST) = 1""")
register("win4_two_rankings",
         lambda w: w.table("mart_top_merchants").select(
             "merchant", "currency", "rank_by_value_within_currency", "rank_by_count_within_currency"),
         """SELECT merchant, currency, rank_by_value_within_currency, rank_by_count_within_currency
            FROM mart_top_merchants""")
MONTHLY = "SELECT CAST(date_trunc('month', opened_date) AS DATE) AS month, count(*) AS n FROM dim_account GROUP BY 1"


def _monthly_accounts(w: Warehouse) -> DataFrame:
    return tally(w.table("dim_account"), dates.month_of(col("opened_date")).alias("month"))


register("win5_running_sum",
         lambda w: _monthly_accounts(w).withColumn("total", running_total(col("n"), "month")),
         f"SELECT *, {N('sum(n) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING)')} AS total FROM ({MONTHLY})")
register("win6_growth",
         lambda w: _monthly_accounts(w).withColumn("growth", growth_percent(col("n"), "month")),
         f"""SELECT month, n, {R(f"({Q('n - p', 'p')} * 100)", 2)} AS growth
             FROM (SELECT *, lag(n) OVER (ORDER BY month) AS p FROM ({MONTHLY}))""")
register("win7_partition_totals",
         lambda w: tally(w.table("dim_account"), "account_type", "currency").withColumns({
             "of_type": F.sum("n").over(Window.partitionBy("account_type")),
             "of_all": F.sum("n").over(Window.partitionBy())}),
         f"""SELECT *, {N('sum(n) OVER (PARTITION BY account_type)')} AS of_type, {N('sum(n) OVER ()')} AS of_all
             FROM (SELECT account_type, currency, count(*) AS n FROM dim_account GROUP BY ALL)""")


def _most_complete(w: Warehouse) -> DataFrame:
    candidates = w.table("stg_transactions").select(
        "account_id", "transaction_date", "amount", "category", "merchant", "transaction_id")
    return dedup.most_complete(candidates, "account_id", "transaction_date")


register("win8_most_complete", _most_complete, f"""
    SELECT account_id, transaction_date, {R('amount')} AS amount, category, merchant, transaction_id FROM stg_transactions
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY
      (CASE WHEN amount IS NULL THEN 0 ELSE 1 END + CASE WHEN category IS NULL THEN 0 ELSE 1 END
       + CASE WHEN merchant IS NULL THEN 0 ELSE 1 END) DESC, transaction_date DESC NULLS LAST,
      amount NULLS LAST, category NULLS LAST, merchant NULLS LAST, transaction_id NULLS LAST) = 1""")

# --- ordering and sets -----------------------------------------------------------------

register("srt1_multi_key",
         lambda w: w.table("mart_tx_by_category").select(
             "category", "currency", "completed_tx_count",
             F.row_number().over(Window.orderBy(
                 col("completed_tx_count").desc(), F.asc_nulls_first("currency"), F.asc_nulls_first("category"))).alias("position")),
         """SELECT category, currency, completed_tx_count, CAST(row_number() OVER (ORDER BY completed_tx_count DESC,
              currency NULLS FIRST, category NULLS FIRST) AS INTEGER) AS position FROM mart_tx_by_category""")
register("srt2_desc_nulls_last",
         lambda w: ordinal(w.table("dim_customer").select("customer_id", "lat", F.lit(1).alias("all")), "all", "lat",
                           "customer_id", "position", nulls_last=True).drop("all"),
         f"""SELECT customer_id, {R('lat')} AS lat, row_number() OVER (ORDER BY lat DESC NULLS LAST, customer_id) AS position
             FROM dim_customer""")
register("srt3_top_k",
         lambda w: customers_by_city(w.table("mart_customer_360"), 10),
         """SELECT country, city, count(*) AS customer_count FROM mart_customer_360 GROUP BY ALL
            ORDER BY customer_count DESC, country, city LIMIT 10""")
register("srt4_top_n_per_group",
         lambda w: w.table("mart_top_merchants").where("rank_by_value_within_currency <= 10").select(
             "currency", "merchant", "rank_by_value_within_currency"),
         """SELECT currency, merchant, rank_by_value_within_currency FROM mart_top_merchants
            WHERE rank_by_value_within_currency <= 10""")


def _in_display_order(w: Warehouse) -> DataFrame:
    counts = tally(w.table("int_customer_risk_profile"), "risk_bucket")
    position = display_order(col("risk_bucket"), "risk")
    return counts.withColumn("position", F.row_number().over(Window.orderBy(position.asc_nulls_last())))


register("srt5_order_by_case", _in_display_order, """
    SELECT risk_bucket, count(*) AS n, CAST(row_number() OVER (ORDER BY CASE risk_bucket WHEN 'low' THEN 1
      WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 END) AS INTEGER) AS position
    FROM int_customer_risk_profile GROUP BY 1""")
register("set1_union_all",
         lambda w: w.table("stg_accounts").select("customer_id", "currency").unionByName(
             w.table("stg_loans").select("customer_id", "currency")).groupBy("currency").agg(F.count("*").alias("products")),
         """SELECT currency, count(*) AS products FROM (SELECT currency FROM stg_accounts UNION ALL
            SELECT currency FROM stg_loans) GROUP BY 1""")
