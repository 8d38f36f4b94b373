"""Source, document, cleaning, date, number and bucket queries.

A scalar query lists each distinct input with its result and how many rows have it, so it
runs over the whole column.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from checks.oracle_tables import (
    AS_OF, CURRENCIES, N, Q, R, S, months, parsed_date, pick, risk_band, score_band, utilization_band, mapped,
)
from checks.registry import register
from finmart import schemas
from finmart.functions import buckets, dates, numbers, text
from finmart.operators import flatten
from finmart.operators.analytics import to_usd
from finmart.plans.models import MARTS
from finmart.plans.warehouse import Warehouse
from finmart.session import shuffles_removed
from finmart.sources import bronze, seeds, store

col = F.col


def tally(df: DataFrame, *columns: Column) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def tally_sql(source: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)}, count(*) AS n FROM {source} GROUP BY ALL"


def scalar(name: str, table: str, raw: str, function, sql_source: str, raw_sql: str, clean_sql: str) -> None:
    """Register ``function`` over one raw column."""
    register(
        name,
        lambda w: tally(raw_table(w, table), col(raw).alias("raw"), function(col(raw)).alias("clean")),
        f"SELECT raw, {clean_sql} AS clean, count(*) AS n FROM (SELECT {raw_sql} AS raw FROM {sql_source}) GROUP BY ALL",
    )


def raw_table(w: Warehouse, table: str) -> DataFrame:
    """A stored table, or ``documents.<array>`` for the untouched elements of an array."""
    if table.startswith("documents."):
        return w.table("documents").select(F.inline(table.split(".")[1]))
    return w.table(table)


# --- sources ---------------------------------------------------------------------------


def _documents_from_text(w: Warehouse) -> DataFrame:
    """Landed as packed lines, a sixth of the plain text, and read again."""
    path = w.scratch("landed")
    w.table("bronze").select("data").write.option("compression", "gzip").text(path)
    landed = bronze.read_json_documents(w.spark, path, lines=True)
    return landed.groupBy(F.get_json_object("data", "$.country").alias("country")).agg(F.count("*").alias("documents"))


register("src1_read_json_documents", _documents_from_text,
         "SELECT country, count(*) AS documents FROM docs GROUP BY ALL")


def _documents_from_arrays(w: Warehouse) -> DataFrame:
    """Landed as one packed array file per thousand ids, and cut into documents again."""
    path = w.scratch("landed-arrays")
    with shuffles_removed(w.spark):
        w.table("bronze").groupBy(F.floor(col("id") / 1000).alias("part")).agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("data"), ",\n"), F.lit("]")).alias("value")
        ).write.partitionBy("part").option("compression", "gzip").text(path)
    landed = bronze.read_json_documents(w.spark, path)
    return landed.groupBy(F.get_json_object("data", "$.country").alias("country")).agg(
        F.count("*").alias("documents"), F.sum(F.size(F.from_json(F.get_json_object("data", "$.transactions"), "array<string>"))).alias("transactions"))


register("src1_read_json_arrays", _documents_from_arrays, """
    SELECT country, count(*) AS documents, sum(n)::BIGINT AS transactions FROM (
      SELECT docs.country, count(x.bronze_id) AS n FROM docs LEFT JOIN all_transactions x
      USING (bronze_id, order_block, line_block) GROUP BY docs.country, bronze_id, order_block, line_block) GROUP BY 1""")


def _appended(w: Warehouse) -> DataFrame:
    path = w.scratch("appended")
    for load in ("load-0001", "load-0002"):
        batch = w.table("bronze").where(col("load_id") == load)
        bronze.append_bronze(batch.select("data"), path, load, "demo_bank.json")
    return bronze.read_bronze(w.spark, path).groupBy("load_id", "source_file").agg(
        F.count("*").alias("records"), F.count_distinct("id").alias("ids"), F.count_distinct("load_timestamp").alias("moments")
    )


register("src2_append_bronze", _appended, """
    SELECT load_id, 'demo_bank.json' AS source_file, count(*) AS records, count(*) AS ids,
      CAST(1 AS BIGINT) AS moments FROM docs GROUP BY ALL""")
register(
    "src3_read_bronze",
    lambda w: tally(bronze.read_bronze(w.spark, w.store.path("bronze", "raw_documents")),
                    "load_id", F.get_json_object("data", "$.status").alias("status")),
    tally_sql("docs", "load_id", "status"),
)


def _restaged(w: Warehouse) -> DataFrame:
    accounts = w.table("raw_accounts")
    target = store.TableStore(w.spark, w.scratch("staging"))
    target.save(accounts.where("status is null"), "silver_raw", "stg_accounts")
    return tally(target.save(accounts, "silver_raw", "stg_accounts"), col("status"))


register("src4_overwrite_staging", _restaged, tally_sql("raw_accounts", "status"))


def _seed_from_csv(w: Warehouse) -> DataFrame:
    path = w.scratch("fx")
    w.table("fx_rates").write.option("header", "true").csv(path)
    rates = seeds.fx_rates(w.spark, path)
    used = tally(w.table("fct_transactions"), col("currency"))
    return used.join(rates, "currency", "left").select(
        "currency", "n", col("rate_to_usd").cast("double").alias("rate"), "as_of_date"
    )


register("src5_seed_csv", _seed_from_csv, """
    SELECT currency, n, rate, as_of_date FROM (SELECT currency, count(*) AS n FROM fct_transactions GROUP BY 1)
    LEFT JOIN fx_rates USING (currency)""")
register(
    "slv9_dim_geography",
    lambda w: tally(w.table("dim_customer").join(
        w.table("dim_geography").withColumnRenamed("country_code", "country"), "country"
    ), *[col(c) for c in ("country", "country_name", "region", "default_currency")]),
    """SELECT country, country_name, region, default_currency, count(*) AS n FROM dim_customer
       JOIN dim_geography ON country = country_code GROUP BY ALL""",
)

register(
    "src6_literal_table",
    lambda w: w.table("dim_account").groupBy("currency").agg(F.count("*").alias("accounts")).join(
        w.table("dim_geography").withColumnRenamed("default_currency", "currency"), "currency", "left"),
    """SELECT currency, accounts, country_code, country_name, region
       FROM (SELECT currency, count(*) AS accounts FROM dim_account GROUP BY 1)
       LEFT JOIN dim_geography ON default_currency = currency""",
)


def _calendar_of_transactions(w: Warehouse) -> DataFrame:
    """The calendar over the span of the facts, with the transactions of each day."""
    per_day = w.table("fct_transactions").groupBy("transaction_date").agg(F.count("*").alias("n"))
    span = per_day.agg(F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b")).first()
    calendar = seeds.dim_date(w.spark, str(span["a"]), str(span["b"]))
    return calendar.join(
        per_day.withColumnRenamed("transaction_date", "date_day"), "date_day", "left"
    ).na.fill(0, ["n"])


CALENDAR_SQL = """SELECT c.*, coalesce(n, 0) AS n FROM calendar_days c LEFT JOIN
    (SELECT transaction_date AS date_day, count(*) AS n FROM fct_transactions GROUP BY 1) USING (date_day)"""
register("slv10_dim_date", _calendar_of_transactions, CALENDAR_SQL)
register(
    "src7_date_spine",
    lambda w: _calendar_of_transactions(w).groupBy("year").agg(F.count("*").alias("days"), F.sum("n").alias("n")),
    f"SELECT year, count(*) AS days, {N('sum(n)')} AS n FROM ({CALENDAR_SQL}) GROUP BY 1",
)


def _through_view(w: Warehouse) -> DataFrame:
    view = f"stg_loans_{uuid.uuid4().hex}"  # of its own: queries of one session keep apart
    store.register_view(w.table("stg_loans"), view)
    return w.spark.sql(f"SELECT loan_type, status, count(*) AS n FROM {view} GROUP BY ALL")


register("src8_view_and_table", _through_view, tally_sql("stg_loans", "loan_type", "status"))


def _layer_tables(w: Warehouse) -> DataFrame:
    """A table per layer in databases of their own; the fact by month, its last month refreshed alone."""
    spark, prefix = w.spark, f"finmart_{uuid.uuid4().hex[:8]}_"
    store.create_namespaces(spark, prefix, w.scratch("layers"))
    facts = w.table("fct_transactions").withColumn("month", F.date_format("transaction_date", "yyyy-MM"))
    store.save_table(w.table("bronze").select("id", "load_id"), f"{prefix}bronze", "raw_documents", ("load_id",))
    store.save_table(w.table("stg_loans"), f"{prefix}silver_raw", "stg_loans")
    store.save_table(facts, f"{prefix}silver", "fct_transactions", ("month",))
    store.save_table(w.table("mart_tx_by_channel"), f"{prefix}gold", "mart_tx_by_channel")
    last = facts.agg(F.max("month")).first()[0]
    store.save_table(facts.where(col("month") == last), f"{prefix}silver", "fct_transactions", ("month",))
    listed = [store.catalog_inventory(spark, f"{prefix}{layer}").withColumn("layer", F.lit(layer)) for layer in store.LAYERS]
    by_month = spark.table(f"{prefix}silver.fct_transactions").where(col("month") >= "1998").agg(
        F.lit("fct_transactions since 1998").alias("table_name"), F.count("*").alias("row_count"), F.lit("silver").alias("layer"))
    return reduce(DataFrame.unionByName, [*listed, by_month])


register("src9_layer_tables", _layer_tables, """
    SELECT 'bronze' AS layer, 'raw_documents' AS table_name, count(*) AS row_count FROM docs
    UNION ALL SELECT 'silver_raw', 'stg_loans', count(*) FROM stg_loans
    UNION ALL SELECT 'silver', 'fct_transactions', count(*) FROM fct_transactions
    UNION ALL SELECT 'gold', 'mart_tx_by_channel', count(*) FROM mart_tx_by_channel
    UNION ALL SELECT 'silver', 'fct_transactions since 1998', count(*) FROM fct_transactions
      WHERE transaction_date >= DATE '1998-01-01'""")
register(
    "src10_latest_batch",
    lambda w: bronze.latest_batch(w.table("bronze")).select(
        "id", F.get_json_object("data", "$.customer_id").alias("customer_id"),
        F.get_json_object("data", "$.country").alias("country")),
    "SELECT bronze_id AS id, customer_id, country FROM docs WHERE load_id = (SELECT max(load_id) FROM docs)",
)
register(
    "src11_batch_inventory",
    lambda w: bronze.batch_inventory(w.table("bronze")).withColumn(
        "loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss")),
    "SELECT load_id, count(*) AS records, max(loaded) AS loaded_at FROM docs GROUP BY 1",
)
register(
    "src12_table_inventory",
    lambda w: store.table_inventory({name: w.saved(name) for name in MARTS}),
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in MARTS),
)

# --- documents -------------------------------------------------------------------------

PARTIAL = schemas.StructType([
    schemas.StructField("customer_id", schemas.StringType()),
    schemas.StructField("transactions", schemas.ArrayType(schemas.TRANSACTION)),
])


def _partly_parsed(w: Warehouse) -> DataFrame:
    return w.table("bronze").select(
        col("id").alias("bronze_id"), "load_timestamp", F.from_json("data", PARTIAL).alias("d")
    ).select("bronze_id", "load_timestamp", "d.*")


TX_DOCS = "all_transactions"
register(
    "jsn1_parse_partial_schema",
    lambda w: _partly_parsed(w).select(F.inline("transactions")).groupBy("type").agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.count("merchant").alias("merchants")),
    f"""SELECT transaction_type AS type, count(*) AS n, count(amount) AS amounts, count(merchant) AS merchants
        FROM {TX_DOCS} GROUP BY ALL""",
)
register(
    "jsn2_explode_loans",
    lambda w: w.table("documents").select("customer_id", F.explode("loans").alias("x")).groupBy("customer_id").agg(
        F.count("*").alias("n")),
    "SELECT customer_id, count(*) AS n FROM all_loans GROUP BY 1",
)
register(
    "jsn3_promote_with_lineage",
    lambda w: w.table("documents").select(
        F.inline("accounts"), "bronze_id", F.date_format("load_timestamp", "yyyy-MM-dd HH:mm:ss").alias("loaded")
    ).select("account_id", "branch_code", "bronze_id", "loaded"),
    "SELECT account_id, branch_code, bronze_id, loaded FROM all_accounts",
)
register(
    "jsn4_scalar_as_text",
    lambda w: tally(w.table("bronze"), *[F.get_json_object("data", f"$.{c}").alias(c)
                                         for c in ("customer_segment", "kyc_status", "status", "country")]),
    tally_sql("docs", "customer_segment", "kyc_status", "status", "country"),
)
register(
    "jsn5_nested_as_text",
    lambda w: tally(w.table("bronze"),
                    F.get_json_object("data", "$.digital_engagement.mobile_app_registered").alias("mobile"),
                    F.get_json_object("data", "$.digital_engagement.avg_monthly_logins").alias("logins"),
                    F.get_json_object("data", "$.credit_info.credit_score").alias("score")),
    tally_sql("docs", "mobile_text AS mobile", "logins_text AS logins", "CAST(credit_score AS VARCHAR) AS score"),
)
SIZES = ("SELECT '{a}' AS array_name, count(x.bronze_id) AS n FROM docs LEFT JOIN all_{a} x "
         "USING (bronze_id, order_block, line_block) GROUP BY bronze_id, order_block, line_block")
register(
    "jsn7_array_cardinality",
    lambda w: flatten.array_cardinality(w.table("documents")),
    f"""SELECT array_name, count(*) AS documents, CAST(min(n) AS INTEGER) AS min_items, {R('avg(n)')} AS avg_items,
        CAST(max(n) AS INTEGER) AS max_items FROM (
        {' UNION ALL '.join(SIZES.format(a=a) for a in ('accounts', 'transactions', 'loans'))}) GROUP BY 1""",
)
TYPED = {"lat": "$.lat", "mobile_app_registered": "$.digital_engagement.mobile_app_registered",
         "utilization_pct": "$.credit_info.utilization_pct", "avg_monthly_logins": "$.digital_engagement.avg_monthly_logins",
         "accounts": "$.accounts", "country": "$.country"}
TYPE_SQL = {
    "lat": "CASE WHEN k % 10 = 5 THEN 'string' ELSE 'number' END",
    "mobile_app_registered": "CASE WHEN k % 8 = 0 THEN 'boolean' ELSE 'string' END",
    "utilization_pct": "CASE WHEN k % 50 IN (1, 2, 3) THEN 'string' ELSE 'number' END",
    "avg_monthly_logins": "CASE WHEN k % 13 = 0 THEN 'string' ELSE 'number' END",
    "accounts": "'array'", "country": "'string'",
}
register(
    "jsn8_json_type_census",
    lambda w: flatten.json_type_census(w.table("bronze"), TYPED),
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, {kind} AS json_type, count(*) AS documents FROM docs GROUP BY ALL"
        for f, kind in TYPE_SQL.items()),
)
KEYS = ",".join(sorted([*schemas.PROFILE_FIELDS, "accounts", "transactions", "loans", "credit_info", "digital_engagement"]))
register("jsn9_key_sets", lambda w: flatten.key_sets(w.table("bronze")),
         f"SELECT '{KEYS}' AS key_set, count(*) AS documents FROM docs")

# --- cleaning --------------------------------------------------------------------------

scalar("cln1_blank_to_null", "documents.transactions", "channel", text.blank_to_null, "all_transactions",
       "CASE channel WHEN 'branch' THEN ' branch' ELSE channel END", "trim(raw)")
scalar("cln2_normalize_casing", "documents.accounts", "account_type", text.normalize_casing, "all_accounts",
       "CASE account_type WHEN 'credit_card' THEN ' credit_card' ELSE account_type END", "lower(trim(raw))")
scalar("cln3_customer_status", "documents", "status", text.normalize_customer_status, "docs", "status",
       mapped("raw", activo="active", inactivo="inactive", suspendido="suspended", cerrado="closed"))
scalar("cln4_account_status", "raw_accounts", "status", text.normalize_account_status, "raw_accounts", "status",
       mapped("raw", activo="active", congelado="frozen", cerrado="closed"))
scalar("cln5_customer_segment", "documents", "customer_segment", text.normalize_customer_segment, "docs",
       "customer_segment", mapped("raw", minorista="retail", banca_privada="private_banking", pyme="sme"))
scalar("cln6_transaction_type", "raw_transactions", "transaction_type", text.normalize_transaction_type,
       "raw_transactions", "transaction_type",
       mapped("raw", deposito="deposit", retiro="withdrawal", transferencia="transfer", pago="payment",
              reembolso="refund", comision="fee"))
scalar("cln7_transaction_category", "documents.transactions", "category", text.normalize_transaction_category,
       "all_transactions", "coalesce(category, '')", "CASE WHEN length(raw) > 4 THEN lower(raw) END")
scalar("cln8_collateral_type", "raw_loans", "collateral_type", text.normalize_collateral_type, "raw_loans",
       "collateral_type", "nullif(lower(raw), 'n/a')")
scalar("cln9_kyc_status", "documents", "kyc_status", text.normalize_kyc_status, "docs", "kyc_status", "lower(trim(raw))")
scalar("cln10_loan_status", "raw_loans", "status", text.normalize_loan_status, "raw_loans", "status", "lower(raw)")
scalar("cln11_loan_type", "raw_loans", "loan_type", text.normalize_loan_type, "raw_loans", "loan_type", "lower(raw)")
scalar("cln12_transaction_status", "raw_transactions", "status", text.normalize_transaction_status,
       "raw_transactions", "status", "lower(raw)")
register(
    "cln13_currency_code",
    lambda w: tally(w.table("documents"), col("credit_info.currency").alias("raw"),
                    text.currency_code(col("credit_info.currency")).alias("clean")),
    f"""SELECT ' ' || lower(c) AS raw, c AS clean, count(*) AS n
        FROM (SELECT {pick(CURRENCIES, 'c_nationkey')} AS c FROM docs) GROUP BY ALL""",
)
scalar("cln14_parse_date", "raw_transactions", "transaction_date", dates.parse_date_multi_format, "raw_transactions",
       "transaction_date", parsed_date("raw"))
register(
    "cln15_safe_cast_numeric",
    lambda w: tally(w.table("documents"),
                    numbers.safe_cast_numeric(col("credit_info.utilization_pct")).alias("utilization"),
                    numbers.safe_cast_numeric(col("digital_engagement.avg_monthly_logins"), "int").alias("logins")),
    tally_sql("docs", f"{R('TRY_CAST(utilization_text AS DOUBLE)')} AS utilization",
              "TRY_CAST(logins_text AS INTEGER) AS logins"),
)
register(
    "cln16_safe_cast_boolean",
    lambda w: tally(w.table("documents"), col("digital_engagement.push_notifications").alias("raw"),
                    numbers.safe_cast_boolean(col("digital_engagement.push_notifications")).alias("clean")),
    tally_sql("docs", "push_text AS raw", """CASE push_text WHEN 'maybe' THEN NULL
        ELSE push_text IN ('true', 'Y', 'si', '1') END AS clean"""),
)
register("cln17_nullable_number",
         lambda w: tally(w.table("documents"), numbers.nullable_number(col("lat")).alias("lat"),
                         numbers.nullable_number(col("risk_score")).alias("risk_score")),
         tally_sql("docs", f"{R('lat')} AS lat", f"{R('risk_score')} AS risk_score"))


def _recovered(w: Warehouse) -> DataFrame:
    parsed = flatten.parse_documents(w.table("bronze"), recover_money=True)
    amounts = flatten.flatten_array(parsed, flatten.TRANSACTIONS)
    return amounts.groupBy("transaction_type").agg(
        F.count("amount").alias("amounts"), numbers.exact_sum(col("amount")).alias("total"))


register("cln18_parse_money", _recovered, f"""
    SELECT transaction_type, count(*) AS amounts, {R(S('amount_recovered'))} AS total
    FROM all_transactions GROUP BY 1""")
register(
    "cln19_validated_range",
    lambda w: tally(w.table("dim_credit_info"),
                    *[col(c) for c in ("credit_score_raw", "credit_score", "is_credit_score_valid")]),
    """SELECT CAST(s AS INTEGER) AS credit_score_raw, CAST(CASE WHEN s >= 300 AND s <= 850 THEN s END AS INTEGER)
        AS credit_score, s >= 300 AND s <= 850 AS is_credit_score_valid, count(*) AS n
        FROM (SELECT credit_score AS s FROM latest_docs) GROUP BY ALL""",
)
register(
    "cln20_validated_point",
    lambda w: w.table("dim_customer").select("customer_id", "lat", "lon", "is_geo_valid"),
    f"""SELECT customer_id, {R('CASE WHEN ok THEN lat END')} AS lat, {R('CASE WHEN ok THEN lon END')} AS lon,
        ok AS is_geo_valid
        FROM (SELECT *, lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AS ok FROM latest_docs)""",
)
scalar("cln21_null_token", "raw_transactions", "category", text.null_token_to_null, "raw_transactions", "category",
       "CASE WHEN raw NOT IN ('NA', 'N/A', 'null') THEN raw END")
scalar("cln22_trim", "documents.transactions", "description", F.trim, "all_transactions", "' ' || description", "trim(raw)")

# --- dates, numbers, conditions -----------------------------------------------------------


def as_of(w: Warehouse) -> Column:
    return F.lit(w.as_of)


register(
    "dte1_completed_months",
    lambda w: tally(w.table("fct_loans"), "start_date", "end_date",
                    dates.completed_months(as_of(w), col("start_date")).alias("age_months"),
                    dates.completed_months(col("end_date"), as_of(w)).alias("left_months")),
    tally_sql("fct_loans", "start_date", "end_date", f"CAST({months(AS_OF, 'start_date')} AS INTEGER) AS age_months",
              f"CAST({months('end_date', AS_OF)} AS INTEGER) AS left_months"),
)
register("dte2_completed_years",
         lambda w: w.table("dim_customer").select(
             "customer_id", dates.completed_years(as_of(w), col("date_of_birth")).alias("years")),
         f"""SELECT customer_id, CAST(year({AS_OF}) - year(date_of_birth) - CASE WHEN
             month(date_of_birth) * 100 + day(date_of_birth) > 1231 THEN 1 ELSE 0 END AS INTEGER) AS years
             FROM dim_customer""")
register("dte3_tenure_years",
         lambda w: tally(w.table("dim_customer"), dates.tenure_years(col("registration_date"), as_of(w)).alias("years")),
         f"""SELECT {R(f"(({AS_OF} - registration_date) / CAST(365.25 AS DOUBLE))", 2)} AS years, count(*) AS n
             FROM dim_customer GROUP BY ALL""")
PARTS = "year quarter month week_of_year day_of_month day_of_week_num day_of_year".split()
TRUNCS = "week_start month_start quarter_start year_start".split()
LABELS = "month_name month_name_short day_name day_name_short year_month_label year_quarter_label".split()
SORT_KEYS = ["year_month_key", "year_quarter_key"]


def _calendar_query(name: str, wanted: list[str]) -> None:
    """Calendar attributes of every transaction date."""
    def build(w: Warehouse) -> DataFrame:
        day = col("transaction_date")
        attributes = seeds.calendar_attributes(day)
        return tally(w.table("fct_transactions"), day, *[attributes[c].alias(c) for c in wanted])

    register(name, build, f"""SELECT date_day AS transaction_date, {', '.join(wanted)}, count(*) AS n
        FROM fct_transactions JOIN calendar_days ON date_day = transaction_date GROUP BY ALL""")


for _name, _wanted in {"dte4_date_parts": PARTS, "dte5_date_trunc": TRUNCS, "dte6_date_labels": LABELS,
                       "dte7_sort_keys": SORT_KEYS, "dte8_weekend": ["is_weekend"]}.items():
    _calendar_query(_name, _wanted)
register("dte9_weekday_name",
         lambda w: tally(w.table("fct_transactions"), "day_of_week",
                         dates.weekday_name(col("day_of_week")).alias("day_name")),
         tally_sql("fct_transactions", "day_of_week", "dayname(transaction_date) AS day_name"))
register("dte10_before_current_month",
         lambda w: tally(w.table("fct_transactions").where(
             col("transaction_date") < dates.month_of(as_of(w))), dates.month_of(col("transaction_date")).alias("month")),
         """SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS n FROM fct_transactions
            WHERE transaction_date < DATE '2001-12-01' GROUP BY ALL""")
register("mth1_round_half_away",
         lambda w: w.table("dim_loan").groupBy("loan_type").agg(
             F.round(numbers.exact_avg(col("monthly_payment")), 2).alias("payment"),
             F.round(numbers.exact_avg(-col("monthly_payment")), 2).alias("negative")),
         """SELECT loan_type, CAST(round(CAST(CAST(p AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS payment,
              -CAST(round(CAST(CAST(p AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS negative
            FROM (SELECT loan_type, sum(round_even(monthly_payment * 1e4, 0)) / 1e4 / count(*) AS p
                  FROM dim_loan GROUP BY 1)""")
register("mth2_safe_ratio",
         lambda w: w.table("dim_customer").join(w.table("agg_customer_activity"), "customer_id").select(
             "customer_id", numbers.ratio(col("loans_count"), col("accounts_count")).alias("loans_per_account")),
         f"SELECT customer_id, {R(Q('loans_count', 'accounts_count'))} AS loans_per_account FROM agg_customer_activity")
register("mth3_billing_months",
         lambda w: tally(w.table("dim_customer"), "tenure_months",
                         numbers.billing_months(col("tenure_months")).alias("months")),
         tally_sql("dim_customer", "tenure_months",
                   "CASE WHEN tenure_months > 3 THEN tenure_months ELSE 3 END AS months"))
register("mth4_percent_to_rate",
         lambda w: tally(w.table("stg_loans"), "interest_rate", numbers.percent_to_rate(col("interest_rate")).alias("rate")),
         tally_sql("stg_loans", f"{R('interest_rate')} AS interest_rate", f"{R('interest_rate / 1e2')} AS rate"))
register("mth5_monthly_interest",
         lambda w: w.table("int_loan_portfolio_metrics").select("loan_id", "status", "monthly_interest_accrued"),
         f"""SELECT loan_id, status, CASE WHEN status IN ('default', 'paid_off') OR outstanding_balance IS NULL THEN 0
             ELSE {R('outstanding_balance * (interest_rate / 1e2) / 12')} END AS monthly_interest_accrued FROM stg_loans""")
register("mth6_principal_repaid",
         lambda w: w.table("dim_loan").select("loan_id", "principal_repaid", "principal_repaid_pct"),
         f"""SELECT loan_id, {R('principal - outstanding_balance')} AS principal_repaid,
             {R('(principal - outstanding_balance) / principal * 100')} AS principal_repaid_pct FROM stg_loans""")
register("mth7_to_usd",
         lambda w: to_usd(w.table("fct_loans"), w.table("fx_rates"), "currency").groupBy("currency").agg(
             numbers.exact_sum(col("principal") * col("rate_to_usd")).alias("principal_usd")),
         f"SELECT currency, {R(S('principal * rate'))} AS principal_usd FROM fct_loans JOIN fx_rates USING (currency) GROUP BY 1")
register("mth8_differs",
         lambda w: tally(w.table("int_customer_monthly_revenue"), numbers.differs(
             col("monthly_fee_revenue_native"), col("monthly_fee_revenue_usd"), 0.0001).alias("apart")),
         tally_sql("int_customer_monthly_revenue",
                   "abs(monthly_fee_revenue_native - monthly_fee_revenue_usd) > 1e-4 AS apart"))
register("cnd1_conditions",
         lambda w: tally(w.table("fct_transactions"),
                         F.coalesce("merchant", "category", F.lit("?")).alias("label"),
                         F.nullif(col("channel"), F.lit("web")).alias("channel"),
                         F.when(col("amount").between(10_000, 50_000), "mid").when(col("amount") > 50_000, "high")
                         .otherwise("low").alias("size"),
                         (col("merchant") == col("category")).alias("same")),
         tally_sql("fct_transactions", "coalesce(merchant, category, '?') AS label",
                   "CASE WHEN channel <> 'web' THEN channel END AS channel",
                   "CASE WHEN amount > 50000 THEN 'high' WHEN amount >= 10000 THEN 'mid' ELSE 'low' END AS size",
                   "merchant = category AS same"))

# --- buckets ---------------------------------------------------------------------------

register("bkt1_age_bucket", lambda w: tally(w.table("dim_customer"), "age", buckets.age_bucket(col("age")).alias("bucket")),
         tally_sql("dim_customer", "age", """CASE WHEN age > 65 THEN '65+' WHEN age > 50 THEN '51-65'
             WHEN age > 35 THEN '36-50' WHEN age > 25 THEN '26-35' WHEN age >= 18 THEN '18-25'
             WHEN age IS NULL THEN 'unknown' ELSE 'under_18' END AS bucket"""))
register("bkt2_tenure_bucket",
         lambda w: tally(w.table("dim_customer"), "tenure_months",
                         buckets.tenure_bucket(col("tenure_months")).alias("bucket")),
         tally_sql("dim_customer", "tenure_months", """CASE WHEN tenure_months > 24 THEN 'loyal'
             WHEN tenure_months >= 6 THEN 'established' WHEN tenure_months IS NULL THEN 'unknown' ELSE 'new' END AS bucket"""))
register("bkt3_risk_bucket",
         lambda w: tally(w.table("dim_customer"), "risk_score", buckets.risk_bucket(col("risk_score")).alias("bucket")),
         tally_sql("dim_customer", f"{R('risk_score')} AS risk_score", f"{risk_band('risk_score')} AS bucket"))
register("bkt4_credit_score_bucket",
         lambda w: tally(w.table("dim_credit_info"), "credit_score_raw",
                         buckets.credit_score_bucket(col("credit_score_raw")).alias("bucket")),
         tally_sql("dim_credit_info", "credit_score_raw", f"{score_band('credit_score_raw')} AS bucket"))
register("bkt5_utilization_bucket",
         lambda w: tally(w.table("dim_credit_info"), "utilization_pct_raw",
                         buckets.utilization_bucket(col("utilization_pct_raw")).alias("bucket")),
         tally_sql("dim_credit_info", f"{R('utilization_pct_raw')} AS utilization_pct_raw",
                   f"{utilization_band('utilization_pct_raw')} AS bucket"))
register("bkt6_dpd_band",
         lambda w: tally(w.table("stg_loans"), "days_past_due", buckets.dpd_band(col("days_past_due")).alias("bucket")),
         tally_sql("int_loan_portfolio_metrics", "days_past_due", "dpd_bucket AS bucket"))
register("bkt7_days_past_due_bucket",
         lambda w: tally(w.table("stg_loans"), "days_past_due",
                         buckets.days_past_due_bucket(col("days_past_due")).alias("bucket")),
         tally_sql("stg_loans", "days_past_due", """CASE WHEN days_past_due > 90 THEN '90+' WHEN days_past_due > 60 THEN '61-90'
             WHEN days_past_due > 30 THEN '31-60' WHEN days_past_due > 0 THEN '1-30'
             WHEN days_past_due = 0 THEN 'current' ELSE 'unknown' END AS bucket"""))
register("bkt8_display_order",
         lambda w: tally(w.table("int_customer_risk_profile"), "credit_score_bucket",
                         buckets.display_order(col("credit_score_bucket"), "credit_score").alias("position")),
         tally_sql("int_customer_risk_profile", "credit_score_bucket", """CAST(list_position(
             ['poor', 'fair', 'good', 'very_good', 'exceptional', 'unknown'], credit_score_bucket) AS BIGINT) AS position"""))
