"""Raw customer documents derived from order-management tables.

Every value is a pure function of the source keys. The derivation plants the defects the
cleaning layer exists for: mixed casing and languages, blanks, null tokens, four date
spellings, quoted numbers, sentinel scores, mixed booleans, repeated customers and
repeated transaction ids. Some transactions name the account of another order, so the payer
is not always the owner and some accounts do not exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from finmart.sources import bronze

BATCHES = {  # load id -> load timestamp
    "load-0001": "2001-11-30 06:00:00",
    "load-0002": "2001-12-15 06:00:00",
}
#: Order keys and line numbers of one document.
ORDER_BLOCK, LINE_BLOCK = 10_000, 1_000

HOME_COUNTRY = ("CO", "UY", "AR", "MX", "CL", "PE", "BR")
HOME_CURRENCY = ("COP", "UYU", "ARS", "MXN", "CLP", "PEN", "BRL")
SEGMENT_OF_MARKET = {
    "FURNITURE": "Retail",
    "BUILDING": "PYME",
    "AUTOMOBILE": "banca_privada",
    "MACHINERY": "PREMIUM",
    "HOUSEHOLD": " minorista ",
}
LOAN_TYPE_OF_PRIORITY = {
    "1-URGENT": "Personal",
    "2-HIGH": "MORTGAGE",
    "3-MEDIUM": "auto",
    "4-NOT SPECIFIED": "Education",
    "5-LOW": "business",
}
ACCOUNT_STATUS_OF_ORDER = {"F": "FROZEN", "O": "activo", "P": "Cerrado"}
BOOLEAN_SPELLINGS = (True, "false", "Y", "N", "si", "1", "0", "maybe")


def pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def lookup(column: Column, mapping: dict[str, str]) -> Column:
    return F.element_at(
        F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), column
    )


def div(number: Column, divisor: int) -> Column:
    return F.floor(number / divisor)


def padded(key: Column) -> Column:
    text = key.cast("string")
    return F.when(key < 10**7, F.lpad(text, 7, "0")).otherwise(text)


def spelled_date(day: Column, selector: Column) -> Column:
    which = selector % 4
    return (
        F.when(which == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(which == 1, F.date_format(day, "yyyyMMdd"))
        .when(which == 2, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "MM-dd-yyyy"))
    )


def days_after(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int"))


def either(name: str, as_text: Column, text: Column, value: Column) -> list[Column]:
    """A JSON field that is quoted on some rows: two same-named fields, one always NULL."""
    quoted = F.coalesce(as_text, F.lit(False))
    return [F.when(quoted, text).alias(name), F.when(~quoted, value).alias(name)]


def mixed_boolean(name: str, selector: Column) -> list[Column]:
    texts = tuple(None if isinstance(v, bool) else v for v in BOOLEAN_SPELLINGS)
    return either(name, selector % 8 != 0, pick(texts, selector % 8), F.lit(True))


def home(values: tuple, nation: Column) -> Column:
    return pick(values, nation % 7)


def profile_json(k: Column, slot: Column) -> Column:
    """Everything but the arrays, for one copy of a customer document."""
    repeated = slot == 1
    segment = lookup(F.col("c_mktsegment"), SEGMENT_OF_MARKET)
    kyc = pick(("verified", "PENDING", " Expired", "REJECTED"), k % 4)
    status = pick(("Activo", "INACTIVE", "suspendido", "Closed"), div(k, 4) % 4)
    country = home(HOME_COUNTRY, F.col("c_nationkey"))
    lat = ((k * 13) % 2000 - 950) / 10.0
    lon = ((k * 29) % 3800 - 1850) / 10.0
    score = (
        F.when(k % 20 == 0, 999999).when(k % 20 == 10, -99).otherwise(300 + (k * 53) % 551)
    )
    odd_utilization = F.when(k % 50 == 1, "$78.26").when(k % 50 == 2, "89.5 USD").when(k % 50 == 3, "83,5")
    utilization = F.when(k % 50 == 4, 120.0).otherwise(((k * 7) % 1001) / 10.0)
    credit = F.struct(
        score.alias("credit_score"),
        F.concat(F.lit(" "), F.lower(home(HOME_CURRENCY, F.col("c_nationkey")))).alias("currency"),
        *either("utilization_pct", odd_utilization.isNotNull(), odd_utilization, utilization),
        (1000 * (1 + k % 50)).alias("total_limit"),
        (10 * (k % 400)).alias("total_used"),
        (k % 9).alias("num_credit_accounts"),
        (k % 240).alias("oldest_account_age_months"),
        (k % 6).alias("late_payments_12m"),
        (k % 4).alias("inquiries_6m"),
        *either("bankruptcy_flag", k % 40 == 0, F.lit("yes"), F.lit(False)),
    )
    digital = F.struct(
        *mixed_boolean("mobile_app_registered", k),
        *mixed_boolean("web_banking_registered", k + 1),
        spelled_date(days_after("2001-06-01", k % 180), k).alias("last_login_date"),
        *either("avg_monthly_logins", k % 13 == 0, F.lit("N/A"), k % 60),
        pick(("mobile", "ATM", "branch", "Phone", "web"), k % 5).alias("preferred_channel"),
        *mixed_boolean("push_notifications", k + 2),
        *mixed_boolean("paperless_statements", k + 3),
    )
    return F.to_json(F.struct(
        F.col("customer_id"),
        F.concat(F.lit("Name"), k % 100).alias("first_name"),
        F.concat(F.lit("Family"), k % 997).alias("last_name"),
        F.concat(F.lit("user"), k, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+000"), k).alias("phone_number"),
        spelled_date(days_after("1930-01-01", (k * 7919) % 20200), k).alias("date_of_birth"),
        pick(("F", "m"), k % 2).alias("gender"),
        country.alias("nationality"),
        F.concat(F.lit("City_"), "c_nationkey").alias("city"),
        country.alias("country"),
        F.concat(k, F.lit(" Main St")).alias("address"),
        *either("lat", k % 10 == 5, lat.cast("string"), lat),
        lon.alias("lon"),
        spelled_date(days_after("1996-01-01", (k * 733) % 2170), div(k, 4)).alias("registration_date"),
        F.when(repeated, F.upper(kyc)).otherwise(kyc).alias("kyc_status"),
        ((k * 37) % 10001 / 100.0).alias("risk_score"),
        F.when(repeated, F.upper(segment)).otherwise(segment).alias("customer_segment"),
        F.concat(F.lit("RM-"), k % 20).alias("relationship_manager"),
        F.when(slot == 2, "Closed").when(repeated, F.lower(status)).otherwise(status).alias("status"),
        credit.alias("credit_info"),
        digital.alias("digital_engagement"),
    ))


def account_json() -> Column:
    o, price = F.col("o_orderkey"), F.col("o_totalprice")
    return F.to_json(F.struct(
        F.concat(F.lit("ACC-"), o).alias("account_id"),
        pick(("savings", " credit_card", "CHECKING", "investment"), o % 4).alias("account_type"),
        F.col("account_currency").alias("currency"),
        F.when(o % 33 != 0, price).alias("balance"),
        F.when(o % 4 == 1, price * 2).alias("credit_limit"),
        ((o % 50) / 10.0).alias("interest_rate"),
        spelled_date(F.col("o_orderdate").cast("date"), o).alias("opened_date"),
        lookup(F.col("o_orderstatus"), ACCOUNT_STATUS_OF_ORDER).alias("status"),
        F.concat(F.lit("BR-"), o % 500).alias("branch_code"),
    ))


def loan_json() -> Column:
    """NULL for the orders that carry no loan."""
    o, price = F.col("o_orderkey"), F.col("o_totalprice")
    opened = F.col("o_orderdate").cast("date")
    term = (12 * (1 + o % 10)).cast("int")
    loan = F.to_json(F.struct(
        F.concat(F.lit("LN-"), o).alias("loan_id"),
        lookup(F.col("o_orderpriority"), LOAN_TYPE_OF_PRIORITY).alias("type"),
        F.col("account_currency").alias("currency"),
        price.alias("principal"),
        F.when(o % 35 != 0, price * ((o * 17) % 100) / 100.0).alias("outstanding_balance"),
        (3 + (o % 320) / 10.0).alias("interest_rate"),
        term.alias("term_months"),
        (price / term).alias("monthly_payment"),
        spelled_date(opened, div(o, 3)).alias("start_date"),
        spelled_date(F.add_months(opened, term), div(o, 3)).alias("end_date"),
        pick(("CURRENT", "delinquent", "Default", "paid_off"), div(o, 24) % 4).alias("status"),
        pick((0, 0, 0, 15, 45, 75, 120, 200), div(o, 3) % 8).alias("days_past_due"),
        pick(("none", "Vehicle", "N/A", "real_estate"), o % 4).alias("collateral_type"),
    ))
    return F.when(o % 3 == 0, loan)


def transaction_json() -> Column:
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    account = F.when(supplier % 11 == 0, div(order, 2)).otherwise(order)
    currency = (
        F.when(supplier % 50 == 0, "EUR").when(supplier % 7 == 0, "MXN").otherwise(F.col("account_currency"))
    )
    category = F.when(
        part % 25 == 0, pick(("", "NA", "N/A", "null"), div(part, 25) % 4)
    ).otherwise(F.col("p_type"))
    return F.to_json(F.struct(
        F.concat_ws("-", F.lit("TX"), order, line).alias("transaction_id"),
        F.concat(F.lit("ACC-"), account).alias("account_id"),
        spelled_date(F.col("l_shipdate").cast("date"), part).alias("date"),
        *either("amount", part % 33 == 0, F.concat(F.lit("$"), price), price),
        currency.alias("currency"),
        pick(("DEPOSIT", "retiro", "Transferencia", "payment", "reembolso", "COMISION"), part % 6).alias("type"),
        category.alias("category"),
        F.when(part % 12 != 0, F.col("p_brand")).alias("merchant"),
        pick(("mobile", "WEB", "atm", " branch", "pos"), supplier % 5).alias("channel"),
        pick(("completed", "PENDING", "failed", "Reversed"), (div(part, 6) + line) % 4).alias("status"),
        F.concat(F.lit(" qty "), F.col("l_quantity").cast("int")).alias("description"),
    ))


def json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def documents(
    spark: SparkSession, sf_dir: str, order_block: int = ORDER_BLOCK, line_block: int = LINE_BLOCK
) -> DataFrame:
    """Raw documents with their ``id`` and ``load_id``.

    A document holds the items of one customer, one block of order keys and one block of line
    numbers, so neither a busy customer nor a long order makes an array outgrow its block. The
    rule looks at keys only and holds at every size. A customer without orders has one document.
    The documents of one customer share their ``id``, so splitting never decides which version
    of an item is the latest.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    customers = table("customer")
    of_document = ["o_custkey", "order_block", "line_block"]
    nation = customers.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = (
        table("orders").join(nation, "o_custkey")
        .withColumn("order_block", div(F.col("o_orderkey"), order_block))
        .withColumn("account_currency", F.when(F.col("o_orderkey") % 2 == 0, "USD")
                    .otherwise(home(HOME_CURRENCY, F.col("c_nationkey"))))
    )
    lines = (
        table("lineitem").where(F.col("l_orderkey").isNotNull())
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .withColumn("line_block", div(F.col("l_linenumber"), line_block))
    )
    k, slot = F.col("c_custkey"), F.col("slot")
    order = F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    line = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
                    "p_type", "p_brand")
    shell = F.struct("c_custkey", "c_nationkey", "c_mktsegment")
    owner = F.struct("o_custkey", "account_currency")

    def shells(parts: DataFrame, how: str) -> DataFrame:
        """A row per document: its customer and its blocks."""
        return (
            customers.join(parts.distinct(), k == F.col("o_custkey"), how)
            .withColumns({"o_custkey": k, **{c: F.coalesce(c, F.lit(0).cast("long")) for c in of_document[1:]}})
            .select(*of_document, shell.alias("shell"))
        )

    def put_together(items: DataFrame) -> DataFrame:
        """Documents from their items, which lie in one partition each. Plain columns are sorted, so that documents come out
        one by one; the much longer JSON is written after the sort."""
        return (
            items.sortWithinPartitions(*of_document)
            .select(*of_document, "shell", "account_currency", "order.*", "line.*")
            # most items are lines: a projection is compiled, what collect_list is given is interpreted row by row.
            # The JSON of all three kinds would make a method too long for Java to compile.
            .withColumn("transaction", F.when(F.col("l_orderkey").isNotNull(), transaction_json()))
            .groupBy(of_document)
            .agg(
                F.collect_list("shell").alias("shells"),
                F.concat(
                    F.lit(',"accounts":'), json_list(F.collect_list(F.when(F.col("o_orderkey").isNotNull(), account_json()))),
                    F.lit(',"transactions":'), json_list(F.collect_list("transaction")),
                    F.lit(',"loans":'), json_list(F.collect_list(loan_json())), F.lit("}"),
                ).alias("arrays"),
            )
            .select(F.inline("shells"), "arrays")
        )

    # Plain columns are shuffled once, by block of order keys: there lines meet the owners of their order and all items
    # their document. Lines beyond the first block of a long order are dealt out by document instead.
    meeting = (
        orders.where(F.col("o_orderkey").isNotNull())
        .select("order_block", F.col("o_orderkey").alias("orderkey"), F.lit(0).cast("long").alias("line_block"),
                owner.alias("owner"), order.alias("order"))
        .unionByName(
            lines.where("line_block = 0").select(
                div(F.col("l_orderkey"), order_block).alias("order_block"), F.col("l_orderkey").alias("orderkey"), "line_block",
                line.alias("line")),
            allowMissingColumns=True)
        .unionByName(
            shells(orders.select("o_custkey", "order_block", F.lit(0).cast("long").alias("line_block")), "left").select(
                "order_block", "line_block",
                F.struct("o_custkey", F.lit(None).cast("string").alias("account_currency")).alias("owner"), "shell"),
            allowMissingColumns=True)
        .repartition("order_block")
        .withColumn("owners", F.collect_list(F.when(F.col("order").isNotNull(), F.col("owner"))).over(
            Window.partitionBy("order_block", "orderkey")))
        .withColumn("owners", F.when(F.col("line").isNotNull(), F.col("owners")).otherwise(F.array("owner")))
        .select(F.inline("owners"), "order_block", "line_block", "order", "line", "shell")
    )
    further = lines.where(F.col("l_linenumber") >= line_block).join(
        orders.select(*of_document[:2], "o_orderkey", "account_currency"), F.col("l_orderkey") == F.col("o_orderkey"))
    dealt_out = (
        further.select(*of_document, "account_currency", line.alias("line"))
        .unionByName(shells(further.select(of_document), "inner"), allowMissingColumns=True)
        .withColumn("order", F.lit(None).cast(meeting.schema["order"].dataType))
        .repartition(*of_document)
    )
    slots = F.filter(
        F.array(F.lit(0), F.when(k % 75 == 0, 1), F.when(k % 50 == 0, 2)), lambda s: s.isNotNull()
    )
    assembled = (
        put_together(meeting).unionByName(put_together(dealt_out))
        .select("c_custkey", "c_nationkey", "c_mktsegment", "arrays", F.explode(slots).alias("slot"))
        .withColumn("customer_id", F.concat(F.lit("CUST-"), padded(k)))
        .withColumn("profile", profile_json(k, slot))
    )
    return assembled.select(
        (k * 4 + slot).alias("id"),
        F.when(slot == 2, "load-0002").otherwise("load-0001").alias("load_id"),
        F.concat(F.expr("left(profile, length(profile) - 1)"), "arrays").alias("data"),
    )


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze rows of both batches, derived in one pass over the tables."""
    return bronze.stamp_batch(
        documents(spark, sf_dir), F.col("load_id"), "demo_bank.json", lookup(F.col("load_id"), BATCHES)
    )
