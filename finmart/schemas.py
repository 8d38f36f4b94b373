"""Explicit schemas of the raw documents and the envelope they arrive in."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _fields(names: str, data_type) -> list[StructField]:
    return [StructField(name, data_type) for name in names.split()]


BRONZE = StructType([
    StructField("id", LongType()),
    StructField("load_id", StringType()),
    StructField("data", StringType()),
    StructField("source_file", StringType()),
    StructField("load_timestamp", TimestampType()),
])

ACCOUNT = StructType(
    _fields("account_id account_type currency", StringType())
    + _fields("balance credit_limit interest_rate", DoubleType())
    + _fields("opened_date status branch_code", StringType())
)

TRANSACTION = StructType(
    _fields("transaction_id account_id date", StringType())
    + _fields("amount", DoubleType())
    + _fields("currency type category merchant channel status description", StringType())
)

LOAN = StructType(
    _fields("loan_id type currency", StringType())
    + _fields("principal outstanding_balance interest_rate", DoubleType())
    + _fields("term_months", IntegerType())
    + _fields("monthly_payment", DoubleType())
    + _fields("start_date end_date status", StringType())
    + _fields("days_past_due", IntegerType())
    + _fields("collateral_type", StringType())
)

# Scalars stay text: the source mixes numbers, quoted numbers and tokens.
PROFILE_FIELDS = (
    "customer_id first_name last_name email phone_number date_of_birth gender nationality "
    "city country address lat lon registration_date kyc_status risk_score customer_segment "
    "relationship_manager status"
).split()

CREDIT_INFO = StructType(_fields(
    "credit_score currency utilization_pct total_limit total_used num_credit_accounts "
    "oldest_account_age_months late_payments_12m inquiries_6m bankruptcy_flag",
    StringType(),
))

DIGITAL_ENGAGEMENT = StructType(_fields(
    "mobile_app_registered web_banking_registered last_login_date avg_monthly_logins "
    "preferred_channel push_notifications paperless_statements",
    StringType(),
))


def document_schema(money_as_text: bool = False) -> StructType:
    """Schema of one raw customer document.

    ``money_as_text`` keeps the array money fields as text so that quoted amounts can be
    recovered later; by default a quoted amount parses to NULL.
    """

    def element(schema: StructType) -> StructType:
        if not money_as_text:
            return schema
        return StructType([
            StructField(f.name, StringType() if isinstance(f.dataType, DoubleType) else f.dataType)
            for f in schema
        ])

    return StructType(
        _fields(" ".join(PROFILE_FIELDS), StringType())
        + [
            StructField("accounts", ArrayType(element(ACCOUNT))),
            StructField("transactions", ArrayType(element(TRANSACTION))),
            StructField("loans", ArrayType(element(LOAN))),
            StructField("credit_info", CREDIT_INFO),
            StructField("digital_engagement", DIGITAL_ENGAGEMENT),
        ]
    )


FX_RATES = StructType([
    StructField("currency", StringType()),
    StructField("rate_to_usd", DecimalType(18, 8)),
    StructField("as_of_date", DateType()),
])

COUNTRY_CURRENCY = StructType(_fields("country_code currency_code", StringType()))
