"""Text cleaning and category normalization."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Surface form -> canonical form, after trimming and lower-casing.
CUSTOMER_STATUS = {
    "activo": "active",
    "inactivo": "inactive",
    "suspendido": "suspended",
    "cerrado": "closed",
}
ACCOUNT_STATUS = {"activo": "active", "congelado": "frozen", "cerrado": "closed"}
CUSTOMER_SEGMENT = {
    "minorista": "retail",
    "banca_privada": "private_banking",
    "pyme": "sme",
}
TRANSACTION_TYPE = {
    "deposito": "deposit",
    "retiro": "withdrawal",
    "transferencia": "transfer",
    "pago": "payment",
    "reembolso": "refund",
    "comision": "fee",
}
# Markers that stand for a missing category.
MISSING_CATEGORY = ("", "na", "null", "n/a")
# Null tokens recognised when profiling, compared trimmed and lower-cased.
NULL_TOKENS = ("null", "n/a", "na", "none", "")


def blank_to_null(text: Column) -> Column:
    """Trim blanks; a text with nothing left becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def normalize_casing(text: Column) -> Column:
    return F.lower(F.trim(text))


def currency_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def _mapped(text: Column, mapping: dict[str, str]) -> Column:
    folded = normalize_casing(text)
    chain = None
    for surface, canonical in mapping.items():
        chain = (F if chain is None else chain).when(folded == surface, canonical)
    return chain.otherwise(folded)


def _without(text: Column, markers: tuple[str, ...]) -> Column:
    folded = normalize_casing(text)
    return F.when(~folded.isin(*markers), folded)


def normalize_customer_status(text: Column) -> Column:
    return _mapped(text, CUSTOMER_STATUS)


def normalize_account_status(text: Column) -> Column:
    return _mapped(text, ACCOUNT_STATUS)


def normalize_customer_segment(text: Column) -> Column:
    return _mapped(text, CUSTOMER_SEGMENT)


def normalize_transaction_type(text: Column) -> Column:
    return _mapped(text, TRANSACTION_TYPE)


def normalize_transaction_category(text: Column) -> Column:
    return _without(text, MISSING_CATEGORY)


def normalize_collateral_type(text: Column) -> Column:
    """Like a category, and the word ``none`` stays: it means an unsecured loan."""
    return _without(text, MISSING_CATEGORY)


# These categories vary in casing only; the names keep call sites explicit.
normalize_kyc_status = normalize_casing
normalize_loan_status = normalize_casing
normalize_loan_type = normalize_casing
normalize_transaction_status = normalize_casing


def null_token_to_null(text: Column) -> Column:
    """NULL for a text that only spells a missing value; anything else is unchanged."""
    return F.when(~F.lower(F.trim(text)).isin(*NULL_TOKENS), text)
