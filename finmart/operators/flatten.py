"""Parsing raw documents and flattening their arrays into tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from finmart import schemas
from finmart.functions.numbers import parse_money
from finmart.functions.text import blank_to_null
from finmart.operators.dedup import keep_latest


@dataclass(frozen=True)
class ArraySpec:
    """How one array of a document becomes a table.

    ``untrimmed`` fields keep their text for a later parser.
    """

    array: str
    key: str
    element: StructType
    renames: dict[str, str] = field(default_factory=dict)
    untrimmed: tuple[str, ...] = ()

    def column_names(self) -> list[str]:
        return [self.renames.get(f.name, f.name) for f in self.element]


ACCOUNTS = ArraySpec("accounts", "account_id", schemas.ACCOUNT, untrimmed=("opened_date",))
TRANSACTIONS = ArraySpec(
    "transactions",
    "transaction_id",
    schemas.TRANSACTION,
    renames={"date": "transaction_date", "type": "transaction_type"},
    untrimmed=("date",),
)
LOANS = ArraySpec(
    "loans", "loan_id", schemas.LOAN, renames={"type": "loan_type"}, untrimmed=("start_date", "end_date")
)


def parse_documents(bronze: DataFrame, recover_money: bool = False) -> DataFrame:
    """Documents parsed once into typed columns, next to their lineage.

    A field of the wrong type becomes NULL without harming its siblings; a malformed
    document yields NULLs only.
    """
    schema = schemas.document_schema(money_as_text=recover_money)
    return bronze.select(
        F.col("id").alias("bronze_id"),
        "load_id",
        "load_timestamp",
        F.from_json("data", schema).alias("document"),
    ).select("bronze_id", "load_id", "load_timestamp", "document.*")


def flatten_array(parsed: DataFrame, spec: ArraySpec) -> DataFrame:
    """One row per array element, with cleaned texts and lineage columns.

    Documents whose array is empty or missing contribute no row. Money that was parsed as
    text (``recover_money``) is converted here.
    """
    exploded = parsed.select(
        "customer_id", "bronze_id", "load_timestamp", F.explode(spec.array).alias("item")
    )
    items = exploded.schema["item"].dataType

    def cleaned(name: str, target) -> F.Column:
        column = F.col(f"item.{name}")
        if isinstance(target, StringType) and name not in spec.untrimmed:
            return blank_to_null(column)
        if isinstance(target, DoubleType) and isinstance(items[name].dataType, StringType):
            return parse_money(column)
        return column

    return exploded.select(
        blank_to_null(F.col("customer_id")).alias("customer_id"),
        *[cleaned(f.name, f.dataType).alias(spec.renames.get(f.name, f.name)) for f in spec.element],
        "bronze_id",
        "load_timestamp",
    )


def stage_array(
    parsed: DataFrame, spec: ArraySpec, save: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, dict[str, int]]:
    """Flatten, deduplicate and save an array, with the counters of the run.

    The counters come from stored rows: ``parsed`` is read once more, only one field of the
    array's elements, and the saved table answers from its file footers. Tasks that run twice
    write their rows once, so the loss of an executor changes no counter.
    """
    saved = save(keep_latest(flatten_array(parsed, spec), spec.key))
    read = parsed.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(F.size(F.col(f"{spec.array}.{spec.key}"))), F.lit(0)).alias("items"),
    ).first()
    kept = saved.count()
    counters = {
        "documents_read": read["documents"], "after_explode": read["items"], "after_dedup": kept,
        "dropped": read["items"] - kept,
    }
    return saved, counters


def array_cardinality(parsed: DataFrame, arrays: tuple[str, ...] = ("accounts", "transactions", "loans")) -> DataFrame:
    """Smallest, mean and largest number of elements per document, one row per array."""
    sizes = F.array(*[
        F.struct(F.lit(a).alias("array_name"), F.coalesce(F.size(a), F.lit(0)).alias("n")) for a in arrays
    ])
    return (
        parsed.select(F.inline(sizes))
        .groupBy("array_name")
        .agg(F.count("*").alias("documents"), F.min("n").alias("min_items"),
             F.avg("n").alias("avg_items"), F.max("n").alias("max_items"))
    )


def key_sets(bronze: DataFrame) -> DataFrame:
    """How many documents share each set of top-level keys."""
    return (
        bronze.groupBy(F.array_join(F.array_sort(F.json_object_keys("data")), ",").alias("key_set"))
        .agg(F.count("*").alias("documents"))
    )


def json_type_census(bronze: DataFrame, fields: dict[str, str]) -> DataFrame:
    """How often each field (name -> path) holds a number, a text, a boolean or nothing."""
    document = F.try_parse_json("data")
    kinds = F.array(*[
        F.struct(
            F.lit(name).alias("field"),
            F.schema_of_variant(F.try_variant_get(document, path, "variant")).alias("token"),
        )
        for name, path in fields.items()
    ])
    token = F.col("token")
    kind = (
        F.when(token.isNull() | (token == "VOID"), "null")
        .when(token.isin("STRING", "BOOLEAN"), F.lower(token))
        .when(token.startswith("ARRAY"), "array")
        .when(token.startswith("OBJECT"), "object")
        .otherwise("number")
    )
    return (
        bronze.select(F.inline(kinds))
        .groupBy("field", kind.alias("json_type"))
        .agg(F.count("*").alias("documents"))
    )
