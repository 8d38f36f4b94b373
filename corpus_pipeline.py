"""From raw documents to token ids: toxicity, quality, near duplicates, mixing, byte-level BPE.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and works on all
rows that the stage before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finmart.llm.byte_bpe import digests, encode_documents
from finmart.llm.jaccard_join import keep_first_of_group
from finmart.llm.mixing import mix_and_repeat
from finmart.llm.quality_rules import keep_good
from finmart.llm.tables import Scratch
from finmart.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, trained on the labelled ones among them, lets pass.

    Rows with a NULL or empty text, a NULL id or a repeated id are scored like any other.
    """
    return drop_toxic(docs, _labels(spark, sf_dir))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep; NULL and empty texts fail the former."""
    return keep_good(docs, _labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id of every group of near duplicates; NULL and empty texts stay."""
    return keep_first_of_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the balanced mix of sources takes them: not at all, once or twice.

    NULL sources are a source; documents without words stay once; repeated rows are rows.
    """
    return mix_and_repeat(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and hashes of the ids and of the decoded bytes of every document taken.

    NULL and empty texts have no tokens; rows are answered one by one, whatever their ids.
    """
    return digests(encode_documents(docs, with_decoded=True))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE encoding and decoding", encoding),
]

#: Trained weights decide the first stage, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return docs
