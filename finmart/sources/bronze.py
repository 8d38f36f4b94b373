"""Raw customer documents: landing files, the append-only batch table, batch inspection."""

from __future__ import annotations

import random
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from finmart import schemas
from finmart.session import cut_lineage


class EmptyBatchError(ValueError):
    """The landed file holds no documents, or is not a list of documents."""


def read_json_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per document, kept as raw JSON text in column ``data``.

    ``lines=True`` reads newline-delimited documents. Otherwise every file is one JSON array of
    objects; the tasks that read its byte ranges cut it into elements, once, and the elements are
    checkpointed in the order of the file. A file that is empty or anything else than such an array is an error.
    """
    if lines:
        documents = spark.read.text(path).where(F.trim("value") != "").toDF("data")
        if documents.isEmpty():
            raise EmptyBatchError(f"no documents in {path}")
        return documents
    pieces = array_pieces(spark, path)
    shape = pieces.agg(
        F.bool_and("sound").alias("sound"), F.count_if(~F.col("is_element")).alias("ends"),
        F.count_if("is_element").alias("documents"),
    ).first()
    if not shape["sound"] or shape["ends"] < len(spark.read.text(path).inputFiles()):
        raise EmptyBatchError(f"{path} is not a JSON array of documents")
    if not shape["documents"]:
        raise EmptyBatchError(f"no documents in {path}")
    return pieces.where("is_element").select("data")


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _depth_change(text: Column) -> Column:
    """Opened minus closed brackets; the closing braces are the ends of the records."""
    return _occurrences(text, "{") + _occurrences(text, "[") - _occurrences(text, "]")


def _scanned(records: DataFrame) -> DataFrame:
    """What every record does to a scanner that starts outside or inside of a string.

    The quotes cut a record into parts that lie in and out of a string by turns, so the brackets
    that do not count for one start are those that count for the other.
    """
    unescaped = F.replace(F.replace("value", F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return (
        records.withColumn("bare", unescaped)
        .withColumn("code", F.regexp_replace("bare", '"[^"]*("|$)', ""))
        .withColumns({"flips": _occurrences(F.col("bare"), '"') % 2, "change": _depth_change(F.col("code")),
                      "change_of_both": _depth_change(F.col("bare"))})
        # the brace that ends the record closes something unless it stands in a string
        .withColumn("from_outside", F.col("change") - (F.col("flips") == 0).cast("int"))
        .withColumn("from_inside", F.col("change_of_both") - F.col("change") - (F.col("flips") == 1).cast("int"))
        .drop("bare", "code", "change", "change_of_both")
    )


def _earlier(window: WindowSpec, amount: str | Column) -> Column:
    return F.coalesce(F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _in_range() -> WindowSpec:
    return Window.partitionBy("file", "start").orderBy("at")


def _over_ranges() -> WindowSpec:
    return Window.partitionBy("file").orderBy("start")


#: Ranges that are broadcast to the records, and characters of elements that span ranges; more are joined by a shuffle.
BROADCAST_RANGES, BROADCAST_CHARACTERS = 100_000, 8 << 20


def _changes() -> dict[int, Column]:
    """Change of depth by a record, by the side of a string on which its range starts."""
    return {side: F.when(F.col("flipped") == side, F.col("from_outside")).otherwise(F.col("from_inside")) for side in (0, 1)}


def _with_depth(records: DataFrame) -> DataFrame:
    """Depth after every record, and whether it closes an element."""
    changes = _changes()
    return records.withColumn(
        "depth", F.col("depth_before") + F.sum(F.when(F.col("side") == 0, changes[0]).otherwise(changes[1])).over(_in_range())
    ).withColumn("closes", (F.col("depth") == 1) & ((F.col("side") + F.col("flipped") + F.col("flips")) % 2 == 0))


def _ranges(records: DataFrame) -> DataFrame:
    """One row per range: state of the scanner and number of elements before it."""
    scanned = _scanned(records).drop("value").withColumn("flipped", _earlier(_in_range(), "flips") % 2)
    changes = _changes()
    states = (
        scanned.groupBy("file", "start")
        .agg((F.sum("flips") % 2).alias("flips"), F.sum(changes[0]).alias("change_0"), F.sum(changes[1]).alias("change_1"))
        .withColumn("side", _earlier(_over_ranges(), "flips") % 2)
        .withColumn("depth_before", _earlier(_over_ranges(), F.when(F.col("side") == 0, F.col("change_0")).otherwise(F.col("change_1"))))
        .select("file", "start", "side", "depth_before", F.lead("start").over(_over_ranges()).isNull().alias("is_last"))
    )
    return (
        _with_depth(scanned.join(states, ["file", "start"]))
        .groupBy("file", "start", "side", "depth_before", "is_last")
        .agg(F.count_if("closes").alias("n"), F.max_by("closes", "at").alias("ends_closed"))
        .withColumn("elements_before", _earlier(_over_ranges(), "n"))
        .withColumn("goes_on", ~F.lag("ends_closed", 1, True).over(_over_ranges()))
        .drop("n", "ends_closed")
    )


def _fragments(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """The part of every element inside one range; ``goes_on`` if the element starts in an earlier one.

    The records are shuffled once, by sampled bounds of their ranges, and stay in the order of the file.
    """
    placed = (
        _with_depth(_scanned(records.repartitionByRange("file", "start"))
                    .withColumn("flipped", _earlier(_in_range(), "flips") % 2).join(ranges, ["file", "start"]))
        .withColumn("is_end", F.col("is_last") & F.lead("at").over(_in_range()).isNull())
        .withColumn("element", _earlier(_in_range(), F.col("closes").cast("int")))
        .withColumn("place", F.col("elements_before") + F.col("element"))
        .withColumn("goes_on", F.col("goes_on") & (F.col("element") == 0) & ~F.col("is_end"))
    )
    values = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda r: r["value"])
    return (
        placed.groupBy("file", "start", "is_end", "place", "goes_on")
        .agg(F.array_join(values, "}").alias("text"), F.bool_or("closes").alias("closed"))
        # the last record of a file has no brace after it
        .withColumn("text", F.when(F.col("is_end"), F.col("text")).otherwise(F.concat("text", F.lit("}"))))
        .orderBy("file", "start", "place")
    )


def array_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(data, is_element, sound)``: the elements of the array in every file, in their order, and its end.

    Tasks read byte ranges of a file as records that end at a closing brace. What a record does to
    a scanner is known without its start: it flips the side of a string or not, and changes the
    depth by one of two numbers, for a start outside or inside of a string. The changes are added
    up within each range and then over the ranges of a file, which gives the depth after every
    record; an element ends where it is one again. ``sound`` tells whether a piece is what an
    array of objects has there. No task needs more than one range and one element at a time.

    The text is shuffled once, by range. Elements are put together inside their range and stored;
    only the rest of an element that goes on in a later range is moved again.
    """
    records = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value")
    ranges = cut_lineage(_ranges(records))
    if ranges.count() <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    fragments = cut_lineage(_fragments(records, ranges))
    rests = fragments.where("goes_on")
    pieces = fragments.where("not goes_on")
    moved = rests.agg(F.sum(F.length("text")).alias("characters")).first()["characters"]
    if moved is not None:
        rest = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda r: r["text"]), "")
        rests = rests.groupBy("file", "place").agg(rest.alias("rest"), F.bool_or("closed").alias("rest_closed")).withColumn(
            "is_end", F.lit(False))
        if moved <= BROADCAST_CHARACTERS:
            rests = F.broadcast(rests)
        pieces = pieces.join(rests, ["file", "place", "is_end"], "left").withColumns({
            "text": F.concat("text", F.coalesce("rest", F.lit(""))),
            "closed": F.col("closed") | F.coalesce("rest_closed", F.lit(False)),
        })
        if moved > BROADCAST_CHARACTERS:
            pieces = pieces.orderBy("file", "place")
    lead = F.regexp_replace(F.regexp_extract("text", "^[^{]*", 0), r"\s", "")
    return pieces.select(
        F.expr("substring(text, instr(text, '{'))").alias("data"), (~F.col("is_end")).alias("is_element"),
        F.when(F.col("is_end"), F.regexp_replace("text", r"\s", "") == F.when(F.col("place") == 0, "[]").otherwise("]"))
        .otherwise(F.col("closed") & (lead == F.when(F.col("place") == 0, "[").otherwise(","))).alias("sound")
    )


def stamp_batch(
    documents: DataFrame,
    load_id: str | Column,
    source_file: str,
    load_timestamp: datetime | Column,
    first_id: int = 1,
) -> DataFrame:
    """Bronze rows of one batch: one load id, one timestamp, ids from ``first_id`` on.

    Documents that already carry an ``id`` keep it.
    """
    surrogate = (
        F.col("id") if "id" in documents.columns
        else F.monotonically_increasing_id() + F.lit(first_id)
    )
    return documents.select(
        surrogate.cast("long").alias("id"),
        F.lit(load_id).alias("load_id"),
        F.col("data"),
        F.lit(source_file).alias("source_file"),
        F.lit(load_timestamp).cast("timestamp").alias("load_timestamp"),
    )


#: A batch owns 2**48 ids: 2**33 for each of at most 2**15 tasks that write it.
BATCH_BITS, TASK_BITS = 48, 15
CLAIMS = "_claims"


def claim_batch(spark: SparkSession, path: str) -> int:
    """Number of a new batch, claimed by a file in the table's folder.

    A writer leaves a file of its own under the number and looks again: the number is its own only
    if no other file claims it. Of two writers the later one always sees the earlier one, so a
    number never has two owners; one that nobody owns, or whose batch was never written, is a gap.
    No data file is read.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(path, CLAIMS)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)

    def claimed() -> list[int]:
        return [int(f.getPath().getName().split("-")[0]) for f in files.listStatus(folder)]

    number = max(claimed(), default=0) + 1
    while True:
        files.create(jvm.Path(folder, f"{number}-{uuid.uuid4().hex}")).close()
        if claimed().count(number) == 1:
            return number
        number = max(claimed()) + random.randint(1, 4)


def append_bronze(
    documents: DataFrame,
    path: str,
    load_id: str,
    source_file: str,
    load_timestamp: datetime | None = None,
) -> None:
    """Append one stamped batch to the bronze table at ``path``.

    Ids start at the batch's claimed number times ``2**48``, so later batches sort after earlier
    ones without reading them.
    """
    spark = documents.sparkSession
    first_id = 1
    if "id" not in documents.columns:
        first_id = claim_batch(spark, path) << BATCH_BITS
        documents = documents.coalesce(1 << TASK_BITS)  # fewer tasks stay as they are
    moment = load_timestamp or spark.range(1).select(F.current_timestamp()).first()[0]
    batch = stamp_batch(documents, load_id, source_file, moment, first_id)
    # each load commits in its own folder, so appends at the same time do not meet
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(load_id)
    batch.drop("load_id").write.mode("append").parquet(f"{path}/load_id={folder}")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BRONZE).parquet(path).select(*schemas.BRONZE.names)


def latest_batch(bronze: DataFrame) -> DataFrame:
    """Rows of the batch with the newest load timestamp.

    The newest load id is one scalar, so no row is shuffled; ties go to the larger id.
    """
    newest = bronze.agg(
        F.max_by("load_id", F.struct("load_timestamp", "load_id")).alias("newest")
    )
    return bronze.where(F.col("load_id") == newest.scalar())


def batch_inventory(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("load_id").agg(
        F.count("*").alias("records"), F.max("load_timestamp").alias("loaded_at")
    )
