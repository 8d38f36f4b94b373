"""Word-shingle Jaccard join: a size-aware heavy-light overlap join ending in components.

Sets are ordered by (frequent, fingerprint) and cut to a prefix in which two linked sets must
share ``need`` shingles. Light sets (up to the boundary) enumerate the two-element subsets of
their prefix; larger sets enter inverted lists that are scanned. The boundary minimises the
estimated cost of both. Whatever a list proposes is checked on the whole sets.

Only components are asked for. Sets that reach a list count how many of their shingles any
other such set holds: no intersection can be larger, which rules out most edited copies at once.
A list is then compared with the one of its members that shares most (linear in its length);
what still lies in different components is compared pair by pair. No link between different
sets is lost, and no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from finmart.llm.shingles import mix, set_fingerprint, shingle_hashes
from finmart.llm.tables import Scratch, components, long_id, small_batches

#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles a prefix pair must share: 1 + size // PREFIX_SHARE, at least two.
PREFIX_SHARE = 8
#: One set in SAMPLE measures shingle frequencies. They steer order and cost, never the result.
SAMPLE = 32
#: Frequent shingles: this often in the sample, or more where they overfill the bitmap.
FREQUENT = 3
#: Bits of the bitmap of frequent shingles that every task gets (512 KB), and its fullest state.
BITMAP_BITS = 1 << 22
BITMAP_MEMBERS = 1 << 19
#: Lists of frequent shingles are split into this many for the first pass.
SALTS = 32
#: Times that members too poor in held shingles for the smallest set of their list leave it.
PRUNINGS = 2
#: Weight of a shared two-subset: it proves what many single shingles would have to.
SUBSET_WEIGHT = 1 << 20

PROFILE = "doc_id long, set_id long, n long, sample array<long>"
POSTINGS = "key long, salt int, set_id long, n int, weight int"
SETS = "set_id long, n int, hashes array<long>"


def required_overlap(n):
    """Least intersection with any partner: ceil(PERCENT / 100 * n)."""
    return -(-PERCENT * n // 100)


def required_shared(n):
    return np.maximum(2, 1 + n // PREFIX_SHARE)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sampled: set[int] = set()  # a copy in another task is counted again, which only steers
    for batch in batches:
        ids, names, sizes, samples = batch.column(0), [], [], []
        for text in batch.column(1):
            hashes = shingle_hashes(text.as_py())
            name = set_fingerprint(hashes)
            names.append(name)
            sizes.append(len(hashes))
            taken = len(hashes) > 0 and name % SAMPLE == 0 and name not in sampled
            samples.append(hashes.view(np.int64) if taken else None)
            if taken:
                sampled.add(name)
        if len(sampled) > 200_000:
            sampled.clear()
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(samples, pa.list_(pa.int64()))],
            names=["doc_id", "set_id", "n", "sample"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_hashes(text.as_py()) for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([set_fingerprint(h) for h in found], pa.int64()),
                pa.array([len(h) for h in found], pa.int32()),
                pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())),
            ],
            names=["set_id", "n", "hashes"],
        )


def prefix_of(hashes: np.ndarray, frequent: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``length`` of the sorted hashes, frequent ones last, and which are frequent."""
    slots = (hashes & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    common = (frequent[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
    ordered = np.concatenate((hashes[~common], hashes[common]))[:length]
    return ordered, np.arange(len(ordered)) >= int(np.count_nonzero(~common))


def _postings_of(hashes: np.ndarray, frequent: np.ndarray, boundary: int):
    """Keys of one set: (key, frequent, weight) arrays."""
    n = len(hashes)
    slack = n - required_overlap(n)
    keys, hot, weights = [], [], []
    if n <= boundary:
        head, common = prefix_of(hashes, frequent, slack + 2)
        left, right = np.triu_indices(len(head), 1)
        low, high = np.minimum(head[left], head[right]), np.maximum(head[left], head[right])
        keys.append(mix(low * np.uint64(0x9E3779B97F4A7C15) ^ mix(high)))
        hot.append(common[left] & common[right])
        weights.append(np.full(len(left), SUBSET_WEIGHT, dtype=np.int32))
    if n >= required_overlap(boundary + 1):
        head, common = prefix_of(hashes, frequent, slack + int(required_shared(n)))
        keys.append(head)
        hot.append(common)
        weights.append(np.ones(len(head), dtype=np.int32))
    return np.concatenate(keys), np.concatenate(hot), np.concatenate(weights)


def _postings(frequent_bytes: bytes, boundary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(frequent_bytes, dtype=np.uint8)
        seen: set[int] = set()
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            keys, hot, weights, names, sizes = (np.concatenate(x) for x in zip(*rows))
            salt = np.where(hot, 1 + names % SALTS, 0).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(salt), pa.array(names), pa.array(sizes), pa.array(weights)],
                names=["key", "salt", "set_id", "n", "weight"],
            )

        for batch in batches:
            for text in batch.column(0):
                hashes = shingle_hashes(text.as_py())
                n, name = len(hashes), set_fingerprint(hashes)
                if n < 3 or name in seen:  # smaller sets link with equal sets only
                    continue
                if len(seen) >= 200_000:  # only spares repeats; a repeat changes nothing
                    seen.clear()
                seen.add(name)
                keys, hot, weights = _postings_of(hashes, frequent, boundary)
                rows.append((keys, hot, weights, np.full(len(keys), name, dtype=np.int64),
                             np.full(len(keys), n, dtype=np.int32)))
                held += len(keys)
                if held >= 100_000:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    return run


def _frequent_shingles(profile: DataFrame, scratch: Scratch) -> tuple[bytes, float]:
    """Bitmap of frequent shingles and the expected length of a scanned list of the others.

    At most BITMAP_MEMBERS slots come to the driver: the count they need rises until they fit.
    """
    counts = scratch.keep(
        profile.select(F.explode("sample").alias("h")).groupBy("h").agg(F.count("*").cast("int").alias("c")), "counts")
    # one row per distinct count
    sizes = counts.groupBy("c").agg(F.count("*").alias("m")).orderBy(F.col("c").desc()).collect()
    members, least = 0, None
    for row in sizes:
        members += row["m"]
        if row["c"] >= FREQUENT and members <= BITMAP_MEMBERS:
            least = row["c"]
    bits = np.zeros(BITMAP_BITS >> 3, dtype=np.uint8)
    if least is not None:
        slots = counts.where(F.col("c") >= least).select(
            F.col("h").bitwiseAND(BITMAP_BITS - 1).alias("slot")).distinct().toArrow()["slot"].to_numpy()
        np.bitwise_or.at(bits, slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8))
    rest = [row for row in sizes if least is None or row["c"] < least]
    total = sum(row["c"] * row["m"] for row in rest)
    square = sum(row["c"] ** 2 * row["m"] for row in rest)
    scratch.drop("counts")
    return bits.tobytes(), 1.0 + SAMPLE * (square / total - 1.0) if total else 1.0


def choose_boundary(sizes: DataFrame, scan: float) -> int:
    """Largest size that enumerates subsets: where keys of light sets and scans of the rest are least.

    ``sizes(n, sets)`` holds one row per distinct set size.
    """
    n = F.col("n")
    slack = n - F.ceil(n * PERCENT / 100)
    subsets = (slack + 2) * (slack + 1) / 2 * F.col("sets")
    scans = (slack + F.greatest(F.lit(2), 1 + F.floor(n / PREFIX_SHARE))) * F.col("sets") * (1.0 + scan)
    upto = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.orderBy("n").rowsBetween(1, Window.unboundedFollowing)
    cost = F.sum(subsets).over(upto) + F.coalesce(F.sum(scans).over(after), F.lit(0.0))
    best = sizes.select("n", cost.alias("cost")).orderBy("cost", "n").first()
    return max(2, int(best["n"])) if best else 2


def _still_apart(rows: DataFrame) -> DataFrame:
    """Lists with members of several groups, and the size of their smallest set."""
    return (
        rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min("n").alias("least"))
        .where(F.col("low") < F.col("high")).select("key", "least")
    )


def _comparable() -> Column:
    """Sizes, and shingles held by others too, under which a link is possible."""
    sizes = F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * PERCENT
    return sizes & ((100 + PERCENT) * F.least("hx", "hy") >= PERCENT * (F.col("nx") + F.col("ny")))


def _shared(n: Column) -> Column:
    return F.greatest(F.lit(2), 1 + F.floor(n / PREFIX_SHARE))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose whole sets reach the threshold."""
    left = sets.select(F.col("set_id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("set_id").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(100 * both >= PERCENT * (F.size("ha") + F.size("hb") - both)).select("a", "b")
    )


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    ``component_id`` is the least id reachable over links, the row's own id included. A NULL or
    wordless text has size 0 and links with nothing. Rows with a NULL id are returned with a
    NULL component and link nothing. Rows that repeat an id keep one row each; their texts
    count for that id. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").alias("text"))
    profile = scratch.keep(texts.mapInArrow(_profile, PROFILE), "profile")
    named = profile.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = named.groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.min("n").alias("n"))

    frequent, scan = _frequent_shingles(named, scratch)
    boundary = choose_boundary(classes.groupBy("n").agg(F.count("*").alias("sets")), scan)
    postings = texts.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(
        _postings(frequent, boundary), POSTINGS)

    # keys that two sets share; the lists of frequent shingles are split and kept unseen
    ordered = Window.partitionBy("key", "salt").orderBy("set_id")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    repeats = F.coalesce(F.lag("set_id").over(ordered) == F.col("set_id"), F.lit(False))
    shared = scratch.keep(
        postings.withColumn("apart", F.first("set_id").over(whole) < F.last("set_id").over(whole))
        .withColumn("repeats", repeats)
        .where((F.col("apart") | (F.col("salt") > 0)) & ~F.col("repeats")).drop("apart", "repeats", "salt"),
        "shared",
    )
    enough = (
        shared.groupBy("set_id").agg(F.sum("weight").alias("w"), F.first("n").alias("n"))
        .where(F.col("w") >= _shared(F.ceil(F.col("n") * PERCENT / 100))).select("set_id")
    )
    members = scratch.keep(shared.join(enough, "set_id"), "members")
    scratch.drop("shared")

    wanted = members.select("set_id").distinct().join(classes, "set_id").select(F.col("first_id").alias("doc_id")).distinct()
    sets = scratch.keep(
        texts.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(_sets, SETS).dropDuplicates(["set_id"]),
        "sets",
    )
    # shingles of a set that another one holds as well bound every intersection from above
    shingles = sets.select("set_id", F.explode("hashes").alias("h"))
    common = scratch.keep(shingles.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > 1), "common")
    held = shingles.join(common, "h").groupBy("set_id").agg(F.count("*").cast("int").alias("held"))
    lists = scratch.keep(
        members.join(held, "set_id").where(F.col("held") >= F.ceil(F.col("n") * PERCENT / 100)), "lists")
    scratch.drop("members")

    # round one: every member against the one of its list that shares the largest part
    hubs = (
        lists.groupBy("key").agg(
            F.max(F.struct((F.col("held") / F.col("n")).alias("part"), "set_id", "n", "held")).alias("hub"),
            F.min("set_id").alias("low"), F.max("set_id").alias("high"))
        .where(F.col("low") < F.col("high")).select("key", "hub")
    )
    meet = lists.join(hubs, "key").where(F.col("set_id") != F.col("hub.set_id"))
    first = scratch.keep(_pairs(meet.select(
        F.col("set_id").alias("x"), F.col("n").alias("nx"), F.col("held").alias("hx"), F.col("hub.set_id").alias("y"),
        F.col("hub.n").alias("ny"), F.col("hub.held").alias("hy"), "weight")), "first")
    found = scratch.keep(_linked(first, sets), "links-1")
    grouped = components(found, scratch, "groups-1")

    # round two: sets of one list that are still apart, compared by the rarest shingles they hold
    placed = scratch.keep(
        lists.join(grouped, F.col("set_id") == F.col("node"), "left")
        .select("key", "set_id", "n", "held", F.coalesce("component", "set_id").alias("part")), "placed")
    near = placed
    for step in range(PRUNINGS):
        near = scratch.keep(
            near.join(_still_apart(near), "key").where((100 + PERCENT) * F.col("held") >= PERCENT * (F.col("n") + F.col("least")))
            .drop("least"), f"near-{step}")
    # a set stays while the smallest one it meets would not be too large for its bound; what
    # that one would need is also what the prefix of its held shingles has to allow for
    least = F.greatest(F.min("least"), F.ceil(F.first("n") * PERCENT / 100))
    apart = (
        near.join(_still_apart(near), "key").groupBy("set_id")
        .agg(F.first("n").alias("n"), F.first("held").alias("held"), F.first("part").alias("part"), least.alias("least"))
        .withColumn("length", F.col("held") - F.ceil((F.col("n") + F.col("least")) * PERCENT / (100 + PERCENT)) + 1)
        .where(F.col("length") > 0)
    )
    rare_first = Window.partitionBy("set_id").orderBy("c", "h")
    heads = scratch.keep(
        sets.select("set_id", F.explode("hashes").alias("h")).join(apart, "set_id").join(common, "h")
        .withColumn("place", F.row_number().over(rare_first)).where(F.col("place") <= F.col("length"))
        .select("h", "set_id", "n", "held", "part"), "heads")
    # all members of a list but its largest group among themselves, and these against the group
    main = (
        heads.groupBy("h", "part").agg(F.count("*").alias("c"))
        .groupBy("h").agg(F.count("*").alias("parts"), F.max_by("part", F.struct("c", "part")).alias("main"))
        .where(F.col("parts") > 1).select("h", "main")
    )
    met = heads.join(main, "h")
    x = met.where(F.col("part") != F.col("main")).select(
        "h", F.col("set_id").alias("x"), F.col("n").alias("nx"), F.col("held").alias("hx"), F.col("part").alias("px"))
    y = met.select("h", F.col("set_id").alias("y"), F.col("n").alias("ny"), F.col("held").alias("hy"),
                   F.col("part").alias("py"), "main")
    open_pairs = (
        x.join(y, "h")
        .where((F.col("px") != F.col("py")) & _comparable()
               & ((F.col("py") == F.col("main")) | (F.col("x") < F.col("y"))))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )
    second = scratch.keep(open_pairs.join(first, ["a", "b"], "left_anti"), "second")
    links = scratch.keep(found.union(_linked(second, sets)), "links-2")
    groups = components(links, scratch, "groups-2")
    for name in ("lists", "heads", "common", "first", "second", "placed", "links-1", "sets"):
        scratch.drop(name)

    labelled = profile.join(groups, F.col("set_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "set_id").alias("label"))
    least = (
        labelled.where(F.col("n_shingles") > 0).groupBy("label").agg(F.min("doc_id").alias("least_id"))
    )
    return labelled.join(least, "label", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(),
               F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))).alias("component_id"),
    )


def _pairs(meetings: DataFrame) -> DataFrame:
    """Distinct pairs that share enough of their prefixes and have comparable sizes."""
    low, high = F.least("x", "y"), F.greatest("x", "y")
    return (
        meetings.where(_comparable())
        .groupBy(low.alias("a"), high.alias("b"))
        .agg(F.sum("weight").alias("w"), F.min(F.least("nx", "ny")).alias("n"))
        .where(F.col("w") >= _shared(F.col("n"))).select("a", "b")
    )


def keep_first_of_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per near-duplicate group, all columns of ``docs`` stay: the row with the least id.

    Groups are of rows, not of ids: rows of one id with different texts are told apart, and equal
    rows are copies. A NULL id comes last in its group. NULL and wordless texts are groups of their
    own. The rows are stored with numbers first, so that a lost executor cannot renumber them.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "first-of-group")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = scratch.keep(docs.select(F.monotonically_increasing_id().alias("number"), whole), "rows")
    marked = jaccard_components(rows.select("number", F.col("row").getField(text).alias("text")), "number", "text")
    ids = rows.select("number", long_id(F.col("row").getField(doc_id)).alias("id"))
    first = (
        marked.withColumnRenamed("doc_id", "number").join(ids, "number")
        .groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("number"))).alias("first"))
        .select("first.number")
    )
    return rows.join(first, "number", "left_semi").select("row.*")
