from collections import Counter
from concurrent.futures import ThreadPoolExecutor
import json
from datetime import date
from pathlib import Path
import time

import pytest

from checks import all_queries
from finmart.session import SHUFFLE_CLEANUP, configured, cut_lineage, private_folder, shuffles_removed
from pyspark.sql import functions as F

from finmart import schemas
from finmart.sources import bronze, demo_bank, jdbc, seeds, store
from tests.conftest import SMALL


def landed(tmp_path, text, name="batch.json"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_read_json_array_keeps_raw_elements(spark, tmp_path):
    path = landed(tmp_path, ' [{"a": 3.0, "b": "x, ]"}, {"a": "3"}]')
    texts = [json.loads(r.data) for r in bronze.read_json_documents(spark, path).collect()]
    assert texts == [{"a": 3.0, "b": "x, ]"}, {"a": "3"}]


ODD_ARRAYS = [
    r'[{"a":"x } ] \" {","b":[{"c":1},{}]}, {"a":"\\"},{"a":"\\\"}]"} ,{"d":{"e":{}}}]',
    '[\n{"a": "[{"},\n{"a": "}]"}\n]\n',
    '[{}]',
    '[{"long": "' + "}{][ \\\\ \\\" " * 40 + '"}, {"next": []}]',
]


@pytest.mark.parametrize("limit", [1, 5, 17, 1 << 20])
@pytest.mark.parametrize("text", ODD_ARRAYS)
def test_array_file_is_cut_in_byte_ranges(spark, tmp_path, text, limit):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(limit))
        found = [json.loads(r.data) for r in bronze.read_json_documents(spark, landed(tmp_path, text)).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(map(json.dumps, found)) == sorted(map(json.dumps, json.loads(text)))


def test_array_file_is_read_by_all_tasks(spark, tmp_path):
    path = landed(tmp_path, json.dumps([{"i": i, "t": [{"x": "}" * (i % 9)}] * 5} for i in range(4000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() >= 8
        found = bronze.read_json_documents(spark, path).select(F.get_json_object("data", "$.i").cast("int").alias("i"))
        assert sorted(r.i for r in found.collect()) == list(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_array_text_is_shuffled_once_and_stays_in_order(spark, tmp_path):
    path = landed(tmp_path, json.dumps([{"i": i, "t": [{"x": "}" * (i % 9)}] * 5} for i in range(2000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        pieces = bronze.array_pieces(spark, path)
        found = pieces.where("is_element").select(F.get_json_object("data", "$.i").cast("int").alias("i")).collect()
        assert [r.i for r in found] == list(range(2000))
        records = spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"), "value")
        ranges = F.broadcast(bronze.cut_lineage(bronze._ranges(records)))
        assert len(exchanges(bronze._fragments(records, ranges))) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def exchanges(df):
    """Text of the plan below every shuffle."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    found = []
    for i, line in enumerate(lines):
        if line.lstrip(" :+-").startswith("Exchange"):
            below = []
            for other in lines[i + 1:]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            found.append("\n".join(below))
    return found


def test_documents_are_shuffled_as_columns(spark):
    shuffled = exchanges(demo_bank.documents(spark, "/root/testdata/sf0.001"))
    assert shuffled and not any("StructsToJson" in below or "collect_list" in below for below in shuffled)


def test_lines_are_shuffled_by_part_and_by_block_of_orders_only(spark):
    with configured(spark, autoBroadcastJoinThreshold="-1"):
        found = [below for below in exchanges(demo_bank.documents(spark, "/root/testdata/sf0.001")) if "l_extendedprice" in below]
    assert len([below for below in found if f">= {demo_bank.LINE_BLOCK})" not in below]) == 2


def test_settings_hold_inside_only(spark):
    name = "spark.sql.execution.replaceHashWithSortAgg"
    before = spark.conf.get(name, None)
    with configured(spark, execution__replaceHashWithSortAgg="true"):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_stored_tables_are_packed(spark, tmp_path):
    store.TableStore(spark, str(tmp_path)).save(spark.range(5), "silver", "numbers")
    files = [f.name for f in (tmp_path / "silver" / "numbers").glob("*.parquet")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_one_bad_file_among_good_ones_is_rejected(spark, tmp_path):
    for bad in ("", "]", '[{"a": 1}'):
        folder = tmp_path / f"land-{len(bad)}"
        folder.mkdir()
        (folder / "good.json").write_text('[{"a": 1}]')
        (folder / "bad.json").write_text(bad)
        with pytest.raises(bronze.EmptyBatchError):
            bronze.read_json_documents(spark, str(folder))


@pytest.mark.parametrize("text", ["[]", '{"a": 1}', "[1, ", "", "[1, {}]", '["a", {}]', "[[{}], {}]", '[{}, {"a":{}]', '[{"a":{}]',
                                  "[{} {}]", '{"a":[{}]}', "[{},]", "]"])
def test_unusable_files_are_rejected(spark, tmp_path, text):
    with pytest.raises(bronze.EmptyBatchError):
        bronze.read_json_documents(spark, landed(tmp_path, text))


def test_read_json_lines(spark, tmp_path):
    path = landed(tmp_path, '{"a": 1}\n\n{"a": 2}\n')
    assert bronze.read_json_documents(spark, path, lines=True).count() == 2
    with pytest.raises(bronze.EmptyBatchError):
        bronze.read_json_documents(spark, landed(tmp_path, "\n", "blank.json"), lines=True)


def test_append_stamps_one_load_and_continues_ids(spark, tmp_path):
    path = str(tmp_path / "bronze")
    docs = spark.range(5).select(F.lit('{"customer_id": "C"}').alias("data"))
    bronze.append_bronze(docs, path, "first", "f.json")
    bronze.append_bronze(docs, path, "second", "f.json")
    stored = bronze.read_bronze(spark, path)
    per_load = {r.load_id: r for r in stored.groupBy("load_id").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"),
        F.count_distinct("load_timestamp").alias("moments")).collect()}
    assert per_load["first"].n == per_load["second"].n == 5
    assert per_load["first"].moments == per_load["second"].moments == 1
    assert per_load["second"].low > per_load["first"].high
    assert {r.load_id for r in bronze.latest_batch(stored).collect()} == {"second"}
    assert [r.records for r in bronze.batch_inventory(stored).collect()] == [5, 5]


def test_seed_file_types(spark, tmp_path):
    path = landed(tmp_path, "currency,rate_to_usd,as_of_date\nUSD,1.000000,2026-05-16\n", "fx.csv")
    row = seeds.fx_rates(spark, path).first()
    assert (row.currency, float(row.rate_to_usd), row.as_of_date) == ("USD", 1.0, date(2026, 5, 16))
    assert seeds.fx_rates(spark).schema == schemas.FX_RATES or seeds.fx_rates(spark).count() == 9
    broken = landed(tmp_path, "currency,rate_to_usd,as_of_date\nUSD,abc,2026-05-16\n", "bad.csv")
    with pytest.raises(Exception):
        seeds.fx_rates(spark, broken).collect()


def test_dim_date_covers_its_range(spark):
    days = seeds.dim_date(spark)
    assert days.count() == 5844
    row = days.where("date_day = date'2024-02-29'").first()
    assert (row.year, row.quarter, row.week_of_year, row.day_of_week_num, row.day_of_year) == (2024, 1, 9, 4, 60)
    assert (row.month_name, row.day_name_short, row.year_quarter_label) == ("February", "Thu", "Q1 2024")
    assert (row.week_start, row.quarter_start) == (date(2024, 2, 26), date(2024, 1, 1))


def test_namespaces_tables_and_inventory(spark, bank):
    store.create_namespaces(spark)
    trend = bank.table("mart_acquisition_trend")
    store.save_table(trend.limit(1), "gold", "trend")
    store.save_table(trend, "gold", "trend")
    listed = {r.table_name: r.row_count for r in store.catalog_inventory(spark, "gold").collect()}
    assert listed == {"trend": trend.count()}
    with pytest.raises(ValueError):
        store.TableStore(spark, "/tmp/x").path("platinum", "t")


def test_jdbc_ranges_are_balanced_and_hold_every_id_once(spark, monkeypatch):
    """Nine tenths of the ids lie in a hundredth of the range."""
    ids = [5 + k for k in range(9000)] + [9005 + k * 891 for k in range(1000)]
    calls = []

    def fake(self, url, table, **options):
        calls.append((table, options))
        if "min(" in table:
            return spark.sql(f"select {min(ids)}L as low, {max(ids)}L as high")
        width = -(-(max(ids) + 1 - min(ids)) // jdbc.STEPS)
        steps = Counter((i - min(ids)) // width for i in ids)
        return spark.createDataFrame(sorted(steps.items()), "step long, n long")

    monkeypatch.setattr(type(spark.read), "jdbc", fake)
    jdbc.read_partitioned(spark, "jdbc:x", "bronze.raw", rows_per_partition=500, user="u")
    predicates = calls[-1][1]["predicates"]
    monkeypatch.undo()
    stored = spark.createDataFrame([(i,) for i in [*ids, None, -3, 10 ** 9]], "id long")
    hits = stored.selectExpr("id", *[f"coalesce(int({p}), 0) as p{k}" for k, p in enumerate(predicates)]).collect()
    assert all(sum(r[1:]) == 1 for r in hits)
    sizes = [sum(r[1 + k] for r in hits) for k in range(len(predicates))]
    assert max(sizes) <= 600 and len(predicates) <= 2 * 10_000 // 500 + 1


@pytest.mark.parametrize("starts, counts, expected", [([], [], ["1 = 1"]), ([7], [9], ["1 = 1"]),
                                                      ([0, 10], [5, 5], ["(id < 10 OR id IS NULL)", "id >= 10"])])
def test_jdbc_predicates_of_few_steps(starts, counts, expected):
    assert jdbc.balanced_predicates("id", starts, counts, 5) == expected

def test_large_customers_are_spread_over_documents(spark):
    whole = demo_bank.documents(spark, "/root/testdata/sf0.001")
    split = demo_bank.documents(spark, "/root/testdata/sf0.001", order_block=100, line_block=3)

    def ids(df):
        items = F.from_json(F.get_json_object("data", "$.transactions"), "array<struct<transaction_id: string>>")
        return df.select(F.inline(items))

    assert split.count() > whole.count() == whole.select("id").distinct().count()
    assert whole.select("id").exceptAll(split.select("id").distinct()).isEmpty()
    assert ids(split).exceptAll(ids(whole)).isEmpty() and ids(whole).exceptAll(ids(split)).isEmpty()


def busy_folder(folder) -> str:
    """The smallest tables, where one customer holds a third of the orders and one order 3000 lines more."""
    from checks.compare import TABLES, connect

    connection = connect("/root/testdata/sf0.001")
    changed = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders",
        "lineitem": """SELECT * FROM lineitem UNION ALL
            SELECT l.* REPLACE (n AS l_linenumber) FROM (SELECT * FROM lineitem WHERE l_linenumber = 1 ORDER BY ALL LIMIT 1) l, range(8, 3008) r(n)""",
    }
    for table in TABLES:
        kinds = connection.execute(f"DESCRIBE {table}").fetchall()
        typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind, *_ in kinds)
        connection.execute(f"COPY (SELECT {typed} FROM ({changed.get(table, f'SELECT * FROM {table}')})) TO '{folder}/{table}.parquet'")
    return str(folder)


def test_no_document_outgrows_its_blocks(spark, tmp_path):
    sizes = demo_bank.documents(spark, busy_folder(tmp_path), order_block=50, line_block=100).select(
        F.size(F.from_json(F.get_json_object("data", "$.transactions"), "array<string>")).alias("n"))
    assert sizes.agg(F.sum("n")).first()[0] >= 9000
    assert sizes.agg(F.max("n")).first()[0] <= 50 * 7 + 100


@pytest.mark.parametrize("name", [
    "src1_read_json_documents", "src1_read_json_arrays", "src11_batch_inventory", "jsn4_scalar_as_text", "jsn5_nested_as_text",
    "jsn7_array_cardinality", "jsn8_json_type_census", "jsn9_key_sets", "prf2_date_format_census", "dq8_run_counters"])
def test_documents_of_a_busy_customer_match_sql(spark, tmp_path_factory, name):
    from checks import all_oracles, all_queries
    from checks.compare import connect, differences

    if not BUSY:
        BUSY.append(busy_folder(tmp_path_factory.mktemp("busy")))
    (folder,) = BUSY
    assert differences(spark, connect(folder), folder, name, all_queries()[name], all_oracles()[name]) == ""


BUSY: list[str] = []


def test_splitting_documents_does_not_change_the_flattened_tables(spark):
    from finmart.operators import dedup, flatten

    def flat(order_block, line_block):
        rows = demo_bank.documents(spark, "/root/testdata/sf0.001", order_block, line_block).withColumn(
            "load_timestamp", F.col("load_id"))
        kept = dedup.keep_latest(
            flatten.flatten_array(flatten.parse_documents(rows), flatten.TRANSACTIONS), "transaction_id")
        return kept.checkpoint()

    whole, split = flat(10_000, 1_000), flat(100, 3)
    assert whole.count() == split.count() and whole.exceptAll(split).isEmpty()


def test_refresh_fills_columns_by_name(spark):
    store.create_namespaces(spark)
    store.save_table(spark.createDataFrame([(1, 2)], "a int, b int"), "gold", "by_name")
    store.save_table(spark.createDataFrame([(20, 10)], "b int, a int"), "gold", "by_name")
    assert [tuple(r) for r in spark.table("gold.by_name").collect()] == [(10, 20)]
    with pytest.raises(ValueError):
        store.save_table(spark.createDataFrame([(1,)], "a int"), "gold", "by_name")


def test_failed_save_keeps_the_stored_table(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path))
    tables.save(spark.range(3).toDF("v"), "gold", "kept")
    with pytest.raises(Exception):
        tables.save(spark.range(3).selectExpr("raise_error('no') as v"), "gold", "kept")
    assert tables.load("gold", "kept").count() == 3


def test_switch_replaces_the_table_and_leaves_nothing_behind(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path))
    for rows in (3, 4):
        assert tables.save(spark.range(rows).toDF("v"), "gold", "kept").count() == rows
    assert [f.name for f in (tmp_path / "gold").iterdir() if not f.name.startswith(".")] == ["kept"]


def test_interleaved_appends_get_disjoint_ids_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda _: bronze.claim_batch(spark, path), range(24)))
    assert len(set(numbers)) == 24
    docs = spark.range(2000).select(F.lit("{}").alias("data")).repartition(7)
    tracker = spark.sparkContext.statusTracker()
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: bronze.append_bronze(docs, path, f"load-{k}", "f"), range(3)))
    stored = bronze.read_bronze(spark, path)
    assert stored.count() == stored.select("id").distinct().count() == 6000
    before = set(tracker.getJobIdsForGroup(None))
    assert bronze.claim_batch(spark, path) > max(numbers) and set(tracker.getJobIdsForGroup(None)) == before


def test_partitioned_table_is_refreshed_by_partition_and_pruned(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    rows = spark.range(90).selectExpr("id", "CONCAT('2024-0', 1 + id % 3) AS month")
    store.save_table(rows, "silver", "facts_by_month", ("month",))
    store.save_table(rows.where("month = '2024-02' AND id < 9"), "silver", "facts_by_month", ("month",))
    kept = spark.table("silver.facts_by_month")
    assert {r.month: r["count"] for r in kept.groupBy("month").count().collect()} == {"2024-01": 30, "2024-02": 3, "2024-03": 30}
    plan = kept.where("month >= '2024-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_private_folder_only_for_a_local_master():
    assert private_folder("local[4]") and private_folder("local")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            private_folder(master)


def test_lines_are_written_as_json_before_they_are_collected(spark):
    plan = demo_bank.documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(transaction#" in plan  # what collect_list itself computes is interpreted row by row


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        found.add(files.next().getName())
    return {name for name in found if name.startswith("shuffle_")}


@pytest.mark.parametrize("keep", [
    lambda df, root: store.TableStore(df.sparkSession, root).save(df, "silver", "kept"),
    lambda df, root: cut_lineage(df),
])
def test_stored_rows_leave_no_shuffle_files(spark, tmp_path, keep):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(50_000).withColumn("r", F.hash("id")).repartition("r").groupBy("r").agg(F.count("*").alias("n"))
    kept = keep(df, str(tmp_path))
    until = time.time() + 10  # executors are told, and remove the files on their own
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert kept.agg(F.sum("n")).first()[0] == 50_000


def test_the_last_open_block_restores_the_shuffle_setting(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


@pytest.mark.parametrize("name, folder", [("src1_read_json_documents", "landed-*"), ("dq8_run_counters", "transactions-*")])
def test_copies_that_queries_write_are_packed(spark, bank, name, folder):
    all_queries()[name](spark, SMALL).count()
    scratch = Path(bank.scratch("x").removeprefix("file:")).parent
    files = [f.name for f in scratch.glob(f"{folder}/**/part-*")]
    assert files and all(".gz" in name or ".zstd" in name for name in files)
