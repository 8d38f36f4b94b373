"""Building the model graph over one bronze table."""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from finmart.plans.models import MARTS, MODELS, SEEDS
from finmart.session import configured, work_dir
from finmart.sources import demo_bank
from finmart.sources.store import TableStore


class Warehouse:
    """Tables by name, built on first use.

    Stored models are written once under the store and read back, which cuts their lineage;
    the files outlive lost executors. Other models are plans over those files.
    """

    def __init__(self, spark: SparkSession, bronze: DataFrame, root: str, as_of: date | None = None):
        self.spark = spark
        self.store = TableStore(spark, root)
        self.as_of = as_of
        self._tables: dict[str, DataFrame] = {"bronze": bronze}
        self._saved: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)

    def table(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._tables:
                self._tables[name] = self._build(name)
            return self._tables[name]

    def tables(self, *names: str) -> list[DataFrame]:
        return [self.table(name) for name in names]

    def _build(self, name: str) -> DataFrame:
        if name in SEEDS:
            return SEEDS[name](self.spark)
        model = MODELS[name]
        arguments = self.tables(*model.inputs)
        if model.dated:
            arguments.append(self.as_of)
        built = model.build(*arguments)
        if not model.stored:
            return built
        if model.partition_by:  # few files per partition; AQE splits a large one among tasks
            built = built.hint("rebalance", *model.partition_by)
        return self.store.save(built, model.layer, name, model.partition_by)

    def saved(self, name: str) -> DataFrame:
        """The table as stored files, written now if it has only been a plan so far; thin ones read those of their input."""
        model = MODELS.get(name)
        if model is None or model.stored or model.thin:
            return self.table(name)
        with self._locks[name]:
            if name not in self._saved:
                self._saved[name] = self.store.save(self.table(name), model.layer, name)
            return self._saved[name]

    def prepare(self, names: list[str], threads: int = 4) -> None:
        """Store the named tables, independent ones at the same time."""
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(self.saved, names))

    def scratch(self, name: str) -> str:
        """A fresh path under the warehouse for a query that writes."""
        return f"{self.store.root}/scratch/{name}-{uuid.uuid4().hex[:8]}"

    def build_all(self, threads: int = 4) -> dict[str, DataFrame]:
        """Build the whole graph; stored models and marts are written to their layers."""
        self.prepare([name for name, model in MODELS.items() if model.stored or name in MARTS], threads)
        for name in MARTS:
            self._tables[name] = self.saved(name)
        return {name: self.table(name) for name in ("bronze", *SEEDS, *MODELS)}


_OPEN: dict[tuple[str, str], Warehouse] = {}
DEMO_AS_OF = date(2001, 12, 31)


def demo_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over documents derived from the tables in ``sf_dir``.

    One per application and folder, in a fresh place under the shared work folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OPEN:
        root = f"{work_dir(spark)}/finmart-{key[0]}-{uuid.uuid4().hex[:8]}"
        # sorted items are aggregated as they come, once, and a task writes the two loads side by side: no JSON is sorted
        with configured(spark, execution__replaceHashWithSortAgg="true", maxConcurrentOutputFileWriters=str(2 * len(demo_bank.BATCHES))):
            bronze = TableStore(spark, root).save(
                demo_bank.bronze_table(spark, sf_dir), "bronze", "raw_documents", partition_by=("load_id",)
            )
        _OPEN[key] = Warehouse(spark, bronze, root, DEMO_AS_OF)
    return _OPEN[key]
