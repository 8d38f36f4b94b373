"""Times the model graph and its headline queries; prints one JSON line.

The documents are derived from the tables in ``$BENCH_SF_DIR`` first. That step stands in
for landing the data and is reported as ``setup``, outside the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import all_queries
from finmart import build_session
from finmart.plans.models import MARTS, MODELS
from finmart.plans.questions import QUESTIONS
from finmart.plans.quality import CHECKS, run_checks
from finmart.plans.warehouse import demo_warehouse


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - started, 3)

    timed("setup", lambda: demo_warehouse(spark, sf_dir))
    setup = timings.pop("setup")
    bank = demo_warehouse(spark, sf_dir)
    stored = [name for name, model in MODELS.items() if model.stored]
    timed("build_silver", lambda: bank.prepare(stored))
    for mart in MARTS:
        timed(mart, lambda: bank.saved(mart))
    for question, (mart, query) in QUESTIONS.items():
        timed(question, lambda: query(bank.saved(mart)).collect())
    bank.prepare(list(CHECKS))
    timed("quality_checks", lambda: run_checks(bank.saved, as_of="DATE '2001-12-31'").collect())
    registered = all_queries()
    for name in [n for n in registered if n.startswith(("kpi", "prf", "rec"))]:
        timed(name, lambda: registered[name](spark, sf_dir).collect())
    print(json.dumps({
        "metric": "medallion build, marts and business questions",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "setup": setup,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
