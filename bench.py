"""Headline queries and the sheet pipeline, timed; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from cellstar.plans import pipeline  # noqa: E402
from cellstar.session import build_session  # noqa: E402
from cellstar.sources.store import Store  # noqa: E402
from contract.inputs import Inputs  # noqa: E402
from contract.queries import QUERIES  # noqa: E402

HEADLINE = [
    "top_indicators",
    "highest_average",
    "period_trend",
    "yoy_growth",
    "value_distribution",
    "zscore_outliers",
    "lowest_cv",
    "summary_report",
    "duplicate_records",
    "distinct_counts",
    "indicator_summary",
    "indicator_search",
    "indicator_metadata",
    "timeseries",
    "series_statistics",
    "rank_total",
    "eda_describe",
    "unpivot_years",
    "row_accounting",
    "fact_load",
    "dim_indicator_build",
    "dq_validate_all",
    "dq_domain",
    "dq_duplicate_rows",
    "run_latest_state",
    "score_by_run",
    "file_change_detect",
]
STAGES = ("sheets_to_grid", "grid_to_long", "long_to_star")


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def consume(rows) -> None:
    """Compute every row and column without bringing them to the driver."""
    rows.write.format("noop").mode("overwrite").save()


def stage_times(spark, folder: str) -> tuple[dict[str, float], int]:
    """Sheets to star schema, once to warm up and once measured."""
    store = Store(spark, tempfile.mkdtemp(prefix="cellstar-bench-"))
    times: dict[str, float] = {}
    for load_id in ("warm", "timed"):
        sheets = Inputs(spark, folder).sheets
        steps = (
            lambda: store.append("grid", sheets, load_id),
            lambda: pipeline.transform(store, load_id),
            lambda: pipeline.load(store, load_id),
        )
        times = {name: timed(step) for name, step in zip(STAGES, steps)}
    return times, store.live("facts").count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries: dict[str, float] = {}
    for key in HEADLINE:
        consume(QUERIES[key](spark, folder))
        queries[key] = min(timed(lambda: consume(QUERIES[key](spark, folder))) for _ in range(2))
    stages, facts = stage_times(spark, folder)
    queries.update(stages)
    loading = stages["grid_to_long"] + stages["long_to_star"]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in queries.items()},
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
                "facts_loaded": facts,
                "facts_per_sec": round(facts / loading),
            }
        )
    )


if __name__ == "__main__":
    main()
