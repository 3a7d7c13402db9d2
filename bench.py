"""Times the headline queries and prints one JSON line.

Each query runs to a sink that discards its rows, once to warm up and then
``BENCH_RUNS`` times; the median counts. ``train_forest`` fits its model anew in every
run; the queries that score take the fitted one. ``fit`` is the fit's share of it, and
``rows_per_second`` is that of ``score_future``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchlake.session import create_session  # noqa: E402
from workload.queries import QUERIES, fitted  # noqa: E402

HEADLINE = (
    "team_values",
    "enrich_two_sided",
    "standings_join",
    "training_dataset",
    "resolve_final",
    "candidates_levenshtein",
    "dedupe_keys",
    "union_sources",
    "dim_teams_unified",
    "team_stats_latest",
    "unpivot_roles",
    "league_slice",
    "sink_partitioned_roundtrip",
    "train_forest",
    "score_future",
    "score_pairings",
    "dq_duplicate_keys",
)


def one_machine(cpus: str) -> dict[str, str]:
    """Sizing for one process and small tables; a cluster brings its own.

    A table here is one row group and so one task. Shuffled rows therefore stay in
    their partitions, also small ones, instead of being read where they were written.
    """
    return {
        "spark__driver__memory": "16g",
        "spark__sql__shuffle__partitions": cpus,
        "spark__sql__adaptive__localShuffleReader__enabled": "false",
        "spark__sql__adaptive__coalescePartitions__minPartitionSize": "64k",
    }


def timed(name: str, spark, sf_dir: str, fits: list[float]) -> float:
    start = time.perf_counter()
    if name == "train_forest":
        fitted.cache_clear()
        fitted(spark, sf_dir)
        fits.append(time.perf_counter() - start)
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = create_session("matchlake-bench", f"local[{cpus}]", **one_machine(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    seconds, fits, extra = {}, [], {}
    for name in wanted:
        timed(name, spark, sf_dir, [])
        seconds[name] = round(statistics.median(timed(name, spark, sf_dir, fits) for _ in range(runs)), 3)
    if fits:
        extra["fit"] = round(statistics.median(fits), 3)
    if "score_future" in wanted:
        extra["rows_per_second"] = round(QUERIES["score_future"](spark, sf_dir).count() / seconds["score_future"])
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
