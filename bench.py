"""Time the headline queries, whole plan and whole result, and print one JSON line.

Each runs twice; the second run is the value, the first (with class loading and compilation) is
printed next to it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.checks import CHECKS, load  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = [
    "frontier", "links_extract", "table_records", "rename_substring", "list_detail_join", "dedupe_ordered", "last_wins", "upsert_keyed", "stream_pages",
    "potential_values", "equipment_records", "star_limits", "set_effects", "slot_corpus",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    load()
    # One small untimed query starts the JVM's and the Python workers' machinery.
    CHECKS["table_cells"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    def timed(name: str) -> float:
        start = time.perf_counter()
        CHECKS[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    first = {name: timed(name) for name in HEADLINE}
    again = {name: timed(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total_second_run",
                "value": round(sum(again.values()), 3),
                "unit": "sec",
                "queries": again,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
