"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from dotreef.plans import registered
from dotreef.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "benthos_by_code", "benthos_without_code", "relief_counts", "crosswalk_counts", "rosetta_counts", "scientific_counts",
    "overlay_labels", "counts_by_path", "wide_to_counts", "points_per_sample", "wrong_point_counts", "anti_single",
    "anti_composite", "coverage_summary", "presence_diff", "scope_semi", "unmatched_classes", "repair_codes",
    "first_code_per_path", "natural_left_join",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    registered.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINES:  # warm up: code generation and file listing
        run(spark, name)
    times = {name: round(min(run(spark, name) for _ in range(2)), 3) for name in HEADLINES}
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
