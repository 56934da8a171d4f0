"""Time the headline queries, or those named on the command line ("all" for every one): prints one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. Each query is run to a sink that keeps nothing, so the
whole result is computed and nothing is sent to the driver.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from plumbline.plans.catalog import QUERIES
from plumbline.session import configure

# One or two queries per check family, each over the family's whole input.
HEADLINE = (
    "value_summary", "value_single_choice", "range_summary", "long_union", "ffill_episode_context", "date_summary",
    "form_elements_resolved", "expected_elements", "completeness_summary", "completeness_per_patient",
    "form_presence_summary", "calc_summary", "import_summary", "long_summary", "rel_summary", "dictionary_build",
    "profile_episode_describe",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or list(HEADLINE)
    spark = configure(
        SparkSession.builder.master(f"local[{cores}]").appName("plumbline-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start-up cost belongs to no query
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
