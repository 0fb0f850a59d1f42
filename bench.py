"""Times the headline queries: one JSON line. Each query runs twice; `queries` holds the second, `cold` the first."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from driver import queries as catalog
from driver.session import give_work_dir

HEADLINES = [
    catalog.wide_reviews, catalog.long_reviews, catalog.top_n_per_bucket, catalog.decision_and_meta,
    catalog.reviews_with_rebuttals, catalog.resolve_target_review, catalog.strip_quoted_text, catalog.content_value,
    catalog.author_table, catalog.manifest_profiles,
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    give_work_dir(spark)
    runs: dict[str, list[float]] = {}
    for query in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.setdefault(query.__name__, []).append(round(time.perf_counter() - start, 3))
    warm = {name: r[1] for name, r in runs.items()}
    print(json.dumps({
        "metric": "headline queries, warm", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": {name: r[0] for name, r in runs.items()}, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cores": int(cpus), "shuffle_partitions": int(cpus),
    }))


if __name__ == "__main__":
    main()
