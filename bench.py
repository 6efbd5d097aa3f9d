"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the given tables, ``BENCH_CPUS`` the
number of local cores. Every query is built and run to the end without
bringing rows to the driver; a small first run warms up the JVM.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from guestlens.catalog.queries import QUERIES
from guestlens.session import build_session

HEADLINE = [
    "merge_reviews_offerings", "clean_reviews", "clean_text", "language_detect", "label_review",
    "review_counts", "positive_counts", "top5_hotels", "top10_category_max", "top10_category_mean",
    "hotel_page", "hotel_cards", "word_freq", "word_pairs", "report_lines", "balance_exact",
    "nb_train", "nb_predict", "top5_predicted", "svc_predict", "rf_predict", "class_metrics",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["top5_hotels"](spark, sf).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
