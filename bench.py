"""Time the headline queries once warm and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_REPEATS
(default 3). Every query runs once to warm up; the median of the repeats is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statloom.plans import suite  # noqa: E402
from statloom.session import build_session  # noqa: E402

HEADLINE = [
    "descriptive_stats",
    "profile_dataset",
    "profile_documents_text_copies",
    "categorical_summary",
    "categorical_summary_documents",
    "column_statistics",
    "outlier_summary",
    "group_comparison",
    "missing_analysis",
    "auto_clean",
    "impute_median",
    "impute_ffill_per_user",
    "drop_duplicates_subset",
    "handle_outliers_iqr_cap",
    "correlation_matrix",
    "correlation_spearman",
    "correlation_kendall",
    "correlation_significance_lineitem",
    "compare_groups_anova",
    "chi_square_independence",
    "feature_screen_categorical_target",
    "normality_large",
    "trend_analysis",
    "histogram",
    "box_stats",
    "classification_metrics",
    "ranking_metrics",
    "fairness_verdicts",
    "linear_regression_fit",
    "attribution_linear",
    "tag_intent_documents",
    "session_sequence_numbers",
    "stream_profile",
    "stream_tumbling_rates",
    "attribution_forest",
    "feature_screen_numeric_target",
    "stratified_folds",
    "csv_round_trip",
    "extract_json_documents",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        app="statloom-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.files.maxPartitionBytes": "4m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        query = suite.QUERIES[name]
        samples = []
        for attempt in range(repeats + 1):
            start = time.perf_counter()
            # the noop sink evaluates every row without bringing it to the driver
            query(spark, folder).write.format("noop").mode("overwrite").save()
            if attempt:
                samples.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(samples), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
