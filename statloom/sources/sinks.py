"""Writing named result tables, partitioned by the dataset they describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_results(
    results: dict[str, DataFrame], folder: str, dataset_id: str, fmt: str = "parquet", mode: str = "append"
) -> dict[str, str]:
    """Write each result under ``folder/<name>/dataset_id=<id>``; returns the paths."""
    paths = {}
    for name, df in results.items():
        paths[name] = f"{folder}/{name}"
        (
            df.withColumn("dataset_id", F.lit(dataset_id))
            .write.mode(mode)
            .partitionBy("dataset_id")
            .format(fmt)
            .save(paths[name])
        )
    return paths
