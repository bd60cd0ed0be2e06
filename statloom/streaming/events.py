"""Structured Streaming operators over an event stream.

Every function maps a streaming DataFrame to a streaming DataFrame; :func:`run` drives
one until the available input is used up and returns what the sink holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from statloom.functions.exprs import name_col
from statloom.functions.moments import adjusted_kurtosis, adjusted_skewness
from statloom.functions.prefix import sequence_numbers
from statloom.session import new_folder, prepare, settle, share_package

RANK_SKETCH = 800  # rank error of about a third of a per cent
DISTINCT_SKETCH = 14  # 2^14 registers: about 0.8 per cent
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_events(
    spark: SparkSession, folder: str, glob: str = "*.parquet", when: str = "ts", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; the event time becomes a zoned timestamp,
    which watermarks require."""
    prepare(spark)
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).withColumn(when, name_col(when).cast("timestamp"))


def run(stream: DataFrame, mode: str = "append", folder: str | None = None) -> DataFrame:
    """Process all available input; append goes to files, other modes keep the last result."""
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "stream")
    out, checkpoint = f"{folder}/data", f"{folder}/checkpoint"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:

        def keep(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        query = writer.foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def incremental_profile(stream: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Running profile per key: size, moments, range, quartiles and distinct values by sketches.

    All parts are mergeable and of bounded size, so the state per key stays small. The sketches are
    columns of their own, to be stored: ``merged_profiles`` adds up profiles of keys, days or streams.
    """
    c = name_col(value).cast("double")
    n, constant = F.count(c), F.min(c) == F.max(c)
    return stream.groupBy(*[name_col(k) for k in keys]).agg(
        n.alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        adjusted_skewness(F.skewness(c), n, constant).alias("skewness"),
        adjusted_kurtosis(F.kurtosis(c), n, constant).alias("kurtosis"),
        F.kll_sketch_agg_double(c, F.lit(RANK_SKETCH)).alias("rank_sketch"),
        F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), F.lit(DISTINCT_SKETCH)).alias("distinct_sketch"),
    ).select("*", *_estimates())


def _estimates() -> list[Column]:
    quartile = [F.kll_sketch_get_quantile_double("rank_sketch", F.lit(p)) for p in (0.25, 0.5, 0.75)]
    return [F.when(F.col("count") > 0, F.array(*quartile)).alias("quartiles"), F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate")]


def merged_profiles(profiles: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Stored profiles added up by ``keys`` (none: all): size, mean, deviation, range, quartiles, distinct values.

    Rank errors and distinct errors stay those of one sketch, however many are merged.
    """
    n, mean = F.col("count"), F.col("mean")
    inner = F.coalesce(F.col("std"), F.lit(0.0)) ** 2 * (n - 1)
    total = F.sum("count")
    sums = profiles.groupBy(*[name_col(k) for k in keys]).agg(
        total.alias("count"),
        (F.sum(n * mean) / total).alias("mean"),
        F.sum(F.when(n > 0, inner)).alias("_inner"),
        F.sum(n * mean * mean).alias("_square"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("rank_sketch").alias("rank_sketch"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
    )
    spread = F.col("_inner") + F.col("_square") - n * mean * mean
    std = F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))
    return sums.select(*[name_col(k) for k in keys], "count", "mean", std.alias("std"), "min", "max", "rank_sketch", "distinct_sketch", *_estimates())


def unique_events(stream: DataFrame, key: str = "event_id", when: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop redelivered events; ids are remembered until the watermark passes them."""
    return stream.withWatermark(when, delay).dropDuplicatesWithinWatermark([key])


def windowed_rates(
    stream: DataFrame,
    keys: list[str],
    value: str,
    width: str,
    slide: str | None = None,
    when: str = "ts",
    delay: str | None = "1 hour",
) -> DataFrame:
    """Counts and sums per tumbling or sliding window; later data than ``delay`` is cut off."""
    late = stream.withWatermark(when, delay) if delay else stream
    window = F.window(name_col(when), width, slide) if slide else F.window(name_col(when), width)
    return (
        late.groupBy(window.alias("w"), *[name_col(k) for k in keys])
        .agg(F.count("*").alias("n"), F.sum(name_col(value)).alias("total"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "total")
    )


def session_spans(stream: DataFrame, key: str, gap: str = "30 minutes", when: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Activity sessions per key, closed by ``gap`` without events."""
    return (
        stream.withWatermark(when, delay)
        .groupBy(F.session_window(name_col(when), gap).alias("w"), name_col(key))
        .agg(F.count("*").alias("n"))
        .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )


def paired_spans(
    starts: DataFrame, ends: DataFrame, key: str, when: str = "ts", within: str = "2 hours", delay: str = "1 hour"
) -> DataFrame:
    """Start and completion of the same run, joined within a time range."""
    a = starts.withWatermark(when, delay).select(name_col(key).alias("_ka"), name_col(when).alias("started"))
    b = ends.withWatermark(when, delay).select(name_col(key).alias("_kb"), name_col(when).alias("ended"))
    near = (
        (F.col("_ka") == F.col("_kb"))
        & (F.col("ended") >= F.col("started"))
        & (F.col("ended") <= F.col("started") + F.expr(f"INTERVAL {within}"))
    )
    seconds = (F.unix_micros("ended") - F.unix_micros("started")) / 1e6
    return a.join(b, near, "inner").select(F.col("_ka").alias(key), "started", "ended", seconds.alias("seconds"))


def anomaly_flags(stream: DataFrame, bounds: DataFrame, key: str, value: str) -> DataFrame:
    """Flag values more than three deviations off their key's training mean.

    ``bounds`` is a static table ``(key, mean, std)`` with a row per key.
    """
    z = F.abs(F.try_divide(name_col(value) - F.col("mean"), F.col("std")))
    return stream.join(bounds, key, "left").withColumn("is_anomaly", F.coalesce(z > 3, F.lit(False))).drop("mean", "std")


def training_bounds(history: DataFrame, key: str, value: str) -> DataFrame:
    return history.groupBy(name_col(key)).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


class _Offsets(StatefulProcessor):
    """How many events a key had before a batch: one number of state per key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batches = pd.concat(list(rows)).sort_values("batch")  # a row per batch
        before = self.seen.get()[0] if self.seen.exists() else 0
        upto = before + batches["seen"].cumsum()
        self.seen.update((int(upto.iloc[-1]),))
        yield pd.DataFrame({"key": key[0], "batch": batches["batch"], "before": upto - batches["seen"]})

    def close(self) -> None:
        pass


def numbered_events(stream: DataFrame, key: str, when: str = "ts", tie: str | None = None, folder: str | None = None) -> DataFrame:
    """Give every key's events consecutive numbers across micro-batches.

    Within a batch events are numbered by time and ``tie``, range by range, so a key with most of the
    events isn't one task's work. The batch's count of every key it holds goes to a log, and a second stream
    over the log keeps one number per key in a state store: it gives each key and batch its offset, and
    touches the batch's own keys only. A batch that is tried again replaces its own rows and counts before
    the second stream sees them. Keys of any type will do, NULL is one of them.
    """
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "numbers")
    data, log = f"{folder}/data", f"{folder}/counts"
    schema = T.StructType([*stream.schema.fields, T.StructField("_name", T.StringType()), T.StructField("_batch", T.LongType()), T.StructField("_seq", T.LongType())])
    counted = T.StructType([T.StructField("key", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("seen", T.LongType())])
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{data}/batch=-1")
    spark.createDataFrame([], counted).write.mode("overwrite").parquet(f"{log}/batch=-1")

    def number(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumns({"_name": F.to_json(F.struct(name_col(key).alias("k"))), "_batch": F.lit(batch_id).cast("long")})
        rows = settle(named, "batch")
        sequence_numbers(rows, ["_name"], when, "_seq", tie).write.mode("overwrite").parquet(f"{data}/batch={batch_id}")
        counts = rows.groupBy(F.col("_name").alias("key"), F.col("_batch").alias("batch")).agg(F.count("*").alias("seen"))
        counts.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    writer.foreachBatch(number).start().awaitTermination()
    offsets = _key_offsets(spark, log, counted, folder)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(data)
    found = rows.join(offsets.select(F.col("key").alias("_name"), F.col("batch").alias("_batch"), "before"), ["_name", "_batch"])
    return found.select(*[name_col(c) for c in stream.columns], (F.col("_seq") + F.col("before")).alias("sequence_num"))


def _key_offsets(spark: SparkSession, log: str, schema: T.StructType, folder: str) -> DataFrame:
    """``(key, batch, before)`` of all batches in the log; only new ones are read."""
    share_package(spark)
    counts = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(log)
    out = T.StructType([schema["key"], schema["batch"], T.StructField("before", T.LongType())])
    offsets = counts.groupBy("key").transformWithStateInPandas(_Offsets(), out, "Append", "None")
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)  # the store that holds several states per key
    try:
        return run(offsets, "append", f"{folder}/offsets")
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def append_log(stream: DataFrame, folder: str, partition: Column | None = None) -> DataFrame:
    """Durable, duplicate-free event log: exactly-once files plus the stream checkpoint."""
    dated = stream if partition is None else stream.withColumn("log_part", partition)
    return run(dated, "append", folder)
