"""Session helpers: the settings the operators rely on and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"
# Recording the Python call site of every expression costs several round trips to the
# JVM per call, which dominates the building of wide aggregates. Static: it can only be
# set when the session is made.
CALL_SITES_KEY = "spark.python.sql.dataFrameDebugging.enabled"


def build_session(app: str = "statloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        CALL_SITES_KEY: "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """What the operators rely on, on a foreign session: the time zone (tables carry zone-less
    timestamps), and JSON objects that repeat a key."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), (DUPLICATE_KEYS, "true")):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    share_package(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, unless they have it anyway.

    Workers on other machines find it at the same path, or have it installed or sent with the job.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([root, *([known] if known else [])])


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    With nothing configured a local master uses a folder of the warehouse; a cluster has to
    name one, as no machine-local folder is visible to the other executors.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/statloom-work"
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name of the shared folder (never reused, never cleared)."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage through a parquet table in the shared folder; survives executor loss."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
