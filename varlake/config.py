"""Session helpers and the size limits every operator shares.

A library function never creates or reconfigures the caller's session; the
helpers here are for tests, the bench and command-line use.  Limits that decide
whether a table may be broadcast are explicit arguments with these defaults, so
a broadcast only ever happens behind a measured row bound.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Limits:
    """Bounds used by the join planners in :mod:`varlake.operators.joins`.

    ``max_broadcast_rows``, ``max_broadcast_bytes``: a lookup side is
    broadcast only if a distributed count proves it has at most this many rows
    and bytes.
    ``max_variant_rows``, ``max_variant_bytes``: a variant table whose keys
    are within both is annotated with a broadcast key set (key-reduced
    annotation); larger tables use the shuffle plan on distinct keys.
    ``hot_key_rows``: a join key carrying more rows than this is split over
    ``ceil(rows / hot_key_rows)`` salted sub-keys.  There are fewer such keys
    than rows / ``hot_key_rows``, and all of them are split.
    ``max_total_broadcast_bytes``: all broadcasts of one pipeline together (the
    variants' keys and the lookup tables) are within it; tables that no longer
    fit are shuffled.
    ``max_sketch_bytes``: a sketch of the variants' keys is broadcast to filter
    annotation tables before they are shuffled if it is within this bound.
    """

    max_broadcast_rows: int = 2_000_000
    max_variant_rows: int = 5_000_000
    max_broadcast_bytes: int = 256 << 20
    max_variant_bytes: int = 512 << 20
    hot_key_rows: int = 1_000_000
    max_sketch_bytes: int = 64 << 20
    max_total_broadcast_bytes: int = 768 << 20


DEFAULT_LIMITS = Limits()


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "varlake",
    event_log_dir: str | None = None,
) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, ANSI on)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Static estimates of parquet scans are compressed file sizes, not a
        # bound on the rows a broadcast would hold: plan-time auto-broadcast is
        # off; AQE converts a join to broadcast only from measured shuffle
        # output, and the library broadcasts only behind a bounded count.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        # Generated methods above 8000 bytes of bytecode are never JIT-compiled
        # by the JVM; let whole-stage codegen fall back to per-operator code
        # instead of running such methods interpreted (wide VCF parsing
        # stages were 4-6x slower without this).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VARLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log_dir
        ).config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # a session without a SparkContext handle (Spark Connect)
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared folder.  A session that names none gets a local
    one if it runs in one JVM (tests, the bench); on a cluster that would be
    a folder the executors don't share, so it is an error."""
    existing = checkpoint_dir(spark)
    if existing:
        return existing
    if spark.conf.get("spark.master", "").split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="varlake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return checkpoint_dir(spark) or local


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; its
    lineage ends there, and a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/varlake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
