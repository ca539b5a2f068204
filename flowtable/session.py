"""Session, shared-folder and join-size helpers used by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest lookup side (rows) that operators broadcast after checking it.
BROADCAST_MAX_ROWS = 1_000_000
# ... and their size as JSON text, an upper bound in practice of what is sent.
BROADCAST_MAX_BYTES = 64 << 20
# Sides whose plan statistics already exceed this are not counted at all.
BROADCAST_MAX_EST_BYTES = 1 << 30


def get_session(master: str | None = None, app: str = "flowtable", partitions: int | None = None) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_fallback_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a folder of its own: on
    a cluster a machine-local folder would be invisible to other executors,
    so a missing setting is an error there.
    """
    global _fallback_dir
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the conf is all there is
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _fallback_dir is None:
            _fallback_dir = tempfile.mkdtemp(prefix="flowtable-ckpt-")
        path = _fallback_dir
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cluster_cores(spark: SparkSession) -> int:
    """Cores of the cluster (default parallelism), or the shuffle partition
    count when the context is not reachable."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one run's output."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "flowtable", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: later
    steps survive lost executors and never compute it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (file sizes for scans; an upper
    bound in practice, since filters are not subtracted without CBO)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # no JVM handle (e.g. Spark Connect): fall back to counting
        return None


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Proves that ``df`` has at most ``max_rows`` rows and at most
    ``BROADCAST_MAX_BYTES`` (stops reading after max_rows + 1 rows). Sides the
    optimizer already estimates as large are refused without reading them, so
    the check never costs a scan of a big table."""
    est = estimated_bytes(df)
    if est is not None and est > BROADCAST_MAX_EST_BYTES:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long"))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return rows <= max_rows and (size or 0) <= BROADCAST_MAX_BYTES


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, check: DataFrame | None = None) -> DataFrame:
    """Broadcast hint for a side whose row count is checked; otherwise the
    plain side, so the join shuffles (and AQE may still broadcast it at run
    time from measured sizes).

    ``check`` is a cheaper DataFrame that bounds ``df``'s rows (e.g. the raw
    input of a ``distinct``), so the check does not compute ``df`` itself.
    Sides derived by shuffles or windows are better left to AQE's runtime
    conversion, which measures them without running them twice.
    """
    return F.broadcast(df) if fits_broadcast(df if check is None else check, max_rows) else df


def spread(df: DataFrame, heavy: bool = False) -> DataFrame:
    """Spread an under-partitioned input over the cluster's cores before
    CPU-heavy per-row work (a round-robin exchange). It applies when fewer
    than half the cores would be busy, or fewer than all of them for
    ``heavy`` work (Python stages, several regex passes per row). Any large
    table has far more partitions than that, so at scale this adds no shuffle."""
    cores = cluster_cores(df.sparkSession)
    try:
        # An input that already went through an exchange is partitioned by the
        # shuffle; asking an adaptive plan for its RDD would run that shuffle.
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            return df
        parts = df.rdd.getNumPartitions()
    except Exception:  # no JVM or RDD view (e.g. Spark Connect): leave it as is
        return df
    limit = cores if heavy else cores // 2
    return df.repartition(cores) if parts < limit else df


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared checkpoint folder (made known to
    the SparkContext first); survives executor loss, unlike a local checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
