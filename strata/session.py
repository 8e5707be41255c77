"""Session defaults and the few cluster-facing helpers every job shares.

Everything here is plain ``SparkSession`` configuration. The settings that
matter at scale are AQE (runtime join-strategy switch, partition coalescing,
skew-join splitting), a UTC session time zone (epoch conversions must not
depend on the driver's locale) and ANSI mode (bad casts fail loudly unless a
``try_`` function is used on purpose).
"""

from __future__ import annotations

import atexit
import os
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


MiB = 1024 * 1024


def partition_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * MiB,
                       max_split_bytes: int = 512 * MiB) -> dict[str, str]:
    """Sizing for a job over ``input_bytes`` on ``total_cores`` cores.

    Initial shuffle partitions are sized so each holds about
    ``target_partition_bytes`` of (pre-aggregation) input, rounded up to a
    multiple of the core count and at least 2 waves; AQE then coalesces
    toward the same advisory size after each shuffle and splits skewed ones.
    Scan splits are capped at ``max_split_bytes`` so a task's input stays
    well inside executor memory. Example: 100 TiB on 8000 cores gives 416,000
    shuffle partitions (52 full waves) of ~250 MiB.
    """
    cores = max(1, total_cores)
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // cores) * cores
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_spark(master: str | None = None, app: str = "strata",
              shuffle_partitions: int | None = None,
              extra: dict | None = None, input_bytes: int | None = None,
              total_cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control of it
    on a cluster. Give ``input_bytes`` and ``total_cores`` to size shuffle
    partitions and scan splits with :func:`partition_settings`, or set
    ``shuffle_partitions`` directly; AQE coalesces small partitions afterwards.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes and total_cores:
        conf.update(partition_settings(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no context
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins. Only on a ``local`` master
    (tests) may it be unset: then ``fallback``, or a fresh folder under the
    system temp dir, is installed. Any other master without the setting is an
    error, so a cluster never writes to a machine-local path.
    """
    sc = _context(spark)
    current = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return (sc.getCheckpointDir() if sc is not None else None) or current
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), f"strata-ckpt-{uuid.uuid4().hex[:8]}")
    spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    return path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder (for landing zones and
    materialized intermediates that every executor must see)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def _scratch_root(spark: SparkSession) -> str:
    sc = _context(spark)
    return shared_path(spark, "strata", sc.applicationId if sc is not None else "remote")


_RELEASED_AT_EXIT: set[str] = set()


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh, unique folder for intermediate data under the shared
    checkpoint folder. It belongs to the application and goes with it."""
    root = _scratch_root(spark)
    if root not in _RELEASED_AT_EXIT:
        _RELEASED_AT_EXIT.add(root)
        atexit.register(release_scratch, spark)
    return f"{root}/{prefix}-{uuid.uuid4().hex[:12]}"


def release_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate data: at the end of a run, when
    no frame that reads it is used any more. Nothing to do on a session that
    has been stopped."""
    sc = _context(spark)
    if sc is None or sc._jsc is None:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 * MiB) -> DataFrame:
    """Broadcast ``df`` if the optimizer's size estimate is at most
    ``max_bytes``; else leave the join strategy to Catalyst and AQE.

    Estimates come from file sizes and never shrink on filters or
    aggregates without statistics, so they are upper bounds for what is read
    from columnar files up to their compression; no job runs for them.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if estimate <= max_bytes // COMPRESSION else df


_SIZING = threading.Lock()


@contextmanager
def shuffle_target(spark: SparkSession, target_bytes: int):
    """Jobs run inside aim at ``target_bytes`` per rebalanced partition. The
    setting is the session's, so such blocks run one at a time."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")
    with _SIZING:
        before = {n: spark.conf.get(n, None) for n in names}
        spark.conf.set(names[0], str(target_bytes))
        spark.conf.set(names[1], "false")
        try:
            yield
        finally:
            for n, v in before.items():
                spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def write_sized(df: DataFrame, write, target_file_bytes: int | None = None, partition_by: list[str] | None = None) -> None:
    """Run ``write(df)``, a Parquet write, with files of about
    ``target_file_bytes``: partitions are rebalanced first (one shuffle), so
    small ones are put together and large ones split, per partition folder if
    there are any, however skewed the rows are over tasks or folders. The
    target counts shuffled bytes; columnar files come out smaller as they
    compress. Without a target there is no shuffle and a file per task."""
    if target_file_bytes is None:
        write(df)
        return
    if target_file_bytes < 1:
        raise ValueError("target_file_bytes must be positive")
    with shuffle_target(df.sparkSession, target_file_bytes):
        write(df.hint("rebalance", *(partition_by or [])))


#: Rows in memory may take so many times their columnar files' bytes.
COMPRESSION = 8


def materialize_shared(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as Parquet into a fresh folder of the shared
    checkpoint directory and return a frame reading it back.

    This cuts the lineage like a reliable checkpoint (and survives executor
    loss, unlike a local checkpoint), but keeps the data columnar: later
    reads prune columns and push filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
