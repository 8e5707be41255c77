"""Arrival-driven bronze loading with Structured Streaming.

The source pipeline loads each day's snapshot on a daily schedule, without
catch-up. Here the same full-refresh load is driven by the landing folder
itself: a file-source stream over ``{base}/raw/*/{entity}.parquet`` with an
``availableNow`` trigger picks up every snapshot landed since the last run
(tracked exactly once in the stream's checkpoint), and each micro-batch
reloads its newest run date whole -- so a backlog of several days collapses to
the latest snapshot, as a truncate-and-load would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.sources import snapshot as snap
from strata.sources.catalog import current_version, version_tag

RUN_DATE = "_run_date"


def landed_stream(spark: SparkSession, landing_base: str, entity: str, file_schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of every landed snapshot file of ``entity``, with the
    run date taken from its folder name."""
    reader = spark.readStream.schema(file_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(f"{landing_base.rstrip('/')}/raw/*/{entity}.parquet")
    return df.withColumn(RUN_DATE, F.regexp_extract(F.input_file_name(), r"/raw/([^/]+)/", 1))


def _arrived_dates(batch: DataFrame) -> list[str]:
    """The run dates a micro-batch saw files of: a handful of strings."""
    return sorted(r[0] for r in batch.select(RUN_DATE).distinct().collect())


def load_new_snapshots(spark: SparkSession, landing_base: str, entity: str, file_schema: T.StructType,
                       contract: T.StructType, target_base: str, checkpoint: str,
                       unbounded_text=(), wait: bool = True) -> StreamingQuery:
    """Load whatever snapshots of ``entity`` landed since the last call into
    its bronze root (read it with :func:`strata.sources.snapshot.read_bronze`).

    A batch only tells which days have new files: the newest of them is loaded
    whole from its folder, so a day whose files arrive apart ends complete. A
    day older than the published one is skipped."""
    root = f"{target_base.rstrip('/')}/bronze/{entity}"

    def handle(batch: DataFrame, batch_id: int) -> None:
        dates = _arrived_dates(batch)
        published = current_version(batch.sparkSession, root)
        if dates and (published is None or version_tag(published) <= dates[-1]):
            snap.load_entity(batch.sparkSession, landing_base, dates[-1], entity, contract, target_base,
                             unbounded_text=unbounded_text)

    q = (landed_stream(spark, landing_base, entity, file_schema)
         .writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q


def run_on_arrival(spark: SparkSession, landing_base: str, warehouse: str, checkpoint: str,
                   marker_entity: str = "raw_games", contracts: dict | None = None,
                   fail_on_test: bool = False, wait: bool = True) -> StreamingQuery:
    """Rebuild every layer when a new day has landed (the source's "load,
    then trigger the transform run" hand-off, driven by arrival).

    The stream watches the landing folder for the ``marker_entity`` file of
    each run date; each micro-batch runs :func:`strata.plans.daily.run_daily`
    for the newest run date it saw (a backlog of days collapses to the latest,
    as a daily full refresh would). Only the batch's distinct run dates -- a
    handful of strings -- reach the driver.
    """
    from strata.plans.daily import run_daily

    file_schema = spark.read.parquet(f"{landing_base.rstrip('/')}/raw/*/{marker_entity}.parquet").schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        dates = _arrived_dates(batch)
        published = current_version(batch.sparkSession, f"{warehouse.rstrip('/')}/bronze/{marker_entity}")
        if dates and (published is None or version_tag(published) <= dates[-1]):
            run_daily(batch.sparkSession, landing_base, dates[-1], warehouse, contracts,
                      fail_on_test=fail_on_test)

    q = (landed_stream(spark, landing_base, marker_entity, file_schema)
         .writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q
