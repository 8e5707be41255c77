"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, scratch_path

#: Columns that operators add for their own use start with ``__s_``, so that
#: no column of the input meets them.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Whitespace that separates words in the contracts: space, \t \n \v \f \r.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Words made of digits, letters and everything beyond ASCII.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z folded and every other character kept."""
    return F.translate(text, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so a
    lost executor costs no recomputation of what led to it. The schema is
    passed on: empty frames read back too. ``codec`` is the files' compression,
    by default the session's."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files behind a frame made by :func:`stored` that nothing
    reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose frames are gone: its
    cleaner acts when the driver collects garbage, which may be long after."""
    gc.collect()
    spark._jvm.System.gc()


def bucket_count(rows: int, rows_per_bucket: int) -> int:
    """Buckets that hold about ``rows_per_bucket`` rows each, at least one."""
    return max(1, -(-rows // rows_per_bucket))


def numbered(df: DataFrame, group: str, keys: list[str], slot: str, rows_per_bucket: int = 50_000) -> DataFrame:
    """``df`` with a gapless number from 0 within each ``group``.

    Rows are counted per (group, hash bucket of the whole row); a running sum
    of those counts is the offset of a bucket, and a window numbers the
    distinct rows inside it, by ``keys`` and then the other columns. Rows equal
    in every column are counted first and expanded last. So neither a large
    group, nor one key that many different rows share, nor a third of the table
    being one repeated row meets in one task. ``df`` should hold only the
    columns to keep.
    """
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__s_copies"))
    rows = df.count()
    distinct = distinct.withColumn("__s_bucket", F.pmod(F.xxhash64(*df.columns), F.lit(bucket_count(rows, rows_per_bucket))))
    sizes = distinct.groupBy(group, "__s_bucket").agg(F.sum("__s_copies").alias("__s_rows"))
    before = Window.partitionBy(group).orderBy("__s_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("__s_g"), F.col("__s_bucket").alias("__s_b"),
                           F.coalesce(F.sum("__s_rows").over(before), F.lit(0)).alias("__s_offset"))
    inside = (Window.partitionBy(group, "__s_bucket").orderBy(*[F.col(k).asc_nulls_last() for k in dict.fromkeys([*keys, *df.columns])])
              .rowsBetween(Window.unboundedPreceding, -1))
    first = distinct.withColumn("__s_first", F.coalesce(F.sum("__s_copies").over(inside), F.lit(0)))
    joined = first.join(offsets, F.col(group).eqNullSafe(F.col("__s_g")) & (F.col("__s_bucket") == F.col("__s_b")))
    start = F.col("__s_offset") + F.col("__s_first")
    return joined.select(*df.columns, F.explode(F.sequence(start, start + F.col("__s_copies") - 1)).alias(slot))
