"""Layered naming, materialization and inline parameter tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import runs

# The report's "Top N" choices and its dimension-switch rows
# (label, field, sort order), as the semantic model defines them.
TOP_N_CHOICES = [1, 3, 5, 10, 25, 50, 100, 1000]
DEFAULT_TOP_N = 10
ASPECT_CHOICES = [
    ("Platforms", "'DIM_PLATFORM'[Platform name]", 0),
    ("Franchises", "'DIM_FRANCHISE'[Franchise name]", 1),
    ("Game modes", "'DIM_GAMEMODE'[Game mode name]", 2),
    ("Genres", "'DIM_GENRE'[Genre name]", 3),
    ("Game types", "'DIM_GAMETYPE'[Game type name]", 4),
]


#: Complete versions of a table that stay on storage; older ones are removed.
KEPT_VERSIONS = 2
_POINTER = "number bigint, path string"


def _pointers(spark: SparkSession, root: str) -> list:
    """(number, path) of the table's complete versions, newest first: one
    small row per kept version."""
    folder = f"{root.rstrip('/')}/_pointers"
    if not runs.numbered(runs.children(spark, folder)):
        return []
    rows = spark.read.schema(_POINTER).json(f"{folder}/*").collect()
    return sorted(((r["number"], r["path"]) for r in rows if r["path"]), reverse=True)


def publish(df: DataFrame, root: str, tag: str, partition_by: list[str] | None = None, target_file_bytes: int | None = None) -> str:
    """Write ``df`` as a new version folder of the table at ``root`` and make
    it current. Nothing that readers (:func:`read_current`) use is ever
    rewritten: a write that fails, of the version or of what names it, leaves
    the table as it was, and blocks no later one.

    A table that a run's manifest names (see :mod:`strata.sources.runs`) is
    published by a commit of its own; any other gets a pointer with the next
    free number. Then versions beyond the newest ``KEPT_VERSIONS`` are
    removed. ``target_file_bytes`` sizes the files (see
    :func:`strata.session.write_sized`)."""
    spark = df.sparkSession
    root = root.rstrip("/")
    version = runs.stage(df, root, tag, partition_by, target_file_bytes)
    base, table = runs.split_root(root)
    run = runs.current(spark, base)
    if run is not None and table in run.tables:
        runs.commit(spark, base, tag, {table: version})
        return version
    before = _pointers(spark, root)
    taken = runs.numbered(runs.children(spark, f"{root}/_pointers"))  # begun and aborted ones included
    number = taken[-1] + 1 if taken else 0
    pointer = spark.createDataFrame([(number, version)], _POINTER).coalesce(1)
    pointer.write.mode("error").json(f"{root}/_pointers/{number:010d}")
    for old, path in before[KEPT_VERSIONS - 1:]:  # the pointer first: it must never dangle
        runs.remove(spark, f"{root}/_pointers/{old:010d}")
        runs.remove(spark, path)
    return version


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest complete version; None before the first."""
    base, table = runs.split_root(root)
    run = runs.current(spark, base)
    if run is not None and table in run.tables:
        return run.tables[table]
    found = _pointers(spark, root)
    return found[0][1] if found else None


def version_tag(version: str) -> str:
    """The tag that a version was published under."""
    return version.rstrip("/").rpartition("/")[2].rpartition("-")[0]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version of {root} has been published")
    return spark.read.parquet(version)


def schema_name(custom: str | None, default: str) -> str:
    """A model's configured layer name is used as-is, else the default."""
    return custom.strip() if custom and custom.strip() else default


def view_name(layer: str, name: str) -> str:
    return f"{layer}_{name}".lower()


def materialize(df: DataFrame, layer: str, name: str, kind: str = "table",
                base: str | None = None, bucket_by: tuple[int, list[str]] | None = None,
                target_file_bytes: int | None = None) -> DataFrame:
    """Publish a model (S8): ``table`` persists it (a new Parquet version
    under ``base`` made current by :func:`publish`, else a catalog table
    ``layer.name``); ``view`` registers the plan for every session of the
    application (a global temporary view), so it is recomputed -- and optimized
    together with its consumer -- at read time. :func:`create_view` makes views
    that outlive the application. ``bucket_by=(n, cols)`` writes a catalog table bucketed
    and sorted by ``cols``: tables bucketed alike on a join key are joined
    later without shuffling either side. Returns the frame consumers read."""
    spark = df.sparkSession
    vname = view_name(layer, name)
    if kind == "view":
        return _register(df, vname)
    if kind != "table":
        raise ValueError(f"unknown materialization {kind!r}")
    if base is not None:
        root = f"{base.rstrip('/')}/{layer}/{name}"
        out = spark.read.parquet(publish(df, root, name, target_file_bytes=target_file_bytes))
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        writer = df.write.mode("overwrite").format("parquet")
        if bucket_by:
            n, cols = bucket_by
            writer = writer.bucketBy(n, *cols).sortBy(*cols)
        writer.saveAsTable(f"`{layer}`.`{name}`")
        out = spark.table(f"`{layer}`.`{name}`")
    return _register(out, vname)


def _register(df: DataFrame, vname: str) -> DataFrame:
    df.createOrReplaceGlobalTempView(vname)
    return df.sparkSession.table(f"global_temp.{vname}")


def create_view(spark: SparkSession, layer: str, name: str, select: str) -> DataFrame:
    """A persistent view ``layer.name`` over catalog tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {select}")
    return spark.table(f"`{layer}`.`{name}`")


def ref(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """Resolve a published model by layer and name (S9), from any session:
    one published by this application, else the catalog's ``layer.name``."""
    published = f"global_temp.{view_name(layer, name)}"
    return spark.table(published if spark.catalog.tableExists(published) else f"`{layer}`.`{name}`")


def values_table(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """A small inline constant table."""
    return spark.createDataFrame(rows, schema)


def top_n_choices(spark: SparkSession) -> DataFrame:
    return values_table(spark, [(n,) for n in TOP_N_CHOICES], "top_n bigint")


def aspect_choices(spark: SparkSession) -> DataFrame:
    return values_table(spark, ASPECT_CHOICES, "aspect string, field string, sort_order int")


def selected_value(values, default=None):
    """The single selected value of a slicer, else ``default``."""
    if values is None:
        return default
    vals = list(dict.fromkeys(values))
    return vals[0] if len(vals) == 1 else default
