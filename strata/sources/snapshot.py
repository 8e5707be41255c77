"""Dated snapshot landing and full-refresh loading.

A snapshot is one Parquet folder per entity per run date under
``{base}/raw/{run_date}/``. Loading matches the file to a fixed contract by
column name (case-insensitively), turns unconvertible values into quarantined
rows instead of failing the load, and replaces the target wholesale.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import write_sized
from strata.sources import runs
from strata.sources.catalog import read_current

BAD_REASON = "_bad_reason"
LOAD_STATUS = "_load_status"
MAX_TEXT = 255


def snapshot_path(base: str, run_date: str, entity: str) -> str:
    return f"{base.rstrip('/')}/raw/{run_date}/{entity}.parquet"


def _lower_map(df: DataFrame) -> dict[str, str]:
    out: dict[str, str] = {}
    for name in df.columns:
        out.setdefault(name.lower(), name)
    return out


def _source_col(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match ``df`` to ``schema`` by column name ignoring case.

    Present columns are converted with ``try_cast`` (unconvertible -> NULL),
    absent ones become typed NULLs, and columns the contract does not name are
    dropped -- so only the contract's columns are ever read from Parquet.
    """
    names = _lower_map(df)
    cols = []
    for field in schema.fields:
        src = names.get(field.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            cols.append(_source_col(df, src).try_cast(field.dataType).alias(field.name))
    return df.select(*cols)


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _not_converted(raw: Column, converted: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """True where a value did not survive its conversion: it became NULL, or a
    fraction was cut off to make a whole number; in arrays and structs, where
    that holds for any element or field. None where nothing can go wrong."""
    if source == target:
        return None
    lost = raw.isNotNull() & converted.isNull()
    if isinstance(source, _FRACTIONAL) and isinstance(target, _WHOLE):
        return lost | (raw.isNotNull() & (converted.cast(source) != raw))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        inner = F.exists(F.zip_with(raw, converted, lambda r, c: F.coalesce(
            _not_converted(r, c, source.elementType, target.elementType), F.lit(False))), lambda bad: bad)
        return lost | F.coalesce(inner, F.lit(False)) if source.elementType != target.elementType else lost
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        for a, b in zip(source.fields, target.fields):  # structs are cast by position
            field_lost = _not_converted(raw[a.name], converted[b.name], a.dataType, b.dataType)
            lost = lost if field_lost is None else lost | field_lost
    return lost


def flag_bad_rows(df: DataFrame, schema: T.StructType, max_text: int = MAX_TEXT,
                  unbounded_text: Iterable[str] = ()) -> DataFrame:
    """Aligned rows plus ``_bad_reason`` (NULL for good rows) (S3).

    A row is bad when a non-NULL input value, array element or struct field
    does not convert to the contract's type or loses a fraction to a whole
    number, or when a text value is longer than ``max_text`` characters (the
    whole text is measured; columns in ``unbounded_text`` are exempt).
    Decimals are rounded to the contract's scale, as the source's load does.
    """
    unbounded = {c.lower() for c in unbounded_text}
    names = _lower_map(df)
    cols, reasons = [], []
    for field in schema.fields:
        src = names.get(field.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = _source_col(df, src)
        conv = raw.try_cast(field.dataType)
        cols.append(conv.alias(field.name))
        lost = _not_converted(raw, conv, df.schema[src].dataType, field.dataType)
        if lost is not None:
            reasons.append(F.when(lost, F.lit(f"{field.name}: not {field.dataType.simpleString()}")))
        if isinstance(field.dataType, T.StringType) and max_text and field.name.lower() not in unbounded:
            reasons.append(F.when(F.length(conv) > max_text, F.lit(f"{field.name}: longer than {max_text}")))
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return df.select(*cols, F.when(reason != "", reason).alias(BAD_REASON))


def read_snapshot(spark: SparkSession, base: str, run_date: str, entity: str,
                  schema: T.StructType | None = None) -> DataFrame:
    """Read exactly one day's file of one entity (S1); aligned when a
    contract is given."""
    df = spark.read.parquet(snapshot_path(base, run_date, entity))
    return align_to_schema(df, schema) if schema is not None else df


def union_pages(frames: Iterable[DataFrame]) -> DataFrame:
    """Combine pages by column name; absent columns are NULL-filled.

    Pages without any column carry nothing and are skipped; an entity with no
    usable page is an error rather than an empty snapshot.
    """
    pages = [f for f in frames if f is not None and len(f.columns) > 0]
    if not pages:
        raise ValueError("no pages to union: refusing to land an empty snapshot")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def read_pages(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """Read raw JSON pages (one array or one object per line/file) as one
    frame (S5 on storage): columns are merged by name across all pages and a
    field absent from a page is NULL; every page file is read in parallel.
    """
    reader = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(list(paths) if not isinstance(paths, str) else paths)


def land_snapshot(df: DataFrame, base: str, run_date: str, entity: str,
                  zstd_level: int = 3, target_file_bytes: int | None = None) -> str:
    """Write one entity's snapshot as zstd Parquet in its day folder.

    Re-running the same day replaces that day's file only; write failures
    propagate to the caller. ``target_file_bytes`` sizes the files (see
    :func:`strata.session.write_sized`).
    """
    path = snapshot_path(base, run_date, entity)

    def write(rows: DataFrame) -> None:
        (rows.write.mode("overwrite")
         .option("compression", "zstd")
         .option("parquet.compression.codec.zstd.level", str(zstd_level))
         .parquet(path))

    write_sized(df, write, target_file_bytes)
    return path


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files under ``path``, hidden ones left out, in name order."""
    fs, p = runs.file_system(spark, path)
    found, names = fs.listFiles(p, True), []
    while found.hasNext():
        file = found.next().getPath()
        inside = file.toString().removeprefix(fs.makeQualified(p).toString()).strip("/")
        if not any(part.startswith(("_", ".")) for part in inside.split("/")):
            names.append(file.toString())
    return sorted(names)


def _schema_groups(spark: SparkSession, files: list[str]) -> tuple[list[tuple[T.StructType, list[str]]], list[tuple[str, str]]]:
    """((schema, files) groups, (file, reason) of files without a readable
    footer). Footers are read by Spark in one job; only if they disagree or
    one is broken are the halves tried on their own, so a day whose files
    agree costs one job and a stray file a logarithmic number."""
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*files).schema, files)], []
    except Exception as error:  # Spark reports disagreeing and broken footers by several types
        if len(files) == 1:
            said = str(error).strip().splitlines()
            return [], [(files[0], said[0] if said else type(error).__name__)]
    half = len(files) // 2
    (left, bad_left), (right, bad_right) = _schema_groups(spark, files[:half]), _schema_groups(spark, files[half:])
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, some in left + right:
        groups.setdefault(schema.json(), (schema, []))[1].extend(some)
    return list(groups.values()), bad_left + bad_right


def read_day(spark: SparkSession, path: str, schema: T.StructType, max_text: int = MAX_TEXT,
             unbounded_text: Iterable[str] = ()) -> DataFrame:
    """Flagged rows (see :func:`flag_bad_rows`) of every file under ``path``,
    whatever types its files have (S3 for files).

    Files are grouped by the schema in their footers; each group is read with
    its own, aligned to the contract and flagged, and the groups are unioned:
    a column may be a number in one file, text in the next and absent in a
    third. A file that has no readable footer gives one row of nulls whose
    reason starts with "unreadable file" and names it. A folder in which no
    file is readable is an error, as a missing one is. Damage behind a good
    footer fails the load, which leaves the table as it was.
    """
    files = _files(spark, path)
    groups, broken = _schema_groups(spark, files) if files else ([], [])
    if not groups:
        raise FileNotFoundError(f"{path}: " + ("none of its files is readable" if broken else "no data files"))
    frames = []
    for found, some in groups:
        whole = len(groups) == 1 and not broken
        df = spark.read.schema(found).parquet(path) if whole else spark.read.schema(found).parquet(*some)
        frames.append(flag_bad_rows(df, schema, max_text, unbounded_text))
    if broken:
        reasons = [(f"unreadable file {file.rpartition('/')[2]}: {why}",) for file, why in broken]
        lost = spark.createDataFrame(reasons, f"{BAD_REASON} string")
        frames.append(lost.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], BAD_REASON))
    return functools.reduce(DataFrame.unionByName, frames)


def _with_status(flagged: DataFrame) -> DataFrame:
    status = F.when(F.col(BAD_REASON).isNull(), F.lit("loaded")).otherwise(F.lit("quarantined"))
    return flagged.withColumn(LOAD_STATUS, status)


def stage_entity(spark: SparkSession, base: str, run_date: str, entity: str, schema: T.StructType,
                 target_base: str, max_text: int = MAX_TEXT, unbounded_text: Iterable[str] = ()) -> str:
    """Write one entity's bronze version from its snapshot, not yet current.

    One scan and one write: rows are flagged against the contract and written
    partitioned by ``_load_status`` (``loaded`` / ``quarantined``), so the
    good table and its quarantine are replaced together and the raw file is
    read once. Returns the version folder.
    """
    flagged = read_day(spark, snapshot_path(base, run_date, entity), schema, max_text, unbounded_text)
    return runs.stage(_with_status(flagged), f"{target_base.rstrip('/')}/bronze/{entity}", run_date, [LOAD_STATUS])


def load_entity(spark: SparkSession, base: str, run_date: str, entity: str, schema: T.StructType,
                target_base: str, max_text: int = MAX_TEXT, unbounded_text: Iterable[str] = ()) -> str:
    """Full-refresh one entity's bronze table from its snapshot (S1-S4) by a
    commit of its own. Returns the bronze root; read it with
    :func:`read_bronze`."""
    load_all(spark, base, run_date, {entity: schema}, target_base, max_text, unbounded_text)
    return f"{target_base.rstrip('/')}/bronze/{entity}"


def loaded_rows(df: DataFrame, quarantined: bool = False) -> DataFrame:
    """The loaded rows of a bronze version, or the quarantined ones with
    their reason; the status filter prunes to one partition folder."""
    want = "quarantined" if quarantined else "loaded"
    df = df.filter(F.col(LOAD_STATUS) == want).drop(LOAD_STATUS)
    return df if quarantined else df.drop(BAD_REASON)


def read_bronze(spark: SparkSession, root: str, quarantined: bool = False) -> DataFrame:
    """The loaded rows (or the quarantined ones, with their reason) of the
    current version of a bronze root."""
    return loaded_rows(read_current(spark, root), quarantined)


def stage_all(spark: SparkSession, base: str, run_date: str, contracts: Mapping[str, T.StructType], target_base: str,
              max_text: int = MAX_TEXT, unbounded_text: Iterable[str] = (), parallel: int = 4) -> dict[str, str]:
    """Stage every entity of one run date, ``parallel`` at a time (they don't
    depend on each other). The first failure, in the order of ``contracts``,
    is raised once the started ones have ended; later ones are not started.
    Returns table ("bronze/entity") -> version folder."""
    stop = threading.Event()

    def one(item):
        if stop.is_set():
            return None
        try:
            return stage_entity(spark, base, run_date, item[0], item[1], target_base, max_text, unbounded_text)
        except BaseException:
            stop.set()
            raise

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        jobs = [pool.submit(one, item) for item in contracts.items()]
    return {f"bronze/{entity}": job.result() for entity, job in zip(contracts, jobs)}


def load_all(spark: SparkSession, base: str, run_date: str,
             contracts: Mapping[str, T.StructType], target_base: str,
             max_text: int = MAX_TEXT, unbounded_text: Iterable[str] = (), parallel: int = 4) -> dict[str, str]:
    """Load every entity of one run date into its bronze table.

    All versions are staged first and become current by one commit: a reader
    sees all entities of the day or none, and a failure leaves every table at
    the run before. Returns entity -> bronze root.
    """
    staged = stage_all(spark, base, run_date, contracts, target_base, max_text, unbounded_text, parallel)
    runs.commit(spark, target_base, run_date, staged)
    return {entity: f"{target_base.rstrip('/')}/bronze/{entity}" for entity in contracts}
