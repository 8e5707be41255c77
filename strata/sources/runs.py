"""Run-level commits: one manifest names every table's version of a run.

A run first writes ("stages") version folders that nobody reads. One small
file, the manifest, then names the version of each table, and readers follow
the newest manifest: either all tables of a run become current or none does.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strata.session import write_sized

#: Manifests, and the versions they name, that stay on storage.
KEPT_RUNS = 2
_LOG = "_runs"
_ROW = "number bigint, tag string, table string, path string"


@dataclass(frozen=True)
class Run:
    """A committed state of a warehouse: its number, the tag of the commit
    that made it, and the version folder of every table ("layer/name")."""

    number: int
    tag: str
    tables: Mapping[str, str]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if table not in self.tables:
            raise FileNotFoundError(f"no version of {table} in run {self.number}")
        return spark.read.parquet(self.tables[table])


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``; none if it isn't there."""
    fs, path = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def numbered(names: list[str]) -> list[int]:
    return sorted(int(n) for n in names if re.fullmatch(r"\d+", n))


def split_root(root: str) -> tuple[str, str]:
    """(base, "layer/name") of a table root ``{base}/{layer}/{name}``."""
    base, layer, name = root.rstrip("/").rsplit("/", 2)
    return base, f"{layer}/{name}"


def stage(df: DataFrame, root: str, tag: str, partition_by: list[str] | None = None, target_file_bytes: int | None = None) -> str:
    """Write ``df`` as a version folder of the table at ``root``, with files
    of about ``target_file_bytes`` if given. It stays unseen until a commit
    names it."""
    version = f"{root.rstrip('/')}/versions/{tag}-{uuid.uuid4().hex[:10]}"

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version)

    write_sized(df, write, target_file_bytes, partition_by)
    return version


def history(spark: SparkSession, base: str) -> list[Run]:
    """The complete manifests, newest first. A manifest is one file that its
    commit renames into place, so one that was begun and aborted has no rows
    and is not there for readers."""
    folder = f"{base.rstrip('/')}/{_LOG}"
    if not numbered(children(spark, folder)):
        return []
    runs: dict[int, list] = {}
    for r in spark.read.schema(_ROW).json(f"{folder}/*").collect():  # one row per table and kept run
        if r["number"] is not None:
            runs.setdefault(r["number"], []).append(r)
    return [Run(n, rows[0]["tag"], {r["table"]: r["path"] for r in rows}) for n, rows in sorted(runs.items(), reverse=True)]


def current(spark: SparkSession, base: str) -> Run | None:
    """The newest complete run of a warehouse; None before the first."""
    found = history(spark, base)
    return found[0] if found else None


def _add(spark: SparkSession, base: str, number: int, tag: str, tables: Mapping[str, str]) -> bool:
    """Write manifest ``number``; False if another commit has taken it."""
    rows = spark.createDataFrame([(number, tag, t, p) for t, p in sorted(tables.items())], _ROW)
    try:
        rows.coalesce(1).write.mode("error").json(f"{base}/{_LOG}/{number:010d}")
    except AnalysisException as taken:
        if "PATH_ALREADY_EXISTS" not in str(taken):
            raise
        return False
    return True


def commit(spark: SparkSession, base: str, tag: str, staged: Mapping[str, str], attempts: int = 20) -> Run:
    """Make the staged versions (table -> folder) current, all at once; every
    other table keeps the version it has.

    The manifest takes the next number that no folder has, be it complete or
    only begun, so an aborted commit never blocks a later one. If another
    commit with a higher number got through meanwhile, this one is written
    again on top of it: no commit's tables are lost. Manifests beyond the
    newest ``KEPT_RUNS`` go, and with them the versions that none names.
    """
    base = base.rstrip("/")
    if not staged:
        raise ValueError("nothing to commit")
    for _ in range(attempts):
        before = history(spark, base)
        taken = numbered(children(spark, f"{base}/{_LOG}"))
        number = taken[-1] + 1 if taken else 0
        tables = {**(before[0].tables if before else {}), **staged}
        if not _add(spark, base, number, tag, tables):
            continue
        after = history(spark, base)
        if after[0].number == number and before == [r for r in after if r.number < number]:
            _prune(spark, base, after)
            return after[0]
    raise RuntimeError(f"{base}: other commits kept getting ahead of this one")


def _prune(spark: SparkSession, base: str, runs: list[Run]) -> None:
    kept, old = runs[:KEPT_RUNS], runs[KEPT_RUNS:]
    used = {p for r in kept for p in r.tables.values()}
    for run in old:  # manifests first: they must never dangle; begun ones may be another commit's at work
        remove(spark, f"{base}/{_LOG}/{run.number:010d}")
    for path in {p for r in old for p in r.tables.values()} - used:
        remove(spark, path)


def recover(spark: SparkSession, base: str) -> list[str]:
    """Clean up after runs that died, while no run is going on: begun
    manifests and staged versions that no manifest names are removed. Returns
    what was removed."""
    base = base.rstrip("/")
    runs = history(spark, base)
    complete, used = {r.number for r in runs}, {p for r in runs for p in r.tables.values()}
    gone = [f"{base}/{_LOG}/{n:010d}" for n in numbered(children(spark, f"{base}/{_LOG}")) if n not in complete]
    for table in {t for r in runs for t in r.tables}:
        folder = f"{base}/{table}/versions"
        gone += [f"{folder}/{name}" for name in children(spark, folder) if not any(u.endswith(f"/{table}/versions/{name}") for u in used)]
    for path in gone:
        remove(spark, path)
    return sorted(gone)
