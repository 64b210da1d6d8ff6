"""Parquet tables in versions: partitions are replaced in one step that readers see whole or not at all.

Below a table's folder, ``_data`` holds a folder of files for each commit and ``_manifest`` a table of the
commits, one row for each partition that a commit replaces. A commit writes its files first and then
its manifest rows, as one file that a rename puts in place. A job that dies before that leaves files
that no manifest names; nobody reads them, and :func:`vacuum` removes them. One writer at a time; two that
meet are found out and one of them fails.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.sources.tables import NOT_READY, has_sink_log, overwrite_folder, read_if_ready

#: ``part`` is the value of ``column`` that a commit replaces; a ``whole`` commit replaces all of them. ``note``
#: is what the writer wants to know about a partition later.
MANIFEST = (
    "version BIGINT, id STRING, folder STRING, whole BOOLEAN, column STRING, part STRING,"
    " schema STRING, note STRING, committed TIMESTAMP"
)


class VersionConflict(RuntimeError):
    """Another writer has committed the same version."""


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """All commits of a table, or None where there is none."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    except AnalysisException as problem:
        if problem.getCondition() in NOT_READY:
            return None
        raise


def has_versions(spark: SparkSession, path: str) -> bool:
    return manifest(spark, path) is not None


def latest_version(spark: SparkSession, path: str) -> int:
    """The version that readers see; 0 where nothing has been committed."""
    commits = manifest(spark, path)
    return (commits.agg(F.max("version")).first()[0] or 0) if commits is not None else 0


def overwrite(
    rows: DataFrame, path: str, column: str, inner: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> int:
    """Replace the whole table, partitioned by ``column`` and ``inner``; returns the new version."""
    return _commit(rows, path, column, [None], True, inner, sort_by)


def replace_parts(
    rows: DataFrame,
    path: str,
    column: str,
    parts: Sequence[dt.date | str | int | None],
    inner: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    notes: Mapping[str | None, str] | None = None,
) -> int:
    """Replace the partitions ``parts`` of a table by those of ``rows``; returns the new version.

    A partition that ``rows`` has nothing for becomes empty. Rows of other partitions must not come. A plain
    Parquet table at ``path`` becomes version 1; from then on, read it with :func:`read_version`. ``notes``
    are kept with the partitions, by the text of their values.
    """
    if not parts:
        raise ValueError("no partition to replace")
    stray = ~_one_of(rows, column, [_text(part) for part in parts])
    checked = rows.withColumn(
        column, F.when(stray, F.raise_error(F.lit("a row of a partition that is not replaced"))).otherwise(F.col(column))
    )
    return _commit(checked, path, column, [_text(part) for part in parts], False, inner, sort_by, notes)


def newest_notes(spark: SparkSession, path: str) -> dict[str | None, str | None]:
    """The note of each partition that was replaced since the table was last written whole."""
    if not has_versions(spark, path):
        return {}
    _, later = _commits_of(spark, path, None)
    found = manifest(spark, path).filter(F.col("id").isin([commit.id for commit, _ in later]))
    notes = {(row.id, row.part): row.note for row in found.select("id", "part", "note").collect()}
    return {part: notes[commit.id, part] for commit, parts in later for part in parts}


def _commit(
    rows: DataFrame,
    path: str,
    column: str,
    parts: Sequence[str | None],
    whole: bool,
    inner: Sequence[str],
    sort_by: Sequence[str],
    notes: Mapping[str | None, str] | None = None,
) -> int:
    spark, id = rows.sparkSession, uuid.uuid4().hex
    if has_sink_log(spark, path):
        raise ValueError(f"{path} belongs to a streaming sink; write to another folder")
    version = latest_version(spark, path) + 1
    if version == 1 and not whole and (plain := read_if_ready(spark, path)) is not None:
        _record(spark, path, [(1, uuid.uuid4().hex, "", True, column, None, plain.schema.json(), None)])
        version = 2
    folder = f"_data/{version:08d}-{id}"
    overwrite_folder(rows.hint("rebalance", column, *inner), f"{path}/{folder}", [column, *inner], sort_by)
    names = [name for name in rows.columns if name not in (column, *inner)]
    schema = rows.select(*names, column, *inner).schema.json()
    notes = notes or {}
    _record(spark, path, [(version, id, folder, whole, column, part, schema, notes.get(part)) for part in parts])
    rivals = manifest(spark, path).filter(F.col("version") == version).agg(F.min("id")).first()[0]
    if rivals != id:
        raise VersionConflict(f"version {version} of {path} is another writer's")
    return version


def _record(spark: SparkSession, path: str, commits: list[tuple]) -> None:
    """Append manifest rows in one file; this is the moment from which a commit counts."""
    rows = spark.createDataFrame(commits, MANIFEST.removesuffix(", committed TIMESTAMP"))
    rows.withColumn("committed", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/_manifest")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest if none is given.

    The newest whole commit is read without the partitions that later commits replace, and each of those
    from its newest commit; filters on the partition columns prune in all of them.
    """
    base, later = _commits_of(spark, path, version)
    replaced = [part for _, parts in later for part in parts]
    tables = []
    for commit, parts in [*([(base, None)] if base else []), *later]:
        rows = spark.read.schema(StructType.fromJson(json.loads(commit.schema))).parquet(f"{path}/{commit.folder}")
        if parts is not None:
            rows = rows.filter(_one_of(rows, commit.column, parts))
        elif replaced:
            rows = rows.filter(~_one_of(rows, commit.column, replaced))
        tables.append(rows)
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), tables)


def _commits_of(spark: SparkSession, path: str, version: int | None) -> tuple[Row | None, list[tuple[Row, list[str | None]]]]:
    """The newest whole commit up to a version, and the later ones that are read with their partitions."""
    commits = manifest(spark, path)
    if commits is None:
        raise ValueError(f"{path} has no versions")
    known = commits.filter(F.col("version") <= version) if version is not None else commits
    rows = known.orderBy("version", F.desc("id")).collect()  # a row per commit and partition
    if not rows:
        raise ValueError(f"{path} has no version {version}")
    won = {row.version: row.id for row in rows}  # of writers that met, the smallest id
    rows = [row for row in rows if row.id == won[row.version]]
    base = max((row for row in rows if row.whole), key=lambda row: row.version, default=None)
    newest = {row.part: row for row in rows if base is None or row.version > base.version}
    by_commit: dict[str, tuple[Row, list[str | None]]] = {}
    for part, row in newest.items():
        by_commit.setdefault(row.id, (row, []))[1].append(part)
    return base, list(by_commit.values())


def _text(part: dt.date | str | int | None) -> str | None:
    return None if part is None else str(part)


def _one_of(rows: DataFrame, column: str, parts: Sequence[str | None]) -> Column:
    """True where the partition value is one of ``parts``, which are texts; never NULL."""
    kind = rows.schema[column].dataType.simpleString()
    found = F.col(column).isin([F.lit(part).cast(kind) for part in parts if part is not None])
    return F.coalesce(found, F.lit(None in parts))


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove the folders that none of the newest ``keep`` versions reads; returns their names.

    Folders younger than ``older_than`` stay, since a writer may be at work in them or a reader may have
    planned to read them.
    """
    commits = manifest(spark, path)
    if commits is None:
        return []
    newest, used = latest_version(spark, path), set()
    for version in range(max(1, newest - keep + 1), newest + 1):
        base, later = _commits_of(spark, path, version)
        used |= {commit.folder for commit in ([base] if base else []) + [commit for commit, _ in later]}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_data")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    before = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    removed = []
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if f"_data/{name}" not in used and status.getModificationTime() <= before:
            system.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)
