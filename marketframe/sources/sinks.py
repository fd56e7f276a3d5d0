"""Sinks: W12 published tables, partition-scoped upserts, W13 write_csv, materialize.

Tables live under a root folder.  A commit is one small immutable file
``<root>/_commits/<n>.json`` that lists, for every table, the folder of each of
its partitions.  Data folders are never written twice: a write makes new folders
for the partitions it touches, and the next commit names these beside the
untouched ones.  Readers take the highest complete commit, so they see all tables
of a commit or none, also while a write runs or after a crash.

Writers may run side by side.  A staged merge remembers the folder that each of its
partitions was merged from; a commit that finds another folder there raises
:class:`CommitConflict` and changes nothing, so no writer's rows are lost.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.session import checkpoint_dir


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm, stream = spark.sparkContext._jvm, fs.open(p)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream)).readLine() or ""
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; fails if there is one of that name, so one of two writers wins."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


class CommitConflict(RuntimeError):
    """Another commit has changed what a staged write was made from."""


@dataclass
class Staged:
    """Written folders of a table that the next commit is to name; ``whole``: they replace all others.

    ``merged_from``: the folder each part was merged from (None: there was none); ``version``: the version of
    the table that the write was made from, where it was made from all of it; ``gone``: parts that have no rows now.
    """

    table: str
    parts: dict[str, str]
    whole: bool
    schema: str
    partition_by: list[str]
    merged_from: dict[str, str | None] = field(default_factory=dict)
    version: int | None = None
    gone: set[str] = field(default_factory=set)


def read_manifest(spark: SparkSession, root: str) -> dict:
    """The highest complete commit: ``commit``, ``tables`` and ``applied``."""
    for name in reversed(_names(spark, f"{root}/_commits")):
        try:
            return json.loads(_read_text(spark, f"{root}/_commits/{name}"))
        except ValueError:                       # a commit that was cut short never happened
            continue
    return {"commit": 0, "tables": {}, "applied": {}}


def _next_manifest(manifest: dict, staged: list[Staged], applied: dict | None) -> tuple[dict, dict[str, int]]:
    tables, versions = dict(manifest["tables"]), {}
    for s in staged:
        old = tables.get(s.table, {"version": 0, "parts": {}})
        moved = [p for p, folder in s.merged_from.items() if old["parts"].get(p) != folder]
        if moved or s.version not in (None, old["version"]):
            raise CommitConflict(f"{s.table} was written by another commit meanwhile: {moved or 'the whole table'}")
        if not (s.parts or s.gone or s.whole) and old["version"]:      # nothing to change
            versions[s.table] = old["version"]
            continue
        versions[s.table] = old["version"] + 1
        tables[s.table] = {"version": versions[s.table], "schema": s.schema, "partition_by": s.partition_by,
                           "parts": s.parts if s.whole else {k: f for k, f in old["parts"].items() if k not in s.gone} | s.parts}
    return manifest | {"tables": tables, "applied": manifest["applied"] | (applied or {})}, versions


def commit(spark: SparkSession, root: str, staged: list[Staged], applied: dict | None = None) -> dict[str, int]:
    """Make staged writes visible, all at once.  Returns the new version of each table.

    Raises :class:`CommitConflict`, with nothing changed, if a part or table that a write was merged from is no longer
    the published one.  A commit that another writer overtakes is checked again against that writer's.
    """
    while True:
        taken = _names(spark, f"{root}/_commits")            # before the manifest: a later commit takes this number
        manifest, versions = _next_manifest(read_manifest(spark, root), staged, applied)
        manifest["commit"] = int(taken[-1].removesuffix(".json")) + 1 if taken else 1
        path = f"{root}/_commits/{manifest['commit']:012d}.json"
        try:
            _create(spark, path, json.dumps(manifest))
            return versions
        except Py4JJavaError:
            if not exists(spark, path):
                raise


def _write_parts(df: DataFrame, folder: str, partition_by: list[str]) -> dict[str, str]:
    """Write ``df`` under a new folder, split by SQL expressions; the folder of each partition, by its values.
    The columns themselves stay in the files.

    Rows are rebalanced: small partitions share a task, a large one is split over tasks of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.  Files are sorted by instrument and day, so reads of a few
    instruments skip row groups, after upserts too.
    """
    spark = df.sparkSession
    order = [c for c in ("instrument_id", "date") if c in df.columns]
    if not partition_by:
        df.write.parquet(folder)
        return {"": folder}
    marks = [f"_p{i}" for i in range(len(partition_by))]
    marked = df.select("*", *[F.expr(e).cast("string").alias(m) for e, m in zip(partition_by, marks)])
    marked.hint("rebalance", *[F.col(m) for m in marks]).sortWithinPartitions(*marks, *order).write.partitionBy(*marks).parquet(folder)
    found = [""]
    for _ in marks:
        found = [f"{f}/{n}" for f in found for n in _names(spark, folder + f) if "=" in n]
    return {f: folder + f for f in found}


def _folder(root: str, table: str) -> str:
    return f"{root}/{table}/data-{uuid.uuid4().hex}"


def stage_snapshot(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None, version: int | None = None) -> Staged:
    """Write all of a table's next version; ``version``: the one that ``df`` was made from, where it was."""
    by = partition_by or []
    return Staged(table, _write_parts(df, _folder(root, table), by), True, df.schema.json(), by, version=version)


def publish_tables(tables: dict[str, DataFrame], root: str, partition_by: dict[str, list[str]] | None = None) -> dict[str, int]:
    """W12 for several tables at once: readers see all the new versions or none."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    return commit(spark, root, [stage_snapshot(df, root, name, (partition_by or {}).get(name)) for name, df in tables.items()])


def publish_snapshot(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> int:
    """Publish ``df`` as the next version of ``table``."""
    return publish_tables({table: df}, root, {table: partition_by or []})[table]


def current_version(spark: SparkSession, root: str, table: str) -> int | None:
    found = read_manifest(spark, root)["tables"].get(table)
    return found and found["version"]


def _read_parts(spark: SparkSession, entry: dict, keys: set[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    folders = [f for k, f in sorted(entry["parts"].items()) if keys is None or k in keys]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The published version of ``table``."""
    entry = read_manifest(spark, root)["tables"].get(table)
    if entry is None:
        raise FileNotFoundError(f"no published snapshot of {table} under {root}")
    return _read_parts(spark, entry)


read_snapshot = read_table


def stage_upsert(batch: DataFrame, root: str, table: str, key: list[str], partition_by: list[str],
                 seq_col: str | None = None) -> Staged:
    """W1 + write at scale: merge ``batch`` into a published table, touching only the partitions it has rows in.

    The batch is written once, split as the table is; its folders name the partitions
    to read (a null partition value is a folder like any other).  Each in which the batch has a
    row that is not there as it is, is merged (the last batch row of a key wins) and written anew; the
    others' folders stay as they are.  Values are cast to the table's types, and one that doesn't fit is an error.  A table that isn't there yet starts with the batch.
    """
    from marketframe.operators.writes import latest_per_key, upsert_observations
    spark = batch.sparkSession
    columns = [c for c in batch.columns if c != seq_col]
    if seq_col in batch.columns:
        batch = latest_per_key(batch, key, seq_col, [c for c in columns if c not in key]).select(*columns)
    entry = read_manifest(spark, root)["tables"].get(table)
    if entry:                                                # its files are read with the table's types
        batch = batch.select(*[F.col(c.name).cast(c.dataType) for c in T.StructType.fromJson(json.loads(entry["schema"]))])
    landed = _write_parts(batch, _folder(root, table), entry["partition_by"] if entry else partition_by)
    if entry is None:
        return Staged(table, landed, True, batch.schema.json(), partition_by, version=0)
    new = _changed_parts(spark, entry, landed)
    touched = {k for k in new if k in entry["parts"]}
    added = {k: f for k, f in landed.items() if k in new - touched}
    if touched:
        current = _read_parts(spark, entry, touched)
        rows = _read_parts(spark, entry | {"parts": landed}, touched).select(*current.columns)
        added |= _write_parts(upsert_observations(current, rows, None, key=key), _folder(root, table), entry["partition_by"])
    return Staged(table, added, False, entry["schema"], entry["partition_by"], {k: entry["parts"].get(k) for k in added})


def _changed_parts(spark: SparkSession, entry: dict, landed: dict[str, str]) -> set[str]:
    """The parts in which ``landed`` has a row that the published table doesn't have as it is."""
    shared = {k for k in landed if k in entry["parts"]}
    if not shared:
        return set(landed)
    current = _read_parts(spark, entry, shared)
    rows = _read_parts(spark, entry | {"parts": landed}, shared)
    there = current.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(current.columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_c{i}")) for i, c in enumerate(current.columns)]
    folders = rows.select("*", F.col("_metadata.file_path").alias("_file")).join(there, same, "left_anti").select(F.regexp_extract("_file", "^(.*)/", 1).alias("f")).distinct()
    inside = lambda path: path[path.rindex("/data-"):]
    changed = {inside(unquote(r.f)) for r in folders.collect()}  # at most as many as parts
    return {k for k in landed if k not in shared or inside(landed[k]) in changed}


def upsert_table(batch: DataFrame, root: str, table: str, key: list[str], partition_by: list[str], seq_col: str | None = None,
                 attempts: int = 5) -> int:
    """Stage an upsert and commit it, anew if another writer was first; the table's new version."""
    for left in range(attempts - 1, -1, -1):
        try:
            return commit(batch.sparkSession, root, [stage_upsert(batch, root, table, key, partition_by, seq_col)])[table]
        except CommitConflict:
            if not left:
                raise


BY_YEAR = ["year(date)"]


def _years(entry: dict, first: int, last: int | None = None) -> set[str]:
    """The parts of these years of a table split by ``BY_YEAR``."""
    years = {k: int(k.split("=")[1]) for k in entry["parts"] if k.split("=")[1].isdigit()}
    return {k for k, y in years.items() if first <= y and (last is None or y <= last)}


def read_years(spark: SparkSession, root: str, table: str, first: int, last: int | None = None) -> DataFrame:
    """The rows of these years of a published table split by ``BY_YEAR``; no other part is listed or opened."""
    entry = read_manifest(spark, root)["tables"][table]
    return _read_parts(spark, entry, _years(entry, first, last))


def stage_since(rows: DataFrame, root: str, table: str, start: dt.date) -> Staged:
    """Put ``rows`` in the place of all rows dated ``start`` or later of a table split by ``BY_YEAR``.

    The year of ``start`` keeps its earlier rows, older years are not touched, later years without rows go.
    A table that isn't there yet starts with the rows.
    """
    spark = rows.sparkSession
    entry = read_manifest(spark, root)["tables"].get(table)
    if entry is None:
        return Staged(table, _write_parts(rows, _folder(root, table), BY_YEAR), True, rows.schema.json(), BY_YEAR, version=0)
    kept = _read_parts(spark, entry, _years(entry, start.year, start.year)).where(F.col("date") < F.lit(start))
    parts = _write_parts(kept.unionByName(rows.select(*kept.columns)), _folder(root, table), BY_YEAR)
    old = _years(entry, start.year)
    return Staged(table, parts, False, entry["schema"], BY_YEAR, {k: entry["parts"].get(k) for k in old | set(parts)}, gone=old - set(parts))


def stage_append(rows: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> Staged:
    """Add rows to a table in folders of their own; nothing that is there is read or written."""
    folder, by = _folder(root, table), partition_by or []
    name = folder.rsplit("/", 1)[1]
    return Staged(table, {f"{k}#{name}": f for k, f in _write_parts(rows, folder, by).items()}, False, rows.schema.json(), by)


def read_partitions(spark: SparkSession, root: str, table: str, like: Staged) -> DataFrame | None:
    """The published rows of an appended table that lie in the partitions of a staged append; None: there are none."""
    entry = read_manifest(spark, root)["tables"].get(table)
    mine = {k.split("#")[0] for k in like.parts}
    keys = {k for k in entry["parts"] if k.split("#")[0] in mine} if entry else set()
    return _read_parts(spark, entry, keys) if keys else None


def expire(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Delete commits but the last ``keep``, and data folders that none of these names; how many folders went."""
    names = _names(spark, f"{root}/_commits")
    kept = []
    for name in names[-keep:]:
        try:
            kept.append(json.loads(_read_text(spark, f"{root}/_commits/{name}")))
        except ValueError:
            continue
    used = {f[len(f"{root}/{t}/"):].split("/")[0] for m in kept for t, e in m["tables"].items() for f in e["parts"].values()}
    gone = 0
    for table in {t for m in kept for t in m["tables"]}:
        for name in _names(spark, f"{root}/{table}"):
            if name not in used:
                gone += _delete(spark, f"{root}/{table}/{name}")
    for name in names[:-keep]:
        _delete(spark, f"{root}/_commits/{name}")
    return gone


def materialize(df: DataFrame, name: str = "tmp", partition_by: list | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the whole chain) and gives later readers Parquet pushdown and pruning.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "materialized", f"{name}-{uuid.uuid4().hex}")
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete what was materialized inside when the block ends, whether it succeeds or fails."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def write_csv(df: DataFrame, path: str) -> None:
    """Flat CSV export with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
