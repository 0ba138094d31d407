"""Publishing whole sets of tables as versions, and changing a published table by the files that hold touched keys.

A published folder holds `data/` with the Parquet files of all versions, and `versions/<n>` with one manifest each: which
files make up each table, how many rows every file has, and the least and greatest key in it.  A version is there once its
manifest is, which is written last, as a single file.  Readers pick a manifest and then read nothing but the files it names,
so they see one version or another and never part of a refresh; a refresh that stops half way leaves files that no manifest
names.  Files are never changed.  An update writes new files for those that hold touched keys, and the next manifest names
these beside the untouched ones.

Versions are numbered 1, 2, …; a writer that finds its number taken fails and may start over from the newer version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.merge import reduce_batch, upsert
from ledgerloom.operators.skew import join_key, lookup_join
from ledgerloom.session import Stored, store

_MANIFEST = "table string, schema string, key string, file string, rows long, low string, high string"


def _place(spark: SparkSession, path: str):
    """A Hadoop path and its file system: what Spark itself reads and writes through."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _version_folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/versions/{version:012d}"


def _folders(spark: SparkSession, path: str) -> dict[int, bool]:
    """All version numbers taken, and whether their manifest is complete."""
    where, files = _place(spark, f"{path.rstrip('/')}/versions")
    if not files.exists(where):
        return {}
    success = spark._jvm.org.apache.hadoop.fs.Path
    return {int(s.getPath().getName()): files.exists(success(s.getPath(), "_SUCCESS")) for s in files.listStatus(where)}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all versions whose manifest is complete, oldest first."""
    return sorted(n for n, done in _folders(spark, path).items() if done)


@dataclass(frozen=True)
class Snapshot:
    """One version: a row for each file of each table, and a row without file for an empty table."""

    spark: SparkSession
    path: str
    version: int
    files: tuple

    @property
    def tables(self) -> list[str]:
        return sorted({f["table"] for f in self.files})

    @property
    def rows(self) -> dict[str, int]:
        return {t: sum(f["rows"] for f in self.files if f["table"] == t) for t in self.tables}

    def files_of(self, table: str) -> list:
        return [f for f in self.files if f["table"] == table and f["file"]]

    def read(self, table: str) -> DataFrame:
        listed = [f for f in self.files if f["table"] == table]
        if not listed:
            raise KeyError(f"no table {table} in version {self.version} of {self.path}")
        schema = T.StructType.fromJson(json.loads(listed[0]["schema"]))
        names = [f"{self.path}/{f['file']}" for f in listed if f["file"]]
        return self.spark.read.schema(schema).parquet(*names) if names else self.spark.createDataFrame([], schema)


def open_snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest version, or the one asked for; None where nothing was published yet."""
    path = path.rstrip("/")
    there = versions(spark, path)
    if version is None and not there:
        return None
    if version is not None and version not in there:
        raise KeyError(f"no version {version} of {path}")
    version = there[-1] if version is None else version
    rows = spark.read.schema(_MANIFEST).parquet(_version_folder(path, version)).collect()  # one row for each file
    return Snapshot(spark, path, version, tuple(r.asDict() for r in rows))


def read_snapshot(spark: SparkSession, path: str, names: Iterable[str] | None = None, version: int | None = None) -> dict[str, DataFrame]:
    """Tables of one version, the newest if none is given."""
    found = open_snapshot(spark, path, version)
    if found is None:
        raise KeyError(f"nothing was published at {path}")
    return {n: found.read(n) for n in (names or found.tables)}


def _commit(spark: SparkSession, path: str, last: Snapshot | None, files: list[dict]) -> Snapshot:
    """Make the version after `last` visible by its manifest, a single file; numbers of broken manifests are passed over."""
    taken = _folders(spark, path)
    newest = max((n for n, done in taken.items() if done), default=0)
    if newest != (last.version if last else 0):
        raise RuntimeError(f"version {newest} of {path} was published meanwhile")
    version = max(taken, default=0) + 1
    columns = [f.name for f in T.StructType.fromDDL(_MANIFEST).fields]
    frame = spark.createDataFrame([tuple(f[c] for c in columns) for f in files], _MANIFEST).coalesce(1)
    frame.write.mode("errorifexists").parquet(_version_folder(path, version))
    return Snapshot(spark, path, version, tuple(files))


def _span(key: Column) -> tuple[Column, Column]:
    return F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")


def _file_name() -> Column:
    """The name of the file that a row stands in; Spark's names are unique over all writes."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def _write_files(
    df: DataFrame, path: str, table: str, key: str | None, rows_per_file: int | None = None, then: str | None = None
) -> list[dict]:
    """Write a table in files of its own and list them; sorted by its key, so that few files hold a few neighbouring keys.

    Rows of one key are split over files by the column `then`, where many may share it.
    """
    spark, schema = df.sparkSession, df.schema
    folder = f"data/{table}-{uuid.uuid4().hex}"
    if key:
        by = [key, then] if then else [key]
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.mode("errorifexists").parquet(f"{path}/{folder}")
    written = spark.read.schema(schema).parquet(f"{path}/{folder}")
    nothing = F.lit(None).cast("string")
    low, high = _span(F.col(key)) if key else (nothing.alias("low"), nothing.alias("high"))
    counts = written.groupBy(_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), low, high).collect()  # one row for each file
    listed = [{"file": f"{folder}/{r['file']}", "rows": r["rows"], "low": r["low"], "high": r["high"]} for r in counts]
    listed = listed or [{"file": None, "rows": 0, "low": None, "high": None}]
    return [{"table": table, "schema": schema.json(), "key": key, **f} for f in listed]


def publish_snapshot(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    path: str,
    keys: dict[str, str] | None = None,
    keep_others: bool = False,
    rows_per_file: int | None = None,
) -> Snapshot:
    """Write tables as the next version, which appears as a whole when the last of them is written.

    `keys` names the column by which a table's files are sorted, for later updates.  With `keep_others`, tables of the last
    version that aren't given are part of the new one, without being written again.
    """
    path = path.rstrip("/")
    last = open_snapshot(spark, path)
    files = [f for name, df in tables.items() for f in _write_files(df, path, name, (keys or {}).get(name), rows_per_file)]
    if keep_others and last:
        files += [f for f in last.files if f["table"] not in tables]
    return _commit(spark, path, last, files)


@dataclass(frozen=True)
class Updated:
    snapshot: Snapshot
    read: int  # files searched for keys
    rewritten: int  # files that held touched keys
    kept: int


def _touched(last: Snapshot, table: str, key: str, keys: Stored) -> tuple[list[dict], int]:
    """Files that hold a key of `keys`: those whose span may hold one are searched, by a scan of the key column."""
    listed = last.files_of(table)
    if not listed:
        return [], 0
    schema = last.read(table).schema
    kind = schema[key].dataType
    side = keys.df.select(F.col(key).cast(kind).alias("_key")).filter(F.col("_key").isNotNull())
    spans = [(f["file"], f["low"], f["high"]) for f in listed if f["low"] is not None]
    span = last.spark.createDataFrame(spans, "file string, low string, high string")
    bounds = side.agg(F.min("_key").alias("_least"), F.max("_key").alias("_most"))
    meets = (F.col("low").cast(kind) <= F.col("_most")) & (F.col("high").cast(kind) >= F.col("_least"))
    may = [r["file"] for r in span.crossJoin(F.broadcast(bounds)).filter(meets).select("file").collect()]  # bounds: one row
    if not may:
        return [], 0
    scan = last.spark.read.schema(schema).parquet(*[f"{last.path}/{name}" for name in may])
    scan = scan.select(F.col(key).alias("_held"), _file_name().alias("_file"))
    side = F.broadcast(side) if keys.fits_broadcast else side
    held = {r["_file"] for r in scan.join(side, F.col("_held") == F.col("_key"), "left_semi").select("_file").distinct().collect()}
    return [f for f in listed if f["file"].rsplit("/", 1)[-1] in held], len(may)


def _replace_files(last: Snapshot, table: str, touched: list[dict], new: list[dict], read: int) -> Updated:
    gone = {f["file"] for f in touched}
    rest = [f for f in last.files if not (f["table"] == table and (f["file"] in gone or f["file"] is None))]
    fresh = [f for f in new if f["file"] or not any(r["table"] == table for r in rest)]
    kept = sum(f["table"] == table for f in rest)
    return Updated(_commit(last.spark, last.path, last, rest + fresh), read, len(touched), kept)


def _part(last: Snapshot, table: str, files: list[dict]) -> DataFrame:
    schema = last.read(table).schema
    if not files:
        return last.spark.createDataFrame([], schema)
    return last.spark.read.schema(schema).parquet(*[f"{last.path}/{f['file']}" for f in files])


@dataclass(frozen=True)
class Part:
    """Those files of a published table that hold given keys, with all their rows."""

    df: DataFrame
    files: list
    searched: int


def files_with(last: Snapshot, table: str, key: str, keys: Stored) -> Part:
    """The files of a table that hold a key of `keys`."""
    touched, searched = _touched(last, table, key, keys)
    return Part(_part(last, table, touched), touched, searched)


def replace_parts(
    last: Snapshot, key: str, parts: dict[str, tuple[Part, DataFrame]], added: dict[str, DataFrame], then: dict[str, str] | None = None
) -> Updated:
    """The next version of several tables at once: new rows in place of a part of each, and rows `added` to others.

    Files of a table are sorted by `key`, and by the column `then` names for it.
    """
    files, kept = list(last.files), 0
    for table, (part, rows) in parts.items():
        gone = {f["file"] for f in part.files}
        rest = [f for f in files if f["table"] == table and f["file"] and f["file"] not in gone]
        new = _write_files(rows, last.path, table, key, then=(then or {}).get(table))
        files = [f for f in files if f["table"] != table] + rest + [f for f in new if f["file"] or not rest]
        kept += len(rest)
    for table, rows in added.items():
        files = [f for f in files if f["table"] != table or f["file"]] + _write_files(rows, last.path, table, None)
    used = [part for part, _ in parts.values()]
    return Updated(_commit(last.spark, last.path, last, files), sum(p.searched for p in used), sum(len(p.files) for p in used), kept)


def upsert_files(
    spark: SparkSession,
    path: str,
    table: str,
    batch: DataFrame,
    key: str,
    update_cols: list[str],
    order: str = "_row",
    defaults: dict[str, object] | None = None,
) -> Updated:
    """`operators.merge.upsert` on a published table: only files that hold a key of the batch are written again.

    The result is the next version; rows of new keys come in files of their own beside the rewritten ones.
    """
    last = open_snapshot(spark, path)
    kinds = {f.name: f.dataType for f in last.read(table).schema.fields}
    batch = store(batch.withColumns({c: F.col(c).cast(kinds[c]) for c in batch.columns if c in kinds}), "batch").df
    keys = store(reduce_batch(batch, key, update_cols, order).select(key), "batch-keys")
    touched, read = _touched(last, table, key, keys)
    merged = upsert(_part(last, table, touched), batch, key, update_cols, order, defaults)
    return _replace_files(last, table, touched, _write_files(merged, last.path, table, key), read)


def update_files(spark: SparkSession, path: str, table: str, source: DataFrame, key: str, updates: dict[str, Column]) -> Updated:
    """`operators.joins.update_matched` on a published table, by its files; `source` holds each key once, under the same name."""
    last = open_snapshot(spark, path)
    fresh = store(source.select(key, *[c.alias(f"_new_{n}") for n, c in updates.items()]), "updates")
    touched, read = _touched(last, table, key, fresh)
    if not touched:
        return Updated(last, read, 0, len(last.files_of(table)))
    part = _part(last, table, touched)
    values = {f"_new_{n}": F.col(f"_new_{n}") for n in updates}
    joined = lookup_join(part, fresh, join_key(key), join_key(key), values, matched="_found")
    changed = joined.select(
        *[F.when(F.col("_found"), F.col(f"_new_{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in updates else F.col(f.name)
          for f in part.schema.fields]
    )
    return _replace_files(last, table, touched, _write_files(changed, last.path, table, key), read)


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Forget all but the newest `keep` versions: manifests first, then the files that no version names; returns what went.

    Run it while nothing is being published: files of an unfinished refresh are unnamed too, and go.
    """
    path = path.rstrip("/")
    there = versions(spark, path)
    left = there[max(len(there) - keep, 0) :]
    gone = sorted(set(_folders(spark, path)) - set(left))
    for version in gone:
        where, files = _place(spark, _version_folder(path, version))
        files.delete(where, True)
    named = {tuple(f["file"].split("/")[1:]) for v in left for f in open_snapshot(spark, path, v).files if f["file"]}
    where, files = _place(spark, f"{path}/data")
    for status in files.listStatus(where) if files.exists(where) else []:
        folder = status.getPath()
        if folder.getName() not in {f for f, _ in named}:
            files.delete(folder, True)
            continue
        for file in files.listStatus(folder):
            name = file.getPath().getName()
            if name.endswith(".parquet") and (folder.getName(), name) not in named:
                files.delete(file.getPath(), False)
    return gone


def append_files(spark: SparkSession, path: str, table: str, rows: DataFrame, key: str | None = None) -> Snapshot:
    """The next version with rows added to a table (or with a new table); no file that is there is written again."""
    path = path.rstrip("/")
    last = open_snapshot(spark, path)
    files = list(last.files) if last else []
    listed = [f for f in files if f["table"] == table]
    if listed:
        key = listed[0]["key"]
        rows = rows.to(T.StructType.fromJson(json.loads(listed[0]["schema"])))
    new = _write_files(rows, path, table, key)
    if listed and not new[0]["file"]:
        return last
    return _commit(spark, path, last, [f for f in files if f["table"] != table or f["file"]] + new)
