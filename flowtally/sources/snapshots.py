"""Publication that can be repeated and is all or nothing.

A published folder holds

    data/<run>/<table>/...        files of one run, under a name that no other run takes
    manifests/<version>.json      one manifest for each finished run

A run writes all its tables, reads them back to describe every file (rows and a checksum of
their values), and then moves its manifest into place under the next version. That move is
the only switch: before it readers see the version before, after it they see all new tables.
A run that breaks leaves files that no manifest names; `expire` removes them. Of two runs at
once, the later one finds its version taken and takes the next, so both are kept, in order.

Readers open exactly the files that the manifest lists, under the schema that it states, so
CSV tables come back typed. Only file names and one small row per file reach the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import quoted
from ..session import remove_folder

#: Settings of CSV tables: quotes are doubled, as most readers expect, and blanks stay.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: NULL is written as nothing and an empty text as two quotes; a mark that no text holds tells them apart.
CSV_READ = CSV | {"multiLine": True, "nullValue": "\0", "emptyValue": ""}
FILE_BYTES = 1 << 28
_NO_ROWS = {"rows": 0, "checksum": None}


@dataclass(frozen=True)
class Manifest:
    """One published version: table -> {form, schema, folder, by, rows, files}."""

    version: int
    run: str
    tables: Mapping[str, dict]


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    store, path = _store(spark, folder), _path(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(path)) if store.exists(path) else []


def _move(spark: SparkSession, source: str, target: str, replace: bool = False) -> bool:
    """Rename in one step; False where the target is there already and shall not be replaced."""
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE if replace else kinds.NONE
    path = _path(spark, target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    if not replace and _store(spark, target).exists(path):
        return False
    try:
        context.rename(_path(spark, source), path, how)
    except Exception as error:  # another run was faster
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Published versions, oldest first."""
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{folder}/manifests") if n.endswith(".json") and not n.startswith(".")]


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> Manifest:
    """What a version holds; by default the current one."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"nothing published below {folder}" if not known else f"no version {version} below {folder}")
    number = known[-1] if version is None else version
    text = spark.read.option("wholetext", True).text(f"{folder}/manifests/{number:020d}.json").first()[0]
    return Manifest(**json.loads(text))


def _loaded(spark: SparkSession, entry: Mapping, base: str, files: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    reader = spark.read.schema(schema).format(entry["form"])
    if entry["form"] == "csv":
        reader = reader.options(**CSV_READ)
    if not files:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", base).load([f"{base}/{f}" for f in files]).select(*[quoted(c) for c in schema.names])


def _checksum(names: Sequence[str]) -> Column:
    """Sum of row hashes: the same for the same rows in any order."""
    return F.sum(F.xxhash64(*[quoted(c) for c in names]).cast("decimal(38,0)")).cast("string")


def _described(df: DataFrame, place: str) -> dict[str, dict]:
    """Rows and checksum of every file that a table is read from, by its path below `place`."""
    names = df.columns
    by_file = df.withColumn("__file", F.col("_metadata.file_path")).groupBy("__file")
    found = by_file.agg(F.count(F.lit(1)).alias("rows"), _checksum(names).alias("checksum")).collect()
    return {unquote(r["__file"]).rpartition(f"{place}/")[2]: {"rows": r["rows"], "checksum": r["checksum"]} for r in found}


def _files(spark: SparkSession, base: str) -> list[str]:
    """Data files below a folder, in the order of their names."""
    store, found = _store(spark, base), []
    listed = store.listFiles(_path(spark, base), True)
    root = _path(spark, base).toUri().getPath().rstrip("/")
    while listed.hasNext():
        path = listed.next().getPath().toUri().getPath().removeprefix(root + "/")
        if not any(part.startswith(("_", ".")) for part in path.split("/")):
            found.append(path)
    return sorted(found)


def _entry(spark: SparkSession, df: DataFrame, folder: str, place: str, form: str, by: Sequence[str]) -> dict:
    base = f"{folder}/{place}"
    writer = df.write.partitionBy(*by) if by else df.write
    (writer.options(**CSV) if form == "csv" else writer).format(form).save(base)
    # columns that name folders come last when a table is read
    fields = [f for f in df.schema.fields if f.name not in by] + [df.schema[c] for c in by]
    schema = json.loads(T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json())
    entry = {"form": form, "schema": schema, "folder": place, "by": list(by)}
    names = _files(spark, base)
    found = _described(_loaded(spark, entry, base, names), place) if names else {}
    files = [{"file": f, **found.get(f, _NO_ROWS)} for f in names]
    return entry | {"rows": sum(f["rows"] for f in files), "files": files}


def publish_tables(
    spark: SparkSession,
    folder: str,
    tables: Mapping[str, DataFrame],
    form: str = "parquet",
    by: Mapping[str, Sequence[str]] | None = None,
    carried: Mapping[str, dict] | None = None,
) -> Manifest:
    """Write all tables as the next version. Readers see all of them or none.

    `by` lays single tables out in folders. `carried` holds entries of an earlier manifest:
    the new version lists their files again, and nothing is copied. Where the run fails,
    what it wrote is removed if that is still possible, and the version before stays current.
    """
    odd = [n for n in tables if not n or n[0] in "_." or set(n) & set("/:=")]
    if odd:
        raise ValueError(f"names of tables become names of folders: {odd}")
    run = uuid.uuid4().hex
    try:
        entries = {
            name: _entry(spark, df, folder, f"data/{run}/{name}", form, (by or {}).get(name, ())) for name, df in tables.items()
        }
        return _switched(spark, folder, run, dict(carried or {}) | entries)
    except BaseException:
        remove_folder(spark, f"{folder}/data/{run}")
        raise


def _switched(spark: SparkSession, folder: str, run: str, entries: Mapping[str, dict]) -> Manifest:
    while True:
        done = Manifest((versions(spark, folder) or [0])[-1] + 1, run, entries)
        draft = f"{folder}/manifests/.{run}"
        stream = _store(spark, folder).create(_path(spark, draft), True)
        try:
            stream.write(bytearray(json.dumps(done.__dict__, ensure_ascii=False).encode()))
        finally:
            stream.close()
        if _move(spark, draft, f"{folder}/manifests/{done.version:020d}.json"):
            return done


def read_table(spark: SparkSession, folder: str, name: str, version: int | None = None, checked: bool = False) -> DataFrame:
    """A published table by its manifest; `checked` compares every file with it first."""
    found = manifest(spark, folder, version)
    if name not in found.tables:
        raise KeyError(f"version {found.version} has no table {name}")
    if checked:
        bad = damaged(spark, folder, name, found.version).collect()
        if bad:
            raise ValueError(f"{name} differs from its manifest: {[r['file'] for r in bad]}")
    entry = found.tables[name]
    return _loaded(spark, entry, f"{folder}/{entry['folder']}", [f["file"] for f in entry["files"]])


def read_tables(spark: SparkSession, folder: str, names: Sequence[str], version: int | None = None) -> DataFrame:
    """Tables of one schema and form under one another, in a single scan of all their files."""
    entries = [manifest(spark, folder, version).tables[n] for n in names]
    if len({json.dumps([e["form"], e["schema"], e["by"]]) for e in entries}) != 1:
        raise ValueError("the tables differ in schema, form or layout")
    return _loaded(spark, entries[0], folder, [f"{e['folder']}/{f['file']}" for e in entries for f in e["files"]])


def damaged(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    """file, listed_rows, found_rows: files whose rows or values are not those of the manifest, or that are gone."""
    entry = manifest(spark, folder, version).tables[name]
    base = f"{folder}/{entry['folder']}"
    there = set(_files(spark, base)) if _store(spark, base).exists(_path(spark, base)) else set()
    listed = sorted(there & {f["file"] for f in entry["files"]})
    found = _described(_loaded(spark, entry, base, listed), entry["folder"]) if listed else {}
    rows = []
    for f in entry["files"]:
        got = found.get(f["file"], _NO_ROWS)
        if f["file"] not in there or got != {"rows": f["rows"], "checksum": f["checksum"]}:
            rows.append((f["file"], f["rows"], got["rows"] if f["file"] in there else None))
    return spark.createDataFrame(rows, "file string, listed_rows long, found_rows long")


def export_file(spark: SparkSession, folder: str, name: str, target: str, version: int | None = None, most_bytes: int = FILE_BYTES) -> str:
    """One CSV file of a small published table, for readers that take no folders; its rows in the order of the table.

    One task puts the files together and no row passes the driver; a table with more than
    `most_bytes` in its files is an error. The file appears, or replaces the one before, in
    one step.
    """
    found = manifest(spark, folder, version)
    entry, store = found.tables[name], _store(spark, folder)
    base = f"{folder}/{entry['folder']}"
    size = sum(store.getFileStatus(_path(spark, f"{base}/{f['file']}")).getLen() for f in entry["files"])
    if size > most_bytes:
        raise ValueError(f"{name} has {size} bytes, too many for one file")
    rows = read_table(spark, folder, name, found.version)
    if entry["files"]:
        place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row")]
        order = ["__file", "__block", "__row"]
        rows = rows.select("*", *place).coalesce(1).sortWithinPartitions(*order).drop(*order)
    draft = f"{target.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        rows.write.options(**CSV).csv(draft)
        parts = _files(spark, draft)
        if parts:
            _move(spark, f"{draft}/{parts[0]}", target, replace=True)
        else:  # a table without rows has no file
            stream = _store(spark, target).create(_path(spark, target), True)
            stream.write(bytearray((",".join(rows.columns) + "\n").encode()))
            stream.close()
    finally:
        remove_folder(spark, draft)
    return target


def catalog(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """cube, version, form, n_files, n_rows: what the manifest lists."""
    found = manifest(spark, folder, version)
    rows = [(name, found.version, e["form"], len(e["files"]), e["rows"]) for name, e in found.tables.items()]
    return spark.createDataFrame(rows, "cube string, version long, form string, n_files long, n_rows long")


def _runs(found: Manifest) -> set[str]:
    """Runs whose files a version lists."""
    return {found.run, *(e["folder"].split("/")[1] for e in found.tables.values())}


def expire(spark: SparkSession, folder: str, keep: int = 2, unfinished_hours: float = 24.0) -> list[int]:
    """Remove all but the last `keep` versions, and what broken runs left behind; returns the versions removed.

    Files that no manifest names may belong to a run under way, so they go only when they
    are older than `unfinished_hours`.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    known = versions(spark, folder)
    old, kept = known[:-keep], {run for v in known[-keep:] for run in _runs(manifest(spark, folder, v))}
    gone = {run for v in old for run in _runs(manifest(spark, folder, v))} - kept
    for v in old:  # no reader may find a manifest without its files
        remove_folder(spark, f"{folder}/manifests/{v:020d}.json")
    store = _store(spark, folder)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for kind in ("data", "manifests"):
        for name in _names(spark, f"{folder}/{kind}"):
            path = f"{folder}/{kind}/{name}"
            run = name.removeprefix(".")
            unnamed = run not in kept | gone if kind == "data" else name.startswith(".")
            late = now - store.getFileStatus(_path(spark, path)).getModificationTime() > unfinished_hours * 3_600_000
            if (kind == "data" and run in gone) or (unnamed and late):
                remove_folder(spark, path)
    return old
