"""Scan of CSV deliveries by header: columns are found by name, whatever their order.

1. The first record of every file is read, a few kilobytes at most, as Spark's own listing
   of the files already visits each of them. It is matched to the wanted columns by
   spelling, without regard to case, outer blanks and line breaks inside a name.
2. Files with the same matched order form a group, and each group is one scan with its own
   names. So the number of scans is that of different layouts, not of files.
3. Files whose header lacks a required column, names one twice or holds names that nobody
   has declared are not read by guess: all their lines go to quarantine with the reason.

Rows carry `src_file`, `src_block`, `src_row` as in `files.read_rows`.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import quoted
from ..operators.reshape import union_by_name
from .files import SOURCE, read_rows, text_schema

HEAD_BYTES = 1 << 16
_READERS = 16


@dataclass(frozen=True)
class Layout:
    """Names of a file's fields in order (None for a field left out), or why it is not read."""

    names: tuple[str | None, ...]
    reason: str | None = None


@dataclass(frozen=True)
class HeaderScan:
    rows: DataFrame
    quarantine: DataFrame  # src_file, src_block, src_row, line, reason


def plain(name: str) -> str:
    """A header name without case, byte order mark, outer blanks and line breaks."""
    return " ".join(name.replace("﻿", "").split()).casefold()


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Files that paths, folders and patterns stand for; hidden ones left out."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        matched = store.globStatus(at)
        if not matched:
            raise FileNotFoundError(path)
        for status in matched:
            if status.isFile():
                found.append(status.getPath().toString())
                continue
            inside, base = store.listFiles(status.getPath(), True), status.getPath().toString()
            while inside.hasNext():
                file = inside.next().getPath().toString()
                if not any(part.startswith(("_", ".")) for part in file.removeprefix(base).split("/")):
                    found.append(file)
    return sorted(set(found))


def read_header(spark: SparkSession, file: str, sep: str = ",") -> list[str] | None:
    """The first record of a file, which may be compressed; None for an empty one."""
    conf = spark._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = at.getFileSystem(conf).open(at)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    try:
        source = codec.createInputStream(stream) if codec is not None else stream
        head = bytes(source.readNBytes(HEAD_BYTES))
    finally:
        stream.close()
    if not head.strip():
        return None
    text = head.decode("utf-8", errors="replace").removeprefix("﻿")
    return next(csv.reader(io.StringIO(text, newline=""), delimiter=sep))


def layout(header: Sequence[str] | None, columns: Mapping[str, Sequence[str]], required: Sequence[str], ignore: Sequence[str]) -> Layout:
    """Match a header to {column: spellings}; a column's own name is one of its spellings."""
    if header is None:
        return Layout((), "no header")
    known = {plain(s): c for c, spellings in columns.items() for s in (c, *spellings)}
    left_out = {plain(s) for s in ignore}
    names = [known.get(plain(h)) for h in header]
    strange = [h for h, n in zip(header, names) if n is None and plain(h) not in left_out]
    if strange:
        return Layout((), "unknown columns: " + ", ".join(" ".join(h.split()) for h in strange))
    given = [n for n in names if n is not None]
    twice = sorted({n for n in given if given.count(n) > 1})
    if twice:
        return Layout((), "columns named twice: " + ", ".join(twice))
    missing = [c for c in required if c not in given]
    if missing:
        return Layout((), "missing columns: " + ", ".join(missing))
    return Layout(tuple(names))


def layouts(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, Sequence[str]],
    required: Sequence[str] | None = None,
    ignore: Sequence[str] = (),
    sep: str = ",",
) -> dict[Layout, list[str]]:
    """Files by layout; `required` is by default every column."""
    files = list_files(spark, paths)
    needed = list(columns) if required is None else list(required)
    with ThreadPoolExecutor(_READERS) as pool:
        headers = list(pool.map(lambda f: read_header(spark, f, sep), files))
    groups: dict[Layout, list[str]] = defaultdict(list)
    for file, header in zip(files, headers):
        groups[layout(header, columns, needed, ignore)].append(file)
    return dict(groups)


def scan_by_header(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, Sequence[str]],
    required: Sequence[str] | None = None,
    ignore: Sequence[str] = (),
    clean: bool = True,
    multi_line: bool = False,
) -> HeaderScan:
    """Rows of all files under the wanted names, as text, and the lines of files that do not fit.

    Columns that a file need not have (`required` names those it must) are NULL where they
    are missing. `ignore` lists spellings of columns that are left out on purpose.
    """
    groups = layouts(spark, paths, columns, required, ignore)
    tables, lines = [], []
    for found, files in groups.items():
        if found.reason is None:
            names = [n or f"__left_out_{k}" for k, n in enumerate(found.names)]
            rows = read_rows(spark, files, names, clean=clean, multi_line=multi_line)
            tables.append(rows.select(*[quoted(n) for n in found.names if n], *SOURCE))
        else:
            text = spark.read.option("lineSep", "\n").text(files)
            lines.append(
                text.select(
                    F.col("_metadata.file_path").alias("src_file"),
                    F.col("_metadata.file_block_start").alias("src_block"),
                    F.monotonically_increasing_id().alias("src_row"),
                    F.rtrim(F.col("value"), F.lit("\r")).alias("line"),
                    F.lit(found.reason).alias("reason"),
                )
            )
    places = [T.StructField("src_file", T.StringType()), T.StructField("src_block", T.LongType()), T.StructField("src_row", T.LongType())]
    wanted = T.StructType([*text_schema(list(columns)), *places])
    rows = union_by_name(spark.createDataFrame([], wanted), *tables).select(*[quoted(c) for c in columns], *SOURCE)
    kept = T.StructType([*places, *text_schema(["line", "reason"])])
    return HeaderScan(rows, union_by_name(spark.createDataFrame([], kept), *lines))
