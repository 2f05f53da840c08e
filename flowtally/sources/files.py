"""Reading raw deliveries as text with their row order, and writing cubes.

Every field is read as text (bronze) and typed later with `try_cast`, so no value
is lost to a failed parse. Each row carries `src_file`, `src_block`, `src_row`:
the pair (src_block, src_row) rises through a file, also when it is read in
several splits. Both are taken at the scan, before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null, trimmed
from ..operators.columns import quoted
from ..operators.reshape import union_by_name

ROW_ORDER = ["src_block", "src_row"]
SOURCE = ["src_file", *ROW_ORDER]


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_rows(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    header: bool = True,
    overflow: str | None = None,
    clean: bool = True,
    quarantine: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan CSV text under the given column names, by position.

    Only a line feed ends a row: carriage returns inside quoted header names stay in
    their field, and files can still be read in splits. `overflow` names an extra
    column for a field beyond the header. Blank fields become NULL.

    Fields beyond these are lost without `quarantine`, which names a column that holds the
    whole line of a row with more or fewer fields than expected, NULL for all other rows.
    `multi_line` reads quoted fields that hold line feeds; such files are not split, and
    `lineSep` no longer applies.
    """
    fields = [*names, *([overflow] if overflow else [])]
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    reader = reader.option("multiLine", True) if multi_line else reader.option("lineSep", "\n")
    if quarantine:
        # a line is only seen to be too long where all its fields are parsed
        reader = reader.option("columnNameOfCorruptRecord", quarantine).option("columnPruning", False)
    raw = reader.schema(text_schema([*fields, *([quarantine] if quarantine else [])])).csv(path)
    values = [blank_to_null(trimmed(quoted(c))).alias(c) if clean else quoted(c) for c in fields]
    return raw.select(
        *values,
        *([quoted(quarantine)] if quarantine else []),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Scan a clean CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).csv(path)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; what does not fit becomes NULL."""
    return df.withColumns({c: quoted(c).try_cast(t) for c, t in types.items()})


def unfit_rows(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Quarantine: rows in which some text does not fit its declared type."""
    bad = F.lit(False)
    for c, t in types.items():
        bad = bad | (quoted(c).isNotNull() & quoted(c).try_cast(t).isNull())
    return df.where(bad)


def year_from_path(pattern: str = r"(?<!\d)((?:19|20)\d{2})(?!\d)[^/]*$") -> Column:
    """Delivery year written in a file's name, or where else the pattern's group finds it."""
    return F.regexp_extract(F.col("src_file"), pattern, 1).try_cast("int")


def sheet_for_year(years: Mapping[int, int]) -> Column:
    """Sheet index looked up by the `year` column."""
    table = F.create_map(*[F.lit(v).cast("int") for kv in years.items() for v in kv])
    return table[F.col("year")]


def read_sheets(
    spark: SparkSession,
    source: str | Sequence[tuple[str, int, int]],
    names: Sequence[str],
    sheets: Mapping[int, int] | None = None,
    clean: bool = True,
) -> DataFrame:
    """Multi-sheet workbooks stored as `sheet=<k>/` folders; only listed sheets are read.

    Either one workbook with `sheets`, {year: sheet}, or a list of (workbook, sheet, year).
    The year column comes from that list. Fields are cleaned as in `read_rows`, and rows
    carry `src_file`, `src_block`, `src_row` for keys and fill-down.
    """
    listed = [(source, sheet, year) for year, sheet in (sheets or {}).items()] if isinstance(source, str) else list(source)
    tables = []
    for folder in dict.fromkeys(f for f, _, _ in listed):
        years = {sheet: year for f, sheet, year in listed if f == folder}
        lookup = F.create_map(*[F.lit(v).cast("int") for pair in years.items() for v in pair])
        raw = spark.read.schema(text_schema(names).add("sheet", T.IntegerType())).option("header", True).csv(folder)
        raw = raw.where(F.col("sheet").isin(list(years)))
        values = [blank_to_null(trimmed(quoted(c))).alias(c) if clean else quoted(c) for c in names]
        tables.append(
            raw.select(
                *values,
                "sheet",
                lookup[F.col("sheet")].alias("year"),
                F.col("_metadata.file_path").alias("src_file"),
                F.col("_metadata.file_block_start").alias("src_block"),
                F.monotonically_increasing_id().alias("src_row"),
            )
        )
    return union_by_name(*tables)


def load_catalog(spark: SparkSession, folder: str, ending: str = ".csv", exclude: str = "_new") -> dict[str, DataFrame]:
    """Register every table of a folder as a temporary view under its file name.

    Published cubes (names holding `exclude`) are skipped. The header of each file is
    its schema, all text; only names are listed on the driver.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    out = {}
    for name in sorted(f.getPath().getName() for f in files):
        if name.endswith(ending) and exclude not in name:
            df = spark.read.option("header", True).csv(f"{folder}/{name}")
            view = name.removesuffix(ending)
            df.createOrReplaceTempView(view)
            out[view] = df
    return out


def write_cube(df: DataFrame, path: str, form: str = "parquet", by: Sequence[str] = ()) -> str:
    """Write a table as Parquet, or as CSV with a header line.

    `by` lays it out in folders, e.g. by year, so that readers open only those they need.
    """
    writer = df.write.partitionBy(*by) if by else df.write
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)
    return path


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
