"""Session set-up and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "flowtally") -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallback: dict[str, str] = {}


def staging_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all executors must share.

    Without that setting, a `local[...]` session takes a temporary folder, and any other
    master is an error: each of its executors would write to a disk of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="flowtally-")
    return _fallback[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{staging_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_written: list[list[str]] = []
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside drop their shuffle files when they end, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, label: str = "stage", release: bool = False) -> DataFrame:
    """Write a table once and go on from the written copy.

    Used where several results are drawn from one expensive table, or where row
    positions must not be worked out twice. The copy outlives lost executors; inside
    `staging` it is removed at the end. With `release` the shuffle files behind it go
    once it is written.
    """
    path = new_folder(df.sparkSession, label)
    with shuffles_removed(df.sparkSession) if release else nullcontext():
        df.write.parquet(path)
    if _written:
        _written[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


ROWS_PER_PARTITION = 200_000


def partitions_for(table: DataFrame) -> int:
    """Partitions for a shuffle of a stored table: as many as the session sets, more where they would hold too many rows.

    So memory of a task stays the same however large the table is. The rows of Parquet files
    are counted from their footers.
    """
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-table.count() // ROWS_PER_PARTITION))


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Removes the copies that were staged inside, for jobs that have written their results."""
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            remove_folder(spark, path)
