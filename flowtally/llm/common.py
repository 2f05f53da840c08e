"""Column and id helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_bytes(name: str) -> Column:
    """UTF-8 bytes of a text column; NULL is empty."""
    return F.coalesce(column(name), F.lit("")).cast("binary")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a row without id belongs to fold 0."""
    return F.coalesce(F.crc32(column(id_column).cast("string").cast("binary")), F.lit(0)) % modulus


def hex64(c: Column) -> Column:
    """16 lowercase hex digits of a 64-bit integer."""
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def above(bounds: Sequence[int], value: Column) -> Column:
    """How many of the ascending `bounds` lie below `value`; NULL counts as below all.

    A fold over powers of two, so the cost grows with the logarithm of the list.
    """
    if not bounds:
        return F.lit(0)
    listed = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.try_element_at(listed, at + step) < value), at + step
        ).otherwise(at),
    )


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
