"""Exact duplicates by radix trees over whole texts.

Texts are dealt by length and content hash, so equal texts meet in one task whatever
their id, and different texts spread evenly. Each task inserts the full byte strings into
a compressed radix tree (`trie.PatriciaTrie`); a terminal node holds the group's size and
its owner, the row that stays. Since strings are compared byte by byte, a hash collision
cannot join two texts. Each task of the scan first merges its own rows the same way, so a
text that a third of all rows share reaches the shuffle once per task.

Defined results: a NULL text counts as empty and equals one; a NULL id is below every
other id; rows that repeat an id and a text are copies of one another; an empty table
gives an empty one. `text_owners` returns fixed columns; `without_copies` returns the
input's own columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, shuffle_partitions, text_bytes
from .trie import PatriciaTrie

BUDGET = 64 << 20
_NEVER = -(1 << 63)


def _merge(largest: bool) -> Callable[[Any, Any], Any]:
    """Values are (rows, id or None, tie, payload)."""

    def rank(v: tuple) -> tuple:
        return (_NEVER if v[1] is None else v[1], v[2])

    def merge(a: tuple, b: tuple) -> tuple:
        if (rank(b) > rank(a)) if largest else (rank(b) < rank(a)):
            return (a[0] + b[0], *b[1:])
        return (a[0] + b[0], *a[1:])

    return merge


def _combined(keyed: DataFrame, largest: bool, budget: int, whole: bool) -> DataFrame:
    """One row per text of each task.

    `whole` merges all texts of a task, with subtrees on disk beyond `budget` bytes; else
    the tree is emptied at that size, which is enough ahead of a shuffle.
    Columns: __length, __hash, __key, __rows, __id, __tie and the payload.
    """
    schema = keyed.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _merge(largest)
        trie = PatriciaTrie(merge, budget if whole else 1 << 62)
        types: list[pa.Field] | None = None

        def flush() -> Iterator[pa.RecordBatch]:
            rows, held = [], 0
            for key, (count, row_id, tie, payload) in trie.items():
                rows.append((*payload[:2], key, count, row_id, tie, *payload[2:]))
                held += len(key) + 64
                if held > (8 << 20):
                    yield _batch(rows, types)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, types)

        try:
            for batch in batches:
                types = types or list(batch.schema)
                for at in range(0, batch.num_rows, 256):
                    for row in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                        trie.add(row[2], (row[3], row[4], row[5], row[:2] + row[6:]))
                    if not whole and trie.size > budget:
                        yield from flush()
            yield from flush()
        finally:
            trie.close()

    return keyed.mapInArrow(run, schema)


def _batch(rows: list[tuple], types: list[pa.Field] | None) -> pa.RecordBatch:
    fields = types or []
    arrays = [pa.array(values, f.type) for values, f in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])


def _keyed(df: DataFrame, id_column: str, text_column: str, payload: list[str]) -> DataFrame:
    text = text_bytes(text_column)
    tie = F.xxhash64(*[column(c) for c in payload]) if payload else F.lit(0).cast("long")
    return df.select(
        F.length(text).cast("long").alias("__length"),
        F.xxhash64(text).alias("__hash"),
        text.alias("__key"),
        F.lit(1).cast("long").alias("__rows"),
        column(id_column).cast("long").alias("__id"),
        tie.alias("__tie"),
        *[column(c).alias(f"__{i}") for i, c in enumerate(payload)],
    )


def _owners(keyed: DataFrame, largest: bool, budget: int) -> DataFrame:
    local = _combined(keyed, largest, budget, whole=False)
    dealt = local.repartition(shuffle_partitions(keyed.sparkSession), "__length", "__hash")
    return _combined(dealt, largest, budget, whole=True)


def text_owners(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", largest: bool = False, budget: int = BUDGET
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The smallest id of equal texts stays, or with `largest` the largest. Rows that repeat
    the staying id and text are all marked as kept, as they cannot be told apart here.
    Only groups of two and more are joined back, by the digest of the text.
    """
    owners = _owners(_keyed(docs, id_column, text_column, []), largest, budget).where(F.col("__rows") > 1)
    shared = owners.select(
        F.sha2(F.col("__key"), 256).alias("__sha"), F.col("__id").alias("__keep"), F.col("__rows").alias("__size")
    )
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), F.sha2(text_bytes(text_column), 256).alias("text_sha256"))
    joined = rows.join(shared, F.col("text_sha256") == F.col("__sha"), "left")
    keep = F.when(F.col("__size").isNull(), F.col("doc_id")).otherwise(F.col("__keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def without_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", largest: bool = False, budget: int = BUDGET
) -> DataFrame:
    """The staying row of each text, with all columns of `docs`; exactly one row per text.

    Where rows repeat an id and a text, one of them stays, chosen by a hash of its columns.
    """
    names = docs.columns
    others = [c for c in names if c not in (text_column,)]
    marked = docs.withColumn("__no_text", column(text_column).isNull())
    payload = [*others, "__no_text"]
    kept = _owners(_keyed(marked, id_column, text_column, payload), largest, budget)
    at = {c: F.col(f"__{i}") for i, c in enumerate(payload)}
    text = F.when(~at["__no_text"], F.col("__key").cast("string"))
    types = dict(docs.dtypes)
    return kept.select(*[(text.cast(types[c]) if c == text_column else at[c]).alias(c) for c in names])


