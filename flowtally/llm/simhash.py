"""SimHash fingerprints and near duplicates by multi-index hashing.

A fingerprint bit is the majority of the same bit over the hashes of a text's word
shingles. Two fingerprints are linked when at most `radius` bits differ. To find links
without comparing all pairs, a fingerprint is cut into segments. If two fingerprints
differ in at most r bits, then either one of the first (r mod m) + 1 of m segments
differs in at most floor(r / m) bits, or one of the others in at most that less one. So
each fingerprint enters one table per segment, and looks up, in each table, the small
Hamming ball around its own segment; whole distances are then verified. Nothing within
the radius can be missed.

Copies share a fingerprint, so they meet in a group-by before any search. A key of many
different fingerprints never gives all its pairs: a task verifies them in blocks and
emits only links that connect what is linked, at most one per fingerprint.

Defined results: a NULL or empty text, or one without words, has fingerprint zero and is
linked like any other; fewer words than a shingle give the whole sequence; repeated rows
each give a row; a row without id gets its group's smallest id, NULL where no row has
one; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import staged

from .common import column, hex64, shuffle_partitions, text_bytes
from .components import components, spanning_links

BITS = 64
BLOCK = 1 << 16


def shingle_hashes(text: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of `width` words, lower-cased A-Z, in blocks."""
    words = text.lower().split()
    if not words:
        return
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, BLOCK):
        spans = zip(starts[at : min(at + BLOCK, count)].tolist(), last[at : min(at + BLOCK, count)].tolist())
        yield np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64)


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """Signed 64-bit SimHash; a bit is 1 if set in over half the hashes."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, width, seed):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, __print (signed long) of every row."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width, seed) for t in texts], dtype="int64")

    return docs.select(column(id_column).cast("long").alias("doc_id"), simhash(text_bytes(text_column)).alias("__print"))


def segments(radius: int, parts: int) -> list[tuple[int, int, int]]:
    """(shift, bits, ball radius) of each segment; a ball of radius -1 is never looked up."""
    size, more = divmod(BITS, parts)
    out, shift = [], 0
    for i in range(parts):
        bits = size + (i < more)
        out.append((shift, bits, radius // parts - (i > radius % parts)))
        shift += bits
    return out


def ball(bits: int, radius: int) -> list[int]:
    """All values of `bits` bits with at most `radius` ones."""
    found = {0}
    for _ in range(radius):
        found |= {x | (1 << i) for x in found for i in range(bits)}
    return sorted(found)


def probes(prints: DataFrame, radius: int, parts: int) -> DataFrame:
    """(key, print, listed): each table entry (listed) and each look-up of a fingerprint."""
    rows = []
    for index, (shift, bits, reach) in enumerate(segments(radius, parts)):
        if reach < 0:
            continue
        value = F.shiftrightunsigned("__print", shift).bitwiseAND((1 << bits) - 1)
        for mask in ball(bits, reach):
            key = value.bitwiseXOR(F.lit(mask).cast("long")).bitwiseOR(F.lit(index << 58).cast("long"))
            rows.append(F.struct(key.alias("key"), F.lit(mask == 0).alias("listed")))
    return prints.select("__print", F.explode(F.array(*rows)).alias("__row")).select("__row.key", "__print", "__row.listed")


def _verified(keys: np.ndarray, prints: np.ndarray, listed: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among whole key groups, reduced to links that connect the same fingerprints."""
    order = np.argsort(keys, kind="stable")
    keys, prints, listed = keys[order], prints[order], listed[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    tables = np.add.reduceat(listed.astype(np.int64), first)
    use = (tables > 0) & (size > 1)
    first, size, tables = first[use], size[use], tables[use]
    lefts, rights = [], []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        near = (np.bitwise_count(a ^ b) <= radius) & (a != b)
        if near.any():
            lefts.append(a[near].view(np.int64))
            rights.append(b[near].view(np.int64))

    small = tables * size <= BLOCK
    # small groups together: every table entry beside every member of its group
    at, total = 0, np.cumsum((tables * size)[small])
    f, s = first[small], size[small]
    while at < len(f):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 4_000_000)))
        rows = np.repeat(f[at:end], s[at:end]) + _counting(s[at:end])
        entries = rows[listed[rows]]
        group = np.repeat(np.arange(end - at), s[at:end])[listed[rows]]
        repeat = s[at:end][group]
        other = np.repeat(f[at:end][group], repeat) + _counting(repeat)
        keep(prints[np.repeat(entries, repeat)], prints[other])
        at = end
    for start, count in zip(first[~small].tolist(), size[~small].tolist()):
        members = prints[start : start + count]
        for entry in members[listed[start : start + count]]:
            keep(np.full(count, entry), members)
        if sum(map(len, lefts)) > 4_000_000:
            a, b = spanning_links(np.concatenate(lefts), np.concatenate(rights))
            lefts, rights = [a], [b]
    if not lefts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return spanning_links(np.concatenate(lefts), np.concatenate(rights))


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given sizes."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def links(prints: DataFrame, radius: int = 4, parts: int = 3) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints within reach of one another.

    prints: distinct `__print`. Rows arrive sorted by key, so a task holds one batch and
    the key group at its end.
    """
    spark = prints.sparkSession
    dealt = probes(prints, radius, parts).repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            keys, prints, listed = (np.concatenate(x) for x in zip(*held))
            cut = len(keys) if whole else int(np.searchsorted(keys, keys[-1]))
            held[:] = [] if whole else [(keys[cut:], prints[cut:], listed[cut:])]
            if cut:
                a, b = _verified(keys[:cut], prints[:cut], listed[:cut], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                held.append((columns[0], columns[1].view(np.uint64), columns[2].astype(bool)))
                if sum(len(h[0]) for h in held) > 500_000 and held[0][0][0] != held[-1][0][-1]:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return dealt.mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 4,
    seed: int = 42,
    radius: int = 4,
    parts: int = 3,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links, the row's own included.
    """
    rows = staged(fingerprints(docs, id_column, text_column, width, seed), "prints")
    prints = rows.groupBy("__print").agg(F.min("doc_id").alias("__least"))
    roots = components(links(prints.select("__print"), radius, parts))
    # one entry per linked fingerprint: the smallest id of its whole component
    placed = prints.join(roots, F.col("__print") == F.col("node"), "left")
    placed = placed.select("__print", "__least", F.coalesce("root", "__print").alias("__root"))
    least = placed.groupBy("__root").agg(F.min("__least").alias("component_id"))
    named = placed.select(F.col("__print").alias("__p"), F.col("__root").alias("__r")).join(
        least, F.col("__r") == F.col("__root")
    )
    named = staged(named.select("__p", "component_id"), "components")
    return rows.join(named, F.col("__print") == F.col("__p")).select(
        "doc_id", hex64(F.col("__print")).alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that stay: those with the smallest id of their group.

    Rows that share the staying id are one document and all stay; a row without id cannot
    be named by a decision and stays.
    """
    groups = near_groups(docs, id_column, text_column, **settings)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, column(id_column) == F.col("__gone"), "left_anti")
