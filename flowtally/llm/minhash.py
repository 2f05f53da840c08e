"""MinHash document fingerprints, and near duplicates by bands of signatures.

A text is lower-cased (A-Z) and cut into words; each run of five words is a shingle,
hashed by a rolling polynomial over its bytes and a mixing step. A signature holds, for
each of 64 multiply-add-shift hash functions, the least value over the shingles; all of it
is numpy. The share of equal places in two signatures estimates the Jaccard likeness of
the shingle sets.

Near duplicates: signatures are cut into bands, equal bands are joined in Spark, and the
Jaccard likeness of the shingle sets themselves is verified. Equal sets are grouped first.
A band that many sets share is not expanded into all pairs: each member is verified against
one of them. Members of bands that still hold several unconnected parts are then paired only
if they can reach the likeness asked for: sets of sizes in that ratio which share one of the
rarest shingles of both, as two sets must that are alike enough. No pair is lost by it.

Defined results: NULL counts as empty; texts without words have one common signature and
are like one another only; fewer than five words form one shingle; repeated rows each
give a row; rows are ordered by id, then text, those without id first; an empty table
gives an empty one; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtally.session import staged

from .common import above, column, shuffle_partitions
from .components import components

SHINGLE = 5
PERMUTATIONS = 64
_ODD = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BLOCK = 2048
_BYTES = 1 << 18
_PAIRS = 512


@lru_cache(maxsize=None)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    inverse = pow(_ODD, -1, 1 << 64)
    up, down = np.full(_BYTES, _ODD, np.uint64), np.full(_BYTES, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(joined: bytes, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words of single-spaced text of at most _BYTES bytes."""
    raw = np.frombuffer(joined, np.uint8)
    spaces = np.flatnonzero(raw == 32)
    starts, ends = np.r_[0, spaces + 1], np.r_[spaces, len(raw)]
    up, down = _powers()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)])
    last = ends[min(width, len(starts)) - 1 :]
    first = starts[: len(last)]
    return _mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the word shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(joined) <= _BYTES:
        return _hashed(joined, width)
    found, at = [], 0
    while at == 0 or at + width <= len(words):  # long texts by pieces that overlap by width - 1 words
        end, size = at, 0
        while end < len(words) and (size + len(words[end]) + 1 <= _BYTES or end - at < width):
            size += len(words[end]) + 1
            end += 1
        piece = b" ".join(words[at:end])
        found.append(_hashed(piece, width) if len(piece) <= _BYTES else _digested(words[at:end], width))
        at = max(at + 1, end - width + 1)
        if end == len(words):
            break
    return np.concatenate(found)


def _digested(words: list[bytes], width: int) -> np.ndarray:
    """For runs that are longer than a piece: their digest in place of the polynomial."""
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    return np.array([int.from_bytes(hashlib.sha256(r).digest()[:8], "little") for r in runs], np.uint64)


@lru_cache(maxsize=None)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(1).integers(0, 1 << 64, (2, count, 1), np.uint64)
    return made[0] | np.uint64(1), made[1]


def signature(text: bytes, count: int = PERMUTATIONS, width: int = SHINGLE) -> np.ndarray:
    """uint32 least values of `count` hash functions; all ones for a text without words."""
    return signature_of(shingles(text, width), count)


def signature_of(hashes: np.ndarray, count: int = PERMUTATIONS) -> np.ndarray:
    least = np.full(count, np.uint64((1 << 64) - 1))
    times, plus = _functions(count)
    for at in range(0, len(hashes), _BLOCK):
        least = np.minimum(least, (hashes[at : at + _BLOCK] * times + plus).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / len(a)


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of `following`."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def beside_next(docs: DataFrame, id_column: str, text_column: str, buckets: int) -> DataFrame:
    """Rows dealt so that each row's successor by id is in its task: one shuffle of the texts.

    Columns __bucket, guard, key, doc_id, text. Ids are cut into ranges at their quantiles.
    The first row of each range is dealt twice: to its own and, as a guard, to the end of
    the range before (the last range, for the first).
    """
    key = F.coalesce(column(id_column).cast("long"), F.lit(-(1 << 63)).cast("long"))
    rows = docs.select(key.alias("key"), column(id_column).cast("long").alias("doc_id"), F.coalesce(column(text_column), F.lit("")).alias("text"))
    steps = [i / buckets for i in range(1, buckets)] or [0.5]
    bounds = rows.agg(F.percentile_approx("key", steps, 100 * buckets)).first()[0] or []
    bounds = sorted(set(bounds))
    rows = rows.withColumn("__bucket", above(bounds, F.col("key")))
    heads = sorted(tuple(r) for r in rows.groupBy("__bucket").agg(F.min("key")).collect())  # one row per range
    first = [None] * (len(bounds) + 1)
    before = [0] * (len(bounds) + 1)
    for i, (bucket, least) in enumerate(heads):
        first[bucket], before[bucket] = least, heads[i - 1][0]
    least = F.element_at(F.array(*[F.lit(x).cast("long") for x in first]), F.col("__bucket") + 1)
    previous = F.element_at(F.array(*[F.lit(x) for x in before]), F.col("__bucket") + 1)
    own = F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("g"))
    guard = F.struct(previous.alias("b"), F.lit(True).alias("g"))
    places = F.explode(F.when(F.col("key") == least, F.array(own, guard)).otherwise(F.array(own)))
    dealt = rows.select("key", "doc_id", "text", places.alias("p")).select(
        F.col("p.b").alias("__bucket"), F.col("p.g").alias("guard"), "key", "doc_id", "text"
    )
    parts = shuffle_partitions(docs.sparkSession)
    return dealt.repartition(parts, "__bucket").sortWithinPartitions("__bucket", "guard", "key", "text")


def fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    count: int = PERMUTATIONS,
    width: int = SHINGLE,
    buckets: int | None = None,
) -> DataFrame:
    """Fingerprint of every text and of its edited text, with likenesses.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (8 hex digits
    per hash function), near_edited, near_next. The edited text takes its end from the next
    document by id, the last one from the first.
    """
    dealt = beside_next(docs, id_column, text_column, buckets or 4 * shuffle_partitions(docs.sparkSession))

    def results(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, done = None, [], False  # held: the row whose successor comes next
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for bucket, guard, doc_id, text in zip(*[part.column(i).to_pylist() for i in (0, 1, 3, 4)]):
                    if held is None or held[0] != bucket:
                        done = False
                    if done:
                        continue
                    own = signature(text.encode(), count, width)
                    if held is not None and held[0] == bucket:
                        _, before_id, before_text, before = held
                        made = edited(before_text, text)
                        raw = made.encode()
                        other = signature(raw, count, width)
                        rows.append(
                            (before_id, len(before_text), hashlib.sha256(raw).hexdigest(), _hex(before), _hex(other),
                             likeness(before, other), likeness(before, own))
                        )
                    held, done = (bucket, doc_id, text, own), guard
                    if len(rows) >= 1000:
                        yield results(rows)
                        rows = []
        if rows:
            yield results(rows)

    return dealt.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def _hex(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def _node(hashes: np.ndarray) -> int:
    """Signed digest of a set of shingle hashes, the same for equal sets."""
    return int(np.bitwise_xor.reduce(_mixed(np.unique(hashes))).astype(np.uint64).view(np.int64))


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The distinct pairs (a, b) whose shingle sets have a Jaccard likeness of `least`.

    A set that many pairs name as b is repeated once per `_PAIRS` of them, so that no task
    gets all pairs of one set.
    """
    copies = pairs.groupBy(F.col("b").alias("of")).agg(F.ceil(F.count(F.lit(1)) / _PAIRS).cast("int").alias("copies"))
    copies = staged(copies, "copies")
    salted = pairs.join(copies, F.col("b") == F.col("of")).select("a", "b", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int").alias("salt"))
    right = copies.join(sets, F.col("of") == F.col("node")).select(
        "of", F.col("set").alias("right"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("s")
    )
    left = salted.join(sets, F.col("a") == F.col("node")).select("a", "b", "salt", F.col("set").alias("left"))
    both = left.join(right, (F.col("b") == F.col("of")) & (F.col("salt") == F.col("s"))).select("a", "b", "left", "right")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [[np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3)]
            near = [jaccard(x, y) >= least for x, y in zip(*views)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    return staged(both.mapInArrow(verify, "a long, b long"), "alike")


def _rare_pairs(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): sets of different parts that share one of their rarest shingles and do not differ too much in size.

    members: distinct (node, part). Two sets of likeness `least` share at least that share of
    either one's shingles, so of each the rarest ones, one more than may be missing, suffice.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                listed = [np.frombuffer(x, np.uint64).view(np.int64) for x in part.column(2).to_pylist()]
                sizes = np.array([len(x) for x in listed], np.int64)
                each = pa.array(np.repeat(np.arange(len(listed)), sizes))
                arrays = [part.column(0).take(each), part.column(1).take(each), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(listed))]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "part", "size", "shingle"])

    found = members.join(sets.withColumnRenamed("node", "of"), F.col("node") == F.col("of")).select("node", "part", "set")
    each = staged(found.mapInArrow(cut, "node long, part long, size long, shingle long"), "shingles")
    times = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1").withColumnRenamed("shingle", "s")
    counted = each.join(times, F.col("shingle") == F.col("s"), "left").select("node", "part", "size", "shingle", F.coalesce("times", F.lit(1)).alias("times"))
    rarest = Window.partitionBy("node").orderBy("times", "shingle")  # one text's shingles
    enough = F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1
    first = counted.withColumn("at", F.row_number().over(rarest)).where((F.col("at") <= enough) & (F.col("times") > 1))
    first = staged(first.select("node", "part", "size", "shingle"), "rarest")
    other = first.select(F.col("node").alias("b"), F.col("part").alias("p"), F.col("size").alias("z"), F.col("shingle").alias("s"))
    near = F.least("size", "z") >= F.greatest("size", "z") * (least - 1e-9)
    pairs = first.join(other, (F.col("shingle") == F.col("s")) & (F.col("part") < F.col("p")) & near)
    return pairs.select(F.col("node").alias("a"), "b").distinct()


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = 0.8,
    bands: int = 16,
    count: int = PERMUTATIONS,
    width: int = SHINGLE,
) -> DataFrame:
    """One row per input row: doc_id, component_id (smallest id reachable over links).

    Texts whose shingle sets have a Jaccard likeness of `least` are linked, if they share a
    band of signatures: with 16 bands of 4 values this misses a pair at 0.8 with a chance
    of 2e-4. Texts of equal shingle sets count as one. Shingles travel only for texts that
    share a band with another set.
    """
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), F.coalesce(column(text_column), F.lit("")).cast("binary").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes = [shingles(t, width) for t in part.column(1).to_pylist()]
                made = [signature_of(h, count).tobytes() for h in hashes]
                arrays = [part.column(0), pa.array([_node(h) for h in hashes], pa.int64()), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "node", "signature"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                nodes = [_node(shingles(t, width)) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), part.column(0)], ["node", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [np.unique(shingles(t, width)).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], ["node", "set"])

    placed = staged(rows.mapInArrow(sign, "doc_id long, node long, signature binary"), "signatures")
    nodes = staged(placed.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("signature").alias("signature")), "nodes")
    rows_per_band = 4 * (count // bands)
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", 1 + b * rows_per_band, rows_per_band)) for b in range(bands)])
    banded = nodes.select("node", F.explode(keys).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).where("n > 1")
    banded = staged(banded.join(shared.select(F.col("key").alias("k"), "centre"), F.col("key") == F.col("k")).select("key", "node", "centre"), "bands")
    wanted = banded.select(F.col("node").alias("w")).distinct()
    texts = rows.select("text").mapInArrow(name, "node long, text binary").join(wanted, F.col("node") == F.col("w"), "left_semi")
    sets = staged(texts.groupBy("node").agg(F.min("text").alias("text")).mapInArrow(cut, "node long, set binary"), "sets")

    # every member of a band beside one of them; then, between what is not yet linked, pairs that can be alike
    stars = staged(banded.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    links = _alike(stars, sets, least)
    roots = staged(components(links), "roots").withColumnRenamed("node", "linked")
    parted = banded.join(roots, F.col("node") == F.col("linked"), "left").select("key", "node", F.coalesce("root", "node").alias("part"))
    parted = staged(parted, "parted")
    mixed = parted.groupBy(F.col("key").alias("k")).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    members = parted.join(mixed, F.col("key") == F.col("k"), "left_semi").select("node", "part").distinct()
    links = links.union(_alike(staged(_rare_pairs(members, sets, least), "pairs"), sets, least))

    roots = components(links)
    named = nodes.select("node", "first").join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    named = named.select("node", "first", F.coalesce("root", "node").alias("root"))
    least_ids = named.groupBy("root").agg(F.min("first").alias("component_id")).select(F.col("root").alias("r"), "component_id")
    final = staged(named.join(least_ids, F.col("root") == F.col("r")).select(F.col("node").alias("n"), "component_id"), "near-groups")
    return placed.join(final, F.col("node") == F.col("n")).select("doc_id", "component_id")


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that stay: those with the smallest id of their group, and those without id."""
    groups = near_groups(docs, id_column, text_column, **settings)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, column(id_column) == F.col("__gone"), "left_anti")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two sorted sets; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)
