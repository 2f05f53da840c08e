"""A mix of sources by target weights, in shards of fixed-length blocks.

1. The words of a source form one stream, document after document, cut into blocks of
   `length` words; the last one may be shorter. Only sizes and positions are moved.
2. Targets: all sources together get `share` of all words, by weight; none gets more than
   `copies` times its own size, and what it cannot take goes to the others by weight, until
   none is above. A source's slots are its target in blocks.
3. Each slot of an output shard draws a source with a probability equal to its share of all
   slots, so the source counts of a shard are multinomial. A slot's draw is a point on the
   line of all slots, on which each source owns a section; points and sections are sorted
   together, which finds the section without a table of all sources anywhere. Slots that
   a source draws beyond its own number go, in order, to sources that drew too few, so that
   the whole mix meets its targets to a block and no text is used too often.
4. A source's slots are numbered over all shards. A pseudorandom permutation of its block
   numbers (a Feistel network, another one for each round through the source) turns the
   number into a block, and blocks are joined by (source, number).

Nothing depends on the number of tasks: running numbers come from `ordered.running_total`,
which cuts hot sources into chunks, and all draws are hashes of numbers. Only five figures
about all sources reach the driver.

Defined results: a NULL or empty text has no words and is never taken; sources go by code
point, a missing one last, as a source of its own; documents with one id are told apart by
their texts, and equal rows take what falls to them in either order. NULL ids come first in
their source. An empty table gives an empty mix; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.operators.joins import join_on
from flowtally.operators.ordered import fill_down, number_rows, running_total
from flowtally.session import staged

from .common import column

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
COPIES = 2
LENGTH = 64
SHARD_SLOTS = 4096
SEED = 20
_ROUNDS = 4
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Mix:
    """Written tables of a mix.

    documents: row, doc_id, source, size, text_hash, number (of its source), start (in its source's stream)
    sources: number, source, source_size, weight, target, blocks, slots
    slots: shard, place (order inside the shard), number, round, block
    """

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    length: int


def sized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """row, doc_id, source, size in words and text_hash of every document, written once."""
    text = F.coalesce(column(text_column), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(id_column).cast("long").alias("doc_id"),
        column(source_column).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"),
    )
    return staged(rows, "sized")


def source_targets(documents: DataFrame, weights: Sequence[float], share: float, copies: int, length: int) -> DataFrame:
    """One row per source: number, source, source_size, weight, target, blocks, slots."""
    sums = documents.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.withColumn("missing", F.col("source").isNull().cast("int"))
    numbered = number_rows(staged(sums, "source-sizes"), "number", ["missing", "source"])
    place = (F.col("number") - 1) % len(weights)
    weight = F.element_at(F.lit([float(w) for w in weights]), (place + 1).cast("int"))
    numbered = staged(numbered.select("number", "source", "source_size", weight.alias("weight")), "source-numbers")

    most = F.col("source_size") * float(copies)
    total = share * (numbered.agg(F.sum("source_size")).first()[0] or 0)
    full, each = -1, 0.0
    while True:  # each round fills at least one more source
        over = most <= F.col("weight") * each
        row = numbered.agg(
            F.count_if(over).alias("full"), F.sum(F.when(over, most)).alias("taken"), F.sum(F.when(~over, F.col("weight"))).alias("rest")
        ).first()
        if row["full"] == full:
            break
        full = row["full"]
        if row["rest"] is None:
            break
        each = (total - (row["taken"] or 0.0)) / row["rest"]
    target = F.least(most, F.col("weight") * each)
    blocks = F.ceil(F.col("source_size") / length).cast("long")
    slots = F.when(F.col("source_size") > 0, F.round(target / F.col("source_size") * blocks)).otherwise(0).cast("long")
    return staged(numbered.select("*", target.alias("target"), blocks.alias("blocks"), slots.alias("slots")), "sources")


def drawn(sources: DataFrame, slots: int, shard_slots: int, seed: int) -> DataFrame:
    """shard, number, n: how often each shard draws each source."""
    sections = running_total(sources.where("slots > 0").select("number", "slots"), {"point": "slots"}, ["number"], before=True)
    sections = sections.select("point", F.lit(-1).cast("long").alias("slot"), "number")
    points = sources.sparkSession.range(slots).select(
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(slots)).alias("point"), F.col("id").alias("slot"), F.lit(None).cast("long").alias("number")
    )
    found = fill_down(points.union(sections), ["number"], ["point", "slot"]).where("slot >= 0")
    return found.groupBy(F.expr(f"slot div {shard_slots}").alias("shard"), "number").agg(F.count(F.lit(1)).alias("n"))


def settled(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """shard, number, first, n, blocks: sections of each source's slots; surplus draws go to sources that drew too few."""
    counts = staged(counts, "shard-counts")
    numbered = running_total(counts, {"first": "n"}, ["shard"], ["number"], before=True)
    numbered = join_on(numbered, sources.select("number", "slots", "blocks"), "number", null_safe=False)
    kept = F.greatest(F.lit(0).cast("long"), F.least("n", F.col("slots") - F.col("first")))
    numbered = staged(numbered.withColumn("kept", kept), "sections")
    surplus = numbered.where("n > kept").select("shard", "number", (F.col("n") - F.col("kept")).alias("more"))
    surplus = running_total(surplus, {"unit": "more"}, ["number", "shard"], before=True)
    units = surplus.select("shard", F.explode(F.expr("sequence(unit, unit + more - 1)")).alias("unit"))
    got = counts.groupBy("number").agg(F.sum("n").alias("got"))
    short = join_on(sources.select("number", "slots", "blocks"), got, "number", null_safe=False).withColumn("got", F.coalesce("got", F.lit(0)))
    short = short.where("slots > got").withColumn("more", F.col("slots") - F.col("got"))
    short = running_total(short, {"unit": "more"}, ["number"], before=True)
    wanted = short.select("number", "blocks", "got", F.posexplode(F.expr("sequence(unit, unit + more - 1)")).alias("k", "unit"))
    moved = units.join(wanted, "unit").select("shard", "number", (F.col("got") + F.col("k")).alias("first"), F.lit(1).cast("long").alias("n"), "blocks")
    return numbered.where("kept > 0").select("shard", "number", "first", F.col("kept").alias("n"), "blocks").union(moved)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(at: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places `at` of 0..size-1 under the permutation that belongs to `key`, element by element.

    A Feistel network over the next even number of bits; what falls outside goes through
    again, which leaves a permutation of the inside.
    """
    at, size, key = at.astype(np.uint64), size.astype(np.uint64), key.astype(np.uint64)
    bits = np.frexp(np.maximum(size.astype(np.int64) - 1, 1).astype(float))[1]
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, open_ = at.copy(), np.arange(len(at))
    while len(open_):
        h, m, k = half[open_], mask[open_], key[open_]
        left, right = out[open_] >> h, out[open_] & m
        for turn in range(_ROUNDS):
            left, right = right, left ^ (_mixed(right + _mixed(k + np.uint64(turn + 1))) & m)
        out[open_] = (left << h) | right
        open_ = open_[out[open_] >= size[open_]]
    return out.astype(np.int64)


_SLOTS = "shard long, place long, number long, round int, block long"


def placed(sections: DataFrame, seed: int) -> DataFrame:
    """One row per slot: which block of which source it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, number, first, n, blocks = (batch.column(k).to_numpy() for k in range(5))
            ends, low = np.cumsum(n), 0
            while low < len(n):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _CHUNK, "right")))
                part = slice(low, high)
                each = np.repeat(np.arange(low, high), n[part])
                t = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
                rounds, at = np.divmod(t, blocks[each])
                key = _mixed(_mixed(number[each].astype(np.uint64) + np.uint64(seed)) + rounds.astype(np.uint64))
                place = _mixed(key + t.astype(np.uint64)).astype(np.int64)
                columns = [shard[each], place, number[each], rounds.astype(np.int32), permuted(at, blocks[each], key)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "place", "number", "round", "block"])
                low = high

    return sections.select("shard", "number", "first", "n", "blocks").mapInArrow(run, _SLOTS)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    length: int = LENGTH,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
    **columns: str,
) -> Mix:
    """Draws the whole mix; `columns` name the id, text and source columns of the documents."""
    documents = sized(docs, **columns)
    sources = source_targets(documents, weights, share, copies, length)
    documents = join_on(documents, sources.select("source", "number"), "source")
    documents = running_total(documents, {"start": "size"}, ["doc_id", "text_hash", "row"], ["number"], before=True)
    total = sources.agg(F.sum("slots")).first()[0] or 0
    if total:
        slots = placed(settled(drawn(sources, total, shard_slots, seed), sources), seed)
    else:
        slots = docs.sparkSession.createDataFrame([], _SLOTS)
    return Mix(staged(documents, "positions"), sources, staged(slots, "slots"), length)


def pieces(mixed: Mix) -> DataFrame:
    """number, block, row, first, words: the part of each block that lies in each document."""
    n = mixed.length
    rows = mixed.documents.where("size > 0").select(
        "number", "row", "start", "size", F.explode(F.expr(f"sequence(start div {n}, (start + size - 1) div {n})")).alias("block")
    )
    low = F.greatest("start", F.col("block") * n)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * n)
    return rows.select("number", "block", "row", (low - F.col("start")).alias("first"), (high - low).alias("words"))


def spans(mixed: Mix) -> DataFrame:
    """shard, place, round, number, block, row, first, words: the mix, as spans of documents."""
    return mixed.slots.join(pieces(mixed), ["number", "block"])


def document_shares(mixed: Mix) -> DataFrame:
    """One row per document: its words, its source's words and target, and how many words the mix takes."""
    taken = spans(mixed).groupBy("row").agg(F.sum("words").alias("taken"))
    rows = join_on(mixed.documents, mixed.sources.select("number", "source_size", "target"), "number", null_safe=False)
    rows = join_on(rows, taken, "row", null_safe=False)
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def block_texts(mixed: Mix, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """shard, place, text: the blocks themselves, words joined by one space.

    Each text is split once, for all its spans.
    """
    known = mixed.documents.select("row", "doc_id", "text_hash")
    wanted = spans(mixed).groupBy("row").agg(F.collect_list(F.struct("shard", "place", "number", "block", "first", "words")).alias("spans"))
    wanted = wanted.join(known, "row")
    text = F.coalesce(column(text_column), F.lit(""))
    texts = docs.select(column(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = join_on(wanted, texts.dropDuplicates(["doc_id", "text_hash"]), ["doc_id", "text_hash"])
    found = found.withColumn("all", F.regexp_extract_all("text", F.lit(WORD), 0)).join(mixed.documents.select("row", "start"), "row")
    cut = F.transform(
        "spans",
        lambda s: F.struct(
            s["shard"].alias("shard"),
            s["place"].alias("place"),
            (F.col("start") + s["first"]).alias("at"),
            F.array_join(F.slice("all", s["first"].cast("int") + 1, s["words"].cast("int")), " ").alias("words"),
        ),
    )
    parts = found.select(F.inline(cut)).groupBy("shard", "place")
    ordered = parts.agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))
    return ordered.select("shard", "place", F.array_join("parts.words", " ").alias("text"))
