"""Alignment of two tokenizers by inverted bitmaps of token pairs.

Both tokenizers cut the same bytes. Where a token of each ends at the same byte, a group
ends; every token of A is linked to every token of B in its group. For a pair of ids, the
documents that hold it linked are kept as a compressed bitmap, and how often as bitmaps of
the binary digits of (occurrences - 1), the multiplicity planes.

1. A task encodes its texts and collects blocks of documents. A document has a number
   inside its block, below 65,536, and a block holds for each pair one container: the
   sorted numbers, two bytes each, or a bitmap, whichever is smaller. Containers of batches
   are OR-merged as a block grows; a block ends at `BLOCK_ENTRIES` entries. Blocks are
   written once to the shared folder, with the digests of their documents.
2. Containers of different blocks share no document, so the OR over all blocks has as many
   bits as its containers together: popcounts are summed by pair, links by planes. The
   largest count of each A id marks its best pairs.
3. Each block asks once for each of its pairs, and its postings return the scores: a pair's
   count goes to the documents of its container, times their multiplicity.

So texts are encoded once, and what is shuffled is one row per block and pair, some tens of
times fewer than links, besides the blocks themselves. No key can be hot: a pair occurs at
most once in a block, and an A id has at most as many pairs as B has ids.

The tokenizers' files are read on the driver and sent to tasks: fixed sizes.

Defined results: a text that is NULL or empty, or whose tokens do not give back a space and
the text (white space or signs that B rewrites), has no tokens: zeros and an empty digest.
Strings of special tokens are plain text. Ids may be NULL; repeated rows are documents of
their own, and both count. An empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import staged

from .common import byte_signs, column

BLOCK_DOCS = 1 << 16
BLOCK_ENTRIES = 2_000_000
BATCH_DOCS = 256
BATCH_BYTES = 1 << 20
_LARGE_GROUP = 1 << 14  # links of a group from which its ids are counted first


@dataclass(frozen=True)
class Definitions:
    """A: JSON of a byte-level BPE and the pattern that splits texts for it; B: a sentencepiece model."""

    byte_bpe: str
    pattern: str
    pieces: bytes


class Coders:
    """Both tokenizers, with the bytes and lengths of their tokens."""

    def __init__(self, definitions: Definitions):
        model = json.loads(definitions.byte_bpe)["model"]
        signs = byte_signs()
        ranks = {bytes(signs[s] for s in token): i for token, i in model["vocab"].items() if all(s in signs for s in token)}
        specials = {t["content"] for t in json.loads(definitions.byte_bpe).get("added_tokens", [])}
        ranks = {token: i for token, i in ranks.items() if token.decode(errors="replace") not in specials}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        order = [model["vocab"][m.replace(" ", "", 1)] for m in merges]
        if order != sorted(set(order)):
            raise ValueError("merges must go in the order of their ids")
        self.a = tiktoken.Encoding("aligned", pat_str=definitions.pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b = b = sentencepiece.SentencePieceProcessor(model_proto=definitions.pieces)
        pieces = range(b.get_piece_size())
        self.b_bytes = [
            bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in pieces
        ]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self.width = len(self.b_bytes)
        most = max(len(self.a_bytes), self.width)
        self.most = most
        self.spelled = [f"{i}{sign}" for sign in ",|;" for i in range(most)]

    def encode(self, texts: list[str]) -> tuple[list, list]:
        return [self.a.encode_ordinary(" " + t) for t in texts], self.b.encode(texts, num_threads=1)

    def whole(self, text: str, a: list[int], b: list[int]) -> bool:
        want = (" " + text).encode()
        return b"".join(map(self.b_bytes.__getitem__, b)) == want and b"".join(map(self.a_bytes.__getitem__, a)) == want


_coders: dict[int, tuple[Definitions, Coders]] = {}


def coders(definitions: Definitions) -> Coders:
    key = hash(definitions)
    if key not in _coders or _coders[key][0] != definitions:
        _coders.clear()
        _coders[key] = (definitions, Coders(definitions))
    return _coders[key][1]


@dataclass
class Aligned:
    """Some texts: numbers of their tokens, groups and links, digests, and linked pairs with their multiplicity."""

    sizes: np.ndarray  # (documents, 4): n_a, n_b, n_groups, n_links
    digests: list[str]
    codes: np.ndarray  # pair * BLOCK_DOCS + document, ascending
    times: np.ndarray


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order with the sum of their times."""
    if not len(codes):
        return codes, times
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(times, first)


def align(texts: list[str | None], c: Coders, first: int = 0) -> Aligned:
    """Groups and links of texts whose numbers inside their block start at `first`."""
    found_a, found_b = c.encode([t or "" for t in texts])
    kept = [k for k, t in enumerate(texts) if t and c.whole(t, found_a[k], found_b[k])]
    sizes, digests = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
    none = np.zeros(0, np.int64)
    if not kept:
        return Aligned(sizes, digests, none, none)
    docs = np.array(kept)
    n_a, n_b = (np.array([len(f[k]) for k in kept]) for f in (found_a, found_b))
    a, b = (np.fromiter(chain.from_iterable(f[k] for k in kept), np.int64, int(n.sum())) for f, n in ((found_a, n_a), (found_b, n_b)))
    end_a, end_b = np.cumsum(c.a_sizes[a]), np.cumsum(c.b_sizes[b])
    at_end = np.zeros(int(end_a[-1]) + 1, bool)
    at_end[end_a] = True
    common = end_b[at_end[end_b]]
    # the groups that end before a byte; texts end in both, so no group spans two of them
    at_end[:] = False
    at_end[common] = True
    before = np.cumsum(at_end)
    group_a, group_b = before[end_a - 1], before[end_b - 1]
    in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
    doc_a = np.repeat(docs, n_a)
    start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    doc_group = doc_a[start_a]
    sizes[docs, 0], sizes[docs, 1] = n_a, n_b
    sizes[:, 2] = np.bincount(doc_group, minlength=len(texts))
    links = in_a * in_b
    np.add.at(sizes[:, 3], doc_group, links)

    # digests: A's ids, then B's, group by group; the sign behind an id is part of its spelling
    sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    sign_a[start_a + in_a - 1], sign_b[start_b + in_b - 1] = 1, 2
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    spelled = np.concatenate([a + sign_a * c.most, b + sign_b * c.most])[order].tolist()
    low = 0
    for k, n in zip(kept, (n_a + n_b).tolist()):
        line = "".join(map(c.spelled.__getitem__, spelled[low : low + n]))
        digests[k] = hashlib.sha256(line[:-1].encode()).hexdigest()
        low += n

    # links of small groups one by one, of large ones by distinct ids
    large = np.flatnonzero(links > _LARGE_GROUP)
    each = in_b[group_a]
    each[np.isin(group_a, large)] = 0
    inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    pair = np.repeat(a * c.width, each) + b[np.repeat(start_b[group_a], each) + inside]
    codes = [pair * BLOCK_DOCS + np.repeat(doc_a + first, each)]
    times = [np.ones(len(pair), np.int64)]
    for g in large:
        ids_a, of_a = np.unique(a[start_a[g] : start_a[g] + in_a[g]], return_counts=True)
        ids_b, of_b = np.unique(b[start_b[g] : start_b[g] + in_b[g]], return_counts=True)
        for i, n in zip(ids_a, of_a):  # one row of pairs at a time, summed with its like below
            codes.append((i * c.width + ids_b) * BLOCK_DOCS + doc_group[g] + first)
            times.append(n * of_b)
    return Aligned(sizes, digests, *_summed(np.concatenate(codes), np.concatenate(times)))


def packed(keys: np.ndarray, docs: np.ndarray, universe: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Containers of ascending (key, document) entries: keys, popcounts and the bytes of all containers.

    A container is the list of its documents, two bytes each, or a bitmap of the block
    where that is smaller.
    """
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    words = -(-universe // 16)  # 16-bit words of a bitmap
    mapped = counts > words
    sizes = np.where(mapped, words, counts)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), "<u2")
    listed = np.repeat(~mapped, counts)
    out[(np.repeat(starts - first, counts) + np.arange(len(keys)))[listed]] = docs[listed]
    for k in np.flatnonzero(mapped):
        bits = np.zeros(words * 16, bool)
        bits[docs[first[k] : first[k] + counts[k]]] = True
        out[starts[k] : starts[k] + words] = np.packbits(bits, bitorder="little").view("<u2")
    return keys[first], counts, out.tobytes()


def unpacked(counts: np.ndarray, data: bytes, universe: int) -> tuple[np.ndarray, np.ndarray]:
    """(container, document) of every entry."""
    out = np.frombuffer(data, "<u2")
    words = -(-universe // 16)
    mapped = counts > words
    sizes = np.where(mapped, words, counts)
    starts, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
    containers = np.repeat(np.arange(len(counts)), counts)
    docs = np.zeros(len(containers), np.int64)
    listed = ~mapped[containers]
    docs[listed] = out[(starts - first)[containers[listed]] + np.flatnonzero(listed)]
    for k in np.flatnonzero(mapped):
        bits = np.unpackbits(out[starts[k] : starts[k] + words].view(np.uint8), bitorder="little")
        docs[first[k] : first[k] + counts[k]] = np.flatnonzero(bits)
    return containers, docs


SIZES = ["n_a", "n_b", "n_groups", "n_links"]
_PLANE = pa.struct([("at", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("bits", pa.binary())])
_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        *[(name, pa.list_(pa.int64())) for name in SIZES],
        ("digest", pa.list_(pa.string())),
        ("pair", pa.list_(pa.int64())),
        ("docs", pa.list_(pa.int32())),
        ("links", pa.list_(pa.int64())),
        ("bits", pa.binary()),
        ("planes", pa.list_(_PLANE)),
    ]
)
BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digest array<string>,"
    " pair array<long>, docs array<int>, links array<long>, bits binary, planes array<struct<at: array<int>, docs: array<int>, bits: binary>>"
)


class Block:
    """Documents of a task, with the postings of their pairs."""

    def __init__(self, number: int):
        self.number = number
        self.ids: list[int | None] = []
        self.sizes: list[np.ndarray] = []
        self.digests: list[str] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.entries = 0

    def add(self, ids: list[int | None], texts: list[str | None], c: Coders) -> None:
        found = align(texts, c, len(self.ids))
        self.ids += ids
        self.sizes.append(found.sizes)
        self.digests += found.digests
        self.parts.append((found.codes, found.times))
        self.entries += len(found.codes)

    def row(self) -> pa.RecordBatch:
        codes, times = _summed(*(np.concatenate(p) for p in zip(*self.parts)))
        universe, (keys, docs) = len(self.ids), np.divmod(codes, BLOCK_DOCS)
        pair, counts, bits = packed(keys, docs, universe)
        links = np.add.reduceat(times, np.cumsum(counts) - counts) if len(pair) else times
        place, more, planes = np.repeat(np.arange(len(pair)), counts), times - 1, []
        while more.any():
            odd = (more & 1).astype(bool)
            at, n, data = packed(place[odd], docs[odd], universe)
            planes.append({"at": at.astype(np.int32), "docs": n.astype(np.int32), "bits": data})
            more = more >> 1
        sizes = np.concatenate(self.sizes)
        row = {"block": self.number, "doc_id": self.ids, "digest": self.digests, "pair": pair, "docs": counts.astype(np.int32), "links": links}
        row |= {"bits": bits, "planes": planes, **{name: sizes[:, k] for k, name in enumerate(SIZES)}}
        return pa.RecordBatch.from_pylist([row], _BLOCK)


def postings(docs: DataFrame, definitions: Definitions, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Blocks of documents with their containers, written once."""
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(definitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(shared.value)
        base, number = TaskContext.get().partitionId() << 31, 0
        block = Block(base)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = BATCH_DOCS
                while take > 1 and batch.column(1).slice(at, take).nbytes > BATCH_BYTES:
                    take //= 2
                part = batch.slice(at, min(take, BLOCK_DOCS - len(block.ids)))
                block.add(part.column(0).to_pylist(), part.column(1).to_pylist(), c)
                at += part.num_rows
                if block.entries >= BLOCK_ENTRIES or len(block.ids) == BLOCK_DOCS:
                    yield block.row()
                    number += 1
                    block = Block(base + number)
        if block.ids:
            yield block.row()

    return staged(rows.mapInArrow(run, BLOCKS), "postings")


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """a, b, pair, n_docs, n_links, best: all linked pairs of ids; best where an A id has no larger count."""
    spread = blocks.select(F.inline(F.arrays_zip("pair", "docs", "links")))
    counts = spread.groupBy("pair").agg(F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))
    counts = counts.select(F.expr(f"pair div {width}").alias("a"), (F.col("pair") % width).alias("b"), "pair", "n_docs", "n_links")
    counts = staged(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select(*counts.columns, (F.col("n_docs") == F.col("most")).alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's documents with the sums that its postings return."""
    row = blocks.to_pylist()[0]
    universe = len(row["doc_id"])
    order = np.argsort(answers.column("pair").to_numpy())  # a block's containers are in the order of pairs
    counts, best = answers.column("n_docs").to_numpy()[order], answers.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    sums, tops = np.zeros(universe, np.int64), np.zeros(universe, np.int64)
    parts = [(np.arange(len(counts)), np.array(row["docs"], np.int64), row["bits"], 1)]
    parts += [(np.array(p["at"], np.int64), np.array(p["docs"], np.int64), p["bits"], 1 << k) for k, p in enumerate(row["planes"])]
    for at, popcounts, data, weight in parts:
        containers, docs = unpacked(popcounts, data, universe)
        np.add.at(sums, docs, counts[at][containers] * weight)
        np.add.at(tops, docs, best[at][containers] * weight)
    columns = {"doc_id": pa.array(row["doc_id"], pa.int64()), **{name: pa.array(row[name], pa.int64()) for name in SIZES}}
    return pa.table(columns | {"n_best": tops, "count_sum": sums, "groups_sha256": pa.array(row["digest"], pa.string())})


def scores(docs: DataFrame, definitions: Definitions, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document, with what the postings of its pairs return."""
    width = coders(definitions).width
    blocks = postings(docs, definitions, text_column, id_column)
    counted = pair_counts(blocks, width).select("pair", "n_docs", "best")
    asked = blocks.select(F.col("block").alias("asker"), F.explode("pair").alias("pair")).join(counted, "pair")
    return blocks.drop("pair", "links").groupBy("block").cogroup(asked.groupBy("asker")).applyInArrow(_scored, RESULT)
