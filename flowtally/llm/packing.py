"""Best-fit packing of documents into bins of fixed length, under conflicts.

No bin holds two documents of one source, or two of one duplicate cluster. Documents
longer than a bin are cut into pieces first. Pieces go longest first to the bin with the
smallest room that holds them and has no conflict: bins are ordered by room, each carries
a bitmap of its sources and one of its clusters, and the search steps on from the tightest
bin to its successors until one is compatible. For each room, the bits common to all its
bins are kept too, so that a source that fills many bins is passed over at once.

Documents are dealt by a hash of their id into shards of bounded size, which are packed
independently; the number of shards follows the number of documents. Only ids, lengths,
sources and cluster ids are shuffled, no texts. A source may hold any share of the rows,
as each shard gets its share of it.

Defined results: a NULL source or cluster conflicts with nothing; a NULL, zero or negative
length takes no room and is packed all the same; repeated rows are packed once each; ties
in length go by id; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, text_bytes

CAPACITY = 2048
SHARD = 10_000
SCHEMA = "doc_id long, piece int, start long, n_tokens long, bin_id long, bin_offset long, bin_tokens long, source string, cluster string"


class Bins:
    """Open bins ordered by room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []  # rooms that have bins, ascending
        self.at: dict[int, list[int]] = {}  # room -> bins, oldest first
        self.common: dict[int, tuple[int, int]] = {}  # room -> bits that all its bins share
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.used: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset for a piece; source and cluster are single bits, or 0."""
        for room in self.rooms[bisect_left(self.rooms, length) :]:
            shared = self.common[room]
            if shared[0] & source or shared[1] & cluster:
                continue
            for index in self.at[room]:
                if not (self.sources[index] & source or self.clusters[index] & cluster):
                    self._take(room, index)
                    return self._put(index, length, source, cluster)
        self.sources.append(0)
        self.clusters.append(0)
        self.used.append(0)
        return self._put(len(self.used) - 1, length, source, cluster)

    def _take(self, room: int, index: int) -> None:
        bins = self.at[room]
        bins.remove(index)
        if not bins:
            del self.at[room], self.common[room]
            self.rooms.pop(bisect_left(self.rooms, room))

    def _put(self, index: int, length: int, source: int, cluster: int) -> tuple[int, int]:
        offset = self.used[index]
        self.used[index] += length
        self.sources[index] |= source
        self.clusters[index] |= cluster
        room = self.capacity - self.used[index]
        if room not in self.at:
            insort(self.rooms, room)
            self.at[room] = []
            self.common[room] = (self.sources[index], self.clusters[index])
        else:
            a, b = self.common[room]
            self.common[room] = (a & self.sources[index], b & self.clusters[index])
        self.at[room].append(index)
        return index, offset


def _bits(values: list, least: int) -> dict:
    """One bit for each value that occurs `least` times or more; others cannot conflict."""
    often = [v for v, n in Counter(values).items() if v is not None and n >= least]
    return {v: 1 << i for i, v in enumerate(sorted(often))}


def pack_pieces(pieces: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """(length, source, cluster) of each piece, longest first -> (bin, offset) of each."""
    sources, clusters = _bits([p[1] for p in pieces], 2), _bits([p[2] for p in pieces], 2)
    bins = Bins(capacity)
    return [bins.place(length, sources.get(s, 0), clusters.get(c, 0)) for length, s, c in pieces]


def pack(
    items: DataFrame,
    id_column: str = "doc_id",
    length_column: str = "n_tokens",
    source_column: str = "source",
    cluster_column: str = "cluster",
    capacity: int = CAPACITY,
    shard: int = SHARD,
) -> DataFrame:
    """One row per piece: where it starts in its document and where it lies in its bin."""
    rows = items.select(
        column(id_column).cast("long").alias("doc_id"),
        F.greatest(F.coalesce(column(length_column).cast("long"), F.lit(0)), F.lit(0)).alias("length"),
        column(source_column).cast("string").alias("source"),
        column(cluster_column).cast("string").alias("cluster"),
    )
    shards = max(1, -(-rows.count() // shard))
    # ids may repeat, so the other columns take part in dealing
    place = F.pmod(F.xxhash64("doc_id", "length", "source", "cluster"), F.lit(shards))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        pieces = []
        for doc_id, length, source, cluster in zip(*[group[c].tolist() for c in ("doc_id", "length", "source", "cluster")]):
            doc_id = None if pd.isna(doc_id) else int(doc_id)
            for piece, start in enumerate(range(0, max(1, length), capacity)):
                pieces.append((min(capacity, length - start), doc_id, piece, start, source, cluster))
        pieces.sort(key=lambda p: (-p[0], p[1] is not None, p[1] or 0, p[2], p[4] or "", p[5] or ""))
        placed = pack_pieces([(p[0], p[4], p[5]) for p in pieces], capacity)
        used = Counter()
        for (index, _), p in zip(placed, pieces):
            used[index] += p[0]
        base = int(key[0]) << 32
        rows = [(p[1], p[2], p[3], p[0], base + i, at, used[i], p[4], p[5]) for p, (i, at) in zip(pieces, placed)]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return rows.withColumn("__shard", place).groupBy("__shard").applyInPandas(_without_extra(run), SCHEMA)


def _without_extra(run):
    def apply(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return run(key, group.astype(object).where(group.notna(), None))

    return apply


def word_lengths(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Items for `pack`: words and one end token per text; equal texts form a cluster."""
    text = F.coalesce(column(text_column), F.lit(""))
    return docs.select(
        column(id_column).alias("doc_id"),
        (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long").alias("n_tokens"),
        column(source_column).alias("source"),
        F.hex(F.xxhash64(text_bytes(text_column))).alias("cluster"),
    )
