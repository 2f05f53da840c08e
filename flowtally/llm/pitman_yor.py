"""A hierarchical Pitman-Yor language model that scores whole texts.

Restaurants are contexts and dishes are words. The root has no context; below it, every
word that stands before another, and the start of a text, has a restaurant for the words
that follow it. All of them share the root as parent: a table that opens in a context is a
customer of the root, whose base is uniform over the known words and one unknown word. A
context without training customers hands everything to the root.

Seating is sampled in sweeps. Restaurants meet only in their totals of customers and
tables; everything else belongs to one dish. So Spark keeps a row of dishes per bucket of
words, with their customers in all restaurants, and a sweep is one pass over these rows:
given the totals of the sweep before, the customers of each dish are seated again by the
Chinese-restaurant rule (one by one up to 32, then by binomial draws over growing blocks),
contexts first, then the root with the tables of the contexts. The totals of contexts are
then summed anew: each bucket sends the tables of its own contexts to shards of contexts,
which add them up and answer; only those of the root reach the driver. Probabilities are
averaged over the sweeps kept. A dish of any frequency has at most one entry per context,
so nothing grows with it. Contexts go by the 64-bit hash of their word.
There are as many buckets as full blocks, whatever the partitions, and no more shards than
buckets; random draws go by bucket, so scores are the same for any number of partitions.

Counting and scoring follow the input. A task turns its texts into blocks of at most `block`
tokens. A block asks each bucket once for its distinct words and (context, word) pairs, with
its own training counts; buckets answer block by block with probabilities. Asking and
answering are the only shuffles besides that of the blocks' compressed token numbers.

Defined results: tokens are the words of the text, lower-cased A-Z and cut at ASCII white
space, then one end; NULL and empty texts are one end; a row without id is held out;
repeated rows each give a row; without training rows all counts are zero; an empty table
gives an empty one; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import staged

from .common import column, fold, shuffle_partitions, text_bytes

END = b""  # no word is empty
NONE = 0  # context number of words that sit at the root; 1 is the start of a text
START = 1
SINGLE = 32
BLOCK = 1_000_000
BLOCK_SCHEMA = "block long, doc_ids array<long>, held array<boolean>, sizes array<long>, tokens binary, words binary"
ASK_SCHEMA = "bucket int, block long, words binary, pairs binary, contexts binary, context binary, n binary"
DISH_SCHEMA = (
    "bucket int, contexts binary, ends binary, context binary, n binary, pairs binary, blocks binary,"
    " asked_words binary, asked_pairs binary, word_at binary, pair_at binary"
)
SENT_SCHEMA = "shard int, bucket int, kind int, values binary"
TIE_SCHEMA = "shard int, at binary, buckets binary, sizes binary"
ROOT = -1  # shard of the sums that go to the driver
CUSTOMERS = 0  # kind of message; 1 and above: tables after so many sweeps, plus 1


# -- texts to blocks ---------------------------------------------------------------


def _block(number: int, index: dict[bytes, int], rows: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
    stream = np.concatenate(tokens)
    words = list(index)
    planes = stream.astype("<u4").view(np.uint8).reshape(-1, 4).T
    packed = zstandard.ZstdCompressor(level=3).compress(planes.tobytes())
    doc_ids, held, sizes = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([list(doc_ids)], pa.list_(pa.int64())),
            pa.array([list(held)], pa.list_(pa.bool_())),
            pa.array([list(sizes)], pa.list_(pa.int64())),
            pa.array([packed], pa.binary()),
            pa.array([_pack_words(words)], pa.binary()),
        ],
        ["block", "doc_ids", "held", "sizes", "tokens", "words"],
    )


def blocks(docs: DataFrame, id_column: str, text_column: str, modulus: int, size: int = BLOCK) -> DataFrame:
    """Token blocks: documents, compressed token numbers and distinct words.

    A document is never split, so a block may exceed `size` by one document.
    """
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), (fold(id_column, modulus) == 0).alias("held"), text_bytes(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number, index, kept, tokens, total = 0, {END: 0}, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for doc_id, held, text in zip(*[c.to_pylist() for c in part.columns]):
                    words = text.lower().split()
                    place = index.setdefault
                    ids = [place(w, len(index)) for w in words]
                    ids.append(0)
                    kept.append((doc_id, held, len(ids)))
                    tokens.append(np.array(ids, np.uint32))
                    total += len(ids)
                    if total >= size:
                        yield _block(first + number, index, kept, tokens)
                        number, index, kept, tokens, total = number + 1, {END: 0}, [], [], 0
        if kept:
            yield _block(first + number, index, kept, tokens)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


@dataclass
class Asked:
    """What a block needs: its distinct (word, context) pairs, dealt to buckets by word."""

    word: np.ndarray  # local words in order of bucket and hash
    bounds: np.ndarray  # of each bucket in `word`
    pair: np.ndarray  # word of each pair, pairs in order of `word` and context
    context: np.ndarray
    pair_bounds: np.ndarray
    token: np.ndarray  # pair of each token


def asked(stream: np.ndarray, sizes: np.ndarray, words: list[bytes], contexts: dict[bytes, int], buckets: int) -> Asked:
    reach = len(contexts) + 2
    kind = np.int32 if len(words) * reach < 1 << 31 else np.int64
    before = np.fromiter((contexts.get(w, NONE) for w in words), kind, len(words))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    word = np.lexsort((hashes, bucket))
    place = np.empty(len(words), kind)
    place[word] = np.arange(len(words))
    code = place[stream]
    code *= reach
    code[1:] += before[stream[:-1]]
    first = np.cumsum(sizes) - sizes
    code[first] = place[stream[first]] * reach + START
    code, token = np.unique(code, return_inverse=True)
    pair = word[code // reach]
    ends = [np.r_[0, np.cumsum(np.bincount(b, minlength=buckets))] for b in (bucket, bucket[pair])]
    return Asked(word, ends[0], pair, code % reach, ends[1], token)


def _stream(row: dict) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Token numbers, sizes of documents and words of a block; no word holds a blank."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["tokens"]), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel(), np.array(row["sizes"], np.int64), _unpack_words(row["words"])


def _pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b" ".join(words))


def _unpack_words(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split(b" ")


def _pack(values: np.ndarray) -> bytes:
    """Integers by planes of their bytes, so that high bytes of small ones take no space."""
    planes = np.ascontiguousarray(np.asarray(values, "<i8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours, small where values rise; `np.cumsum` undoes it."""
    return np.diff(values, prepend=values.dtype.type(0))


def _parts(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.array([_pack(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())


def _numbers(words: list[bytes]) -> dict[bytes, int]:
    """Every word of a block as a context, in order of hashes."""
    return {w: START + 1 + i for i, w in enumerate(sorted(words, key=xxhash.xxh64_intdigest))}


def _hashes(numbers: dict[bytes, int]) -> np.ndarray:
    """Ids of a block's contexts by their numbers; the end, which precedes no word, lends the start its hash."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in (END, END, *numbers)), np.uint64, len(numbers) + 2)


def requests(made: DataFrame, buckets: int) -> DataFrame:
    """A row per block and bucket: words, pairs per word, contexts and training counts of the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                stream, sizes, words = _stream(row)
                numbers = _numbers(words)
                need = asked(stream, sizes, words, numbers, buckets)
                trained = np.repeat(~np.array(row["held"], bool), sizes)
                n = np.bincount(need.token[trained], minlength=len(need.pair))
                per_word = np.bincount(need.pair, minlength=len(words))[need.word]
                in_order = [words[i] for i in need.word.tolist()]
                hashes = _hashes(numbers)
                found = [np.unique(need.context[a:b], return_inverse=True) for a, b in zip(need.pair_bounds[:-1], need.pair_bounds[1:])]
                full = pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(buckets), pa.int32()),
                        pa.array(np.full(buckets, row["block"]), pa.int64()),
                        pa.array([_pack_words(in_order[a:b]) for a, b in zip(need.bounds[:-1], need.bounds[1:])], pa.binary()),
                        _parts(per_word, need.bounds),
                        pa.array([_pack(_steps(hashes[c]).view(np.int64)) for c, _ in found], pa.binary()),
                        pa.array([_pack(at) for _, at in found], pa.binary()),
                        _parts(n, need.pair_bounds),
                    ],
                    ["bucket", "block", "words", "pairs", "contexts", "context", "n"],
                )
                yield full.filter(pa.array(np.diff(need.bounds) > 0))

    return made.select("block", "held", "sizes", "tokens", "words").mapInArrow(run, ASK_SCHEMA)


def _arrays(batch: pa.RecordBatch | pa.Table, at: int = 0) -> dict:
    """A row with its packed integers as arrays."""
    cells = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
    return {k: _unpack(c) if isinstance(c, bytes) else c for k, c in cells.items()}


def _column(table: pa.Table, name: str) -> list[np.ndarray]:
    return [_unpack(c) for c in table.column(name).to_pylist()]


def dishes(asks: DataFrame, shards: int) -> DataFrame:
    """A row per bucket: pairs of each dish with contexts and customers, and who asked for what.

    `contexts` are those of the bucket in order of their shards, which `ends` bounds;
    `context` of a pair is its place among them, from 1.

    word_at and pair_at point from the asked words and pairs, block by block, to the dishes
    and pairs of the bucket. Blocks ask in the order of hashes that dishes and pairs have here,
    so both rise within a block and are kept as steps. A bucket's size is bounded by the number
    of buckets.
    """

    def merge(table: pa.Table) -> pa.Table:
        words = [_unpack_words(w) for w in table.column("words").to_pylist()]
        found = pa.chunked_array([pa.array(w, pa.binary()) for w in words]).combine_chunks().dictionary_encode()
        rank = np.empty(len(found.dictionary), np.int64)
        rank[np.argsort(np.array([xxhash.xxh64_intdigest(w) for w in found.dictionary.to_pylist()], np.uint64))] = np.arange(len(rank))
        word_at = rank[found.indices.to_numpy(zero_copy_only=False)]
        n, per_word, local, context = (_column(table, c) for c in ("n", "pairs", "contexts", "context"))
        contexts, context = np.unique(np.concatenate([np.cumsum(x.view(np.uint64))[at] for x, at in zip(local, context)]), return_inverse=True)
        shard = ((contexts >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)  # rises with the hash
        code, pair_at = np.unique(np.repeat(word_at, np.concatenate(per_word)) << 32 | context + 1, return_inverse=True)
        customers = np.zeros(len(code), np.int64)
        np.add.at(customers, pair_at, np.concatenate(n))
        row = {
            "bucket": table.column("bucket")[0].as_py(),
            "contexts": contexts.view(np.int64),
            "ends": np.r_[0, np.cumsum(np.bincount(shard, minlength=shards))],
            "context": code & 0xFFFFFFFF,
            "n": customers,
            "pairs": np.bincount(code >> 32),
            "blocks": table.column("block").to_numpy(),
            "asked_words": [len(w) for w in words],
            "asked_pairs": [len(x) for x in n],
            "word_at": _steps(word_at),
            "pair_at": _steps(pair_at),
        }
        arrays = [pa.array([row["bucket"]], pa.int32()), *[pa.array([_pack(row[c])], pa.binary()) for c in list(row)[1:]]]
        return pa.Table.from_arrays(arrays, list(row))

    return asks.groupBy("bucket").applyInArrow(merge, DISH_SCHEMA)


# -- seating -----------------------------------------------------------------------


def seated(customers: np.ndarray, base: np.ndarray, opening: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers were seated anew.

    base: the parent's probability of the dish; opening: strength + discount * tables of
    the restaurant. A customer opens a table in proportion to opening * base, or joins one
    in proportion to the dish's customers less discount * its tables.
    """
    tables = np.minimum(customers, 1)
    weight = opening * base
    active = np.flatnonzero(customers > 1)
    at = 1
    while len(active):
        block = 1 if at < SINGLE else at // 8
        t, w = tables[active], weight[active]
        chance = np.clip(w / (w + at - discount * t), 0, 1)
        many = np.minimum(block, customers[active] - at)
        new = (draw.random(len(active)) < chance).astype(np.int64) if block == 1 else draw.binomial(many, chance)
        tables[active] = t + new
        at += block
        active = active[customers[active] > at]
    return tables


@dataclass
class State:
    """Totals of all restaurants after a sweep; entry 0 is the root."""

    customers: np.ndarray
    tables: np.ndarray
    discounts: tuple[float, float]  # of the root, of the contexts
    types: int
    strength: float = 1.0

    def back(self) -> np.ndarray:
        """The weight that each restaurant hands to its parent."""
        d = np.full(len(self.tables), self.discounts[1])
        d[0] = self.discounts[0]
        return (self.strength + d * self.tables) / (self.strength + self.customers)

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        own = (customers - self.discounts[0] * tables) / (self.strength + self.customers[0])
        return own + self.back()[0] / (self.types + 1)


@dataclass
class Seats:
    """Dishes of a bucket: pairs (dish, context, customers); tables of pairs and at the root."""

    dish: np.ndarray
    context: np.ndarray
    n: np.ndarray
    tables: np.ndarray
    root_customers: np.ndarray
    root_tables: np.ndarray


def _first_seats(row: dict) -> Seats:
    """One table per dish and restaurant."""
    pairs = np.array(row["pairs"], np.int64)
    context, n = np.array(row["context"], np.int64), np.array(row["n"], np.int64)
    dish = np.repeat(np.arange(len(pairs)), pairs)
    tables = np.where(context == NONE, n, np.minimum(n, 1))
    customers = np.bincount(dish, tables, len(pairs)).astype(np.int64)
    return Seats(dish, context, n, tables, customers, np.minimum(customers, 1))


def resample(seats: Seats, state: State, draw: np.random.Generator, rounds: int = 2) -> None:
    """Seat all customers of all dishes anew, given the totals of `state`."""
    inside = seats.context != NONE
    d = state.discounts
    opening = (state.strength + d[1] * state.tables)[seats.context]
    for _ in range(rounds):
        base = state.root(seats.root_customers, seats.root_tables)[seats.dish]
        tables = seated(seats.n, base, opening, d[1], draw)
        seats.tables = np.where(inside, tables, seats.n)  # at the root, customers come themselves
        seats.root_customers = np.bincount(seats.dish, seats.tables, len(seats.root_customers)).astype(np.int64)
        uniform = np.full(len(seats.root_customers), 1 / (state.types + 1))
        seats.root_tables = seated(seats.root_customers, uniform, np.full(len(uniform), state.strength + d[0] * state.tables[0]), d[0], draw)


def _after(row: dict, states: list[State]) -> Iterator[Seats]:
    """The seats that each sweep draws; the same draws whenever a bucket's row is read."""
    for state in states:
        seats = _first_seats(row)
        resample(seats, state, np.random.default_rng([row["bucket"], int(state.tables.sum())]))
        yield seats


def _sent(row: dict, values: np.ndarray, kind: int) -> pa.RecordBatch:
    """One number per context of a bucket, as a message to each shard."""
    ends = np.asarray(row["ends"], np.int64)
    many = len(ends) - 1
    full = pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(many), pa.int32()),
            pa.array(np.full(many, row["bucket"]), pa.int32()),
            pa.array(np.full(many, kind), pa.int32()),
            _parts(values, ends),
        ],
        ["shard", "bucket", "kind", "values"],
    )
    return full.filter(pa.array(np.diff(ends) > 0))


def _told(row: dict, seats: Seats, kind: int) -> list[pa.RecordBatch]:
    """Tables per context for the shards, sums of the root and of counts for the driver."""
    tables = np.bincount(seats.context, seats.tables, row["ends"][-1] + 1)[1:]
    once = [np.count_nonzero(x == k) for x in (seats.root_customers, seats.n) for k in (1, 2)]
    sums = [seats.root_customers.sum(), seats.root_tables.sum(), *once, seats.n.sum(), np.count_nonzero(seats.root_customers)]
    root = [pa.array([x], pa.int32()) for x in (ROOT, row["bucket"], kind)] + [pa.array([_pack(sums)], pa.binary())]
    return [_sent(row, tables.astype(np.int64), kind), pa.RecordBatch.from_arrays(root, ["shard", "bucket", "kind", "values"])]


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of all dishes with one table per restaurant, and the customers of contexts."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = _arrays(batch, at)
            seats = _first_seats(row)
            yield from _told(row, seats, 1)
            yield _sent(row, np.bincount(seats.context, seats.n, row["ends"][-1] + 1)[1:].astype(np.int64), CUSTOMERS)


def ties(held: DataFrame) -> DataFrame:
    """A row per shard: buckets in order, how many contexts each has there, and which ones."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = _arrays(batch, at)
                yield _sent(row, row["contexts"], 0)

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        keys = _column(table, "values")
        at = np.unique(np.concatenate(keys), return_inverse=True)[1]
        parts = at, table.column("bucket").to_numpy(), [len(k) for k in keys]
        lists = [pa.array([_pack(x)], pa.binary()) for x in parts]
        return pa.Table.from_arrays([table.column("shard").slice(0, 1).combine_chunks(), *lists], ["shard", "at", "buckets", "sizes"])

    return held.select("bucket", "contexts", "ends").mapInArrow(split, SENT_SCHEMA).groupBy("shard").applyInArrow(merge, TIE_SCHEMA)


def totals(tied: DataFrame, sent: DataFrame) -> DataFrame:
    """Messages added up by context, and sent back to the buckets that hold it."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        tie = _arrays(left)
        ends = np.r_[0, np.cumsum(tie["sizes"])]
        answers = []
        for kind in sorted(pc.unique(right.column("kind")).to_pylist()):
            values = np.concatenate(_column(right.filter(pc.equal(right.column("kind"), kind)).sort_by("bucket"), "values"))
            sums = np.zeros(int(tie["at"].max()) + 1, np.int64)
            np.add.at(sums, tie["at"], values)
            many = len(tie["buckets"])
            fixed = [pa.array(np.broadcast_to(x, many), pa.int32()) for x in (tie["shard"], tie["buckets"], kind)]
            answers.append(pa.Table.from_arrays([*fixed, _parts(sums[tie["at"]], ends)], ["shard", "bucket", "kind", "values"]))
        return pa.concat_tables(answers)

    return tied.groupBy("shard").cogroup(sent.where(F.col("shard") != ROOT).groupBy("shard")).applyInArrow(add, SENT_SCHEMA)


def _received(table: pa.Table) -> dict[int, np.ndarray]:
    """Kind -> totals of a bucket's contexts in their order."""
    kinds = pc.unique(table.column("kind")).to_pylist()
    return {k: np.concatenate(_column(table.filter(pc.equal(table.column("kind"), k)).sort_by("shard"), "values")) for k in kinds}


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


@dataclass
class Fit:
    """What holds for the whole model; totals of contexts stay in `sent`."""

    roots: list[tuple[int, int]]  # customers and tables of the root before the first sweep and after each
    discounts: tuple[float, float]
    types: int
    trained: int

    def state(self, k: int, tables: np.ndarray, customers: np.ndarray | None = None) -> State:
        """State after sweep k for the contexts of one bucket."""
        known = np.zeros(len(tables), np.int64) if customers is None else customers
        return State(np.r_[self.roots[k][0], known], np.r_[self.roots[k][1], tables], self.discounts, self.types)


def _root_sums(sent: DataFrame) -> list[int]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(8, np.int64)
        for batch in batches:
            sums += sum(_column(batch, "values"), np.zeros(8, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(8), pa.int32()), pa.array(sums)], ["at", "n"])

    sums = sent.where(F.col("shard") == ROOT).select("values").mapInArrow(add, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found = {r["at"]: r["n"] for r in sums.collect()}
    return [int(found.get(i, 0)) for i in range(8)]


def _sweep(model: Fit, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _arrays(left)
        state = model.state(k, _received(right)[k + 1])
        return pa.Table.from_batches(_told(row, next(_after(row, [state])), k + 2))

    return run


def fit(held: DataFrame, tied: DataFrame, sweeps: int) -> tuple[Fit, list[DataFrame]]:
    """The model and the messages before the first sweep, of one table per dish, and after each."""
    sent = [staged(held.select("bucket", "ends", "context", "n", "pairs").mapInArrow(_opened, SENT_SCHEMA), "seats", release=True)]
    sums = _root_sums(sent[0])
    model = Fit([(sums[0], sums[1])], (_discount(*sums[2:4]), _discount(*sums[4:6])), sums[7], sums[6])
    rows = held.select("bucket", "ends", "context", "n", "pairs")
    for k in range(sweeps):
        back = totals(tied, sent[-1].where(F.col("kind") != CUSTOMERS))
        seats = rows.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(_sweep(model, k), SENT_SCHEMA)
        sent.append(staged(seats, "seats", release=True))
        sums = _root_sums(sent[-1])
        model = Fit([*model.roots, (sums[0], sums[1])], model.discounts, model.types, model.trained)
    return model, sent


def predictive(row: dict, states: list[State]) -> np.ndarray:
    """Probability of each pair of a bucket, averaged over the samples after the first state."""
    total = np.zeros(len(row["n"]))
    for seats, state in zip(_after(row, states[:-1]), states[1:]):
        root = state.root(seats.root_customers, seats.root_tables)[seats.dish]
        own = (seats.n - state.discounts[1] * seats.tables) / (state.strength + state.customers)[seats.context]
        inside = np.maximum(own, 0) + state.back()[seats.context] * root
        total += np.where(seats.context == NONE, root, inside)
    return total / (len(states) - 1)


# -- scoring -----------------------------------------------------------------------


def _tokens(made: DataFrame) -> int:
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size)
    return made.agg(F.sum(sizes)).first()[0] or 0


def dealt(tokens: int, block: int, partitions: int) -> tuple[int, int]:
    """Buckets of words, as many as full blocks, and shards of contexts, no more of them than shuffle partitions.

    Each block asks each bucket, and each bucket writes to each shard, so a small table must not
    be cut finely where tasks are many or input files short.
    """
    buckets = max(1, -(-tokens // block))
    return buckets, min(buckets, partitions)


def scores(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    modulus: int = 10,
    sweeps: int = 4,
    kept: int = 2,
    block: int = BLOCK,
) -> DataFrame:
    """Fit on the rows outside fold 0 of `modulus` and score every row.

    Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    perplexity per token; scores are log10 probabilities of the whole text. The last `kept`
    of the sweeps are averaged.
    """
    spark = docs.sparkSession
    made = staged(blocks(docs, id_column, text_column, modulus, block), "token-blocks")
    buckets, shards = dealt(_tokens(made), block, shuffle_partitions(spark))
    held = staged(dishes(requests(made, buckets), shards), "dishes", release=True)
    tied = staged(ties(held), "ties", release=True)
    model, sent = fit(held, tied, sweeps)
    trained, types = model.trained, model.types
    last = list(range(sweeps - kept, sweeps + 1))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        r, sums = _arrays(left), _received(right)
        states = [model.state(k, sums[k + 1], sums[CUSTOMERS]) for k in last]
        log_p = np.log10(predictive(r, states)).astype(np.float32)[np.cumsum(r["pair_at"])]
        dish = np.repeat(np.arange(len(r["pairs"])), r["pairs"])
        n = np.bincount(dish, r["n"], len(r["pairs"])).astype(np.int64)[np.cumsum(r["word_at"])]
        return pa.Table.from_arrays(
            [
                pa.array(r["blocks"], pa.int64()),
                pa.array(np.full(len(r["blocks"]), r["bucket"]), pa.int32()),
                _parts(n, np.r_[0, np.cumsum(r["asked_words"])]),
                _parts(log_p.view("<i4"), np.r_[0, np.cumsum(r["asked_pairs"])]),
            ],
            ["block", "bucket", "n", "log_p"],
        )

    told = sent[0].where(F.col("kind") == CUSTOMERS)
    for k in last:
        told = told.unionByName(sent[k].where(F.col("kind") == k + 1))
    asked_rows = held.drop("contexts", "ends").groupBy("bucket")
    answers = asked_rows.cogroup(totals(tied, told).groupBy("bucket")).applyInArrow(answer, "block long, bucket int, n binary, log_p binary")
    base = np.log10(trained + 0.1 * (types + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket")
        counts, found = (np.concatenate(_column(right, c)) for c in ("n", "log_p"))
        found = found.astype("<i4").view("<f4").astype(np.float64)
        parts = []
        for r in left.to_pylist():
            stream, sizes, words = _stream(r)
            need = asked(stream, sizes, words, _numbers(words), buckets)
            n = np.empty(len(counts), np.int64)
            n[need.word] = counts
            first = np.cumsum(sizes) - sizes
            rare = np.log10(n + 0.1) - base
            values = ((n > 0).astype(np.int64), stream), (rare, stream), (found, need.token)
            sums = [np.add.reduceat(v[at], first) for v, at in values]
            parts.append(
                pa.table(
                    {
                        "doc_id": pa.array(r["doc_ids"], pa.int64()),
                        "held_out": pa.array(r["held"], pa.bool_()),
                        "n_tokens": pa.array(sizes),
                        "n_known": pa.array(sums[0]),
                        "train_tokens": pa.array(np.full(len(sizes), trained)),
                        "base_score": pa.array(sums[1]),
                        "score": pa.array(sums[2]),
                        "perplexity": pa.array(10.0 ** np.minimum(-sums[2] / sizes, 300)),
                    }
                )
            )
        return pa.concat_tables(parts)

    texts = made.select(F.col("block").alias("of"), "doc_ids", "held", "sizes", "tokens", "words")
    return (
        texts.groupBy("of")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,"
            " score double, perplexity double",
        )
    )
