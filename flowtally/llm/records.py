"""Token ids in files of length-delimited binary records, with an offset index.

A record file (`.rec`) is a sequence of frames:

    length of the data  u64 | its checksum  u32 | data | checksum of the data  u32

All integers are little-endian. The data is the document id (i64; the least i64 stands for
a missing one), then the token ids, two bytes each where the vocabulary has at most 65,536
entries and four bytes otherwise. A checksum is a CRC-32, rotated right by 15 bits and
moved by a constant, so that a checksum of data that holds checksums stays useful.

Beside it, the index file (`.idx`) has a head (magic, bytes of an id u32, count u64) and
for each record its document id i64, its offset u64 and its number of ids u64. A reader
that wants records in shuffled order reads the index and seeks.

Rows are dealt by ranges of ids and sorted, so that file after file the documents are in
ascending id order, those without id first, equal ids by text. A task closes a file at
`file_bytes`. Files are written under a temporary name and then renamed, always to the same
name for the same part, so a task that runs twice leaves one copy. Files go through
pyarrow's file systems, so the folder may be any that all executors share.

Defined results: a NULL text counts as empty and gives the end id alone; a string of a
special token inside a text gives that token's id, as the library has it; repeated rows are
written once each; an empty table gives no files and an empty result; other columns are
left out.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowtally.session import new_folder

from .common import byte_signs, column, shuffle_partitions

MAGIC = b"FTIDX001"
NO_ID = -(1 << 63)
FILE_BYTES = 64 << 20
_HEAD = "<QI"
_TAIL = "<I"
_INDEX_HEAD = "<8sIQ"
_CACHE = 400_000  # words a worker remembers
_ROWS, _BYTES = 2048, 8 << 20
_BLANKS = " \t\n\v\f\r"
#: Texts on both sides of a blank that a tokenizer might join or read otherwise.
_PROBES = ["a", "the", "Ab1", "'s", "it's", "'", "!?", "é", "e\u0301", "\u0301x", "１2", "ﬁ", "日本", "_", "Σ", "ς", "\u200d", "\x85", "😀", "##x"]
#: Words of ASCII letters, digits and signs but the apostrophe, and of the Latin letters up to U+00FF.
_PLAIN = r"^[!-&(-~À-ÖØ-öø-ÿ]+$"
_RUN = r"([a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+)"
_MOVED = 0xA282EAD8


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MOVED) & 0xFFFFFFFF


def framed(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return length + struct.pack(_TAIL, masked(length)) + data + struct.pack(_TAIL, masked(data))


def read_frame(stream) -> bytes | None:
    """The data of the next frame, None at the end; an error where a checksum differs."""
    head = stream.read(struct.calcsize(_HEAD))
    if not head:
        return None
    if len(head) < struct.calcsize(_HEAD):
        raise ValueError("record file ends inside a frame")
    length, check = struct.unpack(_HEAD, head)
    if masked(head[:8]) != check:
        raise ValueError("length of a record does not match its checksum")
    data = stream.read(length)
    tail = stream.read(struct.calcsize(_TAIL))
    if len(data) < length or len(tail) < struct.calcsize(_TAIL):
        raise ValueError("record file ends inside a frame")
    if masked(data) != struct.unpack(_TAIL, tail)[0]:
        raise ValueError("data of a record does not match its checksum")
    return data


class Known:
    """Texts met before, with their ids; `places` gives new ones the next places, `learn` their ids."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.used = np.zeros(0, np.int64)

    def places(self, distinct: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Place of each of some distinct texts, and those of them that are new, in the order of their places."""
        index, place, before = self.index, self.index.setdefault, len(self.index)
        found = np.array([place(t, len(index)) for t in distinct.tolist()], np.int64)
        self.used = np.concatenate([self.used, np.zeros(len(index) - before, np.int64)])
        self.used[found] += times
        return found, distinct[found >= before].tolist()

    def learn(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts at some places, one after the other, and how many each has."""
        first = self.starts[places]
        sizes = self.starts[places + 1] - first
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes

    def forget(self, most: int) -> None:
        """Keep those met most often, `most` of them; the others hardly ever come again."""
        often = np.flatnonzero(self.used > 1)
        if len(often) > most:
            often = np.sort(often[np.argpartition(-self.used[often], most)[:most]])
        texts = list(self.index)
        ids, sizes = self.of(often)
        self.index = {texts[k]: n for n, k in enumerate(often.tolist())}
        self.starts, self.ids, self.used = np.concatenate([[0], np.cumsum(sizes)]), ids, self.used[often] // 2


class WordCoder:
    """Token ids of whole texts, as the tokenizer gives them, worked out for distinct words.

    Where a tokenizer never joins text across ASCII white space, a text's ids are those of
    its words in turn; each word is encoded once and remembered up to a bound. A word of
    plain letters, digits and punctuation goes to the tokenizer's model run by run, which
    spares the steps ahead of it. Both are tried out on probes when a definition is loaded,
    and left where the tokenizer decides otherwise. Texts that hold a string of an added
    token are encoded whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.signs = {b: s for s, b in byte_signs().items()}
        self.words, self.runs = Known(), Known()
        self.by_word = not any(t.normalized for t in added) and self._stops_at_blanks()
        self.by_run = self.by_word and self._runs_agree()

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _stops_at_blanks(self) -> bool:
        alone = {p: self.whole(p) for p in _PROBES}
        return all(
            self.whole(a + blank + b) == alone[a] + alone[b] for a in _PROBES for b in _PROBES for blank in (*_BLANKS, " " + _BLANKS)
        )

    def _runs_agree(self) -> bool:
        letters = [chr(c) for c in range(0x21, 0x100)]
        words = [w for c in letters for w in (c, c + c, "a" + c, c + "e", c + "1", "." + c, c + "Ab-12", "the" + c + "ing")]
        words = pa.array(words).filter(pc.match_substring_regex(pa.array(words), _PLAIN)).to_pylist()
        ids, sizes = self._by_runs(pa.array(words))
        return [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] == [self.whole(w) for w in words]

    def _by_runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, one after the other, and how many each has."""
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(words), _RUN, r"\1 "))
        runs = pc.dictionary_encode(split.flatten())
        at = runs.indices.to_numpy()
        distinct = runs.dictionary.to_numpy(zero_copy_only=False)
        places, fresh = self.runs.places(distinct, np.bincount(at, minlength=len(distinct)))
        if fresh:
            tokenize, signs = self.tokenizer.model.tokenize, self.signs
            spelled = [r if r.isascii() else "".join([signs[b] for b in r.encode()]) for r in fresh]
            self._add(self.runs, [[t.id for t in tokenize(r)] if r else [] for r in spelled])
        ids, sizes = self.runs.of(places[at])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])])

    @staticmethod
    def _add(known: Known, ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        known.learn(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)

    def _learn(self, words: list[str]) -> None:
        """Words at the next places."""
        listed = pa.array(words, pa.string())
        plain = pc.match_substring_regex(listed, _PLAIN) if self.by_run else pa.array(np.zeros(len(words), bool))
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(listed.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)]
        plain_ids, plain_sizes = self._by_runs(listed.filter(plain))
        plain = plain.to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(words), np.int64)
        sizes[plain], sizes[~plain] = plain_sizes, np.fromiter(map(len, rest), np.int64, len(rest))
        ids, of_plain = np.zeros(int(sizes.sum()), np.uint32), np.repeat(plain, sizes)
        ids[of_plain] = plain_ids
        ids[~of_plain] = np.fromiter(chain.from_iterable(rest), np.uint32, len(ids) - len(plain_ids))
        self.words.learn(ids, sizes)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; none is NULL."""
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not self.by_word:
            special[:] = True
        alone = {int(k): np.array(self.whole(texts[int(k)].as_py()), np.uint32) for k in np.flatnonzero(special)}
        if len(alone) == len(texts):
            return [alone[k] for k in range(len(texts))]
        for known in (self.words, self.runs):
            if len(known.index) > _CACHE:
                known.forget(_CACHE // 2)
        # a text encoded whole takes no part in the words
        texts = pc.if_else(pa.array(special), "", texts) if alone else texts
        split = pc.ascii_split_whitespace(texts)
        words = pc.dictionary_encode(split.flatten())
        at, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False)
        places, fresh = self.words.places(distinct, np.bincount(at, minlength=len(distinct)))
        if fresh:
            self._learn(fresh)
        ids, sizes = self.words.of(places[at])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        return [alone[k] if k in alone else ids[bounds[k] : bounds[k + 1]] for k in range(len(texts))]


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Some thousand rows at a time, fewer where texts are long."""
    at = 0
    while at < batch.num_rows:
        rows = _ROWS
        while rows > 1 and batch.slice(at, rows).nbytes > _BYTES:
            rows //= 2
        yield batch.slice(at, rows)
        at += rows


@lru_cache(maxsize=2)
def _coder(definition: str) -> WordCoder:
    return WordCoder(definition)


class Writer:
    """Record files of one part, in order; rolls over at `file_bytes`."""

    def __init__(self, folder: str, part: int, width: int, file_bytes: int, attempt: int):
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.part, self.width, self.file_bytes, self.attempt = part, width, file_bytes, attempt
        self.number, self.stream = 0, None

    def add(self, doc_id: int | None, ids: np.ndarray) -> dict | None:
        """The entry of a file that this record has closed."""
        if self.stream is None:
            self.name = f"part-{self.part:06d}-{self.number:06d}"
            self.stream = self.system.open_output_stream(f"{self.folder}/{self.name}.rec.{self.attempt}")
            self.offset, self.index, self.total = 0, [], 0
        number = NO_ID if doc_id is None else doc_id
        frame = framed(struct.pack("<q", number) + ids.astype("<u2" if self.width == 2 else "<u4").tobytes())
        self.stream.write(frame)
        self.index.append((number, self.offset, len(ids)))
        self.offset += len(frame)
        self.total += len(ids)
        return self.close() if self.offset >= self.file_bytes else None

    def close(self) -> dict | None:
        if self.stream is None:
            return None
        self.stream.close()
        self.stream = None
        with self.system.open_output_stream(f"{self.folder}/{self.name}.idx.{self.attempt}") as index:
            index.write(struct.pack(_INDEX_HEAD, MAGIC, self.width, len(self.index)))
            index.write(np.array(self.index, "<i8").tobytes())
        for kind in ("idx", "rec"):
            self.system.move(f"{self.folder}/{self.name}.{kind}.{self.attempt}", f"{self.folder}/{self.name}.{kind}")
        entry = {"name": self.name, "part": self.part, "number": self.number, "docs": len(self.index), "ids": self.total}
        self.number += 1
        return entry


FILES = "name string, part int, number int, docs long, ids long"


def write_records(
    docs: DataFrame,
    definition: str,
    end_id: int,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Encode and write all texts; returns the folder. Its list of files is at `folder`/files."""
    spark = docs.sparkSession
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), F.coalesce(column(text_column), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(parts or shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    shared = spark.sparkContext.broadcast(definition)  # a vocabulary file: fixed size
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        task = TaskContext.get()
        writer = Writer(folder, task.partitionId(), coder.width, file_bytes, task.taskAttemptId())
        closed = []
        for batch in batches:
            for part in sliced(batch):
                for doc_id, ids in zip(part.column(0).to_pylist(), coder.encode(part.column(1))):
                    closed.append(writer.add(doc_id, np.append(ids, np.uint32(end_id))))
        closed.append(writer.close())
        entries = [c for c in closed if c]
        if entries:
            yield pa.RecordBatch.from_pylist(entries, pa.schema([("name", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64())]))

    dealt.mapInArrow(run, FILES).write.parquet(f"{folder}/files")
    return folder


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the files.

    One task reads a file from its start, checking every frame; `start` adds the ids of the
    files before, from the list of files, which has one row per file.
    """
    files = spark.read.schema(FILES).parquet(f"{folder}/files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    spread = listed.select("name", "before").repartition(shuffle_partitions(spark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_stream(f"{path}/{name}.idx") as stream:
                    _, width, _ = struct.unpack(_INDEX_HEAD, stream.read(struct.calcsize(_INDEX_HEAD)))
                rows: list[tuple] = []
                with system.open_input_stream(f"{path}/{name}.rec", buffer_size=1 << 20) as stream:
                    while (data := read_frame(stream)) is not None:
                        number = struct.unpack_from("<q", data)[0]
                        ids = np.frombuffer(data, "<u2" if width == 2 else "<u4", offset=8).astype("<u4")
                        rows.append((None if number == NO_ID else number, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) >= 10_000:
                            yield _digests(rows)
                            rows = []
                if rows:
                    yield _digests(rows)

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(path: str) -> np.ndarray:
    """(documents, 3) of an index file: document id, offset, number of ids."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as stream:
        magic, _, count = struct.unpack(_INDEX_HEAD, stream.read(struct.calcsize(_INDEX_HEAD)))
        if magic != MAGIC:
            raise ValueError(f"not an index of records: {path}")
        return np.frombuffer(stream.read(), "<i8").reshape(count, 3)


def read_at(path: str, offsets: list[int], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(document id, ids) of the records at the given offsets, in the order given."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        for offset in offsets:
            file.seek(offset)
            data = read_frame(file)
            if data is None:
                raise ValueError("offset behind the last record")
            yield struct.unpack_from("<q", data)[0], np.frombuffer(data, "<u2" if width == 2 else "<u4", offset=8).astype("<u4")


def round_trip(docs: DataFrame, definition: str, end_id: int, **settings) -> DataFrame:
    """Write all texts to a new folder beside the checkpoints and read the files back."""
    spark = docs.sparkSession
    folder = new_folder(spark, "records")
    return read_records(spark, write_records(docs, definition, end_id, folder, **settings))
