"""Byte-level BPE encoding and decoding by a local rank file.

The tiktoken library encodes; Spark only deals texts to tasks, so nothing is shuffled.
A long text is first cut where no match of the splitting pattern can cross: in front of
white space that follows something else, or between a letter and a number. Each cut part
then gives the ids it would give inside the whole text. Ids are decoded as raw bytes, so
a token that ends inside a character does no harm.

Defined results: NULL text counts as empty, an empty text has no ids; repeated rows each
give a row; an empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from .common import column

PART = 1 << 16
_BOUNDARY = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")
_encodings: dict[str, tuple[tiktoken.Encoding, list[str], list[bytes]]] = {}


def read_ranks(path: str) -> bytes:
    """The rank file as bytes; it goes to the tasks with the query, so they need no such file."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[str], list[bytes]]:
    """The encoding, and each id's decimal text and bytes; built once per worker."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _encodings:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        made = tiktoken.Encoding(key[:8], pat_str=pattern, mergeable_ranks=table, special_tokens={})
        size = max(table.values(), default=-1) + 1
        raw = [b""] * size
        for token, rank in table.items():
            raw[rank] = token
        _encodings[key] = (made, [str(i) for i in range(size)], raw)
    return _encodings[key]


def parts(text: str, size: int = PART) -> Iterator[str]:
    """Cut a text at the first safe boundary after each `size` characters."""
    at = 0
    while len(text) - at > size:
        cut = _BOUNDARY.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def encode(text: str, coder: tiktoken.Encoding, size: int = PART) -> list[int]:
    if len(text) <= size:
        return coder.encode_ordinary(text)
    return [i for part in parts(text, size) for i in coder.encode_ordinary(part)]


def decode(ids: list[int], raw: list[bytes]) -> bytes:
    return b"".join(map(raw.__getitem__, ids))


def token_rows(docs: DataFrame, ranks: bytes, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and decoded (binary) of every text."""
    source = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _, raw = encoding(ranks, pattern)
        for batch in batches:
            ids = [encode(text or "", coder) for text in batch.column(1).to_pylist()]
            arrays = [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([decode(i, raw) for i in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    return source.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def token_digests(docs: DataFrame, ranks: bytes, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids in decimal, joined by one space), decoded_sha256.

    The same encoding as `token_rows`, digested in the task so that no ids leave it.
    """
    source = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, decimal, raw = encoding(ranks, pattern)
        for batch in batches:
            counts, ids_sha, bytes_sha = [], [], []
            for value in batch.column(1):
                ids = encode(value.as_py() or "", coder)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                bytes_sha.append(hashlib.sha256(decode(ids, raw)).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
