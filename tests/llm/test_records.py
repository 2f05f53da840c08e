import io
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowtally.llm import records

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
    DEFINITION = file.read()


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_str(DEFINITION)


def brute(rows, plain):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("settings_", [{}, {"file_bytes": 20_000, "parts": 3}])
def test_round_trip(documents, texts, plain, settings_):
    assert rows_of(records.round_trip(documents, DEFINITION, 1, **settings_)) == brute(list(texts.items()), plain)


def test_odd_rows(odd, odd_rows, plain):
    assert rows_of(records.round_trip(odd, DEFINITION, 1)) == brute([r[:2] for r in odd_rows], plain)


def test_empty_table(empty):
    assert records.round_trip(empty, DEFINITION, 1).collect() == []


def test_index_leads_to_records(documents, texts, plain, tmp_path):
    folder = records.write_records(documents, DEFINITION, 1, str(tmp_path / "out"), parts=2, file_bytes=30_000)
    names = sorted(n for n in os.listdir(folder) if n.endswith(".idx"))
    assert len(names) > 2 and not [n for n in os.listdir(folder) if n[-1].isdigit()]
    seen = {}
    for name in names:
        index = records.read_index(f"{folder}/{name}")
        order = np.random.default_rng(0).permutation(len(index))
        found = list(records.read_at(f"{folder}/{name[:-4]}.rec", index[order, 1].tolist(), 2))
        assert [f[0] for f in found] == index[order, 0].tolist()
        assert [len(f[1]) for f in found] == index[order, 2].tolist()
        seen |= {f[0]: f[1].tolist() for f in found}
    assert seen == {i: [*plain.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}


def test_damage_is_found():
    frame = records.framed(b"some data")
    assert records.read_frame(io.BytesIO(frame)) == b"some data"
    assert records.read_frame(io.BytesIO(b"")) is None
    for at in range(len(frame)):
        broken = bytearray(frame)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(broken)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(frame[:-1]))


ALPHABET = "aB 'śéÅ1２\n\t\x1c\x85 !。Σσ\u0301e.-ÿß×ª"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ALPHABET, "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "the", "'ll"]), max_size=30).map("".join), max_size=4))
def test_words_one_by_one_give_the_ids_of_the_text(texts):
    plain = Tokenizer.from_str(DEFINITION)
    coder = records._coder(DEFINITION)
    assert coder.by_word and coder.by_run
    found = [ids.tolist() for ids in coder.encode(pa.array(texts, pa.string()))]
    assert found == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings_are_the_librarys(spark, plain):
    rows = [(1, "hello <|endoftext|> world"), (2, "<|startoftext|>x<|endoftext|>"), (3, "<|ENDOFTEXT|> no"), (4, "a b")]
    assert plain.encode(rows[0][1], add_special_tokens=False).ids == [3306, 49407, 1002]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(records.round_trip(df, DEFINITION, 1)) == brute(rows, plain)


@pytest.mark.parametrize("name, by_word", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_a_tokenizer_that_joins_across_blanks_gets_whole_texts(name, by_word):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        definition = file.read()
    coder, plain = records.WordCoder(definition), Tokenizer.from_str(definition)
    assert coder.by_word == by_word
    texts = ["two  words\nand more", "", "It's <|endoftext|> x"]
    assert [i.tolist() for i in coder.encode(pa.array(texts))] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_words_changes_nothing(texts, plain, monkeypatch):
    monkeypatch.setattr(records, "_CACHE", 50)  # words are met again after they were forgotten, and while some are kept
    coder, some = records.WordCoder(DEFINITION), list(texts.values())[:30]
    found = [i.tolist() for at in range(0, 30, 4) for i in coder.encode(pa.array(some[at : at + 4]))]
    assert found == [plain.encode(t, add_special_tokens=False).ids for t in some]
