import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from flowtally.llm import byte_bpe

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def digests(text, coder):
    ids = coder.encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())


def test_equals_library_and_decodes_to_the_text(documents, texts, plain):
    rows = byte_bpe.token_digests(documents, RANKS, PATTERN).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: digests(t, plain) for i, t in texts.items()}


def test_odd_rows(odd, odd_rows, plain):
    rows = byte_bpe.token_digests(odd, RANKS, PATTERN).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(((r[0], *digests(r[1], plain)) for r in odd_rows), key=str)


def test_ids_and_bytes(odd, odd_rows, plain):
    rows = byte_bpe.token_rows(odd, RANKS, PATTERN).collect()
    for r in rows:
        text = next(x[1] for x in odd_rows if x[0] == r.doc_id) or ""
        assert list(r.ids) == plain.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_empty_table(empty):
    assert byte_bpe.token_digests(empty, RANKS, PATTERN).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 'sré1２\n\t !。😀"), max_size=60), st.integers(1, 9))
def test_cut_parts_give_the_same_ids(text, size):
    coder, _, raw = byte_bpe.encoding(RANKS, PATTERN)
    assert byte_bpe.encode(text, coder, size) == coder.encode_ordinary(text)
    assert "".join(byte_bpe.parts(text, size)) == text
    assert byte_bpe.decode(byte_bpe.encode(text, coder, size), raw) == text.encode()
