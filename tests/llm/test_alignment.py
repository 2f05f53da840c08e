import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowtally.llm import alignment

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    JSON = file.read()
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
    MODEL = file.read()
DEFINITIONS = alignment.Definitions(JSON, public_tokenizers.PATTERN, MODEL)
TOKENIZER = Tokenizer.from_str(JSON)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def a_bytes(i):
    """Bytes of A's entry by the library's own alphabet."""
    vocab = a_bytes.vocab
    return bytes(a_bytes.signs[s] for s in vocab[i])


a_bytes.vocab = {i: t for t, i in json.loads(JSON)["model"]["vocab"].items()}
a_bytes.signs = {}
for code in range(256):
    stands = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    sign = chr(code) if code in stands else chr(256 + [c for c in range(256) if c not in stands].index(code))
    a_bytes.signs[sign] = code


def b_bytes(i):
    piece = PIECES.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(text):
    """Groups as lists of ids, by walking over the bytes; None for a text without tokens."""
    if not text:
        return None
    a, b = TOKENIZER.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    want = (" " + text).encode()
    if b"".join(map(a_bytes, a)) != want or b"".join(map(b_bytes, b)) != want:
        return None
    out, i, j, end_a, end_b = [], 0, 0, 0, 0
    left, right = [], []
    while i < len(a) or j < len(b):
        if end_a <= end_b and i < len(a):
            left.append(a[i])
            end_a += len(a_bytes(a[i]))
            i += 1
        else:
            right.append(b[j])
            end_b += len(b_bytes(b[j]))
            j += 1
        if end_a == end_b:
            out.append((left, right))
            left, right = [], []
    return out


def brute(texts):
    """Rows without ids, from links one by one."""
    all_groups = [groups_of(t) for t in texts]
    links = [Counter((x, y) for g in groups or [] for x in g[0] for y in g[1]) for groups in all_groups]
    count, most = Counter(p for c in links for p in c), defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for groups, c in zip(all_groups, links):
        if groups is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in c.items() if count[p] == most[p[0]])
        total = sum(n * count[p] for p, n in c.items())
        sizes = (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(c.values()))
        out.append((*sizes, best, total, hashlib.sha256(line.encode()).hexdigest()))
    return out


def rows_of(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, *tuple(r)[1:]) for r in df.collect())


def wanted(rows):
    return sorted((i is not None, i or 0, *found) for (i, _), found in zip(rows, brute([t for _, t in rows])))


@pytest.mark.parametrize("entries", [2_000_000, 3_000])
def test_given_documents(documents, texts, monkeypatch, entries):
    monkeypatch.setattr(alignment, "BLOCK_ENTRIES", entries)
    some = documents.repartition(3)
    assert rows_of(alignment.scores(some, DEFINITIONS)) == wanted(list(texts.items()))


def test_odd_rows(odd, odd_rows):
    special = [(20, "a <|endoftext|> b"), (21, "<s> </s> <unk> <0x41>"), (22, "▁low"), (23, " lead"), (24, "▁")]
    more = odd.sparkSession.createDataFrame([(i, t, "", "", 0, "x", 1) for i, t in special], odd.schema)
    rows = [r[:2] for r in odd_rows] + special
    found = rows_of(alignment.scores(odd.union(more), DEFINITIONS))
    assert found == wanted(rows)
    assert [r for r in found if r[1] == 22][0][2:] == (0, 0, 0, 0, 0, 0, "")


def test_empty_table(empty):
    assert alignment.scores(empty, DEFINITIONS).collect() == []


def test_pair_counts(documents, texts):
    width = PIECES.get_piece_size()
    rows = alignment.pair_counts(alignment.postings(documents, DEFINITIONS), width).collect()
    links = [Counter((x, y) for g in groups_of(t) or [] for x in g[0] for y in g[1]) for t in texts.values()]
    docs, occurrences = Counter(p for c in links for p in c), Counter()
    for c in links:
        occurrences.update(c)
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in rows} == {p: (n, occurrences[p]) for p, n in docs.items()}


def test_large_groups_are_counted_by_ids(monkeypatch):
    c = alignment.coders(DEFINITIONS)
    text = "日本語の文章を書く" * 40 + " xx" * 9
    plain = alignment.align([text], c)
    monkeypatch.setattr(alignment, "_LARGE_GROUP", 1)
    other = alignment.align([text], c)
    assert (plain.codes == other.codes).all() and (plain.times == other.times).all() and plain.digests == other.digests


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB 'séÅ1２\n\t\x1c\x85 !。Σ<|endoftext|>▁ -—日😀"), max_size=40), max_size=5))
def test_tokens_are_the_libraries(texts):
    c = alignment.coders(DEFINITIONS)
    a, b = c.encode(texts)
    assert a == [TOKENIZER.encode(" " + t, add_special_tokens=False).ids for t in texts]
    found = alignment.align(texts, c)
    assert [tuple(s) for s in found.sizes.tolist()] == [r[:4] for r in brute(texts)]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 5), st.integers(0, 199)), max_size=300))
def test_containers_round_trip(entries):
    keys, docs = (np.array([e[k] for e in sorted(entries)], np.int64) for k in (0, 1))
    unique, counts, data = alignment.packed(keys, docs, 200)
    containers, back = alignment.unpacked(counts, data, 200)
    assert (unique[containers] == keys).all() and (back == docs).all()
    assert len(data) <= 2 * len(entries) and len(data) <= 26 * len(unique)
