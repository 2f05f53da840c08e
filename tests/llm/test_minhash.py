import hashlib

import numpy as np
import pytest

from flowtally.llm import minhash


def brute_shingles(text, width=5):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        k = len(text) // 4
        made = text[: len(text) - k] + following[:k]
        own, other, after = (minhash.signature(t.encode()) for t in (text, made, following))
        out.append((doc_id, len(text), hashlib.sha256(made.encode()).hexdigest(), own.astype(">u4").tobytes().hex(),
                    other.astype(">u4").tobytes().hex(), float(np.mean(own == other)), float(np.mean(own == after))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("buckets", [1, 7, None])
def test_equals_brute_force(documents, texts, buckets):
    assert rows_of(minhash.fingerprints(documents, buckets=buckets)) == brute(list(texts.items()))


def test_odd_rows(odd, odd_rows):
    want = brute([(r[0], r[1] or "") for r in odd_rows])
    assert rows_of(minhash.fingerprints(odd)) == want


def test_empty_table_and_one_row(empty, spark):
    assert minhash.fingerprints(empty).collect() == []
    assert minhash.near_groups(empty).collect() == []
    one = spark.createDataFrame([(4, "one single row of text here")], "doc_id long, text string")
    row = minhash.fingerprints(one).first()
    assert row.near_next == 1.0


def test_likeness_estimates_jaccard(texts):
    words = max(texts.values(), key=len).split()
    for share in (0.1, 0.3, 0.5):
        a, b = " ".join(words), " ".join(words[int(len(words) * share) :])
        x, y = brute_shingles(a), brute_shingles(b)
        true = len(x & y) / len(x | y)
        assert abs(minhash.likeness(minhash.signature(a.encode(), 512), minhash.signature(b.encode(), 512)) - true) < 0.1


def test_shingles_of_long_texts_equal_those_of_their_parts():
    text = " ".join(f"w{i}" for i in range(120_000)).encode()
    assert len(text) > 2 * minhash._BYTES
    whole = minhash.shingles(text)
    words = text.split()
    assert len(whole) == len(words) - 4 == len(np.unique(whole))
    for at in (0, 30_000, 119_995):
        assert whole[at] == minhash.shingles(b" ".join(words[at : at + 5]))[0]
    giant = b"x" * (minhash._BYTES + 10)
    assert len(minhash.shingles(giant + b" b c d e f")) == 2


def test_near_groups_equal_brute_force(documents, texts):
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            union = len(sets[i] | sets[j])
            if i < j and (not union or len(sets[i] & sets[j]) / union >= 0.8):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = sorted((i, find(i)) for i in ids)
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_groups(documents).collect()) == want


def test_near_groups_of_odd_rows(odd):
    found = {(r.doc_id, r.component_id) for r in minhash.near_groups(odd).collect()}
    assert {(1, 1), (2, 1), (3, 1), (5, 5), (6, 6), (None, None)} <= found
    assert (7, 6) in found


def test_a_hot_band_is_linked_whole(spark):
    """One large group of near copies, and a chain that only neighbours link."""
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*words[: i % 290], f"x{i}", *words[i % 290 + 1 :]])) for i in range(1, 1200)]
    rows += [(5000 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60))) for i in range(40)]
    found = {r.doc_id: r.component_id for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {found[i] for i in range(1, 1200)} == {1}
    assert {found[5000 + i] for i in range(40)} == {5000}


def test_texts_alike_in_word_shingles_are_one_document(spark):
    """Copies with replaced words beside texts that share half of their words."""
    rows, want = [], []
    for k in range(20):
        words = [f"w{k}x{i}" for i in range(200)]
        rows.append((10 * k, " ".join(words)))
        want.append(10 * k)
        for c in range(1, 4):  # one to three places changed: Jaccard above 0.85
            changed = [f"new{k}x{c}x{i}" if i % 60 == 10 * c and i < 60 * c else w for i, w in enumerate(words)]
            rows.append((10 * k + c, " ".join(changed)))
        # half of the words are others: stays
        rows.append((10 * k + 5, " ".join(words[:100] + [f"other{k}x{i}" for i in range(100)])))
        want.append(10 * k + 5)
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in minhash.without_near_copies(docs).collect()) == want
