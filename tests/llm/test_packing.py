from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowtally.llm import packing


def brute(pieces, capacity):
    """Best fit by looking at all bins: the tightest compatible one, of equal ones the first to get that room."""
    bins, out, age = [], [], 0
    for length, source, cluster in pieces:
        fitting = [
            b for b in bins
            if capacity - b["used"] >= length
            and not (source is not None and source in b["sources"])
            and not (cluster is not None and cluster in b["clusters"])
        ]
        best = min(fitting, key=lambda b: (capacity - b["used"], b["age"]), default=None)
        if best is None:
            best = {"used": 0, "sources": set(), "clusters": set(), "id": len(bins)}
            bins.append(best)
        age += 1
        out.append((best["id"], best["used"]))
        best["used"] += length
        best["sources"].add(source)
        best["clusters"].add(cluster)
        best["age"] = age
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10), st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2, 3, 4])), max_size=40))
def test_equals_search_of_all_bins(pieces):
    pieces = sorted(pieces, key=lambda p: -p[0])
    assert packing.pack_pieces(pieces, 10) == brute(pieces, 10)


def check(rows, items, capacity):
    """Everything is packed once, nothing overlaps, no bin holds a conflict."""
    spans, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.n_tokens))
        bins[r.bin_id].append(r)
    for doc_id, lengths in items.items():
        assert sum(n for _, n in spans[doc_id]) == sum(lengths)
    assert set(spans) == set(items)
    for placed in bins.values():
        at = 0
        for r in sorted(placed, key=lambda r: (r.bin_offset, r.n_tokens)):
            assert r.bin_offset == at
            at += r.n_tokens
        assert at <= capacity and {r.bin_tokens for r in placed} == {at}
        for values in ([r.source for r in placed], [r.cluster for r in placed]):
            known = [v for v in values if v is not None]
            assert len(known) == len(set(known))


@pytest.mark.parametrize("shard", [50, 10_000])
def test_documents_are_packed_whole(documents, texts, shard):
    items = packing.word_lengths(documents)
    rows = packing.pack(items, capacity=512, shard=shard).collect()
    check(rows, {i: [len(t.encode().split()) + 1] for i, t in texts.items()}, 512)


def test_odd_rows(odd, odd_rows):
    want = defaultdict(list)
    for doc_id, text, *_ in odd_rows:
        want[doc_id].append(len((text or "").encode().split()) + 1)
    rows = packing.pack(packing.word_lengths(odd)).collect()
    check(rows, want, packing.CAPACITY)


def test_missing_lengths(spark):
    df = spark.createDataFrame([(1, None, "a", "x"), (2, -3, "a", None), (3, 0, None, "x"), (3, 0, None, "x")], "doc_id long, n_tokens long, source string, cluster string")
    rows = packing.pack(df, capacity=4).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(1, 0), (2, 0), (3, 0), (3, 0)]


def test_one_source_of_all_rows(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "10L AS n_tokens", "'hot' AS source", "CAST(NULL AS string) AS cluster")
    assert len({r.bin_id for r in packing.pack(df, capacity=100).collect()}) == 300


def test_empty_table(empty):
    assert packing.pack(packing.word_lengths(empty)).collect() == []
