import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowtally.llm import mixing


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets(rows, weights=(3, 1, 2), share=1.5, copies=2):
    """Targets by refilling one source after the other."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words_of(text))
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        each = (total - sum(full.values())) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if weight[s] * each >= copies * sizes[s]]
        if not over:
            break
        full |= {s: copies * sizes[s] for s in over}
    return sizes, {s: full.get(s, weight[s] * each) for s in order}


def check(rows, found, length, copies=2):
    """found: (doc_id, size, source_size, target, taken) for every row."""
    sizes, target = targets(rows)
    want = sorted(((i is not None, i or 0), len(words_of(t)), sizes[s], round(target[s], 6)) for i, t, s in rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.size, r.source_size, round(r.target, 6)) for r in found) == want
    assert all(0 <= r.taken <= copies * r.size for r in found)
    taken, left = defaultdict(int), defaultdict(list)
    for r in found:
        left[r.doc_id, r.size, r.source_size].append(r.taken)
    for i, t, s in rows:
        taken[s] += left[i, len(words_of(t)), sizes[s]].pop()
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * length, (s, taken[s], target[s])


@pytest.mark.parametrize("length, shard_slots", [(64, 4096), (16, 100), (7, 33)])
def test_given_documents(documents, length, shard_slots):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    mixed = mixing.mix(documents, length=length, shard_slots=shard_slots)
    found = mixing.document_shares(mixed).collect()
    check(rows, found, length)
    again = mixing.document_shares(mixing.mix(documents.repartition(5), length=length, shard_slots=shard_slots))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found))


def test_blocks_are_whole_and_few(documents, texts):
    """Each block lies in the mix as often as its spans say, and its text is the stream's."""
    mixed = mixing.mix(documents, length=40, shard_slots=50)
    sources = {r.number: r for r in mixed.sources.collect()}
    slots = mixed.slots.collect()
    by_source = Counter(r.number for r in slots)
    assert by_source == Counter({k: r.slots for k, r in sources.items() if r.slots})
    times = Counter((r.number, r.block) for r in slots)
    for number, r in sources.items():
        used = [times[number, b] for b in range(r.blocks)]
        assert sum(used) == r.slots and max(used) - min(used) <= 1
    streams = defaultdict(list)
    for r in sorted(mixed.documents.collect(), key=lambda r: (r.number, r.start)):
        assert len(streams[r.number]) == r.start
        streams[r.number] += words_of(texts[r.doc_id])
    want = Counter()
    for r in slots:
        want[r.shard, r.place] = " ".join(streams[r.number][r.block * 40 : r.block * 40 + 40])
    assert {(r.shard, r.place): r.text for r in mixing.block_texts(mixed, documents).collect()} == dict(want)
    shards = Counter(r.shard for r in slots)
    assert all(n == 50 for s, n in shards.items() if s < max(shards))


def test_source_counts_are_random(documents):
    mixed = mixing.mix(documents, length=10, shard_slots=200)
    slots = [r.slots for r in mixed.sources.orderBy("number").collect()]
    total = sum(slots)
    counts = defaultdict(Counter)
    for r in mixed.slots.collect():
        counts[r.shard][r.number - 1] += 1
    whole = [c for s, c in counts.items() if sum(c.values()) == 200]
    shares = np.array(slots) / total
    got = np.array([[c[k] for k in range(len(slots))] for c in whole])
    spread = got.var(axis=0).sum() / (200 * shares * (1 - shares)).sum()
    assert 0.7 < spread < 1.3  # as wide as a multinomial's


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    found = mixing.document_shares(mixing.mix(odd, length=8)).collect()
    check(rows, found, 8)
    assert [r.taken for r in found if r.size == 0] == [0] * sum(not words_of(t) for _, t, _ in rows)


def test_one_hot_source_and_tiny_ones(spark):
    rows = [(i, "w " * (i % 9), "hot") for i in range(3000)] + [(5000 + i, "a b c", f"s{i:03d}") for i in range(150)]
    rows += [(9000, "", "empty source"), (9001, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.document_shares(mixing.mix(df, length=4, shard_slots=64)).collect()
    check(rows, found, 4)


def test_without_words(spark, empty):
    assert mixing.document_shares(mixing.mix(empty)).collect() == []
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in mixing.document_shares(mixing.mix(df)).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 62))
def test_permutations(size, key):
    found = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, key))
    assert sorted(found.tolist()) == list(range(size))
    if size > 50:
        assert (found != np.arange(size)).sum() > size / 2
