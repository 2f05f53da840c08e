import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from flowtally.llm import components, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(rows, radius=4):
    prints = [brute_print(t) for _, t in rows]
    values = np.array(sorted(set(prints)), np.uint64)
    root = {int(v): int(v) for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v in enumerate(values):
        for w in values[i + 1 :][np.bitwise_count(values[i + 1 :] ^ v) <= radius]:
            a, b = find(int(v)), find(int(w))
            root[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            ids[find(p)].append(doc_id)
    return sorted(((d, f"{p:016x}", min(ids[find(p)], default=None)) for (d, _), p in zip(rows, prints)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(documents, texts):
    assert rows_of(simhash.near_groups(documents)) == brute_groups(list(texts.items()))


def test_odd_rows(odd, odd_rows):
    assert rows_of(simhash.near_groups(odd)) == brute_groups([r[:2] for r in odd_rows])


def test_empty_table(empty):
    assert simhash.near_groups(empty).collect() == []
    assert simhash.without_near_copies(empty).collect() == []


@pytest.mark.parametrize("radius, parts", [(4, 3), (4, 2), (3, 4), (4, 5)])
def test_search_misses_nothing(spark, radius, parts):
    draw = random.Random(radius * parts)
    values = [draw.getrandbits(64) for _ in range(150)]
    for v in values[:100]:  # chains and clouds around some of them
        for _ in range(5):
            w = v
            for bit in draw.sample(range(64), draw.randint(1, 6)):
                w ^= 1 << bit
            values.append(w)
    signed = sorted({int(np.uint64(v).astype(np.int64)) for v in values})
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "__print long"), radius, parts)
    roots = {r.node: r.root for r in components.components(found).collect()}
    want = {v: v for v in signed}
    array = np.array(signed, np.int64)
    changed = True
    while changed:
        changed = False
        for v in signed:
            near = array[np.bitwise_count((array ^ v).view(np.uint64)) <= radius]
            least = min(want[int(x)] for x in near)
            if least < want[v]:
                want[v], changed = least, True
    assert {v: roots.get(v, v) for v in signed} == want


def test_one_group_of_many_near_copies(spark):
    base = 0x0123456789ABCDEF
    cloud = sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in cloud], "__print long")
    found = simhash.links(df)
    assert found.count() < 46 * len(cloud)
    assert len({r.root for r in components.components(found).collect()}) == 1


def test_stage_keeps_one_of_each_group(odd, odd_rows, documents, texts):
    want = {d for d, _, c in brute_groups(list(texts.items())) if d == c}
    kept = simhash.without_near_copies(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert None in {r.doc_id for r in simhash.without_near_copies(odd).collect()}


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(5, 5), (1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in components.components(links).collect()}
    assert roots == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
