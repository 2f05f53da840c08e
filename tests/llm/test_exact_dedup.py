import hashlib
import os
import random
import tempfile
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowtally.llm import exact_dedup
from flowtally.llm.trie import PatriciaTrie


def brute(rows, largest):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        rank = lambda i: float("-inf") if i is None else i
        keep = (max if largest else min)(ids, key=rank)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(documents, texts):
    for largest in (True, False):
        assert rows_of(exact_dedup.text_owners(documents, largest=largest)) == brute(list(texts.items()), largest)


def test_odd_rows_with_subtrees_on_disk(odd, odd_rows):
    pairs = [r[:2] for r in odd_rows]
    for budget in (1, exact_dedup.BUDGET):
        assert rows_of(exact_dedup.text_owners(odd, largest=True, budget=budget)) == brute(pairs, True)


def test_one_row_stays_with_all_columns(spark, odd):
    kept = exact_dedup.without_copies(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    rows = kept.collect()
    assert len([r for r in rows if r.doc_id == 5]) == 1  # the row that was repeated
    assert len(rows) == len({r[1] or "" for r in odd.collect()})
    assert {tuple(r) for r in rows} <= {tuple(r) for r in odd.collect()}
    empties = [r for r in rows if not r.text]
    assert [(r.doc_id, r.text) for r in empties] == [(1, None)]


def test_empty_table(empty):
    assert exact_dedup.text_owners(empty).collect() == []
    assert exact_dedup.without_copies(empty).collect() == []


def test_many_copies(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same', cast(id AS string)) AS text")
    sizes = {r.group_size for r in exact_dedup.text_owners(df).where("text_sha256 = sha2('the same', 256)").collect()}
    assert sizes == {1000}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b))), st.sampled_from([1, 400, 2000, 1 << 30]))
def test_trie_counts_keys(keys, budget):
    before = len(os.listdir(tempfile.gettempdir()))
    trie = PatriciaTrie(lambda a, b: a + b, budget)
    for key in keys:
        trie.add(key, 1)
    found = list(trie.items())
    assert len(found) == len(dict(found))
    assert dict(found) == {k: keys.count(k) for k in set(keys)}
    assert len(os.listdir(tempfile.gettempdir())) <= before


def held(trie):
    """Bytes of a tree in memory, measured by walking over it."""
    total, stack = 0, [trie.root]
    while stack:
        node = stack.pop()
        if hasattr(node, "waiting"):
            total += sum(len(k) + 300 for k, _ in node.waiting)
        else:
            total += 300 + len(node.label)
            stack.extend((node.children or {}).values())
    return total


@pytest.mark.parametrize("kind", ["one first byte", "long shared start", "prefixes of one another", "many first bytes"])
def test_memory_stays_near_the_budget(kind):
    rng, budget = random.Random(3), 100_000
    start = {"one first byte": b"<", "long shared start": b"{" * 5000}.get(kind, b"")
    if kind == "prefixes of one another":
        keys = [b"a" * rng.randrange(1, 3000) for _ in range(6000)]
    else:
        keys = [start + rng.randbytes(6) for _ in range(9000)]
    keys += keys[::3]
    trie, most = PatriciaTrie(lambda a, b: a + b, budget), 0
    for n, key in enumerate(keys):
        trie.add(key, 1)
        if n % 200 == 0:
            most = max(most, held(trie))
    assert most < 2 * budget and trie.spilled
    files = [c.path for c in trie.spilled]
    found = dict(trie.items())
    assert found == Counter(keys) and not any(map(os.path.exists, files))


def test_scratch_files_go_when_reading_stops_early():
    before = set(os.listdir(tempfile.gettempdir()))
    trie = PatriciaTrie(lambda a, b: a + b, 2000)
    for k in range(500):
        trie.add(b"<%d" % (k * 7919), 1)
    items = trie.items()
    for _ in range(10):
        next(items)
    items.close()
    left = set(os.listdir(tempfile.gettempdir())) - before
    assert not [n for n in left if n.startswith("subtree-")]
