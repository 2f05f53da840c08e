import zlib
from collections import Counter

import numpy as np
import xxhash
import pytest

from flowtally.llm import pitman_yor as py


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute(rows):
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        found = tokens(text)
        base = sum(np.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in found)
        out.append((doc_id, held(doc_id), len(found), sum(counts[t] > 0 for t in found), n, base))
    return sorted(out, key=str)


def compare(df, rows):
    found = sorted((tuple(r) for r in df.collect()), key=lambda r: str(r[:5]))
    want = sorted(brute(rows), key=lambda r: str(r[:5]))
    assert [f[:5] for f in found] == [w[:5] for w in want]
    key = lambda r: (str(r[:5]), r[5])
    for f, w in zip(sorted(found, key=key), sorted(want, key=key)):
        assert f[5] == pytest.approx(w[5], rel=1e-9)
        assert np.isfinite(f[6]) and f[6] < 0
        assert f[7] == pytest.approx(10 ** min(300, -f[6] / f[2]))
    return found


@pytest.mark.parametrize("block", [3000, py.BLOCK])
def test_counts_and_base_equal_brute_force(documents, texts, block):
    found = compare(py.scores(documents, block=block), list(texts.items()))
    out = [f for f in found if f[1]]
    # the model beats smoothed word frequencies on texts that it has not seen
    assert sum(f[6] for f in out) > sum(f[5] for f in out)


def test_odd_rows(odd, odd_rows):
    compare(py.scores(odd), [r[:2] for r in odd_rows])


def test_empty_table(empty):
    assert py.scores(empty).collect() == []


def test_probabilities_sum_to_one():
    draw = np.random.default_rng(0)
    types, restaurants = 40, 6
    context = np.concatenate([np.arange(restaurants)] * types)
    n = draw.poisson(2, types * restaurants) * draw.integers(0, 2, types * restaurants)
    n[::restaurants] += 1
    row = {"bucket": 3, "context": context, "n": n, "pairs": [restaurants] * types}

    def state(seats):
        inside = seats.context != py.NONE
        customers = np.bincount(seats.context[inside], seats.n[inside], restaurants)
        tables = np.bincount(seats.context[inside], seats.tables[inside], restaurants)
        customers[0], tables[0] = seats.root_customers.sum(), seats.root_tables.sum()
        return py.State(customers, tables, (0.4, 0.7), types)

    states = [state(py._first_seats(row))]
    for _ in range(3):
        states.append(state(next(py._after(row, [states[-1]]))))
    p = py.predictive(row, states)
    for c in range(restaurants):
        # a word that nobody has met gets the rest
        unknown = np.mean([(s.back()[c] if c else 1) * s.back()[0] / (types + 1) for s in states[1:]])
        assert p[context == c].sum() + unknown == pytest.approx(1)


def test_asked_pairs_lead_back_to_tokens():
    words = [b"", b"a", b"b", b"c"]
    stream, sizes = np.array([1, 2, 1, 0, 0, 3, 2, 0]), np.array([4, 1, 3])
    contexts = {b"a": 2, b"c": 3}
    need = py.asked(stream, sizes, words, contexts, 5)
    pairs = [(int(need.pair[t]), int(need.context[t])) for t in need.token]
    assert pairs == [(1, 1), (2, 2), (1, 0), (0, 2), (0, 1), (3, 1), (2, 3), (0, 0)]
    assert sorted(need.word.tolist()) == [0, 1, 2, 3] and len(set(zip(need.pair.tolist(), need.context.tolist()))) == len(need.pair)


def test_seating_follows_the_rule():
    """Mean number of tables against the exact distribution, by direct recursion."""
    customers, base, opening, discount = 60, 0.02, 50.0, 0.6
    p = np.zeros(customers + 1)
    p[1] = 1
    for n in range(1, customers):
        t = np.arange(customers + 1)
        chance = opening * base / (opening * base + n - discount * np.minimum(t, n))
        new = np.zeros_like(p)
        new[1:] = p[:-1] * chance[:-1]
        p = p * (1 - chance) + new
    draw = np.random.default_rng(5)
    n = 20_000
    found = py.seated(np.full(n, customers), np.full(n, base), np.full(n, opening), discount, draw)
    assert found.mean() == pytest.approx((p * np.arange(customers + 1)).sum(), rel=0.03)
    assert py.seated(np.array([0, 1, 5_000_000]), np.full(3, 0.1), np.full(3, 9.0), 0.5, draw)[:2].tolist() == [0, 1]


def test_every_word_is_a_context(spark):
    """4,500 words, each always before its own successor: a cap on contexts scores most pairs by the root."""
    pairs = [f"a{i} b{i}" for i in range(4500)]
    rows = [(d, " ".join(pairs[(d * 450 + j) % 4500] for j in range(900))) for d in range(40)]
    found = {r["doc_id"]: r for r in py.scores(spark.createDataFrame(rows, "doc_id long, text string"), block=5000).collect()}
    assert len(found) == 40 and any(r["held_out"] for r in found.values())
    # behind a word that is known the next is nearly certain, so a text takes about half of its words' information
    assert all(r["score"] > 0.75 * r["base_score"] for r in found.values())


def test_asked_words_and_pairs_rise_by_hash_within_a_bucket():
    """Dishes keep the same order, so positions of a block are small steps."""
    words = [b"", *[b"w%d" % i for i in range(40)]]
    stream = np.array([*np.random.default_rng(1).integers(1, 41, 300), 0], np.uint32)
    numbers = py._numbers(words)
    need, ids = py.asked(stream, np.array([len(stream)]), words, numbers, 3), py._hashes(numbers)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    for k in range(3):
        inside = hashes[need.word[need.bounds[k] : need.bounds[k + 1]]]
        assert (inside[1:] > inside[:-1]).all()
        a, b = need.pair_bounds[k], need.pair_bounds[k + 1]
        asked = [(hashes[w], ids[c]) for w, c in zip(need.pair[a:b], need.context[a:b]) if c != py.START]
        assert asked == sorted(asked)
    assert (np.cumsum(py._steps(ids)) == ids).all()


def test_buckets_and_shards_follow_tokens_not_partitions():
    """Each bucket writes to each shard; with as many as partitions, their messages grow with the square."""
    assert py.dealt(9_000_000, py.BLOCK, 12) == py.dealt(9_000_000, py.BLOCK, 211) == (9, 9)
    assert py.dealt(0, py.BLOCK, 211) == (1, 1)
    assert py.dealt(10 * py.BLOCK + 1, py.BLOCK, 4) == (11, 4)


def test_requests_hold_each_word_once_and_follow_buckets(spark, documents):
    made = py.blocks(documents.repartition(5), "doc_id", "text", 10)
    tokens = py._tokens(made)
    assert tokens == sum(sum(r["sizes"]) for r in made.collect())
    asks = py.requests(made, 3)
    assert asks.schema["words"].dataType.simpleString() == "binary"
    held = py.dishes(asks, 2)
    rows = held.collect()
    assert len(rows) == 3 and sum(py._unpack(r["n"]).sum() for r in rows) <= tokens
    opened = held.select("bucket", "ends", "context", "n", "pairs").mapInArrow(py._opened, py.SENT_SCHEMA).count()
    assert opened <= 3 * (2 * 2 + 1)


def test_words_survive_packing():
    for words in ([b""], [b"", b"a"], [b"a", b"", "\u00fc".encode()]):
        assert py._unpack_words(py._pack_words(words)) == words
