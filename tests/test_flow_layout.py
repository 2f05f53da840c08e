"""Levels, places and offsets of flow graphs against plain loops over small graphs."""

import random

import pytest

from flowtally.plans import flow as G


def table(spark, edges):
    rows = [(a, b, float(v), k) for k, (a, b, v) in enumerate(edges)]
    return spark.createDataFrame(rows, "source string, target string, value double, position long").repartition(3)


def longest(edges):
    level = {n: 0 for a, b, *_ in edges for n in (a, b)}
    for _ in level:
        for a, b, *_ in edges:
            level[b] = max(level[b], level[a] + 1)
    deepest, leaving = max(level.values()), {a for a, *_ in edges}
    return {n: x if n in leaving else deepest for n, x in level.items()}


def random_graph(seed, size):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(size), 2))) for _ in range(size * 2)}
    return [(f"n{a:02d}", f"n{b:02d}", rng.randint(1, 40)) for a, b in sorted(pairs)]


def levels_of(spark, edges):
    return {r.name: r.level for r in G.node_levels(table(spark, edges)).collect()}


@pytest.mark.parametrize("seed, size", [(1, 6), (2, 12), (3, 25)])
def test_levels_of_random_graphs(spark, seed, size):
    edges = random_graph(seed, size)
    assert levels_of(spark, edges) == longest(edges)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, staged = [], G.staged
    monkeypatch.setattr(G, "staged", lambda df, label="stage": rounds.append(label) or staged(df, label))
    edges = [(f"n{i:04d}", f"n{i + 1:04d}", 1) for i in range(1000)] + [("n0500", "side", 1), ("side", "end", 1)]
    levels = levels_of(spark, edges)
    assert levels["n0999"] == 999 and levels["side"] == 501 and levels["end"] == levels["n1000"] == 1000
    assert len(rounds) <= 25


@pytest.mark.parametrize(
    "edges",
    [[("a", "b", 1), ("b", "a", 1)], [("a", "a", 1)], [("s", "a", 1), ("a", "b", 1), ("b", "c", 1), ("c", "a", 1)], [("s", "a", 1), ("a", "b", 1), ("b", "a", 1), ("b", "t", 1)]],
)
def test_cycles_are_refused(spark, edges):
    with pytest.raises(ValueError, match="cycle"):
        G.node_levels(table(spark, edges)).collect()


def placed(edges, height, padding, sweeps):
    """Places by loops over levels and nodes, and offsets by sorting each node's links."""
    names = list(dict.fromkeys(n for a, b, _ in edges for n in (a, b)))
    level = longest(edges)
    out = {n: sum(v for a, _, v in edges if a == n) for n in names}
    into = {n: sum(v for _, b, v in edges if b == n) for n in names}
    groups = [[n for n in names if level[n] == x] for x in range(max(level.values()) + 1)]
    groups = [g for g in groups if g]
    value = {n: max(out[n], into[n]) for n in names}
    unit = min((height - (len(g) - 1) * padding) / sum(value[n] for n in g) for g in groups)
    size = {n: value[n] * unit for n in names}
    y = {n: float(k) for g in groups for k, n in enumerate(g)}

    def spread():
        for g in groups:
            g.sort(key=lambda n: (y[n], names.index(n)))
            low = 0.0
            for n in g:
                y[n] = max(y[n], low)
                low = y[n] + size[n] + padding
            high = height
            if low - padding > height:
                for n in reversed(g):
                    y[n] = min(y[n], high - size[n])
                    high = y[n] - padding

    def pull(group, links_of, alpha):
        for n in group:
            links = links_of(n)
            if links:
                mean = sum((y[m] + size[m] / 2) * v for m, v in links) / sum(v for _, v in links)
                y[n] += (mean - y[n] - size[n] / 2) * alpha

    spread()
    alpha = 1.0
    for _ in range(sweeps):
        alpha *= 0.99
        for g in reversed(groups):
            pull(g, lambda n: [(b, v) for a, b, v in edges if a == n], alpha)
        spread()
        for g in groups:
            pull(g, lambda n: [(a, v) for a, b, v in edges if b == n], alpha)
        spread()
    offsets = {}
    for n in names:
        for side, other in ((0, 1), (1, 0)):
            at = 0.0
            for k in sorted((k for k, e in enumerate(edges) if e[side] == n), key=lambda k: (round(y[edges[k][other]], 6), names.index(edges[k][other]))):
                offsets[k, side] = at
                at += edges[k][2] * unit
    return {n: (level[n], y[n], size[n]) for n in names}, offsets


@pytest.mark.parametrize("seed, size, sweeps", [(4, 7, 3), (5, 14, 2), (6, 10, 0)])
def test_places_and_offsets(spark, seed, size, sweeps):
    edges = random_graph(seed, size)
    random.Random(seed).shuffle(edges)
    want, offsets = placed(edges, 300.0, 8.0, sweeps)
    nodes, links = G.flow_layout(table(spark, edges), 300.0, 8.0, sweeps)
    found = {r.name: (r.level, r.y, r.dy) for r in nodes.collect()}
    assert set(found) == set(want)
    for n, (level, y, dy) in want.items():
        assert found[n][0] == level and found[n][1:] == pytest.approx((y, dy), abs=1e-7)
    rows = links.collect()
    assert len(rows) == len(edges)
    for r in rows:
        assert (r.sy, r.ty) == pytest.approx((offsets[r.position, 0], offsets[r.position, 1]), abs=1e-7)


def test_chunks_do_not_matter(spark):
    edges = [(f"a{i:02d}", f"b{(i * 7) % 11:02d}", 1 + i % 5) for i in range(60)]
    want, _ = placed(edges, 500.0, 3.0, 1)
    for parts in ("1", "8", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            nodes, _ = G.flow_layout(table(spark, edges), 500.0, 3.0, 1)
            found = {r.name: r.y for r in nodes.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert found == pytest.approx({n: y for n, (_, y, _) in want.items()}, abs=1e-7)


def test_no_links(spark):
    nodes, links = G.flow_layout(table(spark, []), 100.0)
    assert nodes.collect() == [] and links.collect() == []
