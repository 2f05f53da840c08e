import math

import numpy as np
import pytest

from flowtally.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def usable(vectors):
    return [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def brute(vectors):
    """Grid, exact deviations, covariance and its eigenvectors by plain means."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in usable(vectors)]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    near = np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(near.T @ near / n)
    return near, deviations, values[::-1], axes[:, ::-1]


def compare(rows, vectors, count):
    near, deviations, values, axes = brute(vectors)
    rows = sorted(rows, key=lambda r: (r.vec_id, r.component))
    width = min(count, near.shape[1])
    assert len(rows) == len(near) * width
    assert [r.deviation for r in rows[::width]] == deviations
    assert {r.n for r in rows} == {len(near)}
    got = np.array([math.nan if r.whitened is None else r.whitened for r in rows]).reshape(len(near), width)
    share = np.array([r.explained for r in rows[:width]])
    live = values[:width] > values[0] * 1e-12
    assert np.isnan(got[:, ~live]).all() and not np.isnan(got[:, live]).any()
    np.testing.assert_allclose(share, np.where(live, values[:width] / values.sum(), 0), rtol=1e-6, atol=1e-15)
    cov = got[:, live].T @ got[:, live] / len(near)
    assert np.abs(cov - np.eye(live.sum())).max() < 1e-8
    assert {r.identity_error for r in rows}.pop() < 1e-8 and len({r.identity_error for r in rows}) == 1
    want = (near @ axes[:, :width])[:, live] / np.sqrt(values[:width][live])
    gaps = np.abs(np.diff(values[: width + 1])) if len(values) > width else np.append(np.abs(np.diff(values)), 1)
    for k in np.flatnonzero(live):
        if min(gaps[k], gaps[k - 1] if k else 1) > 1e-6 * values[0]:  # equal variances have no axes of their own
            sign = np.sign(want[:, k] @ got[:, k])
            np.testing.assert_allclose(sign * got[:, k], want[:, k], atol=1e-6)


def test_given_vectors(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = [r.embedding for r in table.orderBy("vec_id").collect()]
    compare(whitening.whitened(table).collect(), vectors, 32)


@pytest.mark.parametrize("kind", ["constant entry", "few rows", "one row", "repeated entries", "wide scales"])
def test_without_variance(spark, kind):
    rng = np.random.default_rng(5)
    size = {"few rows": 4, "one row": 1}.get(kind, 300)
    values = rng.normal(size=(size, 6))
    if kind == "constant entry":
        values[:, 2] = 0.25
    if kind == "repeated entries":
        values[:, 4] = values[:, 1]
    if kind == "wide scales":
        values *= np.array([3e3, 400, 30, 1, 0.2, 0.05])
    vectors = values.astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(3)
    rows = whitening.whitened(df, components=5).collect()
    if kind == "one row":
        assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(1, 0, None, 0.0, 0.0)] * 5
    else:
        compare(rows, vectors, 5)


def test_odd_rows(spark):
    good = [[0.5, 1.0], [1.5, -2.0], [2.5, 0.0], [1.5, -2.0]]
    odd = [None, [None, 1.0], [math.nan, 1.0], [1.0, math.inf], [], [1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, "x") for i, v in enumerate(good + odd)] + [(None, good[0], "y"), (0, good[0], "z")]
    df = spark.createDataFrame(rows, SCHEMA + ", component string")
    got = whitening.whitened(df).collect()
    vectors = [*good, good[0], good[0]]
    near, deviations, values, _ = brute(vectors)
    assert sorted(r.vec_id for r in got if r.vec_id is not None) == sorted([0, 0, 0, 0, 1, 1, 2, 2, 3, 3])
    assert sorted(r.deviation for r in got) == sorted(deviations * 2)
    assert np.allclose(sorted({r.explained for r in got}), sorted(values / values.sum()))
    assert {r.n for r in got} == {6} and len({tuple(sorted(r.asDict())) for r in got}) == 1


def test_very_large_entries(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.deviation for r in got if r.vec_id == 1} == {None} and all(math.isfinite(r.explained) for r in got)


def test_empty_table(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []


def test_triangular_solve():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(70, 70))) + 9 * np.eye(70)
    rows = rng.normal(size=(5, 70))
    assert np.allclose(whitening.solved(rows, r) @ r, rows)


def test_order_and_partitions_do_not_matter(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").limit(100)
    one = {(r.vec_id, r.component): r for r in whitening.whitened(table.coalesce(1)).collect()}
    for r in whitening.whitened(table.repartition(7)).collect():
        other = one[r.vec_id, r.component]
        assert r.deviation == other.deviation and abs(abs(r.whitened) - abs(other.whitened)) < 1e-7
