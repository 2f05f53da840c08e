"""Proposals for unmatched names against all pairs, compared one by one."""

import random

import pytest
from pyspark.sql import functions as F

from flowtally.operators import matching as M

COUNTRIES = [
    "Côte d'Ivoire", "Slovakia", "Slovenia", "Republic of Moldova", "Moldova", "Congo, Dem. Rep.", "Congo, Rep.", "Türkiye", "São Tomé and Príncipe",
    "Russian Federation", "North Macedonia", "Niger", "Nigeria", "Guinea", "Guinea-Bissau", "Equatorial Guinea", "Ø", "Straße",
]


def gram_set(text):
    padded = f" {text} "
    return {padded[k : k + 3] for k in range(len(padded) - 2)} if text else set()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def table(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def folded(spark, names):
    return {r.name: r.f for r in table(spark, names).select("name", M.folded("name").alias("f")).collect()}


def test_folding(spark):
    names = ["Côte D'ivoire", "  ŁÓDŹ ", "Straße", "Æbelø", "Việt Nam", "Cotê", "中国", "--"]
    assert list(folded(spark, names).values()) == ["cote d ivoire", "lodz", "strasse", "aebelo", "viet nam", "cote", "中国", ""]


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8, 1.0])
def test_all_pairs(spark, least):
    rng = random.Random(7)
    odd = ["".join(rng.choice("aabeinorst -") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    names = sorted({n.upper().replace("E", "É", 1) for n in COUNTRIES} | {n[:-1] + "x" for n in COUNTRIES} | set(odd))
    known = sorted({*COUNTRIES, *odd[::2]})
    f = folded(spark, {*names, *known})
    want = {}
    for a in names:
        for b in known:
            x, y = gram_set(f[a]), gram_set(f[b])
            likeness = 2 * len(x & y) / (len(x) + len(y)) if x or y else 0
            if x and y and likeness >= least:
                want[a, b] = (pytest.approx(likeness), distance(f[a], f[b]))
    got = {(r.name, r.proposal): (r.likeness, r.distance) for r in M.alike_names(table(spark, names), table(spark, known), least).collect()}
    assert got == want


def test_report(spark):
    names = ["Slovakia", "Slovakya", "Slovakya", "Cote D'ivoire", "XXXXXX", None, "Nigerr"]
    dimension = table(spark, COUNTRIES).withColumn("iso", F.lit("x"))
    rows = M.unmatched_names(table(spark, names), "name", dimension, "name", most=2).orderBy("name", "rank").collect()
    found = [(r.name, r.n_rows, r.rank, r.proposal) for r in rows]
    assert found[0] == ("Cote D'ivoire", 1, 1, "Côte d'Ivoire") and rows[0].likeness == 1.0 and rows[0].distance == 0
    assert [x for x in found if x[0] == "Slovakya"][0] == ("Slovakya", 2, 1, "Slovakia")
    assert ("XXXXXX", 1, None, None) in found and ("Nigerr", 1, 1, "Niger") in found
    assert all(x[0] not in ("Slovakia", None) for x in found) and max(x[2] or 0 for x in found) <= 2


def test_empty(spark):
    assert M.unmatched_names(table(spark, []), "name", table(spark, COUNTRIES), "name").collect() == []
    assert [r.proposal for r in M.unmatched_names(table(spark, ["a"]), "name", table(spark, []), "name").collect()] == [None]
