"""Published results against raw deliveries, where the environment names both.

GOLDEN_STAFF_RAW and GOLDEN_STAFF: deliveries of representatives (a path or pattern) and the
published table by operation. GOLDEN_RETURNS_RAW and GOLDEN_TYPES: deliveries of returns with
continuation rows, and the published cube by year and type.
"""

import csv
import os
from collections import defaultdict

import pytest

from flowtally.functions.nulls import matches
from flowtally.plans import deliveries as D
from flowtally.session import staged
from flowtally.sources.files import read_rows


def named(*variables):
    found = [os.environ.get(v) for v in variables]
    if not all(found):
        pytest.skip(f"{' or '.join(variables)} not set")
    return found


def published(path):
    with open(path, encoding="utf-8-sig", newline="") as file:
        return list(csv.DictReader(file))


def test_representatives_by_operation(spark):
    raw, golden = named("GOLDEN_STAFF_RAW", "GOLDEN_STAFF")
    rows = D.representatives(read_rows(spark, raw, D.REPRESENTATIVE_COLUMNS)).collect()
    number = lambda x: None if x in ("", "NA", None) else float(x)
    want = sorted((r["ROID"], r["DATE"], number(r["N_FX_STAFF"])) for r in published(golden))
    day = lambda d: d and d.strftime("%d/%m/%Y")
    assert sorted(((r.op_id, day(r.op_date), r.n_staff) for r in rows), key=str) == sorted(want, key=str)


def test_people_and_operations_by_year_and_type(spark):
    raw, golden = named("GOLDEN_RETURNS_RAW", "GOLDEN_TYPES")
    rows = staged(read_rows(spark, raw, D.RETURN_COLUMNS, overflow="overflow"), "golden")
    people, operations = defaultdict(float), defaultdict(set)
    for r in D.tidy_returns(rows).where(~matches("op_id", "^$")).collect():
        people[r.op_date.year, r.op_type] += r.n
        operations[r.op_date.year, r.op_type].add((r.op_id, r.op_date))
    cells = {(int(r["YEAR"]), r["KEY"]): r for r in published(golden)}
    assert people
    for (year, kind), n in people.items():
        assert float(cells[year, "Number of deported people"][kind]) == n
        assert float(cells[year, "Number of operations"][kind]) == len(operations[year, kind])
