"""Columns by name, whatever their order; what does not fit is kept with its reason."""

import gzip

import pytest

from flowtally.plans import deliveries as D
from flowtally.sources import headers as H
from flowtally.sources.files import ROW_ORDER, read_rows

COLUMNS = {"id": ["RO-ID"], "origin": ["MS/SAC", "State"], "n": []}


def write(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def rows_of(scan):
    return sorted((r.id or "", r.origin, r.n) for r in scan.rows.collect())


def test_orders_and_spellings(spark, tmp_path):
    write(tmp_path, "d/a.csv", "id,origin,n\n1,AT,5\n2,BE,6\n")
    write(tmp_path, "d/b.csv", "﻿origin,N ,id\nCZ,7,3\n")
    write(tmp_path, "d/c c.csv", '"ro-id","MS/\rSAC",n\r\n4,DE,8\r\n')
    write(tmp_path, "d/d.csv.gz", gzip.compress(b"n,State,id\n9,EE,5\n"))
    write(tmp_path, "d/e.csv", "id,origin,n\n")
    write(tmp_path, "d/_SUCCESS", "")
    columns = COLUMNS | {"origin": ["MS/ SAC", "State"]}
    scan = H.scan_by_header(spark, str(tmp_path / "d"), columns)
    assert rows_of(scan) == [("1", "AT", "5"), ("2", "BE", "6"), ("3", "CZ", "7"), ("4", "DE", "8"), ("5", "EE", "9")]
    assert scan.rows.columns == ["id", "origin", "n", "src_file", "src_block", "src_row"]
    assert scan.quarantine.collect() == []
    groups = H.layouts(spark, str(tmp_path / "d/*"), columns)
    assert sorted(len(f) for f in groups.values()) == [1, 1, 3] or sorted(len(f) for f in groups.values()) == [1, 1, 1, 3]


def test_what_does_not_fit_goes_to_quarantine(spark, tmp_path):
    write(tmp_path, "good.csv", "id,origin,n\n1,AT,5\n")
    write(tmp_path, "strange.csv", "id,origin,n,Total\n2,BE,6,6\n3,BE,7,7\n")
    write(tmp_path, "twice.csv", "id,State,MS/SAC,n\n4,A,B,1\n")
    write(tmp_path, "short.csv", "id,n\r\n5,1\r\n")
    write(tmp_path, "empty.csv", "")
    scan = H.scan_by_header(spark, str(tmp_path / "*.csv"), COLUMNS)
    assert rows_of(scan) == [("1", "AT", "5")]
    lines = [(r.reason, r.line) for r in scan.quarantine.orderBy("src_file", *ROW_ORDER).collect()]
    assert lines == [
        ("missing columns: origin", "id,n"), ("missing columns: origin", "5,1"),
        ("unknown columns: Total", "id,origin,n,Total"), ("unknown columns: Total", "2,BE,6,6"), ("unknown columns: Total", "3,BE,7,7"),
        ("columns named twice: origin", "id,State,MS/SAC,n"), ("columns named twice: origin", "4,A,B,1"),
    ]


def test_optional_and_ignored_columns(spark, tmp_path):
    write(tmp_path, "a.csv", ",id,Remarks,n\nx,1,old,5\n")
    write(tmp_path, "b.csv", "id,origin,n\n2,BE,6\n")
    scan = H.scan_by_header(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], COLUMNS, required=["id"], ignore=["", "remarks"])
    assert rows_of(scan) == [("1", None, "5"), ("2", "BE", "6")]


def test_only_the_first_lines_of_a_file_are_read_for_its_header(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "HEAD_BYTES", 40)
    path = write(tmp_path, "a.csv", "id,origin,n\n" + "1,AT,5\n" * 1000)
    assert H.read_header(spark, path) == ["id", "origin", "n"]


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        H.scan_by_header(spark, str(tmp_path / "*.csv"), COLUMNS)
    (tmp_path / "folder").mkdir()
    scan = H.scan_by_header(spark, str(tmp_path / "folder"), COLUMNS)
    assert scan.rows.collect() == [] and scan.quarantine.collect() == []


def test_tables_by_heading_equal_those_by_position(spark, tmp_path):
    rows = [("RO-1", "01/02/2020", "DEU", '"1,234.50 €"'), ("RO-2", "02/02/2020", "AUT", "€ -"), ("RO-ID", "Date", "MS/SAC", "TOTAL PAID")]
    by_position = write(tmp_path, "p.csv", "RO-ID,Date,MS/SAC,TOTAL PAID\n" + "".join(",".join(r) + "\n" for r in rows))
    by_name = write(tmp_path, "n.csv", "TOTAL PAID,MS/SAC,RO-ID,Date\n" + "".join(",".join((r[3], r[2], r[0], r[1])) + "\n" for r in rows))
    want = D.costs(read_rows(spark, by_position, D.COST_COLUMNS)).collect()
    assert sorted(map(str, D.costs(H.scan_by_header(spark, by_name, D.COST_HEADERS).rows).collect())) == sorted(map(str, want))
    staff = write(tmp_path, "s.csv", "RO Date,Frontex Representative on Board,RO-ID\n03/04/2020,2,RO-5\n")
    (row,) = D.representatives(H.scan_by_header(spark, staff, D.REPRESENTATIVE_HEADERS).rows).collect()
    assert (row.op_id, str(row.op_date), row.n_staff) == ("RO-5", "2020-04-03", 2.0)
