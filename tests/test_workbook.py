"""Sheets of workbooks give the rows of the same sheets as CSV."""

import datetime
import zipfile
from xml.sax.saxutils import escape

import pytest

from flowtally.sources import files as S
from flowtally.sources import workbook as W

HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(k):
    out = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def cell(at, value, shared):
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime.datetime):
        days = (value - datetime.datetime(1899, 12, 30)) / datetime.timedelta(days=1)
        return f'<c r="{at}" s="1"><v>{days!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{at}"><v>{value}</v></c>'
    if value.startswith("="):
        return f'<c r="{at}" t="str"><f>{escape(value[1:])}</f><v>made</v></c>'
    if value.startswith("#"):
        return f'<c r="{at}" t="e"><v>{value}</v></c>'
    if len(value) % 2:
        shared.append(value)
        return f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
    return f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'


def write(path, sheets, gap=0):
    """A workbook of {name: rows}; `gap` rows are left out ahead of the second one."""
    shared = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for k, rows in enumerate(sheets.values(), 1):
            lines = []
            for i, row in enumerate(rows, 1):
                i += gap if i > 1 else 0
                lines.append(f'<row r="{i}">{"".join(cell(f"{letters(j)}{i}", v, shared) for j, v in enumerate(row))}</row>')
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"{HEAD}<worksheet {NS}><sheetData>{''.join(lines)}</sheetData></worksheet>")
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{HEAD}<workbook {NS} xmlns:r="{REL}"><workbookPr/><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{REL}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        texts = "".join(f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r><rPh sb='0' eb='1'><t>hint</t></rPh></si>" for s in shared)
        z.writestr("xl/sharedStrings.xml", f"{HEAD}<sst {NS}>{texts}</sst>")
        z.writestr("xl/styles.xml", f'{HEAD}<styleSheet {NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
    return str(path)


def test_rows_equal_those_of_csv_sheets(spark, tmp_path):
    header, rows = ["id", "origin", "n"], [["R1", "AT & <x>", 5], ["R22", None, 2.5], [None, "ÄÖ ", 7], ["R4", "x", None]]
    book = write(tmp_path / "b.xlsx", {"2001": [header, *rows], "2002": [header, rows[0]]})
    for k, body in ((1, rows), (2, rows[:1])):
        folder = tmp_path / "csv" / f"sheet={k}"
        folder.mkdir(parents=True)
        lines = [",".join("" if v is None else str(v) for v in r) for r in [header, *body]]
        (folder / "part.csv").write_text("\n".join(lines) + "\n")
    want = S.read_sheets(spark, str(tmp_path / "csv"), header, {2001: 1, 2002: 2})
    got = W.read_workbooks(spark, [(book, 1, 2001), (book, 2, 2002)], header)
    columns = [*header, "sheet", "year"]
    assert got.columns == want.columns
    plain = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert plain(got) == plain(want)
    assert [r.src_row for r in got.where("sheet = 1").orderBy("src_row").collect()] == [2, 3, 4, 5]
    assert got.rdd.getNumPartitions() == 2


def test_kinds_of_cells(spark, tmp_path):
    day, noon = datetime.datetime(2020, 2, 29), datetime.datetime(2021, 12, 31, 12, 30)
    book = write(tmp_path / "b.xlsx", {"s": [["h"], [True, False, day, noon, "=A1", "#N/A", 1e-05, "odd"]]}, gap=4)
    names = list("abcdefgh")
    (row,) = W.read_workbooks(spark, [(book, "s", 2020)], names).collect()
    assert tuple(row)[:8] == ("TRUE", "FALSE", "2020-02-29", "2021-12-31 12:30:00", "made", None, "1e-05", "odd")
    assert (row.sheet, row.year, row.src_file, row.src_row) == (1, 2020, book, 6)


def test_sheets_are_chosen_before_reading(spark, tmp_path):
    book = write(tmp_path / "b.xlsx", {"a": [["h"], ["one"]], "b": [["h"], ["two"]], "broken": [["h"]]})
    with zipfile.ZipFile(book, "a") as z:
        z.writestr("xl/worksheets/sheet3.xml", "this is no sheet")
    assert [r.h for r in W.read_workbooks(spark, [(book, "b", 1)], ["h"]).collect()] == ["two"]
    for sheet in (4, "none"):
        with pytest.raises(Exception, match="sheet"):
            W.read_workbooks(spark, [(book, sheet, 1)], ["h"]).collect()


def test_columns_beyond_and_missing_and_no_header(spark, tmp_path):
    book = write(tmp_path / "b.xlsx", {"a": [["x", "y", "z"], ["w"]], "empty": []})
    rows = W.read_workbooks(spark, [(book, 1, 1), (book, 2, 2)], ["a", "b"], header=False).orderBy("src_row").collect()
    assert [(r.a, r.b) for r in rows] == [("x", "y"), ("w", None)]


def test_wide_sheets_and_long_ones(spark, tmp_path):
    book = write(tmp_path / "b.xlsx", {"a": [[f"c{j}" for j in range(60)], *[[i * j for j in range(60)] for i in range(300)]]})
    names = [f"c{j}" for j in range(60)]
    rows = W.read_workbooks(spark, [(book, 1, 1)], names).orderBy("src_row").collect()
    assert len(rows) == 300 and rows[17].c59 == str(17 * 59)
