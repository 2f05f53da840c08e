"""Sheets of XLSX workbooks as a Spark data source, one partition per sheet.

Which sheets are read is settled before any of them is opened: a partition names a workbook
and a sheet, and its task streams that sheet's XML, row by row, out of the archive. Only the
workbook's table of shared texts is held whole. Every cell becomes text, as in the CSV
scans, and is typed later: numbers as they are written, truth values as TRUE and FALSE,
dates, which a workbook stores as numbers under a date format, as yyyy-MM-dd (with the time
behind it where there is one). Empty cells and errors are NULL.

This is the one reader that runs in Python workers; files are opened through pyarrow, so any
folder that it and all executors reach will do.
"""

from __future__ import annotations

import datetime
import json
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.text import blank_to_null, trimmed
from ..operators.columns import quoted
from .files import text_schema

# Names of the parts and tags of the file format, and its built-in date formats.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
DATE_FORMATS = {*range(14, 23), *range(45, 48)}

PLACES = StructType().add("sheet", "integer").add("src_file", "string").add("src_block", "long").add("src_row", "long")


class Workbook:
    """Sheets of one open archive."""

    def __init__(self, archive: zipfile.ZipFile):
        self.archive = archive
        book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
        properties = book.find(f"{MAIN}workbookPr")
        early = properties is not None and properties.get("date1904") in ("1", "true")
        self.first_day = datetime.datetime(1904, 1, 1) if early else datetime.datetime(1899, 12, 30)
        links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in links.iter(f"{PACKAGE}Relationship")}
        self.sheets = [(s.get("name"), self._part(targets[s.get(LINK)])) for s in book.iter(f"{MAIN}sheet")]

    @staticmethod
    def _part(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def texts(self) -> list[str]:
        """The table of shared texts; runs of one text are put together."""
        if "xl/sharedStrings.xml" not in self.archive.namelist():
            return []
        out = []
        with self.archive.open("xl/sharedStrings.xml") as stream:
            for _, element in ElementTree.iterparse(stream):
                if element.tag == f"{MAIN}si":
                    out.append(_text_of(element))
                    element.clear()
        return out

    def date_styles(self) -> set[int]:
        """Numbers of the cell styles that show a number as a date."""
        if "xl/styles.xml" not in self.archive.namelist():
            return set()
        styles = ElementTree.fromstring(self.archive.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")): f.get("formatCode") for f in styles.iter(f"{MAIN}numFmt")}
        dated = {n for n, code in own.items() if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower()))}
        cells = styles.find(f"{MAIN}cellXfs")
        formats = [int(x.get("numFmtId", "0")) for x in cells] if cells is not None else []
        return {k for k, n in enumerate(formats) if n in DATE_FORMATS or n in dated}

    def rows(self, part: str) -> Iterator[tuple[int, list[str | None]]]:
        """(row number, texts of its cells) of a sheet, as its XML goes by."""
        texts, dated = self.texts(), self.date_styles()
        with self.archive.open(part) as stream:
            number, parents = 0, []
            for event, element in ElementTree.iterparse(stream, events=("start", "end")):
                if event == "start":
                    parents.append(element)
                    continue
                parents.pop()
                if element.tag != f"{MAIN}row":
                    continue
                number = int(element.get("r", number + 1))
                cells: list[str | None] = []
                for cell in element.iter(f"{MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = self._value(cell, texts, dated)
                yield number, cells
                if parents:
                    parents[-1].remove(element)  # rows read are let go

    def _value(self, cell: ElementTree.Element, texts: list[str], dated: set[int]) -> str | None:
        kind, value = cell.get("t", "n"), cell.find(f"{MAIN}v")
        if kind == "inlineStr":
            return _text_of(cell)
        if value is None or value.text is None or kind == "e":
            return None
        if kind == "s":
            return texts[int(value.text)]
        if kind == "b":
            return "TRUE" if value.text == "1" else "FALSE"
        if kind == "n" and int(cell.get("s", "0")) in dated:
            when = self.first_day + datetime.timedelta(seconds=round(float(value.text) * 86_400))
            return when.date().isoformat() if when.time() == datetime.time() else when.isoformat(" ")
        return value.text


def _text_of(element: ElementTree.Element) -> str:
    """Texts of the runs of a cell, without hints on how to pronounce them."""
    hints = {id(t) for h in element.iter(f"{MAIN}rPh") for t in h.iter(f"{MAIN}t")}
    return "".join(t.text or "" for t in element.iter(f"{MAIN}t") if id(t) not in hints)


def _column(place: str) -> int:
    """0 for A1, 27 for AB7."""
    out = 0
    for letter in re.match(r"[A-Z]+", place)[0]:
        out = out * 26 + ord(letter) - 64
    return out - 1


def _opened(path: str):
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


class Sheet(InputPartition):
    def __init__(self, path: str, sheet: int | str):
        self.path, self.sheet = path, sheet


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: StructType, options: Mapping[str, str]):
        self.width = len(schema) - len(PLACES)
        self.wanted = [tuple(s) for s in json.loads(options["sheets"])]
        self.header = options.get("header", "true").lower() == "true"

    def partitions(self) -> Sequence[InputPartition]:
        return [Sheet(path, sheet) for path, sheet in self.wanted]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with _opened(partition.path) as file, zipfile.ZipFile(file) as archive:
            book = Workbook(archive)
            names = [name for name, _ in book.sheets]
            if isinstance(partition.sheet, int):
                if not 1 <= partition.sheet <= len(names):
                    raise ValueError(f"{partition.path} has {len(names)} sheets, none is number {partition.sheet}")
                number = partition.sheet
            elif partition.sheet in names:
                number = names.index(partition.sheet) + 1
            else:
                raise ValueError(f"{partition.path} has no sheet {partition.sheet!r}")
            first = self.header
            for row, cells in book.rows(book.sheets[number - 1][1]):
                if first:
                    first = False
                    continue
                cells = (cells + [None] * self.width)[: self.width]
                yield (*cells, number, partition.path, 0, row)


class WorkbookSource(DataSource):
    """spark.read.format("workbook"); `sheets` is a JSON list of (path, sheet number from 1 or name)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        raise ValueError("name the columns of the sheets, see read_workbooks")

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(schema, self.options)


def read_workbooks(
    spark: SparkSession, sheets: Sequence[tuple[str, int | str, int]], names: Sequence[str], header: bool = True, clean: bool = True
) -> DataFrame:
    """Rows of (workbook, sheet, year), columns by position under the given names, like `files.read_sheets`.

    Adds sheet, year, src_file, src_block and src_row, the row's number in its sheet.
    """
    spark.dataSource.register(WorkbookSource)
    schema = StructType([*text_schema(names), *PLACES])
    raw = spark.read.format("workbook").schema(schema).option("header", str(header))
    listed = dict.fromkeys((path, sheet) for path, sheet, _ in sheets)
    tables = []
    for year in dict.fromkeys(y for _, _, y in sheets):
        chosen = [s for s in listed if (*s, year) in {tuple(x) for x in sheets}]
        rows = raw.option("sheets", json.dumps(chosen)).load()
        values = [blank_to_null(trimmed(quoted(c))).alias(c) if clean else quoted(c) for c in names]
        tables.append(rows.select(*values, "sheet", F.lit(year).alias("year"), "src_file", "src_block", "src_row"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_RELS = "application/vnd.openxmlformats-package.relationships+xml"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_workbook(path: str, sheets: Mapping[str, Sequence[Sequence[object]]]) -> str:
    """A small workbook of {sheet name: rows}, numbers as numbers and the rest as text; for deliveries and tests."""
    main = MAIN.strip("{}")
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rsplit("/", 1)[0])
    with store.open_output_stream(place) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
        names = "".join(f'<sheet name={quoteattr(n)} sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
        links = "".join(f'<Relationship Id="rId{k}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k, _ in enumerate(sheets, 1))
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_TYPE}.worksheet+xml"/>' for k, _ in enumerate(sheets, 1))
        book = f'<Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/><Default Extension="rels" ContentType="{_RELS}"/>'
        archive.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">{book}{kinds}</Types>')
        first = f'<Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/>'
        archive.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{PACKAGE.strip("{}")}">{first}</Relationships>')
        archive.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{main}" xmlns:r="{_OFFICE}"><sheets>{names}</sheets></workbook>')
        archive.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{PACKAGE.strip("{}")}">{links}</Relationships>')
        for k, rows in enumerate(sheets.values(), 1):
            with archive.open(f"xl/worksheets/sheet{k}.xml", "w") as sheet:
                sheet.write(f'{_HEAD}<worksheet xmlns="{main}"><sheetData>'.encode())
                for row in rows:
                    sheet.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                sheet.write(b"</sheetData></worksheet>")
    return path


def _cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c><v>{value}</v></c>"
    return f"<c t=\"inlineStr\"><is><t xml:space=\"preserve\">{escape(str(value))}</t></is></c>"
