"""Spreadsheets (.xlsx) as a Python data source over the standard library.

``spark.read.format("sheet_xlsx").load(path)``; ``path`` may name a file, or a folder of
files, each of which is a partition.  The first worksheet is read, its first row names the
columns, rows without any cell are skipped, every cell is text.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from glossweave.operators.sheet import COLUMNS

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(reference: str) -> int:
    """``B7`` is column 1."""
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in root.iter(f"{_MAIN}si")]


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = next(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == sheet.get(_LINK))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def raw_rows(path: str) -> Iterator[dict[int, str]]:
    """Rows of the first worksheet as column number -> text, streamed."""
    with zipfile.ZipFile(path) as book:
        shared = _texts(book)
        with book.open(_first_sheet(book)) as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag != f"{_MAIN}row":
                    continue
                row = {}
                for c in e.iter(f"{_MAIN}c"):
                    if c.get("t") == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    else:
                        v = c.find(f"{_MAIN}v")
                        value = None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                    if value is not None:
                        row[column_number(c.get("r"))] = value
                e.clear()
                if row:
                    yield row


class _File(InputPartition):
    def __init__(self, path: str, number: int):
        super().__init__((path, number))


class XlsxReader(DataSourceReader):
    def __init__(self, paths: list[str], names: list[str]):
        self.paths, self.names = paths, names

    def partitions(self):
        return [_File(p, i) for i, p in enumerate(self.paths)]

    def read(self, partition):
        path, number = partition.value
        rows = raw_rows(path)
        header = next(rows, {})
        places = {name: at for at, name in header.items()}
        for n, row in enumerate(rows):
            # rows are in the order of files, then of rows
            yield (number << 40 | n, *[row.get(places[c]) if c in places else None for c in self.names])


class XlsxSource(DataSource):
    @classmethod
    def name(cls):
        return "sheet_xlsx"

    def schema(self):
        from pyspark.sql.types import LongType

        return StructType([StructField("_ord", LongType()), *[StructField(c, StringType()) for c in COLUMNS]])

    def reader(self, schema):
        path = Path(self.options["path"])
        files = [path] if path.is_file() else sorted(path.glob("*.xlsx"))
        return XlsxReader([str(p) for p in files], COLUMNS)


def read_xlsx(spark: SparkSession, path: str):
    spark.dataSource.register(XlsxSource)
    return spark.read.format("sheet_xlsx").load(path)
