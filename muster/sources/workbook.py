"""Sheets of workbooks as tables.

A workbook is a zip of XML parts. ``rows_of`` reads one sheet's cells as text; the
first row with a cell holds the headings. ``load_sheet`` runs it over files that Spark
reads, from any store, a file a task. ``WorkbookSource`` offers the same as a format:

    spark.dataSource.register(WorkbookSource)
    spark.read.format("workbook").option("sheet", "Expected").load(path)
"""

from __future__ import annotations

import glob
import io
import os
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from muster.sources.schemas import SCHEMAS
from muster.sources.tables import conform, snake


def _name(tag: str) -> str:
    return tag.rpartition("}")[2]


def _children(element: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (child for child in element.iter() if _name(child.tag) == name)


def _text(element: ElementTree.Element) -> str:
    """Text of a string item: its runs in turn, without phonetic hints."""
    parts = []
    for child in element:
        if _name(child.tag) == "t":
            parts.append(child.text or "")
        elif _name(child.tag) == "r":
            parts += [t.text or "" for t in child if _name(t.tag) == "t"]
    return "".join(parts)


def _column(reference: str) -> int:
    """Number of the column of a cell, from its letters."""
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - ord("A") + 1
    return number - 1


def _sheet_part(book: zipfile.ZipFile, sheet: str) -> str:
    """Name of the part that holds a sheet; an unknown sheet stops with the names there are."""
    named = {}
    for entry in _children(ElementTree.fromstring(book.read("xl/workbook.xml")), "sheet"):
        named[entry.get("name")] = next(v for k, v in entry.attrib.items() if _name(k) == "id" and "}" in k)
    if sheet not in named:
        raise ValueError(f"no sheet {sheet!r}, there are {sorted(named)}")
    for entry in _children(ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")), "Relationship"):
        if entry.get("Id") == named[sheet]:
            target = entry.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"sheet {sheet!r} has no part")


def _value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return next((_text(item) for item in _children(cell, "is")), None)
    text = next((v.text for v in _children(cell, "v")), None)
    if text is None or kind == "e":  # an error value is a missing one
        return None
    if kind == "s":
        return shared[int(text)]
    if kind == "b":
        return "TRUE" if text == "1" else "FALSE"
    if kind == "n":
        number = float(text)
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)
    return text


def rows_of(content: bytes, sheet: str) -> Iterator[list[str | None]]:
    """Rows of a sheet as text, headings first, each as wide as the headings; rows
    without a value are left out. Whole numbers come without a decimal point, dates as
    the numbers they are stored as."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            items = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = [_text(item) for item in items if _name(item.tag) == "si"]
        width = None
        with book.open(_sheet_part(book, sheet)) as part:
            for _, row in ElementTree.iterparse(part):
                if _name(row.tag) != "row":
                    continue
                cells = {}
                for place, cell in enumerate(c for c in row if _name(c.tag) == "c"):
                    at = _column(cell.get("r")) if cell.get("r") else place
                    cells[at] = _value(cell, shared)
                row.clear()
                if all(v is None or v == "" for v in cells.values()):
                    continue
                if width is None:
                    width = max(at for at, v in cells.items() if v) + 1
                yield [cells.get(at) for at in range(width)]


def _by_heading(content: bytes, sheet: str, wanted: list[str], file: str) -> Iterator[list[str | None]]:
    """Rows with the wanted columns, found by their headings."""
    rows = rows_of(content, sheet)
    found = {snake(name): at for at, name in enumerate(next(rows, [])) if name}
    missing = [name for name in wanted if name not in found]
    if missing:
        raise ValueError(f"{file}, sheet {sheet!r}: missing columns {missing}")
    for row in rows:
        yield [row[found[name]] for name in wanted]


def load_sheet(spark: SparkSession, path: str, sheet: str, table: str) -> DataFrame:
    """A table from one sheet of the workbooks at ``path``. Other columns of the sheet are
    dropped, a missing one stops the job. Workbooks are read whole, one a task."""
    names = SCHEMAS[table].names

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                yield pd.DataFrame(list(_by_heading(content, sheet, names, file)), columns=names, dtype=object)

    books = spark.read.format("binaryFile").load(path).select("path", "content")
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return conform(books.mapInPandas(read, text), table)


class _Book(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], sheet: str, names: list[str]):
        self._paths, self._sheet, self._names = paths, sheet, names

    def partitions(self) -> list[InputPartition]:
        return [_Book(path) for path in self._paths]

    def read(self, partition: _Book) -> Iterator[tuple]:
        with open(partition.path, "rb") as book:
            content = book.read()
        for row in _by_heading(content, self._sheet, self._names, partition.path):
            yield tuple(row)


class WorkbookSource(DataSource):
    """The format ``workbook``: options ``sheet`` and ``path``, a workbook, a folder or a
    pattern of files that the driver and the executors see under the same name. Without a
    schema, the columns are the headings of the first workbook, as text."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _paths(self) -> list[str]:
        path = self.options["path"].removeprefix("file://").removeprefix("file:")
        found = sorted(glob.glob(os.path.join(path, "*.xlsx")) if os.path.isdir(path) else glob.glob(path))
        if not found:
            raise FileNotFoundError(path)
        return found

    def schema(self) -> T.StructType:
        with open(self._paths()[0], "rb") as book:
            headings = next(rows_of(book.read(), self.options["sheet"]), [])
        return T.StructType([T.StructField(snake(name), T.StringType()) for name in headings if name])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self._paths(), self.options["sheet"], schema.names)
