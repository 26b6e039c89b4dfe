"""Workbook files as a cell table.

Spark lists and ships the files (binaryFile, so any file system it can read);
each task turns its workbooks into cells. Lock files are skipped, sheets can be
pruned by name before they are parsed, and a file or sheet that cannot be read
becomes an error row instead of failing the job.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerbench.constants import EMPTY_CELL_TEXTS
from peerbench.operators.ordering import numbered

CELLS = (
    "file string, file_ord string, sheet string, sheet_ord int, row_idx bigint, col_idx int, "
    "value string, error string"
)
_COLUMNS = [c.split()[0] for c in CELLS.split(", ")]
_BATCH = 50_000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _column_number(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isdigit():
            break
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_text(si) for si in root.iter(f"{_MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dated = set(_DATE_FORMATS)
    for f in root.iter(f"{_MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", ""))
        if re.search(r"[ymdhs]", code, re.IGNORECASE):
            dated.add(int(f.get("numFmtId")))
    styles = root.find(f"{_MAIN}cellXfs")
    if styles is None:
        return set()
    return {i for i, x in enumerate(styles) if int(x.get("numFmtId", 0)) in dated}


def _sheets(book: zipfile.ZipFile) -> Iterator[tuple[int, str, str]]:
    rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    for i, s in enumerate(root.iter(f"{_MAIN}sheet")):
        part = target[s.get(f"{_REL}id")]
        yield i, s.get("name"), part[1:] if part.startswith("/") else f"xl/{part}"


def _value(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        out = _text(cell)
    else:
        v = cell.find(f"{_MAIN}v")
        if v is None or v.text is None:
            return None
        out = v.text
        if kind == "s":
            out = shared[int(out)]
        elif kind == "b":
            out = "True" if out == "1" else "False"
        elif kind in (None, "n") and int(cell.get("s", -1)) in dates:
            out = str(datetime(1899, 12, 30) + timedelta(days=float(out)))
    return None if out in EMPTY_CELL_TEXTS else out


def _sheet_cells(part, shared: list[str], dates: set[int]) -> Iterator[tuple]:
    """(row, column, value, error) of each filled cell; one that can't be read is an error of its own."""
    row = col = -1
    for event, node in ElementTree.iterparse(part, events=("start", "end")):
        if event == "start" and node.tag == f"{_MAIN}row":
            row = int(node.get("r", row + 2)) - 1
            col = -1
        elif event == "end" and node.tag == f"{_MAIN}c":
            ref = node.get("r")
            col = _column_number(ref) if ref else col + 1
            try:
                value = _value(node, shared, dates)
            except (ValueError, IndexError, OverflowError) as e:
                yield row, col, None, f"{type(e).__name__}: {e}"
                continue
            if value is not None:
                yield row, col, value, None
        elif event == "end" and node.tag == f"{_MAIN}row":
            node.clear()


def _workbook_rows(path: str, content: bytes, words: Sequence[str] | None) -> Iterator[tuple]:
    file = path.rsplit("/", 1)[-1]
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        shared, dates, sheets = _shared(book), _date_styles(book), list(_sheets(book))
    except Exception as e:
        yield file, path, None, None, None, None, None, f"{type(e).__name__}: {e}"
        return
    for i, name, part in sheets:
        if words is not None and not any(w in name.lower() for w in words):
            continue
        try:
            with book.open(part) as f:
                cells = list(_sheet_cells(f, shared, dates))
        except Exception as e:  # a sheet that can't be read as a whole gives no cells
            yield file, path, name, i, None, None, None, f"{type(e).__name__}: {e}"
            continue
        for cell in cells:
            yield file, path, name, i, *cell


def list_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Workbook files below a path, lock files left out: path, length, content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.where(~F.element_at(F.split("path", "/"), -1).startswith("~$"))


def read_workbooks(
    spark: SparkSession, path: str, sheet_words: Sequence[str] | None = None
) -> DataFrame:
    """Cells of all workbooks below a path, with an error column.

    Files are ordered by path; file_ord is a file's rank.
    """

    def parse(batches):
        rows = []
        for files in batches:
            for name, content in zip(files["path"], files["content"]):
                for row in _workbook_rows(name, content, sheet_words):
                    rows.append(row)
                    if len(rows) >= _BATCH:
                        yield pd.DataFrame(rows, columns=_COLUMNS)
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=_COLUMNS)

    files = list_workbooks(spark, path)
    ranks = numbered(files.select(F.col("path").alias("file_ord")), ["file_ord"], "_place")
    cells = files.select("path", "content").mapInPandas(parse, CELLS)
    ranked = cells.join(ranks, "file_ord").withColumn("file_ord", (F.col("_place") + 1).cast("int"))
    return ranked.select(*_COLUMNS)


def split_errors(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, errors) of a workbook scan that was written once."""
    cells = read.where(F.col("error").isNull()).drop("error")
    errors = read.where(F.col("error").isNotNull()).select("file", "sheet", "error")
    return cells, errors
