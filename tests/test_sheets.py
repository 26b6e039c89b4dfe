import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from peerbench.constants import ENTITY_SHEET_WORDS, METRIC_SHEET_WORDS
from peerbench.operators import sheets as s
from peerbench.operators.requests import group_choice
from peerbench.session import durable
from peerbench.sources.sinks import write_table
from peerbench.sources.tables import read_table
from peerbench.sources.workbooks import list_workbooks, read_workbooks, split_errors

CELLS = (
    "file string, file_ord int, sheet string, sheet_ord int, row_idx int, col_idx int, value string"
)


def grid(rows, file="F1.xlsx", file_ord=1, sheet="Key Figures", sheet_ord=0):
    return [
        (file, file_ord, sheet, sheet_ord, i, j, v)
        for i, row in enumerate(rows)
        for j, v in enumerate(row)
        if v is not None
    ]


def frame(spark, *grids):
    return spark.createDataFrame([c for g in grids for c in g], CELLS).repartition(3)


@pytest.mark.parametrize("at", [0, 4, 9, 15, 300])
def test_header_is_found_wherever_it_is(spark, at):
    rows = [["t"]] * at + [["Name", " ric "], ["A", "RIC"]]
    got = [r["header_row"] for r in s.header_rows(frame(spark, grid(rows))).collect()]
    assert got == [at]
    cells = frame(spark, grid([["t"]] * at + [["RIC", "Cap"], ["A", "1"]]))
    promoted = s.promote_headers(cells).where("header = 'Cap'").collect()
    assert [(r["id"], r["row_idx"], r["value"]) for r in promoted] == [("A", at + 1, "1")]


def test_no_header(spark):
    cells = frame(spark, grid([["a", "RICH"], ["b", "c"]]), grid([["RIC"]], sheet="Key", sheet_ord=1))
    assert [r["sheet"] for r in s.header_rows(cells).collect()] == ["Key"]
    assert [(r["sheet"], r["n_cells"]) for r in s.sheets_without_header(cells).collect()] == [("Key Figures", 4)]


def test_promotion_keeps_blanks_and_renames_repeats(spark):
    rows = [["title"], ["Name", "RIC", "Cap", "Cap", None], ["N", "A.B", "1", None, "x"], ["M", None, "2"]]
    got = s.promote_headers(frame(spark, grid(rows))).collect()
    assert {(r["id"], r["row_idx"], r["col_ord"], r["header"], r["value"]) for r in got} == {
        ("A.B", 2, 0, "Name", "N"), ("A.B", 2, 1, "RIC", "A.B"), ("A.B", 2, 2, "Cap", "1"),
        ("A.B", 2, 3, "Cap.1", None)}


def test_detected_but_not_exact_header_is_not_promoted(spark):
    assert s.promote_headers(frame(spark, grid([["ric"], ["A"]]))).count() == 0


def test_superheader_and_name_column(spark):
    rows = [[None, None, "ROE 5Y", "note"], [None, None, "Free float", "x"],
            ["RIC", "Universe", None, None], ["A", "Alpha", "3", "4"]]
    cells = frame(spark, grid(rows))
    names = s.name_columns(cells).collect()
    assert [(r["header_row"], r["name_col"]) for r in names] == [(2, 1)]
    got = s.promote_headers_by_name(cells).collect()
    assert {(r["id"], r["name"], r["header"], r["value"]) for r in got} == {
        ("A", "Alpha", "RIC", "A"), ("A", "Alpha", "Universe", "Alpha"), ("A", "Alpha", "ROE 5Y", "3")}


def test_positional_entities(spark):
    rows = [["x"], ["y"], ["h"] * 5, ["Hold", "Uni", "Sub", None, "A.B"], ["Hold", "Uni", "Sub"]]
    narrow = [row[:4] for row in rows]
    cells = frame(spark, grid(rows), grid(rows, sheet="Notes", sheet_ord=1), grid(narrow, sheet="Key", sheet_ord=2))
    got = s.positional_entities(cells).orderBy("row_idx").collect()
    assert [(r["sheet"], r["row_idx"], r["holding"], r["focus"], r["id"]) for r in got] == [
        ("Key Figures", 3, "Hold", None, "A.B"), ("Key Figures", 4, "Hold", None, None)]


def test_sheet_names(spark):
    cells = frame(spark, *[grid([["v"]], sheet=n) for n in ("Key Figures", "Notes", "CashFlow")])
    names = lambda words: {r["sheet"] for r in s.prune_sheets(cells, words).collect()}
    assert names(ENTITY_SHEET_WORDS) == {"Key Figures"}
    assert names(METRIC_SHEET_WORDS) == {"Key Figures", "CashFlow"}


def test_code_rewrite(spark):
    out = s.rewrite_codes(frame(spark, grid([[" rl ", "RL.N", "RLX"]]))).orderBy("col_idx")
    assert [(r["value"], r["changed"]) for r in out.collect()] == [
        ("RL.N", True), ("RL.N", False), ("RLX", False)]
    assert [tuple(r) for r in s.changed_sheets(out).collect()] == [("F1.xlsx", 1, "Key Figures", 0, 1)]


def test_request_sheet(spark):
    rows = [["Name", "Code", "GICS Sector", "Focus", "Sub-Industry", "Kennzahlen aus Excel", "Kennzahlen aus Refinitiv"],
            ["Hermes", None, "Consumer", "X", None, "Market Cap", "TR.EBIT"],
            [None, "RL.N", None, None, "x", "Market Cap", None]]
    cells = frame(spark, grid(rows))
    got = s.requests_from_cells(cells).orderBy("row_number").collect()
    cols = ["row_number", "name", "id", "sub_industry_flag", "focus_flag", "sector"]
    assert [tuple(r[c] for c in cols) for r in got] == [
        (1, "Hermes", None, None, "X", "Consumer"), (2, None, "RL.N", "x", None, None)]
    wanted = {(r["ord"], r["origin"], r["field"]) for r in s.wanted_fields_from_cells(cells).collect()}
    assert wanted == {(1, "sheet", "Market Cap"), (2, "sheet", "Market Cap"), (1, "vendor", "TR.EBIT")}


def test_blank_first_request_is_a_row(spark):
    rows = [["Name", "Code", "GICS Sector", "Focus", "Sub-Industry"], [], ["A", None, None, "X"], ["B"]]
    got = s.requests_from_cells(frame(spark, grid(rows)))
    assert [r["name"] for r in got.orderBy("row_number").collect()] == [None, "A", "B"]
    chosen = group_choice(got).orderBy("row_number").collect()
    assert [r["group_choice"] for r in chosen] == ["Sub-Industry", "Focus", "Sub-Industry"]
    assert s.requests_from_cells(frame(spark, grid(rows[:1]))).count() == 0


# --- workbook files ----------------------------------------------------------

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_workbook(path, sheets, broken=()):
    """A minimal workbook; strings are shared, numbers plain, ("d", n) is a date."""
    shared, books, rels = [], [], []
    with zipfile.ZipFile(path, "w") as z:
        for k, (name, rows) in enumerate(sheets.items()):
            books.append(f'<sheet name="{escape(name)}" sheetId="{k + 1}" r:id="r{k}"/>')
            rels.append(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>')
            xml = []
            for i, row in enumerate(rows):
                cells = []
                for j, v in enumerate(row):
                    ref = f"{chr(65 + j)}{i + 1}"
                    if isinstance(v, tuple):
                        cells.append(f'<c r="{ref}" s="1"><v>{v[1]}</v></c>')
                    elif isinstance(v, bool):
                        cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                    elif isinstance(v, str):
                        shared.append(v)
                        cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
                    elif v is not None:
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                xml.append(f'<row r="{i + 1}">{"".join(cells)}</row>')
            body = f"<worksheet {MAIN}><sheetData>{''.join(xml)}</sheetData></worksheet>"
            z.writestr(f"xl/worksheets/s{k}.xml", "<oops" if name in broken else body)
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{RELS}"><sheets>{"".join(books)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{''.join(rels)}</Relationships>")
        items = "".join(f"<si><t>{escape(t)}</t></si>" for t in shared)
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{items}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')


def test_workbooks_become_cells(spark, tmp_path):
    want = set()
    for n in range(30):
        name = f"Bük {n:02d}.xlsx"
        rows = [["Holding", "RIC", None], [f"H<{n}>", f"ID{n}", n + 0.5], ["N/A", True, ("d", 45292)]]
        write_workbook(tmp_path / name, {"Key & Figures": rows, "Notes": [["x"]]})
        want |= {(name, 0, i, j, v) for i, r in enumerate(rows[:2]) for j, v in enumerate(map(str, r)) if v != "None"}
        want |= {(name, 0, 2, 1, "True"), (name, 0, 2, 2, "2024-01-01 00:00:00")}
    write_workbook(tmp_path / "~$lock.xlsx", {"Key": [["x"]]})
    write_workbook(tmp_path / "half.xlsx", {"Key": [["y"]], "Figures": [["z"]]}, broken=["Figures"])
    want.add(("half.xlsx", 0, 0, 0, "y"))
    (tmp_path / "broken.xlsx").write_bytes(b"no workbook")
    (tmp_path / "other.txt").write_bytes(b"text")

    assert list_workbooks(spark, str(tmp_path)).count() == 32
    cells, errors = split_errors(durable(read_workbooks(spark, str(tmp_path), METRIC_SHEET_WORDS)))
    got = {(r["file"], r["sheet_ord"], r["row_idx"], r["col_idx"], r["value"]) for r in cells.collect()}
    assert got == want
    assert {(r["file"], r["sheet"]) for r in errors.collect()} == {("broken.xlsx", None), ("half.xlsx", "Figures")}


def test_unreadable_cells_and_ranks(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"Key": [["x"], [("d", 1e12), "y"], ["z"]]})
    write_workbook(tmp_path / "b.xlsx", {"Key": [["w"]]})
    cells, errors = split_errors(durable(read_workbooks(spark, str(tmp_path))))
    write_table(cells, str(tmp_path / "cells"))
    again = read_table(spark, "cells", str(tmp_path / "cells")).collect()
    assert {(r["file"], r["file_ord"], r["row_idx"], r["value"]) for r in again} == {
        ("a.xlsx", 1, 0, "x"), ("a.xlsx", 1, 1, "y"), ("a.xlsx", 1, 2, "z"), ("b.xlsx", 2, 0, "w")}
    assert [r["file"] for r in errors.collect()] == ["a.xlsx"]


def test_workbook_to_metrics(spark, tmp_path):
    rows = [["t"], [None, "RIC", "Market\nCap"], ["n", "A.B", 12]]
    write_workbook(tmp_path / "a.xlsx", {"Key": rows})
    cells, _ = split_errors(durable(read_workbooks(spark, str(tmp_path))))
    got = s.promote_headers(cells).where(F.col("header") != "RIC").collect()
    assert [(r["id"], r["header"], r["value"]) for r in got] == [("A.B", "Market\nCap", "12")]


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", None, "X", None, "it")], "row_number int, name string, id string, sub_industry_flag string, focus_flag string, sector string")
    for fmt in ("parquet", "csv"):
        for _ in range(2):  # the second run overwrites the first
            write_table(df, str(tmp_path / fmt), fmt)
        assert read_table(spark, "requests", str(tmp_path / fmt), fmt).collect() == df.collect()
