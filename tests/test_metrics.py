import random

import pytest

from peerbench.operators import benchmarks as b
from peerbench.operators import joins
from peerbench.operators import metrics as m

METRICS = (
    "id string, name string, file string, file_ord int, sheet string, sheet_ord int, row_idx int, "
    "col_ord int, header string, value string"
)
VENDOR = "id string, field string, fy int, value string, ord int"


def sheet(file_ord, sheet_ord, headers, *rows):
    """Rows are (id, values...) under the given headers."""
    return [
        (r[0], f"Name {r[0]}", f"F{file_ord}.xlsx", file_ord, "Key", sheet_ord, i, c, h, r[1 + c])
        for i, r in enumerate(rows)
        for c, h in enumerate(headers)
    ]


def look(spark, rows, fields, **options):
    df = spark.createDataFrame(rows, METRICS).repartition(3)
    ids = df.select("id").distinct()
    return {(r["id"], r["field"]): r["value"] for r in m.metric_lookup(df, ids, fields, **options).collect()}


@pytest.mark.parametrize(
    ("headers", "values", "want"),
    [
        (["market cap", "Market\nCap", "Market Cap"], ["3", "2", "1"], "1"),
        (["market cap", "Market\nCap", "Market Cap"], ["3", "2", ""], "2"),
        (["market cap", "Market\nCap", "Market Cap"], ["3", None, " "], "3"),
        (["Total Market Cap (USD)", "x"], ["4", "9"], "4"),
        (["Market", "Cap"], ["5", "6"], "5"),
        (["Cap", "Mar"], ["5", "6"], None),
    ],
)
def test_header_tiers(spark, headers, values, want):
    got = look(spark, sheet(1, 0, headers, ("A", *values)), ["Market Cap"])
    assert got.get(("A", "Market Cap")) == want


def test_first_row_of_an_id_is_final_within_a_sheet(spark):
    rows = sheet(1, 0, ["Revenue"], ("A", ""), ("A", "7")) + sheet(1, 1, ["Revenue"], ("a ", "8"))
    assert look(spark, rows, ["Revenue"]) == {("A", "Revenue"): "8"}


def test_error_text_ends_the_search_and_codes_do_not(spark):
    rows = (
        sheet(1, 0, ["Revenue", "Margin"], ("A", "#N/A", "USD"))
        + sheet(1, 1, ["Revenue", "Margin"], ("A", "5", "6"))
    )
    got = look(spark, rows, ["Revenue", "Margin"])
    assert got == {("A", "Revenue"): None, ("A", "Margin"): "6"}
    got = look(spark, rows, ["Margin"], strict_codes=False)
    assert got == {("A", "Margin"): "USD"}


def test_stop_after_first_hit(spark):
    rows = (
        sheet(1, 0, ["Other"], ("A", "0"))
        + sheet(1, 1, ["Revenue"], ("A", "1"))
        + sheet(1, 2, ["Margin"], ("A", "2"))
        + sheet(2, 0, ["Growth"], ("A", "3"))
        + sheet(2, 1, ["Margin"], ("A", "4"))
    )
    fields = ["Revenue", "Margin", "Growth"]
    every = look(spark, rows, fields)
    assert every == {("A", "Revenue"): "1", ("A", "Margin"): "2", ("A", "Growth"): "3"}
    early = look(spark, rows, fields, stop_after_first_hit=True)
    assert early == {("A", "Revenue"): "1", ("A", "Growth"): "3"}


def test_files_narrow_the_search(spark):
    rows = sheet(1, 0, ["Revenue"], ("A", "1")) + sheet(2, 0, ["Revenue"], ("A", "2"))
    files = spark.createDataFrame([("F2.xlsx",)], "file string")
    assert look(spark, rows, ["Revenue"], files=files) == {("A", "Revenue"): "2"}


def test_lookup_by_name(spark):
    df = spark.createDataFrame(sheet(1, 0, ["net revenue", "Rev"], ("A", "1", "USD")), METRICS)
    names = spark.createDataFrame([(" name a",)], "name string")
    got = {r["field"]: r["value"] for r in m.metric_lookup_by_name(df, names, ["Revenue", "Rev"]).collect()}
    assert got == {"Revenue": "1", "Rev": "USD"}


def test_batch_and_missing(spark):
    found = spark.createDataFrame([("A", "x", None), ("A", "y", "1")], "id string, field string, value string")
    ids = spark.createDataFrame([("a",), ("B",)], "id string")
    got = {(r["id"], r["field"]): (r["value"], r["is_found"]) for r in m.every_field(ids, found, ["x", "y"]).collect()}
    assert got == {("a", "x"): (None, True), ("a", "y"): ("1", True), ("B", "x"): (None, False), ("B", "y"): (None, False)}
    missing = m.missing_fields(ids, found, ["x", "y"]).collect()
    assert {tuple(r) for r in missing} == {("B", "x"), ("B", "y")}


def vendor(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], VENDOR)


def test_vendor_lookup(spark):
    v = vendor(spark, ("a", "TR.EBIT", 1, "5"), ("A ", "EBIT", 1, "1234.5"), ("B", "TR.EBIT", 1, "text"))
    ids = spark.createDataFrame([("A",), ("b",), ("C",)], "id string")
    got = {(r["id"], r["field"]): r["display"] for r in m.vendor_lookup(v, ids, ["EBIT", "TR.EBIT", ""]).collect()}
    assert got == {("A", "EBIT"): "1,234", ("b", "EBIT"): "text", ("C", "EBIT"): ""}


def test_vendor_lookup_with_periods(spark):
    v = vendor(spark, ("a ", "TR.X", 2020, "1"), ("A", "TR.X", 2021, "2"), ("A", "Y", 2022, "3"), ("A", "Y(Period=FY-1)", 2022, "8"))
    ids = spark.createDataFrame([("A",)], "id string")
    got = {r["field"]: r["value"] for r in m.vendor_lookup(v, ids, ["TR.X(Period=FY-1)", "X(Period=FY-2)", "Y(Period=FY-1)", "X"]).collect()}
    assert got == {"X(Period=FY-1)": "2", "X(Period=FY-2)": "1", "Y(Period=FY-1)": "8", "X": "2"}


def test_last_row_wins_even_if_null(spark):
    v = vendor(spark, ("A", "TR.X", 1, "5"), ("A", "TR.X", 1, None))
    assert [r["value"] for r in m.last_wins(v).collect()] == [None]


def test_relative_period(spark):
    v = vendor(spark, ("A", "TR.X", 2020, "1"), ("A", "TR.X", 2021, "2"), ("A", "Y", 2022, "3"), ("B", "X", 2019, "9"))
    got = {(r["id"], r["field"]): r["value"] for r in m.relative_period(v, ["TR.X(Period=FY-1)", "X", "Y(Period=FY0)"]).collect()}
    assert got == {("A", "TR.X(Period=FY-1)"): "2", ("A", "Y(Period=FY0)"): "3", ("B", "X"): "9"}


def test_mean_of_list(spark):
    v = vendor(spark, ("A", "TR.X", 1, "1,000"), ("B", "TR.X", 1, "50%"), ("C", "TR.X", 1, "7"), ("A", "TR.Y", 1, "abc"))
    ids = spark.createDataFrame([("a",), ("B",)], "id string")
    got = [tuple(r) for r in b.mean_of_list(v, ids, ["X", "TR.Y"]).collect()]
    assert got == [("X", 525.0, 2)]


def test_group_means(spark):
    members = spark.createDataFrame(
        [("Focus", "f", "A"), ("Focus", "f", "B"), ("Focus", "f", "C"), ("Focus", "solo", "D")],
        "group_type string, group_value string, id string",
    )
    metrics = spark.createDataFrame(
        [("A", "x", "0"), ("B", "x", "-4"), ("C", "x", "n/a"), ("D", "x", "5"), ("A", "y", "")],
        "id string, field string, value string",
    )
    got = {(r["group_value"], r["field"]): (r["avg_value"], r["n_valid"], r["n_entities"])
           for r in b.group_means(members, metrics, ["x", "y"]).collect()}
    assert got == {("f", "x"): (-2.0, 2, 3), ("f", "y"): (None, 0, 3)}


def test_sector_fallback(spark):
    proxies = spark.createDataFrame(
        [("S", 0, "P0"), ("S", 1, "P1"), ("T", 0, "Q0"), ("T", 1, "Q1")], "sector string, ord int, id string"
    )
    v = vendor(spark, ("P0", "TR.X", 1, None), ("P1", "TR.X", 1, "1.23456"), ("Q0", "X", 1, "n/a"))
    medians = spark.createDataFrame([("S", "X", 9.0), ("T", "X", 2.5), ("T", "Z", 1.0)], "sector string, field string, median_value double")
    got = {tuple(r) for r in b.sector_fallback(proxies, v, medians).collect()}
    assert got == {("S", "X", 1.2346), ("T", "X", 2.5), ("T", "Z", 1.0)}


def test_median_cap(spark):
    rows = [("S", f"I{i:03d}", "x", str(i)) for i in range(20)]
    u = spark.createDataFrame(rows, "sector string, id string, field string, value string")
    got = b.sector_medians(u, top=5).collect()
    assert [(r["n_values"], r["median_value"]) for r in got] == [(5, 2.0)]
    assert [(r["n_values"], r["median_value"]) for r in b.sector_medians(u).collect()] == [(20, 9.5)]


def test_sector_values_from_universe_and_vendor(spark):
    universe = spark.createDataFrame(
        [(f"U{i}", code, True, True, True, "USD", "TR.X", str(i)) for code in ("45", "10") for i in range(5)]
        + [("V", "45", False, True, True, "USD", "TR.X", "1000")],
        "id string, sector_code string, is_active boolean, is_public boolean, is_primary boolean, curn string, field string, value string",
    )
    v = vendor(spark, (".SPIT", "TR.X", 1, "n/a"), ("xlk ", "X", 1, "7.55555"), ("XLK", "TR.X", 1, "9"), ("XLE", "TR.Y", 1, "3"))
    it, energy = "Information Technology", "Energy"
    got = {tuple(r) for r in b.sector_values(universe, v).collect()}
    assert got == {(it, "X", 7.5556), (energy, "X", 2.0), (energy, "Y", 3.0)}
    assert {tuple(r) for r in b.sector_values(universe, v, ["TR.Y"]).collect()} == {(energy, "Y", 3.0)}


# --- more ids than a broadcast takes -------------------------------------------


@pytest.fixture
def many_keys(monkeypatch):
    monkeypatch.setattr(joins, "SMALL_ROWS", 0, raising=False)
    monkeypatch.setattr(joins.lookup, "__defaults__", ("inner", (), 0, None))


def test_cells_are_read_once_and_unsalted_for_many_ids(spark, many_keys, tmp_path):
    rows = sheet(1, 0, ["Revenue", "x"], *[(f"I{i}", str(i), "9") for i in range(20)])
    spark.createDataFrame(rows, METRICS).write.parquet(str(tmp_path / "m"))
    cells = spark.read.parquet(str(tmp_path / "m"))
    ids = spark.createDataFrame([(f"i{i}",) for i in range(5, 30)], "id string")
    found = m.metric_lookup(cells, ids, ["Revenue"], stop_after_first_hit=True)
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("LeftSemi") == 1  # picks are made once
    cells_in = tree[tree.index("LeftSemi") :]
    assert "Aggregate" in cells_in.split("parquet")[0]  # and before they meet the ids
    assert {r["id"]: r["value"] for r in found.collect()} == {f"I{i}": str(i) for i in range(5, 20)}
    assert m.metric_lookup(cells, ids, []).count() == 0


def test_many_ids_find_what_few_ids_find(spark, monkeypatch):
    rng = random.Random(5)
    heads = ["Revenue", "Total revenue", "Net Margin", "EBIT", "Growth"]
    fields = [*heads, *[f"No such field {i}" for i in range(12)], "Margin", "Revenue", "Net"]
    rows = []
    for file in (1, 2):
        for nth in range(3):
            shown = rng.sample(heads, 3)
            value = lambda: rng.choice([None, " ", "5", "7", "#N/A", "USD", "12"])
            rows += sheet(file, nth, shown, *[(f"I{rng.randint(0, 9)}", *[value() for _ in shown]) for _ in range(12)])
    for stop in (False, True):
        few = look(spark, rows, fields, stop_after_first_hit=stop)
        with monkeypatch.context() as patch:
            patch.setattr(joins, "SMALL_ROWS", 0, raising=False)
            assert look(spark, rows, fields, stop_after_first_hit=stop) == few
        assert len(few) > 20
        assert {f for _, f in few} <= {*heads, "Margin"}


def test_vendor_rows_of_many_ids(spark, many_keys):
    rows = [(f"V{i}", "TR.EBIT", 2000 + y, str(i * 10 + y), y) for i in range(4) for y in range(3)]
    vendor = spark.createDataFrame(rows, VENDOR)
    ids = spark.createDataFrame([("v1",), (" V3 ",), ("W",)], "id string")
    found = m.vendor_lookup(vendor, ids, ["EBIT", "EBIT(Period=FY-1)"])
    assert {(r["id"], r["field"], r["value"]) for r in found.collect()} == {
        ("v1", "EBIT", "12"), ("v1", "EBIT(Period=FY-1)", "11"), (" V3 ", "EBIT", "32"),
        (" V3 ", "EBIT(Period=FY-1)", "31"), ("W", "EBIT", None), ("W", "EBIT(Period=FY-1)", None)}
    assert "_salt" not in m.yearly(vendor, joins.Wanted.of(ids, ["id"]))._jdf.queryExecution().optimizedPlan().toString()
