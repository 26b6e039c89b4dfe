import pytest

from peerbench.operators import entities as e
from peerbench.operators import peers as p
from peerbench.operators import report as r
from peerbench.operators import sectors as sec
from peerbench.operators.name_index import NameIndex
from peerbench.plans.peer_report import peer_report, report_from_sheet
from peerbench.sources.sinks import write_report

REQ = "row_number int, name string, id string, sub_industry_flag string, focus_flag string, sector string"
ENT = (
    "file string, file_ord int, sheet string, sheet_ord int, row_idx int, holding string, "
    "universe string, sub_industry string, focus string, id string"
)
MET = (
    "id string, file string, file_ord int, sheet string, sheet_ord int, row_idx int, col_ord int, "
    "header string, value string"
)
VEN = "id string, field string, fy int, value string, ord int"
UNI = (
    "id string, sector_code string, is_active boolean, is_public boolean, is_primary boolean, "
    "curn string, field string, value string"
)
FILES = {"Consumer_A.xlsx": 1, "Health_B.xlsx": 2}


@pytest.fixture(scope="module")
def inputs(spark):
    ent, met = [], []
    people = [
        ("Consumer_A.xlsx", "A", "Apparel", "Luxury", "10"),
        ("Consumer_A.xlsx", "B", "Apparel", None, "20"),
        ("Consumer_A.xlsx", "C", "Shoes", "Luxury", "N/A"),
        ("Health_B.xlsx", "D", "Drugs", None, "40"),
        ("Health_B.xlsx", "E", "Drugs", None, "1,000"),
        ("Health_B.xlsx", "A", "Apparel", "Luxury", "99"),
    ]
    for i, (file, eid, sub, focus, cap) in enumerate(people):
        place = (file, FILES[file], "Key", 0, i)
        ent.append((*place, f"Holding {eid}", f"Uni {eid}", sub, focus, eid))
        met.append((eid, *place, 0, "Market Cap", cap))
    requests = [
        (1, None, "a", None, "X", "consumer"),
        (2, "holding d", None, "X", None, None),
        (3, None, "C", None, "X", None),
        (4, None, "nope", None, None, None),
    ]
    vendor = [("A", "TR.EBIT", 1, "1500", 0), ("A", "TR.EBIT", 1, "2500", 1), ("D", "TR.EBIT", 1, "x", 2)]
    universe = [
        (f"U{i}", code, True, True, True, "USD", "TR.EBIT", str(i))
        for code in ("25", "35", "10")
        for i in range(20)
    ]
    universe.append(("V", "25", False, True, True, "USD", "TR.EBIT", "1000000"))
    make = spark.createDataFrame
    return (
        make(requests, REQ), make(ent, ENT), make(met, MET), make(vendor, VEN), make(universe, UNI)
    )


@pytest.fixture(scope="module")
def report(inputs):
    return peer_report(*inputs, ["Market Cap", "Unknown"], ["TR.EBIT", "EBIT"])


def test_no_fields_asked_for(inputs):
    wide = peer_report(*inputs, [], []).wide()
    assert {(x["id"], x["row_kind"]) for x in wide.collect()} == {(i, "entity") for i in "ACDE"}


def test_nothing_resolved(inputs):
    out = peer_report(inputs[0].where("row_number = 4"), *inputs[1:], ["Market Cap"], ["EBIT"])
    assert out.wide().count() == 0
    assert [x["status"] for x in out.status.collect()] == ["not_found"]


def test_status(report):
    assert {x["row_number"]: x["status"] for x in report.status.collect()} == {
        1: "by_id", 2: "by_name", 3: "duplicate_group", 4: "not_found"}


def test_entity_rows(report):
    rows = report.wide().where("row_kind = 'entity'").collect()
    got = {(x["input_row"], x["id"], x["sector"], x["peer_group_type"], x["Market Cap"], x["EBIT"]) for x in rows}
    cons, health = "Consumer Discretionary", "Health Care"
    assert got == {
        ("Zeile 1", "A", cons, "Focus", 10.0, 2500.0),
        ("Zeile 1", "C", cons, "Focus", None, None),
        ("Zeile 2", "D", health, "Sub-Industry", 40.0, None),
        ("Zeile 2", "E", health, "Sub-Industry", None, None),
    }
    shown = {x["id"]: (x["Market Cap"], x["EBIT"]) for x in report.wide("value_text").where("row_kind = 'entity'").collect()}
    assert shown == {"A": ("10", "2,500"), "C": (None, ""), "D": ("40", "x"), "E": ("1,000", "")}


def test_benchmark_rows(report):
    rows = report.wide().where("row_kind <> 'entity'").collect()
    got = {(x["section"], x["name"], x["Market Cap"], x["EBIT"]) for x in rows}
    assert got == {
        (1, "💼 Ø Apparel", 15.0, None),
        (1, "💼 Ø Drugs", 40.0, None),
        (2, "🎯 Ø Luxury", 10.0, None),
        (3, "🏭 Ø Consumer Discretionary", None, 9.5),
        (3, "🏭 Ø Health Care", None, 9.5),
    }
    assert {x["input_row"] for x in rows if x["row_kind"] == "focus_mean"} == {"Focus-Ø (2 Unternehmen)"}


def test_projection_and_empty_columns(report):
    wide = r.project(report.wide(), ["Market Cap", "Unknown"], ["TR.EBIT", "EBIT"])
    assert wide.columns == [*r.BASE, "Market Cap", "Unknown", "EBIT"]
    assert r.drop_empty_columns(wide).columns == [*r.BASE, "Market Cap", "EBIT"]
    assert r.base_first(wide.select("EBIT", "id", "name")).columns == ["name", "id", "EBIT"]


def test_finished_table(report):
    table = report.table()
    assert table.columns == ["row_kind", *r.BASE, "Market Cap", "EBIT"]
    rows = table.collect()
    assert [x["id"] for x in rows[:4]] == ["A", "C", "D", "E"]
    kinds = ["entity"] * 4 + ["sub_industry_mean"] * 2 + ["focus_mean"] + ["sector_mean"] * 2
    assert [x["row_kind"] for x in rows] == kinds
    means = {x["name"]: x["sector"] for x in rows if x["id"] == ""}
    assert means["🎯 Ø Luxury"] == "Consumer Discretionary"


def test_written_in_order(report, spark, tmp_path):
    write_report(report.wide(), str(tmp_path / "out"))
    sections = [x["section"] for x in spark.read.parquet(str(tmp_path / "out")).orderBy(*r.SORT).collect()]
    assert sections == [0, 0, 0, 0, 1, 1, 2, 3, 3]
    write_report(report.wide(), str(tmp_path / "out"), partition_by=["row_kind"])
    assert spark.read.parquet(str(tmp_path / "out")).where("row_kind = 'entity'").count() == 4


def test_a_request_sheet_drives_the_report(inputs, report, spark):
    sheet = [
        ["Name", "Code", "GICS Sector", "Focus", "Sub-Industry", "Kennzahlen aus Excel", "Kennzahlen aus Refinitiv"],
        [None, "a", "consumer", "X", None, "Market Cap", "TR.EBIT"],
        ["holding d", None, None, None, "X", " Unknown", "EBIT"],
        [None, "C", None, "X", None, "Market Cap ", None],
        [None, "nope"],
    ]
    cells = [("R", 1, "S", 0, i, j, v) for i, row in enumerate(sheet) for j, v in enumerate(row) if v is not None]
    schema = "file string, file_ord int, sheet string, sheet_ord int, row_idx int, col_idx int, value string"
    found = report_from_sheet(spark.createDataFrame(cells, schema).repartition(3), *inputs[1:])
    assert found.fields == report.fields
    assert found.table().collect() == report.table().collect()
    assert sorted(found.status.collect()) == sorted(report.status.collect())


def test_a_request_sheet_of_many_alike_names(inputs, spark, monkeypatch):
    pairs, searched = [], []
    look, expand = e.lookup, p.expand

    def counted(*args, **options):
        out = look(*args, **options)
        pairs.append(out.count())
        return out

    def groups_searched(groups, *args, **options):
        searched.append(sorted(x["group_value"] for x in groups.collect()))
        return expand(groups, *args, **options)

    monkeypatch.setattr(e, "lookup", counted)
    monkeypatch.setattr(p, "expand", groups_searched)
    n = 3000
    entities = [("Consumer_A.xlsx", 1, "Key", 0, i, f"Holding {i:07d}", f"Uni {i}", f"Sub {i % 7}", f"Focus {i % 2}", f"E{i}") for i in range(n)]
    sheet = [["Name", "Code", "GICS Sector", "Focus", "Sub-Industry", "Kennzahlen aus Excel", "Kennzahlen aus Refinitiv"]]
    sheet += [[f"holding {i:07d}"[: 15 - i % 2], None, None, None, "X"] for i in range(n)]
    cells = [("R", 1, "S", 0, i, j, v) for i, row in enumerate(sheet) for j, v in enumerate(row) if v is not None]
    schema = "file string, file_ord int, sheet string, sheet_ord int, row_idx int, col_idx int, value string"
    made = report_from_sheet(spark.createDataFrame(cells, schema), spark.createDataFrame(entities, ENT), *inputs[2:])
    kinds = {x["status"]: x["count"] for x in made.status.groupBy("status").count().collect()}
    assert kinds == {"by_name": 7, "duplicate_group": n - 7}
    assert made.long.where("row_kind = 'entity'").count() == n
    assert pairs[0] <= 8 * n
    assert searched == [[f"Sub {i}" for i in range(7)], ["Focus 0", "Focus 1"]]  # no group twice


def test_search_that_stops_and_search_in_an_index(inputs, report):
    index = NameIndex.write(inputs[1], buckets=4)
    found = peer_report(*inputs, ["Market Cap", "Unknown"], ["TR.EBIT", "EBIT"], names=index)
    assert found.table().collect() == report.table().collect()
    stopped = peer_report(*inputs, ["Market Cap"], [], stop_after_first_hit=True)
    assert {x["id"]: x["Market Cap"] for x in stopped.table().where("row_kind = 'entity'").collect()} == {"A": 10.0, "C": None, "D": 40.0, "E": None}


def test_fill_sector_and_titles(spark):
    rows = spark.createDataFrame(
        [(0, "entity", "A"), (1, "entity", "B"), (2, "entity", "B"), (3, "entity", "A"),
         (4, "focus_mean", None), (5, "sector_mean", "C"), (6, "entity", ""), (7, "entity", None), (8, "entity", None)],
        "ord int, row_kind string, sector string",
    )
    got = [x["sector"] for x in r.fill_sector(rows, ["ord"]).orderBy("ord").collect()]
    assert got[4] == "A" and got[5] == "C"
    assert r.title_sector(rows, ["ord"]).collect()[0][0] == "Multi-Sector"
    assert r.title_sector(rows.where("ord < 4"), ["ord"]).collect()[0][0] == "A"
    assert [x[0] for x in r.used_sectors(rows).collect()] == ["A", "B", "C"]


def test_column_profile(spark):
    df = spark.createDataFrame([("x" * 50, "id", "12"), (None, "long id here 17", None)], "name string, id string, cap string")
    got = {x["column"]: (x["max_length"], x["width"]) for x in r.column_profile(df, ["cap"]).collect()}
    assert got == {"name": (50, 40), "id": (15, 15), "cap": (3, 12)}


def test_sector_files(spark):
    files = spark.createDataFrame([("Consumer_A.xlsx",), ("IT1.xlsx",), ("my_Technology.xlsx",), ("Media.xlsx",)], "file string")
    words = spark.createDataFrame([("consumer ",), ("IT",), ("media",), ("Fantasy",), ("x",)], "sector string")
    got = {tuple(x) for x in sec.sector_files(files, words).collect()}
    assert got == {("consumer ", "Consumer_A.xlsx"), ("IT", "IT1.xlsx"), ("IT", "my_Technology.xlsx"), ("media", "Media.xlsx")} | {
        ("x", f) for f in ("Consumer_A.xlsx", "IT1.xlsx", "my_Technology.xlsx", "Media.xlsx")}
    listed = lambda *w: {x["file"] for x in sec.files_for_sectors(files, w).collect()}
    assert listed(" CONSUMER") == {"Consumer_A.xlsx"}
    assert len(listed("Fantasy")) == len(listed()) == len(listed("", None)) == 4


def test_fixed_dimensions(spark):
    assert sec.sector_codes(spark).count() == 11
    proxies = sec.sector_proxies(spark)
    assert proxies.count() == 44
    assert proxies.join(sec.sector_codes(spark), "sector", "left_anti").count() == 0


def test_screen(spark):
    rows = [("1", True, True, True, "USD"), ("2", False, True, True, "USD"), ("3", True, True, True, "EUR"), ("4", True, None, True, "USD")]
    df = spark.createDataFrame(rows, "sector_code string, is_active boolean, is_public boolean, is_primary boolean, curn string")
    assert [x["sector_code"] for x in sec.screen(df).collect()] == ["1"]
    assert sec.screen(df, "9").count() == 0
