"""Stored forms: indexes, snapshots, states, tables by file, written reports."""

import contextlib
import io
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerbench.operators import entities as e
from peerbench.operators import header_match as h
from peerbench.operators import metrics as m
from peerbench.operators import quantiles as q
from peerbench.operators import sheets
from peerbench.operators.name_index import NameIndex
from peerbench.operators.ordering import numbered
from peerbench.operators.quantile_state import QuantileState
from peerbench.session import durable, release
from peerbench.sources.by_file import of_sectors, read_by_file, write_by_file
from peerbench.sources.sinks import read_report, write_report, write_table
from peerbench.sources.vendor_snapshot import VendorSnapshot


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def above_scan(df, name):
    """The operators between a table's scan and the join above it."""
    tree = plan(df).split("\n\n")[0].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = max(i for i, line in enumerate(tree) if name in line)
    out, level = [], depth(tree[at])
    for line in reversed(tree[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Join" in line:
                break
            out.append(line.strip(" :+-"))
    return out


@pytest.fixture
def merge_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- order and sinks ---------------------------------------------------------


def test_places_in_an_order_without_a_window(spark):
    r = random.Random(1)
    rows = [(r.choice([None, "a", "b", "c"]), r.randrange(1000), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n int, i int").repartition(5)
    placed = numbered(df, [F.col("k").desc(), "n", "i"])
    assert "Window" not in plan(placed)
    got = [(x["k"], x["n"], x["i"]) for x in sorted(placed.collect(), key=lambda x: x["position"])]
    assert got == sorted(rows, key=lambda x: (-ord(x[0]) if x[0] else 1, x[1], x[2]))
    assert sorted(x["position"] for x in placed.collect()) == list(range(500))
    assert numbered(df.where("false"), ["i"]).count() == 0


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    for write in (write_table, write_report):
        with pytest.raises(Exception, match="no"):
            write(bad, path)
        assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    write_table(spark.read.parquet(path).where("id > 2"), path)  # a table over itself
    assert sorted(x[0] for x in spark.read.parquet(path).collect()) == [3, 4]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_written_report_keeps_its_order(spark, tmp_path):
    rows = [(i % 4, i, f"n{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "section int, row_number int, name string").repartition(7)
    write_report(df, str(tmp_path / "r"))
    back = read_report(spark, str(tmp_path / "r")).collect()
    assert [(x["section"], x["row_number"]) for x in sorted(back, key=lambda x: x["position"])] == sorted((a, b) for a, b, _ in rows)
    write_report(df.where("false"), str(tmp_path / "r"))
    assert read_report(spark, str(tmp_path / "r")).count() == 0


def test_released_tables_are_gone(spark):
    table = durable(spark.range(3))
    release(table)
    with pytest.raises(Exception, match="(?i)not.exist|does not exist|PATH_NOT_FOUND|FileNotFound"):
        spark.read.parquet(table.stored_at).count()


# --- names -------------------------------------------------------------------


def some_entities(r, n):
    word = lambda k: "".join(r.choice("abcA ") for _ in range(k))
    return [(r.randint(1, 3), r.randint(0, 2), i, r.choice([None, word(8)]), word(9), "s", "f", f"I{i}") for i in range(n)]


def test_index_finds_what_a_search_finds(spark, entities):
    r = random.Random(3)
    rows = some_entities(r, 400)
    wanted = [("".join(r.choice("abc ") for _ in range(r.randint(2, 6))),) for _ in range(60)]
    needles = spark.createDataFrame(wanted, "needle string")
    index = NameIndex.write(entities(rows).repartition(5), buckets=4)
    again = NameIndex(spark, index.path, 4)
    found = [sorted(tuple(x) for x in e.find_by_name(needles, where).select("needle", "id", "name").collect()) for where in (index, again, entities(rows))]
    assert found[0] == found[1] == found[2] and len(found[0]) > 5
    assert NameIndex.write(entities(rows[:0]), buckets=4).find(needles).count() == 0


def test_a_probe_moves_needles_only(spark, entities, merge_joins):
    index = NameIndex.write(entities(some_entities(random.Random(4), 50)), buckets=4)
    probe = index.hits(spark.createDataFrame([("abca",)], "needle string"))
    assert not [x for x in above_scan(probe, index.postings.name) if "Exchange" in x]


def test_names_without_a_needles_trigram_are_not_shuffled(spark, entities):
    search = e.find_by_name(spark.createDataFrame([("abca",)], "needle string"), entities(some_entities(random.Random(4), 50)))
    tree = plan(search).split("\n\n")[0]
    assert tree.index("Aggregate") < tree.index("Exchange") < tree.index("BroadcastHashJoin")


# --- headers -----------------------------------------------------------------


def brute_tiers(headers, fields, tier, spark):
    both = spark.createDataFrame([(a,) for a in headers], "header string").crossJoin(spark.createDataFrame([(b,) for b in fields], "field string"))
    return {tuple(x) for x in both.withColumn("tier", tier(F.col("header"), F.col("field"))).where("tier IS NOT NULL").collect()}


@pytest.mark.parametrize("matching", [h.STRICT, h.LOOSE])
def test_headers_meet_as_if_all_pairs_were_compared(spark, matching):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abAB \n") for _ in range(r.randrange(0, 9)))
    headers, fields = [{word() for _ in range(150)} for _ in range(2)]
    got = h.match_headers(spark.createDataFrame([(x,) for x in [*headers, None, *headers]], "header string"), sorted(fields), matching)
    want = brute_tiers(headers, fields, matching.tier, spark)
    assert {tuple(x) for x in got.collect()} == want and len(want) > 100


def test_pairs_compared_grow_with_the_matches(spark):
    r = random.Random(2)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    fields = [f"{word(6)} {word(7)}" for _ in range(1000)]
    headers = [(f"{r.choice(fields)} {word(4)}" if i % 10 == 0 else f"{word(5)} {word(8)}",) for i in range(100_000)]
    heads = durable(spark.createDataFrame(headers, "h string"))
    wanted = durable(spark.createDataFrame([(f,) for f in fields], "f string"))
    pairs = h.candidates(heads, wanted, 4)
    compared, matches = pairs.count(), pairs.where(F.contains("h", "f") | F.contains("f", "h")).count()
    assert matches >= 9_000 and compared < len(headers)  # of 100 million pairs
    assert "CartesianProduct" not in plan(pairs) and "NestedLoop" not in plan(pairs)


# --- vendor snapshot ---------------------------------------------------------

VENDOR = "id string, field string, fy int, value string, ord int"
ASKED = ["EBIT", "TR.Sales", "EBIT(Period=FY-1)", "Sales(Period=FY0)"]


def replies(r, n):
    fields = ["TR.EBIT", " EBIT", "Sales", "TR.Sales(Period=FY0)", "Other", None]
    return [(r.choice(["a", "A ", "b", "c", None]), r.choice(fields), r.choice([None, 2020, 2021, 2022]), r.choice([None, "1", "2", "x"]), i) for i in range(n)]


def test_a_later_reply_is_merged(spark):
    r = random.Random(6)
    parts = [replies(r, 60), replies(r, 20), replies(r, 5)]
    ids = spark.createDataFrame([("a",), ("B",), ("none",)], "id string")
    snapshot = VendorSnapshot(spark, buckets=4)
    with pytest.raises(ValueError, match="no reply"):
        snapshot.rows()
    for k, part in enumerate(parts):
        snapshot.merge(spark.createDataFrame(part, VENDOR).repartition(3))
        # Rows of a later reply come after all rows before.
        seen = [(*row[:4], n) for n, row in enumerate(x for p in parts[: k + 1] for x in p)]
        want = m.vendor_lookup(spark.createDataFrame(seen, VENDOR), ids, ASKED)
        opened = VendorSnapshot(spark, snapshot.path)
        for s in (snapshot, opened):
            assert sorted(map(tuple, s.lookup(ids, ASKED).collect())) == sorted(map(tuple, want.collect()))
    keys = snapshot.rows().groupBy("id", "field", "fy").count()
    assert keys.where("count > 1").count() == 0 and opened.buckets == 4


def test_a_lookup_reads_wanted_fields_and_moves_ids_only(spark, merge_joins):
    snapshot = VendorSnapshot(spark, buckets=4)
    snapshot.merge(spark.createDataFrame(replies(random.Random(7), 50), VENDOR))
    found = snapshot.lookup(spark.createDataFrame([("a",)], "id string"), ["EBIT", "Sales"])
    text = plan(found)
    assert "In(field, [EBIT,Sales])" in text
    assert not [x for x in above_scan(found, snapshot.table.name) if "Exchange" in x]


def test_a_merge_moves_the_reply_only(spark, merge_joins, monkeypatch):
    from peerbench.sources import bucketed

    snapshot = VendorSnapshot(spark, buckets=4)
    snapshot.merge(spark.createDataFrame(replies(random.Random(7), 50), VENDOR))
    old, plans = snapshot.table.name, []
    append = bucketed.BucketedTable.append
    monkeypatch.setattr(bucketed.BucketedTable, "append", lambda self, df: (plans.append(above_scan(df, old)), append(self, df))[1])
    snapshot.merge(spark.createDataFrame(replies(random.Random(8), 50), VENDOR))
    assert plans and not [x for x in plans[0] if "Exchange" in x]


# --- quantile state ----------------------------------------------------------

PROBS = {"a": 0.05, "b": 0.5, "c": 0.95}


@pytest.fixture(scope="module")
def numbers(spark):
    r = np.random.default_rng(5)
    rows = [("x", float(v)) for v in r.normal(size=2000)] + [("y", float(v)) for v in r.integers(-3, 4, 1500)]
    rows += [("z", 3.5), ("x", float("nan")), ("y", None), (None, 1.0)]
    return spark.createDataFrame(rows, "k string, v double").repartition(6).withColumn("half", F.pmod(F.hash("v"), F.lit(3))).cache()


def test_parts_add_up_to_the_whole(spark, numbers):
    state = QuantileState(spark, {"k": "string"})
    for part in (0, 1, 2, 1):  # one part comes again
        state.add(numbers.where(F.col("half") == part), "v", f"p{part}")
    opened = QuantileState(spark, {"k": "string"}, state.path)
    whole = numbers.where("k IS NOT NULL")
    near = lambda rows: {x["k"]: [round(v, 9) if isinstance(v, float) else v for v in x] for x in rows}
    for s in (state, opened):
        assert near(s.quantiles(PROBS).collect()) == near(q.grouped_quantiles(whole, ["k"], "v", PROBS).collect())
        assert near(s.trimmed_mean(min_n=1).collect()) == near(q.trimmed_mean(whole, ["k"], "v", min_n=1).collect())


def test_a_part_without_its_slots_does_not_count(spark, numbers):
    state = QuantileState(spark, {"k": "string"})
    state.add(numbers.where("half = 0"), "v", "p0")
    before = sorted(map(tuple, state.quantiles(PROBS).collect()))
    lost = numbers.groupBy("k", F.lit(0).cast("long").alias("_slot"), F.col("v").alias("_v")).agg(F.count("*").alias("_n"))
    write_table(lost, f"{state.path}/values/_part=p9")
    assert sorted(map(tuple, state.quantiles(PROBS).collect())) == before


def test_no_keys(spark, numbers):
    values = np.array([x["v"] for x in numbers.where("v IS NOT NULL AND NOT isnan(v)").collect()])
    got = q.grouped_quantiles(numbers, [], "v", PROBS).collect()
    assert len(got) == 1 and got[0].asDict() == pytest.approx({"n_values": len(values), **{n: np.quantile(values, p) for n, p in PROBS.items()}})
    mean = q.trimmed_mean(numbers, [], "v", scale=None).collect()
    lo, hi = np.quantile(values, [0.05, 0.95])
    assert mean[0]["avg_value"] == pytest.approx(values[(values >= lo) & (values <= hi)].mean()) and len(mean) == 1
    assert q.grouped_quantiles(numbers.where("false"), [], "v", PROBS).count() == 0


# --- tables by file, header index --------------------------------------------


def test_other_files_are_pruned_at_run_time(spark, tmp_path):
    files = ["Consumer_A.xlsx", "Health_B.xlsx", "IT_C.xlsx"]
    rows = [(f"i{i}", files[i % 3], i % 3, "Key", 0, i, 0, "Cap", str(i)) for i in range(60)]
    cells = spark.createDataFrame(rows, "id string, file string, file_ord int, sheet string, sheet_ord int, row_idx bigint, col_ord int, header string, value string")
    write_by_file(cells, str(tmp_path / "m"))
    table = read_by_file(spark, "metrics", str(tmp_path / "m"))
    found = of_sectors(table, ["health", "c.x", "consumer", "", None])
    assert "dynamicpruning" in plan(found)
    assert {(x["sector"], x["file"]) for x in found.collect()} == {("health", "Health_B.xlsx"), ("consumer", "Consumer_A.xlsx"), ("c.x", "IT_C.xlsx")}
    assert found.count() == 60


def test_promotion_scans_the_cells_once(spark):
    grid = [["RIC", "Cap"], ["A", "1"], ["B", None], [None, "2"]]
    cells = [("F", 1, "Key", 0, i, j, v) for i, row in enumerate(grid) for j, v in enumerate(row) if v]
    table = durable(spark.createDataFrame(cells, "file string, file_ord int, sheet string, sheet_ord int, row_idx int, col_idx int, value string"))
    index = sheets.header_index(table)
    for promote in (sheets.promote_headers, sheets.promote_headers_by_name):
        rows = promote(table, index)
        assert len(re.findall(rf"Location: InMemoryFileIndex.*{re.escape(table.stored_at)}", plan(rows))) == 1
        assert {(x["id"], x["header"], x["value"]) for x in rows.collect()} == {("A", "RIC", "A"), ("A", "Cap", "1"), ("B", "RIC", "B"), ("B", "Cap", None)}
