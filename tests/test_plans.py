"""What must reach the scans and what must happen before a shuffle."""

import contextlib
import io
import itertools
import re

import pytest

from __spark_entry__ import queries
from peerbench.operators import joins
from peerbench.session import shared_dir


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_screen_reaches_the_scan(spark, sf):
    text = plan(queries()["universe_screen"](spark, sf))
    scan = next(s for s in re.split(r"\n\n+", text) if "lineitem.parquet" in s)
    for c in ("l_linestatus", "l_discount", "l_returnflag"):
        assert c in re.search(r"PushedFilters: .*", scan).group(0)
    assert "l_shipdate" not in re.search(r"ReadSchema: .*", scan).group(0)


def test_cap_is_applied_before_the_shuffle(spark, sf):
    from peerbench.catalogue.registry import Views
    from peerbench.operators.benchmarks import first_ids_per_sector

    text = plan(first_ids_per_sector(Views(spark, sf).listings, 500))
    assert text.count("WindowGroupLimit") >= 2


def test_proxies_narrow_the_vendor_table_before_it_is_grouped(spark, sf):
    text = plan(queries()["sector_fallback"](spark, sf))
    tree = text[: text.index("\n\n")].splitlines()
    semi = next(i for i, line in enumerate(tree) if "LeftSemi" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below = itertools.takewhile(lambda line: depth(line) > depth(tree[semi]), tree[semi + 1 :])
    assert "Aggregate" in "".join(tree[:semi]) and "Aggregate" not in "".join(below)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_first_per_key_aggregates_before_the_shuffle(spark, sf):
    text = plan(queries()["dedupe_first"](spark, sf))
    assert "partial_min_by" in text


def test_lookup_broadcasts_only_below_the_limit(spark):
    from peerbench.session import durable

    small = durable(spark.range(100).withColumnRenamed("id", "k"))
    big = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(joins.lookup(big, small, ["k"], small_rows=100))
    salted = plan(joins.lookup(big, small, ["k"], spread=["k"], small_rows=99))
    assert "_salt" in salted


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_side_repeated_for_every_salt_is_not_broadcast(spark, how):
    small = spark.range(50).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    joined = joins.salted_join(big, small, ["k"], how, ["k"])
    assert joined.count() == (1000 if how == "left" else 50)
    text = plan(joined)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


@pytest.mark.parametrize("name, dropped", [("cells", []), ("metrics", ["name"]), ("universe", []), ("vend", [])])
def test_a_view_is_dealt_before_its_rows_become_cells(spark, sf, name, dropped):
    from peerbench.catalogue.registry import Views
    from peerbench.catalogue.views import dealt_view, view

    dealt = dealt_view(spark, sf, name, 5, dropped)
    tree = plan(dealt).split("\n\n")[0]
    at = tree.index("Exchange")
    assert "Generate" not in tree[at:] and ("Generate" in tree[:at]) == (name != "vend")
    want, got = view(spark, sf, name).drop(*dropped), Views(spark, sf).stored(name, *dropped)
    assert got.columns == want.columns
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("name", ["ent_rows", "metrics", "listings"])
def test_customers_of_a_view_are_not_broadcast(spark, sf, name):
    from peerbench.catalogue.views import view

    tree = plan(view(spark, sf, name))
    assert "SortMergeJoin" in tree
    assert not [x for x in tree.splitlines() if "BroadcastHashJoin" in x and "custkey" in x]


def test_tables_with_a_row_per_entity_are_not_broadcast(spark):
    from peerbench.operators import entities, metrics, report, sectors

    ids = spark.createDataFrame([("A",), ("B",)], "id string")
    place = "1 AS file_ord, 1 AS sheet_ord, 2 AS row_idx"
    rows = ids.selectExpr("*", "'IT_Services.xlsx' AS file", place.split(", ")[0], *place.split(", ")[1:], "'Acme' AS holding")
    peers = ids.selectExpr("*", "1 AS row_number", *place.split(", "), "'n' AS name", "'s' AS sub_industry", "'f' AS focus", "'Focus' AS group_type")
    found = ids.limit(1).selectExpr("id", "'x' AS field", "'1' AS value")
    made = {
        "sectors": sectors.entity_sectors(ids, rows),
        "rows": report.entity_rows(peers, ids.selectExpr("id", "'IT' AS sector")),
        "names": entities.id_to_name(ids, rows),
        "fields": metrics.every_field(ids, found, ["x"]),
    }
    for what, df in made.items():
        # the join of all rows is the first in the plan
        joins_ = [x for x in plan(df).splitlines() if "Join" in x]
        assert "SortMergeJoin" in joins_[0], what
        assert df.count() == 2, what
