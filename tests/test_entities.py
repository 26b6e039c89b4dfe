import random

import pytest
from pyspark.sql import functions as F

from peerbench.operators import entities as e
from peerbench.operators import joins, peers, requests
from peerbench.operators.sectors import entity_sectors
from peerbench.session import durable

REQ = (
    "row_number int, name string, id string, sub_industry_flag string, focus_flag string, "
    "sector string"
)

ROWS = [
    (1, 0, 3, "Ralph Lauren", "Ralph Lauren Corp", "Apparel", "Luxury", "RL.N"),
    (1, 0, 4, None, "AT&T Inc", "Telecom", None, "T.N"),
    (1, 1, 3, "Zara Home", "Inditex", "Apparel", "Fast", " ITX.MC "),
    (2, 0, 3, "A(B Holding", "Odd", "Apparel", "Luxury", "AB.X"),
    (2, 0, 4, "RL copy", "RL copy Corp", "Other", "Other", "rl.n "),
    (2, 0, 5, "L'Oréal", "L'Oréal SA", "Beauty", "Luxury", "OREP.PA"),
    (2, 0, 6, "Lonely", None, "", None, "LONE.X"),
]


@pytest.fixture(params=[200_000, 0], ids=["broadcast", "salted"])
def any_join(request, monkeypatch):
    monkeypatch.setattr(joins.lookup, "__defaults__", ("inner", (), request.param, None))


def test_find_by_id(spark, entities, any_join):
    wanted = spark.createDataFrame([("rl.n",), (" RL.N ",), ("T.N",), ("XXX.YY",)], "id string")
    got = {r["key"]: (r["id"], r["name"]) for r in e.find_by_id(wanted, entities(ROWS)).collect()}
    assert got == {"RL.N": ("RL.N", "Ralph Lauren"), "T.N": ("T.N", "AT&T Inc")}


@pytest.mark.parametrize(
    ("needle", "found"),
    [("zara", "ITX.MC"), ("ralph", "RL.N"), ("at&t", "T.N"), ("a(b ", "AB.X"),
     ("l'oréal", "OREP.PA"), ("corp", "RL.N"), ("nothing", None), ("odd", None)],
)
def test_find_by_name(spark, entities, needle, found):
    wanted = spark.createDataFrame([(needle,)], "needle string")
    got = [r["id"] for r in e.find_by_name(wanted, entities(ROWS)).collect()]
    assert got == ([found] if found else [])


def test_find_by_name_equals_brute_force(spark, entities, any_join):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcA ") for _ in range(n))
    rows = [
        (rng.randint(1, 3), rng.randint(0, 2), i, rng.choice([None, word(8)]), word(9), "s", "f", f"I{i}")
        for i in range(400)
    ]
    needles = sorted({word(rng.randint(3, 6)).lower() for _ in range(60)})
    want = {}
    for n in needles:
        hits = [
            ((f, s, side, r), i)
            for f, s, r, h, u, _, _, i in rows
            for side, t in ((0, h), (1, u))
            if t and len(n) >= 4 and n in t.lower()
        ]
        if hits:
            want[n] = min(hits)[1]
    wanted = spark.createDataFrame([(n,) for n in needles], "needle string")
    found = e.find_by_name(wanted, entities(rows).repartition(5)).collect()
    assert {r["needle"]: r["id"] for r in found} == want


def requests_df(spark, rows):
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], REQ)


def run_requests(spark, entities, rows):
    raw = requests.group_choice(requests_df(spark, rows))
    clean = requests.clean_requests(raw)
    found = e.resolve(clean, entities).join(
        clean.select("row_number", "group_choice", "sector"), "row_number"
    )
    assigned = durable(peers.assign_group(found))
    groups = durable(peers.open_groups(assigned))
    status = {r["row_number"]: r["status"] for r in requests.request_status(raw, assigned, groups).collect()}
    members = peers.peers_or_self(groups, peers.expand(groups, entities))
    by_row = {}
    for r in members.collect():
        by_row.setdefault(r["row_number"], set()).add(r["id"])
    return status, by_row, groups


def test_statuses_and_groups(spark, entities, any_join):
    status, by_row, groups = run_requests(
        spark,
        entities(ROWS),
        [
            ("Ralph", "RL.N", None, "X", "Consumer"),  # id beats name, focus group
            ("VF", None, None, None, None),
            ("Fantasiefirma AG", "nan", None, None, None),
            ("None", "", None, None, None),
            (None, "OREP.PA", None, " x ", "it"),  # same group again
            (None, "T.N", None, "X", None),  # focus wanted, none there
            ("Zara", None, "X", None, None),
            (None, "LONE.X", "X", None, None),  # neither focus nor sub-industry
        ],
    )
    assert status == {
        1: "by_id", 2: "name_too_short", 3: "not_found", 4: "no_key", 5: "duplicate_group",
        6: "by_id", 7: "by_name", 8: "by_id"}
    assert by_row == {
        1: {"RL.N", "AB.X", "OREP.PA"},
        6: {"T.N"},
        7: {"RL.N", "ITX.MC", "AB.X"},
        8: {"LONE.X"},
    }
    opened = {r["row_number"]: r for r in groups.collect()}
    assert opened[1]["sectors"] == ["Consumer", "it"]
    assert opened[6]["sectors"] == []
    assert opened[6]["group_type"] == "Sub-Industry"
    assert opened[8]["group_type"] == "Self"


def test_name_hit_without_id_opens_its_group(spark, entities):
    rows = [(1, 0, 3, "Acme Steel", "Acme", "Steel", None, None), (2, 0, 3, "Acme Steel", "Acme", "Steel", None, "ACM.N")]
    status, by_row, _ = run_requests(spark, entities(rows), [("acme steel", None, None, None, None)])
    assert status == {1: "by_name"} and by_row == {1: {"ACM.N"}}


def test_a_request_without_sector_asks_for_all_files(spark, entities):
    asked = [(None, "RL.N", None, "X", "Consumer"), (None, "OREP.PA", None, "X", None)]
    groups = run_requests(spark, entities(ROWS), asked)[2].collect()
    assert [r["sectors"] for r in groups] == [[]]


def test_default_choice_comes_from_first_row(spark):
    rows = [(None, None, "X", None, None), ("a", None, None, "X", None), ("b", None, None, "Y", None)]
    got = requests.group_choice(requests_df(spark, rows)).orderBy("row_number").collect()
    assert [r["group_choice"] for r in got] == ["Sub-Industry", "Focus", "Sub-Industry"]
    rows[0] = (None, None, "X", "x", None)
    got = requests.group_choice(requests_df(spark, rows)).orderBy("row_number").collect()
    assert [r["group_choice"] for r in got] == ["Focus", "Focus", "Focus"]


def test_first_match_ignores_partitioning(spark, entities):
    rows = [(f, s, r, f"H{f}{s}{r}", "U", "S", "F", "X") for f in (2, 1) for s in (1, 0) for r in (5, 4)]
    for n in (1, 3, 8):
        got = joins.first_per_key(entities(rows).repartition(n), ["id"], ["holding"]).collect()
        assert [r["holding"] for r in got] == ["H104"]


def test_name_and_id_lookups(spark, entities):
    names = spark.createDataFrame([("RALPH lauren",), ("nobody",)], "name string")
    got = {r["name"]: r["id"] for r in e.name_to_id(names, entities(ROWS)).collect()}
    assert got == {"RALPH lauren": "RL.N", "nobody": ""}
    ids = spark.createDataFrame([("rl.n",), ("zz",), ("T.N",)], "id string")
    got = {r["id"]: r["name"] for r in e.id_to_name(ids, entities(ROWS)).collect()}
    assert got == {"rl.n": "Ralph Lauren", "zz": "", "T.N": ""}


def test_distinct_fields(spark):
    rows = [(3, "v", "TR.EBIT"), (1, "v", " TR.EBIT "), (2, "s", None), (4, "s", "Cap")]
    df = spark.createDataFrame(rows, "ord int, origin string, field string")
    got = {tuple(r) for r in requests.distinct_fields(df).select("ord", "origin", "field").collect()}
    assert got == {(1, "v", "TR.EBIT"), (4, "s", "Cap")}


def test_hot_group_is_spread_over_tasks(spark, entities):
    rows = [(1, 0, i, None, f"U{i}", "Big", None, f"I{i}") for i in range(4000)]
    groups = durable(spark.createDataFrame([("Sub-Industry", "Big")], "group_type string, group_value string"))
    joined = joins.salted_join(
        peers.memberships(entities(rows)), groups, peers.GROUP, "inner", ["id"]
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 4000
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 2000


@pytest.fixture
def met(monkeypatch):
    """How many pairs of a text and a needle that it is compared with each search made."""
    pairs = []
    look = e.lookup

    def counted(*args, **options):
        out = look(*args, **options)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(e, "lookup", counted)
    return pairs


def test_needles_that_share_their_trigrams_are_not_all_compared(spark, entities, met):
    rows = [(1, 0, i, None, f"Customer#{i:07d}", "s", None, f"I{i}") for i in range(0, 30000, 10)]
    wanted = spark.createDataFrame([(f"customer#{i:06d}",) for i in range(6000)], "needle string")
    found = {x["needle"]: x["id"] for x in e.find_by_name(wanted, entities(rows)).collect()}
    assert found == {f"customer#{i:06d}": f"I{i * 10}" for i in range(3000)}
    assert met[0] <= 2 * len(rows)


def test_needles_of_many_lengths(spark, entities, any_join):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdé ") for _ in range(400))
    rows = [(1, 0, i, text[i : i + n], None, "s", None, f"I{i}") for i, n in enumerate(rng.choices(range(1, 90), k=300))]
    rows.append((1, 0, 300, "ab" * 40, "", "s", None, "I300"))
    needles = sorted({text[i : i + n].lower() for i, n in zip(rng.choices(range(330), k=80), rng.choices(range(2, 70), k=80))} | {"ab" * 30, "ba" * 30 + "a"})
    want = {}
    for n in needles:
        hits = [r for r in rows if len(n) >= 4 and n in r[3]]
        if hits:
            want[n] = hits[0][7]
    found = e.find_by_name(spark.createDataFrame([(n,) for n in needles], "needle string"), entities(rows)).collect()
    assert {r["needle"]: r["id"] for r in found} == want
    assert len(want) > 10
    none = spark.createDataFrame([("abc",), (None,)], "needle string")
    assert e.find_by_name(none, entities(rows)).count() == 0


def test_sectors_of_many_ids_are_not_salted(spark, entities, monkeypatch):
    rows = [(1, 0, i, None, "U", "s", None, f"I{i}") for i in range(6)]
    found = entities(rows).withColumn("file", F.when(F.col("row_idx") < 3, "Health_Care.xlsx").otherwise("Overview.xlsx"))
    ids = spark.createDataFrame([(" i1 ",), ("I4",), ("I9",)], "id string")
    monkeypatch.setattr(joins, "SMALL_ROWS", 0)
    monkeypatch.setattr(joins.lookup, "__defaults__", ("inner", (), 0, None))
    out = entity_sectors(ids, found)
    assert "_salt" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["id"], r["sector"]) for r in out.collect()} == {(" i1 ", "Health Care"), ("I4", None), ("I9", None)}
