"""Queries against their SQL twins, and what SQL can't say against brute force or a round trip."""

import re
from pathlib import Path

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare_rows
from peerbench.llm import language_id
from peerbench.llm.queries import MODEL_FILE, ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, sf, name):
    assert compare_rows(QUERIES[name](spark, sf), con, name).startswith("ok")


def test_languages_of_documents_that_were_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = QUERIES["op3_language_id"](spark, sf).filter("held_out").join(docs, "doc_id")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n == docs.filter(language_id.held_out(F.col("doc_id"))).count() and right > 0.9


def test_pipeline_keeps_what_brute_force_keeps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = docs.columns
        docs = stage(spark, docs, sf)
        assert docs.columns == before, name
    rows = docs.collect()
    texts = [" ".join(r["text"].lower().split()) for r in rows]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    assert len(rows) == len({r["doc_id"] for r in rows}) > 100
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert not linked


def test_pipeline_rows_are_those_of_all_stages_by_hand(spark, con, sf):
    docs = {i: t or "" for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    names = [d[0] for d in con.execute(ORACLES["op9_quality_rules"]).description]
    good = sorted(r[names.index("doc_id")] for r in con.fetchall() if r[names.index("kept")])
    first = {}
    for i in good:
        first.setdefault(" ".join(re.split("[ \t-\r]+", docs[i])), i)
    ids = sorted(first.values())
    sets, group = [], list(range(len(ids)))
    for i in ids:
        w = docs[i].lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    for i in range(len(ids)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = [a if x == b else x for x in group]
    left = [i for k, i in enumerate(ids) if group[k] == k]
    assert 100 < len(left) < len(ids) < len(good) < len(docs)
    mixed = duckdb.connect()
    mixed.execute(f"CREATE TABLE documents AS SELECT * FROM '{sf}/documents.parquet' WHERE doc_id IN ({','.join(map(str, left))})")
    names = [d[0] for d in mixed.execute(ORACLES["op5_mixing"]).description]
    copies = {r[names.index("doc_id")]: r[names.index("copies")] for r in mixed.fetchall()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    expected = sorted((i, sp.encode(docs[i])) for i in left for _ in range(copies[i]))
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == expected and all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_registered_pieces_and_pseudonyms(spark, con, sf):
    docs = {i: t or "" for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    pieces = QUERIES["op6_sentencepiece"](spark, sf).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in pieces} == {i: sp.encode(t) for i, t in docs.items()} and len(pieces) == len(docs)
    assert all(r["exact"] == ("\u2581" not in docs[r["doc_id"]]) for r in pieces)
    hidden = QUERIES["op8_pii"](spark, sf).collect()
    assert len(hidden) == len(docs) and {r["doc_id"] for r in hidden} == set(docs) and sum(r["n_found"] for r in hidden) > 0
    mail = re.compile(r"[A-Za-z0-9._]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}|\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}")
    for r in hidden:
        old, new = docs[r["doc_id"]], r["text"] or ""
        assert len(mail.findall(old)) == len(mail.findall(new)) and not set(mail.findall(old)) & set(mail.findall(new))
        assert r["n_found"] or old == new
