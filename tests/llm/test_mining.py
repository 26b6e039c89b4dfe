"""Collocations, the hidden Markov model and the source audit, against brute force and by hand."""

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerbench.llm import collocations, hidden_markov, packing, source_audit
from peerbench.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, chunk string, code long, n long, page string"


def table(frame, rows):
    return frame([(*r, "c", 1, 2, "p") for r in rows], DOCS)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- collocations ------------------------------------------------------------


def brute_collocations(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang or "und"][tuple(w[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        told = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            longer = [q for q, c in often.items() if len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if longer:
                continue
            cuts = [(1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            told.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(told)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def test_collocations_are_brute_force(spark, frame):
    r = random.Random(5)
    words = [*"abcdefgh", "Ä", "é", "the"]
    rows = [(1, None, "en", "s"), (2, "", None, "s"), (3, "a b. c,d\x0be f", None, None), (3, "a b. c,d\x0be f", None, None)]
    for i in range(120):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", ". ", "\n", "  ", "!"]) for _ in range(r.randrange(40)))
        rows.append((i, text + " The quick BROWN fox jumps", r.choice(["en", "de", None]), "s"))
    rows.append((999, "x y z " * 5000, "en", "s"))
    for least, longest, top in ((3, 5, 2000), (2, 3, 7)):
        found = collocations.collocations(table(frame, rows).repartition(4), least, longest, top)
        got = sorted(tuple(x) for x in found.collect())
        assert got == brute_collocations(rows, least, longest, top) and len(got) > 10


def test_collocations_over_several_chunks_and_pages(spark, frame, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_WORDS", 50)
    monkeypatch.setattr(collocations, "PAGE", 16)
    monkeypatch.setattr(packing, "SHARD", 40)
    r = random.Random(6)
    rows = [(i, " ".join(r.choice("abcde") for _ in range(60)), "en", "s") for i in range(30)]
    pages = list(collocations._pages(collocations._ROUND, (np.arange(100, dtype=np.int32),), chunk=1, kind="codes"))
    assert len(pages) == 7
    found = collocations.collocations(table(frame, rows).coalesce(1), 5, 4, 50)
    assert sorted(tuple(x) for x in found.collect()) == brute_collocations(rows, 5, 4, 50)


def test_packed_columns_come_back():
    columns = (np.arange(50, dtype=np.int64) << 33, np.arange(50, dtype=np.int32)[::-1].copy(), np.zeros(50, np.int64))
    for n in (0, 1, 50):
        packed = packing.pack(*[c[:n] for c in columns])
        back = packing.unpack(packed["data"], packed["size"], (np.int64, np.int32, np.int64))
        assert all(np.array_equal(a[:n], b) for a, b in zip(columns, back, strict=True))


def test_nothing_to_find_gives_no_rows(spark, frame):
    for rows in ([], [(1, None, None, None)], [(1, "a b", "en", "s")]):
        assert collocations.collocations(table(frame, rows)).collect() == []


def test_pairs_in_dense_and_sparse_tiles():
    r = np.random.default_rng(1)
    a = np.concatenate([r.integers(0, 40, 90000), r.integers(0, 9000, 5000), r.integers(600, 620, 50000)])
    b = np.concatenate([r.integers(0, 40, 90000), r.integers(0, 9000, 5000), r.integers(1100, 1120, 50000)])
    left, right, n = collocations.count_pairs(a, b)
    assert dict(zip(zip(left.tolist(), right.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(a.tolist(), b.tolist(), strict=True))


def test_scores_beyond_64_bits_are_exact(spark):
    a, n = 4_000_000_123, 9_000_000_000_001
    left, right = 5_000_000_007, 6_000_000_011
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(n).alias("n"), F.array(F.lit(left)).alias("first"), F.array(F.lit(right)).alias("last"))
    got = row.select(collocations._cut(1, F.lit(2), F.col("a"), F.col("n")).alias("c")).select("c.*").first()
    assert tuple(got) == (1000 * a * n // (left * right), 1, left, right)


# --- hidden Markov model -----------------------------------------------------


def test_forward_is_the_sum_over_all_paths():
    r = np.random.default_rng(3)
    k, v = 3, 5
    pi, move, emit = (x / x.sum(axis=-1, keepdims=True) for x in (r.random(k), r.random((k, k)), r.random((k, v))))
    docs = sorted((r.integers(0, v, n) for n in (1, 4, 2, 5, 5)), key=len, reverse=True)
    block = hidden_markov.Block(docs)
    got = block.likelihood(pi, move, emit) * math.log(10)
    states, moves, first = block.expected(pi, move, emit)
    want_states, want_moves = np.zeros((v, k)), np.zeros((k, k))
    for d, doc in enumerate(docs):
        total, by_path = 0.0, []
        for path in itertools.product(range(k), repeat=len(doc)):
            p = pi[path[0]] * emit[path[0], doc[0]]
            for i in range(1, len(doc)):
                p *= move[path[i - 1], path[i]] * emit[path[i], doc[i]]
            total += p
            by_path.append((p, path))
        assert math.isclose(got[d], math.log(total), rel_tol=1e-9)
        for p, path in by_path:
            for i, s in enumerate(path):
                want_states[doc[i], s] += p / total
                if i:
                    want_moves[path[i - 1], s] += p / total
    found = np.zeros((v, k))
    np.add.at(found, block.symbols, states.T)
    assert np.allclose(found, want_states) and np.allclose(moves, want_moves) and math.isclose(first.sum(), len(docs))


def corpus(r, n):
    voices = [[f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]]
    return [" ".join(r.choice(r.choice(voices) if r.random() < 0.1 else voices[i % 2]) for _ in range(r.randrange(1, 40))) for i in range(n)]


def test_model_is_a_distribution_and_learns(spark, frame):
    texts = corpus(random.Random(2), 400)
    rows = [(i, t, "x", "s") for i, t in enumerate(texts)] + [(1000, None, "x", "s"), (1001, "", "x", "s"), (1001, "NEVER seen " * 3000, "x", "s"), (None, "a1", None, None)]
    model = hidden_markov.HiddenMarkov(table(frame, rows).coalesce(1), states=3, rounds=3)
    stored = model.docs.rows().filter("codes IS NULL").first()
    code, symbol, c = packing.unpack(stored["data"], stored["size"], hidden_markov._SYMBOL)
    assert len(set(symbol.tolist())) == len(symbol) == 15  # one chunk has all symbols: 14 words and the end
    counts = packing.joined([packing.unpack(r["data"], r["size"], (np.uint16,) * 3) for r in model.params.orderBy("shard").collect()], (np.uint16,) * 3)
    assert np.allclose(model.emissions.matrix(code, c, counts).sum(axis=1), 1)
    assert np.allclose(model.move.sum(axis=1), 1) and math.isclose(model.pi.sum(), 1)
    found = model.score().collect()
    assert len(found) == len(rows)
    by_text = {r["doc_id"]: r for r in found if r["doc_id"] is not None and r["doc_id"] < 400}
    held = [r for r in by_text.values() if r["held_out"] and r["n_tokens"] > 10]
    assert len(held) > 10 and sum(r["score"] > r["base_score"] for r in held) > 0.9 * len(held)
    empty = [r for r in found if r["doc_id"] in (1000, 1001) and r["n_tokens"] == 1]
    assert len(empty) == 2 and math.isclose(empty[0]["score"], empty[1]["score"])
    for parts in (1, 4):
        other = hidden_markov.HiddenMarkov(table(frame, rows).repartition(parts), states=3, rounds=3)
        assert np.allclose(model.move, other.move, atol=0.01) and np.allclose(model.emissions.mass, other.emissions.mass, rtol=0.01)
    again = hidden_markov.HiddenMarkov(table(frame, rows).coalesce(1), states=3, rounds=3)
    assert np.array_equal(model.move, again.move) and np.array_equal(model.emissions.mass, again.emissions.mass)


def test_documents_are_dealt_to_their_chunks_once(spark, frame, monkeypatch):
    exchanges, append = [], hidden_markov.BucketedTable.append

    def noted(self, df, together=False):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges.append((plan.count("Exchange hashpartitioning"), together))
        append(self, df, together)

    monkeypatch.setattr(hidden_markov.BucketedTable, "append", noted)
    rows = [(i, t, "x", "s") for i, t in enumerate(corpus(random.Random(4), 200))]
    model = hidden_markov.HiddenMarkov(table(frame, rows).repartition(5, "doc_id"), states=2, rounds=1)
    numbered, facts = exchanges
    assert numbered[1] is False and facts == (1, True)  # only the words' counts move to where the documents are
    assert len({r["chunk"] for r in model.docs.rows().select("chunk").collect()}) == 5
    assert sorted(r["doc_id"] for r in model.score().collect()) == list(range(200))
    assert not [x for x in os.listdir(re.sub("^file:", "", os.path.dirname(model.docs.path))) if x.endswith("-numbered")]


def test_nothing_to_learn_from(spark, frame):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = hidden_markov.HiddenMarkov(table(frame, [(held, "some words", "x", "s")])).score().first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert math.isclose(row["score"], 0, abs_tol=1e-9) and math.isclose(row["base_score"], 0, abs_tol=1e-9)
    assert hidden_markov.HiddenMarkov(table(frame, [])).score().collect() == []


def test_registered_scores(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokens = {i: [*re.findall("[^ \t-\r]+", lower(t)), ""] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total, kinds = sum(counts.values()), len(counts)
    found = QUERIES["op12_hidden_markov"](spark, sf).collect()
    assert {r["doc_id"] for r in found} == set(docs) and len(found) == len(docs)
    for r in found:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    apart = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in apart) > sum(r["base_score"] for r in apart)


# --- source audit ------------------------------------------------------------


def test_pointers_are_sorted_by_term():
    r = random.Random(4)
    words = ["".join(r.choice("ab") for _ in range(r.randrange(1, 30))) for _ in range(500)] + ["abcdefgh", "abcdefghi", "é" * 9] * 3
    text = " ".join(words).encode()
    data = source_audit.LETTER[np.frombuffer(text, np.uint8)]
    starts, ends = source_audit.pointers(data, np.array([0, len(data)]))
    order, begins = source_audit.sort_pointers(data, starts, ends)
    got = [bytes(text[starts[i] : ends[i]]) for i in order]
    assert got == sorted(w.encode() for w in words)
    assert [i for i, b in enumerate(begins) if b] == [i for i, w in enumerate(got) if not i or got[i - 1] != w]
    assert all(a < b for a, b, fresh in zip(order, order[1:], begins[1:], strict=False) if not fresh)


def brute_audit(rows, least, most):
    docs, counts, groups = Counter(), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        group = (lang or "", source or "")
        groups.add(group)
        terms = re.findall("[a-z\u0080-\U0010ffff]+", lower(text))
        counts[group].update(terms)
        docs.update((group[0], t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= least)
        own = {s: {t: counts[lang, s][t] for t in kept} for x, s in groups if x == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (n + 1) // (sum(c.values()) + len(kept)) for t, n in c.items()}
        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            far = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in own if o != s]
            over = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items, cut in (("pair", far, None), ("term", over, most)):
                placed = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:cut]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(placed, 1)]
    return sorted(out)


@pytest.mark.parametrize("slice_bytes", [1, 1 << 23])
def test_audit_is_brute_force(spark, frame, monkeypatch, slice_bytes):
    monkeypatch.setattr(source_audit, "SLICE_BYTES", slice_bytes)
    r = random.Random(8)
    words = ["alpha", "Beta", "gammaé", "internationalisation", "internationalism", "x", "y2z", "世界"]
    rows = [(1, None, None, None), (2, "", "en", "empty"), (3, "1 2 3", "xx", "only"), (4, "lone", "yy", "a"), (5, "other", "yy", "b")]
    rows += [(i, " ".join(r.choice(words[: r.randrange(1, 9)]) for _ in range(r.randrange(30))), r.choice(["en", "de"]), r.choice(["a", "b", "c", None])) for i in range(80)]
    rows += [rows[-1], (7, "alpha " * 20000, "en", "a")]
    found = source_audit.SourceAudit(table(frame, rows).repartition(3)).report(5)
    got = sorted((x["lang"], x["source"], x["part"], x["item"], x["value"], x["rank"]) for x in found.collect())
    assert got == brute_audit(rows, 3, 5)


def test_audit_of_nothing(spark, frame):
    assert source_audit.SourceAudit(table(frame, [])).report().collect() == []


def test_shares_of_great_counts_are_exact(spark):
    c, size, terms = 8_000_000_000_007, 9_000_000_000_011, 123_457
    row = spark.range(1).select(F.lit(c).alias("c"), F.lit(size).alias("s"), F.lit(terms).alias("v"))
    assert row.select(source_audit.share(F.col("c"), F.col("s"), F.col("v"))).first()[0] == 1 + 10**9 * (c + 1) // (size + terms)
