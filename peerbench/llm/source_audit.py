"""Source divergence audit: how far the sources of a language differ in their terms.

1. Each task takes slices of whole documents. In a slice's Arrow buffer every term's start is a pointer;
   the pointers are sorted by the terms they point at, by multikey quicksort with eight bytes to a key:
   what is equal after eight bytes is sorted on by the next eight. Equal terms then stand in runs.
   Pointers enter in the order of their group (language and source) and document, which the sort
   keeps, so a run also tells each group's occurrences and documents.
2. Runs are summed per (language, source, term) over all slices, then per (language, term). A term is
   kept where at least `least_docs` documents of the language have it.
3. Shares are whole numbers (parts of 1,000,000,000, one count added to each term). Terms that a source
   doesn't have all share one value, so a pair of sources needs its own terms only: by how many terms of a
   source have a count, and a correction for each term that both have. Corrections are added up in
   tasks per pair of sources before anything is shuffled.

All sums are exact: shares are at most 1,000,000,001, so a square fits 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerbench.session import durable

LEAST_DOCS = 3
MOST_TERMS = 200
PARTS = 1_000_000_000
SLICE_BYTES = 1 << 23  # of text sorted at a time; a longer document is a slice of its own
PAIRS = 1 << 20  # of sources handled at a time
ROWS = 1 << 16  # handed on at a time
KEY = 8

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
#: The byte as it counts in a term, 0 where it stands in none.
LETTER = np.where((_lower >= 97) & (_lower <= 122) | (_lower >= 128), _lower, 0).astype(np.uint8)

#: Masks of the first 0, 1, ... 8 bytes of a key.
KEPT = np.array([(0xFFFFFFFFFFFFFFFF << 8 * (KEY - n)) & 0xFFFFFFFFFFFFFFFF for n in range(KEY + 1)], np.uint64)

_RUNS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("n", pa.int64())])


def pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms of documents that stand one behind the other in `data` (letters or 0)."""
    inside = data != 0
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a term ends with its document
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(starts).astype(np.int32), (np.flatnonzero(ends) + 1).astype(np.int32)


def sort_pointers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pointers by term, equal ones as they were, and where in it a run begins."""
    padded = np.concatenate([data, np.zeros(KEY, np.uint8)])
    eights = np.ndarray((len(data) + 1,), ">u8", padded.data, strides=(1,))
    order, begins = np.arange(len(starts), dtype=np.int32), np.zeros(len(starts), bool)
    at, run, depth = order.copy(), None, 0
    while len(at):
        some = order[at]
        here = np.minimum(starts[some] + depth, ends[some])
        left = np.minimum(ends[some] - here, KEY)
        key = eights[here].astype(np.uint64) & KEPT[left]  # without what stands behind the term
        by = np.argsort(key, kind="stable") if run is None else np.lexsort((key, run))
        order[at], key = some[by], key[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        if run is not None:
            fresh[1:] |= run[1:] != run[:-1]
        begins[at] = fresh
        run = np.cumsum(fresh, dtype=np.int32) - 1
        going = (key & np.uint64(255) != 0) & (np.bincount(run)[run] > 1)
        at, run, depth = at[going], run[going], depth + KEY
    return order, begins


def slice_runs(table: pa.Table) -> pa.RecordBatch:
    """(lang, source, term, docs, n) of a slice; a row without a term (docs: all documents) per group."""
    table = table.combine_chunks()
    lang, source = (table.column(c).chunk(0).dictionary_encode() for c in ("lang", "source"))
    codes = [x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, source)]
    pairs, group = np.unique(codes[0] * len(source.dictionary) + codes[1], return_inverse=True)
    group = group.astype(np.int32)
    text = table.column("text").chunk(0).cast(pa.large_string())
    bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    data, offsets = LETTER[raw], bounds - bounds[0]
    starts, ends = pointers(data, offsets)
    doc = (np.searchsorted(offsets, starts, "right") - 1).astype(np.int32)
    by_group = np.argsort(group[doc], kind="stable")
    starts, ends, doc = starts[by_group], ends[by_group], doc[by_group]

    order, begins = sort_pointers(data, starts, ends)
    of, docs_at = group[doc][order], doc[order]
    row = begins.copy()  # a row begins with a run, or with the next group in it
    row[1:] |= of[1:] != of[:-1]
    new_doc = row.copy()
    new_doc[1:] |= docs_at[1:] != docs_at[:-1]
    firsts = np.flatnonzero(row)
    n = np.diff(np.append(firsts, len(order)))
    docs = np.add.reduceat(new_doc.astype(np.int64), firsts) if len(firsts) else n

    first = order[np.flatnonzero(begins)]
    sizes = ends[first] - starts[first]
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    letters = data[np.arange(cuts[-1]) + np.repeat(starts[first] - cuts[:-1], sizes)]
    terms = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(letters)])
    term = terms.take(pa.array(np.cumsum(begins)[firsts] - 1)).cast(pa.string())

    of = np.concatenate([of[firsts], np.arange(len(pairs))])
    width = max(1, len(source.dictionary))
    columns = [
        lang.dictionary.take(pa.array(pairs[of] // width)),
        source.dictionary.take(pa.array(pairs[of] % width)),
        pa.concat_arrays([term, pa.array([""] * len(pairs), pa.string())]),
        pa.array(np.concatenate([docs, np.bincount(group, minlength=len(pairs))]).astype(np.int64)),
        pa.array(np.concatenate([n, np.zeros(len(pairs), np.int64)]).astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _RUNS, strict=True)], schema=_RUNS)


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Whole documents, about `most` bytes at a time."""
    held, size = [], 0
    for batch in batches:
        sizes = np.cumsum(np.array(batch.column("bytes"), np.int64))
        done = 0
        while done < batch.num_rows:
            before = sizes[done - 1] if done else 0
            to = min(int(np.searchsorted(sizes, before + most - size)) + 1, batch.num_rows)
            held.append(batch.slice(done, to - done))
            size, done = size + int(sizes[to - 1] - before), to
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, docs, n) over all documents; the empty term's `docs` is a group's documents.

    Nulls count as ''. Terms are runs of letters: A-Z (lowered), a-z and everything beyond ASCII. A repeated
    row is a document of its own. An empty table gives no rows.
    """
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    most = SLICE_BYTES
    rows = docs.select(own(lang_col).alias("lang"), own(source_col).alias("source"), own(text_col).alias("text"))
    runs = rows.withColumn("bytes", F.octet_length("text").cast("long")).mapInArrow(
        lambda batches: (runs.slice(k, ROWS) for s in _slices(batches, most) for runs in (slice_runs(s),) for k in range(0, runs.num_rows, ROWS)),
        "lang string, source string, term string, docs long, n long",
    )
    return runs.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def share(count: Column, size: Column, terms: Column) -> Column:
    """1 + floor(PARTS * (count + 1) / (size + terms)); the product is exact beyond 64 bits, too."""
    product = F.lit(PARTS).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.call_function("div", product, (size + terms).cast("decimal(19,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


_BOTH = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources, over the terms that both have: what their own shares make of the value
    in place of those of a term that one doesn't have. A row per term comes in, with its sources."""
    for batch in batches:
        entries = batch.column("sources").flatten()
        lang = batch.column("lang").dictionary_encode()
        source = entries.field("source").dictionary_encode()
        p, p0 = (entries.field(c).to_numpy(zero_copy_only=False) for c in ("p", "p0"))
        codes = source.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.array(batch.column("sources").value_lengths(), np.int64)
        langs = np.repeat(lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)  # of each entry's term
        partners = np.repeat(sizes, sizes)
        upto, start, width = np.cumsum(partners), 0, len(source.dictionary)
        while start < len(p):
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + PAIRS, "right")))
            many = partners[start:end]
            a = np.repeat(np.arange(start, end), many)
            b = np.arange(len(a)) + np.repeat(begin[start:end] - (np.cumsum(many) - many), many)
            apart = a != b
            a, b, start = a[apart], b[apart], end
            if not len(a):
                continue
            value = _distance(p[a], p[b]) - _distance(p[a], p0[b]) - _distance(p0[a], p[b]) + _distance(p0[a], p0[b])
            key = (langs[a] * width + codes[a]) * width + codes[b]
            by = np.argsort(key, kind="stable")
            key = key[by]
            firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sums, key = np.add.reduceat(value[by], firsts), key[firsts]
            of = (lang.dictionary.take(pa.array(key // width**2)), *(source.dictionary.take(pa.array(x)) for x in (key // width % width, key % width)))
            yield pa.RecordBatch.from_arrays([*of, pa.array(sums)], schema=_BOTH)


class SourceAudit:
    """The counts behind an audit, each a written table.

    `kept`: lang, term, total, sources (of each its name and count); `groups`: lang, source, size (N), own
    (how many kept terms it has), terms (V), lang_size and p0 (its share of a term it doesn't have, null without terms).
    """

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS):
        counts = durable(term_counts(docs, text_col, lang_col, source_col))
        self.kept = durable(
            counts.filter("term <> ''")
            .groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources"))
            .filter(F.col("docs") >= least_docs)
            .drop("docs")
        )
        entries = self.kept.select("lang", "term", "total", F.inline("sources"))
        sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("own"))
        langs = self.kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
        groups = (
            counts.filter("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        ).fillna(0, ["size", "own", "terms", "lang_size"])
        some = F.when(F.col("terms") > 0, F.col("terms"))
        self.groups = durable(groups.withColumn("p0", share(F.lit(0), F.col("size"), some)))
        self.entries = entries.join(self.groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("size"), F.col("terms")))

    def terms(self, most: int = MOST_TERMS) -> DataFrame:
        """lang, source, item, value, rank: the terms a source has more of than its language."""
        q = share(F.col("total"), F.col("lang_size"), F.col("terms"))
        more = self.entries.withColumn("q", q).filter("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
        return _ranked(more).filter(F.col("rank") <= most)

    def pairs(self) -> DataFrame:
        """lang, source, item, value, rank: every other source of the language, the farthest first."""
        a, b = (self.groups.select("lang", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "size", "own", "terms", "p0")]) for x in "ab")
        pairs = a.join(b, "lang").filter("source_a <> source_b")  # a row for each row of the result
        bare = (F.col("terms_a") - F.col("own_a") - F.col("own_b")) * distance(F.col("p0_a"), F.col("p0_b"))
        neither = pairs.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), F.coalesce(bare, F.lit(0)).alias("value"))

        # A source's shares by count: as many different ones as it has different counts.
        shares = self.entries.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
        one = {}
        for x, other in ("ab", "ba"):
            side = shares.select("lang", F.col("source").alias(f"source_{x}"), "p", "times")
            met = pairs.join(side, ["lang", f"source_{x}"])
            p, q = (F.col("p"), F.col(f"p0_{other}")) if x == "a" else (F.col(f"p0_{other}"), F.col("p"))
            one[x] = met.groupBy("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item")).agg(F.sum(F.col("times") * distance(p, q)).alias("value"))
        together = self.entries.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("sources"))
        both = together.filter("size(sources) > 1").select("lang", "sources").mapInArrow(_corrections, "lang string, source string, item string, value long")
        parts = neither.unionByName(one["a"]).unionByName(one["b"]).unionByName(both)
        return _ranked(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))

    def report(self, most: int = MOST_TERMS) -> DataFrame:
        """lang, source, part (pair or term), item, value, rank; from 1 by value, greatest first, ties by item.

        A group without terms has pairs but no terms; a language without kept terms has pairs of value 0; a
        source that is its language's only one has no pairs. An empty table gives no rows.
        """
        parts = [f.withColumn("part", F.lit(name)) for name, f in (("pair", self.pairs()), ("term", self.terms(most)))]
        return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


def _ranked(rows: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", place)
