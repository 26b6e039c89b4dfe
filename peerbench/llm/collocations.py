"""Phrase collocation mining by direct-address tiling.

1. Each task cuts its texts into chunks of one language: a chunk has its words numbered as they first come and
   its text as an array of these numbers, with a break between pieces. No text is shuffled.
2. The chunks' words are dealt by hash to shards, packed many to a row, and added up there; frequent ones get
   an id. Each chunk gets the ids and frequencies of its own words back and ranks them by frequency. So
   no worker holds the whole vocabulary.
3. Pairs of neighbours in a chunk are counted in tiles of TILE x TILE ranks: a tile with many pairs by direct
   address (numpy's bincount over its cells), the others by sorting their coordinates. The counted pairs are
   dealt to shards and added up as words are.
4. The frequent pairs are ranked anew and take the words' place: two neighbouring pairs share a word, so a pair of
   pairs is a phrase of three words, and so on, up to the longest phrase. A phrase that is frequent has
   frequent parts only, so each round's pairs are all candidates there can be.
5. A phrase's first and last parts are frequent phrases of the rounds before, so every cut finds its counts
   in the phrase's own row.

There are as many shards as give each SHARD entries, however large the input; what a round has written is
removed when the next one has been written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerbench.llm.packing import DEALT, SHARDS_DDL, WORD_ENTRY, Numbers, by_shard, deal_words, expand, joined, pack, rows, shards, squeeze, unpacked
from peerbench.session import durable, release

LEAST = 100
LONGEST = 5
TOP = 2000
PERCENT = 100
UNKNOWN = "und"
HELD_WORDS = 1 << 21  # that a task numbers before it hands its chunks on
PAGE = 1 << 18  # numbers in a row
TILE_BITS = 9
DENSE = 1 << 15  # pairs from which a tile is counted by direct address

#: Ends a piece: a stop or a line break becomes one line break.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)

_CHUNKS = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("page", pa.int32()), ("size", pa.int64()), ("data", pa.binary()), ("words", pa.binary()), ("words_size", pa.int64()), ("n", pa.int64())])
_CHUNKS_DDL = "chunk long, lang string, page int, size long, data binary, words binary, words_size long, n long"
_ROUND = pa.schema([("chunk", pa.int64()), ("kind", pa.string()), ("page", pa.int32()), ("size", pa.int64()), ("data", pa.binary()), ("n", pa.int64())])
_ROUND_DDL = "chunk long, kind string, page int, size long, data binary, n long"
_MERGED = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("left", pa.int64()), ("right", pa.int64()), ("f", pa.int64()), ("chunk", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])
_MERGED_DDL = "id long, lang string, word string, left long, right long, f long, chunk long, size long, data binary"

_PAIR_ENTRY = (np.int64, np.int64, np.int64, np.int64)  # chunk, left, right, n
_WORD_RANK = (np.int32, np.int64, np.int64)  # code, id, f
_PAIR_RANK = (np.int64, np.int64, np.int64, np.int64)  # left, right, id, f


class _Chunk:
    """The words of one language's texts as numbers, -1 after each piece."""

    def __init__(self) -> None:
        self.numbers, self.parts, self.held = Numbers(), [], 0

    def add(self, text: str) -> int:
        words, sizes = [], []
        for piece in text.encode("utf-8", "replace").lower().translate(_ENDS).split(b"\n"):
            own = piece.split()
            if own:
                words += own
                sizes.append(len(own))
        if words:
            codes = np.full(len(words) + len(sizes), -1, np.int32)
            codes[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)] = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
            self.parts.append(codes)
            self.held += len(words)
        return len(words)


def _pages(schema: pa.Schema, numbers: tuple[np.ndarray, ...], **columns) -> Iterator[pa.RecordBatch]:
    """Rows of PAGE entries each, numbered by page."""
    for page, k in enumerate(range(0, len(numbers[0]), PAGE)):
        part = [x[k : k + PAGE] for x in numbers]
        own = {**columns, "page": page, **pack(*part)}
        if "n" not in columns:
            own["n"] = len(part[0])
        yield rows(schema, **{c: [v] for c, v in own.items()})


def _unpaged(table: pa.Table, kinds: tuple[type, ...]) -> list[np.ndarray]:
    order = np.argsort(np.array(table.column("page"), np.int64), kind="stable")
    return joined(list(unpacked(table.take(pa.array(order)), kinds)), kinds)


def _number(held_words: int):
    """Chunks: their text as pages of numbers (n: null), their words with counts (n: how many words the chunk has)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, _Chunk] = {}
        held, made = 0, TaskContext.get().partitionId() << 24

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang, chunk in chunks.items():
                if not chunk.held:
                    continue
                codes = np.concatenate(chunk.parts)
                yield from _pages(_CHUNKS, (codes,), chunk=made, lang=lang, n=None)
                words = b"\n".join(chunk.numbers)
                n = np.bincount(codes[codes >= 0], minlength=len(chunk.numbers))
                own = {"chunk": made, "lang": lang, **pack(n.astype(np.int64)), "words": squeeze(words), "words_size": len(words), "n": chunk.held}
                yield rows(_CHUNKS, **{c: [v] for c, v in own.items()})
                made += 1

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                held += chunks.setdefault(lang.as_py(), _Chunk()).add(text.as_py())
                if held >= held_words:
                    yield from flush()
                    chunks, held = {}, 0
        yield from flush()

    return work


def _deal_pairs(count: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk, left, right, n = joined(parts, _PAIR_ENTRY)
            mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            yield from by_shard((mixed >> np.uint64(33)).astype(np.int64) % count, [chunk, left, right, n])

        for batch in batches:
            for chunk, (left, right, n) in zip(batch.column("chunk").to_pylist(), unpacked(batch, _PAIR_ENTRY[1:]), strict=True):
                parts.append([np.full(len(n), chunk, np.int64), left, right, n])
                size += len(n)
                if size >= DEALT:
                    yield from flush()
                    parts, size = [], 0
        yield from flush()

    return work


def _merged(shard: int, key: np.ndarray, n: np.ndarray, chunk: np.ndarray, least: int, units: Callable, ranks: Callable) -> pa.Table:
    """A shard's frequent units, and for each chunk what it has of them. `key` tells entries of different units apart.

    units: columns of the units, given an entry of each; ranks: columns of entries; both get ids or f besides.
    """
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(order) else np.empty(0, np.int64)
    f = np.add.reduceat(n[order], first) if len(first) else np.empty(0, np.int64)
    often = np.flatnonzero(f >= least)
    often = often[np.argsort(-f[often], kind="stable")]
    number = np.full(len(first), -1, np.int64)
    number[often] = np.arange(len(often))
    batches = [rows(_MERGED, id=shard << 32 | np.arange(len(often)), f=f[often], **units(order[first[often]]))]
    of = np.repeat(number, np.diff(np.append(first, len(order))))
    kept, of = order[of >= 0], of[of >= 0]
    by = np.argsort(chunk[kept], kind="stable")
    kept, of = kept[by], of[by]
    for some in np.split(np.arange(len(kept)), np.flatnonzero(np.diff(chunk[kept])) + 1) if len(kept) else []:
        own = {"chunk": int(chunk[kept[some[0]]]), **pack(*ranks(kept[some]), shard << 32 | of[some], f[often][of[some]])}
        batches.append(rows(_MERGED, **{c: [v] for c, v in own.items()}))
    return pa.Table.from_batches(batches, schema=_MERGED)


def _merge_words(least: int):
    def work(key: tuple, dealt: pa.Table) -> pa.Table:
        chunk, code, n = joined(list(unpacked(dealt, WORD_ENTRY)), WORD_ENTRY)
        words: list[bytes] = []
        langs = []
        for text, size, lang in zip(dealt.column("words"), dealt.column("words_size").to_pylist(), dealt.column("lang").to_pylist(), strict=True):
            own = expand(text.as_buffer(), size).split(b"\n")
            words += own
            langs += [lang] * len(own)
        word, lang = pa.array(words, pa.binary()).dictionary_encode(), pa.array(langs, pa.string()).dictionary_encode()
        unit = lang.indices.to_numpy().astype(np.int64) * len(word.dictionary) + word.indices.to_numpy()
        named = lambda x, kind: x.take(pa.array(kind)).dictionary_decode().cast(pa.string())
        return _merged(key[0].as_py(), unit, n, chunk, least, lambda at: {"lang": named(lang, at), "word": named(word, at)}, lambda at: [code[at]])

    return work


def _merge_pairs(least: int):
    def work(key: tuple, dealt: pa.Table) -> pa.Table:
        chunk, left, right, n = joined(list(unpacked(dealt, _PAIR_ENTRY)), _PAIR_ENTRY)
        (lefts, a), (rights, b) = (np.unique(x, return_inverse=True) for x in (left, right))
        unit = a * len(rights) + b
        return _merged(key[0].as_py(), unit, n, chunk, least, lambda at: {"left": left[at], "right": right[at]}, lambda at: [left[at], right[at]])

    return work


def count_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of ranks (a, b), and how often each occurs."""
    width = (max(a.max(initial=0), b.max(initial=0)) >> TILE_BITS) + 1
    tiles = (a >> TILE_BITS) * width + (b >> TILE_BITS)
    found, size = np.unique(tiles, return_counts=True)
    sparse, out = np.ones(len(a), bool), []
    mask = (1 << TILE_BITS) - 1
    for tile in found[size >= DENSE].tolist():
        here = tiles == tile
        sparse &= ~here
        cells = np.bincount((a[here] & mask) << TILE_BITS | b[here] & mask)
        some = np.flatnonzero(cells)
        out.append((tile // width * (mask + 1) + (some >> TILE_BITS), tile % width * (mask + 1) + (some & mask), cells[some]))
    keys, n = np.unique(a[sparse].astype(np.int64) << 32 | b[sparse], return_counts=True)
    out.append((keys >> 32, keys & 0xFFFFFFFF, n))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _ranked(chunk: int, codes: np.ndarray, ids: np.ndarray) -> pa.Table:
    """A chunk's next round: its units as places in `ids` (by frequency), the ids, and the counted pairs of neighbours."""
    batches = []
    both = (codes[:-1] >= 0) & (codes[1:] >= 0)
    left, right, n = count_pairs(codes[:-1][both], codes[1:][both])
    if len(n):
        batches += _pages(_ROUND, (codes,), chunk=chunk, kind="codes")
        batches += _pages(_ROUND, (ids,), chunk=chunk, kind="ids")
        batches += _pages(_ROUND, (ids[left], ids[right], n.astype(np.int64)), chunk=chunk, kind="pairs")
    return pa.Table.from_batches(batches, schema=_ROUND)


def _rank_words(key: tuple, pages: pa.Table, ranks: pa.Table) -> pa.Table:
    (codes,) = _unpaged(pages, (np.int32,))
    at, ids, f = joined(list(unpacked(ranks, _WORD_RANK)), _WORD_RANK)
    by = np.lexsort((ids, -f))
    places = np.full(max(at.max(initial=-1), codes.max(initial=-1)) + 2, -1, np.int32)  # the last one is for -1
    places[at[by]] = np.arange(len(by))
    return _ranked(key[0].as_py(), places[codes], ids[by])


def _rank_pairs(key: tuple, pages: pa.Table, ranks: pa.Table) -> pa.Table:
    kind = np.array(pages.column("kind").to_pylist(), object)
    (codes,), (units,) = (_unpaged(pages.filter(pa.array(kind == k)), (t,)) for k, t in (("codes", np.int32), ("ids", np.int64)))
    left, right, ids, f = joined(list(unpacked(ranks, _PAIR_RANK)), _PAIR_RANK)
    if not len(ids) or not len(codes):
        return _ROUND.empty_table()
    by = np.lexsort((ids, -f))
    sorted_units = np.argsort(units)
    place = lambda x: sorted_units[np.searchsorted(units, x, sorter=sorted_units)].astype(np.int64)
    known = place(left[by]) * len(units) + place(right[by])
    order = np.argsort(known)
    a, b = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
    asked = np.where((a >= 0) & (b >= 0), a * len(units) + b, -1)
    at = np.minimum(np.searchsorted(known[order], asked), len(known) - 1)
    return _ranked(key[0].as_py(), np.where(known[order][at] == asked, order[at], -1).astype(np.int32), ids[by])


def _merge(table: DataFrame, entries: int, deal: Callable, merge: Callable) -> DataFrame:
    dealt = table.mapInArrow(deal(shards(entries)), SHARDS_DDL)
    return durable(dealt.groupBy("shard").applyInArrow(merge, _MERGED_DDL))


def _next_round(pages: DataFrame, merged: DataFrame, rank: Callable) -> DataFrame:
    ranks = merged.filter("chunk IS NOT NULL").select("chunk", "size", "data")
    return durable(pages.groupBy("chunk").cogroup(ranks.groupBy("chunk")).applyInArrow(rank, _ROUND_DDL))


def _cut(k: int, length: Column, a: Column, n: Column) -> Column:
    """The score of the cut after k words; null where the phrase has no such cut."""
    wide = lambda c: c.cast("decimal(17,0)")
    left, right = F.get("first", F.lit(k - 1)), F.get("last", length - k - 1)
    product = wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", product, wide(left) * wide(right))
    return F.when(length > k, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(every frequent phrase, the words of each language).

    The first has lang, words, length, a (occurrences), first and last (occurrences of its first and last 1, 2, ... words) and
    longer (the most occurrences of a phrase one word longer that holds it, or null); the second lang and n.
    """
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = durable(own.mapInArrow(_number(HELD_WORDS), _CHUNKS_DDL))
    words = base.filter("words IS NOT NULL")
    sizes = durable(words.groupBy("lang").agg(F.sum("n").alias("n"), F.sum(F.col("size") / 8).cast("long").alias("entries")))
    entries = sizes.agg(F.sum("entries")).first()[0]
    merged = _merge(words.select("chunk", "lang", "size", "data", "words", "words_size"), entries, deal_words, _merge_words(least))
    units = durable(merged.filter("id IS NOT NULL").select("id", "lang", "word", "f"))
    here = units.select("id", "lang", F.array("word").alias("words"), F.lit(1).alias("length"), F.col("f").alias("a"), F.array("f").alias("first"), F.array("f").alias("last"))
    pages, rank, spent, levels = base.filter("words IS NULL").select("chunk", "page", "size", "data"), _rank_words, [base], []
    for length in range(2, longest + 2):
        found = None
        if length <= longest and not units.isEmpty():
            after = _next_round(pages, merged, rank)
            release(merged, *spent)
            pairs = after.filter("kind = 'pairs'")
            merged = _merge(pairs.select("chunk", "size", "data"), pairs.agg(F.sum("n")).first()[0], _deal_pairs, _merge_pairs(least))
            pages, rank, spent = after.filter("kind <> 'pairs'").select("chunk", "kind", "page", "size", "data"), _rank_pairs, [after]
            found = durable(merged.filter("id IS NOT NULL").select("id", "left", "right", "f"))
        if found is None or found.isEmpty():
            levels.append(here.withColumn("longer", F.lit(None).cast("long")).drop("id"))
            release(merged, *spent)
            break
        units = found
        longer = units.select("f", F.explode(F.array("left", "right")).alias("id")).groupBy("id").agg(F.max("f").alias("longer"))
        levels.append(here.join(longer, "id", "left").drop("id"))
        lefts = here.select(F.col("id").alias("left"), "lang", "words", "first")
        rights = here.select(F.col("id").alias("right"), F.element_at("words", -1).alias("word"), "last")
        here = durable(
            units.join(lefts, "left").join(rights, "right").select(
                "id", "lang", F.array_append("words", F.col("word")).alias("words"), F.lit(length).alias("length"), F.col("f").alias("a"),
                F.array_append("first", F.col("f")).alias("first"), F.array_append("last", F.col("f")).alias("last"),
            )
        )
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, sizes.select("lang", "n")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of 2 to `longest` words of each language.

    A phrase scores by its weakest cut, floor(1000 * a * n / (l * r)), the first of equals. Phrases that a longer
    one holds with at least `percent` % of their occurrences are left out. Ties go to the greater a, then
    to the lesser phrase. A null text is empty; a null language is `und`; repeated rows count each; texts
    without a phrase of `least` occurrences, like an empty table, give no rows; other columns are ignored.
    """
    found, sizes = phrases(docs, least, longest, text_col, lang_col)
    told = found.filter((F.col("length") > 1) & (F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))).join(sizes, "lang")
    cuts = F.array_compact(F.array(*[_cut(k, F.col("length"), F.col("a"), F.col("n")) for k in range(1, longest)]))
    scored = told.withColumn("cut", F.array_min(cuts)).select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return scored.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
