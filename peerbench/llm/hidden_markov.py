"""Language-model scoring with a hidden Markov model.

1. Each task numbers its words and hands on its documents as pages of numbers, with its different words beside
   them; an end stands behind every document. Words are dealt by hash to shards, packed many to a row, and counted
   there over the documents to learn from; every chunk gets the counts of its own words back.
2. Words that were learnt from fewer than RARE_LEAST times, and words never met, are one symbol to the states; within
   it a word has its smoothed share, whatever the state. A chunk's documents are dealt once, as numbers, to tables
   that are bucketed by chunk; they become symbols where they stand, with the chunk's symbols, and no round moves them.
3. Baum-Welch: in a round every chunk gets the expected counts of its own symbols so far, runs the scaled forward
   and backward recursions over its runs, and hands on its own expected counts. These are dealt to their symbols'
   shards and summed there in whole numbers of 1 / UNIT, so a round doesn't depend on the order; only the
   transitions, of a fixed size, pass the driver. A run is RUN tokens of a document, or its rest. Counts
   travel as 16-bit logarithms, 1 % apart; those that a shard sends back are the model's own.
4. A text's score is its exact likelihood, by the scaled forward recursion over the whole text: all documents of
   a chunk advance together, a step for each place.

A state emits a symbol s with probability (C(s) + PRIOR * u(s)) / (C + PRIOR): C are the expected counts, u the smoothed
unigram shares. So the probabilities of all words, the unknown one included, add up to 1 in every state.
Before the first round a symbol's counts are its own shared out by its hash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import drop_shuffles, give_back, shuffle_partitions
from peerbench.llm.packing import DEALT, SHARDS_DDL, WORD_ENTRY, Numbers, by_shard, deal_words, expand, joined, pack, rows, shards, squeeze, unpack, unpacked
from peerbench.session import durable, release, shared_dir
from peerbench.sources.bucketed import BucketedTable

STATES = 8
ROUNDS = 3
STAY = 0.9  # of the transitions before learning
SMOOTH = 0.1  # added to every count
RARE_LEAST = 50
PRIOR = 50.0
UNIT = 1 << 10
CHUNK_TOKENS = 3 << 20
PAGE_TOKENS = 1 << 18  # of the documents of a row
RUN = 256  # tokens that are learnt from as one sequence
BLOCK_TOKENS = 1 << 18  # of runs that advance together
END = b""  # no word is empty
RARE = -1  # the symbol of rare and unknown words

_CHUNKS = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.string())), ("size", pa.int64()), ("data", pa.binary()), ("codes_size", pa.int64()), ("codes", pa.binary()), ("words", pa.binary()), ("words_size", pa.int64())])
_CHUNKS_DDL = "chunk long, ids array<string>, size long, data binary, codes_size long, codes binary, words binary, words_size long"
_DOCS = pa.schema([(f.name, f.type) for f in _CHUNKS][:6])
_DOCS_DDL = "chunk bigint, ids array<string>, size bigint, data binary, codes_size bigint, codes binary"
_PACKED = pa.schema([("chunk", pa.int64()), ("kind", pa.string()), ("shard", pa.int64()), ("size", pa.int64()), ("data", pa.binary()), ("n", pa.int64())])
_PACKED_DDL = "chunk long, kind string, shard long, size long, data binary, n long"
_DOC = (np.int32, np.uint8)  # tokens, learnt from
_FACT = (np.int32, np.uint8, np.int32, np.float64, np.float64)  # tokens, learnt from, known, unigram score, what rare words add
_COUNT = (np.int32, np.int64)  # code, count
_SYMBOL = (np.int32, np.int64, np.int64)  # code, symbol, count


def held_out(doc_id: Column, folds: int = 10) -> Column:
    """The documents that learning never sees: crc32 of the id as text, modulo `folds`, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def shrink(x: np.ndarray) -> np.ndarray:
    """Counts as 16-bit logarithms: 0 stays 0, and up to 2 ** 63 all fit. Few different values compress well."""
    return np.rint(64 * np.log2(1 + x)).astype(np.uint16)


def widen(q: np.ndarray) -> np.ndarray:
    return np.exp2(q / 64) - 1


def _number(chunk_tokens: int):
    """Documents as pages of numbers, and a row for each chunk's words with how often they are learnt from."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, numbers, pages, ids, taught, parts = TaskContext.get().partitionId() << 24, Numbers(), [], [], [], []
        n, held, on_page = np.zeros(0, np.int64), 0, 0

        def turn() -> None:
            nonlocal n, on_page
            codes, sizes, learn = np.concatenate(parts), np.array([len(p) for p in parts], np.int32), np.array(taught, np.uint8)
            counts = np.bincount(codes[np.repeat(learn > 0, sizes)], minlength=len(numbers))
            counts[: len(n)] += n
            n = counts
            packed = pack(codes)
            own = {"chunk": made, "ids": list(ids), **pack(sizes, learn), "codes_size": packed["size"], "codes": packed["data"]}
            pages.append(rows(_CHUNKS, **{c: [v] for c, v in own.items()}))
            for x in (ids, taught, parts):
                x.clear()
            on_page = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if parts:
                turn()
            if pages:
                words = b"\n".join(numbers)
                own = {"chunk": made, **pack(n.astype(np.int64)), "words": squeeze(words), "words_size": len(words)}
                yield from pages
                yield rows(_CHUNKS, **{c: [v] for c, v in own.items()})

        for batch in batches:
            for doc, learn, text in zip(batch.column("id").to_pylist(), batch.column("taught").to_pylist(), batch.column("text"), strict=True):
                words = text.as_py().encode("utf-8", "replace").lower().split()
                words.append(END)
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                ids.append(doc)
                taught.append(learn)
                held, on_page = held + len(words), on_page + len(words)
                if on_page >= PAGE_TOKENS:
                    turn()
                if held >= chunk_tokens:
                    yield from flush()
                    made, numbers, pages, n, held = made + 1, Numbers(), [], np.zeros(0, np.int64), 0
        yield from flush()
        numbers, pages = Numbers(), []
        give_back()

    return work


def share_out(words: list[bytes], states: int) -> np.ndarray:
    """The part of a symbol's counts that each state has before learning, by the symbol's hash."""
    drawn = np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=2 * states).digest() for w in words), "<u2")
    parts = 0.5 + drawn.reshape(len(words), states) / 65535.0
    return parts / parts.sum(axis=1, keepdims=True)


def _by_chunk(shard: int, chunk: np.ndarray, **kinds: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Entries as packed rows for each chunk that has any, in the order they came in, for every kind alike."""
    order = np.argsort(chunk, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1) if len(order) else []:
        for kind, columns in kinds.items():
            own = {"chunk": int(chunk[some[0]]), "kind": kind, "shard": shard, **pack(*[c[some] for c in columns]), "n": len(some)}
            yield rows(_PACKED, **{c: [v] for c, v in own.items()})


def _of(table: pa.Table, kind: str, types: tuple[type, ...]) -> list[np.ndarray]:
    """A chunk's entries of a kind, shard by shard: entries of one order, whatever their kind."""
    some = np.flatnonzero(np.array(table.column("kind").to_pylist(), object) == kind)
    shard = np.array(table.column("shard"), np.int64)[some]
    return joined(list(unpacked(table.take(pa.array(some[np.argsort(shard, kind="stable")])), types)), types)


def _totals(states: int) -> str:
    return "total long, kinds long, rare_total long, rare_kinds long, " + ", ".join(f"s{k} long" for k in range(states))


def _merge_words(states: int):
    """A shard's words counted: for each chunk the counts of its words, and its frequent symbols with their first
    expected counts; and the shard's totals."""
    totals = [c.split()[0] for c in _totals(states).split(", ")]
    schema = pa.schema([*_PACKED, *[(c, pa.int64()) for c in totals]])

    def work(key: tuple, dealt: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        chunk, code, n = joined(list(unpacked(dealt, WORD_ENTRY)), WORD_ENTRY)
        words: list[bytes] = []
        for text, size in zip(dealt.column("words"), dealt.column("words_size").to_pylist(), strict=True):
            words += expand(text.as_buffer(), size).split(b"\n")
        word = pa.array(words, pa.binary()).dictionary_encode()
        of, different = word.indices.to_numpy().astype(np.int64), word.dictionary.to_pylist()
        count = np.zeros(len(different), np.int64)
        np.add.at(count, of, n)
        often = np.flatnonzero(count >= RARE_LEAST)
        number = np.full(len(count), -1, np.int64)
        number[often] = np.arange(len(often))
        first = shrink(share_out([different[i] for i in often.tolist()], states).T * count[often])
        some = np.flatnonzero(number[of] >= 0)
        some = some[np.lexsort((number[of[some]], chunk[some]))]
        at = number[of[some]]
        made = list(_by_chunk(shard, chunk, counts=[code, count[of]]))
        symbols = [code[some], shard << 32 | at, count[often][at]]
        made += _by_chunk(shard, chunk[some], symbols=symbols, params=list(first[:, at]))
        seldom = (count > 0) & (count < RARE_LEAST)
        sums = [count.sum(), (count > 0).sum(), count[seldom].sum(), seldom.sum(), *np.rint(widen(first) * UNIT).sum(axis=1)]
        made = [rows(schema, **{f.name: b.column(i) for i, f in enumerate(_PACKED)}) for b in made]
        made.append(rows(schema, **{c: [int(v)] for c, v in zip(totals, sums, strict=True)}))
        del words, word, different
        give_back()
        return pa.Table.from_batches(made, schema=schema)

    return work


def _page(ids: pa.Array, chunk: int, facts: list[np.ndarray], codes: np.ndarray) -> pa.RecordBatch:
    packed = pack(codes)
    own = {"chunk": chunk, "ids": ids, **pack(*facts), "codes_size": packed["size"], "codes": packed["data"]}
    return rows(_DOCS, **{c: [v] for c, v in own.items()})


def _pages(docs: pa.Table, kinds: tuple[type, ...]) -> Iterator[tuple[list, list[np.ndarray], np.ndarray]]:
    """(ids, facts, codes) of each page."""
    docs = docs.filter(pa.compute.is_valid(docs.column("codes")))
    for ids, facts, codes, size in zip(docs.column("ids").to_pylist(), unpacked(docs, kinds), docs.column("codes"), docs.column("codes_size").to_pylist(), strict=True):
        yield ids, facts, unpack(codes.as_buffer(), size, (np.int32,))[0]


def _symbols(docs: pa.Table) -> list[np.ndarray]:
    """code, symbol, count of a chunk's frequent words."""
    return next(unpacked(docs.filter(pa.compute.is_null(docs.column("codes"))), _SYMBOL))


def _facts(total: int, kinds: int, rare: float):
    """Per document its unigram score, what its rare words add to any score, and its symbols: numbers of
    frequent words stay, the others become RARE. `rare`: the counts of all rare words, each smoothed, and the unknown one's."""
    norm = total + SMOOTH * (kinds + 1)

    def work(key: tuple, docs: pa.Table, given: pa.Table) -> pa.Table:
        code, c = _of(given, "counts", _COUNT)
        count = np.zeros(len(code))
        count[code] = c
        unigram = np.log10((count + SMOOTH) / norm)
        inside = np.where(count < RARE_LEAST, np.log10((count + SMOOTH) / rare), 0.0)
        made = [rows(_DOCS, chunk=[key[0].as_py()], **{c: [v] for c, v in pack(*_of(given, "symbols", _SYMBOL)).items()})]
        for ids, (sizes, taught), codes in _pages(docs, _DOC):
            doc = np.repeat(np.arange(len(sizes)), sizes)
            add = lambda x: np.bincount(doc, weights=x[codes], minlength=len(sizes))  # noqa: B023, E731
            facts = [sizes, taught, add((count > 0).astype(float)).astype(np.int32), add(unigram), add(inside)]
            made.append(_page(ids, key[0].as_py(), facts, np.where(count[codes] < RARE_LEAST, RARE, codes).astype(np.int32)))
        give_back()
        return pa.Table.from_batches(made, schema=_DOCS)

    return work


class Block:
    """Sequences, the longest first, laid out by place: the symbols of all first places, then of
    all second ones, and so on; at each place the sequences that are long enough.

    Tables of probabilities have a row per state and a column per symbol.
    """

    def __init__(self, parts: list[np.ndarray]):
        sizes = np.array([len(p) for p in parts])
        longest = int(sizes.max())
        self.width = np.searchsorted(-sizes, -np.arange(longest), "left")  # sequences longer than t
        self.start = np.concatenate([[0], np.cumsum(self.width)])
        doc = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = self.start[place] + doc
        self.symbols = np.empty(len(doc), np.int64)
        self.symbols[at] = np.concatenate(parts)

    def likelihood(self, pi: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """log10 of each sequence's probability. Only the last place's probabilities are held."""
        out, last, onward = np.zeros(self.width[0]), pi[:, None], np.ascontiguousarray(move.T)
        start = self.start.tolist()
        for t, (a, b) in enumerate(zip(start, start[1:], strict=False)):
            last = emit[:, self.symbols[a:b]] * (onward @ last[:, : b - a] if t else last)
            scale = last.sum(axis=0)
            last /= scale
            out[: b - a] += np.log10(scale)
        return out

    def expected(self, pi: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected states by place, expected transitions, expected first states."""
        kind = emit.dtype
        ahead = emit[:, self.symbols]  # at first what is emitted; then scaled, and times beta
        alpha, scale = np.empty_like(ahead), np.empty(ahead.shape[1], kind)
        onward, back = np.ascontiguousarray(move.T).astype(kind), move.astype(kind)
        start, last = self.start.tolist(), pi[:, None].astype(kind)
        for t, (a, b) in enumerate(zip(start, start[1:], strict=False)):
            now = alpha[:, a:b]
            np.multiply(ahead[:, a:b], onward @ last[:, : b - a] if t else last, out=now)
            scale[a:b] = now.sum(axis=0)
            now /= scale[a:b]
            last = now
        ahead /= scale
        moves = np.zeros_like(move)
        for t in range(len(start) - 3, -1, -1):
            a, b, c = start[t], start[t + 1], start[t + 2]
            moves += alpha[:, a : a + c - b] @ ahead[:, b:c].T
            beta = back @ ahead[:, b:c]
            alpha[:, a : a + c - b] *= beta
            if t:
                ahead[:, a : a + c - b] *= beta
        return alpha, move * moves, alpha[:, : start[1]].sum(axis=1, dtype=np.float64)


def order_of(sizes: np.ndarray) -> np.ndarray:
    return np.argsort(-sizes, kind="stable")


def runs(sizes: np.ndarray, codes: np.ndarray) -> list[np.ndarray]:
    """Documents cut into runs."""
    out = []
    for part in np.split(codes, np.cumsum(sizes)[:-1]) if len(sizes) else []:
        out += [part[k : k + RUN] for k in range(0, len(part), RUN)]
    return out


def blocks(parts: list[np.ndarray]) -> Iterator[Block]:
    """Blocks of about BLOCK_TOKENS symbols, each of sequences of about one length."""
    sizes = np.array([len(p) for p in parts], np.int64)
    order = order_of(sizes)
    cut = np.cumsum(sizes[order]) // BLOCK_TOKENS
    for some in np.split(order, np.flatnonzero(np.diff(cut)) + 1) if len(order) else []:
        yield Block([parts[i] for i in some])


class Emissions:
    """What the states emit, from the expected counts of all symbols together and of a chunk's own."""

    def __init__(self, states: int, norm: float, rare: float, mass: np.ndarray, rare_mass: np.ndarray):
        self.states, self.norm, self.rare, self.mass, self.rare_mass = states, norm, rare, mass, rare_mass

    def matrix(self, code: np.ndarray, c: np.ndarray, counts: list[np.ndarray]) -> np.ndarray:
        """A column for each of a chunk's codes, the last one for RARE (code -1)."""
        out = np.zeros((self.states, int(code.max(initial=-1)) + 2))
        share = PRIOR * (c + SMOOTH) / self.norm
        for k in range(self.states):
            out[k, code] = (widen(counts[k]) + share) / (self.mass[k] + PRIOR)
        out[:, -1] = (self.rare_mass + PRIOR * self.rare / self.norm) / (self.mass + PRIOR)
        return out


def _learn(pi: np.ndarray, move: np.ndarray, emissions: Emissions):
    """Expected counts of a chunk: packed by symbol, and rows for rare words (key -1), first states (-2) and the
    transitions from each state (-3 and below)."""
    states = emissions.states
    schema = pa.schema([*_PACKED, ("key", pa.int64()), *[(f"s{k}", pa.int64()) for k in range(states)]])

    def work(key: tuple, docs: pa.Table, given: pa.Table) -> pa.Table:
        code, symbol, c = _symbols(docs)
        emit = emissions.matrix(code, c, _of(given, "params", (np.uint16,) * states)).astype(np.float32)
        rare = emit.shape[1] - 1
        parts: list[np.ndarray] = []
        for _, (sizes, taught, *_), codes in _pages(docs, _FACT):
            learn = taught > 0
            parts += runs(sizes[learn], codes[np.repeat(learn, sizes)])
        counts, first, moves = np.zeros((states, rare + 1)), np.zeros(states), np.zeros((states, states))
        for block in blocks(parts):
            block.symbols[block.symbols < 0] = rare
            found, moved, began = block.expected(pi, move, emit)
            for k in range(states):
                counts[k] += np.bincount(block.symbols, weights=found[k], minlength=rare + 1)
            first += began
            moves += moved
        whole = lambda x: np.rint(x * UNIT).astype(np.int64)
        own = {"chunk": key[0].as_py(), "kind": "params", **pack(symbol, *shrink(counts[:, code])), "n": len(code)}
        small = whole(np.concatenate([counts[:, -1:].T, first[None], moves]))
        give_back()
        made = [rows(schema, **{x: [v] for x, v in own.items()})]
        made.append(rows(schema, key=-1 - np.arange(len(small)), **{f"s{k}": small[:, k] for k in range(states)}))
        return pa.Table.from_batches(made, schema=schema)

    return work


def _deal_params(states: int):
    """Chunks' expected counts to the shards that their symbols are from."""
    own = (np.int64, *[np.uint16] * states)  # symbol, expected counts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk, symbol, *counts = joined(parts, (np.int64, *own))
            yield from by_shard(symbol >> 32, [chunk, (symbol & 0xFFFFFFFF).astype(np.int32), *counts])  # ascending in each chunk

        for batch in batches:
            for chunk, columns in zip(batch.column("chunk").to_pylist(), unpacked(batch, own), strict=True):
                parts.append([np.full(len(columns[0]), chunk, np.int64), *columns])
                size += len(columns[0])
                if size >= DEALT // 4:
                    yield from flush()
                    parts, size = [], 0
        yield from flush()

    return work


def _merge_params(states: int):
    schema = pa.schema([*_PACKED, *[(f"s{k}", pa.int64()) for k in range(states)]])
    kinds = (np.int64, np.int32, *[np.uint16] * states)

    def work(key: tuple, dealt: pa.Table) -> pa.Table:
        chunk, of, *own = joined(list(unpacked(dealt, kinds)), kinds)
        sums = np.zeros((states, int(of.max(initial=-1)) + 1), np.int64)
        for k in range(states):
            np.add.at(sums[k], of, np.rint(widen(own[k]) * UNIT).astype(np.int64))
        sums = shrink(sums / UNIT)
        made = [rows(schema, **{f.name: b.column(i) for i, f in enumerate(_PACKED)}) for b in _by_chunk(key[0].as_py(), chunk, params=list(sums[:, of]))]
        made.append(rows(schema, **{f"s{k}": [int(x)] for k, x in enumerate(np.rint(widen(sums) * UNIT).sum(axis=1))}))
        return pa.Table.from_batches(made, schema=schema)

    return work


class HiddenMarkov:
    """A model learnt from the documents that `held_out` leaves, with their unigram counts.

    `pi` and `move` are the first states' and the transitions' probabilities; `params` has each chunk's symbols with
    the expected counts of all chunks together, `emissions` what the states emit given these.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS):
        spark = docs.sparkSession
        self.states, self.id_type = states, docs.schema[id_col].dataType
        own = docs.select(F.col(id_col).cast("string").alias("id"), (~held_out(F.col(id_col))).alias("taught"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        buckets = shuffle_partitions(spark)
        place = f"{shared_dir(spark)}/peerbench/hidden-markov-{uuid.uuid4().hex}"
        numbered = BucketedTable(spark, f"{place}-numbered", _CHUNKS_DDL, ["chunk"], buckets)
        numbered.append(own.mapInArrow(_number(CHUNK_TOKENS), _CHUNKS_DDL))
        drop_shuffles(spark)
        base = numbered.rows()
        words = base.filter("words IS NOT NULL").select("chunk", F.lit(None).cast("string").alias("lang"), "size", "data", "words", "words_size")
        entries = words.agg(F.sum("size")).first()[0]
        ddl = f"{_PACKED_DDL}, {_totals(states)}"
        counted = durable(words.mapInArrow(deal_words(shards(entries and entries // 8)), SHARDS_DDL).groupBy("shard").applyInArrow(_merge_words(states), ddl))
        sums = counted.filter("total IS NOT NULL").agg(*[F.coalesce(F.sum(c.split()[0]), F.lit(0)) for c in _totals(states).split(", ")]).first()
        self.total, self.kinds, rare_total, rare_kinds = sums[:4]
        rare = rare_total + SMOOTH * (rare_kinds + 1)
        rare_mass = share_out([b"\n"], states)[0] * rare_total
        self.emissions = Emissions(states, self.total + SMOOTH * (self.kinds + 1), rare, np.array(sums[4:], float) / UNIT + rare_mass, rare_mass)

        drop_shuffles(spark)
        self.docs = BucketedTable(spark, place, _DOCS_DDL, ["chunk"], buckets)
        pages = base.filter("words IS NULL").select("chunk", "ids", "size", "data", "codes_size", "codes")
        given = counted.filter("kind IN ('counts', 'symbols')").select("chunk", "kind", "shard", "size", "data")
        facts = pages.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(_facts(self.total, self.kinds, rare), _DOCS_DDL)
        self.docs.append(facts, together=True)
        numbered.remove()
        drop_shuffles(spark)

        self.pi = np.full(states, 1 / states)
        self.move = np.full((states, states), (1 - STAY) / max(1, states - 1))
        np.fill_diagonal(self.move, STAY if states > 1 else 1.0)
        self._stored = counted
        for _ in range(rounds if self.total else 0):
            self._round()

    @property
    def params(self) -> DataFrame:
        return self._stored.filter("kind = 'params'").select("chunk", "kind", "shard", "size", "data")

    def _with_params(self, work, ddl: str) -> DataFrame:
        return self.docs.rows().groupBy("chunk").cogroup(self.params.groupBy("chunk")).applyInArrow(work, ddl)

    def _round(self) -> None:
        names = [f"s{k}" for k in range(self.states)]
        each = ", ".join(f"{x} long" for x in names)
        found = durable(self._with_params(_learn(self.pi, self.move, self.emissions), f"{_PACKED_DDL}, key long, {each}"))
        summed = found.filter("key IS NOT NULL").groupBy("key").agg(*[F.sum(x).alias(x) for x in names])
        small = {r["key"]: np.array(list(r)[1:], float) / UNIT for r in summed.collect()}  # a row per state and two
        dealt = found.filter("kind IS NOT NULL").select("chunk", "size", "data").mapInArrow(_deal_params(self.states), SHARDS_DDL)
        merged = durable(dealt.groupBy("shard").applyInArrow(_merge_params(self.states), f"{_PACKED_DDL}, {each}"))
        mass = merged.filter("kind IS NULL").agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in names]).first()
        release(found, self._stored)
        self._stored = merged
        del found, summed, dealt, merged
        drop_shuffles(self.docs.spark)
        e = self.emissions
        self.emissions = Emissions(e.states, e.norm, e.rare, np.array(list(mass), float) / UNIT + small[-1], small[-1])
        self.pi = (small[-2] + 1) / (small[-2] + 1).sum()
        moves = np.stack([small[-3 - k] for k in range(self.states)]) + 1
        self.move = moves / moves.sum(axis=1, keepdims=True)

    def score(self, id_col: str = "doc_id") -> DataFrame:
        """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

        Tokens are the words, A-Z lowered, and an end. Null counts as empty; an empty text is its end alone. Rows that repeat
        an id are scored each; a null id counts as ''. Where there is nothing to learn from, every score is 0. An empty
        table gives no rows; other columns are ignored.
        """
        pi, move, emissions, kinds = self.pi, self.move, self.emissions, (np.uint16,) * self.states
        schema = pa.schema([("id", pa.string()), ("taught", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

        def work(key: tuple, docs: pa.Table, given: pa.Table) -> pa.Table:
            code, _, c = _symbols(docs)
            emit = emissions.matrix(code, c, _of(given, "params", kinds))
            pages = list(_pages(docs, _FACT))
            sizes, taught, known, base, score = joined([facts for _, facts, _ in pages], _FACT)
            parts = [p for _, (n, *_), codes in pages for p in np.split(codes, np.cumsum(n)[:-1])]
            order = order_of(sizes)
            block = Block([parts[i] for i in order])
            score[order] += block.likelihood(pi, move, emit)
            ids = pa.array([i for own, _, _ in pages for i in own], pa.string())
            return pa.Table.from_arrays([ids, pa.array(taught > 0), pa.array(sizes.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)], schema=schema)

        found = self._with_params(work, "id string, taught boolean, n_tokens long, n_known long, base double, score double")
        return found.select(
            F.col("id").cast(self.id_type).alias(id_col), (~F.col("taught")).alias("held_out"), "n_tokens", "n_known",
            F.lit(self.total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
        )
