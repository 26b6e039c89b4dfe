"""Similarity join on word n-grams (Jaccard) by vertical partitioning, and its linked groups.

1. Documents become sets of hashed n-grams; equal sets are one class, named by a 128-bit digest.
2. N-grams have one global order: by hash, with the frequent ones last, by frequency. Two sets that link
   share an n-gram among the first of either (a quarter of the set, for 75 %), so only those are
   posted; postings that no other class shares fall away.
3. Candidates are pairs that share postings. How many they share bounds their overlap, which
   drops nearly all that don't link. First each class meets one leader of its postings, which
   joins large groups of near copies with as many pairs as they have members; where a wide posting
   is still split between groups, two more rounds let the smaller groups' members meet leaders of the
   largest. Then every pair within a posting whose members are not yet joined is a candidate: none is
   left out.
4. Overlaps are exact: the order is cut into fragments (more for larger sets), each fragment of a
   pair's sets is intersected apart, and the counts are summed per pair.
5. Links are closed to groups by large-star and small-star rounds.

Frequent n-grams are found by counts within tasks that are added up; only the order depends on them,
never the result, so their number is bounded for the workers. No text is shuffled: sets are rebuilt
from the text, in the last passes for those documents only that a fixed-size bit table lets through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerbench.llm.common import give_back
from peerbench.session import durable

WORDS = 5
PERCENT = 75
FRAGMENT_GRAMS = 2048  # of a set in a fragment, about
LEVELS = 8  # a level has 8 times the fragments of the one before
WIDE = 32  # members from which a posting that is split between groups gets more leaders
LATER_LEADERS = (4, 24)  # of a posting, and tried by a class, in a later round
BASE = np.uint64(0x9E3779B97F4A7C15)
CHARS = 1 << 22  # characters handled at a time
KEPT_WORDS = 1 << 18
LOCAL_TOKENS = 1 << 17  # counts a task keeps
LOCAL_LEAST, HEAVY_LEAST = 3, 24
MOST_HEAVY = 1 << 17  # frequent n-grams that workers get
SLOT_BITS = 23  # of the bit table of documents
TABLE_WORDS = 4  # of 64 bits, of the bit table of a class's first n-grams
EARLIER = 4  # n-grams before a shared one that tell whether it is the first

_FACTS = "heavy boolean, id long, n long, cls long, key binary, token long, count long"
_TABLE = {"boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(x.split()[0], _TABLE[x.split()[1]]) for x in ddl.split(", ")])


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


class Shingler:
    """Sets of n-grams as sorted distinct hashes of 63 bits."""

    def __init__(self, words: int):
        self.words, self.hashes = words, _Words()

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """A-Z count as a-z. A text of fewer words is one n-gram; one without words has none."""
        if len(self.hashes) > KEPT_WORDS:
            self.hashes = _Words()
        words, ends = [], []
        for t in texts:
            words += t.encode().lower().split()
            ends.append(len(words))
        own = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        w = self.words
        grams = _mix(_fold(own, w)) if len(own) >= w else np.empty(0, np.int64)
        out, start = [], 0
        for end in ends:
            n = end - start
            if n >= w:
                s = np.sort(grams[start : end - w + 1])
                fresh = np.empty(len(s), bool)
                fresh[0] = True
                np.not_equal(s[1:], s[:-1], out=fresh[1:])
                out.append(s[fresh])
            else:
                out.append(_mix(_fold(own[start:end], n) + np.uint64(n)) if n else np.empty(0, np.int64))
            start = end
        return out


def _fold(hashes: np.ndarray, w: int) -> np.ndarray:
    out = np.zeros(len(hashes) - w + 1, np.uint64)
    for k in range(w):
        out = out * BASE + hashes[k : len(hashes) - w + 1 + k]
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _cls(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _scan(docs: DataFrame, ddl: str, work: Callable[[Iterator[tuple[list, list[str]]]], Iterator[dict]]) -> DataFrame:
    """Runs `work` over (ids, texts) of bounded size; it yields columns, missing ones are null."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids.append(i)
                texts.append(t.as_py())
                held += len(texts[-1])
                if held >= CHARS:
                    yield ids, texts
                    ids, texts, held = [], [], 0
        if texts:
            yield ids, texts

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(ddl)
        for cols in work(parts(batches)):
            n = len(next(iter(cols.values())))
            arrays = [pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        give_back()

    return docs.mapInArrow(rows, ddl)


def _facts(words: int):
    """Per document its class; per task the n-grams that are frequent there."""

    def work(parts):
        shingler, counts = Shingler(words), {}
        for ids, texts in parts:
            sets = shingler.sets(texts)
            keys = [_key(s) for s in sets]
            yield {"heavy": [False] * len(ids), "id": ids, "n": [len(s) for s in sets], "cls": [_cls(k) for k in keys], "key": keys}
            each = list(dict(zip(keys, sets, strict=True)).values())
            tokens, n = np.unique(np.concatenate(each), return_counts=True)
            for t, c in zip(tokens[n > 1].tolist(), n[n > 1].tolist(), strict=True):
                counts[t] = counts.get(t, 0) + c
            if len(counts) > LOCAL_TOKENS:
                counts = dict(sorted(counts.items(), key=lambda x: -x[1])[: LOCAL_TOKENS // 2])
        some = [(t, c) for t, c in counts.items() if c >= LOCAL_LEAST]
        yield {"heavy": [True] * len(some), "token": [t for t, _ in some], "count": [c for _, c in some]}

    return work


def _set_keys(words: int):
    """Per text, named by its digest, the key and the size of its set."""

    def work(parts):
        shingler = Shingler(words)
        for digests, texts in parts:
            sets = shingler.sets(texts)
            yield {"digest": digests, "set_key": [_key(s) for s in sets], "n": [len(s) for s in sets]}

    return work


def _prefix(n: int, percent: int) -> int:
    """How many of the first n-grams of a set hold one that any linked set has there, too."""
    return n - -(-percent * n // 100) + 1


def _postings(words: int, percent: int, tokens: np.ndarray, ranks: np.ndarray):
    """The first n-grams of each class: (spot, cls, order); order has the place in the set in its low
    32 bits, above them 0 or 1 + the rank of a frequent n-gram.

    A frequent n-gram's rows get spots apart from each other, so that no task has them all.
    """

    def work(parts):
        shingler, seen = Shingler(words), set()
        for _, texts in parts:
            if len(seen) > KEPT_WORDS:
                seen = set()
            spots, classes, orders = [], [], []
            for s in shingler.sets(texts):
                if not len(s) or (cls := _cls(_key(s))) in seen:
                    continue
                seen.add(cls)
                p = _prefix(len(s), percent)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    is_heavy = tokens[at] == s
                    light = s[~is_heavy][:p]
                    rank = np.sort(ranks[at[is_heavy]])[: p - len(light)]
                else:
                    light, rank = s[:p], np.empty(0, np.int64)
                size = len(light) + len(rank)
                spots.append(np.concatenate([light, rank * 0x9E3779B1 ^ cls]))
                orders.append(np.concatenate([np.zeros(len(light), np.int64), rank + 1]) << 32 | np.arange(size))
                classes.append(np.full(size, cls))
            if spots:
                yield {"spot": np.concatenate(spots), "cls": np.concatenate(classes), "order": np.concatenate(orders)}

    return work


def _slot(doc_id: np.ndarray) -> np.ndarray:
    return doc_id & ((1 << SLOT_BITS) - 1)


def _level(n: int) -> int:
    """How finely a set of this size is cut: into 8 ** level fragments."""
    return sum(n > FRAGMENT_GRAMS << (3 * k) for k in range(LEVELS))


def _segments(words: int, percent: int, sides: list[np.ndarray]):
    """Fragments of the sets of documents that a bit table lets through, first and second side.

    A set is cut at its own level and at that of the largest set it can link with; others don't occur.
    """

    def work(parts):
        shingler = Shingler(words)
        for ids, texts in parts:
            slots = _slot(np.array([-1 if i is None else i for i in ids], np.int64))
            first, second = ((bits[slots >> 3] >> (slots & 7) & 1).astype(bool) for bits in sides)
            some = np.flatnonzero(first | second).tolist()
            rows, pieces, cuts = [], [], [0]
            for k, s in zip(some, shingler.sets([texts[k] for k in some]), strict=True):
                key = _key(s)
                for level in {_level(len(s)), _level(len(s) * 100 // percent)}:
                    bounds = np.arange(1, 8**level, dtype=np.int64) << (63 - 3 * level)
                    base, last = cuts[-1], 0
                    for f, end in enumerate([*np.searchsorted(s, bounds).tolist(), len(s)]):
                        if end > last:
                            rows.append((bool(first[k]), bool(second[k]), key, level, f))
                            cuts.append(base + end)
                            last = end
                    pieces.append(s)
            if rows:
                grams = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(pieces)))
                names = ["first", "second", "key", "level", "fragment"]
                yield {**dict(zip(names, zip(*rows, strict=True), strict=True)), "grams": grams}

    return work


class NgramJoin:
    """The join over one table of documents.

    `rows` has a row per document (id, n, key), `classes` one per different set with n-grams: node,
    key, cls, n, first_id (its smallest id).
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT):
        self.words, self.percent = words, percent
        self.scan = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        facts = durable(_scan(self.scan, _FACTS, _facts(words)))
        self.rows = facts.filter("NOT heavy").select("id", "n", "cls", "key")
        self.classes = durable(
            self.rows.filter("n > 0")
            .groupBy("key", "cls", "n")
            .agg(F.min("id").alias("first_id"))
            .withColumn("node", F.monotonically_increasing_id())
        )
        heavy = (
            facts.filter("heavy")
            .groupBy("token")
            .agg(F.sum("count").alias("count"))
            .filter(F.col("count") >= HEAVY_LEAST)
            .orderBy(F.desc("count"), "token")
            .limit(MOST_HEAVY)
            .collect()
        )
        heavy = sorted(heavy, key=lambda x: x["token"])
        tokens = np.array([x["token"] for x in heavy], np.int64)
        order = np.lexsort((tokens, np.array([x["count"] for x in heavy], np.int64)))
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.arange(len(order))
        self.shared = self._shared(tokens, ranks)

    def _shared(self, tokens: np.ndarray, ranks: np.ndarray) -> DataFrame:
        """Postings (token, node, n, place) of n-grams that two classes or more may share.

        Frequent ones have negative tokens.
        """
        posted = _scan(self.scan, "spot long, cls long, order long", _postings(self.words, self.percent, tokens, ranks))
        one, rank = Window.partitionBy("spot"), F.shiftright("order", 32)
        some = posted.withColumns({"_lo": F.min("cls").over(one), "_hi": F.max("cls").over(one)}).filter((rank > 0) | (F.col("_lo") < F.col("_hi")))
        token, place = F.when(rank > 0, -rank).otherwise(F.col("spot")), F.col("order").bitwiseAND(0xFFFFFFFF)
        kept = some.select(token.alias("token"), "cls", place.alias("place")).distinct()
        return durable(kept.join(self.classes.select("cls", "node", "n"), "cls").select("token", "node", "n", "place"))

    def _may_link(self, shared: Column, n_a: Column, n_b: Column) -> Column:
        """Whether sets of these sizes can link that share so many of their first n-grams.

        What they share lies among the first of both, or behind the first of one of them.
        """
        p = self.percent
        least, most = F.least(n_a, n_b), F.greatest(n_a, n_b)
        behind = F.ceil(p * most / 100) - 1
        return (100 * least >= p * most) & ((100 + p) * (shared + behind) >= p * (n_a + n_b))

    def _leader_pairs(self, met: DataFrame, tries: int) -> DataFrame:
        """(a, b): of the leaders that classes meet (node, n, leader: a row per posting), the `tries` best."""
        counted = met.filter("node <> leader").groupBy("node", "n", "leader").count()
        sizes = self.classes.select(F.col("node").alias("leader"), F.col("n").alias("n_leader"))
        able = counted.join(sizes, "leader").filter(self._may_link(F.col("count"), F.col("n"), F.col("n_leader")))
        best = Window.partitionBy("node").orderBy(F.desc("count"), "leader")
        placed = able.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= tries)
        return placed.select(F.col("node").alias("a"), F.col("leader").alias("b"))

    def _first_leaders(self) -> DataFrame:
        leaders = self.shared.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
        met = self.shared.join(leaders, "token").select("node", "n", F.explode(F.array("lo", "hi")).alias("leader"))
        return self._leader_pairs(met, 1)

    def _split(self, groups: DataFrame) -> DataFrame:
        """The postings between classes of different groups: token, node, n, group, size (of the group)."""
        sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
        known = groups.join(sizes, "group").withColumnRenamed("group", "_group")
        here = self.shared.join(known, "node", "left").select(
            "token", "node", "n", "place", F.coalesce("_group", "node").alias("group"), F.coalesce("size", F.lit(1)).alias("size")
        )
        split = here.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count(F.lit(1)).alias("width"))
        return durable(here.join(split.filter("lo < hi").select("token", "width"), "token"))

    def _later_leaders(self, split: DataFrame, seed: int) -> DataFrame:
        """In wide postings, members of smaller groups with members of the largest ones, picked by hash.

        Where groups are equally large, as where none has formed yet, the hash picks among all their members.
        Leaders whose sets are too large or too small to link are not met at all.
        """
        per_token, tries = LATER_LEADERS
        near = f"100 * least(n, x.n) >= {self.percent} * greatest(n, x.n)"
        wide = split.filter(F.col("width") >= WIDE)
        picks = [
            F.min_by(F.struct("node", "group", "size", "n"), F.struct(-F.col("size"), F.xxhash64("node", F.lit(seed * per_token + k))))
            for k in range(per_token)
        ]
        leaders = wide.groupBy("token").agg(F.array_distinct(F.array(*picks)).alias("leaders"))
        met = (
            wide.join(leaders, "token")
            .withColumn("leader", F.explode(F.expr(f"filter(leaders, x -> group <> x.group AND size <= x.size AND {near})")))
            .select("node", "n", F.col("leader.node").alias("leader"))
        )
        return self._leader_pairs(met, tries)

    def _met(self, left: DataFrame) -> DataFrame:
        """(node_a, n_a, node_b, n_b): pairs of different groups that share a split posting and are able to link.

        All n-grams that such classes share among their first stand in split postings. So they share no more than
        either has of those from the first shared one on, nor than it has less the bits of its
        table (a bit for each of its n-grams, many to a bit) that the other lacks.
        Both sets have one order, so a pair that shares one of the n-grams just before is listed there: what
        holds at a later n-gram holds at an earlier one, too. The first shared one always lists its pair.
        """
        one = Window.partitionBy("node")
        slot = F.pmod("token", F.lit(64 * TABLE_WORDS))
        bit = F.expr(f"shiftleft(1L, cast(pmod(token, {64 * TABLE_WORDS}) % 64 AS int))")
        table = [F.bit_or(F.when(F.floor(slot / 64) == k, bit).otherwise(0)).over(one).alias(f"bits{k}") for k in range(TABLE_WORDS)]
        down = one.orderBy(F.desc("place"))
        onward = F.row_number().over(down).alias("onward")
        earlier = F.array_compact(F.array(*[F.lead("token", k).over(down) for k in range(1, EARLIER + 1)])).alias("earlier")
        known = durable(left.select("token", "node", "n", "place", "group", onward, earlier, F.count(F.lit(1)).over(one).alias("all"), *table))
        a, b = (known.select("token", *[F.col(c).alias(f"{c}_{x}") for c in known.columns if c != "token"]) for x in "ab")
        p = self.percent
        apart = (F.col("node_a") < F.col("node_b")) & (F.col("group_a") != F.col("group_b"))
        near = 100 * F.least("n_a", "n_b") >= p * F.greatest("n_a", "n_b")
        # The first n-gram that linked sets share has all of their overlap from its place on, in both.
        ahead = (100 + p) * F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= p * (F.col("n_a") + F.col("n_b"))
        held = [
            F.col(f"all_{x}") - sum(F.bit_count(F.col(f"bits{k}_{x}").bitwiseAND(F.bitwise_not(f"bits{k}_{y}"))) for k in range(TABLE_WORDS))
            for x, y in ("ab", "ba")
        ]
        enough = self._may_link(F.least("onward_a", "onward_b", *held), F.col("n_a"), F.col("n_b"))
        first = ~F.arrays_overlap("earlier_a", "earlier_b")
        met = a.join(b, (a["token"] == b["token"]) & apart & near & ahead & enough & first)
        return met.select("node_a", "n_a", "node_b", "n_b").distinct()

    def _cross_pairs(self, left: DataFrame, done: DataFrame) -> DataFrame:
        """(a, b) with a < b: all pairs that can link, share a split posting and are not in one group yet."""
        pairs = self._met(left)
        own = durable(left.groupBy("node").agg(F.collect_list("token").alias("tokens")))  # no more than the first of a set
        for x in "ab":
            pairs = pairs.join(own.select(F.col("node").alias(f"node_{x}"), F.col("tokens").alias(f"tokens_{x}")), f"node_{x}")
        shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
        able = pairs.filter(self._may_link(shared, F.col("n_a"), F.col("n_b"))).select(
            F.col("node_a").alias("a"), F.col("node_b").alias("b")
        )
        tried = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return able.join(tried, ["a", "b"], "left_anti")

    def _bits(self, needed: Column, pairs: DataFrame) -> np.ndarray:
        """A table of 2 ** SLOT_BITS bits, set for the documents named."""
        slot = F.coalesce(needed, F.lit(-1)).bitwiseAND((1 << SLOT_BITS) - 1)
        words = (
            pairs.select(slot.alias("slot"))
            .select(F.shiftright("slot", 5).cast("int").alias("word"), F.expr("shiftleft(1L, cast(slot & 31 AS int))").alias("bit"))
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .collect()
        )
        out = np.zeros(1 << (SLOT_BITS - 5), np.uint32)
        out[[x["word"] for x in words]] = [x["bits"] for x in words]
        return out.view(np.uint8)

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, with their overlap."""
        facts = {c: self.classes.select(F.col("node").alias(c), F.col("key").alias(f"key_{c}"), F.col("n").alias(f"n_{c}"), F.col("first_id").alias(f"id_{c}")) for c in "ab"}
        pairs = durable(pairs.join(facts["a"], "a").join(facts["b"], "b"))
        sides = [self._bits(F.col(c), pairs) for c in ("id_a", "id_b")]
        schema = "first boolean, second boolean, key binary, level int, fragment int, grams array<long>"
        segments = durable(_scan(self.scan, schema, _segments(self.words, self.percent, sides)))
        level = sum((F.greatest("n_a", "n_b") > FRAGMENT_GRAMS << (3 * k)).cast("int") for k in range(LEVELS))
        a = segments.filter("first").select(F.col("key").alias("key_a"), "level", "fragment", F.col("grams").alias("grams_a"))
        b = segments.filter("second").select(F.col("key").alias("key_b"), "level", "fragment", F.col("grams").alias("grams_b"))
        counted = a.join(pairs.withColumn("level", level), ["key_a", "level"]).join(b, ["key_b", "level", "fragment"]).select(
            "a", "b", "n_a", "n_b", "fragment", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("part")
        )
        # A fragment counts once, also where a document's row is repeated.
        overlap = (
            counted.groupBy("a", "b", "n_a", "n_b", "fragment").agg(F.max("part").alias("part"))
            .groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
        )
        union = F.col("n_a") + F.col("n_b") - F.col("overlap")
        return overlap.filter(100 * F.col("overlap") >= self.percent * union)

    def groups(self) -> DataFrame:
        """(node, group) of the classes that link with another; a group is named by its smallest node."""
        tried = durable(self._first_leaders())
        links = durable(self._links(tried).select("a", "b"))
        for seed in range(2):
            pairs = durable(self._later_leaders(self._split(connected(links)), seed))
            if pairs.isEmpty():
                break
            tried = tried.unionByName(pairs)
            links = durable(links.unionByName(self._links(pairs).select("a", "b")))
        cross = self._cross_pairs(self._split(connected(links)), tried)
        return connected(durable(links.unionByName(self._links(cross).select("a", "b"))))

    def components(self, id_col: str = "doc_id") -> DataFrame:
        """One row per document: id, n_shingles, component_id, class_id.

        component_id is the smallest id reachable by links, class_id the smallest of those with the
        same set. A null text has no n-grams, and a document without any is linked with nothing.
        Rows without an id take part, but never name a group; a group without any id has null. Rows
        that repeat an id with another text are documents of their own. An empty table gives no rows;
        other columns are ignored.
        """
        named = self.classes.join(self.groups(), "node", "left").withColumn("group", F.coalesce("group", "node"))
        named = durable(named.select("key", "first_id", "group"))
        least = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
        sets = named.join(least, "group").select(F.col("key").alias("_key"), F.col("first_id").alias("class_id"), "component_id")
        found = self.rows.join(sets, (F.col("key") == F.col("_key")) & (F.col("n") > 0), "left")
        own = lambda c: F.when(F.col("n") > 0, F.col(c)).otherwise(F.col("id")).alias(c)
        return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own("component_id"), own("class_id"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, group) of every node with an edge (a, b): the smallest node that can be reached.

    Large-star links each larger neighbour of a node to the smallest one, small-star each smaller one.
    The rounds end when the edges stay as they are; each round is written, and none gathers a
    node's neighbours.
    """
    here = durable(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v"))
    mark = None
    while True:
        both = here.unionByName(here.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = durable(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        here = durable(small.unionByName(smallest.withColumnRenamed("m", "v")).distinct())
        now = here.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    members = here.select(F.col("u").alias("node"), F.col("v").alias("group"))
    return durable(members.unionByName(here.select(F.col("v").alias("node"), F.col("v").alias("group"))).distinct())


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of documents that link, directly or by others.

    It is the row with the smallest id, of rows with one id the one with the smallest set key; a row without
    an id stays only where none of its group has one. Rows that share an id and differ in their sets are
    documents of their own. Documents without n-grams link with nothing and all stay. All columns
    stay as they were.
    """
    join = NgramJoin(docs, id_col, text_col)
    named = join.classes.join(join.groups(), "node", "left").withColumn("group", F.coalesce("group", "node"))
    least = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "key"))
    stays = durable(named.groupBy("group").agg(least.alias("least")).select(F.col("least.first_id").alias("_id"), F.col("least.key").alias("_key")))
    held = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    gone = durable(join.rows.filter("n > 0 AND id IS NOT NULL").join(stays, held, "left_anti").select(F.col("id").alias("_id")).distinct())
    shared = durable(join.rows.groupBy("id").count().filter("count > 1 OR id IS NULL").select(F.col("id").alias("_id")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("row_id"), text.alias("text"))
    if shared.isEmpty():
        return own.join(gone, F.col("row_id") == F.col("_id"), "left_anti").select("row.*")

    # Ids don't tell these rows apart: each is decided by its id and set.
    same = F.col("row_id").eqNullSafe(F.col("_id"))
    unclear = own.join(shared, same, "left_semi").select("row", "row_id", "text", F.unhex(F.sha2("text", 256)).alias("row_digest"))
    texts = unclear.select(F.col("row_digest").alias("id"), "text")
    sets = durable(_scan(texts, "digest binary, set_key binary, n long", _set_keys(join.words)).distinct())
    keyed = unclear.drop("text").join(sets, F.col("row_digest") == F.col("digest"))
    linkable = keyed.filter("n > 0").join(stays, same & (F.col("set_key") == F.col("_key")), "left_semi")
    first = durable(linkable.groupBy(F.col("row_id").alias("_id"), F.col("set_key").alias("_key")).agg(F.min("row_digest").alias("_first")))
    one = same & (F.col("set_key") == F.col("_key")) & (F.col("row_digest") == F.col("_first"))
    kept = linkable.join(first, one, "left_semi").dropDuplicates(["row_id", "row_digest"]).unionByName(keyed.filter("n = 0"))
    clear = own.join(shared, same, "left_anti").join(gone, same, "left_anti")
    return clear.select("row").unionByName(kept.select("row")).select("row.*")
