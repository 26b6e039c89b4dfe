"""SentencePiece encoding and decoding by a batched Viterbi search.

Texts are cut into words that no piece crosses. The distinct words of a batch are grouped by length,
and the words of one length advance together, one character at a time: the hashes of the substrings
that end at the place are probed in the sorted hashes of all pieces, every hit is scored for all words
at once, and the best one is stored as the backpointer.

How a hit is scored depends on the model. In a unigram model it is the best score of what stands
before plus the piece's own. A BPE model has no such sum: its segmentation is the one in which every
two neighbours would also stay apart if merged on their own. So a hit scores 0 where its piece may
follow the last one of the best path before it, and minus infinity where not; exactly one hit of each
place scores 0. Whether a pair may stand is worked out once by merging its characters, then looked up.

Texts are independent, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import give_back, small_batches

SPACE = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
KEPT_CHARS = 5 << 20  # of the words whose pieces a task keeps
LONG_WORD = 64  # characters from which a word is cut where no piece can cross
PAIR_BITS = 21  # of the number of pairs whose answer a worker keeps
BATCH_CHARS = 1 << 21  # characters encoded at a time
GROUP_CHARS = 1 << 18  # of the words that advance together
UNIGRAM, BPE = 1, 2
FILTER_BITS = 20
FOREIGN = 1 << 20  # stands for a character that is no piece


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            out |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return out, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Model:
    """Pieces and rules of a model file. The file is read once, on the driver."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], model_type: int, dummy_prefix: bool = True):
        """kinds: normal, byte, unknown or other (control) for each piece."""
        self.model_type, self.dummy_prefix = model_type, dummy_prefix
        self.pieces, self.kinds = pieces, kinds
        self.unknown = kinds.index("unknown") if "unknown" in kinds else 0
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "byte"}
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.rank = {pieces[i]: scores[i] for i in normal}
        if model_type == BPE:  # a piece that merging never makes is never a hit
            normal = [i for i in normal if len(merged(pieces[i], self.rank)) == 1]
        self.longest = max((len(pieces[i]) for i in normal), default=1)
        keys = np.array([piece_key(pieces[i]) for i in normal], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int64)[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)  # by the first bits of a hash: whether a piece has them
        self.maybe[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        if len(keys) > 1 and (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.scores = np.array(scores)
        self.foreign_score = min((scores[i] for i in normal), default=0.0) - 10.0
        long = [p for p in self.rank if len(p) > 1]
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in long)
        inside = {c for p in long for c in p}
        alone = "".join(c for c in "\n\r\t" if c not in inside)
        lone = f"[{alone}]|" if alone else ""
        #: Neighbours inside a piece; between others a long word may be cut. Without byte pieces a run of unknown
        #: characters is one piece, so no word is cut there.
        self.pairs = {p[i : i + 2] for p in long for i in range(len(p) - 1)} if self.bytes else None
        self.cut = re.compile(f"{lone}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+") if self.by_word else re.compile(r".+", re.S)

    @classmethod
    def load(cls, path: str) -> Model:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = dict(_fields(sp.serialized_model_proto()))
        trainer, norm = dict(_fields(spec[2])), dict(_fields(spec[3]))
        if norm.get(2) or norm.get(4, 1):
            raise NotImplementedError("only models that leave texts as they are, spaces included")
        n = sp.get_piece_size()
        kinds = ["byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "other" if sp.is_control(i) or sp.is_unused(i) else "normal" for i in range(n)]
        return cls([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], kinds, trainer.get(3, UNIGRAM), bool(norm.get(3, 1)))

    def words(self, text: str) -> list[str]:
        marked = text.replace(" ", SPACE)
        words = self.cut.findall(SPACE + marked if self.dummy_prefix and marked else marked)
        if self.pairs is None or max(map(len, words), default=0) < LONG_WORD:
            return words
        return [part for w in words for part in (self._cut_up(w) if len(w) >= LONG_WORD else (w,))]

    def _cut_up(self, word: str) -> Iterator[str]:
        """A word's parts; no piece crosses the borders between them."""
        start, pairs = 0, self.pairs
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in pairs:
                yield word[start:i]
                start = i
        yield word[start:]


def piece_key(s: str) -> int:
    h = 0
    for c in s:
        h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def merges(parts: list[str], rank: dict[str, float]) -> Iterator[int]:
    """Merges neighbours in place, the best pair first, the left one of equals; yields each place."""
    none = float("-inf")
    get = rank.get
    ranks = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while ranks and (best := max(ranks)) != none:
        k = ranks.index(best)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
        del ranks[k]
        if k < len(ranks):
            ranks[k] = get(parts[k] + parts[k + 1], none)
        if k:
            ranks[k - 1] = get(parts[k - 1] + parts[k], none)
        yield k


def merged(s: str, rank: dict[str, float]) -> list[str]:
    """The BPE segmentation of a string."""
    parts = list(s)
    for _ in merges(parts, rank):
        pass
    return parts


def apart(a: str, b: str, rank: dict[str, float]) -> bool:
    """Whether no merge crosses the border of two pieces, each of which is one on its own."""
    left = len(a)  # parts before the border
    for k in merges(list(a + b), rank):
        if k == left - 1:
            return False
        left -= k < left - 1
    return True


def one_by_one(word: str, m: Model) -> list[int]:
    """The ids of a single word by the pieces' texts, without hashes."""
    if m.model_type == BPE:
        parts = merged(word, m.rank)
    else:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for j in range(1, len(word) + 1):
            hits = [(best[i][0] + m.rank[word[i:j]], i) for i in range(max(0, j - m.longest), j) if word[i:j] in m.rank]
            alone = [] if word[j - 1] in m.rank else [(best[j - 1][0] + m.foreign_score, j - 1)]
            best.append(max(hits + alone))
        parts, j = [], len(word)
        while j:
            parts.append(word[best[j][1] : j])
            j = best[j][1]
        parts.reverse()
    out: list[int] = []
    for part in parts:
        if part in m.rank:
            out.append(m.pieces.index(part))
        elif m.bytes:
            out.extend(m.bytes[b] for b in part.encode("utf-8", "replace"))
        elif not (out and out[-1] == m.unknown):
            out.append(m.unknown)
    return out


class Places(dict):
    """Numbers words as they are first asked for, and lists the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.forget()
        # Pairs met, each at the place its hash gives; a later one takes an earlier one's place.
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_stays = np.zeros(1 << PAIR_BITS, bool)

    def forget(self) -> None:
        self.places, self.kept_chars = Places(), 0
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        if self.kept_chars > KEPT_CHARS:
            self.forget()
        words, counts = [], [0]
        for t in texts:
            words += self.model.words(t)
            counts.append(len(words))
        which = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        if self.places.new:
            self._learn(self.places.new)
            self.kept_chars += sum(map(len, self.places.new))
            self.places.new = []
        starts, flat = self.starts, self.flat
        sizes = starts[which + 1] - starts[which] if len(which) else np.empty(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(starts[which] - ends[:-1], sizes) if len(which) else np.empty(0, np.int64)
        return ends[counts], flat[at]

    def _learn(self, new: list[str]) -> None:
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, w in enumerate(new):
            by_length[len(w)].append(k)
        found: list[list[int]] = [[]] * len(new)
        for length, ks in by_length.items():
            step = max(1, GROUP_CHARS // length)
            for a in range(0, len(ks), step):
                group = ks[a : a + step]
                for k, ids in zip(group, self._search([new[k] for k in group], length), strict=True):
                    found[k] = ids
        self.flat = np.concatenate([self.flat, np.array([x for f in found for x in f], np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(f) for f in found])])

    def _search(self, words: list[str], length: int) -> list[list[int]]:
        """Viterbi over words of one length."""
        m, n = self.model, len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length)
        reach = min(m.longest, length)
        hashes = np.zeros((reach, n), np.uint64)  # of the substrings of 1, 2, ... characters that end here
        last = np.full((length + 1, n), -1, np.int32)
        back = np.zeros((length + 1, n), np.int32)
        best = np.zeros((length + 1, n)) if m.model_type != BPE else None
        for j in range(1, length + 1):
            c = codes[:, j - 1].astype(np.uint64) + np.uint64(1)
            hashes[1:] = hashes[:-1] * BASE + c
            hashes[0] = c
            k = min(j, reach)
            probe = hashes[:k]
            ids = np.full(probe.shape, -1)
            some = np.nonzero(m.maybe[probe >> np.uint64(64 - FILTER_BITS)])
            if len(some[0]):
                at = np.minimum(np.searchsorted(m.keys, probe[some]), len(m.keys) - 1)
                ids[some] = np.where(m.keys[at] == probe[some], m.ids[at], -1)
            ids[0] = np.where(ids[0] < 0, FOREIGN, ids[0])
            score = np.full((k, n), -np.inf)
            sizes, cols = np.nonzero(ids >= 0)
            before, piece = j - 1 - sizes, ids[sizes, cols]
            if m.model_type == BPE:
                stays = np.ones(len(piece), bool)
                several = np.bincount(cols, minlength=n)[cols] > 1  # one of the hits always stays
                stays[several] = self._stays(last[before[several], cols[several]], piece[several])
                score[sizes[stays], cols[stays]] = 0.0
            else:
                own = np.where(piece == FOREIGN, m.foreign_score, m.scores[np.minimum(piece, len(m.scores) - 1)])
                score[sizes, cols] = best[before, cols] + own
            top = score.argmax(axis=0)
            every = np.arange(n)
            last[j], back[j] = ids[top, every], top + 1
            if best is not None:
                best[j] = score[top, every]
            elif np.isinf(score[top, every]).any():
                raise ValueError("a word has no segmentation")
        traced = (self._trace(*x) for x in zip(words, last.T.tolist(), back.T.tolist(), strict=True))
        return [one_by_one(w, m) if ids is None else ids for w, ids in zip(words, traced, strict=True)]

    def _trace(self, word: str, last: list[int], back: list[int]) -> list[int] | None:
        """The ids of the best path; None where a substring had a piece's hash and isn't it."""
        m, out, j = self.model, [], len(word)
        while j:
            piece, size = last[j], back[j]
            if piece != FOREIGN:
                if m.pieces[piece] != word[j - size : j]:
                    return None
                out.append(piece)
            elif m.bytes:
                out.extend(m.bytes[b] for b in reversed(word[j - 1].encode("utf-8", "replace")))
            elif not (out and out[-1] == m.unknown):
                out.append(m.unknown)
            j -= size
        return out[::-1]

    def _stays(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE leaves a pair of pieces apart. Nothing before, or a foreign character, always."""
        free = (left < 0) | (left == FOREIGN) | (right == FOREIGN)
        keys = (left.astype(np.int64) << 21) | right
        out = np.ones(len(keys), bool)
        asked = keys[~free]
        slots = (asked.astype(np.uint64) * BASE >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        stays, unknown = self.pair_stays[slots], self.pair_keys[slots] != asked
        if unknown.any():
            pieces, rank = self.model.pieces, self.model.rank
            fresh, which = np.unique(asked[unknown], return_inverse=True)
            answers = np.array([apart(pieces[k >> 21], pieces[k & ((1 << 21) - 1)], rank) for k in fresh.tolist()], bool)
            stays[unknown] = answers[which]
            at = (fresh.astype(np.uint64) * BASE >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            places, first = np.unique(at, return_index=True)
            self.pair_keys[places], self.pair_stays[places] = fresh[first], answers[first]
        out[~free] = stays
        return out


class Decoder:
    def __init__(self, model: Model):
        self.model = model
        shown = {"normal": lambda p: p, "unknown": lambda p: " ⁇ ", "byte": lambda p: "", "other": lambda p: ""}
        self.texts = [shown[k](p).encode("utf-8", "replace") for p, k in zip(model.pieces, model.kinds, strict=True)]
        for value, i in model.bytes.items():
            self.texts[i] = bytes([value])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. Runs of byte pieces are read as UTF-8, what is none as U+FFFD."""
        text = b"".join(map(self.texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_ENCODERS: dict[str, Encoder] = {}


def _encoder(model: Model, key: str) -> Encoder:
    """A worker's encoder for a run. From task to task it keeps which pairs stay apart, a table of fixed size, but no words."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    part, held = [], 0
    for t in texts:
        part.append(t.as_py() or "")
        held += len(part[-1])
        if held >= BATCH_CHARS:
            yield part
            part, held = [], 0
    if part:
        yield part


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids, n_tokens, exact (decoding the ids gives the text back).

    Every document's ids are decoded in the task that encodes it. What decodes otherwise is a text that
    holds the model's mark for a space, or characters that the model has neither a piece nor bytes for.

    Null counts as empty; an empty text has no ids and is exact. Texts are encoded whole, with no
    marks of their own; marks that stand in a text are ordinary characters. Characters outside the
    vocabulary become byte pieces, or one unknown piece per run where a model has none. Repeated rows
    give equal rows; an empty table none; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary
    key = f"{id(model)}-{len(model.pieces)}-{shared._jbroadcast.id() if shared._jbroadcast else 0}"
    schema = pa.schema([("id", pa.string()), ("ids", pa.list_(pa.int32())), ("exact", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(shared.value, key), Decoder(shared.value)
        for batch in batches:
            done = 0
            for part in _parts(batch.column("text")):
                offsets, ids = encoder.encode(part)
                exact = [decoder.decode(ids[a:b]) == t for t, a, b in zip(part, offsets[:-1], offsets[1:], strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                own = batch.column("id").slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([own.cast(pa.string()), lists, pa.array(exact)], schema=schema)
        encoder.forget()
        give_back()

    # Ids travel as text, whatever their type.
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = given.mapInArrow(rows, "id string, ids array<int>, exact boolean")
    return found.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "ids", F.size("ids").cast("long").alias("n_tokens"), "exact"
    )


def decode(encoded: DataFrame, model: Model, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id, text. Null ids give an empty text; ids outside the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("id", pa.string()), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [decoder.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), pa.array(texts, pa.string())], schema=schema)

    given = encoded.select(F.col(id_col).cast("string").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    found = given.mapInArrow(rows, "id string, text string")
    return found.select(F.col("id").cast(encoded.schema[id_col].dataType).alias(id_col), "text")
