"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vectors of three letters in a row are rotated by
their place, bound by multiplication into the vector of that 3-gram, and bundled by addition over a
text. A language's prototype bundles its texts' vectors, each scaled to one length. A text gets the
language whose prototype has the greatest cosine with it.

Learning adds vectors up per partition and then per language and dimension, in whole numbers, so the
sums don't depend on the order. Only the prototypes reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.session import durable

DIMENSIONS = 1024
GRAM = 3
SEED = 7
SCALE = 1 << 24  # whole numbers per unit of a scaled vector
CHARS = 1 << 19  # characters handled at a time
KEPT_GRAMS = 1 << 15  # vectors kept per worker
MOST_LANGUAGES = 4096
UNKNOWN = "und"
_BITS = 21  # of a code point


@lru_cache(maxsize=1 << 14)
def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The vector of a letter (0: a word's edge), drawn from its code point alone."""
    bits = np.random.default_rng([SEED, code]).integers(0, 2, dimensions, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def gram_vector(key: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Binds the letters of a 3-gram, the first one rotated most."""
    out = np.ones(dimensions, np.int8)
    for place in range(GRAM):
        code = key >> (_BITS * place) & ((1 << _BITS) - 1)
        out *= np.roll(letter_vector(code, dimensions), place)
    return out


class Encoder:
    """Vectors of texts; keeps the vectors of 3-grams it has met, up to a number."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.places: dict[int, int] = {}
        self.vectors = np.empty((1024, dimensions), np.float32)

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        if len(self.places) + len(keys) > KEPT_GRAMS:
            self.places, self.vectors = {}, np.empty((1024, self.dimensions), np.float32)
        for key in keys.tolist():
            if key not in self.places:
                n = len(self.places)
                if n == len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                self.vectors[n] = gram_vector(key, self.dimensions)
                self.places[key] = n
        return self.vectors[[self.places[k] for k in keys.tolist()]]

    def bundle(self, texts: list[str]) -> np.ndarray:
        """A row per text: the sum of its 3-grams' vectors; zeros where there is no letter."""
        out = np.zeros((len(texts), self.dimensions))
        group, held = [], 0
        for i, text in enumerate(texts):
            for a in range(0, max(len(text), 1), CHARS):  # a long text is handled in parts that overlap
                part = text[max(0, a - GRAM + 1) : a + CHARS].lower()
                group.append((i, a > 0, a + CHARS < len(text), part))
                held += len(part)
                if held >= CHARS:
                    self._add(out, group)
                    group, held = [], 0
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bool, bool, str]]) -> None:
        parts, owners = [], []
        for i, goes_on, is_cut, part in group:
            # A word's edge (0) stands before and after the text; where it is cut there is none (-1).
            codes = np.concatenate([[-1] if goes_on else [0], _letters(part), [-1] if is_cut else [0]]).astype(np.int64)
            parts.append(codes)
            owners.append(np.full(len(codes), i))
        codes, owner = np.concatenate(parts), np.concatenate(owners)
        first, mid, last = codes[:-2], codes[1:-1], codes[2:]
        real = (first >= 0) & (mid > 0) & (last >= 0) & (owner[:-2] == owner[2:])
        keys = (first[real] << (2 * _BITS)) | (mid[real] << _BITS) | last[real]
        if not len(keys):
            return
        grams, which = np.unique(keys, return_inverse=True)
        low = owner[0]
        n = owner[-1] - low + 1
        size = max(1, (1 << 22) // max(1, len(grams)))  # texts per product
        texts = owner[:-2][real] - low
        for a in range(0, n, size):
            here = (texts >= a) & (texts < a + size)
            b = min(size, n - a)
            counts = np.bincount((texts[here] - a) * len(grams) + which[here], minlength=b * len(grams))
            counts = counts.reshape(b, len(grams)).astype(np.float32)
            used = np.flatnonzero(counts.any(axis=0))
            for k in range(0, len(used), KEPT_GRAMS // 2):  # whole numbers: blocks add up to the same
                some = used[k : k + KEPT_GRAMS // 2]
                out[low + a : low + a + b] += counts[:, some] @ self._rows(grams[some])


@lru_cache(maxsize=1 << 16)
def _is_letter(code: int) -> bool:
    return chr(code).isalpha()


def _letters(text: str) -> np.ndarray:
    """Code points, 0 for whatever is no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    known, which = np.unique(codes, return_inverse=True)
    return np.where([_is_letter(c) for c in known.tolist()], known, 0)[which] if len(codes) else codes


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zeros stay zeros."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """The fold that learning never sees: crc32 of the id as text, modulo `folds`, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototypes by language, of length 1, from all rows with text and language.

    Rows without language, and texts without letters, teach nothing. An empty table gives none.
    More than MOST_LANGUAGES values of the language column are refused, as they are no languages.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, total = Encoder(dimensions), {}
        for batch in batches:
            scaled = np.rint(unit(encoder.bundle(batch["text"].tolist())) * SCALE).astype(np.int64)
            for lang, rows in batch.groupby("lang").indices.items():
                total[lang] = total.get(lang, 0) + scaled[rows].sum(axis=0)
            if len(total) > MOST_LANGUAGES:
                raise ValueError("the language column holds too many values")
        if total:
            yield pd.DataFrame({"lang": list(total), "vector": [v.tolist() for v in total.values()]})

    given = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    summed = durable(
        given.mapInPandas(sums, "lang string, vector array<long>")
        .select("lang", F.posexplode("vector"))
        .groupBy("lang", "pos")
        .agg(F.sum("col").alias("value"))
    )
    if summed.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError("the language column holds too many values")
    out: dict[str, np.ndarray] = {}
    for lang, pos, value in summed.collect():  # at most MOST_LANGUAGES * dimensions rows
        out.setdefault(lang, np.zeros(dimensions))[pos] = value
    return {k: unit(v[None])[0] for k, v in sorted(out.items()) if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (the cosine, 0 at least).

    Null, empty and letterless texts, and all texts where nothing was learnt, are `und` with score 0.
    Ties go to the first language by name. Every text is read whole; other columns are ignored.
    """
    langs = np.array([*prototypes], dtype=object)
    matrix = np.array([*prototypes.values()]).T if prototypes else None
    dimensions = matrix.shape[0] if prototypes else DIMENSIONS

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(dimensions)
        for batch in batches:
            out = batch[["id"]].assign(lang_pred=UNKNOWN, score=0.0)
            if matrix is not None and len(batch):
                vectors = unit(encoder.bundle(batch["text"].tolist()))
                cosines = vectors @ matrix
                some = vectors.any(axis=1)
                best = cosines.argmax(axis=1)
                out.loc[some, "lang_pred"] = langs[best][some]
                out["score"] = np.where(some, cosines.max(axis=1).clip(0, 1), 0.0)
            yield out

    # Ids travel as text: pandas has no integer column with nulls.
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType
    found = given.mapInPandas(rows, "id string, lang_pred string, score double")
    return found.select(F.col("id").cast(kind).alias(id_col), "lang_pred", "score")
