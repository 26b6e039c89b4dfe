"""Columns of numbers packed many to a row, as operators of this subpackage hand them from task to task."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PACKED = 256  # bytes from which a row is compressed
SHARD = 1 << 19  # entries of a shard, about
DEALT = 1 << 22  # entries that a task deals at a time

SHARDS = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("data", pa.binary()), ("words", pa.binary()), ("words_size", pa.int64())])
SHARDS_DDL = "shard long, lang string, size long, data binary, words binary, words_size long"
WORD_ENTRY = (np.int64, np.int32, np.int64)  # chunk, code, n


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """Rows with the columns given; the others are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def squeeze(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True) if len(raw) >= PACKED else raw


def expand(data, size: int) -> bytes:
    return pa.decompress(data, size, codec="zstd", asbytes=True) if size >= PACKED else bytes(data)


def pack(*columns: np.ndarray) -> dict:
    """Columns of one length as (size, data): like bytes of all numbers stand together, which compresses well."""
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns)
    return {"size": len(raw), "data": squeeze(raw)}


def unpack(data, size: int, kinds: tuple[type, ...]) -> list[np.ndarray]:
    raw, out, at = np.frombuffer(expand(data, size), np.uint8), [], 0
    n = size // sum(np.dtype(k).itemsize for k in kinds)
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


def unpacked(table: pa.Table | pa.RecordBatch, kinds: tuple[type, ...]) -> Iterator[list[np.ndarray]]:
    for data, size in zip(table.column("data"), table.column("size").to_pylist(), strict=True):
        yield unpack(data.as_buffer(), size, kinds)


def joined(parts: list[list[np.ndarray]], kinds: tuple[type, ...]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, k) for k in kinds]


class Numbers(dict):
    """Numbers words as they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def shards(entries: int | None) -> int:
    """As many shards as give each about SHARD entries."""
    return -(-(entries or 1) // SHARD)


def by_shard(shard: np.ndarray, columns: list[np.ndarray], words: list[bytes] | None = None, lang: str | None = None) -> Iterator[pa.RecordBatch]:
    """Entries by shard, packed."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for some in np.split(order, cuts) if len(order) else []:
        own = {"shard": int(shard[some[0]]), "lang": lang, **pack(*[c[some] for c in columns])}
        if words is not None:
            text = b"\n".join([words[i] for i in some.tolist()])
            own |= {"words": squeeze(text), "words_size": len(text)}
        yield rows(SHARDS, **{c: [v] for c, v in own.items()})


def deal_words(count: int):
    """Deals the words of chunks, rows of (chunk, lang, size, data: counts, words, words_size), to shards by their hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (words, parts) in held.items():
                shard = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % count
                yield from by_shard(shard, joined(parts, WORD_ENTRY), words, lang)

        for batch in batches:
            texts = zip(batch.column("words"), batch.column("words_size").to_pylist(), strict=True)
            for chunk, lang, (n,), (text, text_size) in zip(batch.column("chunk").to_pylist(), batch.column("lang").to_pylist(), unpacked(batch, (np.int64,)), texts, strict=True):
                words, parts = held.setdefault(lang, ([], []))
                words += expand(text.as_buffer(), text_size).split(b"\n")
                parts.append([np.full(len(n), chunk, np.int64), np.arange(len(n), dtype=np.int32), n])
                size += len(n)
                if size >= DEALT:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return work
