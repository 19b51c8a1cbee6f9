"""Vectorised text handling inside tasks: words, shingles and hashes of many texts at once.

Functions here take the UTF-8 bytes of a slice of texts as one numpy array with offsets, as
Arrow keeps them, so no Python object is made per word. Memory is bounded by the slice
(``SLICE_BYTES``, or one text where a text is longer).
"""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SLICE_BYTES = 1 << 19
U64 = np.uint64


def _table(seed: int, size: int) -> np.ndarray:
    """``size`` odd 64-bit numbers that are the same on every machine."""
    return mix(np.arange(1, size + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def process_store(name: str) -> dict:
    """A dictionary that outlives tasks: these functions reach executors by value, so their modules' globals do not."""
    return sys.modules.setdefault(f"_sedgemill_{name}", types.ModuleType(f"_sedgemill_{name}")).__dict__


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 .. base^n and base^-0 .. base^-n modulo 2^64 (an odd base has an inverse)."""
    kept = process_store("powers")
    have = kept.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=U64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        have = (made[0], made[1])
        if size <= 4 << 20:
            kept[base] = have
    return have


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for many ranges, from one prefix sum of a polynomial."""
    power, inverse = _powers(base, len(values))
    prefix = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64))


@dataclass
class Texts:
    """UTF-8 bytes of consecutive texts; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``. A null text is empty."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    off = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * np.dtype(kind).itemsize)
    off = off.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[off[0]:off[-1]], off - off[0])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take about ``most`` bytes together."""
    if not batch.num_rows:
        return
    off = texts_of(batch.column(batch.schema.get_field_index(column))).offsets
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        upto = min(max(upto, at + 1), batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto


def map_texts(
    df: DataFrame, text: str, schema: str, work: Callable[[pa.RecordBatch, Texts], pa.RecordBatch | None],
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Apply ``work`` to slices of rows of about ``most`` bytes of text; it gets the slice and its texts and returns the rows to emit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()  # what an earlier task of this process left in reference cycles
        for batch in batches:
            for part in slices(batch, text, most):
                out = work(part, texts_of(part.column(part.schema.get_field_index(text))))
                if out is not None and out.num_rows:
                    yield out
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass
class Words:
    """Byte ranges of words (runs without space, tab, line or page break); ``first[i]:first[i + 1]`` are those of text ``i``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def place(self) -> np.ndarray:
        """Place of each word in its text, from 0."""
        return np.arange(len(self)) - np.repeat(self.first[:-1], self.counts)


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-text firsts of the runs of True, which no run crosses a text's end."""
    n = len(solid)
    opens = np.zeros(n + 1, dtype=bool)
    opens[offsets] = True
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty(n, dtype=bool)
    after[n - 1:] = False
    after[:-1] = solid[1:]
    start = np.flatnonzero(solid & (~before | opens[:-1]))
    end = np.flatnonzero(solid & (~after | opens[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def words_of(texts: Texts) -> Words:
    return Words(*runs(~SPACE[texts.data], texts.offsets))


def word_hashes(texts: Texts, words: Words, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes; another seed gives an independent one."""
    values = _table(seed, 256)[texts.data]
    return range_hash(values, words.start, words.end, 0x9DDFEA08EB382D69 + 2 * seed)


def window_hashes(hashes: np.ndarray, words: Words, width: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """First word (index into the slice's words) and hash of every window of ``width`` words of one text."""
    last = np.repeat(words.first[1:], words.counts) - width
    at = np.flatnonzero(np.arange(len(words)) <= last)
    return at, range_hash(hashes, at, at + width, 0xC2B2AE3D27D4EB4F + 2 * seed)


def gather_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given byte ranges put together with one space after each: bytes and the new starts."""
    size = end - start + 1
    new = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=new[1:])
    out = np.full(new[-1], 0x20, dtype=np.uint8)
    at = np.arange(new[-1]) - np.repeat(new[:-1], size) + np.repeat(start, size)
    inside = np.ones(new[-1], dtype=bool)
    inside[new[1:] - 1] = False
    out[inside] = data[at[inside]]
    return out, new


def spaced(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text joined by one space: bytes, and start and end of each word there.

    A space also follows the last word of a text, so ranges from a word's start to a later
    word's end are the joined words.
    """
    out, new = gather_words(texts.data, words.start, words.end)
    return out, new[:-1], new[1:] - 1


# XXH64 as published: fixed values.
_P1, _P2, _P3, _P4, _P5 = (
    U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x85EBCA77C2B2AE63),
    U64(0x27D4EB2F165667C5),
)


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U64(n)) | (x >> U64(64 - n))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte ranges, those of one length together."""
    out = np.zeros(len(start), dtype=U64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    half = np.ndarray((len(data) + 1,), dtype="<u4", buffer=padded.data, strides=(1,))
    size = end - start
    order = np.argsort(size, kind="stable")
    lengths, firsts = np.unique(size[order], return_index=True)
    s = U64(seed)
    round_ = lambda acc, lane: _rot(acc + lane * _P2, 31) * _P1
    with np.errstate(over="ignore"):
        for n, a, b in zip(lengths.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(order)], strict=True):
            rows = order[a:b]
            at = start[rows].copy()
            left = n
            if n >= 32:
                acc = [np.full(len(at), v, dtype=U64) for v in (s + _P1 + _P2, s + _P2, s, s - _P1)]
                while left >= 32:
                    acc = [round_(v, wide[at + 8 * i]) for i, v in enumerate(acc)]
                    at += 32
                    left -= 32
                h = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
                for v in acc:
                    h = (h ^ round_(U64(0), v)) * _P1 + _P4
            else:
                h = np.full(len(at), s + _P5, dtype=U64)
            h = h + U64(n)
            while left >= 8:
                h = _rot(h ^ round_(U64(0), wide[at]), 27) * _P1 + _P4
                at += 8
                left -= 8
            if left >= 4:
                h = _rot(h ^ (half[at].astype(U64) * _P1), 23) * _P2 + _P3
                at += 4
                left -= 4
            for _ in range(left):
                h = _rot(h ^ (padded[at].astype(U64) * _P5), 11) * _P1
                at += 1
            h = (h ^ (h >> U64(33))) * _P2
            h = (h ^ (h >> U64(29))) * _P3
            out[rows] = h ^ (h >> U64(32))
    return out


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts, for choosing numbers of buckets."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(doc_id: str, text: str) -> "F.Column":
    """A hash of id and text: tells rows apart that share an id or have none."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def held_out(doc_id) -> "F.Column":
    """True where crc32 of the id as text leaves 1 modulo 3; such rows are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
