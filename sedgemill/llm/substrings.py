"""Removal of word sequences that occurred before, found through fixed-block anchors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.textkit import (
    SLICE_BYTES, Texts, Words, gather_words, map_texts, row_key, slices, text_bytes, texts_of, window_hashes, word_hashes, words_of,
)
from sedgemill.session import written

#: Words of one unit: what a task turns into one row per bucket. A unit has at least ``ENTRIES``
#: words for each bucket, so that rows carry entries and not their own heads, up to ``MOST_WORDS``
#: that a task can hold (some 30 bytes each); that is 60,000 buckets, or 180 GB of text.
UNIT_WORDS, ENTRIES, MOST_WORDS = 256 * 1024, 64, 4 << 20
#: Bytes of text per bucket; a bucket's entries are compared in one task.
BUCKET_BYTES = 3 << 20
LAST_ID = (1 << 63) - 1
#: Entries of one unit for one bucket: places in the unit (``gaps``), hashes and flags, or with ``ids`` and ``starts``
#: the document of each and the place there. Rows with ``uids`` carry the unit's documents instead.
UNIT_SCHEMA = "bucket int, unit long, ids binary, uids binary, sizes binary, gaps binary, tags binary, flags binary, starts binary"
HIT_SCHEMA = "unit long, ids binary, uids binary, sizes binary, gaps binary"


def _planes(values: np.ndarray) -> bytes:
    """Byte 0 of all values, then byte 1 and so on: small numbers leave planes of zeros, which compress away."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _values(data: bytes, kind: type, n_bytes: int | None = None) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    have = n_bytes or wide
    n = len(data) // have
    out = np.zeros((n, wide), dtype=np.uint8)
    out[:, :have] = np.frombuffer(data, dtype=np.uint8).reshape(have, n).T
    return out.view(kind).ravel()


def _small(values: np.ndarray) -> bytes:
    return zlib.compress(_planes(np.diff(values, prepend=values.dtype.type(0))), 1)


def _unsmall(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_values(zlib.decompress(data), kind), dtype=kind)


def unit_words(buckets: int) -> int:
    return min(max(UNIT_WORDS, ENTRIES * buckets), MOST_WORDS)


class _Unit:
    """Collects documents and their entries until they are enough for a row per bucket."""

    def __init__(self, buckets: int, tag_bytes: int, with_ids: bool) -> None:
        self.buckets, self.tag_bytes, self.with_ids, self.number = buckets, tag_bytes, with_ids, 0
        self.most = unit_words(buckets)
        self._clear()

    @property
    def full(self) -> bool:
        return self.words >= self.most

    def _clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.words = 0

    def add(self, ids, uids, sizes, at, bucket, tag, flag) -> None:
        self.parts.append((ids, uids, sizes, at + self.words, bucket, tag, flag))
        self.words += int(sizes.sum())

    def rows(self) -> pa.RecordBatch:
        ids, uids, sizes, at, bucket, tag, flag = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        unit = (TaskContext.get().partitionId() << 32) + self.number
        self.number += 1
        spans = zlib.compress(_planes(sizes.astype(np.uint32)), 1)
        out = [(unit % self.buckets, unit, _small(ids), _planes(uids), spans, b"", b"", b"", b"")]
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        own = np.searchsorted(begin, at, side="right") - 1 if self.with_ids else None
        for b in np.flatnonzero(np.diff(edges)):
            rows = order[edges[b]:edges[b + 1]]
            gaps = np.diff(at[rows], prepend=0).astype(np.uint32)
            tags = tag[rows].view(np.uint8).reshape(-1, 8)[:, :self.tag_bytes].T.tobytes()
            docs, starts = None, None
            if self.with_ids:
                docs, starts = _small(ids[own[rows]]), _planes((at[rows] - begin[own[rows]]).astype(np.uint32))
            out.append((int(b), unit, docs, None, None, _planes(gaps), tags, np.packbits(flag[rows]).tobytes(), starts))
        self._clear()
        names = [c.split()[0] for c in UNIT_SCHEMA.split(", ")]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 7]
        columns = [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)


def _squeezed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, uid, packed): texts compressed for the shuffles to come; ``uid`` tells rows of one id apart."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        data, off = texts.data.tobytes(), texts.offsets.tolist()
        packed = [zlib.compress(data[a:b], 1) for a, b in zip(off, off[1:])]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], ["id", "uid", "packed"])

    return map_texts(_keyed(docs, doc_id, text), "_text", "id long, uid long, packed binary", work)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id"),
        row_key(doc_id, text).alias("uid"), F.col(text).alias("_text"))


def _probe_units(rows: DataFrame, width: int, block: int, buckets: int) -> DataFrame:
    """Every rolling window of ``block`` words, once per document, marked where it is one of the document's own blocks.

    A repeat of ``width`` words holds a whole block of either side if ``2 * block - 1 <= width``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(buckets, 3, False)
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = texts_of(part.column(2))
                words = words_of(texts)
                at, h = window_hashes(word_hashes(texts, words), words, block)
                doc, place = words.text_of_word()[at], words.place()[at]
                order, first, count = _groups(h ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
                anchor = np.maximum.reduceat((place % block == 0)[order], first) if len(first) else np.zeros(0, bool)
                one = order[first]
                one, anchor, many = one[(keep := np.argsort(one))], anchor[keep], (count > 1)[keep]
                h = h[one]
                flag = np.stack([anchor, many], axis=1)
                ids, uids = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                unit.add(ids, uids, words.counts, at[one], ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), h, flag)
                if unit.full:
                    yield unit.rows()
        if unit.parts:
            yield unit.rows()

    return rows.mapInArrow(run, UNIT_SCHEMA)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by value, the first place of each value in it, and how many it has."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    return order, first, np.diff(first, append=len(ordered))


def _entries(table: pa.Table, tag_bytes: int):
    """Entries of a bucket with the unit row each is from; and the rows that carry documents, to pass on."""
    carry = pc_is_docs(table)
    entries = table.filter(pa.array(~carry))
    gaps = [np.cumsum(_values(x, np.uint32), dtype=np.int64) for x in entries.column("gaps").to_pylist()]
    tags = [_values(x, np.uint64, tag_bytes) for x in entries.column("tags").to_pylist()]
    return entries, gaps, tags, table.filter(pa.array(carry)).select(["unit", "ids", "uids", "sizes", "gaps"])


def pc_is_docs(table: pa.Table) -> np.ndarray:
    return ~table.column("uids").is_null().to_numpy()


def _hits(entries: pa.Table, at: list[np.ndarray], chosen: np.ndarray, docs: pa.Table) -> pa.Table:
    """Chosen places as one row per unit, after the rows that carry documents."""
    sizes = np.cumsum([0, *map(len, at)])
    found = []
    for i, unit in enumerate(entries.column("unit").to_pylist()):
        mine = at[i][chosen[sizes[i]:sizes[i + 1]]]
        if len(mine):
            found.append((unit, _planes(np.diff(mine, prepend=0).astype(np.uint32))))
    none = pa.nulls(len(found), pa.binary())
    rows = pa.table([pa.array([x[0] for x in found], pa.int64()), none, none, none,
                     pa.array([x[1] for x in found], pa.binary())], ["unit", "ids", "uids", "sizes", "gaps"])
    return pa.concat_tables([docs, rows])


def _shared(table: pa.Table) -> pa.Table:
    """Probes that found an anchor: their window is a block somewhere and occurs at least twice."""
    entries, at, tags, docs = _entries(table, 3)
    if not at:
        return docs
    tag = np.concatenate(tags)
    flags = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=2 * len(t)).reshape(-1, 2)
                            for f, t in zip(entries.column("flags").to_pylist(), tags, strict=True)]).astype(bool)
    order, first, count = _groups(tag)
    anchored = np.maximum.reduceat(flags[order, 0], first)
    twice = (count > 1) | np.maximum.reduceat(flags[order, 1], first)
    chosen = np.zeros(len(tag), dtype=bool)
    chosen[order] = np.repeat(anchored & twice, count)
    return _hits(entries, at, chosen, docs)


def _later(table: pa.Table) -> pa.Table:
    """Windows whose word sequence also starts earlier: at a smaller id, or earlier in the same document."""
    entries, at, tags, docs = _entries(table, 8)
    if not at:
        return docs
    tag = np.concatenate(tags)
    doc = np.concatenate([_unsmall(x, np.int64) for x in entries.column("ids").to_pylist()])
    place = np.concatenate([_values(x, np.uint32) for x in entries.column("starts").to_pylist()])
    order = np.lexsort((place, doc, tag))
    ordered = tag[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc[order] != doc[order][head]) | (place[order] != place[order][head])
    chosen = np.zeros(len(tag), dtype=bool)
    chosen[order] = later
    return _hits(entries, at, chosen, docs)


def _by_document(table: pa.Table) -> pa.Table:
    """The chosen places of a unit, dealt to its documents."""
    carry = pc_is_docs(table)
    found = [np.cumsum(_values(x, np.uint32), dtype=np.int64) for x in table.filter(pa.array(~carry)).column("gaps").to_pylist()]
    empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.binary())], ["id", "uid", "found"])
    if not found:
        return empty
    docs = table.filter(pa.array(carry)).to_pylist()[0]
    ids, uids = _unsmall(docs["ids"], np.int64), _values(docs["uids"], np.int64)
    end = np.cumsum(_values(zlib.decompress(docs["sizes"]), np.uint32), dtype=np.int64)
    at = np.sort(np.concatenate(found))
    edges = np.searchsorted(at, np.concatenate([[0], end]))
    has = np.flatnonzero(np.diff(edges))
    begin = np.concatenate([[0], end])
    places = [(at[edges[d]:edges[d + 1]] - begin[d]).astype(np.uint32).tobytes() for d in has]
    return pa.table([pa.array(ids[has]), pa.array(uids[has]), pa.array(places, pa.binary())], ["id", "uid", "found"])


def _chosen(units: DataFrame, pick) -> DataFrame:
    """(id, uid, found): places chosen by ``pick`` in each bucket, as packed 32-bit numbers per document."""
    hits = units.groupBy("bucket").applyInArrow(pick, HIT_SCHEMA)
    return hits.groupBy("unit").applyInArrow(_by_document, "id long, uid long, found binary")


def _read_joined(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, Texts, np.ndarray, np.ndarray]]:
    """Ids, uids, texts, and (text index, place) of the found places, a few texts at a time."""
    ids, uids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    texts, places, first, held = [], [], 0, 0
    for i, (packed, found) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
        texts.append(zlib.decompress(packed.as_py()))
        places.append(np.frombuffer(found.as_py() or b"", np.uint32))
        held += len(texts[-1])
        if held >= SLICE_BYTES or i + 1 == batch.num_rows:
            off = np.cumsum([0, *map(len, texts)])
            own = np.repeat(np.arange(len(texts)), [len(p) for p in places])
            yield (ids[first:i + 1], uids[first:i + 1], Texts(np.frombuffer(b"".join(texts), np.uint8), off), own,
                   np.concatenate(places).astype(np.int64))
            texts, places, first, held = [], [], i + 1, 0


def cover(words: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """True for the words that lie in any of the ranges low..high (both included)."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high + 1, -1)
    return np.cumsum(change)[:-1] > 0


def _candidate_units(joined: DataFrame, width: int, block: int, buckets: int) -> DataFrame:
    """Windows of ``width`` words that hold a probe with an anchor: anchors extended to whole windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Unit(buckets, 8, True)
        for batch in batches:
            for ids, uids, texts, own, place in _read_joined(batch):
                words = words_of(texts)
                hashes = word_hashes(texts, words)
                start, h = window_hashes(hashes, words, block)
                key = h ^ (words.text_of_word()[start].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                hit = start[np.isin(key, key[np.searchsorted(start, words.first[own] + place)])]
                doc = words.text_of_word()[hit]
                low = np.maximum(words.first[doc], hit - (width - block))
                high = np.minimum(hit, words.first[doc + 1] - width)
                fits = low <= high
                windows, tag = window_hashes(hashes, words, width)
                _, other = window_hashes(word_hashes(texts, words, 7), words, width, 7)
                take = cover(words, low[fits], high[fits])[windows]
                bucket = (other[take] % np.uint64(buckets)).astype(np.int32)
                unit.add(ids, uids, words.counts, windows[take], bucket, tag[take], np.zeros((take.sum(), 1), bool))
                if unit.full:
                    yield unit.rows()
        if unit.parts:
            yield unit.rows()

    return joined.where("found is not null").mapInArrow(run, UNIT_SCHEMA)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 20, block: int = 10
) -> DataFrame:
    """Drop every word covered by a ``width``-word window whose word sequence also starts earlier.

    Returns (doc_id, n_words, n_removed, kept_text) for every row; ``kept_text`` is the
    remaining words joined by one space. Earlier means in a smaller doc_id, or in the same
    document at an earlier word; windows are judged on the input. Texts are cut at space,
    tab, line and page breaks, and words are compared as they are.

    Non-overlapping blocks of ``block`` words are the index and every rolling window of that
    size probes it; both are dealt to buckets by hash. Only windows of ``width`` words around
    a probe that found an anchor are then compared, by 64 bits of hash and the bucket's
    independent hash, so the repeats found are the maximal ones. A document enters a bucket
    once per distinct block, however often it repeats it.

    Null and empty texts have no words and give an empty text. Null ids come last in the
    order and are returned as null. Rows that repeat an id are documents of the same place
    in the order, and identical rows keep the same words: neither starts earlier than the
    other. Texts shorter than a window stay whole. Other columns are not read.
    """
    if 2 * block - 1 > width:
        raise ValueError("a window must hold a whole block wherever it begins: width >= 2 * block - 1")
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-text_bytes(docs, text) // BUCKET_BYTES))
    rows, packed = _keyed(docs, doc_id, text), _squeezed(docs, doc_id, text)
    anchored = written(_chosen(_probe_units(rows, width, block, buckets), _shared), "repeat-anchors")
    candidates = _candidate_units(packed.join(anchored, ["id", "uid"]).select("id", "uid", "packed", "found"), width, block, buckets)
    repeated = written(_chosen(candidates, _later), "repeat-windows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, texts, own, place in _read_joined(batch):
                words = words_of(texts)
                low = words.first[own] + place
                kept = ~cover(words, low, low + width - 1)
                data, new = gather_words(texts.data, words.start[kept], words.end[kept])
                before = np.concatenate([[0], np.cumsum(kept)])[words.first]
                raw = data.tobytes()
                joined = [raw[new[a]:new[b] - 1] if b > a else b"" for a, b in zip(before, before[1:])]
                columns = [pa.array(ids, mask=ids == LAST_ID), pa.array(words.counts),
                           pa.array(words.counts - np.diff(before)), pa.array(joined, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_text"])

    # A repeated row would meet the places found for each of its copies: they are the same places.
    once = repeated.groupBy("id", "uid").agg(F.first("found").alias("found"))
    return packed.join(once, ["id", "uid"], "left").select("id", "uid", "packed", "found").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string")
