"""SimHash near-duplicates by tiled exact comparison of all distinct fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.components import star_components
from sedgemill.llm.textkit import Texts, free_name, map_texts, row_key, spaced, words_of, xxh64
from sedgemill.session import written

TILE = 4096
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Population counts kept for each tile: of 2 halves and of 8 bytes.
HALVES = [0xFFFFFFFF00000000, 0xFFFFFFFF]
BYTES = [0xFF << s for s in range(56, -1, -8)]


def fingerprint_values(texts: Texts, width: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text over its ``width``-word shingles, repeats included."""
    texts = Texts(LOWER[texts.data], texts.offsets)
    words = words_of(texts)
    data, start, end = spaced(texts, words)
    per = words.counts
    shingles = np.where(per >= width, per - width + 1, (per > 0).astype(per.dtype))
    size = np.minimum(per, width)
    first = np.zeros(len(per) + 1, dtype=np.int64)
    np.cumsum(shingles, out=first[1:])
    at = np.arange(first[-1]) - np.repeat(first[:-1] - words.first[:-1], shingles)
    h = xxh64(data, start[at], end[at + np.repeat(size, shingles) - 1], seed) if len(at) else np.zeros(0, np.uint64)
    out = np.zeros(len(per), dtype=np.uint64)
    full = np.flatnonzero(shingles)
    if len(full):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[full], axis=0, dtype=np.int32)
        chosen = np.packbits(2 * ones > shingles[full, None], axis=1, bitorder="little")
        out[full] = chosen.view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row (doc_id, key, fp) per row of ``docs``: ``fp`` is the signed value of the 64 bits, ``key`` a hash of id and text."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        values = fingerprint_values(texts, width).view(np.int64)
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(values)], ["doc_id", "key", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).alias("_text"))
    return map_texts(rows, "_text", "doc_id long, key long, fp long", work)


def _ones(masks: list[int]) -> list:
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return [F.bit_count(F.col("fp").bitwiseAND(F.lit(m))) for m in signed]


def tiles(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints in order of their population counts, ``tile`` to a row, with the ranges of those counts."""
    n = distinct.count()
    parts = max(1, -(-n // tile))
    placed = distinct.select("fp").repartitionByRange(parts, *_ones(HALVES), *_ones(BYTES), "fp")
    placed = placed.sortWithinPartitions(*_ones(HALVES), *_ones(BYTES), "fp")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)
        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            while len(held) >= tile:
                yield _tile(held[:tile])
                held = held[tile:]
        if len(held):
            yield _tile(held)

    schema = "tile string, lo array<int>, hi array<int>, fps binary"
    return written(placed.mapInArrow(pack, schema), "simhash-tiles")


def _tile(fps: np.ndarray) -> pa.RecordBatch:
    counts = np.stack([np.bitwise_count(fps & np.uint64(m)) for m in HALVES + BYTES]).astype(np.int32)
    name = f"{int(fps[0]):016x}"  # fingerprints are distinct, so the first names its tile
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([counts.min(1)]), pa.array([counts.max(1)]), pa.array([fps.tobytes()])],
        ["tile", "lo", "hi", "fps"])


def tile_pairs(packed: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles (each with itself, too) that can hold fingerprints within ``radius`` bits.

    Bits that differ in a part of the fingerprint are at least the difference of the
    part's population counts, so a pair is skipped where the gaps between the two tiles'
    ranges, added over the parts, exceed the radius. The pairs are found by joining on the
    counts of the two halves, each pair at one cell of that grid only.
    """
    head = packed.select("tile", "lo", "hi")
    span = lambda i, r: F.explode(F.sequence(F.col("lo")[i] - r, F.col("hi")[i] + r))
    grid = lambda df, r: df.withColumn("_l", span(0, r)).withColumn("_r", span(1, r))
    a = grid(head, 0).select(F.col("tile").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), "_l", "_r")
    b = grid(head, radius).select(F.col("tile").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), "_l", "_r")
    gap = lambda i: F.greatest(
        F.lit(0), F.col("lo_b")[i] - F.col("hi_a")[i], F.col("lo_a")[i] - F.col("hi_b")[i])
    once = (F.col("_l") == F.greatest(F.col("lo_a")[0], F.col("lo_b")[0] - radius)) & (
        F.col("_r") == F.greatest(F.col("lo_a")[1], F.col("lo_b")[1] - radius))
    near = (gap(0) + gap(1) <= radius) & (sum((gap(i) for i in range(3, 10)), gap(2)) <= radius)
    found = a.join(b, ["_l", "_r"]).where((F.col("a") <= F.col("b")) & once & near).select("a", "b")
    swap = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 1  # so that no tile is always on one side
    return found.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"),
                        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))


def union(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j in place; ``parent[x] == root`` for all x before and after."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool, rows: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` bits between two tiles, reduced to one link to its set's root per fingerprint."""
    everyone = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    parent = np.arange(len(everyone))
    for at in range(0, len(a), rows):
        low = at if same else 0
        near = np.bitwise_count(a[at:at + rows, None] ^ b[None, low:]) <= radius
        if near.any():
            i, j = np.nonzero(near)
            union(parent, i + at, j + low + shift)
    child = np.flatnonzero(parent != np.arange(len(parent)))
    return everyone[child], everyone[parent[child]]


def links(packed: DataFrame, radius: int = 3) -> DataFrame:
    """Rows (u, v) of distinct fingerprints whose classes are those of all pairs within ``radius`` bits."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a, b = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                u, v = tile_links(a, b, radius, bool(a[0] == b[0]))
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    one = packed.select(F.col("tile").alias("a"), F.col("fps").alias("fps_a"))
    two = packed.select(F.col("tile").alias("b"), F.col("fps").alias("fps_b"))
    both = tile_pairs(packed, radius).join(one, "a").join(two, "b").select("fps_a", "fps_b")
    return both.mapInArrow(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3, tile: int = TILE
) -> DataFrame:
    """Fingerprint and class of every row: (doc_id, key, fp, component_id, component_key).

    Rows are linked where their fingerprints differ in at most ``radius`` bits; a class is
    what links reach, named by its smallest doc_id. Copies share one fingerprint and are
    compared once. Null and word-less texts have fingerprint 0, which links like any other;
    a null doc_id keeps its row and names no class unless all ids of the class are null;
    ``component_key`` is the key of the row that names the class.
    Repeated rows stay. Other columns are not read.
    """
    marks = written(fingerprints(docs, doc_id, text, width), "simhash-marks")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    distinct = written(marks.groupBy("fp").agg(first), "simhash-distinct")
    found = written(links(tiles(distinct, tile), radius), "simhash-links")
    roots = star_components(found)
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("first"))
    classes = rooted.select("fp", "root").join(named, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("component_key"))
    return marks.join(classes, "fp").select("doc_id", "key", "fp", "component_id", "component_key")


def keep_first_of_class(docs: DataFrame, classes: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each class: that of the smallest id, and of the smallest key among rows of that id."""
    key, own = free_name(docs, "_key"), free_name(docs, "_own")
    kept = classes.where((F.col("key") == F.col("component_key")) & F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("key").alias(key), F.col("doc_id").alias(own)).distinct()
    keyed = docs.withColumns({key: row_key(doc_id, text), own: F.col(doc_id).cast("long")})
    same = (keyed[key] == kept[key]) & keyed[own].eqNullSafe(kept[own])
    return keyed.join(kept, same, "left_semi").dropDuplicates([key, own]).drop(key, own)
