"""Benchmark decontamination by templates, which also finds questions asked again with other numbers, names or units."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import IS_DIGIT, IS_LOWER, IS_UPPER
from sedgemill.llm.textkit import Texts, _table, free_name, map_texts, mix, range_hash, row_key, words_of
from sedgemill.session import written

#: Bits of the filter that documents' windows are tried on before any of them is shuffled.
FILTER_BITS = 1 << 24
# Words that name a unit when they stand after a number.
UNITS = (
    "%", "°", "°c", "°f", "$", "€", "£", "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "foot", "yards", "miles",
    "mile", "g", "kg", "mg", "lb", "lbs", "oz", "tons", "ml", "l", "liters", "litres", "gallons", "s", "sec", "seconds", "min",
    "minutes", "h", "hours", "days", "weeks", "months", "years", "mph", "km/h", "w", "kw", "v", "j", "cents", "dollars", "euros",
    "pounds", "percent", "meters", "metres", "grams", "kilograms", "kilometers",
)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC13FA9A902A6328F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_EDGE = np.zeros(256, dtype=bool)
IS_EDGE[list(b".,;:!?()[]{}\"'*#&<>|")] = True
ENDS = np.zeros(256, dtype=bool)
ENDS[list(b".!?:")] = True


def _hash(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return range_hash(_table(11, 256)[lowered], start, end, 0xE7037ED1A0B428DB)


def _unit_hashes() -> np.ndarray:
    raw = [u.encode() for u in UNITS]
    edge = np.cumsum([0, *map(len, raw)])
    return np.sort(_hash(np.frombuffer(b"".join(raw), np.uint8), edge[:-1], edge[1:]))


def canonical(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens of each text: hash, kind (0 word, 1 number, 2 name, 3 unit), byte range, and firsts per text.

    Words lose signs at their ends and case. A word with a digit is a number; a capitalised
    word that does not begin a sentence or line is a name; a unit is one of ``UNITS`` right
    after a number. Runs of numbers, or of names, are one placeholder.
    """
    words = words_of(texts)
    data, n = texts.data, len(words)
    start, end = words.start.copy(), words.end.copy()
    ends_sentence = ENDS[data[end - 1]] if n else np.zeros(0, bool)
    while n:
        cut = (start < end) & IS_EDGE[data[np.minimum(start, len(data) - 1)]]
        if not cut.any():
            break
        start[cut] += 1
    while n:
        cut = (start < end) & IS_EDGE[data[end - 1]]
        if not cut.any():
            break
        end[cut] -= 1
    digits = np.concatenate([[0], np.cumsum(IS_DIGIT[data])])
    low = np.concatenate([[0], np.cumsum(IS_LOWER[data])])
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    number = digits[end] > digits[start]
    begins = np.zeros(n, dtype=bool)
    begins[words.first[:-1][words.counts > 0]] = True
    begins[1:] |= ends_sentence[:-1] | (breaks[words.start[1:]] > breaks[words.end[:-1]])
    capital = IS_UPPER[data[np.minimum(start, max(len(data) - 1, 0))]] if n else np.zeros(0, bool)
    name = capital & (low[end] > low[start]) & ~begins & ~number & (start < end)
    h = _hash(LOWER[data], start, end) if n else np.zeros(0, np.uint64)
    units = _unit_hashes()
    unit = units[np.minimum(np.searchsorted(units, h), len(units) - 1)] == h
    unit[1:] &= number[:-1]
    unit[:1] = False
    unit &= ~number & ~begins
    kind = np.where(number, 1, np.where(unit, 3, np.where(name, 2, 0)))
    doc = words.text_of_word()
    keep = start < end
    doc, kind, h, start, end = doc[keep], kind[keep], h[keep], start[keep], end[keep]
    first_of_run = np.ones(len(kind), dtype=bool)
    first_of_run[1:] = (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1]) | (kind[1:] == 0)
    last_of_run = np.ones(len(kind), dtype=bool)
    last_of_run[:-1] = first_of_run[1:]
    doc, kind, h, start, end = doc[first_of_run], kind[first_of_run], h[first_of_run], start[first_of_run], end[last_of_run]
    h = np.where(kind == 1, NUMBER, np.where(kind == 2, NAME, np.where(kind == 3, UNIT, h)))
    return h, kind, np.stack([start, end], axis=1), doc, np.searchsorted(doc, np.arange(len(texts) + 1))


def _windows(h: np.ndarray, kind: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``width`` tokens with more words than placeholders: first token and hash."""
    last = np.repeat(first[1:], np.diff(first)) - width
    words = np.concatenate([[0], np.cumsum(kind == 0)])
    at = np.flatnonzero(np.arange(len(h)) <= last)
    at = at[2 * (words[at + width] - words[at]) > width]
    return at, range_hash(h, at, at + width, 0x8EBC6AF09C88C6E3)


def _rows(part: pa.RecordBatch, texts: Texts, widths: list[int], own_width: bool, bits: np.ndarray | None) -> pa.RecordBatch:
    """Windows as rows (id, pos, width, n_tokens, h, slots); of documents only those the filter lets through."""
    h, kind, span, doc, first = canonical(texts)
    ids, raw = part.column(0).to_pylist(), texts.data.tobytes()
    size = np.diff(first)
    out: list[list] = [[] for _ in range(6)]
    for width in widths:
        at, key = _windows(h, kind, first, width)
        if own_width:  # a short item is one window of its own length
            right = np.minimum(size[doc[at]], widths[-1]) == width
            at, key = at[right], key[right]
        if bits is not None and len(at):
            inside = np.ones(len(at), dtype=bool)
            for place in _filter_places(key):
                inside &= (bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)) == 1
            at, key = at[inside], key[inside]
        for i, k in zip(at.tolist(), key.view(np.int64).tolist(), strict=True):
            d = doc[i]
            slots = [raw[a:b].decode("utf-8", "replace").lower() for (a, b), s in zip(span[i:i + width], kind[i:i + width]) if s]
            for column, value in zip(out, (ids[d], i - int(first[d]), width, int(size[d]), k, slots), strict=True):
                column.append(value)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                      ["id", "pos", "width", "n_tokens", "h", "slots"])


ROW_SCHEMA = "id long, pos long, width int, n_tokens long, h long, slots array<string>"


def _filter_places(key: np.ndarray) -> Iterator[np.ndarray]:
    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        yield (mix(key ^ np.uint64(salt)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _filter(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of the items' windows: ``FILTER_BITS`` bits, whatever their number."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(_filter_places(key))))], ["place"])

    words = windows.select("h").distinct().mapInArrow(places, "place long").groupBy(
        F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return bits.view(np.uint64)


def template_classes(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, class_item_id, n_items): items of one template, named by the smallest id among them.

    Two items are of one template if their template tokens are equal and the same of their
    slots share a value, so a document holds both or neither. An id whose rows have several
    templates is a class of its own, as is each item without a token. A null id names a class
    only where there is no other.
    """

    def keys(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        h, kind, span, _, first = canonical(texts)
        raw, out = texts.data.tobytes(), []
        for low, high in zip(first.tolist(), first[1:].tolist()):
            seen: dict[bytes, int] = {}
            slots = [seen.setdefault(raw[a:b].decode("utf-8", "replace").lower(), len(seen))
                     for (a, b), k in zip(span[low:high].tolist(), kind[low:high].tolist()) if k]
            mark = hashlib.blake2b(h[low:high].tobytes() + b"/" + repr(slots).encode(), digest_size=16)
            out.append(mark.hexdigest() if high > low else None)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], ["id", "mark"])

    items = benchmark.select(F.col(item_id).cast("long").alias("_id"), F.col(item_text).alias("_text"))
    marked = map_texts(items, "_text", "id long, mark string", keys)
    one = F.count("*") == F.count("mark")
    own = F.concat(F.lit("id "), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    by_id = written(marked.groupBy("id").agg(
        F.when(one & (F.min("mark") == F.max("mark")), F.min("mark")).alias("mark")).withColumn("mark", F.coalesce("mark", own)), "template-marks")
    named = by_id.groupBy("mark").agg(F.min("id").alias("class_item_id"), F.count("*").alias("n_items"))
    return by_id.join(named, "mark").select(F.col("id").alias("item_id"), "class_item_id", "n_items")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 6, least_tokens: int = 4, least_covered: float = 0.5,
) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other numbers, names or units.

    Columns: doc_id, item_id, position, covered_tokens, item_tokens, n_slots, changed_slots, n_items.
    Items of one template have one row for a document, that of their smallest id, with their
    number in ``n_items``; ``template_classes`` lists them. ``changed_slots`` counts the slots
    with another value than that item has. Texts become templates with typed placeholders; windows of ``width`` tokens are joined on
    their hash. A document holds an item if, along one alignment of the two, windows cover
    ``least_covered`` of the item's tokens and every value in the item's slots stands for one
    value throughout. ``position`` is the template token of the document at which the best
    such alignment has the item begin; of equal ones the first.

    An item shorter than a window is one window of its own; items under ``least_tokens``
    tokens, null ones among them, and windows with no more words than placeholders are not
    searched. Null texts hold nothing. Rows that repeat an id are one document, or one item.
    Only a filter of fixed size is broadcast; without items the result is empty.
    """
    widths = list(range(least_tokens, width + 1))
    items = benchmark.select(F.col(item_id).cast("long").alias("_id"), F.col(item_text).alias("_text"))
    windows = written(map_texts(items, "_text", ROW_SCHEMA, lambda p, t: _rows(p, t, widths, True, None)), "template-items")
    classes = written(template_classes(benchmark, item_id, item_text), "template-classes")
    heads = classes.where(F.col("item_id").eqNullSafe(F.col("class_item_id"))).select(F.col("item_id").alias("id"), "n_items")
    windows = windows.join(heads, windows.id.eqNullSafe(heads.id), "left_semi")
    used = sorted(r[0] for r in windows.select("width").distinct().collect())
    bits = _filter(windows)
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    tried = map_texts(rows, "_text", ROW_SCHEMA, lambda p, t: _rows(p, t, used, False, bits))
    left = tried.select(F.col("id").alias("doc_id"), "width", "h", "pos", F.col("slots").alias("doc_slots"))
    right = windows.select(F.col("id").alias("item_id"), "width", "h", F.col("pos").alias("item_pos"), "n_tokens", F.col("slots").alias("item_slots"))
    hits = left.join(right, ["h", "width"]).withColumn("position", F.col("pos") - F.col("item_pos"))
    hits = written(hits.select("doc_id", "item_id", "position", "item_pos", "width", "n_tokens", "doc_slots", "item_slots"), "template-hits")
    one = ["doc_id", "item_id", "position"]
    step = lambda acc, p: F.struct(
        (acc["covered"] + F.least(F.col("width"), p - acc["last"])).cast("long").alias("covered"), p.alias("last"))
    covered = hits.groupBy(*one).agg(
        F.array_sort(F.collect_set("item_pos")).alias("at"), F.first("width").alias("width"), F.first("n_tokens").alias("item_tokens"))
    start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(-(1 << 40)).cast("long").alias("last"))
    covered = covered.select(*one, "item_tokens", F.aggregate("at", start, step)["covered"].alias("covered_tokens"))
    covered = covered.where(F.col("covered_tokens") >= least_covered * F.col("item_tokens"))
    pair = F.explode(F.arrays_zip("item_slots", "doc_slots"))
    values = hits.where(F.size("item_slots") > 0).select(*one, pair.alias("_s")).groupBy(*one, F.col("_s.item_slots").alias("value")).agg(
        F.min("_s.doc_slots").alias("low"), F.max("_s.doc_slots").alias("high"))
    slots = values.groupBy(*one).agg(
        F.count("*").alias("n_slots"), F.count_if(F.col("low") != F.col("value")).alias("changed_slots"),
        F.bool_and(F.col("low") == F.col("high")).alias("fits"))
    keys = [covered[c].eqNullSafe(slots[c]) for c in one]
    fitting = covered.join(slots.withColumnRenamed("position", "position"), keys[0] & keys[1] & keys[2], "left").where(
        F.coalesce("fits", F.lit(True))).select(
        *[covered[c] for c in one], "covered_tokens", "item_tokens", F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
        F.coalesce("changed_slots", F.lit(0)).alias("changed_slots"))
    best = F.min_by(F.struct("position", "covered_tokens", "item_tokens", "n_slots", "changed_slots"),
                    F.struct(-F.col("covered_tokens"), F.col("position"))).alias("_b")
    rows = fitting.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "_b.*")
    return rows.join(heads, rows.item_id.eqNullSafe(heads.id)).drop("id")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; rows are told apart by id and text."""
    name = free_name(docs, "_key")
    keyed = docs.withColumn(name, row_key(doc_id, text))
    found = contaminated(keyed, benchmark, doc_id=name, text=text).select(F.col("doc_id").alias(name)).distinct()
    return keyed.join(found, name, "left_anti").drop(name)
