"""Line dedup: documents that share lines are aligned by patience diff, and common blocks leave the later one."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import line_hashes, lines_of
from sedgemill.llm.textkit import Texts, free_name, map_texts, row_key, words_of
from sedgemill.session import written

LAST_ID = (1 << 63) - 1
Block = tuple[int, int, int]


def _rising(places: list[int]) -> list[int]:
    """Indices of a longest increasing run of ``places``."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(places)
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        before[i] = at[k - 1] if k else -1
        tops[k:k + 1], at[k:k + 1] = [p], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience_blocks(a: list[int], b: list[int]) -> list[Block]:
    """Aligned common blocks (place in a, place in b, lines) of two lists of line hashes.

    Lines that occur once on either side and keep their order are anchors; anchors are
    extended over equal neighbours, and what lies between two anchors is aligned in the same
    way by itself.
    """
    out: list[Block] = []
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {h: i for i, h in enumerate(a[a0:a1], a0) if once_a[h] == 1 and once_b.get(h) == 1}
        common = [(place[h], j) for j, h in enumerate(b[b0:b1], b0) if h in place]
        if not common:
            continue
        anchors = [common[k] for k in _rising([i for i, _ in common])]
        i, j = a0, b0
        for x, y in anchors:
            if y < j:
                continue  # inside a block that an anchor before it was extended to
            start_x, start_y = x, y
            while start_x > i and start_y > j and a[start_x - 1] == b[start_y - 1]:
                start_x, start_y = start_x - 1, start_y - 1
            while x < a1 and y < b1 and a[x] == b[y]:
                x, y = x + 1, y + 1
            out.append((start_x, start_y, x - start_x))
            if start_x > i and start_y > j:
                open_.append((i, start_x, j, start_y))
            i, j = x, y
        if i < a1 and j < b1:
            open_.append((i, a1, j, b1))
    return sorted(out, key=lambda v: v[1])


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, key, hashes, words): hash and number of words of every line; ``key`` tells rows of one id apart."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        begin, end, owner = lines_of(texts)
        words = words_of(texts)
        per = np.searchsorted(words.start, end) - np.searchsorted(words.start, begin)
        first = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
        hashes = pa.array(line_hashes(texts, begin, end).view(np.int64))
        lists = [pa.ListArray.from_arrays(pa.array(first), v) for v in (hashes, pa.array(per.astype(np.int32)))]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], ["id", "key", "hashes", "words"])

    rows = _keyed(docs, doc_id, text).select("id", "key", F.col("text").alias("_text"))
    return map_texts(rows, "_text", "id long, key long, hashes array<long>, words array<int>", work)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.withColumns({
        "id": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)), "key": row_key(doc_id, text),
        "text": F.col(text)})


def overlapping(lines: DataFrame) -> DataFrame:
    """Pairs (a, b) of an earlier and a later document that share a line with a word.

    A document is paired with the first holder of each of its shared lines, so a line in many
    documents makes one pair for each of them and not for each two of them.
    """
    placed = lines.select("id", "key", F.explode(F.arrays_zip("hashes", "words")).alias("_l")).where("_l.words > 0")
    held = placed.select(F.col("_l.hashes").alias("h"), F.struct("id", "key").alias("doc"))
    first = held.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).where("a != z").select("h", "a")
    return held.distinct().join(first, "h").where("doc != a").select("a", F.col("doc").alias("b")).distinct()


def common_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 4) -> DataFrame:
    """Blocks of lines that a document has in common with an earlier one: what line dedup deletes.

    Columns: doc_id, key, line_start, n_lines, n_words, kept_doc_id, kept_line_start. Lines
    end at line breaks and are equal if all their bytes are. Of two documents the one with
    the larger id is later, null ids come last, and rows that repeat an id go by ``key``, a
    hash of id and text; identical rows are one document. Blocks of under ``least_words``
    words are left alone. Null texts have no lines with a word, and other columns are not read.
    """
    lines = written(line_table(docs, doc_id, text).dropDuplicates(["id", "key"]), "line-table")
    pairs = written(overlapping(lines), "line-pairs")
    side = lambda n: lines.select(*[F.col(c).alias(f"{c}_{n}") for c in lines.columns])
    flat = pairs.select(F.col("a.id").alias("id_a"), F.col("a.key").alias("key_a"), F.col("b.id").alias("id_b"), F.col("b.key").alias("key_b"))
    both = flat.join(side("a").drop("words_a"), ["id_a", "key_a"]).join(side("b"), ["id_b", "key_b"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_a, id_b, key_b = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for n, (x, y, w) in enumerate(zip(batch.column(3), batch.column(4), batch.column(5), strict=True)):
                total = np.concatenate([[0], np.cumsum(w.values.to_numpy())])
                for i, j, size in patience_blocks(x.values.to_pylist(), y.values.to_pylist()):
                    words = int(total[j + size] - total[j])
                    if words >= least_words:
                        out.append((id_b[n], key_b[n], j, size, words, id_a[n], i))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["doc_id", "key", "line_start", "n_lines", "n_words", "kept_doc_id", "kept_line_start"]
    found = both.select("id_a", "id_b", "key_b", "hashes_a", "hashes_b", "words_b").mapInArrow(
        align, ", ".join(f"{c} long" for c in names))
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).alias(c)
    return found.select(real("doc_id"), *names[1:5], real("kept_doc_id"), "kept_line_start")


def without_common_blocks(docs: DataFrame, blocks: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines of ``blocks`` taken out of their texts; a document that loses all lines with a word goes.

    The other rows and columns stay as they are.
    """
    name, own, list_name = free_name(docs, "_key"), free_name(docs, "_own"), free_name(docs, "_gone")
    known = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(LAST_ID)).alias(own)
    gone = blocks.groupBy(F.col("key").alias(name), known("doc_id")).agg(
        F.collect_set(F.struct("line_start", "n_lines")).alias(list_name))
    joined = docs.withColumns({name: row_key(doc_id, text), own: known(doc_id)}).join(gone, [name, own], "left")
    inside = lambda i: F.exists(list_name, lambda g: (i >= g["line_start"]) & (i < g["line_start"] + g["n_lines"]))
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~inside(i)), "\n")
    whole = F.col(list_name).isNull()
    left = joined.withColumn(text, F.when(whole, F.col(text)).otherwise(kept))
    some = whole | F.regexp_like(F.col(text), F.lit(r"[^\x20\x09-\x0D]"))
    return left.where(some).select(*docs.columns)
