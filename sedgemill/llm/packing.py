"""Packing of documents into sequences of bounded length, by column generation over the histogram of piece lengths."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sedgemill.llm.byte_pieces import encoder, token_ids
from sedgemill.llm.cutting_stock import patterns
from sedgemill.llm.textkit import Texts, map_texts
from sedgemill.session import written

#: Tokens that lengths are rounded up to when patterns are sought.
GRAIN = 4
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(total: int, capacity: int, block: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then whole blocks, then the rest."""
    full, rest = divmod(total, capacity)
    blocks, tail = divmod(rest, block)
    return [capacity] * full + [block] * blocks + [tail] * (tail > 0)


def token_pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, block: int = 512,
    end_id: int = 1, with_ids: bool = False,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every document's ids with ``end_id`` after them."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        ids, first = token_ids(encoder(path), texts)
        rows, values = [], []
        for i, key in enumerate(part.column(0).to_pylist()):
            own = np.append(ids[first[i]:first[i + 1]], np.uint32(end_id)).astype("<u4")
            at = 0
            for length in cut(len(own), capacity, block):
                piece = own[at:at + length]
                rows.append((key, at, length, zlib.crc32(piece.tobytes()), len(own)))
                if with_ids:
                    values.append(piece.astype(np.int32))
                at += length
        columns = [pa.array(c, type=pa.int64()) for c in zip(*rows, strict=True)]
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        if with_ids:
            columns.append(pa.array(values, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return map_texts(rows, "_text", PIECE_SCHEMA + ", ids array<int>" * with_ids, work)


def _ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """Rank of every piece among those of its size, from 0, without bringing a size into one task.

    Pieces of a size are dealt to buckets by hash and numbered there; the counts of the
    buckets before, a few numbers per size and bucket, are added.
    """
    placed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy("_size", "_bucket").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    before = Window.partitionBy("_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_size", "_bucket").agg(F.count("*").alias("_n"))
    starts = counts.select("_size", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_place", F.row_number().over(inside))
    return numbered.join(starts, ["_size", "_bucket"]).withColumn(
        "_rank", F.col("_before") + F.col("_place") - 1).drop("_bucket", "_before", "_place")


def _slots(found: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (size, first rank, first sequence, pieces per sequence): who takes the pieces of a size, in rank order."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in found:
        for size, per in pattern.items():
            rows.append((size, taken.get(size, 0), sequence, per))
            taken[size] = taken.get(size, 0) + per * times
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, block: int = 512,
    end_id: int = 1, grain: int = GRAIN, with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens; one row per piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens, padded_tokens (``capacity``, or ``sequence_tokens`` at a power of two) and,
    if asked for, ids. A document is its ids and ``end_id``; it is cut into whole sequences,
    then blocks, then a rest. The histogram of piece lengths, at most ``block / grain`` counts
    however many pieces there are, is all the linear program on the driver sees. Its rounded
    patterns are dealt to the pieces by their rank among those of their size.

    Null and empty texts are documents of ``end_id`` alone. Rows that repeat an id are packed
    each on its own; null ids stay null; other columns are not read. An empty table gives none.
    Any ``capacity`` of at least ``grain`` tokens will do; one below is refused.
    """
    if not 1 <= grain <= capacity or block < 1:
        raise ValueError(f"grain {grain} and block {block} do not suit sequences of {capacity} tokens")
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = written(token_pieces(docs, path, doc_id, text, capacity, block, end_id, with_ids), "pack-pieces")
    whole = capacity // grain  # a piece that rounds up beyond it fills a sequence alone
    size = F.when(F.col("length") >= capacity - grain, F.lit(whole)).otherwise(F.least(F.ceil(F.col("length") / grain), F.lit(whole)))
    pieces = pieces.withColumn("_size", size.cast("int"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("_size").count().collect()}
    slots = _slots(patterns(histogram, whole))

    def deal(batches):
        keys = slots[:, 0] << 44 | slots[:, 1]
        for batch in batches:
            sizes, ranks = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                            for c in ("_size", "_rank"))
            row = slots[np.searchsorted(keys, sizes << 44 | ranks, side="right") - 1]
            yield batch.append_column("sequence_id", pa.array(row[:, 2] + (ranks - row[:, 1]) // row[:, 3]))

    ranked = _ranked(pieces, buckets)
    dealt = ranked.mapInArrow(deal, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in ranked.schema)}, sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32", "_rank")
    whole = Window.partitionBy("sequence_id")
    upto = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = dealt.withColumn("offset", upto - F.col("length")).withColumn("sequence_tokens", F.sum("length").over(whole))
    power = F.bit_count("sequence_tokens") == 1
    return out.withColumn("padded_tokens", F.when(power, F.col("sequence_tokens")).otherwise(F.lit(capacity)).cast("long")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_tokens",
        *["ids"] * with_ids)
