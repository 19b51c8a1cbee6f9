"""Quality rules: base counts of a text, and limits on what suffix arrays find repeated in it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import base_counts, per_text, suffix_repeats
from sedgemill.llm.textkit import Texts, map_texts, word_hashes, words_of

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]


def repetition_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 4, most_covered: int = 30,
    longest: int = 100, least_words: int = 50, most_repeated: int = 50,
) -> DataFrame:
    """Counts and verdict of every row.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_covered_words, longest_repeat, base_failed, kept. The suffix array of a text's words
    gives its maximal repeated sequences; ``n_covered_words`` are the words in the union of
    all occurrences of those of ``shortest`` words or more, ``longest_repeat`` is the longest
    in words. The base rules fail a text of under ``least_words`` words, or with more than
    ``most_repeated`` percent of its words in repeated 3-word windows. A text is kept if they
    do not fail, at most ``most_covered`` percent of its words are covered, and no repeat is
    longer than ``longest`` words.

    Null and empty texts have no words and fail. Every row is judged alone, so repeated rows,
    ties and null ids make no difference; other columns are not read.
    """

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        words = words_of(texts)
        hashes = word_hashes(texts, words)
        base = base_counts(texts, words, hashes)
        repeat = suffix_repeats(hashes, words.first)
        change = np.zeros(len(words) + 1, dtype=np.int64)
        at = np.flatnonzero(repeat >= shortest)
        np.add.at(change, at, 1)
        np.add.at(change, at + repeat[at], -1)
        base["n_covered_words"] = per_text(np.cumsum(change)[:-1] > 0, words.first)
        base["longest_repeat"] = np.zeros(len(texts), dtype=np.int64)
        full = np.flatnonzero(words.counts)
        if len(full):
            base["longest_repeat"][full] = np.maximum.reduceat(repeat, words.first[:-1][full])
        return pa.RecordBatch.from_arrays(
            [part.column(0), *[pa.array(base[c].astype(np.int64)) for c in COLUMNS]], ["doc_id", *COLUMNS])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    counted = map_texts(rows, "_text", "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS), work)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    fine = (100 * F.col("n_covered_words") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
