"""Language identification: scripts narrow the candidates, a Viterbi path over words labels the spans."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import IS_LOWER, IS_UPPER, per_text
from sedgemill.llm.textkit import Texts, Words, held_out, map_texts, mix, runs, spaced, words_of

#: Labelled texts a model is fitted on, in expectation, for each language.
TRAINING_TEXTS = 3_000
#: Buckets of hashed byte sequences, for each of their lengths.
BUCKETS = 1 << 15
LENGTHS = (1, 2, 3, 4)
#: Words scored at a time: bounds the memory of their byte sequences.
BLOCK_WORDS = 1 << 14
#: Bytes of texts whose paths are found in step; more make fewer steps.
PATH_BYTES = 2 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# First and last code points of letters of the scripts told apart.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x531, 0x587)],
    "hebrew": [(0x5D0, 0x5F2)],
    "arabic": [(0x620, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE01, 0xE4E)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3041, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "hangul": [(0xAC00, 0xD7A3), (0x1100, 0x11FF)],
}
_RANGES = sorted((a, b, 1 << i) for i, ranges in enumerate(SCRIPTS.values()) for a, b in ranges)
_FROM, _TO, _BIT = (np.array(c, dtype=np.int64) for c in zip(*_RANGES, strict=True))
ASCII_LETTER = IS_LOWER | IS_UPPER


def scripts_of_bytes(data: np.ndarray) -> np.ndarray:
    """The script bit of the letter that begins at each byte; 0 inside letters and for other signs."""
    out = np.where(ASCII_LETTER[data], 1, 0).astype(np.int32)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        more = lambda i: data[np.minimum(lead + i, len(data) - 1)].astype(np.int64) & 0x3F
        first = data[lead].astype(np.int64)
        code = np.where(first < 0xE0, (first & 0x1F) << 6 | more(1), np.where(
            first < 0xF0, (first & 0xF) << 12 | more(1) << 6 | more(2),
            (first & 0x7) << 18 | more(1) << 12 | more(2) << 6 | more(3)))
        at = np.maximum(np.searchsorted(_FROM, code, side="right") - 1, 0)
        out[lead] = np.where((code >= _FROM[at]) & (code <= _TO[at]), _BIT[at], 0)
    return out


def _padded(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space before and after each; start and end of each word."""
    data, start, end = spaced(Texts(LOWER[texts.data], texts.offsets), words)
    return np.concatenate([[np.uint8(32)], data]), start + 1, end + 1


def sequence_buckets(data: np.ndarray, length: int) -> np.ndarray:
    """Bucket of the byte sequence of ``length`` that begins at each place (the last few places have none)."""
    n = max(len(data) - length + 1, 0)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        code = code << np.uint64(8) | data[i:i + n].astype(np.uint64)
    return (mix(code + np.uint64(length << 40)) >> np.uint64(49)).astype(np.int64)


def _inside(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    change = np.zeros(n + 2, dtype=np.int64)
    fits = first <= last
    np.add.at(change, first[fits], 1)
    np.add.at(change, last[fits] + 1, -1)
    return np.cumsum(change)[:n] > 0


@dataclass
class LanguageModel:
    """``logs[length][bucket]`` has a logarithm for each language; ``scripts[language]`` the bits of its scripts."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray

    def _block_scores(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.zeros((len(data) + 1, len(self.languages)))
        scores = np.zeros((len(start), len(self.languages)))
        for table, length in zip(self.logs, LENGTHS, strict=True):
            found = table[sequence_buckets(data, length)]
            np.cumsum(found, axis=0, out=total[1:len(found) + 1])
            low, high = start - (length > 1), np.maximum(end + (length > 1) - length + 1, start - (length > 1))
            high = np.minimum(high, len(found))
            scores += total[np.maximum(high, low)] - total[low]
        return scores

    def word_scores(self, texts: Texts, words: Words) -> np.ndarray:
        """Score of each word in each language; a word without letters scores 0 in all."""
        data, start, end = _padded(texts, words)
        scores = np.zeros((len(words), len(self.languages)))
        for at in range(0, len(words), BLOCK_WORDS):
            upto = min(at + BLOCK_WORDS, len(words))
            low, high = start[at] - 1, end[upto - 1] + 1
            scores[at:upto] = self._block_scores(data[low:high], start[at:upto] - low, end[at:upto] - low)
        seen = np.bitwise_or.reduceat(scripts_of_bytes(data), start) if len(words) else np.zeros(0, np.int32)
        fits = (seen[:, None] & self.scripts[None, :]) != 0
        scores[(seen != 0)[:, None] & ~fits & fits.any(1)[:, None]] -= 1e6
        scores[seen == 0] = 0
        return scores


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word on the best path of its text, where each switch costs ``penalty``.

    Texts go in step, longest first, so a step is one set of array operations on all texts
    that still have a word.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    came = np.zeros(scores.shape, dtype=np.int8)
    value = np.zeros((len(size), scores.shape[1]))
    own = np.arange(scores.shape[1], dtype=np.int8)
    for t in range(longest):
        m = active[t]
        at = begin[:m] + t
        v = value[:m]
        if t:
            top = v.argmax(1)
            best = v[np.arange(m), top][:, None] - penalty
            stay = v >= best
            came[at] = np.where(stay, own, top[:, None].astype(np.int8))
            v = np.where(stay, v, best)
        value[:m] = v + scores[at]
    path = np.zeros(len(scores), dtype=np.int8)
    state = value.argmax(1)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at = begin[:m] + t
        path[at] = state[:m]
        if t:
            state[:m] = came[at, state[:m]]
    return path


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", texts: int = TRAINING_TEXTS) -> LanguageModel:
    """Learn from rows that have a language and are not held out, about ``texts`` of each language.

    Rows are chosen by a hash of their id. What is counted has a fixed number of buckets for
    each language, so the driver receives a model of bounded size.
    """
    known = docs.where(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("_lang"), F.col(text).alias("_text"), F.xxhash64(F.col(doc_id).cast("long")).alias("_h"))
    counts = {r[0]: r[1] for r in known.groupBy("_lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((len(LENGTHS), BUCKETS, 0)), np.zeros(0, np.int32))
    share = F.coalesce(*[F.when(F.col("_lang") == k, F.lit(int(min(1.0, texts / n) * (1 << 30)))) for k, n in counts.items()])
    chosen = known.where(F.pmod("_h", F.lit(1 << 30)) < share).select("_lang", "_text")
    number = {k: i for i, k in enumerate(languages)}

    def count(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        words = words_of(texts)
        data, start, end = _padded(texts, words)
        own = np.array([number[x] for x in part.column(0).to_pylist()], dtype=np.int64)[words.text_of_word()]
        place = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(place, start[1:] - 1, np.diff(own))
        owner = np.cumsum(place)[:-1] + (own[0] if len(own) else 0)
        keys, many = [], []
        lettered = np.bitwise_or.reduceat(scripts_of_bytes(data), start) != 0 if len(words) else np.zeros(0, bool)
        for i, length in enumerate(LENGTHS):
            bucket = sequence_buckets(data, length)
            use = _inside((start - (length > 1))[lettered], (end + (length > 1) - length)[lettered], len(bucket))
            key, n = np.unique((owner[:len(bucket)] * len(LENGTHS) + i)[use] * BUCKETS + bucket[use], return_counts=True)
            keys.append(key)
            many.append(n)
        script = scripts_of_bytes(data)
        for i in range(len(SCRIPTS)):
            key, n = np.unique(owner[script == 1 << i], return_counts=True)
            keys.append(-1 - (key * len(SCRIPTS) + i))
            many.append(n)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(many).astype(np.int64))], ["k", "n"])

    counted = map_texts(chosen, "_text", "k long, n long", count).groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    k, n = counted["k"].to_numpy(), counted["n"].to_numpy().astype(float)
    grams = np.full((len(languages) * len(LENGTHS) * BUCKETS,), 0.0)
    grams[k[k >= 0]] = n[k >= 0]
    grams = grams.reshape(len(languages), len(LENGTHS), BUCKETS) + 0.5
    logs = np.log(grams / grams.sum(2, keepdims=True)).transpose(1, 2, 0)
    letters = np.zeros((len(languages) * len(SCRIPTS),))
    letters[-1 - k[k < 0]] = n[k < 0]
    letters = letters.reshape(len(languages), len(SCRIPTS))
    common = letters >= 0.01 * np.maximum(letters.sum(1, keepdims=True), 1)
    return LanguageModel(languages, np.ascontiguousarray(logs), (common * (1 << np.arange(len(SCRIPTS)))).sum(1).astype(np.int32))


def _has_letter(texts: Texts) -> np.ndarray:
    """Is there any letter: looked up for the scripts known here, asked of each sign in the texts left over."""
    known = per_text(scripts_of_bytes(texts.data) != 0, texts.offsets) > 0
    for i in np.flatnonzero(~known):
        raw = texts.data[texts.offsets[i]:texts.offsets[i + 1]].tobytes().decode("utf-8", "ignore")
        known[i] = any(c.isalpha() for c in raw)
    return known


def _labelled(model: LanguageModel, texts: Texts, penalty: float):
    """Language number (the last is none), score, and for each word its text and language."""
    words = words_of(texts)
    n, k = len(texts), max(len(model.languages), 1)
    share, path = np.zeros((n, k)), np.zeros(0, np.int8)
    if model.languages and len(words):
        scores = model.word_scores(texts, words)
        path = best_path(scores, words.first, penalty)
        counts = np.where(scores.any(1), words.end - words.start, 0)
        share = np.bincount(words.text_of_word() * k + path, counts, n * k).reshape(n, k)
    total = share.sum(1)
    known = _has_letter(texts) & bool(model.languages)
    score = np.where(known & (total > 0), share.max(1) / np.maximum(total, 1), 0.0)
    return np.where(known, share.argmax(1), len(model.languages)), score, words, path


def keep_identified(
    docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = 8.0, least_score: float = 0.5
) -> DataFrame:
    """Rows whose text has a language that takes at least ``least_score`` of its lettered words."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        number, score, _, _ = _labelled(model, texts, penalty)
        return part.filter(pa.array((number < len(model.languages)) & (score >= least_score)))

    return map_texts(docs, text, docs.schema, work, PATH_BYTES)


def identify(
    docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text", penalty: float = 8.0
) -> DataFrame:
    """Language and spans of every row: (doc_id, held_out, lang_pred, score, spans).

    Each word is scored in each language that shares a script with it (in all where none
    does); the best path with ``penalty`` per switch labels the words. ``lang_pred`` is the
    language with the most bytes of lettered words, the first in the alphabet at a tie,
    ``score`` its share of them. ``spans`` lists (language, first word, words) in order; words
    without letters join the span they stand in.

    A null text, and one without any letter, is ``und`` with score 0 and no spans, as is every
    text where nothing was learned. Every row is judged alone, by its text only; repeated
    rows, null ids and other columns make no difference.
    """
    names = [*model.languages, "und"]

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        number, score, words, path = _labelled(model, texts, penalty)
        known = number < len(model.languages)
        lists = [[] for _ in range(len(texts))]
        if len(path):
            doc = words.text_of_word()
            new = np.ones(len(path), dtype=bool)
            new[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new)
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(path)], strict=True):
                lists[doc[a]].append({"lang": names[path[a]], "start": a - int(words.first[doc[a]]), "words": b - a})
        spans = [x if ok else [] for x, ok in zip(lists, known, strict=True)]
        kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("words", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.array(names, dtype=object)[number], pa.string()), pa.array(score), pa.array(spans, kind)],
            ["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang: string, start: int, words: int>>"
    found = map_texts(rows, "_text", schema, work, PATH_BYTES)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")
