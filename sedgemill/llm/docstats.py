"""Counts and ratios of whole texts, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from sedgemill.llm.textkit import SPACE, Texts, Words, _table, range_hash, window_hashes, word_hashes, words_of

#: The symbols counted by the base rules.
SYMBOLS = b"#*$%&|<>"


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


IS_SYMBOL = _flags(SYMBOLS)
IS_UPPER = _flags(bytes(range(65, 91)))
IS_LOWER = _flags(bytes(range(97, 123)))
IS_DIGIT = _flags(bytes(range(48, 58)))
IS_STOP = _flags(b".,;:?")
IS_LOUD = _flags(b"!")
IS_CONTINUED = np.zeros(256, dtype=bool)
IS_CONTINUED[0x80:0xC0] = True


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive offsets."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def _keyed(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return hashes ^ (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once; has it occurred before."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    many, again = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    many[order] = same[1:] | same[:-1]
    again[:] = many
    if len(keys):
        again[np.minimum.reduceat(order, np.flatnonzero(~same[:-1]))] = False
    return many, again


def lines_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every line; lines end at a line break only, and an empty text has one empty line."""
    breaks = np.flatnonzero(texts.data == 10)
    doc = np.searchsorted(texts.offsets, breaks, side="right") - 1
    start = np.concatenate([texts.offsets[:-1], breaks + 1])
    end = np.concatenate([texts.offsets[1:], breaks])
    text = np.concatenate([np.arange(len(texts)), doc])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    end = np.lexsort((end, np.concatenate([np.arange(len(texts)), doc])))
    ends = np.concatenate([texts.offsets[1:], breaks])[end]
    return start, ends, text


def line_hashes(texts: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return range_hash(_table(3, 256)[texts.data], start, end, 0x9DDFEA08EB382D6F)


def base_counts(texts: Texts, words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the lines and their repeats."""
    n = len(texts)
    solid = ~SPACE[texts.data]
    begin, end, text = lines_of(texts)
    filled = np.concatenate([[0], np.cumsum(solid)])
    filled = filled[end] > filled[begin]
    again = np.zeros(len(begin), dtype=bool)
    again[filled] = _repeats(_keyed(line_hashes(texts, begin, end)[filled], text[filled]))[1]
    at, h = window_hashes(hashes, words, 3)
    many, _ = _repeats(_keyed(h, words.text_of_word()[at]))
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, at[many], 1)
    np.add.at(change, at[many] + 3, -1)
    covered = np.cumsum(change)[:-1] > 0
    return {
        "n_words": words.counts, "word_chars": per_text(solid & ~IS_CONTINUED[texts.data], texts.offsets),
        "n_symbols": per_text(IS_SYMBOL[texts.data], texts.offsets),
        "n_dup_lines": np.bincount(text[again], minlength=n), "n_repeat_words": per_text(covered, words.first),
        "n_lines": np.bincount(text[filled], minlength=n),
    }


FEATURES = [
    "log_words", "mean_word", "symbols", "dup_lines", "repeat_words", "words_per_line", "upper", "digits", "stops", "loud",
    "not_ascii", "unique_words", "capital_words", "short_words", "long_words", "pipe_words", "top_word", "adjacent_same",
    "letters", "longest_word",
]


def features(texts: Texts) -> np.ndarray:
    """One row of ``FEATURES`` per text; a ratio with nothing below it is 0."""
    words = words_of(texts)
    hashes = word_hashes(texts, words)
    base = base_counts(texts, words, hashes)
    data, off, per = texts.data, texts.offsets, words.counts
    ratio = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    of_bytes = lambda flags: ratio(per_text(flags[data], off), np.diff(off))
    of_words = lambda flags: ratio(per_text(flags, words.first), per)
    size = words.end - words.start
    doc = words.text_of_word()
    key = _keyed(hashes, doc)
    again = _repeats(key)[1]
    same = np.zeros(len(words), dtype=bool)
    same[1:] = key[1:] == key[:-1]
    top, longest = np.zeros(len(texts)), np.zeros(len(texts))
    if len(words):
        ordered, count = np.unique(key, return_counts=True)
        full = np.flatnonzero(per)
        top[full] = np.maximum.reduceat(count[np.searchsorted(ordered, key)], words.first[:-1][full])
        longest[full] = np.maximum.reduceat(size, words.first[:-1][full])
    alone = (size == 1) & (data[words.start] == 0x7C) if len(words) else np.zeros(0, bool)
    return np.stack([
        np.log1p(base["n_words"]), ratio(base["word_chars"], per), ratio(base["n_symbols"], base["word_chars"]),
        ratio(base["n_dup_lines"], base["n_lines"]), ratio(base["n_repeat_words"], per), ratio(per, base["n_lines"]),
        of_bytes(IS_UPPER), of_bytes(IS_DIGIT), of_bytes(IS_STOP), of_bytes(IS_LOUD), of_bytes(IS_CONTINUED),
        of_words(~again), of_words(IS_UPPER[data[words.start]]), of_words(size <= 3), of_words(size >= 12),
        of_words(alone), ratio(top, per), of_words(same), of_bytes(IS_UPPER | IS_LOWER), np.log1p(longest),
    ], axis=1)


def suffix_repeats(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length of the longest sequence that starts at each token and also starts elsewhere in the same text.

    A suffix array of each text (all texts of the slice at once) by prefix doubling that sorts
    unsettled suffixes only; the longest common prefixes of neighbours come from the ranks of
    every doubling. A token's length is that of the deepest interval of common prefixes it is in.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][text]
    order = np.lexsort((tokens, text))
    ranks = []
    new = np.ones(n, dtype=bool)
    new[1:] = (tokens[order][1:] != tokens[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    step = 1
    while True:
        ranks.append(rank)
        size = np.diff(np.flatnonzero(new), append=n)
        open_ = np.repeat(size > 1, size)  # places of the order whose group is not settled
        if not open_.any():
            break
        rows = order[open_]
        ahead = rows + step
        second = np.where(ahead < end[rows], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[rows] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        places = np.flatnonzero(open_)
        order = order.copy()
        order[places] = rows[by]
        key = key[by]
        change = np.ones(len(key), dtype=bool)
        change[1:] = key[1:] != key[:-1]
        new = new.copy()
        new[places] = change
        rank = rank.copy()
        rank[rows[by]] = places[np.flatnonzero(change)[np.cumsum(change) - 1]]
        step *= 2
    i, j = order[:-1].copy(), order[1:].copy()
    pair = np.flatnonzero(text[i] == text[j])
    i, j = i[pair], j[pair]
    length = np.zeros(len(pair), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (i < n) & (j < n)
        a, b = np.minimum(i, n - 1), np.minimum(j, n - 1)
        equal = inside & (ranks[level][a] == ranks[level][b]) & (a + (1 << level) <= end[a]) & (b + (1 << level) <= end[b])
        length[equal] += 1 << level
        i[equal] += 1 << level
        j[equal] += 1 << level
    common = np.zeros(n + 1, dtype=np.int64)
    common[pair + 1] = length
    out = np.empty(n, dtype=np.int64)
    out[order] = np.maximum(common[:-1], common[1:])
    return out
