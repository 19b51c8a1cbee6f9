"""Token ids of many texts by a byte-level tokenizer, each distinct piece encoded once by the library."""

from __future__ import annotations


import numpy as np

from sedgemill.llm.textkit import Texts, _table, process_store, range_hash
from sedgemill.llm.transducer import DIGIT, LETTER, SHORT_ENDINGS, SIGN, SPACE_CLASS, byte_classes

#: Distinct pieces kept in a process; beyond them the store starts anew.
MOST_PIECES = 1 << 20


class Encoder:
    """Ids of pieces by a 64-bit hash of their bytes; what the library gives for a piece is kept."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.classes = np.full(0x110000, -1, dtype=np.int8)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.begin, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.pool: np.ndarray = np.zeros(0, dtype=np.uint32)

    def class_of(self, codes: np.ndarray) -> np.ndarray:
        """Space, letter, digit or sign of code points, asked of the library's own pattern once for each."""
        cut = lambda text: len(self.library.pre_tokenizer.pre_tokenize_str(text))
        for c in np.unique(codes[self.classes[codes] < 0]).tolist():
            s = chr(c)
            self.classes[c] = LETTER if cut("a" + s) == 1 else DIGIT if cut("1" + s) == 1 else SIGN if cut("#" + s) == 1 else SPACE_CLASS
        return self.classes[codes]

    def starts(self, texts: Texts) -> np.ndarray:
        """Where pieces begin: a space joins the piece after it, other white space stands apart from it."""
        data, n = texts.data, len(texts.data)
        classes, begins = byte_classes(self, data)
        opens = np.zeros(n + 1, dtype=bool)
        opens[texts.offsets] = True
        changed = np.ones(n, dtype=bool)
        changed[1:] = classes[1:] != classes[:-1]
        changed |= opens[:-1]
        space = classes == SPACE_CLASS
        # The last white-space sign before something else: a piece of its own, or joined to it if it is a space.
        turn = np.flatnonzero(changed & ~space & ~opens[:-1])
        turn = turn[space[turn - 1]]
        before = turn - 1
        while len(before) and not begins[before].all():
            before = np.where(begins[before], before, before - 1)
        starts = changed.copy()
        starts[before] = True
        joined = data[before] == 0x20
        starts[turn[joined]] = False
        quote = np.flatnonzero((data == 0x27) & starts)
        if len(quote):
            limit = texts.offsets[np.searchsorted(texts.offsets, quote, side="right")]
            at = lambda i: np.where(quote + i < limit, data[np.minimum(quote + i, n - 1)], 0)
            taken = np.zeros(len(quote), dtype=np.int64)
            for ending in sorted(SHORT_ENDINGS, key=len):
                hit = np.ones(len(quote), dtype=bool)
                for i, c in enumerate(ending.encode()):
                    hit &= at(i + 1) == c
                taken[hit] = len(ending)
            quote, taken = quote[taken > 0], taken[taken > 0]
            starts[quote + 1] = False
            after = quote + 1 + taken
            after = after[after < n]
            starts[after[~space[after]]] = True
        return np.flatnonzero(starts)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where those of each text begin; no special strings in the texts."""
        start = self.starts(texts)
        end = np.append(start[1:], len(texts.data)) if len(start) else start
        hashes = range_hash(_table(5, 256)[texts.data], start, end, 0xA0761D6478BD642F)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > MOST_PIECES:
            self.clear()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            raw = texts.data.tobytes()
            pieces = [raw[start[i]:end[i]].decode("utf-8") for i in sample[new]]
            ids = [e.ids for e in self.library.encode_batch(pieces, add_special_tokens=False)]
            size = np.array([len(x) for x in ids], dtype=np.int64)
            begin = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, np.array([i for x in ids for i in x], dtype=np.uint32)])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known)
            self.known = known[order]
            self.begin = np.concatenate([self.begin, begin])[order]
            self.size = np.concatenate([self.size, size])[order]
            place = np.searchsorted(self.known, distinct)
        place = place[which]
        size = self.size[place]
        first = np.cumsum(size) - size
        total = int(size.sum())
        out = self.pool[np.arange(total) + np.repeat(self.begin[place] - first, size)]
        pieces = np.searchsorted(start, texts.offsets)
        return out, np.append(first, total)[pieces]


def encoder(path: str) -> Encoder:
    """The encoder of this process for a tokenizer file; tasks that follow each other share it."""
    kept = process_store("encoders")
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def token_ids(built: Encoder, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text as the library gives them, special strings inside texts included."""
    raw = texts.data.tobytes()
    if not any(s.encode() in raw for s in built.special):
        return built.encode(texts)
    parts: list[np.ndarray] = []
    for a, b in zip(texts.offsets.tolist(), texts.offsets[1:].tolist()):
        own = built.library.encode(raw[a:b].decode("utf-8"), add_special_tokens=False).ids
        parts.append(np.array(own, dtype=np.uint32))
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
