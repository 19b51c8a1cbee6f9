"""Token counts by a tokenizer compiled into a finite-state transducer.

The library's byte-pair encoding of a piece (a word, a digit, a run of signs) is replaced by a
deterministic machine over bytes whose transitions carry the change of the token count.
Encodings have two properties it rests on: leaving out the last token of an encoding gives
the encoding of the shorter string, and a sequence is an encoding exactly if each two
neighbours are one. So the last token of every prefix, found from the last tokens of shorter
prefixes, is all a state needs; states are made when first reached and kept for the process.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import IS_DIGIT
from sedgemill.llm.textkit import Texts, map_texts, process_store

#: States and symbols for which the tables have room; beyond them the machine is compiled anew.
MOST_STATES, SYMBOLS = 1 << 17, 160
#: Last tokens are compared by what they allow only below nodes with at most so many tokens below.
COMPARED_TOKENS = 16
#: Bytes of a chunk.
CHUNK_BYTES = 256
SPACE_CLASS, LETTER, DIGIT, SIGN = range(4)
# The pieces that the pattern of this tokenizer cuts after an apostrophe.
SHORT_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files of byte-level tokenizers."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Full(Exception):
    """A slice needs more states or symbols than the tables hold."""


class Machine:
    """Transitions over bytes (a piece's last byte is a symbol of its own) with count changes, compiled on demand.

    A state lists the places of the piece where a token may begin that is not complete yet: the
    node of the vocabulary's tree reached from there, the last token before the place, and how
    many tokens the encoding up to there has more than the whole prefix. Places where no token
    can still follow are left out, and last tokens that allow the same tokens below a node count
    as one, which keeps the states few.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        simple = sorted({x for m in merges for x in m if x not in made} | {t for t in model["vocab"] if t not in made})
        # Tokens are numbered by rank: simple ones first, then as the merges make them.
        self.id = {t: i for i, t in enumerate(simple)}
        self.left = [-1] * (len(simple) + len(merges))
        self.right, self.merge = [-1] * len(self.left), {}
        for rank, (a, b) in enumerate(merges):
            number = self.id.setdefault(a + b, len(simple) + rank)
            self.merge[self.id[a] << 20 | self.id[b]] = number
            if self.left[number] < 0:
                self.left[number], self.right[number] = self.id[a], self.id[b]
        self.children: list[dict[int, int]] = [{}]
        self.token: list[list[int]] = [[-1, -1]]
        letters = _byte_letters()
        for name in model["vocab"]:
            closed = name.endswith(self.end)
            body = name[: -len(self.end)] if closed else name
            if not body or any(c not in letters for c in body):
                continue
            node = 0
            for c in body:
                node = self.children[node].setdefault(letters[c], len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token.append([-1, -1])
            self.token[node][closed] = self.id[name]
        self.tokens_below: dict[int, list[int]] = {}
        self.classes = np.full(0x110000, -1, dtype=np.int8)
        self.clear()

    def clear(self) -> None:
        start = ((0, -1, 0),)
        self.states, self.number = [start], {start: 0}
        self.allowed: dict[tuple[int, int], int | None] = {}
        self.alike: dict[tuple[int, tuple[bool, ...]], int] = {}
        self.symbol = np.full(512, -1, dtype=np.int64)
        self.symbols: list[int] = []
        self.next = np.full(MOST_STATES * SYMBOLS, -1, dtype=np.int32)
        self.change = np.zeros(MOST_STATES * SYMBOLS, dtype=np.int16)

    def neighbours(self, a: int, b: int) -> bool:
        """Can token ``b`` follow token ``a`` (-1: begin a piece) in an encoding?

        Undoes the merges that made the two, latest first; they are no neighbours if a merge
        across their border would have come before one that was undone.
        """
        left, right, merge = self.left, self.right, self.merge
        if a < 0:  # every token is the encoding of its own bytes
            return True
        limit = 1 << 40
        while True:
            across = merge.get(a << 20 | b)
            if across is not None and across < limit:
                return False
            if a > b:
                limit = a
                if right[a] >= 0:
                    a = right[a]
                    continue
                limit = b + 1
                if left[b] < 0:
                    return True
                b = left[b]
            else:
                limit = b + 1
                if left[b] >= 0:
                    b = left[b]
                    continue
                limit = a
                if right[a] < 0:
                    return True
                a = right[a]

    def stands_for(self, node: int, last: int) -> int | None:
        """A last token that allows the same tokens below ``node`` as ``last`` does; None if it is seen to allow none."""
        key = (node, last)
        if key not in self.allowed:
            below = self.tokens_below.get(node)
            if below is None:
                below, open_ = [], list(self.children[node].values())
                while open_:
                    at = open_.pop()
                    below += [t for t in self.token[at] if t >= 0]
                    open_ += self.children[at].values()
                self.tokens_below[node] = below
            if len(below) > COMPARED_TOKENS:
                found = last
            else:
                allows = tuple([self.neighbours(last, t) for t in below])
                found = self.alike.setdefault((node, allows), last) if any(allows) else None
            self.allowed[key] = found
        return self.allowed[key]

    def step(self, state: int, code: int) -> tuple[int, int]:
        """Next state and change of the token count for a byte, or for a piece's last byte (256 more)."""
        closed, byte = divmod(code, 256)
        live, found, change = [], -1, 0
        for node, last, ahead in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token[child][closed]
            if found < 0 <= token and self.neighbours(last, token):
                found, change = token, ahead + 1
            if not closed and self.children[child]:
                live.append((child, last, ahead))
        if found < 0:
            raise ValueError(f"no token ends in byte {byte}")
        if closed:
            return 0, change
        kept = ((n, self.stands_for(n, last), a - change) for n, last, a in live)
        target = (*(x for x in kept if x[1] is not None), (0, found, 0))
        number = self.number.get(target)
        if number is None:
            number = self.number[target] = len(self.states)
            self.states.append(target)
        return number, change

    def count(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Tokens that begin to count in each chunk ``codes[first[i]:first[i + 1]]``; chunks are cut anywhere.

        Chunks that need more states than the tables hold are counted in parts, each entered
        with the state the part before it left.
        """
        entry, counted, parts = self.states[0], [], [(0, len(first) - 1)]
        while parts:
            low, high = parts.pop()
            fresh = len(self.states) == 1
            try:
                totals, entry = self._count(codes, first[low:high + 1], entry)
                counted.append(totals)
            except _Full:
                self.clear()
                if not fresh:
                    parts.append((low, high))
                elif high - low > 1:
                    size = min((high - low + 1) // 2, max(1, MOST_STATES // 4 // CHUNK_BYTES))
                    cuts = [*range(low, high, size), high]
                    parts += list(zip(cuts, cuts[1:]))[::-1]
                else:
                    total, entry = self._alone(codes[first[low]:first[high]].tolist(), entry)
                    counted.append(np.array([total]))
        return np.concatenate(counted)

    def _alone(self, codes: list[int], entry: tuple) -> tuple[int, tuple]:
        total = 0
        for code in codes:
            if len(self.states) >= MOST_STATES:
                self.clear()
            state, change = self.step(self._entered(entry), code)
            entry = self.states[state]
            total += change
        return total, entry

    def _entered(self, state: tuple) -> int:
        """The number of a state, which the tables may have lost."""
        number = self.number.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number

    def _run(self, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and change of the count after ``codes[begin[i]:end[i]]``, entered in state ``entry[i]``."""
        order = np.argsort(begin - end, kind="stable")
        begin, size, state = begin[order], (end - begin)[order], entry[order]
        total = np.zeros(len(size), dtype=np.int64)
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")
        for t in range(longest):
            m = active[t]
            at = state[:m] * SYMBOLS + self.symbol[codes[begin[:m] + t]]
            into = self.next[at]
            if into.min() < 0:
                for cell in np.unique(at[into < 0]).tolist():
                    self.next[cell], self.change[cell] = self.step(cell // SYMBOLS, self.symbols[cell % SYMBOLS])
                    if len(self.states) >= MOST_STATES:
                        raise _Full
                into = self.next[at]
            total[:m] += self.change[at]
            state[:m] = into
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def _count(self, codes: np.ndarray, first: np.ndarray, entry: tuple) -> tuple[np.ndarray, tuple]:
        """Tokens of each chunk and the state after the last one.

        A chunk's map gives, for each state that may enter it, the state that leaves it and the
        change of the count. Behind its first end of a piece the state does not depend on the
        entry, so that part is run once; the part before is run from the states that leave the
        chunk before, the start state standing in where those are not known yet, until no chunk
        is left with an entry it has not been run from. Maps compose by doubling.
        """
        for code in np.unique(codes[first[0]:first[-1]]).tolist():
            if self.symbol[code] < 0:
                if len(self.symbols) >= SYMBOLS:
                    raise _Full
                self.symbol[code] = len(self.symbols)
                self.symbols.append(code)
        begin, end, n = first[:-1], first[1:], len(first) - 1
        closed = np.append(np.flatnonzero(codes[first[0]:first[-1]] >= 256) + first[0], first[-1])
        head = np.minimum(closed[np.searchsorted(closed, begin)] + 1, end)
        constant = codes[head - 1] >= 256
        leaves, tail = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        leaves[constant], tail[constant] = self._run(
            codes, head[constant], end[constant], np.zeros(constant.sum(), dtype=np.int64))

        known, into, change = (np.zeros(0, dtype=np.int64) for _ in range(3))
        wanted = np.arange(n) * MOST_STATES + np.concatenate([[self._entered(entry)], leaves[:-1]])
        while len(wanted):
            chunk, state = np.divmod(wanted, MOST_STATES)
            state, counted = self._run(codes, begin[chunk], head[chunk], state)
            state = np.where(constant[chunk], leaves[chunk], state)
            known, into = np.concatenate([known, wanted]), np.concatenate([into, state])
            change = np.concatenate([change, counted + tail[chunk]])
            follows = (wanted // MOST_STATES + 1) * MOST_STATES + state
            wanted = np.setdiff1d(follows[chunk < n - 1], known)

        order = np.argsort(known)
        known, into, change = known[order], into[order], change[order]
        chunk = known // MOST_STATES
        last = chunk == n - 1
        # An entry of a map points to the entry of the next chunk's map that it leads to.
        jump = np.where(last, np.arange(len(known)), np.searchsorted(known, (chunk + 1) * MOST_STATES + into) % len(known))
        path = np.zeros(1, dtype=np.int64)
        while len(path) < n:
            path = np.concatenate([path, jump[path]])[:n]
            jump = jump[jump]
        return change[path], self.states[into[path[-1]]]

    def class_of(self, codes: np.ndarray) -> np.ndarray:
        """Space, letter, digit or sign of code points, asked of the library's own pattern once for each."""
        for c in np.unique(codes[self.classes[codes] < 0]).tolist():
            pieces = self.library.pre_tokenizer.pre_tokenize_str(f"a{chr(c)}a")
            spans = [b - a for _, (a, b) in pieces]
            self.classes[c] = LETTER if spans == [3] else SPACE_CLASS if len(spans) == 2 else (
                DIGIT if len(self.library.pre_tokenizer.pre_tokenize_str(chr(c) * 2)) == 2 else SIGN)
        return self.classes[codes]


def machine(path: str) -> Machine:
    """The machine of this process for a tokenizer file; tasks that follow each other share it."""
    kept = process_store("machines")
    if path not in kept:
        kept[path] = Machine(path)
    return kept[path]


def normal(data: bytes) -> bytes:
    """Composed and in lower case; each capital sigma becomes the sigma used inside words."""
    text = data.decode("utf-8")
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower().encode("utf-8")


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def normalised(texts: Texts) -> Texts:
    if not (texts.data >= 0x80).any():
        return Texts(LOWER[texts.data], texts.offsets)
    raw, off = texts.data.tobytes(), texts.offsets.tolist()
    parts = [x.lower() if (x := raw[a:b]).isascii() else normal(x) for a, b in zip(off, off[1:])]
    return Texts(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))


_ASCII_CLASS = np.full(128, SIGN, dtype=np.int8)
_ASCII_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE_CLASS
_ASCII_CLASS[IS_DIGIT[:128]] = DIGIT
_ASCII_CLASS[97:123] = LETTER
_ASCII_CLASS[65:91] = LETTER


def byte_classes(built: Machine, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of the sign each byte belongs to, and whether the byte begins a sign."""
    begins = (data & 0xC0) != 0x80
    high = data >= 0x80
    classes = np.where(high, 0, _ASCII_CLASS[data & 0x7F]).astype(np.int8)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int64)
        more = lambda i: data[np.minimum(lead + i, len(data) - 1)].astype(np.int64) & 0x3F
        code = np.where(first < 0xE0, (first & 0x1F) << 6 | more(1), np.where(
            first < 0xF0, (first & 0xF) << 12 | more(1) << 6 | more(2),
            (first & 0x7) << 18 | more(1) << 12 | more(2) << 6 | more(3)))
        kind = built.class_of(code)
        width = np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4))
        for i in range(4):
            inside = width > i
            classes[lead[inside] + i] = kind[inside]
    return classes, begins


def piece_starts(texts: Texts, classes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the tokenizer's pattern begins a piece."""
    data, n = texts.data, len(texts.data)
    opens = np.zeros(n + 1, dtype=bool)
    opens[texts.offsets] = True
    changed = np.ones(n, dtype=bool)
    changed[1:] = classes[1:] != classes[:-1]
    changed |= opens[:-1]
    starts = (changed | ((classes == DIGIT) & begins)) & (classes != SPACE_CLASS)
    quote = np.flatnonzero((data == 0x27) & changed)
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
        starts[after[classes[after] != SPACE_CLASS]] = True
    return starts


def token_numbers(built: Machine, texts: Texts) -> np.ndarray:
    """Tokens of each text, which holds no special strings."""
    texts = normalised(texts)
    n = len(texts)
    classes, begins = byte_classes(built, texts.data)
    starts = piece_starts(texts, classes, begins)
    solid = np.flatnonzero(classes != SPACE_CLASS)
    if not len(solid):
        return np.zeros(n, dtype=np.int64)
    first = starts[solid]
    codes = texts.data[solid].astype(np.int64)
    last = np.ones(len(solid), dtype=bool)
    last[:-1] = first[1:]
    codes[last] += 256
    edges = np.searchsorted(solid, texts.offsets)
    # Chunks end at fixed bytes, inside pieces and characters too, and where texts end.
    cuts = np.unique(np.concatenate([np.arange(0, len(solid), CHUNK_BYTES), edges[:-1][np.diff(edges) > 0]]))
    counted = built.count(codes, np.append(cuts, len(solid)))
    doc = np.searchsorted(edges, cuts, side="right") - 1
    return np.bincount(doc, counted, n).astype(np.int64)


def _split_special(built: Machine, texts: Texts) -> tuple[Texts, np.ndarray, np.ndarray]:
    """Parts of texts between special strings, the text each is of, and the special strings of each text."""
    raw, extra = texts.data.tobytes(), np.zeros(len(texts), dtype=np.int64)
    names = [s.encode() for s in built.special]
    if not any(s in raw for s in names):
        return texts, np.arange(len(texts)), extra
    parts, owner = [], []
    for i, (a, b) in enumerate(zip(texts.offsets.tolist(), texts.offsets[1:].tolist())):
        own = [raw[a:b]]
        for s in names:
            own = [y for x in own for y in x.split(s)]
        parts += own
        owner += [i] * len(own)
        extra[i] = len(own) - 1
    return Texts(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])), np.array(owner), extra


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the tokenizer file at ``path`` counts whole texts.

    Made for files whose model is byte-pair encoding with word ends over NFC lower-case text.
    The file's special strings inside a text are one token each. No begin or end tokens are
    counted. Null and empty texts have 0 bytes and tokens; a text without any space is cut into
    chunks like others. Every row is counted alone;
    repeated rows, null ids and other columns make no difference. Executors read the file at
    the same path.
    """

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        built = machine(path)
        parts, owner, extra = _split_special(built, texts)
        tokens = np.bincount(owner, token_numbers(built, parts), len(texts)).astype(np.int64) + extra
        size = np.diff(texts.offsets)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return map_texts(rows, "_text", "doc_id long, n_bytes long, n_tokens long, over_limit boolean", work)
