"""Signatures, edited texts and classes against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from sedgemill.llm import spotsigs
from sedgemill.llm.textkit import texts_of
from tests.llm.conftest import sentence

WORD = re.compile("(?:[0-9a-z]|[^\x00-\x7f])+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_signatures(text, anchors):
    words = plain_words(text)
    found = set()
    for i, w in enumerate(words):
        rest = [x for x in words[i + 1:] if x not in anchors][:spotsigs.CHAIN]
        if w in anchors and len(rest) == spotsigs.CHAIN:
            found.add((w, *rest))
    return found or ({text} if text else set())


def plain_anchors(rows, n):
    counts = collections.Counter(w for _, t in rows for w in set(plain_words(t)))
    return {w for w, _ in counts.most_common(n)}, sorted(counts.values(), reverse=True)


def _likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _unique(rows):
    return [(n, t) for n, (_, t) in enumerate(rows)] + [(None, "no id at all, the one and only")]


def _hashes(words):
    return np.sort(spotsigs._words(texts_of(pa.array(sorted(words))))[1])


def test_every_text_is_compared_with_its_edited_and_the_next(spark, frame, corpus):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    rows = _unique(corpus)
    anchors = {"an", "on", "re", "that", "the", "la", "ha"}
    got = {r.doc_id: r for r in spotsigs.compare_with_next(frame(rows), anchors=_hashes(anchors)).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    marks = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        n = len(text)
        edited = text[:n - n // 2] + after[:n // 2]
        own = plain_signatures(text, anchors)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - _likeness(own, plain_signatures(edited, anchors))) < 1e-12
        assert abs(r.near_next - _likeness(own, plain_signatures(after, anchors))) < 1e-12
        for name, sigs in ((r.fingerprint, own), (r.edited_fingerprint, plain_signatures(edited, anchors))):
            assert marks.setdefault(name, sigs) == sigs
    assert len(set(map(frozenset, marks.values()))) == len(marks)


def test_common_words_are_those_of_most_documents(frame, corpus):
    rows = _unique(corpus)
    found = spotsigs.common_words(frame(rows), most=10)
    _, counts = plain_anchors(rows, 10)
    by_hash = {int(_hashes({w})[0]): n for w, n in collections.Counter(w for _, t in rows for w in set(plain_words(t))).items()}
    assert sorted((by_hash[int(h)] for h in found), reverse=True) == counts[:10]


def test_order_of_equal_ids_and_small_tables(spark, frame):
    rows = [(1, "b"), (1, "b"), (1, "a"), (None, "c"), (2, "d" * 9)]
    got = spotsigs.compare_with_next(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == [("1", 1), ("1", 1), ("1", 1), ("2", 9), ("None", 1)]
    assert [r.edited_sha256 for r in got if r.doc_id == 2] == [hashlib.sha256(b"dddddc").hexdigest()]
    one = spotsigs.compare_with_next(frame([(5, "ab\U0001f600d")])).collect()
    assert [(r.n_chars, r.near_edited, r.edited_sha256) for r in one] == [(4, 0.0, hashlib.sha256("ab\U0001f600"[:2].encode() + b"ab").hexdigest())]
    assert spotsigs.compare_with_next(frame([])).collect() == []


def test_classes_are_those_of_all_similar_pairs(frame):
    rnd = random.Random(8)
    rows = []
    for i in range(12):
        base = plain_words(sentence(rnd, 120)) + ["an", "on"] * 5
        rnd.shuffle(base)
        for j in range(rnd.randint(1, 9)):
            rows.append((len(rows), " ".join(base)))
            for _ in range(rnd.randint(0, 3)):
                base[rnd.randrange(len(base))] = rnd.choice(["an", "on", "new", f"w{j}"])
    rows += [(500, None), (501, ""), (502, "..."), (503, "..."), (504, rows[0][1]), (None, rows[0][1])]
    anchors = {"an", "on", "ha", "re"}
    sets = [plain_signatures(t, anchors) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if _likeness(sets[i], sets[j]) >= 0.8:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {r: min(i for k, (i, _) in enumerate(rows) if root[k] == r and i is not None) for r in set(root)}
    want = sorted(((str(i), least[r]) for (i, _), r in zip(rows, root, strict=True)))
    assert len(set(root)) < len(rows) - 20
    got = spotsigs.near_duplicates(frame(rows), anchors=_hashes(anchors), tile=2).collect()
    assert sorted((str(r.doc_id), r.class_id) for r in got) == want
