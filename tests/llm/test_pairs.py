"""SimHash, substring dedup and line dedup against plain versions."""

import difflib
import hashlib
import random
import re
import types

import numpy as np
import pytest
import xxhash

from sedgemill.llm import components, lines, simhash, substrings
from sedgemill.llm.textkit import xxh64

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, radius):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    prints = [(i, fingerprint(t)) for i, t in rows]
    for i, (_, a) in enumerate(prints):
        for _, b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for i, fp in prints:
        if i is not None:
            least[find(fp)] = min(least.get(find(fp), i), i)
    return sorted(((i, fp, least.get(find(fp))) for i, fp in prints), key=str)


def test_xxh64_of_all_lengths():
    data = np.random.RandomState(0).bytes(200)
    for n in range(len(data)):
        assert xxh64(np.frombuffer(data, np.uint8), np.array([0]), np.array([n]))[0] == xxhash.xxh64_intdigest(data[:n], 42)


@pytest.mark.parametrize("tile", [4096, 16])
def test_simhash_classes(frame, corpus, tile):
    got = simhash.near_duplicates(frame(corpus), tile=tile).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == classes(corpus, 3)


def test_tiles_find_every_link():
    rnd = np.random.RandomState(1)
    base = rnd.randint(0, 1 << 62, 300).astype(np.uint64)
    near = base ^ (np.uint64(1) << rnd.randint(0, 60, 300).astype(np.uint64)) ^ (np.uint64(1) << rnd.randint(0, 60, 300).astype(np.uint64))
    values = np.unique(np.concatenate([base, near]))
    u, v = simhash.tile_links(values, values, 3, True)
    root = {int(x): int(x) for x in values} | dict(zip(u.tolist(), v.tolist()))
    for i, a in enumerate(values):
        for b in values[i + 1:][np.bitwise_count(values[i + 1:] ^ a) <= 3]:
            assert root[int(a)] == root[int(b)]


def test_one_of_each_class_stays(frame, corpus):
    docs = frame(corpus)
    kept = simhash.keep_first_of_class(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    rows = kept.collect()
    named = {c for _, _, c in classes(corpus, 3)}
    assert {r.doc_id for r in rows} == named and len(rows) == len(named)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    roots = {r.node: r.root for r in components.star_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert roots == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 140)}


def removed(rows, width):
    seen, out = {}, []
    order = sorted({(i is None, i or 0, t) for i, t in rows}, key=lambda r: (r[0], r[1]))
    first = {}
    for none, i, t in order:
        words = WORD.findall(t or "")
        for k in range(len(words) - width + 1):
            at = (none, i, k)
            w = tuple(words[k:k + width])
            first[w] = min(first.get(w, at), at)
    for none, i, t in order:
        words = WORD.findall(t or "")
        gone = set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k:k + width])] < (none, i, k):
                gone.update(range(k, k + width))
        seen[None if none else i, t] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    out = [(i, *seen[i, t]) for i, t in rows]
    return sorted(out, key=str)


@pytest.mark.parametrize("width,block", [(20, 10), (6, 3)])
def test_repeats_are_removed(frame, corpus, width, block):
    got = substrings.remove_repeats(frame(corpus), width=width, block=block).collect()
    assert sorted(map(tuple, got), key=str) == removed(corpus, width)
    assert hashlib.sha256(b"").hexdigest() != ""


@pytest.mark.parametrize("with_ids", [False, True])
def test_rows_of_a_unit_do_not_repeat_its_documents(monkeypatch, with_ids):
    """The bytes a word costs stay the same from 20 to 20,000 buckets."""
    monkeypatch.setattr(substrings.TaskContext, "get", staticmethod(lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    rnd = np.random.default_rng(1)
    cost = []
    for buckets in (20, 200, 2000, 20000):
        unit = substrings._Unit(buckets, 8 if with_ids else 3, with_ids)
        while not unit.full:
            sizes = rnd.integers(50, 600, 200)
            n = int(sizes.sum())
            ids = np.arange(200, dtype=np.int64) + 10 ** 6
            unit.add(ids, rnd.integers(0, 2 ** 62, 200), sizes, np.arange(n), rnd.integers(0, buckets, n).astype(np.int32),
                     rnd.integers(0, 2 ** 62, n).astype(np.uint64), np.zeros((n, 2), bool))
        words = unit.words
        rows = unit.rows()
        cost.append(rows.nbytes / words)
        assert rows.num_rows <= buckets + 1
    assert max(cost) <= 1.6 * min(cost)


def test_patience_blocks_are_common_and_rise():
    rnd = random.Random(3)
    for _ in range(300):
        a = [rnd.randint(0, 12) for _ in range(rnd.randint(0, 25))]
        b = [rnd.randint(0, 12) for _ in range(rnd.randint(0, 25))]
        blocks = lines.patience_blocks(a, b)
        x = y = 0
        for i, j, n in blocks:
            assert n > 0 and i >= x and j >= y and a[i:i + n] == b[j:j + n]
            x, y = i + n, j + n
    a, b = list(range(50)), [*range(10), 99, *range(15, 50)]
    assert lines.patience_blocks(a, b) == [tuple(m) for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks()][:-1]


def plain_blocks(rows, least_words=4):
    docs = sorted({(i, t) for i, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0))
    ids = [i for i, _ in docs]
    cut = [t.split("\n") for _, t in docs]
    first = {}
    for n, ls in enumerate(cut):
        for line in ls:
            if WORD.search(line):
                first.setdefault(line, n)
    out = set()
    for n, ls in enumerate(cut):
        for m in {first[line] for line in ls if WORD.search(line)} - {n}:
            for i, j, size in lines.patience_blocks(cut[m], ls):
                words = sum(len(WORD.findall(x)) for x in ls[j:j + size])
                if words >= least_words:
                    out.add((ids[n], j, size, words, ids[m], i))
    return out


def test_common_blocks(frame, corpus):
    got = lines.common_blocks(frame(corpus)).drop("key").collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == plain_blocks(corpus)


def test_common_lines_leave_the_later_document(frame):
    rows = [(1, "one two three four\nfive six seven eight\nnine"), (2, "zero\none two three four\nfive six seven eight\nlast"),
            (3, "one two three four\nfive six seven eight\nnine"), (4, None), (5, ""), (6, "alone here")]
    docs = frame(rows)
    left = lines.without_common_blocks(docs, lines.common_blocks(docs))
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: rows[0][1], 2: "zero\nlast", 4: None, 5: "", 6: "alone here"}


def test_empty_tables(frame):
    none = frame([])
    assert simhash.near_duplicates(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert lines.common_blocks(none).count() == 0
