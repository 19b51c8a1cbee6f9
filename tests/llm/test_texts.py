"""Token counts, packing, quality rules, classifier, languages, templates and urls against plain versions."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sedgemill.llm import boosting, docstats, language, packing, repetition, templates, transducer, urls
from sedgemill.llm.cutting_stock import patterns
from sedgemill.llm.queries import LLM_PLANS, LLM_SQL
from sedgemill.llm.textkit import Texts
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["don't we'll they've I'm he'd 'sh ''s !'s", "İstanbul ΣΑΣ straße ǅ", "a1b22 333 ½ ²", "日本語 한국어", "x  y\u3000z", "<|endoftext|> a<|startoftext|>b",
       "’s don’t", "ab'" * 20, "'", "s'", "'re've", "'r e", "\n\n \n x", "   x", "tab\tx \t y", "!" * 300]


def test_token_counts_are_the_librarys(frame, corpus):
    path = public_tokenizers.path("word_bpe_49k.json")
    rnd = random.Random(2)
    rows = corpus + [(1000 + i, t) for i, t in enumerate(ODD)]
    rows += [(2000 + i, "".join(rnd.choice("abstrelmd'' .,!?19é\n") for _ in range(rnd.randint(0, 80)))) for i in range(300)]
    lib = Tokenizer.from_file(path)
    want = sorted(((i, len((t or "").encode()), n, n > 2048) for i, t in rows
                   for n in [len(lib.encode(t or "", add_special_tokens=False).ids)]), key=str)
    got = transducer.token_counts(frame(rows), path).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_unbroken_runs_are_cut_inside_pieces(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = ["a" * 100_000, "ab" * 999, "abc" * 5000 + " x", "".join(rnd.choices(letters, k=6_000)), "ñ" * 1000 + " é", "", " ",
            "".join(rnd.choices("ab", k=5000)), "1" * 3000, "!" * 3001, "the quick brown fox " * 500,
            "".join(rnd.choice("abstrelmd'' .,!?19é\n") for _ in range(9_000))]
    lib = Tokenizer.from_file(path)
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in rows]
    raw = [t.encode() for t in rows]
    texts = Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert transducer.token_numbers(transducer.Machine(path), texts).tolist() == want
    monkeypatch.setattr(transducer, "CHUNK_BYTES", 7)
    assert transducer.token_numbers(transducer.Machine(path), texts).tolist() == want
    # Tables too small for the whole, then for one chunk.
    for states, chunk in ((4096, 64), (100, 256)):
        monkeypatch.setattr(transducer, "MOST_STATES", states)
        monkeypatch.setattr(transducer, "CHUNK_BYTES", chunk)
        assert transducer.token_numbers(transducer.Machine(path), texts).tolist() == want


def test_packing_covers_every_id_once(frame, corpus):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(n, t) for n, (_, t) in enumerate(corpus + [(0, t) for t in ODD])]
    lib = Tokenizer.from_file(path)
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    got = packing.pack(frame(rows), path, with_ids=True).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids == own and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        total = r.sequence_tokens
        assert total <= 2048 and r.padded_tokens == (total if total & (total - 1) == 0 else 2048)
    for listed, totals in ((pieces, {i: len(x) for i, x in ids.items()}), (sequences, None)):
        for key, spans in listed.items():
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert totals is None or at == totals[key]
    assert len(pieces) == len(rows)


@pytest.mark.parametrize("capacity", [511, 64, 5, 4])
def test_packing_into_sequences_of_any_capacity(frame, corpus, capacity):
    got = packing.pack(frame(corpus[:20]), public_tokenizers.path("byte_bpe_50k.json"), capacity=capacity, block=64).collect()
    filled = collections.defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    starts = collections.Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0)
    assert sum(r.length for r in got) == sum(n * t for (_, t), n in starts.items())
    with pytest.raises(ValueError, match="sequences of 3"):
        packing.pack(frame(corpus[:2]), public_tokenizers.path("byte_bpe_50k.json"), capacity=3)


def test_packing_of_repeated_and_missing_ids(frame):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(frame([(1, "same"), (1, "same"), (None, "x"), (2, None)]), path).collect()
    assert sorted(((r.doc_id, r.start) for r in got), key=str) == sorted([(1, 0), (1, 0), (None, 0), (2, 0)], key=str)
    assert packing.pack(frame([]), path).count() == 0


@pytest.mark.parametrize("n", [1, 40, 5000])
def test_patterns_hold_exactly_the_pieces(n):
    sizes = np.random.RandomState(n).randint(1, 65, n)
    histogram = dict(zip(*[x.tolist() for x in np.unique(sizes, return_counts=True)]))
    held = collections.Counter()
    used = 0
    for pattern, times in patterns(histogram, 128):
        assert sum(k * v for k, v in pattern.items()) <= 128 and times > 0
        used += times
        for k, v in pattern.items():
            held[k] += v * times
    assert held == histogram
    if n >= 5000:
        assert used <= 1.01 * sizes.sum() / 128 + 1


def plain_rules(text):
    """Counts and verdict of a text, by comparing all pairs of its words' places."""
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    reach = [0] * (len(words) + 1)
    for step in range(1, len(words)):  # runs of words that equal those ``step`` places on
        run = 0
        for k in range(len(words) - step - 1, -1, -1):
            run = run + 1 if words[k] == words[k + step] else 0
            reach[k], reach[k + step] = max(reach[k], run), max(reach[k + step], run)
    covered = {k + j for k, n in enumerate(reach) if n >= 4 for j in range(n)}
    n, longest = len(words), max(reach)
    failed = n < 50 or 100 * len(again) > 50 * n
    kept = not failed and 100 * len(covered) <= 30 * n and longest <= 100
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), len(covered), longest, failed, kept)


def limit_rows():
    """Texts that the base rules keep and one limit alone rejects, and near misses."""
    rnd = random.Random(12)
    word = iter(f"w{k}x" for k in range(10 ** 6))
    fresh = lambda k: [next(word) for _ in range(k)]
    rows = {}
    for name, (n, repeats, length) in {"covered": (200, 8, 8), "fine": (200, 3, 8), "long": (900, 1, 101), "almost_long": (900, 1, 100)}.items():
        words = fresh(n)
        for _ in range(repeats):
            part = fresh(length)
            words[rnd.randint(0, 5):0] = part
            words += part
        rows[name] = " ".join(words)
    return rows


def test_quality_rules_count_as_stated(frame, corpus):
    limits = limit_rows()
    rows = [(i, t) for i, t in corpus if len(t or "") < 20000] + [(700 + n, t) for n, t in enumerate(limits.values())]
    got = repetition.repetition_rules(frame(rows)).collect()
    want = [(i, *plain_rules(t)) for i, t in rows]
    columns = ["doc_id", *repetition.COLUMNS, "base_failed", "kept"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(want, key=str)
    verdict = {name: (not plain_rules(t)[-2], plain_rules(t)[-1]) for name, t in limits.items()}
    assert verdict == {"covered": (True, False), "fine": (True, True), "long": (True, False), "almost_long": (True, True)}


def test_quality_rules_as_sql(spark, frame, corpus, tmp_path):
    rows = [(n, t) for n, (_, t) in enumerate(corpus)] + [(700 + n, t) for n, t in enumerate(limit_rows().values())]
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = LLM_PLANS["op9_quality_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(LLM_SQL["op9_quality_rules"])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_suffix_repeats():
    rnd = random.Random(4)
    texts = [[rnd.randint(0, 4) for _ in range(rnd.randint(0, 40))] for _ in range(30)] + [[1] * 30, []]
    first = np.cumsum([0, *map(len, texts)])
    got = docstats.suffix_repeats(np.array([x for t in texts for x in t], dtype=np.uint64), first)
    for n, t in enumerate(texts):
        for i in range(len(t)):
            best = 0
            for j in range(len(t)):
                k = 0
                while j != i and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                    k += 1
                best = max(best, k)
            assert got[first[n] + i] == best


def quality_rows(n):
    rnd = random.Random(6)
    good = [(i, " ".join(sentence(rnd, 12) for _ in range(5))) for i in range(n)]
    bad = [(n + i, " ".join(rnd.choice(["###", "$$$", "|", "BUY!!", "x"]) for _ in range(60))) for i in range(n)]
    return good + bad


def test_classifier_on_held_out_rows(spark, frame):
    n = 150
    docs = frame(quality_rows(n) + [(9000, None), (9001, ""), (None, "x")])
    labels = spark.createDataFrame([(i, int(i < n), 0) for i in range(2 * n)] + [(5, 1, 0), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    forest = boosting.train(docs, labels)
    rows = boosting.quality_scores(docs, forest).collect()
    assert len(rows) == 2 * n + 3
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id < 2 * n]
    assert sum(r.predicted == int(r.doc_id < n) for r in held) >= 0.98 * len(held)


def test_classifier_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int")
    forest = boosting.train(frame([(1, "a b")]), none)
    assert [r.score for r in boosting.quality_scores(frame([(1, "a b"), (2, None)]), forest).collect()] == [0.5, 0.5]
    assert boosting.quality_scores(frame([]), forest).count() == 0


def test_flat_trees_are_the_trees():
    rnd = np.random.RandomState(0)
    x = rnd.rand(400, 5)
    forest = boosting.fit(x, (x[:, 0] + x[:, 1] > 1).astype(float), trees=10)
    for row, got in zip(x[:50], forest.score(x[:50])):
        margin = forest.prior
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            margin += leaf[node - len(f)]
        assert abs(1 / (1 + np.exp(-margin)) - got) < 1e-9


LANGS = {"en": "the of and to in is that it was for on are as with his they at be this from".split(),
         "es": "el la de que y en un ser se no haber por con su para como estar tener le lo".split(),
         "ru": "и в не на я быть он с что а по это она этот к но они мы весь который".split()}


def test_languages_and_spans(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(LANGS[k]) for _ in range(40)), k) for i, k in enumerate(sorted(LANGS) * 60)]
    mixed = " ".join(rnd.choice(LANGS["en"]) for _ in range(40)) + " " + " ".join(rnd.choice(LANGS["es"]) for _ in range(25))
    rows += [(900, mixed, None), (901, None, "en"), (902, "", "en"), (903, "12 34 !?", "en"), (None, "the of and", None), (905, "это что", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs, language.fit(docs)).collect()
    found = {r.doc_id: r for r in got}
    held = [(found[i], k) for i, _, k in rows[:180] if found[i].held_out]
    assert sum(r.lang_pred == k for r, k in held) >= 0.98 * len(held)
    assert [s.lang for s in found[900].spans] == ["en", "es"] and abs(found[900].spans[1].start - 40) <= 2
    assert [(found[i].lang_pred, found[i].score) for i in (901, 902, 903)] == [("und", 0.0)] * 3
    assert found[905].lang_pred == "ru" and found[None].lang_pred == "en"
    kept = {r.doc_id for r in language.keep_identified(docs, language.fit(docs)).collect()}
    assert kept == {r.doc_id for r in got if r.lang_pred != "und"}
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_best_path_is_best():
    rnd = np.random.RandomState(8)
    for n in (1, 2, 5, 7):
        scores = rnd.randn(n, 3)
        value = lambda p: sum(scores[i, s] for i, s in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
        paths = np.stack(np.meshgrid(*[range(3)] * n), -1).reshape(-1, n)
        got = language.best_path(scores, np.array([0, n]), 0.7)
        assert abs(max(map(value, paths)) - value(got)) < 1e-9


def test_leaks_exact_and_asked_again(spark, frame):
    rnd = random.Random(9)
    item = "A farmer has 12 cows and 30 sheep on a field of 5 km near Boston and sells 12 cows to Mary for 40 dollars each"
    again = item.replace("12", "17").replace("30", "8").replace("5 km", "9 miles").replace("Boston", "Denver")
    clash = item.replace("sells 12", "sells 99")
    fill = lambda: sentence(rnd, 40)
    docs = frame([(1, f"{fill()} {item}. {fill()}"), (2, f"{fill()}\n{again}\n{fill()}"), (3, fill()), (4, None), (5, ""),
                  (6, f"{fill()} {clash}. {fill()}"), (7, "short question here now"), (8, f"{fill()} {' '.join(item.split()[:7])} {fill()}")])
    bench = spark.createDataFrame([(10, item), (11, None), (12, "short question here now"), (13, "two words"), (14, fill())],
                                  "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in templates.contaminated(docs, bench).collect()}
    assert set(rows) == {(1, 10), (2, 10), (7, 12)}
    assert rows[1, 10].changed_slots == 0 and rows[2, 10].changed_slots > 0 and rows[2, 10].n_slots == rows[1, 10].n_slots
    kept = templates.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, 8}
    assert templates.contaminated(docs, bench.limit(0)).count() == 0 and templates.contaminated(frame([]), bench).count() == 0


def test_items_of_one_template_are_one_row(spark, frame):
    rnd = random.Random(10)
    ask = lambda a, b, name, c: f"A farmer near {name} has {a} cows and {b} sheep and then sells {c} cows to the dairy man"
    told = [ask(rnd.randint(10, 99), rnd.randint(100, 999), rnd.choice(["Boston", "Denver"]), None) for _ in range(40)]
    same = [t.replace("None", t.split(" has ")[1].split()[0]) for t in told]  # cows sold are the cows owned
    other = [t.replace("None", "7") for t in told]
    plain = ["what is the best way to cook an egg at home", "No 5", "5", None, "", "?!"]
    items = [(i, t) for i, t in enumerate(same[:20] + other[:20] + plain)] + [(0, same[0]), (20, same[25]), (None, same[3])]
    docs = [(i, f"{sentence(rnd, 12)}. So: {t}. {sentence(rnd, 9)}") for i, t in enumerate(same + other + plain[:1])]
    schema = "item_id long, text string"
    bench = spark.createDataFrame(items, schema)
    classes = {r.item_id: (r.class_item_id, r.n_items) for r in templates.template_classes(bench).collect()}
    assert classes[0] == classes[19] == (0, 21) and classes[None] == (0, 21)
    assert classes[20] == (20, 1) and classes[21] == classes[39] == (21, 19) and classes[43] == (43, 1) and len(classes) == 47
    got = templates.contaminated(frame(docs), bench).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    members = collections.defaultdict(list)
    for item, (head, _) in classes.items():
        members[head].append(item)
    held = {(r.doc_id, i) for r in got for i in members[r.item_id]}
    assert all(r.n_items == len(members[r.item_id]) for r in got)
    # Each item searched alone.
    for i in (0, 7, 19, 20, 21, 33, 40, 41, 43):
        alone = templates.contaminated(frame(docs), bench.where(F.col("item_id") == i)).collect()
        assert {r.doc_id for r in alone} == {d for d, item in held if item == i}, i


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_urls_rules_and_words(spark):
    bad = [f"http://{h}.example.org/en/{i}" for i in range(8) for h in ("spam-farm", "casino-win", "cheappills")]
    good = [f"https://{h}.example.org/en/{i}" for i in range(40) for h in ("garden", "book-shop")]
    odd = [None, "", "no scheme", "http://WWW.Example.com/en/X?a#b", "x://a.net/es/1", "ftp://com", "http://sub.example.com/en/#", "http://farmwin.example.org/en/1"]
    rows = [(i, u, "<p>cheap pills farm win casino garden book shop</p>" if i % 2 else None) for i, u in enumerate([*bad, *good, *odd])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in urls.judge(pages, RULES, bad_words=("spam", "casino", "pills", "win")).collect()}
    assert len(got) == len(rows)
    at = lambda u: got[next(i for i, x, _ in rows if x == u)]
    assert (at(None).host, at(None).path, at(None).rule) == ("", "", None) and at("no scheme").host == ""
    assert (at(odd[3]).host, at(odd[3]).path, at(odd[3]).rule, at(odd[3]).verdict) == ("www.example.com", "/en/X", "www.example.com/en/", "allow")
    assert at(odd[4]).verdict == "block" and at(odd[5]).rule is None and at(odd[6]).verdict == "block"
    assert at(bad[2]).host_words == "cheap pills example org" and at(odd[7]).host_words == "farm win example org"
    assert {got[i].verdict for i in range(len(bad))} == {"block"} and at(odd[7]).verdict == "block"
    assert {got[len(bad) + i].verdict for i in range(len(good))} == {"allow"}
    assert urls.judge(pages.limit(0), RULES).count() == 0


def plain_cut(name, counts, total):
    """The best of all ways to cut a name."""
    if not name:
        return 0.0, []
    ways = []
    for i in range(1, len(name) + 1):
        word = name[:i]
        cost = math.log(counts[word] / total) if len(word) > 1 and word in counts else -math.log(total) - i * math.log(10)
        rest, words = plain_cut(name[i:], counts, total)
        ways.append((cost + rest, [word, *words]))
    return max(ways)


def test_names_are_cut_in_the_likeliest_way():
    rnd = random.Random(2)
    counts = collections.Counter({"ab": 9, "abc": 4, "ca": 30, "bca": 2, "aab": 5, "cc": 1, "c" * 40: 3})
    total = sum(counts.values())
    for _ in range(150):
        name = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 11)))
        known = [(i, len(w), n) for w, n in counts.items() for i in range(len(name)) if name.startswith(w, i)]
        score, _ = plain_cut(name, counts, total)
        mine = sum(math.log(counts[w] / total) if len(w) > 1 and w in counts else -math.log(total) - len(w) * math.log(10)
                   for w in urls.best_cut(name, known, total))
        assert "".join(urls.best_cut(name, known, total)) == name and abs(mine - score) < 1e-9
    assert urls.best_cut("ab" + "c" * 40, [(0, 2, 9), (2, 40, 3)], total) == ["ab", "c" * 40]


def test_verdicts_are_those_of_plain_naive_bayes(spark):
    rnd = random.Random(7)
    kinds = ["good.example.com/en", "www.example.com/en", "a.example.net/es", "b.example.net/fr", "c.example.net/de", "d.example.org/fr", "e.example.org/en"]
    rows = [(i, f"http://{rnd.choice(kinds)}/{rnd.choice(['shop', 'news', 'a1'])}/{i % 9}", None) for i in range(200)]
    rows += [(900, None, None), (901, "x://" + "long" * 200 + ".example.org/" + "p/" * 3000, None), (902, rows[3][1], None)]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()}
    examples, seen = collections.Counter(), {True: collections.Counter(), False: collections.Counter()}
    words = {}
    for i, _, _ in rows:
        r = got[i]
        words[i] = [f"h:{w}" for w in r.host_words.split()] + [f"p:{w}" for w in re.findall(r"[a-z0]+", re.sub("[0-9]+", "0", r.path.lower()))]
        if r.rule:
            examples[r.verdict == "block"] += 1
            seen[r.verdict == "block"].update(words[i])
    vocabulary = set(seen[True]) | set(seen[False])
    total = {k: sum(c.values()) + len(vocabulary) for k, c in seen.items()}
    assert examples[True] and examples[False]
    for i, _, _ in rows:
        margin = sum(
            math.log((seen[True][w] + 1) / total[True]) - math.log((seen[False][w] + 1) / total[False]) for w in words[i] if w in vocabulary)
        assert abs(got[i].score - 1 / (1 + math.exp(-max(-500, min(500, margin))))) < 1e-9
        if got[i].rule is None:
            assert got[i].verdict == ("block" if got[i].score > 0.9 else "allow")
