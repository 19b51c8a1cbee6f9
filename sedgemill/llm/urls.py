"""URL filters: rules by host and path, and naive Bayes over words that a Viterbi path cuts host names into."""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import IS_LOWER
from sedgemill.llm.textkit import _table, range_hash, runs, slices, texts_of
from sedgemill.session import written

#: Words a task counts before it passes them on.
HELD_WORDS = 1 << 18
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
UPPER_LETTERS, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url) -> "F.Column":
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER_LETTERS, LOWER_LETTERS), F.lit(""))


def path_of(url) -> "F.Column":
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host, path, rules: list[tuple[str, str]]) -> tuple["F.Column", "F.Column"]:
    """Text and verdict of the longest rule that fits; null where none does. ``rules`` is a short list."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        text, verdict = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def word_counts(pages: DataFrame, html: str) -> DataFrame:
    """(word, n): lower-cased runs of Latin letters in all pages, counted in the tasks before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w for w, _ in held.values()], pa.string()),
                                              pa.array([n for _, n in held.values()], pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for part in slices(batch, html):
                texts = texts_of(part.column(0))
                data = LOWER[texts.data]
                start, end, _ = runs(IS_LOWER[data], texts.offsets)
                fits = end - start >= 2
                start, end = start[fits], end[fits]
                key, at, n = np.unique(range_hash(_table(17, 256)[data], start, end, 0x589965CC75374CC3), return_index=True, return_counts=True)
                raw = data.tobytes()
                for k, i, c in zip(key.tolist(), at.tolist(), n.tolist(), strict=True):
                    if k in held:
                        held[k][1] += c
                    else:
                        held[k] = [raw[start[i]:end[i]].decode(), c]
                if len(held) >= HELD_WORDS:
                    yield rows()
        yield rows()

    return pages.select(html).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def best_cut(name: str, known: list[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest words of a name: counts of ``known`` words (start, size, n), a tenth per letter for unknown ones.

    Words may have any length: of the unknown ones that end at a place only the best is carried on.
    """
    ends: dict[int, list[tuple[int, int]]] = {}
    for start, size, n in known:
        ends.setdefault(start + size, []).append((start, n))
    best, came, letter = [0.0], [0], log(10)
    open_, since = 0.0, -1
    for end in range(1, len(name) + 1):
        fresh = best[end - 1] - log(total) - letter
        if since < 0 or fresh >= open_ - letter:
            open_, since = fresh, end - 1
        else:
            open_ -= letter
        top = (open_, since)
        for start, n in ends.get(end, ()):
            top = max(top, (best[start] + log(n / total), start))
        best.append(top[0])
        came.append(top[1])
    words, end = [], len(name)
    while end:
        words.append(name[came[end]:end])
        end = came[end]
    return words[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct names: their parts of letters looked up in ``counts`` and cut by a Viterbi path.

    Parts are tried in the lengths that counted words have, which are few.
    """
    total = 1 + counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sizes = sorted(r[0] for r in counts.select(F.length("word")).distinct().collect()) or [1]
    tried = F.filter(F.lit(sizes), lambda size: size <= F.length("name"))
    spans = names.select("name", F.explode(tried).alias("size")).select(
        "name", "size", F.explode(F.sequence(F.lit(0), F.length("name") - F.col("size"))).alias("start"))
    spans = spans.withColumn("word", F.substring("name", F.col("start") + 1, F.col("size")))
    known = spans.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("start", "size", "n")).alias("known"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            words = [best_cut(r["name"], [(k["start"], k["size"], k["n"]) for k in r["known"] or ()], total) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return names.join(known, "name", "left").select("name", "known").mapInArrow(cut, "name string, words array<string>")


def _path_tokens(path) -> "F.Column":
    """Words of a path in lower case; a run of digits is one token whatever its digits."""
    lowered = F.translate(path, UPPER_LETTERS, LOWER_LETTERS)
    return F.regexp_extract_all(F.regexp_replace(lowered, "[0-9]+", "0"), F.lit(r"([^\x00-\x2F:-@\[-`{-\x7F]+|0)"), 1)


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) of distinct hosts: parts between dots, dashes and other signs, each cut into words."""
    parts = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("([a-z]+|[^a-z.]+)"), 1)).alias("pos", "name"))
    parts = parts.where(F.regexp_like("name", F.lit("[a-z0-9]")) | (F.length("name") > 1))
    names = parts.select("name").distinct()
    words = parts.join(segmented(names, counts), "name")
    listed = words.groupBy("host").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "words"))), lambda x: x["words"])).alias("words"))
    return hosts.join(listed, "host", "left").select("host", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url", html: str = "html",
    bad_words: tuple[str, ...] = (), smooth: float = 1.0, least: float = 0.9,
) -> DataFrame:
    """Verdict on every url: (page_id, host, path, rule, verdict, score, host_words).

    ``rules`` are (verdict, host/path) and win where one fits, the longest first. Elsewhere
    multinomial naive Bayes decides: ``score`` is the chance of block, from the words of the
    host and of the path, and a url is blocked from above ``least``. Rules are no sample of the
    urls, so their shares are not taken for a prior: that is even. Its examples are the urls that the rules decide; with ``bad_words``
    all others are examples too, of block where the host has one of them among its words. Names of
    hosts are cut into words by unigram counts of all pages' text. Words are counted by host
    and by path first, so a host with a third of all urls is one row; words and scores stay
    distributed.

    A null url, or one without ``://``, has an empty host and path, no tokens and a score of a
    half. Equal urls get equal rows; a score of exactly ``least`` allows. Without
    examples of both kinds everything that no rule decides is allowed. Null pages count no
    words. Words, hosts and paths may have any length. Other columns are not read.
    """
    split = pages.select(F.col(page_id).cast("long").alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    split = written(split.withColumns({"rule": rule, "ruled": verdict}), "url-parts")
    counts = written(word_counts(pages, html), "url-words")
    listed = F.arrays_overlap("words", F.array(*[F.lit(w.lower()) for w in bad_words]).cast("array<string>"))
    hosts = written(host_words(split.select("host").distinct(), counts).withColumn("listed", listed), "url-hosts")

    block = F.when(F.col("ruled").isNotNull(), F.col("ruled") == "block")
    block = block.otherwise(F.col("listed")) if bad_words else block
    kinds = split.join(hosts.select("host", "listed"), "host").withColumn("bad", block).where("bad IS NOT NULL")
    by_host = kinds.groupBy("host", "bad").agg(F.count("*").alias("n"))
    by_path = kinds.groupBy("path", "bad").agg(F.count("*").alias("n")).withColumn("words", _path_tokens(F.col("path")))
    tokens = lambda df, side: df.select(F.explode(F.transform("words", lambda w: F.concat(F.lit(side), w))).alias("token"), "bad", "n")
    counted = tokens(by_host.join(hosts.select("host", "words"), "host"), "h:").unionByName(tokens(by_path, "p:"))
    model = written(counted.groupBy("token").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("block"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("allow")), "url-model")
    size, block, allow = (x or 0 for x in model.agg(F.count("*"), F.sum("block"), F.sum("allow")).first())
    urls = {r[0]: r[1] for r in by_host.groupBy("bad").agg(F.sum("n")).collect()}
    if not urls.get(True) or not urls.get(False):
        weight = F.lit(0.0)
    else:
        weight = F.log((F.col("block") + smooth) / F.lit(block + smooth * size)) - F.log(
            (F.col("allow") + smooth) / F.lit(allow + smooth * size))
    weights = model.select("token", weight.alias("w"))

    def scored(df: DataFrame, key: str, side: str) -> DataFrame:
        one = df.select(key, F.explode(F.transform("words", lambda w: F.concat(F.lit(side), w))).alias("token"))
        return df.select(key).join(one.join(weights, "token").groupBy(key).agg(F.sum("w").alias(f"{key}_score")), key, "left")

    paths = split.select("path").distinct().withColumn("words", _path_tokens(F.col("path")))
    margin = F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    out = split.join(scored(hosts, "host", "h:"), "host").join(scored(paths, "path", "p:"), "path")
    out = out.join(hosts.select("host", F.array_join("words", " ").alias("host_words")), "host")
    out = out.withColumn("score", 1 / (1 + F.exp(-F.least(F.greatest(margin, F.lit(-500.0)), F.lit(500.0)))))
    method = F.when(F.col("score") > least, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "score", "host_words")
