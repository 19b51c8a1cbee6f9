"""SpotSigs: chains of content words behind common words sign a text; sets of signatures are compared by Jaccard.

A spot is an occurrence of a common word; its signature is that word with the next ``chain``
words that are not common. Boilerplate (lists, menus, figures) has few spots, prose has many.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.components import star_components
from sedgemill.llm.textkit import Texts, U64, Words, _table, map_texts, mix, range_hash, runs, slices, texts_of, word_hashes
from sedgemill.session import written

#: Common words that start a chain, and content words in it.
ANCHORS, CHAIN = 100, 2
#: Buckets of the histogram by which signatures are ordered, and sets compared in one task at once.
HEAT, TILE = 1 << 18, 512
#: Rows sampled for each partition when the order of documents is split.
SAMPLED = 100

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def _words(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words (runs of letters, digits and bytes beyond ASCII, A-Z lower-cased) and their hashes."""
    low = Texts(LOWER[texts.data], texts.offsets)
    words = Words(*runs(IS_WORD[low.data], low.offsets))
    return words, word_hashes(low, words, seed=5)


def common_words(docs: DataFrame, text: str = "text", most: int = ANCHORS) -> np.ndarray:
    """Hashes, sorted, of the ``most`` words that the most documents hold (equal counts: by hash)."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        words, hashes = _words(texts)
        doc = words.text_of_word()
        order = np.lexsort((doc, hashes))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        found, counts = np.unique(hashes[order][new], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "docs"])

    counted = map_texts(docs.select(F.col(text).alias("_text")), "_text", "word long, docs long", work)
    top = counted.groupBy("word").agg(F.sum("docs").alias("docs")).orderBy(F.desc("docs"), "word").limit(most).collect()
    return np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(U64))


def signatures(texts: Texts, anchors: np.ndarray, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Distinct signatures, rising, of each text; ``first[i]:first[i + 1]`` are those of text ``i``.

    A text without a complete chain is signed by all its bytes; an empty one has no signature.
    """
    words, hashes = _words(texts)
    common = np.isin(hashes, anchors)
    content = hashes[~common]
    stop = np.concatenate([[0], np.cumsum(~common)])[words.first]  # content words up to each text's end
    at = np.flatnonzero(common)
    doc = words.text_of_word()[at]
    next_ = np.cumsum(~common)[at]
    whole = next_ + chain <= stop[1:][doc]
    at, doc, next_ = at[whole], doc[whole], next_[whole]
    found = mix(range_hash(content, next_, next_ + chain, 0x9DDFEA08EB382D71) + hashes[at] * U64(0x9E3779B97F4A7C15))
    bare = np.setdiff1d(np.flatnonzero(np.diff(texts.offsets)), doc)
    if len(bare):
        all_ = range_hash(_table(7, 256)[texts.data], texts.offsets[:-1][bare], texts.offsets[1:][bare], 0x9DDFEA08EB382D73)
        found, doc = np.concatenate([found, all_]), np.concatenate([doc, bare])
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    return found[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def digests(found: np.ndarray, first: np.ndarray) -> list[str]:
    """Fingerprint of each set: 32 hex digits of the SHA-256 of its sorted signatures."""
    raw, at = found.astype("<u8").tobytes(), (8 * first).tolist()
    return [hashlib.sha256(raw[a:b]).hexdigest()[:32] for a, b in zip(at, at[1:], strict=False)]


def likeness(a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of set i of ``a`` and set i of ``b`` for every i; two empty sets are alike."""
    size_a, size_b = np.diff(first_a), np.diff(first_b)
    pair = np.concatenate([np.repeat(np.arange(len(size_a)), size_a), np.repeat(np.arange(len(size_b)), size_b)])
    value = np.concatenate([a, b])
    order = np.lexsort((value, pair))
    value, pair = value[order], pair[order]
    both = np.bincount(pair[1:][(value[1:] == value[:-1]) & (pair[1:] == pair[:-1])], minlength=len(size_a))
    either = size_a + size_b - both
    return np.where(either > 0, both / np.maximum(either, 1), 1.0)


def _ordered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (bucket, guest, doc_id, text) in partitions by ranges of the order of documents, sorted there.

    The order is by id (nulls first), then by the text's hash. Bounds come from a sample of
    keys. Behind the last row of a bucket stands a guest: the first row of the next one that
    has rows, or of the first bucket, so that every row has its successor beside it and each
    text is shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("*", F.struct(
        F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash")).alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = F.struct("key", F.monotonically_increasing_id().alias("place"))  # equal rows are dealt to several buckets
    sample = min(1.0, SAMPLED * parts / max(1, docs.count()))
    keys = rows.select(salted.alias("at")).sample(sample, seed=1).orderBy("at").collect()
    bounds = [keys[i * len(keys) // parts]["at"] for i in range(1, parts)] if len(keys) >= parts else [k["at"] for k in keys[1:]]
    bound = lambda b: F.struct(
        F.struct(F.lit(b["key"]["named"]).alias("named"), F.lit(b["key"]["id"]).cast("long").alias("id"),
                 F.lit(b["key"]["hash"]).cast("long").alias("hash")).alias("key"), F.lit(b["place"]).cast("long").alias("place"))
    below = F.size(F.filter(F.array(*map(bound, bounds)), lambda b: b <= salted)) if bounds else F.lit(0)
    rows = rows.withColumn("bucket", below)
    firsts = sorted(map(tuple, rows.groupBy("bucket").agg(F.min("key").alias("key")).collect()))
    follows = [(firsts[i - 1][0], key) for i, (_, key) in enumerate(firsts)]
    targets = spark.createDataFrame(follows, "target int, key struct<named:boolean,id:long,hash:long>")
    guests = rows.join(F.broadcast(targets), "key").dropDuplicates(["target"]).select(
        F.col("target").alias("bucket"), F.lit(1).alias("guest"), "doc_id", "text", "key")
    both = rows.select("bucket", F.lit(0).alias("guest"), "doc_id", "text", "key").unionByName(guests)
    dealt = both.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "guest", "key")
    return dealt.select("bucket", "guest", "doc_id", "text")


def compare_with_next(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchors: np.ndarray | None = None, chain: int = CHAIN,
) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they and the next document's are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. In the edited text the last ``floor(n_chars / 2)`` code points are replaced by
    the first as many (or all) of the next document's, by rising doc_id; after the last comes
    the first. ``near_edited`` and ``near_next`` are the Jaccard similarities of the text's
    signatures with those of the edited and of the next text. ``anchors`` are the common
    words, those of ``docs`` unless given.

    A null text is empty; empty texts have no signature and are alike. Rows without id come
    first, rows of one id follow by the hash of their texts, equal rows each follow another;
    a single row is its own successor. Other columns are not read; an empty table gives no
    rows. Whole texts are signed; each is shuffled once and passes a task as a stream.
    """
    anchors = common_words(docs, text) if anchors is None else anchors

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in slices(batch, "text"):
                rows = pa.Table.from_batches([part] if held is None else [held, part]).combine_chunks().to_batches()[0]
                held = rows.slice(rows.num_rows - 1)
                if rows.num_rows > 1:
                    yield _compared(rows, anchors, chain)

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return _ordered(docs, doc_id, text).mapInArrow(work, schema)


def _compared(rows: pa.RecordBatch, anchors: np.ndarray, chain: int) -> pa.RecordBatch:
    """Results for those rows that are followed by their successor."""
    said = rows.column("text").to_pylist()
    at = np.flatnonzero(rows.column("guest").to_numpy()[:-1] == 0)
    edited = [said[i][:len(said[i]) - len(said[i]) // 2] + said[i + 1][:len(said[i]) // 2] for i in at.tolist()]
    found, first = signatures(texts_of(rows.column("text")), anchors, chain)
    changed, changed_first = signatures(texts_of(pa.array(edited, pa.string())), anchors, chain)

    def of(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = first[i + 1] - first[i]
        ends = np.concatenate([[0], np.cumsum(size)])
        return found[np.arange(ends[-1]) + np.repeat(first[i] - ends[:-1], size)], ends

    own, names = of(at), digests(found, first)
    return pa.RecordBatch.from_arrays([
        rows.column("doc_id").take(pa.array(at)), pa.array([len(said[i]) for i in at.tolist()], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
        pa.array([names[i] for i in at.tolist()], pa.string()), pa.array(digests(changed, changed_first), pa.string()),
        pa.array(likeness(*own, changed, changed_first)), pa.array(likeness(*own, *of(at + 1)))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def signed(docs: DataFrame, anchors: np.ndarray, doc_id: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """(doc_id, fingerprint, sigs) of every row; ``sigs`` are the signatures as signed numbers."""

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        found, first = signatures(texts, anchors, chain)
        sigs = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(found.view(np.int64)))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(digests(found, first), pa.string()), sigs], ["doc_id", "fingerprint", "sigs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return map_texts(rows, "_text", "doc_id long, fingerprint string, sigs array<long>", work)


def length_part(size: int, similarity: float) -> int:
    """Sets whose Jaccard similarity reaches ``similarity`` lie in one such part or in neighbouring ones."""
    return math.floor(math.log(size) / -math.log(similarity) + 1e-9)


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(part, sig, fingerprint, own): the rarest signatures of each set, of which similar sets share one, in its part and the next.

    Rarity is the count of the signature's bucket in a histogram of fixed size over all sets,
    then the signature itself, so the order is one for all sets.
    """
    buckets = F.transform("sigs", lambda s: F.pmod(s, F.lit(HEAT)).cast("int"))
    heat = np.zeros(HEAT, dtype=np.int64)
    counts = sets.select(F.explode(buckets).alias("bucket")).groupBy("bucket").count().toPandas()
    heat[counts["bucket"].to_numpy()] = counts["count"].to_numpy()
    heat = np.minimum(heat, np.iinfo(np.int32).max).astype(np.int32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts, chosen = [], [], []
            for name, sigs in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sigs = sigs.values.to_numpy()
                least = max(1, math.ceil(similarity * len(sigs) - 1e-9))
                rare = sigs[np.lexsort((sigs, heat[sigs % HEAT]))][:len(sigs) - least + 1]
                names.append(np.repeat(name, len(rare)))
                parts.append(np.full(len(rare), length_part(len(sigs), similarity)))
                chosen.append(rare)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts).astype(np.int64)), pa.array(np.concatenate(chosen)), pa.array(np.concatenate(names).astype(object), pa.string())],
                    ["part", "sig", "fingerprint"])

    filled = sets.filter(F.size("sigs") > 0).select("fingerprint", "sigs")
    rows = filled.mapInArrow(work, "part long, sig long, fingerprint string")
    rows = rows.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1))))
    return rows.select((F.col("part") + F.col("step")).alias("part"), "sig", "fingerprint", (F.col("step") == 0).alias("own"))


def _alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets reach the similarity; sizes alone rule most pairs out."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (u, v) of fingerprints whose sets reach the similarity."""
    side = lambda name: sets.select(F.col("fingerprint").alias(name), F.col("sigs").alias(f"sigs_{name}"))
    both = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "sigs_u", "sigs_v")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_alike(a.values.to_numpy(), b.values.to_numpy(), similarity) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["u", "v"])

    return both.mapInArrow(work, "u string, v string")


def _mixed_links(groups: DataFrame, sets: DataFrame, similarity: float, tile: int) -> DataFrame:
    """Links between sets of different classes that share a (part, sig); a large group is dealt to pairs of tiles."""
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), tiles).cast("int")
    keyed = groups.withColumn("tile", own).select(
        "*", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")).select(
        "part", "sig", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "fingerprint", "root", "own")

    def work(table: pa.Table) -> pa.Table:
        rows = [dict(r, sigs=np.array(r["sigs"])) for r in table.to_pylist()]
        out, root = [], {r["root"]: r["root"] for r in rows}

        def top(name: str) -> str:
            while root[name] != name:
                name = root[name]
            return name

        a, b = rows[0]["a"], rows[0]["b"]
        for i, x in enumerate(rows):
            for y in rows[:i]:
                crossing = a == b or x["tile"] != y["tile"]
                if crossing and (x["own"] or y["own"]) and top(x["root"]) != top(y["root"]) and _alike(x["sigs"], y["sigs"], similarity):
                    root[top(x["root"])] = top(y["root"])
                    out.append((x["fingerprint"], y["fingerprint"]))
        return pa.table({"u": pa.array([u for u, _ in out], pa.string()), "v": pa.array([v for _, v in out], pa.string())})

    return keyed.join(sets, "fingerprint").groupBy("part", "sig", "a", "b").applyInArrow(work, "u string, v string")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8, anchors: np.ndarray | None = None,
    chain: int = CHAIN, tile: int = TILE,
) -> DataFrame:
    """(doc_id, fingerprint, class_id) of every row; classes are what links of at least ``similarity`` reach, named by their least id.

    Equal sets are one set before any is compared. Sets meet at a shared rare signature in the
    same part of set lengths or in neighbouring ones. First each is held against one set of
    the group; then, in groups that still hold several classes, sets of different classes are
    compared until none are left, in pairs of tiles where a group is large. So no link between
    classes is lost, and copies never make pairs of their own.

    A null text is empty; all empty texts are one class. A null id names no class unless all
    ids of the class are null. Repeated rows stay; other columns are not read.
    """
    anchors = common_words(docs, text) if anchors is None else anchors
    marks = written(signed(docs, anchors, doc_id, text, chain), "spotsigs-marks")
    sets = written(marks.groupBy("fingerprint").agg(F.any_value("sigs").alias("sigs")), "spotsigs-sets")
    met = _prefixes(sets, similarity)
    groups = met.groupBy("part", "sig").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("own"), F.col("fingerprint"))).alias("pivot")).filter("n > 1 AND pivot IS NOT NULL")
    met = written(met.join(groups, ["part", "sig"]), "spotsigs-met")
    pairs = met.filter("fingerprint <> pivot").select(F.least("fingerprint", "pivot").alias("u"), F.greatest("fingerprint", "pivot").alias("v")).distinct()
    found = written(_verified(pairs, sets, similarity), "spotsigs-links")
    roots = star_components(found)
    rooted = met.join(roots, met.fingerprint == roots.node, "left").select(
        "part", "sig", "fingerprint", "own", "n", F.coalesce("root", "fingerprint").alias("root"))
    mixed = rooted.groupBy("part", "sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("part", "sig")
    more = _mixed_links(rooted.join(mixed, ["part", "sig"], "left_semi"), sets, similarity, tile)
    roots = star_components(written(found.unionByName(more), "spotsigs-links"))
    classes = marks.select("doc_id", "fingerprint").join(
        roots.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left").select(
        "doc_id", "fingerprint", F.coalesce("root", "fingerprint").alias("root"))
    named = classes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return classes.join(named, "root").select("doc_id", "fingerprint", "class_id")
