"""Write relations back as archive documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sedgemill.operators.flatten import POST_FIELDS
from sedgemill.operators.shuffles import NULL_SALTS, lookup_join, tasks_for, with_row_index
from sedgemill.session import written
from sedgemill.sinks.folders import write_folders

# Format of large archives: posts in a document; a source with more is written in parts 0, 1, ...
POSTS_PER_DOCUMENT = 1_000

# Fields of the nested lists, in document order.
NESTED = {
    "media": ["type", "url", "local_path"],
    "links": ["text", "url"],
    "download_errors": ["url", "error"],
}


def _ordered(column: str, fields: list[str]) -> Column:
    """Collected structs in the order of their leading field, which is then dropped."""
    return F.transform(
        F.sort_array(F.collect_list(column)), lambda item: F.struct(*[item[n].alias(n) for n in fields])
    )


def archive_records(
    posts: DataFrame,
    media: DataFrame | None = None,
    links: DataFrame | None = None,
    errors: DataFrame | None = None,
) -> DataFrame:
    """Posts with their lists nested, one record each, as they stand in an archive document.

    A list is ordered by the child's ``pos`` (of any type that sorts) where it has one.
    """
    tables = {"media": media, "links": links, "download_errors": errors}
    # Children that come joined on the post's id are nested where they are: one list a kind, no shuffle of all kinds.
    # Posts without an id match nothing and are spread.
    place = F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS)).cast("string")
    joined = posts.withColumn("_key", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("\0"), place)))
    for kind, table in tables.items():
        if table is None:
            as_type = "array<struct<" + ",".join(f"{n}:string" for n in NESTED[kind]) + ">>"
            joined = joined.withColumn(kind, F.array().cast(as_type))
            continue
        renamed = table.withColumnRenamed("media_type", "type")
        pos = F.col("pos") if "pos" in table.columns else F.lit(None).cast("bigint")
        item = F.struct(pos.alias("pos"), *NESTED[kind])
        nested = renamed.select(F.col("post_id").cast("string").alias("_id"), item.alias("_item")).groupBy("_id").agg(
            _ordered("_item", NESTED[kind]).alias(kind))
        match = (F.col("_key") == F.col("_id")) & F.col("id").isNotNull()
        joined = joined.join(nested, match, "left").drop("_id").withColumn(
            kind, F.coalesce(kind, F.array().cast(nested.schema[kind].dataType)))
    return joined.drop("_key")


def _weight(records: DataFrame) -> Column:
    """About the bytes a post takes in memory: its texts, and so many for each field and each item of a list."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("content", "original_url") if c in records.columns]
    items = [F.coalesce(F.size(k), F.lit(0)) * 300 for k in NESTED if k in records.columns]
    return sum([*texts, *items], F.lit(1_000)).cast("bigint")


#: Types whose values JSON text gives back as they were.
EXACT = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _nullable(kind: T.DataType, numbered: bool) -> T.DataType | None:
    """The type with all its parts nullable, its fields named by their place if ``numbered``; None if JSON could change a value."""
    if isinstance(kind, T.StructType):
        inner = [_nullable(f.dataType, numbered) for f in kind]
        if None in inner:
            return None
        return T.StructType([T.StructField(str(i) if numbered else f.name, t) for i, (f, t) in enumerate(zip(kind, inner, strict=True))])
    if isinstance(kind, T.ArrayType):
        inner = _nullable(kind.elementType, numbered)
        return None if inner is None else T.ArrayType(inner)
    return kind if isinstance(kind, EXACT) else None


def _shuffled(rows: DataFrame, column: str, tasks: int, keys: list[str]) -> DataFrame:
    """Rows spread by ``keys`` into ``tasks`` tasks. A struct with lists of structs travels as JSON text: rows have a place, a length
    and padding for every field of every item, and take half as much again when they are compressed."""
    kind = rows.schema[column].dataType
    short = _nullable(kind, True)
    if short is None:
        return rows.repartition(tasks, *keys)
    moved = rows.withColumn(column, F.to_json(F.col(column).cast(short))).repartition(tasks, *keys)
    # A text that could not be read back would be a lost post.
    return moved.withColumn(column, F.from_json(column, short, {"mode": "FAILFAST"}).cast(_nullable(kind, False)))


def write_archives(
    sources: DataFrame,
    records: DataFrame,
    path: str,
    order: list[str],
    layout: str = "lines",
    slug: str = "source_slug",
    posts_per_document: int = POSTS_PER_DOCUMENT,
    compression: str | None = None,
) -> None:
    """One archive per source: metadata, scrape time and its posts in ``order``.

    A source of up to ``posts_per_document`` posts is one document, ``part`` 0; posts of a larger
    one are numbered, and it continues in parts 1, 2, ..., so no document
    depends on the size of its source. ``sources`` needs slug, name, orig_url, handler,
    scraped_at and may carry consolidated_at, old_scraped_at and new_scraped_at. ``records`` are
    read more than once: give stored ones. Layout
    ``lines`` has a document per line, ``files`` a file per document in a folder per slug.
    Layout ``whole`` has one document in one file per source, of any size and without parts: its
    posts pass a task in order and are written line by line (text files, read with
    ``read_archives(..., layout="stream", pattern="*.txt")``). ``compression`` is for files of ``lines``.
    The output appears as a whole or not at all.
    """
    fields = [c for c in ["id", *POST_FIELDS, *NESTED] if c in records.columns]
    # Only equal rows may tie, so a task that runs again orders its rows the same way.
    ties = [c for c in POST_FIELDS if c in records.columns]
    lists = [k for k in NESTED if k in records.columns]

    def rank(of) -> list[Column]:
        return [*[of(c) for c in [*order, "id", *ties]], F.xxhash64(*[F.to_json(of(k)) for k in lists])]

    owned = records.withColumn("_slug", F.col(slug)).where(F.col("_slug").isNotNull())
    meta = F.struct("slug", "name", "orig_url", "handler").alias("metadata")
    extra = [F.col("consolidated_at")] if "consolidated_at" in sources.columns else []
    if "old_scraped_at" in sources.columns:
        extra.append(F.struct("old_scraped_at", "new_scraped_at").alias("sources"))
    if layout == "whole":
        item = F.to_json(F.struct(*fields, F.col("_slug").alias("source_slug")), {"ignoreNullFields": "false"})
        posts = owned.select(
            F.col("_slug").alias("slug"), F.lit(1).alias("_kind"), F.struct(*rank(F.col)).alias("_rank"), item.alias("value"))
        known = lookup_join(posts, sources.select("slug"), ["slug"], "left_semi")
        tasks = tasks_for(records.sparkSession, owned.agg(F.sum(_weight(owned))).first()[0] or 0)
        _write_whole(sources.select("slug", F.struct(meta, "scraped_at", *extra).alias("head")), known, path, tasks)
        return
    counts = written(owned.groupBy(F.col("_slug").alias("slug")).agg(
        F.count("*").alias("_n"), F.sum(_weight(owned)).alias("_bytes")), "archive-counts")
    # So many that the posts of a task are nested and sorted in memory, however many there are in all.
    tasks = tasks_for(owned.sparkSession, counts.agg(F.sum("_bytes")).first()[0] or 0)
    # A source in one document needs no numbers; of the larger ones there are few for the posts.
    large = written(counts.where(F.col("_n") > posts_per_document).select(F.col("slug").alias("_slug")), "archive-large")
    keys = [c for c in order if c not in fields]
    post = F.struct(*keys, *fields)
    heads = sources.join(counts.drop("_bytes").hint("merge"), "slug", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))

    def documents(posts: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
        # Posts come together before they are nested (lists begun before the shuffle would be sorted and spilled there);
        # documents stay where they were nested and meet one head each, that of a source without posts none.
        rows = posts.select(F.col("_slug").alias("slug"), *keys[1:], post.alias("_post"))
        nested = _shuffled(rows, "_post", tasks, keys).groupBy(*keys).agg(F.collect_list("_post").alias("_posts"))
        ranked = F.sort_array(F.transform("_posts", lambda p: F.struct(
            *[c.alias(f"k{i}") for i, c in enumerate(rank(lambda c: p[c]))], p.alias("post"))))
        plain = F.transform(ranked, lambda r: F.struct(*[r["post"][c].alias(c) for c in fields], F.col("slug").alias("source_slug")))
        full = heads.join(nested.select(*keys, plain.alias("posts")).hint("merge"), keys, "left")
        part = F.col("part") if "part" in keys else F.lit(0).cast("bigint").alias("part")
        empty = F.array().cast(full.schema["posts"].dataType)
        return full.select("slug", meta, "scraped_at", *extra, part, F.coalesce("posts", empty).alias("posts"))

    if large.isEmpty():
        out = documents(owned, heads, ["slug"])
    else:
        numbered = with_row_index(lookup_join(owned, large, ["_slug"], "left_semi"), [F.col("_slug"), *rank(F.col)], "_row")
        first = numbered.groupBy("_slug").agg(F.min("_row").alias("_first"))
        part = F.floor((F.col("_row") - F.col("_first")) / posts_per_document).cast("bigint")
        parted = lookup_join(numbered, first, ["_slug"], "inner").withColumn("part", part)
        parts = F.sequence(F.lit(0).cast("bigint"), (F.ceil(F.col("_n") / posts_per_document) - 1).cast("bigint"))
        out = documents(
            lookup_join(owned, large, ["_slug"], "left_anti"), heads.where(F.col("_n") <= posts_per_document), ["slug"]
        ).unionByName(documents(
            parted, heads.where(F.col("_n") > posts_per_document).withColumn("part", F.explode(parts)), ["slug", "part"]))
    if layout == "lines":
        out.drop("slug").write.json(path, compression=compression)
    elif layout == "files":
        write_folders(out, "slug", path, "json", alone=True)
    else:
        raise ValueError(f"unknown layout {layout}")


def _write_whole(sources: DataFrame, posts: DataFrame, path: str, tasks: int) -> None:
    """One file per slug: the members before the posts, a line per post, the closing brackets."""
    head = F.regexp_replace(F.to_json("head", {"ignoreNullFields": "false"}), r"\}$", ',"posts":[')
    none = F.lit(None).cast(posts.schema["_rank"].dataType)
    edge = lambda kind, value: sources.select("slug", F.lit(kind).alias("_kind"), none.alias("_rank"), value.alias("value"))
    lines = edge(0, head).unionByName(posts).unionByName(edge(2, F.lit("]}")))
    # The writer opens one file per slug as the rows pass; a slug that cannot be null keeps their order.
    named = lines.withColumn("slug", F.coalesce("slug", F.lit("")))
    # Every post but the first has a comma before it.
    before = F.lag("_kind").over(Window.partitionBy("slug").orderBy("_kind", "_rank"))
    comma = F.when((F.col("_kind") == 1) & (before == 1), ",").otherwise("")
    sorted_lines = named.repartition(tasks, "slug").select("slug", "_kind", F.concat(comma, "value").alias("value"))
    write_folders(sorted_lines.select("slug", "value"), "slug", path, "text")
