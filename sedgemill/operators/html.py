"""Pages of HTML to posts, links, sources and full texts.

Parsing is the one step without a Spark expression: it runs in Arrow batches, one pass
per page, and everything around it stays a DataFrame plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import sedgemill
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from sedgemill.functions import absolutize_url
from sedgemill.operators.html_tree import JS_SPACE, Walk, parse
from sedgemill.operators.shuffles import lookup_join

# The parser travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sedgemill)

# Where the source's pages keep their parts.
POST = "article.post"
POST_META_TAG, POST_META_ID_PREFIX = "div", "arepl-"
POST_ATTRIBUTES = {
    "id": "data-id", "source_slug": "data-sn", "source_name": "data-n", "date": "data-d",
    "original_url": "data-oau", "local_url": "data-f",
}
POST_BODY = ".leadtextborder.wordbreak"
POST_IMAGE = "figure img.imgfit"
POST_VIDEO, VIDEO_ATTRIBUTE = ".video-wrapper .fb-video", "data-href"
MORE_LINK, MORE_TEXT = ".pt-1.clearfix .float-right a", "Folytatódik"
FULL_BODY = "article.post-details .wordbreak"
SOURCE = ".ma-ps"
SOURCE_ATTRIBUTES = {"slug": "data-s", "name": "data-n", "orig_url": "data-o", "handler": "data-h"}
DEFAULT_HANDLER = "facebook"
SCROLL_ID = r"initInfiniteScrollForSource\(([0-9]+)\)"
LAST_POST_ID = r"document\.lastPostId = ([0-9]+);"
END_MARK = "post-sources-placeholder"

POST_SCHEMA = (
    "post_pos int, " + ", ".join(f"{c} string" for c in POST_ATTRIBUTES)
    + ", content string, continuation_url string, "
    "media array<struct<type:string,url:string>>, links array<struct<text:string,url:string>>"
)


def _over_pages(pages: DataFrame, html: str, schema: str, read: Callable[[str], Iterable[tuple]]) -> DataFrame:
    """Rows that ``read`` finds in the text of each page, next to the page's other columns; in Arrow batches."""
    keep = [c for c in pages.columns if c != html]
    found_schema = pages.sparkSession.createDataFrame([], schema).toArrow().schema
    names, kinds = found_schema.names, found_schema.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, origin = [], []
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                for row in read(text):
                    found.append(row)
                    origin.append(i)
            kept = batch.select(keep).take(pa.array(origin, pa.int32())).columns if keep else []
            rows = [pa.array([row[j] for row in found], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*kept, *rows], [*keep, *names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in keep)
    full = f"{kept}, {schema}" if kept else schema
    return pages.where(F.col(html).isNotNull()).select(*keep, html).mapInArrow(run, full)


def _trim(text: str) -> str:
    return text.strip(JS_SPACE)


class _Post:
    """What is found inside a post block so far; texts are lists of pieces."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.images: list[dict] = []
        self.videos: list[dict] = []
        self.bodies: list[list[str]] = []
        self.links: list[tuple[list[str], str | None]] = []
        self.more: tuple[list[str], str | None] | None = None


class _Posts(Walk):
    """Post blocks of a page in their order, from one walk; blocks may lie in one another."""

    def __init__(self) -> None:
        super().__init__([POST, POST_IMAGE, POST_VIDEO, POST_BODY, f"{POST_BODY} a", MORE_LINK])
        self.found: list[_Post] = []

    def start(self, tag: str, attrs: dict[str, str], fits: list[int]) -> list:
        kept: list = []
        if self.scopes:
            if tag == POST_META_TAG and attrs.get("id", "").startswith(POST_META_ID_PREFIX):
                for post in self.scopes:
                    post.head = post.head or attrs
            text: list[str] | None = None
            for fit in fits:
                if fit == 1 and "src" in attrs:
                    for post in self.scopes:
                        post.images.append({"type": "image", "url": attrs["src"]})
                elif fit == 2:
                    for post in self.scopes:
                        post.videos.append({"type": "video", "url": attrs.get(VIDEO_ATTRIBUTE)})
                elif fit >= 3:
                    text = [] if text is None else text
                    for post in self.scopes:
                        if fit == 3:
                            post.bodies.append(text)
                        elif fit == 4:
                            post.links.append((text, attrs.get("href")))
                        else:
                            post.more = post.more or (text, attrs.get("href"))
            if text is not None:
                kept.append(text)
        if 0 in fits:
            post = _Post()
            self.found.append(post)
            kept.append(post)
        return kept


def _posts(text: str) -> Iterator[tuple]:
    n = 0
    for post in _Posts().over(text).found:
        if post.head is None:
            continue
        links = [{"text": _trim("".join(said)), "url": href} for said, href in post.links]
        continued = post.more[1] if post.more and _trim("".join(post.more[0])).startswith(MORE_TEXT) else None
        attributes = [post.head.get(a) for a in POST_ATTRIBUTES.values()]
        content = _trim("".join(piece for body in post.bodies for piece in body))
        yield (n, *attributes, content, continued, post.images + post.videos, links)
        n += 1


def html_posts(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """Posts of feed pages with their media (images first) and links; blocks without a head are skipped."""
    rows = _over_pages(pages, html, POST_SCHEMA, _posts)
    absolute = F.transform("media", lambda m: F.struct(
        m["type"].alias("type"),
        F.when(m["type"] == "image", absolutize_url(m["url"], base)).otherwise(m["url"]).alias("url")))
    return rows.withColumn("media", absolute)


def html_media(posts: DataFrame) -> DataFrame:
    return posts.select(F.col("id").alias("post_id"), "source_slug", F.posexplode("media").alias("pos", "_m")).select(
        "post_id", "source_slug", F.col("_m.type").alias("media_type"), "_m.url", "pos")


def html_post_links(posts: DataFrame) -> DataFrame:
    return posts.select(F.col("id").alias("post_id"), "source_slug", F.posexplode("links").alias("pos", "_l")).select(
        "post_id", "source_slug", "_l.text", "_l.url", "pos")


def html_links(pages: DataFrame, html: str = "html", scope: str = "") -> DataFrame:
    """Anchors with an address, inside elements that match ``scope`` or anywhere."""

    def read(text: str) -> Iterator[tuple]:
        for n, a in enumerate(e for e in parse(text).find(f"{scope} a") if "href" in e.attrs):
            yield n, _trim(a.text()), a.attrs["href"]

    return _over_pages(pages, html, "pos int, text string, url string", read)


def html_sources(pages: DataFrame, html: str = "html") -> DataFrame:
    """Sources listed on the index page, in page order; a missing handler has a default."""

    def read(text: str) -> Iterator[tuple]:
        for n, e in enumerate(parse(text).find(SOURCE)):
            yield (n, *[e.attrs.get(a) for a in SOURCE_ATTRIBUTES.values()])

    schema = "pos int, " + ", ".join(f"{c} string" for c in SOURCE_ATTRIBUTES)
    rows = _over_pages(pages, html, schema, read)
    return rows.withColumn("handler", F.coalesce(F.nullif("handler", F.lit("")), F.lit(DEFAULT_HANDLER)))


def html_full_content(pages: DataFrame, html: str = "html") -> DataFrame:
    """Trimmed text of the first body of a post's own page; pages without one give no row."""

    def read(text: str) -> Iterator[tuple]:
        for body in parse(text).find(FULL_BODY)[:1]:
            yield (_trim(body.text()),)

    return _over_pages(pages, html, "body string", read)


def continuation_fill(posts: DataFrame, bodies: DataFrame, base: str) -> DataFrame:
    """Replace the shortened content by the fetched body (url, body) where that is not empty."""
    url = absolutize_url(F.col("continuation_url"), base)
    full = bodies.where(F.col("body") != "").select(F.col("url").alias("_url"), "body")
    rows = lookup_join(posts.withColumn("_url", url), full, ["_url"], "left")
    return rows.withColumn("content", F.coalesce("body", "content")).drop("_url", "body")


def feed_page_tokens(html: Column) -> dict[str, Column]:
    """Numbers a feed page keeps in its scripts: the source's and the last post's."""
    first = lambda pattern: F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    return {"source_id": first(SCROLL_ID), "last_post_id": first(LAST_POST_ID)}


def feed_page_status(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Why a crawl stops at a page, or ``more`` when it has posts."""
    blank = F.col(html).isNull() | F.regexp_like(F.col(html), F.lit(r"(?U)\A[\s\x{feff}]*\z"))
    flags = pages.select(
        key, F.coalesce(html, F.lit("")).alias(html), blank.alias("_blank"),
        F.coalesce(F.col(html).contains(END_MARK), F.lit(False)).alias("_mark"))
    # One pass: a page's flags go with it through the walk, which gives its count even if that is 0.
    rows = _over_pages(flags, html, "posts long", lambda text: ((sum(1 for _ in _posts(text)),),))
    status = (
        F.when(F.col("_blank"), "blank").when(F.col("_mark"), "placeholder")
        .when(F.col("posts") == 0, "no_posts").otherwise("more"))
    return rows.select(key, "posts", status.alias("status"))
