"""HTML extraction over pages rendered from the relations, and over the given pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sedgemill.operators import html as hx
from sedgemill.plans.fixtures import fixture, table, with_views
from sedgemill.plans.registry import query
from sedgemill.plans.render import escape_html, rendered
from sedgemill.sinks.archives import archive_records

BASE = "https://cdn.example.com"
SITE = "https://example.org"


def _tag(name: str, value: Column) -> Column:
    return F.concat(F.lit(f' {name}="'), escape_html(value), F.lit('"'))


def post_pages(spark, sf_dir) -> DataFrame:
    """The rendered feed pages, spread over the tasks of a small session too."""
    write = lambda path: _post_pages(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(rendered(spark, sf_dir, "post-pages", write))


def _post_pages(spark, sf_dir) -> DataFrame:
    """Feed pages of up to twenty posts: two orders of attributes, entities, a block without a head."""
    records = archive_records(fixture(spark, sf_dir, "f_posts"), fixture(spark, sf_dir, "f_media"))
    n = F.col("id").cast("bigint")
    attrs = [_tag(attr, F.col(c)) for c, attr in hx.POST_ATTRIBUTES.items()]
    mark = F.concat(F.lit(' id="arepl-'), "id", F.lit('"'))
    head = F.when(n % 2 == 0, F.concat(mark, *attrs)).otherwise(F.concat(*reversed(attrs), mark))
    link = F.when(n % 4 == 0, F.concat(F.lit(' <a class="x" href="https://example.com/l?a=1&amp;b='), "id", F.lit('">read '), "id", F.lit("</a>"))).otherwise("")
    # Some images have an address relative to the site.
    src = lambda u: F.when(u.endswith("=1"), F.replace(u, F.lit(BASE), F.lit(""))).otherwise(u)
    image = lambda m: F.concat(F.lit('<figure><img class="big imgfit"'), _tag("src", src(m["url"])), F.lit("></figure>"))
    video = lambda m: F.concat(F.lit('<div class="video-wrapper"><div'), _tag("data-href", m["url"]), F.lit(' class="fb-video"></div></div>'))
    of = lambda kind: F.filter("media", lambda m: m["type"] == kind)
    more = (
        F.when(F.col("continuation_url").isNotNull(), F.concat(F.lit("<a"), _tag("href", F.col("continuation_url")), F.lit("> Folytatódik »</a>")))
        .when(n % 3 == 0, F.lit('<a href="/x">Megosztás</a>')).otherwise(""))
    article = F.concat(
        F.lit('<article class="post"><div'), head, F.lit('></div><div class="wordbreak leadtextborder">\n '),
        escape_html(F.col("content")), link, F.lit("\n</div>"),
        F.array_join(F.transform(of("video"), video), ""), F.array_join(F.transform(of("image"), image), ""),
        F.lit('<div class="pt-1 clearfix"><span class="float-right">'), more, F.lit("</span></div></article>"))
    blocks = records.select(F.floor(n / 20).alias("page_no"), n.alias("n"), article.alias("article"))
    # Blocks come together before they are listed, in parts that are not merged: no list is sorted and spilled before the shuffle.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pages = blocks.repartition(parts, "page_no").groupBy("page_no").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("n", "article"))), lambda a: a["article"]), "\n").alias("body"))
    return pages.select("page_no", F.concat(
        F.lit('<html><body><script>var a = "<article class=post>";</script><article class="post"><p>no head</p></article>'),
        "body", F.lit("</body></html>")).alias("html"))


def posts(spark, sf_dir) -> DataFrame:
    return hx.html_posts(post_pages(spark, sf_dir), BASE)


@query("html_posts", with_views("f_posts") + """
SELECT id, source_slug, source_name, date, original_url, local_url,
  CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN concat(content, ' read ', id) ELSE content END AS content FROM f_posts
""")
def html_posts_query(spark, sf_dir):
    return posts(spark, sf_dir).select(*hx.POST_ATTRIBUTES, "content")


@query("html_media", with_views("f_media") + "SELECT post_id, source_slug, media_type, url FROM f_media")
def html_media_query(spark, sf_dir):
    return hx.html_media(posts(spark, sf_dir)).select("post_id", "source_slug", "media_type", "url")


@query("html_post_links", with_views("f_posts") + """
SELECT id AS post_id, concat('read ', id) AS text, concat('https://example.com/l?a=1&b=', id) AS url
FROM f_posts WHERE CAST(id AS BIGINT) % 4 = 0
""")
def html_post_links_query(spark, sf_dir):
    return hx.html_post_links(posts(spark, sf_dir)).select("post_id", "text", "url")


@query("html_continuation", with_views("f_posts") + "SELECT id, continuation_url FROM f_posts")
def html_continuation_query(spark, sf_dir):
    return posts(spark, sf_dir).select("id", "continuation_url")


@query("html_links", with_views("f_links") + "SELECT page_id, url FROM f_links")
def html_links_query(spark, sf_dir):
    return hx.html_links(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "url")


@query("html_sources", with_views("f_sources") + "SELECT slug, name, orig_url, handler FROM f_sources")
def html_sources_query(spark, sf_dir):
    """Index pages of fifty sources; the default handler is left out of the page."""
    n = F.substr("slug", F.lit(5)).cast("bigint")
    handler = F.when(F.col("handler") == "youtube", _tag("data-h", F.col("handler"))).when(n % 3 == 0, ' data-h=""').otherwise("")
    item = F.concat(F.lit('<a class="ma-ps x"'), _tag("data-n", F.col("name")), _tag("data-s", F.col("slug")), handler, _tag("data-o", F.col("orig_url")), F.lit(">t</a>"))
    pages = fixture(spark, sf_dir, "f_sources").select(F.floor(n / 50).alias("page_no"), item.alias("item")).groupBy("page_no").agg(
        F.array_join(F.collect_list("item"), "").alias("html"))
    return hx.html_sources(pages).select("slug", "name", "orig_url", "handler")


@query("continuation_fill", with_views("f_posts") + """,
bodies AS (SELECT concat('/post/', doc_id) AS url, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS body FROM documents WHERE doc_id % 5 <> 0)
SELECT id, coalesce(nullif(body, ''), content) AS content FROM f_posts LEFT JOIN bodies ON url = continuation_url
""")
def continuation_fill_query(spark, sf_dir):
    """Full pages hold the whole texts of the documents; one in five has an empty body."""
    text = F.when(F.col("doc_id") % 5 == 0, F.lit(" ")).otherwise(escape_html(F.col("text")))
    pages = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(f"{SITE}/post/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(F.lit('<article class="post-details"><div class="wordbreak">'), text, F.lit('</div><div class="wordbreak">x</div></article>')).alias("html"))
    filled = hx.continuation_fill(fixture(spark, sf_dir, "f_posts"), hx.html_full_content(pages), SITE)
    return filled.select("id", "content")


@query("feed_page_tokens", """
SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN CAST(page_id * 7 AS VARCHAR) END AS source_id,
  CASE WHEN page_id % 2 = 0 THEN CAST(page_id + 1000 AS VARCHAR) END AS last_post_id FROM pages
""")
def feed_page_tokens_query(spark, sf_dir):
    n = F.col("page_id")
    scroll = F.when(n % 3 != 0, F.concat(F.lit("<script>initInfiniteScrollForSource("), (n * 7).cast("string"), F.lit(");</script>"))).otherwise("")
    last = F.when(n % 2 == 0, F.concat(F.lit("<script>document.lastPostId = "), (n + 1000).cast("string"), F.lit(";</script>"))).otherwise("")
    html = F.concat("html", scroll, last)
    return table(spark, sf_dir, "pages").select("page_id", *[c.alias(k) for k, c in hx.feed_page_tokens(html).items()])


@query("feed_page_status", """
SELECT page_id, CAST(CASE WHEN page_id % 5 = 2 THEN 1 WHEN page_id % 5 = 4 THEN 2 ELSE 0 END AS BIGINT) AS posts,
  CASE page_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'blank' WHEN 2 THEN 'placeholder' WHEN 3 THEN 'no_posts' ELSE 'more' END AS status
FROM pages
""")
def feed_page_status_query(spark, sf_dir):
    n = F.col("page_id") % 5
    block = F.lit('<article class="post"><div id="arepl-1" data-id="1"></div></article>')
    html = (
        F.when(n == 0, F.lit(None).cast("string")).when(n == 1, F.lit(" \n\t"))
        .when(n == 2, F.concat(block, F.lit('<div id="post-sources-placeholder"></div>'), "html"))
        .when(n == 3, F.col("html")).otherwise(F.concat(block, "html", block)))
    return hx.feed_page_status(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "page_id")
