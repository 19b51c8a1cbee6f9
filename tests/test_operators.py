"""Operators on small hand-made inputs: golden rows, edge rows, hot keys."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sedgemill.operators import api_index, dedup, feed, flatten as fl, html, merge as mg, planning as pl, profile as pf, reconcile as rc
from sedgemill.operators.html_tree import parse
from sedgemill.operators.shuffles import lookup_join, with_row_index
from sedgemill.operators.upsert import insert_or_ignore
from sedgemill.plans.merge_queries import Sides
from sedgemill.sinks import archive_records, current_tables, write_archives, write_schema_report, write_tables
from sedgemill.sinks.tables import store_state
from sedgemill.sources import archive_documents, read_archives, read_ledger, read_manifest, read_worklist


def documents(spark, *docs, paths=None):
    rows = [(paths[i] if paths else f"/d/s{i}.json", f"s{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return archive_documents(spark.createDataFrame(rows, "path string, file_slug string, value string"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_flatten_edges(spark):
    docs = documents(
        spark,
        {"metadata": {"name": " A\t"}, "scraped_at": None, "posts": [
            {"id": " 1 ", "content": " ", "source_slug": None, "media": [{"type": "image", "url": "u"}], "links": None},
            {"id": "2"}, {"content": "no id"}, {"id": 3, "download_errors": [{"url": "x"}]}, None]},
        {"metadata": {"slug": None}, "posts": None},
        "{broken", [1], {"posts": "text"})
    assert rows(docs.where("error is not null"), "file_slug") == [("s2",), ("s3",), ("s4",)]
    assert rows(fl.flatten_sources(docs), "slug", "name", "scraped_at") == [("s0", "A", None), (None, None, None)]
    posts = fl.explode_posts(docs)
    got = rows(fl.flatten_posts(posts), "id", "source_slug", "content", "has_media", "has_links", "has_errors")
    assert got == [("1", None, None, 1, 0, 0), ("2", "s0", None, 0, 0, 0), ("3", "s0", None, 0, 0, 1)]
    assert rows(fl.flatten_media(posts), "post_id", "media_type", "url", "local_path") == [("1", "image", "u", None)]
    stats = fl.load_stats(docs)
    assert rows(stats, "path", "success", "posts", "media", "errors_dl")[0] == ("/d/s0.json", True, 3, 1, 1)
    assert rows(fl.load_totals(stats), "files", "failed_files", "posts") == [(5, 3, 3)]


def test_last_read_post_wins(spark):
    docs = documents(
        spark, {"posts": [{"id": "1", "content": "a"}, {"id": "1", "content": "b"}]}, {"posts": [{"id": "1", "content": "c"}]},
        paths=["/d/x/b.json", "/d/a/z.json"])
    assert rows(fl.upsert_posts(fl.flatten_posts(fl.explode_posts(docs))), "id", "content") == [("1", "b")]


def test_insert_or_ignore(spark):
    store = spark.createDataFrame([("a", "old")], "id string, v string")
    new = spark.createDataFrame([("a", "x", 1), ("b", "second", 3), ("b", "first", 2)], "id string, v string, n int")
    assert rows(insert_or_ignore(store, new, ["id"], ["n"]), "id", "v") == [("a", "old"), ("b", "first")]


def test_dedup_golden(spark):
    keys = [("s", "u", "d"), ("s", "u", "d"), ("s", "", "d"), ("s", " ", "d"), ("s", "u ", "d2"), ("s", None, "d")]
    posts = spark.createDataFrame([("f", i, *k) for i, k in enumerate(keys)],
                                  "file_slug string, post_pos int, source_slug string, original_url string, date_iso string")
    kept = dedup.dedup_posts(posts, ["post_pos"])
    assert rows(kept, "post_pos") == [(0,), (2,), (3,), (4,), (5,)]
    assert rows(dedup.dedup_report(posts, ["post_pos"]), "removed", "remaining") == [(1, 5)]
    assert dedup.dedup_report(kept, ["post_pos"]).count() == 0
    other = posts.unionByName(posts.withColumn("source_slug", F.lit("t")))
    assert rows(dedup.cross_posts(other), "url", "slugs", "slug") == [("u", 2, "s"), ("u", 2, "t")]


def merged(spark, old, new, old_time="2026-01-01T00:00:00Z", new_time="2026-02-01T00:00:00Z"):
    error = lambda e: [{"url": e, "error": e}] if e else []
    doc = lambda posts, time: {"metadata": {"slug": "s0"}, "scraped_at": time, "posts": [
        {"id": i, "content": c, "date_iso": d, "download_errors": error(e)} for i, c, d, e in posts]}
    o, n = documents(spark, doc(old, old_time)), documents(spark, doc(new, new_time))
    matches = mg.slug_match(o, n)
    op, np_ = fl.explode_posts(o), fl.explode_posts(n)
    groups = mg.merge_groups(op.drop("media", "links", "download_errors"), np_.drop("media", "links", "download_errors"), matches)
    errors = mg.merge_errors(fl.flatten_errors(op), fl.flatten_errors(np_), groups, matches)
    return o, n, matches, groups, errors


OLD = [("1", "o1", "d", "a"), ("2", "o2", "e", None), ("1", "o3", "d", "b")]
NEW = [("1", "n1", "d", "c"), ("3", "n3", "d", None), ("1", "n2", "d", "d")]


def test_merge_golden(spark):
    o, n, matches, groups, errors = merged(spark, OLD, NEW)
    assert rows(mg.merge_posts(groups), "id", "content") == [("1", "n2"), ("2", "o2")]
    assert rows(mg.merge_posts(groups, keep_new_only=True), "id") == [("1",), ("2",), ("3",)]
    order = errors.orderBy("newer", "part", "post_pos", "pos").select("post_id", "error").collect()
    assert [tuple(r) for r in order] == [("1", "b"), ("1", "c"), ("1", "d")]
    assert rows(mg.merge_stats(groups, o, n, matches), "total_old", "total_new", "duplicates_updated", "only_in_old",
                "only_in_new", "merged_total") == [(3, 3, 2, 1, 1, 2)]


def test_merge_swaps_when_old_is_later(spark):
    _, _, matches, groups, _ = merged(spark, OLD, NEW, old_time="2026-03-01T00:00:00Z")
    assert rows(matches, "status", "swapped") == [("merged", True)]
    assert rows(mg.merge_posts(groups), "id", "content") == [("1", "o3"), ("3", "n3")]


def test_old_only_sample_takes_both_ends_once(spark):
    posts = spark.range(25).select(
        F.concat(F.lit("f"), F.col("id") % 1).alias("file_slug"), F.col("id").cast("string").alias("id"), F.lit("s").alias("source_slug"),
        F.lit("n").alias("source_name"), F.format_string("%02d", "id").alias("date_iso"), F.lit("").alias("date"),
        F.lit("").alias("original_url"), F.lit(None).cast("string").alias("content"), F.array(F.lit(1)).alias("media"),
        F.lit(None).cast("array<int>").alias("links"), F.lit(0).alias("part"), F.col("id").cast("int").alias("post_pos"))
    sample = mg.old_only_sample(posts)
    assert {int(r.id) for r in sample.collect()} == set(range(10)) | set(range(15, 25))
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert mg.old_only_sample(posts.limit(12)).count() == 12


def test_counts_of_a_merge_read_each_snapshot_once(spark):
    docs = [documents(spark, {"metadata": {"slug": "s0"}, "scraped_at": at, "posts": [{"id": "1"}, {"text": "no id"}, {"id": " 2 "}]})
            for at in ("2026-01-01T00:00:00Z", "2026-02-01T00:00:00Z")]
    for side in docs:
        heads = mg.document_heads(side)
        places = fl.explode_posts(side).select("path", "file_slug", "part", "post_pos", "id")
        assert rows(mg.post_places(heads), "id", "post_pos") == rows(places, "id", "post_pos") == [("1", 0), ("2", 2)]
    s = Sides(*docs)
    plan = s.stats()._jdf.queryExecution().toString()
    assert "from_json" not in plan and "content" not in plan  # heads and matches are written, posts are not touched
    assert [tuple(r) for r in s.stats().collect()] == [("s0", 3, 3, 2, 0, 0, 2)]


def test_media_are_looked_for_by_the_documents_slug_or_folder(spark, tmp_path):
    media = [{"url": "u1", "local_path": "media/a.jpg"}, {"url": "u2", "local_path": "/abs/b.jpg"}, {"url": "u3"}, {"local_path": ""}]
    for name, doc in {"x y/one": {"metadata": {"slug": "s"}, "posts": [{"id": "1", "media": media}]},
                      "x y/two": {"metadata": {"slug": ""}, "posts": [{"media": media[:1]}, {"id": "3", "media": None}]},
                      "x y/three": {"posts": [{"id": "4", "media": media[:1]}]}, "x y/bad": {"posts": "x"}}.items():
        path = tmp_path / f"{name}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps(doc))
    docs, here = read_archives(spark, str(tmp_path)), f"{tmp_path}/x y"
    found = rows(rc.referenced_media(docs), "slug", "post_id", "url", "local_path")
    assert found == [("s", "1", "u1", f"{here}/media/a.jpg"), ("s", "1", "u2", "/abs/b.jpg"), ("x y", "", "u1", f"{here}/media/a.jpg"),
                     ("x y", "4", "u1", f"{here}/media/a.jpg")]
    have = spark.createDataFrame([("/m/s/media/a.jpg",), ("/abs/b.jpg",)], "path string")
    missing = rc.missing_document_media(docs, have, "/m/")
    assert rows(missing, "slug", "local_path") == [("x y", "/m/x y/media/a.jpg")] * 2


def test_pages_that_end_a_crawl(spark):
    post = '<article class="post"><div id="arepl-1" data-id="1"></div></article>'
    pages = spark.createDataFrame([(1, None), (2, " \ufeff\n"), (3, "<p>x</p>"), (4, post * 3), (5, post + '<i class="post-sources-placeholder">'),
                                   (None, post)], "page_id long, html string")
    status = html.feed_page_status(pages, "page_id")
    assert rows(status, "page_id", "posts", "status") == [
        (1, 0, "blank"), (2, 0, "blank"), (3, 0, "no_posts"), (4, 3, "more"), (5, 1, "placeholder"), (None, 1, "more")]
    assert "Join" not in status._jdf.queryExecution().executedPlan().toString()


def test_posts_without_a_continuation_do_not_meet_in_one_task(spark):
    posts = spark.createDataFrame([(str(i), "short", None if i else "/post/1") for i in range(9)], "id string, content string, continuation_url string")
    bodies = spark.createDataFrame([("https://x/post/1", "full"), ("https://x/post/2", "")], "url string, body string")
    filled = html.continuation_fill(posts, bodies, "https://x")
    assert rows(filled, "id", "content") == [(str(i), "short" if i else "full") for i in range(9)]
    assert "_salt" in filled._jdf.queryExecution().optimizedPlan().toString()


def test_feed_golden(spark):
    body = spark.createDataFrame([("for (;;);0:{A}\n1:{B}\n\n",)], "b string")
    assert body.select(feed.split_chunks(F.col("b"))).first()[0] == ["{A}", "{B}"]
    cut = spark.createDataFrame([(["a", "x 1675004", "b"],), (["a"],), (["1675004"],)], "c array<string>")
    assert [r[0] for r in cut.select(feed.throttle_cut(F.col("c"))).collect()] == [["a"], ["a"], []]
    arrivals = spark.createDataFrame(
        [("p", pid, 0, i, 0) for i, pid in enumerate(["a", "b", "a", "b", "c", None, ""])],
        "page string, pid string, response_id long, chunk_no int, edge_no int")
    store = spark.createDataFrame([("p", "b"), ("q", "a")], "page string, id string")
    got = feed.feed_dedupe(arrivals, store).orderBy("chunk_no").select("status").collect()
    assert [r[0] for r in got] == ["NEW", "IGN-DB", "IGN-SEEN", "IGN-SEEN", "NEW"]


def test_html(spark):
    page = """<article class='post x'><div id="arepl-7" data-id=7 data-n="A &amp; B"></div>
      <div class="leadtextborder wordbreak"> one <a href="/l">t<b>w</b>o</a><script>no</script></div><p>open
      <figure><img class="imgfit" src="/i.jpg"></figure><figure><img class="imgfit"></figure>
      <div class="video-wrapper"><i><div class="fb-video" data-href="v"></div></i></div><div class="fb-video" data-href="w"></div>
      <div class="pt-1 clearfix"><u class="float-right"><a href="/more"> Folytatódik</a></u></div></article>
      <article class="post">no head</article>"""
    posts = html.html_posts(spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, html string"), "https://b")
    row = posts.select("k", "id", "source_name", "content", "continuation_url", "media", "links").collect()
    assert len(row) == 1
    k, pid, name, content, more, media, links = row[0]
    assert (k, pid, name, content, more) == (1, "7", "A & B", "one two", "/more")
    assert [tuple(m) for m in media] == [("image", "https://b/i.jpg"), ("video", "v")]
    assert [tuple(x) for x in links] == [("two", "/l")]
    full = html.html_full_content(spark.createDataFrame(
        [("u", '<article class="post-details"><p class="wordbreak"> a </p><p class="wordbreak">b</p></article>')], "url string, html string"))
    assert rows(full, "url", "body") == [("u", "a")]


def test_lists(spark, tmp_path):
    manifest = tmp_path / "m.txt"
    manifest.write_text("a/media/1.jpg\n/x\nnoslash\n\n")
    assert rows(read_manifest(spark, str(manifest)), "source_slug", "local_path", "skipped") == [
        ("", "x", False), ("a", "media/1.jpg", False), (None, None, True), (None, None, True)]
    (tmp_path / "w.csv").write_text('page_name,x,url\n p ,1," u, v "\n')
    assert rows(read_worklist(spark, str(tmp_path / "w.csv")), "page_name", "url") == [("p", "u, v")]
    with pytest.raises(ValueError):
        read_worklist(spark, str(manifest))
    ledgers = tmp_path / "l"
    ledgers.mkdir()
    (ledgers / "a.csv").write_text("filename,timestamp\nx.bin,t\n")
    (ledgers / "b.csv").write_text("t,y.mp4,3\nt,z.txt,3\n")
    assert rows(read_ledger(spark, str(ledgers)), "filename") == [("x.bin",), ("y.mp4",)]


def test_worklist_parts_add_up(spark):
    work = spark.createDataFrame(
        [("p", ""), ("p", "/1234567"), ("p", "/videos/1"), ("p", "/videos/2"), ("p", "/videos/3")], "page_name string, url string")
    failed = spark.createDataFrame([("/videos/3",)], "url string")
    disk = spark.createDataFrame([("p_1.mp4", 0)], "name string, size long")
    ledger = spark.createDataFrame([], "filename string")
    plan = lambda **kw: dict(rows(pl.worklist_pending(work, failed, ledger, disk, **kw), "url", "label"))
    assert plan() == {"": "empty_url", "/1234567": "no_post_id", "/videos/1": "already", "/videos/2": "pending"}
    assert plan(need_content=True)["/videos/1"] == "pending"
    assert len(plan(retry_failed=True)) == 5
    done = pl.download_summary(pl.worklist_pending(work, failed, ledger, disk), spark.createDataFrame([("p_2.mp4", True)], "filename string, ok boolean"))
    assert rows(done, "succeeded", "failed", "total") == [(3, 1, 4)]


def test_sync_plan_golden(spark):
    files = spark.sql("""SELECT * FROM VALUES ('young', 5L, TIMESTAMP '2026-01-01 00:00:01'), ('there', 5L, TIMESTAMP '2026-01-01 00:00:00'),
      ('absent', 5L, TIMESTAMP '2026-01-01 00:00:00') AS t(name, size, mtime)""")
    there = spark.createDataFrame([("young", 5), ("there", 5)], "name string, size long")
    plan = rc.sync_plan(files, there, F.to_timestamp(F.lit("2026-01-01 00:05:00")))
    assert rows(plan, "name", "action") == [("absent", "COPY"), ("there", "CLEAN"), ("young", "SKIP")]
    assert rows(rc.copy_verify(plan, there), "name", "result") == [("absent", "MISMATCH")]


def test_split_and_row_index(spark):
    sources = spark.range(0, 10, 2, 3).select((F.col("id") * 7 % 11).alias("pos"))
    assert [pl.split_group(sources, g, "pos").count() for g in (0, 1, 2)] == [5, 3, 2]
    numbered = with_row_index(sources, [F.col("pos")]).orderBy("pos").select("row_index").collect()
    assert [r[0] for r in numbered] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 2000, 2001])
def test_halves_of_any_size(spark, monkeypatch, n):
    monkeypatch.setattr(pl, "SORTED_AT_MOST", 5)
    sources = spark.range(0, n, 1, 4).select(((F.col("id") * 7919 + 13) % 1_000_003 - 500).alias("pos"))
    values = sorted(r.pos for r in sources.collect())
    halves = [sorted(r.pos for r in pl.split_group(sources, g, "pos").collect()) for g in (1, 2)]
    assert halves == [values[:(n + 1) // 2], values[(n + 1) // 2:]]


def test_halves_with_ties_and_without_positions(spark, monkeypatch):
    monkeypatch.setattr(pl, "SORTED_AT_MOST", 2)
    rows_ = [(5,)] * 30 + [(1,), (9,), (None,), (None,)]
    counted = pl.with_halves(spark.createDataFrame(rows_, "pos long"), "pos").groupBy("pos", "half").count()
    assert rows(counted, "pos", "half", "count") == sorted([(5, 1, 30), (1, 1, 1), (9, 2, 1), (None, 2, 2)], key=repr)
    halves = pl.with_halves(spark.range(100).select("id"), "id")
    plan = halves._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def _report(spark, texts, fmt, folder):
    files = spark.createDataFrame([(f"/f/{i}.json", len(t), t) for i, t in enumerate(texts)], "path string, size long, text string")
    write_schema_report(files, str(folder), "now", fmt)
    return "\n".join(r.value for r in spark.read.text(str(folder), wholetext=True).orderBy(F.input_file_name()).collect())


def test_report_of_files_that_agree(spark, tmp_path):
    out = _report(spark, ['{"a":1}', '{"a":2}', "[]"], "text", tmp_path / "t")
    assert "  Files compared : 2\n" in out and "  Unique keys  : none\n" in out and "  Type conflicts: none  ✓\n" in out
    out = _report(spark, ['{"a":1}', '{"a":2}'], "markdown", tmp_path / "m")
    assert "**Unique keys:**" not in out and "✅ **No type conflicts detected.**" in out


def test_report_of_files_that_differ(spark, tmp_path):
    out = _report(spark, ['{"a":1,"b":1}', '{"a":"x"}'], "text", tmp_path / "t")
    assert "    • b → 0.json\n\n  ⚠  TYPE CONFLICTS:\n    • 'a':\n        0.json: integer\n        1.json: string\n\n====" in out
    out = _report(spark, ['{"b":1}', '{"a":"x"}'], "text", tmp_path / "n")
    assert "  Shared keys  : none\n" in out


def test_report_without_root_objects(spark, tmp_path):
    assert "COMPARISON" not in _report(spark, ["[1]", "{bad"], "text", tmp_path / "t")
    files = spark.createDataFrame([("/f/0.json", 3, "[1]")], "path string, size long, text string")
    write_schema_report(files, str(tmp_path / "j"), "now", "json")
    summary = spark.read.json(str(tmp_path / "j" / "summary")).first()
    assert (summary.files_compared, summary.file_count, summary.note) == (0, 1, "No root-object files to compare.")


def test_api_pages(spark):
    pages = spark.createDataFrame([(1, 40), (3, None)], "page long, items_total long")
    assert rows(api_index.api_failed_pages(pages), "page") == [(2,)]
    assert rows(api_index.api_failed_pages(pages, fixed_total=80), "page") == [(2,), (4,), (5,)]


def test_json_profile(spark):
    texts = ['{"a":1,"b":{"c":[null,"x",2]},"d":null}', '{"a":"t","b":{}}', "[]", "{bad"]
    files = spark.createDataFrame([(f"/f/{i}.json", len(t), t) for i, t in enumerate(texts)], "path string, size long, text string")
    fields = pf.json_field_profile(files).where("path = '/f/0.json'")
    assert rows(fields, "field", "type", "length", "is_uniform", "field_count") == sorted([
        ("$", "object", None, None, 3), ("$.a", "integer", None, None, None), ("$.b", "object", None, None, 1),
        ("$.b.c", "array", 3, False, None), ("$.b.c.[]", "string", 1, None, None), ("$.d", "null", None, None, None)], key=repr)
    shallow = pf.json_field_profile(files, max_depth=1).where("depth = 2")
    assert rows(shallow, "field", "type", "note") == [("$.b.c", "unknown", "max depth reached")]
    assert rows(pf.json_consistency(pf.json_key_sets(files)), "all_keys", "shared_keys", "consistency_pct") == [(3, 2, 66.7)]
    assert rows(pf.json_unshared_keys(files), "key", "path") == [("d", "/f/0.json")]
    assert rows(pf.json_type_conflicts(files), "key", "type") == [("a", "integer"), ("a", "string")]


def test_hot_and_missing_keys_join_whole(spark):
    facts = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 2, F.col("id").cast("string")).alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1), ("2", 2), (None, 3)], "k string, v int")
    assert lookup_join(facts, lookup, ["k"], "inner").count() == 1668
    assert lookup_join(facts, lookup, ["k"], "left_anti").count() == 5000 - 1668
    left = lookup_join(facts, lookup, ["k"], "left")
    assert left.columns == ["k", "id", "v"] and left.count() == 5000 and left.where("v is not null").count() == 1668
    assert "Generate" not in left._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, ["k"], "outer")


def test_archives_split_large_sources_and_posts(spark, tmp_path):
    """A source over several documents reads back whole; its parts are numbered from 0; a post is one record."""
    posts = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit("big").alias("source_slug"), F.lit("d").alias("date_iso"))
    media = spark.range(30).select(
        F.lit("7").alias("post_id"), F.lit("image").alias("media_type"), F.concat(F.lit("u"), "id").alias("url"),
        F.lit(None).cast("string").alias("local_path"))
    sources = spark.createDataFrame(
        [("big", "n", "o", "h", "t"), ("empty", "n", "o", "h", "t")], "slug string, name string, orig_url string, handler string, scraped_at string")
    records = archive_records(posts, media)
    assert records.count() == 50
    for layout in ("lines", "files"):
        path = str(tmp_path / layout)
        write_archives(sources, records, path, ["date_iso"], layout=layout, posts_per_document=8)
        docs = read_archives(spark, path, layout=layout)
        assert rows(docs, "file_slug", "part") == [("big", n) for n in range(7)] + [("empty", 0)]
        assert docs.select(F.max(F.size("posts"))).first()[0] <= 8
        tables = fl.flatten(docs)
        assert fl.upsert_sources(tables.sources).count() == 2
        stored = fl.upsert_posts(tables.posts)
        assert rows(stored.where("has_media = 1"), "id") == [("7",)]
        assert stored.count() == 50
        assert tables.media.select("url").distinct().count() == tables.media.count() == 30


def test_tables_replace_or_append_children(spark, tmp_path):
    docs = documents(spark, {"metadata": {"slug": "s"}, "posts": [
        {"id": "1", "links": [{"url": "a"}]}, {"id": "1", "links": [{"url": "b"}]}, {"id": "2", "links": [{"url": "c"}]}]})
    tables = fl.flatten(docs)
    root = str(tmp_path / "replace")
    assert current_tables(spark, root) is None
    for version in (1, 2):
        assert write_tables(tables, root) == version
    assert rows(current_tables(spark, root)["links"], "url") == [("b",), ("c",)]
    assert current_tables(spark, root)["posts"].count() == 2
    root = str(tmp_path / "append")
    for _ in range(2):
        write_tables(tables, root, children="append")
    assert current_tables(spark, root)["links"].count() == 6


def archive(slug, ids, word, **fields):
    posts = [{"id": str(i), "content": f"{word} {i}", "links": [{"text": word, "url": f"{word}{i}"}], **fields} for i in ids]
    return {"metadata": {"slug": slug, "name": f"{slug} {word}"}, "posts": posts}


def stored_files(root):
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.stat().st_size) for p in root.rglob("*.parquet") if "committed" not in p.parts}


def test_a_load_writes_only_the_buckets_it_touches(spark, tmp_path):
    root = tmp_path / "store"
    every = documents(spark, *[archive(f"s{i}", range(10 * i, 10 * i + 5), "old") for i in range(40)], "{broken")
    assert write_tables(fl.flatten(every, once=True), str(root), buckets=16) == 1
    before, state = stored_files(root), store_state(spark, str(root))
    again = documents(spark, archive("s7", [70, 71, 79], "new"), {"metadata": {"slug": "empty"}, "posts": []})
    assert write_tables(fl.flatten(again, once=True), str(root), buckets=99) == 2
    after, now = stored_files(root), store_state(spark, str(root))
    assert {k: v for k, v in after.items() if k in before} == before and now.buckets == 16
    touched = [b for b in range(16) if now.versions[b] == 2]
    assert 1 <= len(touched) <= 2 and all(now.versions[b] == state.versions[b] for b in range(16) if b not in touched)
    assert {k.split("bucket=")[1].split("/")[0] for k in set(after) - set(before)} == {str(b) for b in touched}
    tables = current_tables(spark, str(root))
    want = [(str(10 * i + j), f"s{i}", "old") for i in range(40) for j in range(5) if (i, j) not in ((7, 0), (7, 1))]
    want += [("70", "s7", "new"), ("71", "s7", "new"), ("79", "s7", "new")]
    posts = tables["posts"].withColumn("word", F.substring_index("content", " ", 1))
    assert rows(posts, "id", "source_slug", "word") == sorted(want, key=repr)
    assert rows(tables["links"], "post_id", "source_slug", "text") == sorted(want, key=repr)
    names = {f"s{i} old" for i in range(40) if i != 7} | {"s7 new", None}
    assert {r.name for r in tables["sources"].collect()} == names and tables["sources"].count() == 41


def test_a_post_that_moves_to_another_source_leaves_the_old_one(spark, tmp_path):
    root = str(tmp_path / "store")
    write_tables(fl.flatten(documents(spark, *[archive(f"s{i}", [i], "old") for i in range(30)]), once=True), root, buckets=64)
    write_tables(fl.flatten(documents(spark, archive("s100", [3, 4], "moved")), once=True), root)
    tables = current_tables(spark, root)
    moved = [r for r in rows(tables["posts"], "id", "source_slug") if r[0] in ("3", "4")]
    assert moved == [("3", "s100"), ("4", "s100")] and tables["posts"].count() == 30 and tables["links"].count() == 30
    touched = store_state(spark, root).versions.count(2)
    assert touched <= 3
    scan = current_tables(spark, root)["posts"]._jdf.queryExecution().toString()
    assert "PartitionFilters" in scan


def test_relations_from_one_parse_are_the_lazy_ones(spark):
    docs = documents(spark, {"metadata": {"slug": "a"}, "posts": [{"text": "no id"}, {"id": "1", "media": [{"type": "image", "url": "u"}]}]},
                     {"metadata": {"slug": "b"}, "scraped_at": "t", "posts": []}, {"posts": None}, "{broken", archive("c", [2, 3], "x"))
    lazy, once = fl.flatten(docs), fl.flatten(docs, once=True)
    for name in ("sources", "posts", "media", "links", "errors"):
        assert rows(getattr(lazy, name), *getattr(lazy, name).columns) == rows(getattr(once, name), *getattr(lazy, name).columns)
    plan = once.media._jdf.queryExecution().toString()
    assert "from_json" not in plan and "parse_json" not in plan


def test_merged_errors_keep_their_order_in_the_archive(spark, tmp_path):
    _, _, _, groups, errors = merged(spark, OLD, NEW)
    posts = mg.merge_posts(groups).drop("source_slug").withColumn("source_slug", F.col("file_slug"))
    records = archive_records(posts, errors=errors.withColumn("pos", F.struct("newer", "part", "post_pos", "pos")))
    sources = spark.createDataFrame([("s0", "n", "o", "h", "t")], "slug string, name string, orig_url string, handler string, scraped_at string")
    write_archives(sources, records, str(tmp_path / "m"), ["first_place"])
    back = fl.explode_posts(read_archives(spark, str(tmp_path / "m"), layout="lines"))
    ordered = fl.flatten_errors(back).orderBy("post_id", "pos").select("post_id", "error").collect()
    assert [tuple(r) for r in ordered] == [("1", "b"), ("1", "c"), ("1", "d")]


def tree_posts(page):
    """Posts by searches in an element tree, as a plain version of the walk."""
    n = 0
    for post in page.find(html.POST):
        heads = [e for e in post.find(html.POST_META_TAG) if e.attrs.get("id", "").startswith(html.POST_META_ID_PREFIX)]
        if not heads:
            continue
        trim = lambda text: text.strip(html.JS_SPACE)
        images = [{"type": "image", "url": e.attrs["src"]} for e in post.find(html.POST_IMAGE) if "src" in e.attrs]
        videos = [{"type": "video", "url": e.attrs.get(html.VIDEO_ATTRIBUTE)} for e in post.find(html.POST_VIDEO)]
        links = [{"text": trim(a.text()), "url": a.attrs.get("href")} for a in post.find(f"{html.POST_BODY} a")]
        more = post.find(html.MORE_LINK)[:1]
        continued = more[0].attrs.get("href") if more and trim(more[0].text()).startswith(html.MORE_TEXT) else None
        content = trim("".join(b.text() for b in post.find(html.POST_BODY)))
        yield (n, *[heads[0].attrs.get(a) for a in html.POST_ATTRIBUTES.values()], content, continued, images + videos, links)
        n += 1


def test_one_walk_finds_what_tree_searches_find():
    rnd = random.Random(4)
    starts = ['<article class="post">', '<div id="arepl-1" data-id="1" data-id="2" data-n>', '<div class="leadtextborder x wordbreak">', "<figure>",
              '<img class="imgfit" src="a&amp;b">', "<img class=imgfit>", '<div class="video-wrapper">', '<b class="fb-video" data-href="v">',
              '<div class="pt-1 clearfix">', '<span class="float-right">', '<a href="/m">', "<a>", "<p>", "<li>", "<ul>", "<table>", "<tr>", "<td>",
              "<script>", "<style>", "<br>", '<p class="wordbreak leadtextborder">']
    texts = [" Folytatódik ", "x &lt; y", "\n", "é", "<!-- c -->", "Folytat", "&nbsp;"]
    ends = ["</article>", "</div>", "</figure>", "</span>", "</a>", "</p>", "</li>", "</ul>", "</table>", "</td>", "</script>", "</style>", "</b>"]
    seen = 0
    for _ in range(1500):
        page = "".join(rnd.choice(rnd.choice([starts, starts, texts, ends])) for _ in range(rnd.randint(0, 60)))
        page = rnd.choice(["", starts[0] + starts[1], starts[0] + starts[1] + starts[2]]) + page
        want = list(tree_posts(parse(page)))
        assert list(html._posts(page)) == want
        seen += len(want)
    assert seen > 300
