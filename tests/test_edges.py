"""Cases that small mistakes in readers, sinks, merges and streams would lose rows on."""

import csv
import json
import tracemalloc

import pytest
from pyspark.sql import functions as F

from sedgemill.operators import api_index as api, feed, flatten as fl, merge as mg, planning as pl
from sedgemill.sinks import current_tables, write_tables
from sedgemill.sinks.archives import archive_records, write_archives
from sedgemill.sources import archive_stream, read_archives, read_feed_responses, read_ledger, read_worklist
from sedgemill.sources.lists import read_failures
from sedgemill.streaming.feed import stored_before, stream_feed_new, upsert_feed_store

SOURCE = "slug string, name string, orig_url string, handler string, scraped_at string"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_a_post_with_many_children_keeps_them_all(spark, tmp_path):
    posts = spark.createDataFrame([("7", "s", "d")], "id string, source_slug string, date_iso string")
    media = spark.range(25).select(F.lit("7").alias("post_id"), F.lit("image").alias("media_type"),
                                   F.concat(F.lit("u"), "id").alias("url"), F.lit(None).cast("string").alias("local_path"))
    links = spark.createDataFrame([("7", "t", "l")], "post_id string, text string, url string")
    sources = spark.createDataFrame([("s", "n", "o", "h", "2026-01-01T00:00:00Z")], SOURCE)
    write_archives(sources, archive_records(posts, media, links), str(tmp_path / "a"), ["date_iso"])
    docs = read_archives(spark, str(tmp_path / "a"), layout="lines")
    write_tables(fl.flatten(docs), str(tmp_path / "t"))
    stored = current_tables(spark, str(tmp_path / "t"))
    assert [stored[k].count() for k in ("media", "links", "posts")] == [25, 1, 1]
    assert stored["posts"].first().has_links == 1
    stats = fl.load_stats(docs, by="file_slug").first()
    assert (stats.posts, stats.media, stats.links) == (1, 25, 1)
    posts = fl.explode_posts(docs)
    groups = mg.merge_groups(posts.drop("media", "links", "download_errors"), posts.drop("media", "links", "download_errors"), mg.slug_match(docs, docs))
    merged = mg.merge_posts(groups)
    assert mg.merge_children(fl.flatten_media(posts), fl.flatten_media(posts), merged).count() == 25
    assert mg.merge_children(fl.flatten_links(posts), fl.flatten_links(posts), merged).count() == 1


def test_archives_below_a_folder_called_media(spark, tmp_path):
    root = tmp_path / "media" / "root"
    write(root / "a b" / "s.json", json.dumps({"metadata": {"slug": "s"}, "posts": []}))
    write(root / "media" / "t.json", json.dumps({"metadata": {"slug": "t"}, "posts": []}))
    slugs = lambda **k: sorted(r.file_slug for r in read_archives(spark, str(root), **k).collect())
    assert slugs() == ["s", "t"]
    assert slugs(prune=("media",)) == ["s"]
    assert sorted(r.file_slug for r in read_archives(spark, f"{tmp_path}/med*/root", prune=("media",)).collect()) == ["s"]


def test_ledgers_of_any_width(spark, tmp_path):
    wide = ",".join(f"c{i}" for i in range(9)) + ",filename\n" + ",".join("x" * 9) + ",v.mp4\n" + ",".join("y" * 9) + ',"a,""b"".mp4"\n'
    paths = [write(tmp_path / "w.csv", wide), write(tmp_path / "n.csv", "2026,w.mp4,3\n2026,filename,4\n2026,note,1\n"),
             write(tmp_path / "e.csv", "timestamp,filename,filesize\n")]
    assert sorted(r.filename for r in read_ledger(spark, paths).collect()) == ['a,"b".mp4', "v.mp4", "w.mp4"]


def test_work_lists_with_columns_in_another_order(spark, tmp_path):
    paths = [write(tmp_path / "a.csv", "page_name,url\np1,u1\n\n"), write(tmp_path / "b.csv", "url,note,page_name\r\nu2,n,p2\r\nu3\r\n")]
    assert sorted(map(tuple, read_worklist(spark, paths).collect())) == [("", "u3"), ("p1", "u1"), ("p2", "u2")]
    with pytest.raises(ValueError, match="page_name"):
        read_worklist(spark, [*paths, write(tmp_path / "c.csv", "url\nu4\n")])


CSV_LISTS = {
    "first": "page_name,url\n,https://a/posts/1\np,https://a/posts/2\n,\n \n\n",
    "quoted": 'url,"page_name"\r\n"https://a/3?x=1,2","a ""b"" c"\r\n"u\r\n4","two\r\nlines"\r\n"",q\r\n',
    "marked": '\ufeffpage_name,url,note\np5,u5\np6,u6,"n\n\nn",more,cells\n"","u7"\n',
    "marked_quoted": '\ufeff"url","page_name"\nu8,"p\n8"\n',
    "bare": "page_name,url",
}
CSV_LEDGERS = {
    "named": "timestamp,filename,filesize\n,x.mp4,3\n2026,,4\n,,\n2026,\"a,\nb.mp4\",1\n",
    "plain": "2026,y.mp4,3\n,z.mp4,3\n2026,note.txt\nalone\n",
    "wide": "filename,a,b\nq.bin,1,2\n,1,2\n",
}


def test_lists_are_read_as_the_csv_module_reads_them(spark, tmp_path):
    for name, text in {**CSV_LISTS, **CSV_LEDGERS}.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    records = lambda name: list(csv.reader(open(tmp_path / f"{name}.csv", newline="", encoding="utf-8-sig")))
    want = []
    for name in CSV_LISTS:
        rows = csv.DictReader(open(tmp_path / f"{name}.csv", newline="", encoding="utf-8-sig"))
        want += [((r["page_name"] or "").strip(), (r["url"] or "").strip()) for r in rows]
    got = [r for n in CSV_LISTS for r in map(tuple, read_worklist(spark, str(tmp_path / f"{n}.csv")).collect())]
    assert sorted(c.replace("\r\n", "\n") for r in got for c in r) == sorted(c.replace("\r\n", "\n") for r in want for c in r)
    assert len(got) == len(want)
    together = read_worklist(spark, [str(tmp_path / f"{n}.csv") for n in CSV_LISTS])
    assert sorted(map(tuple, together.collect())) == sorted(got)
    urls = {u for _, u in got if u}
    assert {r.url for r in read_failures(spark, [str(tmp_path / f"{n}.csv") for n in CSV_LISTS]).collect()} == urls
    names = set()
    for name in CSV_LEDGERS:
        first, *rest = records(name)
        if "filename" in first:
            names |= {r[first.index("filename")] for r in rest if len(r) > first.index("filename")}
        else:
            names |= {r[1] for r in [first, *rest] if len(r) > 1 and r[1].endswith(".mp4")}
    got = read_ledger(spark, [str(tmp_path / f"{n}.csv") for n in CSV_LEDGERS]).collect()
    assert sorted(r.filename for r in got) == sorted(names - {""})


def test_index_without_items_or_without_its_first_page(spark):
    pages = lambda rows: spark.createDataFrame(rows, "page long, items_total long")
    assert api.expected_pages(pages([(1, 0)])).count() == 0 and api.api_failed_pages(pages([(1, 0)])).count() == 0
    missing = [r.page for r in api.api_failed_pages(pages([(2, None)]), default_total=50).collect()]
    assert sorted(missing) == [1, 3]
    assert api.expected_pages(pages([(3, None)])).count() == 286


def test_retry_is_named_after_the_first_post_of_all_parts(spark):
    text = "ERROR: This video is only available for registered users"
    errors = spark.createDataFrame([("f", 1, 0, "B0", "u", text), ("f", 0, 3, "A1", "u", text)],
                                   "file string, part long, post_pos int, post_id string, url string, error string")
    assert [r.filename for r in pl.retry_candidates(errors).collect()] == ["A1_video.mp4"]


def test_errors_are_nested_in_the_order_of_attempts(spark):
    posts = spark.createDataFrame([("1", [("a", "x")]), ("2", None)], "id string, download_errors array<struct<url:string,error:string>>")
    outcomes = spark.createDataFrame([("1", 2, "c", "z"), ("1", 1, "b", "y"), ("1", 3, "d", None)], "post_id string, seq int, url string, error string")
    got = {r.id: [tuple(e) for e in r.download_errors] for r in pl.attach_download_errors(posts, outcomes).collect()}
    assert got == {"1": [("a", "x"), ("b", "y"), ("c", "z")], "2": []}


def snapshots(spark, tmp_path, old, new):
    docs = []
    for n, posts in enumerate((old, new)):
        text = json.dumps({"metadata": {"slug": "s"}, "scraped_at": f"2026-0{n + 1}-01T00:00:00Z", "posts": posts})
        docs.append(read_archives(spark, write(tmp_path / str(n) / "s.json", text)))
    posts = [fl.explode_posts(d) for d in docs]
    flat = [p.drop("media", "links", "download_errors") for p in posts]
    matches = mg.slug_match(*docs)
    return posts, mg.merge_groups(*flat, matches), matches


def test_merged_posts_keep_their_error_flag_and_new_only_errors(spark, tmp_path):
    error = [{"url": "u", "error": "e"}]
    posts, groups, matches = snapshots(
        spark, tmp_path, [{"id": "1", "download_errors": error}, {"id": "2"}], [{"id": "1"}, {"id": "2"}, {"id": "3", "download_errors": error}])
    flags = {r.id: r.has_errors for r in mg.merge_posts(groups, keep_new_only=True).collect()}
    assert flags == {"1": 1, "2": 0, "3": 1}
    errors = [fl.flatten_errors(p) for p in posts]
    ids = lambda **k: sorted(r.post_id for r in mg.merge_errors(*errors, groups, matches, **k).collect())
    assert ids() == ["1"] and ids(keep_new_only=True) == ["1", "3"]


def body(*stories):
    def media(n):
        return {"styles": {"attachment": {"media": {"__typename": "Photo", "id": n, "image": {"uri": f"http://x/{n}"}}}}}

    lines = []
    for n, (pid, text, m) in enumerate(stories):
        story = {"id": pid, "creation_time": 5, "message": {"text": text}, "attachments": [media(m)]}
        edge = {"node": {"__typename": "Story", "comet_sections": {"content": {"story": story}}}}
        lines.append(f"{n}:" + json.dumps({"data": {"node": {"timeline_list_feed_units": {"edges": [edge]}}}}))
    return "for (;;);" + "\n".join(lines)


def test_stream_keeps_media_of_the_first_arrival_only(spark, tmp_path):
    schema = "response_id long, page string, body string"
    responses = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    row = lambda n, *s: json.dumps({"response_id": n, "page": "p", "body": body(*s)})
    write(tmp_path / "in" / "1.json", row(1, ("a", "first", "m1"), ("a", "again", "m2"), ("b", "other", "m3")))
    target, mark = str(tmp_path / "store"), str(tmp_path / "mark")
    upsert_feed_store(responses(), target, mark).awaitTermination()
    write(tmp_path / "in" / "2.json", row(2, ("a", "late", "m4"), ("c", "new", "m5")))
    upsert_feed_store(responses(), target, mark).awaitTermination()
    posts = {r.id: r.text for r in spark.read.parquet(f"{target}/posts").collect()}
    media = {r.id: r.post_id for r in spark.read.parquet(f"{target}/media").collect()}
    assert posts == {"a": "first", "b": "other", "c": "new"} and media == {"img_m1": "a", "img_m3": "b", "img_m5": "c"}
    known = stored_before(spark, f"{target}/posts", 2, [0, 1])
    assert "PartitionFilters" in known._jdf.queryExecution().toString()
    buckets = lambda b: {r.id for r in stored_before(spark, f"{target}/posts", 2, b).collect()}
    assert buckets(list(range(32))) == {"a", "b", "c"} and buckets([]) == set()
    assert {r.id for r in stored_before(spark, f"{target}/posts", 1, list(range(32))).collect()} == {"a", "b"}
    assert sorted(b for i in "abc" for b in range(32) if i in buckets([b])) == sorted(
        r.b for r in spark.sql("SELECT pmod(xxhash64(id), 32) AS b FROM VALUES ('a'), ('b'), ('c') AS t(id)").collect())


def test_files_are_walked_as_streams_to_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive_stream, "PART_POSTS", 3)
    monkeypatch.setattr(archive_stream, "CHUNK", 16)
    posts = [{"id": str(i), "content": 'a } { ] "quoted" \\ \n é' * (i % 4), "media": [{"type": "image", "url": f"u{i}{j}"} for j in range(i % 3)],
              "n": 1.50} for i in range(20)]
    texts = {
        "plain": json.dumps({"metadata": {"slug": "p", "name": "N"}, "scraped_at": "t", "posts": posts}),
        "late": json.dumps({"posts": posts[:7], "metadata": {"slug": "l"}, "part": 2}, indent=1, ensure_ascii=False) + "\n \n",
        "none": '{"metadata": {"slug": "n"}, "posts": null}', "empty": '{"posts": [ ], "scraped_at": "}"}', "bare": "{}", "blank": "",
        "open": json.dumps({"metadata": {"slug": "o"}, "posts": posts})[:-1], "cut": json.dumps({"posts": posts})[:-40],
        "list": "[1]", "text": '{"posts": "x"}', "behind": '{"posts": []} x', "twice": '{"posts": [{"id": "no"}], "posts": [{"id": "yes"}]}',
        "control": '{"posts": [{"id": "a\nb"}]}', "word": "}", "numbers": '{"posts": [{"id": 12345678901234567890}, {"id": 1.50}, null, "x", 7]}',
    }
    for name, text in texts.items():
        write(tmp_path / "in" / f"{name}.json", text)
    whole, parts = (read_archives(spark, str(tmp_path / "in"), layout=layout) for layout in ("files", "stream"))
    said = lambda docs: sorted((tuple(r) for r in docs.groupBy("file_slug", "error").agg(
        F.sum(F.coalesce(F.size("posts"), F.lit(0)))).collect()), key=str)
    assert said(whole) == said(parts) and parts.where("file_slug = 'plain'").count() == 7
    for once in (False, True):
        one, two = fl.flatten(whole, once=once), fl.flatten(parts, once=once)
        for name in ("sources", "posts", "media", "links", "errors"):
            a, b = (sorted(map(str, getattr(t, name).collect())) for t in (one, two))
            assert a == b and (a or name in ("links", "errors"))
    assert sorted(map(str, fl.load_stats(whole).collect())) == sorted(map(str, fl.load_stats(parts).collect()))


def test_documents_of_a_bundle_are_those_of_separate_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive_stream, "PART_POSTS", 3)
    monkeypatch.setattr(archive_stream, "CHUNK", 16)
    posts = [{"id": str(i), "content": 'a } { ] "quoted" \\ \n \u00e9' * (i % 4), "media": [{"type": "image", "url": f"u{i}"}], "n": 1.50} for i in range(20)]
    documents = [
        json.dumps({"metadata": {"slug": "plain", "name": "N"}, "scraped_at": "t", "posts": posts}),
        json.dumps({"posts": posts[:7], "metadata": {"slug": "late"}, "part": 2}, indent=1, ensure_ascii=False),
        '{"metadata": {"slug": "none"}, "posts": null}', '{"metadata": {"slug": "empty"}, "posts": [ ], "scraped_at": "}"}', "{}",
        '{"metadata": {"slug": "text"}, "posts": "x"}', '{"metadata": {"slug": "twice"}, "posts": [{"id": "no"}], "posts": [{"id": "yes"}]}',
        json.dumps({"metadata": {"slug": "last"}, "posts": posts[:3]}),
    ]
    said = lambda docs: sorted((tuple(r) for r in docs.groupBy("file_slug", "error").agg(
        F.sum(F.coalesce(F.size("posts"), F.lit(0)))).collect()), key=str)
    content = lambda docs: sorted(map(str, fl.explode_posts(docs).drop("path").collect()))
    for n, text in enumerate(documents):
        write(tmp_path / "files" / f"part-{n:05d}-00000000-0000-0000-0000-000000000000.json", text)
    files = read_archives(spark, str(tmp_path / "files"))
    for name, between in (("lines", "\n"), ("close", ""), ("spaced", " \n\t\n ")):
        write(tmp_path / name / "some name.json", between.join(documents) + between)
        write(tmp_path / name / "blank.json", " \n ")
        bundle = read_archives(spark, str(tmp_path / name), layout="bundles")
        assert said(bundle) == said(files) and content(bundle) == content(files)
    # What stands behind a fault is one unreadable document; those before it hold, and other files too.
    write(tmp_path / "cut" / "a.json", documents[0] + "\n" + documents[1][:-40] + "\n" + documents[7])
    write(tmp_path / "cut" / "b.json", documents[7] + "x")
    cut = read_archives(spark, str(tmp_path / "cut"), layout="bundles")
    bad = "not a JSON object with a list of posts"
    assert said(cut) == sorted([("plain", None, 20), ("last", None, 3), (None, bad, 0)], key=str)
    assert cut.where("error IS NOT NULL").count() == 2


def test_one_document_per_source_of_any_size(spark, tmp_path):
    posts = spark.range(3000).select(F.col("id").cast("string"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source_slug"),
                                     F.lpad(F.pmod(F.col("id") * 7919, F.lit(3000)).cast("string"), 5, "0").alias("date_iso"), F.lit('a "q"\n} é').alias("content"))
    slugs = [*{r.source_slug for r in posts.collect()}, "empty"]
    sources = spark.createDataFrame([(s, f"n {s}", None, "h", "2026-01-01T00:00:00Z") for s in slugs], SOURCE)
    write_archives(sources, archive_records(posts), str(tmp_path / "w"), ["date_iso"], layout="whole")
    files = sorted((tmp_path / "w").rglob("*.txt"))
    assert len(files) == len(slugs)
    found = [json.loads(f.read_text()) for f in files]
    big = next(d for d in found if d["metadata"]["slug"] == "big")
    dates = [p["date_iso"] for p in big["posts"]]
    assert len(dates) == 1000 and dates == sorted(dates) and big["posts"][0]["content"] == 'a "q"\n} é' and big["posts"][0]["links"] == []
    assert next(d for d in found if d["metadata"]["slug"] == "empty")["posts"] == [] and sum(len(d["posts"]) for d in found) == 3000
    docs = read_archives(spark, str(tmp_path / "w"), layout="stream", pattern="*.txt")
    assert sorted(r.slug for r in fl.flatten_sources(docs).collect()) == sorted(slugs)
    assert fl.flatten_posts(fl.explode_posts(docs)).where("source_slug = 'big'").count() == 1000


def test_a_walk_holds_one_part_only():
    post = json.dumps({"id": "1", "content": "x" * 300, "media": [{"url": "u}"}] * 3})

    def pieces():
        yield '{"metadata": {"slug": "s"}, "posts": ['
        for _ in range(60000):
            yield from (p + "}" for p in (post + ",").split("}")[:-1])
            yield ","
        yield post + "]}"

    tracemalloc.start()
    found = sum(posts.count('"id"') for _, _, posts, _ in archive_stream.walk(pieces()) if posts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 60001 and peak < 4 << 20


def feed_file(path, n, arrived, *stories):
    rows = {"response_id": n, "page": "p", "url": "/graphql", "body": body(*stories), "arrived": arrived}
    return write(path, json.dumps(rows))


def test_new_posts_of_a_stream_are_first_arrivals(spark, tmp_path):
    store = spark.createDataFrame([("p", "z")], "page string, id string")
    folder, target, mark = tmp_path / "in", str(tmp_path / "new"), str(tmp_path / "mark")
    run = lambda: stream_feed_new(
        read_feed_responses(spark, str(folder), stream=True, max_files=2), store, target, mark).awaitTermination()
    found = lambda: sorted((r.pid, r.text, r.response_id) for r in spark.read.parquet(target).collect())
    feed_file(folder / "1.json", 5, "2026-01-01T10:00:00Z", ("a", "later", "m1"), ("a", "again", "m2"), ("z", "stored", "m3"))
    feed_file(folder / "2.json", 3, "2026-01-01T10:00:00Z", ("a", "first", "m4"), ("b", "b", "m5"))
    run()
    assert found() == [("a", "first", 3), ("b", "b", 3)]
    feed_file(folder / "3.json", 1, "2026-01-01T11:00:00Z", ("a", "earlier number, later batch", "m6"), ("c", "c", "m7"))
    run()
    want = [("a", "first", 3), ("b", "b", 3), ("c", "c", 1)]
    assert found() == want
    # The last batch ended before its commit was noted: it runs again and gives the same.
    commits = sorted((tmp_path / "mark" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (tmp_path / "mark" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    run()
    assert found() == want


def test_bounded_stream_forgets_ids(spark, tmp_path):
    store = spark.createDataFrame([], "page string, id string")
    folder, target, mark = tmp_path / "in", str(tmp_path / "new"), str(tmp_path / "mark")

    def run():
        query = stream_feed_new(read_feed_responses(spark, str(folder), stream=True), store, target, mark, within="1 hour")
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    found = lambda: sorted((r.pid, r.text) for r in spark.read.parquet(target).collect())
    feed_file(folder / "1.json", 2, "2026-01-01T10:00:00Z", *[(f"a{i}", "x", f"m{i}") for i in range(20)])
    full = run()
    feed_file(folder / "2.json", 3, "2026-01-01T10:30:00Z", ("a1", "repeat", "m"), ("b", "b", "n"))
    run()
    assert found() == sorted([(f"a{i}", "x") for i in range(20)] + [("b", "b")])
    feed_file(folder / "3.json", 4, "2026-01-01T15:00:00Z", ("c", "c", "o"))
    left = run()
    assert left < full
    feed_file(folder / "4.json", 5, "2026-01-01T15:01:00Z", ("a1", "after its time", "p"))
    feed_file(folder / "5.json", 6, "2026-01-01T10:05:00Z", ("d", "late", "q"))
    run()
    assert [r for r in found() if r[0] in ("a1", "d")] == [("a1", "after its time"), ("a1", "x")]


def test_arrival_is_the_time_of_the_file_where_none_is_given(spark, tmp_path):
    path = write(tmp_path / "1.json", json.dumps({"response_id": 1, "page": "p", "url": "/graphql", "body": "x"}))
    row = read_feed_responses(spark, path).select(F.unix_seconds("arrived").alias("at")).first()
    assert abs(row["at"] - (tmp_path / "1.json").stat().st_mtime) < 2
