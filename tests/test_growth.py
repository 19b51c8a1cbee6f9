"""Steps whose work has to grow no faster than their input."""

from pathlib import Path

from pyspark.sql import functions as F

from sedgemill.operators import api_index as api, flatten as fl, merge as mg
from sedgemill.plans import archive_queries, html_queries, merge_queries, render
from sedgemill.sinks import archives as sink, tables as store
from sedgemill.sinks.archives import archive_records, write_archives
from sedgemill.sources import read_archives

POST = "id string, source_slug string, date_iso string, content string"
SOURCE = "slug string, name string, orig_url string, handler string, scraped_at string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def make_sources(spark, *slugs):
    return spark.createDataFrame([(s, "n", "u", "h", "t") for s in slugs], SOURCE)


def test_lists_of_posts_are_nested_without_a_shuffle_of_all_kinds(spark):
    posts = spark.createDataFrame([("1", "a", "d", "x"), (None, "a", "d", "y"), (None, "b", "d", "z"), ("2", "b", "d", "w")], POST)
    media = spark.createDataFrame([("1", "image", "u2", "l"), ("1", "image", "u1", "l"), (None, "image", "no", "l")],
                                  "post_id string, media_type string, url string, local_path string")
    errors = spark.createDataFrame([("2", "u", "e")], "post_id string, url string, error string")
    records = archive_records(posts, media, None, errors)
    assert "Union" not in plan_of(records)
    found = {r.content: ([m.url for m in r.media], len(r.links), [e.error for e in r.download_errors]) for r in records.collect()}
    assert found == {"x": (["u1", "u2"], 0, []), "y": ([], 0, []), "z": ([], 0, []), "w": ([], 0, ["e"])}


def test_posts_of_small_sources_are_not_sorted_and_numbered(spark, tmp_path, monkeypatch):
    rows = [(str(i), s, f"2026-01-{28 - i:02d}", f"{s}{i}") for s, n in (("a", 3), ("b", 7), (None, 2)) for i in range(n)]
    records = archive_records(spark.createDataFrame(rows, POST))
    sources = make_sources(spark, "a", "b", "c")

    def listed(name, size):
        write_archives(sources, records, str(tmp_path / name), ["date_iso"], posts_per_document=size, compression="gzip")
        docs = read_archives(spark, str(tmp_path / name), layout="lines")
        posts = fl.explode_posts(docs).orderBy("file_slug", "part", "post_pos").collect()
        parts = docs.groupBy("file_slug").agg(F.count("*").alias("n")).collect()
        return [(p.file_slug, p.part, p.id) for p in posts], {p.file_slug: p.n for p in parts}

    numbered = []
    real = sink.with_row_index
    monkeypatch.setattr(sink, "with_row_index", lambda df, *rest: numbered.append({r[0] for r in df.select("_slug").collect()}) or real(df, *rest))
    posts, parts = listed("whole", 7)
    assert numbered == [] and parts == {"a": 1, "b": 1, "c": 1}
    assert posts == [("a", 0, str(i)) for i in (2, 1, 0)] + [("b", 0, str(i)) for i in range(6, -1, -1)]
    posts, parts = listed("parts", 3)
    assert numbered == [{"b"}] and parts == {"a": 1, "b": 3, "c": 1}
    assert posts == [("a", 0, str(i)) for i in (2, 1, 0)] + [("b", (6 - i) // 3, str(i)) for i in range(6, -1, -1)]


def test_keys_of_the_index_do_not_pass_through_the_driver(spark):
    items = spark.createDataFrame([(1, 0, "a", "u"), (1, 1, "b", "u"), (1, 2, "c", None), (2, 0, "d", "u")], "page long, pos int, slug string, download_url string")
    archives = spark.createDataFrame([("a.zip", 1), ("b.zip", 0)], "name string, size int")
    pending = api.docs_pending(items, archives)
    outcomes = api.docs_outcomes(items, pending, pending.select("page", "pos", (F.col("slug") == "b").alias("ok")))
    assert "Broadcast" not in plan_of(outcomes)
    assert {(r.slug, r.ok) for r in outcomes.collect()} == {("a", True), ("b", True), ("c", True), ("d", False)}


def test_winners_of_a_load_do_not_pass_through_the_driver(spark, tmp_path, monkeypatch):
    write_archives(make_sources(spark, "a"), archive_records(spark.createDataFrame([("1", "a", "d", "x"), ("2", "a", "d", "y")], POST)),
                   str(tmp_path / "in"), ["date_iso"])
    plans, real = [], store.lookup_join

    def spied(*given):
        joined = real(*given)
        plans.append(plan_of(joined))
        return joined

    monkeypatch.setattr(store, "lookup_join", spied)
    docs = read_archives(spark, str(tmp_path / "in"), layout="lines")
    for _ in range(2):
        store.write_tables(fl.flatten(docs, once=True), str(tmp_path / "t"), buckets=2)
    assert len(plans) == 16 and not [p for p in plans if "Broadcast" in p]
    assert store.current_tables(spark, str(tmp_path / "t"))["posts"].count() == 2


def test_feed_pages_are_shuffled_once(spark, tmp_path):
    spark.sql("""SELECT id AS o_orderkey, id % 3 AS o_custkey, 'O' AS o_orderstatus, DATE'1996-01-02' AS o_orderdate, '1-URGENT' AS o_orderpriority
                 FROM range(1, 45)""").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT id AS l_orderkey, 1 AS l_partkey, 2 AS l_suppkey, 1 AS l_linenumber FROM range(1, 45)").write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("customer", "events", "documents", "pages"):
        spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    plan = plan_of(html_queries._post_pages(spark, str(tmp_path)))
    # The list of a page is begun behind its one shuffle, so above it in the plan.
    assert plan.count("hashpartitioning(page_no") == 1 and plan.index("partial_collect_list") < plan.index("hashpartitioning(page_no")
    pages = html_queries.post_pages(spark, str(tmp_path))
    assert pages.count() == 3
    assert html_queries.posts(spark, str(tmp_path)).count() == 44


def test_tasks_that_nest_posts_grow_with_the_posts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sedgemill.operators.shuffles.TASK_BYTES", 2_000)
    posts = spark.createDataFrame([(str(i), f"s{i % 40}", f"d{i:03d}", "x" * 100) for i in range(200)], POST)
    slugs = [f"s{i}" for i in range(41)]
    write_archives(make_sources(spark, *slugs), archive_records(posts), str(tmp_path / "in"), ["date_iso"])
    # 110 tasks, however few Spark is set to: about as many hold one of 41 sources.
    assert len(list((tmp_path / "in").glob("part-*.json"))) > 20
    docs = read_archives(spark, str(tmp_path / "in"), layout="lines")
    found = {s: [p.id for p in fl.explode_posts(docs).where(F.col("file_slug") == s).orderBy("post_pos").collect()] for s in ("s0", "s7", "s40")}
    assert docs.count() == 41 and found == {"s0": ["0", "40", "80", "120", "160"], "s7": ["7", "47", "87", "127", "167"], "s40": []}


def test_children_are_matched_as_one_list_per_post(spark, tmp_path):
    media = spark.createDataFrame([(str(i), "image", f"u{i}{j}", f" l{j} ") for i in range(1, 5) for j in range(3)],
                                  "post_id string, media_type string, url string, local_path string")
    errors = media.select("post_id", "url", F.lit("e").alias("error"))
    read = {}
    for side, ids in (("old", "123"), ("new", "234")):
        posts = spark.createDataFrame([(i, "a", "d" + i, side) for i in ids], POST)
        write_archives(make_sources(spark, "a"), archive_records(posts, media, None, errors), str(tmp_path / side), ["date_iso"])
        read[side] = read_archives(spark, str(tmp_path / side), layout="lines")
    rows = fl.explode_posts(read["old"])
    lists = fl.list_rows(rows, "media", fl.MEDIA_FIELDS)
    assert lists.count() == 3
    given = fl.flatten_media(rows)
    assert fl.explode_lists(lists).select(*given.columns).exceptAll(given).isEmpty() and fl.explode_lists(lists).count() == given.count() == 9
    sides = merge_queries.Sides(read["old"], read["new"])
    for found in (sides.children("media", fl.MEDIA_FIELDS), sides.errors()):
        plan = plan_of(found)
        assert plan.index("posexplode(items") < plan.index("Join")  # opened behind the joins, so above them in the plan
    kept = sorted((r.post_id, r.side, r.pos) for r in sides.children("media", fl.MEDIA_FIELDS).collect())
    assert kept == [(p, s, n) for p, s in (("1", "old"), ("2", "new"), ("3", "new")) for n in range(3)]
    gone = mg.old_only_posts(mg.sample_fields(sides.old), mg.sample_fields(sides.new), sides.groups(False), sides.matches)
    assert "media" not in gone.columns
    assert {(r.id, r.media_count, r.links_count) for r in mg.old_only_sample(gone).collect()} == {("1", 3, 0)}


def test_posts_travel_as_text_and_come_back_as_they_were(spark):
    item = "array<struct<type:string,url:string>>"
    rows = [("a", ("x" * 9, None, (1, 2), [("t", 'q"\n\u00e9\U0001f600\\'), (None, None), None])), ("a", (None, "", (None, 3), [])), ("b", None), ("b", ("1", "{}", None, None))]
    df = spark.createDataFrame(rows, f"slug string, _post struct<id:string,content:string,first_place:struct<part:bigint,post_pos:int>,media:{item}>")
    moved = sink._shuffled(df, "_post", 3, ["slug"])
    above, below = plan_of(moved).split("Exchange", 1)  # what runs before the shuffle stands below it
    assert "from_json" in above and "StructsToJson" in below
    assert moved.rdd.getNumPartitions() == 3 and moved.schema["_post"].dataType == df.schema["_post"].dataType
    assert sorted(map(repr, moved.collect())) == sorted(map(repr, df.collect()))
    # What JSON could round stays a struct.
    timed = spark.sql("SELECT 'a' AS slug, named_struct('at', TIMESTAMP'2026-01-01 00:00:00.123456', 'd', 0.1D) AS _post")
    assert "json" not in plan_of(sink._shuffled(timed, "_post", 3, ["slug"])).lower()


def test_loads_move_only_what_they_return(spark):
    rows = [("1", "first", "/x/a/b", 0, 0), ("1", "last", "/x/a-b/c", 0, 0), ("2", "p1", "/x/a", 1, 0), ("2", "p0", "/x/a", 0, 7), ("3", "deep", "/x/a/b/c", 0, 0), ("3", "flat", "/x/a/b", 5, 0)]
    posts = spark.createDataFrame(rows, "id string, content string, path string, part bigint, post_pos int").withColumn("file_slug", F.col("path"))
    kept = fl.upsert_posts(posts)
    assert kept.columns == ["id", "content"] and "file_slug" not in plan_of(kept)
    # Files follow each other by the parts of their paths: a-b comes after a, with all below a.
    assert {r.id: r.content for r in kept.collect()} == {"1": "last", "2": "p1", "3": "deep"}


def test_groups_of_a_merge_hold_only_wanted_fields(spark, tmp_path):
    read = {}
    for side in ("old", "new"):
        write_archives(make_sources(spark, "a"), archive_records(spark.createDataFrame([("1", "a", "d", side)], POST)), str(tmp_path / side), ["date_iso"])
        read[side] = read_archives(spark, str(tmp_path / side), layout="lines")
    sides = merge_queries.Sides(read["old"], read["new"])
    groups = sides.groups(fields=["content"])
    assert set(groups.schema["old"].dataType.names) == {"content", "part", "post_pos", "side"}
    assert [(r.id, r.content, r.side) for r in mg.merge_posts(groups).collect()] == [("1", "new", "new")]


def test_streamed_archives_do_not_take_a_file_per_source(spark, tmp_path):
    days = "date_add(DATE'1996-01-01', CAST(id % 900 AS INT))"
    spark.sql(f"""SELECT id AS o_orderkey, id % 300 AS o_custkey, 'O' AS o_orderstatus, {days} AS o_orderdate, '1-URGENT' AS o_orderpriority
                  FROM range(1, 2000)""").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT id AS l_orderkey, 1 AS l_partkey, 2 AS l_suppkey, 1 AS l_linenumber FROM range(1, 2000)").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT id AS c_custkey, 'n' AS c_name FROM range(300)").write.parquet(str(tmp_path / "customer.parquet"))
    spark.sql("SELECT id AS page_id, '<p>' AS html FROM range(1)").write.parquet(str(tmp_path / "pages.parquet"))
    for name in ("events", "documents"):
        spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    listed = archive_queries.read_archives_stream_query(spark, str(tmp_path))
    found = {r.file_slug: (r.failed, r.listed_posts) for r in listed.collect()}
    want = {f"page{s}": (False, sum(1 + (p % 8 == 0) for p in range(1, 2000) if p % 300 == s)) for s in range(300)}
    want |= {f"page{900_000_000 + s}": (False, 0) for s in range(0, 300, 10)}
    assert found == want | {"broken": (True, 0)}
    # 330 sources: as many files as tasks, not as sources; none is walked twice.
    files = list(Path(render.archive_bundles(spark, str(tmp_path))).glob("*.json"))
    assert 2 <= len(files) <= 2 * 4 + 1
    assert "MapInArrow" not in plan_of(listed)
