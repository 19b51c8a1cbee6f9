"""A folder and a file per source: written, listed and read without a process or a task for each."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from sedgemill.operators import flatten as fl
from sedgemill.plans import archive_queries, reconcile_queries
from sedgemill.sinks.archives import archive_records, write_archives
from sedgemill.sinks import folders
from sedgemill.sources import archive_stream, many_files, read_archives, read_file_inventory

SOURCE = "slug string, name string, orig_url string, handler string, scraped_at string"


def tasks_of(spark, work):
    """What ``work`` returns, and the tasks of each stage it ran."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        result = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return result, [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]


def make_tables(spark, root, sources):
    """Two posts and two media a source; posts of which the number is a multiple of 9 have no files."""
    to = lambda name: str(root / f"{name}.parquet")
    spark.range(sources).selectExpr("id AS c_custkey", "'n' AS c_name").write.parquet(to("customer"))
    spark.range(2 * sources).selectExpr("id AS o_orderkey", f"id % {sources} AS o_custkey", "'O' AS o_orderstatus", "DATE'1996-01-01' AS o_orderdate",
                                        "'1-URGENT' AS o_orderpriority").write.parquet(to("orders"))
    spark.range(2 * sources).selectExpr("id AS l_orderkey", "id AS l_partkey", "1 AS l_suppkey", "1 AS l_linenumber").write.parquet(to("lineitem"))
    spark.sql("SELECT id AS page_id, '<p>' AS html FROM range(1)").write.parquet(to("pages"))
    for name in ("events", "documents"):
        spark.range(1).write.parquet(to(name))
    return str(root)


def files_below(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file())


def test_folders_are_laid_out_as_by_sparks_writer(spark, tmp_path):
    slugs = ["a", "b", "é 日本", "x=1/2%\"'#:?\\{[]^*\n", "", None, "a.b ~!<>|"]
    rows = spark.createDataFrame([(s, n, None, [{"v": f"é{n}"}]) for s in slugs for n in range(2)],
                                 "slug string, n int, gone string, items array<struct<v:string>>")
    said = lambda root: sorted(
        (p.parent.name, p.name.split(".", 1)[1], p.read_text()) for p in root.rglob("part-*"))
    one = rows.repartition(1).sortWithinPartitions("slug", "n")
    one.write.partitionBy("slug").option("maxRecordsPerFile", 1).json(str(tmp_path / "spark"))
    folders.write_folders(one, "slug", str(tmp_path / "own"), "json", alone=True)
    assert said(tmp_path / "own") == said(tmp_path / "spark") and len(said(tmp_path / "own")) == 14
    lines = one.select("slug", F.concat(F.lit("l"), F.col("n").cast("string")).alias("value"))
    lines.where("slug <> ''").write.partitionBy("slug").text(str(tmp_path / "spark lines"))
    folders.write_folders(lines.where("slug <> ''"), "slug", f"file://{tmp_path}/own lines", "text")
    assert said(tmp_path / "own lines") == said(tmp_path / "spark lines") and len(said(tmp_path / "own lines")) == 5
    # Plain files, no checksum beside each.
    assert not list((tmp_path / "own").rglob("*part-*.crc")) and (tmp_path / "own" / "_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        folders.write_folders(one, "slug", str(tmp_path / "own"), "json", alone=True)


def test_folders_appear_as_a_whole_or_not_at_all(spark, tmp_path):
    bad = spark.range(40).select(F.concat(F.lit("s"), "id").alias("slug"), F.expr("CASE WHEN id = 33 THEN raise_error('no') ELSE 'x' END").cast("string").alias("value"))
    with pytest.raises(Exception, match="no"):
        folders.write_folders(bad, "slug", str(tmp_path / "out"), "text")
    assert list(tmp_path.iterdir()) == []
    folders.write_folders(bad.limit(0), "slug", str(tmp_path / "out"), "text")
    assert files_below(tmp_path / "out") in (["_SUCCESS"], ["._SUCCESS.crc", "_SUCCESS"])


def test_files_of_a_key_are_numbered_within_a_task(spark, tmp_path):
    """Also where its rows come apart: a task that runs again gives the same names."""
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "slug string, value string").coalesce(1)
    twice = rows.unionByName(rows.where("slug = 'b'")).coalesce(1)
    folders.write_folders(twice, "slug", str(tmp_path / "out"), "text", alone=True)
    found = {(p.parent.name, p.name.split(".")[1]): p.read_text() for p in (tmp_path / "out").rglob("part-*")}
    assert found == {("slug=a", "c000"): "1\n", ("slug=a", "c001"): "2\n", ("slug=b", "c000"): "3\n", ("slug=b", "c001"): "3\n"}


def test_media_of_a_folder_per_source(spark, tmp_path):
    root = make_tables(spark, tmp_path, 150)
    missing, tasks = tasks_of(spark, lambda: reconcile_queries.missing_document_media_query(spark, root))
    # 150 folders: no stage has a task for each of them.
    assert tasks and max(tasks) <= many_files.ROUNDS ** 2 * 4
    found = sorted((r.slug, r.post_id, r.local_path) for r in missing.collect())
    want = []
    for p in range(0, 300, 9):
        slug = f"folder=page{p % 150}" if p % 150 % 3 == 0 else f"page{p % 150}"
        want.append((slug, str(p), f"/archive/data/{slug}/media/{p}_{p}_1.jpg"))
    assert found == sorted(want)


def test_archives_in_a_file_per_source(spark, tmp_path):
    root = make_tables(spark, tmp_path, 150)
    listed, tasks = tasks_of(spark, lambda: archive_queries.read_archives_query(spark, root))
    assert tasks and max(tasks) <= many_files.ROUNDS ** 2 * 4
    found = {r.file_slug: (r.failed, r.listed_posts) for r in listed.collect()}
    posts = lambda s: sum(1 + (p % 8 == 0) for p in (s, s + 150))
    want = {f"page{s}": (False, posts(s)) for s in range(150)} | {f"page{900_000_000 + s}": (False, 0) for s in range(0, 150, 10)}
    assert found == want | {"broken": (True, 0)}


def test_files_of_a_source_are_plain_files(spark, tmp_path):
    posts = spark.range(30).selectExpr("CAST(id AS STRING) AS id", "concat('s', id % 10) AS source_slug", "'d' AS date_iso")
    sources = spark.createDataFrame([(f"s{i}", "n", "u", "h", "t") for i in range(11)], SOURCE)
    write_archives(sources, archive_records(posts), str(tmp_path / "f"), ["date_iso"], layout="files", posts_per_document=2)
    names = [n for n in files_below(tmp_path / "f") if "SUCCESS" not in n]
    assert len(names) == 21 and all(n.endswith(".json") for n in names)
    assert json.loads((tmp_path / "f" / next(n for n in names if n.startswith("slug=s10/"))).read_text())["posts"] == []
    docs = read_archives(spark, str(tmp_path / "f"))
    assert sorted((r.file_slug, r.part) for r in docs.collect()) == sorted([(f"s{i}", n) for i in range(10) for n in (0, 1)] + [("s10", 0)])
    assert fl.explode_posts(docs).count() == 30


def test_small_files_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    for i in range(120):
        (tmp_path / f"{i}").mkdir()
        (tmp_path / f"{i}" / "d.json").write_text(json.dumps({"metadata": {"slug": f"s{i}"}, "posts": [{"id": str(i)}]}))
    (tmp_path / "large.json").write_text(json.dumps({"metadata": {"slug": "large"}, "posts": [{"id": "x", "content": "c" * 3000}]}))
    monkeypatch.setattr(many_files, "TASK_FILES", 40)
    monkeypatch.setattr(many_files, "SMALL_FILE", 1000)
    monkeypatch.setattr(many_files, "ROUNDS", 1)
    before = spark.conf.get(many_files.LISTING)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    try:
        docs, tasks = tasks_of(spark, lambda: read_archives(spark, str(tmp_path)))
        files, more = tasks_of(spark, lambda: read_file_inventory(spark, str(tmp_path), "*.json", recursive=True))
        assert max(tasks + more) <= 4 and spark.conf.get(many_files.LISTING) == before
        # Four tasks for the small files, one for the large one.
        assert docs.rdd.getNumPartitions() <= 5 and files.rdd.getNumPartitions() <= 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.file_slug for r in docs.collect()) == ["d"] * 120 + ["large"]
    assert files.count() == 121 and files.where("size > 0 AND mtime IS NOT NULL").select("path").distinct().count() == 121


def test_files_held_whole_are_walked_where_they_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive_stream, "PART_POSTS", 3)
    posts = [{"id": str(i), "content": 'a } { ] "quoted" \\ \n é' * (i % 4)} for i in range(20)]
    texts = {
        "plain": json.dumps({"metadata": {"slug": "p"}, "posts": posts}), "none": '{"metadata": {"slug": "n"}, "posts": null}', "bare": "{}", "blank": "",
        "space": " \n", "empty": '{"posts": [ ], "scraped_at": "}"}', "cut": json.dumps({"posts": posts})[:-40], "behind": '{"posts": []} x',
        "text": '{"posts": "x"}', "twice": '{"posts": [{"id": "no"}], "posts": [{"id": "yes"}], "part": 3}', "then": '{"posts": [{"id": "no"}], "posts": []}',
        "long": json.dumps({"scraped_at": "t", "posts": posts * 5}),
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    said = lambda docs: sorted(map(str, docs.withColumn("metadata", F.to_json("metadata")).withColumn(
        "posts", F.transform("posts", lambda p: F.to_json(p))).drop("scraped_at", "consolidated_at", "sources").collect()))
    read = lambda: said(read_archives(spark, str(tmp_path), layout="stream"))
    monkeypatch.setattr(archive_stream, "AT_ONCE", 0)
    fragments = read()
    monkeypatch.setattr(archive_stream, "AT_ONCE", 1500)  # "long" is larger
    assert read() == fragments
    assert len(fragments) == 7 + 34 + 9  # a blank file has no document
    # Files of which none is large do not leave the tasks that read them.
    monkeypatch.setattr(archive_stream, "AT_ONCE", 1 << 20)
    monkeypatch.setattr(archive_stream, "lookup_join", lambda *a: 1 / 0)
    assert read() == fragments
