"""Headline timings: one JSON line on standard output.

Raw forms (archives, feed captures, pages) are rendered first and timed apart as
``prepare_sec``; each query is then planned and run to its end, best of BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sedgemill.plans import PLANS, render
from sedgemill.session import build_session

HEADLINE = [
    "flatten_posts", "flatten_media", "upsert_posts", "source_stats", "load_totals", "failed_downloads",
    "dedup_posts", "cross_posts", "slug_match", "merge_posts", "merge_errors", "merge_stats", "old_only_sample",
    "missing_media", "manifest_missing", "worklist_pending", "media_download_plan", "retry_candidates",
    "apply_retry_media", "html_posts", "html_links", "continuation_fill", "feed_extract_posts", "feed_extract_media",
    "feed_dedupe", "stream_feed_new", "api_index", "json_file_profile", "json_field_profile", "json_key_sets",
    "json_type_conflicts", "extract_post_id", "parse_hu_date", "split_group",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    started = time.perf_counter()
    if not sys.argv[1:]:
        render.archive_lines(spark, sf_dir)
        for side in ("old", "new"):
            render.snapshot_docs(spark, sf_dir, side)
        for by_page in (False, True):
            render.feed_captures(spark, sf_dir, by_page)
        render.api_captures(spark, sf_dir)
    prepared = time.perf_counter() - started

    timings: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            begin = time.perf_counter()
            PLANS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        timings[name] = round(best, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "prepare_sec": round(prepared, 3), "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
