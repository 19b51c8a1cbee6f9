"""Golden rows of the scalar functions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sedgemill import functions as sf

AS_OF = "2026-04-17T12:55:21.123Z"


def values(spark, texts, build):
    """Values of ``build(column)`` for each text, in input order."""
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("t"))).collect()]


def check(spark, pairs, build):
    assert values(spark, [p[0] for p in pairs], build) == [p[1] for p in pairs]


def test_clean_text(spark):
    check(spark, [("  a ", "a"), ("\t", None), (" ", None), ("", None), (None, None), (" x\n", "x")],
          sf.clean_text)


def test_parse_hu_date(spark):
    pairs = [
        ("Ma 9:07", "2026-04-17T09:07:00.000Z"),
        ("Ma", AS_OF),
        ("Tegnap 23:59", "2026-04-16T23:59:00.000Z"),
        ("Tegnap", "2026-04-16T12:55:21.123Z"),
        ("2024. 3. 5. 9:07", "2024-03-05T09:07:00.000Z"),
        ("2024.3.5.9:07 x", "2024-03-05T09:07:00.000Z"),
        ("2024. 13. 1. 0:00", "2025-01-01T00:00:00.000Z"),
        ("2024. 2. 30. 25:61", "2024-03-02T02:01:00.000Z"),
        ("May 5, 2024", AS_OF),
        ("abc", "abc"),
        ("2024-03-05", "2024-03-05T00:00:00.000Z"),
        ("2024-03-05T10:00:00+02:00", "2024-03-05T08:00:00.000Z"),
        ("", None),
        (None, None),
    ]
    check(spark, pairs, lambda c: sf.parse_hu_date(c, AS_OF, "UTC"))


def test_parse_hu_date_in_a_zone(spark):
    pairs = [
        ("2024. 3. 5. 9:07", "2024-03-05T08:07:00.000Z"),
        ("2024. 7. 5. 9:07", "2024-07-05T07:07:00.000Z"),
        ("Ma 0:30", "2026-04-16T22:30:00.000Z"),
    ]
    check(spark, pairs, lambda c: sf.parse_hu_date(c, AS_OF, "Europe/Budapest"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_scrape_time_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, ["2026-04-17T12:55:21.000Z", "x", None],
                     lambda c: F.unix_seconds(sf.parse_scraped_at(c)))
        assert got == [1776430521, 0, 0]
        assert values(spark, ["2024-03-05T10:00:00Z"], lambda c: sf.parse_hu_date(c, AS_OF, "UTC")) == [
            "2024-03-05T10:00:00.000Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_extract_post_id(spark):
    check(spark, [
        ("https://www.facebook.com/somebody/videos/1264399547438987/", "1264399547438987"),
        ("https://www.facebook.com/watch/?v=1234567890", "1234567890"),
        ("https://www.facebook.com/permalink.php?story_fbid=1234567890&id=987654321", "1234567890"),
        ("/reels/12?v=99", "12"),
        ("/p/posts/7", "7"),
        ("/11111111/22222222", "22222222"),
        ("/1234567", None),
        ("", None),
    ], sf.extract_post_id)


def test_page_and_folder_names(spark):
    check(spark, [
        ("https://www.facebook.com/profile.php?id=61571844754927", "61571844754927"),
        ("https://www.facebook.com/profile.php?x=1&id=5&id=6#id=7", "5"),
        ("https://www.facebook.com/a/b/", "a/b"),
        ("https://www.facebook.com/profile.php", "profile.php"),
        ("https://www.facebook.com", ""),
    ], sf.page_name)
    check(spark, [
        ("a/b?c", "a_b"),
        ("x profile 12", "12"),
        ("profile", "profile"),
        ("", hashlib.sha1(b"u").hexdigest()[:16]),
        ("é" * 100, "_" * 80),
    ], lambda c: sf.safe_name(c, F.lit("u")))


def test_media_local_path(spark):
    image = lambda c: sf.media_local_path(F.lit("5"), F.lit("image"), c)
    check(spark, [("https://c/x/y.jpg?z=1", "media/5_y.jpg"), ("https://c/x/y.jpg/", "media/5_y.jpg")], image)
    video = lambda c: sf.media_local_path(F.lit("5"), F.lit("video"), c)
    check(spark, [("https://c/w", "media/5_video.mp4")], video)
    skipped = lambda c: sf.media_local_path(F.lit("5"), F.lit("video"), c, skip_video=True)
    check(spark, [("https://c/w", None)], skipped)


def test_leading_int_and_preview(spark):
    check(spark, [("12ab", 12), (" -3", -3), ("x", None), (None, None)], sf.leading_int)
    text = "a" * 10 + "\n" + "b" * 239
    check(spark, [(text, "a" * 10 + " " + "b" * 189), (None, "")], sf.content_preview)


def test_error_classes_and_log_lines(spark):
    check(spark, [
        ("ERROR: This video is only available for registered users", "registered_only"),
        ("x Cannot parse data y", "rate_limited"),
        ("Could not extract post ID", "no_post_id"),
        ("TimeoutExpired", "timeout"),
        ("Interrupted by user", "interrupted"),
        ("boom", "other"),
        (None, None),
    ], sf.classify_error)
    lines = ["[t] [ctx] http://a | Not Found", "[t] http://a | b | c", "junk"]
    got = values(spark, lines, lambda c: F.struct(*[v.alias(k) for k, v in sf.missing_log_line(c).items()]))
    assert [tuple(r) for r in got] == [
        ("t", "ctx", "http://a", "Not Found"), ("t", None, "http://a", "b | c"), (None,) * 4]


def test_json_type(spark):
    check(spark, [
        ("true", "boolean"), ("1", "integer"), ("1.5", "float"), ("1.0", "float"), ("1e3", "float"),
        ("null", "null"), ("12345678901234567890", "integer"), ('"a"', "string"), ("[1]", "array"), ("{}", "object"),
    ], lambda c: sf.json_type(F.parse_json(c)))
