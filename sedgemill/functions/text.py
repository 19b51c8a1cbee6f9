from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode white space plus the four ASCII separators, so a tab or a no-break
# space counts as blank (SQL trim only knows U+0020).
_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}]"
_EDGE_SPACE = rf"(?U)^{_SPACE}+|{_SPACE}+$"


def strip_unicode(c: Column) -> Column:
    """Trim every kind of Unicode space from both ends."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Trimmed text; NULL when nothing is left."""
    return blank_to_null(strip_unicode(c))


def content_preview(c: Column, length: int = 200) -> Column:
    """First ``length`` characters on one line; missing content gives an empty text."""
    return F.translate(F.left(F.coalesce(c, F.lit("")), F.lit(length)), "\n", " ")


def leading_int(c: Column) -> Column:
    """Integer at the start of a text, NULL where there is none or it exceeds 64 bits."""
    return F.regexp_extract(c, r"(?U)^\s*([+-]?[0-9]+)", 1).try_cast("bigint")
