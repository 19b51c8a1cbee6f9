"""Column expressions; all run inside the JVM."""

from .dates import parse_hu_date, parse_scraped_at
from .media import absolutize_url, is_video_host, media_local_path, video_filename
from .text import blank_to_null, clean_text, content_preview, leading_int, strip_unicode
from .urls import extract_post_id, page_name, safe_name, short_id
from .variants import json_type, shallow_json_type, type_name, variant_text
from .worklogs import classify_error, missing_log_line

__all__ = [
    "absolutize_url", "blank_to_null", "classify_error", "clean_text", "content_preview",
    "extract_post_id", "is_video_host", "json_type", "leading_int", "media_local_path",
    "missing_log_line", "page_name", "parse_hu_date", "parse_scraped_at", "safe_name",
    "shallow_json_type", "short_id", "strip_unicode", "type_name", "variant_text", "video_filename",
]
