"""Readers: captured files to DataFrames."""

from .archives import archive_documents, read_archives
from .captures import api_items, feed_responses, read_api_pages, read_feed_responses
from .inventory import read_file_inventory
from .lists import read_allow_list, read_ledger, read_manifest, read_worklist

__all__ = [
    "api_items", "archive_documents", "feed_responses", "read_allow_list", "read_api_pages", "read_archives",
    "read_feed_responses", "read_file_inventory", "read_ledger", "read_manifest", "read_worklist",
]
