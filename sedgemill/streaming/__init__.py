"""Structured Streaming forms of the feed operators."""

from .feed import new_feed_posts, stream_feed_new, upsert_feed_store

__all__ = ["new_feed_posts", "stream_feed_new", "upsert_feed_store"]
