"""Spark-native analysis of crawled web archives: flatten, merge, reconcile, profile."""
