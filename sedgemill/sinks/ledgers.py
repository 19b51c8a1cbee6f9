"""CSV reports and append-only ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv_report(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with header and a fixed column order."""
    rows.select(*columns).write.option("header", "true").option("escape", '"').option("emptyValue", "").csv(path)


def append_ledger(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Add one batch of rows to a ledger folder; earlier batches stay untouched."""
    rows.select(*columns).write.mode("append").option("header", "true").option("escape", '"').csv(path)
