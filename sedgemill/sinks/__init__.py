"""Writers; each has a reader that gives the rows back."""

from .archives import archive_records, write_archives
from .ledgers import append_ledger, write_csv_report
from .schema_report import schema_report, write_schema_report
from .tables import current_tables, write_tables

__all__ = [
    "append_ledger", "archive_records", "current_tables", "schema_report", "write_archives", "write_csv_report",
    "write_schema_report", "write_tables",
]
