"""Writers for silver/gold tables, the dashboard CSV export and the quality report."""

from churnlens.sinks.writers import (
    key_fits_buckets, quality_report_nested, write_bucketed, write_csv_export, write_csv_file, write_quality_json, write_table,
)

__all__ = ["key_fits_buckets", "quality_report_nested", "write_bucketed", "write_csv_export", "write_csv_file", "write_quality_json", "write_table"]
