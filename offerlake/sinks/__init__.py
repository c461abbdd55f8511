"""Sinks (K1-K6): a run's partition of every table, quality report, error log."""

from offerlake.sinks.writers import append_error_log, error_log_rows, write_quality_report, write_run, write_staged

__all__ = ["append_error_log", "error_log_rows", "write_quality_report", "write_run", "write_staged"]
