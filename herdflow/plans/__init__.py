"""Composed jobs and report tables."""

from herdflow.plans.jobs import (blob_job, blob_rows, blob_run, daily_run, retention_job, session_job,
                                 session_rows, transform_tail)
from herdflow.plans.reports import daily_report, month_report, weekly_report

__all__ = [
    "blob_job", "blob_rows", "blob_run", "daily_report", "daily_run", "month_report", "retention_job",
    "session_job", "session_rows", "transform_tail", "weekly_report",
]
