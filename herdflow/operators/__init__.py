"""Relational operators: enrichment, conform, keep-latest, bands, aggregates, quality,
retention and repairs."""

from herdflow.operators.aggregates import (curve, day_counts, freshness, histogram,
                                           month_headline, monthly_by_key, top_groups,
                                           value_counts)
from herdflow.operators.bands import (band_count, band_join, band_stats, coverage,
                                      coverage_status, coverage_summary, month_groups,
                                      month_meta, month_summary, weekly_coverage)
from herdflow.operators.conform import (conform, drop_invalid_tags, filter_range,
                                        observe_range, range_counts)
from herdflow.operators.dedup import (dedup_latest, duplicate_keys, duplicate_summary,
                                      first_per_key, latest_order)
from herdflow.operators.enrich import enrich, match_counts
from herdflow.operators.quality import (all_null_columns, expect_columns, expect_non_empty,
                                        join_rate_gate, landing_stats, null_counts, preview,
                                        probe, profile_keys, summary)
from herdflow.operators.repair import (fill_device, migrate_legacy, repair_class,
                                       repair_device, repair_null_counts, repair_nulls,
                                       round_age_month)
from herdflow.operators.retention import select_for_retention
from herdflow.operators.windows import running_total

__all__ = [
    "all_null_columns", "band_count", "band_join", "band_stats", "conform", "coverage",
    "coverage_status", "coverage_summary", "curve", "day_counts", "dedup_latest",
    "drop_invalid_tags", "duplicate_keys", "duplicate_summary", "enrich", "expect_columns",
    "expect_non_empty", "fill_device", "filter_range", "first_per_key", "freshness",
    "histogram", "join_rate_gate", "landing_stats", "latest_order", "match_counts",
    "migrate_legacy", "month_groups", "month_headline", "month_meta", "month_summary",
    "monthly_by_key", "null_counts", "observe_range", "preview", "probe", "profile_keys", "range_counts",
    "repair_class", "repair_device", "repair_null_counts", "repair_nulls", "round_age_month",
    "running_total", "select_for_retention", "summary", "top_groups", "value_counts",
    "weekly_coverage",
]
