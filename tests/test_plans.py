"""Plan shapes and the driver contract on the smallest scale factor."""
import duckdb
import pytest

from herdflow.harness.catalog import REGISTRY
from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Keys whose work includes writes to the scratch folder (streams, landing, upsert).
SIDE_EFFECT = {"upsert_latest", "land_raw", "read_raw_blobs", "stream_dedup", "stream_upsert",
               "stream_daily_counts"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() == 3
    assert df.columns[:4] == ["ord", "label", "baseline", "weighed"]


def test_every_key_has_oracle_except_none():
    assert all(sql is not None for _, sql in REGISTRY.values())
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


# Keys that write to the scratch folder while their plan is made.
WRITING = SIDE_EFFECT | {"blob_run", "blob_job_full", "session_job", "session_replay", "upsert_new_column", "upsert_dry_run",
                         "stream_over_batch", "land_raw_moved_day", "landing_outcomes", "land_sessions", "land_sessions_twice",
                         "month_bundle_clean", "daily_run_status", "table_probe", "export_csv", "read_master_window", "read_sessions"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITING))
def test_no_python_eval_and_no_cartesian(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan


def test_dedup_plans_window_group_limit(spark):
    assert "WindowGroupLimit" in _plan(queries()["dedup_latest"](spark, SF_SMALL))


def test_parquet_scans_are_pruned(spark):
    plan = queries()["filter_range"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value,60.0), LessThanOrEqual(value,900.0)]" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = round(v, 9) + 0.0
            t.append(str(v))
        norm.append(tuple(t))
    return sorted(norm)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_oracle_small(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    rel = con.execute(oracle_sql()[name])
    ocols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, rel.fetchall())


def test_generated_code_compiles(spark):
    """Whole-stage code of the keys with the largest expressions compiles (no fallback)."""
    keys = ["weigh_job", "enrich_left", "weekly_coverage", "month_groups", "monthly_by_key", "session_job", "join_rate",
            "curve_exact", "freshness", "month_headline", "preview_latest"]
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        for k in keys:
            queries()[k](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", "true")


def test_sessions_window_prunes_folders(spark):
    plan = queries()["read_sessions"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
