"""Day bitmaps, kept month tables and repairs written back, against full recomputation."""
import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from herdflow.operators import coverage_state as CS
from herdflow.operators.aggregates import monthly_by_key, read_months, refresh_months
from herdflow.operators.bands import month_groups, weekly_coverage
from herdflow.operators.repair import repair_class, repair_device, repair_nulls
from herdflow.session import local_path, scratch_path
from herdflow.sinks.master import changed_days, read_table, upsert_days, upsert_latest, write_back

MASTER = ("date date, ear_tag string, device string, no string, animal_type string, age_month double, weight_kg double, lac_no tinyint, "
          "dim smallint, age_days smallint, group_name string, source string, time string, loaded_at timestamp")
HERD = "date date, age_month_fix double, lac_no int, dim int"


def _rows(rng, n, load, days=70):
    out = []
    for _ in range(n):
        animal, day = rng.randrange(200), dt.date(2024, 4, 1) + dt.timedelta(days=rng.randrange(days))
        cow = animal % 2
        out.append((day, f"t{animal}", rng.choice("AB"), None if animal % 17 == 0 else str(animal), "cow" if cow else "heifer",
                    rng.uniform(4, 14), rng.uniform(80, 950), rng.randrange(1, 6) if cow else 0, rng.randrange(200) if cow else None, 300,
                    rng.choice(["g1", "g2", None]), "PTM", "07:00", dt.datetime(2024, 6, load)))
    return out


@pytest.fixture(scope="module")
def loads(spark):
    """Two loads, the second with late rows for old days, and what each touched."""
    rng, path = random.Random(5), scratch_path(spark, "t-master")
    first = upsert_days(spark.createDataFrame(_rows(rng, 900, 1), MASTER), path)
    late = [r for r in _rows(rng, 300, 2) if r[0].day in (3, 17) and r[0].month in (4, 6)]
    return path, first, spark.createDataFrame(late, MASTER)


def _files(path):
    return {f: open(f, "rb").read() for f in glob.glob(f"{local_path(path)}/*=*/*.parquet")}


def test_reports_of_states_equal_direct_reports_after_late_rows(spark, loads):
    path, first, late = loads
    rng = random.Random(6)
    herd = spark.createDataFrame([(dt.date(2024, m, 2), rng.uniform(4, 14), rng.randrange(6), rng.randrange(200)) for m in (4, 5, 6) for _ in range(300)], HERD)
    roots = {r: scratch_path(spark, f"t-{r}") for r in (CS.WEEKLY, CS.MONTHLY)}
    months, numbers = scratch_path(spark, "t-months"), scratch_path(spark, "t-numbers")

    def refresh(table, days):
        for r, root in roots.items():
            CS.refresh_states(spark, table, root, CS.number_animals(spark, numbers, table), days, r)
        refresh_months(table, months, days)

    def same(a, b):
        key = lambda r: str(r)
        assert a.columns == b.columns or sorted(a.columns) == sorted(b.columns)
        assert sorted(map(tuple, a.select(*b.columns).collect()), key=key) == sorted(map(tuple, b.collect()), key=key)

    def check():
        master = read_table(spark, path)
        for today in (dt.date(2024, 4, 20), dt.date(2024, 5, 31), dt.date(2024, 6, 7)):
            same(CS.weekly_coverage_of_states(CS.read_states(spark, roots[CS.WEEKLY]), herd, today), weekly_coverage(master, herd, today))
        for m in (4, 5, 6):
            lo, hi = dt.date(2024, m, 1), dt.date(2024, m, 30)
            same(CS.month_groups_of_states(CS.read_states(spark, roots[CS.MONTHLY]), herd, lo, hi), month_groups(master, herd, lo, hi))
        same(read_months(spark, months), monthly_by_key(master))

    refresh(first.table, first.days)
    check()
    before = {**_files(roots[CS.WEEKLY]), **_files(months)}
    done = upsert_days(late, path)
    assert len(done.days) <= 4
    refresh(done.table, done.days)
    check()
    after = {**_files(roots[CS.WEEKLY]), **_files(months)}
    touched = {f"day={d}" for d in done.days} | {f"year_month={d[:7]}" for d in done.days}
    for f, content in before.items():
        if f.split("/")[-2] not in touched:
            assert after[f] == content        # other days and May keep their files
    assert "year_month=2024-05" not in touched


def test_numbers_are_kept_and_dense(spark):
    path = scratch_path(spark, "t-num")
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "no string")
    one = {r["no"]: r["num"] for r in CS.number_animals(spark, path, names("b", "a", None, "a")).collect()}
    two = {r["no"]: r["num"] for r in CS.number_animals(spark, path, names("c", "a", "d")).collect()}
    assert sorted(one.values()) == [0, 1] and {k: two[k] for k in one} == one and sorted(two.values()) == [0, 1, 2, 3]
    assert CS.number_animals(spark, path, names()).count() == 4


def test_empty_days_and_no_states(spark):
    states, numbers = scratch_path(spark, "t-none"), spark.createDataFrame([], "no string, num bigint")
    master = spark.createDataFrame([], MASTER).withColumn("day", F.lit("x"))
    CS.refresh_states(spark, master, states, numbers, ["2024-01-01", None])
    assert CS.read_states(spark, states).count() == 0
    herd = spark.createDataFrame([(dt.date(2024, 1, 1), 6.0, 0, 0)], HERD)
    got = CS.weekly_coverage_of_states(CS.read_states(spark, states), herd, dt.date(2024, 1, 5)).collect()
    assert [(r["weighed"], r["avg_weight"], r["n_valid"]) for r in got] == [(0, None, 0)] * 3


def _repaired(spark, rows, repair):
    path = scratch_path(spark, "t-repair")
    upsert_latest(spark.createDataFrame(rows, MASTER), path)
    before = _files(path)
    dry = [tuple(r) for r in write_back(spark, path, repair, write=False).collect()]
    assert _files(path) == before
    days = sorted((tuple(r) for r in write_back(spark, path, repair).collect()), key=str)
    assert sorted(dry, key=str) == days
    after = _files(path)
    changed = {f"day={'__HIVE_DEFAULT_PARTITION__' if d[0] is None else d[0]}" for d in days}
    for f in set(before) | set(after):
        assert (f.split("/")[-2] in changed) != (before.get(f) == after.get(f))
    assert write_back(spark, path, repair).count() == 0 and _files(path) == after       # a clean master stays as it is
    return path, days


def _row(day, tag="1", device="A", **kw):
    base = dict(date=None if day is None else dt.date(2024, 1, day), ear_tag=tag, device=device, no="9", animal_type="cow", age_month=30.0,
                weight_kg=500.0, lac_no=2, dim=30, age_days=900, group_name="g", source="PTM", time="07:00", loaded_at=dt.datetime(2024, 2, 1))
    return tuple((base | kw).values())


def test_null_repair_rewrites_only_its_days(spark):
    rows = [_row(1), _row(2, group_name=" N/A "), _row(3, age_days=-4), _row(4, group_name=None), _row(None, group_name="nan")]
    path, days = _repaired(spark, rows, repair_nulls)
    assert [d[0] for d in days if d[0]] == ["2024-01-02", "2024-01-03"] and len(days) == 3
    assert {r["day"]: (r["group_name"], r["age_days"]) for r in read_table(spark, path).collect()}["2024-01-03"] == ("g", None)


def test_device_repair_drops_phantoms(spark):
    rows = [_row(1), _row(2, device=None), _row(2, device="A", weight_kg=400.0), _row(3, device=None, tag="7")]
    path, days = _repaired(spark, rows, repair_device)
    assert [(d[0], d[1], d[2]) for d in days] == [("2024-01-02", 2, 1), ("2024-01-03", 1, 1)]
    assert read_table(spark, path).where("device IS NULL").count() == 0


def test_class_repair(spark):
    rows = [_row(1, animal_type="cow"), _row(2, animal_type="dry_cow"), _row(3, animal_type="heifer", lac_no=0)]
    path = scratch_path(spark, "t-class")
    upsert_latest(spark.createDataFrame(rows, MASTER), path)
    want = {str(r["date"]): r["animal_type"] for r in repair_class(read_table(spark, path)).collect()}
    write_back(spark, path, repair_class)
    assert {str(r["date"]): r["animal_type"] for r in read_table(spark, path).collect()} == want


def test_swapped_values_are_seen(spark):
    """Two rows of a day that trade a value give the same bag of values and still differ."""
    a = spark.createDataFrame([("1", "x", "d"), ("2", "y", "d")], "ear_tag string, v string, day string")
    b = spark.createDataFrame([("1", "y", "d"), ("2", "x", "d")], "ear_tag string, v string, day string")
    assert changed_days(a, a).count() == 0 and changed_days(a, b).count() == 1
