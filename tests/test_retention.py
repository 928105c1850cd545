"""Retention plan (W2, J4, A21) against a direct re-statement of the rule."""
import random

from herdflow.operators.retention import select_for_retention
from herdflow.operators.windows import running_total

LISTING = "href string, name string, createdAt string, animalCount bigint"


def _listing(spark, rows):
    return spark.createDataFrame(rows, LISTING)


def _landed(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "session_id bigint")


def _brute(rows, landed, threshold=8000, buffer=2000):
    total = sum(r[3] or 0 for r in rows)
    if total <= threshold:
        return []
    cand = []
    for r in rows:
        sid = r[0].split("/")[-1]
        if sid.isdigit() and int(sid) in landed:
            cand.append((r[2] or "", int(sid), r[3] or 0))
    out, running = [], total
    for created, sid, cnt in sorted(cand):
        if running <= threshold - buffer:
            break
        out.append(sid)
        running -= cnt
    return out


def test_total_at_threshold_does_nothing(spark):
    rows = [(f"/s/{i}", "n", f"2024-01-{i:02d}", 1000) for i in range(1, 9)]
    assert select_for_retention(_listing(spark, rows), _landed(spark, range(1, 9))).count() == 0


def test_one_over_threshold(spark):
    rows = [(f"/s/{i}", "n", f"2024-01-{i:02d}", 1000) for i in range(1, 9)] + [("/s/9", "n", "2024-01-09", 1)]
    got = [r["session_id"] for r in select_for_retention(_listing(spark, rows), _landed(spark, range(1, 10)))
           .orderBy("createdAt").collect()]
    assert got == [1, 2, 3] == _brute(rows, set(range(1, 10)))


def test_random_mix_matches_rule(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        created = f"2024-0{rnd.randint(1, 3)}-{rnd.randint(10, 12)}"     # many equal createdAt
        href = f"/api/sessions/{i}" if i % 17 else f"/api/sessions/{i}/x"
        rows.append((href, "n", created if i % 23 else None, rnd.randint(0, 60) if i % 11 else None))
    landed = {i for i in range(400) if rnd.random() < 0.7}
    out = select_for_retention(_listing(spark, rows), _landed(spark, landed))
    got = sorted(r["session_id"] for r in out.collect())
    assert got == sorted(_brute(rows, landed))


def test_running_total_matches_sequential(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 5), i, rnd.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "k int, id int, v int")
    got = {r["id"]: r["before"] for r in running_total(df, ["k", "id"], "v", partitions=7).collect()}
    acc, want = 0, {}
    for k, i, v in sorted(data):
        want[i] = acc
        acc += v
    assert got == want
