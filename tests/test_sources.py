"""Sources: file-name dates, session documents, envelopes, incremental selection, windows."""
import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.functions.dates import file_date
from herdflow.schemas import SESSION_DOC_SCHEMA
from herdflow.sources.master import load_window, tag_and_union
from herdflow.sources.sessions import deletable, flatten_envelope, flatten_sessions, new_sessions


def test_file_date(spark):
    names = ["raw_CIMA1_012-12032024_00.csv", "raw_CIMA1_direct_2024-02-24.csv",
             "raw_CIMA1_direct_2024-02-30.csv", "raw_CIMA1_012-31022024_00.csv", "raw_CIMA1_x.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(file_date("n")).collect()]
    assert got == [dt.date(2024, 3, 12), dt.date(2024, 2, 24), None, None, None]


def test_flatten_sessions_cases(spark):
    docs = [
        {"name": "S1", "createdAt": "2024-05-01T07:30:00Z",
         "animals": {"values": [{"rfid": "982", "currentWeight": 400.5, "scanDate": "2024-05-01T07:31"},
                                {"currentWeight": None}]}},
        {"name": "S2", "createdAt": "2024-05-02", "animals": {"values": [{"rfid": "1", "currentWeight": 1.0}]}},
        {"name": "S3", "createdAt": "2024-05-03T08:00:00", "animals": {"values": []}},
    ]
    raw = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "session_id int, doc string")
    parsed = raw.select("session_id", F.from_json("doc", SESSION_DOC_SCHEMA).alias("d")).select("session_id", "d.*")
    out = flatten_sessions(parsed).orderBy("session_id", "ear_tag").collect()
    assert len(out) == 3
    assert (out[0]["ear_tag"], out[0]["weight"], out[0]["scan_date"]) == ("", None, "")
    assert (out[1]["date"], out[1]["time"], out[1]["weight"]) == ("2024-05-01", "07:30", 400.5)
    assert (out[2]["date"], out[2]["time"]) == ("2024-05-02", "")


def test_envelope_both_shapes(spark):
    rec = T.StructType([T.StructField("id", T.LongType()), T.StructField("operationTag", T.StringType())])
    pages = spark.createDataFrame([(1, '{"hydra:member": [{"id": 1, "operationTag": "A"}]}'),
                                   (2, ' [{"id": 2, "operationTag": "B"}, {"id": 3}]'),
                                   (3, '{"hydra:member": []}'), (4, "[]")], "p int, text string")
    got = sorted(r["id"] for r in flatten_envelope(pages, "text", rec).collect())
    assert got == [1, 2, 3]


def test_new_and_deletable_sessions(spark):
    listing = spark.createDataFrame([("/s/1", "a"), ("/s/2", "b"), ("/s/3/x", "c"), ("/s/", "d")],
                                    "href string, name string")
    landed = spark.createDataFrame([("1",), ("1",), ("9",)], "session_id string")
    assert [r["session_id"] for r in new_sessions(listing, landed).collect()] == [2]
    assert [r["session_id"] for r in deletable(listing, landed).collect()] == [1]


def test_load_window():
    today = dt.date(2024, 5, 10)
    assert load_window(today) == (dt.date(2024, 5, 3), dt.date(2024, 5, 11))
    assert load_window(today, "2024-01-01", None) == (dt.date(2024, 5, 3), dt.date(2024, 5, 11))
    assert load_window(today, "2024-01-01", "2024-01-31") == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert load_window(today, "2024-01-01", None, mode="replay") == (dt.date(2024, 1, 1), today)


def test_tag_and_union(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, extra string")
    out = tag_and_union({"CIMA1": a, "CIMA2": b, "OFF": a}, "PTM", enabled=["CIMA1", "CIMA2"])
    assert sorted((r["device"], r["x"]) for r in out.collect()) == [("CIMA1", 1), ("CIMA2", 2)]
