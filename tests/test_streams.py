"""Streams in append mode with late rows: batches come as one file each."""
import datetime as dt
import os

from pyspark.sql import types as T

from biolattice.streaming import detections as st

SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("species", T.StringType()), T.StructField("taxon", T.StringType()), T.StructField("ts", T.TimestampType())])


def at(h, m=0):
    return dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h, minutes=m)


def run(spark, tmp_path, make, batches):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(str(tmp_path / f"b{i}"))
        part = next(p for p in (tmp_path / f"b{i}").iterdir() if p.name.startswith("part-"))
        os.link(part, src / f"{i}.json")
        os.utime(src / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    d = st.read_detections(spark, str(src), SCHEMA, "json", files_per_trigger=1)
    q = (make(d).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(spark.read.parquet(out).collect(), key=str)


def test_hourly_contacts_drop_what_comes_too_late(spark, tmp_path):
    batches = [[("f", "a", "a", at(1)), ("f", "a", "a", at(1, 30)), ("f", "a", "a", at(2))], [("f", "a", "a", at(2, 10)), ("f", "a", "a", at(9))],
               [("f", "a", "a", at(9, 10))], [("f", "a", "a", at(1, 40)), ("f", "a", "a", at(8, 30)), ("f", "a", "a", at(20))]]
    got = run(spark, tmp_path, lambda d: st.hourly_contacts(d, delay="1 hour"), batches)
    # the row of 1:40 comes a batch after the watermark passed its hour, that of 8:30 does not
    assert [(r.hour_start.astimezone(dt.timezone.utc).hour, r.contacts) for r in got] == [(1, 2), (2, 2), (8, 1), (9, 2)]


def test_sessions_are_appended_once_closed(spark, tmp_path):
    batches = [[("f", "a", "a", at(1)), ("f", "a", "a", at(1, 20)), ("g", "a", "a", at(1))], [("f", "a", "a", at(5)), ("f", "a", "a", at(1, 45))], [("f", "a", "a", at(30))],
               [("f", "a", "a", at(30, 5)), ("g", "a", "a", at(1, 10))]]
    got = run(spark, tmp_path, lambda d: st.detection_sessions(d, gap="30 minutes", delay="1 hour"), batches)
    assert [(r.file, r.detections) for r in got] == [("f", 3), ("f", 1), ("g", 1)]


def test_tidy_live_keeps_one_of_each(spark, tmp_path):
    batches = [[("f", "a", "a", at(1)), ("f", "a", "a", at(1, 5)), ("f", "a", "empty", at(1))], [("f", "a", "a", at(1, 20)), ("f", "a", "empty", at(1))]]
    got = run(spark, tmp_path, lambda d: st.tidy_live(d, delay="1 hour"), batches)
    assert sorted(r.taxon for r in got) == ["a", "empty", "empty"]
