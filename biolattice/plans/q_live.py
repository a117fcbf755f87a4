"""Live detections (X), run to the end of the available input."""
from __future__ import annotations


from pyspark.sql import functions as F

from .. import streaming as st
from .registry import query
from .views import scratch, table


def _events(spark, sf):
    """The events table as a stream of its file."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file"),
                      F.when(F.col("event_type") == "error", "empty").otherwise(F.col("event_type")).alias("taxon"))


def _drain(spark, df):
    """Append the stream's result to a new shared folder and read it back."""
    out, ck = scratch(spark), scratch(spark)
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@query("live_tidy", "X-01", sql="""SELECT 'u' || user_id AS file, CASE WHEN event_type = 'error' THEN 'empty' ELSE event_type END AS taxon, CASE WHEN event_type = 'error' THEN count(*) ELSE 1 END AS n
FROM events GROUP BY user_id, event_type""", i="n")
def live_tidy(spark, sf):
    d = _drain(spark, st.tidy_live(_events(spark, sf), delay="40 days"))
    return d.groupBy("file", "taxon").agg(F.count(F.lit(1)).alias("n"))


# appended: windows and sessions that ended before the watermark, the latest time less the delay

@query("live_hourly_contacts", "X-02", sql="""SELECT date_trunc('hour', ts) AS hour_start, event_type AS species, count(*) AS contacts FROM events GROUP BY ALL
HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR""", i="contacts")
def live_hourly_contacts(spark, sf):
    e = _events(spark, sf).withColumn("species", F.when(F.col("taxon") == "empty", "error").otherwise(F.col("taxon")))
    return _drain(spark, st.hourly_contacts(e, delay="6 hours"))


@query("live_sessions", "X-03", sql="""WITH e AS (SELECT 'u' || user_id AS file, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY file ORDER BY ts) AS g FROM e) SELECT file, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS detections FROM s GROUP BY file, g
HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR""", i="detections")
def live_sessions(spark, sf):
    return _drain(spark, st.detection_sessions(_events(spark, sf), gap="6 hours", delay="6 hours"))
