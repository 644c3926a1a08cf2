"""Structured Streaming over the events table, run to its end with ``availableNow``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import jsonb, sql
from ..session import scratch_dir, table
from ..streaming import pipeline
from .registry import query


def _drain(spark, frame, mode):
    """Run the stream to the end; the last batch's rows, written to the shared folder."""
    root = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex[:12]}"

    def sink(batch, batch_id):
        batch.write.mode("append" if mode == "append" else "overwrite").parquet(f"{root}/out")

    stream = frame.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    stream.foreachBatch(sink).start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{root}/out")


def _events(spark, d):
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).parquet(f"{d}/events*.parquet")


@query("""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts)::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL""")
def q_stream_windows(spark, d):
    """Counts per day and stage, with a watermark for late rows."""
    rows = _events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = _drain(spark, pipeline.windowed_rate(rows, "ts", "1 day", "1 day", "1 day", "event_type"), "complete")
    return out.select("event_type", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("day"), "n")


@query("""SELECT event_type, count(*) AS n, last(value ORDER BY event_id) AS last,
 round(list_reduce(list(value ORDER BY event_id), lambda a, x: CASE WHEN a = 0 THEN x ELSE 0.15::DOUBLE * x + 0.85::DOUBLE * a END, 0.0::DOUBLE), 6) AS ema FROM events GROUP BY 1""")
def q_stream_stats(spark, d):
    """Rolling statistics whose state is three numbers a key."""
    out = _drain(spark, pipeline.rolling_stats(_events(spark, d), "event_type", "event_id", "value"), "update")
    return out.select("event_type", "n", "last", F.round("ema", 6).alias("ema"))


@query("""WITH e AS (SELECT event_id, user_id, CASE event_id % 4 WHEN 0 THEN 'request' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'COMPLETED' ELSE 'FAILED' END AS event, event_id % 10 = 0 AS force FROM events),
 h AS (SELECT *, list(event || force::INTEGER) OVER (PARTITION BY user_id ORDER BY event_id) AS past FROM e),
 s AS (SELECT *, list_reduce(list_prepend('', past[1 : len(past) - 1]), lambda a, x: CASE WHEN x = 'request1' OR (x = 'request0' AND a IN ('', 'FAILED')) THEN 'PENDING' WHEN x = 'request0' THEN a ELSE x[1 : len(x) - 1] END) AS before FROM h)
SELECT event_id, CASE WHEN event = 'request' THEN force OR before IN ('', 'FAILED') END AS run,
 CASE WHEN event <> 'request' THEN event WHEN force OR before IN ('', 'FAILED') THEN 'PENDING' ELSE before END AS status FROM s""")
def q_stream_gate(spark, d):
    """Task states over a stream of requests and transitions."""
    k = F.col("event_id")
    event = F.when(k % 4 == 0, "request").when(k % 4 == 1, "RUNNING").when(k % 4 == 2, "COMPLETED").otherwise("FAILED")
    rows = _events(spark, d).select("user_id", k.alias("seq"), event.alias("event"), (k % 10 == 0).alias("force"))
    out = _drain(spark, pipeline.state_gate(rows, ["user_id"]), "append")
    return out.select(F.col("seq").alias("event_id"), "run", "status")


@query("""SELECT DISTINCT user_id, md5(props) AS content FROM events""")
def q_stream_dedup(spark, d):
    """One row of each content, with a watermark that lets old ones go."""
    rows = _events(spark, d).select("user_id", F.md5(F.col("props").cast("binary")).alias("content"), F.col("ts").cast("timestamp").alias("ts"))
    return _drain(spark, pipeline.dedup_stream(rows, "ts", "3650 days", "user_id", "content"), "append").select("user_id", "content")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, max(CASE WHEN l_discount <= 0 THEN -40.0::DOUBLE ELSE
 round(10 * log10(greatest(0.0001::DOUBLE, l_discount) / (1 - greatest(0.0001::DOUBLE, l_discount))), 4) END) AS db FROM lineitem GROUP BY ALL""")
def q_sql_functions(spark, d):
    """The SQL form of the harmonicity function."""
    sql.register(spark)
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "calc_hnr_db(l_discount) AS v")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("db"))


@query("""SELECT event_id, (props->>'$.k') AS v FROM events""")
def q_stem_value(spark, d):
    """One scalar out of three document layouts."""
    k, p = F.col("event_id"), F.col("props")
    doc = (
        F.when(k % 3 == 0, F.concat(F.lit('{"demucs":{"vocals":{"scalars":'), p, F.lit("}}}")))
        .when(k % 3 == 1, F.concat(F.lit('{"demucs":{"vocals":'), p, F.lit("}}")))
        .otherwise(F.concat(F.lit('{"vocals":'), p, F.lit("}")))
    )
    return table(spark, d, "events").select("event_id", jsonb.stem_value(doc, "vocals", "k").alias("v"))


@query("""SELECT event_id, (props->>'$.k')::BIGINT AS kept, 2::BIGINT AS won, 3::BIGINT AS added FROM events""")
def q_deep_merge(spark, d):
    """Nested documents merged level by level."""
    left = F.concat(F.lit('{"scalars":'), F.col("props"), F.lit(',"sequences":{"a":1}}'))
    merged = jsonb.deep_merge(left, F.lit('{"sequences":{"a":2},"more":{"b":3}}'), "bigint")
    pick = lambda *path: jsonb.path_text(F.col("m"), *path).cast("bigint")
    return table(spark, d, "events").select("event_id", merged.alias("m")).select(
        "event_id", pick("scalars", "k").alias("kept"), pick("sequences", "a").alias("won"), pick("more", "b").alias("added")
    )
