"""Stage telemetry on ``events``: event_type is the stage, user_id the worker, value the seconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import telemetry as T
from ..session import table
from .registry import query


@query("""SELECT e.event_id, (SELECT count(*) FROM events f WHERE f.user_id = e.user_id AND f.ts <= e.ts AND f.ts > e.ts - INTERVAL 3600 SECONDS) AS in_window
FROM events e""")
def q_rolling_60s(spark, d):
    """Rolling count strictly after the window's start; an hour here, since the events are sparse."""
    rows = table(spark, d, "events").select("event_id", "user_id", "ts")
    return T.rolling_count(rows, ["user_id"], "ts", 3600).select("event_id", "in_window")


@query("""WITH r AS (SELECT event_type, event_id, ts, value, lag(value) OVER w AS b, lag(ts) OVER w AS t FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT event_id, CASE WHEN epoch_us(ts) > epoch_us(t) THEN round((CASE WHEN value < b THEN value ELSE value - b END) / ((epoch_us(ts) - epoch_us(t)) / 1e6::DOUBLE), 6) END AS rate FROM r""")
def q_rate(spark, d):
    """Counter increase per second with resets."""
    rows = table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    return T.counter_rate(rows, ["event_type"], "ts", "event_id", "value").select("event_id", F.round("rate", 6).alias("rate"))


@query("""SELECT event_type, round(list_reduce(list(value ORDER BY ts, event_id), lambda a, x: CASE WHEN a = 0 THEN x ELSE 0.15::DOUBLE * x + 0.85::DOUBLE * a END, 0.0::DOUBLE), 6) AS ema
FROM events GROUP BY event_type""")
def q_ema(spark, d):
    """Exponential moving average, 0 as unset."""
    out = T.ema(table(spark, d, "events"), ["event_type"], "ts", "event_id", "value")
    return out.select("event_type", F.round("ema", 6).alias("ema"))


@query("""SELECT event_type, CASE WHEN count(*) > 0 AND avg(value) > 0 THEN round(count(*) * avg(value), 4) ELSE 0.0::DOUBLE END AS eta FROM events GROUP BY 1""")
def q_eta(spark, d):
    g = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("q"), F.avg("value").alias("a"))
    return g.select("event_type", F.round(T.eta_seconds(F.col("q"), F.col("a")), 4).alias("eta"))


@query("SELECT event_type, arg_max(value, (ts, event_id)) AS last FROM events GROUP BY 1")
def q_last_value(spark, d):
    return T.last_value(table(spark, d, "events"), ["event_type"], "value", "ts", "event_id")


@query("""SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events,
 (SELECT unnest([1.0::DOUBLE, 5.0, 10.0, 50.0, 100.0, 500.0]) AS le) GROUP BY 1, 2""")
def q_stage_histogram(spark, d):
    """Cumulative buckets in one aggregation."""
    return T.histogram(table(spark, d, "events"), ["event_type"], "value", [1, 5, 10, 50, 100, 500])


@query("""WITH p AS (SELECT l_orderkey AS file, count(*) AS total, count(*) FILTER (WHERE l_linestatus = 'F') AS finished,
 count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag <> 'R') AS succeeded, count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R') AS failed FROM lineitem GROUP BY 1)
SELECT *, CASE WHEN finished < total THEN 'running' WHEN failed > 0 AND succeeded = 0 THEN 'error' ELSE 'success' END AS status FROM p""")
def q_file_progress(spark, d):
    """Orders as files, lines as tracks."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_returnflag")
    out = T.file_progress(lines, "l_orderkey", F.count(F.lit(1)), F.col("l_linestatus") == "F", F.col("l_returnflag") != "R")
    return out.withColumnRenamed("l_orderkey", "file")


@query("""SELECT event_type, count(*) AS n FROM events WHERE regexp_full_match(event_type, 'click|view|.*chase') AND contains(props, '1') GROUP BY 1""")
def q_log_filter(spark, d):
    """Anchored label match and a line filter."""
    rows = table(spark, d, "events").where(T.anchored(F.col("event_type"), "click|view|.*chase") & F.col("props").contains("1"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, last(value ORDER BY ts, event_id) AS last_value, round(avg(value), 6) AS mean_value, max(value) AS max_value,
 round(sum(value) FILTER (WHERE value > 0), 4) AS positive FROM events GROUP BY 1""")
def q_panel_reducers(spark, d):
    """Last, mean, maximum, and the sum of a filtered vector."""
    return table(spark, d, "events").groupBy("event_type").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("last_value"),
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.max("value").alias("max_value"),
        F.round(F.sum(F.when(F.col("value") > 0, F.col("value"))), 4).alias("positive"),
    )


@query("""SELECT event_id, round(value - lag(value, 1, value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS delta FROM events""")
def q_delta(spark, d):
    """Change to the row before, the first one 0."""
    rows = table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    rows = T.with_previous(rows, ["event_type"], "ts", "event_id", ["value"])
    delta = F.col("value") - F.col("previous.value")
    return rows.select("event_id", F.round(F.coalesce(delta, F.lit(0.0)), 6).alias("delta"))


@query("""WITH s AS (SELECT event_type, epoch_us(ts) // 3600000000 AS h, epoch_us(ts) AS us, value, lag(value) OVER (PARTITION BY event_type, epoch_us(ts) // 3600000000 ORDER BY ts, event_id) AS b FROM events)
SELECT event_type, h * 3600 AS step, count(*) AS samples, CASE WHEN max(us) > min(us) THEN round(sum(CASE WHEN b IS NULL THEN 0 WHEN value < b THEN value ELSE value - b END) / ((max(us) - min(us)) / 1e6::DOUBLE), 6) END AS rate
FROM s GROUP BY event_type, h""")
def q_range_rate(spark, d):
    """Rate over each step of time; an hour here, since the events are sparse."""
    rows = table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    out = T.range_rate(rows, ["event_type"], "ts", "event_id", "value", 3600)
    return out.select("event_type", "step", "samples", F.round("rate", 6).alias("rate"))


@query("""SELECT user_id, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75 FROM events GROUP BY 1""")
def q_percentiles(spark, d):
    g = table(spark, d, "events").groupBy("user_id")
    return g.agg(*[F.round(F.percentile("value", F.lit(q)), 6).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)])


@query("""SELECT event_type, round(avg(value) FILTER (WHERE event_id % 2 = 0), 6) AS even_mean, round(avg(value) FILTER (WHERE event_id % 2 = 1), 6) AS odd_mean,
 count(DISTINCT user_id) AS workers, count(*) AS n, min(value) AS least FROM events GROUP BY 1""")
def q_conditional_aggregates(spark, d):
    """Filtered means, distinct counts and minima together."""
    part = lambda k: F.round(F.avg(F.when(F.col("event_id") % 2 == k, F.col("value"))), 6)
    return table(spark, d, "events").groupBy("event_type").agg(
        part(0).alias("even_mean"), part(1).alias("odd_mean"), F.countDistinct("user_id").alias("workers"),
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"),
    )
