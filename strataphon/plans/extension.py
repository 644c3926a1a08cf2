"""Operators that the engine brings along beyond the library's own: labelled as an extension."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import table
from .registry import query


@query("""SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority)::BIGINT AS level, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def q_ext_cube(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 86400000000 OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM e)
SELECT user_id, session::BIGINT AS session, count(*) AS n FROM s GROUP BY 1, 2""")
def q_ext_sessions(spark, d):
    """Sessions by gaps over a day."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    rows = table(spark, d, "events").select("user_id", "ts", "event_id").withColumn("new", F.coalesce((gap > 86_400_000_000).cast("int"), F.lit(1)))
    rows = rows.withColumn("session", F.sum("new").over(w))
    return rows.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p.event_id, coalesce(v.event_id, -1) AS view_id FROM (SELECT * FROM events WHERE event_type = 'click') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
 ON p.user_id = v.user_id AND p.ts >= v.ts""")
def q_ext_asof(spark, d):
    """Latest earlier row of the other kind: one union, one window, no range join."""
    rows = table(spark, d, "events").where("event_type in ('click', 'view')").select("event_id", "user_id", "ts", (F.col("event_type") == "view").alias("right"))
    w = Window.partitionBy("user_id").orderBy("ts", F.desc("right"), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("right"), F.col("event_id")), ignorenulls=True).over(w)
    return rows.withColumn("view_id", seen).where(~F.col("right")).select("event_id", F.coalesce("view_id", F.lit(-1).cast("long")).alias("view_id"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
 round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, round(avg(l_quantity), 4) AS avg_qty,
 round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def q_ext_pricing(spark, d):
    """Pricing summary, a scan and one small aggregation."""
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    return (
        table(spark, d, "lineitem")
        .where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.sum(price), 2).alias("sum_base_price"),
            F.round(F.sum(price * (1 - disc)), 2).alias("sum_disc_price"),
            F.round(F.sum(price * (1 - disc) * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
            F.round(F.avg(price), 4).alias("avg_price"),
            F.round(F.avg(disc), 6).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
    )


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def q_ext_revenue(spark, d):
    """A star of five joins."""
    t = lambda n: table(spark, d, n)
    joined = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
