"""Snapshots, history, dead letters and task states on the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jsonb, tags
from ..operators import snapshot
from ..session import table
from .registry import query

_COLS = "o_orderkey, o_orderstatus, o_totalprice"
_BASE = "base AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT')"
_BATCH = "batch AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'O')"


def _sides(spark, d):
    orders = table(spark, d, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    batch = orders.where("o_orderstatus <> 'O'").select(columns)
    batch = batch.withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return orders.where("o_orderpriority <> '1-URGENT'").select(columns), batch


@query(f"""WITH {_BASE}, {_BATCH}
SELECT o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus, coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice
FROM base a FULL JOIN batch b USING (o_orderkey)""")
def q_upsert_latest(spark, d):
    """Insert or overwrite by key."""
    return snapshot.upsert(*_sides(spark, d), ["o_orderkey"])


@query(f"""WITH {_BASE}, {_BATCH}
SELECT a.o_orderkey, a.o_orderstatus, a.o_totalprice, '2024-01-01' AS archived_at FROM base a JOIN batch b USING (o_orderkey)
WHERE a.o_totalprice IS DISTINCT FROM CASE WHEN a.o_orderkey % 4 = 0 THEN a.o_totalprice ELSE b.o_totalprice END""")
def q_history_changed(spark, d):
    """Rows whose document changed by value; other spelling of the same value is no change."""
    base, batch = _sides(spark, d)
    doc = lambda price, form: F.format_string(form, price.cast("string"))
    old = base.withColumn("doc", doc(F.col("o_totalprice"), '{"p":%s,"q":1}'))
    same = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice"))
    new = batch.withColumn("doc", doc(F.round(same, 2), '{ "q": 1.0, "p": %s }'))
    old = old.withColumn("doc", doc(F.round("o_totalprice", 2), '{"p":%s,"q":1}'))
    out = snapshot.history_of(old, new, ["o_orderkey"], ["doc"], F.lit("2024-01-01"))
    return out.drop("doc")


@query(f"""WITH {_BASE}, {_BATCH}, good AS (SELECT * FROM batch WHERE o_totalprice > 100000)
SELECT 'snapshot' AS part, count(*) AS n, round(sum(p), 2) AS price FROM
  (SELECT coalesce(b.o_totalprice, a.o_totalprice) AS p FROM base a FULL JOIN good b USING (o_orderkey))
UNION ALL SELECT 'letters', count(*), round(sum(o_totalprice), 2) FROM batch WHERE NOT o_totalprice > 100000""")
def q_dlq_replay(spark, d):
    """Dead letters that now succeed enter the snapshot, the others stay."""
    base, letters = _sides(spark, d)
    new, left = snapshot.replay_dead_letters(base, letters, F.col("o_totalprice") > 100000, ["o_orderkey"])
    count = lambda df, part: df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price"))
    return count(new, "snapshot").union(count(left, "letters"))


@query("""SELECT doc_id, audio_hash FROM (SELECT doc_id, md5(text) AS audio_hash,
  row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def q_dedup_hash(spark, d):
    """First row of each content hash."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return snapshot.dedup_by_content(docs, "text", F.col("doc_id")).select("doc_id", "audio_hash")


@query("""SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_not_ingested(spark, d):
    """Anti-join: keys that the store does not hold yet."""
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def q_hash_exists(spark, d):
    """Semi-join: keys that exist."""
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")


@query("""SELECT coalesce(in_d, false) AS in_files, coalesce(in_l, false) AS in_db, count(*) AS n, min(doc_id) AS first_id FROM
 (SELECT doc_id, true AS in_d FROM documents WHERE lang <> 'fr') FULL JOIN (SELECT doc_id, true AS in_l FROM labels) USING (doc_id)
GROUP BY ALL""")
def q_full_reconcile(spark, d):
    """Keys in the files, in the store or in both."""
    files = table(spark, d, "documents").where("lang <> 'fr'").select("doc_id")
    both = snapshot.reconcile(files, table(spark, d, "labels").select("doc_id"), ["doc_id"])
    return both.groupBy(F.col("in_left").alias("in_files"), F.col("in_right").alias("in_db")).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")
    )


@query("""SELECT p.page_id, q.page_id AS other_id FROM pages p JOIN
 (SELECT page_id, upper(replace(url, '/', chr(92))) AS url FROM pages) q
 ON regexp_replace(lower(regexp_replace(trim(p.url), '[' || chr(92) || chr(92) || '/]+', '/', 'g')), '/$', '')
  = regexp_replace(lower(regexp_replace(trim(q.url), '[' || chr(92) || chr(92) || '/]+', '/', 'g')), '/$', '')""")
def q_path_join(spark, d):
    """Join on paths that differ in slashes and case."""
    pages = table(spark, d, "pages").select("page_id", "url")
    other = pages.select(F.col("page_id").alias("other_id"), F.upper(F.translate("url", "/", "\\")).alias("u2"))
    return pages.join(other, tags.path_key(F.col("url")) == tags.path_key(F.col("u2"))).select("page_id", "other_id")


@query("""SELECT page_id, list_last(string_split(url, '/')) AS name,
 regexp_replace(url, '/[^/]*$', '') AS folder FROM pages""")
def q_path_parts(spark, d):
    """Base and folder name."""
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", tags.base_name(url).alias("name"), tags.dir_name(url).alias("folder"))


@query("""SELECT l.doc_id, l.quality::VARCHAR AS quality, CASE WHEN l.toxic = 1 THEN 'late' ELSE d.lang END AS lang, d.source AS source
FROM labels l JOIN documents d USING (doc_id)""")
def q_doc_merge(spark, d):
    """Maps of three documents merged per key, the later one wins."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    one = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    two = F.create_map(F.lit("quality"), F.col("quality").cast("string"))
    three = F.when(F.col("toxic") == 1, F.create_map(F.lit("lang"), F.lit("late")))
    merged = jsonb.merge_maps(jsonb.merge_maps(one, two), three)
    out = labels.join(docs, "doc_id").select("doc_id", merged.alias("m"))
    return out.select("doc_id", *[F.col("m")[k].alias(k) for k in ("quality", "lang", "source")])


@query("""WITH s AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'COMPLETED' WHEN 3 THEN 'FAILED' END AS st,
  o_orderkey % 7 = 0 AS f FROM orders)
SELECT o_orderkey, (st IS NULL OR st = 'FAILED' OR f) AS run, CASE WHEN st IS NULL OR st = 'FAILED' OR f THEN 'PENDING' ELSE st END AS status FROM s""")
def q_state_machine(spark, d):
    """Which requests run, given the states that are stored."""
    keys = table(spark, d, "orders").select("o_orderkey")
    names = F.array(*map(F.lit, ["PENDING", "RUNNING", "COMPLETED", "FAILED"]))
    states = keys.withColumn("status", F.get(names, (F.col("o_orderkey") % 5).cast("int"))).where("status is not null")
    requests = keys.withColumn("force", F.col("o_orderkey") % 7 == 0)
    return snapshot.admit(states, requests, ["o_orderkey"]).select("o_orderkey", "run", "status")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'FAILED' WHEN o_orderkey % 4 = 2 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
 CASE WHEN o_orderkey % 4 < 2 THEN 'interrupted' END AS error_message FROM orders""")
def q_stale_recovery(spark, d):
    """Restart: waiting and running tasks have failed."""
    names = F.array(*map(F.lit, ["PENDING", "RUNNING", "COMPLETED", "FAILED"]))
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.get(names, (F.col("o_orderkey") % 4).cast("int")).alias("status"), F.lit(None).cast("string").alias("error_message")
    )
    return snapshot.recover_stale(rows)


@query("""SELECT c_custkey, c_name AS artist, NULL::INTEGER AS track_number FROM customer""")
def q_schema_evolution(spark, d):
    """A renamed and an added column."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    return snapshot.evolve(rows, {"c_name": "artist"}, {"track_number": "int"})


@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN 'kept' ELSE coalesce(l.quality::VARCHAR, 'unknown') END AS meta
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_fill_empty(spark, d):
    """Empty documents filled from a second source."""
    meta = F.when(F.col("doc_id") % 2 == 0, F.lit('"kept"')).otherwise(F.lit("{ }"))
    rows = table(spark, d, "documents").select("doc_id", meta.alias("meta"))
    out = rows.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    filled = F.coalesce(F.col("quality").cast("string"), F.lit("unknown"))
    return out.select("doc_id", F.when(jsonb.is_empty(F.col("meta")), filled).otherwise(F.lit("kept")).alias("meta"))


@query("""SELECT o_orderkey, o_totalprice AS before, o_totalprice + 1 AS after FROM orders WHERE o_orderstatus = 'P'""")
def q_migration_diff(spark, d):
    """A dry run: only rows that a transform changes."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("v"))
    after = rows.withColumn("v", F.when(F.col("o_orderstatus") == "P", F.col("v") + 1).otherwise(F.col("v")))
    return snapshot.migration_diff(rows, after, ["o_orderkey"], "v")


@query("""WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS id FROM orders)
SELECT k, coalesce(id, (SELECT max(id) FROM s) + row_number() OVER (PARTITION BY id IS NULL ORDER BY k)) AS id FROM s""")
def q_surrogate_ids(spark, d):
    """New rows get the next ids, without a global window."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.alias("k"), F.when(k % 3 == 0, k).alias("id"))
    return snapshot.with_new_ids(rows, "id", ["k"])


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01' OR o_orderdate >= TIMESTAMP '1996-01-01'""")
def q_delete_range(spark, d):
    """Delete by range: the rows that stay."""
    gone = (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp")) & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))
    return table(spark, d, "orders").where(~gone).select("o_orderkey", "o_orderdate")
