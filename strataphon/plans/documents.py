"""Analytical queries over semi-structured track documents, on the tables that stand in for them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import jsonb
from ..operators.snapshot import unpivot
from ..session import table
from .registry import query

STEMS = ["mix", "bass", "drums", "other", "piano", "guitar", "vocals"]


@query("""
WITH h AS (
  SELECT vec_id, list_avg(list_transform(embedding[1:32], lambda x: x::DOUBLE * x::DOUBLE)) AS a,
         list_avg(list_transform(embedding[33:], lambda x: x::DOUBLE * x::DOUBLE)) AS b FROM embeddings)
SELECT vec_id, round(a, 6) AS first_half, round(b, 6) AS second_half, round(b - a, 6) AS delta
FROM h ORDER BY round(b - a, 6) DESC NULLS FIRST, vec_id LIMIT 20
""")
def q_energy_halves(spark, d):
    """Mean energy of both halves of a sequence and the change, largest rise first."""
    e = A.doubles(F.col("embedding"))
    first, second = A.energy(F.slice(e, 1, 32)), A.energy(F.slice(e, 33, 1 << 30))
    return (
        table(spark, d, "embeddings")
        .select(
            "vec_id",
            F.round(first, 6).alias("first_half"),
            F.round(second, 6).alias("second_half"),
            F.round(second - first, 6).alias("delta"),
        )
        .orderBy(F.desc_nulls_first("delta"), "vec_id")
        .limit(20)
    )


@query("""
WITH latest AS (SELECT event_id, ts, event_type, '{"mix":' || props || ',"demucs":{"bass":' || props || ',"drums":{"k":null}}}' AS doc
                FROM events ORDER BY ts DESC, event_id DESC LIMIT 10)
SELECT event_id, stem, value FROM (
  SELECT event_id, 'mix' AS stem, doc->>'$.mix.k' AS value FROM latest
  UNION ALL SELECT event_id, 'bass', doc->>'$.demucs.bass.k' FROM latest
  UNION ALL SELECT event_id, 'drums', doc->>'$.demucs.drums.k' FROM latest
  UNION ALL SELECT event_id, 'other', doc->>'$.demucs.other.k' FROM latest
  UNION ALL SELECT event_id, 'piano', doc->>'$.demucs.piano.k' FROM latest
  UNION ALL SELECT event_id, 'guitar', doc->>'$.demucs.guitar.k' FROM latest
  UNION ALL SELECT event_id, 'vocals', doc->>'$.demucs.vocals.k' FROM latest) WHERE value IS NOT NULL
""")
def q_latest_unpivot(spark, d):
    """The ten latest documents, one row per stem that has a value, from one scan."""
    doc = F.concat(F.lit('{"mix":'), F.col("props"), F.lit(',"demucs":{"bass":'), F.col("props"), F.lit(',"drums":{"k":null}}}'))
    latest = table(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(10).select("event_id", doc.alias("doc"))
    path = lambda s: ("mix", "k") if s == "mix" else ("demucs", s, "k")
    branches = {s: jsonb.path_text(F.col("doc"), *path(s)) for s in STEMS}
    return unpivot(latest, ["event_id"], branches, "stem", "value").where("value IS NOT NULL")


@query("""
SELECT event_id, round((props->>'$.k')::DOUBLE, 2) AS k, round(value, 4) AS value FROM events
WHERE (props->>'$.k')::DOUBLE > 50 ORDER BY round((props->>'$.k')::DOUBLE, 2) DESC NULLS FIRST, event_id LIMIT 20
""")
def q_json_topk(spark, d):
    """Numeric predicate and order on a document value."""
    k = jsonb.path_number(F.col("props"), "k", scale=2).cast("double")
    return (
        table(spark, d, "events")
        .select("event_id", k.alias("k"), F.round("value", 4).alias("value"))
        .where("k > 50")
        .orderBy(F.desc_nulls_first("k"), "event_id")
        .limit(20)
    )


@query("""
WITH t AS (SELECT unnest(string_split(text, ' ')) AS tag FROM documents)
SELECT tag, count(*) AS cnt FROM t WHERE tag <> '' GROUP BY tag ORDER BY cnt DESC, tag LIMIT 20
""")
def q_tag_ranking(spark, d):
    """Frequencies of unnested array elements; rows of empty arrays vanish."""
    tags = table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("tag")).where("tag <> ''")
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "tag").limit(20)


@query("""
SELECT vec_id, round(list_avg(list_transform(embedding[1:9], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS mix,
  round(list_avg(list_transform(embedding[10:18], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS bass,
  round(list_avg(list_transform(embedding[19:27], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS drums,
  round(list_avg(list_transform(embedding[28:36], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS other,
  round(list_avg(list_transform(embedding[37:45], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS piano,
  round(list_avg(list_transform(embedding[46:54], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS guitar,
  round(list_avg(list_transform(embedding[55:63], lambda x: x::DOUBLE * x::DOUBLE)), 4) AS vocals
FROM embeddings
""")
def q_stem_energy(spark, d):
    """Energy of seven segments as columns."""
    e = A.doubles(F.col("embedding"))
    columns = [F.round(A.energy(F.slice(e, 9 * k + 1, 9)), 4).alias(s) for k, s in enumerate(STEMS)]
    return table(spark, d, "embeddings").select("vec_id", *columns)


@query("""
SELECT event_type, round(avg((props->>'$.k')::DOUBLE), 4) AS mean_k, round(avg(value), 4) AS mean_value,
       count(*) AS n FROM events GROUP BY event_type ORDER BY event_type
""")
def q_group_means(spark, d):
    """Means of document values per group."""
    k = jsonb.path_text(F.col("props"), "k").try_cast("double")
    return (
        table(spark, d, "events")
        .groupBy("event_type")
        .agg(F.round(F.avg(k), 4).alias("mean_k"), F.round(F.avg("value"), 4).alias("mean_value"), F.count(F.lit(1)).alias("n"))
        .orderBy("event_type")
    )


_SYMBOLS = """
WITH f AS (SELECT vec_id, i, embedding[8*i+1:8*i+8] AS w FROM embeddings, unnest(range(8)) t(i)),
     s AS (SELECT vec_id, (list_position(w, list_max(w)) - 1)::INTEGER AS symbol FROM f)
"""


@query(_SYMBOLS + "SELECT symbol, count(*) AS cnt FROM s GROUP BY symbol")
def q_symbol_freq(spark, d):
    """How often each symbol of the unnested sequences occurs."""
    return _symbols(table(spark, d, "embeddings")).groupBy("symbol").agg(F.count(F.lit(1)).alias("cnt"))


@query(_SYMBOLS + """SELECT vec_id, count(DISTINCT symbol) AS variety, count(*) AS frames FROM s
GROUP BY vec_id ORDER BY variety DESC, vec_id LIMIT 20""")
def q_symbol_variety(spark, d):
    """Distinct symbols per sequence, without a shuffle but for the top rows."""
    s = F.transform(A.frames(F.col("embedding"), 8), A.argmax)
    return (
        table(spark, d, "embeddings")
        .select("vec_id", F.size(F.array_distinct(s)).cast("long").alias("variety"), F.size(s).cast("long").alias("frames"))
        .orderBy(F.desc("variety"), "vec_id")
        .limit(20)
    )


def _symbols(df):
    return df.select("vec_id", F.explode(F.transform(A.frames(F.col("embedding"), 8), A.argmax)).alias("symbol"))


@query("""SELECT vec_id, len(embedding)::INTEGER AS frames, 2::INTEGER AS rows, (vec_id % 7)::INTEGER AS second, embedding[1]::DOUBLE AS first, embedding[2]::DOUBLE AS inner FROM embeddings""")
def q_shape_probe(spark, d):
    """Lengths of arrays in documents, nested ones too, and single elements by subscript."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    part = F.slice(e, F.lit(1), (F.col("vec_id") % 7).cast("int"))
    doc = F.to_json(F.struct(e.alias("a"), F.array(e, part).alias("nested")))
    size = lambda path: F.json_array_length(F.get_json_object("doc", path))
    item = lambda path: F.get_json_object("doc", path).cast("double")
    return table(spark, d, "embeddings").select("vec_id", doc.alias("doc")).select(
        "vec_id", size("$.a").alias("frames"), size("$.nested").alias("rows"), size("$.nested[1]").alias("second"),
        item("$.a[0]").alias("first"), item("$.nested[0][1]").alias("inner"),
    )


@query("""SELECT d.doc_id, d.lang, coalesce(l.quality, -1)::INTEGER AS quality, row_number() OVER (PARTITION BY d.lang ORDER BY l.quality DESC NULLS LAST, d.doc_id) AS place FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_nulls_last(spark, d):
    """Falling order with unknown values at the end, per language."""
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    w = Window.partitionBy("lang").orderBy(F.desc_nulls_last("quality"), "doc_id")
    return rows.select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).cast("int").alias("quality"), F.row_number().over(w).alias("place"))


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def q_status_hist(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P')")
def q_progress_count(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "P")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'P'
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def q_recent_running(spark, d):
    """The ten most recent rows of one status."""
    rows = table(spark, d, "orders").where("o_orderstatus = 'P'")
    return rows.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10).select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("""
WITH x AS (SELECT event_id % 7 AS r, CASE event_id % 7 WHEN 0 THEN '{"a":[1,2]}' WHEN 1 THEN '{"a":null}' WHEN 2 THEN '{}'
  WHEN 3 THEN '{"a":{"b":1}}' WHEN 4 THEN '{"a":"s"}' WHEN 5 THEN '{"a":true}' ELSE '{"a":1.0}' END AS doc FROM events)
SELECT r, CASE WHEN r IN (2) THEN false ELSE true END AS present,
  CASE json_type(doc, '$.a') WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' WHEN 'VARCHAR' THEN 'string'
    WHEN 'BOOLEAN' THEN 'boolean' WHEN NULL THEN NULL WHEN 'DOUBLE' THEN 'number' END AS kind,
  (r = 2) AS empty_doc, count(*) AS n FROM x GROUP BY ALL
""")
def q_json_kinds(spark, d):
    """Presence, type and emptiness of document values: a JSON null is present but has no text."""
    samples = ['{"a":[1,2]}', '{"a":null}', "{}", '{"a":{"b":1}}', '{"a":"s"}', '{"a":true}', '{"a":1.0}']
    doc = F.get(F.array(*map(F.lit, samples)), F.col("r").cast("int"))
    rows = table(spark, d, "events").select((F.col("event_id") % 7).alias("r")).withColumn("doc", doc)
    return rows.groupBy(
        "r", jsonb.present(F.col("doc"), "a").alias("present"), jsonb.kind(F.col("doc"), "a").alias("kind"), jsonb.is_empty(F.col("doc")).alias("empty_doc")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT turn, CASE WHEN turn % 2 = 0 THEN role || ' / ' || turn::VARCHAR ELSE role END AS artist, count(*) AS n
FROM conversations GROUP BY ALL
""")
def q_flexible_string(spark, d):
    """Fields that hold a JSON string or an array of strings."""
    raw = F.when(F.col("turn") % 2 == 0, F.to_json(F.array("role", F.col("turn").cast("string")))).otherwise(
        F.concat(F.lit('"'), F.col("role"), F.lit('"'))
    )
    rows = table(spark, d, "conversations").select("turn", jsonb.flexible_string(raw).alias("artist"))
    return rows.groupBy("turn", "artist").agg(F.count(F.lit(1)).alias("n"))
