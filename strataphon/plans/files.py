"""Sources and sinks: audio files made from embeddings, and text files that are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import snapshot, telemetry
from ..session import scratch_dir, table
from ..sources import audio, documents
from ..streaming import pipeline
from .registry import query

_SAMPLES = "list_transform(embedding, lambda x: greatest(-32768, least(32767, round(x::DOUBLE * 8000)::INTEGER)))"
_RAW = "list_reduce(list_prepend('', list_transform({}, lambda x: printf('%02x%02x', (x + 65536) % 256, ((x + 65536) % 65536) // 256))), lambda a, x: a || x)"


def _folder(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _samples():
    return F.transform("embedding", lambda x: F.greatest(F.lit(-32768), F.least(F.lit(32767), F.round(x.cast("double") * 8000).cast("int"))))


def _files(spark, d):
    """A file of each vector: WAV, and FLAC by each predictor."""
    k = F.col("vec_id")
    kind = F.get(F.array(*map(F.lit, ["wav", "verbatim", "fixed", "linear"])), (k % 4).cast("int"))
    comments = F.create_map(F.lit("TITLE"), F.concat(F.lit("T"), k.cast("string")), F.lit("GENRE"), F.col("label").cast("string"))
    rows = table(spark, d, "embeddings").select(
        F.concat(F.lit("/music/"), k.cast("string"), F.lit(".x")).alias("path"), _samples().alias("samples"), comments.alias("comments"), kind.alias("kind")
    )
    return audio.audio_files(rows, 44_100)


def _vec_id():
    return F.regexp_extract("path", r"(\d+)\.x$", 1).cast("long").alias("vec_id")


@query(f"""WITH s AS (SELECT vec_id, label, {_SAMPLES} AS x FROM embeddings WHERE vec_id % 4 > 0)
SELECT vec_id, 44100 AS sample_rate, 1 AS channels, 16 AS bits_per_sample, len(x)::BIGINT AS total_samples, md5(unhex({_RAW.format('x')})) AS md5,
 md5(unhex({_RAW.format('x')})) AS header, 'T' || vec_id AS title, label::VARCHAR AS genre FROM s
UNION ALL SELECT vec_id, 0, 0, 0, 0, NULL, NULL, NULL, NULL FROM embeddings WHERE vec_id % 4 = 0""")
def q_flac_info(spark, d):
    """Stream properties, comments and digests of FLAC files; other files have none."""
    files = _files(spark, d)
    info = audio.read_flac_info(files)
    header = files.select(F.col("path").alias("p2"), audio.header_md5(F.col("content")).alias("header"))
    return info.join(header, F.col("path") == F.col("p2")).select(
        _vec_id(), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sample_rate", "channels", "bits_per_sample", "total_samples")], "md5", "header",
        F.get(F.try_element_at("tags", F.lit("title")), F.lit(0)).alias("title"), F.get(F.try_element_at("tags", F.lit("genre")), F.lit(0)).alias("genre"),
    )


@query(f"""WITH s AS (SELECT vec_id, {_SAMPLES} AS x, (vec_id % 20)::INTEGER AS a FROM embeddings), t AS (SELECT vec_id, x[a + 1 : a + 30] AS x FROM s)
SELECT vec_id, len(x)::INTEGER AS n, md5(unhex({_RAW.format('x')})) AS audio_hash, round(x[1] / 32768.0::DOUBLE, 6) AS first,
 round(list_sum(list_transform(x, lambda v: v / 32768.0::DOUBLE)), 5) AS total, false AS failed FROM t WHERE vec_id % 11 > 0
UNION ALL SELECT vec_id, 0, NULL, NULL, NULL, true FROM t WHERE vec_id % 11 = 0""")
def q_audio_slices(spark, d):
    """Slices of WAV and FLAC files decoded to waveforms; cut files fail by themselves."""
    files = _files(spark, d).select("path", "content", _vec_id())
    cut = F.when(F.col("vec_id") % 11 == 0, F.substring("content", 1, 20)).otherwise(F.col("content"))
    start = F.col("vec_id") % 20
    rows = audio.read_slices(files.select("path", cut.alias("content"), start.alias("start"), (start + 30).alias("end")))
    y = F.transform("y", lambda v: v.cast("double"))
    total = F.aggregate(y, F.lit(0.0), lambda a, v: a + v)
    return rows.select(
        _vec_id(), F.when(F.col("y").isNotNull(), F.size("y")).otherwise(0).alias("n"), "audio_hash", F.round(F.get(y, F.lit(0)), 6).alias("first"),
        F.round(total, 5).alias("total"), F.col("error").isNotNull().alias("failed"),
    )


@query("""SELECT n_regionkey::INTEGER AS region, count(*) AS names, true AS listed, true AS stale, false AS fresh FROM nation GROUP BY 1""")
def q_list_files(spark, d):
    """Files below a folder by suffix, whatever its case, and those that are older than some hours."""
    root = _folder(spark, "files")
    rows = table(spark, d, "nation").select(F.col("n_name").alias("value"), F.col("n_regionkey").cast("int").alias("region"))
    rows.write.partitionBy("region").text(root)
    files = audio.list_files(spark, root, "TXT")
    old = lambda hours: audio.orphans(files, F.current_timestamp() + F.make_dt_interval(hours=F.lit(hours)), 1).select("path")
    region = F.regexp_extract("path", r"region=(\d+)", 1).cast("int").alias("region")
    marks = files.join(old(2).withColumn("stale", F.lit(True)), "path", "left").join(old(0).withColumn("fresh", F.lit(True)), "path", "left")
    found = marks.groupBy(region).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(c) for c in ("stale", "fresh")])
    names = spark.read.text(root).groupBy("region").agg(F.count(F.lit(1)).alias("names"))
    return names.join(found, "region").select("region", "names", F.lit(True).alias("listed"), "stale", "fresh")


@query("""SELECT event_id, event_type AS stage, 'w"' || user_id AS worker, value AS sample FROM events""")
def q_metrics_scrape(spark, d):
    """Exposition text written and scraped, with comments, escapes and time stamps."""
    root = _folder(spark, "metrics")
    line = F.format_string('stage_seconds{id="%d",stage="%s",worker="w\\"%d"} %s 1700000000000', "event_id", "event_type", "user_id", F.col("value").cast("string"))
    lines = F.explode(F.array(F.lit("# TYPE stage_seconds gauge"), line))
    table(spark, d, "events").select(lines.alias("value")).write.text(root)
    at = lambda k: F.col("labels")[k]
    return documents.read_metrics(spark, root).select(
        at("id").cast("long").alias("event_id"), at("stage").alias("stage"), F.replace(at("worker"), F.lit('\\"'), F.lit('"')).alias("worker"), "sample"
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status, '{}' AS tensor FROM orders""")
def q_queue_documents(spark, d):
    """Queue documents written and read back: invalid and missing ones are empty; the queue is removed after."""
    root = _folder(spark, "queue")
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    good = F.to_json(F.struct(F.col("o_totalprice").alias("p")))
    main = orders.select(key.alias("audio_hash"), F.when(key % 5 == 0, '{"p": ').otherwise(good).alias("doc"))
    predictions = orders.where(key % 3 > 0).select(key.alias("audio_hash"), F.to_json(F.struct(F.col("o_orderstatus").alias("s"))).alias("doc"))
    documents.write_queue({"main": main, "predictions": predictions}, root)
    read = documents.read_queue(spark, root)
    out = read.select(
        F.col("audio_hash").cast("long").alias("o_orderkey"), F.get_json_object("main", "$.p").cast("double").alias("price"),
        F.get_json_object("predictions", "$.s").alias("status"), "tensor",
    )
    kept = documents.write_report(out)
    documents.remove_queue(spark, root)
    return kept


@query("""SELECT doc_id FROM documents WHERE lang <> 'fr' AND doc_id % 3 > 0""")
def q_done_list(spark, d):
    """Names appended to a done list in two runs, one of them twice; what is left to do."""
    root, docs = _folder(spark, "done"), table(spark, d, "documents").select("doc_id", "lang")
    documents.append_done(docs.where("lang = 'fr'"), root, "doc_id")
    documents.append_done(docs.where("doc_id % 3 = 0"), root, "doc_id")
    files = docs.select(F.col("doc_id").cast("string").alias("path"))
    return documents.not_done(files, documents.read_done(spark, root)).select(F.col("path").cast("long").alias("doc_id"))


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 7 < 2 THEN NULL ELSE user_id END AS file, lpad(event_id::VARCHAR, 12, '0') AS k FROM events)
SELECT event_id, CASE WHEN file IS NULL THEN 400 WHEN row_number() OVER (PARTITION BY file ORDER BY k) = 1 THEN 202 ELSE 200 END::INTEGER AS code,
 file::VARCHAR AS path FROM t""")
def q_task_intake(spark, d):
    """Requests by JSON line: taken, refused, or known already."""
    k = F.col("event_id")
    text = F.format_string('{"album":"%s","flacPath":"%d"}', F.lpad(k.cast("string"), 12, "0"), "user_id")
    text = F.when(k % 7 == 0, '{"flacPath":').when(k % 7 == 1, '{"flacPath":" "}').otherwise(text)
    rows = documents.checked_tasks(table(spark, d, "events").select("event_id", text.alias("value")), pipeline.TASK_SCHEMA)
    return rows.select("event_id", "code", F.col("task.flacPath").alias("path"))


@query("""SELECT event_id, event_type AS stage, (props->>'$.k')::INTEGER AS amount FROM events WHERE contains(props, '1')""")
def q_log_fields(spark, d):
    """Log lines by content, their JSON parsed and fields renamed."""
    rows = documents.log_fields(table(spark, d, "events").select("event_id", "event_type", "props"), "props", "1", "k int", {"k": "amount"})
    return rows.select("event_id", F.col("event_type").alias("stage"), "amount")


@query("""SELECT file_path, 0 AS track_number, arg_min(status, o_orderkey) AS status FROM (SELECT o_custkey AS file_path, o_orderstatus AS status, o_orderkey FROM orders) GROUP BY 1""")
def q_state_migration(spark, d):
    """States of files under the key of file and track; of rows that then share a key the first stays."""
    orders = table(spark, d, "orders")
    states = orders.select(F.col("o_custkey").alias("file_path"), F.col("o_orderstatus").alias("status"), "o_orderkey")
    out = snapshot.migrate_states(states, ["file_path", "track_number"], {"track_number": F.lit(0)}, F.col("o_orderkey"))
    again = snapshot.migrate_states(out, ["file_path", "track_number"], {"track_number": F.lit(1)}, F.col("o_orderkey"))
    return again.select("file_path", "track_number", "status")


_UPDATE = "CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'F' THEN l_quantity ELSE l_quantity + 1 END"


@query(f"""WITH p AS (SELECT l_quantity AS a, {_UPDATE} AS b FROM lineitem)
SELECT 'plan' AS part, count(*) FILTER (WHERE b <> a) AS changed, count(*) FILTER (WHERE a = b) AS skipped, count(*) FILTER (WHERE b IS NULL) AS failed, round(sum(coalesce(b, a)), 2) AS total FROM p""")
def q_planned_update(spark, d):
    """A batched update: what it would do, counted, and the rows after it."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    lines = lines.groupBy("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    lines = lines.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).drop("n")
    keys = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "copy"]
    rows = lines.withColumn("v", F.col("l_quantity"))
    plan = snapshot.planned_update(rows, keys, "v", F.expr(_UPDATE))
    total = snapshot.apply_update(rows, plan, keys, "v").agg(F.lit("plan").alias("part"), F.round(F.sum("v"), 2).alias("total"))
    return snapshot.outcomes(plan).select(F.lit("plan").alias("part"), "*").join(total, "part")


@query("""WITH m AS (SELECT (['task_duration','file_duration','stage_duration','demucs_wait','tensor_wait','gatekeeper_wait','shm_alloc_duration','python_stage_duration','gpu_wait'])[1 + event_id % 9] AS metric, value FROM events),
 b(metric, les) AS (VALUES ('task_duration', [1,2,5,10,15,20,30,45,60,90,120,180,300]::DOUBLE[]), ('file_duration', [2,5,10,20,30,45,60,90,120,180,240,360,600]),
 ('stage_duration', [0.01,0.05,0.1,0.25,0.5,1,2,5,10,20,30,60,120]), ('demucs_wait', [0.1,0.5,1,2,5,10,20,30,60,120,300]), ('tensor_wait', [0.05,0.1,0.5,1,2,5,10,20,30,60]),
 ('gatekeeper_wait', [1,5,10,20,30,60,120,300]), ('shm_alloc_duration', [0.001,0.005,0.01,0.05,0.1,0.5,1,2,5]), ('python_stage_duration', [0.005,0.01,0.05,0.1,0.25,0.5,1,2,5,10,20,30,60]),
 ('gpu_wait', [0.5,1,2,5,10,20,30,60,120]))
SELECT metric, le, count(*) FILTER (WHERE value <= le) AS n FROM m JOIN (SELECT metric, unnest(les) AS le FROM b) USING (metric) GROUP BY ALL""")
def q_metric_histograms(spark, d):
    """Cumulative buckets of nine metrics, each by its own bounds."""
    names = F.array(*map(F.lit, telemetry.BOUNDS))
    rows = table(spark, d, "events").select(F.get(names, (F.col("event_id") % 9).cast("int")).alias("metric"), "value")
    return telemetry.metric_histograms(rows, "metric", "value")
