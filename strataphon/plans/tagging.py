"""Cue sheets, tags and class probabilities on conversations (files of turns) and events (predictions)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import tags
from ..session import table
from ..sources import documents
from .registry import query

_BOUNDS = """c AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations),
 p AS (SELECT conv_id, turn, role, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos,
   (sum(n) OVER (PARTITION BY conv_id))::BIGINT AS total FROM c),
 s AS (SELECT conv_id, turn, role, total * 588 AS total_samples, pos,
   ((((pos // 75) // 60) * 60 + (pos // 75) % 60 + (pos % 75) / 75.0::DOUBLE) * 44100) AS seconds FROM p)"""


def _positions(spark, d):
    """Turn starts in frames of 1/75 s, one character a frame."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    w = Window.partitionBy("conv_id")
    before = F.sum("n").over(w.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    return rows.select("conv_id", "turn", "role", F.coalesce(before, F.lit(0)).cast("long").alias("pos"), F.sum("n").over(w).cast("long").alias("total"))


@query(f"""WITH {_BOUNDS}, b AS (SELECT conv_id, turn, trunc(seconds)::BIGINT AS start, total_samples AS total FROM s)
SELECT conv_id, turn, start, least("end", total) AS "end" FROM
 (SELECT *, lead(start, 1, total) OVER (PARTITION BY conv_id ORDER BY turn) AS "end" FROM b) WHERE start < total AND least("end", total) > start""")
def q_track_bounds(spark, d):
    """Each track ends where the next begins; empty ones go."""
    pos = F.col("pos")
    at = tags.cue_samples(F.floor(pos / 4500), F.floor(pos / 75) % 60, pos % 75, 44100)
    rows = _positions(spark, d).select("conv_id", "turn", at.alias("start"), (F.col("total") * 588).alias("total"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = rows.withColumn("end", F.least(F.coalesce(F.lead("start").over(w), F.col("total")), F.col("total")))
    return rows.where((F.col("start") < F.col("total")) & (F.col("end") > F.col("start"))).select("conv_id", "turn", "start", "end")


@query(f"""WITH {_BOUNDS}, b AS (SELECT conv_id, turn, role, trunc(seconds)::BIGINT AS start, total_samples AS total FROM s)
SELECT conv_id, 'Album ' || conv_id AS album, (turn + 1)::INTEGER AS track, start, least("end", total) AS "end", 'Turn ' || turn AS title, role AS artist FROM
 (SELECT *, lead(start, 1, total) OVER (PARTITION BY conv_id ORDER BY turn) AS "end" FROM b) WHERE start < total AND least("end", total) > start""")
def q_cue_parse(spark, d):
    """Cue sheets written from the turns and parsed back, with mixed case and optional quotes."""
    pos = F.col("pos")
    entry = F.format_string(
        '  TRACK %02d AUDIO\r\n    title "Turn %d"\n    PERFORMER %s\n    INDEX 00 00:00:00\n    index 01 %02d:%02d:%02d',
        F.col("turn") + 1, F.col("turn"), F.col("role"), F.floor(pos / 4500), F.floor(pos / 75) % 60, pos % 75,
    )
    rows = _positions(spark, d).select("conv_id", "turn", "total", entry.alias("e"))
    sheet = rows.groupBy("conv_id").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct((-F.col("turn")).alias("k"), "e"))).alias("es"))
    head = F.concat(F.lit('PERFORMER "Band"\nTITLE "Album '), F.col("conv_id").cast("string"), F.lit('"\n'))
    text = F.concat(head, F.array_join(F.transform("es", lambda x: x["e"]), "\n"))
    parsed = sheet.select("conv_id", (F.col("total") * 588).alias("total"), tags.parse_cue(text, 44100).alias("c"))
    out = parsed.select("conv_id", F.col("c.album").alias("album"), F.inline(tags.track_slices(F.col("c.tracks"), F.col("total"))))
    return out.select("conv_id", "album", "track", "start", "end", "title", "artist")


@query("""SELECT conv_id, turn, turn::INTEGER AS number, 'title' AS name FROM conversations""")
def q_tag_pattern(spark, d):
    """Track number and name out of tag keys."""
    key = F.concat(F.when(F.col("turn") % 2 == 0, "cue_track_").otherwise("track"), F.lpad(F.col("turn").cast("string"), 2, "0"), F.lit("_title"))
    pick = lambda k: F.regexp_extract(key, tags.TRACK_TAG, k)
    return table(spark, d, "conversations").select("conv_id", "turn", pick(1).cast("int").alias("number"), pick(2).alias("name"))


@query("""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN role WHEN 1 THEN 'sorted' WHEN 2 THEN 'file' ELSE 'played' END AS artist,
 turn::INTEGER AS number, CASE WHEN turn % 2 = 0 THEN '["a","b"]' ELSE '"a"' END AS genre FROM conversations""")
def q_track_meta(spark, d):
    """Tag fallbacks, track numbers and multi-value tags."""
    turn = F.col("turn")
    num = F.lpad(turn.cast("string"), 2, "0")
    cases = [
        F.create_map(F.concat(F.lit("CUE_Track"), num, F.lit("_ARTIST")), F.col("role")),
        F.create_map(F.concat(F.lit("cue_track"), num, F.lit("_artistsort")), F.lit("sorted")),
        F.create_map(F.lit("Artist"), F.lit("file")),
        F.create_map(F.concat(F.lit("cue_track_"), turn.cast("string"), F.lit("_performer")), F.lit("played")),
    ]
    m = F.when(turn % 4 == 0, cases[0]).when(turn % 4 == 1, cases[1]).when(turn % 4 == 2, cases[2]).otherwise(cases[3])
    genre = F.when(turn % 2 == 0, F.array(F.lit("a"), F.lit(" "), F.lit("b"))).otherwise(F.array(F.lit("a")))
    slash = F.concat(turn.cast("string"), F.when(turn % 2 == 0, "/12").otherwise("-12"))
    return table(spark, d, "conversations").select(
        "conv_id", "turn", tags.track_tag(tags.lower_keys(m), turn, "artist", "ARTIST").alias("artist"),
        tags.track_number(slash).alias("number"), tags.multi_value(genre).alias("genre"),
    )


@query("""SELECT conv_id, turn, 'T' || turn AS title, 'x' AS album, 2::INTEGER AS n FROM conversations""")
def q_own_tags(spark, d):
    """Own track tags lose the prefix, other tracks' go."""
    turn = F.col("turn").cast("int")
    key = lambda k: F.concat(F.lit("TRACK"), k.cast("string"), F.lit("_TITLE"))
    m = F.create_map(key(turn), F.concat(F.lit("T"), turn.cast("string")), key(turn + 1), F.lit("other"), F.lit("album"), F.lit("x"))
    own = tags.own_track_tags(m, turn)
    return table(spark, d, "conversations").select("conv_id", "turn", own.alias("m")).select(
        "conv_id", "turn", F.col("m")["title"].alias("title"), F.col("m")["album"].alias("album"), F.size("m").alias("n")
    )


_CLASSES = """g AS (SELECT user_id, event_type, sum(value) AS v FROM events GROUP BY 1, 2),
 p AS (SELECT user_id, event_type AS c, floor(1000 * v / sum(v) OVER (PARTITION BY user_id)) / 1000 AS p FROM g)"""


def _classes(spark, d):
    g = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"))
    p = F.floor(1000 * F.col("v") / F.sum("v").over(Window.partitionBy("user_id"))) / 1000
    g = g.select("user_id", F.struct(F.col("event_type").alias("class"), p.alias("p")).alias("x"))
    return g.groupBy("user_id").agg(F.array_sort(F.collect_list("x")).alias("items"))


@query(f"""WITH {_CLASSES} SELECT user_id, string_agg(c, '; ' ORDER BY p DESC, c) AS top5 FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, c) AS r FROM p) WHERE r <= 5 GROUP BY 1""")
def q_top5_classes(spark, d):
    """Five likeliest classes; ties keep their order."""
    return _classes(spark, d).select("user_id", tags.top_classes(F.col("items")).alias("top5"))


@query(f"""WITH {_CLASSES}, m AS (SELECT *, max(p) OVER (PARTITION BY user_id) AS top, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, c) AS r FROM p)
SELECT user_id, string_agg(c || ':' || trunc(p * 1000)::INTEGER, ',' ORDER BY p DESC, c) AS packed FROM m WHERE p >= 0.3 OR (top < 0.3 AND r = 1) GROUP BY 1""")
def q_pack_multi(spark, d):
    """Classes above a threshold, or the best one."""
    return _classes(spark, d).select("user_id", F.array_join(tags.pack_classes(F.col("items"), 0.3), ",").alias("packed"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'GENRE_ROSAMERICA' WHEN event_id % 3 = 1 THEN 'NEW_MODEL' ELSE 'UNKNOWN' END AS model,
 CASE WHEN event_id % 3 = 0 THEN 'A_' || event_type WHEN event_id % 3 = 1 THEN 'X' ELSE 'PLAIN' END AS class, round(CASE WHEN event_id % 2 = 0 THEN 0.25::DOUBLE ELSE 0.007::DOUBLE END, 4) AS p,
 CASE WHEN event_id % 2 = 0 THEN 'RHYTHM_AND_BLUES' ELSE 'CLASS_A' END AS label FROM events""")
def q_model_split(spark, d):
    """Model and class of probability tags, probabilities and class labels."""
    k, t = F.col("event_id"), F.col("event_type")
    name = F.when(k % 3 == 0, F.concat(F.lit("ESSENTIA_GENRE_ROSAMERICA_A_"), t)).when(k % 3 == 1, "ESSENTIA_NEW_MODEL_X").otherwise("ESSENTIA_PLAIN")
    p = tags.probability(F.when(k % 2 == 0, "0.25").otherwise("7"))
    label = tags.class_label(F.when(k % 2 == 0, "rhy").otherwise("class-a"))
    return table(spark, d, "events").select("event_id", tags.split_model(name).alias("m"), F.round(p, 4).alias("p"), label.alias("label")).select(
        "event_id", "m.model", "m.class", "p", "label"
    )


@query("""WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 t AS (SELECT vec_id, e, list_avg(list_transform(e, lambda x: x * x)) AS en, list_max(list_transform(e, lambda x: abs(x))) AS pk FROM s)
SELECT vec_id, trunc(en * 100)::BIGINT::VARCHAR AS energy, trunc(pk * 100)::BIGINT::VARCHAR AS peak, 'straight' AS groove, '100' AS swing, 'C#' AS pitch,
 trunc(e[3] * 100)::BIGINT::VARCHAR AS band2, trunc(e[20] * 100)::BIGINT::VARCHAR AS mfcc12, '0.0' AS zcr, (round(e[1], 3) + 0.0::DOUBLE)::VARCHAR AS nap, (23 + 7 + 13 + 6 + 2)::INTEGER - 1 AS n FROM t""")
def q_tag_render(spark, d):
    """Features as tags: scales, decimals, one tag an element of a list, and defaults."""
    e = A.doubles(F.col("embedding"))
    scalars = {
        "energy": A.energy(e), "rms_peak": A.peak(e), "dominant_pitch": F.lit("C#"), "bpm": F.lit(120.7), "snr": F.get(e, F.lit(5)),
        "nap": F.round(F.get(e, F.lit(0)), 3), "contrast_bands": F.slice(e, 1, 7), "mfccs": F.slice(e, 8, 13),
    }
    m = tags.render_tags(scalars)
    names = {
        "energy": "ENERGY", "peak": "RMS_PEAK", "groove": "GROOVE_CLASS", "swing": "SWING_RATIO", "pitch": "DOMINANT_PITCH",
        "band2": "CONTRAST_B2", "mfcc12": "MFCC12", "zcr": "ZCR", "nap": "NAP",
    }
    rows = table(spark, d, "embeddings").select("vec_id", m.alias("m"))
    return rows.select("vec_id", *[F.col("m")["LIBROSA_" + t].alias(c) for c, t in names.items()], F.size("m").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, min(((CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END) || l_quantity::INTEGER || 'e' || (l_orderkey % 40 - 20))::DOUBLE::VARCHAR) AS shown FROM lineitem GROUP BY ALL""")
def q_float_text(spark, d):
    """Doubles of every size as their shortest decimals."""
    sign = F.when(F.col("l_returnflag") == "R", "-").otherwise("")
    text = F.concat(sign, F.col("l_quantity").cast("int").cast("string"), F.lit("e"), (F.col("l_orderkey") % 40 - 20).cast("string"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tags.float_text(text.cast("double")).alias("shown"))
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.min("shown").alias("shown"))


def _sheets(spark, d, last_first: bool):
    """One cue sheet a conversation, of its turns in order or from the last to the first."""
    pos, order = F.col("pos"), F.col("turn") if last_first else -F.col("turn")
    entry = F.format_string(
        'TRACK %02d AUDIO\nTITLE "Turn %d"\nPERFORMER %s\nINDEX 01 %02d:%02d:%02d\nTITLE "after"',
        F.col("turn") + 1, F.col("turn"), F.col("role"), F.floor(pos / 4500), F.floor(pos / 75) % 60, pos % 75,
    )
    rows = _positions(spark, d).select("conv_id", "total", F.struct((-order).alias("k"), entry.alias("e"), "turn", "pos").alias("x"))
    sheet = rows.groupBy("conv_id").agg((F.max("total") * 588).alias("total"), F.array_sort(F.collect_list("x")).alias("xs"))
    return sheet.withColumn("text", F.concat(F.lit('TITLE "All"\n'), F.array_join(F.transform("xs", lambda x: x["e"]), "\n")))


@query(f"""WITH {_BOUNDS}, b AS (SELECT conv_id, turn, role, trunc(seconds)::BIGINT AS start, total_samples AS total FROM s)
SELECT conv_id, (turn + 1)::INTEGER AS track, start, least("end", total) AS "end", 'Turn ' || turn AS title, role AS artist FROM
 (SELECT *, lead(start, 1, total) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS "end" FROM b) WHERE start < total""")
def q_cue_dialect(spark, d):
    """The second dialect: tracks as they come, ends unchecked, no titles after the INDEX."""
    parsed = _sheets(spark, d, True).select("conv_id", "total", tags.parse_cue(F.col("text"), 44100, by_number=False).alias("c"))
    return parsed.select("conv_id", F.inline(tags.cue_segments(F.col("c.tracks"), F.col("total"))))


@query(f"""WITH {_BOUNDS}, b AS (SELECT conv_id, turn, role, trunc(seconds)::BIGINT AS start, total_samples AS total FROM s),
 e AS (SELECT *, least(lead(start, 1, total) OVER (PARTITION BY conv_id ORDER BY turn), total) AS "end" FROM b),
 k AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM e WHERE start < total AND "end" > start AND conv_id % 3 < 2)
SELECT conv_id, (turn + 1)::INTEGER AS track, start, "end", CASE WHEN n = 1 AND conv_id % 2 = 0 THEN 'File ' || conv_id WHEN conv_id % 3 = 0 THEN 'after' ELSE 'Track ' || (turn + 1) END AS title,
 CASE WHEN conv_id % 3 = 0 THEN role ELSE 'Unknown' END AS artist FROM k
UNION ALL SELECT conv_id, 1, 0, max(total), CASE WHEN conv_id % 2 = 0 THEN 'File ' || conv_id ELSE 'Unknown' END, 'Unknown' FROM b
 WHERE conv_id % 3 = 2 OR conv_id NOT IN (SELECT conv_id FROM k) GROUP BY conv_id""")
def q_file_slices(spark, d):
    """Slices by the cue sheet in a file's tags, else by its cue block, else the whole file."""
    conv = F.col("conv_id")
    own = F.when(conv % 2 == 0, F.create_map(F.lit("title"), F.concat(F.lit("File "), conv.cast("string")))).otherwise(F.create_map().cast("map<string,string>"))
    at = lambda x: tags.cue_samples(F.floor(x["pos"] / 4500), F.floor(x["pos"] / 75) % 60, x["pos"] % 75, 44100)
    block = F.transform("xs", lambda x: F.struct((x["turn"] + 1).alias("track"), at(x).alias("start")))
    text = F.when(conv % 3 == 0, F.col("text")).when(conv % 3 == 1, "")
    rows = _sheets(spark, d, False)
    slices = tags.file_slices(text, F.when(conv % 3 == 1, block), F.col("total"), 44100, own)
    return rows.select("conv_id", F.inline(slices))


@query("""SELECT c_custkey, c_custkey % 5 = 0 AS consistent, CASE WHEN c_custkey % 5 = 1 THEN 'GENRE' WHEN c_custkey % 5 = 2 THEN 'COMMENT,GENRE' END AS missing,
 CASE WHEN c_custkey % 5 = 3 THEN 'title' WHEN c_custkey % 5 = 4 THEN 'title,artist' END AS mismatch FROM customer""")
def q_tag_consistency(spark, d):
    """Files against the store: missing or empty tags, other titles; written as JSON and read back."""
    k, name, segment = F.col("c_custkey") % 5, F.col("c_name"), F.col("c_mktsegment")
    other = F.concat(F.lit("not "), name)
    pair = lambda n, v: F.struct(F.lit(n).alias("k"), v.alias("v"))
    entries = F.array(
        pair("Title", F.when(k >= 3, other).otherwise(F.concat(F.lit(" "), F.upper(name)))),
        pair("ARTIST", F.when(k == 4, "somebody else").otherwise(F.lower(segment))),
        pair("album", F.lit("")),
        pair("genre", F.when(k == 1, "").otherwise("jazz")),
        pair("comment", F.lit("x")),
    )
    have = F.map_filter(F.map_from_entries(entries), lambda n, _: (k != 2) | ~n.isin("genre", "comment"))
    wanted = F.create_map(*[F.lit(x) for x in ("GENRE", "jazz", "COMMENT", "x")])
    stored = {"title": name, "artist": segment, "album": F.lit("stored alone")}
    rows = table(spark, d, "customer").select("c_custkey", tags.consistency(stored, wanted, have).alias("r"))
    report = documents.write_report(rows.select("c_custkey", "r.*"))
    text = lambda c: F.nullif(F.array_join(c, ","), F.lit(""))
    return report.select(
        "c_custkey", "consistent", text(F.array_sort(F.map_keys("missing"))).alias("missing"), text(F.transform("mismatch", lambda x: x["field"])).alias("mismatch")
    )


@query("""SELECT event_id, event_type AS key, (CASE event_id % 5 WHEN 0 THEN 4 WHEN 1 THEN 255 WHEN 2 THEN 255 WHEN 3 THEN 100 ELSE 255 END)::INTEGER AS length FROM events""")
def q_model_files(spark, d):
    """Keys of model files, and texts cut to their column."""
    k = F.col("event_id") % 5
    marks = F.array(*map(F.lit, ["-discogs-effnet-1", "_msd_musicnn", "_effnet", "_musicnn-2", "_maest_30s"]))
    name = F.concat("event_type", F.get(marks, k.cast("int")), F.lit(".onnx"))
    long = F.repeat(F.lit("é"), F.get(F.array(*map(F.lit, [4, 255, 256, 100, 9999])), k.cast("int")))
    return table(spark, d, "events").select("event_id", tags.model_file_key(name).alias("key"), F.length(tags.cut_text(long)).alias("length"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'source' ELSE 'lang,source' END AS missing FROM documents""")
def q_missing_tags(spark, d):
    """Expected tags that a file lacks."""
    want = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    have = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("lang"), F.lit("x"))).otherwise(F.create_map(F.lit("y"), F.lit("x")))
    keys = F.array_join(F.array_sort(F.map_keys(tags.missing_tags(want, have))), ",")
    return table(spark, d, "documents").select("doc_id", keys.alias("missing"))


@query("""SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS fallback_number FROM conversations""")
def q_track_fallback(spark, d):
    """Running number of a file's rows."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("fallback_number"))


@query("""SELECT doc_id, (trunc(x * 1.5::DOUBLE))::BIGINT AS cut, (CASE WHEN x * 0.5 - floor(x * 0.5) = 0.5 THEN 2 * round(x * 0.25) ELSE round(x * 0.5) END)::BIGINT AS even FROM
 (SELECT doc_id, doc_id::DOUBLE AS x FROM documents)""")
def q_integer_rules(spark, d):
    """Numbers cut toward zero, and rounded half to even."""
    x = F.col("doc_id").cast("double")
    return table(spark, d, "documents").select("doc_id", tags.scaled_int(x * 1.5).alias("cut"), tags.tagger_int(x * 0.5).alias("even"))


