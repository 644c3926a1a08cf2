"""Snapshots, tags, admission, sources and streaming on literal rows."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataphon.functions import arrays as A
from strataphon.functions import jsonb, music, tags
from strataphon.operators import admission, snapshot, telemetry
from strataphon.sources import audio, documents
from strataphon.streaming import pipeline


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "a, b, same",
    [('{"a":1,"b":2}', '{ "b": 2, "a": 1.0 }', True), ('{"a":1}', '{"a":2}', False), (None, "{}", False), (None, None, True), ('{"a":1e2}', '{"a":100.0e0}', True)],
)
def test_json_equality(spark, a, b, same):
    assert one(spark, jsonb.differs(F.lit(a).cast("string"), F.lit(b).cast("string"))) is not same


@pytest.mark.parametrize("doc, empty", [(None, True), ("{}", True), (" { } ", True), ("null", True), ('{"a":null}', False), ("[]", False)])
def test_empty_documents(spark, doc, empty):
    assert one(spark, jsonb.is_empty(F.lit(doc).cast("string"))) is empty


@pytest.mark.parametrize("raw, text", [('"a"', "a"), ('["a","b"]', "a / b"), ("plain", "plain"), ("[broken", "[broken")])
def test_flexible_string(spark, raw, text):
    assert one(spark, jsonb.flexible_string(F.lit(raw))) == text


@pytest.mark.parametrize(
    "nap, variant, db",
    [(None, "sql", None), (-0.1, "sql", -40.0), (0.0, "core", -40.0), (0.5, "sql", 0.0), (1.0, "sql", 39.9996), (1.0, "core", 40.0), (1e-5, "jig", -39.9996)],
)
def test_hnr(spark, nap, variant, db):
    got = one(spark, music.hnr_db(F.lit(nap).cast("double"), variant))
    assert got == db if db is None else abs(got - db) < 1e-3


@pytest.mark.parametrize("nap", [0.001, 0.25, 0.5, 0.9])
def test_nap_round_trip(spark, nap):
    assert abs(one(spark, music.nap_from_hnr(music.hnr_db(F.lit(nap), "core"), "core")) - nap) < 1e-6


@pytest.mark.parametrize("db, variant, nap", [(31.0, "sql", 1.0), (-31.0, "sql", 0.0), (301.0, "jig", 1.0), (31.0, "jig", 0.9992)])
def test_nap_cutoffs(spark, db, variant, nap):
    assert abs(one(spark, music.nap_from_hnr(F.lit(db), variant)) - nap) < 1e-3


CUE = """PERFORMER 'Band'
TITLE Album
  TRACK 02 AUDIO
    TITLE "Two"
    INDEX 01 00:02:00
  track 01 audio
    title One
    PERFORMER "Solo"
    INDEX 01 00:00:00
  TRACK 03 AUDIO
    TITLE "No index"
  TRACK 04 AUDIO
    INDEX 01 09:00:00
"""


def test_cue(spark):
    c = one(spark, tags.parse_cue(F.lit(CUE), 44100))
    assert (c.album, c.performer) == ("Album", "Band")
    assert [(t.track, t.start, t.title, t.artist) for t in c.tracks] == [(1, 0, "One", "Solo"), (2, 88200, "Two", ""), (4, 9 * 60 * 44100, "", "")]
    s = one(spark, tags.track_slices(tags.parse_cue(F.lit(CUE), 44100)["tracks"], F.lit(200_000).cast("long")))
    assert [(t.track, t.start, t.end) for t in s] == [(1, 0, 88200), (2, 88200, 200_000)]


@pytest.mark.parametrize("text, number", [("3/12", 3), ("3-12", 3), (" ", None), ("x", None), ("07", 7), (None, None)])
def test_track_number(spark, text, number):
    assert one(spark, tags.track_number(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize("text, p", [("0.25", 0.25), ("250", 0.25), ("1.5", 0.0015), ("x", 0.0)])
def test_probability(spark, text, p):
    assert abs(one(spark, tags.probability(F.lit(text))) - p) < 1e-12


def test_multi_value(spark):
    f = lambda *v: one(spark, tags.multi_value(F.array(*map(F.lit, v))))
    assert (f("a"), f("a", " ", "b"), f(" ")) == ('"a"', '["a","b"]', '""')


@pytest.mark.parametrize("samples, seconds", [(60, 390), (300, 750), (3300, 5250), (6000, 7200)])
def test_timeouts(spark, samples, seconds):
    t = admission.adaptive_timeout(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(44100 * samples).cast("long"), 300, 1.5, 7200)
    assert one(spark, t) == seconds


def test_timeout_by_size_and_default(spark):
    zero = F.lit(0).cast("long")
    assert one(spark, admission.adaptive_timeout(F.lit(50 << 20).cast("long"), zero, zero)) == 1200
    assert one(spark, admission.adaptive_timeout(zero, zero, zero, 0, 0, 0)) == 750


def test_workers(spark):
    assert one(spark, admission.worker_count(F.lit(64.0), F.lit(16), 0.625, 0.80, 1.75)) == 12


def test_hysteresis(spark):
    got = one(spark, admission.slot_hysteresis(F.array(*map(F.lit, [2, 2, 1, 2, 1, 2, 2, 2]))))
    assert got == [1, 2, 1, 1, 1, 1, 2, 2]


def test_ema_zero_is_unset(spark):
    assert abs(one(spark, telemetry.ema_fold(F.array(*map(F.lit, [0.0, 5.0, 3.0])))) - (0.15 * 3 + 0.85 * 5)) < 1e-12


def test_rolling_boundary(spark):
    df = spark.sql("select 1 k, timestamp'2024-01-01 00:00:00' ts union all select 1, timestamp'2024-01-01 00:01:00'")
    got = {str(r.ts): r.in_window for r in telemetry.rolling_count(df, ["k"], "ts").collect()}
    assert got["2024-01-01 00:01:00"] == 1


def test_array_edges(spark):
    empty = F.array().cast("array<double>")
    assert one(spark, A.resample(empty)) == [0.0] * 32
    assert one(spark, A.entropy(empty)) == 0.0
    assert one(spark, A.mean(empty)) == 0.0
    assert one(spark, A.skewness(F.array(*[F.lit(2.0)] * 5))) == 0.0
    assert one(spark, A.zero_crossing_rate(F.array(F.lit(1.0)))) == 0.0


SCHEMA = "id long, audio_hash string, meta string, title string"


def test_upsert_and_history(spark):
    old = spark.createDataFrame([(1, "a", '{"x":1}', "A"), (2, "b", "{}", "B"), (3, "c", "{}", "C")], SCHEMA)
    new = spark.createDataFrame([(None, "a", '{"x":1.0}', "A2"), (None, "b", '{"y":2}', "B"), (None, "d", "{}", "D"), (None, "e", "{}", "E")], SCHEMA)
    after = snapshot.upsert(old, new, ["audio_hash"], keep=["id"])
    rows = {r.audio_hash: (r.id, r.title) for r in snapshot.with_new_ids(after, "id", ["audio_hash"]).collect()}
    assert rows == {"a": (1, "A2"), "b": (2, "B"), "c": (3, "C"), "d": (4, "D"), "e": (5, "E")}
    again = snapshot.upsert(after, new, ["audio_hash"], keep=["id"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)
    old_rows = snapshot.history_of(old, new, ["audio_hash"], ["meta"], F.lit("now")).collect()
    assert [r.audio_hash for r in old_rows] == ["b"]


def flac(tags_: dict, md5: bytes = bytes(range(16))) -> bytes:
    stream = struct.pack(">HH", 4096, 4096) + bytes(6) + ((44100 << 44) | (1 << 41) | (15 << 36) | 88200).to_bytes(8, "big") + md5
    text = struct.pack("<I", 4) + b"test" + struct.pack("<I", len(tags_))
    for k, v in tags_.items():
        c = f"{k}={v}".encode()
        text += struct.pack("<I", len(c)) + c
    return b"fLaC" + b"\x00" + len(stream).to_bytes(3, "big") + stream + b"\x84" + len(text).to_bytes(3, "big") + text


def wav(x: np.ndarray, bits: int = 16, rate: int = 44100) -> bytes:
    raw = (x * 32767).astype("<i2").tobytes() if bits == 16 else x.astype("<f4").tobytes()
    form = struct.pack("<HHIIHH", 1 if bits == 16 else 3, 1, rate, rate * bits // 8, bits // 8, bits)
    body = b"WAVEfmt " + struct.pack("<I", 16) + form + b"data" + struct.pack("<I", len(raw)) + raw
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_audio_files(spark, tmp_path):
    (tmp_path / "J" / "B").mkdir(parents=True)
    (tmp_path / "J" / "a.flac").write_bytes(flac({"Title": "T", "CUESHEET": "TRACK 01 AUDIO"}))
    (tmp_path / "J" / "B" / "b.FLAC").write_bytes(b"nothing")
    (tmp_path / "J" / "c.wav").write_bytes(wav(np.sin(np.arange(22050) / 10)))
    files = audio.list_files(spark, str(tmp_path))
    assert files.count() == 2
    info = {r.path[-6:]: r for r in audio.read_flac_info(audio.read_files(spark, str(tmp_path))).collect()}
    a = info["a.flac"]
    assert (a.sample_rate, a.channels, a.bits_per_sample, a.total_samples, a.duration_sec) == (44100, 2, 16, 88200, 2.0)
    assert a.tags["title"] == ["T"] and a.cuesheet == "TRACK 01 AUDIO"
    assert info["b.FLAC"].sample_rate is None
    md5 = {r.path[-6:]: r.m for r in audio.read_files(spark, str(tmp_path)).select("path", audio.header_md5(F.col("content")).alias("m")).collect()}
    assert md5["a.flac"] == bytes(range(16)).hex() == a.md5 and md5["b.FLAC"] is None
    w = audio.read_slices(audio.read_files(spark, str(tmp_path), "wav")).first()
    assert w.sr == 44100 and len(w.y) == 22050 and len(w.audio_hash) == 32


@pytest.mark.parametrize("bits", [16, 24, 32])
def test_pcm(bits):
    x = np.array([0, 1, -1, 2 ** (bits - 1) - 1, -(2 ** (bits - 1))], dtype=np.int64)
    raw = b"".join(int(v).to_bytes(bits // 8, "little", signed=True) for v in x)
    assert np.allclose(audio.pcm_to_float(raw + b"\x01", bits, False, 1)[:, 0], x / 2.0 ** (bits - 1), atol=1e-7)


def test_metrics(spark):
    text = ['# HELP x', 'a_total{status="ok",msg="say \\"hi\\", x"} 3', "b 2.5e3 1700000000", "c +Inf", "bad line here now"]
    rows = {r.name: r for r in documents.parse_metrics(spark.createDataFrame([(t,) for t in text], "value string")).collect()}
    assert rows["a_total"].sample == 3 and rows["a_total"].labels["status"] == "ok"
    assert rows["b"].sample == 2500 and rows["b"].labels == {} and rows["c"].sample == float("inf") and len(rows) == 3


def test_settings():
    a = documents.load_settings("[o]\nworkers = 3", {"o": {"workers": 1, "ratio": 0.5}})
    assert a == {"o": {"workers": 3, "ratio": 0.5}}
    assert documents.settings_diff({"o": {"w": 1, "x": 2}}, {"o": {"w": 3, "x": 2}}) == {"o.w": (1, 3)}


def test_stream_gate_and_sink(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    schema = "path string, seq long, event string, force boolean"
    rows = [("a", 1, "request", False), ("a", 2, "request", False), ("a", 3, "FAILED", False), ("a", 4, "request", False), ("b", 5, "request", True), ("b", 6, "COMPLETED", False), ("b", 7, "request", True)]
    (drop / "x.json").write_text("\n".join(json.dumps(dict(zip(["path", "seq", "event", "force"], r))) for r in rows))
    stream = spark.readStream.schema(schema).json(str(drop))
    q = pipeline.state_gate(stream, ["path"]).writeStream.format("memory").queryName("gate").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.seq: (r.run, r.status) for r in spark.table("gate").collect()}
    assert got == {1: (True, "PENDING"), 2: (False, "PENDING"), 3: (None, "FAILED"), 4: (True, "PENDING"), 5: (True, "PENDING"), 6: (None, "COMPLETED"), 7: (True, "PENDING")}


def test_upsert_sink_is_idempotent(spark, tmp_path):
    store = pipeline.SnapshotStore(spark, str(tmp_path / "store"))
    schema = "audio_hash string, meta string, title string"
    sink = pipeline.upsert_sink(store, schema, ["audio_hash"], ["meta"], F.desc("title"), F.col("audio_hash").isNotNull())
    first = spark.createDataFrame([("a", "{}", "1"), ("a", "{}", "2"), (None, "{}", "x")], schema)
    sink(first, 0)
    sink(first, 0)
    sink(spark.createDataFrame([("a", '{"k":1}', "3"), ("b", "{}", "1")], schema), 1)
    assert sorted(map(tuple, store.read("current", schema).collect())) == [("a", '{"k":1}', "3"), ("b", "{}", "1")]
    assert spark.read.parquet(f"{store.root}/history").count() == 1
    assert spark.read.parquet(f"{store.root}/letters").count() == 1


def test_expand(spark):
    tasks = spark.createDataFrame([("p", 1, "s", 0, 0, 0, "t", "a", "b", "c", False), ("q", 1, "s", 0, 0, 0, "t", "a", "b", "c", False)], pipeline.TASK_SCHEMA)
    tracks = spark.createDataFrame([("p", [(1, 0, 10), (2, 10, 20)])], "flacPath string, tracks array<struct<track:int,start:long,end:long>>")
    rows = sorted((r.flacPath, r.trackNumber, r.startSample, r.endSample) for r in pipeline.expand(tasks, tracks).collect())
    assert rows == [("p", 1, 0, 10), ("p", 2, 10, 20), ("q", 0, 0, 0)]


def test_new_ids_under_adaptive_ranges(spark):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(40_000).selectExpr("id AS k", "IF(id % 4 = 0, id, NULL) AS id", "repeat(CAST(id AS STRING), 40) AS part")
        out = snapshot.with_new_ids(rows.repartition(9), "id", ["k"]).toPandas()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    new = out[out.k % 4 != 0].sort_values("k")
    assert out.columns.tolist() == ["k", "id", "part"] and (new.part == new.k.astype(str).map(lambda x: x * 40)).all()
    assert new.id.tolist() == list(range(39_996 + 1, 39_996 + 1 + 30_000))


def test_ema_with_zeros_and_blocks(spark):
    values = [0.0, 0.0, 3.0, 1.0, 0.0, 0.0, 5.0, 2.0, 0.0, 7.0]
    rows = [("a", f"2024-01-{1 + k // 2:02d} 0{k % 2}:00:00", k, v) for k, v in enumerate(values)] + [("b", "2024-01-01 00:00:00", 0, 0.0)]
    df = spark.createDataFrame(rows, "k string, t string, i int, v double").withColumn("t", F.col("t").cast("timestamp"))
    want = 0.0
    for v in values:
        want = v if want == 0 else 0.15 * v + 0.85 * want
    got = {r.k: r.ema for r in telemetry.ema(df, ["k"], "t", "i", "v").collect()}
    assert abs(got["a"] - want) < 1e-12 and got["b"] == 0.0


def test_fold_ema():
    from strataphon.streaming.pipeline import fold_ema

    rng = np.random.default_rng(0)
    values = np.where(rng.random(1000) < 0.2, 0, rng.random(1000))
    want = 0.0
    for v in values:
        want = v if want == 0 else 0.15 * v + 0.85 * want
    assert abs(fold_ema(fold_ema(0.0, values[:300]), values[300:]) - want) < 1e-9
    assert fold_ema(0.0, np.zeros(3)) == 0.0 and fold_ema(0.5, np.zeros(0)) == 0.5


def test_previous_row_across_blocks(spark):
    rows = [("a", f"2024-01-0{d} 0{h}:00:00", 10 * d + h) for d in (1, 4, 5) for h in (1, 2)] + [("b", "2024-01-02 00:00:00", 7)]
    df = spark.createDataFrame(rows, "k string, t string, v int").withColumn("t", F.col("t").cast("timestamp"))
    got = {r.v: r.previous.v if r.previous else None for r in telemetry.with_previous(df, ["k"], "t", "v", ["v"]).collect()}
    assert got == {11: None, 12: 11, 41: 12, 42: 41, 51: 42, 52: 51, 7: None}


@pytest.mark.parametrize("kind", ["verbatim", "fixed", "linear"])
@pytest.mark.parametrize("channels", [1, 2, 3])
@pytest.mark.parametrize("bits", [8, 16, 24])
def test_flac_round_trip(kind, channels, bits):
    import hashlib

    from strataphon.sources import flac

    rng, t, top = np.random.default_rng(bits), np.arange(5000), 1 << (bits - 1)
    x = np.stack([np.round(0.4 * top * np.sin(t / (20 + 7 * c)) + rng.normal(0, 3, len(t))) for c in range(channels)], 1)
    x = np.clip(x, -top, top - 1).astype(np.int64)
    content = flac.encode(x, 48_000, bits, kind, comments={"TITLE": "t"})
    assert (np.concatenate(list(flac.blocks(content))) == x).all()
    assert (np.concatenate(list(flac.blocks(content, 4000, 4500))) == x[4000:4500]).all()
    info = audio.flac_info(content)
    assert info["md5"] == hashlib.md5(flac.pcm(x, bits)).hexdigest() and info["tags"] == {"title": ["t"]} and info["total_samples"] == 5000
    with pytest.raises(ValueError):
        list(flac.blocks(content[: len(content) // 2]))


def test_flac_silence_and_other_files():
    from strataphon.sources import flac

    quiet = np.zeros((9000, 2), np.int64)
    assert (np.concatenate(list(flac.blocks(flac.encode(quiet, 44_100)))) == 0).all()
    with pytest.raises(ValueError):
        flac.stream(b"RIFF" + bytes(100))


def test_long_wav_comes_in_blocks():
    x = np.arange(-20_000, 20_000, dtype=np.int64)[:, None]
    rate, parts = audio.sample_blocks(audio.wav_file(x, 4000), 100, 39_000)
    parts = list(parts)
    assert rate == 4000 and len(parts) == 5 and np.allclose(np.concatenate([p[1] for p in parts])[:, 0], x[100:39_000, 0] / 32768)


def test_second_cue_dialect_and_priority(spark):
    text = 'PERFORMER "Band"\r\nTRACK 02 AUDIO\rTITLE \'Two\'\n  PERFORMER "B "\nINDEX 01 00:02:00\nTRACK 01 audio\ntitle One side\nINDEX 01 00:01:00\nTRACK 03 AUDIO\nTITLE "no index"'
    got = one(spark, tags.parse_cue(F.lit(text), 75, by_number=False))
    assert [(t.track, t.start, t.title, t.artist) for t in got.tracks] == [(2, 150, "Two", "B"), (1, 75, "One side", "")]
    assert [t.track for t in one(spark, tags.parse_cue(F.lit(text), 75)).tracks] == [1, 2]
    parsed = tags.parse_cue(F.lit(text), 75, by_number=False)["tracks"]
    assert [(t.track, t.end) for t in one(spark, tags.cue_segments(parsed, F.lit(160).cast("long")))] == [(2, 75), (1, 160)]
    none = F.lit(None).cast("array<struct<track:int,start:long>>")
    empty = F.create_map().cast("map<string,string>")
    whole = one(spark, tags.file_slices(F.lit(None).cast("string"), none, F.lit(9).cast("long"), 75, empty))
    assert [(t.track, t.start, t.end, t.title) for t in whole] == [(1, 0, 9, "Unknown")]


@pytest.mark.parametrize("value", [0.0, -0.0, 1.0, -2.5, 0.001, 0.0001, 0.00012345, 1e-5, 1.5e-7, 123456789.0, 1e15, 1.25e15, 1e16, 1.5e22, 2.2250738585072014e-308, 1.7976931348623157e308])
def test_float_text_is_shortest(spark, value):
    assert one(spark, tags.float_text(F.lit(value))) == repr(value)


def test_float_text_defaults(spark):
    assert [one(spark, tags.float_text(F.lit(v).cast("double"))) for v in (None, float("nan"), float("-inf"))] == ["0.0"] * 3


def test_live_settings():
    text = {"t": "[a]\nx = 1\n"}
    live = documents.LiveSettings(lambda: text["t"], lambda: hash(text["t"]), {"a": {"x": 0, "y": 5}})
    assert live.now == {"a": {"x": 1, "y": 5}} and live.poll() == {}
    text["t"] = "[a]\nx = 2\n"
    assert live.poll() == {"a.x": (1, 2)} and live.poll() == {}
    text["t"] = "[a\n"
    assert live.poll() == {} and live.now["a"]["x"] == 2


def test_guarded_sink_saves_batches(spark):
    import time

    letters = []
    keep = lambda batch, k, why: letters.append((k, why))
    pipeline.guarded_sink(lambda batch, k: batch.count(), keep, 30)(spark.range(5), 0)
    pipeline.guarded_sink(lambda batch, k: 1 / 0, keep, 30)(spark.range(5), 1)
    slow = lambda batch, k: batch.selectExpr("java_method('java.lang.Thread', 'sleep', 20000L)").collect()
    began = time.time()
    pipeline.guarded_sink(slow, keep, 0.5)(spark.range(1), 2)
    assert [k for k, _ in letters] == [1, 2] and "division" in letters[0][1] and time.time() - began < 19


def test_periodic_replay_goes_on_after_a_failure():
    seen = []

    def job():
        seen.append(1)
        if len(seen) == 1:
            raise ValueError("store is away")

    assert pipeline.periodically(job, 0.01, rounds=3) == 3 and len(seen) == 3


def test_planned_update_with_limit(spark):
    rows = spark.createDataFrame([(k, None if k == 2 else float(k)) for k in range(6)], "k int, v double")
    plan = snapshot.planned_update(rows, ["k"], "v", F.expr("IF(k = 4, NULL, v * 2)"), limit=5)
    assert snapshot.outcomes(plan).first().asDict() == {"changed": 2, "skipped": 2, "failed": 1}
    assert {r.k: r.v for r in snapshot.apply_update(rows, plan, ["k"], "v").collect()} == {0: 0.0, 1: 2.0, 2: None, 3: 6.0, 4: 4.0, 5: 5.0}


def test_wide_states_stay(spark):
    rows = spark.createDataFrame([("a", 1, "x")], "file_path string, track_number int, status string")
    out = snapshot.migrate_states(rows, ["file_path", "track_number"], {"track_number": F.lit(0)}, F.col("status"))
    assert out.collect() == rows.collect()
