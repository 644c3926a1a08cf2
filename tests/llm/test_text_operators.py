"""Text operators against brute force, with nulls, empty and long texts, ties, repeats, empty tables and extra columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strataphon.llm import jaccard_join, packing, suffix_dedup, toxicity
from strataphon.llm.licenses import Scanner, contained, scan_licenses
from strataphon.llm.mixing import mix, mixing_rates
from strataphon.llm.sharding import hypergeometric, matrix_row, permuted, shard_sizes, shuffle_into_shards

DOCS = "doc_id long, text string"


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame(list(enumerate(texts)), schema)


def near_copies():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \t ", "one", "One  TWO", "one two"]
    for g in range(2):
        base = [rng.choice(words) for _ in range(50 + 30 * g)]
        for _ in range(40):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t))
    passage = [rng.choice(words) for _ in range(30)]
    for _ in range(20):
        texts.append(" ".join([rng.choice(words) for _ in range(20)] + passage + [rng.choice(words) for _ in range(20)]))
    return texts + [texts[10]] * 8 + [" ".join(rng.choice(words) for _ in range(30_000))]


def brute_components(texts, width, percent):
    sets = []
    for t in texts:
        x = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(x[i : i + width]) for i in range(max(1, len(x) - width + 1))) if x else frozenset())
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("run", [4, 32])
def test_jaccard(spark, monkeypatch, run):
    monkeypatch.setattr(jaccard_join, "RUN", run)
    monkeypatch.setattr(jaccard_join, "CHEAP", 1 if run == 4 else 32)
    texts = near_copies()
    df = frame(spark, texts).selectExpr("*", "1 as fp", "'x' as token", "0 as rep").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark, df, 4, 85).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts, 4, 85)


def test_jaccard_empty_and_null_ids(spark):
    empty = frame(spark, ["a"]).where("false")
    assert jaccard_join.jaccard_components(spark, empty).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f")], DOCS)
    assert sorted((r.component_id for r in jaccard_join.jaccard_components(spark, rows).collect())) == [7, 7, 7]


def test_jaccard_repeated_shared_and_null_ids(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"{rng.getrandbits(40):x}" for _ in range(n)]
    common = fresh(10_000)
    near = [" ".join(common + fresh(10_000)) for _ in range(2)]  # Jaccard 1/3, alike in every bound
    c, d, e = fresh(200), fresh(200), fresh(200)
    copy = lambda w: " ".join(w[:-1] + ["x"])
    rows = [(1, near[0])] * 2 + [(2, near[1])] * 2
    rows += [(3, " ".join(c)), (3, " ".join(d)), (4, copy(c)), (5, copy(d)), (None, " ".join(e)), (None, " ".join(e)), (9, copy(e))]
    rows = [(a, b, k) for k, (a, b) in enumerate(rows)]
    got = jaccard_join.jaccard_rows(spark, spark.createDataFrame(rows, DOCS + ", k int"), 4, 85).collect()
    key = {r.text: r.h for r in spark.createDataFrame(rows, DOCS + ", k int").selectExpr("text", "xxhash64(text) as h").collect()}
    named = {(r.doc_id, r.text_key): r for r in got}
    at = lambda i: named[rows[i][0], key[rows[i][1]]]
    assert len(got) == len(rows)
    assert [at(i).component_id for i in range(11)] == [1, 1, 2, 2, 3, 3, 3, 3, 9, 9, 9]
    assert at(4).component == at(6).component != at(5).component == at(7).component


def test_pipeline_near_copies_go_by_row(spark):
    import corpus_pipeline

    rng = random.Random(9)
    a, b, c, d, e = ([f"{rng.getrandbits(40):x}" for _ in range(60)] for _ in range(5))
    near, whole = lambda w: " ".join([*w[:-1], "x"]), " ".join
    rows = [(1, whole(a)), (1, whole(a)), (2, near(a)), (2, whole(b)), (3, whole(c)), (3, whole(d)), (4, near(d)), (5, None), (6, "")]
    rows += [(None, whole(e)), (None, near(e)), (None, "alone"), (None, None)]
    out = corpus_pipeline.ngram_jaccard(spark, spark.createDataFrame(rows, DOCS), "")
    gone = Counter([(1, whole(a)), (2, near(a)), (4, near(d))])
    assert out.columns == ["doc_id", "text"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(rows) - gone


@pytest.mark.parametrize("k", [1, 40])
def test_overlaps(k):
    rng = np.random.default_rng(k)
    sets = [[np.unique(rng.integers(0, m, rng.integers(1, 400))).astype(np.uint64) for _ in range(n)] for n, m in ((7 * k, 300), (5 * k, 9000))]
    xs, ys = sets[0] + sets[1][:3], sets[1] + sets[0][:2]
    assert jaccard_join.overlaps(xs, ys).tolist() == [[len(np.intersect1d(x, y)) for y in ys] for x in xs]


def test_jaccard_links_are_all_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "RUN", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 9)
    texts = near_copies()
    sets = []
    for t in texts:
        x = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(x[i : i + 4]) for i in range(max(1, len(x) - 3))) if x else frozenset())
    linked = lambda a, b: bool(a & b) and 100 * len(a & b) >= 85 * len(a | b)
    want = [sum(linked(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)]
    got = {r.doc_id: r.n_links for r in jaccard_join.jaccard_components(spark, frame(spark, texts), 4, 85).collect()}
    assert [got[i] for i in range(len(texts))] == want


def brute_removed(texts, window):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        m = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                m[i : i + window] = True
        a = np.frombuffer(b, np.uint8)
        out.append((len(b), int(m.sum()), suffix_dedup.runs(m), hashlib.sha256(a[~m]).hexdigest()))
    return out


def repeats():
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    texts = [None, "", "a" * 150, "ab" * 90, "ab" * 60 + "x" + "ab" * 60]
    for _ in range(100):
        s = list("".join(rng.choice(base)[rng.randint(0, 100) :][: rng.randint(0, 200)] for _ in range(rng.randint(1, 4))))
        for _ in range(rng.randint(0, 2)):
            if s:
                s[rng.randrange(len(s))] = rng.choice("xyz")
        texts.append("".join(s))
    return texts


@pytest.mark.parametrize("group", [1, 50_000])
def test_suffix_dedup(spark, group):
    texts = repeats()
    found = suffix_dedup.repeated(spark, frame(spark, texts), 40, None, group)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(found, 40).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, 40)


def shuffled(spark, work):
    """Records that the stages of ``work`` write to shuffles."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = lambda: store.stageList(None, False, False, jvm.new_array(jvm.jvm.double, 0), None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    seen = {stages().apply(i).stageId() for i in range(stages().size())}
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = [stages().apply(i) for i in range(stages().size())]
    return sum(s.shuffleWriteRecords() for s in found if s.stageId() not in seen)


def test_suffix_shuffles_each_pick_once_at_any_size(spark):
    rng = random.Random(8)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = [fresh(300) for _ in range(40)]
    df = frame(spark, [fresh(200) + s + fresh(200) + s for s in shared for _ in range(3)] + [fresh(2000) for _ in range(200)])
    plan = suffix_dedup.kinds(40, None)
    picks = df.select("doc_id", "text").mapInArrow(suffix_dedup.survey(plan), suffix_dedup._PICK_SQL).count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        n = shuffled(spark, lambda: suffix_dedup.digest(suffix_dedup.repeated(spark, df, 40), 40).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert picks > 40_000 and n < 2 * picks


@pytest.mark.parametrize("most", [1, 5, 1 << 16])
def test_sorted_neighbours_decide(monkeypatch, most):
    rng, batch = np.random.default_rng(most), lambda **c: pa.RecordBatch.from_pydict(c)
    monkeypatch.setattr(suffix_dedup.ordered, "__defaults__", (most,))
    for _ in range(100):
        n = int(rng.integers(1, 60))
        own = {"words": np.zeros(n, bool), "uid": np.arange(n), "pos": np.arange(n, dtype=np.int32)}
        x, y, m = rng.integers(0, max(2, n // 4), n), rng.integers(0, 3, n), rng.choice([1, 1, 2], n)
        x, y = (c[np.lexsort((y, x))] for c in (x, y))
        edges = [0, *np.sort(rng.integers(0, n + 1, 4)), n]
        cut = lambda b: [b.slice(i, j - i) for i, j in zip(edges, edges[1:])]  # noqa: B023, E731
        met = pa.Table.from_batches(suffix_dedup.meet(cut(batch(seed=x, span=y, m=m, **own)))).to_pylist()
        live = {i: min(2, m[(x == x[i]) & (y == y[i])].sum()) for i in range(n) if m[x == x[i]].sum() > 1}
        assert {r["uid"]: r["c"] for r in met} == live
        several = {(a, b) for a, b in zip(x, y) if len(set(y[x == a])) > 1}
        assert Counter((r["seed"], y[r["uid"]]) for r in met if r["seed"] is not None) == Counter(several)
        hull, d1 = pa.array(y, mask=y == 0), (x % 2).astype(np.int32)
        made = batch(core=x, hull=hull, c=m, d0=np.zeros(n, np.int32), d1=d1, **own)
        got = pa.Table.from_batches(suffix_dedup.settle(cut(made))).to_pylist()
        again = [((x == x[i]) & ((y == y[i]) & (y > 0) | (d1[i] == 0))).sum() > 1 and (y[i] > 0 or d1[i] == 0) for i in range(n)]
        undecided = np.array([m[i] == 1 and not again[i] and (x == x[i]).sum() > 1 and d1[i] > 0 for i in range(n)])
        wanted = {i: 1 if undecided[i] else 2 for i in range(n) if undecided[x == x[i]].any()}
        assert {r["uid"] for r in got if r["hit"]} == {i for i in range(n) if m[i] == 1 and again[i]}
        opened = {r["uid"]: r["c"] for r in got if r["open"]}
        assert wanted.items() <= opened.items() and (most < n or wanted == opened)
        assert all(c == 2 for i, c in opened.items() if i not in wanted)


def test_suffix_blocks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 997)
    b = np.frombuffer(np.random.default_rng(0).integers(97, 101, 5000, dtype=np.uint8).tobytes(), np.uint8)
    parts = suffix_dedup.picks(b, 40, 20)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 22)
    whole = suffix_dedup.picks(b, 40, 20)
    assert all((x == y).all() for x, y in zip(parts, whole))


def test_strip_keeps_columns(spark):
    df = spark.createDataFrame([(1, "é" * 60 + "tail", "r", 1), (2, "é" * 60 + "end", "s", 2), (3, None, "t", 3)], "doc_id long, text string, resolved string, found int")
    out = suffix_dedup.strip_repeats(spark, df, 40)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "tail", 2: "end", 3: None}
    assert suffix_dedup.strip_repeats(spark, df.where("false"), 40).count() == 0


def brute_passages(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    kept = []
    for w in words:
        m = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                m[i : i + width] = True
        kept.append([x.decode() for x, gone in zip(w, m) if not gone])
    return kept


def test_strip_words_against_brute(spark):
    rng = random.Random(6)
    base = [" ".join(rng.choice(["ä", "b", "cd", "efg"]) for _ in range(40)) for _ in range(12)]
    texts = [None, "", "a " * 30, "a b " * 20 + "c"]
    for _ in range(80):
        w = " ".join(" ".join(rng.choice(base).split()[rng.randint(0, 15) :][: rng.randint(1, 30)]) for _ in range(rng.randint(1, 4))).split()
        texts.append("".join(x + rng.choice([" ", "\n", " \t"]) for x in w))
    out = suffix_dedup.strip_repeats(spark, frame(spark, texts), 4000, words=11).collect()
    got = {r.doc_id: (r.text or "").split() for r in out}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, 11)


@pytest.mark.parametrize("n", [50, 51])
def test_pipeline_strips_short_passages(spark, n):
    import corpus_pipeline

    rng = random.Random(5)
    fresh = lambda k: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(k))
    passage, long = " ".join(rng.choice(["é", "ab", "cde"]) for _ in range(n)), fresh(1) * 70
    heads = [f"{fresh(20)}{k}" for k in range(4)]
    assert len(passage.encode()) < 400 < len(long)
    texts = [f"{heads[0]} {passage} end", f"{heads[1]}\n{passage}\nstop", f"{heads[2]} {long} x", f"{heads[3]} {long} y"]
    df = frame(spark, texts).selectExpr("*", "length(text) as n_chars")
    got = {r.doc_id: ("".join(r.text.split()), r.n_chars - len(r.text)) for r in corpus_pipeline.suffix_dedup(spark, df, "").collect()}
    mid = passage.split() if n == 50 else []
    want = [heads[0].split() + mid + ["end"], heads[1].split() + mid + ["stop"], heads[2].split() + ["x"], heads[3].split() + ["y"]]
    assert [got[i] for i in range(4)] == [("".join(w), 0) for w in want]


def packed(spark, texts, **more):
    df = frame(spark, texts).selectExpr("*", "1 as start", "'x' as ids").repartition(3)
    return packing.pack(spark, df, packing.default_tokenizer(), **more).toPandas()


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = [None, "", "A b, c!", "<|endoftext|> It's İ, x", "word " * 900] + [" ".join(rng.choice(["alpha", "Beta.", "gamma,", "δ"]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    out = packed(spark, texts, size=128, open_windows=4, merge_windows=8)
    t = Tokenizer.from_file(packing.default_tokenizer())
    for doc, rows in out.groupby("doc_id"):
        ids = np.array([*t.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        rows = rows.sort_values("start")
        assert rows.start.tolist() == [0, *np.cumsum(rows.length).tolist()[:-1]]
        assert b"".join(rows.ids) == ids.tobytes() and set(rows.doc_tokens) == {len(ids)}
        assert [zlib.crc32(i) for i in rows.ids] == rows.ids_crc32.tolist()
    assert out.doc_id.nunique() == len(texts)
    for _, rows in out.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length).tolist()[:-1]] and rows.length.sum() <= 128


def test_packing_fill(spark):
    rng = random.Random(2)
    used = packed(spark, ["alpha beta " * rng.randint(1, 30) for _ in range(600)], size=128, open_windows=32).groupby("sequence_id").length.sum()
    assert used.max() <= 128 and used.sum() / (128 * len(used)) > 0.95


def test_packing_empty(spark):
    assert packing.pack(spark, frame(spark, ["a"]).where("false"), packing.default_tokenizer()).count() == 0


def test_sharding(spark):
    df = frame(spark, [None, "", *["same"] * 500, *map(str, range(498))]).selectExpr("*", "0 as slot", "doc_id * 101 as _key", "'k' as _rank").repartition(7)
    out = shuffle_into_shards(spark, df, 24).toPandas()
    assert sorted(out.doc_id) == list(range(1000)) and out.columns.tolist() == ["doc_id", "text", "_key", "_rank", "shard", "slot"]
    assert (out._key == out.doc_id * 101).all() and set(out._rank) == {"k"}
    sizes = out.groupby("shard").size()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    for _, s in out.groupby("shard").slot:
        assert sorted(s) == list(range(len(s)))
    again = shuffle_into_shards(spark, df, 24, seed=1).toPandas()
    one, two = (x.sort_values("doc_id") for x in (out, again))
    assert (one.shard.to_numpy() != two.shard.to_numpy()).mean() > 0.8
    assert abs(np.corrcoef(one.doc_id, one.slot)[0, 1]) < 0.15
    assert shuffle_into_shards(spark, df.where("false")).count() == 0
    assert shuffle_into_shards(spark, df.limit(3), 24).count() == 3


def test_sharding_query(spark):
    from strataphon.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id").text
    out = QUERIES["op2_hypergeometric_sharding"](spark, sf).toPandas()
    assert sorted(out.doc_id) == sorted(docs.index) and set(out.law) == {"rows"} and out.grown_shard.isna().all()
    for r in out.itertuples():
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    sizes = out.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()


def test_a_wrong_count_stops_the_job(spark, monkeypatch):
    df = spark.range(100).repartition(4)
    kind = type(df)
    collect = kind.collect

    def miscount(self):
        rows = collect(self)
        return [(rows[0][0], rows[0][1] + 1), *[(r[0], r[1]) for r in rows[1:]]]

    monkeypatch.setattr(kind, "collect", miscount)
    out = shuffle_into_shards(spark, df)
    monkeypatch.undo()
    with pytest.raises(Exception, match="counted"):
        out.collect()


@pytest.mark.parametrize("limit", [1, 10**9])
def test_hypergeometric(limit):
    rng = np.random.default_rng(4)
    good, bad, n = 3000, 5000, 1200
    got = np.array([hypergeometric(rng, good, bad, n, limit) for _ in range(2000)])
    p = good / (good + bad)
    sd = np.sqrt(n * p * (1 - p) * (good + bad - n) / (good + bad - 1))
    assert abs(got.mean() - n * p) < 5 * sd / np.sqrt(len(got)) and 0.92 < got.std() / sd < 1.08
    assert hypergeometric(rng, 7, 0, 3, limit) == 3 and hypergeometric(rng, 0, 7, 3, limit) == 0 and hypergeometric(rng, 4, 3, 7, limit) == 4


def test_hypergeometric_of_large_populations():
    rng = np.random.default_rng(5)
    got = np.array([hypergeometric(rng, 10**13, 3 * 10**13, 10**12) for _ in range(200)])
    sd = np.sqrt(10**12 * 0.25 * 0.75 * (1 - 1 / 40))
    assert abs(got.mean() - 2.5e11) < 5 * sd / np.sqrt(200) and 0.8 < got.std() / sd < 1.2


def test_matrix_rows_add_up():
    sizes, columns = [5, 0, 17, 3, 41, 1], shard_sizes(67, 4)
    before = np.concatenate([[0], np.cumsum(sizes)])
    rows = [matrix_row(before, columns, p, 3, limit=20) for p in range(len(sizes))]
    counts = np.array([r[0] for r in rows])
    assert counts.sum(axis=1).tolist() == sizes and counts.sum(axis=0).tolist() == columns and (counts >= 0).all()
    assert [r[1] for r in rows] == (np.cumsum(counts, axis=0) - counts).tolist()
    many = np.mean([matrix_row(before, columns, 4, seed)[0] for seed in range(400)], axis=0)
    assert np.allclose(many, 41 / 67 * np.array(columns), atol=0.5)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000])
def test_places_are_permuted(n):
    x = np.arange(n)
    out = permuted(x, np.full(n, n), np.full(n, 9, np.uint64))
    assert sorted(out) == x.tolist() and (n < 100 or abs(np.corrcoef(x, out)[0, 1]) < 0.1)


def words_places(text, phrase):
    import re

    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text).encode())
    p = phrase.encode().split()
    return len(w), [i for i in range(len(w)) if w[i : i + len(p)] == p]


@pytest.mark.parametrize(
    "text",
    ["", "CC BY cc by CC-BY-NC 4.0", "All rights\nreserved. GNU General Public License v3", "Éall rights reserved", "cc by" * 3, "general public license " * 5000],
)
def test_license_base(text):
    n, count, first, last, base, labels, score, _ = Scanner().scan(text)
    places = {p: words_places(text, p) for p in ("cc by", "general public license", "all rights reserved")}
    every = sorted(i for _, x in places.values() for i in x)
    assert (n, count, first, last) == (places["cc by"][0], len(every), every[0] if every else None, every[-1] if every else None)
    names = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    assert base == ",".join(sorted(names[p] for p, (_, x) in places.items() if x))
    assert set(filter(None, base.split(","))) <= set(labels.split(",")) and 0 <= score <= 1


@pytest.mark.parametrize(
    "text, label",
    [("Licensed under the Apache License, Version 2.0", "apache-2.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
     ("CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0"), ("the MIT License", "mit"), ("BSD 3-Clause License", "bsd-3-clause"), ("GPLv3", "gpl-3.0")],
)
def test_license_rules(text, label):
    assert label in Scanner().scan(text)[5].split(",")


def test_license_containment():
    hits = [(0, 10, 2, 0), (0, 10, 1, 1), (2, 5, 0, 2), (20, 30, 5, 3), (25, 40, 5, 4), (21, 29, 9, 5)]
    assert sorted(contained(hits)) == [(2, 5, 0, 2), (20, 30, 5, 3), (25, 40, 5, 4)]
    assert len(Scanner().rules) > 250


def test_license_table(spark):
    df = frame(spark, [None, "cc by"]).selectExpr("*", "1 as labels")
    assert {r.doc_id: r.n_base for r in scan_licenses(df).collect()} == {0: 0, 1: 1}
    assert scan_licenses(df.where("false")).count() == 0


def test_toxicity_tolerates_gaps(spark):
    rng = random.Random(0)
    plain = ["table", "river", "music", "paper", "window", "garden", "yellow", "silver", "market", "summer", "forest", "number"]
    docs = []
    for k in range(300):
        words = [rng.choice(plain) + rng.choice(["", "s", "ed", "ing"]) for _ in range(30)]
        toxic = k % 3 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["grumblor", "skevnik", "Grumblors"])
        docs.append((toxic, toxicity.units(" ".join(words))))
    model = toxicity.train(docs)
    score = lambda t: float(model.probability(np.array([max(model.unit_scores(sorted(toxicity.units(t))))]))[0])
    for bad in ("grumblor", "you gru-mb-lor you", "g r u m b l o r", "grumbllor music", "SKEVNIK", "skev.nik"):
        assert score(bad) >= 0.5, bad
    for good in ("river music tables", "gardening in summer", "numbers"):
        assert score(good) < 0.5, good
    df = frame(spark, [None, "", "a grumblor here", "river " * 5000]).selectExpr("*", "0 as toxicity")
    got = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(spark, df, model).collect()}
    assert got[0] == 0 and got[1] == 0 and got[2] >= 0.5 and got[3] < 0.5
    assert toxicity.train([]).table is None
    assert toxicity.score_toxicity(spark, df, toxicity.train([])).count() == 4


def test_string_kernel_is_the_gap_weighted_count():
    def brute(s, t):
        def phi(x):
            c = [toxicity.START, *map(toxicity.symbol, x), toxicity.END]
            out, norm = Counter(), 0.0
            for i in range(len(c)):
                for j in range(i + 1, len(c)):
                    for k in range(j + 1, min(len(c), i + toxicity.SPAN)):
                        if toxicity.GAP not in (c[i], c[j], c[k]):
                            w = toxicity.DECAY ** (k - i + 1)
                            out[c[i], c[j], c[k]] += w
                            norm += w * w
            return {u: v / norm**0.5 for u, v in out.items()}

        a, b = phi(s), phi(t)
        return sum(v * b.get(u, 0) for u, v in a.items())

    words, marks = ["idiot", "id.iot", "table"], ["idiot", "stable"]
    assert np.allclose(toxicity.kernel_rows(words, marks), [[brute(w, m) for m in marks] for w in words])


def test_mixing_against_numpy(spark):
    rng = random.Random(4)
    good, bad = [f"good{i}" for i in range(50)], [f"bad{i}" for i in range(50)]
    texts = [" ".join(rng.choice(bad if k % 4 == 0 else good) for _ in range(rng.randint(5, 60))) for k in range(400)] + [None, ""]
    docs = frame(spark, texts).selectExpr("*", "1 as quality", "2 as rate")
    labels = spark.createDataFrame([(k, int(k % 4 != 0), 0) for k in range(200)], "doc_id long, quality int, toxic int")
    r = mixing_rates(spark, docs, labels).toPandas().sort_values("doc_id")
    p, t, w = np.array(r.posterior.tolist()), r.tokens.to_numpy(float), r.rate.to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and t[400] == 0
    assert ((p[:400, 1] > 0.5) == (np.arange(400) % 4 != 0)).mean() > 0.98
    share = (w * t) @ p / (w * t).sum()
    assert np.allclose(share, [0.05, 0.95], atol=1e-6) and w.min() >= 0 and w.max() <= 1 + 1e-12
    # projected gradient by hand, small steps in the same metric, reaches the same totals
    v = np.ones(len(w))
    for _ in range(4000):
        v = np.maximum(0, v - 0.5 * p @ ((v * t) @ p / t.sum() - [0.05, 0.95]))
    assert np.allclose(np.minimum(1, v / v[t > 0].max())[:400], w[:400], atol=1e-3)
    kept = mix(spark, docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == int(r.groupby("doc_id").copies.min().sum())
    assert mix(spark, docs.where("false"), labels).count() == 0
    assert mixing_rates(spark, docs, labels.where("false")).where("rate < 0").count() == 0


def test_mixing_misfit_and_long_texts(spark):
    texts = ["good fine word " * (1 + k % 4) if k % 2 else "bad poor thing " * (1 + k % 3) for k in range(80)]
    texts += ["good fine " * 150_000, None, ""]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    out = mixing_rates(spark, docs, labels).toPandas()
    share = (out.rate * out.tokens * out.posterior.map(lambda p: p[1])).sum() / (out.rate * out.tokens).sum()
    assert abs(abs(share - 0.95) - out.misfit[0]) < 1e-6 and out.misfit[0] < 1e-6 and out.tokens.max() == 300_000
    assert out.rate.between(0, 1).all()
    one = mixing_rates(spark, docs.where("doc_id % 2 = 1 and doc_id < 80"), labels.where("quality = 1")).toPandas()
    assert one.misfit[0] > 0.01  # one domain alone can't make up both shares


def test_mixing_is_native(spark):
    docs = frame(spark, ["a b", "c"])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    plan = mixing_rates(spark, docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
