"""Registered queries: against their SQL, against brute force, and on empty and odd tables."""

import glob
import os
import time

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from strataphon.llm import embedding_dedup, jaccard_join, neighbours, toxicity
from strataphon.llm.licenses import Scanner, contained, rules
from strataphon.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    mine, other = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert rows(mine) == rows(other)


def test_op3_holds_every_id_once(spark):
    import zlib

    from tokenizers import Tokenizer

    from strataphon.llm.packing import default_tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id").text
    out = QUERIES["op3_bounded_space_packing"](spark, SF).toPandas()
    assert sorted(set(out.doc_id)) == sorted(docs.index)
    vocabulary = Tokenizer.from_file(default_tokenizer())
    for doc, pieces in out.groupby("doc_id"):
        ids = np.array([*vocabulary.encode(docs[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        for p in pieces.itertuples():
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
        assert pieces.length.sum() == len(ids)
    used = out.groupby("sequence_id").length.sum()
    assert used.max() <= 4096 and (used.sum() / 4096) / len(used) > 0.9


def test_op4_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    out = QUERIES["op4_string_kernel_toxicity"](spark, SF).toPandas().merge(labels, on="doc_id")
    import zlib

    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (out.predicted == (out.score >= 0.5)).all() and out.score.between(0, 1).all()
    held = out[out.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9
    assert len(docs) == QUERIES["op4_string_kernel_toxicity"](spark, SF).count()


def test_op4_doesnt_see_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "IF(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 5) = 0, 1 - toxic, toxic) AS toxic")
    one, two = (toxicity.train_toxicity(spark, docs, x, ~toxicity.held_out()) for x in (labels, turned))
    assert (one.table == two.table).all() and (one.bias, one.slope, one.shift) == (two.bias, two.slope, two.shift)


def test_toxicity_of_odd_rows(spark):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    texts = [" ".join([word() for _ in range(30)] + (["moronic"] if k % 2 else [])) for k in range(200)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    model = toxicity.train_toxicity(spark, docs, labels, F.lit(True))
    tests = [(None, "so moronic"), (1, None), (2, ""), (3, "m o r o n i c"), (4, "m. o. r. o. n. i. c."), (5, "mo-ro-nic"), (6, word() + " " + word()), (6, "x " * 50_000 + "mor0nic")]
    df = spark.createDataFrame(tests, "doc_id long, text string").selectExpr("*", "0.5 AS toxicity", "'k' AS score")
    got = toxicity.score_toxicity(spark, df, model).toPandas()
    assert list(got.columns) == ["doc_id", "text", "score", "toxicity"] and len(got) == len(tests)
    by = dict(zip([t[1] for t in tests], [got[got.text.isna() if t[1] is None else got.text == t[1]].toxicity.iloc[0] for t in tests]))
    assert by[None] == by[""] == 0
    for t in ("so moronic", "m o r o n i c", "m. o. r. o. n. i. c.", "mo-ro-nic", "x " * 50_000 + "mor0nic"):
        assert by[t] >= 0.5, t[:30]
    assert by[tests[6][1]] < 0.5
    assert toxicity.score_toxicity(spark, df.where("false"), model).count() == 0
    held = spark.createDataFrame([(None,), (3,)], "doc_id long").select(toxicity.held_out().alias("h")).collect()
    assert all(r.h in (True, False) for r in held)


def test_licence_scan_is_linear():
    text = "licensed under cc by 4.0 all rights reserved general public license v3 or any later version mit license "
    scanner, took = Scanner(), []
    for n in (500, 4000):
        began = time.process_time()
        scanner.scan(text * n)
        took.append(time.process_time() - began)
    assert took[1] < 20 * took[0] + 0.5


def test_licence_rules_pass_their_gates():
    """Texts of each rule's own words find its label, or one that suppresses it."""
    scanner = Scanner()
    slow = [(r, r.regex) for r in rules()]
    texts = [
        "GPLv3 or later", "GPLv2 only", "lgplv2.1", "agpl3", "Neither the name of the authors nor the names of its contributors may be used",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "SPDX-License-Identifier: Apache-2.0", "CC BY-NC-SA 4.0",
        "Creative Commons Attribution-ShareAlike 3.0 Unported", "licensed under the MIT", "New BSD License", "Mozilla Public License, version 2.0",
    ]
    for text in texts:
        line = b" " + b" ".join("".join(c if c.isalnum() else " " for c in text.lower()).encode().split()) + b" "
        hits = [(m.start() + 1, m.end(), r.rank, k) for k, (r, regex) in enumerate(slow) for m in regex.finditer(line)]
        want = sorted({slow[h[3]][0].label for h in slow_contained(hits)} | {x for p, x in (("all rights reserved", "reserved"),) if p in text})
        got = scanner.scan(text)
        assert sorted(set(got[5].split(",")) - set(got[4].split(","))) == sorted(set(want) - set(got[4].split(","))), text


def slow_contained(hits):
    kept = []
    for h in sorted(hits, key=lambda h: (h[2], h[0] - h[1], h[3], h[0])):
        if not any((a <= h[0] and h[1] <= b) or (h[0] <= a and b <= h[1]) for a, b, *_ in kept):
            kept.append(h)
    return kept


def test_containment_against_a_slow_scan():
    rng = np.random.default_rng(3)
    for _ in range(300):
        starts = rng.integers(0, 60, 25)
        hits = [(int(a), int(a + n), int(r), k) for k, (a, n, r) in enumerate(zip(starts, rng.integers(1, 12, 25), rng.integers(0, 4, 25)))]
        assert sorted(contained(hits)) == sorted(slow_contained(hits))


def vectors(spark, extra=()):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6, 12))
    data = [(k, (base[k % 6] + rng.normal(scale=0.05, size=12)).tolist(), k % 2) for k in range(120)]
    data += [(200 + k, rng.normal(size=5).tolist(), 0) for k in range(30)]
    data += [(250 + k, [1.0, 2.0, 3.0 + k / 1000], 0) for k in range(30)] + list(extra)
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), data


@pytest.mark.parametrize("cell_rows", [2048, 4])
def test_near_dedup_of_mixed_lengths(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embedding_dedup, "FLAT_CELLS", 8)
    df, data = vectors(spark, [(400, [0.0] * 12, 0), (401, None, 0), (402, [float("nan")] + [1.0] * 11, 0), (403, [1.0] * 12, None)])
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark, df).collect()}
    good = [(i, np.array(e), x) for i, e, x in data if e is not None and np.isfinite(e).all() and any(e) and x is not None]
    links = {i: set() for i, *_ in data}
    for i, a, x in good:
        for j, b, y in good:
            if i != j and x == y and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[i] == (len(links[i]), min(seen))


def test_near_dedup_of_repeated_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 1.0, 0.001]
    rows = [(5, a, 0), (5, b, 0), (3, c, 0), (9, a, 0), (9, a, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark, df).collect())
    assert got == [(3, 1, 3), (5, 1, 3), (5, 2, 5), (9, 2, 5), (9, 2, 5)]


def test_neighbours_of_mixed_lengths(spark):
    df, data = vectors(spark, [(400, [], 0), (401, None, 0)])
    got = neighbours.nearest(spark, df.where("vec_id % 20 = 0"), df, 5, query_block=3, candidate_block=20).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    for i, a, _ in data:
        if i % 20 == 0 and a:
            scores = sorted((-float(np.dot(a, b)), j) for j, b, _ in data if b and len(b) == len(a) and j != i)
            assert by[i] == [j for _, j in scores[:5]]


def test_wide_vectors_keep_their_bounds(spark):
    rng = np.random.default_rng(1)
    data = [(k, rng.normal(size=1500).tolist()) for k in range(60)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = neighbours.nearest(spark, df.where("vec_id < 5"), df, 3).collect()
    x = np.array([e for _, e in data])
    for q in range(5):
        s = x @ x[q]
        s[q] = -np.inf
        assert sorted(r.vec_id for r in got if r.query_id == q) == sorted(np.argsort(-s)[:3].tolist())


@pytest.mark.parametrize("waves", [4, 0])
def test_a_passage_that_half_of_all_documents_share(spark, monkeypatch, waves):
    monkeypatch.setattr(jaccard_join, "WAVES", waves)
    monkeypatch.setattr(jaccard_join, "CHEAP", 1)
    monkeypatch.setattr(jaccard_join, "RUN", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    rng = np.random.default_rng(2)
    fresh = lambda n: [f"{x:x}" for x in rng.integers(1 << 40, size=n)]
    passage = fresh(60)
    texts = [" ".join(passage + fresh(int(rng.integers(0, 16)))) if k % 2 else " ".join(fresh(40)) for k in range(160)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    from test_text_operators import brute_components

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark, df, 4, 85).collect()}
    assert [got[k] for k in range(160)] == brute_components(texts, 4, 85)


def test_hot_ngrams_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SPLIT_RUN", 10)
    monkeypatch.setattr(jaccard_join, "SKETCH_BITS", 12)
    rng = np.random.default_rng(4)
    fresh = lambda n: [f"{x:x}" for x in rng.integers(1 << 40, size=n)]
    base = fresh(40)
    texts = [" ".join(base[:k % 7] + fresh(1) + base[k % 7 + 1 :]) for k in range(90)] + [" ".join(fresh(30)) for _ in range(30)]
    order = jaccard_join.Order(np.array([1] * 4000 + [500] * 96), 4)
    assert len(order.hot) == 96 and (order.parts > 40).all()
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    from test_text_operators import brute_components

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark, df, 4, 80).collect()}
    assert [got[k] for k in range(120)] == brute_components(texts, 4, 80)


def test_pipeline_on_empty_and_wide_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.limit(60).selectExpr("*", "doc_id AS component", "text AS _uid", "1 AS toxicity", "'x' AS text_key")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.where("false"), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
        if name != "toxicity":
            out = stage(spark, wide.drop("toxicity"), SF)
            assert out.columns == wide.drop("toxicity").columns, name
    assert corpus_pipeline.packing(spark, docs.where("false"), SF).count() == 0
