"""Vector operators against brute force; chat windows by exact round trips; components; the pipeline."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from strataphon.llm import chat
from strataphon.llm.common import Scratch, pointer_rounds
from strataphon.llm.embedding_dedup import near_duplicates
from strataphon.llm.neighbours import nearest
from strataphon.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 8))
    x = [b + rng.standard_normal(8) * 0.03 for b in base for _ in range(12)] + [base[0]] * 20
    rows = [(i, [float(np.float32(v)) for v in y], i % 3 if i % 11 else None) for i, y in enumerate(x)]
    odd = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, []]
    return rows + [(1000 + i, v, 1) for i, v in enumerate(odd)]


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_duplicates(spark):
    rows = vectors()
    got = {r.vec_id: r for r in near_duplicates(spark, spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as rep")).collect()}
    good = [(i, np.array(v, float), c) for i, v, c in rows if usable(v) and c is not None]
    unit = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    ids, label = np.array([i for i, _, _ in good]), np.array([c for _, _, c in good])
    a = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(a, False)
    comp = ids.copy()
    for _ in range(len(ids)):
        comp = np.minimum(comp, np.where(a, comp, 1 << 40).min(axis=1))
    assert [got[i].n_links for i in ids] == a.sum(axis=1).tolist()
    assert [got[i].component_id for i in ids] == comp.tolist()
    rest = set(got) - set(ids)
    assert all(got[i].n_links == 0 and got[i].kept for i in rest) and len(got) == len(rows)


def test_near_duplicates_empty(spark):
    assert near_duplicates(spark, spark.createDataFrame([], VECTORS)).count() == 0
    assert near_duplicates(spark, spark.createDataFrame([(1, None, 1)], VECTORS)).first().kept


@pytest.mark.parametrize("blocks", [(2048, 16384), (7, 50)])
def test_nearest(spark, blocks):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as tile").repartition(3)
    got = {}
    for r in nearest(spark, df.where("vec_id % 20 = 0"), df, 5, *blocks).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = {i: np.array(v, float) for i, v, _ in rows if usable(v)}
    for q in (i for i in good if i % 20 == 0):
        best = sorted(((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q))[:5]
        mine = sorted(got.pop(q))
        assert [m[1] for m in mine] == [i for _, i in best]
        assert np.allclose([m[2] for m in mine], [-s for s, _ in best], rtol=1e-12)
    assert not got


def test_nearest_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1)], VECTORS)
    assert [(r.query_id, r.vec_id) for r in nearest(spark, df.where("vec_id = 0"), df).collect()] == [(0, 1)]
    assert nearest(spark, df.where("false"), df).count() == 0


text = st.text(alphabet=st.sampled_from(list("ab\\]<s>/[INST] \n|é😀")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "to]ol"]), text), max_size=12), st.integers(1, 200), st.integers(0, 100))
def test_chat_round_trip(turns, budget, history):
    turns = [(r, t + ("</s>\n<s>[user]\n" if k % 3 == 0 else "")) for k, (r, t) in enumerate(turns)]
    seen, loss = {}, []
    for formatted, spans, members in chat.windows(sized(turns), budget, history):
        back = chat.read_back(formatted)
        assert back == [turns[k] for k in members]
        for k, t in zip(members, back):
            seen[k] = t
        loss += [chat.unescape(formatted[a:b]) for a, b in spans]
        new_only = [k for k in members if k not in range(0)]
        assert new_only == sorted(new_only)
        assert "</s>" not in "".join(chat.escape(t) for _, t in turns)
    assert [seen[k] for k in range(len(turns))] == turns
    assert loss == [t for r, t in turns if r == "assistant"]


def test_chat_windows_keep_system_and_budget():
    turns = [("system", "S" * 20)] + [("user" if k % 2 else "assistant", str(k) * 50) for k in range(1, 20)]
    made = list(chat.windows(sized(turns), 300, 120))
    assert len(made) > 3 and all(m[2][0] == 0 for m in made) and all(len(m[0]) <= 300 for m in made)
    assert any(set(a[2][1:]) & set(b[2][1:]) for a, b in zip(made, made[1:]))


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "n"), (1, 1, "assistant", "b</s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as window")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha("user\n\nassistant\nb</s>\nassistant\nb</s>\n")
    assert got[1].loss_chars == 10 and got[1].loss_sha256 == sha("b</s>b</s>")
    assert got[2].loss_chars == 0 and got[2].loss_sha256 == sha("") and None in got
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


def sized(turns):
    return [(r, t, len(chat.formatted_turn(r, t))) for r, t in turns]


def test_chat_large_ids_and_tokens(spark):
    from tokenizers import Tokenizer

    from strataphon.llm.packing import default_tokenizer

    big = 2**53 + 1
    rows = [(big, 0, "system", "be kind"), (None, 0, "user", "x"), (-big, 0, "assistant", "a")]
    rows += [(7, k, ["user", "assistant"][k % 2], "some words, " * (k % 9)) for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df, 200, 60, default_tokenizer())
    out = made.collect()
    assert {r.conv_id for r in out} == {big, -big, None, 7}
    vocabulary = Tokenizer.from_file(default_tokenizer())
    for r in out:
        whole = len(vocabulary.encode(r.formatted, add_special_tokens=False).ids)
        assert whole <= 200 or len(r.turns) == 1
        parts = [chat.formatted_turn(*t) for t in chat.read_back(r.formatted)]
        assert whole == sum(len(vocabulary.encode(p, add_special_tokens=False).ids) for p in parts)
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    text = [t for _, _, role, t in rows[3:] if role == "assistant"]
    assert got[7].n_turns == 3000 and got[7].loss_sha256 == hashlib.sha256("".join(text).encode()).hexdigest()


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 80)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in pointer_rounds(spark, Scratch(spark, "t"), df).collect()}
    assert got == {x: root(x) for x in up}
    assert pointer_rounds(spark, Scratch(spark, "t"), df.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[:3] in ("op2", "op9") or n[:4] == "op10"))
def test_query_rows(spark, name):
    table = "conversations" if name.startswith("op10") else "documents"
    source = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
    want = source.select("conv_id").distinct().count() + 1 if table == "conversations" else source.count()
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == want


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "suffix_dedup", "mixing", "packing"]
    scratch = Scratch(spark, "t")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.put(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        docs = out
    order = list(kept)
    assert all(kept[b] <= kept[a] for a, b in zip(order, order[1:])) and kept["ngram_jaccard"] == kept["suffix_dedup"]
    pieces = corpus_pipeline.packing(spark, docs, "").toPandas()
    assert set(pieces.doc_id) == kept["mixing"]
    assert pieces.groupby("sequence_id").length.sum().max() <= 4096
