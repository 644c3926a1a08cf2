"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Kernel: k(s, t) sums, over all symbol triples u, the gap-weighted counts of u as a subsequence of s and of t:
an occurrence that spans g positions weighs ``DECAY ** g``, spans over ``SPAN`` count nothing. It is divided
by the same norm of both strings' positions. Inserted characters only widen a gap, and characters that are
not letters or digits take a position but match nothing, so ``i-d-i.o t`` still resembles ``idiot``.

A sentence's units are its words, runs of three or more single letters joined to one, punctuation between them
aside. An insult cut in longer pieces by blanks is no unit of its own; its pieces are. Labels mark whole
documents, so training is multiple-instance: each toxic document lends the unit that scores highest, the
clean ones lend their hardest units, and both are renewed a few times. Landmarks Z give the Nyström map
K(Z,Z)^(-1/2) k(x,Z); a linear squared-hinge machine is trained on it. Its decision function is linear in
the triples, so it folds into one weight table and a unit costs one pass over its triples. A document's
score is a logistic curve of its highest unit, fitted on the training documents.

Training reads at most ``TRAIN_ROWS`` labelled rows of each class with texts up to ``TRAIN_BYTES`` (sampled by
id hash). Scoring reads every whole text.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, lean

TRAIN_ROWS, TRAIN_BYTES = 2000, 20_000
DECAY, SPAN = 0.6, 7
SYMBOLS = 64
START, END, GAP = 26, 27, 63
UNIT_CHARS, UNIT_STEP = 24, 12
LANDMARKS, NEGATIVES, ROUNDS = 256, 6000, 3
CACHE_UNITS, GROUP_TEXTS = 100_000, 200
#: Digits that stand for letters.
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


#: Marks that may stand at a single letter's side.
_MARKS = ".,;:!?-_*'\"()/|"


@lru_cache(maxsize=4096)
def symbol(char: str) -> int:
    char = _LEET.get(char, char)
    if "a" <= char <= "z":
        return ord(char) - 97
    return 28 + ord(char) % 34 if char.isalnum() else GAP


def units(text: str | None) -> set[str]:
    """Distinct lower-case words, pieces of overlong ones, and joined runs of single letters."""
    words = unicodedata.normalize("NFC", text or "").lower().split()
    out = set(words)
    if any(len(w) > UNIT_CHARS for w in out):
        for w in [w for w in out if len(w) > UNIT_CHARS]:
            out.discard(w)
            out.update(w[k : k + UNIT_CHARS] for k in range(0, max(1, len(w) - UNIT_STEP), UNIT_STEP))
    run: list[str] = []
    for w in [*words, ""] if sum(len(w) <= 2 for w in out) >= 2 else []:
        letter = w if len(w) == 1 else w.strip(_MARKS) if len(w) == 2 else ""
        if len(letter) == 1:
            run.append(letter)
            continue
        if len(run) >= 3:
            run_text = "".join(run)
            out.update(run_text[k : k + UNIT_CHARS] for k in range(0, max(1, len(run_text) - UNIT_STEP), UNIT_STEP))
        run = []
    return out


@lru_cache(maxsize=64)
def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions (n, 3), weights) of all triples in a string of ``length``."""
    at = [t for t in combinations(range(length), 3) if t[2] - t[0] < SPAN]
    at = np.asarray(at or np.zeros((0, 3)), dtype=np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def features(words: list[str]):
    """Yields (row numbers, triple codes (rows, n), normed weights (rows, n)) by equal length."""
    by: dict[int, list[int]] = {}
    codes = []
    for k, w in enumerate(words):
        c = [START, *map(symbol, w), END]
        codes.append(c)
        by.setdefault(len(c), []).append(k)
    for length, rows in by.items():
        at, weight = triples(length)
        for part in range(0, len(rows), 4096):
            mine = rows[part : part + 4096]
            c = np.asarray([codes[k] for k in mine], dtype=np.int64)
            a, b, d = c[:, at[:, 0]], c[:, at[:, 1]], c[:, at[:, 2]]
            w = np.where((a == GAP) | (b == GAP) | (d == GAP), 0.0, weight)
            norm = np.sqrt((w * w).sum(axis=1, keepdims=True))
            yield np.asarray(mine), (a * SYMBOLS + b) * SYMBOLS + d, w / np.where(norm > 0, norm, 1)


def apply_table(words: list[str], table: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words))
    for rows, code, weight in features(words):
        out[rows] = (table[code] * weight).sum(axis=1)
    return out


def kernel_rows(words: list[str], landmarks: list[str]) -> np.ndarray:
    """k(words, landmarks): one weight table for each landmark."""
    out = np.zeros((len(words), len(landmarks)))
    table = np.zeros(SYMBOLS**3)
    made = list(features(words))
    for j, z in enumerate(landmarks):
        _, code, weight = next(features([z]))
        np.add.at(table, code[0], weight[0])
        for rows, c, w in made:
            out[rows, j] = (table[c] * w).sum(axis=1)
        table[code[0]] = 0.0
    return out


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine by Newton steps on the squared hinge loss; the last feature is the bias."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = np.full(x1.shape[1], ridge)
    reg[-1] = 1e-6
    active = np.ones(len(x), bool)
    for _ in range(30):
        xa, sa = x1[active], weight[active]
        w = np.linalg.solve((xa * sa[:, None]).T @ xa + np.diag(reg), (xa * sa[:, None]).T @ y[active])
        now = y * (x1 @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


@dataclass
class Model:
    table: np.ndarray | None
    bias: float = 0.0
    slope: float = 0.0
    shift: float = 0.0

    def unit_scores(self, words: list[str]) -> np.ndarray:
        return apply_table(words, self.table) + self.bias

    def probability(self, best: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -30, 30)))


def logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a slightly regularised logistic fit."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ (p - y) + 1e-2 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: list[tuple[bool, set[str]]], seed: int = 0) -> Model:
    """Multiple-instance training on (toxic, units) of each document; no table if a class is missing."""
    rng = np.random.default_rng(seed)
    toxic, clean = [u for t, u in docs if t and u], [u for t, u in docs if not t and u]
    if not toxic or not clean:
        return Model(None, shift=30.0 if toxic else -30.0)
    vocabulary = sorted(set().union(*toxic, *clean))
    number = {w: k for k, w in enumerate(vocabulary)}
    n_pos, n_neg = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
    toxic_ids = [np.array(sorted(number[w] for w in u)) for u in toxic]
    clean_ids = [np.array(sorted(number[w] for w in u)) for u in clean]
    for ids in toxic_ids:
        n_pos[ids] += 1
    for ids in clean_ids:
        n_neg[ids] += 1
    odds = np.log((n_pos + 0.1) / len(toxic)) - np.log((n_neg + 0.5) / len(clean)) + np.log1p(n_pos)
    scores, in_clean = odds, np.flatnonzero(n_neg)
    easy = rng.choice(in_clean, min(NEGATIVES, len(in_clean)), replace=False)
    model = Model(None)
    for _ in range(ROUNDS):
        witness = np.array([ids[np.argmax(scores[ids])] for ids in toxic_ids])
        lent, times = np.unique(witness[n_neg[witness] == 0] if (n_neg[witness] == 0).any() else witness, return_counts=True)
        hard = in_clean[np.argsort(-scores[in_clean], kind="stable")[: NEGATIVES // 3]]
        negative = np.union1d(easy, hard)
        negative = np.setdiff1d(negative, lent)
        order = lent[np.argsort(-times, kind="stable")]
        chosen = [*order[: 3 * LANDMARKS // 4], *hard[: LANDMARKS // 8], *easy[: LANDMARKS // 8]]
        z = [vocabulary[k] for k in dict.fromkeys(int(k) for k in chosen)]
        value, vector = np.linalg.eigh(kernel_rows(z, z))
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])
        words = [vocabulary[k] for k in [*lent, *negative]]
        x = kernel_rows(words, z) @ root
        y = np.array([1.0] * len(lent) + [-1.0] * len(negative))
        weight = np.concatenate([times * len(negative) / times.sum(), np.ones(len(negative))])
        w, bias = squared_hinge(x, y, weight)
        table = np.zeros(SYMBOLS**3)
        for beta, word in zip(root @ w, z):
            _, code, tw = next(features([word]))
            np.add.at(table, code[0], beta * tw[0])
        model = Model(table.astype(np.float32), bias)
        scores = model.unit_scores(vocabulary)
    best = np.array([scores[ids].max() for ids in [*toxic_ids, *clean_ids]])
    label = np.array([1.0] * len(toxic_ids) + [0.0] * len(clean_ids))
    model.slope, model.shift = logistic_curve(best, label)
    return model


def train_toxicity(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    rows: int = TRAIN_ROWS,
    seed: int = 0,
    text_bytes: int = TRAIN_BYTES,
) -> Model:
    """Train on at most ``rows`` labelled documents of each class among those where ``keep`` (on doc_id) holds.

    Texts longer than ``text_bytes`` lend nothing to training: the driver holds 2 * rows * text_bytes at most. In a
    multiple-instance sample a long text says least, as any of its many words may be the one that counts. With neither
    class, or one alone, all texts score alike.
    """
    marked = labels.where("toxic is not null and doc_id is not null").where(keep).select("doc_id", "toxic").distinct()
    parts = [
        marked.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows) for t in (1, 0)
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))  # 2 * rows rows at most
    found = docs.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= text_bytes)
    table = found.join(chosen, "doc_id").select("doc_id", "toxic", "text").toArrow()
    data = sorted(zip(*(table[c].to_pylist() for c in ("doc_id", "toxic", "text"))), key=lambda r: (r[0], r[2] or ""))
    return train([(bool(t), units(x)) for _, t, x in data], seed)


def score_toxicity(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity double`` (0 to 1); the whole text counts, a null or empty one has no unit and scores 0.

    Rows, repeated ones included, and columns stay; a column ``toxicity`` is replaced.
    """
    bounded_batches(spark)
    docs = docs.drop("toxicity")
    shared = spark.sparkContext.broadcast(model)
    column = docs.columns.index("text")
    schema = docs.withColumn("toxicity", F.lit(0.0)).schema

    def step(batches):
        mine, cache = shared.value, {}
        for batch in batches:
            if mine.table is None:
                best = np.zeros(batch.num_rows)
            else:
                best, texts = [], batch.column(column)
                for k in range(0, len(texts), GROUP_TEXTS):
                    part = [units(t.as_py()) for t in texts[k : k + GROUP_TEXTS]]
                    new = sorted(set().union(*part) - cache.keys())
                    cache.update(zip(new, mine.unit_scores(new).tolist()))
                    best += [max(map(cache.__getitem__, u), default=-np.inf) for u in part]
                    if len(cache) > CACHE_UNITS:
                        cache.clear()
                best = np.asarray(best, dtype=float)
            score = np.where(np.isfinite(best), mine.probability(np.where(np.isfinite(best), best, 0)), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], schema.names)

    return docs.mapInArrow(lean(step), schema)


def held_out() -> Column:
    """Is the row kept out of training? A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def op4_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; every fifth label by id hash is held out of training."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_toxicity(spark, docs, labels, ~held_out())
    out = score_toxicity(spark, docs, model)
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
