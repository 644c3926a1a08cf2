"""Mixing documents to target domain weights with soft memberships, in DataFrame functions alone.

1. A labelled table names the domain of some documents. A naive Bayes classifier over hashed words is
   counted on at most ``TRAIN_ROWS`` of them (by id hash) and gives every document posterior probabilities of
   the domains. A document's evidence is scaled to that of ``EVIDENCE`` words, so long texts stay soft.
2. Rates w >= 0 are fitted by projected gradient on the least-squares misfit between the expected domain
   token totals sum(w * tokens * posterior) and the targets' shares of all tokens. The gradient of a document
   is its posteriors times the misfit of the domains, so a round is one aggregate of domains + domains**2
   sums; these also precondition the step. The driver sees only such sums. A document's rate is the fold
   of the rounds' steps over its posteriors, so no state is kept by document.
3. Rates are scaled to at most 1: no document needs repeating, and shares stay at the targets.

``copies`` draws an integer for each row, floor(rate + u) with u in [0, 1) from the id's hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded_broadcast

TRAIN_ROWS = 20_000
BUCKETS = 4096
#: Words of a topical text are far from independent, so a naive posterior of a whole text is all but certain; that of as many
#: words as make a long sentence is not, and a text's share of either domain can then be split.
EVIDENCE = 40
ROUNDS, TOLERANCE = 25, 1e-9
#: Target shares of expected tokens by value of ``labels.quality``.
TARGETS = {0: 0.05, 1: 0.95}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def buckets(text: Column) -> Column:
    return F.transform(words(text), lambda w: (F.pmod(F.xxhash64(w), F.lit(BUCKETS)) + 1).cast("int"))


def domain_posteriors(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, domains: list, rows: int = TRAIN_ROWS
) -> DataFrame:
    """``docs`` with ``_tokens long`` (words) and ``_posterior array<double>`` in the order of ``domains``."""
    marked = labels.where(F.col(label).isin(domains) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min(label).alias("_domain"))
    sample = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    seen = docs.select("doc_id", "text").join(sample, "doc_id").select("_domain", F.explode(buckets(F.col("text"))).alias("b"))
    counts = seen.groupBy("b").agg(*[F.sum((F.col("_domain") == d).cast("double")).alias(f"n{k}") for k, d in enumerate(domains)])
    # BUCKETS rows at most; one row of the log likelihoods of all buckets, the class 0 as the base
    filled = spark.range(1, BUCKETS + 1).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left")
    count = [F.coalesce(f"n{k}", F.lit(0.0)) + 0.5 for k in range(len(domains))]
    sums = filled.agg(*[F.sum(c).alias(f"s{k}") for k, c in enumerate(count)]).first()
    odds = [F.log(count[k] / sums[k]) - F.log(count[0] / sums[0]) for k in range(1, len(domains))]
    columns = [
        F.transform(F.array_sort(F.collect_list(F.struct("b", o.alias("w")))), lambda s: s["w"]).alias(f"w{k}")
        for k, o in enumerate(odds, 1)
    ]
    table = filled.agg(*columns).first() if columns else ()
    own = docs.withColumn("_buckets", buckets(F.col("text"))).withColumn("_tokens", F.size("_buckets").cast("long"))
    scale = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest("_tokens", F.lit(1)))

    def evidence(line: Column) -> Column:
        return F.aggregate("_buckets", F.lit(0.0), lambda a, b: a + F.element_at(line, b)) * scale

    logits = [F.lit(0.0), *[evidence(F.lit(np.asarray(weights, dtype=np.float64))) for weights in table]]
    own = own.withColumn("_logit", F.array(*logits)).drop("_buckets")
    top = F.array_max("_logit")
    own = own.withColumn("_logit", F.transform("_logit", lambda x: F.exp(x - top)))
    total = F.aggregate("_logit", F.lit(0.0), lambda a, x: a + x)
    return own.withColumn("_posterior", F.transform("_logit", lambda x: x / total)).drop("_logit")


def rate_column(steps: list[np.ndarray], k: int) -> Column:
    """max(0, ...max(0, 1 - p.g1) - p.g2...) over the steps."""
    out = F.lit(1.0)
    for g in steps:
        dot = sum((F.col("_posterior")[j] * float(g[j]) for j in range(1, k)), F.col("_posterior")[0] * float(g[0]))
        out = F.greatest(F.lit(0.0), out - dot)
    return out


def fit_rates(spark: SparkSession, soft: DataFrame, targets: list[float], rounds: int = ROUNDS) -> tuple[list[np.ndarray], float, float]:
    """(steps, highest rate, misfit) for a written table with ``_tokens`` and ``_posterior``; the misfit is the largest gap
    between a domain's share of expected tokens and its target, 0 without tokens."""
    k, steps = len(targets), []
    want = np.asarray(targets, float) / sum(targets)
    p = [F.col("_posterior")[j] for j in range(k)]
    mass = F.col("_tokens").cast("double")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    top, misfit = 1.0, 0.0
    for turn in range(rounds + 1):
        w = F.col("_w")
        table = soft.withColumn("_w", rate_column(steps, k))
        live = mass * (w > 0).cast("double")
        found = table.agg(
            F.sum(mass),
            F.max(F.when(mass > 0, w)),
            *[F.sum(w * mass * p[j]) for j in range(k)],
            *[F.sum(live * p[i] * p[j]) for i, j in pairs],
        ).first()
        if not found[0]:
            return [], 1.0, 0.0
        total, top = found[0], found[1] or 1.0
        reached = np.array(found[2 : 2 + k])
        miss = reached / total - want
        misfit = float(np.abs(reached / max(reached.sum(), 1e-300) - want).max())
        if np.abs(miss).max() < TOLERANCE or turn == rounds:
            break
        gram = np.zeros((k, k))
        for (i, j), v in zip(pairs, found[2 + k :]):
            gram[i, j] = gram[j, i] = v / total
        steps.append(np.linalg.solve(gram + 1e-9 * np.eye(k), miss))
    return steps, max(top, 1e-12), misfit


def mixing_rates(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict = TARGETS, label: str = "quality"
) -> DataFrame:
    """``doc_id, tokens, posterior array<double>, rate, copies, misfit`` for every row of ``docs (doc_id, text)``.

    ``misfit``, one number for all rows, is the largest gap that is left between a domain's share of expected tokens and
    its target; targets that no rates can meet show there.

    Domains are the keys of ``targets`` in order; labels of other values are not used. A null or empty text has no
    token and the posteriors of no evidence; it gets the rate of those. Without labelled rows all posteriors
    are even. A row of null doc_id is treated like others. Repeated rows have equal results. An empty table gives
    an empty table; other columns are ignored.
    """
    scratch = Scratch(spark, "mixing")
    domains = list(targets)
    soft = domain_posteriors(spark, docs.select("doc_id", "text"), labels, label, domains)
    soft = scratch.put(soft.select("doc_id", "_tokens", "_posterior"), "posteriors")
    steps, top, misfit = fit_rates(spark, soft, [targets[d] for d in domains])
    rate = F.least(F.lit(1.0), rate_column(steps, len(domains)) / top)
    u = F.xxhash64(F.col("doc_id"), F.lit(5)).bitwiseAND((1 << 53) - 1).cast("double") / float(1 << 53)
    return soft.withColumn("rate", rate).select(
        "doc_id",
        F.col("_tokens").alias("tokens"),
        F.col("_posterior").alias("posterior"),
        "rate",
        F.floor(F.col("rate") + u).cast("int").alias("copies"),
        F.lit(misfit).alias("misfit"),
    )


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict = TARGETS) -> DataFrame:
    """The rows of ``docs`` that their rates keep, with its columns.

    The decision belongs to the doc_id: rows that share one share it, by the smallest rate. Null ids stay.
    """
    rates = mixing_rates(spark, docs, labels, targets)
    gone = rates.groupBy("doc_id").agg(F.min("copies").alias("c")).where("c = 0 and doc_id is not null").select("doc_id")
    gone = Scratch(spark, "mixing").put(gone, "gone")
    return docs.join(bounded_broadcast(gone, 24), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for the target shares of ``labels.quality``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mixing_rates(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(TARGETS)]
    return out.select("doc_id", "tokens", *shares, "rate", "copies", "misfit")
