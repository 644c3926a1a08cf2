"""The corpus pipeline: five operators, each reading what the one before it wrote.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, all but the
last with the columns of ``documents``. Documents of null doc_id pass the stages that decide by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataphon.llm.common import Scratch, bounded_broadcast
from strataphon.llm.jaccard_join import jaccard_rows
from strataphon.llm.mixing import mix
from strataphon.llm.packing import default_tokenizer, pack
from strataphon.llm.suffix_dedup import PASSAGE_WORDS, strip_repeats
from strataphon.llm.toxicity import score_toxicity, train_toxicity


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    model = train_toxicity(spark, docs, _labels(spark, sf_dir), F.lit(True))
    return score_toxicity(spark, docs, model).where("toxicity < 0.5").drop("toxicity")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5 words, 0.8) the row of smallest id stays, of a repeated row one.

    Rows are told apart by id and text: of texts that share an id only copies go. Rows of null id stay.
    """
    scratch = Scratch(spark, "near")
    found = jaccard_rows(spark, docs, width=5, percent=80, links=False).where("doc_id is not null")
    found = scratch.put(found.groupBy("doc_id", "text_key", "component").agg(F.count(F.lit(1)).alias("n")), "groups")
    first = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    gone = found.join(first.where("rows > 1"), "component").where(F.struct("doc_id", "text_key") != F.col("first"))
    gone = scratch.put(gone.select("doc_id", "text_key"), "gone")
    some_repeat = not found.where("n > 1").isEmpty()
    scratch.keep(gone)
    key = docs.withColumn("text_key", F.xxhash64("text"))
    kept = key.join(bounded_broadcast(gone, 32), ["doc_id", "text_key"], "left_anti")
    if some_repeat:
        once = kept.where("doc_id is not null").dropDuplicates(["doc_id", "text_key"])
        kept = once.unionByName(kept.where("doc_id is null"))
    return kept.select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of over 50 words and repeated 400-byte strings go; ``n_chars`` follows the text."""
    out = strip_repeats(spark, docs, words=PASSAGE_WORDS)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents thinned to the target shares of quality."""
    return mix(spark, docs, _labels(spark, sf_dir))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 4096 ids."""
    return pack(spark, docs, default_tokenizer(), with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: The stages train models and follow links, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.put(docs, name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
