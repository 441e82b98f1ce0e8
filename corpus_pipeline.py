"""From raw documents to packed token sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontaminate, jaccard, language, packing, privacy
from weftline.llm.queries import VOCABULARY
from weftline.session import settle

# Texts and sets of documents go to Python in batches of so many bytes, not only of so many rows, as each
# core of an executor holds some of them twice.
BATCH_BYTES = "4m"
# A text of at least so many letters that needs so many phrases per letter is in no learned language.
LEAST_LETTERS, REJECTED_RATE = 50, 0.5


def bounded_batches(stage):
    """The stage with the session's Arrow batches bounded by ``BATCH_BYTES``."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return bounded


@bounded_batches
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in no language that the labelled ones teach."""
    found = language.identify(docs, language.learn(docs))
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    strange = (F.col("lang_rate") >= REJECTED_RATE) & (letters >= LEAST_LETTERS)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & ~strange).select(*_names(docs))


@bounded_batches
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    Rows that share an id (or have none) are judged one by one; rows with the same id and text are kept once.
    """
    kept = _without(docs, settle(jaccard.later_copies(docs, width=5, percent=80), "dropped"))
    again = kept.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again__"))
    same = F.col("doc_id").eqNullSafe(F.col("again__"))
    again = jaccard.small(settle(again, "again"))
    single = kept.join(again, same, "left_anti")
    return single.unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


@bounded_batches
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    leaks = decontaminate.find_leaks(docs, benchmark, code=jaccard.text_code()).select("doc_id", "code").distinct()
    return _without(docs, settle(leaks, "leaks"))


@bounded_batches
def mask_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in texts by its kind; ``n_chars`` follows the new text."""
    masked = privacy.mask(privacy.find_private(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return masked.select(*_names(docs))


@bounded_batches
def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 ids, with the ids."""
    return packing.pack(docs, VOCABULARY)


def _names(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns]


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows of the given ids and text codes."""
    gone = jaccard.small(rows.select(F.col("doc_id").alias("gone__"), F.col("code").alias("code__")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("gone__")) & (jaccard.text_code() == F.col("code__"))
    return docs.join(gone, same, "left_anti")


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("private_data", mask_private_data),
    ("packing", pack_tokens),
]

# SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
