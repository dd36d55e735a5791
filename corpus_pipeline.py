"""Corpus pipeline: language ID, near duplicates, secrets, mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.

* ``language_id``: keeps documents with a known language and at least ``LEAST_SCORE`` of evidence for it;
* ``ngram_jaccard_join``: of each group of near copies (``SHINGLE`` words, ``PERCENT`` of Jaccard) the document of the smallest id stays (of repeated rows of an id, one);
* ``secret_scan``: secrets give way to ``[SECRET]``, and ``n_chars`` follows the text; no document goes;
* ``mix``: a document stays as often as the mix takes it (not at all, once or twice); one without words, which the
  mix can't weigh, stays once;
* ``bpe``: token ids of every row, with the digests of ids and decoded text.

An empty table passes through every stage; a null text is an empty text, whose language is unknown.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.llm import langid, mixing, ngram_join, secrets
from pairforge.llm.bpe import bpe_round_trip
from pairforge.llm.common import free_name, keep_ids, written
from pairforge.session import shared_dir

LEAST_SCORE = 0.5
SHINGLE, PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judge, name = langid.predictor(spark, langid.fit(docs)), free_name(docs, "_judged")
    judged = docs.withColumn(name, judge(F.col("text")))
    known = (F.col(name)["lang_pred"] != langid.UNKNOWN) & (F.col(name)["score"] >= LEAST_SCORE)
    return judged.where(known).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    joined = written(ngram_join.ngram_jaccard_join(docs, n=SHINGLE, percent=PERCENT))
    gone = joined.where(F.col("component_id") != F.col("doc_id"))
    kept = keep_ids(docs, gone, "doc_id", "left_anti")
    twice = written(joined.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id"))
    if twice.isEmpty():
        return kept.select(docs.columns)
    # an id that occurs in several rows: one of them, by its text
    rank, name = F.row_number().over(Window.partitionBy("doc_id").orderBy("text")), free_name(docs, "_rank")
    once = keep_ids(kept, twice, "doc_id", "left_semi").withColumn(name, rank).where(F.col(name) == 1)
    return keep_ids(kept, twice, "doc_id", "left_anti").select(docs.columns).unionByName(once.select(docs.columns))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs, "_clean")
    clean = docs.withColumn(name, secrets.redactor(spark)(F.col("text")))
    changed = ~F.col(name).eqNullSafe(F.col("text"))
    length = F.char_length(name).cast(docs.schema["n_chars"].dataType)
    now = {"text": F.col(name), "n_chars": F.when(changed, length).otherwise(F.col("n_chars"))}
    return clean.select(*[now.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_round_trip(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix", mix),
    ("bpe", bpe),
]

#: Language models and BPE have no SQL twin; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "corpus_pipeline", unique=True)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
