"""Inputs derived from the given tables (integer arithmetic and MD5 only, so that
Spark and an SQL oracle agree exactly).  Every input grows with its source table.

* prompts    -- conversations: per ``conv_id`` the turns up to the last user turn.
* candidates -- per prompt, K = 4 responses (3 when ``conv_id % 7 = 0``, the short
  sets that F1 drops); response ``k`` is the whole text of document
  ``(conv_id*37 + k*101 + k*k*13) mod n_documents``.
* rewards    -- 1.0 for every response when ``conv_id % 11 = 0`` (all tied), else
  ``(h mod 41)/8 - 2.5`` with ``h`` the first 4 hex digits of ``md5(response)``.
* logps      -- four dyadic log-probs per ``events`` row, ``batch_id = event_id div 16``.
* tokens     -- ``embeddings`` as a token table: ``seq_id = vec_id div 10``,
  ``pos = vec_id mod 10``, label -100 at ``pos < 3``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ints import idiv
from ..operators.candidates import drop_short, to_wide
from ..schemas import LABEL_PAD
from .tables import read_table

K = 4
SHORT_EVERY = 7
TIED_EVERY = 11
BATCH_SIZE = 16
TOKENS_PER_SEQ = 10
MASKED_PREFIX = 3
PAIRS_PER_BATCH = 4


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 from ``conversations``: ``row_id = conv_id``, messages in turn order.

    One shuffle on ``conv_id``: the window and the grouping share it.
    """
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last_user = F.max(F.when(F.col("role") == "user", F.col("turn"))).over(Window.partitionBy("conv_id"))
    kept = conv.withColumn("_last_user", last_user).filter(F.col("turn") <= F.col("_last_user"))
    msgs = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    grouped = kept.groupBy("conv_id").agg(msgs.alias("_m"))
    return grouped.select(
        F.col("conv_id").alias("row_id"),
        F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        .alias("context_messages"),
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT chats: the whole conversation as ``messages`` (``row_id = conv_id``)."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    msgs = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    grouped = conv.groupBy("conv_id").agg(msgs.alias("_m"))
    return grouped.select(
        F.col("conv_id").alias("row_id"),
        F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        .alias("messages"),
    )


def fixture_reward(row_id: Column, response: Column) -> Column:
    h = F.conv(F.substring(F.md5(response), 1, 4), 16, 10).cast("long")
    return F.when(row_id % TIED_EVERY == 0, F.lit(1.0)).otherwise((h % 41).cast("double") / 8.0 - 2.5)


def prompt_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id`` of every prompt (conversations with a user turn): a distinct over
    two columns with map-side partial aggregation, instead of re-deriving prompts."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.filter(F.col("role") == "user").select(F.col("conv_id").alias("row_id")).distinct()


def candidate_ids(prompt_df: DataFrame, n_docs: Column) -> DataFrame:
    """(row_id, k, doc_id) for every prompt; row-local ``explode``, no join."""
    ks = F.when(F.col("row_id") % SHORT_EVERY == 0, F.array(*[F.lit(i) for i in range(K - 1)])) \
        .otherwise(F.array(*[F.lit(i) for i in range(K)]))
    ids = prompt_df.select("row_id", F.explode(ks).alias("k"))
    k = F.col("k").cast("long")
    doc = F.pmod(F.col("row_id") * 37 + k * 101 + k * k * 13, n_docs)
    return ids.select("row_id", F.col("k").cast("int").alias("k"), doc.alias("doc_id"))


def candidates_long(spark: SparkSession, sf_dir: str, prompt_df: DataFrame | None = None,
                    with_reward: bool = True) -> DataFrame:
    """Long candidates ``(row_id, k, response[, reward])``; whole document texts.

    ``n_documents`` is a scalar subquery (computed once), not a join; the
    document lookup is an equi-join on ``doc_id`` that AQE plans by runtime size.
    """
    docs = read_table(spark, sf_dir, "documents")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    p = prompt_df if prompt_df is not None else prompt_ids(spark, sf_dir)
    ids = candidate_ids(p, n_docs)
    joined = ids.join(docs.select("doc_id", F.col("text").alias("response")), "doc_id", "inner")
    cols = [F.col("row_id"), F.col("k"), F.col("response")]
    if with_reward:
        cols.append(fixture_reward(F.col("row_id"), F.col("response")).alias("reward"))
    return joined.select(*cols)


def scored_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 wide (before F1): ``row_id, prompt, responses, rewards``."""
    p = prompts(spark, sf_dir)
    wide = to_wide(candidates_long(spark, sf_dir))
    return p.select("row_id", F.col("context_messages").alias("prompt")).join(wide, "row_id", "inner")


def scored(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """D4 wide after F1 (what the annotator writes)."""
    return drop_short(scored_all(spark, sf_dir), k)


def _dyadic(event_id: Column, mult: int, mod: int) -> Column:
    # ((e mod m) * c) mod m == (e * c) mod m, without overflow for any e.
    return -(F.pmod(F.pmod(event_id, F.lit(mod)) * mult, F.lit(mod))).cast("double") / 64.0


def logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 from ``events``: four dyadic log-probs per pair, 16 pairs per batch."""
    e = F.col("event_id")
    return read_table(spark, sf_dir, "events").select(
        e.alias("pair_id"),
        idiv(e, BATCH_SIZE).alias("batch_id"),
        _dyadic(e, 7919, 4001).alias("policy_chosen_logps"),
        _dyadic(e, 104729, 4003).alias("policy_rejected_logps"),
        _dyadic(e, 1299709, 3989).alias("reference_chosen_logps"),
        _dyadic(e, 15485863, 3967).alias("reference_rejected_logps"),
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 from ``embeddings``: ``seq_id, pos, label, logits`` (64 logits per position)."""
    v = F.col("vec_id")
    pos = (v % TOKENS_PER_SEQ).cast("int")
    return read_table(spark, sf_dir, "embeddings").select(
        idiv(v, TOKENS_PER_SEQ).alias("seq_id"),
        pos.alias("pos"),
        F.when(pos < MASKED_PREFIX, F.lit(LABEL_PAD)).otherwise(F.col("label")).cast("int").alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("logits"),
    )


def with_pair_keys(df: DataFrame) -> DataFrame:
    """Token rows -> pair keys: even ``seq_id`` = chosen, odd = rejected, 4 pairs per batch."""
    pair = idiv(F.col("seq_id"), 2)
    return df.withColumn("pair_id", pair) \
        .withColumn("batch_id", idiv(pair, PAIRS_PER_BATCH)) \
        .withColumn("side", F.when(F.col("seq_id") % 2 == 0, F.lit("chosen")).otherwise(F.lit("rejected")))
