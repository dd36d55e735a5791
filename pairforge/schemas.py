"""Explicit schemas of the data model (no JSON inference: it costs a scan and
cannot type a column whose arrays are all empty)."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES = T.ArrayType(MESSAGE)

ROLE_VALUE = T.StructType([
    T.StructField("from", T.StringType()),
    T.StructField("value", T.StringType()),
])

# One row per prompt.
PROMPTS = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("context_messages", MESSAGES),
])

# D3: candidate set, wide.
CANDIDATES = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("prompt", MESSAGES),
    T.StructField("responses", T.ArrayType(T.StringType())),
])

# Scored set, wide; ``rewards`` is parallel to ``responses``.
SCORED = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("prompt", MESSAGES),
    T.StructField("responses", T.ArrayType(T.StringType())),
    T.StructField("rewards", T.ArrayType(T.DoubleType())),
])

# The same sets as JSONL files from the reference's stages carry no row id.
CANDIDATES_JSONL = T.StructType([f for f in CANDIDATES.fields if f.name != "row_id"])
SCORED_JSONL = T.StructType([f for f in SCORED.fields if f.name != "row_id"])

# Long form of D3/D4: one row per (row_id, k).
CANDIDATE_LONG = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("response", T.StringType()),
])

# Preference pair.
PAIRS = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("chosen", T.StringType()),
    T.StructField("rejected", T.StringType()),
    T.StructField("margin", T.DoubleType()),
])

# Log-prob row.
LOGPS = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("policy_chosen_logps", T.DoubleType()),
    T.StructField("policy_rejected_logps", T.DoubleType()),
    T.StructField("reference_chosen_logps", T.DoubleType()),
    T.StructField("reference_rejected_logps", T.DoubleType()),
])

# Token table, one row per (seq_id, pos); label -100 = masked.
TOKENS = T.StructType([
    T.StructField("seq_id", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("logits", T.ArrayType(T.DoubleType())),
])

# Run record.
RUN_RECORD = T.StructType([
    T.StructField("iteration", T.IntegerType()),
    T.StructField("mean_score", T.DoubleType()),
    T.StructField("top1_score", T.DoubleType()),
])

LABEL_PAD = -100
