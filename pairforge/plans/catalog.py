"""The contract queries: one Spark plan per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or data Spark derives from them).  Output columns are scalars with the
same names and types as the SQL twin in ``oracle.py``: integers as ``bigint``,
transcendental results rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import first_score
from ..functions.ints import idiv
from ..functions.chat import DEFAULT_BOS, END_OF_TURN, normalise_chat, render_chat, reward_model_text
from ..functions.text import drop_chars, strip_echo_all, token_ids
from ..operators import losses as LS
from ..operators import tokens as TK
from ..operators.candidates import (drop_short, join_candidates, overlength_guard, render_prompts,
                                    to_long, to_wide)
from ..operators.hooks import (generate_candidates, generate_wide, score_candidates, score_wide,
                               score_with_model, tokenise)
from ..operators.ordering import (head_n, in_order, sanity_cut, shard_cover, shard_floor, shard_round_robin,
                                  shuffle, with_ordinal)
from ..operators.pairs import (STRATEGIES, best_vs_rest, build_eval_pairs, build_pairs,
                               build_pairs_multi, pair_outcomes)
from ..operators.summaries import run_record as run_record_op
from ..operators.summaries import score_summary as score_summary_op
from ..operators.summaries import shard_counts as shard_counts_op
from ..schemas import SCORED
from ..session import shared_dir
from ..sources import fixtures as fx
from ..sources.jsonl import (add_row_ids, read_jsonl, read_jsonl_at, read_records, read_shard_files, read_shards,
                             write_in_order, write_shard_files, write_sharded)
from ..sources.tables import read_prompts, read_table
from .iteration import IterationConfig, run_iterations
from .stand_ins import echo_generator, make_md5_predict, md5_scorer, trigram_tokeniser

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the contract queries.
K = fx.K
LENGTH_PENALTY = 1.0 / 256
EOT = END_OF_TURN
# beta = 1/8 keeps every non-transcendental value dyadic, hence exact in both engines.
BETA = 0.125
EXACT_LOSSES = ("hinge", "ipo", "sppo_hard")
ROBUST_EPS = 0.125
SMOOTHING = 0.1  # the shipped training setting
AUX_COEF = 0.5
ALPHA = 0.125
RPO_ALPHA = 0.5
MAX_INPUT_LENGTH = 3000
SHARDS = 7
SHUFFLE_SEED = 42
PACK_LEN = 4096
MAX_LENGTH = 2048
MAX_PROMPT_LENGTH = 1000
HEAD_N = 50
EVAL_EVERY = 5
MARGIN_SCALE = 0.5
#: White space that ``str.strip`` removes beyond the blank, and none.
PADS = (" \t", "\u3000", "", "\u2028\n", "\u00a0 ", "\x1c")
ROLE_TO_SHAREGPT = {"system": "system", "user": "human", "assistant": "gpt"}
SHAREGPT_ROLES = {"system": "system", "human": "user", "gpt": "assistant"}

QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _long(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


# --- rendering (P1-P6, P13, P14) ---------------------------------------------------

@query("render_sft")
def render_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = fx.chats(spark, sf_dir)
    return chats.select("row_id", render_chat(F.col("messages")).alias("text"))


@query("render_sft_long")
def render_sft_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 straight from the long conversations table (pieces rendered in codegen, then joined)."""
    from ..functions.chat import render_long

    conv = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("row_id"), "turn", "role", F.col("text").alias("content"))
    return render_long(conv)


@query("render_prompt")
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = render_prompts(fx.prompts(spark, sf_dir), out="prompt")
    return p.select("row_id", "prompt")


@query("render_rm_text")
def render_rm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = to_long(fx.scored(spark, sf_dir), arrays=("responses",), names=("response",), keep=("prompt",))
    return long.select("row_id", _long("k"), reward_model_text(F.col("prompt"), F.col("response")).alias("rm_text"))


@query("strip_echo")
def strip_echo_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = render_prompts(fx.scored(spark, sf_dir), messages="prompt", out="prompt_text")
    echoed = F.transform("responses", lambda r: F.concat(F.col("prompt_text"), r))
    stripped = s.select("row_id", F.posexplode(strip_echo_all(echoed, F.col("prompt_text"))).alias("k", "response"))
    return stripped.select("row_id", _long("k"), "response")


@query("normalise_chat")
def normalise_chat_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = fx.chats(spark, sf_dir)
    to_sg = F.create_map(*[F.lit(x) for kv in ROLE_TO_SHAREGPT.items() for x in kv])
    sharegpt = chats.select("row_id", F.transform(
        "messages", lambda m: F.struct(F.element_at(to_sg, m["role"]).alias("from"), m["content"].alias("value"))
    ).alias("conversations"))
    norm = sharegpt.select("row_id", F.posexplode(normalise_chat(F.col("conversations"), SHAREGPT_ROLES))
                           .alias("turn", "m"))
    return norm.select("row_id", _long("turn"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query("role_mask")
def role_mask_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("row_id"), "turn", "role", F.col("text").alias("content"))
    toks = TK.role_mask(conv)
    trained = F.col("label") != F.lit(-100)
    return toks.groupBy("row_id", "turn").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count_if(trained).cast("long").alias("n_trained"),
        F.coalesce(F.sum(F.when(trained, F.col("label"))), F.lit(0)).cast("long").alias("trained_id_sum"),
    )


# --- candidates (J1, P7, G2, G4, G5, P8, F1) ------------------------------------------

@query("candidates_join")
def candidates_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = to_wide(fx.candidates_long(spark, sf_dir, with_reward=False), values=("response",), arrays=("responses",))
    j = join_candidates(fx.prompts(spark, sf_dir), wide)
    return j.select(
        "row_id",
        F.size("prompt").cast("long").alias("n_messages"),
        F.size("responses").cast("long").alias("n_responses"),
        F.aggregate("responses", F.lit(0).cast("long"), lambda acc, r: acc + F.length(r)).alias("response_chars"),
    )


@query("candidates_wide")
def candidates_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = to_wide(fx.candidates_long(spark, sf_dir))
    z = wide.select("row_id", F.posexplode(F.arrays_zip("responses", "rewards")).alias("k", "z"))
    return z.select("row_id", _long("k"), F.col("z.responses").alias("response"), F.col("z.rewards").alias("reward"))


@query("candidates_long")
def candidates_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(fx.scored_all(spark, sf_dir)).select("row_id", _long("k"), "response", "reward")


@query("first_score")
def first_score_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = fx.candidates_long(spark, sf_dir)
    outputs = F.array(
        F.struct(F.lit("LABEL_0").alias("label"), F.col("reward").alias("score")),
        F.struct(F.lit("LABEL_1").alias("label"), (1.0 - F.col("reward")).alias("score")),
    )
    return long.select("row_id", _long("k"), first_score(outputs).alias("score"))


@query("overlength_guard")
def overlength_guard_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = render_prompts(fx.scored_all(spark, sf_dir), messages="prompt", out="prompt_text")
    g = overlength_guard(s, MAX_INPUT_LENGTH, F.col("prompt_text"))
    return g.select("row_id", F.size("responses").cast("long").alias("n_responses"))


@query("drop_short")
def drop_short_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_short(fx.scored_all(spark, sf_dir), K)
    return kept.select("row_id", F.size("responses").cast("long").alias("n_responses"))


# --- pair selection (C1-C9, F2, F3, P9-P12, A4, L1, L2) -------------------------------

def _pairs(strategy: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lam = LENGTH_PENALTY if strategy == "max_min_p" else 0.0
        return build_pairs(fx.scored(spark, sf_dir), strategy, length_penalty=lam, eot_token=EOT)
    run.__name__ = f"pairs_{strategy}"
    return run


for _s in STRATEGIES:
    QUERIES[f"pairs_{_s}"] = _pairs(_s)


@query("pairs_max_min_scaled")
def pairs_max_min_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 with a margin scale: margin = (hi - lo) * 0.5."""
    return build_pairs(fx.scored(spark, sf_dir), "max_min", margin_scale=MARGIN_SCALE, eot_token=EOT)


@query("pair_outcomes")
def pair_outcomes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_outcomes(fx.scored_all(spark, sf_dir), length_penalty=LENGTH_PENALTY)


@query("pairs_multi")
def pairs_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_pairs_multi(fx.scored(spark, sf_dir), best_vs_rest, eot_token=EOT)


@query("pairs_eval")
def pairs_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_eval_pairs(fx.scored(spark, sf_dir), eot_token=EOT)


@query("pairs_head")
def pairs_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return head_n(build_pairs(fx.scored(spark, sf_dir), "max_min", eot_token=EOT), HEAD_N)


# --- summaries (A1-A3, A5, A8, S6) -----------------------------------------------------

@query("score_summary")
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_summary_op(fx.scored_all(spark, sf_dir), K)


@query("run_record")
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three prompt sets (contiguous L4 shards of the scored rows), one record each."""
    sets = shard_cover(fx.scored(spark, sf_dir).select("row_id", "rewards"), 3)
    rec = run_record_op(sets.withColumn("iteration", (F.col("shard") + 1).cast("long")))
    return rec.select("iteration", "n", "mean_score", "top1_score")


@query("shard_counts")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = shard_round_robin(fx.scored(spark, sf_dir).select("row_id"), 8)
    return shard_counts_op(rr).select(_long("shard"), "n")


# --- ordering and shards (L3-L8, U1, U2) ------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select("o_orderkey")


@query("shard_floor")
def shard_floor_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_floor(_orders(spark, sf_dir), SHARDS, drop_tail=True, key="o_orderkey").select("o_orderkey", "ordinal", _long("shard"))


@query("shard_cover")
def shard_cover_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_cover(_orders(spark, sf_dir), SHARDS, key="o_orderkey").select("o_orderkey", "ordinal", _long("shard"))


@query("shard_round_robin")
def shard_round_robin_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_round_robin(_orders(spark, sf_dir), SHARDS, key="o_orderkey").select("o_orderkey", _long("shard"))


@query("shard_union")
def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + U2: documents in 8 contiguous shards (L4) written as shard folders (S5),
    every shard read back and concatenated (S3): counts per shard equal the input's."""
    from ..sources.jsonl import write_sharded as _ws

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    path = shared_dir(spark, "shard_union", unique=True)
    _ws(shard_cover(docs, 8, key="doc_id").drop("ordinal"), path)
    back = read_shards(spark, path, 8, "doc_id long, lang string, shard int")
    return back.groupBy(_long("shard")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query("ordinal")
def ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ordinal(_orders(spark, sf_dir), key="o_orderkey")


@query("shuffle_merge")
def shuffle_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 8 contiguous shards (L4), concatenated (U1/U2) and shuffled."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    sharded = shard_cover(docs, 8, key="doc_id").drop("ordinal")
    return shuffle(sharded, SHUFFLE_SEED, key="doc_id").select("doc_id", _long("shard"), "position")


# --- losses (Z1-Z3, X1-X14, A6, A7, A9, J2, J5) ---------------------------------------

def _loss(loss_type: str, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = LS.preference_loss(fx.logps(spark, sf_dir), loss_type, beta=BETA, **kw)
        if loss_type in ("aot", "aot_pair"):
            return out.select("batch_id", "rank", r6("loss").alias("loss"))
        loss = F.col("loss") if loss_type in EXACT_LOSSES else r6("loss")
        return out.select("pair_id", "batch_id", loss.alias("loss"), "chosen_reward", "rejected_reward")
    return run


for _t in LS.LOSS_TYPES:
    QUERIES[f"loss_{_t}"] = _loss(_t, label_smoothing=ROBUST_EPS if _t == "robust" else 0.0)
QUERIES["loss_sigmoid_alpha"] = _loss("sigmoid", f_divergence="alpha_divergence", alpha=ALPHA)
QUERIES["loss_sigmoid_js"] = _loss("sigmoid", f_divergence="js_divergence")
QUERIES["loss_sigmoid_smoothed"] = _loss("sigmoid", label_smoothing=SMOOTHING)
QUERIES["loss_sigmoid_ref_free"] = _loss("sigmoid", reference_free=True)


@query("implicit_rewards")
def implicit_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cr, rj = LS.implicit_rewards(BETA)
    return fx.logps(spark, sf_dir).select("pair_id", cr.alias("chosen_reward"), rj.alias("rejected_reward"))


@query("batch_loss")
def batch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = LS.preference_loss(fx.logps(spark, sf_dir), "sigmoid", beta=BETA)
    return LS.batch_loss(losses).select("batch_id", r6("loss").alias("loss"))


@query("batch_loss_aux")
def batch_loss_aux(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 with an auxiliary loss per batch (a rule on the batch id)."""
    losses = LS.preference_loss(fx.logps(spark, sf_dir), "sigmoid", beta=BETA)
    aux = losses.select("batch_id").distinct().withColumn("aux_loss", (F.col("batch_id") % 7) / F.lit(8.0))
    return LS.batch_loss(losses, aux=aux, aux_coef=AUX_COEF).select("batch_id", r6("loss").alias("loss"))


def _token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy log-probs per pair from the token table (J4 stack/split of T2)."""
    t = fx.with_pair_keys(fx.tokens(spark, sf_dir))
    chosen = t.filter(F.col("side") == "chosen").drop("side")
    rejected = t.filter(F.col("side") == "rejected").drop("side")
    return TK.stack_split(chosen, rejected)


def _policy_with_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pol = _token_pairs(spark, sf_dir).select(
        "pair_id",
        idiv(F.col("pair_id"), fx.PAIRS_PER_BATCH).alias("batch_id"),
        F.col("chosen_logps").alias(LS.PC), F.col("rejected_logps").alias(LS.PR), "chosen_tokens", "rejected_tokens")
    return LS.with_reference(pol, fx.logps(spark, sf_dir))


@query("ref_logps_join")
def ref_logps_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _policy_with_reference(spark, sf_dir)
    return j.select("pair_id", *[r6(c).alias(c) for c in (LS.PC, LS.PR, LS.RC, LS.RR)])


def _nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.batch_nll(fx.with_pair_keys(fx.tokens(spark, sf_dir)))


def _token_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses of the token table's pairs; it may end inside the last pair, whose loss is then null."""
    whole = F.col("chosen_tokens").isNotNull() & F.col("rejected_tokens").isNotNull()
    return LS.preference_loss(_policy_with_reference(spark, sf_dir), "sigmoid", beta=BETA, whole=whole)


@query("loss_rpo")
def loss_rpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = _token_losses(spark, sf_dir)
    out = LS.add_rpo(losses, _nll(spark, sf_dir), RPO_ALPHA)
    return out.select("pair_id", "batch_id", r6("loss").alias("loss"))


@query("batch_metrics")
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = _token_losses(spark, sf_dir)
    logits = TK.logits_sums(fx.with_pair_keys(fx.tokens(spark, sf_dir)))
    nll = _nll(spark, sf_dir)
    split = F.when(F.pmod("pair_id", F.lit(EVAL_EVERY)) == 1, F.lit("eval")).otherwise(F.lit("train"))
    out = LS.batch_metrics(losses, split, logits=logits, nll=nll)
    return out.select("split", "batch_id", "metric", r6("value").alias("value"))


# --- tokens (T1-T9, J4) -----------------------------------------------------------------

@query("seq_logps")
def seq_logps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TK.sequence_logps(fx.tokens(spark, sf_dir))
    return s.select("seq_id", r6("logps").alias("logps"), "n_tokens")


@query("seq_logps_chunked")
def seq_logps_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/T2 over the array layout, four positions to a chunk: the logits cross no join."""
    s = TK.chunk_logps(TK.to_chunks(fx.tokens(spark, sf_dir), 4))
    return s.select("seq_id", r6("logps").alias("logps"), "n_tokens")


@query("seq_logps_avg")
def seq_logps_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = TK.sequence_logps(fx.tokens(spark, sf_dir), average=True)
    return s.select("seq_id", r6("logps").alias("logps"))


@query("batch_nll")
def batch_nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nll(spark, sf_dir).select("batch_id", r6("nll_loss").alias("nll_loss"))


@query("stack_split")
def stack_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _token_pairs(spark, sf_dir)
    return s.select("pair_id", r6("chosen_logps").alias("chosen_logps"), r6("rejected_logps").alias("rejected_logps"),
                    "chosen_tokens", "rejected_tokens")


@query("align_labels")
def align_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels start at position 2 (8 per sequence); logits cover all 10 positions."""
    t = fx.tokens(spark, sf_dir)
    labels = t.filter(F.col("pos") >= 2).select("seq_id", (F.col("pos") - 2).cast("int").alias("pos"), "label")
    logits = t.select("seq_id", "pos", "logits")
    checked = TK.check_shapes(labels, TK.trim_logits(logits, labels))
    s = TK.sequence_logps(checked)
    return s.select("seq_id", r6("logps").alias("logps"), "n_tokens")


@query("pack_blocks")
def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", TK.text_token_counts("text").alias("n_tokens"))
    return TK.pack_spans(docs, PACK_LEN)


@query("pack_hash_keys")
def pack_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 over keys that span 64 bits and repeat (97 different ones, of both signs)."""
    rest = F.col("doc_id") % 97
    h = F.conv(F.substring(F.md5(rest.cast("string")), 1, 15), 16, 10).cast("long") * 8
    docs = read_table(spark, sf_dir, "documents").select(
        F.when(rest % 2 == 0, h).otherwise(-h).alias("hash_key"), TK.text_token_counts("text").alias("n_tokens"))
    return TK.pack_spans(docs, PACK_LEN, key="hash_key")


@query("role_mask_hook")
def role_mask_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 with a tokeniser from outside, whose pieces are not words."""
    conv = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("row_id"), "turn", "role", F.col("text").alias("content"))
    toks = TK.role_mask(tokenise(conv, trigram_tokeniser, "content"), tokens="tokens")
    trained = F.col("label") != F.lit(-100)
    return toks.groupBy("row_id", "turn").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_if(trained).cast("long").alias("n_trained"),
        F.coalesce(F.sum(F.when(trained, F.col("label"))), F.lit(0)).cast("long").alias("trained_id_sum"))


@query("pack_tokens_hook")
def pack_tokens_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 with content, by a tokeniser from outside: every block's length, first and last id and sum of ids."""
    docs = tokenise(read_table(spark, sf_dir, "documents").select("doc_id", "text"), trigram_tokeniser)
    blocks = TK.pack_tokens(docs.select("doc_id", "tokens"), PACK_LEN)
    return blocks.select("block_id", F.size("tokens").cast("long").alias("n_tokens"), F.get("tokens", 0).alias("first_id"),
                         F.element_at("tokens", -1).alias("last_id"), F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("truncate_hook")
def truncate_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 (the start of a prompt stays) on ids of a tokeniser from outside."""
    pairs = build_pairs(fx.scored(spark, sf_dir), "max_min", eot_token=EOT).select("row_id", "prompt", "chosen", "rejected")
    for text in ("prompt", "chosen", "rejected"):
        pairs = tokenise(pairs, trigram_tokeniser, text, f"{text}_ids")
    p, c, r = TK.truncate_pair(F.col("prompt_ids"), F.col("chosen_ids"), F.col("rejected_ids"), MAX_LENGTH, MAX_PROMPT_LENGTH, "keep_start")
    t = pairs.select("row_id", p.alias("p"), c.alias("c"), r.alias("r"))
    return t.select("row_id", F.size("p").cast("long").alias("prompt_len"), F.size("c").cast("long").alias("chosen_len"),
                    F.size("r").cast("long").alias("rejected_len"), F.get("p", F.size("p") - 1).alias("prompt_last"),
                    F.get("c", F.size("c") - 1).alias("chosen_last"), F.get("r", F.size("r") - 1).alias("rejected_last"))


@query("sft_pack")
def sft_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SFT path: whole conversations rendered (P1), tokenised (hook default),
    packed into 4096-token blocks in row order (T8); no sample limit (F4, n <= 0)."""
    chats = head_n(fx.chats(spark, sf_dir), 0)
    texts = chats.select("row_id", TK.text_token_counts(render_chat(F.col("messages"))).alias("n_tokens"))
    return TK.pack_spans(texts, PACK_LEN, key="row_id")


@query("truncate_end")
def truncate_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = build_pairs(fx.scored(spark, sf_dir), "max_min", eot_token=EOT)
    p, c, r = TK.truncate_pair(token_ids("prompt"), token_ids("chosen"), token_ids("rejected"),
                               MAX_LENGTH, MAX_PROMPT_LENGTH, "keep_end")
    t = pairs.select("row_id", p.alias("p"), c.alias("c"), r.alias("r"))
    return t.select(
        "row_id",
        F.size("p").cast("long").alias("prompt_len"),
        F.size("c").cast("long").alias("chosen_len"),
        F.size("r").cast("long").alias("rejected_len"),
        F.get("p", 0).alias("prompt_first"),
        F.get("c", F.size("c") - 1).alias("chosen_last"),
        F.get("r", F.size("r") - 1).alias("rejected_last"),
    )


# --- hooks, sources/sinks, iteration (G1, G3, S1-S6, I1-I3) ------------------------------

@query("generate_hook")
def generate_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = render_prompts(fx.prompts(spark, sf_dir))
    gen = generate_candidates(p, echo_generator, K)
    return gen.select("row_id", _long("k"), drop_chars("response", F.col("prompt_chars")).alias("response"))


@query("score_hook")
def score_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = to_long(fx.scored(spark, sf_dir), arrays=("responses",), names=("response",), keep=("prompt",))
    s = score_candidates(long, md5_scorer, reward_model_text(F.col("prompt"), F.col("response")))
    return s.select("row_id", _long("k"), "reward")


@query("generate_hook_wide")
def generate_hook_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 in wide form: responses appended to each prompt row (no join, no shuffle)."""
    p = render_prompts(fx.prompts(spark, sf_dir))
    gen = generate_wide(p, echo_generator, K)
    stripped = gen.select("row_id", F.posexplode(strip_echo_all("responses", F.col("prompt_text"))).alias("k", "response"))
    return stripped.select("row_id", _long("k"), "response")


@query("score_hook_wide")
def score_hook_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 in wide form: one vectorised scorer call per Arrow batch, rewards parallel to responses."""
    s = fx.scored(spark, sf_dir)
    texts = F.transform("responses", lambda r: reward_model_text(F.col("prompt"), r))
    scored = score_wide(s.drop("rewards"), md5_scorer, texts)
    return scored.select("row_id", F.posexplode("rewards").alias("k", "reward")).select("row_id", _long("k"), "reward")


@query("score_hook_batch")
def score_hook_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 through predict_batch_udf (model cached per Python worker, fixed batch size)."""
    long = to_long(fx.scored(spark, sf_dir), arrays=("responses",), names=("response",), keep=("prompt",))
    texts = long.withColumn("rm_text", reward_model_text(F.col("prompt"), F.col("response")))
    s = score_with_model(texts, make_md5_predict, "rm_text", batch_size=64)
    return s.select("row_id", _long("k"), "reward")


@query("jsonl_round_trip")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 (sharded JSONL write) -> S3/S1 (typed read of shards 0..3) -> U1 -> G4."""
    path = shared_dir(spark, "jsonl_round_trip", unique=True)
    sharded = shard_round_robin(fx.scored_all(spark, sf_dir), 4).drop("ordinal")
    write_sharded(sharded, path)
    back = read_shards(spark, path, 4, T.StructType([*SCORED.fields, T.StructField("shard", T.IntegerType())]))
    return to_long(back).select("row_id", _long("k"), "response", "reward")


@query("stream_pairs")
def stream_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored sets land as JSONL; Structured Streaming selects max_min pairs into a file sink."""
    from ..sources.jsonl import write_jsonl
    from ..streaming import stream_pairs

    root = shared_dir(spark, "stream_pairs", unique=True)
    write_jsonl(fx.scored(spark, sf_dir), f"{root}/landing")
    q = stream_pairs(spark, f"{root}/landing", f"{root}/pairs", "max_min", checkpoint=f"{root}/ckpt", eot_token=EOT)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/pairs")


@query("stream_loss_sigmoid")
def stream_loss_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-prob rows land as JSONL; Structured Streaming computes the sigmoid loss into a file sink."""
    from ..sources.jsonl import write_jsonl
    from ..streaming import stream_losses

    root = shared_dir(spark, "stream_losses", unique=True)
    write_jsonl(fx.logps(spark, sf_dir), f"{root}/landing")
    q = stream_losses(spark, f"{root}/landing", f"{root}/losses", "sigmoid", checkpoint=f"{root}/ckpt", beta=BETA)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/losses")
    return out.select("pair_id", "batch_id", r6("loss").alias("loss"), "chosen_reward", "rejected_reward")


@query("pairs_from_jsonl")
def pairs_from_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference-format files in, reference-format pairs out: scored sets written
    as id-less JSONL ({prompt, responses, rewards}), read back with the fixed
    schema, given row ids, and turned into {prompt, chosen, rejected, margin}."""
    from ..schemas import SCORED_JSONL
    from ..sources.jsonl import add_row_ids, read_jsonl, write_jsonl

    path = shared_dir(spark, "pairs_from_jsonl", unique=True)
    write_jsonl(fx.scored(spark, sf_dir).drop("row_id"), path)
    sets = add_row_ids(read_jsonl(spark, path, SCORED_JSONL))
    pairs = build_pairs(sets, "max_min", eot_token=EOT)
    return pairs.select("prompt", "chosen", "rejected", "margin")


def _iterations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """(pairs, folder of the run records)"""
    prompts = shard_cover(fx.prompts(spark, sf_dir), 3)
    records = shared_dir(spark, "run_records", unique=True)
    cfg = IterationConfig(k=K, choose_type="max_min", eot_token=EOT, record_path=records,
                          generator_setup=lambda i: lambda: f"iter{i} ")
    return run_iterations(spark, cfg, lambda i: prompts.filter(F.col("shard") == i - 1).drop("shard", "ordinal"),
                          lambda i: echo_generator, md5_scorer, iterations=3), records


@query("iterate3_records")
def iterate3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record lines that three iterations wrote, read back."""
    return read_records(spark, _iterations(spark, sf_dir)[1])


@query("shard_files")
def shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5/S3/U1 under the reference's file names, with late shards that are empty: the documents (L4 in 8 shards) are
    written in one job as ``base + i + ".json"`` for 12 shards and read back."""
    base = shared_dir(spark, "shard_files", unique=True) + "/docs_"
    rows = shard_cover(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), 8, key="doc_id")
    write_shard_files(rows.drop("ordinal"), base, 12)
    back = read_shard_files(spark, base, 12, "doc_id long, lang string, n_chars long")
    return back.select("doc_id", "lang", "n_chars", _long("shard"))


@query("jsonl_file_order")
def jsonl_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id-less JSONL files of very different sizes get row ids by file and line."""
    base = shared_dir(spark, "file_order", unique=True) + "/part_"
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    shard = F.when(F.col("doc_id") < 3, 0).when(F.col("doc_id") < 150, 1).when(F.col("doc_id") < 160, 2).otherwise(10)
    # ranges of (shard, id): a shard with nearly all rows is spread over many tasks and files
    rows = docs.withColumn("shard", shard).repartitionByRange("shard", "doc_id").sortWithinPartitions("shard", "doc_id")
    write_shard_files(rows, base, 11)
    scan = read_jsonl(spark, f"{base}*.json", "doc_id long")
    return add_row_ids(scan).select("doc_id", "row_id")


@query("jsonl_offsets")
def jsonl_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by file and byte offset of whole documents, in one file per 10,000 ids; texts as hexadecimal digits."""
    path = shared_dir(spark, "jsonl_offsets", unique=True)
    docs = read_table(spark, sf_dir, "documents")
    line = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"text":"'),
                    F.coalesce(F.hex(F.col("text").cast("binary")), F.lit("")), F.lit('"}'))
    docs.select(line.alias("value"), F.floor(F.col("doc_id") / 10_000).alias("shard"), "doc_id") \
        .repartition("shard").sortWithinPartitions("shard", "doc_id").select("value", "shard") \
        .write.partitionBy("shard").text(path)
    rows = read_jsonl_at(spark, f"{path}/shard=*/*.txt", "doc_id long, text string")
    shard = F.regexp_extract("file", r"shard=(\d+)/", 1).cast("long")
    return rows.select("doc_id", shard.alias("shard"), "offset", F.length("text").cast("long").alias("n_digits"))


@query("ordered_sink")
def ordered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in the order of a hash; each line's position in the concatenated files."""
    path = shared_dir(spark, "ordered_sink", unique=True)
    h = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("long")
    write_in_order(_orders(spark, sf_dir).withColumn("hash_key", h), path, ["hash_key", "o_orderkey"])
    return add_row_ids(read_jsonl(spark, path, "o_orderkey long, hash_key long"), "position").select("o_orderkey", "position")


@query("ordinal_hash_keys")
def ordinal_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 over keys that span 64 bits, with ties: a hash of the order's customer, both signs."""
    h = F.conv(F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 15), 16, 10).cast("long")
    keys = read_table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 2 == 0, h).otherwise(-h).alias("hash_key"))
    wide = keys.withColumn("hash_key", F.col("hash_key") * 8)
    return with_ordinal(wide, key="hash_key", tiebreak=["o_orderkey"])


@query("read_prompts")
def read_prompts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts written as a table, read by ``read_prompts``; contents in key order."""
    path = shared_dir(spark, "prompt_table", unique=True)
    fx.prompts(spark, sf_dir).write.parquet(path)
    p = read_prompts(spark, path)
    return in_order(p.select("row_id", F.size("context_messages").cast("long").alias("n_messages"),
                             F.aggregate("context_messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"])).alias("n_chars")))


@query("render_padded")
def render_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 and P5 where they bite: contents padded with white space of several kinds, and
    with the BOS string inside; the reward-model text of the conversation plus one reply."""
    pads = F.array(*map(F.lit, PADS))
    pad = lambda shift: F.element_at(pads, (F.pmod(F.col("conv_id") + F.col("turn") + shift, F.lit(len(PADS))) + 1).cast("int"))
    conv = read_table(spark, sf_dir, "conversations")
    content = F.concat(pad(0), F.col("text"), F.lit(DEFAULT_BOS), F.col("role"), pad(1))
    msgs = F.array_sort(F.collect_list(F.struct("turn", "role", content.alias("content"))))
    chats = conv.groupBy(F.col("conv_id").alias("row_id")).agg(msgs.alias("_m"))
    messages = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return chats.select("row_id", reward_model_text(messages, F.lit("\u2003ok\u00a0")).alias("rm_text"))


@query("pair_outcomes_broken")
def pair_outcomes_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3, C6 and A4 where they bite: NaN rewards, null rewards, a reward too many, null responses
    and short sets, by a rule on ``row_id``."""
    return pair_outcomes(_broken(fx.scored_all(spark, sf_dir)), length_penalty=LENGTH_PENALTY)


@query("score_summary_nulls")
def score_summary_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A2 with null rewards, which count neither in the sum nor in the size."""
    s = fx.scored_all(spark, sf_dir)
    first = F.when(F.col("row_id") % 5 == 1, F.lit(None)).otherwise(F.get("rewards", 0)).cast("double")
    return score_summary_op(s.withColumn("rewards", F.concat(F.array(first), F.slice("rewards", 2, 99))), K)


def _broken(s: DataFrame) -> DataFrame:
    rule = F.col("row_id") % 6
    first = F.when(rule == 1, F.lit(float("nan"))).when(rule == 2, F.lit(None).cast("double")).otherwise(F.get("rewards", 0))
    rewards = F.concat(F.array(first), F.slice("rewards", 2, 99), F.when(rule == 3, F.array(F.lit(0.0))).otherwise(F.array().cast("array<double>")))
    responses = F.when(rule == 4, F.transform("responses", lambda r: F.lit(None).cast("string"))).otherwise(F.col("responses"))
    cut = F.when(rule == 5, 1).otherwise(99)
    return s.withColumns({"rewards": F.slice(rewards, F.lit(1), cut), "responses": F.slice(responses, F.lit(1), cut)})


@query("sanity_cut")
def sanity_cut_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 where it bites: the first 100 of the orders in key order."""
    return sanity_cut(_orders(spark, sf_dir), order_by="o_orderkey")


@query("iterate3")
def iterate3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three iterations over contiguous thirds of the prompts; iteration i loads its own
    model, which shows in its texts."""
    pairs = _iterations(spark, sf_dir)[0]
    return pairs.select(F.col("iteration").cast("long").alias("iteration"), "row_id", "chosen", "rejected", "margin")
