"""Token-level reductions over a token table.

Token table: one row per ``(seq_id, pos)`` with ``label int`` (-100 = masked)
and either ``logits array<double>`` or a precomputed ``token_logp double`` (a
real vocabulary is too wide to store per token).  The label shift is an
equi-join on the unique ``(seq_id, pos)`` key and every per-sequence or
per-batch sum is a partial aggregation, so no sequence is gathered into one
task; packing offsets across sequences come from one scan over sorted ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ints import idiv
from ..functions.stats import log_softmax_at
from ..functions.text import token_ids, whitespace_pieces
from ..schemas import LABEL_PAD
from .ordering import range_scan, required


def shift_labels(tokens: DataFrame, seq: str = "seq_id", pos: str = "pos", label: str = "label",
                 out: str = "target") -> DataFrame:
    """Logits at ``pos`` predict the label at ``pos + 1``; the last position drops.
    (Not applied for encoder-decoder models: use ``target = label``.)

    An equi-join on the unique ``(seq_id, pos)`` key with the label column moved
    one position back -- not a window over ``seq_id``, which would put a whole
    sequence (however long) into one sort; the join's hash spreads every token.
    Positions are dense from 0 within a sequence.
    """
    nxt = tokens.select(seq, (F.col(pos) - 1).cast(tokens.schema[pos].dataType).alias(pos), F.col(label).alias(out))
    return tokens.join(nxt, [seq, pos], "inner")


def token_logp(target: Column, logits: Column, pad: int = LABEL_PAD, row_max: Column | None = None) -> Column:
    """T2 + T4 per token: log-softmax(logits)[target], 0 where target is the pad.
    A null label, or one outside the vocabulary, fails the query."""
    bad = target.isNull() | ((target != F.lit(pad)) & ((target < 0) | (target >= F.size(logits))))
    target = F.when(bad, F.raise_error(F.lit("a label is outside the vocabulary"))).otherwise(target)
    masked = target == F.lit(pad)
    idx = F.when(masked, F.lit(0)).otherwise(target)
    return F.when(masked, F.lit(0.0)).otherwise(log_softmax_at(logits, idx, row_max))


def _per_token(tokens: DataFrame, shift: bool, pad: int) -> DataFrame:
    if "token_logp" in tokens.columns:
        t = shift_labels(tokens) if shift else tokens.withColumn("target", F.col("label"))
        target = required("target", "a label")
        lp = F.when(target == F.lit(pad), F.lit(0.0)).otherwise(F.col("token_logp"))
        return t.withColumn("_lp", lp)
    if shift:
        # the row max is computed below the shift join, so the exp-sum fold reads a column
        t = shift_labels(tokens.withColumn("_lmax", F.array_max("logits")))
        return t.withColumn("_lp", token_logp(F.col("target"), F.col("logits"), pad, F.col("_lmax"))).drop("_lmax")
    t = tokens.withColumn("target", F.col("label"))
    return t.withColumn("_lp", token_logp(F.col("target"), F.col("logits"), pad))


def sequence_logps(tokens: DataFrame, shift: bool = True, average: bool = False,
                   pad: int = LABEL_PAD, seq: str = "seq_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """T2 (sum of label log-probs and count of unmasked labels per sequence), T3 with ``average``.

    The per-token log-prob is row-local; the sum per sequence is a partial
    (map-side) aggregation, so a long sequence is pre-summed in every task.
    """
    t = _per_token(tokens, shift, pad)
    out = t.groupBy(seq, *keep).agg(
        F.sum("_lp").alias("logps"),
        F.count_if(F.col("target") != F.lit(pad)).cast("long").alias("n_tokens"),
    )
    if average:
        out = out.withColumn("logps", F.try_divide(F.col("logps"), F.col("n_tokens")))
    return out


def to_chunks(tokens: DataFrame, chunk: int = 128, seq: str = "seq_id", pos: str = "pos", label: str = "label",
              logits: str = "logits", keep: tuple[str, ...] = ()) -> DataFrame:
    """Token rows -> the array layout: one row per ``chunk`` positions of a sequence, ``seq_id, chunk, labels, logits,
    next_label``.  ``next_label`` is the first label of the sequence's next chunk (null at the end), so the label shift (T1)
    needs nothing from other rows.  A group holds at most ``chunk`` positions; the join carries one label per chunk.
    """
    number = idiv(F.col(pos), int(chunk))
    cells = F.array_sort(F.collect_list(F.struct(pos, label, logits)))
    rows = tokens.groupBy(seq, *keep, number.alias("chunk")).agg(cells.alias("_c")).select(
        seq, *keep, "chunk", F.col(f"_c.{label}").alias("labels"), F.col(f"_c.{logits}").alias("logits"))
    first = tokens.where(F.pmod(F.col(pos), F.lit(int(chunk))) == 0).select(seq, (number - 1).alias("chunk"), F.col(label).alias("next_label"))
    return rows.join(first, [seq, "chunk"], "left")


def chunk_logps(chunks: DataFrame, shift: bool = True, average: bool = False, pad: int = LABEL_PAD,
                seq: str = "seq_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """T1-T3 over the array layout: the shift, the log-softmax and the masked sum of a chunk are row-local, the logits
    cross no exchange, and the chunks' sums meet in a partial aggregation."""
    following = F.when(F.col("next_label").isNotNull(), F.array("next_label")).otherwise(F.slice("labels", 1, 0))
    targets = F.concat(F.slice("labels", 2, F.greatest(F.size("labels"), F.lit(1))), following) if shift else F.col("labels")
    # the last position of a sequence has no target
    taken = F.slice("logits", F.lit(1), F.size("_targets"))
    rows = chunks.withColumn("_targets", targets)
    cells = F.arrays_zip(F.col("_targets").alias("t"), taken.alias("g"))
    one = lambda c: F.struct(token_logp(c["t"], c["g"], pad).alias("lp"), (c["t"] != F.lit(pad)).cast("long").alias("n"))
    zero = F.struct(F.lit(0.0).alias("lp"), F.lit(0).cast("long").alias("n"))
    added = F.aggregate(F.transform(cells, one), zero, lambda a, x: F.struct((a["lp"] + x["lp"]).alias("lp"), (a["n"] + x["n"]).alias("n")))
    out = rows.select(seq, *keep, added.alias("_s")).groupBy(seq, *keep).agg(
        F.sum("_s.lp").alias("logps"), F.sum("_s.n").alias("n_tokens"))
    if average:
        out = out.withColumn("logps", F.try_divide(F.col("logps"), F.col("n_tokens")))
    return out


def batch_nll(tokens: DataFrame, pad: int = LABEL_PAD, batch: str = "batch_id",
              side: str = "side", shift: bool = True) -> DataFrame:
    """T5: cross-entropy over the chosen half, averaged per token over the whole batch; NaN for a batch
    whose labels are all masked (the mean of nothing)."""
    t = _per_token(tokens.filter(F.col(side) == "chosen"), shift, pad)
    mean = F.try_divide(-F.sum("_lp"), F.count_if(F.col("target") != F.lit(pad)))
    return t.groupBy(batch).agg(mean.alias("nll_loss")).withColumn(
        "nll_loss", F.coalesce("nll_loss", F.lit(float("nan"))))


def logits_sums(tokens: DataFrame, batch: str = "batch_id", side: str = "side") -> DataFrame:
    """Per batch: sum and count of all logits (every position and vocabulary entry,
    padding included) for each side, for the ``logits/*`` metrics (A6)."""
    s = F.aggregate("logits", F.lit(0.0), lambda acc, x: acc + x)
    n = F.size("logits").cast("long")
    ch = F.col(side) == "chosen"
    return tokens.groupBy(batch).agg(
        F.sum(F.when(ch, s)).alias("logits_sum_chosen"),
        F.sum(F.when(ch, n)).alias("logits_n_chosen"),
        F.sum(F.when(~ch, s)).alias("logits_sum_rejected"),
        F.sum(F.when(~ch, n)).alias("logits_n_rejected"),
    )


def stack_split(chosen: DataFrame, rejected: DataFrame, pad: int = LABEL_PAD,
                pair: str = "pair_id", shift: bool = True, average: bool = False) -> DataFrame:
    """Both halves through one pass (union with a ``side`` tag), token log-probs summed
    straight to the pair by conditional sums.  A pair has one sequence per side."""
    both = chosen.withColumn("side", F.lit("chosen")).unionByName(rejected.withColumn("side", F.lit("rejected")))
    t = _per_token(both, shift, pad)
    counted = F.col("target") != F.lit(pad)
    of = lambda side, v: F.sum(F.when(F.col("side") == side, v))
    out = t.groupBy(pair).agg(
        of("chosen", F.col("_lp")).alias("chosen_logps"), of("rejected", F.col("_lp")).alias("rejected_logps"),
        of("chosen", counted.cast("long")).alias("chosen_tokens"), of("rejected", counted.cast("long")).alias("rejected_tokens"))
    if average:
        out = out.withColumns({f"{s}_logps": F.try_divide(F.col(f"{s}_logps"), F.col(f"{s}_tokens")) for s in ("chosen", "rejected")})
    return out


def check_shapes(labels: DataFrame, logits: DataFrame, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """Logits and labels must cover the same positions, and every unmasked
    label must index into its logits; otherwise the query fails."""
    j = labels.join(logits, [seq, pos], "full_outer")
    bad_pos = F.col("label").isNull() | F.col("logits").isNull()
    bad_idx = (F.col("label") != F.lit(LABEL_PAD)) & ((F.col("label") < 0) | (F.col("label") >= F.size("logits")))
    return j.withColumn(
        "label",
        F.when(bad_pos, F.raise_error(F.lit("a position has a label without logits, or logits without a label")))
        .when(bad_idx, F.raise_error(F.lit("label outside the logits range")))
        .otherwise(F.col("label")),
    )


def trim_logits(logits: DataFrame, labels: DataFrame, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """When a sequence has more logit positions than labels, keep the last
    ``n_labels`` logit positions and renumber them onto the label positions.
    Positions are dense from 0 within a sequence.  Both sides are counted in one
    pre-aggregated grouping."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = labels.select(seq, one.alias("_nl"), none.alias("_ng")).unionByName(logits.select(seq, none.alias("_nl"), one.alias("_ng")))
    counts = both.groupBy(seq).agg(F.sum("_nl").alias("_nl"), F.sum("_ng").alias("_ng")).where("_nl > 0")
    skip = F.greatest(F.col("_ng") - F.col("_nl"), F.lit(0))
    return logits.join(counts.select(seq, skip.alias("_skip")), seq, "inner") \
        .filter(F.col(pos) >= F.col("_skip")) \
        .withColumn(pos, (F.col(pos) - F.col("_skip")).cast("int")).drop("_skip")


def align_to_labels(logits: DataFrame, labels: DataFrame, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """T7, joined: every label with the logits of its position."""
    return labels.join(trim_logits(logits, labels, seq, pos), [seq, pos], "inner")


def text_token_counts(text: Column | str = "text") -> Column:
    """Number of default-tokeniser tokens of a text: pieces are counted, no id is computed."""
    return F.size(whitespace_pieces(text)).cast("long")


def _spans(scanned: DataFrame, seq_len: int, n_tokens: str) -> DataFrame:
    """One row per (sequence, block that it reaches) of rows with ``n_tokens`` and ``n_tokens_before``: adds ``block_id,
    start_in_block, offset_in_seq``, and ``n_tokens`` becomes that of the span."""
    if seq_len <= 0:
        raise ValueError("seq_len must be positive")
    L = F.lit(int(seq_len))
    start = F.col(n_tokens + "_before")
    end = start + F.col(n_tokens)
    spans = scanned.filter(F.col(n_tokens) > 0).select("*", F.explode(F.sequence(idiv(start, L), idiv(end - 1, L))).alias("block_id"))
    lo = F.greatest(start, F.col("block_id") * L)
    hi = F.least(end, (F.col("block_id") + 1) * L)
    return spans.withColumns({"start_in_block": lo - F.col("block_id") * L, "offset_in_seq": lo - start, "_span": hi - lo}) \
        .drop(n_tokens, n_tokens + "_before").withColumnRenamed("_span", n_tokens)


def _scanned(df: DataFrame, key: str, n_tokens: str, tie: str) -> DataFrame:
    """Rows with the tokens before them in ``key`` order; a null key is an error, a null count is none."""
    counted = df.withColumns({key: required(key, f"the order key {key}"), n_tokens: F.coalesce(F.col(n_tokens).cast("long"), F.lit(0).cast("long"))})
    return range_scan(counted, [key, tie], sums=[n_tokens])


def pack_spans(df: DataFrame, seq_len: int, key: str = "doc_id", n_tokens: str = "n_tokens") -> DataFrame:
    """Concatenate token streams in ``key`` order and cut them into blocks of
    ``seq_len`` tokens.  Returns one row per (block, piece of a sequence):
    ``block_id, key, start_in_block, offset_in_seq, n_tokens`` -- a sequence over a block
    edge is split.  Offsets come from one scan over sorted ranges (``range_scan``); the split is
    a row-local ``sequence`` + ``explode``.  Rows that share a key are sequences of their own, the shorter first; any
    64-bit key works, and a null key fails the query.
    """
    scanned = _scanned(df.select(key, n_tokens), key, n_tokens, n_tokens)
    return _spans(scanned, seq_len, n_tokens).select("block_id", key, "start_in_block", "offset_in_seq", n_tokens)


def pack_tokens(df: DataFrame, seq_len: int, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """T8 with content: ``block_id, tokens array``.

    Tokens travel with their row through the scan, so a key that repeats is no harm (rows of one key stand in the order
    of their tokens); each span takes its slice; the slices are gathered per block (at most ``seq_len`` tokens, a
    bounded group) and laid out by ``start_in_block``.
    """
    counted = df.select(key, tokens, F.size(tokens).alias("n_tokens"))
    spans = _spans(_scanned(counted, key, "n_tokens", tokens), seq_len, "n_tokens")
    pieces = spans.select("block_id", "start_in_block", F.slice(
        F.col(tokens), (F.col("offset_in_seq") + 1).cast("int"), F.col("n_tokens").cast("int")).alias("_piece"))
    gathered = pieces.groupBy("block_id").agg(
        F.array_sort(F.collect_list(F.struct("start_in_block", "_piece"))).alias("_p"))
    return gathered.select("block_id", F.flatten(F.transform("_p", lambda x: x["_piece"])).alias(tokens))


def truncate_pair(prompt: Column, chosen: Column, rejected: Column, max_length: int,
                  max_prompt_length: int, mode: str = "keep_end") -> tuple[Column, Column, Column]:
    """T9 on token arrays: if prompt + the longer response exceed ``max_length``,
    cut the prompt to ``max_prompt_length`` (its end with ``keep_end``, its start
    with ``keep_start``); if still too long, cut each response to
    ``max_length - max_prompt_length`` tokens."""
    if mode not in ("keep_end", "keep_start"):
        raise ValueError(f"unknown truncation mode {mode!r}")
    mpl = int(max_prompt_length)
    longer = F.greatest(F.size(chosen), F.size(rejected))
    too_long = F.size(prompt) + longer > F.lit(max_length)
    if mode == "keep_end":
        cut = F.when(F.size(prompt) > mpl, F.slice(prompt, -mpl, mpl)).otherwise(prompt)
    else:
        cut = F.slice(prompt, 1, mpl)
    p = F.when(too_long, cut).otherwise(prompt)
    still = F.size(p) + longer > F.lit(max_length)
    keep = max(int(max_length) - mpl, 0)
    c = F.when(still, F.slice(chosen, 1, keep)).otherwise(chosen)
    r = F.when(still, F.slice(rejected, 1, keep)).otherwise(rejected)
    return p, c, r


def role_mask(messages: DataFrame, output_roles: tuple[str, ...] = ("assistant",),
              key: str = "row_id", turn: str = "turn", role: str = "role", content: str = "content",
              tokens: str | None = None) -> DataFrame:
    """Explode each message to its tokens; a token keeps its id as label only
    when its message role is an output role (``train_on_inputs: false``), else -100.
    ``tokens`` names a column of token ids (``hooks.tokenise``); without it the default pieces count."""
    ids = F.col(tokens) if tokens else token_ids(F.col(content))
    toks = messages.select(key, turn, role, F.posexplode(ids).alias("tok_idx", "token_id"))
    label = F.when(F.col(role).isin(*output_roles), F.col("token_id")).otherwise(F.lit(LABEL_PAD).cast("long"))
    return toks.withColumn("label", label)
