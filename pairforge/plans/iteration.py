"""The iteration driver (I1-I3): render -> generate -> merge -> score -> pairs.

The whole iteration is row-local: prompts, their K responses and their rewards
stay in one row (wide form), so no stage shuffles.  Each stage's output is
written once to the shared folder (the cluster's checkpoint directory) and read
back, partitioned by iteration: that is the stage hand-off of the reference,
and it cuts lineage, so a lost executor recomputes from the last written
stage, and a rerun of an iteration reuses the stages that are finished --
which matters for generation, whose sampling is not repeatable.  A stage is
reused only if it was made of the same things: a digest of the configuration, the
models and the input, chained from stage to stage, is noted with it and compared.  The
scored table feeds two sinks (pairs and the run record) from one written copy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import DEFAULT_BOS, render_chat, reward_model_text_rendered
from ..functions.text import strip_echo_all
from ..operators.candidates import drop_short, render_prompts
from ..operators.hooks import generate_wide, score_wide
from ..operators.ordering import sanity_cut
from ..operators.pairs import build_pairs
from ..operators.summaries import run_record
from ..session import shared_dir
from ..sources.jsonl import content_digest, digest, stage, write_record


@dataclass(frozen=True)
class IterationConfig:
    """One configuration, one K for every stage."""

    k: int = 4
    choose_type: str = "max_min"
    margin_scale: float = 1.0
    length_penalty: float = 0.0
    eot_token: str = ""
    bos: str = DEFAULT_BOS
    max_input_length: int | None = None
    sanity_check: bool = False
    sampling: tuple[tuple[str, object], ...] = field(default_factory=tuple)
    output_dir: str | None = None
    record_path: str | None = None
    run: str = "0"  # name of the run in the records: another run appends to the same ``record_path``
    version: str = ""  # of what a digest can't see, e.g. weights behind a path; another one makes every stage anew
    partitions: int | None = None
    stage_format: str = "parquet"  # or "json": JSONL stage files, as the reference hands them on
    # model loaders, called once per Python worker; results reach the hooks as ``model=``
    # ``generator_setup(i)`` is the loader of iteration i's model, trained in i - 1
    generator_setup: Callable[[int], Callable[[], object]] | None = None
    measure: Callable[[str], int] = len  # unit of ``max_input_length``: characters, or a tokeniser's count
    scorer_setup: Callable[[], object] | None = None
    # training side: the preference loss applied to the pairs' log-prob table
    loss_type: str = "sigmoid"
    beta: float = 0.1
    label_smoothing: float = 0.0
    f_divergence: str = "reverse_kl"
    rpo_alpha: float | None = None


def run_iteration(spark: SparkSession, cfg: IterationConfig, iteration: int, prompts: DataFrame,
                  generator: Callable, scorer: Callable) -> DataFrame:
    """One iteration; returns the pairs table as written."""
    out = cfg.output_dir or shared_dir(spark, "iterations", unique=True)
    base = f"{out}/iteration={iteration}"
    rendered = render_prompts(prompts, bos=cfg.bos)
    # a model is what its loader loads; without a loader it is the hook itself
    loader = cfg.generator_setup(iteration) if cfg.generator_setup else None
    of_candidates = digest(content_digest(prompts), cfg.k, cfg.bos, cfg.max_input_length, cfg.measure, cfg.sampling, cfg.version,
                           iteration, loader or generator)
    of_scored = digest(of_candidates, cfg.scorer_setup or scorer)
    of_pairs = digest(of_scored, cfg.choose_type, cfg.margin_scale, cfg.length_penalty, cfg.eot_token, cfg.sanity_check)

    # generate K texts per prompt in the prompt's own row (G1), strip the echoed prompt
    gen = generate_wide(rendered, generator, cfg.k, partitions=cfg.partitions,
                        setup=loader,
                        limit=cfg.max_input_length, measure=cfg.measure, **dict(cfg.sampling))
    candidates = gen.select("row_id", F.col("context_messages").alias("prompt"),
                            strip_echo_all(F.col("responses"), F.col("prompt_text")).alias("responses"),
                            render_chat(F.col("context_messages"), bos=cfg.bos).alias("prompt_rendered"))
    candidates = stage(candidates, f"{base}/candidates", cfg.stage_format, of_candidates)

    # drop short sets before scoring (F1); score every (prompt, response) text of a row
    full = drop_short(candidates, cfg.k)
    # the prompt was rendered once per row in the written candidates stage
    texts = F.transform("responses", lambda r: reward_model_text_rendered(F.col("prompt_rendered"), r, cfg.bos))
    scored = stage(score_wide(full, scorer, texts, setup=cfg.scorer_setup).drop("prompt_rendered"), f"{base}/scored", cfg.stage_format, of_scored)

    if cfg.record_path:
        write_record(run_record(scored.withColumn("iteration", F.lit(iteration)))
                     .select("iteration", "mean_score", "top1_score"), cfg.record_path, iteration, cfg.run)

    pairs = build_pairs(scored, cfg.choose_type, margin_scale=cfg.margin_scale,
                        length_penalty=cfg.length_penalty, eot_token=cfg.eot_token, bos=cfg.bos)
    pairs = sanity_cut(pairs, cfg.sanity_check)
    return stage(pairs.withColumn("iteration", F.lit(iteration)), f"{base}/pairs", cfg.stage_format, of_pairs)


def run_iterations(spark: SparkSession, cfg: IterationConfig, prompt_sets: Callable[[int], DataFrame],
                   generator_for: Callable[[int], Callable], scorer: Callable,
                   iterations: int = 3) -> DataFrame:
    """Iterations 1..n, each with its own prompt set; the generator of
    iteration i is supplied by the caller (the model trained in i - 1)."""
    if cfg.output_dir is None:
        cfg = IterationConfig(**{**cfg.__dict__, "output_dir": shared_dir(spark, "iterations", unique=True)})
    result = None
    for i in range(1, iterations + 1):
        pairs = run_iteration(spark, cfg, i, prompt_sets(i), generator_for(i), scorer)
        result = pairs if result is None else result.unionByName(pairs)
    return result


def iteration_losses(cfg: IterationConfig, logps, nll=None, split: str = "train"):
    """Loss and batch metrics for one iteration's pairs, given their log-prob
    table (``pair_id, batch_id`` + the four log-probs, from the caller's model):
    returns ``(per-pair losses, batch loss, batch metrics)`` under ``cfg``'s
    loss type, beta, label smoothing, divergence and optional RPO term."""
    from ..operators import losses as LS

    losses = LS.preference_loss(logps, cfg.loss_type, beta=cfg.beta, label_smoothing=cfg.label_smoothing,
                                f_divergence=cfg.f_divergence)
    if cfg.loss_type in ("aot", "aot_pair"):
        return losses, LS.batch_loss(losses), None
    if cfg.rpo_alpha is not None and nll is not None:
        losses = LS.add_rpo(losses, nll, cfg.rpo_alpha)
    metrics = LS.batch_metrics(losses, split, nll=nll if cfg.rpo_alpha is not None else None)
    return losses, LS.batch_loss(losses), metrics
