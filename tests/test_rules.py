"""Rules for nulls, missing rows, uneven sets, models, shards and shared folders."""

import pytest
from pyspark.sql import functions as F

from helpers import logps_rows, scored_rows
from pairforge.functions.chat import render_chat, render_long
from pairforge.operators import losses as LS
from pairforge.operators import tokens as TK
from pairforge.operators.hooks import generate_candidates, generate_wide
from pairforge.operators.ordering import sanity_cut, shard_cover, with_ordinal
from pairforge.operators.pairs import build_eval_pairs, build_pairs, pair_outcomes
from pairforge.operators.summaries import run_record
from pairforge.session import shared_dir
from pairforge.sources.jsonl import add_row_ids, read_jsonl, read_shard_files, read_shards, write_shard_files, write_sharded


def keyed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "row_id long")


def test_null_keys_are_an_error_and_any_long_is_a_key(spark):
    with pytest.raises(Exception, match="must not be null"):
        with_ordinal(keyed(spark, [1, None, 3])).collect()
    keys = [-(2**63), 2**63 - 1, 0, -1, 5]
    got = {r.row_id: r.ordinal for r in with_ordinal(keyed(spark, keys)).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    assert with_ordinal(keyed(spark, [])).count() == 0


@pytest.mark.parametrize("loss", LS.LOSS_TYPES)
def test_null_log_probs_are_an_error_in_every_loss(spark, loss):
    df = logps_rows(spark, [(1, 0, None, -1.0, -1.0, -1.0), (2, 0, -1.0, -2.0, -1.0, -1.0)])
    with pytest.raises(Exception, match="must not be null"):
        LS.preference_loss(df, loss).collect()


@pytest.mark.parametrize("loss", ["bco_pair", "aot", "aot_pair"])
def test_null_batch_is_an_error(spark, loss):
    df = logps_rows(spark, [(1, None, -1.0, -1.0, -1.0, -1.0), (2, 0, -1.0, -2.0, -1.0, -1.0)])
    with pytest.raises(Exception, match="must not be null"):
        LS.preference_loss(df, loss).collect()


def test_null_in_null_out(spark):
    from pairforge.functions.stats import cap_exp, log_sigmoid, relu, softplus
    row = spark.createDataFrame([(None,)], "x double").select(*[f(F.col("x")).alias(f.__name__) for f in (relu, cap_exp, log_sigmoid, softplus)]).first()
    assert list(row) == [None] * 4


def test_alpha_zero_is_refused(spark):
    with pytest.raises(ValueError, match="alpha"):
        LS.preference_loss(logps_rows(spark, []), "sigmoid", f_divergence="alpha_divergence", alpha=0.0)


def test_missing_reference_nll_and_logits_are_errors(spark):
    df = logps_rows(spark, [(1, 0, -1.0, -1.0, -1.0, -1.0), (2, 1, -1.0, -2.0, -1.0, -1.0)])
    policy = df.select("pair_id", "batch_id", LS.PC, LS.PR)
    with pytest.raises(Exception, match="must not be null"):
        LS.with_reference(policy, df.where("pair_id = 1")).collect()
    losses = LS.preference_loss(df, "sigmoid")
    nll = spark.createDataFrame([(0, 0.5)], "batch_id long, nll_loss double")
    with pytest.raises(Exception, match="must not be null"):
        LS.add_rpo(losses, nll, 1.0).collect()
    with pytest.raises(Exception, match="must not be null"):
        LS.batch_metrics(losses, nll=nll).collect()


def test_metrics_by_a_split_column(spark):
    df = logps_rows(spark, [(i, i // 4, -1.0 - i, -2.0, -1.5, -1.5) for i in range(8)])
    losses = LS.preference_loss(df, "sigmoid")
    both = LS.batch_metrics(losses, F.when(F.col("pair_id") % 2 == 0, F.lit("eval")).otherwise(F.lit("train")))
    got = sorted(map(tuple, both.collect()))
    want = sorted([*map(tuple, LS.batch_metrics(losses.where("pair_id % 2 = 0"), "eval").collect()),
                   *map(tuple, LS.batch_metrics(losses.where("pair_id % 2 = 1"), "train").collect())])
    assert got == want and any(m.startswith("eval_") for _, _, m, _ in got)


def test_null_content_is_an_error_in_both_renderers(spark):
    long = spark.createDataFrame([(1, 0, "user", None), (1, 1, "user", "a")], "row_id long, turn int, role string, content string")
    with pytest.raises(Exception, match="without content"):
        render_long(long).collect()
    wide = spark.createDataFrame([(1, [("user", None)])], "row_id long, m array<struct<role:string,content:string>>")
    with pytest.raises(Exception, match="without content"):
        wide.select(render_chat("m")).collect()


def test_uneven_sets_emit_nothing_and_are_counted(spark):
    df = scored_rows(spark, [(1, [1.0, 2.0, 3.0], ["a", "b"]), (2, [1.0, 2.0], ["a", None]), (3, [1.0, 2.0], ["a", "b"]), (4, [1.0], ["a"])])
    assert [r.row_id for r in build_pairs(df, "max_min").collect()] == [3]
    got = {(r.strategy, r.outcome): r.n for r in pair_outcomes(df).collect()}
    assert all(got[s, "uneven"] == 2 and got[s, "kept"] == 1 and got[s, "short"] == 1 for s in ("random", "max_min", "max_max", "max_min_p"))


def test_null_rewards_leave_sum_and_size(spark):
    df = scored_rows(spark, [(1, [1.0, None], None), (2, [2.0, 2.0], None)]).withColumn("iteration", F.lit(1))
    r = run_record(df).first()
    assert abs(r.mean_score - 5 / 3) < 1e-12 and r.top1_score == 1.5


def test_labels_outside_the_vocabulary_are_an_error(spark):
    t = spark.createDataFrame([(1, 0, -100, [0.0, 1.0]), (1, 1, 5, [0.0, 1.0])], "seq_id long, pos int, label int, logits array<double>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        TK.sequence_logps(t).collect()
    short = spark.createDataFrame([(1, 0, [0.0, 1.0])], "seq_id long, pos int, logits array<double>")
    with pytest.raises(Exception, match="label without logits"):
        TK.check_shapes(t.select("seq_id", "pos", "label"), short).collect()


def test_token_counts_equal_the_ids(spark):
    df = spark.createDataFrame([("a b  c\n",), ("",), (" x ",)], "text string")
    from pairforge.functions.text import token_ids
    assert all(r[0] == r[1] for r in df.select(TK.text_token_counts("text"), F.size(token_ids("text"))).collect())


def test_a_generator_must_return_a_list_for_every_prompt(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "b")], "row_id long, prompt_text string").coalesce(1)
    for run in (generate_candidates, generate_wide):
        with pytest.raises(Exception, match="2 prompts and returned 1 lists"):
            run(prompts, lambda ps, k: [["x"] * k], 2).collect()


def test_limit_holds_for_a_generator_that_ignores_it(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "b c d e")], "row_id long, prompt_text string")
    plain = lambda ps, k: [[p] * k for p in ps]
    got = {r.row_id: r.responses for r in generate_wide(prompts, plain, 2, limit=3).collect()}
    assert got == {1: ["a", "a"], 2: []}
    by_words = generate_wide(prompts, plain, 2, limit=4, measure=lambda p: len(p.split())).collect()
    assert all(len(r.responses) == 2 for r in by_words)


def test_loaders_of_one_factory_are_told_apart(spark):
    prompts = spark.createDataFrame([(1, "p")], "row_id long, prompt_text string").coalesce(1)

    def factory(i):
        return lambda: f"model{i}"

    def gen(ps, k, model):
        return [[model] * k for _ in ps]

    got = [generate_wide(prompts, gen, 1, setup=factory(i)).first().responses for i in (1, 2, 3)]
    assert got == [["model1"], ["model2"], ["model3"]]


def test_iterations_load_their_models_and_reuse_finished_stages(spark):
    from pairforge.plans.iteration import IterationConfig, run_iterations
    from pairforge.plans.stand_ins import echo_generator, md5_scorer
    from pairforge.sources.jsonl import read_records

    prompts = spark.createDataFrame([(i, [("user", f"q{i}")]) for i in range(6)], "row_id long, context_messages array<struct<role:string,content:string>>")
    out, record = shared_dir(spark, "t_rules_iter", unique=True), shared_dir(spark, "t_rules_rec", unique=True)
    cfg = IterationConfig(k=4, record_path=record, output_dir=out, generator_setup=lambda i: lambda: f"it{i} ")
    run = lambda: sorted(map(tuple, run_iterations(spark, cfg, lambda i: prompts, lambda i: echo_generator, md5_scorer, 2).collect()))
    first = run()
    assert first and all(f"it{r[-1]} " in r[2] for r in first)

    def boom(ps, k, **kw):
        raise RuntimeError("generated again")

    again = sorted(map(tuple, run_iterations(spark, cfg, lambda i: prompts, lambda i: boom, md5_scorer, 2).collect()))
    assert again == first and read_records(spark, record).count() == 2


def test_empty_late_shards(spark):
    path = shared_dir(spark, "t_rules_shards", unique=True)
    write_sharded(shard_cover(keyed(spark, range(8)), 8).drop("ordinal"), path)
    assert read_shards(spark, path, 8, "row_id long, shard int").count() == 8
    base = shared_dir(spark, "t_rules_files", unique=True) + "/gen.v1_"
    rows = shard_cover(keyed(spark, range(8)), 3).drop("ordinal").withColumn("shard", F.col("shard") * 5)
    write_shard_files(rows, base, 12)
    back = read_shard_files(spark, base, 11, "row_id long").collect()
    assert sorted((r.row_id, r.shard) for r in back) == [(i, i // 3 * 5) for i in range(8)]
    assert {r.shard for r in read_shard_files(spark, base, 10, "row_id long").collect()} == {0, 5}


def test_row_ids_follow_files_and_lines(spark):
    base = shared_dir(spark, "t_rules_order", unique=True).replace("file:", "")
    import os
    os.makedirs(base)
    n = 0
    for name, lines in (("f1", 3), ("f2", 300), ("f10", 30)):
        with open(f"{base}/{name}.json", "w", encoding="utf8") as f:
            for _ in range(lines):
                f.write(f'{{"n": {n}, "pad": "{"x" * 50}"}}\n')
                n += 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = add_row_ids(read_jsonl(spark, base, "n long, pad string")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 333 and all(r.n == r.row_id for r in rows)


def test_cuts_are_parameters(spark):
    df = scored_rows(spark, [(i, [1.0, 2.0], None) for i in range(130)])
    assert build_eval_pairs(df).count() == 100 and build_eval_pairs(df, limit=None).count() == 130
    assert sanity_cut(df).count() == 100 and sanity_cut(df, rows=7).count() == 7 and sanity_cut(df, rows=0).count() == 130


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d)))


def oracle_rows(name, path):
    import duckdb

    from pairforge.plans.oracle import SQL
    con = duckdb.connect()
    for table in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/{table}.parquet/*.parquet')")
    return con.execute(SQL[name]).fetchall()


@pytest.mark.parametrize("name", ["loss_rpo", "batch_metrics"])
@pytest.mark.parametrize("positions", [82, 84, 104, 111])
def test_a_token_table_that_ends_inside_a_pair(spark, tmp_path, name, positions):
    """The last pair has no rejected half: its row stays, as in the SQL, and fails nothing."""
    from pairforge.plans.catalog import QUERIES
    spark.range(64).selectExpr("id AS event_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.range(positions).selectExpr("id AS vec_id", "CAST(id % 4 AS INT) AS label", "transform(sequence(0, 3), x -> CAST((id * 7 + x * 3) % 5 AS FLOAT)) AS embedding") \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(str, map(tuple, QUERIES[name](spark, str(tmp_path)).collect())))
    assert got == sorted(map(str, oracle_rows(name, tmp_path))) and (name != "loss_rpo" or any("None" in r for r in got))


def test_whole_pairs_still_need_every_log_prob(spark):
    df = logps_rows(spark, [(1, 0, -1.0, None, -1.0, -1.0), (2, 0, -1.0, -2.0, -1.0, -1.0)])
    got = {r.pair_id: r.loss for r in LS.preference_loss(df, "sigmoid", whole=F.col("pair_id") == 2).collect()}
    assert got[1] is None and got[2] is not None
    with pytest.raises(Exception, match="must not be null"):
        LS.preference_loss(df, "sigmoid", whole=F.col("pair_id") > 0).collect()
    with pytest.raises(ValueError, match="both halves"):
        LS.preference_loss(df, "bco_pair", whole=F.col("pair_id") == 2)
