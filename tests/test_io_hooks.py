"""JSONL sources/sinks (S1-S6), hooks (G1, G3) and the iteration driver."""

import pytest
from pyspark.sql import functions as F

from helpers import scored_rows
from pairforge.operators.hooks import generate_candidates, score_candidates
from pairforge.plans.stand_ins import echo_generator, md5_scorer
from pairforge.schemas import SCORED
from pairforge.session import shared_dir
from pairforge.sources.jsonl import read_jsonl, read_records, read_shards, write_jsonl, write_record, write_sharded


def test_jsonl_round_trip_identity(spark):
    df = scored_rows(spark, [(1, [1.0, float("nan")], ["é😀", "x"]), (2, [], []), (3, [0.5, None], None)])
    path = shared_dir(spark, "t_jsonl", unique=True)
    write_jsonl(df, path)
    back = read_jsonl(spark, path, SCORED)
    norm = lambda rows: sorted((r.row_id, str(r.rewards), r.responses) for r in rows)
    assert norm(back.collect()) == norm(df.collect())


def test_malformed_line_fails_fast(spark):
    path = shared_dir(spark, "t_bad", unique=True).replace("file:", "")
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.json", "w", encoding="utf8") as f:
        f.write('{"row_id": 1, "responses": ["a"], "rewards": [1.0]}\n{"row_id": 2, "responses": [\n')
    with pytest.raises(Exception):
        read_jsonl(spark, path, SCORED).collect()


def test_sharded_write_and_explicit_read(spark):
    df = scored_rows(spark, [(i, [1.0, 2.0], None) for i in range(10)]).withColumn("shard", (F.col("row_id") % 3).cast("int"))
    path = shared_dir(spark, "t_shards", unique=True)
    write_sharded(df, path)
    from pyspark.sql import types as T
    schema = T.StructType([*SCORED.fields, T.StructField("shard", T.IntegerType())])
    assert read_shards(spark, path, 2, schema).count() == 7  # shards 0 and 1 only
    assert read_shards(spark, path, 3, schema).count() == 10


def test_records_are_read_back_and_a_rerun_adds_none(spark):
    path = shared_dir(spark, "t_record", unique=True)
    rec = spark.createDataFrame([(1, 0.5, 1.0)], "iteration int, mean_score double, top1_score double")
    for i in (1, 2, 2):
        write_record(rec.withColumn("iteration", F.lit(i)), path, i)
    assert sorted(map(tuple, read_records(spark, path).collect())) == [(1, 0.5, 1.0), (2, 0.5, 1.0)]


def test_generate_hook(spark):
    prompts = spark.createDataFrame([(1, "abc"), (2, "x" * 50)], "row_id long, prompt_text string")
    out = generate_candidates(prompts, echo_generator, 3, limit=10).collect()
    assert sorted((r.row_id, r.k) for r in out) == [(1, 0), (1, 1), (1, 2)]
    assert all(r.response.startswith("abc") and r.prompt_chars == 3 for r in out)


def test_pandas_scorer_equals_column_scorer(spark):
    df = spark.createDataFrame([(t,) for t in ["a", "bb", "é😀", ""]], "t string")
    a = score_candidates(df, md5_scorer, "t").orderBy("t").collect()

    def col_scorer(c):
        h = F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("long")
        return (h % 41).cast("double") / 8.0 - 2.5

    b = score_candidates(df, col_scorer, "t", kind="column").orderBy("t").collect()
    assert [r.reward for r in a] == [r.reward for r in b]


def test_iterations(spark):
    from pairforge.plans.iteration import IterationConfig, run_iterations
    prompts = spark.createDataFrame([(i, [("user", f"q{i}")]) for i in range(6)],
                                    "row_id long, context_messages array<struct<role:string,content:string>>")
    record = shared_dir(spark, "t_iter_record", unique=True)
    cfg = IterationConfig(k=4, choose_type="max_min", record_path=record)
    pairs = run_iterations(spark, cfg, lambda i: prompts.filter(F.col("row_id") % 3 == i - 1),
                           lambda i: (lambda ps, k, **kw: echo_generator(ps, k, tag=f"it{i} ", **kw)),
                           md5_scorer, iterations=3)
    rows = pairs.collect()
    assert {r.iteration for r in rows} <= {1, 2, 3}
    assert all(f"it{r.iteration} " in r.chosen for r in rows)
    assert read_records(spark, record).count() == 3


def test_generate_wide_with_setup(spark):
    from pairforge.operators.hooks import generate_wide
    prompts = spark.createDataFrame([(1, "ab", 7), (2, "c", 8)], "row_id long, prompt_text string, extra int")

    def gen(ps, k, model=None, **_):
        return [[f"{model}:{p}:{i}" for i in range(k)] for p in ps]

    out = {r.row_id: r for r in generate_wide(prompts, gen, 2, setup=lambda: "M").collect()}
    assert out[1].responses == ["M:ab:0", "M:ab:1"] and out[2].extra == 8


def test_predict_batch_scorer(spark):
    from pairforge.operators.hooks import score_with_model
    from pairforge.plans.stand_ins import make_md5_predict
    df = spark.createDataFrame([(t,) for t in ["a", "bb", "é😀"]], "t string")
    a = sorted((r.t, r.reward) for r in score_with_model(df, make_md5_predict, "t", batch_size=2).collect())
    b = sorted((r.t, r.reward) for r in score_candidates(df, md5_scorer, "t").collect())
    assert a == b


def test_score_wide_handles_empty_and_null(spark):
    from pairforge.operators.hooks import score_wide
    df = spark.createDataFrame([(1, ["a", "bb"]), (2, []), (3, None), (4, ["é😀"])], "row_id long, t array<string>")
    got = {r.row_id: r.rewards for r in score_wide(df, md5_scorer, F.col("t")).collect()}
    exp = {1: list(md5_scorer(__import__("pandas").Series(["a", "bb"]))), 2: [], 3: None,
           4: list(md5_scorer(__import__("pandas").Series(["é😀"])))}
    assert got == exp


def test_read_prompts_parquet_and_table(spark):
    from pairforge.sources.tables import read_prompts
    df = spark.createDataFrame([(1, [("user", "q")])], "row_id long, msgs array<struct<role:string,content:string>>")
    path = shared_dir(spark, "t_prompts", unique=True)
    df.write.parquet(path)
    got = read_prompts(spark, path, key="msgs").collect()
    assert got[0].row_id == 1 and got[0].context_messages[0].content == "q"
    df.createOrReplaceTempView("t_prompt_view")
    assert read_prompts(spark, "t_prompt_view", key="msgs", fmt="table").count() == 1


def test_iteration_with_jsonl_stages(spark):
    from pairforge.plans.iteration import IterationConfig, run_iteration
    prompts = spark.createDataFrame([(i, [("user", f"q{i}")]) for i in range(5)],
                                    "row_id long, context_messages array<struct<role:string,content:string>>")
    out = shared_dir(spark, "t_iter_json", unique=True)
    cfg = IterationConfig(k=4, stage_format="json", output_dir=out)
    pairs = run_iteration(spark, cfg, 1, prompts, echo_generator, md5_scorer)
    cfg_p = IterationConfig(k=4, output_dir=shared_dir(spark, "t_iter_pq", unique=True))
    pq = run_iteration(spark, cfg_p, 1, prompts, echo_generator, md5_scorer)
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, pq.collect()))
    assert spark.read.json(f"{out}/iteration=1/scored").count() == 5


def test_iteration_losses_uses_config(spark):
    from helpers import logps_rows
    from pairforge.plans.iteration import IterationConfig, iteration_losses
    df = logps_rows(spark, [(i, i // 2, -1.0 - i, -2.0, -1.5, -1.5) for i in range(6)])
    losses, batch, metrics = iteration_losses(IterationConfig(loss_type="hinge", beta=0.5), df)
    assert losses.count() == 6 and batch.count() == 3
    assert metrics.filter("metric = 'rewards/accuracies'").count() == 3


def test_reference_format_jsonl_to_pairs(spark):
    import os

    from pairforge.operators.pairs import build_pairs
    from pairforge.schemas import SCORED_JSONL
    from pairforge.sources.jsonl import add_row_ids
    path = shared_dir(spark, "t_ref_jsonl", unique=True).replace("file:", "")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/data.jsonl", "w", encoding="utf8") as f:
        f.write('{"prompt": [{"role": "user", "content": "hi"}], "responses": ["a", "bb", "c"], "rewards": [0.5, 2.0, -1.0]}\n')
        f.write('{"prompt": [{"role": "user", "content": "yo"}], "responses": ["x", "y"], "rewards": [1.0, 1.0]}\n')
    sets = add_row_ids(read_jsonl(spark, path, SCORED_JSONL))
    pairs = build_pairs(sets, "max_min").collect()
    assert [(p.chosen, p.rejected, p.margin) for p in pairs] == [("bb", "c", 3.0)]
    assert sets.select("row_id").distinct().count() == 2


def test_score_wide_with_setup(spark):
    from pairforge.operators.hooks import score_wide
    df = spark.createDataFrame([(1, ["a", "bb"])], "row_id long, t array<string>")

    def scorer(texts, model=None):
        return texts.map(lambda t: model * len(t))

    got = score_wide(df, scorer, F.col("t"), setup=lambda: 2.0).first().rewards
    assert got == [2.0, 4.0]


def test_iteration_passes_scorer_model(spark):
    from pairforge.plans.iteration import IterationConfig, run_iteration
    prompts = spark.createDataFrame([(i, [("user", f"q{i}")]) for i in range(3)],
                                    "row_id long, context_messages array<struct<role:string,content:string>>")

    def scorer(texts, model=None):  # responses differ only in their index digit
        return texts.map(lambda t: model * (sum(map(ord, t)) % 11))

    cfg = IterationConfig(k=4, scorer_setup=lambda: 0.5, output_dir=shared_dir(spark, "t_iter_model", unique=True))
    pairs = run_iteration(spark, cfg, 1, prompts, echo_generator, scorer).collect()
    assert pairs and all(p.margin % 0.5 == 0 for p in pairs)
