"""Packing over any keys, stage manifests, shard files in one job, ordered sinks, the tokeniser hook, the array layout."""

import random

import pytest
from pyspark.sql import functions as F

from pairforge.operators import losses as LS
from pairforge.operators import tokens as TK
from pairforge.operators import hooks
from pairforge.operators.hooks import tokenise
from pairforge.plans.iteration import IterationConfig, run_iteration
from pairforge.plans.stand_ins import echo_generator, md5_scorer, trigram_tokeniser
from pairforge.session import shared_dir
from pairforge.sources import jsonl

PROMPTS = "row_id long, context_messages array<struct<role:string,content:string>>"


def plain_blocks(rows, seq_len):
    flat = [t for _, tokens in sorted(rows) for t in tokens]
    return {i // seq_len: flat[i:i + seq_len] for i in range(0, len(flat), seq_len)}


def test_packing_over_repeated_and_64_bit_keys(spark):
    rng = random.Random(2)
    keys = [-(1 << 63), (1 << 63) - 1, 0, 0, 0, 1, 1] + [rng.randrange(-(1 << 63), 1 << 63) for _ in range(60)]
    rows = [(k, [rng.randrange(9) for _ in range(rng.randrange(12))]) for k in keys] + [(1, [1, 2]), (1, [3, 4, 5])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<long>").repartition(5)
    got = {r.block_id: r.tokens for r in TK.pack_tokens(df, 4).collect()}
    assert got == plain_blocks(rows, 4)
    # spans of one sequence are those of its own tokens, though its key repeats
    spans = TK.pack_spans(df.select("doc_id", F.size("tokens").alias("n_tokens")), 4).collect()
    assert sum(s.n_tokens for s in spans) == sum(len(t) for _, t in rows)
    assert sorted((s.block_id, s.start_in_block) for s in spans) == sorted({(s.block_id, s.start_in_block) for s in spans})


@pytest.mark.parametrize("keys", [[1, None, 3], [1, None, 1 << 60]])
def test_a_null_key_fails_packing_on_narrow_and_wide_ranges(spark, keys):
    df = spark.createDataFrame([(k, [1] * 7) for k in keys], "doc_id long, tokens array<long>")
    with pytest.raises(Exception, match="must not be null"):
        TK.pack_tokens(df, 4).collect()
    with pytest.raises(Exception, match="must not be null"):
        TK.pack_spans(df.select("doc_id", F.size("tokens").alias("n_tokens")), 4).collect()


def test_running_mean_over_64_bit_batches(spark):
    batches = [-(1 << 63), 5, (1 << 63) - 1]
    rows = [(i, batches[i % 3], -1.0 * i, -2.0, -0.5, -0.25 * i) for i in range(30)]
    df = spark.createDataFrame(rows, f"pair_id long, batch_id long, {LS.PC} double, {LS.PR} double, {LS.RC} double, {LS.RR} double")
    got = {r.batch_id: r._delta for r in LS.bco_running_delta(df, 0.5).collect()}
    means, want = [], {}
    for b in batches:
        own = [r for r in rows if r[1] == b]
        means.append(sum(0.5 * (r[2] - r[4]) + 0.5 * (r[3] - r[5]) for r in own) / (2 * len(own)))
        want[b] = sum(means) / len(means)
    assert got == pytest.approx(want)


def iterate(spark, out, prompts=range(6), k=4, scorer=md5_scorer, generator=echo_generator, **more):
    df = spark.createDataFrame([(i, [("user", f"q{i}")]) for i in prompts], PROMPTS)
    cfg = IterationConfig(k=k, output_dir=out, **more)
    return sorted(map(tuple, run_iteration(spark, cfg, 1, df, generator, scorer).collect()))


def test_changed_k_scorer_prompts_or_model_recompute(spark):
    out = shared_dir(spark, "t_manifest", unique=True)
    fresh = lambda **more: iterate(spark, shared_dir(spark, "t_manifest_fresh", unique=True), **more)
    other_scorer = lambda texts: texts.map(lambda t: float(int(t.rsplit("response ", 1)[1][0])))
    first = iterate(spark, out)
    for change in ({"k": 3}, {"scorer": other_scorer}, {"prompts": range(2, 9)}, {"choose_type": "max_max"},
                   {"generator_setup": lambda i: lambda: f"it{i} "}, {"version": "2"}):
        assert iterate(spark, out, **change) == fresh(**change)
    assert iterate(spark, out) == first


def test_a_killed_run_resumes_after_its_finished_stages(spark):
    out, calls = shared_dir(spark, "t_killed", unique=True), spark.sparkContext.accumulator(0)

    def counted(ps, k, **kw):
        calls.add(len(ps))
        return echo_generator(ps, k, **kw)

    def broken(texts):
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        iterate(spark, out, scorer=broken, generator=counted)
    assert calls.value == 6
    resumed = iterate(spark, out, generator=counted)
    assert calls.value == 6 and resumed
    # a note that was never finished, or a stage without its files, is made again
    jsonl.stage(spark.range(3), f"{out}/s", of="a")
    assert jsonl.stage(spark.range(10), f"{out}/s", of="a").count() == 3
    assert jsonl.stage(spark.range(10), f"{out}/s", of="b").count() == 10
    spark.range(1).select(F.lit("unfinished")).coalesce(1).write.mode("overwrite").text(f"{out}/s.manifest")
    assert jsonl.stage(spark.range(4), f"{out}/s", of="b").count() == 4
    assert jsonl.stage(spark.range(5), f"{out}/s").count() == 5


def test_content_digest_knows_rows_not_their_order(spark):
    a, b = spark.range(100), spark.range(100).repartition(7)
    assert jsonl.content_digest(a) == jsonl.content_digest(b)
    assert jsonl.content_digest(a) != jsonl.content_digest(spark.range(101))
    assert jsonl.content_digest(a) != jsonl.content_digest(a.unionByName(a))


def test_shard_files_replace_old_ones_in_one_job(spark):
    base = shared_dir(spark, "t_one_job", unique=True) + "/s_"
    rows = spark.range(100).withColumn("shard", (F.col("id") % 3).cast("int"))
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    jsonl.write_shard_files(rows.mapInArrow(count, rows.schema), base, 5)
    assert reads.value == 100
    jsonl.write_shard_files(rows.where("id < 30 and shard <> 1"), base, 5)
    back = jsonl.read_shard_files(spark, base, 5, "id long").collect()
    assert sorted((r.id, r.shard) for r in back) == [(i, i % 3) for i in range(30) if i % 3 != 1]


def test_lines_of_an_ordered_sink_have_their_position(spark):
    path = shared_dir(spark, "t_ordered", unique=True)
    jsonl.write_in_order(spark.range(5000).selectExpr("(id * 7919) % 5003 AS k").repartition(6), path, ["k"])
    rows = jsonl.add_row_ids(jsonl.read_jsonl(spark, path, "k long")).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(5000)) and [r.k for r in rows] == sorted(r.k for r in rows)


def test_records_of_another_run_are_appended(spark):
    path = shared_dir(spark, "t_runs", unique=True)
    rec = spark.createDataFrame([(1, 0.5, 1.0)], "iteration int, mean_score double, top1_score double")
    for run in ("a", "b", "b"):
        jsonl.write_record(rec, path, 1, run)
    assert jsonl.read_records(spark, path).count() == 2


def test_tokeniser_hook(spark):
    df = spark.createDataFrame([(1, "abcdef gh"), (2, None), (3, "")], "row_id long, text string")
    rows = {r.row_id: r.tokens for r in tokenise(df, trigram_tokeniser).collect()}
    assert rows == {1: trigram_tokeniser(["abcdef gh"])[0], 2: None, 3: []}
    loaded = tokenise(df, lambda texts, model: [[model] * len(t) for t in texts], setup=lambda: 7)
    assert {r.row_id: r.tokens for r in loaded.collect()} == {1: [7] * 9, 2: None, 3: []}
    with pytest.raises(Exception, match="returned 1 lists"):
        tokenise(df.coalesce(1), lambda texts: [[1]]).collect()
    messages = df.where("row_id = 1").selectExpr("row_id", "0 AS turn", "'user' AS role", "text AS content", "text")
    masked = TK.role_mask(tokenise(messages, trigram_tokeniser), tokens="tokens").collect()
    assert [r.label for r in masked] == [-100] * 3 and [r.token_id for r in masked] == rows[1]


def test_a_tokeniser_gets_few_texts_at_once(spark):
    """However many rows a partition has; a text longer than the bound goes alone, and every row keeps its own ids."""
    texts = ["x" * (i % 5) if i % 7 else None for i in range(2000)]
    texts[1000:1003] = ["y" * hooks.TOKENISED_BYTES, "z" * (hooks.TOKENISED_BYTES // 2), "w" * hooks.TOKENISED_BYTES]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string").coalesce(1)
    sizes = lambda given: [[len(given), sum(map(len, given)), len(t)] for t in given]
    rows = {r.row_id: r.tokens for r in tokenise(df, sizes).collect()}
    assert {i: t and t[2] for i, t in rows.items()} == {i: None if t is None else len(t) for i, t in enumerate(texts)}
    assert all(t[0] <= hooks.TOKENISED_ROWS and (t[0] == 1 or t[1] <= hooks.TOKENISED_BYTES) for t in rows.values() if t)
    assert rows[1000][0] == 1 and rows[1002][0] == 1


@pytest.mark.parametrize("chunk", [1, 2, 3, 128])
def test_array_layout_equals_the_token_table(spark, chunk):
    rng = random.Random(4)
    rows = [(s, p, rng.choice([-100, 0, 1, 2]), [rng.random() for _ in range(3)]) for s in range(9) for p in range(rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, "seq_id long, pos int, label int, logits array<double>").repartition(4)
    for shift in (True, False):
        want = {r.seq_id: (r.logps, r.n_tokens) for r in TK.sequence_logps(df, shift=shift).collect()}
        got = {r.seq_id: (r.logps, r.n_tokens) for r in TK.chunk_logps(TK.to_chunks(df, chunk), shift=shift).collect()}
        lengths = {s: sum(r[0] == s for r in rows) for s in range(9)}
        for s in got:
            assert got[s] == pytest.approx(want.get(s, (0.0, 0)))
        assert set(want) <= set(got) and all(lengths[s] == 1 for s in set(got) - set(want))


def test_null_labels_fail_and_masked_batches_are_nan(spark):
    logp = spark.createDataFrame([(1, 0, 1, -1.0), (1, 1, None, -1.0), (1, 2, 1, -1.0)], "seq_id long, pos int, label int, token_logp double")
    with pytest.raises(Exception, match="must not be null"):
        TK.sequence_logps(logp).collect()
    tokens = spark.createDataFrame([(1, p, b, -100 if b == 7 else 1, "chosen", [0.5, 0.5]) for b in (7, 8) for p in range(3)],
                                   "seq_id long, pos int, batch_id long, label int, side string, logits array<double>")
    rows = {r.batch_id: r.nll_loss for r in TK.batch_nll(tokens.withColumn("seq_id", F.col("batch_id"))).collect()}
    assert rows[7] != rows[7] and rows[8] == pytest.approx(0.6931471805599453)


def test_a_batch_without_its_auxiliary_loss_is_an_error(spark):
    losses = spark.createDataFrame([(1, 0.5), (2, 0.25)], "batch_id long, loss double")
    aux = spark.createDataFrame([(1, 1.0)], "batch_id long, aux_loss double")
    with pytest.raises(Exception, match="must not be null"):
        LS.batch_loss(losses, aux=aux, aux_coef=0.5).collect()
    full = aux.unionByName(spark.createDataFrame([(2, 2.0)], "batch_id long, aux_loss double"))
    assert {r.batch_id: r.loss for r in LS.batch_loss(losses, aux=full, aux_coef=0.5).collect()} == {1: 1.0, 2: 1.25}


def test_rank_pairing_has_no_exchange_on_the_batch_alone(spark):
    rows = [(i, i % 3, -1.0 * i, -2.0, -0.5, -0.25 * i) for i in range(30)]
    df = spark.createDataFrame(rows, f"pair_id long, batch_id long, {LS.PC} double, {LS.PR} double, {LS.RC} double, {LS.RR} double")
    plan = LS.preference_loss(df, "aot", beta=0.5)._jdf.queryExecution().executedPlan().toString()
    import re
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert keys and all("rank" in k or "_range" in k for k in keys)


def test_line_offsets_are_the_same_for_every_split(spark, tmp_path):
    """Ids are the real byte offsets, with multi-byte letters, blank lines, carriage returns, no last newline, any split size."""
    lines = [f'{{"k": {i}, "s": "{"é日" * (i % 7)}"}}' + ("\r" if i % 5 == 0 else "") for i in range(200)]
    lines[17] = lines[90] = ""
    want = set()
    for name in ("a", "b"):
        data = "\n".join(lines[:150] if name == "a" else lines).encode()
        (tmp_path / f"{name}.json").write_bytes(data + (b"\n" if name == "a" else b""))
        at = 0
        for line in data.split(b"\n"):
            if line:
                want.add((name, at, jsonl.json.loads(line)["k"]))
            at += len(line) + 1
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("134217728", "333", "64"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != "134217728" else before["spark.sql.files.openCostInBytes"])
            rows = jsonl.read_jsonl_at(spark, str(tmp_path / "*.json"), "k long, s string").collect()
            assert {(r.file.rsplit("/", 1)[1][0], r.offset, r.k) for r in rows} == want and len(rows) == len(want)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    with pytest.raises(Exception, match="(?i)malformed"):
        (tmp_path / "c.json").write_text('{"k": ')
        jsonl.read_jsonl_at(spark, str(tmp_path / "c.json"), "k long").collect()


def test_hot_conversation_is_joined_in_runs(spark):
    from pairforge.functions.chat import render_long

    rows = [(1, t, "user", f"m{t}") for t in range(-5, 2000)] + [(i, t, "user", f"x{i}{t}") for i in range(2, 30) for t in (3, 1, 2)]
    long = spark.createDataFrame(rows, "row_id long, turn int, role string, content string").repartition(7)
    one = {r.row_id: r.text for r in render_long(long, span=10 ** 9).collect()}
    two = {r.row_id: r.text for r in render_long(long, span=16).collect()}
    assert one == two and len(two) == 29 and two[1].index("m-5<") < two[1].index("m0<") < two[1].index("m1999<")
    groups = render_long(long, span=16)._jdf.queryExecution().executedPlan().toString()
    assert groups.count("Exchange hashpartitioning(row_id") >= 1 and "_run" in groups
