"""Plan shape: column pruning and filter pushdown reach the parquet scans."""

from conftest import SF_SMALL
from pairforge.sources import fixtures as fx
from pairforge.sources.tables import read_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_logps_reads_one_column(spark):
    p = plan(fx.logps(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint>" in p


def test_prompt_ids_push_the_role_filter(spark):
    p = plan(fx.prompt_ids(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in p
    assert "ReadSchema: struct<conv_id:bigint,role:string>" in p


def test_document_count_reads_no_column(spark):
    p = plan(read_table(spark, SF_SMALL, "documents").selectExpr("count(1)"))
    assert "ReadSchema: struct<>" in p


def test_tokens_label_side_is_pruned(spark):
    from pairforge.operators.tokens import sequence_logps
    p = plan(sequence_logps(fx.tokens(spark, SF_SMALL)))
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in p


def test_row_local_losses_stay_in_whole_stage_codegen(spark):
    from pairforge.operators.losses import LOSS_TYPES, preference_loss
    df = read_table(spark, SF_SMALL, "events").limit(0)
    lp = fx.logps(spark, SF_SMALL)
    for lt in LOSS_TYPES:
        if lt in ("bco_pair", "aot", "aot_pair"):
            continue
        p = plan(preference_loss(lp, lt))
        assert "Exchange" not in p and "Python" not in p, lt
        assert "*(1) Project" in p, lt  # the loss projection is fused into generated code
    assert df.count() == 0
