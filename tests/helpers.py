from pyspark.sql import types as T

from pairforge.schemas import SCORED


def scored_rows(spark, rows):
    """rows: list of (row_id, rewards, responses or None); prompt is one user turn."""
    data = []
    for rid, rewards, responses in rows:
        if responses is None:
            responses = [f"resp{rid}_{i}" for i in range(len(rewards))]
        data.append((rid, [("user", f"question {rid}")], responses, rewards))
    return spark.createDataFrame(data, SCORED)


def logps_rows(spark, rows):
    schema = T.StructType([
        T.StructField("pair_id", T.LongType()), T.StructField("batch_id", T.LongType()),
        T.StructField("policy_chosen_logps", T.DoubleType()), T.StructField("policy_rejected_logps", T.DoubleType()),
        T.StructField("reference_chosen_logps", T.DoubleType()),
        T.StructField("reference_rejected_logps", T.DoubleType()),
    ])
    return spark.createDataFrame(rows, schema)


def single_partition_shuffle_records(df):
    """Run ``df`` (collect) and return the records written by every shuffle
    exchange with a single output partition, read from the final AQE plan."""
    df.collect()
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange" and node.outputPartitioning().numPartitions() == 1:
            out.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
        ch = node.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out
