"""Joins on a key that holds a third of the rows are split at run time, and no
plan sorts or collects a whole table in one task."""

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import aggregates, evaluate, joins, sets
from ledgerleaf.operators import ordered
from ledgerleaf.operators.ordered import numbered

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return spark.range(60000, numPartitions=16).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_enriching_join_is_split(no_broadcast, facts, dimension):
    joined = joins.enrich(facts, dimension, "k")
    assert "skew=true" in final_plan(joined) and joined.filter("twice = k * 2").count() == 60000


def test_join_with_a_deduplicated_dimension_is_split(no_broadcast, facts, dimension):
    unique = aggregates.top_row(dimension.union(dimension), "k", ["twice"])
    joined = joins.enrich(facts, unique, "k")
    assert "skew=true" in final_plan(joined) and joined.filter("twice = k * 2").count() == 60000


def test_missing_keys_match_nothing(facts, dimension):
    holes = facts.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k")))
    joined = joins.enrich(holes, dimension.union(dimension.limit(1).selectExpr("cast(null as bigint)", "0")), "k")
    assert joined.columns == ["id", "k", "pad", "twice"]
    assert joined.filter("k is null and twice is not null").count() == 0 and joined.count() == 60000


def test_repeated_keys_join_is_split(no_broadcast, facts):
    found = joins.repeated_rows(facts, "k")
    assert "skew=true" in final_plan(found)
    assert found.filter("k = 7").count() == found.filter("k = 7").select("key_count").first()[0]


def test_subtract_is_split(no_broadcast, facts, dimension):
    left = sets.subtract(facts, dimension.filter("k > 100").select("k"), ["k"])
    assert "skew=true" in final_plan(left) and left.filter("k > 100").count() == 0


def shuffled_rows(df):
    """Rows written by the shuffles of a plan that has run, first to last."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.finalPhysicalPlan())
        if name.startswith("ShuffleQueryStage"):
            return walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if name.startswith("Exchange"):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_grouping_shuffles_combined_rows_only(facts):
    """At most one row per key and input task, though one key holds most rows."""
    few = facts.withColumn("k", F.col("k") % 50)
    for df in (aggregates.mode(few, "k", "k"), aggregates.top_row(few, "k", ["id"]), aggregates.count_by_key(few, "k")):
        moved = shuffled_rows(df)
        assert moved and max(moved) <= 50 * 16


def test_ordered_operators_have_no_single_task_window_over_rows(facts, spark):
    """Only the table of part totals may be gathered."""
    placed = numbered(facts.select("k", "id"), ["k", "id"], parts=24)
    gathered = [line for line in placed._jdf.queryExecution().executedPlan().toString().splitlines() if "SinglePartition" in line]
    assert len(gathered) == 1
    assert placed.agg(F.max("line_no")).first()[0] == 60000


def test_ordered_operators_move_rows_once(facts, monkeypatch):
    """One exchange of raw rows each; all others carry part or group totals."""
    monkeypatch.setattr(ordered, "ROWS_PER_PART", 5000)
    scored = facts.select((F.col("id") / 60000).alias("score"), (F.col("id") % 2).cast("double").alias("label"), "k", "id")
    made = {
        "numbered": numbered(scored, ["k", "id"]),
        "auc": evaluate.score_steps(scored),
        "dcg": evaluate.dcg(scored, "k", "label", [F.desc("score")]),
        "area": evaluate.area_under_points(scored.select("score", "label"), "score", "label"),
    }
    for name, df in made.items():
        moved = shuffled_rows(df)
        assert len([n for n in moved if n >= 60000]) == 1, (name, moved)


def test_exact_area_over_many_scores(spark):
    """Every score distinct, positives on top."""
    df = spark.range(50000).select((F.col("id") / 50000).alias("score"), (F.col("id") >= 40000).cast("double").alias("label"))
    assert evaluate.auc_exact(df).first()[0] == 1.0
