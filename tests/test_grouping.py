"""Aggregates, joins and sets on tables with one dominant key."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import aggregates, columns, joins, sets, words


@pytest.fixture(scope="module")
def data():
    return [
        (0 if i % 5 < 2 else i % 40, None if i % 4 == 3 else "abc"[(i * 7) % 3], (i * 13) % 6, float(i % 100) / 4, i)
        for i in range(2000)
    ]


@pytest.fixture(scope="module")
def skewed(spark, data):
    return spark.createDataFrame(data, "k int, t string, n int, x double, i int").repartition(7)


def best(values):
    tally = Counter(values)
    return min(tally, key=lambda v: (-tally[v], v is None, v))


def by_key(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return groups


def test_modes_count_missing_values_and_break_ties_low(skewed, data):
    got = {r.k: (r.t, r.n) for r in aggregates.modes(skewed, "k", ["t", "n"]).collect()}
    assert got == {k: (best(r[1] for r in g), best(r[2] for r in g)) for k, g in by_key(data).items()}
    single = {r.k: r.t for r in aggregates.mode(skewed, "k", "t").collect()}
    assert single == {k: v[0] for k, v in got.items()}


def test_modes_keep_types_and_compare_numbers_as_numbers(spark):
    df = spark.createDataFrame([(1, 10, 2.5), (1, 9, 10.5)], "k int, a bigint, b double")
    out = aggregates.modes(df, "k", ["a", "b"])
    assert out.dtypes == [("k", "int"), ("a", "bigint"), ("b", "double")]
    assert tuple(out.first()) == (1, 9, 2.5)


def test_one_pass_equals_separate_passes(skewed, rows):
    both = aggregates.modes_and_sums(skewed, "k", ["t", "n"], ["x", "i"], scale=2)
    apart = aggregates.modes(skewed, "k", ["t", "n"]).join(
        aggregates.sums_and_averages(skewed, "k", ["x", "i"], scale=2), "k"
    )
    assert rows(both) == rows(apart.select(both.columns))


def test_sums_of_texts_that_are_no_numbers(spark):
    df = spark.createDataFrame([(1, "2.5"), (1, "x"), (2, "x")], "k int, v string")
    got = {r.k: (r.sum_v, r.avg_v) for r in aggregates.sums_and_averages(df, "k", ["v"]).collect()}
    assert got == {1: (2.5, 2.5), 2: (None, None)}


def test_chunks_are_bounded_and_whole(skewed, data):
    pieces = aggregates.collected_in_chunks(skewed, "k", "i", F.col("t"), width=50).collect()
    assert max(len(p["values"]) for p in pieces) <= 50
    joined = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.k, p.chunk)):
        joined[p.k] += p["values"]
    assert joined == {k: [r[1] for r in sorted(g, key=lambda r: r[4])] for k, g in by_key(data).items()}


def test_tags_to_columns(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", ""), (2, "b", ""), (2, "b", "z"), (2, "b", "y")], "id int, tag string, v string")
    out = aggregates.tags_to_columns(df, "id", "tag", "v")
    assert out.columns == ["id", "a", "b"]
    assert sorted(map(tuple, out.collect())) == [(1, "", "x"), (2, "", "z")]
    spark.conf.set("spark.sql.pivotMaxValues", 1)
    try:
        with pytest.raises(ValueError, match="tags"):
            aggregates.tags_to_columns(df, "id", "tag", "v")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_statistics_with_weight_zero_and_large_offset(spark):
    df = spark.createDataFrame([(1e9 + 1, 1.0), (1e9 + 3, 1.0), (5.0, 0.0)], "x double, w double")
    row = aggregates.column_statistics(df, ["x"], weight="w").first()
    assert (row["mean"], row["variance"], row["count"], row["min"]) == (1e9 + 2, 2.0, 2, 1e9 + 1)
    plain = aggregates.column_statistics(df.filter("w > 0"), ["x"]).first()
    assert plain["variance"] == 2.0 and plain["num_nonzeros"] == 2


def test_observed_counter(spark):
    rows = spark.newSession().range(2000)
    counted, seen = aggregates.counted_beside(rows, "seen", F.col("id"))
    assert counted.filter("id >= 0").agg(F.sum("id")).first()[0] == seen.get["total"] == 1999000
    assert seen.get["rows"] == 2000


def test_repeated_rows(skewed, data):
    tally = Counter(r[0] for r in data)
    got = joins.repeated_rows(skewed, "k").collect()
    assert len(got) == sum(n for n in tally.values() if n > 1)
    assert all(r.key_count == tally[r.k] for r in got)


def test_subtract_keeps_repeats_and_matches_nulls(spark, rows):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    right = spark.createDataFrame([("b",), ("b",), (None,)], "v string")
    assert rows(sets.subtract(left, right)) == [("a",), ("a",)]
    assert rows(sets.subtract(left, right.filter("v is not null"))) == [("a",), ("a",), (None,), (None,)]


def test_files_of_different_length_fail(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "line int, id string")
    b = spark.createDataFrame([(1, "0.5"), (2, "0.6")], "line int, pred string")
    assert sorted(r.merged for r in joins.side_by_side(a, b, "line", "id", "pred").collect()) == ["x    0.5", "y    0.6"]
    for left, right in ((a, b.filter("line = 1")), (a.filter("line = 1"), b)):
        with pytest.raises(Exception, match="length"):
            joins.side_by_side(left, right, "line", "id", "pred").collect()


def test_join_types_and_missing_tables(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    b = spark.createDataFrame([(2, "c"), (3, "d")], "k int, y string")
    assert {how: joins.join_tables([a, b], "k", how).count() for how in joins.JOIN_TYPES} == {"left": 2, "right": 2, "full": 3}
    with pytest.raises(ValueError):
        joins.join_tables([a, b], "k", "cross")
    with pytest.raises(ValueError):
        joins.join_catalog(spark, ["no_such_table"], "k")


def test_repeated_keys_fail_the_fold(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, x string")
    b = spark.createDataFrame([(1, "p"), (None, "q"), (None, "r")], "k int, y string")
    c = spark.createDataFrame([(2, 1), (2, 2), (3, 1)], "k int, z int")
    # The first table may repeat keys; missing keys are never repeated.
    joined = joins.join_checked({"a": a, "b": b}, "k")
    assert sorted((r.x, r.y) for r in joined.collect()) == [("a", "p"), ("b", "p"), ("c", None), ("d", None)]
    assert joins.join_checked({"a": a, "b": b}, "k", "full").count() == 6
    with pytest.raises(ValueError, match='c has 2 rows with the key {"k":2}'):
        joins.join_checked({"a": a, "b": b, "c": c}, "k")
    assert joins.join_checked({"a": a, "c": c.withColumnRenamed("z", "x2").dropDuplicates(["k"])}, "k").count() == 4
    assert joins.join_checked({"a": a}, "k").count() == 4
    found = joins.repeated_keys({"a": a, "b": b, "c": c}, "k")
    assert sorted(map(tuple, found.collect())) == [("a", '{"k":1}', 2), ("c", '{"k":2}', 2)]
    # Of two columns a key repeats only as a whole.
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (1, None), (1, "b")], "k int, x string")
    assert [r.key_count for r in joins.repeated_keys({"p": pairs}, ["k", "x"]).collect()] == [2]
    for name in ("a", "c"):
        {"a": a, "c": c}[name].createOrReplaceTempView(f"fold_{name}")
    with pytest.raises(ValueError, match="fold_c has 2 rows"):
        joins.join_catalog(spark, ["fold_a", "fold_c"], "k")
    with pytest.raises(ValueError):
        joins.repeated_keys({}, "k")


def test_only_keys_are_read_to_look_for_repeats(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2)], "k int, x string, y int").write.parquet(f"{tmp_path}/t")
    plan = joins.repeated_keys({"t": spark.read.parquet(f"{tmp_path}/t")}, "k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int>" in plan and plan.count("Exchange hashpartitioning") == 1


def test_broadcast_is_given_up_for_a_large_side(spark):
    a, b = spark.range(100), spark.range(50)
    small = joins.with_strategy(a, b, "id", "broadcast")._jdf.queryExecution().optimizedPlan().toString()
    large = joins.with_strategy(a, b, "id", "broadcast", broadcast_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in small and "strategy=merge" in large
    wide = b.withColumn("pad", F.repeat(F.lit("x"), 1000))
    assert joins.is_small(wide) and not joins.is_small(wide, size=40_000) and not joins.is_small(wide, rows=49)


def test_column_tools(spark):
    df = spark.createDataFrame([(1, "2", "x")], "a int, b string, c string")
    assert columns.prefixed(df, "p", keep=["a"]).columns == ["a", "p__b", "p__c"]
    assert columns.without(df, ["b"]).columns == ["a", "c"]
    assert columns.at_positions(df, {2: "z", 0: "y"}).columns == ["z", "y"]
    assert tuple(columns.cast_columns(df, {"b": "double", "c": "double"}).first()) == (1, 2.0, None)
    assert columns.stacked_by_task({"m1": df, "m2": df}).filter("task = 'm2'").count() == 1


def test_stop_list_of_any_length(spark, rows):
    lines = [(1, "a|b|c1|a|d"), (2, "b"), (3, ""), (4, None), (5, "d||a|"), (1, "c|d"), (1, "c|d"), (None, "a|d")]
    texts = spark.createDataFrame(lines, "id int, t string")
    want = [(1, "a|a"), (2, ""), (3, ""), (4, None), (5, "|a"), (1, "c"), (1, "c"), (None, "a")]
    sizes_tried = (0, {}), (20_000, {}), (20_000, {"broadcast_words": 1}), (20_000, {"broadcast_bytes": 1}), (20_000, {"held_words": 1})
    for more, sizes in sizes_tried:
        stops = spark.createDataFrame([("b",), ("d",), (None,)], "w string").union(spark.range(more).select(F.concat(F.lit("z"), "id")))
        got = words.remove_stop_words(texts, "t", stops, **sizes)
        moved = "Exchange" in got._jdf.queryExecution().executedPlan().toString()
        assert moved == ("held_words" in sizes)
        assert got.columns == ["id", "t", "words"]
        assert sorted(map(tuple, got.select("id", "words").collect()), key=str) == sorted(want, key=str)


def test_modes_keep_their_types_and_periods(spark):
    """Lists, records, times and missing values, against a window per column and period."""
    n = F.col("id")
    df = spark.range(900).select(
        (n % 7).alias("k"),
        F.array((n % 3).cast("string"), F.lit("x")).alias("marks"),
        F.struct((n % 5).alias("a"), F.when(n % 4 == 0, n % 2).alias("b")).alias("piece"),
        F.when(n % 6 > 0, F.timestamp_seconds(n % 4)).alias("at"),
        (n % 11).cast("double").alias("x"),
        F.when(n % 10 == 3, F.lit(None)).otherwise(n % 10 < 6).alias("recent"),
    )
    names = ["marks", "piece", "at", "x"]
    periods = [aggregates.Period(F.col("recent"), ["x"]), aggregates.Period(~F.col("recent"), (), "old_")]
    got = aggregates.period_features(df, "k", names, periods)
    assert dict(got.dtypes)["at"] == "timestamp" and dict(got.dtypes)["old_marks"] == "array<string>"
    for period in periods:
        rows = df.filter(period.rows)
        for name in names:
            want = {tuple(r) for r in aggregates.mode(rows, "k", name).select("k", F.to_json(F.struct(name))).collect()}
            column = F.to_json(F.struct(F.col(f"{period.prefix}{name}").alias(name)))
            assert {tuple(r) for r in got.select("k", column).collect()} == want
    sums = df.filter("recent").groupBy("k").agg(F.sum("x"))
    assert sorted(map(tuple, got.select("k", "sum_x").collect())) == sorted(map(tuple, sums.collect()))


def test_rows_of_a_key_meet_before_they_become_cells(spark):
    rows = spark.range(100).select((F.col("id") % 5).alias("k"), (F.col("id") % 3).alias("v"))
    found = aggregates.modes_and_sums(rows, "k", ["v"], ["v"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RebalancePartitions")
    assert found.count() == 5
