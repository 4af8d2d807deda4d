"""Labels, splits and whole jobs."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import labels
from ledgerleaf.operators.labels import LabelTask
from ledgerleaf.plans import customers, importing
from ledgerleaf.sinks.tables import replace_parts, replace_table
from ledgerleaf.sources import delimited


def test_weighted_label(spark):
    data = [(1, "0", 2.0, 7), (2, "10", None, 7), (3, "", 4.0, 7), (4, "null", -9999.0, 7), (5, None, 1.0, 7), (6, "bad", 0.0, 7)]
    df = spark.createDataFrame(data, "id int, a string, b double, c int")
    task = LabelTask(("a", "b", "c"), (0.5, 0.3, 0.2))
    got = {r.id: r.label for r in labels.weighted_label(df, "id", task).collect()}
    # a: 0..10, b: 0..4, c constant
    want = {1: 0.15 + 0.1, 2: 0.5 + 0.1, 3: 0.3 + 0.1, 4: 0.1, 5: 0.075 + 0.1, 6: 0.1}
    assert got == pytest.approx(want)


def test_weighted_label_against_the_library_scaler(spark):
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler

    df = spark.range(200).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    wide = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    scaled = MinMaxScaler(inputCol="v", outputCol="s").fit(wide).transform(wide)
    want = {r.id: float(r.s[0] * 0.7 + r.s[1] * 0.3) for r in scaled.collect()}
    got = {r.id: r.label for r in labels.weighted_label(df, "id", LabelTask(("a", "b"), (0.7, 0.3))).collect()}
    assert got == pytest.approx(want)


def test_tasks_need_a_weight_per_column():
    with pytest.raises(ValueError):
        LabelTask(("a",), (0.5, 0.5))
    tasks = labels.standing_tasks(["a", "b"], ["a", "b", "c", "d"], ["c", "d"])
    assert tasks["m2"].weights == (0.3, 0.3, 0.3, 0.1)


def test_stacked_labels_equal_single_ones(spark, rows):
    df = spark.range(50).select("id", (F.col("id") * 3 % 11).alias("a"), (F.col("id") % 4).alias("b"))
    tasks = {"x": LabelTask(("a",), (1.0,)), "y": LabelTask(("a", "b"), (0.4, 0.6))}
    stacked = labels.stacked_labels(df, "id", tasks)
    for name, task in tasks.items():
        assert rows(stacked.filter(F.col("task") == name), "id", "label") == rows(labels.weighted_label(df, "id", task))


def test_one_vs_rest(spark):
    df = spark.createDataFrame([("p", "1"), ("q", "3"), ("r", None)], "pin string, label string")
    got = {(r["class"], r.pin): r.class_label for r in labels.label_per_class(df, "pin", "label", 3).collect()}
    assert len(got) == 9 and [k for k, v in got.items() if v == "1"] == [(1, "p"), (3, "q")]


def test_splits(spark):
    df = spark.range(5000)
    split = labels.split_by_hash(df, "id", {"train": 0.7, "valid": 0.2, "test": 0.1})
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 5000 and abs(sizes["train"] - 3500) < 150
    again = labels.split_by_hash(df.repartition(9), "id", {"train": 0.7, "valid": 0.2, "test": 0.1})
    assert split.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        labels.split_by_hash(df, "id", {"train": 0.7})
    one, two = labels.split_at_random(df, "id", labels.TRAIN_TEST, 1)
    assert one.unionAll(two).exceptAll(df).count() == 0 and one.count() + two.count() == 5000
    assert abs(one.count() - 3000) < 200 and labels.split_at_random(df, "id", labels.TRAIN_TEST, 2)[0].count() != one.count()


def test_splits_keep_missing_keys_and_small_shares(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 4 != 0, F.col("id")).alias("id"))
    split = labels.split_by_hash(df, "id", {"most": 0.995, "few": 0.005})
    sizes = {r.split: r["count"] for r in split.filter("id is not null").groupBy("split").count().collect()}
    assert sum(sizes.values()) == 15_000 and 40 < sizes["few"] < 115
    assert split.filter("id is null").select("split").distinct().count() == 1
    assert split.filter("split is null").count() == 0
    with pytest.raises(ValueError):
        labels.split_bounds([1 - 1e-12, 1e-12])
    task = {"t": LabelTask(("a",), (1.0,))}
    tables = importing.train_tables(df.withColumn("a", F.lit(1)), "id", task)
    assert sum(tables[f"t_{part}"].count() for part in ("train", "valid", "test")) == 20_000
    assert tables["t_label"].count() == 20_000


def test_a_table_may_be_replaced_from_itself(spark):
    name = "selfmade"
    replace_table(spark.range(10), name)
    assert replace_table(spark.table(name).filter("id < 4"), name).count() == 4
    broken = spark.table(name).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception):
        replace_table(broken, name)
    assert spark.table(name).count() == 4
    spark.sql(f"drop table {name}")


def test_parts_are_written_in_one_pass(spark):
    df = spark.range(10).select("id", F.when(F.col("id") < 3, "a").otherwise("b").alias("p"))
    stored = replace_parts(df, "p", {"a": "part_a", "b": "part_b", "c": "part_c"})
    assert {name: table.count() for name, table in stored.items()} == {"part_a": 3, "part_b": 7, "part_c": 0}
    assert stored["part_c"].columns == ["id"]
    for name in stored:
        spark.sql(f"drop table {name}")


def test_header_is_in_the_first_file_by_name(spark, tmp_path):
    (tmp_path / "part-00000").write_text("id,name\n")
    (tmp_path / "part-00001").write_text("".join(f"{i},n{i}\n" for i in range(500)))
    got = delimited.read_text_table(spark, str(tmp_path), ",")
    assert got.columns == ["id", "name"] and got.count() == 500


@pytest.fixture()
def job(tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    inputs = [
        importing.Input(
            "orders_in",
            write("oh.txt", "id,user_id,before,paid"),
            write("od.txt", "".join(f"{i % 20}\tu{i % 20}\t{i}\t{i / 2}\n" for i in range(100)) + "bad line\n"),
        ),
        importing.Input(
            "info_in",
            write("ih.txt", "id,user_id,x,y"),
            write("id.txt", "".join(f"{i}\tu{i}\t{i}\x02{i * i}\n" for i in range(18)) + "18\tu18\tonly\n"),
            sep="\x02",
            rejects=str(tmp_path / "rejects"),
        ),
        importing.Input("never_imported", str(tmp_path / "ih.txt"), str(tmp_path / "absent.txt")),
    ]
    return importing.ImportJob(
        key="id",
        original_key="user_id",
        inputs=inputs,
        result="all_in",
        tasks={"m1": LabelTask(("avg_before", "x"), (0.5, 0.5))},
        averages={"before": "avg_before", "paid": "avg_paid"},
    )


def test_import_job(spark, job, tmp_path):
    tables = importing.run_import_job(spark, job)
    assert set(tables) == {"m1_label", "m1_train", "m1_valid", "m1_test"}
    assert spark.table("all_in").count() == 20 and spark.table("m1_label").count() == 20
    assert sum(spark.table(f"m1_{part}").count() for part in ("train", "valid", "test")) == 20
    assert set(spark.table("m1_train").columns) == {"id", "count_id", "avg_paid", "y"}
    assert [r[0] for r in spark.read.text(str(tmp_path / "rejects")).collect()] == ["invalid row size: 3, content: 18,u18,only"]
    joined = {r.id: r for r in spark.table("all_in").collect()}
    assert joined["18"].x is None and joined["3"].count_id == "5" and joined["3"].avg_before == "43.0"
    # Later runs can start from the stored tables.
    predicted = importing.run_import_job(spark, job, step="skip_import", join=False, goal="predict")
    assert list(predicted) == ["m1_test"] and predicted["m1_test"].count() == 20
    assert importing.run_import_job(spark, job, step="skip_import", how="full")["m1_label"].count() == 20


def test_a_stale_table_is_not_joined(spark, job, tmp_path):
    importing.run_import_job(spark, job)
    (tmp_path / "id.txt").unlink()
    again = replace(job, tasks={"m1": LabelTask(("avg_before",), (1.0,))})
    importing.run_import_job(spark, again, step="skip_import")
    assert "x" not in spark.table("all_in").columns and spark.table("all_in").count() == 20
    with pytest.raises(ValueError):
        importing.import_orders(spark, replace(job, inputs=job.inputs[2:]))


def test_import_sample(spark, job, tmp_path):
    (tmp_path / "s.csv").write_text("id,user_id,avg_before,x,z\n1,u,5.0,null,-9999\n2,u,,2,3\n")
    tables = importing.run_import_job(spark, job, step="import_sample", join=False, sample=str(tmp_path / "s.csv"))
    assert tables["m1_label"].count() == 2
    stored = {r.id: r for r in spark.table("all_in").collect()}
    assert stored[1].x == "" and stored[1].z == 0 and stored[2].avg_before == 0.0


def test_import_job_rejects_unknown_steps(spark, job):
    with pytest.raises(ValueError):
        importing.run_import_job(spark, job, step="everything")
    with pytest.raises(ValueError):
        importing.run_import_job(spark, job, goal="test")
    with pytest.raises(ValueError):
        importing.run_import_job(spark, job, step="import_sample")


def test_train_tables_with_whole_test(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("a"), F.lit("x").alias("b"))
    tables = importing.train_tables(df, "id", {"t": LabelTask(("a",), (1.0,))}, test_is_full=True)
    assert tables["t_test"].count() == 100 and tables["t_test"].columns == ["id", "b"]


def test_customer_tables(spark):
    trans = spark.createDataFrame(
        [("c1", "m1", "x", 1.0, 1), ("c1", "m2", "x", 3.0, 1), ("c2", "m9", None, 5.0, 0), ("c1", "m1", "y", 7.0, 0), ("c4", "m1", "z", 2.0, None)],
        "card string, m string, cat string, amount double, month int",
    )
    merchants = spark.createDataFrame([("m1", 10.0, "drop"), ("m2", 20.0, "drop")], "m string, sales double, cat string")
    spec = customers.FeatureSpec("card", ["cat"], ["amount", "sales"], ["amount"])
    made = customers.feature_table(trans, merchants, "m", spec, F.col("month") == 1, drop=["cat"])
    assert made.columns == [
        "card", "cat", "sum_amount", "avg_amount", "sum_sales", "avg_sales",
        "historical__cat", "historical__sum_amount", "historical__avg_amount",
    ]
    base = spark.createDataFrame([("c1", 0.5), ("c3", 0.7), ("c4", 0.1)], "card string, target double")
    train, test = customers.customer_tables(base, base.drop("target"), made, "card", "target")
    rows = {r.card: r for r in train.collect()}
    assert rows["c1"].sum_sales == 30.0 and rows["c1"].cat == "x" and rows["c3"].sum_amount is None
    assert rows["c1"].historical__cat == "y" and rows["c1"].historical__sum_amount == 7.0
    # A row of no known month is historical.
    assert rows["c4"].cat is None and rows["c4"].historical__cat == "z"
    assert {r.target for r in test.collect()} == {0}


def test_features_of_both_periods_read_and_join_the_facts_once(spark, tmp_path):
    spark.range(500).selectExpr("id % 50 card", "id % 7 m", "id % 3 cat", "id * 1.0D amount", "id % 2 month").write.parquet(str(tmp_path / "t"))
    spark.range(7).selectExpr("id m", "id * 2.0D sales").write.parquet(str(tmp_path / "d"))
    trans, merchants = (spark.read.parquet(str(tmp_path / name)) for name in "td")
    spec = customers.FeatureSpec("card", ["cat", "m"], ["amount", "sales"], ["amount"])
    made = customers.feature_table(trans, merchants, "m", spec, F.col("month") == 1)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Join") == 1
    assert plan.count("Exchange hashpartitioning(card") == 2
