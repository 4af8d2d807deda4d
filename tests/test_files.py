"""Readers, writers, dictionary and libsvm files."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerleaf.operators import dictionary, features
from ledgerleaf.plans import libsvm
from ledgerleaf.scratch import ensure_checkpoint_dir, fresh_path, shared_folder
from ledgerleaf.sinks import cells as cell_sink
from ledgerleaf.sinks import files, tables
from ledgerleaf.sources import cells, delimited, vectors


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_header_lines_are_all_left_out(spark, tmp_path):
    path = put(tmp_path, "t.txt", "a\tb\n1\t2\na\tb\n3\n4\t5\t6\n\t\n7\t8\n")
    df = delimited.read_text_table(spark, path)
    assert df.columns == ["a", "b"]
    assert sorted(map(tuple, df.collect())) == [("", ""), ("1", "2"), ("7", "8")]


def test_other_separators_and_header_file(spark, tmp_path):
    data = put(tmp_path, "d.txt", "1|2\n3|4|5\n")
    header = put(tmp_path, "h.txt", "x,y\nignored,line\n")
    df = delimited.read_text_with_header_file(spark, header, data, sep=r"\|")
    assert df.columns == ["x", "y"] and [tuple(r) for r in df.collect()] == [("1", "2")]
    with pytest.raises(ValueError):
        delimited.first_line(spark, put(tmp_path, "empty.txt", ""))


def test_packed_lines(spark, tmp_path):
    data = put(tmp_path, "p.txt", "1\tu\ta\x02b\n\n2\tu\ta\n3\tu\n4\tu\ta\x02b\tmore\n5\n")
    header = put(tmp_path, "h.txt", "id,user,x,y")
    rejects = str(tmp_path / "rejects")
    good = delimited.read_packed(spark, header, data, rejects, sep="\x02")
    assert sorted(map(tuple, good.collect())) == [("1", "u", "a", "b"), ("4", "u", "a", "b")]
    assert sorted(r[0] for r in spark.read.text(rejects).collect()) == [
        "invalid row size: 1, content: 5",
        "invalid row size: 2, content: 3,u",
        "invalid row size: 3, content: 2,u,a",
    ]


def test_typed_and_trimmed_csv(spark, tmp_path):
    path = put(tmp_path, "c.csv", "i,d,t\n 1 , 2.5 , x y \n2,3.5,z\n")
    assert [t for _, t in delimited.read_csv(spark, put(tmp_path, "q.csv", "i,d,t\n1,2.5,x\n")).dtypes] == ["int", "double", "string"]
    trimmed = delimited.read_csv(spark, path, trim=True)
    assert sorted(map(tuple, trimmed.collect())) == [(1, 2.5, "x y"), (2, 3.5, "z")]


def test_matrix(spark, tmp_path):
    df = vectors.read_matrix(spark, put(tmp_path, "m.csv", "1,2.5\n3,4\n"), width=2)
    assert [list(r.features) for r in df.collect()] == [[1.0, 2.5], [3.0, 4.0]]


def test_tables(spark):
    df = spark.range(5)
    assert tables.replace_table(df, "t_replace").count() == 5
    assert tables.replace_table(df.limit(2), "t_replace").count() == 2
    tables.create_table(df, "t_create")
    with pytest.raises(AnalysisException):
        tables.create_table(df, "t_create")


def test_bucketed_table_joins_without_shuffle(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 100)
    a = tables.replace_keyed_table(df, "t_keyed_a", "k", 4)
    b = tables.replace_keyed_table(df.select("k").distinct(), "t_keyed_b", "k", 4)
    plan = a.join(b.hint("merge"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and a.join(b, "k").count() == 2000


def test_large_bucket_is_written_in_pieces(spark, tmp_path):
    rows = spark.range(4000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    stored = tables.replace_keyed_table(rows.repartition(6), "t_keyed_hot", "k", 16, str(tmp_path / "hot"))
    assert stored.exceptAll(rows).count() == 0 and rows.exceptAll(stored).count() == 0
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 4000 / 6 and len(sizes) > 16


def test_text_and_points(spark, tmp_path):
    lines = spark.range(100).select(F.col("id").cast("string").alias("value")).repartition(5)
    files.write_text(lines, str(tmp_path / "many"))
    files.write_text(lines, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "many").glob("part-*"))) == 5
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    points = spark.createDataFrame([(0.0, 0.5)], "x double, y double")
    files.write_points(points, str(tmp_path / "points"), "x", "y")
    assert [r[0] for r in spark.read.text(str(tmp_path / "points")).collect()] == ["0.0,0.5"]
    files.write_scores(points, str(tmp_path / "scores"), ["x", "y"], sep=" ")
    assert [r[0] for r in spark.read.text(str(tmp_path / "scores")).collect()] == ["0.0 0.5"]


@pytest.fixture(scope="module")
def training(spark):
    data = [
        (1, 1.0, "b", 0, None, "2024-01-01 00:00:10"),
        (2, 0.0, "a", 5, 2.5, None),
        (3, 0.0, "b", 7, 1.5e7, "2024-01-01 00:00:00"),
        (4, 0.0, None, 7, -9.5, None),
        (5, 1.0, "c", 7, 0.0, None),
    ]
    df = spark.createDataFrame(data, "id int, y double, t string, n int, x double, at string")
    return df.withColumn("at", F.col("at").cast("timestamp"))


def test_dictionary_of_fields_without_labels(spark):
    """Of no rows at all, of missing texts alone, and of no columns but passed-through ones."""
    some = spark.createDataFrame([(1, None, "x"), (2, None, None)], "id int, a string, b string")
    for df, want in (
        (some, [(1, "a", None, None), (2, "b", "x", 1)]),
        (some.drop("b"), [(1, "a", None, None)]),
        (some.filter("id < 0"), [(1, "a", None, None), (2, "b", None, None)]),
        (some.select("id"), []),
    ):
        for limit in (None, 3):
            fitted = dictionary.fit_dictionary(df, ignore=["id"], limit=limit)
            got = [(r.key, r.fieldName, r.label, r.number) for r in fitted.filter("key > 0").collect()]
            assert sorted(got) == want
            assert dictionary.encode(df, fitted).count() == df.count()


def test_dictionary(training):
    fitted = dictionary.fit_dictionary(training, ignore=["id", "y"])
    assert fitted.schema == dictionary.SCHEMA
    assert sorted(map(tuple, fitted.collect()), key=lambda r: (r[0], r[2], r[4] or 0)) == [
        (0, "NONE", "id", None, None),
        (0, "NONE", "y", None, None),
        (1, "STRING", "t", "b", 1),
        (1, "STRING", "t", "a", 2),
        (1, "STRING", "t", "c", 3),
        (2, "DOUBLE", "n", None, None),
        (3, "DOUBLE", "x", None, None),
        (4, "DATE", "at", None, None),
    ]
    short = dictionary.fit_dictionary(training, ignore=["id", "y"], limit=1)
    maps = {r.fieldName: r.fieldMap for r in dictionary.label_maps(short).collect()}
    assert maps == {"id": {}, "y": {}, "t": {"b": 1}, "n": {}, "x": {}, "at": {}}


def test_a_text_field_without_labels(spark):
    df = spark.createDataFrame([(1, None, "a")], "id int, t string, u string")
    fitted = dictionary.fit_dictionary(df, ignore=["id"])
    assert {(r.fieldName, r.label) for r in fitted.collect()} == {("id", None), ("t", None), ("u", "a")}
    assert [tuple(r) for r in dictionary.encode(df, fitted).collect()] == [(1, 0, 1)]


def test_a_field_of_a_million_labels(spark):
    """Labels are ranked, stored and joined without a list or map of them all."""
    n = F.col("id")
    name = F.concat(F.lit("name "), F.when(n >= 1_000_000, n - 1_000_000).otherwise(n))
    df = spark.range(1_000_100).select("id", name.alias("t"), F.concat(F.lit("u"), n % 3).alias("u"))
    fitted = dictionary.fit_dictionary(df, ignore=["id"])
    assert "collect_list" not in fitted._jdf.queryExecution().optimizedPlan().toString()
    assert fitted.filter("fieldName = 't'").count() == 1_000_000
    got = dictionary.encode(df, fitted)
    assert tuple(got.agg(F.count_distinct("t"), F.min("t"), F.max("t"), F.max("u")).first()) == (1_000_000, 1, 1_000_000, 3)
    assert got.filter("t <= 100").groupBy("t").count().filter("count = 2").count() == 100
    with pytest.raises(ValueError):
        dictionary.label_maps(fitted)


@pytest.mark.parametrize("limits", [{}, {"small_rows": 0}, {"small_rows": 3}])
def test_fields_small_and_large_encode_alike(spark, rows, limits):
    """By broadcast, by text and as cells; a hot label, repeated rows and nulls."""
    text = lambda k: F.when(F.col("id") % 7 == k, F.lit(None)).otherwise(F.concat(F.lit("x"), F.col("id") % k))
    hot = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40))
    df = spark.range(2000).select((F.col("id") % 500).alias("id"), text(3).alias("a"), hot.alias("b.c"), text(5).alias("d"), F.lit("z").alias("_row1"))
    fitted = dictionary.fit_dictionary(df.limit(1500).withColumnRenamed("b.c", "e"), ignore=["id"])
    got = dictionary.encode(df.withColumnRenamed("b.c", "e"), fitted, **limits)
    known = {(r.fieldName, r.label): r.number for r in fitted.collect()}
    want = [(r[0], *[known.get((f, v), 0) for f, v in zip(("a", "e", "d", "_row1"), r[1:])]) for r in df.collect()]
    assert rows(got) == sorted(want, key=lambda row: tuple((x is None, str(x)) for x in row))


def test_encode_with_unknown_and_missing_labels(spark, training):
    fitted = dictionary.fit_dictionary(training, ignore=["id", "y"])
    new = training.withColumn("t", F.when(F.col("id") == 1, "never seen").otherwise(F.col("t")))
    rows = {r.id: r for r in dictionary.encode(new, fitted).collect()}
    assert [rows[i].t for i in (1, 2, 3, 4, 5)] == [0, 2, 1, 0, 3]
    assert rows[1]["at"] == 1704067210 and rows[2]["at"] is None and rows[1]["n"] == 0.0
    filled = {r.id: r for r in dictionary.encode(new, fitted, fill=True).collect()}
    assert filled[2]["at"] == 0 and filled[1]["x"] == 0.0


def test_dictionary_survives_the_file(spark, training, tmp_path):
    fitted = dictionary.fit_dictionary(training, ignore=["id", "y"])
    files.write_text(dictionary.dictionary_lines(fitted), str(tmp_path / "obj"), one_file=True)
    back = spark.read.schema(dictionary.SCHEMA).json(str(tmp_path / "obj"))
    assert dictionary.dictionary_fields(back) == dictionary.dictionary_fields(fitted)
    assert sorted(back.collect(), key=str) == sorted(fitted.collect(), key=str)


def test_all_labels_are_kept_unless_a_limit_is_given(spark):
    df = spark.range(900).select(F.concat(F.lit("v"), F.col("id") % 300).alias("t"))
    fitted = dictionary.fit_dictionary(df)
    assert fitted.count() == 300
    assert dictionary.fit_dictionary(df, limit=dictionary.TOP_LABELS).count() == dictionary.TOP_LABELS
    assert sorted({r.t for r in dictionary.encode(df, fitted).collect()}) == list(range(1, 301))


def test_libsvm_lines(spark):
    data = [(1, "1.0", 2, 0.0, 1.5e7, None), (2, "0.0", 0, float("nan"), 1.5e-5, float("inf")), (3, "0.5", 1, 3.0, -2.5, 4.0)]
    df = spark.createDataFrame(data, "id int, y string, a int, b double, c double, d double")
    got = {r.id: r.line for r in features.libsvm_table(df, "id", "y").collect()}
    assert got == {1: "1.0 1:2 3:15000000", 2: "0.0 3:0.000015", 3: "0.5 1:1 2:3.0 3:-2.5 4:4.0"}


def test_export_keeps_keys_and_lines_in_step(spark, training, tmp_path):
    many = spark.range(1000).join(training.withColumnRenamed("id", "pick"), F.col("id") % 5 + 1 == F.col("pick")).drop("pick")
    path = str(tmp_path / "train")
    used = libsvm.export(many.repartition(6), path, "id", "y")
    lines = {r.id: r.line for r in libsvm.convert(many, "id", "y", used)[0].collect()}
    index = [p.read_text().split() for p in sorted((tmp_path / "train.index").glob("part-*"))]
    rows = [p.read_text().splitlines() for p in sorted((tmp_path / "train.libsvm").glob("part-*"))]
    pairs = [pair for keys, texts in zip(index, rows, strict=True) for pair in zip(keys, texts, strict=True)]
    assert len(pairs) == 1000 and all(lines[int(key)] == line for key, line in pairs)
    assert (tmp_path / "train.obj").exists()
    names = next((tmp_path / "train.name").glob("part-*")).read_text().split()
    assert names == many.columns
    back = vectors.read_libsvm(spark, path + ".libsvm", features=len(names) - 2)
    assert back.count() == 1000


def test_labels_from_a_table_of_their_own(spark, training):
    labels = training.select("id", F.lit(1.0).alias("label")).filter("id < 4")
    lines, _ = libsvm.convert_labeled(training.drop("y"), labels, "id", "label")
    assert lines.count() == 3 and all(r.line.startswith("1.0 ") for r in lines.collect())


def test_cells(spark):
    stored = spark.createDataFrame(
        [("a", "f1", "", "old", 1), ("a", "f1", "", "new", 2), ("a", "f2", "", "x", 1), ("b", "f1", "q", "hidden", 9)],
        "rowkey string, family string, qualifier string, value string, version bigint",
    )
    scan = {r.rowkey: (r.f1, r.f2) for r in cells.scan_cells(stored, ["f1", "f2"]).collect()}
    assert scan == {"a": ("new", "x"), "b": (None, None)}
    pairs = spark.createDataFrame([("a", 0.5), ("c", 0.25)], "k string, v double")
    puts = cell_sink.as_cells(pairs, "k", "v", "f1", "", F.lit(3).cast("bigint"))
    merged = cell_sink.upsert_cells(stored, puts)
    assert merged.count() == 4
    assert {r.rowkey: r.f1 for r in cells.scan_cells(merged, ["f1"]).collect()} == {"a": "0.5", "b": None, "c": "0.25"}


def test_levelled_cell_store(spark, tmp_path):
    """Newest versions over many batches; reads without an exchange; merges that
    read one level; batches put again, before and after a merge."""
    store = cell_sink.LevelStore(spark, "levelled_cells", buckets=4, per_level=3)
    write, seen = store.writer(), {}
    schema = cell_sink.CELL

    def batch(number):
        return [(f"r{(number * 5 + i) % 17}", f"f{i % 2}", "", f"v{number}.{i}", number * 10 + i % 7) for i in range(20)]

    for number in (0, 1, 1, 2, 3, 4, 3, 5, 6, 7, 8, 0, 9):
        write(spark.createDataFrame(batch(number), schema), number)
        for rowkey, family, qualifier, value, version in batch(number):
            key = (rowkey, family, qualifier)
            seen[key] = max(seen.get(key, (-1, "")), (version, value))
    got = {(r.rowkey, r.family, r.qualifier): (r.version, r.value) for r in store.read().collect()}
    assert got == seen
    levels = store.batches()
    assert max(levels) == 2 and all(len(names) < 3 for names in levels.values())
    plan = store.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount" in plan
    one = cell_sink.resolve_cells(spark.table(store.name).filter("level = 1"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in one and "level" in one.split("PartitionFilters")[1].split("]")[0]
    again = cell_sink.LevelStore(spark, store.name, buckets=4)
    assert again.read().count() == len(seen)


def test_vectors_from_mixed_columns(spark):
    df = spark.createDataFrame([(1, 3, 4.0, "5")], "a int, b int, c double, d string")
    row = features.labeled_points(df).first()
    assert row.label == 1.0 and list(row.features) == [3.0, 4.0, 5.0]
    assert list(features.assembled(df, ["a", "d"]).first().features) == [1.0, 5.0]
    with pytest.raises(Exception, match="no number"):
        features.assembled(df.withColumn("d", F.lit("x")), ["d"]).collect()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named and fresh_path(spark, "x").startswith(named)
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
