"""Known micro-batch sequences, one file per batch."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerleaf import catalog
from ledgerleaf.functions.text import split_words
from ledgerleaf.operators.words import word_counts
from ledgerleaf.scratch import fresh_path
from ledgerleaf.streaming import jobs, windows
from ledgerleaf.streaming.sources import file_stream, kafka_options


def feed(spark, batches, schema="value string"):
    """A stream that takes one of the given batches at a time."""
    path = fresh_path(spark, "feed")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, files_per_batch=1)


def batches_of(df, *columns):
    found = {}
    for row in df.collect():
        value = row[columns[0]] if len(columns) == 1 else tuple(row[c] for c in columns)
        found.setdefault(row.batch_id, []).append(value)
    return {number: sorted(values) for number, values in found.items()}


def texts(*batches):
    return [[(value,) for value in batch] for batch in batches]


def test_subtract_per_batch(spark):
    left = feed(spark, texts(["hi", "pandas"], ["hi holden"], ["bye"]))
    right = feed(spark, texts(["hi"], ["pandas"], ["byes"]))
    got = batches_of(jobs.batch_subtract(left, right, "value"), "value")
    assert got == {0: ["pandas"], 1: ["hi holden"], 2: ["bye"]}


def test_tokenize(spark):
    stream = feed(spark, texts(["hi"], ["hi holden"], ["bye"]))
    words = stream.select(F.explode(split_words(F.col("value"))).alias("word"))
    assert batches_of(jobs.run_batches(words, lambda b: b, "word string"), "word") == {
        0: ["hi"], 1: ["hi", "holden"], 2: ["bye"],
    }


def test_word_count_carries_no_state(spark):
    stream = feed(spark, texts(["a b a"], ["a"]))
    counts = jobs.run_batches(stream, lambda b: word_counts(b, "value"), "word string, n bigint")
    assert batches_of(counts, "word", "n") == {0: [("a", 2), ("b", 1)], 1: [("a", 1)]}


def test_empty_batch_gives_no_rows(spark):
    stream = feed(spark, [[(1,)], [], [(10,)]], "n int").select((F.col("n") * 3).alias("n"))
    got = batches_of(jobs.run_batches(stream, lambda b: b, "n int"), "n")
    assert sorted(got.values()) == [[3], [30]]


def test_stream_without_any_data(spark):
    stream = feed(spark, [[]], "n int")
    assert jobs.run_batches(stream, lambda b: b, "n int").count() == 0


def test_many_batches(spark):
    stream = feed(spark, [[(n,)] for n in range(1, 31)], "n int").select((F.col("n") * 2).alias("n"))
    got = batches_of(jobs.run_batches(stream, lambda b: b, "n int"), "n")
    assert [got[i] for i in range(30)] == [[2 * n] for n in range(1, 31)]


def test_identity_on_absolute_values(spark):
    stream = feed(spark, [[(-1,)], [(-2,), (3,), (-4,)], [(5,), (-6,)]], "n int").select(F.abs("n").alias("n"))
    assert batches_of(jobs.run_batches(stream, lambda b: b, "n int"), "n") == {0: [1], 1: [2, 3, 4], 2: [5, 6]}


@pytest.fixture(scope="module")
def ticks(spark):
    """Batches of 2, 4, 3 and 1 rows, one second apart."""
    sizes = [2, 4, 3, 1]
    base = spark.createDataFrame([(second, i) for second, n in enumerate(sizes) for i in range(n)], "s int, i int")
    path = fresh_path(spark, "ticks")
    base.select(F.timestamp_seconds("s").alias("at"), "i").write.parquet(path)
    return path


def counts(df):
    return [row.n for row in sorted(df.collect(), key=lambda r: r.start)]


def test_window_of_three_seconds_every_two(spark, ticks):
    got = windows.run_sliding_counts(file_stream(spark, ticks), "at", "3 seconds", "2 seconds", "1 second")
    # The first and last windows reach over the ends of the data.
    full = got.filter((F.unix_seconds("end") == 2) | (F.unix_seconds("end") == 4))
    assert counts(full) == [6, 8]


def test_window_of_two_seconds_every_one(spark, ticks):
    got = windows.run_sliding_counts(file_stream(spark, ticks), "at", "2 seconds", "1 second")
    assert counts(got.filter(F.unix_seconds("end") <= 4)) == [2, 6, 7, 4]


def test_stream_equals_batch_over_several_files(spark, rows):
    path = fresh_path(spark, "parts")
    at = F.timestamp_seconds(F.col("id") * 3 % 101)
    spark.range(500).select(at.alias("at")).repartition(5).write.parquet(path)
    streamed = windows.run_sliding_counts(file_stream(spark, path, files_per_batch=1), "at", "10 seconds", "5 seconds")
    batch = windows.sliding_counts(spark.read.parquet(path), "at", "10 seconds", "5 seconds")
    assert rows(streamed) == rows(batch)


def test_subtract_per_window_of_event_time(spark):
    """The known batches, one second apart; a late row closes the windows."""

    def timed(*batches):
        rows = [[(second, value) for value in batch] for second, batch in enumerate(batches)]
        stream = feed(spark, [*rows, [(100, "end")]], "second int, value string")
        return stream.select(F.timestamp_seconds("second").alias("at"), "value")

    left = timed(["hi", "pandas"], ["hi holden"], ["bye"])
    right = timed(["hi"], ["pandas"], ["byes"])
    kept = windows.windowed_subtract(left, right, "at", "value", "1 second", "0 seconds")
    got = jobs.run_batches(kept, lambda b: b, "start timestamp, end timestamp, value string")
    rows = sorted((r.second, r.value) for r in got.select(F.unix_seconds("start").alias("second"), "value").collect())
    assert rows == [(0, "pandas"), (1, "hi holden"), (2, "bye")]


def test_windowed_subtract_of_hot_missing_and_repeated_values(spark):
    """Brute force over one hot value, missing values, missing times, repeated
    rows and batches out of order."""
    left = [(i % 4, i, "hot") for i in range(80)] + [(1, 200, "hot"), (1, 200, "hot"), (0, 201, None), (2, 202, "b"), (None, 203, "b")]
    left += [(3, i, "c") for i in (300, 300, 301)]
    right = [(0, i, "hot") for i in range(60)] + [(2, 400, "hot"), (1, 401, None), (3, 402, "b"), (0, 403, "c"), (None, 404, "c")]
    gone = {(s, v) for s, _, v in right if s is not None and v is not None}
    want = sorted((s, str(v)) for s, _, v in left if s is not None and (s, v) not in gone)

    def arriving(rows):
        stream = feed(spark, [rows[1::2], rows[::2], [(1000, 0, "end")]], "second int, n int, value string")
        return stream.select(F.timestamp_seconds("second").alias("at"), "n", "value")

    kept = windows.windowed_subtract(arriving(left), arriving(right), "at", "value", "1 second", "100 seconds", spread=["n"], pieces=3)
    got = jobs.run_batches(kept, lambda b: b, "start timestamp, end timestamp, value string")
    assert sorted((r.second, str(r.value)) for r in got.select(F.unix_seconds("start").alias("second"), "value").collect()) == want


def test_a_hot_value_is_dealt_over_pieces(spark):
    """The join asks for its rows by piece too, and one value's rows differ in theirs."""
    at = F.timestamp_seconds(F.lit(5))
    stream = lambda: feed(spark, [[(1, "a")]], "n int, value string").withColumn("at", at)
    kept = windows.windowed_subtract(stream(), stream(), "at", "value", "1 second", "0 seconds", spread=["n"])
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert "w_piece" in plan.split("Join LeftOuter")[1].splitlines()[0]
    pieces = spark.range(1000).select(F.pmod(F.xxhash64(at, F.col("id").cast("int")), F.lit(windows.PIECES)).alias("p"))
    sizes = [r["count"] for r in pieces.groupBy("p").count().collect()]
    assert len(sizes) == windows.PIECES and max(sizes) < 120


def test_offset_ranges(spark):
    records = [[("t", 0, 5), ("t", 0, 6), ("t", 1, 0)], [("t", 0, 7)]]
    stream = feed(spark, records, "topic string, partition int, offset bigint")
    got = jobs.run_batches(stream, jobs.offset_ranges, "topic string, partition int, from_offset bigint, until_offset bigint")
    assert batches_of(got, "partition", "from_offset", "until_offset") == {0: [(0, 5, 7), (1, 0, 1)], 1: [(0, 7, 8)]}


def test_finished_batch_is_replaced_not_repeated(spark):
    path, output = fresh_path(spark, "feed"), fresh_path(spark, "out")
    spark.createDataFrame([("a",)], "value string").write.parquet(path)
    for _ in range(2):
        # A lost checkpoint makes batch 0 run again.
        jobs.start_batches(file_stream(spark, path), lambda b: b, output, fresh_path(spark, "ck")).awaitTermination()
    assert jobs.stored_batches(spark, output, "value string").count() == 1


def test_batch_interval(spark):
    query = jobs.start_batches(
        feed(spark, texts(["a"])), lambda b: b, fresh_path(spark, "out"), fresh_path(spark, "ck"), every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.lastProgress is not None
    finally:
        query.stop()


def test_timed_batches_end_by_progress(spark):
    """Two arrivals, two triggers of the clock, two numbers."""
    path, output = fresh_path(spark, "feed"), fresh_path(spark, "out")
    put = lambda *v: spark.createDataFrame([(x,) for x in v], "value string").write.mode("append").parquet(path)
    put("a", "b")
    query = jobs.start_batches(file_stream(spark, path), lambda b: b, output, fresh_path(spark, "ck"), every="300 milliseconds")
    try:
        jobs.run_until(query, 2)
        put("c")
        jobs.run_until(query, 3)
        with pytest.raises(TimeoutError):
            jobs.run_until(query, 4, seconds=0.5)
    finally:
        query.stop()
    assert batches_of(jobs.stored_batches(spark, output, "value string"), "value") == {0: ["a", "b"], 1: ["c"]}


def test_ranges_of_the_source(spark):
    """Stored by batch, touching, and those of the query's progress."""
    checkpoint = fresh_path(spark, "ck")
    query = jobs.start_batches(feed(spark, texts(["a"], ["b", "c"], ["d"])), lambda b: b, fresh_path(spark, "out"), checkpoint)
    query.awaitTermination()
    rows = sorted(jobs.source_ranges(spark, checkpoint).collect(), key=lambda r: r.batch_id)
    assert [r.batch_id for r in rows] == [0, 1, 2]
    assert [r.from_offset for r in rows[1:]] == [r.until_offset for r in rows[:-1]]
    told = {p["batchId"]: int(re.search(r"\d+", str(p["sources"][0]["endOffset"]))[0]) for p in query.recentProgress if p["numInputRows"]}
    assert {r.batch_id: r.until_offset for r in rows} == told


def test_ranges_of_record_sources(spark, tmp_path):
    """Offsets as a record source stores them, beside a source of another kind."""
    folder = tmp_path / "offsets"
    folder.mkdir()
    for batch, (a, b, c) in enumerate([(5, 3, 1), (9, 3, 2)]):
        lines = ["v1", "{}", '{"t":{"0":%d,"1":%d}}' % (a, b), '{"logOffset":%d}' % c]
        (folder / str(batch)).write_text("\n".join(lines))
    got = {tuple(r) for r in jobs.source_ranges(spark, str(tmp_path)).collect()}
    assert got == {
        (0, 0, "t", 0, None, 5), (0, 0, "t", 1, None, 3), (0, 1, None, None, None, 1),
        (1, 0, "t", 0, 5, 9), (1, 0, "t", 1, 3, 3), (1, 1, None, None, 1, 2),
    }


def test_rows_without_a_key_arrive(spark, tmp_path):
    """Null and negative keys are in some batch, as the SQL has it."""
    keys = [None, -1, -2, -3, 0, 1, 2, 5, None]
    rows = [(k, k, "click", 1.0, f"p{i}", None) for i, k in enumerate(keys)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double, props string, ts timestamp").write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(k, "a b") for k in keys], "conv_id bigint, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    spark.createDataFrame([(k,) for k in keys], "c_custkey bigint").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(1, None), (-2, -1), (7, 9)], "o_custkey bigint, o_orderkey bigint").write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    for name in ("events", "conversations", "customer", "orders"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    known, sqls = catalog.queries(), catalog.oracle_sql()
    for name in ("stream_records", "stream_offset_ranges", "stream_word_count_batch", "stream_subtract", "stream_timed_batches"):
        df = known[name](spark, str(tmp_path))
        columns = sorted(df.columns)
        got = [tuple(r) for r in df.select(*columns).collect()]
        want = con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({sqls[name]})").fetchall()
        assert sorted(map(str, got)) == sorted(map(str, want)), name


def test_single_file_and_kafka_options(spark):
    stream = file_stream(spark, "/root/testdata/sf0.001/events.parquet")
    assert jobs.run_batches(stream.select("event_id"), lambda b: b, "event_id bigint").count() == 1000
    options = kafka_options(["h1:9092", "h2:9092"], ["a", "b"], "g")
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "g"
