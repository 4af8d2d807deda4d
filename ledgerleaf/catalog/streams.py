"""Streams over the standard tables."""

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.catalog.scalars import WORDS_SQL
from ledgerleaf.functions.text import split_words
from ledgerleaf.operators.words import word_counts
from ledgerleaf.scratch import fresh_path
from ledgerleaf.streaming import jobs, windows
from ledgerleaf.streaming.sources import as_records, file_stream


def _stream(spark, sf_dir, name):
    return file_stream(spark, f"{sf_dir}/{name}.parquet")


_RECORDS_SQL = """SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
  CAST(user_id AS VARCHAR) AS key, props AS value FROM events"""
_RECORD_SCHEMA = "topic string, partition int, offset bigint, key string, value string"


#: Arrivals of the streams that are cut into batches.
_ARRIVALS = 3


def _arrival(piece, n=_ARRIVALS):
    """The arrival of a row: rows without a number come first, negative numbers
    count round."""
    return F.pmod(F.coalesce(piece, F.lit(0)), F.lit(n))


def _arrival_sql(piece, n=_ARRIVALS):
    return f"((coalesce({piece}, 0) % {n}) + {n}) % {n}"


def _in_batches(spark, sources, stream_of, job, schema, mode="append", checkpoint=None):
    """Tables that arrive in pieces: a batch for each arrival, in one stream
    that is resumed. ``sources`` has a table and its piece number; ``stream_of``
    makes one stream of theirs."""
    inboxes = [fresh_path(spark, "inbox") for _ in sources]
    output, checkpoint = fresh_path(spark, "batches"), checkpoint or fresh_path(spark, "progress")
    for arrival in range(_ARRIVALS):
        for (rows, piece), inbox in zip(sources, inboxes):
            rows.filter(_arrival(piece) == arrival).write.mode("append").parquet(inbox)
        streams = [spark.readStream.schema(rows.schema).parquet(inbox) for (rows, _), inbox in zip(sources, inboxes)]
        jobs.start_batches(stream_of(*streams), job, output, checkpoint, mode=mode).awaitTermination()
    return jobs.stored_batches(spark, output, schema)


def _records(events):
    return as_records(
        events,
        topic=F.col("event_type"),
        partition=F.col("user_id") % 4,
        offset=F.col("event_id"),
        key=F.col("user_id"),
        value=F.col("props"),
    )


_BATCHED_SQL = f"SELECT *, {_arrival_sql('"offset"')} AS batch_id FROM ({_RECORDS_SQL})"


@query("stream_records", _BATCHED_SQL)
def stream_records(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return _in_batches(spark, [(events, F.col("event_id"))], _records, lambda batch: batch, _RECORD_SCHEMA)


@query(
    "stream_offset_ranges",
    f"""SELECT topic, partition, min("offset") AS from_offset, max("offset") + 1 AS until_offset, batch_id
        FROM ({_BATCHED_SQL}) GROUP BY topic, partition, batch_id""",
)
def stream_offset_ranges(spark, sf_dir):
    schema = "topic string, partition int, from_offset bigint, until_offset bigint"
    events = table(spark, sf_dir, "events")
    return _in_batches(spark, [(events, F.col("event_id"))], _records, jobs.offset_ranges, schema)


@query(
    "stream_source_ranges",
    f"""SELECT batch_id, n, CASE WHEN batch_id > 0 THEN batch_id - 1 END AS from_offset, batch_id AS until_offset
      FROM (SELECT {_arrival_sql("event_id")} AS batch_id, count(*) AS n FROM events GROUP BY 1)""",
)
def stream_source_ranges(spark, sf_dir):
    """The source's own ranges of each batch, beside the rows the batch took."""
    checkpoint, events = fresh_path(spark, "progress"), table(spark, sf_dir, "events")
    taken = _in_batches(spark, [(events, F.col("event_id"))], lambda s: s.select("event_id"), lambda b: b, "event_id bigint", checkpoint=checkpoint)
    counts = taken.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    ranges = jobs.source_ranges(spark, checkpoint).select("batch_id", "from_offset", "until_offset")
    return counts.join(ranges, "batch_id")


#: How late a row of the tables may be: they span 30 days and arrive out of order.
_LATENESS = "60 days"

#: Arrivals of the timed stream.
_TIMED = 2


@query("stream_timed_batches", f"SELECT event_id, user_id, {_arrival_sql('event_id', _TIMED)} AS batch_id FROM events")
def stream_timed_batches(spark, sf_dir):
    """A query that runs on a clock: what arrives after a trigger is the next
    one's batch. It is stopped when its progress tells of all rows."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    inbox, output = fresh_path(spark, "inbox"), fresh_path(spark, "batches")
    arrival, sent, running = _arrival(F.col("event_id"), _TIMED), 0, None
    try:
        for number in range(_TIMED):
            mine = events.filter(arrival == number)
            mine.write.mode("append").parquet(inbox)
            sent += mine.count()
            if running is None:
                stream = spark.readStream.schema(events.schema).parquet(inbox)
                running = jobs.start_batches(stream, lambda batch: batch, output, fresh_path(spark, "progress"), every="1 second")
            jobs.run_until(running, sent)
    finally:
        if running is not None:
            running.stop()
    return jobs.stored_batches(spark, output, "event_id bigint, user_id bigint")


_TEXT_WORDS_SQL = WORDS_SQL.format(t="text", s=" ", raw=" ")


@query(
    "stream_word_count_batch",
    f"""SELECT word, count(*) AS n, batch_id FROM (SELECT {_arrival_sql("conv_id")} AS batch_id, unnest({_TEXT_WORDS_SQL}) AS word
      FROM conversations) GROUP BY word, batch_id""",
)
def stream_word_count_batch(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "text")
    count = lambda batch: word_counts(batch, "text")
    return _in_batches(spark, [(talk, F.col("conv_id"))], lambda s: s.select("text"), count, "word string, n bigint")


@query("stream_tokenize", f"SELECT conv_id, turn, unnest({_TEXT_WORDS_SQL}) AS word FROM conversations")
def stream_tokenize(spark, sf_dir):
    talk = _stream(spark, sf_dir, "conversations")
    words = talk.select("conv_id", "turn", F.explode(split_words(F.col("text"))).alias("word"))
    return jobs.run_batches(words, lambda batch: batch, "conv_id bigint, turn bigint, word string").drop("batch_id")


@query(
    "stream_subtract",
    f"""SELECT c_custkey AS custkey, {_arrival_sql("c_custkey")} AS batch_id FROM customer WHERE NOT EXISTS
      (SELECT 1 FROM orders WHERE o_custkey IS NOT DISTINCT FROM c_custkey AND {_arrival_sql("o_orderkey")} = {_arrival_sql("c_custkey")})""",
)
def stream_subtract(spark, sf_dir):
    """Customers without an order in the same batch."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    sources = [(customers, F.col("custkey")), (orders, F.col("o_orderkey"))]
    both = lambda left, right: jobs.tagged_sides(left, right, "custkey")
    return _in_batches(spark, sources, both, jobs.subtract_sides("custkey"), "custkey bigint")


@query(
    "stream_windowed_subtract",
    """WITH e AS (SELECT event_type, user_id, epoch_us(ts) // 21600000000 AS w FROM events WHERE ts IS NOT NULL)
      SELECT w * 21600 AS start_second, user_id FROM e WHERE event_type = 'view' AND NOT EXISTS
        (SELECT 1 FROM e AS p WHERE p.event_type = 'purchase' AND p.w = e.w AND p.user_id = e.user_id)""",
)
def stream_windowed_subtract(spark, sf_dir):
    """Views by users without a purchase in the same six hours, from two streams
    that arrive in pieces out of order.

    The last piece of either stream has a closing row, far behind all others:
    its watermark lets every window of the table out.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    closing = events.agg(F.max("ts").alias("ts")).filter(F.col("ts").isNotNull()).select(
        F.lit(_ARRIVALS - 1).cast("bigint").alias("event_id"),
        (F.col("ts") + F.expr(f"INTERVAL {_LATENESS} + INTERVAL 1 DAY")).alias("ts"),
        F.lit(None).cast("bigint").alias("user_id"),
    )
    of = lambda kind: events.filter(F.col("event_type") == kind).drop("event_type").union(closing)
    open_windows = lambda views, purchases: windows.windowed_subtract(
        views, purchases, "ts", "user_id", "6 hours", _LATENESS, spread=["event_id"]
    )
    sources = [(of("view"), F.col("event_id")), (of("purchase"), F.col("event_id"))]
    got = _in_batches(spark, sources, open_windows, lambda batch: batch, "start timestamp, end timestamp, user_id bigint")
    return got.select(F.unix_seconds("start").alias("start_second"), "user_id")


def _sliding_sql(length, slide, offset):
    """Window starts that cover each event, in whole microseconds."""
    steps = -(-length // slide)
    starts = " UNION ALL ".join(
        f"SELECT t, ((t - {offset}) // {slide}) * {slide} + {offset} - {i * slide} AS s FROM e" for i in range(steps)
    )
    return f"""WITH e AS (SELECT epoch_us(ts) AS t FROM events), w AS ({starts})
      SELECT s // 1000000 AS start_second, (s + {length}) // 1000000 AS end_second, count(*) AS n
      FROM w WHERE t < s + {length} GROUP BY 1, 2"""


def _seconds(counts):
    return counts.select(
        F.unix_seconds("start").alias("start_second"), F.unix_seconds("end").alias("end_second"), "n"
    )


@query("stream_sliding_3_2", _sliding_sql(3_000_000, 2_000_000, 1_000_000))
def stream_sliding_3_2(spark, sf_dir):
    events = _stream(spark, sf_dir, "events").select("ts")
    return _seconds(windows.run_sliding_counts(events, "ts", "3 seconds", "2 seconds", "1 second", lateness=_LATENESS))


@query("stream_sliding_2_1", _sliding_sql(2_000_000, 1_000_000, 0))
def stream_sliding_2_1(spark, sf_dir):
    events = _stream(spark, sf_dir, "events").select("ts")
    return _seconds(windows.run_sliding_counts(events, "ts", "2 seconds", "1 second", lateness=_LATENESS))


@query(
    "stream_map",
    "SELECT event_id, event_id * 3 AS tripled, event_id * 2 AS doubled, event_id AS same FROM events",
)
def stream_map(spark, sf_dir):
    number = F.col("event_id")
    mapped = _stream(spark, sf_dir, "events").select(
        "event_id", (number * 3).alias("tripled"), (number * 2).alias("doubled"), number.alias("same")
    )
    schema = "event_id bigint, tripled bigint, doubled bigint, same bigint"
    return jobs.run_batches(mapped, lambda batch: batch, schema).drop("batch_id")


@query("stream_empty_batch", "SELECT event_id * 3 AS tripled FROM events")
def stream_empty_batch(spark, sf_dir):
    """A batch without rows, then the events, in one resumed stream."""
    events = table(spark, sf_dir, "events").select("event_id")
    inbox, output = fresh_path(spark, "inbox"), fresh_path(spark, "batches")
    checkpoint = fresh_path(spark, "progress")
    for arriving in (events.filter(F.lit(False)), events):
        arriving.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        tripled = stream.select((F.col("event_id") * 3).alias("tripled"))
        jobs.start_batches(tripled, lambda batch: batch, output, checkpoint).awaitTermination()
    return jobs.stored_batches(spark, output, "tripled bigint").drop("batch_id")
