"""String, time, number, map and JSON functions."""

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.functions import maps, numbers, text, times
from ledgerleaf.operators import words
from ledgerleaf.scratch import fresh_path
from ledgerleaf.sinks.files import write_text

# Twenty common words of the provided texts.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with his they at be this"
).split()


def _spoiled_dates(spark, sf_dir):
    key = F.col("o_orderkey")
    shown = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    start = F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, "unknown").when(key % 5 == 2, "").otherwise(shown)
    return table(spark, sf_dir, "orders").select("o_orderkey", start.alias("start"))


_SPOILED_SQL = """WITH d AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'unknown'
    WHEN 2 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS start FROM orders) """


@query(
    "fn_slot30",
    _SPOILED_SQL
    + """SELECT o_orderkey, start, CAST((CAST(epoch(TIMESTAMP '2018-09-01 00:00:00') AS BIGINT)
      - coalesce(CAST(epoch(TRY_CAST(start AS TIMESTAMP)) AS BIGINT), 0)) // 2592000 AS INTEGER) AS stamp FROM d""",
)
def fn_slot30(spark, sf_dir):
    return _spoiled_dates(spark, sf_dir).withColumn("stamp", times.slot30(F.col("start")))


@query(
    "fn_epoch_millis",
    _SPOILED_SQL
    + """SELECT o_orderkey, CAST(epoch(TRY_CAST(start AS TIMESTAMP)) AS BIGINT) * 1000 AS millis,
      coalesce(CAST(epoch(TRY_CAST(start AS TIMESTAMP)) AS BIGINT) * 1000, 0) AS millis_or_zero FROM d""",
)
def fn_epoch_millis(spark, sf_dir):
    start = F.col("start")
    return _spoiled_dates(spark, sf_dir).select(
        "o_orderkey",
        times.epoch_millis(start).alias("millis"),
        times.epoch_millis(start, default=0).alias("millis_or_zero"),
    )


@query("fn_epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def fn_epoch_seconds(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.epoch_seconds(F.col("ts")).alias("seconds"))


@query(
    "fn_to_double",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS from_number,
      CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice END AS from_text FROM part""",
)
def fn_to_double(spark, sf_dir):
    mixed = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        numbers.to_double(F.col("p_size"), strict=True).alias("from_number"),
        numbers.to_double(mixed).alias("from_text"),
    )


@query(
    "fn_digit_flags",
    r"""WITH w AS (SELECT doc_id AS id, text FROM documents UNION ALL
        SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END FROM part
        UNION ALL SELECT n_nationkey, '' FROM nation)
      SELECT id, regexp_matches(text, '\p{Nd}') AS has_digit, regexp_full_match(text, '\p{Nd}*') AS all_digits FROM w""",
)
def fn_digit_flags(spark, sf_dir):
    size = F.col("p_size")
    named = F.when(size % 2 == 0, F.col("p_brand")).otherwise(size.cast("string"))
    texts = (
        table(spark, sf_dir, "documents")
        .select(F.col("doc_id").alias("id"), "text")
        .union(table(spark, sf_dir, "part").select("p_partkey", named))
        .union(table(spark, sf_dir, "nation").select("n_nationkey", F.lit("")))
    )
    return texts.select(
        "id", text.has_digit(F.col("text")).alias("has_digit"), text.all_digits(F.col("text")).alias("all_digits")
    )


# Trailing separators do not count as words.
WORDS_SQL = """CASE WHEN {t} <> '' AND regexp_replace({t}, '{s}+$', '') = '' THEN CAST([] AS VARCHAR[])
   ELSE string_split(regexp_replace({t}, '{s}+$', ''), '{raw}') END"""
_BARRED_SQL = WORDS_SQL.format(t="replace(text, ' ', '|')", s="\\|", raw="|")


def _barred(spark, sf_dir):
    """Documents with their words joined by a vertical bar."""
    return table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit(" "), F.lit("|")).alias("fact"))


# A list of the usual stop words and of 12,000 others.
_MORE_STOP_WORDS = 12_000


@query(
    "fn_stopwords",
    f"""WITH stops AS (SELECT unnest([{", ".join(f"'{w}'" for w in STOP_WORDS)}]) AS w
        UNION SELECT 'w' || unnest(generate_series(1, {_MORE_STOP_WORDS}))),
      rows AS (SELECT row_number() OVER () AS n, k, text FROM (SELECT doc_id % 50 AS k, text FROM documents
        UNION ALL SELECT NULL, text FROM documents WHERE doc_id % 9 = 0)),
      split AS (SELECT n, {_BARRED_SQL} AS ws FROM rows),
      words AS (SELECT n, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS place FROM split),
      lines AS (SELECT n, string_agg(w, '|' ORDER BY place) AS line FROM words
        WHERE w NOT IN (SELECT w FROM stops) AND NOT regexp_matches(w, '\\p{{Nd}}') GROUP BY n)
      SELECT k, coalesce(line, '') AS words FROM rows LEFT JOIN lines USING (n)""",
)
def fn_stopwords(spark, sf_dir):
    """A long list from a file; keys repeat and some are missing."""
    path = fresh_path(spark, "stop-words")
    usual = spark.createDataFrame([(word,) for word in STOP_WORDS], "value string")
    more = spark.range(1, _MORE_STOP_WORDS + 1).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("value"))
    write_text(usual.union(more), path)
    texts = _barred(spark, sf_dir)
    keyed = texts.select((F.col("doc_id") % 50).alias("k"), "fact")
    missing = texts.filter("doc_id % 9 = 0").select(F.lit(None).cast("bigint").alias("k"), "fact")
    return words.remove_stop_words(keyed.union(missing), "fact", spark.read.text(path)).drop("fact")


@query(
    "fn_trim_digit_words",
    f"""SELECT doc_id, array_to_string(list_filter({_BARRED_SQL},
        lambda w: NOT regexp_matches(w, '\\p{{Nd}}')), ' ') AS words FROM documents""",
)
def fn_trim_digit_words(spark, sf_dir):
    kept = text.drop_digit_words(text.split_words(F.col("fact"), "|"))
    return _barred(spark, sf_dir).select("doc_id", F.array_join(kept, " ").alias("words"))


@query(
    "fn_tokenize",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({WORDS_SQL.format(t="text", s=" ", raw=" ")}) AS word
      FROM documents) GROUP BY 1""",
)
def fn_tokenize(spark, sf_dir):
    return words.word_counts(table(spark, sf_dir, "documents"), "text")


@query(
    "fn_round_half_up",
    """SELECT DISTINCT CAST(round(CAST(l_extendedprice / 1000 AS DECIMAL(18, 8)), 2) AS DOUBLE) AS x,
      CAST(round(CAST(l_linenumber * 5 / 1000.0 AS DECIMAL(18, 8)), 2) AS DOUBLE) AS y FROM lineitem""",
)
def fn_round_half_up(spark, sf_dir):
    x = numbers.round_half_up(F.col("l_extendedprice") / 1000, 2)
    y = numbers.round_half_up(F.col("l_linenumber") * 5 / 1000, 2)
    return table(spark, sf_dir, "lineitem").select(x.alias("x"), y.alias("y")).distinct()


@query(
    "fn_clamp",
    "SELECT c_custkey, least(greatest(c_acctbal / 5000, 0.0), 1.0) AS score FROM customer",
)
def fn_clamp(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.clamp(F.col("c_acctbal") / 5000).alias("score"))


@query(
    "fn_to_json",
    """SELECT p_partkey, CAST(json_object('key', p_partkey, 'name', p_name, 'size', p_size) AS VARCHAR) AS body
       FROM part""",
)
def fn_to_json(spark, sf_dir):
    body = maps.json_text(key=F.col("p_partkey"), name=F.col("p_name"), size=F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", body.alias("body"))


@query(
    "fn_map_lookup",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
       ELSE 0 END AS number FROM orders""",
)
def fn_map_lookup(spark, sf_dir):
    labels = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    number = maps.label_number(F.col("o_orderpriority"), labels)
    return table(spark, sf_dir, "orders").select("o_orderkey", number.alias("number"))


@query(
    "fn_cartesian",
    """SELECT p_partkey, a || ',' || b || ',' || c AS combination FROM
      (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS a FROM part)
      JOIN (SELECT p_partkey, unnest([p_brand, p_type]) AS b FROM part) USING (p_partkey)
      JOIN (SELECT p_partkey, unnest([CAST(p_size AS VARCHAR), 'x']) AS c FROM part) USING (p_partkey)""",
)
def fn_cartesian(spark, sf_dir):
    lists = F.concat_ws(
        "|",
        F.replace("p_name", F.lit(" "), F.lit(",")),
        F.concat_ws(",", "p_brand", "p_type"),
        F.concat_ws(",", F.col("p_size").cast("string"), F.lit("x")),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", lists.alias("lists"))
    combined = words.list_combinations(parts, "lists", "c")
    return combined.select("p_partkey", F.array_join("c", ",").alias("combination"))


@query(
    "fn_arith",
    "SELECT c_custkey, c_acctbal * 3 AS tripled, abs(c_acctbal) AS magnitude FROM customer",
)
def fn_arith(spark, sf_dir):
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (balance * 3).alias("tripled"), F.abs(balance).alias("magnitude")
    )
