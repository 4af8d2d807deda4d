"""Aggregates, windows, sorts, limits and set operations."""

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import aggregates, sets, statistics
from ledgerleaf.operators.ordered import numbered
from ledgerleaf.scratch import fresh_path


def mean_text_sql(column):
    """The mean of two-digit numbers, rounded half up to six digits in whole
    numbers, as text."""
    cents, rows = f"CAST(round(sum({column}) * 100) AS HUGEINT)", f"count({column})"
    return f"CAST(CAST((2 * {cents} * 10000 + {rows}) // (2 * {rows}) AS DOUBLE) / 1000000 AS VARCHAR)"


def _history_sql(keys):
    means = {"l_extendedprice": "avg_prefr_amount", "l_quantity": "avg_pay_amount"}
    shown = ", ".join(
        f"{mean_text_sql(c)} AS {name}" for c, name in means.items()
    )
    return f"SELECT {keys}, CAST(count(*) AS VARCHAR) AS count_id, {shown} FROM lineitem GROUP BY {keys}"


_AVERAGES = {"l_extendedprice": "avg_prefr_amount", "l_quantity": "avg_pay_amount"}


@query("agg_history", _history_sql("l_orderkey, l_returnflag"))
def agg_history(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return aggregates.history(lines, ["l_orderkey", "l_returnflag"], _AVERAGES, scale=2)


@query("agg_order_summary", _history_sql("l_partkey"))
def agg_order_summary(spark, sf_dir):
    return aggregates.history(table(spark, sf_dir, "lineitem"), ["l_partkey"], _AVERAGES, scale=2)


@query(
    "agg_sum_avg",
    """SELECT o_custkey, round(sum(o_totalprice), 2) AS sum_o_totalprice,
         round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_o_totalprice FROM orders GROUP BY 1""",
)
def agg_sum_avg(spark, sf_dir):
    return aggregates.sums_and_averages(table(spark, sf_dir, "orders"), "o_custkey", ["o_totalprice"], scale=2)


@query(
    "agg_mode",
    """SELECT o_custkey, o_orderpriority FROM (
         SELECT o_custkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority NULLS LAST) AS r
         FROM orders GROUP BY 1, 2) WHERE r = 1""",
)
def agg_mode(spark, sf_dir):
    return aggregates.mode(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query("agg_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query(
    "agg_dedup_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders)
       WHERE r = 1""",
)
def agg_dedup_key(spark, sf_dir):
    latest = aggregates.top_row(table(spark, sf_dir, "orders"), "o_custkey", [F.desc("o_orderdate"), "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@query("agg_count_key", "SELECT o_custkey, count(*) AS key_count FROM orders GROUP BY 1")
def agg_count_key(spark, sf_dir):
    return aggregates.count_by_key(table(spark, sf_dir, "orders"), "o_custkey")


_EVENT_TYPES_SQL = ", ".join(
    f"coalesce(max(CAST(value AS VARCHAR)) FILTER (event_type = '{t}'), '') AS \"{t}\""
    for t in ("click", "error", "purchase", "signup", "view")
)


@query("agg_pivot_tags", f"SELECT user_id, {_EVENT_TYPES_SQL} FROM events GROUP BY 1")
def agg_pivot_tags(spark, sf_dir):
    return aggregates.tags_to_columns(table(spark, sf_dir, "events"), "user_id", "event_type", "value")


def _statistics_sql(columns, weight):
    """The textbook formulas, column by column."""
    selects = []
    for c in columns:
        selects.append(
            f"""SELECT '{c}' AS "column", round(wx / w, 8) AS mean,
            round((wxx - wx * wx / w) / (w - ww / w), 8) AS variance, n AS "count", nnz AS num_nonzeros,
            hi AS "max", lo AS "min", round(l1, 8) AS norm_l1, round(sqrt(wxx), 8) AS norm_l2
            FROM (SELECT sum({weight}) AS w, sum({weight} * {weight}) AS ww, sum({weight} * {c}) AS wx,
                sum({weight} * {c} * {c}) AS wxx, count(*) AS n, count(*) FILTER ({c} <> 0) AS nnz,
                max({c}) AS hi, min({c}) AS lo, sum({weight} * abs({c})) AS l1
              FROM lineitem WHERE {weight} > 0)"""
        )
    return " UNION ALL ".join(selects)


_STATISTICS = ("l_quantity", "l_discount", "l_tax")


@query("agg_summary", _statistics_sql(_STATISTICS, "1.0::DOUBLE"))
def agg_summary(spark, sf_dir):
    return aggregates.column_statistics(table(spark, sf_dir, "lineitem"), _STATISTICS, scale=8)


@query("agg_summary_weighted", _statistics_sql(_STATISTICS, "l_linenumber::DOUBLE"))
def agg_summary_weighted(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return aggregates.column_statistics(lines, _STATISTICS, weight="l_linenumber", scale=8)


@query("agg_summary_stored", _statistics_sql(_STATISTICS, "l_linenumber::DOUBLE"))
def agg_summary_stored(spark, sf_dir):
    """Partial statistics stored by year, a year at a time in the one pass over
    it, merged when they are read."""
    lines = table(spark, sf_dir, "lineitem").withColumn("part", F.coalesce(F.year("l_shipdate"), F.lit(0)))
    store = fresh_path(spark, "statistics")
    partials = statistics.partial_statistics(lines, _STATISTICS, "l_linenumber", by=["part"])
    partials.write.partitionBy("part").parquet(store)
    return statistics.stored_statistics(spark, store, scale=8)


@query("agg_observe_counter", "SELECT count(*) AS rows, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem")
def agg_observe_counter(spark, sf_dir):
    lines = table(spark.newSession(), sf_dir, "lineitem").select("l_linenumber")
    counted, seen = aggregates.counted_beside(lines, "line counter", F.col("l_linenumber"))
    counted.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], seen.get["total"])], "rows bigint, total bigint")


@query("agg_count", "SELECT count(*) AS rows FROM lineitem")
def agg_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "agg_mean_var_std",
    """SELECT round(avg(l_quantity), 8) AS mean, round(var_samp(l_quantity), 8) AS variance,
         round(stddev_samp(l_quantity), 8) AS deviation FROM lineitem""",
)
def agg_mean_var_std(spark, sf_dir):
    return aggregates.mean_variance_deviation(table(spark, sf_dir, "lineitem"), "l_quantity", scale=8)


@query(
    "agg_collect_list",
    """SELECT o_custkey, o_orderkey // 1000 AS chunk, string_agg(o_orderpriority, ',' ORDER BY o_orderkey) AS priorities
       FROM orders GROUP BY 1, 2""",
)
def agg_collect_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    pieces = aggregates.collected_in_chunks(
        orders, "o_custkey", "o_orderkey", F.col("o_orderpriority"), width=1000, name="priorities"
    )
    return pieces.withColumn("priorities", F.array_join("priorities", ","))


@query(
    "win_top1",
    """SELECT l_suppkey, l_returnflag, n FROM (
         SELECT l_suppkey, l_returnflag, count(*) AS n,
           row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS r
         FROM lineitem GROUP BY 1, 2) WHERE r = 1""",
)
def win_top1(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.top_row(counts, "l_suppkey", [F.desc("n"), "l_returnflag"])


@query(
    "sort_composite",
    """SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS position, o_orderpriority, o_orderkey
       FROM orders""",
)
def sort_composite(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    return numbered(orders, ["o_orderpriority", "o_orderkey"], name="position")


@query("limit_distinct", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY 1 LIMIT 100")
def limit_distinct(spark, sf_dir):
    return sets.first_distinct(table(spark, sf_dir, "part"), "p_brand", 100)


@query("limit_take", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_take(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


def _nation_keys(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return customer, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))


@query("set_union", "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def set_union(spark, sf_dir):
    return sets.union(*_nation_keys(spark, sf_dir))


@query("set_intersect", "SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf_dir):
    return sets.intersection(*_nation_keys(spark, sf_dir))


@query(
    "set_subtract",
    """SELECT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def set_subtract(spark, sf_dir):
    indebted = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return sets.subtract(table(spark, sf_dir, "orders").select("o_custkey"), indebted)
