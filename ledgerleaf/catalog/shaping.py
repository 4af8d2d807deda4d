"""Projections, filters and cleaning."""

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import clean, columns


@query("proj_select", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def proj_select(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("proj_exclude", "SELECT * EXCLUDE (c_name, c_mktsegment) FROM customer")
def proj_exclude(spark, sf_dir):
    return columns.without(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])


@query(
    "proj_prefix",
    """SELECT c_custkey, c_name AS historical__c_name, c_nationkey AS historical__c_nationkey,
       c_acctbal AS historical__c_acctbal, c_mktsegment AS historical__c_mktsegment FROM customer""",
)
def proj_prefix(spark, sf_dir):
    return columns.prefixed(table(spark, sf_dir, "customer"), "historical", keep=["c_custkey"])


@query(
    "proj_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority,
       CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders""",
)
def proj_cast(spark, sf_dir):
    chosen = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey")
    return columns.cast_columns(
        chosen,
        {"o_orderkey": "string", "o_totalprice": "string", "o_orderpriority": "double", "o_custkey": "double"},
    )


@query("proj_constant", "SELECT c_custkey, 0 AS target FROM customer")
def proj_constant(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").withColumn("target", F.lit(0))


@query(
    "proj_task_tag",
    """SELECT c_custkey AS id, c_acctbal AS prediction, 'm1' AS task FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, 'm2' FROM supplier
       UNION ALL SELECT p_partkey, p_retailprice, 'm3' FROM part""",
)
def proj_task_tag(spark, sf_dir):
    sources = {
        "m1": ("customer", "c_custkey", "c_acctbal"),
        "m2": ("supplier", "s_suppkey", "s_acctbal"),
        "m3": ("part", "p_partkey", "p_retailprice"),
    }
    results = {
        task: table(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(value).alias("prediction"))
        for task, (name, key, value) in sources.items()
    }
    return columns.stacked_by_task(results)


@query(
    "proj_rename_positions",
    """SELECT l_orderkey AS phone, l_partkey AS label, l_quantity AS pred_1, l_extendedprice AS pred_2,
       l_discount AS pred_3, l_tax AS pred_4 FROM lineitem""",
)
def proj_rename_positions(spark, sf_dir):
    names = {0: "phone", 1: "label", 4: "pred_1", 5: "pred_2", 6: "pred_3", 7: "pred_4"}
    return columns.at_positions(table(spark, sf_dir, "lineitem"), names)


@query(
    "filter_predicates",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IS NOT NULL AND o_orderpriority <> '' AND o_orderpriority <> '5-LOW'
         AND len(string_split(o_orderpriority, '-')) = 2 AND o_custkey > 1""",
)
def filter_predicates(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .filter(priority.isNotNull() & (priority != "") & (priority != "5-LOW"))
        .filter((F.size(F.split(priority, "-", -1)) == 2) & (F.col("o_custkey") > 1))
        .select("o_orderkey", "o_orderpriority")
    )


# Customers with missing values and sentinels put in by their key.
_DIRTY_SQL = """
WITH dirty AS (
  SELECT c_custkey,
    CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN 'NULL' WHEN 4 THEN '-9999'
      ELSE c_mktsegment END AS segment,
    CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NULL' ELSE c_name END AS name,
    CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN -9999 WHEN 2 THEN 0 ELSE c_acctbal END AS balance,
    CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN -9999 ELSE c_nationkey END AS nation
  FROM customer)
"""


def _dirty(spark, sf_dir):
    by7, by5 = F.col("c_custkey") % 7, F.col("c_custkey") % 5
    none = F.lit(None)
    segment = F.when(by7 == 0, none).when(by7 == 1, "").when(by7 == 2, "null").when(by7 == 3, "NULL")
    name = F.when(by5 == 0, none).when(by5 == 1, "").when(by5 == 2, "NULL")
    balance = F.when(by7 == 0, none).when(by7 == 1, -9999.0).when(by7 == 2, 0.0)
    nation = F.when(by5 == 0, none).when(by5 == 1, -9999)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        segment.when(by7 == 4, "-9999").otherwise(F.col("c_mktsegment")).alias("segment"),
        name.otherwise(F.col("c_name")).alias("name"),
        balance.otherwise(F.col("c_acctbal")).alias("balance"),
        nation.otherwise(F.col("c_nationkey")).alias("nation"),
    )


@query(
    "clean_empty_cols",
    _DIRTY_SQL
    + """SELECT c_custkey,
      CASE WHEN segment IS NULL OR segment IN ('', 'null', 'NULL') THEN '0.0' ELSE segment END AS segment,
      coalesce(name, '0.0') AS name,
      CASE WHEN balance IS NULL OR balance = -9999 THEN 0.0 ELSE balance END AS balance,
      coalesce(nation, 0) AS nation FROM dirty""",
)
def clean_empty_cols(spark, sf_dir):
    return clean.fill_for_labels(_dirty(spark, sf_dir), ["segment", "balance"])


@query(
    "clean_null_blank",
    _DIRTY_SQL
    + """SELECT c_custkey,
      CASE WHEN segment IS NULL OR segment IN ('null', 'NULL', '-9999') THEN '' ELSE segment END AS segment,
      CASE WHEN name IS NULL OR name IN ('null', 'NULL', '-9999') THEN '' ELSE name END AS name,
      CASE WHEN balance IS NULL OR balance = -9999 THEN 0.0 ELSE balance END AS balance,
      CASE WHEN nation IS NULL OR nation = -9999 THEN 0 ELSE nation END AS nation FROM dirty""",
)
def clean_null_blank(spark, sf_dir):
    return clean.fill_blank(_dirty(spark, sf_dir))


@query(
    "clean_null_zero",
    _DIRTY_SQL
    + """SELECT c_custkey,
      CASE WHEN segment IS NULL OR segment IN ('', 'null') THEN '0.0' ELSE segment END AS segment,
      CASE WHEN name IS NULL OR name IN ('', 'null') THEN '0.0' ELSE name END AS name,
      coalesce(balance, 0.0) AS balance, coalesce(nation, 0) AS nation FROM dirty""",
)
def clean_null_zero(spark, sf_dir):
    return clean.fill_zero(_dirty(spark, sf_dir))


@query(
    "clean_null_sentinel",
    _DIRTY_SQL
    + """SELECT c_custkey,
      CASE WHEN segment IS NULL OR segment IN ('', 'null', 'NULL') THEN '0.0'
           WHEN segment = '-9999' THEN '0' ELSE segment END AS segment,
      CASE WHEN name IS NULL OR name IN ('', 'null', 'NULL') THEN '0.0'
           WHEN name = '-9999' THEN '0' ELSE name END AS name,
      CASE WHEN balance IS NULL OR balance = -9999 THEN 0.0 ELSE balance END AS balance,
      CASE WHEN nation IS NULL OR nation = -9999 THEN 0 ELSE nation END AS nation FROM dirty""",
)
def clean_null_sentinel(spark, sf_dir):
    return clean.fill_zero_and_sentinels(_dirty(spark, sf_dir))


@query(
    "clean_zero_to_one",
    _DIRTY_SQL
    + """SELECT CASE WHEN c_custkey = 0 THEN 1 ELSE c_custkey END AS c_custkey, segment, name,
      CASE WHEN balance = 0 THEN 1.0 ELSE balance END AS balance,
      CASE WHEN nation = 0 THEN 1 ELSE nation END AS nation FROM dirty""",
)
def clean_zero_to_one(spark, sf_dir):
    return clean.zero_to_one(_dirty(spark, sf_dir))
