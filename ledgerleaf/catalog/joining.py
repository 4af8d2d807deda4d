"""Joins and customer tables."""

import uuid

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import aggregates, features, joins
from ledgerleaf.operators.ordered import numbered
from ledgerleaf.plans import customers


def _orders_per_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return aggregates.count_by_key(orders, "c_custkey", "order_count")


def _solvent(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey", "c_acctbal")


@query(
    "join_fold_left",
    """SELECT c.c_custkey, c.c_mktsegment, o.order_count, t.sum_o_totalprice, t.avg_o_totalprice
       FROM customer c
       LEFT JOIN (SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey
       LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS sum_o_totalprice,
                         round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_o_totalprice
                  FROM orders GROUP BY 1) t ON c.c_custkey = t.o_custkey""",
)
def join_fold_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    tables = {
        "base": table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        "counts": _orders_per_customer(spark, sf_dir),
        "totals": aggregates.sums_and_averages(orders, "c_custkey", ["o_totalprice"], scale=2),
    }
    run = uuid.uuid4().hex
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{name}_{run}")
    names = [f"{name}_{run}" for name in ("base", "counts", "absent", "totals")]
    joined = joins.join_catalog(spark, names, "c_custkey")
    for name in tables:
        spark.catalog.dropTempView(f"{name}_{run}")
    return joined


def _typed_join(how):
    def run(spark, sf_dir):
        return joins.join_tables([_solvent(spark, sf_dir), _orders_per_customer(spark, sf_dir)], "c_custkey", how)

    sql = f"""WITH a AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0),
      b AS (SELECT o_custkey AS c_custkey, count(*) AS order_count FROM orders GROUP BY 1)
      SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.c_acctbal, b.order_count
      FROM a {how.upper()} JOIN b ON a.c_custkey = b.c_custkey"""
    query(f"join_type_{how}", sql)(run)


for _how in joins.JOIN_TYPES:
    _typed_join(_how)


@query(
    "join_label_features",
    """SELECT l.doc_id, l.quality, d.lang, d.source, d.n_chars
       FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id""",
)
def join_label_features(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.join_checked({"labels": labels, "documents": documents}, "doc_id")


@query(
    "join_repeated_keys",
    """SELECT 'lineitem' AS table_name, '{"order_key":' || l_orderkey || '}' AS key_text, count(*) AS key_count
       FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1
       UNION ALL
       SELECT 'orders', '{"order_key":' || o_orderkey || '}', count(*)
       FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1""",
)
def join_repeated_keys(spark, sf_dir):
    """What the fold join would refuse: keys that repeat in a table."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_key")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "order_key")
    return joins.repeated_keys({"lineitem": lines, "orders": orders}, "order_key")


def _enriched(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    dimension = aggregates.top_row(part, "l_partkey", ["p_name", "p_brand"])
    return joins.enrich(table(spark, sf_dir, "lineitem"), dimension, "l_partkey", drop=["p_name"])


@query(
    "join_enrich",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand, p.p_type, p.p_size, p.p_retailprice
       FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
)
def join_enrich(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "p_type", "p_size", "p_retailprice"
    )


def _mode_sql(source, key, column, value=None):
    value = value or column
    return f"""SELECT {key}, {column} FROM (
        SELECT {key}, {value} AS {column},
          row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value} ASC NULLS LAST) AS r
        FROM {source} GROUP BY {key}, {value}) WHERE r = 1"""


_MODES = ("l_returnflag", "l_linestatus", "l_linenumber", "p_brand", "p_type")
_SUMS = ("l_quantity", "l_extendedprice", "l_discount", "p_retailprice")
_ENRICHED_SQL = "(SELECT * FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"
_WIDE_MODES_SQL = (
    "SELECT * FROM "
    + " JOIN ".join(
        f"({_mode_sql(_ENRICHED_SQL, 'l_suppkey', c)}) {'USING (l_suppkey)' if i else ''}"
        for i, c in enumerate(_MODES)
    )
)
_WIDE_SUMS_SQL = (
    "SELECT l_suppkey, "
    + ", ".join(
        f"round(sum({c}), 2) AS sum_{c}, round(sum({c}), 2) / count({c}) AS avg_{c}" for c in _SUMS
    )
    + f" FROM {_ENRICHED_SQL} GROUP BY l_suppkey"
)


@query("feat_mode_wide", _WIDE_MODES_SQL)
def feat_mode_wide(spark, sf_dir):
    return aggregates.modes(_enriched(spark, sf_dir), "l_suppkey", _MODES)


@query("feat_agg_wide", _WIDE_SUMS_SQL)
def feat_agg_wide(spark, sf_dir):
    return aggregates.sums_and_averages(_enriched(spark, sf_dir), "l_suppkey", _SUMS, scale=2)


def _customer_sql(where="TRUE", prefix=""):
    modes = ("o_orderpriority", "o_orderstatus")
    source = f"(SELECT * FROM orders WHERE {where})"
    shown = ", ".join(f"{c} AS {prefix}{c}" for c in modes)
    return f"""SELECT o_custkey AS c_custkey, {shown},
        sum_o_totalprice AS {prefix}sum_o_totalprice, avg_o_totalprice AS {prefix}avg_o_totalprice
      FROM ({_mode_sql(source, 'o_custkey', modes[0])})
      JOIN ({_mode_sql(source, 'o_custkey', modes[1])}) USING (o_custkey)
      JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS sum_o_totalprice,
              round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_o_totalprice
            FROM {source} GROUP BY 1) USING (o_custkey)"""


def _customer_features(orders):
    return features.customer_features(
        orders.withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
        ["o_orderpriority", "o_orderstatus"],
        ["o_totalprice"],
        scale=2,
    )


@query(
    "feat_customer",
    f"SELECT c_custkey, f.* EXCLUDE (c_custkey) FROM customer LEFT JOIN ({_customer_sql()}) f USING (c_custkey)",
)
def feat_customer(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select("c_custkey")
    return features.assembled_base(base, "c_custkey", _customer_features(table(spark, sf_dir, "orders")))


# Orders from this day on are current, earlier ones historical.
_CUT = "1998-01-01"


_ORDER_SPEC = customers.FeatureSpec(
    key="c_custkey",
    mode_columns=["o_orderpriority", "o_orderstatus"],
    sum_columns=["o_totalprice"],
    historical_sum_columns=["o_totalprice"],
    scale=2,
)


def _order_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return customers.plain_feature_table(orders, _ORDER_SPEC, F.col("o_orderdate") >= F.lit(_CUT).cast("timestamp_ntz"))


def _assembled_sql(where, extra):
    return f"""SELECT c.c_custkey, {extra}, c.c_nationkey, f.* EXCLUDE (c_custkey), h.* EXCLUDE (c_custkey)
      FROM customer c
      LEFT JOIN ({_customer_sql(f"o_orderdate >= TIMESTAMP '{_CUT}'")}) f ON c.c_custkey = f.c_custkey
      LEFT JOIN ({_customer_sql(f"o_orderdate < TIMESTAMP '{_CUT}'", "historical__")}) h ON c.c_custkey = h.c_custkey
      WHERE {where}"""


def _customer_bases(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    train = customer.filter("c_acctbal >= 0").select("c_custkey", F.col("c_acctbal").alias("target"), "c_nationkey")
    test = customer.filter("c_acctbal < 0").select("c_custkey", "c_nationkey")
    return train, test


@query("feat_assemble_train", _assembled_sql("c.c_acctbal >= 0", "c.c_acctbal AS target"))
def feat_assemble_train(spark, sf_dir):
    train, test = _customer_bases(spark, sf_dir)
    return customers.customer_tables(train, test, _order_features(spark, sf_dir), "c_custkey", "target")[0]


@query("feat_assemble_test", _assembled_sql("c.c_acctbal < 0", "0 AS target"))
def feat_assemble_test(spark, sf_dir):
    train, test = _customer_bases(spark, sf_dir)
    return customers.customer_tables(train, test, _order_features(spark, sf_dir), "c_custkey", "target")[1]


_JOB_SPEC = customers.FeatureSpec(
    key="l_suppkey",
    mode_columns=["l_returnflag", "l_linenumber", "p_brand"],
    sum_columns=["l_quantity", "l_extendedprice", "p_retailprice"],
    historical_sum_columns=["l_quantity"],
    scale=2,
)


#: As many columns as a wide job has, of every type the lines have.
_WIDE_SPEC = customers.FeatureSpec(
    key="l_suppkey",
    mode_columns=[
        "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate", "p_brand", "p_type", "p_size",
    ],
    sum_columns=[
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "net", "taxed", "p_retailprice", "p_size",
    ],
    historical_sum_columns=["l_quantity", "l_extendedprice", "net"],
    scale=2,
)


def _job_sql(spec, where, sums, prefix):
    source = f"""(SELECT *, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS taxed
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE {where})"""
    shown = [f"{c} AS {prefix}{c}" for c in spec.mode_columns]
    shown += [f"{kind}_{c} AS {prefix}{kind}_{c}" for c in sums for kind in ("sum", "avg")]
    totals = ", ".join(
        f"round(sum(CAST({c} AS DOUBLE)), 2) AS sum_{c}, round(sum(CAST({c} AS DOUBLE)), 2) / count({c}) AS avg_{c}" for c in sums
    )
    parts = [f"({_mode_sql(source, 'l_suppkey', c)})" for c in spec.mode_columns]
    parts.append(f"(SELECT l_suppkey, {totals} FROM {source} GROUP BY 1)")
    joined = parts[0] + "".join(f" JOIN {p} USING (l_suppkey)" for p in parts[1:])
    return f"SELECT l_suppkey, {', '.join(shown)} FROM {joined}"


def _supplier_sql(spec):
    return f"""SELECT s.s_suppkey AS l_suppkey, a.* EXCLUDE (l_suppkey), b.* EXCLUDE (l_suppkey) FROM supplier s
      LEFT JOIN ({_job_sql(spec, f"l_shipdate >= TIMESTAMP '{_CUT}'", spec.sum_columns, "")}) a
        ON s.s_suppkey = a.l_suppkey
      LEFT JOIN ({_job_sql(spec, f"l_shipdate < TIMESTAMP '{_CUT}'", spec.historical_sum_columns, "historical__")}) b
        ON s.s_suppkey = b.l_suppkey"""


def _supplier_features(spark, sf_dir, spec):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").withColumns({"net": net, "taxed": net * (1 + F.col("l_tax"))})
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    recent = F.col("l_shipdate") >= F.lit(_CUT).cast("timestamp_ntz")
    made = customers.feature_table(lines, part, "l_partkey", spec, recent, drop=["p_name"])
    base = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    return features.assembled_base(base, "l_suppkey", made)


@query("job_customer_features", _supplier_sql(_JOB_SPEC))
def job_customer_features(spark, sf_dir):
    """Suppliers as customers: current and older lines, enriched by part."""
    return _supplier_features(spark, sf_dir, _JOB_SPEC)


@query("job_customer_features_wide", _supplier_sql(_WIDE_SPEC))
def job_customer_features_wide(spark, sf_dir):
    """Ten most frequent values and nine sums of either period, in the same pass."""
    return _supplier_features(spark, sf_dir, _WIDE_SPEC)


_TYPED_SQL = """(SELECT *, [l_returnflag, p_brand] AS marks, {'brand': p_brand, 'size': p_size} AS piece
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""


@query(
    "feat_mode_typed",
    f"""SELECT l_suppkey, l_shipdate, array_to_string(marks, '|') AS marks, piece.brand AS piece_brand, piece.size AS piece_size
      FROM ({_mode_sql(_TYPED_SQL, 'l_suppkey', 'l_shipdate')})
      JOIN ({_mode_sql(_TYPED_SQL, 'l_suppkey', 'marks')}) USING (l_suppkey)
      JOIN ({_mode_sql(_TYPED_SQL, 'l_suppkey', 'piece')}) USING (l_suppkey)""",
)
def feat_mode_typed(spark, sf_dir):
    """Most frequent time, list and record per supplier."""
    piece = F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    lines = _enriched(spark, sf_dir).withColumns({"marks": F.array("l_returnflag", "p_brand"), "piece": piece})
    found = aggregates.modes(lines, "l_suppkey", ["l_shipdate", "marks", "piece"])
    return found.select(
        "l_suppkey",
        "l_shipdate",
        F.array_join("marks", "|").alias("marks"),
        F.col("piece.brand").alias("piece_brand"),
        F.col("piece.size").alias("piece_size"),
    )


@query(
    "join_find_duplicates",
    """SELECT o_custkey, o_orderkey, o_totalprice, key_count FROM (
         SELECT *, count(*) OVER (PARTITION BY o_custkey) AS key_count FROM orders) WHERE key_count > 1""",
)
def join_find_duplicates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return joins.repeated_rows(orders, "o_custkey")


@query(
    "join_positional",
    """WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS line_no FROM orders),
       p AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS line_no FROM orders)
       SELECT line_no, o_orderkey || '    ' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS merged
       FROM i JOIN p USING (line_no)""",
)
def join_positional(spark, sf_dir):
    placed = numbered(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    ids = placed.select("line_no", F.col("o_orderkey").cast("string").alias("id"))
    scores = placed.select("line_no", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("pred"))
    return joins.side_by_side(ids, scores, "line_no", "id", "pred")


@query(
    "join_cross",
    """SELECT p_partkey, word, tag FROM
         (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
       JOIN (SELECT p_partkey, unnest([p_brand, p_type]) AS tag FROM part) USING (p_partkey)""",
)
def join_cross(spark, sf_dir):
    """All pairs of two lists that belong to the same part."""
    part = table(spark, sf_dir, "part")
    pairs = joins.pairs_of_lists(part, F.split("p_name", " "), F.array("p_brand", "p_type"), "word", "tag")
    return pairs.select("p_partkey", "word", "tag")


@query(
    "join_hint_broadcast",
    """SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def join_hint_broadcast(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = joins.with_strategy(table(spark, sf_dir, "customer"), nation, "c_nationkey", "broadcast")
    return aggregates.count_by_key(joined, "n_name", "customers")


@query(
    "join_hint_shuffle_hash",
    """SELECT p_brand, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def join_hint_shuffle_hash(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    joined = joins.with_strategy(table(spark, sf_dir, "lineitem"), part, "l_partkey", "shuffle_hash")
    return aggregates.count_by_key(joined, "p_brand", "lines")


@query(
    "join_hint_merge",
    """SELECT o_orderpriority, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def join_hint_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    joined = joins.with_strategy(table(spark, sf_dir, "lineitem"), orders, "l_orderkey", "merge")
    return aggregates.count_by_key(joined, "o_orderpriority", "lines")
