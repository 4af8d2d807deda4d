"""Labels, splits, dictionaries and encoded features."""

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import dictionary, features, labels
from ledgerleaf.plans import importing, libsvm
from ledgerleaf.scratch import fresh_path
from ledgerleaf.sinks import files


def _order_lines(spark, sf_dir):
    """Order lines with a key of their own, some keys and texts missing."""
    line = F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    price = F.when(F.col("l_linenumber") == 3, "").when(F.col("l_linenumber") == 4, "null")
    return table(spark, sf_dir, "lineitem").select(
        line.alias("id"),
        "l_quantity",
        price.otherwise(F.col("l_extendedprice").cast("string")).alias("price_text"),
        "l_discount",
        "l_tax",
        "l_partkey",
        "l_returnflag",
    )


_LINES_SQL = """
WITH lines AS (SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey * 10 + l_linenumber END AS id, l_quantity,
    CASE l_linenumber WHEN 3 THEN '' WHEN 4 THEN 'null' ELSE CAST(l_extendedprice AS VARCHAR) END AS price_text,
    l_discount, l_tax, l_partkey, l_returnflag FROM lineitem),
numbers AS (SELECT *, coalesce(TRY_CAST(price_text AS DOUBLE), 0.0) AS price FROM lines)
"""

# Columns a task's label is made of, with their numeric form in SQL.
_TASK_COLUMNS = {
    "m1": ("l_quantity", "l_discount"),
    "m2": ("l_quantity", "price_text", "l_discount", "l_tax"),
    "m3": ("price_text", "l_tax"),
}


def _tasks():
    return labels.standing_tasks(**_TASK_COLUMNS)


def _label_sql(task):
    numeric = [c.replace("price_text", "price") for c in _TASK_COLUMNS[task]]
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in numeric)
    terms = " + ".join(
        f"{w}::DOUBLE * CASE WHEN hi_{c} = lo_{c} THEN 0.5 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END"
        for c, w in zip(numeric, labels.TASK_WEIGHTS[task])
    )
    return f"SELECT id, {terms} AS label FROM numbers, (SELECT {ends} FROM numbers)"


@query("label_minmax_weighted", _LINES_SQL + _label_sql("m2"))
def label_minmax_weighted(spark, sf_dir):
    return labels.weighted_label(_order_lines(spark, sf_dir), "id", _tasks()["m2"])


@query(
    "label_multi_task",
    _LINES_SQL + " UNION ALL ".join(f"SELECT *, '{t}' AS task FROM ({_label_sql(t)})" for t in _TASK_COLUMNS),
)
def label_multi_task(spark, sf_dir):
    return labels.stacked_labels(_order_lines(spark, sf_dir), "id", _tasks())


@query(
    "label_one_vs_rest",
    """SELECT CAST(k AS INTEGER) AS class, vec_id, CASE WHEN label = k THEN '1' ELSE '0' END AS class_label
       FROM embeddings, (SELECT unnest(generate_series(1, 9)) AS k)""",
)
def label_one_vs_rest(spark, sf_dir):
    return labels.label_per_class(table(spark, sf_dir, "embeddings"), "vec_id", "label", 9)


def split_sql(key, shares, salt=""):
    """The part of a key as SQL; ``shares`` maps names to shares."""
    bucket = f"CAST('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '') || '{salt}'), 1, 8) AS BIGINT)"
    *firsts, last = shares
    bounds = labels.split_bounds(list(shares.values()))
    cases = " ".join(f"WHEN {bucket} < {bound} THEN '{name}'" for name, bound in zip(firsts, bounds))
    return f"CASE {cases} ELSE '{last}' END"


_STANDING = dict(zip(("train", "valid", "test"), labels.TRAIN_VALID_TEST))
# One part is half a percent of the rows.
_UNEVEN = {"train": 0.7, "valid": 0.295, "rest": 0.005}


@query(
    "split_hash",
    f"""SELECT key, c_acctbal, {split_sql('key', _STANDING)} AS split, {split_sql('key', _UNEVEN)} AS uneven
    FROM (SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS key, c_acctbal FROM customer)""",
)
def split_hash(spark, sf_dir):
    key = F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey"))
    customer = table(spark, sf_dir, "customer").select(key.alias("key"), "c_acctbal")
    return labels.split_by_hash(labels.split_by_hash(customer, "key", _STANDING), "key", _UNEVEN, "uneven")


@query(
    "split_random",
    f"SELECT c_custkey, {split_sql('c_custkey', dict(zip(('train', 'test'), labels.TRAIN_TEST)), '/1234')} AS part FROM customer",
)
def split_random(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    train, test = labels.split_at_random(customer, "c_custkey", labels.TRAIN_TEST, seed=1234)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _train_sql():
    parts = []
    for task, used in _TASK_COLUMNS.items():
        kept = [c if c not in used else f"NULL AS {c}" for c in ("l_quantity", "price_text", "l_discount", "l_tax")]
        parts.append(f"SELECT '{task}_' || part AS table_name, id, l_partkey, l_returnflag, {', '.join(kept)}, NULL::DOUBLE AS label FROM split")
        parts.append(f"SELECT '{task}_label', id, NULL, NULL, NULL, NULL, NULL, NULL, label FROM ({_label_sql(task)})")
    return " UNION ALL ".join(parts)


def _stacked(tables):
    tagged = [df.withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(lambda top, one: top.unionByName(one, allowMissingColumns=True), tagged)


@query("job_train_tables", _LINES_SQL + f", split AS (SELECT *, {split_sql('id', _STANDING)} AS part FROM lines) " + _train_sql())
def job_train_tables(spark, sf_dir):
    """All three tasks."""
    return _stacked(importing.train_tables(_order_lines(spark, sf_dir), "id", _tasks()))


@query(
    "job_train_tables_full_test",
    _LINES_SQL
    + f""", split AS (SELECT *, {split_sql('id', _STANDING)} AS part FROM lines)
    SELECT 'm2_' || part AS table_name, id, l_partkey, l_returnflag, NULL::DOUBLE AS label FROM split WHERE part <> 'test'
    UNION ALL SELECT 'm2_test', id, l_partkey, l_returnflag, NULL FROM lines
    UNION ALL SELECT 'm2_label', id, NULL, NULL, label FROM ({_label_sql("m2")})""",
)
def job_train_tables_full_test(spark, sf_dir):
    """The test table is the whole table."""
    return _stacked(importing.train_tables(_order_lines(spark, sf_dir), "id", {"m2": _tasks()["m2"]}, test_is_full=True))


@query(
    "job_predict_tables",
    _LINES_SQL
    + """SELECT 'm1_test' AS table_name, id, l_partkey, l_returnflag, price_text, l_tax, NULL::DOUBLE AS l_quantity,
           NULL::DOUBLE AS l_discount FROM lines
         UNION ALL SELECT 'm2_test', id, l_partkey, l_returnflag, NULL, NULL, NULL, NULL FROM lines
         UNION ALL SELECT 'm3_test', id, l_partkey, l_returnflag, NULL, NULL, l_quantity, l_discount FROM lines""",
)
def job_predict_tables(spark, sf_dir):
    return _stacked(importing.predict_tables(_order_lines(spark, sf_dir), _tasks()))


def parts_to_encode(spark, sf_dir):
    """Parts as a training table: key, label, then features."""
    target = F.when(F.col("p_size") > 25, 1.0).otherwise(0.0)
    return table(spark, sf_dir, "part").select(
        "p_partkey", target.alias("target"), "p_brand", "p_type", "p_name", "p_size", "p_retailprice"
    )


_TEXTS = ("p_brand", "p_type", "p_name")


def _ranks_sql(order, limit=None):
    within = "" if limit is None else f" WHERE number <= {limit}"
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS field, label, number FROM (SELECT {c} AS label,
          CAST(row_number() OVER (ORDER BY {order.format(c=c)}) AS INTEGER) AS number FROM part
          WHERE {c} IS NOT NULL GROUP BY {c}){within}"""
        for c in _TEXTS
    )


def dictionary_sql(order, limit=None):
    return f"""WITH ranks AS ({_ranks_sql(order, limit)}),
      fields(key, fieldType, fieldName) AS (VALUES (0, 'NONE', 'p_partkey'), (0, 'NONE', 'target'),
        (1, 'STRING', 'p_brand'), (2, 'STRING', 'p_type'), (3, 'STRING', 'p_name'), (4, 'DOUBLE', 'p_size'),
        (5, 'DOUBLE', 'p_retailprice'))
      SELECT f.key, f.fieldType, f.fieldName, r.label, r.number FROM fields f LEFT JOIN ranks r ON f.fieldName = r.field"""


@query("feat_dictionary", dictionary_sql("count(*) DESC, {c}"))
def feat_dictionary(spark, sf_dir):
    return dictionary.fit_dictionary(parts_to_encode(spark, sf_dir), ignore=["p_partkey", "target"])


# Fewer than the labels of p_brand and p_name.
_SHORT = 20


@query("feat_dictionary_top", dictionary_sql("count(*) DESC, {c}", _SHORT))
def feat_dictionary_top(spark, sf_dir):
    """The most frequent labels only; the usual limit is ``TOP_LABELS``."""
    parts = parts_to_encode(spark, sf_dir)
    fitted = dictionary.fit_dictionary(parts, ignore=["p_partkey", "target"], limit=_SHORT)
    maps = dictionary.label_maps(fitted)
    return maps.select("key", "fieldType", "fieldName", F.explode_outer("fieldMap").alias("label", "number"))


@query("feat_dictionary_distinct", dictionary_sql("{c}"))
def feat_dictionary_distinct(spark, sf_dir):
    return dictionary.fit_dictionary(parts_to_encode(spark, sf_dir), ignore=["p_partkey", "target"], by="value")


def _encode_sql(source, values):
    joins = "".join(
        f" LEFT JOIN ranks r{i} ON r{i}.field = '{c}' AND r{i}.label = {values[c]}" for i, c in enumerate(_TEXTS)
    )
    numbers = ", ".join(f"coalesce(r{i}.number, 0) AS {c}" for i, c in enumerate(_TEXTS))
    return f"SELECT p.p_partkey, target, {numbers}, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM {source} p{joins}"


_TARGET_SQL = "(SELECT *, CASE WHEN p_size > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target FROM part)"
_PLAIN = {c: f"p.{c}" for c in _TEXTS}
ENCODED_SQL = f"WITH ranks AS ({_ranks_sql('count(*) DESC, {c}')}), " + f"encoded AS ({_encode_sql(_TARGET_SQL, _PLAIN)}) "


@query("feat_encode", ENCODED_SQL + "SELECT * FROM encoded")
def feat_encode(spark, sf_dir):
    parts = parts_to_encode(spark, sf_dir)
    return dictionary.encode(parts, dictionary.fit_dictionary(parts, ignore=["p_partkey", "target"]), fill=True)


# Later data has brands the training table has never seen.
_SHIFTED = {**_PLAIN, "p_brand": "CASE WHEN p.p_size % 2 = 0 THEN p.p_brand || '*' ELSE p.p_brand END"}


@query(
    "feat_encode_predict",
    f"WITH ranks AS ({_ranks_sql('count(*) DESC, {c}')}) {_encode_sql(_TARGET_SQL, _SHIFTED)}",
)
def feat_encode_predict(spark, sf_dir):
    parts = parts_to_encode(spark, sf_dir)
    path = fresh_path(spark, "dictionary")
    fitted = dictionary.fit_dictionary(parts, ignore=["p_partkey", "target"])
    files.write_text(dictionary.dictionary_lines(fitted), path)
    stored = spark.read.schema(dictionary.SCHEMA).json(path)
    brand = F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit("*"))).otherwise(F.col("p_brand"))
    return dictionary.encode(parts.withColumn("p_brand", brand), stored)


def _vector_columns(df, width, *keep):
    return df.withColumn("_v", vector_to_array("features")).select(
        *keep, *[F.col("_v")[i].alias(f"f{i}") for i in range(width)]
    )


@query(
    "feat_assemble",
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1 FROM part",
)
def feat_assemble(spark, sf_dir):
    texts = table(spark, sf_dir, "part").withColumn("price_text", F.col("p_retailprice").cast("string"))
    return _vector_columns(features.assembled(texts, ["p_size", "price_text"]), 2, "p_partkey")


@query(
    "feat_labeled_point",
    "SELECT l_quantity AS label, l_extendedprice AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
)
def feat_labeled_point(spark, sf_dir):
    numbers = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return _vector_columns(features.labeled_points(numbers), 3, "label")


LINE_SQL = """concat_ws(' ', CAST(target AS VARCHAR),
  CASE WHEN p_brand <> 0 THEN '1:' || p_brand END, CASE WHEN p_type <> 0 THEN '2:' || p_type END,
  CASE WHEN p_name <> 0 THEN '3:' || p_name END, CASE WHEN p_size <> 0 THEN '4:' || CAST(p_size AS VARCHAR) END,
  CASE WHEN p_retailprice <> 0 THEN '5:' || CAST(p_retailprice AS VARCHAR) END)"""


@query("job_libsvm", ENCODED_SQL + f"SELECT p_partkey, {LINE_SQL} AS line FROM encoded")
def job_libsvm(spark, sf_dir):
    """Train once, then encode with the stored dictionary."""
    parts = parts_to_encode(spark, sf_dir)
    fitted = libsvm.fit(parts, "p_partkey", "target")
    return libsvm.convert(parts, "p_partkey", "target", fitted)[0]
