"""Sinks: each query writes to a fresh folder and reads back."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerleaf.catalog.evaluating import ROC_SQL, scored_lines
from ledgerleaf.catalog.labeling import ENCODED_SQL, LINE_SQL, dictionary_sql, parts_to_encode
from ledgerleaf.catalog.reading import event_cells
from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import dictionary, evaluate, features
from ledgerleaf.plans import libsvm
from ledgerleaf.scratch import fresh_path
from ledgerleaf.sinks import cells, files, tables


def _name(label):
    return f"{label}_{uuid.uuid4().hex}"


@query("sink_table_overwrite", "SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer")
def sink_table_overwrite(spark, sf_dir):
    """Replaced by other columns, then by its own rows with one changed."""
    name, customer = _name("replaced"), table(spark, sf_dir, "customer")
    tables.replace_table(customer.select("c_custkey", "c_name"), name, fresh_path(spark, "old"))
    stored = tables.replace_table(customer.select("c_custkey", "c_acctbal"), name, fresh_path(spark, "new"))
    return tables.replace_table(stored.withColumn("c_acctbal", F.col("c_acctbal") * 2), name, fresh_path(spark, "own"))


@query("sink_table_create", "SELECT c_custkey, c_name FROM customer")
def sink_table_create(spark, sf_dir):
    name, customer = _name("created"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    created = tables.create_table(customer, name, fresh_path(spark, "created"))
    try:
        tables.create_table(customer, name, fresh_path(spark, "again"))
    except AnalysisException:
        return created
    raise AssertionError("a second table of the same name was created")


@query("sink_text", "SELECT concat_ws(',', c_custkey, c_name, c_mktsegment) AS value FROM customer")
def sink_text(spark, sf_dir):
    path = fresh_path(spark, "text")
    line = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment")
    files.write_text(table(spark, sf_dir, "customer").select(line.alias("value")), path)
    return spark.read.text(path)


@query("sink_libsvm_line", ENCODED_SQL + f"SELECT {LINE_SQL} AS value FROM encoded")
def sink_libsvm_line(spark, sf_dir):
    parts = parts_to_encode(spark, sf_dir)
    fitted = dictionary.fit_dictionary(parts, ignore=["p_partkey", "target"])
    path = fresh_path(spark, "lines")
    lines = features.libsvm_table(dictionary.encode(parts, fitted), "p_partkey", "target")
    files.write_text(lines, path, "line")
    return spark.read.text(path)


@query(
    "sink_libsvm_index",
    ENCODED_SQL
    + f"""SELECT 'libsvm' AS file, {LINE_SQL} AS value FROM encoded
      UNION ALL SELECT 'index', CAST(p_partkey AS VARCHAR) FROM part
      UNION ALL SELECT 'name', unnest(['p_partkey', 'target', 'p_brand', 'p_type', 'p_name', 'p_size', 'p_retailprice'])""",
)
def sink_libsvm_index(spark, sf_dir):
    path = fresh_path(spark, "export")
    libsvm.export(parts_to_encode(spark, sf_dir), path, "p_partkey", "target")
    kinds = ("libsvm", "index", "name")
    first, *rest = [spark.read.text(f"{path}.{kind}").select(F.lit(kind).alias("file"), "value") for kind in kinds]
    return first.union(rest[0]).union(rest[1])


@query("dict_json_roundtrip", dictionary_sql("count(*) DESC, {c}"))
def dict_json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "dictionary")
    fitted = dictionary.fit_dictionary(parts_to_encode(spark, sf_dir), ignore=["p_partkey", "target"])
    files.write_text(dictionary.dictionary_lines(fitted), path)
    return spark.read.schema(dictionary.SCHEMA).json(path)


@query(
    "sink_cells_upsert",
    """SELECT CAST(user_id AS VARCHAR) AS rowkey, event_type AS family, '' AS qualifier,
       CAST(arg_max(value, event_id) AS VARCHAR) AS value, max(event_id) AS version FROM events GROUP BY 1, 2""",
)
def sink_cells_upsert(spark, sf_dir):
    """Four batches, so that the first level is merged: the even events, the odd
    ones of most types, and those of two types put over them, one batch twice,
    as a batch that runs again would."""
    everything = event_cells(spark, sf_dir)
    odd, later = F.pmod("version", F.lit(2)) == 1, F.col("family").isin("error", "click")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = cells.LevelStore(spark, _name("cells"), buckets)
    write = store.writer()
    write(everything.filter(~odd | F.col("version").isNull()), 0)
    write(everything.filter(odd & ~later), 1)
    for number in (2, 2, 3):
        write(everything.filter(odd & (F.col("family") == ("error" if number == 2 else "click"))), number)
    return store.read()


@query("sink_points_csv", ROC_SQL + "SELECT fpr, tpr FROM pts")
def sink_points_csv(spark, sf_dir):
    path = fresh_path(spark, "points")
    files.write_points(evaluate.roc_points(scored_lines(spark, sf_dir)), path, "fpr", "tpr")
    return spark.read.schema("fpr double, tpr double").csv(path)


@query("sink_partitioned_by_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def sink_partitioned_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return tables.replace_keyed_table(orders, _name("keyed"), "o_custkey", buckets, fresh_path(spark, "keyed"))
