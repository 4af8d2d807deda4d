"""Sources. Text inputs are first written from the standard tables, with
malformed lines put in by a rule on the key."""

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerleaf.catalog.labeling import ENCODED_SQL, parts_to_encode
from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import aggregates
from ledgerleaf.plans import libsvm
from ledgerleaf.scratch import fresh_path
from ledgerleaf.sinks.files import write_text
from ledgerleaf.sinks.tables import replace_table
from ledgerleaf.sources import cells, delimited, scores, vectors

_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
_CUSTOMER_TEXT_SQL = "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _CUSTOMER) + " FROM customer"


def _customer(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(*_CUSTOMER)


@query("src_csv_typed", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_typed(spark, sf_dir):
    path = fresh_path(spark, "csv")
    _customer(spark, sf_dir).write.option("header", True).option("sep", "|").csv(path)
    return delimited.read_csv(spark, path, "|")


@query("src_csv_trim", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_trim(spark, sf_dir):
    path = fresh_path(spark, "padded")
    customer = _customer(spark, sf_dir)
    padded = customer.select(*[F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" ")).alias(c) for c in _CUSTOMER])
    writer = padded.write.option("header", True).option("quoteAll", False)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return delimited.read_csv(spark, path, schema=customer.schema, trim=True)


@query("src_text_header", _CUSTOMER_TEXT_SQL + " WHERE c_custkey % 7 <> 0")
def src_text_header(spark, sf_dir):
    """Every seventh name holds a separator, which makes its line too wide."""
    path = fresh_path(spark, "text")
    name = F.when(F.col("c_custkey") % 7 == 0, F.concat("c_name", F.lit("\t?"))).otherwise(F.col("c_name"))
    spoiled = _customer(spark, sf_dir).withColumn("c_name", name)
    # The header is in a small file of its own, the first by name.
    tab = {"sep": "\t", "quote": ""}
    spoiled.limit(0).coalesce(1).write.options(header=True, **tab).csv(f"{path}/0")
    spoiled.write.options(**tab).csv(f"{path}/1")
    return delimited.read_text_table(spark, f"{path}/*")


def _spoiled_lines(spark, sf_dir, sep):
    key = F.col("c_custkey")
    fields = [F.col(c).cast("string") for c in _CUSTOMER]
    line = (
        F.when(key % 7 == 0, F.concat_ws(sep, *fields, F.lit("extra")))
        .when(key % 11 == 0, F.concat_ws(sep, *fields[:3]))
        .otherwise(F.concat_ws(sep, *fields))
    )
    return _customer(spark, sf_dir).select(line.alias("value"))


_WELL_FORMED = " WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0"


@query("src_text_raw", _CUSTOMER_TEXT_SQL + _WELL_FORMED)
def src_text_raw(spark, sf_dir):
    path = fresh_path(spark, "rows")
    write_text(_spoiled_lines(spark, sf_dir, ","), path)
    return delimited.read_text_rows(spark, path, _CUSTOMER)


def write_header(spark, names):
    """A one-line header file."""
    path = fresh_path(spark, "header")
    write_text(spark.createDataFrame([(",".join(names),)], "value string"), path, one_file=True)
    return path


@query("src_text_split_header", _CUSTOMER_TEXT_SQL + _WELL_FORMED)
def src_text_split_header(spark, sf_dir):
    path = fresh_path(spark, "rows")
    write_text(_spoiled_lines(spark, sf_dir, "\t"), path)
    return delimited.read_text_with_header_file(spark, write_header(spark, _CUSTOMER), path)


# Fields of the packed part of a line are split by this control character.
PACK = "\x02"


def write_packed_customers(spark, sf_dir):
    """Packed customer lines: some too wide, some without a packed part."""
    key = F.col("c_custkey")
    packed = F.concat_ws(PACK, "c_nationkey", "c_acctbal", "c_mktsegment")
    line = (
        F.when(key % 7 == 0, F.concat_ws("\t", key, "c_name", F.concat_ws(PACK, packed, F.lit("extra"))))
        .when(key % 11 == 0, F.concat_ws("\t", key, "c_name"))
        .otherwise(F.concat_ws("\t", key, "c_name", packed))
    )
    path = fresh_path(spark, "packed")
    write_text(_customer(spark, sf_dir).select(line.alias("value")), path)
    return path


@query("src_quarantine_valid", _CUSTOMER_TEXT_SQL + _WELL_FORMED)
def src_quarantine_valid(spark, sf_dir):
    data, header = write_packed_customers(spark, sf_dir), write_header(spark, _CUSTOMER)
    return delimited.read_packed(spark, header, data, fresh_path(spark, "rejects"), sep=PACK)


@query(
    "src_quarantine_rejects",
    """SELECT CASE WHEN c_custkey % 7 = 0 THEN concat('invalid row size: 6, content: ',
         concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'extra'))
       ELSE concat('invalid row size: 2, content: ', concat_ws(',', c_custkey, c_name)) END AS value
       FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0""",
)
def src_quarantine_rejects(spark, sf_dir):
    data, header = write_packed_customers(spark, sf_dir), write_header(spark, _CUSTOMER)
    rejects = fresh_path(spark, "rejects")
    delimited.read_packed(spark, header, data, rejects, sep=PACK)
    return spark.read.text(rejects)


@query("src_table_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_table_scan(spark, sf_dir):
    name = f"customers_{uuid.uuid4().hex}"
    replace_table(_customer(spark, sf_dir), name, fresh_path(spark, "table"))
    return spark.sql(f"SELECT * FROM {name}")


@query("src_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def src_parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_totalprice > 250000").select("o_orderkey", "o_totalprice")


@query(
    "src_libsvm",
    ENCODED_SQL
    + """SELECT target AS label, CAST(p_brand AS DOUBLE) AS f0, CAST(p_type AS DOUBLE) AS f1,
      CAST(p_name AS DOUBLE) AS f2, p_size AS f3, p_retailprice AS f4 FROM encoded""",
)
def src_libsvm(spark, sf_dir):
    path = fresh_path(spark, "libsvm")
    lines, _ = libsvm.convert(parts_to_encode(spark, sf_dir), "p_partkey", "target")
    write_text(lines, path, "line")
    points = vectors.read_libsvm(spark, path, features=5).withColumn("_v", vector_to_array("features"))
    return points.select("label", *[F.col("_v")[i].alias(f"f{i}") for i in range(5)])


@query(
    "src_matrix_csv",
    "SELECT l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3 FROM lineitem",
)
def src_matrix_csv(spark, sf_dir):
    path = fresh_path(spark, "matrix")
    numbers = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    numbers.write.option("header", False).csv(path)
    matrix = vectors.read_matrix(spark, path, width=4).withColumn("_v", vector_to_array("features"))
    return matrix.select(*[F.col("_v")[i].alias(f"f{i}") for i in range(4)])


@query(
    "src_values",
    """SELECT v.meaning, count(*) AS lines FROM lineitem
       LEFT JOIN (VALUES ('R', 'returned'), ('A', 'accepted')) v(flag, meaning) ON l_returnflag = v.flag GROUP BY 1""",
)
def src_values(spark, sf_dir):
    meanings = spark.createDataFrame([("R", "returned"), ("A", "accepted")], "l_returnflag string, meaning string")
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag")
    return aggregates.count_by_key(lines.join(meanings, "l_returnflag", "left"), "meaning", "lines")


EVENT_FAMILIES = ("click", "error", "view")


def event_cells(spark, sf_dir):
    """Events as cells: one row per user, one family per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("rowkey"),
        F.col("event_type").alias("family"),
        F.lit("").alias("qualifier"),
        F.col("value").cast("string").alias("value"),
        F.col("event_id").alias("version"),
    )


@query(
    "src_cells_scan",
    "SELECT CAST(user_id AS VARCHAR) AS rowkey, "
    + ", ".join(
        f"CAST(arg_max(value, event_id) FILTER (event_type = '{t}') AS VARCHAR) AS \"{t}\"" for t in EVENT_FAMILIES
    )
    + " FROM events GROUP BY 1",
)
def src_cells_scan(spark, sf_dir):
    return cells.scan_cells(event_cells(spark, sf_dir), EVENT_FAMILIES)


_UNIFORM = "(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '/score/{part}'), 1, 8) AS BIGINT) + 1) / 4294967297.0"


@query(
    "src_synth_scores",
    f"""WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag = 'R' AS hit FROM lineitem),
      g AS (SELECT id, hit, sqrt(-2.0 * ln({_UNIFORM.format(part="r")})) * cos(2 * pi() * {_UNIFORM.format(part="a")}) AS z
            FROM k)
      SELECT id, round(least(greatest(z * sqrt(CASE WHEN hit THEN 0.3 ELSE 0.1 END)
               + CASE WHEN hit THEN 0.7 ELSE 0.15 END, 0.0), 1.0), 8) AS score,
             CASE WHEN hit THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM g""",
)
def src_synth_scores(spark, sf_dir):
    """One draw per order line, returned lines from the positive population."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_returnflag"
    )
    negatives, positives = scores.POPULATIONS["simulated"]
    drawn = scores.draw_scores(lines, "id", F.col("l_returnflag") == "R", negatives, positives)
    return drawn.withColumn("score", F.round("score", 8))
