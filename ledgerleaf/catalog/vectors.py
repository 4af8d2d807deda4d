"""Vectors and matrices over the embeddings."""

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.functions import arrays
from ledgerleaf.operators import matrix
from ledgerleaf.scratch import materialize


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"), "label"
    )


_V_SQL = "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings) "


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array("l_quantity", "l_discount", "l_tax").alias("v")
    )


@query(
    "vec_weighted_sum",
    "SELECT l_orderkey, l_linenumber, round(0.3 * l_quantity + 0.3 * l_discount + 0.4 * l_tax, 9) AS total FROM lineitem",
)
def vec_weighted_sum(spark, sf_dir):
    total = F.round(arrays.weighted_sum(F.col("v"), (0.3, 0.3, 0.4)), 9)
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", total.alias("total"))


@query(
    "vec_dot",
    _V_SQL + "SELECT vec_id, round(list_dot_product(v, list_reverse(v)), 9) AS dot FROM e",
)
def vec_dot(spark, sf_dir):
    value = F.round(arrays.dot(F.col("v"), F.reverse("v")), 9)
    return _vectors(spark, sf_dir).select("vec_id", value.alias("dot"))


@query(
    "vec_hadamard",
    _V_SQL + """SELECT vec_id, CAST(unnest(generate_series(1, len(v))) AS INTEGER) - 1 AS i,
      unnest(list_transform(list_zip(v, list_reverse(v)), lambda p: p[1] * p[2])) AS x FROM e""",
)
def vec_hadamard(spark, sf_dir):
    product = arrays.hadamard(F.col("v"), F.reverse("v"))
    return _vectors(spark, sf_dir).select("vec_id", F.posexplode(product).alias("i", "x"))


@query("vec_argmax", _V_SQL + "SELECT vec_id, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS best FROM e")
def vec_argmax(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", arrays.argmax(F.col("v")).alias("best"))


@query(
    "vec_outer",
    """SELECT l_orderkey, l_linenumber, i, j, x * y AS value FROM
      (SELECT *, unnest([0, 1]) AS i, unnest([l_quantity, l_tax]) AS x FROM lineitem),
      LATERAL (SELECT unnest([0, 1]) AS j, unnest([l_extendedprice, l_discount]) AS y)""",
)
def vec_outer(spark, sf_dir):
    product = arrays.outer(F.array("l_quantity", "l_tax"), F.array("l_extendedprice", "l_discount"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.posexplode(product).alias("i", "_row")
    )
    return rows.select("l_orderkey", "l_linenumber", "i", F.posexplode("_row").alias("j", "value"))


@query(
    "mat_multiply",
    _V_SQL
    + """, cells AS (SELECT vec_id, label, unnest(generate_series(1, len(v))) AS j, unnest(v) AS x FROM e),
      b AS (SELECT label, j, avg(x) AS x FROM cells GROUP BY 1, 2)
      SELECT a.vec_id, b.label, round(sum(a.x * b.x), 8) AS value FROM cells a JOIN b ON a.j = b.j GROUP BY 1, 2""",
)
def mat_multiply(spark, sf_dir):
    """All embeddings times the matrix of class means."""
    rows = _vectors(spark, sf_dir)
    cells = rows.select("label", F.posexplode("v").alias("j", "x"))
    means = cells.groupBy("label", "j").agg(F.avg("x").alias("x"))
    columns = means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("j", "x"))), lambda cell: cell["x"]).alias("v")
    )
    product = matrix.multiply(rows.select("vec_id", "v"), columns, row="vec_id", column="label", vector="v")
    return product.withColumn("value", F.round("value", 8))


@query(
    "mat_multiply_blocks",
    _V_SQL
    + """, cells AS (SELECT vec_id, unnest(generate_series(1, len(v))) AS j, unnest(v) AS x FROM e),
      pairs AS (SELECT label, unnest(generate_series(1, len(v))) AS i, v FROM e),
      gram AS (SELECT i, unnest(generate_series(1, len(v))) AS j, unnest(list_transform(v, lambda x: x * v[i])) AS x FROM pairs),
      b AS (SELECT i, j, sum(x) AS x FROM gram GROUP BY 1, 2)
      SELECT a.vec_id, CAST(b.i - 1 AS BIGINT) AS i, round(sum(a.x * b.x), 5) AS value
      FROM cells a JOIN b ON a.j = b.j GROUP BY 1, 2""",
)
def mat_multiply_blocks(spark, sf_dir):
    """All embeddings times the sums of products of their columns, a right
    matrix of many blocks: none of either matrix is broadcast."""
    rows = _vectors(spark, sf_dir)
    width = rows.agg(F.max(F.size("v"))).first()[0]
    square = materialize(matrix.gram(rows, "v", width), "gram")
    product = matrix.multiply(rows, square, row="vec_id", column="i", vector="v", held_cells=0, inner=24, columns=16)
    return product.withColumn("value", F.round("value", 5))


@query("mat_column", _V_SQL + "SELECT vec_id, v[2] * 5.0 AS value FROM e")
def mat_column(spark, sf_dir):
    return matrix.column_of(_vectors(spark, sf_dir), "vec_id", "v", position=1, factor=5.0)
