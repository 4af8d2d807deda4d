"""Import jobs on files written from the standard tables."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ledgerleaf.catalog.grouping import mean_text_sql
from ledgerleaf.catalog.labeling import split_sql
from ledgerleaf.catalog.reading import PACK, write_header
from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import labels
from ledgerleaf.operators.labels import LabelTask
from ledgerleaf.plans import importing
from ledgerleaf.scratch import fresh_path
from ledgerleaf.sinks.files import write_text

_ORDER_COLUMNS = ("id", "user_id", "before_amount", "paid_amount")
_INFO_COLUMNS = ("id", "user_id", "nation", "balance", "segment")
_AVERAGES = {"before_amount": "avg_prefr_amount", "paid_amount": "avg_pay_amount"}


# Columns a task's label is made of.
_TASK_COLUMNS = {
    "m1": ("avg_prefr_amount", "balance"),
    "m2": ("avg_prefr_amount", "avg_pay_amount", "balance", "count_id"),
    "m3": ("avg_pay_amount", "count_id"),
}


def _job(spark, sf_dir):
    """Order lines as tab-separated text and customers as packed text, every
    seventh customer line too wide."""
    run = uuid.uuid4().hex
    orders, info = fresh_path(spark, "orders"), fresh_path(spark, "customers")
    line = F.concat_ws(
        "\t", "o_custkey", F.concat(F.lit("U"), "o_custkey"), "o_totalprice", F.substring("o_orderpriority", 1, 1)
    )
    write_text(table(spark, sf_dir, "orders").select(line.alias("value")), orders)
    key = F.col("c_custkey")
    packed = F.concat_ws(PACK, "c_nationkey", "c_acctbal", "c_mktsegment")
    wide = F.when(key % 7 == 0, F.concat_ws(PACK, packed, F.lit("extra"))).otherwise(packed)
    customers = table(spark, sf_dir, "customer").select(
        F.concat_ws("\t", key, F.concat(F.lit("U"), key), wide).alias("value")
    )
    write_text(customers, info)
    inputs = [
        importing.Input(f"orders_{run}", write_header(spark, _ORDER_COLUMNS), orders),
        importing.Input(f"info_{run}", write_header(spark, _INFO_COLUMNS), info, sep=PACK),
    ]
    return importing.ImportJob(
        key="id",
        original_key="user_id",
        inputs=inputs,
        result=f"all_{run}",
        tasks={f"{task}_{run}": LabelTask(columns, labels.TASK_WEIGHTS[task]) for task, columns in _TASK_COLUMNS.items()},
        averages=_AVERAGES,
        scale=2,
        location=lambda name: fresh_path(spark, name),
    ), run


_IMPORTED_SQL = f"""
WITH history AS (SELECT CAST(o_custkey AS VARCHAR) AS id, 'U' || o_custkey AS user_id, CAST(count(*) AS VARCHAR) AS count_id,
    {mean_text_sql("o_totalprice")} AS avg_prefr_amount,
    {mean_text_sql("CAST(substr(o_orderpriority, 1, 1) AS INTEGER)")} AS avg_pay_amount
  FROM orders GROUP BY o_custkey),
info AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS nation,
    CAST(c_acctbal AS VARCHAR) AS balance, c_mktsegment AS segment FROM customer WHERE c_custkey % 7 <> 0)
"""


@query(
    "job_import",
    _IMPORTED_SQL
    + """SELECT 'orders' AS source, id, user_id, count_id, avg_prefr_amount, avg_pay_amount, NULL::VARCHAR AS nation,
      NULL::VARCHAR AS balance, NULL::VARCHAR AS segment FROM history
    UNION ALL SELECT 'info', id, NULL, NULL, NULL, NULL, nation, balance, segment FROM info""",
)
def job_import(spark, sf_dir):
    job, _ = _job(spark, sf_dir)
    orders = importing.import_orders(spark, job).withColumn("source", F.lit("orders"))
    info = importing.import_information(spark, job)[0].withColumn("source", F.lit("info"))
    return orders.unionByName(info, allowMissingColumns=True)


def _join_sql():
    rows = []
    for task, used in _TASK_COLUMNS.items():
        every = ("count_id", "avg_prefr_amount", "avg_pay_amount", "nation", "balance", "segment")
        kept = ", ".join(f"NULL AS {c}" if c in used else c for c in every)
        terms = " + ".join(
            f"{w}::DOUBLE * (({c}_n - low_{c}) / (high_{c} - low_{c}))" for c, w in zip(used, labels.TASK_WEIGHTS[task])
        )
        rows.append(f"SELECT '{task}_' || part AS part, id, {kept}, NULL::DOUBLE AS label FROM joined")
        rows.append(f"SELECT '{task}_label', id, NULL, NULL, NULL, NULL, NULL, NULL, {terms} FROM n, x")
    used = sorted({c for columns in _TASK_COLUMNS.values() for c in columns})
    numbers = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}_n" for c in used)
    ends = ", ".join(f"min({c}_n) AS low_{c}, max({c}_n) AS high_{c}" for c in used)
    shares = dict(zip(("train", "valid", "test"), labels.TRAIN_VALID_TEST))
    return (
        _IMPORTED_SQL
        + f""", joined AS (SELECT h.*, i.nation, i.balance, i.segment, {split_sql("h.id", shares)} AS part
            FROM history h LEFT JOIN info i USING (id)),
          n AS (SELECT id, {numbers} FROM joined), x AS (SELECT {ends} FROM n) """
        + " UNION ALL ".join(rows)
    )


@query("job_import_join", _join_sql())
def job_import_join(spark, sf_dir):
    """All three tasks."""
    job, _ = _job(spark, sf_dir)
    tables = importing.run_import_job(spark, job, step="import_all", goal="train")
    parts = []
    for name, df in tables.items():
        task, _, kind = name.split("_")
        parts.append(df.withColumn("part", F.lit(f"{task}_{kind}")))
    return reduce(lambda top, one: top.unionByName(one, allowMissingColumns=True), parts)
