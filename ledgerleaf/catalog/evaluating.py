"""Score evaluation over order lines.

The score of a line follows from its price (whole cents modulo 1000 units)
and is higher for returned lines; the label is "returned".
"""

from pyspark.sql import functions as F

from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import evaluate

_SCORES_SQL = """
WITH cents AS (
  SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS hit,
    CAST(round(l_extendedprice * 100) AS BIGINT) % 100000 AS c FROM lineitem),
s AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN hit THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
    CAST(CASE WHEN hit THEN 7 * c + 300000 ELSE 8 * c END AS DOUBLE) / 1000000 AS score,
    CASE WHEN hit THEN 7 * c + 300000 ELSE 8 * c END AS millionths FROM cents)
"""


def scored_lines(spark, sf_dir, *keep):
    hit = F.col("l_returnflag") == "R"
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint") % 100000
    millionths = F.when(hit, cents * 7 + 300000).otherwise(cents * 8)
    return table(spark, sf_dir, "lineitem").select(
        *keep, (millionths / 1000000).alias("score"), F.when(hit, 1.0).otherwise(0.0).alias("label")
    )


@query(
    "eval_threshold",
    _SCORES_SQL
    + """SELECT l_orderkey, l_linenumber, score, label,
      CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predicted FROM s""",
)
def eval_threshold(spark, sf_dir):
    return evaluate.with_threshold(scored_lines(spark, sf_dir, "l_orderkey", "l_linenumber"))


_CONFUSION_SQL = (
    _SCORES_SQL
    + """, m AS (SELECT count(*) AS total, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n,
      count(*) FILTER (label = 1 AND score >= 0.5) AS tp, count(*) FILTER (label = 0 AND score < 0.5) AS tn,
      count(*) FILTER (label = 0 AND score >= 0.5) AS fp, count(*) FILTER (label = 1 AND score < 0.5) AS fn FROM s),
    r AS (SELECT tp / p AS recall, tp / (tp + fp) AS precision, fp / n AS fpr, (tp + tn) / total AS accuracy FROM m)
"""
)


@query("eval_confusion", _CONFUSION_SQL + "SELECT * FROM m")
def eval_confusion(spark, sf_dir):
    return evaluate.confusion(scored_lines(spark, sf_dir))


@query(
    "eval_prf", _CONFUSION_SQL + "SELECT *, 2.0::DOUBLE * precision * recall / (1.0::DOUBLE * precision + recall) AS f1 FROM r"
)
def eval_prf(spark, sf_dir):
    return evaluate.ratios(scored_lines(spark, sf_dir))


_BETAS = (0.5, 1.0, 2.0)


@query(
    "eval_fbeta",
    _CONFUSION_SQL
    + " UNION ALL ".join(
        f"""SELECT {b}::DOUBLE AS beta, {1 + b * b}::DOUBLE * precision * recall
        / ({b * b}::DOUBLE * precision + recall) AS f_beta FROM r"""
        for b in _BETAS
    ),
)
def eval_fbeta(spark, sf_dir):
    return evaluate.f_beta(scored_lines(spark, sf_dir), _BETAS)


@query(
    "eval_label_counts",
    """SELECT count(*) FILTER (l_tax * 10 >= 0.5) AS num_positives, count(*) FILTER (NOT l_tax * 10 >= 0.5) AS num_negatives
       FROM lineitem""",
)
def eval_label_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_tax") * 10).alias("label"))
    return evaluate.label_counts(lines)


@query(
    "eval_accuracy",
    "SELECT count(*) FILTER (o_orderstatus = 'F') / count(*) AS accuracy FROM orders",
)
def eval_accuracy(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.lit("F").alias("prediction"), "o_orderstatus")
    return evaluate.accuracy(orders, "prediction", "o_orderstatus")


@query("eval_rmse", _SCORES_SQL + "SELECT round(sqrt(avg((label - score) * (label - score))), 9) AS rmse FROM s")
def eval_rmse(spark, sf_dir):
    return evaluate.rmse(scored_lines(spark, sf_dir), scale=9)


@query(
    "eval_error_stats",
    _SCORES_SQL
    + """SELECT round(avg(label - score), 7) AS error_mean, round(var_samp(label - score), 7) AS error_variance,
      round(avg(abs(label - score)), 7) AS mean_absolute_error,
      round(sum((label - score) * (label - score)), 7) AS squared_error FROM s""",
)
def eval_error_stats(spark, sf_dir):
    return evaluate.error_statistics(scored_lines(spark, sf_dir), scale=7)


# Counts at and above (or below) each distinct rounded score, by definition.
_TOTALS_SQL = "tot AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM s)"
_KS_SQL = (
    _SCORES_SQL
    + f""", {_TOTALS_SQL},
    th AS (SELECT DISTINCT CAST(round(CAST(score AS DECIMAL(18, 6)), 2) * 1000000 AS BIGINT) AS t FROM s),
    g AS (SELECT millionths AS t, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg, 0 AS mark
          FROM s GROUP BY 1 UNION ALL SELECT t, 0, 0, 1 FROM th),
    c AS (SELECT t, mark, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM g
          WINDOW w AS (ORDER BY t, mark ROWS UNBOUNDED PRECEDING)),
    pts AS (SELECT CAST(t AS DOUBLE) / 1000000 AS threshold, CAST(cn AS DOUBLE) / n AS neg_ratio,
              CAST(cp AS DOUBLE) / p AS pos_ratio FROM c, tot WHERE mark = 1)
"""
)


@query("eval_ks_points", _KS_SQL + "SELECT * FROM pts")
def eval_ks_points(spark, sf_dir):
    return evaluate.ks_points(scored_lines(spark, sf_dir))


@query("eval_ks", _KS_SQL + "SELECT max(abs(neg_ratio - pos_ratio)) AS ks FROM pts")
def eval_ks(spark, sf_dir):
    return evaluate.ks(scored_lines(spark, sf_dir))


ROC_SQL = (
    _SCORES_SQL
    + f""", {_TOTALS_SQL},
    th AS (SELECT DISTINCT CAST(round(CAST(score AS DECIMAL(18, 6)), 3) * 1000000 AS BIGINT) AS t FROM s),
    g AS (SELECT millionths AS t, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg, 0 AS mark
          FROM s GROUP BY 1 UNION ALL SELECT t, 0, 0, 1 FROM th),
    c AS (SELECT t, mark, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM g
          WINDOW w AS (ORDER BY t DESC, mark ROWS UNBOUNDED PRECEDING)),
    raw AS (SELECT CAST(cn AS DOUBLE) / n AS fpr, CAST(cp AS DOUBLE) / p AS tpr FROM c, tot WHERE mark = 1),
    pts AS (SELECT DISTINCT CAST(round(CAST(fpr AS DECIMAL(18, 12)), 3) AS DOUBLE) AS fpr,
              CAST(round(CAST(tpr AS DECIMAL(18, 12)), 3) AS DOUBLE) AS tpr FROM raw)
"""
)
_AREA_SQL = """, walk AS (SELECT x, y, lag(x, 1, 0.0) OVER o AS bx, lag(y, 1, 0.0) OVER o AS prev_y
      FROM (SELECT fpr AS x, tpr AS y FROM {points}
            UNION ALL SELECT 1.0, 1.0) WINDOW o AS (ORDER BY x, y))
    SELECT round(sum((y + prev_y) * abs(x - bx) / 2), 9) AS area FROM walk"""


@query("eval_roc_points", ROC_SQL + "SELECT * FROM pts")
def eval_roc_points(spark, sf_dir):
    return evaluate.roc_points(scored_lines(spark, sf_dir))


@query("eval_auc_rounded", ROC_SQL + _AREA_SQL.format(points="pts"))
def eval_auc_rounded(spark, sf_dir):
    return evaluate.auc_rounded(scored_lines(spark, sf_dir)).select(F.round("area", 9).alias("area"))


_STEPS_SQL = (
    _SCORES_SQL
    + f""", {_TOTALS_SQL},
    g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM s GROUP BY 1),
    c AS (SELECT score, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM g
          WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
    curve AS (SELECT CAST(cn AS DOUBLE) / n AS fpr, CAST(cp AS DOUBLE) / p AS tpr FROM c, tot)
"""
)


@query("eval_area_under_curve", _STEPS_SQL + _AREA_SQL.format(points="curve"))
def eval_area_under_curve(spark, sf_dir):
    points = evaluate.roc_exact(scored_lines(spark, sf_dir))
    return evaluate.area_under_points(points, "fpr", "tpr").select(F.round("area", 9).alias("area"))


@query(
    "eval_auc_exact",
    _STEPS_SQL
    + """SELECT CAST(sum(neg * (2 * cp - pos)) AS DOUBLE) / (2.0::DOUBLE * any_value(p) * any_value(n)) AS auc
         FROM c, tot""",
)
def eval_auc_exact(spark, sf_dir):
    return evaluate.auc_exact(scored_lines(spark, sf_dir))


@query(
    "eval_pr_by_threshold",
    _STEPS_SQL
    + """SELECT score AS threshold, CAST(cp AS DOUBLE) / CAST(cp + cn AS DOUBLE) AS precision,
      CAST(cp AS DOUBLE) / p AS recall FROM c, tot""",
)
def eval_pr_by_threshold(spark, sf_dir):
    return evaluate.precision_recall(scored_lines(spark, sf_dir))


@query(
    "eval_aupr",
    _STEPS_SQL
    + """, pr AS (SELECT score, CAST(cp AS DOUBLE) / CAST(cp + cn AS DOUBLE) AS y, CAST(cp AS DOUBLE) / p AS x FROM c, tot),
      walk AS (SELECT x, y, lag(x, 1, 0.0) OVER o AS bx, lag(y, 1, y) OVER o AS prev_y FROM pr WINDOW o AS (ORDER BY score DESC))
      SELECT round(sum((x - bx) * (y + prev_y) / 2), 9) AS aupr FROM walk""",
)
def eval_aupr(spark, sf_dir):
    return evaluate.area_under_precision_recall(scored_lines(spark, sf_dir), scale=9)


@query(
    "eval_ks_bands",
    _SCORES_SQL
    + """, b AS (SELECT CAST(least(millionths // 100000, 9) AS INTEGER) AS band, count(*) FILTER (label = 1) AS pos,
          count(*) FILTER (label = 0) AS neg FROM s GROUP BY 1)
      SELECT band, pos, neg, CAST(sum(pos) OVER (ORDER BY band) AS BIGINT) AS cum_pos,
        CAST(sum(neg) OVER (ORDER BY band) AS BIGINT) AS cum_neg FROM b""",
)
def eval_ks_bands(spark, sf_dir):
    return evaluate.ks_bands(scored_lines(spark, sf_dir))


# Orders ranked by price for each customer; relevance is the priority's digit.
_RANKED_SQL = """
WITH r AS (SELECT o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rel,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS i,
    row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(substr(o_orderpriority, 1, 1) AS INTEGER) DESC, o_orderkey) AS j
  FROM orders),
d AS (SELECT o_custkey, sum(CASE WHEN i = 1 THEN rel ELSE rel / log2(i) END) AS dcg,
    sum(CASE WHEN j = 1 THEN rel ELSE rel / log2(j) END) AS best FROM r GROUP BY 1)
"""


def _ranked_orders(spark, sf_dir):
    relevance = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", relevance.alias("rel"))


@query("eval_dcg", _RANKED_SQL + "SELECT o_custkey, round(dcg, 8) AS dcg FROM d")
def eval_dcg(spark, sf_dir):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return evaluate.dcg(_ranked_orders(spark, sf_dir), "o_custkey", "rel", order, scale=8)


@query("eval_ndcg", _RANKED_SQL + "SELECT o_custkey, round(dcg / best, 8) AS ndcg FROM d")
def eval_ndcg(spark, sf_dir):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return evaluate.ndcg(_ranked_orders(spark, sf_dir), "o_custkey", "rel", order, "o_orderkey", scale=8)
