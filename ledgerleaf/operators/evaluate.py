"""Quality of scores against labels. Input tables have a ``score`` and a
``label`` column (label 1 = positive, 0 = negative)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.numbers import at_least, round_half_up
from ledgerleaf.operators.ordered import numbered, running, with_preceding

# Digits kept for KS thresholds, ROC thresholds and ROC points.
KS_SCALE = 2
ROC_SCALE = 3


def _is_positive() -> Column:
    return F.col("label") == 1


def _is_negative() -> Column:
    return F.col("label") == 0


def with_threshold(df: DataFrame, threshold: float = 0.5, output: str = "predicted") -> DataFrame:
    return df.withColumn(output, at_least(F.col("score"), threshold))


def confusion(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row of counts at a threshold, in one pass."""
    hit = F.col("score") >= threshold
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_is_positive()).alias("p"),
        F.count_if(_is_negative()).alias("n"),
        F.count_if(_is_positive() & hit).alias("tp"),
        F.count_if(_is_negative() & ~hit).alias("tn"),
        F.count_if(_is_negative() & hit).alias("fp"),
        F.count_if(_is_positive() & ~hit).alias("fn"),
    )


def _f_score(beta: float) -> Column:
    square = beta * beta
    return F.try_divide(
        (1.0 + square) * F.col("precision") * F.col("recall"), square * F.col("precision") + F.col("recall")
    )


def ratios(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Recall, precision, false positive rate, accuracy and F1; a ratio with
    an empty denominator is null."""
    counts = confusion(df, threshold)
    return counts.select(
        F.try_divide("tp", "p").alias("recall"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("fp", "n").alias("fpr"),
        F.try_divide(F.col("tp") + F.col("tn"), F.col("total")).alias("accuracy"),
    ).withColumn("f1", _f_score(1.0))


def f_beta(df: DataFrame, betas: Sequence[float], threshold: float = 0.5) -> DataFrame:
    """F-measure for several weights of recall against precision."""
    base = ratios(df, threshold).select("precision", "recall")
    cells = [F.struct(F.lit(float(beta)).alias("beta"), _f_score(beta).alias("f_beta")) for beta in betas]
    return base.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def label_counts(df: DataFrame) -> DataFrame:
    """Positives and negatives, where any label of 0.5 or more is positive."""
    high = F.col("label") >= 0.5
    return df.agg(F.count_if(high).alias("num_positives"), F.count_if(~high).alias("num_negatives"))


def accuracy(df: DataFrame, prediction: str, label: str) -> DataFrame:
    return df.agg(F.try_divide(F.count_if(F.col(prediction) == F.col(label)), F.count(label)).alias("accuracy"))


def rmse(df: DataFrame, scale: int | None = None) -> DataFrame:
    error = F.col("label") - F.col("score")
    value = F.sqrt(F.avg(error * error))
    return df.agg((value if scale is None else F.round(value, scale)).alias("rmse"))


def error_statistics(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean, variance and absolute mean of label - score, and squared error."""
    error = F.col("label") - F.col("score")
    results = {
        "error_mean": F.avg(error),
        "error_variance": F.var_samp(error),
        "mean_absolute_error": F.avg(F.abs(error)),
        "squared_error": F.sum(error * error),
    }
    return df.agg(*[(v if scale is None else F.round(v, scale)).alias(k) for k, v in results.items()])


def _threshold_counts(df: DataFrame, scale: int, above: bool, unit_scores: bool) -> DataFrame:
    """Cumulative positives and negatives at every rounded score.

    A threshold is a score rounded to ``scale`` digits, so each raw score can
    be moved to the grid value next to it on the far side of the comparison:
    it passes the same thresholds as before. The table is grouped by grid value
    at once, which leaves at most ``10**scale + 1`` rows for scores in [0, 1];
    a score outside fails the job. With ``unit_scores=False`` any score is
    allowed, and the running sum is spread over tasks.
    """
    unit = 10**scale
    score = F.col("score").cast("double")
    if unit_scores:
        inside = (score >= 0) & (score <= 1)
        score = F.when(inside, score).otherwise(F.raise_error(F.lit("score outside [0, 1]")).cast("double"))
    rounded = round_half_up(score, scale)
    at = F.round(rounded * unit).cast("bigint")
    beside = F.when(rounded > score, at - 1).otherwise(at) if above else F.when(rounded < score, at + 1).otherwise(at)
    cells = (
        df.select(at.alias("at"), beside.alias("beside"), "label")
        .groupBy("at", "beside")
        .agg(F.count_if(_is_positive()).alias("pos"), F.count_if(_is_negative()).alias("neg"))
    )
    none = F.lit(0).cast("bigint")
    both = F.array(
        F.struct(F.col("beside").alias("at"), "pos", "neg", F.lit(False).alias("used")),
        F.struct("at", none.alias("pos"), none.alias("neg"), F.lit(True).alias("used")),
    )
    grid = (
        cells.select(F.explode(both).alias("c"))
        .groupBy("c.at")
        .agg(F.sum("c.pos").alias("pos"), F.sum("c.neg").alias("neg"), F.max("c.used").alias("used"))
    )
    order = F.desc("at") if above else F.asc("at")
    if unit_scores:
        so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        everything = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        sums = grid.select(
            "at",
            "used",
            F.sum("pos").over(so_far).alias("cum_pos"),
            F.sum("neg").over(so_far).alias("cum_neg"),
            F.sum("pos").over(everything).alias("total_pos"),
            F.sum("neg").over(everything).alias("total_neg"),
        )
    else:
        sums = _spread_totals(grid, order)
    return sums.filter("used").select(
        (F.col("at") / F.lit(unit)).alias("threshold"), "cum_pos", "cum_neg", "total_pos", "total_neg"
    )


def _spread_totals(counts: DataFrame, order: Column) -> DataFrame:
    """Running and overall counts without a single-task window."""
    return running(
        counts,
        [order],
        totals={"cum_pos": "pos", "cum_neg": "neg"},
        overall={"total_pos": "pos", "total_neg": "neg"},
    )


def ks_points(df: DataFrame, scale: int = KS_SCALE, unit_scores: bool = True) -> DataFrame:
    """Shares of negatives and positives at or below each rounded score."""
    return _threshold_counts(df, scale, above=False, unit_scores=unit_scores).select(
        "threshold",
        F.try_divide("cum_neg", "total_neg").alias("neg_ratio"),
        F.try_divide("cum_pos", "total_pos").alias("pos_ratio"),
    )


def ks(df: DataFrame, scale: int = KS_SCALE, unit_scores: bool = True) -> DataFrame:
    """Greatest gap between the two cumulative shares."""
    points = ks_points(df, scale, unit_scores)
    return points.agg(F.max(F.abs(F.col("neg_ratio") - F.col("pos_ratio"))).alias("ks"))


def roc_points(df: DataFrame, scale: int = ROC_SCALE, unit_scores: bool = True) -> DataFrame:
    """Distinct (fpr, tpr) points at the rounded scores, themselves rounded."""
    points = _threshold_counts(df, scale, above=True, unit_scores=unit_scores)
    return points.select(
        round_half_up(F.try_divide("cum_neg", "total_neg"), scale).alias("fpr"),
        round_half_up(F.try_divide("cum_pos", "total_pos"), scale).alias("tpr"),
    ).distinct()


def _trapezoid(x: Column, y: Column, x_before: Column, y_before: Column) -> Column:
    return (y + y_before) * F.abs(x - x_before) / 2


def _closing(last_x: Column, last_y: Column) -> Column:
    return (last_y + 1.0) * F.abs(F.lit(1.0) - last_x) / 2


def area_under_points(points: DataFrame, x: str, y: str, gridded: bool = False) -> DataFrame:
    """Trapezoid area from (0, 0) over rising points to (1, 1).

    ``gridded`` says that the points rise in both directions on a rounded
    grid, so that there are few of them and one task can walk along. Otherwise
    they are dealt by ranges, and each part is handed the point before its first.
    """
    if gridded:
        order = Window.orderBy(x, y)
        steps = points.select(
            F.col(x).alias("x"),
            F.col(y).alias("y"),
            F.lag(x, 1, 0.0).over(order).alias("bx"),
            F.lag(y, 1, 0.0).over(order).alias("by"),
        )
    else:
        placed = with_preceding(points.select(F.col(x).alias("x"), F.col(y).alias("y")), ["x", "y"], "_before")
        from_zero = lambda name: F.coalesce(F.col(f"_before.{name}"), F.lit(0.0)).alias(f"b{name}")
        steps = placed.select("x", "y", from_zero("x"), from_zero("y"))
    area = F.sum(_trapezoid(F.col("x"), F.col("y"), F.col("bx"), F.col("by")))
    end = F.max(F.struct("x", "y"))
    return steps.agg(area.alias("_area"), end.alias("_end")).select(
        (F.col("_area") + _closing(F.col("_end.x"), F.col("_end.y"))).alias("area")
    )


def auc_rounded(df: DataFrame, scale: int = ROC_SCALE, unit_scores: bool = True) -> DataFrame:
    """Area under the rounded ROC points."""
    return area_under_points(roc_points(df, scale, unit_scores), "fpr", "tpr", gridded=True)


def score_steps(df: DataFrame) -> DataFrame:
    """Every distinct score with its counts, the counts at or above it, and
    the totals; exact for any number of distinct scores."""
    grouped = df.groupBy("score").agg(
        F.count_if(_is_positive()).alias("pos"), F.count_if(_is_negative()).alias("neg")
    )
    return _spread_totals(grouped, F.desc("score"))


def roc_exact(df: DataFrame) -> DataFrame:
    """(fpr, tpr) at every distinct score."""
    return score_steps(df).select(
        F.try_divide("cum_neg", "total_neg").alias("fpr"), F.try_divide("cum_pos", "total_pos").alias("tpr")
    )


def auc_exact(df: DataFrame) -> DataFrame:
    """Area under the unrounded ROC curve.

    Twice the area is a whole number of (positive, negative) pairs, so it is
    summed exactly.
    """
    # Counts of some billions each: their product is beyond a long.
    wide = lambda value: value.cast("decimal(19,0)")
    doubled = wide(F.col("neg")) * wide(2 * F.col("cum_pos") - F.col("pos"))
    whole = score_steps(df).agg(
        F.sum(doubled).alias("doubled"), F.first("total_pos").alias("p"), F.first("total_neg").alias("n")
    )
    return whole.select(
        F.try_divide(F.col("doubled").cast("double"), 2.0 * F.col("p") * F.col("n")).alias("auc")
    )


def precision_recall(df: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score."""
    return score_steps(df).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide("cum_pos", "total_pos").alias("recall"),
    )


def area_under_precision_recall(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Trapezoid area; the curve starts level at its first precision.

    The point before a score follows from the score's own counts, so no
    neighbour is looked up.
    """
    cum = F.col("cum_pos") + F.col("cum_neg")
    here = F.col("cum_pos") / cum
    pos_before = F.col("cum_pos") - F.col("pos")
    before = F.coalesce(F.try_divide(pos_before, cum - F.col("pos") - F.col("neg")), here)
    step = F.try_divide("pos", "total_pos")
    area = F.sum(step * (here + before) / 2)
    return score_steps(df).agg((area if scale is None else F.round(area, scale)).alias("aupr"))


def ks_bands(df: DataFrame, bands: int = 10) -> DataFrame:
    """Positives and negatives per equal-width score band, and their running
    counts. There is one row per band."""
    band = F.least(F.floor(F.col("score") * bands), F.lit(bands - 1)).cast("int")
    counts = df.groupBy(band.alias("band")).agg(
        F.count_if(_is_positive()).alias("pos"), F.count_if(_is_negative()).alias("neg")
    )
    so_far = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        "band",
        "pos",
        "neg",
        F.sum("pos").over(so_far).alias("cum_pos"),
        F.sum("neg").over(so_far).alias("cum_neg"),
    )


def _discounted(relevance: Column, position: Column) -> Column:
    return F.when(position == 1, relevance).otherwise(relevance / F.log2(position))


def dcg(
    df: DataFrame, query: str, relevance: str, order_by: Sequence[Column | str], scale: int | None = None, name: str = "dcg"
) -> DataFrame:
    """Discounted cumulative gain per query.

    Positions are numbered over range parts, so one query may hold most of
    the rows.
    """
    ranked = numbered(df, order_by, name="_at", group_by=[query])
    total = F.sum(_discounted(F.col(relevance).cast("double"), F.col("_at").cast("double")))
    return ranked.groupBy(query).agg((total if scale is None else F.round(total, scale)).alias(name))


def ndcg(
    df: DataFrame, query: str, relevance: str, order_by: Sequence[Column | str], unique: str, scale: int | None = None
) -> DataFrame:
    """Gain divided by the gain of the best order; null where that is 0."""
    actual = dcg(df, query, relevance, order_by)
    graded = df.select(query, relevance, unique)
    ideal = dcg(graded, query, relevance, [F.desc(relevance), F.asc(unique)], name="ideal_dcg")
    ratio = F.try_divide("dcg", "ideal_dcg")
    other = ideal.withColumnRenamed(query, "_query")
    return actual.join(other, actual[query].eqNullSafe(other["_query"])).select(
        query, (ratio if scale is None else F.round(ratio, scale)).alias("ndcg")
    )
