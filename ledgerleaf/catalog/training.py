"""Models over the embeddings and order lines. Scores depend on the learner;
the queries return facts about them that SQL can state."""

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerleaf.catalog.evaluating import scored_lines
from ledgerleaf.catalog.labeling import split_sql
from ledgerleaf.catalog.registry import query, table
from ledgerleaf.operators import boosting, evaluate, models
from ledgerleaf.operators.labels import split_by_hash
from ledgerleaf.scratch import fresh_path, materialize
from ledgerleaf.sinks.files import write_scores

_SHARES = {"train": 0.4, "valid": 0.2, "test": 0.4}


def _vectors(spark, sf_dir):
    """Embeddings with a two-class label and a hashed split."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("label") >= 5, 1.0).otherwise(0.0).alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    return split_by_hash(rows, "vec_id", _SHARES)


def _split(rows):
    return split_by_hash(rows, "id", _SHARES).withColumn("is_valid", F.col("split") == "valid")


def _returns(spark, sf_dir):
    """Order lines with "returned" as the label."""
    lines = scored_lines(spark, sf_dir, "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return _split(
        lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            "label",
            array_to_vector(F.array("score", "l_quantity", "l_discount", "l_tax")).alias("features"),
        )
    )


def _revenue(spark, sf_dir):
    """Order lines with the discounted price (in thousands) as the target."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        (price * (1 - discount) / 1000).alias("label"),
        array_to_vector(F.array("l_extendedprice", "l_discount", "l_quantity", "l_tax")).alias("features"),
    )
    return _split(rows)


def _training(rows, key="id"):
    """Training rows, written once: a tree learner asks for them several times."""
    return models.balanced(materialize(rows.filter("split <> 'test'"), "training-rows"), key)


def _lines(rows):
    """Training lines as they lie: boosted trees group them first, and spread them
    by their key if that does not help."""
    return rows.filter("split <> 'test'")


def _scored(model, rows):
    return models.scored(model, rows, "id", "split", "label")


def _split_rows_sql(key, source):
    return f"SELECT {key} AS id, {split_sql(key, _SHARES)} AS split FROM {source}"


_LINE_KEY = "l_orderkey * 10 + l_linenumber"
_FACTS_SQL = f"SELECT *, TRUE AS consistent FROM ({_split_rows_sql(_LINE_KEY, 'lineitem')})"


def _facts(scores):
    """Each row scored once, its class that of the greater probability."""
    likely = F.col("probability") > 0.5
    within = F.col("probability").between(0, 1)
    return scores.select("id", "split", (within & ((F.col("prediction") == 1) == likely)).alias("consistent"))


@query("ml_random_forest", _FACTS_SQL)
def ml_random_forest(spark, sf_dir):
    rows = _returns(spark, sf_dir)
    return _facts(_scored(models.random_forest(_training(rows)), rows))


@query("ml_gbt_classifier_valid", _FACTS_SQL)
def ml_gbt_classifier_valid(spark, sf_dir):
    rows = _returns(spark, sf_dir)
    return _facts(_scored(models.boosted_classifier_validated(_lines(rows), "is_valid", spread="id"), rows))


_ERRORS_SQL = f"SELECT split, count(*) AS rows, TRUE AS beats_the_mean FROM ({_split_rows_sql(_LINE_KEY, 'lineitem')}) GROUP BY split"


def _errors(model, rows):
    report = models.error_report(_scored(model, rows))
    return report.select("split", "rows", (F.col("rmse") < F.col("rmse_of_mean")).alias("beats_the_mean"))


@query("ml_gbt_regressor", _ERRORS_SQL)
def ml_gbt_regressor(spark, sf_dir):
    rows = _revenue(spark, sf_dir)
    return _errors(models.boosted_regressor_validated(_lines(rows), "is_valid", spread="id"), rows)


@query("ml_gbt_classifier", "SELECT unnest(['accuracy', 'auc']) AS metric, TRUE AS better_than_chance")
def ml_gbt_classifier(spark, sf_dir):
    rows = _returns(spark, sf_dir)
    scored = _scored(models.boosted_classifier(_lines(rows), spread="id"), rows.filter("split = 'test'"))
    # Scored once for both measures.
    scored = materialize(scored, "scores")
    accuracy = evaluate.accuracy(scored, "prediction", "label").select(
        F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")
    )
    area = evaluate.auc_exact(scored.select(F.col("probability").alias("score"), "label"))
    both = accuracy.union(area.select(F.lit("auc"), "auc"))
    return both.select("metric", (F.col("value").between(0.5, 1.0)).alias("better_than_chance"))


@query("ml_boost_classifier", _FACTS_SQL)
def ml_boost_classifier(spark, sf_dir):
    rows = _returns(spark, sf_dir)
    return _facts(_scored(models.gradient_classifier(_lines(rows), spread="id"), rows))


@query("ml_boost_regressor", _ERRORS_SQL)
def ml_boost_regressor(spark, sf_dir):
    rows = _revenue(spark, sf_dir)
    return _errors(models.gradient_regressor(rows.filter("split = 'train'"), spread="id"), rows)


@query("ml_kmeans", "SELECT vec_id, TRUE AS nearest, 2::BIGINT AS centres FROM embeddings")
def ml_kmeans(spark, sf_dir):
    """Every row is in the cluster of its nearest centre."""
    rows = _vectors(spark, sf_dir)
    model = models.clusters(models.balanced(rows, "vec_id"))
    value = vector_to_array("features")
    # One column for each of the k centres.
    distances = F.array(
        *[
            F.aggregate(F.zip_with(value, F.lit([float(x) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
            for c in model.clusterCenters()
        ]
    )
    placed = model.transform(rows).select("vec_id", distances.alias("d"), F.col("prediction"))
    nearest = F.get("d", F.col("prediction")) <= F.array_min("d") + 1e-9
    return placed.select("vec_id", nearest.alias("nearest"), F.size("d").cast("bigint").alias("centres"))


@query("ml_logistic", _FACTS_SQL.replace("TRUE AS consistent", "TRUE AS consistent, TRUE AS falls"))
def ml_logistic(spark, sf_dir):
    """Probabilities are the sigmoid of the stored coefficients; the objective
    never rises."""
    rows = _returns(spark, sf_dir)
    model = models.logistic(models.balanced(rows, "id"))
    terms = [F.get(vector_to_array("features"), F.lit(i)) * float(c) for i, c in enumerate(model.coefficients)]
    margin = sum(terms, F.lit(float(model.intercept)))
    scored = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    same = F.abs(F.col("probability") - 1 / (1 + F.exp(-margin))) < 1e-9
    history = models.objective_rows(model, rows)
    order = Window.orderBy("step")
    falls = history.select((F.col("objective") <= F.lag("objective", 1, float("inf")).over(order) + 1e-12).alias("ok"))
    return scored.select("id", "split", same.alias("consistent")).withColumn("falls", falls.agg(F.bool_and("ok")).scalar())


@query("ml_kmeans_centres", "SELECT unnest([0, 1])::INTEGER AS cluster, 64::BIGINT AS size")
def ml_kmeans_centres(spark, sf_dir):
    """The centres of the clusters."""
    rows = _vectors(spark, sf_dir)
    centres = models.centre_rows(models.clusters(models.balanced(rows, "vec_id")), rows)
    return centres.select("cluster", F.size("centre").cast("bigint").alias("size"))


def _saved_classifier(spark, rows):
    path = fresh_path(spark, "model")
    model = models.boosted_classifier(_training(rows, "vec_id"), maxIter=models.BOOSTED_CLASSIFIER["maxIter"])
    models.save_model(model, path)
    return model, models.load_model(GBTClassificationModel, path)


@query("ml_save_load", "SELECT vec_id, TRUE AS same FROM embeddings")
def ml_save_load(spark, sf_dir):
    """Scores of the model kept in memory and of the model read back."""
    rows = _vectors(spark, sf_dir)
    kept, loaded = _saved_classifier(spark, rows)
    before = models.scored(kept, rows, "vec_id").withColumnRenamed("probability", "before")
    after = models.scored(loaded, rows, "vec_id").withColumnRenamed("probability", "after")
    both = before.select("vec_id", "before").join(after.select("vec_id", "after"), "vec_id")
    return both.select("vec_id", (F.col("before") == F.col("after")).alias("same"))


@query("ml_batch_score", "SELECT vec_id, TRUE AS stored, TRUE AS consistent FROM embeddings")
def ml_batch_score(spark, sf_dir):
    """A stored model applied to the whole table; its score file read again."""
    rows = _vectors(spark, sf_dir)
    _, loaded = _saved_classifier(spark, rows)
    scores = materialize(models.scored(loaded, rows, "vec_id"), "scores")
    path = fresh_path(spark, "score-file")
    write_scores(scores, path, ["vec_id", "prediction", "probability"])
    back = spark.read.schema("vec_id bigint, p double, q double").csv(path)
    likely = (F.col("prediction") == 1) == (F.col("probability") > 0.5)
    return scores.join(back, "vec_id").select(
        "vec_id", ((F.col("p") == F.col("prediction")) & (F.col("q") == F.col("probability"))).alias("stored"), likely.alias("consistent")
    )


# Rounds and step of the regularised trees in the queries; the standing ones
# (400 of 0.01) are the defaults of the operator.
_ROUNDS, _ETA = 10, 0.2


def _lists(rows):
    return rows.withColumn("features", vector_to_array("features"))


@query("ml_boost_regressor_l1")
def ml_boost_regressor_l1(spark, sf_dir):
    """Error per part of trees with the standing L1 term, least gain and depth."""
    rows = _lists(_revenue(spark, sf_dir))
    model = boosting.fit(rows.filter("split = 'train'"), "id", rounds=_ROUNDS, eta=_ETA)
    report = models.error_report(boosting.score(model, rows, "id", "split", "label"))
    return report.withColumn("leaves", F.lit(model.n_leaves()))


@query("ml_boost_classifier_l1")
def ml_boost_classifier_l1(spark, sf_dir):
    """Confusion counts and measures per part."""
    rows = _lists(_returns(spark, sf_dir))
    model = boosting.fit(rows.filter("split = 'train'"), "id", objective="logistic", rounds=_ROUNDS, eta=_ETA)
    scores = boosting.score(model, rows, "id", "split", "label").withColumnRenamed("prediction", "probability")
    return models.classifier_report(scores)


@query("ml_classifier_report")
def ml_classifier_report(spark, sf_dir):
    """Measures of the forest and of boosted trees per part, with the exact area
    under the curve of the test rows."""
    rows = _returns(spark, sf_dir)
    found = None
    fitted = (("forest", models.random_forest(_training(rows))), ("boosted", models.gradient_classifier(_lines(rows), spread="id")))
    for name, model in fitted:
        scores = materialize(_scored(model, rows), "scores")
        area = evaluate.auc_exact(scores.filter("split = 'test'").select(F.col("probability").alias("score"), "label"))
        mine = models.classifier_report(scores).union(area.select(F.lit("test"), F.lit("auc"), "auc"))
        mine = mine.withColumn("model", F.lit(name))
        found = mine if found is None else found.unionByName(mine)
    return found


@query("ml_regressor_report")
def ml_regressor_report(spark, sf_dir):
    """Root mean squared error per part, beside that of the mean."""
    rows = _revenue(spark, sf_dir)
    model = models.boosted_regressor_validated(_lines(rows), "is_valid", spread="id", maxIter=10, stepSize=0.1)
    return models.error_report(_scored(model, rows))


@query("ml_kmeans_report")
def ml_kmeans_report(spark, sf_dir):
    """Within-cluster squared error and the centres, number by number."""
    rows = _vectors(spark, sf_dir)
    report = models.cluster_report(models.clusters(models.balanced(rows, "vec_id")), rows)
    return report.select("cluster", "rows", "squared_error", F.posexplode("centre").alias("position", "value"))


@query("ml_logistic_report")
def ml_logistic_report(spark, sf_dir):
    """Objective history, ROC points and the area under them."""
    rows = _returns(spark, sf_dir)
    model = models.logistic(models.balanced(rows, "id"), regParam=0.01)
    scores = _scored(model, rows).select(F.col("probability").alias("score"), "label")
    area = evaluate.auc_exact(scores).select(F.lit("auc").alias("kind"), F.lit(0.0).alias("x"), F.col("auc").alias("y"))
    return models.fit_report(model, rows).union(area)
