"""Import, join, label and split."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.operators.aggregates import history
from ledgerleaf.operators.clean import fill_blank
from ledgerleaf.operators.columns import without
from ledgerleaf.operators.joins import join_catalog
from ledgerleaf.operators.labels import TRAIN_VALID_TEST, LabelTask, split_by_hash, weighted_labels
from ledgerleaf.scratch import materialize
from ledgerleaf.sinks.tables import replace_parts, replace_table
from ledgerleaf.sources.delimited import path_exists, read_csv, read_packed, read_text_with_header_file

# Names of the import steps and of what the tables are for.
STEPS = ("import_business", "import_info", "import_all", "import_sample", "skip_import")
GOALS = ("train", "predict")


@dataclass(frozen=True)
class Input:
    """One table to import: a header file and a data file."""

    name: str
    header: str
    data: str
    header_sep: str = ","
    sep: str = "\t"
    rejects: str | None = None


@dataclass(frozen=True)
class ImportJob:
    """What to import, how to join it and which labels to make.

    Inputs whose header or data file is missing are left out. The first of the
    others is the order history, the rest are information tables with one row
    per key.
    """

    key: str
    original_key: str
    inputs: Sequence[Input]
    result: str
    tasks: Mapping[str, LabelTask]
    averages: Mapping[str, str] = field(default_factory=dict)
    scale: int | None = None
    location: Callable[[str], str | None] = lambda name: None


def existing_inputs(spark: SparkSession, job: ImportJob) -> list[Input]:
    """Inputs whose header and data are both there."""
    return [one for one in job.inputs if path_exists(spark, one.header) and path_exists(spark, one.data)]


def import_orders(spark: SparkSession, job: ImportJob) -> DataFrame:
    """Order lines as counts and averages per customer, stored as a table."""
    found = existing_inputs(spark, job)
    if not found:
        raise ValueError(f"none of the inputs exists: {[one.data for one in job.inputs]}")
    first = found[0]
    lines = read_text_with_header_file(spark, first.header, first.data, first.header_sep, first.sep)
    summary = history(lines, [job.key, job.original_key], job.averages, scale=job.scale)
    return replace_table(summary, first.name, job.location(first.name))


def import_information(spark: SparkSession, job: ImportJob) -> list[DataFrame]:
    """The other inputs, their malformed lines set aside."""
    stored = []
    for one in existing_inputs(spark, job)[1:]:
        rejects = one.rejects or f"{one.data}.rejects"
        table = read_packed(spark, one.header, one.data, rejects, one.header_sep, one.sep)
        stored.append(replace_table(table.drop(job.original_key), one.name, job.location(one.name)))
    return stored


def import_sample(spark: SparkSession, job: ImportJob, path: str, sep: str = ",") -> DataFrame:
    """A ready-joined sample, cleaned and stored as the result table."""
    return replace_table(fill_blank(read_csv(spark, path, sep)), job.result, job.location(job.result))


def train_tables(
    data: DataFrame,
    key: str,
    tasks: Mapping[str, LabelTask],
    drop: Iterable[str] = (),
    shares: Sequence[float] = TRAIN_VALID_TEST,
    test_is_full: bool = False,
) -> dict[str, DataFrame]:
    """Per task: label, train, valid and test tables.

    The columns a label is made of are not features. Rows are split by the
    hash of the key; ``test_is_full`` makes the test table the whole table.
    The labels of all tasks are computed together, once.
    """
    tables = {}
    labels = materialize(weighted_labels(data, key, tasks), "labels")
    named = dict(zip(("train", "valid", "test"), shares, strict=True))
    for name, task in tasks.items():
        features = without(data, [*task.columns, *drop])
        split = split_by_hash(features, key, named, "_split")
        tables[f"{name}_label"] = labels.select(key, F.col(name).alias("label"))
        for part in named:
            tables[f"{name}_{part}"] = split.filter(split["_split"] == part).drop("_split")
        if test_is_full:
            tables[f"{name}_test"] = features
    return tables


def predict_tables(data: DataFrame, tasks: Mapping[str, LabelTask], drop: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Per task the whole table as test data; no labels."""
    return {f"{name}_test": without(data, [*task.columns, *drop]) for name, task in tasks.items()}


def run_import_job(
    spark: SparkSession,
    job: ImportJob,
    step: str = "import_all",
    join: bool = True,
    goal: str = "train",
    how: str = "left",
    sample: str | None = None,
) -> dict[str, DataFrame]:
    """The whole job; returns the stored task tables.

    Without ``join`` the result table of an earlier run is used.
    """
    if step not in STEPS or goal not in GOALS:
        raise ValueError(f"step must be one of {STEPS} and goal one of {GOALS}")
    if step in ("import_business", "import_all"):
        import_orders(spark, job)
    if step in ("import_info", "import_all"):
        import_information(spark, job)
    if step == "import_sample":
        if sample is None:
            raise ValueError("import_sample needs the path of the sample")
        import_sample(spark, job, sample)
    if join:
        # Only inputs that are there now: a table left by an earlier run is stale.
        names = [one.name for one in existing_inputs(spark, job)]
        joined = join_catalog(spark, names, job.key, how)
        data = replace_table(joined, job.result, job.location(job.result))
    else:
        data = spark.table(job.result)
    if goal == "predict":
        tables = predict_tables(data, job.tasks, [job.original_key])
        return {name: replace_table(table, name, job.location(name)) for name, table in tables.items()}
    return store_train_tables(data, job)


def store_train_tables(data: DataFrame, job: ImportJob, shares: Sequence[float] = TRAIN_VALID_TEST) -> dict[str, DataFrame]:
    """The train job's tables, stored: the labels of all tasks in one pass, and
    one pass per task that writes train, valid and test rows apart."""
    stored = {}
    labels = materialize(weighted_labels(data, job.key, job.tasks), "labels")
    split = split_by_hash(data, job.key, dict(zip(("train", "valid", "test"), shares, strict=True)), "_split")
    for name, task in job.tasks.items():
        label = f"{name}_label"
        stored[label] = replace_table(labels.select(job.key, F.col(name).alias("label")), label, job.location(label))
        names = {part: f"{name}_{part}" for part in ("train", "valid", "test")}
        features = without(split, [*task.columns, job.original_key])
        stored |= replace_parts(features, "_split", names, job.location(name))
    return stored
