"""Matrix products against numpy, held whole and cut into blocks."""

import numpy as np
import pytest

from ledgerleaf.operators import matrix


def tables(spark, a, b):
    left = spark.createDataFrame([(f"r{i}", [float(x) for x in v]) for i, v in enumerate(a)], "r string, v array<double>")
    right = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(b.T)], "k bigint, v array<double>")
    return left.repartition(3), right.repartition(2)


@pytest.mark.parametrize("sizes", [{}, {"held_cells": 0, "inner": 4, "columns": 3}, {"held_cells": 0, "inner": 64, "columns": 5}, {"held_cells": 0}])
def test_product(spark, sizes):
    rng = np.random.default_rng(1)
    a, b = rng.random((40, 11)), rng.random((11, 17))
    left, right = tables(spark, a, b)
    got = {(r.r, r.k): r.value for r in matrix.multiply(left, right, row="r", column="k", vector="v", **sizes).collect()}
    want = a @ b
    assert len(got) == 40 * 17
    for i in range(40):
        for k in range(17):
            assert got[f"r{i}", k] == pytest.approx(want[i, k], abs=1e-12)


@pytest.mark.parametrize("sizes", [{}, {"held_cells": 0, "inner": 2, "columns": 1}])
def test_missing_numbers_and_uneven_vectors(spark, sizes):
    left = spark.createDataFrame([(1, [1.0, None, 3.0]), (2, [2.0]), (3, None), (4, []), (5, [1.0, 1.0, 1.0, 9.0])], "r int, v array<double>")
    right = spark.createDataFrame([(1, [1.0, 10.0, 100.0]), (2, [5.0]), (3, None)], "k int, v array<double>")
    got = {(r.r, r.k): r.value for r in matrix.multiply(left, right, row="r", column="k", vector="v", **sizes).collect()}
    rows = {1: [1, 0, 3], 2: [2, 0, 0], 3: [0, 0, 0], 4: [0, 0, 0], 5: [1, 1, 1]}
    columns = {1: [1, 10, 100], 2: [5, 0, 0], 3: [0, 0, 0]}
    assert got == {(r, k): float(np.dot(x, y)) for r, x in rows.items() for k, y in columns.items()}
    none = left.limit(0)
    assert matrix.multiply(none, right, row="r", column="k", vector="v", **sizes).count() == 0
    assert matrix.multiply(left, right.limit(0), row="r", column="k", vector="v", **sizes).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_dealt_and_not_broadcast(spark):
    """Each matrix is read once and moves once; nothing whole sits in the plan.
    What a key holds of the right matrix is one block of it."""
    rng = np.random.default_rng(2)
    left, right = tables(spark, rng.random((30, 8)), rng.random((8, 40)))
    product = matrix.multiply(left, right, row="r", column="k", vector="v", held_cells=0, inner=8, columns=10)
    plan = plan_of(product)
    assert "Broadcast" not in plan and "Subquery" not in plan and plan.count("Scan ExistingRDD") == 2
    assert plan.count("REPARTITION_BY_COL") == 1
    held = matrix.multiply(left, right, row="r", column="k", vector="v")
    assert "Exchange hash" not in plan_of(held) and plan_of(held).count("Scan ExistingRDD") == 1


def test_gram(spark):
    a = np.random.default_rng(3).random((50, 6))
    left, _ = tables(spark, a, a.T)
    got = {r.i: r.v for r in matrix.gram(left, "v", 6).collect()}
    assert np.allclose([got[i] for i in range(6)], a.T @ a)
