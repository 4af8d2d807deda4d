import math

import pytest

from ledgerleaf.llm.source_mixing import MOST_REPEATS, mix_plan, mix_sources, source_targets


def reshared(sizes, weights=(5, 2, 1), most=3):
    """Targets by literal resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, total, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        left = total - sum(target.values())
        share = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * share > most * sizes[s]}
        for s in above or open_:
            target[s] = most * sizes[s] if above else weight[s] * share
        open_ -= above or open_
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 10, None: 500, "B": 70},
        {"a": 1, "b": 1, "c": 1_000_000},
        {"only": 12},
        {f"s{i}": (i * 37) % 91 for i in range(40)},
        {"a": 0, "b": 0},
        {"a": 0, "b": 9},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys()
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=1e-6)
        assert got[name] <= MOST_REPEATS * sizes[name]


def test_copies_follow_the_rate_and_reruns_agree(documents):
    rows = [(i, "w " * (1 + i % 7), "en", "big" if i % 3 else f"s{i % 9}") for i in range(4000)]
    docs = documents(rows)
    plan = mix_plan(docs).collect()
    for source in {r[3] for r in rows}:
        mine = [r for r in plan if r.source == source]
        rate = mine[0].target / mine[0].source_size
        assert {r.copies for r in mine} <= {math.floor(rate), math.floor(rate) + 1, MOST_REPEATS}
        assert sum(r.size * r.copies for r in mine) == pytest.approx(mine[0].target, rel=0.1)
    assert sorted(plan) == sorted(mix_plan(docs.repartition(3)).collect())
    taken = sorted((r.id, r.copies) for r in plan if r.copies)
    out = {}
    for r in mix_sources(docs).collect():
        out[r.doc_id] = out.get(r.doc_id, 0) + 1
    assert sorted(out.items()) == taken


def test_nulls_empty_texts_ties_and_clashing_columns(documents):
    rows = [(1, None, "en", None), (2, "", "en", "a"), (3, " \t\x0b", None, "a"), (None, "x y", "en", "a"), (5, "b", None, "b"), (5, "b", None, "b")]
    docs = documents(rows, extra=("size", "source_size", "target", "copies", "copy", "row", "id", "rate"))
    plan = {(r.id, r.source, r.size) for r in mix_plan(docs).collect()}
    assert plan == {(1, None, 0), (2, "a", 0), (3, "a", 0), (None, "a", 2), (5, "b", 1)}
    assert mix_sources(docs).schema.names == docs.schema.names
    assert mix_sources(docs).count() >= 1
    assert mix_plan(documents([])).count() == 0 and mix_sources(documents([])).count() == 0
