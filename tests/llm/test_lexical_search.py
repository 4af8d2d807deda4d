import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerleaf.llm import lexical_search as ls

WORD = re.compile(ls.TERM)
FOLD = str.maketrans(ls.UPPER, ls.LOWER)


def brute(docs, items, k=10):
    terms = lambda text: WORD.findall((text or "").translate(FOLD))
    read = [(d, Counter(terms(text)), len(terms(text))) for d, text in docs if terms(text)]
    n_docs, length = len(read), sum(n for _, _, n in read)
    held = Counter(t for _, counts, _ in read for t in counts)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for d, counts, n in read:
            m = 100 - 75 + 75 * n * n_docs // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t, times in wanted.items()
                if t in counts
            )
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        out += [(item, rank + 1, d, -minus) for rank, (minus, _, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=lambda r: (r[0] is not None, r[0], r[1]))


def table_of(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} bigint, text string")


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))


def made(n_docs, n_items, seed=3):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{int(rng.zipf(1.4)) % 300}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(0, 60))))) for i in range(n_docs)]
    items = [(i, " ".join(word() for _ in range(int(rng.integers(1, 12))))) for i in range(n_items)]
    return docs, items


@pytest.mark.parametrize("pairs", [ls.PASS_PAIRS, 25])
def test_equals_brute_force_in_one_pass_and_in_many(spark, pairs, monkeypatch):
    docs, items = made(700, 40)
    if pairs == 25:
        for name, size in (("ITEM_ROWS", 3), ("TERM_ROWS", 5), ("DOC_ROWS", 64)):
            monkeypatch.setattr(ls, name, size)
    got = ls.search(table_of(spark, docs, "doc_id"), table_of(spark, items, "item_id"), most_pairs=pairs)
    assert result(got) == brute(docs, items)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (None, "Été blue"), (None, "Été blue"), (9, "blue été"), (9, "blue été"), (4, "BLUE"), (5, "blue" * 9000)]
    docs += [(100 + i, "blue sky") for i in range(30)] + [(200, "x " * 200_000 + "blue")] + [(300 + i, f"other{i}") for i in range(60)]
    items = [(1, "blue"), (1, "Blue blue"), (None, "été"), (2, None), (3, "nothing-known"), (4, "sky ÉTÉ")]
    got = ls.search(table_of(spark, docs, "doc_id").selectExpr("*", "1 as score", "2 as n", "3 as terms", "4 as `row`"), table_of(spark, items, "item_id"))
    want = brute(docs, items)
    assert result(got) == want
    assert [r[2] for r in want if r[0] == 4] == list(range(100, 110))
    assert {r[0] for r in want} == {1, None, 4}


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert ls.search(table_of(spark, [], "doc_id"), table_of(spark, items, "item_id")).count() == 0
    assert ls.search(table_of(spark, docs, "doc_id"), table_of(spark, [], "item_id")).count() == 0


def test_products_stay_exact_beyond_the_range_of_doubles():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 1 << 40, (5, 30))
    impacts = rng.integers(0, 1000, (30, 7))
    want = [[sum(int(a) * int(b) for a, b in zip(row, column)) for column in impacts.T] for row in weights]
    assert ls.exact_product(weights, impacts.astype(float)).tolist() == want


def test_ties_at_the_edge_of_a_tile():
    best = ls.Best(1, 3)
    for first in range(0, 50_000, 100):  # the smallest identifiers come last
        ids = np.arange(50_000 - first, 49_900 - first, -1)
        best.offer(0, np.full((1, 100), 7), np.ones(100, bool), ids)
    assert best.settle()[3].tolist() == [1, 2, 3]
