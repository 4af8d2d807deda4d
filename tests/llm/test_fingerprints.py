import hashlib
import random
import re

import numpy as np
import pytest

from ledgerleaf.llm import fingerprints as fp


def runs(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    a, b = runs(a), runs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def near(a, b):
    x, y = (fp.codes([t.encode()]) for t in (a, b))
    return float(fp.likeness(x, y)[0])


@pytest.mark.parametrize("words", [30, 200, 3000])
def test_likeness_estimates_jaccard_without_bias(words):
    rng = random.Random(words)
    errors = []
    for _ in range(40):
        a = text_of(rng, words)
        cut = rng.randrange(len(a))
        b = a[:cut] + text_of(rng, words)[: len(a) - cut]
        errors.append(near(a, b) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.03 and np.sqrt(np.mean(np.square(errors))) < (0.12 if words < 100 else 0.06)


def test_defined_cases():
    assert near("", " \n") == 1.0 and near("", "a") == 0.0 and near("a b", "A  b") == 1.0
    assert near("a b", "a c") < 0.2
    low, some = fp.unpacked(fp.packed(*fp.codes([b"", b"one two", b"x " * 9])))
    again = fp.codes([b"", b"one two", b"x " * 9])
    assert (low[1:] == again[0][1:]).all() and some.tolist() == [False, True, True]


def test_densification_fills_every_bin_from_the_text_itself():
    found = np.full((3, fp.BINS), fp._EMPTY)
    found[0, 7] = 5
    found[1, [3, 90]] = [1, 2]
    filled = fp.densified(found)
    assert (filled[0] == 5).all() and set(filled[1]) == {1, 2} and (filled[2] == fp._EMPTY).all()


def successors(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    return [(r[0], r[1] or "", order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)]


@pytest.mark.parametrize("n,parts", [(1, 8), (2, 8), (37, 8), (700, 8), (700, 1), (700, 200)])
def test_successors_and_digests(spark, documents, n, parts):
    rng = random.Random(n)
    rows = [(i * 3, text_of(rng, rng.randrange(40))) for i in range(n)]
    check(spark, documents(rows).repartition(3), rows, parts)


def test_ties_nulls_and_clashing_columns(spark, documents):
    rows = [(5, "five"), (5, "also five words in here"), (None, "no id"), (None, None), (7, "é" * 100), (2, ""), (9, "x y " * 20_000), (9, "x")]
    check(spark, documents(rows, extra=("part", "tail", "content", "id")), rows, 4)
    only_null = [(None, "b c d"), (None, "a")]
    check(spark, documents(only_null), only_null, 4)
    assert fp.neighbour_fingerprints(documents([])).count() == 0


def check(spark, docs, rows, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = fp.neighbour_fingerprints(docs).collect()
        plain = {(r.doc_id, r.fingerprint) for r in fp.fingerprint_column(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = []
    for ident, text, following in successors(rows):
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        a, b, c = (fp.codes([t.encode()]) for t in (text, changed, following))
        want.append((ident, len(text), hashlib.sha256(changed.encode()).hexdigest(), fp.packed(*a)[0], fp.packed(*b)[0],
                     float(fp.likeness(a, b)[0]), float(fp.likeness(a, c)[0])))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert plain == {(w[0], w[3]) for w in want}
