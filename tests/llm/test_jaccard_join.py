import random
import re

import numpy as np
import pytest

from ledgerleaf.llm import jaccard_join as join
from ledgerleaf.llm.components import connected_components
from ledgerleaf.llm.signature_tree import Linker, overlap


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(rows):
        key = find(i)
        least[key] = min((x for x in (least.get(key), ident) if x is not None), default=None)
    return sorted(((ident, len(sets[i]), least[find(i)]) for i, (ident, _) in enumerate(rows)), key=str)


def made_rows(seed=5, n=150):
    """Families of edited copies, chains, shared passages, copies, short and empty texts."""
    rng = random.Random(seed)
    words = lambda k: [f"w{rng.randrange(3000)}" for _ in range(k)]
    passage, rows = words(60), []
    for i in range(n):
        kind = i % 5
        if kind == 0:
            base = words(rng.randrange(5, 120))
        elif kind == 1:
            base = [*words(rng.randrange(3, 60)), *passage, *words(rng.randrange(3, 60))]
        elif kind == 2 and rows:
            base = (rng.choice(rows)[1] or "").split()
        else:
            base = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.randrange(1, 4)):
                if base:
                    base[rng.randrange(len(base))] = f"e{rng.randrange(9999)}"
        rows.append((i, rng.choice((" ", "\n", " \t")).join(base)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "A b c"), (904, "a B  c"), (905, "a b"), (None, "a b"), (906, "x " * 30_000), (907, "X " * 31_000)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (3, "another text under the same identifier as before")]
    return rows


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(documents, seed):
    rows = made_rows(seed)
    docs = documents(rows, extra=("rec", "home", "n", "content", "grp", "component")).repartition(5)
    assert found(join.jaccard_components(docs)) == brute(rows)


def test_wide_neighbourhoods_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(join, "SAMPLE_ONE_IN", 2)
    rows = made_rows(7, 100)
    made = join.jaccard_records(documents(rows).repartition(3), unit_tokens=300).select("id", "n", "least_id")
    assert found(made) == brute(rows)


def test_threshold_is_met_exactly(documents):
    base = [f"t{i}" for i in range(39)]  # 35 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:31])), (3, " ".join(base[:30] + ["q"] * 1))]
    assert found(join.jaccard_components(documents(rows))) == brute(rows)
    edge = [(1, " ".join(f"a{i}" for i in range(24))), (2, " ".join(f"a{i}" for i in range(19))), (3, " ".join(f"a{i}" for i in range(4, 18)))]
    assert found(join.jaccard_components(documents(edge))) == brute(edge)  # 15 of 20 links


def test_drop_near_copies(documents):
    rows = made_rows(3, 80)
    docs = documents(rows, extra=("rec", "mark", "id", "content"))
    kept = join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    groups = brute(rows)
    want = {least for _, n, least in groups if n}
    assert {r.doc_id for r in got if shingles(r.text)} == want
    assert sorted(r.doc_id for r in got if not shingles(r.text)) == [900, 901, 902]
    classes = {(ident, least) for ident, n, least in groups if n}
    assert len([r for r in got if shingles(r.text)]) <= len(classes)
    assert join.drop_near_copies(documents([])).count() == 0 and join.jaccard_components(documents([])).count() == 0


def test_repeated_rows_leave_one(documents):
    rows = [(1, "one two three four five six")] * 4 + [(2, "alone in this place with its words")]
    assert sorted(r.doc_id for r in join.drop_near_copies(documents(rows)).collect()) == [1, 2]


@pytest.mark.parametrize("n,tokens,flips", [(400, 60, 2), (300, 12, 1), (60, 900, 300)])
def test_signature_trees_find_what_all_pairs_find(n, tokens, flips):
    rng = np.random.default_rng(n)
    centres = [rng.choice(1 << 62, tokens, replace=False) for _ in range(4)]
    sets = []
    for i in range(n):
        s = centres[i % 4].copy() if i % 7 else rng.choice(1 << 62, rng.integers(1, tokens), replace=False)
        s[rng.integers(0, len(s), rng.integers(0, flips + 1))] = rng.integers(1 << 62)
        sets.append(np.unique(s).astype(np.uint64))
    linker = Linker(sets)
    linker.run()
    want = Linker(sets)
    for i in range(n):
        for j in range(i):
            o = overlap(sets[i], sets[j])
            assert o == len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                want.groups.union(i, j)
    assert linker.groups.labels().tolist() == want.groups.labels().tolist()
    assert linker.compared < n * (n - 1) / 4


def test_a_large_group_needs_few_comparisons():
    rng = np.random.default_rng(1)
    base = rng.choice(1 << 62, 80, replace=False).astype(np.uint64)
    sets = []
    for _ in range(3000):
        s = base.copy()
        s[rng.integers(0, 80, 3)] = rng.integers(1 << 62, size=3)
        sets.append(np.unique(s))
    linker = Linker(sets)
    linker.run()
    assert len(set(linker.groups.labels().tolist())) == 1 and linker.compared < 4 * len(sets)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("ident", [None, 7])
def test_a_shared_identifier_fetches_each_text_once(documents, monkeypatch, ident):
    words = [f"w{k}" for k in range(60)]
    rows = [(ident, " ".join([*words, f"end{i}"])) for i in range(25)]
    fetched, linked = [], join._linked
    monkeypatch.setattr(join, "_linked", lambda dealt: fetched.append(dealt.count()) or linked(dealt))
    got = join.jaccard_components(documents(rows)).collect()
    assert [(r.doc_id, r.component_id) for r in got] == [(ident, ident)] * 25
    assert fetched == [25]


def test_equal_rows_under_one_identifier_deal_one_text(documents, monkeypatch):
    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words))] * 500 + [(2, " ".join([*words, "end"]))]
    dealt, linked = [], join._linked
    monkeypatch.setattr(join, "_linked", lambda rows: dealt.append(rows.count()) or linked(rows))
    assert found(join.jaccard_components(documents(rows).repartition(4))) == brute(rows)
    assert dealt == [2]


def test_an_unlinked_wide_neighbourhood_sends_few_texts(documents, monkeypatch):
    """Each text has a third of its words in common with the next: one
    neighbourhood of many chunks, no links."""
    rng = random.Random(9)
    shared = [[f"s{i}_{k}" for k in range(20 + i // 4)] for i in range(121)]
    rows = []
    for i in range(120):
        own = [f"o{i}_{k}" for k in range(20 + i // 4)]
        rows.append((i, " ".join(shared[i] + own + shared[i + 1])))
    rng.shuffle(rows)
    dealt, linked = [], join._linked
    monkeypatch.setattr(join, "ASKED_ONE_IN", 1 << 30)
    monkeypatch.setattr(join, "prefix_lengths", lambda n: n)
    monkeypatch.setattr(join, "_linked", lambda rows: dealt.append(rows.select("unit1", "unit2", "unit3", "rec").collect()) or linked(rows))
    made = join.jaccard_records(documents(rows).repartition(3), unit_tokens=1500).select("id", "n", "least_id")
    assert found(made) == brute(rows)
    chunks = len({r.unit2 for r in dealt[0]})
    assert len(dealt) == 3 and len({r.unit1 for r in dealt[0]}) == 1 and chunks > 8
    assert len(dealt[2]) < len(rows) * chunks / 2


def test_parts_by_size_are_bounded_and_narrow(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(2), k, rng.randrange(1, 400)) for k in range(4000)]
    frame = spark.createDataFrame(rows, "home bigint, rec bigint, n bigint")
    got = join._by_size(frame, frame.filter("home = 1"), 9000, "part").collect()
    assert len(got) == len(rows) and all((r.part is None) == (r.home == 0) for r in got)
    parts = {}
    for r in got:
        if r.home:
            parts.setdefault(r.part, []).append(r.n)
    assert max(map(sum, parts.values())) < 9000 and len(parts) < 4 * sum(map(sum, parts.values())) / 9000
    assert all(max(p) <= 1.6 * min(p) for p in parts.values() if min(p) > 100)
