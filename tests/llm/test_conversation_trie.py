import hashlib
import zlib

import numpy as np
import pytest

from ledgerleaf.llm import conversation_trie as ct


def brute(rows):
    """Nodes by literal prefixes; rows (conv_id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fix(c / 100)) * 100
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, mine in members.items():
        gain = (len(mine) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += gain
            leaves[path[:d]] += children[path] == 0
    out = []
    for path, mine in members.items():
        ends = ",".join(str(c) for c in sorted(mine) if whole[c] == path)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(mine), len(path), parent, len(mine), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def result(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    return sorted((tuple(r) for r in ct.conversation_trie(df, **sizes).select(*COLUMNS).collect()), key=str)


def made(n, seed=1, most=9):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        conv = int(rng.integers(-250, 900))
        for turn in range(int(rng.integers(1, most))):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], "abc"[: 1 + int(rng.integers(0, 2))] * (1 + turn)))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"band": 2, "shard": 12}, {"band": 3, "shard": 1}])
def test_equals_brute_force_however_it_is_cut(spark, sizes):
    rows = made(150)
    assert result(spark, rows, **sizes) == brute(rows)


def test_copies_of_a_conversation_and_one_that_is_long(spark):
    """A hot first turn, many equal conversations and one with far more turns than a segment."""
    rows = [(c, t, "user", f"hello {t}") for c in range(1000, 1060) for t in range(9)]
    rows += [(5, t, "user", f"long {t // 2}") for t in range(60)]
    rows += [(c, t, "user", "hello 0" if t == 0 else f"own {c} {t}") for c in range(40) if c != 5 for t in range(4)]
    got = result(spark, rows, band=16, shard=40)
    assert got == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, None), (1, None, "user", None), (1, 2, "a", "b"), (1, 2, "a", "b"), (1, 2, "", "ab"), (None, 1, "user", "x")]
    rows += [(100, t, "user", f"t{t}") for t in range(8)] + [(c, 0, "user", "short") for c in range(101, 130)] + [(-3, 1, "u", "é" * 5)]
    rows += [(7, 0, "user", "x" * 300_000)]
    assert result(spark, rows) == brute(rows)
    assert any(r[3] > 1 and r[1] == 0 for r in brute(rows))


def test_empty_table_and_further_columns(spark):
    assert result(spark, []) == []
    rows = made(20)
    df = spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, symbol string, prefix binary")
    assert sorted((tuple(r) for r in ct.conversation_trie(df).select(*COLUMNS).collect()), key=str) == brute(rows)


def test_trees_of_siblings_are_balanced():
    tree = ct.Tree()
    order = list(ct.middles(1000))
    assert sorted(order) == list(range(1000))
    for symbol in order:
        tree.insert([symbol], [1])

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.less[at]), height(tree.more[at]))

    assert height(tree.down[0]) == 10


def test_digests_of_long_groups_stream_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE", 50)
    pairs = [(b"a", i) for i in range(-500, 1500)] + [(b"b", 7), (b"c", -1), (b"c", 3)]
    got = {bytes(r.ended): r.ends for r in ct.end_digests(spark.createDataFrame(pairs, "ended binary, conv_id bigint").repartition(5)).collect()}
    want = {k: hashlib.sha256(",".join(str(i) for i in sorted(i for q, i in pairs if q == k)).encode()).hexdigest() for k in (b"a", b"b", b"c")}
    assert got == want
