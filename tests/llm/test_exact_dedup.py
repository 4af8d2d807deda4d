import pytest

from ledgerleaf.llm.exact_dedup import SQL, copy_groups, drop_copies

CASES = [
    (5, "a  b"), (3, "a\tb"), (9, "a b "), (7, None), (2, ""), (4, "A b"), (8, "x" * 200_000), (1, "x" * 200_000),
    (6, "x" * 199_999), (None, "a b"), (10, " a b"), (11, "a \n\r b"), (12, "lone"),
]


def norm(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for ident, text in rows:
        groups.setdefault(norm(text), []).append(ident)
    ordered = lambda ids: sorted(ids, key=lambda x: (x is None, x or 0))
    return {(i, ordered(g)[0], len(g)) for g in groups.values() for i in g}


def found(df):
    return {(r.doc_id, r.keep_id, r.group_size) for r in df.collect()}


def test_groups_are_those_of_brute_force(documents):
    assert found(copy_groups(documents(CASES))) == brute(CASES)


def test_extra_columns_with_clashing_names_and_whole_rows_stay(documents):
    docs = documents(CASES, extra=("row", "hash", "part", "digest", "at_edge", "content", "id"))
    kept = drop_copies(docs)
    assert kept.schema.names == docs.schema.names
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 9, 10, 12}
    assert found(copy_groups(docs)) == brute(CASES)


def test_repeated_rows_keep_one(documents):
    rows = [(1, "same")] * 5 + [(2, "same"), (2, "other"), (2, "other")]
    assert sorted((r.doc_id, r.text) for r in drop_copies(documents(rows)).collect()) == [(1, "same"), (2, "other")]
    assert copy_groups(documents(rows)).filter("kept").count() == 2


def test_empty_table(documents):
    assert copy_groups(documents([])).count() == 0 and drop_copies(documents([])).count() == 0


@pytest.mark.parametrize("share", [1, 3])
def test_a_hot_text_is_spread_and_put_together(spark, documents, share):
    """A text that fills much of the table lies in several parts."""
    rows = [(i, "hot text" if i % share == 0 else f"text {i}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        groups = copy_groups(documents(rows).repartition(5))
        assert found(groups) == brute(rows)
        assert sorted(r.doc_id for r in drop_copies(documents(rows)).collect()) == sorted({k for _, k, _ in brute(rows)})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_agrees_with_sql(documents, sql_rows):
    rows = [r for r in CASES if r[0] is not None]
    names, want = sql_rows(SQL, documents=documents(rows).toPandas())
    assert sorted(map(tuple, copy_groups(documents(rows)).select(*names).collect())) == sorted(want)
