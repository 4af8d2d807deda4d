"""Every registered query that has SQL agrees with it on the smallest tables."""

import pytest
from oracle import TABLES, compare, connect

from ledgerleaf import catalog

SF_DIR = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(catalog.queries()[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(catalog.queries())


def test_entry_is_lazy_and_has_rows(spark):
    import __spark_entry__ as contract

    spark.sparkContext.setJobGroup("entry", "entry")
    df = contract.entry(spark)
    # Reading a footer for the schema is no query job.
    begun = spark.sparkContext.statusTracker().getJobIdsForGroup("entry")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(begun) <= 2
    assert df.columns[0] == "c_custkey" and df.count() == 150
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_queries_read_the_given_tables(spark, tmp_path):
    """Half of a table gives half of the rows."""
    for name in TABLES:
        if name != "customer":
            (tmp_path / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
    spark.read.parquet(f"{SF_DIR}/customer.parquet").filter("c_custkey < 75").write.parquet(str(tmp_path / "customer.parquet"))
    for name in ("sink_text", "split_hash", "split_random", "fn_arith"):
        counts = [catalog.queries()[name](spark, d).count() for d in (SF_DIR, str(tmp_path))]
        assert counts == [150, 75]
