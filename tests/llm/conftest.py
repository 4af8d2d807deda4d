import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Builds a small documents table: rows (doc_id, text[, lang[, source]])."""

    def build(rows, extra=()):
        full = [tuple(r) + (None,) * (4 - len(r)) + tuple("x" for _ in extra) for r in rows]
        names = "doc_id bigint, text string, lang string, source string" + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame(full, names)

    return build


@pytest.fixture(scope="session")
def sql_rows():
    """Runs DuckDB SQL over tables given as pandas frames."""

    def run(sql, **frames):
        con = duckdb.connect()
        for name, frame in frames.items():
            con.register(name, frame)
        rel = con.sql(sql)
        return rel.columns, rel.fetchall()

    return run
