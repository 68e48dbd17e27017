import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or longer rows."""
    def make(rows):
        full = [tuple(r) + ("en", "s", None)[len(r) - 2:] for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def sql_rows():
    """Rows of a DuckDB query over pandas tables given by name."""
    def run(sql, **tables):
        con = duckdb.connect()
        for name, frame in tables.items():
            con.register(name, frame)
        return con.execute(sql).df()
    return run
