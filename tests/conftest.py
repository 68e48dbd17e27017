import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("cohortkit-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortkit-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        for t in ("orders", "customer"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return connect


def norm_rows(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
             "date": "DATE", "boolean": "BOOLEAN"}


def assert_same(sdf, con, sql):
    """Spark result equals the DuckDB result: same column names and types,
    same rows as a multiset."""
    scols = sdf.columns
    rel = con.sql(sql)
    dcols = rel.columns
    assert sorted(scols) == sorted(dcols)
    dtypes = dict(zip(dcols, (str(t) for t in rel.types)))
    assert {c: SQL_TYPES.get(t, t) for c, t in sdf.dtypes} == {c: dtypes[c] for c in scols}
    idx = [dcols.index(c) for c in scols]
    srows = norm_rows([tuple(r) for r in sdf.collect()])
    drows = norm_rows([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert len(srows) == len(drows)
    assert srows == drows
