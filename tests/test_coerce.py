"""Text coercions: same values with ANSI mode on and off, equal to the
implicit casts the rules were written against."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortkit.functions.coerce import as_double, as_int, parse_date

# Fixed probe values and expected results.
NUMBERS = ["42", "50.7", "-0.5", "3000000000", "abc", "1e3", " 42 ", ".5", "5.", "", "+7",
           "1,234.5", "NaN", "12f"]
EXPECTED_INT = [42, 50, 0, None, None, None, 42, 0, 5, None, 7, None, None, None]
DATES = ["2024-03-13", "2024-3-5", "2024-03-13 10:20:30", "2024-02-30", "13/03/2024", "",
         "2024-03-13T00:00", "24-03-13", " 2024-03-13", "2024-13-01", "2024", "2024-03",
         "2024-03-13abc", "2024-03-13Z", "0000-00-00", "2024-003-013"]
D = dt.date(2024, 3, 13)
# as the legacy parser reads them: "24-03-13" is year 24, "2024-003-013" is 13 March
EXPECTED_DATE = [D, dt.date(2024, 3, 5), D, None, None, None, D, dt.date(24, 3, 13), D, None,
                 None, None, D, D, None, D]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


def _one_col(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def test_as_int_probes(spark, ansi):
    rows = _one_col(spark, NUMBERS).select("i", as_int("v").alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == EXPECTED_INT


def test_as_int_equals_legacy_implicit_cast(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = _one_col(spark, NUMBERS)
        rows = df.select(F.col("v").cast("int").alias("legacy"), as_int("v").alias("ours")).collect()
        assert all(r.legacy == r.ours for r in rows)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_as_double_never_raises(spark, ansi):
    rows = _one_col(spark, NUMBERS).select(as_double("v").alias("x")).collect()
    assert len(rows) == len(NUMBERS)


def test_parse_date_probes(spark, ansi):
    rows = _one_col(spark, DATES).select("i", parse_date("v").alias("d")).orderBy("i").collect()
    assert [r.d for r in rows] == EXPECTED_DATE


def test_as_int_equals_legacy_cast_on_random_text(spark):
    """Random short strings over digits, signs, points, blanks and letters."""
    import random
    rnd = random.Random(11)
    alphabet = list("0123456789") * 3 + list(".+- e\t") + ["a", "f", ","]
    values = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 7)))
              for _ in range(5000)}
    values |= {".", "-.", "+. ", "1.", "-.5", "00012", "-0", "2147483647", "2147483648",
               "-2147483648", "-2147483649", "2147483647.9", "1.2.3"}
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(v,) for v in values], "v string")
        diff = df.where(~F.col("v").cast("int").eqNullSafe(as_int("v")))
        assert diff.count() == 0, diff.limit(10).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_oracle_int_reading_matches(spark):
    import duckdb
    from cohortkit.oracle import _int
    con = duckdb.connect()
    got = [con.execute(f"SELECT {_int('v')} FROM (SELECT ?::VARCHAR AS v)", [v]).fetchone()[0]
           for v in NUMBERS + [".", "-."]]
    assert got == EXPECTED_INT + [0, 0]


def test_parse_date_equals_legacy_parser_on_random_text(spark):
    """Against ``to_date(v, 'yyyy-MM-dd')`` under the LEGACY time parser."""
    import random
    rnd = random.Random(5)
    values = set()
    for _ in range(4000):
        y = rnd.choice(["2024", "1999", "24", "0", "02024", "20240", "+2024", " 2024", "ab"])
        m = rnd.choice(["3", "03", "12", "13", "0", "003", "1a", ""])
        d = rnd.choice(["5", "05", "31", "30", "29", "32", "0", "013", "050", ""])
        s1, s2 = rnd.choice(["-", "-", "/", "", "- "]), rnd.choice(["-", "-", "/", "", "-\t"])
        tail = rnd.choice(["", " 10:20:30", "T00:00", "abc", "Z", " ", "0"])
        values.add(f"{y}{s1}{m}{s2}{d}{tail}")
    old_ansi = spark.conf.get("spark.sql.ansi.enabled")
    old_policy = spark.conf.get("spark.sql.legacy.timeParserPolicy")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")
    try:
        df = spark.createDataFrame([(v,) for v in values], "v string")
        diff = df.where(~F.to_date("v", "yyyy-MM-dd").eqNullSafe(parse_date("v")))
        assert diff.count() == 0, diff.select("v").limit(10).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)
        spark.conf.set("spark.sql.legacy.timeParserPolicy", old_policy)


def test_oracle_date_reading_matches(spark):
    import duckdb
    from cohortkit.oracle import _date
    con = duckdb.connect()
    got = [con.execute(f"SELECT {_date('v')} FROM (SELECT ?::VARCHAR AS v)", [v]).fetchone()[0]
           for v in DATES]
    assert got == EXPECTED_DATE
