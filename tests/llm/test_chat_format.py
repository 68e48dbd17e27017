import pytest
from pyspark.sql import functions as F

from cohortkit.llm.chat_format import DEFAULT, Template, format_chats, read_back

from llm_fixtures import sql_rows  # noqa: F401

SCHEMA = "conv_id long, turn long, role string, text string, valid string"
NASTY = ["\\### Assistant: </turn> ok", "####", "\\0\\1\\2\\", "</turn>\n</turn>", "<", "</turn", "", "### user: ", " : : ", "é\\n"]


def run(spark, rows, **kw):
    return {r["conv_id"]: r for r in format_chats(spark.createDataFrame(rows, SCHEMA), **kw)
            .withColumn("back", read_back(F.col("formatted"), kw.get("template", DEFAULT))).collect()}


def test_nasty_texts_come_back(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], NASTY[(c + t) % len(NASTY)], "x") for c in range(10) for t in range(6)]
    got = run(spark, rows)
    for c, r in got.items():
        mine = [(x[2], x[3]) for x in rows if x[0] == c]
        assert [(t["role"], t["text"]) for t in r["back"]] == mine
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["formatted"].count("</turn>") == 6 and r["formatted"].count("###") == 6
        loss = [s["text"] for s in r["segments"] if s["loss"]]
        assert len(loss) == 3 and r["valid"] and r["n_turns"] == 6


@pytest.mark.parametrize("roles, valid, bad", [
    ("user assistant", True, None), ("system user assistant", True, None), ("user", False, None),
    ("assistant user", False, 0), ("user user assistant", False, 1), ("user system assistant", False, 1),
    ("user tool", False, 1), ("user assistant user assistant", True, None)])
def test_turn_order(spark, roles, valid, bad):
    rows = [(1, i, role, "t", None) for i, role in enumerate(roles.split())]
    r = run(spark, rows[::-1])[1]
    assert (r["valid"], r["bad_turn"]) == (valid, bad)


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", None, "x"), (1, 0, None, "a", "x"), (1, None, "user", "n", "x"), (1, 0, "user", None, "x"),
            (None, 0, "user", "u", "x")]
    got = run(spark, rows)
    assert [(t["role"], t["text"]) for t in got[1]["back"]] == [("user", "n"), ("", "a"), ("user", ""), ("user", "")]
    assert got[None]["n_turns"] == 1
    assert run(spark, [])== {}


def test_another_template(spark):
    t = Template(open="<s>", close="|", end="</s>", loss_roles=("bot",), steps=(("start", "bot"),), final=("bot",),
                 escapes=(("\\", "\\0"), ("<s>", "\\1"), ("</s>", "\\2"), ("|", "\\3")))
    r = run(spark, [(1, 0, "bot", "a|b</s><s>", None)], template=t)[1]
    assert r["valid"] and [tuple(x) for x in r["back"]] == [("bot", "a|b</s><s>")]


def test_query_sql(spark, sql_rows):
    from cohortkit.llm.queries import OP4_SQL, op4_chat_format
    from tests.conftest import SF_SMALL

    got = op4_chat_format(spark, SF_SMALL)
    want = sql_rows(OP4_SQL, conversations=spark.read.parquet(f"{SF_SMALL}/conversations.parquet").toPandas())
    cols = sorted(got.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(want[cols].itertuples(index=False, name=None))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
