"""The operators that have a SQL form against it, on whole tables, and on odd rows."""

import duckdb
import pytest

from lapse.llm import queries as Q
from lapse.llm.chat_format import chat_format
from lapse.llm.quality_rules import quality_rules
from tests.conftest import SF001
from tools.oracle_check import canon, duck


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, name):
    got = canon(Q.queries()[name](spark, SF001).toPandas())
    assert got == canon(duck(SF001).execute(Q.oracle_sql()[name]).fetchdf())


def odd(name, frame, sql):
    con = duckdb.connect()
    con.register(name, frame)
    return canon(con.execute(sql).fetchdf())


def test_odd_texts_match_oracle(spark):
    texts = ["", "   \n\t ", "a b c a b c a b c", "ONE TWo THRee ÜBER x\ny\nx\n\nx", "# & | <a> $", "a b", "w " * 500, "é ü   x\x0by\x0cz"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None), (2, texts[2])], "doc_id long, text string")
    assert canon(quality_rules(docs).toPandas()) == odd("documents", docs.toPandas(), Q.oracle_sql()["op5_quality_rules"])


def test_odd_turns_match_oracle(spark):
    rows = [(1, 0, "user", "a \\ b </s>"), (1, 1, "assistant", None), (2, 0, "tool", "[TURN]x[/TURN] \\|"), (3, 0, "system", ""),
            (3, 1, "user", "[SYS]"), (3, 2, "assistant", "<s></s>\n"), (4, 0, "user", "x"), (4, 0, "user", "x"), (5, 1, "assistant", "first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert canon(chat_format(turns).toPandas()) == odd("conversations", turns.toPandas(), Q.oracle_sql()["op4_chat_format"])
