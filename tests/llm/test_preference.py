import pytest

from blocktide.llm import sql
from blocktide.llm.preference import cut_answers, preference_texts, preference_turns
from blocktide.llm.queries import QUERIES
from tests.compare import compare, duck
from tests.llm.cases import SMALL

TURNS = "pair_id long, turn long, role string, text string"


def test_query_equals_sql(spark):
    name = "op2_preference"
    assert compare(spark, duck(SMALL), name, QUERIES[name], sql.ORACLE[name], SMALL) is None


def test_prefix_ends_where_sides_differ(spark):
    same = [(1, 0, "system", "s"), (1, 1, "user", "hi")]
    chosen = spark.createDataFrame([*same, (1, 2, "assistant", "good"), (1, 3, "user", "ok")], TURNS)
    rejected = spark.createDataFrame([*same, (1, 2, "assistant", "bad"), (1, 3, "user", "ok")], TURNS)
    rows = preference_turns(chosen, rejected)
    got = {(r.part, r.turn): r for r in rows.collect()}
    # Turns after the first difference are completion even where they are equal.
    assert set(got) == {("prompt", 0), ("prompt", 1), ("chosen", 2), ("chosen", 3), ("rejected", 2), ("rejected", 3)}
    good = got["chosen", 2]
    assert good.rendered[good.loss_start : good.loss_end] == "good<|end|>"
    assert all(r.loss_end == 0 for (p, _), r in got.items() if p == "prompt" or r.role == "user")
    whole = preference_texts(rows).first()
    assert whole.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert whole.rejected == "<|assistant|>\nbad<|end|>\n<|user|>\nok<|end|>\n"


@pytest.mark.parametrize("swap", [False, True])
def test_odd_pairs(spark, swap):
    one = spark.createDataFrame(
        [(1, 0, None, None), (1, 0, None, None), (1, 1, "assistant", "x"), (2, 0, "user", "only"),
         (None, 0, "user", "lost"), (3, None, "user", "lost"), (4, 0, "user", "b"), (4, 0, "user", "a")],
        TURNS,
    ).selectExpr("*", "'clash' AS part", "'clash' AS ord")
    two = spark.createDataFrame(
        [(1, 0, "user", ""), (1, 1, "assistant", "x"), (4, 0, "user", "a"), (4, 0, "user", "b")], TURNS
    )
    rows = preference_turns(two, one) if swap else preference_turns(one, two)
    got = sorted((r.pair_id, r.part, r.turn, r.ord) for r in rows.collect())
    side = "rejected" if swap else "chosen"
    assert got == [(1, "prompt", 0, 0), (1, "prompt", 1, 0), (2, side, 0, 0), (4, "prompt", 0, 0), (4, "prompt", 0, 1)]


def test_empty_tables_and_cut_answers(spark):
    none = spark.createDataFrame([], TURNS)
    assert preference_turns(none, none).count() == 0
    turns = spark.createDataFrame(
        [(1, 0, "user", "q"), (1, 1, "assistant", "abcd"), (1, 2, "user", "bye"), (2, 0, "user", "q")],
        "conv_id long, turn long, role string, text string",
    )
    chosen, rejected = cut_answers(turns)
    assert sorted(map(tuple, chosen.collect())) == [(1, 0, "user", "q"), (1, 1, "assistant", "abcd")]
    assert sorted(map(tuple, rejected.collect())) == [(1, 0, "user", "q"), (1, 1, "assistant", "ab")]
