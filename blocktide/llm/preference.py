"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns becomes the prompt, rendered once; what
follows becomes the two completions. The result has a row for each rendered
turn, so that no conversation, however long, has to fit in one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def _turns(df: DataFrame, says: str) -> DataFrame:
    said = F.struct(
        F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = df.filter(F.col("pair_id").isNotNull() & F.col("turn").isNotNull())
    return rows.groupBy("pair_id", "turn").agg(F.array_sort(F.collect_set(said)).alias(says))


def preference_turns(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rendered turns of every pair, from two tables (pair_id, turn, role, text).

    ``part`` is prompt, chosen or rejected. ``rendered`` holds a role header, the
    text and an end mark; characters ``loss_start`` to ``loss_end`` bear loss:
    text and end mark of assistant turns in completions, nothing elsewhere
    (both 0). A prompt ends before the first turn number at which the sides
    differ or only one side speaks.

    Rows without pair or turn number belong to no conversation and are left out;
    a null role is a user, a null text is empty. Repeated rows count once; several
    rows of one turn are compared as a set and rendered in order of role and text.
    A pair with equal sides is all prompt; a pair with one side has no prompt.
    Other columns are ignored; empty tables give no rows.
    """
    both = _turns(chosen, "_chosen").join(
        _turns(rejected, "_rejected"), ["pair_id", "turn"], "full_outer"
    )
    differs = ~F.col("_chosen").eqNullSafe(F.col("_rejected"))
    cuts = both.filter(differs).groupBy("pair_id").agg(F.min("turn").alias("_cut"))
    parted = both.join(cuts, "pair_id", "left")
    common = F.col("_cut").isNull() | (F.col("turn") < F.col("_cut"))

    def part(name: str, says: str) -> Column:
        return F.struct(F.lit(name).alias("part"), F.col(says).alias("says"))

    parts = F.when(common, F.array(part(PROMPT, "_chosen"))).otherwise(
        F.filter(
            F.array(part(CHOSEN, "_chosen"), part(REJECTED, "_rejected")),
            lambda p: p["says"].isNotNull(),
        )
    )
    one = parted.select("pair_id", "turn", F.explode(parts).alias("p"))
    said = one.select(
        "pair_id", F.col("p.part").alias("part"), "turn", F.posexplode("p.says").alias("ord", "s")
    )
    head = F.concat(F.lit("<|"), F.col("s.role"), F.lit("|>\n"))
    rendered = F.concat(head, F.col("s.text"), F.lit("<|end|>\n"))
    bears = (F.col("part") != PROMPT) & (F.col("s.role") == "assistant")
    return said.select(
        "pair_id",
        "part",
        F.col("turn").cast("long").alias("turn"),
        F.col("ord").cast("long").alias("ord"),
        F.col("s.role").alias("role"),
        rendered.alias("rendered"),
        F.when(bears, F.length(head)).otherwise(0).cast("long").alias("loss_start"),
        F.when(bears, F.length(rendered) - 1).otherwise(0).cast("long").alias("loss_end"),
    )


def preference_texts(turns: DataFrame) -> DataFrame:
    """One row for each pair with its three whole texts, for pairs that fit in a row."""
    lines = F.array_sort(F.collect_list(F.struct("turn", "ord", "rendered")))
    parts = turns.groupBy("pair_id", "part").agg(lines.alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["rendered"]), "")
    return parts.withColumn("text", text).groupBy("pair_id").agg(
        *[
            F.coalesce(F.max(F.when(F.col("part") == p, F.col("text"))), F.lit("")).alias(p)
            for p in (PROMPT, CHOSEN, REJECTED)
        ]
    )


def cut_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides made from finished conversations.

    Chosen is a conversation up to its last assistant turn; rejected is the same
    with only the first half of that turn's characters. Conversations without an
    assistant turn give nothing.
    """
    rows = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = (
        rows.filter(F.col("role") == "assistant").groupBy("pair_id").agg(F.max("turn").alias("_last"))
    )
    chosen = rows.join(last, "pair_id").filter(F.col("turn") <= F.col("_last"))
    half = F.expr("substring(text, 1, cast(length(text) DIV 2 AS int))")
    cut = (F.col("turn") == F.col("_last")) & (F.col("role") == "assistant")
    rejected = chosen.withColumn("text", F.when(cut, half).otherwise(F.col("text")))
    return chosen.drop("_last"), rejected.drop("_last")
