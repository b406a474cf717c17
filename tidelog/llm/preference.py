"""Chosen and rejected conversations as one prompt and two masked completions.

DataFrame operations only. A conversation is an array of turns in one row, as the training
example made of it has to be. The longest common prefix of turns is rendered once; what
follows on either side is its completion, and only the assistant's turns in it count
towards the loss: their spans are character offsets into the completion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) from rows (conv_id, turn, role, text).

    Turns are ordered by turn, role and text, nulls first; a row repeated in full counts
    once, rows without conv_id belong to no conversation. Other columns are not read.
    """
    rows = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    # repeated rows are neighbours now
    new = F.filter("all", lambda t, i: (i == 0) | ~t.eqNullSafe(F.get("all", i - 1)))
    return sorted_.select(
        "conv_id", F.transform(new, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def _last_answer(turns: Column) -> Column:
    """Index from 0 of the last assistant turn; null without one."""
    at = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: F.get(turns, i)["role"] == ASSISTANT)
    return F.array_max(at)


def swapped_answers(convs: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): each conversation against itself with its neighbour's last answer.

    The neighbour of an even conv_id is the next id, of an odd one the id before. Where
    the neighbour is missing or never answers, the rejected side ends before the answer;
    a conversation without answer is its own rejected side.
    """
    at = convs.select("conv_id", "turns", _last_answer(F.col("turns")).alias("at"))
    other = at.select(
        F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"),
        F.get("turns", F.col("at")).alias("answer"),
        F.col("at").isNotNull().alias("answers"),
    )
    before = F.slice("turns", F.lit(1), F.col("at"))
    after = F.slice("turns", F.col("at") + 2, F.size("turns"))
    rejected = (
        F.when(F.col("at").isNull(), F.col("turns"))
        .when(F.coalesce("answers", F.lit(False)), F.concat(before, F.array("answer"), after))
        .otherwise(F.concat(before, after))
    )
    joined = at.join(other, "conv_id", "left")
    return joined.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def _rendered(turns: Column) -> Column:
    """Text of each turn. Markers inside a text are broken up; null roles and texts are empty."""

    def one(turn):
        safe = F.replace(F.coalesce(turn["text"], F.lit("")), F.lit("<|"), F.lit("< |"))
        role = F.replace(F.coalesce(turn["role"], F.lit("")), F.lit("<|"), F.lit("< |"))
        return F.concat(F.lit(START), role, F.lit("\n"), safe, F.lit(END + "\n"))

    return F.transform(turns, one)


def _spans(turns: Column, texts: Column) -> Column:
    """(start, end) of what the assistant says, end marker included, in the joined texts."""
    head = len(START) + len(ASSISTANT) + 1
    none = F.array().cast("array<struct<start:int,end:int>>")
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(acc, i):
        end = acc["at"] + F.length(F.get(texts, i))
        span = F.struct((acc["at"] + head).alias("start"), (end - 1).alias("end"))
        said = F.get(turns, i)["role"] == ASSISTANT
        return F.struct(
            end.alias("at"), F.when(said, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans")
        )

    every = F.when(F.size(turns) > 0, F.sequence(F.lit(0), F.size(turns) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(every, state, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Prompt and masked completions of (pair_id, chosen, rejected), arrays of (role, text).

    Columns: pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans
    and tied (both sides equal: empty completions, no preference to learn). Turns are equal
    when role and text are, null equal to null. A null side is a conversation without
    turns. Every row comes back; other columns are dropped.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select(
        "pair_id", F.coalesce("chosen", none).alias("chosen"), F.coalesce("rejected", none).alias("rejected")
    )
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    common = F.when(F.array_contains(same, False), F.array_position(same, False) - 1).otherwise(F.size(same))
    cut = sides.withColumn("n", common.cast("int"))
    rest = {side: F.slice(side, F.col("n") + 1, F.size(side)) for side in ("chosen", "rejected")}
    cut = cut.select(
        "pair_id",
        "n",
        F.slice("chosen", F.lit(1), F.col("n")).alias("shared_turns"),
        *[c.alias(f"{s}_turns") for s, c in rest.items()],
    )
    texts = cut.select("*", *[_rendered(F.col(f"{s}_turns")).alias(f"{s}_texts") for s in ("shared", *rest)])
    return texts.select(
        "pair_id",
        F.col("n").alias("prompt_turns"),
        F.array_join("shared_texts", "").alias("prompt"),
        *[F.array_join(f"{s}_texts", "").alias(s) for s in rest],
        *[_spans(F.col(f"{s}_turns"), F.col(f"{s}_texts")).alias(f"{s}_spans") for s in rest],
        ((F.size("chosen_turns") == 0) & (F.size("rejected_turns") == 0)).alias("tied"),
    )
