"""Preference formatting: one prompt, two masked completions.

The turns of a chosen and a rejected conversation are put in order, their longest
common prefix of equal (role, text) turns is found and rendered once as the prompt,
and what follows on each side is rendered as its completion. A mask of character
ranges (start, end exclusive, in prompt + completion) covers what a model is trained
on: the texts of the completion's ``assistant`` turns with their end marks.

Turns are grouped by pair: a conversation is one training example and one row. All
expressions are built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>", "<|end|>"
TRAINED = "assistant"


def _gathered(turns: DataFrame, name: str) -> DataFrame:
    """(pair_id, name): the (role, text) turns of a pair in order of turn, role and text."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.groupBy("pair_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return rows.select("pair_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    n = F.least(F.size(a), F.size(b))
    equal = F.transform(F.arrays_zip(F.slice(a, 1, n).alias("a"), F.slice(b, 1, n).alias("b")), lambda z: z["a"] == z["b"])
    first = F.array_position(equal, F.lit(False)).cast("int")
    return F.when(n == 0, F.lit(0)).when(first == 0, n).otherwise(first - 1)


def _safe(text: Column) -> Column:
    """Marks inside a text can't open a turn."""
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit(CLOSE + "\n"))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(END + "\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def loss_spans(turns: Column, start: Column) -> Column:
    """(start, end) of the trained texts when rendering begins at character ``start``."""
    zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, turn: Column) -> Column:
        begin = acc["at"] + F.char_length(_head(turn))
        end = begin + F.char_length(_body(turn))
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["role"] == TRAINED, F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, add, lambda acc: acc["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair of two frames of (pair_id, turn, role, text).

    Columns: pair_id, n_prompt_turns, prompt, chosen, rejected (completions), chosen_mask,
    rejected_mask, usable (both sides have something to train on and differ). A
    pair found on one side only has an empty other side and is not usable; null roles
    and texts are empty; turns with equal numbers, and repeated rows, follow in order
    of role and text; a null pair_id is a pair of its own; other columns are ignored;
    empty tables give no rows.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    a, b = _gathered(chosen, "a"), _gathered(rejected, "b").withColumnRenamed("pair_id", "b_id")
    both = a.join(b, F.col("pair_id").eqNullSafe(F.col("b_id")), "full").select(
        F.coalesce("pair_id", "b_id").alias("pair_id"), F.coalesce("a", empty).alias("a"), F.coalesce("b", empty).alias("b"))
    both = both.withColumn("n", common_prefix(F.col("a"), F.col("b")))
    rest = {s: F.slice(s, F.col("n") + 1, F.size(s)) for s in ("a", "b")}
    both = both.select("pair_id", "n", rendered(F.slice("a", 1, F.col("n"))).alias("prompt"),
                       rest["a"].alias("a"), rest["b"].alias("b"))
    start = F.char_length("prompt")
    out = both.select("pair_id", F.col("n").cast("long").alias("n_prompt_turns"), "prompt",
                      rendered(F.col("a")).alias("chosen"), rendered(F.col("b")).alias("rejected"),
                      loss_spans(F.col("a"), start).alias("chosen_mask"), loss_spans(F.col("b"), start).alias("rejected_mask"))
    return out.withColumn("usable", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0)
                          & (F.col("chosen") != F.col("rejected")))


def echo_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, rejected) turns from plain conversations.

    Chosen is the conversation; rejected answers, in place of the last assistant turn,
    by echoing the turn before it, and ends there. Conversations without an answer to
    a turn are the same on both sides.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    order = W.partitionBy("pair_id").orderBy("turn", "role", "text")
    answer = F.max(F.when(F.col("role") == TRAINED, F.col("turn"))).over(W.partitionBy("pair_id"))
    rows = turns.select("*", F.lag("text").over(order).alias("before"), answer.alias("last"))
    stays = F.col("last").isNull() | (F.col("turn") <= F.col("last"))
    swap = (F.col("turn") == F.col("last")) & (F.col("role") == TRAINED) & F.col("before").isNotNull()
    return turns, rows.where(stays).select("pair_id", "turn", "role", F.when(swap, F.col("before")).otherwise(F.col("text")).alias("text"))


def digest(conversations: DataFrame) -> DataFrame:
    """Preference rows of all conversations, masks as start:end lists."""
    def text(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(mask)

    out = format_pairs(*echo_pairs(conversations))
    return out.select(F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", "rejected",
                      text("chosen_mask"), text("rejected_mask"), "usable")
