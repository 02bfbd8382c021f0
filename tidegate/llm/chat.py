"""Preference formatting of paired conversations.

The turns of a chosen and a rejected conversation are laid over each other: a turn both
have is common, and the longest common prefix ends before the first that is not. The
prefix is rendered once as the prompt. The turns after it are two completions, each with
the places where a loss is taken: what the assistant says.

Everything up to the segments works on single turns, so a conversation of any length is
spread over tasks; only ``render`` brings a pair's turns together, in the row it makes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import written

# How a turn is written.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"
TURN = ["turn", "role", "text"]


def _head() -> Column:
    return F.concat(F.lit(OPEN), "role", F.lit(CLOSE))


def segments(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, part, turn, role, text, rendered, loss``: one row per turn of prompt and completions.

    Both tables hold ``pair_id, turn, role, text``. Turns are ordered by their number,
    then role and text; null roles and texts count as empty, a null number comes first.
    Rows that repeat a turn count once. ``part`` is ``prompt``, ``chosen`` or
    ``rejected``; a pair that only one table has is all completion on that side, and
    alike conversations are all prompt. Empty tables give an empty result.
    """
    sides = [
        df.select("pair_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(c).alias("c"), F.lit(r).alias("r"))
        for df, c, r in ((chosen, 1, 0), (rejected, 0, 1))
    ]
    turns = sides[0].unionByName(sides[1]).groupBy("pair_id", *TURN).agg(F.max("c").alias("c"), F.max("r").alias("r"))
    turns = written(turns, "turns")
    parted = turns.filter("c + r < 2").groupBy("pair_id").agg(F.min(F.struct(*TURN)).alias("first"))
    parted = written(parted.withColumnRenamed("pair_id", "of"), "partings")
    placed = turns.join(parted, F.col("pair_id").eqNullSafe(F.col("of")), "left")
    common = F.col("first").isNull() | (F.struct(*TURN) < F.col("first"))
    sided = F.when(common, F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("c") == 1, "chosen"), F.when(F.col("r") == 1, "rejected")), lambda p: p.isNotNull())
    )
    out = placed.select("pair_id", F.explode(sided).alias("part"), *TURN)
    return out.withColumn("rendered", F.concat(_head(), "text", F.lit(END))).withColumn("loss", (F.col("part") != "prompt") & (F.col("role") == LEARNED_ROLE))


def _spans(turns: Column) -> Column:
    """Where the loss is taken, as ``start`` and ``end`` among the characters of the joined turns."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state, turn):
        end = state["at"] + F.length(turn["rendered"])
        begin = state["at"] + F.length(turn["role"]) + F.lit(len(OPEN + CLOSE))
        spans = F.when(turn["loss"], F.concat(state["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def _of_part(part: str) -> Column:
    return F.filter("turns", lambda turn: turn["part"] == part)


def render(found: DataFrame) -> DataFrame:
    """``pair_id, prompt, chosen, rejected, chosen_loss, rejected_loss, prompt_turns`` from ``segments``, a row per pair."""
    pairs = found.groupBy("pair_id").agg(F.sort_array(F.collect_list(F.struct(*TURN, "part", "rendered", "loss"))).alias("turns"))
    part = {p: _of_part(p) for p in ("prompt", "chosen", "rejected")}
    text = {p: F.array_join(F.transform(turns, lambda t: t["rendered"]), "").alias(p) for p, turns in part.items()}
    losses = [_spans(part[p]).alias(f"{p}_loss") for p in ("chosen", "rejected")]
    return pairs.select("pair_id", *text.values(), *losses, F.size(part["prompt"]).alias("prompt_turns"))


def swapped_replies(conversations: DataFrame, block: int = 64) -> tuple[DataFrame, DataFrame]:
    """Pairs made of single conversations: ``(chosen, rejected)`` turns, ``pair_id`` being ``conv_id``.

    The rejected side ends in the last reply of the next conversation by id, in rounds
    within ``block`` neighbouring ids, or in an empty reply if there is no other. A
    conversation without a reply is alike on both sides.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    last = turns.filter(F.col("role") == LEARNED_ROLE).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    near = W.partitionBy(F.floor(F.col("pair_id") / block)).orderBy("pair_id")
    whole = near.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    other = F.coalesce(F.lead("last.text").over(near), F.first("last.text").over(whole))
    reply = F.when(F.count(F.lit(1)).over(whole) > 1, other).otherwise("")
    replies = written(last.select(F.col("pair_id").alias("of"), F.col("last.turn").alias("at"), reply.alias("reply")), "replies")
    met = turns.join(replies, F.col("pair_id").eqNullSafe(F.col("of")), "left")
    replaced = (F.col("role") == LEARNED_ROLE) & F.col("turn").eqNullSafe(F.col("at")) & F.col("reply").isNotNull()
    return turns, met.select("pair_id", "turn", "role", F.when(replaced, F.col("reply")).otherwise(F.col("text")).alias("text"))
