"""Preference formatting of conversations (operator 2).

A pair of conversations shares its longest common prefix of turns as the prompt, rendered once. What is
left of either is its completion, with a mask that tells which characters are learnt from: those the
assistant wrote.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm.store import stored

HEAD, FOOT = "<|{role}|>\n", "<|end|>\n"
LEARNT = "assistant"
#: Conversations that one task puts in order.
BUCKET = 50_000
PAIR = ("chosen_id", "rejected_id", "a", "b")


def conversations(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``conv`` and ``turns``, in order of turn, role and text.

    Turns without a conversation id are left out; a null role or text is an empty one; rows that repeat
    stay repeated.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("conv"), turn.alias("t"))
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def by_opening(convs: DataFrame) -> DataFrame:
    """Pairs of conversations that begin alike: the smallest id is chosen, each other one rejected.

    For tables without preference labels. One row a conversation at most, however many begin alike.
    """
    opening = convs.withColumn("o", F.sha2(F.concat_ws("\n", F.col("turns")[0]["role"], F.col("turns")[0]["text"]), 256))
    first = opening.groupBy("o").agg(F.min("conv").alias("chosen_id"))
    rows = opening.join(first, "o").where("conv <> chosen_id").select("chosen_id", F.col("conv").alias("rejected_id"), F.col("turns").alias("b"))
    return rows.join(convs.select(F.col("conv").alias("chosen_id"), F.col("turns").alias("a")), "chosen_id").select(*PAIR)


def by_swapped_answer(convs: DataFrame) -> DataFrame:
    """Pairs of a conversation and itself with the last answer of the next one (its id and one) for its own.

    Both must end with the assistant. The rejected id is that of the conversation the answer comes from.
    """
    ends = F.element_at("turns", -1)
    rows = convs.where(ends["role"] == LEARNT)
    answers = rows.select((F.col("conv") - 1).alias("conv"), F.col("conv").alias("rejected_id"), ends["text"].alias("answer"))
    swapped = F.struct(ends["turn"].alias("turn"), ends["role"].alias("role"), F.col("answer").alias("text"))
    return rows.join(answers, "conv").select(
        F.col("conv").alias("chosen_id"),
        "rejected_id",
        F.col("turns").alias("a"),
        F.concat(F.slice("turns", F.lit(1), F.size("turns") - 1), F.array(swapped)).alias("b"),
    )


def by_neighbour_answer(convs: DataFrame) -> DataFrame:
    """Pairs of a conversation up to its last answer and itself with the last answer of another one.

    Each conversation with an assistant turn has one row, whatever its id and whatever follows that turn, in which
    the other answer stands for its last one; and a second row, in which it stands for its first answer and ends
    there, if that is not the last. The other one is the next by SHA-256 of the id, the first after the last; a
    single one is its own. The order is one of ids and hashes alone, sorted in buckets of about ``BUCKET`` ids by
    the first digits of the hash; the last of a bucket takes the first of the next.
    """
    learnt = F.transform("turns", lambda t: t["role"] == LEARNT)
    last = F.size("turns") - F.array_position(F.reverse(learnt), F.lit(True)).cast("int") + 1
    rows = convs.where(F.array_contains(learnt, True)).select(
        "conv", F.slice("turns", F.lit(1), last).alias("turns"), F.array_position(learnt, F.lit(True)).cast("int").alias("first")
    )
    rows = stored(rows.withColumn("answer", F.element_at("turns", -1)["text"]), "answered")
    digits = max(1, math.ceil(math.log(max(rows.count() / BUCKET, 1), 16)))
    name = F.sha2(F.col("conv").cast("string"), 256)
    ids = rows.select("conv", name.alias("h"), F.substring(name, 1, digits).alias("bucket"))
    heads = ids.groupBy("bucket").agg(F.min_by("conv", F.struct("h", "conv")).alias("conv"))
    around = Window.orderBy("bucket")  # a row a bucket
    heads = heads.select("bucket", F.coalesce(F.lead("conv").over(around), F.first("conv").over(around)).alias("beyond"))
    within = ids.withColumn("next", F.lead("conv").over(Window.partitionBy("bucket").orderBy("h", "conv")))
    order = within.join(heads, "bucket").select("conv", F.coalesce("next", "beyond").alias("rejected_id"))
    answers = rows.select(F.col("conv").alias("rejected_id"), F.col("answer").alias("other"))
    pairs = rows.join(order, "conv").join(answers, "rejected_id")
    end = F.element_at("turns", F.col("at"))
    swapped = F.struct(end["turn"].alias("turn"), end["role"].alias("role"), F.col("other").alias("text"))
    places = F.array_distinct(F.array(F.size("turns"), F.col("first")))
    return pairs.withColumn("at", F.explode(places)).select(
        F.col("conv").alias("chosen_id"),
        "rejected_id",
        F.col("turns").alias("a"),
        F.concat(F.slice("turns", F.lit(1), F.col("at") - 1), F.array(swapped)).alias("b"),
    )


def _head(t: Column) -> Column:
    left, right = HEAD.split("{role}")
    return F.concat(F.lit(left), t["role"], F.lit(right))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(FOOT))), "")


def mask(turns: Column) -> Column:
    """Run lengths over the rendered turns: ``1:n`` for n characters that are learnt from, else ``0:n``."""

    def runs(t):
        learnt = F.when(t["role"] == LEARNT, "1:").otherwise("0:")
        return F.concat(
            F.lit("0:"), F.length(_head(t)).cast("string"), F.lit(","), learnt, F.length(t["text"]).cast("string"), F.lit(f",0:{len(FOOT)}")
        )

    return F.array_join(F.transform(turns, runs), ",")


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix by role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    differs = F.array_position(same, F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """``chosen_id``, ``rejected_id``, ``n_common``, ``prompt`` and both completions with their masks.

    ``pairs``: the ids, and the turns of the chosen (``a``) and the rejected (``b``) conversation. Equal
    conversations have empty completions, ones that differ from the start an empty prompt.
    """
    rows = pairs.withColumn("k", common_turns(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(c, F.col("k") + 1, F.size(c))
    return rows.select(
        "chosen_id",
        "rejected_id",
        F.col("k").cast("long").alias("n_common"),
        rendered(F.slice("a", F.lit(1), F.col("k"))).alias("prompt"),
        rendered(rest("a")).alias("chosen"),
        mask(rest("a")).alias("chosen_mask"),
        rendered(rest("b")).alias("rejected"),
        mask(rest("b")).alias("rejected_mask"),
    )


def preferences(turns: DataFrame) -> DataFrame:
    """Pairs by opening and by the answer of the next id; conversations without either have no row."""
    convs = stored(conversations(turns), "conversations")
    return format_preferences(by_opening(convs).unionAll(by_swapped_answer(convs)))


def all_preferences(turns: DataFrame) -> DataFrame:
    """Pairs by opening, and one or two rows of its own for each conversation with an assistant turn."""
    convs = stored(conversations(turns), "conversations")
    return format_preferences(by_opening(convs).unionAll(by_neighbour_answer(convs)))
