"""Preference formatting of conversations: DataFrame operations only.

Two conversations, a chosen and a rejected one, share a begin. Their longest common prefix of turns is rendered once, as
the prompt; what follows is rendered as two completions, each with the spans of characters that a loss counts:
the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import run_folder, saved

ASSISTANT = "assistant"

_TURNS = "array<struct<role:string,text:string>>"


def turns_of(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """key and turns (role, text in order) of every conversation: by turn (nulls first), then role, then text; rows that
    repeat one another count once. A null role is ``user`` and a null text empty. Null keys belong to no conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (
        conversations.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sort_array(F.collect_set(turn)).alias("turns"))
        .select(key, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def common_turns(one: Column, other: Column) -> Column:
    """How many turns two conversations begin with that are equal in role and text."""
    differ = F.zip_with(one, other, lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(differ, F.lit(True)).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(one), F.size(other)))


def turn_text(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, turn_text), "")


def loss_spans(turns: Column) -> Column:
    """Begin and end, in characters of the rendered turns, of what the loss counts: the assistant's texts with the line end
    that closes them. Array of (start, end)."""
    opening = lambda t: F.char_length(t["role"]) + 5
    found = F.aggregate(
        turns,
        F.expr("struct(0 as at, cast(array() as array<struct<start:int,end:int>>) as spans)"),
        lambda done, t: F.struct(
            (done["at"] + F.char_length(turn_text(t))).alias("at"),
            F.when(
                t["role"] == ASSISTANT,
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + opening(t)).alias("start"),
                            (done["at"] + F.char_length(turn_text(t))).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return found


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Format every row of ``pairs`` (pair_id, chosen_id, rejected_id, chosen and rejected: arrays of (role, text)).

    Adds n_prompt_turns, prompt, chosen_text, chosen_spans, rejected_text, rejected_spans. Equal conversations have all turns in
    the prompt and empty completions; null or empty ones share nothing and have an empty text. Other columns go.
    """
    none = F.expr(f"cast(array() as {_TURNS})")
    one, other = F.coalesce(F.col("chosen").cast(_TURNS), none), F.coalesce(F.col("rejected").cast(_TURNS), none)
    cut = pairs.select("pair_id", "chosen_id", "rejected_id", one.alias("one"), other.alias("other")).withColumn(
        "n_prompt_turns", common_turns(F.col("one"), F.col("other"))
    )
    rest = lambda turns: F.slice(turns, F.col("n_prompt_turns") + 1, F.size(turns))
    split = cut.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "n_prompt_turns",
        F.slice("one", F.lit(1), F.col("n_prompt_turns")).alias("shared"),
        rest("one").alias("one"),
        rest("other").alias("other"),
    )
    return split.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        rendered(F.col("shared")).alias("prompt"),
        rendered(F.col("one")).alias("chosen_text"),
        loss_spans(F.col("one")).alias("chosen_spans"),
        rendered(F.col("other")).alias("rejected_text"),
        loss_spans(F.col("other")).alias("rejected_spans"),
    )


def with_other_reply(conversations: DataFrame) -> DataFrame:
    """One pair per conversation, for tables without preferences: the conversation as it is, and the same one with its
    last assistant turn replaced by that of its partner. Partners are ids that differ in their last bit.

    Without a partner, or with one that has no assistant turn, the reply is left out of the rejected one; a conversation
    without an assistant turn is rejected as it is. pair_id and chosen_id are its id, rejected_id its partner's.
    """
    folder = run_folder(conversations.sparkSession, "chat")
    whole = turns_of(conversations.withColumn("conv_id", F.col("conv_id").cast("long")))
    from_end = F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == ASSISTANT), F.lit(True)).cast("int")
    placed = saved(
        whole.withColumn("at", F.when(from_end > 0, F.size("turns") - from_end + 1)), folder, "turns"
    )
    replies = placed.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.try_element_at("turns", F.col("at")).alias("reply")
    )
    put = F.when(F.col("reply").isNull(), F.expr(f"cast(array() as {_TURNS})")).otherwise(F.array("reply"))
    turns, at = F.col("turns"), F.col("at")
    swapped = F.concat(F.slice(turns, F.lit(1), at - 1), put, F.slice(turns, at + 1, F.size(turns)))
    return placed.join(replies, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"),
        F.col("conv_id").alias("chosen_id"),
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("rejected_id"),
        F.col("turns").alias("chosen"),
        F.when(at.isNull(), turns).otherwise(swapped).alias("rejected"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """The formatted pairs, the spans as ``start:end`` joined by commas."""
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])))
    return (
        format_pairs(with_other_reply(conversations))
        .withColumn("chosen_spans", listed("chosen_spans"))
        .withColumn("rejected_spans", listed("rejected_spans"))
    )
