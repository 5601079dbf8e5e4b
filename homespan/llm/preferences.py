"""Preference records for training: one prompt, two masked completions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: How a turn is written; a completion's mask covers the content and the end mark of assistant turns.
OPEN, AFTER_ROLE, END, AFTER_TURN = "<|im_start|>", "\n", "<|im_end|>", "\n"
LEARNED_ROLE = "assistant"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn.role, F.lit(AFTER_ROLE))


def _body(turn: Column) -> Column:
    return F.concat(turn.text, F.lit(END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t), F.lit(AFTER_TURN))), "")


def _mask(turns: Column) -> Column:
    """Spans (start, end) in code points of a completion that count towards the loss, in order."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state.at + F.length(_header(turn))
        end = begin + F.length(_body(turn))
        span = F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct((end + len(AFTER_TURN)).cast("long").alias("at"),
                        F.when(turn.role == LEARNED_ROLE, F.concat(state.spans, F.array(span)))
                        .otherwise(state.spans).alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state.spans)


def preference_records(turns: DataFrame) -> DataFrame:
    """One row per pair_id: prompt, chosen, rejected, chosen_mask, rejected_mask, n_shared_turns, n_chosen_turns, n_rejected_turns.

    ``turns`` has pair_id, side ('chosen' or 'rejected'), turn, role, text. The prompt is the longest run of turns that
    both sides begin with (same role and text), written once; the completions are what is left of each side, with
    the spans of assistant content that a trainer should learn. Null roles and texts count as empty, null turn
    numbers come first, rows of one number are ordered by role and text; rows with a null pair or another side are
    left out. A pair with one side only has an empty other side; two equal sides give empty completions.

    A pair's turns meet in one row, as the record holds them all; nothing larger than a record is gathered, and one
    shuffle by pair_id is all.
    """
    clean = turns.where("pair_id is not null and side in ('chosen', 'rejected')").select(
        "pair_id", "side", F.struct(
            F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"))

    def side(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("t")))).alias(name)

    pairs = clean.groupBy("pair_id").agg(side("chosen"), side("rejected"))
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    differs = lambda i: ((F.get("chosen", i).role != F.get("rejected", i).role)
                         | (F.get("chosen", i).text != F.get("rejected", i).text))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    shared = F.coalesce(F.array_min(F.filter(places, differs)), shorter)
    split = pairs.withColumn("k", shared).select(
        "pair_id", "k", F.size("chosen").alias("n_chosen_turns"), F.size("rejected").alias("n_rejected_turns"),
        F.slice("chosen", 1, F.col("k")).alias("before"),
        F.slice("chosen", F.col("k") + 1, F.size("chosen")).alias("good"),
        F.slice("rejected", F.col("k") + 1, F.size("rejected")).alias("bad"))
    # a side that is only the prefix, or empty, leaves an empty completion
    return split.select(
        "pair_id", _rendered(F.col("before")).alias("prompt"), _rendered(F.col("good")).alias("chosen"),
        _rendered(F.col("bad")).alias("rejected"), _mask(F.col("good")).alias("chosen_mask"),
        _mask(F.col("bad")).alias("rejected_mask"), F.col("k").cast("long").alias("n_shared_turns"),
        F.col("n_chosen_turns").cast("long").alias("n_chosen_turns"),
        F.col("n_rejected_turns").cast("long").alias("n_rejected_turns"))


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: pair_id, side, turn, role, text.

    The chosen side of pair c is conversation c up to its last assistant turn. The rejected side has the same turns, but that
    turn is the last assistant turn of conversation c + 1, an answer to something else. Conversations without
    an assistant turn, or without such a neighbour, give no pair; nor do rows without conv_id or turn.
    """
    rows = conversations.where("conv_id is not null and turn is not null").select(
        F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    replies = rows.where(F.col("role") == LEARNED_ROLE).groupBy("pair_id").agg(
        F.max("turn").alias("last"), F.max_by(F.coalesce("text", F.lit("")), F.struct("turn", F.coalesce("text", F.lit(""))))
        .alias("reply"))
    other = replies.select((F.col("pair_id") - 1).alias("pair_id"), F.col("reply").alias("other"))
    ends = replies.select("pair_id", "last").join(other, "pair_id")
    kept = rows.join(ends, "pair_id").where("turn <= last")
    swapped = F.when((F.col("turn") == F.col("last")) & (F.col("role") == LEARNED_ROLE), F.col("other")).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
                    F.struct(F.lit("rejected").alias("side"), swapped.alias("text")))
    return kept.select("pair_id", "turn", "role", F.explode(sides).alias("s")).select(
        "pair_id", "s.side", "turn", "role", "s.text")
