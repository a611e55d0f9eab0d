"""Preference formatting of chat turns.

``conversations`` gathers turns to one row per conversation; ``preferences``
takes two such columns, chosen and rejected, finds their longest common prefix
of turns (same role and text), renders it once as the prompt and renders what
follows on either side as completions with masks. A mask lists the spans (code
points, end exclusive) of a completion that are trained on: the assistant's
words and their end marks, never headers or other roles' turns.

Defined results: turns without a conversation id belong to no conversation and
are left out; a null role reads as ``user``, a null text as empty; turns are
ordered by turn number, then role and text, null numbers first, and repeated
rows of a turn are one turn; if both sides are equal, the prompt is the
whole conversation and both completions are empty; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TURN = "struct<turn:bigint,role:string,text:string>"
#: Conversations among which replies are exchanged (on average).
POOL = 128


def conversations(turns: DataFrame, *by: str | Column) -> DataFrame:
    """One row per conversation: conv_id and ``turns``, an ordered array."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    known = turns.where(F.col("conv_id").isNotNull())
    return known.groupBy(*by, "conv_id").agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Spans of the rendered turns that are trained on."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(_header(t))
        end = start + F.length(_body(t))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda s: s["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix: the first place where a turn differs."""
    same = lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"])
    differs = F.zip_with(a, b, lambda x, y: ~F.coalesce(same(x, y), F.lit(False)))
    at = F.array_position(differs, F.lit(True))
    return F.when(at > 0, at - 1).otherwise(F.size(a)).cast("int")


def preferences(pairs: DataFrame, keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """``keep`` columns, n_common, prompt, chosen, rejected and their masks, from
    the columns chosen_turns and rejected_turns."""
    df = pairs.withColumn("n_common", common_turns(F.col("chosen_turns"), F.col("rejected_turns")))
    rest = lambda turns: F.slice(turns, F.col("n_common") + 1, F.size(turns))
    df = df.select(
        *keep,
        "n_common",
        F.slice("chosen_turns", F.lit(1), F.col("n_common")).alias("shared"),
        rest(F.col("chosen_turns")).alias("c"),
        rest(F.col("rejected_turns")).alias("r"),
    )
    return df.select(
        *keep,
        "n_common",
        render(F.col("shared")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        mask(F.col("c")).alias("chosen_mask"),
        render(F.col("r")).alias("rejected"),
        mask(F.col("r")).alias("rejected_mask"),
    )


def last_reply(turns: Column) -> Column:
    """Place (from 0) of the last assistant turn, -1 if there is none."""
    return F.aggregate(
        F.transform(turns, lambda t, i: F.when(t["role"] == "assistant", i).otherwise(F.lit(-1))), F.lit(-1), lambda a, x: F.greatest(a, x)
    )


def exchanged_replies(turns: DataFrame, pools: int) -> DataFrame:
    """Preference pairs from recorded conversations: the conversation itself is
    chosen; rejected is the same conversation with its last reply exchanged for
    the last reply of another one, the next in its pool by id (the last takes
    the first's). Every conversation with a reply gives one pair: one that is alone
    in its pool takes the reply of the first conversation of all, or of the
    second if it is the first itself, and an empty one if there is no other.
    Conversations without a reply give none. Pools are dealt by a hash of the id."""
    pool = F.pmod(F.xxhash64("conv_id"), F.lit(pools)).alias("pool")
    # one exchange by pool serves both the gathering and the window
    dealt = turns.select("conv_id", "turn", "role", "text", pool).where("conv_id IS NOT NULL").repartition("pool")
    convs = conversations(dealt, "pool").withColumn("at", last_reply(F.col("turns"))).where("at >= 0")
    convs = convs.withColumn("reply", F.get("turns", F.col("at"))["text"])
    w = Window.partitionBy("pool").orderBy("conv_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    convs = convs.withColumns({"next": F.lead("reply").over(w), "first": F.first("reply").over(whole), "n": F.count(F.lit(1)).over(whole)})
    lone = F.when(F.get("ends", F.lit(0)) != F.col("conv_id"), F.get("replies", F.lit(0))).otherwise(F.get("replies", F.lit(1)))
    other = F.when(F.col("n") > 1, F.coalesce("next", "first")).otherwise(F.coalesce(lone, F.lit("")))
    swapped = F.transform("turns", lambda t, i: F.when(i == F.col("at"), F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.col("other").alias("text"))).otherwise(t))
    # the replies of two conversations, one row
    two = with_reply(turns).groupBy().agg(F.min("conv_id").alias("a")).select("a")
    two = with_reply(turns).join(F.broadcast(two)).groupBy().agg(F.first("a").alias("a"), F.min(F.when(F.col("conv_id") > F.col("a"), F.col("conv_id"))).alias("b"))
    ends = conversations(turns.join(F.broadcast(two), (F.col("conv_id") == F.col("a")) | (F.col("conv_id") == F.col("b"))).drop("a", "b"))
    ends = ends.withColumn("reply", F.get("turns", last_reply(F.col("turns")))["text"])
    ends = ends.agg(F.sort_array(F.collect_list(F.struct("conv_id", "reply"))).alias("e")).select(F.col("e")["conv_id"].alias("ends"), F.col("e")["reply"].alias("replies"))
    convs = convs.join(F.broadcast(ends)).withColumn("other", other)
    return convs.select("conv_id", F.col("turns").alias("chosen_turns"), swapped.alias("rejected_turns"))


def with_reply(turns: DataFrame) -> DataFrame:
    """The rows (conv_id) of assistant turns."""
    return turns.where(F.col("conv_id").isNotNull() & (F.col("role") == "assistant")).select("conv_id")


def pools_for(turns: DataFrame) -> int:
    """So many pools that one holds about ``POOL`` conversations with a reply."""
    return max(1, with_reply(turns).agg(F.count_distinct("conv_id")).first()[0] // POOL)
