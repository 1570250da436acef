"""Chat formatting: logged conversations without the snapshots that longer ones contain.

Method: a chat log that is saved after every turn holds each conversation many times, as
prefixes of its last state. Each turn gets a hash of all turns up to it: the running XOR of
128-bit hashes of (place, role, text), taken by a window over one conversation at a time.
A conversation whose last hash is an inner hash of another one is a prefix of it and goes,
by an anti-join; of equal conversations the smallest id stays. The rest are rendered.

Both sides of the anti-join are first reduced to different hashes, so that a first turn or
a whole conversation that a third of the log shares is one row there.

Cases: a null text is an empty one, a null role is `unknown`. Turns are taken in the order
of turn (nulls first), role and text; a turn that is repeated exactly counts once, differing
ones of the same number all stay. Rows without a conversation id are one conversation.
An empty table gives an empty result. Other columns aren't looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import stored, text_of

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"  # fixed values: the marks of a common chat markup
UNKNOWN = "unknown"


def turns(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, role, text, a, b): each different turn with its place from 1, and the
    hash of its conversation up to it."""
    rows = chats.select(
        col(conv_id).alias("conv_id"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit(UNKNOWN)).alias("role"), text_of(text).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = [F.lag(c).over(order) for c in ("turn", "role", "text")]
    new = ~(before[0].eqNullSafe(F.col("turn")) & before[1].eqNullSafe(F.col("role"))
            & before[2].eqNullSafe(F.col("text")))
    rows = rows.withColumn("new", new).withColumn("place", F.sum(F.col("new").cast("bigint")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("new")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        "conv_id", "turn", "place", "role", "text",
        *[F.bit_xor(F.xxhash64(F.lit(i), "place", "role", "text")).over(so_far).alias(n)
          for i, n in enumerate("ab")])


def rendered(role: Column, text: Column) -> Column:
    """One turn in the markup; marks inside a text are broken up, so they can't end a turn."""
    safe = F.replace(text, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), F.replace(role, F.lit("<|"), F.lit("< |")), F.lit("\n"), safe, F.lit(CLOSE))


def maximal_conversations(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                          role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation that is no proper prefix of another, and the first of equal
    ones: conv_id, n_turns, n_equal (conversations equal to it, itself included), text."""
    every = turns(chats, conv_id, turn, role, text)
    last = Window.partitionBy("conv_id")
    hashes = stored(every.select("conv_id", "place", "a", "b")
                    .withColumn("n_turns", F.max("place").over(last)))
    whole = (hashes.where("place = n_turns").groupBy("n_turns", "a", "b")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal")))
    inner = hashes.where("place < n_turns").select(F.col("place").alias("n_turns"), "a", "b").distinct()
    kept = whole.join(inner, ["n_turns", "a", "b"], "left_anti").select(
        F.col("conv_id").alias("kept_id"), "n_turns", "n_equal")
    lines = every.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    return (lines.groupBy("conv_id", "n_turns", "n_equal")
            .agg(F.sort_array(F.collect_list(F.struct("place", rendered(F.col("role"), F.col("text")).alias("line"))))
                 .alias("lines"))
            .select("conv_id", "n_turns", "n_equal",
                    F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text")))
