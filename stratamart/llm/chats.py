"""Chat formatting: cumulative snapshots of a conversation collapse into the longest one before it is rendered.

A log often holds the same conversation again after each turn. A rolling hash over its
turns names every beginning of a conversation. One whose hash is a beginning of a longer
one is a snapshot of that and goes; of equal ones the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Markers of the rendered form.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def turn_digest(place: Column, role: Column, text: Column) -> list[Column]:
    """Two integers below 2 ** 60 from a SHA-256 of a turn and its place, so their sums over turns depend on order."""
    whole = F.sha2(
        F.concat_ws(
            ":", place.cast("string"), F.when(role.isNull(), "-").otherwise(F.concat_ws(":", F.length(role).cast("string"), role)),
            F.when(text.isNull(), "-").otherwise(F.concat(F.lit("+"), text)),
        ).cast("binary"), 256,
    )
    return [F.conv(F.substr(whole, F.lit(at), F.lit(15)), 16, 10).cast("decimal(20,0)") for at in (1, 16)]


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(END + "\n"))


def collapse(turns: DataFrame) -> DataFrame:
    """Conversations that stay: conv_id, n_turns, n_equal (equal conversations that it stands for, itself included).

    ``turns`` has conv_id, turn, role, text. Turns of a conversation follow each other by
    turn, null first, then role and text; a row that is there twice counts once. Rows
    with a null conv_id are one conversation. Null roles and texts are values of their
    own and render as empty. Other columns are not read; an empty table gives none.

    A window adds up the digests of each conversation's turns as rows stream through it,
    so no conversation is gathered. Beginnings are made distinct before they meet the
    conversations, so a first turn that a third of the log shares is one row.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    rows = rows.withColumn("place", F.row_number().over(order))
    a, b = turn_digest(F.col("place"), F.col("role"), F.col("text"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("conv_id", "place", F.sum(a).over(so_far).alias("a"), F.sum(b).over(so_far).alias("b"), F.lead(F.lit(1)).over(order).isNull().alias("last"))
    rows = stored(rows, "chat-beginnings")
    whole = rows.where("last").groupBy("place", "a", "b").agg(
        F.min(F.struct(F.col("conv_id").isNotNull().alias("known"), "conv_id"))["conv_id"].alias("conv_id"), F.count("*").alias("n_equal")
    )
    begun = rows.where("not last").select("place", "a", "b").distinct()
    return whole.join(begun, ["place", "a", "b"], "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_equal")


def format_chats(turns: DataFrame) -> DataFrame:
    """Rendered conversations that :func:`collapse` keeps: conv_id, n_turns, n_equal, n_chars, rendered.

    A conversation is one row of the result, so its turns meet in one task.
    """
    kept = collapse(turns)
    rows = turns.select("conv_id", "turn", "role", "text").distinct().withColumnRenamed("conv_id", "_conv")
    met = rows.join(kept, F.col("_conv").eqNullSafe(F.col("conv_id")))
    # Structs sort by their fields in turn, null first.
    parts = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    out = met.groupBy("conv_id", "n_turns", "n_equal").agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: rendered_turn(p["role"], p["text"])), "")
    return out.select("conv_id", "n_turns", "n_equal", F.length(text).cast("long").alias("n_chars"), text.alias("rendered"))

