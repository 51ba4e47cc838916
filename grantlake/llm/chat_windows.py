"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written as ``[INST]`` role ``[/INST]`` text ``</s>``, a window as ``<s>`` and its turns. Control strings
inside roles and texts get a backslash after their first character, and backslashes are doubled, so a control string
in the output is always a mark of the template, and texts can be read back.

Running sums of the turns' tokens choose the windows: the n-th holds the turns whose sum falls into the n-th stretch of
SPAN tokens. Each window after the first begins with the system turn and with the last turns of the window before, up
to HISTORY tokens; these repeated turns are outside the loss mask, which covers the texts of new assistant turns. A window
so has at most SYSTEM plus HISTORY plus SPAN tokens and one turn's that began before the stretch; a longer system turn is
repeated whole. Every turn is new in one window only.

Turns are taken by turn number, then role and text; null roles and texts are empty, null numbers come first, and rows without
conv_id form one conversation. Rows that repeat are turns of their own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

#: Tokens (words and marks) of a window's new turns and of its repeated history.
SPAN, HISTORY = 768, 192
_MARKS = (("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]"))


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark, spelled in _MARKS:
        out = F.replace(out, F.lit(mark), F.lit(spelled))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def windows(conversations: DataFrame, span: int = SPAN, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, n_repeated (turns that are not new), and loss: begin and end of each masked stretch in characters."""
    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    tokens = F.regexp_count("text", F.lit(r"\S+")) + 4
    turns = c.with_running(turns, ["conv_id"], ["turn", "role", "text"], {"sum": tokens, "number": F.lit(1)}, "turns")
    turns = turns.withColumn("window", F.floor((F.col("sum") - 1) / span))
    turns = c.staged(turns.withColumn("tokens", F.regexp_count("text", F.lit(r"\S+")) + 4), "turns")
    # The sum at a window's end is known from its last turn; a turn is history if little enough stands from it to there.
    last = turns.groupBy("conv_id", "window").agg(F.max("sum").alias("last"))
    # Windows that hold a turn are numbered without gaps, so that history goes to the next one there is.
    last = c.with_running(last, ["conv_id"], ["window"], {"place": F.lit(1)}, "places")
    last = last.select(F.col("conv_id").alias("_c"), F.col("window").alias("_w"), "last", "place")
    turns = turns.join(last, turns["conv_id"].eqNullSafe(F.col("_c")) & (F.col("window") == F.col("_w"))).drop("_c", "_w")
    system = (F.col("number") == 1) & (F.col("role") == "system")
    near = (F.col("last") - F.col("sum") + F.col("tokens") <= history) & ~system
    new = F.array(F.struct(F.col("place").alias("window"), F.lit(False).alias("again")))
    again = F.array(F.struct((F.col("place") + 1).alias("window"), F.lit(True).alias("again")))
    copies = turns.withColumn("to", F.explode(F.when(near, F.concat(new, again)).otherwise(new)))
    piece = F.concat(F.lit("[INST]"), escaped(F.col("role")), F.lit("[/INST]"), escaped(F.col("text")), F.lit("</s>"))
    head = F.length(F.concat(F.lit("[INST]"), escaped(F.col("role")), F.lit("[/INST]")))
    copies = copies.select("conv_id", "to.window", "number", "to.again", (F.col("role") == "assistant").alias("target"), head.alias("head"), piece.alias("piece"))
    # A window is bounded by its budget, so its turns may be gathered. Only the history of a last window has no new turn.
    made = copies.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("number", "again", "target", "head", "piece"))).alias("turns"), F.max(~F.col("again")).alias("any")
    )
    made = made.filter("any").drop("any")
    first = turns.filter(system).select(
        F.col("conv_id").alias("_c"), F.struct("number", F.lit(True).alias("again"), F.lit(False).alias("target"), head.alias("head"), piece.alias("piece")).alias("system")
    )
    made = made.join(first, made["conv_id"].eqNullSafe(F.col("_c")) & (F.col("window") > 1), "left").drop("_c")
    made = made.withColumn("turns", F.when(F.col("system").isNotNull(), F.concat(F.array("system"), "turns")).otherwise(F.col("turns")))
    made = made.withColumn("ends", F.expr("aggregate(turns, array(3L), (a, t) -> array_append(a, element_at(a, -1) + length(t.piece)))"))
    loss = F.expr(
        "transform(filter(sequence(0, size(turns) - 1), i -> turns[i].target and not turns[i].again),"
        " i -> struct(ends[i] + turns[i].head as begin, ends[i + 1] - 4 as end))"
    )
    return made.select(
        "conv_id", "window", F.concat(F.lit("<s>"), F.array_join("turns.piece", "")).alias("text"),
        F.size(F.filter("turns", lambda t: t["again"])).alias("n_repeated"), loss.alias("loss"),
    )


def read_back(window: DataFrame) -> DataFrame:
    """From the output alone: per window the new turns (role, text) and the texts under the loss mask, unescaped."""
    parts = F.slice(F.split(F.expr("substring(text, 4)"), "</s>", -1), F.col("n_repeated") + 1, F.lit(1 << 30))
    turns = F.transform(
        F.filter(parts, lambda p: p != ""),
        lambda p: F.struct(
            unescaped(F.substring_index(F.substring(p, 7, 1 << 30), "[/INST]", 1)).alias("role"),
            unescaped(F.regexp_replace(p, r"(?s)^\[INST\].*?\[/INST\]", "")).alias("text"),
        ),
    )
    masked = F.expr("transform(loss, s -> substring(text, cast(s.begin + 1 as int), cast(s.end - s.begin as int)))")
    return window.select(
        "conv_id", "window", F.length("text").cast("long").alias("chars"), turns.alias("turns"), F.transform(masked, unescaped).alias("masked")
    )
