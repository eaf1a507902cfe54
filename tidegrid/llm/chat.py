"""Preference formatting of conversations, in DataFrame functions only.

Chosen and rejected conversations share their first turns: these are rendered once, as prompt.  What follows is rendered
for each side, with a mask of run lengths: characters of assistant turns count in the loss, role headers and other turns don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed format of a turn.
OPEN, CLOSE, STOP = "<|", "|>\n", "<|end|>\n"


def preference_pairs(turns: DataFrame) -> DataFrame:
    """Pairs (conv_id, chosen, rejected) of arrays of (role, text) from ``turns`` (conv_id, turn, role, text).

    Conversations 2k and 2k + 1 are partners.  Chosen is a conversation up to its last assistant turn (all of it if it has
    none); rejected is the same with that turn's text replaced by the partner's last assistant text, or without that turn if
    the partner has none.  One shuffle on conv_id div 2 brings partners together.  Turns are ordered by (turn, role, text),
    nulls first, so repeated and tied turns have a fixed place; turns without conv_id belong to no conversation.
    """
    t = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).where("conv_id is not null")
    both = t.groupBy(F.shiftright("conv_id", 1).alias("pair")).agg(F.collect_list(F.struct("turn", "role", "text", "conv_id")).alias("all"))
    even = F.col("pair") * 2
    of = lambda who: F.transform(F.array_sort(F.filter("all", lambda x: x["conv_id"] == who)), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    sides = both.select(even.alias("even"), of(even).alias("a"), of(even + 1).alias("b"))
    side = lambda i, own, other: F.struct((F.col("even") + i).alias("conv_id"), F.col(own).alias("own"), F.col(other).alias("other"))
    rows = sides.select(F.explode(F.array(side(0, "a", "b"), side(1, "b", "a"))).alias("s")).select("s.*").where(F.size("own") > 0)
    said = lambda c: F.filter(c, lambda x: x["role"] == "assistant")
    last = F.size("own") - F.array_position(F.transform(F.reverse("own"), lambda x: F.coalesce(x["role"] == "assistant", F.lit(False))), True) + 1
    spoken = F.size(said("own")) > 0
    rows = rows.withColumn("chosen", F.when(spoken, F.slice("own", 1, F.when(spoken, last).otherwise(1).cast("int"))).otherwise(F.col("own")))
    answer = F.element_at(F.transform(said("other"), lambda x: F.struct(F.lit("assistant").alias("role"), x["text"].alias("text"))), -1)
    kept = F.slice("chosen", 1, F.greatest(F.size("chosen") - 1, F.lit(0)))
    swapped = F.when(F.size(said("other")) > 0, F.concat(kept, F.array(answer))).otherwise(kept)
    return rows.select("conv_id", "chosen", F.when(spoken, swapped).otherwise(F.col("chosen")).alias("rejected"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(STOP))


def render(turns: Column) -> Column:
    """The text of an array of turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def loss_runs(turns: Column, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """Run lengths in characters over the rendered turns: (chars, loss), a header's and a body's run for each turn."""
    run = lambda text, loss: F.struct(F.length(text).alias("chars"), loss.alias("loss"))
    return F.flatten(F.transform(turns, lambda t: F.array(run(_header(t), F.lit(False)), run(_body(t), F.coalesce(t["role"].isin(*roles), F.lit(False))))))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """Render (conv_id, chosen, rejected): prompt_turns, prompt, the two completions and their loss runs.

    The prompt is the longest common prefix of whole turns (role and text equal, nulls equal each other).  Equal
    conversations are all prompt and have empty completions; a null or empty side has no turns.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    p = pairs.withColumn("chosen", F.coalesce("chosen", empty)).withColumn("rejected", F.coalesce("rejected", empty))
    same = F.zip_with("chosen", "rejected", lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    differ = F.array_position(same, False)
    p = p.withColumn("prompt_turns", F.when(differ > 0, differ - 1).otherwise(F.size("chosen")).cast("int"))
    rest = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.size(c))
    return p.select(
        *[c for c in pairs.columns if c not in ("chosen", "rejected")], "prompt_turns", render(F.slice("chosen", 1, F.col("prompt_turns"))).alias("prompt"),
        render(rest("chosen")).alias("chosen"), render(rest("rejected")).alias("rejected"), loss_runs(rest("chosen")).alias("chosen_runs"), loss_runs(rest("rejected")).alias("rejected_runs"),
    )
