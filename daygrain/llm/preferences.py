"""Chat formatting: preference pairs with one shared prompt and masked completions.

``format_pairs`` takes a chosen and a rejected conversation per row (arrays
of role and text), finds their longest common turn prefix, renders it once
as the prompt and renders what remains of each as its completion.  Masks are
code point spans ``[start, end)`` of prompt + completion that are trained on:
the text and end marker of assistant turns after the prompt.

``pairs_from_conversations`` derives pairs from a turn table.  Conversations
that open with the same turn compete: the one with the most assistant
characters (then the smallest id) is chosen over each of the others.  And
each conversation is chosen over itself with its last assistant reply
replaced by the one before.  The winner per opening is a maximum of weights
and ids combined map-side; its turns join it once, and the others join that.
Openings that hold more than a thousandth of all conversations (fewer than a
thousand can) are salted on both sides, so a common opening is many join keys
and never a group in one task.

Defined cases: null role or text counts as empty; turns are ordered by turn,
role, text; repeated rows of a turn stand once; rows without conversation id
are left out; identical conversations leave both completions empty; a chat
marker inside a text is broken by a space (``< |``); an empty table gives an
empty result; extra columns are ignored.  A conversation is one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import write_read

#: An opening with more than one conversation in this many is salted, into ``SALTS`` keys.
COMMON = 1000
SALTS = 64
_TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv_id"), one.alias("t"))
    packed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("t"))
    return packed.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(_TURNS).alias("turns"))


def _last_reply_replaced(turns: Column) -> Column:
    """The conversation up to its last assistant turn, that turn saying what the previous one said; null without two."""
    at = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: F.element_at(turns, i)["role"] == "assistant")
    last, before = F.element_at(at, -1), F.element_at(at, -2)
    swapped = F.array(F.struct(F.lit("assistant").alias("role"), F.element_at(turns, before)["text"].alias("text")))
    rest = F.slice(turns, last + 1, F.size(turns))
    return F.when((F.size(turns) > 0) & (F.size(at) >= 2), F.concat(F.slice(turns, 1, last - 1), swapped, rest))


def pairs_from_conversations(turns: DataFrame, **names) -> DataFrame:
    """(chosen_id, rejected_id, kind, chosen, rejected)."""
    convs = conversations(turns, **names)
    replies = F.filter("turns", lambda t: t["role"] == "assistant")
    weight = F.aggregate(replies, F.lit(0), lambda acc, t: acc + F.length(t["text"]))
    opening = F.element_at("turns", 1)
    convs = write_read(convs.select("conv_id", "turns", opening.alias("opening"), F.xxhash64(opening).alias("h"), weight.alias("weight")), "conversations")
    total = convs.count()
    common = [r["h"] for r in convs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * COMMON > total).select("h").collect()]
    is_common = F.col("h").isin(common) if common else F.lit(False)

    opened = convs.withColumn("salt", F.when(is_common, F.pmod(F.xxhash64(F.lit(1), "conv_id"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    winners = (
        convs.groupBy("h", "opening")
        .agg(F.max(F.struct("weight", (-F.col("conv_id")).alias("minus"))).alias("w"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("h", "opening", (-F.col("w.minus")).alias("chosen_id"))
    )
    salts = F.when(is_common, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    best = winners.join(convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen")), "chosen_id").withColumn("salt", F.explode(salts))
    shared = (
        opened.join(best, ["h", "salt", "opening"])
        .where(F.col("conv_id") != F.col("chosen_id"))
        .select("chosen_id", F.col("conv_id").alias("rejected_id"), F.lit("opening").alias("kind"), "chosen", F.col("turns").alias("rejected"))
    )
    replaced = convs.select(
        F.col("conv_id").alias("chosen_id"),
        F.col("conv_id").alias("rejected_id"),
        F.lit("reply").alias("kind"),
        F.col("turns").alias("chosen"),
        _last_reply_replaced(F.col("turns")).cast(_TURNS).alias("rejected"),
    ).where(F.col("rejected").isNotNull())
    return shared.union(replaced)


def _safe(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def _render(turns: Column) -> Column:
    each = F.transform(turns, lambda t: F.concat(F.lit("<|im_start|>"), _safe(t["role"]), F.lit("\n"), _safe(t["text"]), F.lit("<|im_end|>\n")))
    return F.array_join(each, "")


def _mask(turns: Column, offset: Column) -> Column:
    """Spans of assistant texts with their end markers, counted from ``offset``."""
    zero = F.struct(offset.cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        start = acc["at"] + F.length(F.concat(F.lit("<|im_start|>"), _safe(t["role"]), F.lit("\n")))
        end = start + F.length(_safe(t["text"])) + 10
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected", keep=()) -> DataFrame:
    """``keep`` columns, n_prompt_turns, prompt, and completion and mask of either side."""
    clean = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast(_TURNS)), lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    rows = pairs.select(*keep, clean(chosen).alias("__c"), clean(rejected).alias("__r"))
    rows = rows.withColumn("__n", common_turns(F.col("__c"), F.col("__r")))
    tail = lambda c: F.slice(c, F.col("__n") + 1, F.size(c))
    rows = rows.select(*keep, F.col("__n").alias("n_prompt_turns"), _render(F.slice("__c", F.lit(1), F.col("__n"))).alias("prompt"), tail("__c").alias("__c"), tail("__r").alias("__r"))
    return rows.select(
        *keep,
        "n_prompt_turns",
        "prompt",
        _render(F.col("__c")).alias("chosen_completion"),
        _mask(F.col("__c"), F.length("prompt")).alias("chosen_mask"),
        _render(F.col("__r")).alias("rejected_completion"),
        _mask(F.col("__r"), F.length("prompt")).alias("rejected_mask"),
    )
