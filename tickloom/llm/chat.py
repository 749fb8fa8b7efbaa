"""Preference pairs from conversations: one prompt, two masked completions.

The turns that chosen and rejected conversation have in common from the start are
rendered once, as the prompt. What follows on either side is its completion, with
the spans that are learnt from: the assistant's words and the mark that ends them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def gather(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: by turn (null first), then role, then text.

    A row that is there several times counts once, a null role is the empty
    role, a null text an empty one, and rows without conv_id are left out, as
    they belong to no conversation. A conversation is one value of one row.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.where(F.col("conv_id").isNotNull())
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.array_distinct(F.collect_list(turn))).alias("turns"))


def pairs_of(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, chosen and rejected (turns) for ``pairs``: pair_id, chosen_id, rejected_id; null for an unknown conversation."""
    turns = gather(conversations)
    chosen = turns.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    rejected = turns.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    return (
        pairs.select("pair_id", "chosen_id", "rejected_id").join(chosen, "chosen_id", "left")
        .join(rejected, "rejected_id", "left").select("pair_id", "chosen", "rejected"))


def pairs_with_borrowed_turns(conversations: DataFrame) -> DataFrame:
    """Every conversation against itself with the turns of its partner from the first differing reply on.

    Partners are the conversations 2n and 2n + 1. Their assistant turns are
    compared one by one in order; where the first two differ, ``rejected`` leaves
    the conversation and goes on as the partner does, to its end. ``chosen`` is the
    whole conversation. Without a partner, or where no two replies differ,
    ``rejected`` is null.
    """
    own = gather(conversations).select("conv_id", F.col("turns").alias("chosen"), _replies("turns").alias("replies"))
    other = own.select(
        F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("chosen").alias("other"),
        F.col("replies").alias("others"))
    pairs = F.arrays_zip(F.col("replies").alias("own"), F.col("others").alias("other"))
    differing = F.filter(pairs, lambda p: p["own"]["text"] != p["other"]["text"])
    cut = F.get(differing, 0)
    swapped = F.concat(
        F.slice("chosen", 1, cut["own"]["at"]),
        F.slice("other", cut["other"]["at"] + 1, F.size("other")))
    return own.join(other, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), "chosen", F.when(cut.isNotNull(), swapped).otherwise(F.lit(None).cast(_TURNS)).alias("rejected"))


def _replies(turns: str) -> Column:
    """The texts of the assistant's turns with their positions, from 0."""
    placed = F.transform(turns, lambda t, at: F.struct(at.alias("at"), t["role"].alias("role"), t["text"].alias("text")))
    return F.filter(placed, lambda t: t["role"] == LEARNT)


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n"))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """[start, end) of every stretch of the rendered turns that is learnt from, in characters."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        after = done["at"] + F.char_length(_rendered(turn))
        begin = done["at"] + F.char_length(F.concat(F.lit(START), turn["role"], F.lit("\n")))
        span = F.array(F.struct(begin.alias("start"), (after - 1).alias("end")))
        return F.struct(
            after.alias("at"),
            F.when(turn["role"] == LEARNT, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda done: done["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """pair_id, common_turns, prompt, chosen, rejected and their learnt spans for ``pairs``: pair_id, chosen, rejected.

    Turns are equal if role and text are. Equal conversations have empty
    completions. Where one side is missing, the other's last turn is its
    completion and the missing one is null; without both all is null. Marks that
    occur in a text stay as they are: the spans say which ones are real.
    """
    same = F.zip_with("chosen", "rejected", lambda a, b: (
        a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]) & a.isNotNull() & b.isNotNull()))
    differs = F.array_position(same, False)
    one = F.coalesce(F.col("chosen"), F.col("rejected"))
    common = (
        F.when(F.col("chosen").isNotNull() & F.col("rejected").isNotNull(),
               F.when(differs == 0, F.size("chosen")).otherwise(differs - 1))
        .when(one.isNotNull(), F.greatest(F.size(one) - 1, F.lit(0)))
    ).cast("int")
    rows = pairs.select("pair_id", "chosen", "rejected", common.alias("common_turns"))
    rest = {side: F.slice(side, F.col("common_turns") + 1, F.greatest(F.size(side), F.lit(1))) for side in ("chosen", "rejected")}
    return rows.select(
        "pair_id", "common_turns", _joined(F.slice(F.coalesce("chosen", "rejected"), 1, F.col("common_turns"))).alias("prompt"),
        _joined(rest["chosen"]).alias("chosen"), _joined(rest["rejected"]).alias("rejected"),
        _spans(rest["chosen"]).alias("chosen_spans"), _spans(rest["rejected"]).alias("rejected_spans"))
