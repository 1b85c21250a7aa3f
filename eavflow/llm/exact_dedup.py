"""Exact dedup by distributed MSD radix partitioning; equality needs no digest.

Documents are split by successive bytes of their key.  A round takes the next
bytes of every undecided document as one wide digit, counts (group, digit) and
splits the groups by it.  A document alone in its group is decided; so are the
documents whose bytes end in the same round with the same digit: they are
equal.  The others go on with the rest of their bytes.  Digits get four times
wider each round, so the number of rounds grows with the logarithm of the
longest text, and after the first round only documents that share their first
bytes with another one are read.

Counts are combined before the shuffle, and documents learn the outcome of
their digit through ``lookup_join``, so a group with a third of all documents
stays spread over all tasks and never meets in one.

Defined cases: null text counts as empty, and empty texts are equal; null ids
are ordinary (they come after all others when a survivor is chosen); repeated
rows are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavflow.llm.common import Scratch, col, lookup_join, without

FIRST_DIGIT, WIDER = 128, 4
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
RESULT = ("keep_id", "group_size", "kept")


def normalised(text: Column) -> Column:
    """The text without any ``[\\x20\\x09-\\x0D]``; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for s in SPACES:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def radix_classes(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Classes of equal ``key`` (binary) among ``rows`` (with a unique long ``_e_row``).

    Returns one row for each row whose class has two members or more: its other
    columns, ``_e_class`` (the smallest ``_e_row`` of the class) and ``_e_n``.
    """
    carry = [c for c in rows.columns if c != key]
    state = rows.select(*carry, F.lit(0).cast("long").alias("_e_g"), F.col(key).alias("_e_rest"))
    digit, done, last = FIRST_DIGIT, None, []
    while True:
        digits = state.select(
            *carry, "_e_g", F.expr(f"substring(_e_rest, 1, {digit})").alias("_e_digit"),
            (F.length("_e_rest") <= digit).alias("_e_end"),
            F.expr(f"substring(_e_rest, {digit + 1})").alias("_e_rest"))
        split = ["_e_g", "_e_digit", "_e_end"]
        groups = scratch.write(digits.groupBy(*split).agg(F.count(F.lit(1)).alias("_e_n"),
                                                          F.min("_e_row").alias("_e_class")).where("_e_n > 1"))
        met = scratch.write(lookup_join(digits, groups, split, "_e_n").drop("_e_digit"), ["_e_end"])
        scratch.drop(groups, *last)
        ended = met.where("_e_end").select(*carry, "_e_class", "_e_n")
        done = ended if done is None else done.unionByName(ended)
        state = met.where("NOT _e_end").select(*carry, F.col("_e_class").alias("_e_g"), "_e_rest")
        if state.isEmpty():
            return done
        digit *= WIDER


def exact_dedup(df: DataFrame, key_col: str, points: Column, id_col: str = "doc_id",
                keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns in ``keep`` (all), then keep_id, group_size and kept.

    Of rows with equal ``key_col`` the one with the most ``points`` (a column
    of whole numbers, such as the text's length), then the smallest id, stays;
    ``keep_id`` is its id.  Filter by ``kept`` for the deduplicated table.
    Columns named like a result are replaced.
    """
    scratch = Scratch(df.sparkSession, "exact")
    own = [c for c in without(df, RESULT) if keep is None or c in keep]
    base = scratch.write(df.select(
        F.monotonically_increasing_id().alias("_e_row"), F.struct(*[col(c) for c in own]).alias("_e_df"),
        col(id_col).alias("_e_id"), points.cast("long").alias("_e_points"),
        F.coalesce(col(key_col), F.lit("")).cast("binary").alias("_e_key")))
    rows = base.select("_e_row", "_e_id", "_e_points", "_e_key")
    copies = scratch.write(radix_classes(rows, "_e_key", scratch))
    rank = F.struct((-F.col("_e_points")).alias("p"), F.col("_e_id").isNull().alias("z"),
                    F.col("_e_id").alias("i"), F.col("_e_row").alias("r"))
    best = scratch.write(copies.groupBy("_e_class", "_e_n").agg(F.min(rank).alias("_e_best")))
    found = lookup_join(copies.select("_e_row", "_e_class"), best, ["_e_class"], "_e_n").select(
        "_e_row", "_e_n", F.col("_e_best.i").alias("_e_keep"), (F.col("_e_best.r") == F.col("_e_row")).alias("_e_kept"))
    out = base.select("_e_row", "_e_id", "_e_df").join(found.hint("merge"), "_e_row", "left")
    single = F.col("_e_n").isNull()
    return out.select(*[F.col("_e_df").getField(c).alias(c) for c in own],
                      F.when(single, F.col("_e_id")).otherwise(F.col("_e_keep")).alias("keep_id"),
                      F.coalesce("_e_n", F.lit(1).cast("long")).alias("group_size"),
                      F.coalesce("_e_kept", F.lit(True)).alias("kept"))
