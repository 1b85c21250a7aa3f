"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words: its share by weight of all words, at most
``cap`` times what it has; what is above goes to the others by weight until
none is above.  A document of the source is expected target / source size
times.  The documents of a source stand in a row, by size; the prefix sum of
their expected copies plus one offset of the source crosses integers, and each
crossing emits one copy.  By size, so that the copies are spread evenly over
short and long documents and the words taken stay within one document or two
of the target.

The row is found without gathering a source in one task: a range shuffle by
(source, size, id) gives every task a run of it, and the runs' row counts give
each run its first rank.  Targets and ranks come from one row per source and
one per run.

Defined cases: null text is empty (size 0); null source is a source of its
own, the last; a source without words has target 0 and takes nothing; ties and
repeated rows are separate documents in a fixed order (by id, then by content);
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eavflow.llm.common import Scratch, col, without

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
RESULT = ("size", "source_size", "target", "copies", "taken")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str) -> Column:
    """The source's offset in [0, 1): 32 bits of the MD5 of the seed and the name."""
    h = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("")))), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(_e_src, _e_words) per source -> with _e_target.  One row per source, so its windows hold no documents.

    Water filling in closed form: with the first k sources by cap / weight at
    their cap, the level of the rest (words a unit of weight) rises as long as
    the next one is below it and falls after, so the level is the highest of all.
    """
    order = W.orderBy(F.col("_e_src").asc_nulls_last())
    at = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (at + 1).cast("int")).cast("long")
    s = (sizes.withColumn("_e_w", w).withColumn("_e_cap", F.col("_e_words") * cap)
         .withColumn("_e_ratio", F.col("_e_cap") / F.col("_e_w")))
    full = W.orderBy("_e_ratio", F.col("_e_src").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    level = ((F.sum("_e_words").over(every) - F.coalesce(F.sum("_e_cap").over(full), F.lit(0)))
             / (F.sum("_e_w").over(every) - F.coalesce(F.sum("_e_w").over(full), F.lit(0))))
    s = s.withColumn("_e_level", level).withColumn("_e_level", F.max("_e_level").over(every))
    return s.withColumn("_e_target", F.least(F.col("_e_cap").cast("double"), F.col("_e_level") * F.col("_e_w")))


def mix(df: DataFrame, size: Column, source_col: str = "source", id_col: str = "doc_id",
        weights=WEIGHTS, cap: int = CAP, seed: str = "mix-1") -> DataFrame:
    """One row per row of ``df``: its columns, then size, source_size, target, copies and taken.

    ``copies`` is how often the mix takes the document (0 .. cap), ``taken``
    the words of all copies.  ``emit`` turns the rows into the mixed corpus.
    Columns of ``df`` named like a result are replaced.
    """
    scratch = Scratch(df.sparkSession, "mix")
    own = without(df, RESULT)
    rows = df.select(*[col(c) for c in own], col(source_col).alias("_e_src"), col(id_col).alias("_e_id"),
                     size.cast("long").alias("_e_size"))
    order = [F.col("_e_src").asc_nulls_last(), F.col("_e_size"), F.col("_e_id").asc_nulls_last(),
             F.xxhash64(*[col(c) for c in own])]
    # the place in the partition after the sort: partition number * 2**33 + row
    rows = scratch.write(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_e_at", F.monotonically_increasing_id()))
    run = F.shiftright("_e_at", 33)
    runs = scratch.write(rows.groupBy("_e_src", run.alias("_e_run")).agg(
        F.count(F.lit(1)).alias("_e_n"), F.min("_e_at").alias("_e_first"), F.sum("_e_size").alias("_e_words")))
    sizes = runs.groupBy("_e_src").agg(F.sum("_e_words").alias("_e_words"))
    goal = targets(sizes, weights, cap).select(F.col("_e_src").alias("_e_s"), F.col("_e_words").alias("_e_sw"), "_e_target")
    before = F.coalesce(F.sum("_e_n").over(W.partitionBy("_e_src").orderBy("_e_run")
                                           .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_e_before", before).join(goal, F.col("_e_src").eqNullSafe(F.col("_e_s")))
    # written, so that Spark knows its size and broadcasts it only if that is small
    runs = scratch.write(runs.select(F.col("_e_src").alias("_e_s"), F.col("_e_run").alias("_e_r"), "_e_first",
                                     "_e_before", "_e_sw", "_e_target"))
    # a run is what one task wrote, so no key of this join is larger than a partition
    out = rows.join(runs, (run == F.col("_e_r")) & F.col("_e_src").eqNullSafe(F.col("_e_s")))
    k = F.col("_e_before") + F.col("_e_at") - F.col("_e_first")
    rate = F.when(F.col("_e_sw") > 0, F.col("_e_target") / F.col("_e_sw")).otherwise(F.lit(0.0))
    u = offset(F.col("_e_src"), seed)
    copies = (F.floor(rate * (k + 1) + u) - F.floor(rate * k + u)).cast("long")
    return out.select(*[col(c) for c in own], F.col("_e_size").alias("size"), F.col("_e_sw").alias("source_size"),
                      F.col("_e_target").alias("target"), copies.alias("copies"),
                      (copies * F.col("_e_size")).alias("taken"))


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed corpus: every document as often as its copies say."""
    return (mixed.where("copies > 0")
            .withColumn("_e_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*[col(c) for c in columns]))
