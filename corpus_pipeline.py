"""The corpus pipeline: five stages over ``documents``, each reading what its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result under the shared folder and reads it again for the next.
All stages but the last return the columns of ``docs``; where a stage changes
the text, ``n_chars`` follows it.  SQL cannot express the stages (a trained
classifier, MinHash, SimHash and tokenised packing), so ``ORACLE_SQL`` is None
and the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavflow.llm import line_dedup, mixing, packing, quality, simhash
from eavflow.llm.common import Scratch, cleared, col
from eavflow.llm.language_id import held_out
from eavflow.llm.queries import table, tokenizer_path

SHINGLE_WORDS, RADIUS = 4, 4


def _packed(docs: DataFrame, needed: list[str], text: bool = True) -> DataFrame:
    """``docs`` as one struct beside the needed columns, so that no other column can clash with an operator's own."""
    inner = [col(c) for c in docs.columns if text or c != "text"]
    return docs.select(F.struct(*inner).alias("docs_row"), *[col(c) for c in needed])


def _unpacked(df: DataFrame, docs: DataFrame, new_text: bool = False) -> DataFrame:
    """The columns of ``docs`` again; with ``new_text`` the text and ``n_chars`` follow the operator's text."""
    made = {"text": F.col("text"), "n_chars": F.length("text")} if new_text else {}
    return df.select(*[(made[c].cast(docs.schema[c].dataType) if c in made else F.col("docs_row").getField(c)).alias(c)
                       for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1; labels of the held-out third teach nothing."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(table(spark, sf_dir, "documents"), labels.where(~held_out(F.col("doc_id"), 3, 1)))
    quality.ship(spark)
    return docs.where(quality.score(model, col("text")) >= 0.5)


def fuzzy_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one."""
    return _unpacked(line_dedup.line_dedup(_packed(docs, ["doc_id", "text"], text=False)), docs, new_text=True)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    out = simhash.near_dedup(_packed(docs, ["doc_id", "text"]), words=SHINGLE_WORDS, radius=RADIUS, keep=["docs_row"])
    return _unpacked(out.where("kept"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows = _packed(docs, ["doc_id", "source"])
    mixed = mixing.mix(rows, mixing.words(F.col("docs_row").getField("text")))
    return _unpacked(mixing.emit(mixed, ["docs_row"]), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most one sequence with their sequence and offset."""
    parts = packing.pieces(docs, tokenizer_path(), keep=["doc_id", "source"]).select(
        "doc_id", "source", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(parts)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", fuzzy_line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mix_sources),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over all of ``documents``; what a stage staged goes when its result is written."""
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with cleared():
            docs = scratch.write(stage(spark, docs, sf_dir), compression="zstd")
        scratch.drop(*last)
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
