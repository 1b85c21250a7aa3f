"""Per-file code lookups (J1-J4) with the distinct list aggregate (A3).

Every operator takes narrow record columns ``(src, rk, form, value)`` and the
pre-aggregated dictionaries of ``file_index`` (unique per key), so each join is
N:1 and cannot multiply rows.  Results are *enrichment rows*
``(src, rk, kind, value, hit)`` that the pipeline folds back into the record
with one aggregation and one join; misses become diagnostics rows
``(src, form, field, token, reason)`` instead of failing the job.

Dictionaries are staged, so their size is known: small ones are broadcast,
larger ones are joined with hot codes held apart (``skew.lookup``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavflow.functions import values as V
from eavflow.operators.skew import lookup

ENRICH_COLS = ["src", "rk", "kind", "value", "hit"]
DIAG_COLS = ["src", "form", "field", "token", "reason"]


def _enrich(df: DataFrame, kind: str, value, hit=None) -> DataFrame:
    return df.select("src", "rk", F.lit(kind).alias("kind"),
                     (value if not isinstance(value, str) else F.col(value)).cast("string").alias("value"),
                     (hit if hit is not None else F.lit(True)).alias("hit"))


def _diag(df: DataFrame, field: str, token, reason) -> DataFrame:
    return df.select("src", "form", F.lit(field).alias("field"),
                     (token if not isinstance(token, str) else F.col(token)).alias("token"),
                     (reason if not isinstance(reason, str) else F.lit(reason)).alias("reason"))


def tokens(records: DataFrame, value: str, marker: str) -> DataFrame:
    """V4 + V6: (src, rk, form, tok) for every token of the code list holding ``marker``."""
    return (records.where(F.col(value).isNotNull())
                   .select("src", "rk", "form", F.explode(V.token_split(value)).alias("tok"))
                   .where(F.col("tok").contains(marker)))


def category(records: DataFrame, value: str, codes: DataFrame, sentinels, size: int,
             kind: str = "cat") -> DataFrame:
    """A whole-value sentinel resolved to the file's category name (null if none)."""
    sent = records.where(F.col(value).isin(list(sentinels))).select("src", "rk", F.col(value).alias("code"))
    cat = codes.where(F.col("cat").isNotNull()).select("src", F.col("form").alias("code"), "cat")
    return _enrich(lookup(sent, cat, ["src", "code"], "left", size), kind, "cat")


def code_names(records: DataFrame, value: str, codes: DataFrame, marker: str,
               sentinels, size: int, field: str = "fsa") -> tuple[DataFrame, DataFrame]:
    """J2 (+J1): tokens -> first name row of the file; items for A3; misses to diagnostics."""
    non_sent = records.where(~F.col(value).isin(list(sentinels)))
    toks = tokens(non_sent, value, marker)
    names = codes.where("fsa_hit").select("src", F.col("form").alias("tok"), "fsa_name", "fsa_hit")
    hits = lookup(toks, names, ["src", "tok"], "left", size)
    ok = F.coalesce(F.col("fsa_hit"), F.lit(False)) & F.col("fsa_name").isNotNull()
    items = hits.where(ok).select("src", "rk", F.explode(V.list_items("fsa_name")).alias("item"))
    diag = _diag(hits.where(~ok), field, "tok",
                 F.when(F.coalesce(F.col("fsa_hit"), F.lit(False)), "null name").otherwise("no lookup row"))
    cat = category(records, value, codes, sentinels, size, f"{field}:cat")
    return _enrich(items, field, "item").unionByName(cat), diag


def code_labels(records: DataFrame, value: str, labels: DataFrame, marker: str, size: int,
                field: str = "assert") -> tuple[DataFrame, DataFrame]:
    """J3 + V5: tokens -> first row with that id (any group) -> path label -> items."""
    toks = tokens(records, value, marker)
    hits = lookup(toks, labels.select("src", F.col("id").alias("tok"), "label", "label_hit"),
                  ["src", "tok"], "left", size)
    lab = V.path_label("label")
    ok = F.col("label_hit").isNotNull() & lab.isNotNull()
    items = hits.where(ok).select("src", "rk", F.explode(V.list_items(lab)).alias("item"))
    reason = (F.when(F.col("label_hit").isNull(), "no lookup row")
               .when(F.col("label").isNull(), "null label")
               .otherwise("no label segment"))
    return _enrich(items, field, "item"), _diag(hits.where(~ok), field, "tok", reason)


def lookup_or_self(records: DataFrame, value: str, codes: DataFrame, size: int,
                   field: str = "sri") -> DataFrame:
    """Non-blank value -> first indicator row's data (even null) if a row exists.

    Only hits are emitted; the pipeline keeps the value itself otherwise.
    """
    left = records.where(~V.blank(value)).select("src", "rk", F.col(value).alias("code"))
    ind = codes.where("ind_hit").select("src", F.col("form").alias("code"), "ind")
    return _enrich(lookup(left, ind, ["src", "code"], "inner", size), field, "ind")
