"""the full conversion of EAV records into the wide view.

Plan shape (independent of the number of records or files)::

    rec --(route + one partial aggregation)--> file index
          records ---------------------------------------------+
          tokens -> names / labels, values -> indicators,      |
          forms -> link walk   (narrow N:1 joins)              |
                -> enrichment rows -> one aggregation by rk ---+-> join on (src, rk) -> 35 columns

What a field contributes to each step is its transform's (``transforms``), so a
caller's own kinds join the same plan.  No ``collect``; the driver only builds the plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavflow.operators.file_index import FileIndex, build_index
from eavflow.plans import spec as S
from eavflow.plans import transforms as T
from eavflow.plans.stage import Stage


@dataclass
class Conversion:
    view: DataFrame          # src, first_ord, form, <template columns>
    diagnostics: DataFrame   # src, form, field, token, reason
    index: FileIndex


def _union(parts: list[DataFrame]) -> DataFrame | None:
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def enrichment(idx: FileIndex, tpl: S.Template) -> tuple[DataFrame | None, DataFrame | None]:
    """All join-backed field values as (src, rk, kind, value, hit) rows, plus diagnostics."""
    parts, diags = [], []
    for transform, fields in T.by_transform(tpl).items():
        rows, problems = transform.enrich(idx, tpl, fields)
        parts += rows
        diags += problems
    return _union(parts), _union(diags)


def fold(enrich: DataFrame, tpl: S.Template) -> DataFrame:
    """One row per (src, rk) with the columns that the fields' transforms fold."""
    return enrich.groupBy("src", "rk").agg(*[a for f in tpl.fields for a in T.transform_of(f).folds(f)])


def convert(rec: DataFrame, tpl: S.Template = S.RISK_TEMPLATE, stage: Stage | None = None) -> Conversion:
    """EAV rows (src, ord, header..., form, group_, id, data) -> wide view; ``stage`` deletes the index after the run."""
    idx = build_index(rec, tpl, stage, T.dictionaries(tpl))
    enrich, diags = enrichment(idx, tpl)
    wide = idx.records
    if enrich is not None:
        wide = wide.join(fold(enrich, tpl), ["src", "rk"], "left")
    view = wide.select("src", F.col("rk").alias("first_ord"), "form", *list(tpl.header),
                       *[T.transform_of(f).column(f, tpl).cast("string").alias(f.out) for f in tpl.fields])
    if diags is None:
        diags = rec.sparkSession.createDataFrame([], "src string, form string, field string, token string, reason string")
    return Conversion(view, diags, idx)


def wide_view(rec: DataFrame, tpl: S.Template = S.RISK_TEMPLATE, with_order: bool = False) -> DataFrame:
    """The template's columns (plus ``src``; plus ``first_ord`` when asked)."""
    v = convert(rec, tpl).view
    return v.select("src", *(["first_ord"] if with_order else []), *tpl.columns)
