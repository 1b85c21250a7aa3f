"""how a field gets its value, as a protocol that a caller can implement.

A ``FieldSpec.kind`` is the name of a built-in transform or any ``Transform``.
A transform may contribute, each part optional:

* ``dictionaries``: lookups of its own, routed and aggregated in the one pass
  that builds the file index (so a template with many of them still scans its
  records once);
* ``enrich``: join-backed values as rows (src, rk, kind, value, hit), all fields
  of equal transforms at once, and diagnostics (src, form, field, token, reason);
* ``folds``: aggregates that bring those rows back to one row per record;
* ``column``: the output column, over the record's attributes and the folds.

The built-in kinds are written in the same protocol.  A value function that
needs the value alone is a ``Scalar``; one that looks the value up in rows of the
same file is a ``KeyedLookup``.  Both take Columns and SQL text, no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavflow.functions import values as V
from eavflow.operators import links, lookup
from eavflow.operators.file_index import Dictionary, FileIndex
from eavflow.operators.reshape import attr_col
from eavflow.operators.skew import lookup as join_dictionary
from eavflow.plans import spec as S

Rows = list[DataFrame]


def raw(f: S.FieldSpec) -> Column:
    return F.col(attr_col(f.source_id))


def picked(f: S.FieldSpec) -> Column:
    """In ``folds``: the value of the field's own enrichment rows, null on others."""
    return F.when(F.col("kind") == f.out, F.col("value"))


class Transform:
    #: Whether the record's last write of ``source_id`` is wanted.
    reads_source = True

    def dictionaries(self, tpl: S.Template) -> Sequence[Dictionary]:
        return ()

    def enrich(self, idx: FileIndex, tpl: S.Template, fields: Sequence[S.FieldSpec]) -> tuple[Rows, Rows]:
        return [], []

    def folds(self, f: S.FieldSpec) -> list[Column]:
        return []

    def column(self, f: S.FieldSpec, tpl: S.Template) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Scalar(Transform):
    """``of(value)``; where ``unreadable(value)`` holds, a diagnostics row says ``reason``."""
    of: Callable[[Column], Column]
    unreadable: Callable[[Column], Column] | None = None
    reason: str = "unreadable value"

    def enrich(self, idx, tpl, fields):
        if self.unreadable is None:
            return [], []
        return [], [idx.records.where(self.unreadable(raw(f))).select(
            "src", "form", F.lit(f.out).alias("field"), raw(f).alias("token"), F.lit(self.reason).alias("reason"))
            for f in fields]

    def column(self, f, tpl):
        return self.of(raw(f))


@dataclass(frozen=True)
class KeyedLookup(Transform):
    """The value looked up in rows of the same file.

    ``dictionary`` says which rows and under which key, ``take`` which of its
    values.  A value without a match stays itself (``or_self``) or becomes null,
    and leaves a diagnostics row if ``report``.  A match whose value is null gives null.
    """
    dictionary: Dictionary
    take: str
    or_self: bool = False
    report: bool = False

    def dictionaries(self, tpl):
        return (self.dictionary,)

    def enrich(self, idx, tpl, fields):
        name = self.dictionary.name
        known = idx.extra[name].select("src", "key", F.col(self.take).alias("value"), F.lit(True).alias("hit"))
        rows, diags = [], []
        for f in fields:
            asked = idx.records.where(raw(f).isNotNull()).select("src", "rk", "form", raw(f).alias("key"))
            found = join_dictionary(asked, known, ["src", "key"], "left" if self.report else "inner", idx.sizes[name])
            rows.append(found.where("hit").select("src", "rk", F.lit(f.out).alias("kind"),
                                                  F.col("value").cast("string").alias("value"), "hit"))
            if self.report:
                diags.append(found.where("hit IS NULL").select("src", "form", F.lit(f.out).alias("field"),
                                                               F.col("key").alias("token"), F.lit("no lookup row").alias("reason")))
        return rows, diags

    def folds(self, f):
        return _value_and_hit(f)

    def column(self, f, tpl):
        hit = F.when(F.col(f"{f.out}__hit").isNotNull(), F.col(f"{f.out}__val"))
        return hit.otherwise(raw(f)) if self.or_self else hit


def _value_and_hit(f: S.FieldSpec) -> list[Column]:
    return [F.max(picked(f)).alias(f"{f.out}__val"),
            F.max(F.when(F.col("kind") == f.out, F.lit(1))).alias(f"{f.out}__hit")]


def _items(f: S.FieldSpec) -> Column:
    return V.join_sorted_distinct(F.collect_set(picked(f))).alias(f"{f.out}__items")


class CodeNames(Transform):
    """Sentinel -> category name, else tokens -> names."""

    def enrich(self, idx, tpl, fields):
        L = tpl.lookups
        made = [lookup.code_names(idx.records, attr_col(f.source_id), idx.codes, L.name_marker, L.sentinels,
                                  idx.sizes["codes"], f.out) for f in fields]
        return [e for e, _ in made], [d for _, d in made]

    def folds(self, f):
        return [_items(f), F.max(F.when(F.col("kind") == f"{f.out}:cat", F.col("value"))).alias(f"{f.out}__cat")]

    def column(self, f, tpl):
        return (F.when(raw(f).isin(list(tpl.lookups.sentinels)), F.col(f"{f.out}__cat"))
                 .otherwise(F.coalesce(F.col(f"{f.out}__items"), F.lit(""))))


class CodeLabels(Transform):
    """Tokens -> path labels."""

    def enrich(self, idx, tpl, fields):
        made = [lookup.code_labels(idx.records, attr_col(f.source_id), idx.labels, tpl.lookups.label_marker,
                                   idx.sizes["labels"], f.out) for f in fields]
        return [e for e, _ in made], [d for _, d in made]

    def folds(self, f):
        return [_items(f)]

    def column(self, f, tpl):
        return F.coalesce(F.col(f"{f.out}__items"), F.lit(""))


class LookupOrSelf(Transform):
    """Indicator name, or the value itself."""

    def enrich(self, idx, tpl, fields):
        return [lookup.lookup_or_self(idx.records, attr_col(f.source_id), idx.codes, idx.sizes["codes"], f.out)
                for f in fields], []

    def folds(self, f):
        return _value_and_hit(f)

    def column(self, f, tpl):
        return (F.when(V.blank(raw(f)), raw(f))
                 .when(F.col(f"{f.out}__hit").isNotNull(), F.col(f"{f.out}__val"))
                 .otherwise(raw(f)))


class LinkName(Transform):
    """The name at the other end of the record's first link (J5); one walk for all relations."""
    reads_source = False

    def enrich(self, idx, tpl, fields):
        return [links.link_names(idx.records, idx, [(f.out, f.param, tpl.link_name_id(f.param)) for f in fields])], []

    def folds(self, f):
        return [F.max(picked(f)).alias(f"{f.out}__val")]

    def column(self, f, tpl):
        return F.col(f"{f.out}__val")


BUILT_IN: dict[str, Transform] = {
    S.COPY: Scalar(lambda c: c),
    S.YES_NO: Scalar(V.yes_no),
    S.YES_NO_SOME: Scalar(V.yes_no_some),
    S.DATE: Scalar(V.date_norm, V.date_unreadable, "unreadable date"),
    S.CODE_NAMES: CodeNames(),
    S.CODE_LABELS: CodeLabels(),
    S.LOOKUP_OR_SELF: LookupOrSelf(),
    S.LINK_NAME: LinkName(),
}


def transform_of(f: S.FieldSpec) -> Transform:
    if isinstance(f.kind, Transform):
        return f.kind
    if f.kind not in BUILT_IN:
        raise ValueError(f"field {f.out!r}: no transform is named {f.kind!r}")
    return BUILT_IN[f.kind]


def by_transform(tpl: S.Template) -> dict[Transform, list[S.FieldSpec]]:
    """The template's fields under their transforms, equal ones together."""
    out: dict[Transform, list[S.FieldSpec]] = {}
    for f in tpl.fields:
        out.setdefault(transform_of(f), []).append(f)
    return out


def dictionaries(tpl: S.Template) -> list[Dictionary]:
    """All that the template's transforms look up beside the template's own lookups, each once."""
    out: dict[str, Dictionary] = {}
    for t in by_transform(tpl):
        for d in t.dictionaries(tpl):
            if out.setdefault(d.name, d) != d:
                raise ValueError(f"two dictionaries are named {d.name!r}")
    return list(out.values())
