"""Two aggregations: the records, and every per-file dictionary at once.

All lookups of the conversion read "the first row of the same file where ...".
Instead of scanning the rows once per dictionary, every row is routed to
the keys it can be found under and a single aggregation builds them all; the
records, whose many columns the narrow dictionary rows would only carry empty
through sorts and shuffle, are pivoted by one of their own (``reshape``):

========  ==========  ============================================  ==========
kind      key         rows routed there                             used by
========  ==========  ============================================  ==========
``D``     ``form``    category, name and indicator rows             J1 J2 J4
``K``     ``form``    relation and target rows of links             J5
``T``     ``form``    names of link targets                         J5
``L``     ``id``      rows whose id carries the label marker        J3
``B``     ``data``    link rows naming a record (``MEMBER_B``)      J5
``X_...`` its own     rows of a ``Dictionary``                      F1
``R``     ``form``    the records, a table of their own             all
========  ==========  ============================================  ==========

The grouping key is ``(src, kind, key)``; ``src`` is in every key because
lookups never cross files.  Every output column is a partial aggregate
(``min_by``/``max_by``/``count``), so a hot key or a file holding a third of
all rows is combined map-side (by sorting: strings have no fixed-width
buffer).  A key's values share a few columns (slots): which of them a row counts
for are bits.  The result is written once as a ``kind``-partitioned table, so each
consumer reads its own rows only and a dictionary's size is known.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavflow.operators.reshape import attr_col, pivot_last, record_filter
from eavflow.plans.spec import Template
from eavflow.plans.stage import Stage, stage_table, stored_bytes

K_RECORD, K_CODE, K_LINK, K_TARGET, K_LABEL, K_MEMBER = "R", "D", "K", "T", "L", "B"


def name_col(name_id: str) -> str:
    return f"n__{name_id}"


def rel_col(relation: str) -> str:
    return f"r__{relation}"


@dataclass(frozen=True)
class Dictionary:
    """A lookup of a caller's own in the rows of each file, built in the same pass as all others.

    ``where`` (a condition) and ``key`` (null: left out) are SQL over a row's
    columns, ``values`` are (name, SQL aggregate) pairs over the rows of one key
    (no DISTINCT: it would send every routed row through one more shuffle).
    """
    name: str
    where: str
    key: str
    values: tuple

    def __post_init__(self):
        if not re.fullmatch(r"\w+", self.name, re.ASCII):
            raise ValueError(f"a dictionary's name is made of letters, digits and underscores: {self.name!r}")

    @property
    def kind(self) -> str:
        return f"X_{self.name}"

    def column(self, value: str) -> str:
        return f"x__{self.name}__{value}"


@dataclass
class FileIndex:
    records: DataFrame      # src, form, rk, header..., a__<id>...
    codes: DataFrame        # src, form, cat, fsa_name, fsa_hit, ind, ind_hit
    links: DataFrame        # src, form, target, r__*
    targets: DataFrame      # src, form, n__*
    labels: DataFrame       # src, id, label, label_hit (always true: marks a match)
    members: DataFrame      # src, data, lf
    sizes: dict[str, int]   # staged bytes of each of them, and of the extra ones
    stage: Stage            # where its tables lie; steps that read a long join more than once cut it there
    extra: dict[str, DataFrame] = field(default_factory=dict)      # Dictionary name -> src, key, its values


def build_index(rec: DataFrame, tpl: Template, stage: Stage | None = None,
                dictionaries: Sequence[Dictionary] = ()) -> FileIndex:
    stage = stage or Stage(rec.sparkSession)
    L = tpl.lookups
    g, i, d, frm = F.col("group_"), F.col("id"), F.col("data"), F.col("form")
    header = list(tpl.header)
    records = stage_table(pivot_last(record_filter(rec, tpl.group, header), tpl.source_ids, header), f"records-{tpl.name}", stage=stage,
                          within=f"kind={K_RECORD}").where(F.col("kind") == K_RECORD)

    rels, name_ids = [r for r, _ in L.link_targets], [n for _, n in L.link_targets]

    wanted = []

    n_slots = max(3, len(name_ids))

    def to(cond, kind_: str, key, *slots, marks=()) -> F.Column:
        """A row's place under a key; bit ``b`` of ``hits`` says that the row counts for slot ``b`` of its kind, the bits after the slots are marks, whose values nobody asks for."""
        wanted.append(cond)
        bits = [*enumerate(slots), *enumerate(marks, n_slots)]
        hits = reduce(lambda x, y: x.bitwiseOR(y), [F.when(c, F.lit(1 << b)).otherwise(0) for b, c in bits], F.lit(0))
        value = frm if kind_ == K_MEMBER else d
        return F.when(cond, F.struct(F.lit(kind_).alias("kind"), key.alias("key"), value.alias("value"), hits.alias("hits")))

    route = F.array(
        to(i.isin(L.category_id, L.name_id, L.indicator_id), K_CODE, frm, (g == L.category_group) & (i == L.category_id),
           (g == L.name_group) & (i == L.name_id), (g == L.indicator_group) & (i == L.indicator_id)),
        to(i.isin(L.link_relation, L.link_member_target), K_LINK, frm, i == L.link_member_target,
           marks=[(i == L.link_relation) & (d == r) for r in rels]),
        to(i.isin(name_ids) if name_ids else F.lit(False), K_TARGET, frm, *[i == n for n in name_ids]),
        to(i.contains(L.label_marker), K_LABEL, i, F.lit(True)),
        to(i == L.link_member_record, K_MEMBER, d, F.lit(True)),
        *[to(F.expr(f"({x.where}) AND ({x.key}) IS NOT NULL"), x.kind, F.expr(x.key).cast("string")) for x in dictionaries],
    )
    # the columns of a caller's own dictionaries are kept for their aggregates alone
    own = [c for c in rec.columns if c not in ("src", "ord")] if dictionaries else []
    # rows that no lookup wants, most of them, go before anything is made of them
    routed = rec.where(reduce(or_, wanted)).select("src", "ord", *own, F.explode(route).alias("_k")).where("_k IS NOT NULL").select(
        "src", "ord", *own, F.col("_k.kind").alias("_kind"), F.col("_k.key").alias("_key"), F.col("_k.value").alias("_value"), F.col("_k.hits").alias("_hits"))
    bit = lambda c, b: F.col(c).bitwiseAND(F.lit(1 << b)) != 0
    # the key leads: a sort tells most rows apart by the first bytes of its first column, and few files and kinds differ in theirs
    agg = routed.groupBy(F.col("_key").alias("key"), "src", F.col("_kind").alias("kind")).agg(
        F.bit_or("_hits").alias("hits"),
        *[F.min_by("_value", F.when(bit("_hits", b), F.col("ord"))).alias(f"v{b}") for b in range(n_slots)],
        *[F.expr(how).alias(x.column(value)) for x in dictionaries for value, how in x.values])
    # Every consumer filters on ``kind``; without a cut the optimizer pushes those
    # filters below the aggregate and each consumer would rescan the rows.
    agg = stage_table(agg, f"index-{tpl.name}", ["kind"], stage)

    def of(kind_: str, *cols) -> DataFrame:
        return agg.where(F.col("kind") == kind_).select("src", *cols)

    form, first = F.col("key").alias("form"), lambda b, name: F.col(f"v{b}").alias(name)
    flags = [bit("hits", n_slots + b).alias(rel_col(r)) for b, r in enumerate(rels)]
    # rows that no lookup can use are left out of their side
    useful = F.col("target").isNotNull() & reduce(or_, [F.col(rel_col(r)) for r in rels], F.lit(False))
    return FileIndex(
        records=records.select("src", "form", "rk", *header, *[attr_col(s) for s in tpl.source_ids]),
        codes=of(K_CODE, form, first(0, "cat"), first(1, "fsa_name"), bit("hits", 1).alias("fsa_hit"), first(2, "ind"), bit("hits", 2).alias("ind_hit")),
        links=of(K_LINK, form, first(0, "target"), *flags).where(useful),
        targets=of(K_TARGET, form, *[first(b, name_col(n)) for b, n in enumerate(name_ids)]),
        labels=of(K_LABEL, F.col("key").alias("id"), first(0, "label"), F.lit(True).alias("label_hit")),
        members=of(K_MEMBER, F.col("key").alias("data"), first(0, "lf")),
        sizes={name: stored_bytes(agg, f"kind={k}") for name, k in (
            ("codes", K_CODE), ("links", K_LINK), ("targets", K_TARGET), ("labels", K_LABEL), ("members", K_MEMBER),
            *[(x.name, x.kind) for x in dictionaries])},
        stage=stage,
        extra={x.name: of(x.kind, "key", *[F.col(x.column(value)).alias(value) for value, _ in x.values])
               for x in dictionaries})
