"""Record filter (P1/P2) and the EAV pivot with last-write-wins (A1, A2, O2).

The pivot is ONE aggregation keyed by ``(src, form)`` (sort-based: ``max_by`` over
strings has no fixed-width buffer):

* ``max_by(data, CASE WHEN id = X THEN ord END)`` per mapped id gives the last
  write of X, also when that write is null (rows of other ids have a null
  ordering value and are skipped);
* ``max_by(struct(header...), ord)`` gives the header of the record's last row,
  whatever its id (A2);
* ``min(ord)`` is the record's first appearance (O2) and doubles as a record
  key ``rk`` that is unique inside ``src`` and never null, unlike ``form``.

All three are partial aggregates, so a hot record or a file holding a third of
the rows is combined map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["src", "form"]
SORT = ["form", "src"]      # grouped in this order: a sort tells rows apart by the first bytes of its first column


def record_filter(rec: DataFrame, group: str, header: Sequence[str]) -> DataFrame:
    """P1 + P2: rows of one record group with an id, projected to what the pivot needs."""
    return (rec.where((F.col("group_") == group) & F.col("id").isNotNull())
               .select("src", "ord", *header, "form", "id", "data"))


def attr_col(source_id: str) -> str:
    return f"a__{source_id}"


def pivot_last(rows: DataFrame, ids: Sequence[str], header: Sequence[str] = ()) -> DataFrame:
    """One row per (src, form): rk, header columns, ``a__<id>`` per id."""
    aggs = [F.min("ord").alias("rk")]
    if header:
        aggs.append(F.max_by(F.struct(*header), F.col("ord")).alias("_hdr"))
    aggs += [F.max_by(F.col("data"), F.when(F.col("id") == i, F.col("ord"))).alias(attr_col(i))
             for i in ids]
    out = rows.groupBy(*SORT).agg(*aggs)
    return out.select(*KEY, "rk", *[F.col("_hdr")[h].alias(h) for h in header], *[attr_col(i) for i in ids])

