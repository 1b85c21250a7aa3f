"""J5 link walk: record -> first link naming it -> relation check -> target -> name.

The reference issues up to four filtered scans per record and relation.  Here
it is three N:1 joins over pre-aggregated keys for all records and both
relations at once:

1. ``members``  (src, data -> first link form ``lf``)        -- first link only
2. ``links``    on ``lf``: first ``MEMBER_A`` target, relation flags
3. ``targets``  on the target: first name row per name id

Any miss (no link, wrong relation, no target, no name, null keys) is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavflow.functions import values as V
from eavflow.operators import skew
from eavflow.operators.file_index import FileIndex, name_col, rel_col
from eavflow.operators.skew import lookup


def _cut(step: DataFrame, idx: FileIndex, following: str) -> DataFrame:
    """Staged if the next lookup is too large for a broadcast: it reads its rows several times, and theirs would be read as often again."""
    return step if idx.sizes[following] <= skew.BROADCAST_BYTES else idx.stage.table(step, "walk")


def link_walk(records: DataFrame, idx: FileIndex, relations) -> DataFrame:
    """(src, rk, form, lf, target, r__<rel>..., n__<name>...) for the records that a walk gets through."""
    rels = list(relations)
    recs = records.where(~V.blank("form")).select("src", "rk", "form")
    step1 = _cut(lookup(recs, idx.members.select("src", F.col("data").alias("form"), "lf"), ["src", "form"], "inner",
                        idx.sizes["members"]), idx, "links")
    link = idx.links.select("src", F.col("form").alias("lf"), "target", *[rel_col(r) for r, _ in rels])
    step2 = _cut(lookup(step1, link, ["src", "lf"], "inner", idx.sizes["links"]), idx, "targets")
    names = idx.targets.select("src", F.col("form").alias("target"), *[name_col(n) for _, n in rels])
    return lookup(step2, names, ["src", "target"], "inner", idx.sizes["targets"])


def link_names(records: DataFrame, idx: FileIndex, fields) -> DataFrame:
    """Enrichment rows for each ``(field, relation, name_id)``, one pass over the walk."""
    fields = list(fields)
    walk = link_walk(records, idx, [(r, n) for _, r, n in fields])
    found = F.filter(F.array(*[
        F.when(F.col(rel_col(rel)) & F.col(name_col(nid)).isNotNull(),
               F.struct(F.lit(fld).alias("kind"), F.col(name_col(nid)).alias("value")))
        for fld, rel, nid in fields]), lambda x: x.isNotNull())
    return (walk.select("src", "rk", F.explode(found).alias("_f"))
                .select("src", "rk", F.col("_f.kind").alias("kind"),
                        F.col("_f.value").alias("value"), F.lit(True).alias("hit")))
