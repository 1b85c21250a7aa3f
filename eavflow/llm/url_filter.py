"""URL filters: gradient-boosted trees on lexical features, in DataFrame functions only.

Training runs as aggregations.  Features are cut into at most ``BINS`` bins at
quantiles; equal binned rows are counted together once; a tree level is one
aggregation of gradient and weight sums by (node, feature, bin), which has at
most 2**depth * features * bins rows, whatever the input, and is all that
reaches the driver.  The model is a sum of CASE expressions, so scoring is a
projection of the scan.

Features: length, path depth, digit ratio, entropy of the host's characters,
number of parameters, host labels, hyphens, and the smoothed block rate and
frequency of the host's suffix (its last label) among the labelled URLs.

Defined cases: null or malformed URLs have empty host and path, and are scored
on them; with no labelled rows, or one class only, the score is the class rate
(0.5 without rows); ties between splits go to the first feature and bin.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavflow.llm.common import Scratch, col, lookup_join

BINS, TREES, DEPTH, RATE, SMOOTH, LEAST = 16, 10, 3, 0.4, 8.0, 4.0
LEXICAL = ("length", "depth", "digits", "entropy", "params", "labels", "hyphens")
FEATURES = (*LEXICAL, "suffix_rate", "suffix_n")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_verdict(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host, path, verdict) that fits, else nulls.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for the empty text."""
    n = F.length(text).cast("double")
    p = F.transform(F.array_distinct(F.split(text, "")),
                    lambda c: F.when(c != "", (n - F.length(F.replace(text, c, F.lit("")))) / n).otherwise(F.lit(1.0)))
    return F.when(n > 0, F.aggregate(p, F.lit(0.0), lambda a, x: a - x * F.log2(x))).otherwise(F.lit(0.0))


def lexical(url: str, host_: str, path_: str) -> dict[str, Column]:
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.length(u)
    query = F.regexp_extract(u, r"(?s)^[^?#]*\?([^#]*)", 1)
    return {
        "length": n.cast("double"),
        "depth": F.regexp_count(F.col(path_), F.lit("/[^/]")).cast("double"),
        "digits": F.when(n > 0, F.regexp_count(u, F.lit("[0-9]")) / n).otherwise(F.lit(0.0)),
        "entropy": entropy(F.col(host_)),
        "params": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
        "labels": F.regexp_count(F.col(host_), F.lit("[^.]+")).cast("double"),
        "hyphens": F.regexp_count(F.col(host_), F.lit("-")).cast("double"),
    }


@dataclass
class Boosted:
    """cuts: by feature, ascending; a value's bin is the number of cuts below it."""

    base: float = 0.0
    cuts: dict[str, list[float]] = field(default_factory=dict)
    trees: list[dict] = field(default_factory=list)

    def bin(self, name: str) -> Column:
        out = F.lit(0)
        for i, c in enumerate(self.cuts[name]):
            out = F.when(F.col(name) > F.lit(c), F.lit(i + 1)).otherwise(out)
        return out.cast("int")

    def margin(self, binned: bool = False) -> Column:
        out = F.lit(float(self.base))
        for t in self.trees:
            out = out + self._value(t, binned)
        return out

    def _value(self, node: dict, binned: bool) -> Column:
        if "value" in node:
            return F.lit(float(node["value"]))
        name, b = node["split"]
        right = F.col("b_" + name) > b if binned else F.col(name) > F.lit(self.cuts[name][b])
        return F.when(right, self._value(node["right"], binned)).otherwise(self._value(node["left"], binned))

    def score(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def fit(rows: DataFrame, label: str, scratch: Scratch, features=FEATURES, trees: int = TREES, depth: int = DEPTH,
        bins: int = BINS, rate: float = RATE) -> Boosted:
    """Logistic boosting on ``rows`` with a 0/1 ``label`` column."""
    model = Boosted()
    steps = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("k"),
                     *[F.percentile_approx(f, steps, F.lit(10000)).alias(f) for f in features]).first()
    n, k = first["n"], first["k"] or 0
    if not n:
        return model
    # smoothed, so that one class alone has a finite score
    model.base = math.log((k + 0.5) / (n - k + 0.5))
    model.cuts = {f: sorted(set(first[f])) for f in features}
    if k in (0, n):
        return model
    binned = scratch.write(rows.select(*[model.bin(f).alias("b_" + f) for f in features], F.col(label).alias("_e_y"))
                           .groupBy(*["b_" + f for f in features])
                           .agg(F.count(F.lit(1)).alias("_e_w"), F.sum("_e_y").alias("_e_k")))
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col("b_" + f).alias("b"))
                                for i, f in enumerate(features)])).alias("cell")
    for _ in range(trees):
        root: dict = {}
        open_ = [(root, F.lit(True))]
        now = binned.withColumn("_e_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin(binned=True))))
        for level in range(depth):
            node = F.lit(-1)
            for i, (_, here) in enumerate(open_):
                node = F.when(here, F.lit(i)).otherwise(node)
            sums = (now.select(node.alias("node"), "_e_w", "_e_k", "_e_p", cells).where("node >= 0")
                    .groupBy("node", "cell.f", "cell.b")
                    .agg(F.sum(F.col("_e_k") - F.col("_e_w") * F.col("_e_p")).alias("g"),
                         F.sum(F.col("_e_w") * F.col("_e_p") * (1 - F.col("_e_p"))).alias("h")).collect())
            after = []
            for i, (leaf, here) in enumerate(open_):
                split, g, h = _best([r for r in sums if r["node"] == i], features)
                if split is None:
                    leaf["value"] = rate * g / (h + 1.0)
                    continue
                name, b, (gl, hl), (gr, hr) = split
                leaf |= {"split": (name, b), "left": {}, "right": {}}
                goes = F.col("b_" + name) > b
                if level == depth - 1:
                    leaf["left"]["value"], leaf["right"]["value"] = rate * gl / (hl + 1.0), rate * gr / (hr + 1.0)
                else:
                    after += [(leaf["left"], here & ~goes), (leaf["right"], here & goes)]
            open_ = after
            if not open_:
                break
        model.trees.append(root)
    return model


def _best(rows: list, features) -> tuple:
    """The split with the most gain of one node's (feature, bin) sums, and the node's own sums."""
    by: dict[int, dict[int, tuple[float, float]]] = {}
    for r in rows:
        by.setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
    if not by:
        return None, 0.0, 0.0
    g, h = (sum(v[i] for v in by[0].values()) for i in (0, 1))
    best, most = None, 1e-6
    for f in sorted(by):
        gl = hl = 0.0
        for b in sorted(by[f])[:-1]:
            gl, hl = gl + by[f][b][0], hl + by[f][b][1]
            gr, hr = g - gl, h - hl
            gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - g * g / (h + 1)
            if gain > most + 1e-9 and min(hl, hr) * 4 >= LEAST:
                best, most = (features[f], b, (gl, hl), (gr, hr)), gain
    return best, g, h


def judge(df: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``df``: its columns, then host, path, rule, score and verdict.

    URLs that a rule decides are the labelled ones: they train the trees and
    keep the rule's verdict.  The others get ``block`` where the trees' block
    probability is over ``threshold``.  Columns named like a result are replaced.
    """
    scratch = Scratch(df.sparkSession, "urls")
    own = [c for c in df.columns if c.lower() not in {"host", "path", "rule", "score", "verdict"}]
    rows = df.select(F.struct(*[col(c) for c in own]).alias("_e_df"), col(url_col).alias("_e_url"),
                     host(col(url_col)).alias("_e_host"), path(col(url_col)).alias("_e_path"))
    rule, verdict = rule_verdict(F.col("_e_host"), F.col("_e_path"), rules)
    rows = rows.withColumns({"_e_rule": rule, "_e_verdict": verdict})
    rows = rows.withColumns(lexical("_e_url", "_e_host", "_e_path"))
    rows = scratch.write(rows.withColumns({
        "_e_y": (F.col("_e_verdict") == "block").cast("int"),
        "_e_suffix": F.regexp_extract("_e_host", r"([^.]*)\.?$", 1)}))
    stats = scratch.write(rows.groupBy("_e_suffix").agg(F.count(F.lit(1)).alias("_e_n"), F.count("_e_y").alias("_e_l"),
                                                        F.sum("_e_y").alias("_e_b")))
    every = stats.agg(F.sum("_e_l"), F.sum("_e_b")).first()
    prior = (every[1] or 0) / every[0] if every[0] else 0.5
    stats = scratch.write(stats.select(
        "_e_suffix", "_e_n", ((F.coalesce("_e_b", F.lit(0)) + SMOOTH * prior) / (F.col("_e_l") + SMOOTH)).alias("suffix_rate"),
        F.log1p(F.col("_e_l").cast("double")).alias("suffix_n")))
    rows = scratch.write(lookup_join(rows, stats, ["_e_suffix"], "_e_n"))
    model = fit(rows.where("_e_y IS NOT NULL"), "_e_y", scratch)
    score = model.score()
    return rows.select(*[F.col("_e_df").getField(c).alias(c) for c in own], F.col("_e_host").alias("host"),
                       F.col("_e_path").alias("path"), F.col("_e_rule").alias("rule"), score.alias("score"),
                       F.coalesce("_e_verdict", F.when(score > threshold, "block").otherwise("allow")).alias("verdict"))
