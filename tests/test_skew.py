"""A code used by almost every record: a hot join key, with dictionaries below and beyond the broadcast limit."""

from pyspark.sql import functions as F

from eavflow.operators import skew
from eavflow.plans import pipeline
from eavflow.plans.spec import RISK_TEMPLATE
from tests.conftest import EAV_SCHEMA


def test_hot_code_and_hot_target(spark, monkeypatch):
    n = 3000
    rows = spark.range(n).select(
        F.lit("f").alias("src"), (F.col("id") * 4).alias("ord"),
        F.lit("f.csv").alias("filename"), F.lit("2020").alias("yearend"), F.lit("1").alias("entityid"),
        F.lit("E").alias("entityname"), F.lit("b").alias("bundleguid"), F.lit("t").alias("lastmodified"),
        F.lit("c").alias("cwguid"), F.concat(F.lit("R"), F.col("id").cast("string")).alias("form"),
        F.lit("RISK").alias("group_"), F.lit("R_FSA").alias("id"),
        F.when(F.col("id") % 10 == 0, F.lit("GRP2")).otherwise(F.lit("GRP1,AO1")).alias("data"))
    links = spark.range(n).select(
        F.lit("f").alias("src"), (F.col("id") * 4 + 1).alias("ord"),
        *[F.lit(None).cast("string").alias(c) for c in
          ["filename", "yearend", "entityid", "entityname", "bundleguid", "lastmodified", "cwguid"]],
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("form"), F.lit("LINK").alias("group_"),
        F.explode(F.array(
            F.struct(F.lit("MEMBER_B").alias("i"), F.concat(F.lit("R"), F.col("id").cast("string")).alias("d")),
            F.struct(F.lit("RELATION_TYPE").alias("i"), F.lit("C2R").alias("d")),
            F.struct(F.lit("MEMBER_A").alias("i"), F.lit("C1").alias("d")))).alias("x")
    ).select(*[c for c in EAV_SCHEMA_COLS if c not in ("id", "data")], F.col("x.i").alias("id"), F.col("x.d").alias("data"))
    dicts = spark.createDataFrame([
        ("f", 10**9 + 1, None, None, None, None, None, None, None, "GRP1", "FSA", "FSA_NAME", "Hot"),
        ("f", 10**9 + 2, None, None, None, None, None, None, None, "GRP2", "FSA", "FSA_NAME", "Cold"),
        ("f", 10**9 + 3, None, None, None, None, None, None, None, "AOF", "ASSERT", "AO1", "x|Label"),
        ("f", 10**9 + 4, None, None, None, None, None, None, None, "C1", "CONTROL", "C_NAME", "Ctrl")], EAV_SCHEMA)
    rec = rows.unionByName(links).unionByName(dicts)
    want = {("Hot", "Label", "Ctrl"): n - n // 10, ("Cold", "", "Ctrl"): n // 10}
    seen = {}
    for limit in (skew.BROADCAST_BYTES, 0):         # dictionaries below and beyond the limit
        monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
        view = pipeline.wide_view(rec, RISK_TEMPLATE)
        out = view.groupBy("fsa", "assert", "assocd_ctrl").count()
        got = {(r.fsa, r["assert"], r.assocd_ctrl): r["count"] for r in out.collect()}
        assert got == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        seen[limit] = plan.split("== Initial Plan ==")[0].count("LeftSemi"), plan.count("LeftAnti")
    # small: broadcast, no split; large: hot codes meet a broadcast of their own rows, the rest is merged
    assert seen[max(seen)] == (0, 0) and min(seen[0]) > 0


def test_hot_key_rows_stay_and_cold_ones_merge(spark, monkeypatch):
    left = spark.range(5000).select(F.when(F.col("id") < 2500, 1).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(1, -1)], "k long, v long"))
    for how in ("left", "inner"):
        whole = left.join(right, "k", how)
        for size in (0, skew.BROADCAST_BYTES + 1):
            out = skew.lookup(left, right, ["k"], how, size)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == (size > 0)
            assert sorted(map(str, out.select("k", "id", "v").collect())) == sorted(map(str, whole.select("k", "id", "v").collect()))


EAV_SCHEMA_COLS = [c.split()[0] for c in EAV_SCHEMA.split(", ")]
