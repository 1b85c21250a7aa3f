"""Steps whose work must grow no faster than their input: how files are made, lines read, dictionaries built and looked up."""

import os
import time

from pyspark.sql import functions as F

from eavflow import queries
from eavflow.functions import values as V
from eavflow.operators import links, skew
from eavflow.operators.file_index import build_index
from eavflow.plans import writer
from eavflow.plans.spec import RECORD_COLS, RISK_TEMPLATE
from eavflow.plans.stage import Stage
from eavflow.session import checkpoint_root
from eavflow.sources import fixtures as FX
from eavflow.sources import records as RD
from tests.conftest import EAV_SCHEMA

NONE = [None] * 7


def test_a_file_is_written_in_parts_and_is_one_object(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(FX, "PART_ROWS", 7)
    wide = spark.range(100).select(
        F.lit("f").alias("src"), (F.col("id") * 37 % 100).alias("ord"), *[F.lit(None).cast("string").alias(c) for c in RECORD_COLS if c not in ("form", "data")],
        F.lit("R").alias("form"), F.concat(F.lit('x,"'), (F.col("id") * 37 % 100).cast("string")).alias("data"))
    seen = []
    whole = FX._put_together
    monkeypatch.setattr(FX, "_put_together", lambda s, path, header, parts: (seen.extend(parts), whole(s, path, header, parts)))
    path = f"{tmp_path}/a b%.csv"
    FX.write_objects(wide, {"f": path})
    with open(path) as f:
        lines = f.read().splitlines()
    assert lines[0] == ",".join(RECORD_COLS) and len(lines) == 101 and len(seen) >= 15
    at = RECORD_COLS.index("data")
    assert [r["data"] for r in RD.read_records(spark, path).orderBy("ord").collect()] == [f'x,"{k}' for k in range(100)] and at >= 0
    assert os.listdir(tmp_path) == ["a b%.csv"]


def test_a_task_makes_records_of_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(FX, "SPREAD_ROWS", 10)
    assert FX.spread(spark.range(1000)).rdd.getNumPartitions() == 100


def test_a_line_is_split_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('form,id,data\nR1,A,\n"R,2",B,""\nR3,C\nR4,D,1,2\n')
    rows = RD.parse_lines(RD.read_lines(spark, [str(tmp_path)]), ["id", "form", "data", "other"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1
    assert [tuple(r)[2:] for r in rows.orderBy("ord").collect()] == [("A", "R1", None, None), ("B", "R,2", None, None)]


def _small(spark):
    rows = [("f", 1, *NONE, "R1", "RISK", "R_FRF", "FT1"), ("f", 2, *NONE, "R2", "RISK", "R_FRF", "FT2"),
            ("f", 3, *NONE, "FT1", "FRFTYPE", "FRFTYPENAME", "One"), ("f", 4, *NONE, "FT1", "FRFTYPE", "FRFTYPENAME", "Two")]
    for k in (1, 2):
        rows += [("f", 10 * k, *NONE, f"L{k}", "LINK", "MEMBER_B", f"R{k}"), ("f", 10 * k + 1, *NONE, f"L{k}", "LINK", "RELATION_TYPE", "C2R"),
                 ("f", 10 * k + 2, *NONE, f"L{k}", "LINK", "MEMBER_A", "C1")]
    return spark.createDataFrame([*rows, ("f", 99, *NONE, "C1", "CONTROL", "C_NAME", "Ctrl")], EAV_SCHEMA)


def test_dictionary_rows_carry_no_record_columns(spark):
    idx = build_index(_small(spark), RISK_TEMPLATE)
    staged = [spark.read.parquet(p).columns for p in idx.stage.paths]
    assert len(staged) == 2 and sorted(staged[1]) == ["hits", "key", "kind", "src", "v0", "v1", "v2"]
    assert [tuple(r) for r in idx.codes.select("form", "ind", "ind_hit", "fsa_hit").collect()] == [("FT1", "One", True, False)]


def test_a_walk_through_large_dictionaries_reads_each_step_once(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    idx = build_index(_small(spark), RISK_TEMPLATE)
    walk = links.link_walk(idx.records, idx, [("C2R", "C_NAME")])
    assert sum("/walk-" in p for p in idx.stage.paths) == 2
    assert sorted(tuple(r) for r in walk.select("form", "target", "n__C_NAME").collect()) == [("R1", "C1", "Ctrl"), ("R2", "C1", "Ctrl")]


def test_without_hot_keys_the_left_side_is_joined_once(spark):
    left = spark.range(3000).select("id", (F.col("id") * 2).alias("v"))
    out = skew.lookup(left, spark.range(0, 3000, 3), ["id"], "left", skew.BROADCAST_BYTES + 1)
    assert "LeftAnti" not in out._jdf.queryExecution().optimizedPlan().toString() and out.count() == 3000


def test_the_time_of_day_is_cut_off_once(spark):
    df = spark.createDataFrame([("8/17/69 10:11",), ("17.08.70",), ("13/13/2020",), ("Aug 7, 2020",), ("7-sept-2020 1:02 PM",), ("20200231",)], "t string")
    out = df.select(V.date_norm("t").alias("day"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("UTC|GMT") == 1
    assert [r[0] for r in out.collect()] == ["2069-08-17", "1970-08-17", None, "2020-08-07", "2020-09-07", None]


def test_sidecars_are_written_by_many_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "SIDECARS_A_TASK", 2)
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    spark.range(200).select(F.col("id").alias("page_id")).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.q_property_scan(spark, str(tmp_path)).count()
    parts = [n for _, _, names in os.walk(f"{tmp_path}/sidecars") for n in names if n.startswith("part-")]
    assert got == FX.property_rows(spark, str(tmp_path)).count() > 40
    assert len({n.split("-")[1] for n in parts}) >= 10


def test_staged_tables_are_shuffled_finely(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        made = Stage(spark).table(spark.range(200_000).groupBy(F.sha2(F.col("id").cast("string"), 256).alias("k")).agg(F.max("id").alias("n")), "fine")
    finally:
        spark.conf.set(name, before)
    files = made.inputFiles()
    assert made.count() == 200_000 and len(files) > 1
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_a_view_is_made_once_for_its_write(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        made.add(1)
        return x

    view = spark.range(20).select(F.lit("s3://b/t/cv/x.csv").alias("src"), F.col("id").alias("first_ord"), seen(F.col("id").cast("string")).alias("a"))
    writer.write_view(view, str(tmp_path), ["a"])
    assert made.value == 20
    assert writer.read_view(spark, str(tmp_path), ["a"]).count() == 20


def test_rows_are_routed_without_a_lambda_and_sorted_by_key(spark):
    plans = {}

    class Seen(Stage):
        def table(self, df, name, partition_by=()):
            plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
            return super().table(df, name, partition_by)

    rec = spark.createDataFrame([("f", 1, *NONE, "L1", "LINK", "MEMBER_B", "R1"), ("f", 2, *NONE, "R1", "RISK", "R_NOTE", "x")], EAV_SCHEMA)
    idx = build_index(rec, RISK_TEMPLATE, Seen(spark))
    plan = plans[f"index-{RISK_TEMPLATE.name}"]
    assert "lambda" not in plan and "Aggregate [_key" in plan
    assert [tuple(r) for r in idx.members.collect()] == [("f", "R1", "L1")]


def test_what_a_file_is_put_together_from_goes_as_it_is_placed(spark, monkeypatch, tmp_path):
    wide = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "e").otherwise("f").alias("src"), F.col("id").alias("ord"),
        *[F.lit(None).cast("string").alias(c) for c in RECORD_COLS if c != "data"], F.concat(F.lit("é,"), F.col("id").cast("string")).alias("data"))
    left, whole = [], FX._put_together

    def put_together(s, path, header, parts):
        whole(s, path, header, parts)
        left.append([os.path.getsize(p.removeprefix("file:")) for p, _ in parts])
    monkeypatch.setattr(FX, "_put_together", put_together)
    before = _scratch(spark)
    FX.write_objects(wide, {"e": f"{tmp_path}/e.csv", "f": f"{tmp_path}/f.csv"})
    assert len(left) == 2 and all(left) and not any(map(any, left)) and _scratch(spark) == before
    for k, name in enumerate("ef"):
        assert [r["data"] for r in RD.read_records(spark, f"{tmp_path}/{name}.csv").orderBy("ord").collect()] == [f"é,{i}" for i in range(k, 400, 2)]


def _scratch(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return sorted(os.listdir(root)) if os.path.isdir(root) else []


def _shuffled(spark):
    """The shuffle files that are on disk."""
    at = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for d in at for base, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = _shuffled(spark)
    with Stage(spark) as stage:
        out = stage.table(spark.range(20000).groupBy((F.col("id") % 5000).alias("k")).agg(F.max("id").alias("m")), "maxima")
        until = time.time() + 20
        while _shuffled(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not _shuffled(spark) - before
        assert out.count() == 5000 and all(f.endswith(".zstd.parquet") for f in out.inputFiles())
        stage.drop(out)
        assert not os.path.exists(out.stage_path.removeprefix("file:"))


def test_marks_of_links_carry_no_values(spark):
    with Stage(spark) as stage:
        idx = build_index(_small(spark), RISK_TEMPLATE, stage)
        agg = spark.read.parquet(next(p for p in stage.paths if "/index-" in p))
        assert agg.where("kind = 'K' AND (v1 IS NOT NULL OR v2 IS NOT NULL)").isEmpty() and agg.where("kind = 'K' AND v0 = 'C1'").count() == 2
        assert {(r["form"], r["target"], r["r__C2R"], r["r__R2I"]) for r in idx.links.collect()} == {("L1", "C1", True, False), ("L2", "C1", True, False)}
