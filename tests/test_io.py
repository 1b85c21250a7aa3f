"""CSV scan/sink edge cases, notifications, gate, stream = batch."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eavflow import session
from eavflow.functions import paths as P
from eavflow.operators import select as SEL
from eavflow.plans import catalog, pipeline, run, writer
from eavflow.plans.spec import RISK_TEMPLATE
from eavflow.sources import listing, notifications
from eavflow.sources.records import read_records
from eavflow.sources.tables import Ledger, Queue, read_ledger
from eavflow.streaming import convert as SC
from eavflow.streaming import intake
from tests.conftest import eav

HDR = "filename,yearend,entityid,entityname,bundleguid,lastmodified,cwguid,form,id,data,group_,extra"


def _write(d, name, text):
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_headers_malformed_and_quotes(spark):
    d = tempfile.mkdtemp(prefix="eav-csv-")
    a = _write(d, "a.csv", HDR + "\n"
               "a.csv,2020,1,E,b,t,c,R1,R_IDENTIFIER,R1,RISK,z\n"
               "a.csv,2020,1,E,b,t,c,R1,R_NAME,\"x\"\"y\",RISK,z\n"
               "a.csv,2020,1,E\n"                                   # short row: dropped
               "a.csv,2020,1,E,b,t,c,R1,R_BC,v,RISK,z,too,long\n"    # long row: dropped
               "a.csv,2020,1,E,b,t,c,R1,R_RFD,\"\",RISK,z\n")
    # second file: other column order (a second header)
    b = _write(d, "b.csv", "group_,id,data,form,filename,yearend,entityid,entityname,bundleguid,lastmodified,cwguid\n"
               "RISK,R_IDENTIFIER,R9,R9,b.csv,2021,2,F,b,t,c\n")
    rec = read_records(spark, [a, b])
    rows = {(os.path.basename(r.src), r.id): r for r in rec.collect()}
    assert len(rows) == 4
    assert rows[("a.csv", "R_NAME")].data == 'x"y'
    assert rows[("a.csv", "R_RFD")].data is None
    assert rows[("b.csv", "R_IDENTIFIER")].form == "R9" and rows[("b.csv", "R_IDENTIFIER")].yearend == "2021"
    # ord follows file order
    ords = [r.ord for r in sorted((r for r in rows.values() if r.src.endswith("a.csv")), key=lambda r: r.ord)]
    assert [rows[k].id for k in rows if k[0] == "a.csv"] and ords == sorted(ords)
    view = pipeline.wide_view(rec, RISK_TEMPLATE).collect()
    assert {r.rid for r in view} == {"R1", "R9"}


def test_csv_write_read_roundtrip(spark):
    rec = eav(spark, [("R1", "RISK", "R_IDENTIFIER", "R1"), ("R1", "RISK", "R_NAME", 'say "hi", ok'),
                      ("R1", "RISK", "R_RFD", "")], "s3://b/t-1/cv/f.csv")
    view = pipeline.convert(rec, RISK_TEMPLATE).view
    out = tempfile.mkdtemp(prefix="eav-out-")
    writer.write_view(view, out, RISK_TEMPLATE.columns)
    back = writer.read_view(spark, out, RISK_TEMPLATE.columns).collect()
    assert len(back) == 1 and back[0]["desc"] == 'say "hi", ok' and back[0].r_forward is None
    assert (back[0].bucket, back[0].tenant, back[0].file) == ("b", "t-1", "f.csv")
    # rerun replaces only that file's folder
    writer.write_view(view, out, RISK_TEMPLATE.columns)
    assert writer.read_view(spark, out, RISK_TEMPLATE.columns).count() == 1


def test_notification_two_records(spark):
    body = ('{"Records":[{"s3":{"bucket":{"name":"bk"},"object":{"key":"t/cv/a+b%26c.csv"}}},'
            '{"s3":{"bucket":{"name":"bk"},"object":{"key":"t/metadata/a.csv"}}}]}')
    df = spark.createDataFrame([(body,)], "body string")
    got = notifications.record_uploads(df).collect()
    assert [(r.bucket, r.url) for r in got] == [("bk", "s3://bk/t/cv/a b&c.csv")]


def test_gate(spark):
    files = spark.createDataFrame([("m",), ("n",), ("y",)], "src string")
    props = spark.createDataFrame([("n", "Title"), ("y", "CWAuditSource"), ("y", "x")], "src string, propertyname string")
    got = SEL.gate_semi(files, props, RISK_TEMPLATE.gate_properties).collect()
    assert [r.src for r in got] == ["y"]                       # missing / without / with gate name


def test_ledger_upsert_newest_wins(spark):
    s = "src string, bucket string, ts long, status string, detail string"
    old = spark.createDataFrame([("a", "b", 1, "converted", "x"), ("c", "b", 1, "rejected", "y")], s)
    new = spark.createDataFrame([("a", "b", 2, "converted", "z")], s)
    got = {r.src: r for r in SEL.ledger_upsert(old, new).collect()}
    assert got["a"].detail == "z" and got["c"].status == "rejected"


def test_intake_stream_dedupes_and_reruns(spark):
    d = tempfile.mkdtemp(prefix="eav-notes-")
    q = tempfile.mkdtemp(prefix="eav-queue-") + "/q"
    ck = tempfile.mkdtemp(prefix="eav-ck-")
    note = lambda k: '{"Records":[{"s3":{"bucket":{"name":"bk"},"object":{"key":"%s"}}}]}' % k
    _write(d, "1.json", note("t/cv/1.csv") + "\n" + note("t/cv/1.csv") + "\n")
    intake.run_intake(spark, d, q, ck)
    _write(d, "2.json", note("t/cv/1.csv") + "\n" + note("t/cv/2.csv") + "\n" + note("t/x/3.csv") + "\n")
    intake.run_intake(spark, d, q, ck)
    intake.run_intake(spark, d, q, ck)
    assert sorted(r.src for r in Queue(spark, q).read().collect()) == ["s3://bk/t/cv/1.csv", "s3://bk/t/cv/2.csv"]


def test_outputs_of_two_buckets_do_not_meet(spark):
    """Same tenant and file in two buckets; a file that has no record any more has an empty output."""
    rows = [("R1", "RISK", "R_IDENTIFIER", "R1")]
    urls = ["s3://b1/t/cv/x.csv", "s3://b2/t/cv/x.csv", "s3://b2/t/cv/a=b %.csv"]
    rec = eav(spark, rows, urls[0]).unionByName(eav(spark, rows, urls[1])).unionByName(eav(spark, rows, urls[2]))
    view = pipeline.convert(rec, RISK_TEMPLATE).view
    out = tempfile.mkdtemp(prefix="eav-out-")
    writer.write_view(view.where(F.col("src") == urls[0]), out, RISK_TEMPLATE.columns)
    writer.write_view(view.where(F.col("src") != urls[0]), out, RISK_TEMPLATE.columns)
    back = lambda: sorted((r.bucket, r.file) for r in writer.read_view(spark, out, RISK_TEMPLATE.columns).collect())
    assert back() == [("b1", "x.csv"), ("b2", "a=b %.csv"), ("b2", "x.csv")]
    at = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(P.output_location("u", out)).collect()]
    assert all(os.path.isdir(a) for a in at)
    writer.write_empty(spark, at[1:], RISK_TEMPLATE.columns)
    assert back() == [("b1", "x.csv")] and all(os.listdir(a) for a in at)


def test_paths_are_decoded_and_escaped(spark):
    d = tempfile.mkdtemp(prefix="eav-names-")
    names = ["report 1&v1.csv", "a%20b.csv", "x[1].csv", "p+q.csv", "{z}*?.csv", "ü.csv"]
    for n in names:
        _write(d, n, HDR + "\n" + "f,2020,1,E,b,t,c,R1,R_IDENTIFIER,R1,RISK,z\n")
    rec = read_records(spark, [f"{d}/{n}" for n in names])
    assert sorted(os.path.basename(r.src) for r in rec.collect()) == sorted(names)
    listed = {r.path for r in listing.list_objects(spark, d, suffix=".csv").collect()}
    assert listed == {r.src for r in rec.select("src").collect()}


def test_scan_jobs_and_driver_rows_do_not_grow_with_files(spark):
    """One plan for many headers; nothing but a number reaches the driver."""
    sc = spark.sparkContext

    def jobs(n):
        d = tempfile.mkdtemp(prefix="eav-many-")
        for i in range(n):
            cols = HDR.split(",")
            cols = cols[i % len(cols):] + cols[:i % len(cols)]
            _write(d, f"{i}.csv", ",".join(cols) + "\n" + ",".join(cols) + "\n")
        sc.setJobGroup(f"scan-{n}", "")
        got = read_records(spark, d)
        rows = got.collect()
        assert len(rows) == n and all(r.form == "form" and r.data == "data" for r in rows)
        return len(sc.statusTracker().getJobIdsForGroup(f"scan-{n}"))
    assert jobs(30) <= jobs(3) + 2      # a listing of many paths is a job of its own


def _bucket():
    root = tempfile.mkdtemp(prefix="eav-bucket-")
    line = "f,2020,1,E,b,t,c,{0},R_IDENTIFIER,{0},RISK,z\n"
    for path, text in {
            "b/t/cv/ok 1.csv": HDR + "\n" + line.format("R1") + line.format("R2"),
            "b/t/metadata/ok 1.csv": "propertyname\nCWAuditSource\n",
            "b/t/cv/none.csv": HDR + "\n", "b/t/metadata/none.csv": "x,propertyname\n1,CWAuditSource\n",
            "b/t/cv/no-sidecar.csv": HDR + "\n" + line.format("R3"),
            "b/t/cv/empty-sidecar.csv": HDR + "\n" + line.format("R4"), "b/t/metadata/empty-sidecar.csv": "",
            "b/t/cv/deep/d.csv": HDR + "\n", "b/t/cv/a.json": "{}", "b/t/cvrisk/old.csv": HDR + "\n" + line.format("R5"),
            "b2/t/cv/ok 1.csv": HDR + "\n" + line.format("R6"), "b2/t/metadata/ok 1.csv": "propertyname\nCWAuditSource\n"}.items():
        _write(os.path.join(root, os.path.dirname(path)), os.path.basename(path), text)
    return P.Store(root)


WANT = {"s3://b/t/cv/ok 1.csv": ("converted", 2), "s3://b/t/cv/none.csv": ("converted", 0),
        "s3://b/t/cv/no-sidecar.csv": ("rejected", None), "s3://b/t/cv/empty-sidecar.csv": ("rejected", None),
        "s3://b/t/cv/deep/d.csv": ("bad_path", None), "s3://b2/t/cv/ok 1.csv": ("converted", 1)}


def test_backfill_over_a_real_bucket(spark):
    store, out = _bucket(), tempfile.mkdtemp(prefix="eav-out-") + "/o"
    led = tempfile.mkdtemp(prefix="eav-led-") + "/l"
    before = set(os.listdir(session.checkpoint_root(spark).removeprefix("file:")))
    got = {r.src: r for r in run.backfill(spark, store, "", out, led, 7, max_files=4).collect()}
    assert {k: (r.status, r.n_records) for k, r in got.items()} == WANT
    assert all(os.path.isdir(r.detail) for r in got.values() if r.status == "converted")
    back = writer.read_view(spark, out, RISK_TEMPLATE.columns).collect()
    assert sorted((r.bucket, r.file, r.rid) for r in back) == [("b", "ok 1.csv", "R1"), ("b", "ok 1.csv", "R2"), ("b2", "ok 1.csv", "R6")]
    # a second run finds nothing; without its ledger it finds the outputs
    assert run.backfill(spark, store, "", out, led, 8).where("ts = 8").count() == 0
    again = {r.src: r.status for r in run.backfill(spark, store, "", out, led + "2", 9).collect()}
    assert {k for k, v in again.items() if v == "already_converted"} == {k for k, v in WANT.items() if v[0] == "converted"}
    # no staged table is left behind
    assert set(os.listdir(session.checkpoint_root(spark).removeprefix("file:"))) == before


def test_stream_sees_late_sidecars_and_replays_safely(spark):
    store, out = _bucket(), tempfile.mkdtemp(prefix="eav-out-") + "/o"
    led, ck = tempfile.mkdtemp(prefix="eav-led-") + "/l", tempfile.mkdtemp(prefix="eav-ck-")
    times = iter(range(100, 200))
    go = lambda c: SC.run_conversion_stream(spark, store, "", out, led, c, clock=lambda: next(times))
    go(ck)
    line = "f,2020,1,E,b,t,c,R9,R_IDENTIFIER,R9,RISK,z\n"
    _write(f"{store.root.removeprefix('file://')}b/t/metadata", "late.csv", "propertyname\nCWAuditSource\n")
    _write(f"{store.root.removeprefix('file://')}b/t/cv", "late.csv", HDR + "\n" + line)
    go(ck)
    version = Ledger(spark, led).table.manifest()["version"]
    go(tempfile.mkdtemp(prefix="eav-ck-"))      # every batch again
    got = {r.src: (r.status, r.n_records) for r in read_ledger(spark, led).collect()}
    assert got == WANT | {"s3://b/t/cv/late.csv": ("converted", 1)}
    assert Ledger(spark, led).table.manifest()["version"] == version        # nothing was written again
    assert writer.read_view(spark, out, RISK_TEMPLATE.columns).count() == 4


def test_diagnostics_are_written_beside_the_outputs(spark):
    store, out = _bucket(), tempfile.mkdtemp(prefix="eav-out-") + "/o"
    _write(f"{store.root.removeprefix('file://')}b/t/cv", "ok 1.csv", HDR + "\n" +
           "f,2020,1,E,b,t,c,R1,ISMODDATE,no date,RISK,z\n" + "f,2020,1,E,b,t,c,R1,R_FSA,GRP9,RISK,z\n")
    run.backfill(spark, store, "b", out, out + "-ledger", 7)
    got = spark.read.parquet(f"{out}/{run.DIAGNOSTICS}").collect()
    assert sorted((r.src, r.form, r.token, r.reason) for r in got) == [
        ("s3://b/t/cv/ok 1.csv", "R1", "GRP9", "no lookup row"), ("s3://b/t/cv/ok 1.csv", "R1", "no date", "unreadable date")]


def test_json_uploads_are_not_queued(spark):
    body = '{"Records":[{"s3":{"bucket":{"name":"bk"},"object":{"key":"t/cv/a.json"}}}]}'
    assert notifications.record_uploads(spark.createDataFrame([(body,)], "body string")).count() == 0


def test_ledger_errors_are_raised(spark):
    d = tempfile.mkdtemp(prefix="eav-led-")
    assert read_ledger(spark, d + "/not-there").count() == 0
    _write(d + "/bad", "part-0.parquet", "this file does not exist as parquet")
    with pytest.raises(Exception):
        read_ledger(spark, d + "/bad").collect()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        def __init__(self, master, root=None):
            self.master, self.root = master, root

        def getCheckpointDir(self):
            return self.root

        def setCheckpointDir(self, d):
            self.root = d

        def getConf(self):
            return {}

    class Session:
        def __init__(self, *a):
            self.sparkContext = Context(*a)
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.checkpoint_root(Session(master))
    assert session.checkpoint_root(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert os.path.isdir(session.checkpoint_root(Session("local[8]")))


def test_catalog_names_and_locations_are_checked(spark):
    for bad in ("a b", "a;drop", "a.b.c", "1a", "a`"):
        with pytest.raises(ValueError):
            catalog.create_database(spark, bad)
    with pytest.raises(ValueError):
        catalog.register_csv_table(spark, "t", "/x\ny")
    where = tempfile.mkdtemp(prefix="eav-it's-")
    catalog.create_database(spark, "quoted_db", where)
    assert "it's" in spark.sql("DESCRIBE DATABASE quoted_db").where("info_name = 'Location'").first()[1]
    spark.sql("DROP DATABASE quoted_db")
    assert catalog.db_name("a-b-c") == "tenant_abc" and catalog.db_name("a-b", "p_") == "p_ab"
