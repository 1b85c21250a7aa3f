"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query derives its input from the driver's tables (through the EAV
fixture or the path fixtures) and runs the operator over all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavflow.functions import values as V
from eavflow.operators.file_index import Dictionary, build_index
from eavflow.operators.reshape import attr_col, pivot_last, record_filter
from eavflow.operators.skew import lookup
from eavflow.plans import pipeline
from eavflow.plans import spec as S
from eavflow.plans.transforms import KeyedLookup, Scalar
from eavflow.sources import fixtures as FX

RISK = S.RISK_TEMPLATE
# Fixed values of the fixture recipe: the attribute ids it writes.
FIXTURE_IDS = ["R_IDENTIFIER", "R_NEWNAME", "ISMODDATE", "R_FSA", "R_FRF", "R_SIGNIFICANT",
               "R_MANRESPDD", "R_AUDRESPDD", "R_ENTITY", "R_BC", "R_NOTE"]


def _rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.eav_records(spark, sf_dir)


def _ord():
    """The place in the file as the SQL has it."""
    return F.col("ord").cast("bigint").alias("ord")


def _risk_rows(spark, sf_dir):
    return _rec(spark, sf_dir).where(F.col("group_") == RISK.group)


# -- reshape ---------------------------------------------------------------

def q_record_filter(spark, sf_dir):
    return record_filter(_rec(spark, sf_dir), RISK.group, []).select("src", _ord(), "form", "id", "data")


def q_pivot_last(spark, sf_dir):
    rows = record_filter(_rec(spark, sf_dir), RISK.group, [])
    pv = pivot_last(rows, FIXTURE_IDS)
    return pv.select("src", "form", *[F.col(attr_col(i)).alias(i) for i in FIXTURE_IDS])


def q_last_attrs(spark, sf_dir):
    rows = record_filter(_rec(spark, sf_dir), RISK.group, RISK.header)
    return pivot_last(rows, [], RISK.header).select("src", "form", *RISK.header)


def q_ordered_view(spark, sf_dir):
    rows = record_filter(_rec(spark, sf_dir), RISK.group, [])
    return (pivot_last(rows, ["R_IDENTIFIER"])
            .select("src", "form", F.col("rk").cast("bigint").alias("first_ord"),
                    F.col(attr_col("R_IDENTIFIER")).alias("rid")))


# -- scalar values ---------------------------------------------------------

def q_yes_no(spark, sf_dir):
    r = _risk_rows(spark, sf_dir).where(F.col("id").isin("R_SIGNIFICANT", "R_AUDRESPDD"))
    return r.select("src", _ord(), "id", "data", V.yes_no("data").alias("yn"))


def q_yes_no_some(spark, sf_dir):
    r = _risk_rows(spark, sf_dir).where(F.col("id").isin("R_MANRESPDD", "R_SIGNIFICANT", "R_AUDRESPDD"))
    return r.select("src", _ord(), "id", "data", V.yes_no_some("data").alias("yns"))


def q_date_norm(spark, sf_dir):
    r = _risk_rows(spark, sf_dir).where(F.col("id").isin("ISMODDATE", "R_NEWNAME"))
    return r.select("src", _ord(), "data", V.date_norm("data").alias("day"))


def q_token_split(spark, sf_dir):
    r = _risk_rows(spark, sf_dir).where((F.col("id") == "R_FSA") & F.col("data").isNotNull())
    t = r.select("src", "ord", F.posexplode(V.token_split("data")).alias("pos", "tok"))
    return t.select("src", _ord(), F.col("pos").cast("bigint").alias("pos"), "tok",
                    F.col("tok").contains(RISK.lookups.name_marker).alias("is_name"),
                    F.col("tok").contains(RISK.lookups.label_marker).alias("is_label"))


def q_path_label(spark, sf_dir):
    r = _rec(spark, sf_dir).where(F.col("id").contains(RISK.lookups.label_marker))
    return r.select("src", _ord(), "id", "data", V.path_label("data").alias("label"))


# -- lookups ---------------------------------------------------------------

def _index(spark, sf_dir):
    return build_index(_rec(spark, sf_dir), RISK)


def q_category_lookup(spark, sf_dir):
    idx = _index(spark, sf_dir)
    raw = attr_col("R_FSA")
    recs = idx.records.where(F.col(raw).isin(list(RISK.lookups.sentinels)))
    cat = idx.codes.where(F.col("cat").isNotNull()).select("src", F.col("form").alias(raw), "cat")
    return lookup(recs, cat, ["src", raw], "left", idx.sizes["codes"]).select("src", "form", F.col(raw).alias("code"), "cat")


def _with_form(spark, sf_dir, out: str) -> DataFrame:
    tpl = S.Template(RISK.name, RISK.group, (), tuple(f for f in RISK.fields if f.out == out),
                     lookups=RISK.lookups)
    return pipeline.convert(_rec(spark, sf_dir), tpl).view.select("src", "form", out)


def q_token_names(spark, sf_dir):
    return _with_form(spark, sf_dir, "fsa")


def q_token_labels(spark, sf_dir):
    return _with_form(spark, sf_dir, "assert")


def q_lookup_or_self(spark, sf_dir):
    return _with_form(spark, sf_dir, "sri")


def q_link_control(spark, sf_dir):
    return _with_form(spark, sf_dir, "assocd_ctrl")


def q_link_item(spark, sf_dir):
    return _with_form(spark, sf_dir, "assocd_item")


# -- flagship --------------------------------------------------------------

def q_wide_view(spark, sf_dir):
    return pipeline.wide_view(_rec(spark, sf_dir), RISK)


QUERIES = {
    "wide_view": q_wide_view,
    "record_filter": q_record_filter,
    "pivot_last": q_pivot_last,
    "last_attrs": q_last_attrs,
    "ordered_view": q_ordered_view,
    "yes_no": q_yes_no,
    "yes_no_some": q_yes_no_some,
    "date_norm": q_date_norm,
    "token_split": q_token_split,
    "path_label": q_path_label,
    "category_lookup": q_category_lookup,
    "token_names": q_token_names,
    "token_labels": q_token_labels,
    "lookup_or_self": q_lookup_or_self,
    "link_control": q_link_control,
    "link_item": q_link_item,
}


# -- paths, notifications, work selection ----------------------------------

from eavflow.functions import paths as P  # noqa: E402
from eavflow.operators import select as SEL  # noqa: E402
from eavflow.plans import selection  # noqa: E402
from eavflow.sources import listing, notifications  # noqa: E402


def q_list_keys(spark, sf_dir):
    keys = listing.filter_keys(FX.objects(spark, sf_dir), "key", "", P.RECORD_SUFFIX, P.RECORD_KEYWORD)
    return keys.select("key", "url")


def q_path_parts(spark, sf_dir):
    p = P.path_parts("url")
    return FX.objects(spark, sf_dir).select(
        "url", p["bucket"].alias("bucket"), p["tenant"].alias("tenant"),
        p["folder"].alias("folder"), p["file"].alias("file"), p["ok"].alias("ok"))


def q_sibling_path(spark, sf_dir):
    return FX.record_objects(spark, sf_dir).select(
        "url", P.sibling_path("url", P.OUTPUT_FOLDER).alias("out_url"),
        P.sibling_path("url", P.METADATA_FOLDER).alias("meta_url"))


def q_tenant_db_name(spark, sf_dir):
    return (FX.objects(spark, sf_dir).select("tenant").distinct()
            .select("tenant", P.tenant_db_name("tenant").alias("db_name")))


def q_notif_decode(spark, sf_dir):
    return notifications.decode(FX.notifications(spark, sf_dir)).select("bucket", "key", "url")


def _listed(spark, sf_dir):
    return FX.record_objects(spark, sf_dir).select(F.col("url").alias("src"), "bucket")


def q_gate_semi(spark, sf_dir):
    return SEL.gate_semi(_listed(spark, sf_dir), FX.property_rows(spark, sf_dir),
                         RISK.gate_properties).select("src")


def q_pending_anti(spark, sf_dir):
    return SEL.pending_anti(_listed(spark, sf_dir), FX.ledger_rows(spark, sf_dir)).select("src")


def q_output_anti(spark, sf_dir):
    return SEL.output_status(_listed(spark, sf_dir), FX.output_rows(spark, sf_dir)).select("src", "status")


def q_queue_dedupe(spark, sf_dir):
    return SEL.queue_dedupe(FX.queue_puts(spark, sf_dir)).select("src", "bucket")


def q_queue_drain(spark, sf_dir):
    q = SEL.queue_dedupe(FX.queue_puts(spark, sf_dir))
    return SEL.queue_drain(q, FX.ledger_rows(spark, sf_dir)).select("src")


def q_has_pending(spark, sf_dir):
    return SEL.has_pending(SEL.queue_dedupe(FX.queue_puts(spark, sf_dir)))


def _outcomes(spark, sf_dir):
    return selection.outcomes(_listed(spark, sf_dir), FX.ledger_rows(spark, sf_dir),
                              FX.output_rows(spark, sf_dir), FX.property_rows(spark, sf_dir), RISK, FX.OUT_ROOT)


def q_convert_status(spark, sf_dir):
    return _outcomes(spark, sf_dir)


def q_ledger_upsert(spark, sf_dir):
    """K4 through the ledger that the runs use: earlier rows, this run's outcomes, and a later write of the same second."""
    ledger = TB.Ledger(spark, scratch_path(spark, "ledger"))
    ledger.put(FX.ledger_rows(spark, sf_dir))
    new = selection.ledger_entries(_outcomes(spark, sf_dir), FX.LEDGER_TS + 60).withColumn("n_records", F.lit(None).cast("long"))
    ledger.put(new)
    late = new.where("status = 'rejected' AND bucket = 'b1'").withColumns({"status": F.lit("converted"), "n_records": F.lit(7).cast("long")})
    ledger.put(late)
    return ledger.read()


QUERIES.update({
    "list_keys": q_list_keys,
    "path_parts": q_path_parts,
    "sibling_path": q_sibling_path,
    "tenant_db_name": q_tenant_db_name,
    "notif_decode": q_notif_decode,
    "gate_semi": q_gate_semi,
    "pending_anti": q_pending_anti,
    "output_anti": q_output_anti,
    "queue_dedupe": q_queue_dedupe,
    "queue_drain": q_queue_drain,
    "has_pending": q_has_pending,
    "convert_status": q_convert_status,
    "ledger_upsert": q_ledger_upsert,
})


# -- I/O: scans, sinks, catalog ------------------------------------------------

import uuid  # noqa: E402

from eavflow.plans import catalog, run, writer  # noqa: E402
from eavflow.plans.stage import Stage  # noqa: E402
from eavflow.session import scratch_path  # noqa: E402
from eavflow.sources import records as RD  # noqa: E402
from eavflow.sources import tables as TB  # noqa: E402
from eavflow.streaming import convert as SC  # noqa: E402
from eavflow.streaming import intake  # noqa: E402


def q_csv_scan(spark, sf_dir):
    """Four files with awkward names and three headers."""
    root = scratch_path(spark, "records")
    rec = _rec(spark, sf_dir)
    names = {"f0": "a b.csv", "f1": "x&y%2B+.csv", "f2": "z[1]{2}.csv", "f3": "plain.csv"}
    path = {k: f"{root}/{v}" for k, v in names.items()}
    FX.write_objects(rec, {k: path[k] for k in ("f0", "f1")})
    FX.write_objects(rec, {"f2": path["f2"]}, ["extra", *RD.RECORD_COLS])
    FX.write_objects(rec, {"f3": path["f3"]}, list(reversed(RD.RECORD_COLS)))
    df = RD.read_records(spark, list(path.values()))
    name = F.element_at(F.split("src", "/"), -1)
    file = F.lit(None).cast("string")
    for k, v in names.items():
        file = F.when(name == v, F.lit(k)).otherwise(file)
    return df.select(file.alias("file"), *S.HEADER_COLS, "form", "group_", "id", "data")


SIDECARS_A_TASK = 200       # small files that a task writes one after another


def q_property_scan(spark, sf_dir):
    root = scratch_path(spark, "sidecars")
    props = FX.property_rows(spark, sf_dir)
    pages = FX.record_objects(spark, sf_dir).select(F.col("url").alias("src"), F.col("page_id").alias("p_page"))
    # what costs is files, not bytes: the number of tasks is said, and each moves its own files to their place
    tasks = max(spark.sparkContext.defaultParallelism, -(-pages.count() // SIDECARS_A_TASK))
    (props.join(pages, "src").select("p_page", "propertyname")
          .repartition(tasks, "p_page").write.partitionBy("p_page")
          .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
          .option("header", "true").option("escape", '"').csv(root))
    df = RD.read_properties(spark, root)
    return df.select(F.regexp_extract("src", r"/p_page=(\d+)/", 1).cast("bigint").alias("p_page"), "propertyname")


def _written_view(spark, sf_dir):
    root = scratch_path(spark, "cvrisk")
    with Stage(spark) as stage:
        view = pipeline.convert(FX.with_urls(_rec(spark, sf_dir)), RISK, stage).view
        writer.write_view(view, root, RISK.columns)
    return root


def q_csv_roundtrip(spark, sf_dir):
    return writer.read_view(spark, _written_view(spark, sf_dir), RISK.columns)


def q_multi_bucket_write(spark, sf_dir):
    """The same tenant and file in two buckets, several tenants; one file has no record on the second run."""
    root = scratch_path(spark, "cvrisk")
    urls = {"f0": "s3://b0/t-1/cv/x.csv", "f1": "s3://b1/t-1/cv/x.csv", "f2": "s3://b1/t-2/cv/y=1.csv", "f3": "s3://b1/t-3/cv/z.csv"}
    ids = S.Template(RISK.name, RISK.group, RISK.header, tuple(f for f in RISK.fields if f.out == "rid"))
    view = pipeline.convert(FX.with_urls(_rec(spark, sf_dir), urls), ids).view
    writer.write_view(view, root, ids.columns)
    writer.write_view(view.where(F.col("src") != urls["f3"]), root, ids.columns)
    gone = spark.range(1).select(P.output_location(F.lit(urls["f3"]), root)).first()[0]
    writer.write_empty(spark, [gone], ids.columns)
    return writer.read_view(spark, root, ids.columns).select("bucket", "tenant", "file", "rid")


def _registered(spark, sf_dir) -> str:
    root, db = _written_view(spark, sf_dir), f"conv_{uuid.uuid4().hex[:10]}"
    catalog.create_database(spark, db, scratch_path(spark, db))
    catalog.register_csv_table(spark, f"{db}.cvrisk", root)
    return db


def q_typed_view(spark, sf_dir):
    db = _registered(spark, sf_dir)
    return catalog.create_typed_view(spark, f"{db}.cvrisk_typed", f"{db}.cvrisk", temporary=False)


def q_catalog_query(spark, sf_dir):
    db = _registered(spark, sf_dir)
    catalog.create_typed_view(spark, f"{db}.cvrisk_typed", f"{db}.cvrisk", temporary=False)
    return catalog.query(spark, f"""
        SELECT yearend, significant, count(*) AS n_risks, count(assocd_ctrl) AS n_with_ctrl,
               count(assocd_item) AS n_with_item
        FROM {db}.cvrisk_typed GROUP BY yearend, significant""")


def q_tenant_database(spark, sf_dir):
    """K3: one database per tenant of the listing, seen in the catalog."""
    prefix = f"k3_{uuid.uuid4().hex[:8]}_"
    tenants = [r[0] for r in FX.objects(spark, sf_dir).select("tenant").distinct().collect()]   # one DDL statement each
    for t in tenants:
        catalog.create_database(spark, catalog.db_name(t, prefix), scratch_path(spark, "db"))
    shown = catalog.query(spark, f"SHOW DATABASES LIKE '{prefix}*'").select(F.col("namespace").alias("made"))
    wanted = FX.objects(spark, sf_dir).groupBy("tenant").agg(F.count(F.lit(1)).alias("n_objects"))
    return (wanted.join(shown, P.tenant_db_name("tenant", prefix) == F.col("made"))
            .select("tenant", F.replace("made", F.lit(prefix), F.lit("tenant_")).alias("db_name"), "n_objects"))


def q_queue_pending(spark, sf_dir):
    queue = TB.Queue(spark, scratch_path(spark, "queue"))
    queue.put(FX.queue_puts(spark, sf_dir))
    return queue.read()


# -- templates and dictionary ---------------------------------------------------

def q_second_template(spark, sf_dir):
    return pipeline.wide_view(FX.event_records(spark, sf_dir), S.EVENT_TEMPLATE)


#: Value functions of a caller's own: a look at other rows of the file, a band, a lookup that keeps unknown values.
_PLAN = Dictionary("plan", "group_ = 'EVENT' AND id = 'plan'", "data",
                   (("first_user", "min_by(form, ord)"), ("uses", "count(1)")))
_ALIKE = Dictionary("alike", "group_ = 'EVENT' AND id = 'active' AND data <> '0'", "data", (("last_user", "max_by(form, ord)"),))
PLUGIN_TEMPLATE = S.Template(
    name="EventPlugins", group="EVENT", header=S.RISK_HEADER,
    fields=(
        S.FieldSpec("plan", "plan", "Plan code"),
        S.FieldSpec("plan_first", "plan", "First user of the file with that plan", KeyedLookup(_PLAN, "first_user")),
        S.FieldSpec("plan_uses", "plan", "How often the file names that plan", KeyedLookup(_PLAN, "uses")),
        S.FieldSpec("view_band", "view", "Last view value, as a band", Scalar(
            lambda c: F.when(c.cast("decimal(18,2)") >= 50, "high").when(c.isNotNull(), "low"))),
        S.FieldSpec("active_alike", "active", "Last user of the file with that state, or the state",
                    KeyedLookup(_ALIKE, "last_user", or_self=True)),
    ))


def q_plugin_template(spark, sf_dir):
    return pipeline.wide_view(FX.event_records(spark, sf_dir), PLUGIN_TEMPLATE)


def q_field_dictionary(spark, sf_dir):
    view = pipeline.wide_view(_rec(spark, sf_dir), RISK)
    outs = [f.out for f in RISK.fields]
    counts = view.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in outs])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_values")) for c in outs])).alias("s")
    ).select("s.*")
    spec = spark.createDataFrame([(f.out, f.source_id, f.desc, f.kind) for f in RISK.fields],
                                 "column string, source_id string, description string, kind string")
    # ``spec`` has one row per template field (a fixed, tiny size): safe to broadcast.
    return stacked.join(F.broadcast(spec), "column").select(
        "column", "source_id", "description", "kind", "n_values")


# -- streaming -------------------------------------------------------------------

def q_stream_notifications(spark, sf_dir):
    src_dir, queue = scratch_path(spark, "notes"), scratch_path(spark, "queue")
    ckpt = scratch_path(spark, "intake-ckpt")
    notes = FX.notifications(spark, sf_dir)
    for drop in (0, 1):   # two arrivals, one checkpoint
        (notes.where(F.col("page_id") % 2 == drop).select(F.col("body").alias("value"))
              .write.mode("append").text(src_dir))
        intake.run_intake(spark, src_dir, queue, ckpt)
    # a rerun over the same files adds nothing
    intake.run_intake(spark, src_dir, queue, ckpt)
    return TB.Queue(spark, queue).read()


GATE_ROWS = "propertyname,value\nTitle,x\n"


def _sidecar(spark, store: P.Store, k: int, passes: bool) -> None:
    url = FX.file_url(k).replace("/cv/", "/metadata/")
    FX.put(spark, store.root + url[len(store.scheme):], GATE_ROWS + (f"{RISK.gate_properties[-1]},y\n" if passes else ""))


def _arrive(spark, store: P.Store, rec: DataFrame, files: list[int]) -> None:
    FX.write_objects(rec, {f"f{k}": store.root + FX.file_url(k)[len(store.scheme):] for k in files})


def _bucket(spark, rec: DataFrame) -> P.Store:
    """A store whose buckets also hold an old output, a deep path, a record that is no CSV and an empty sidecar."""
    store = P.Store(scratch_path(spark, "store"))
    for path in ("b0/tenant-0/cvrisk/old.csv", "b0/tenant-0/cv/deep/d.csv", "b0/tenant-0/cv/note.json", "b1/tenant-1/cv/e.csv"):
        FX.put(spark, store.at(path), ",".join(RD.RECORD_COLS) + "\n")
    FX.put(spark, store.at("b1/tenant-1/metadata/e.csv"), "")
    return store


def q_stream_convert(spark, sf_dir):
    """Two arrivals, a sidecar that comes after the stream began, and all batches replayed by a second stream."""
    rec, out, ledger = _rec(spark, sf_dir), scratch_path(spark, "cvrisk"), scratch_path(spark, "ledger")
    store, ckpt = _bucket(spark, rec), scratch_path(spark, "convert-ckpt")
    go = lambda c: SC.run_conversion_stream(spark, store, "", out, ledger, c, clock=lambda: FX.LEDGER_TS, max_files=5)
    _sidecar(spark, store, 0, True)
    _sidecar(spark, store, 1, True)
    _arrive(spark, store, rec, [0, 1])
    go(ckpt)
    _sidecar(spark, store, 2, True)
    _sidecar(spark, store, 3, False)
    _arrive(spark, store, rec, [2, 3])
    go(ckpt)
    go(scratch_path(spark, "convert-ckpt"))
    return _with_ledger(spark, store, out, ledger)


def _with_ledger(spark, store: P.Store, out: str, ledger: str) -> DataFrame:
    """The published view with status and n_records of each row's file."""
    led = TB.read_ledger(spark, ledger).select(F.col("src").alias("url"), "status", "n_records")
    view = writer.read_view(spark, out, RISK.columns)
    url = F.concat(F.lit(store.scheme), "bucket", F.lit("/"), "tenant", F.lit("/cv/"), "file")
    return view.join(led, url == F.col("url"), "left").drop("url")


def q_backfill(spark, sf_dir):
    """Three runs over a bucket; the second finds a new file, the third nothing.  One ledger row per file."""
    rec, out, ledger = _rec(spark, sf_dir), scratch_path(spark, "cvrisk"), scratch_path(spark, "ledger")
    store = _bucket(spark, rec)
    go = lambda ts: run.backfill(spark, store, "", out, ledger, ts, max_files=4)
    for k in range(3):
        _sidecar(spark, store, k, k != 1)
    _arrive(spark, store, rec, [0, 1, 2])
    go(FX.LEDGER_TS)
    _sidecar(spark, store, 3, True)
    _arrive(spark, store, rec, [3])
    go(FX.LEDGER_TS + 60)
    return go(FX.LEDGER_TS + 120).select(
        F.col("src").alias("url"), "bucket", "ts", "status", "n_records",
        F.when(F.col("detail").startswith(out), F.regexp_replace(F.substring("detail", len(out) + 1, 1 << 30), "^/batch=[^/]+", ""))
         .otherwise(F.col("detail")).alias("detail"))


class Crash(Exception):
    """Stands for a driver that died."""


def _crash_after(step: str):
    """An observer that ends the run after its first batch has done ``step``."""
    def observe(done: str) -> None:
        if done == step:
            raise Crash(step)
    return observe


def _crashed(start, step: str) -> None:
    try:
        start(_crash_after(step))
    except Crash:
        pass


CRASH_STEPS = ["outputs", "rows", "published", "ledger"]


def q_crash_replay(spark, sf_dir):
    """A backfill that dies after each of these steps and is started again each time, one file a batch."""
    rec, out, ledger = _rec(spark, sf_dir), scratch_path(spark, "cvrisk"), scratch_path(spark, "ledger")
    store = _bucket(spark, rec)
    for k in range(4):
        _sidecar(spark, store, k, k != 3)
    _arrive(spark, store, rec, [0, 1, 2, 3])
    go = lambda observe: run.backfill(spark, store, "", out, ledger, FX.LEDGER_TS, max_files=2, on_step=observe)
    for step in CRASH_STEPS:
        _crashed(go, step)
    go(lambda step: None)
    return _with_ledger(spark, store, out, ledger)


def _notify(spark, store: P.Store, folder: str, files: list[int]) -> None:
    """Upload notifications of record files and their sidecars, as the store would send them, the first one twice."""
    for k in [*files, files[0]]:
        bucket, key = FX.file_url(k)[len(store.scheme):].split("/", 1)
        records = ", ".join('{"s3": {"bucket": {"name": "%s"}, "object": {"key": "%s"}}}' % (bucket, x)
                            for x in (key, key.replace("/cv/", "/metadata/")))
        FX.put(spark, f"{folder}/{uuid.uuid4().hex}.json", '{"Records": [' + records + "]}\n")


def q_queue_convert(spark, sf_dir):
    """Notifications -> queue -> conversion -> empty queue, with a crash after a batch was published and a replayed intake."""
    rec, out, ledger = _rec(spark, sf_dir), scratch_path(spark, "cvrisk"), scratch_path(spark, "ledger")
    store, notes, path, ckpt = _bucket(spark, rec), scratch_path(spark, "notes"), scratch_path(spark, "queue"), scratch_path(spark, "ckpt")
    ids = iter(range(1 << 30))
    go = lambda observe: run.drain(spark, store, path, out, ledger, lambda: f"batch-{next(ids)}", lambda: FX.LEDGER_TS,
                                   max_files=2, lease=-1, on_step=observe)
    for k in range(4):
        _sidecar(spark, store, k, k != 3)
    _arrive(spark, store, rec, [0, 1, 2, 3])
    _notify(spark, store, notes, [0, 1, 3])
    intake.run_intake(spark, notes, path, ckpt)
    _crashed(go, "published")
    _notify(spark, store, notes, [2])
    intake.run_intake(spark, notes, path, ckpt)
    go(lambda step: None)
    left = TB.Queue(spark, path).read().agg(F.count(F.lit(1)).alias("n_waiting"))      # one row
    return _with_ledger(spark, store, out, ledger).join(F.broadcast(left))


def q_late_sidecar(spark, sf_dir):
    """Files that were rejected because their sidecars came later, or came without the gate property first."""
    rec, out, ledger = _rec(spark, sf_dir), scratch_path(spark, "cvrisk"), scratch_path(spark, "ledger")
    store, ckpt = _bucket(spark, rec), scratch_path(spark, "sidecar-ckpt")
    _sidecar(spark, store, 0, True)
    _arrive(spark, store, rec, [0, 1, 2, 3])
    run.backfill(spark, store, "", out, ledger, FX.LEDGER_TS)
    go = lambda: SC.run_sidecar_stream(spark, store, "", out, ledger, ckpt, clock=lambda: FX.LEDGER_TS)
    _sidecar(spark, store, 1, True)
    _sidecar(spark, store, 3, False)
    go()
    _sidecar(spark, store, 2, True)
    go()
    return _with_ledger(spark, store, out, ledger)


def q_tenant_tables(spark, sf_dir):
    """What each tenant's table holds in its own database after a backfill that registers its batches."""
    rec, out, ledger = _rec(spark, sf_dir), scratch_path(spark, "cvrisk"), scratch_path(spark, "ledger")
    store, prefix = _bucket(spark, rec), f"run_{uuid.uuid4().hex[:8]}_"
    for k in range(4):
        _sidecar(spark, store, k, k != 3)
    _arrive(spark, store, rec, [0, 1, 2, 3])
    run.backfill(spark, store, "", out, ledger, FX.LEDGER_TS, max_files=3, catalog_prefix=prefix)
    made = [r[0] for r in catalog.query(spark, f"SHOW DATABASES LIKE '{prefix}*'").collect()]        # one per tenant
    one = " UNION ALL ".join(f"SELECT '{db.removeprefix(prefix)}' AS db, bucket, tenant, file, rid, significant FROM {db}.cvrisk" for db in made)
    return catalog.query(spark, one)


def q_diagnostics(spark, sf_dir):
    return pipeline.convert(_rec(spark, sf_dir), S.DIAGNOSTIC_TEMPLATE).diagnostics


DATE_FORMS = ["yyyy-M-d", "yyyy/MM/dd", "yyyyMMdd", "yyyy-MM-dd'T10:11:12Z'", "yyyy-MM-dd'T10:11:12.123'",
              "yyyy-MM-dd' 10:11:12.0'", "yyyy-MM-dd' 10:11'", "yyyyMMdd'101112'", "M/d/yyyy", "dd-MMM-yyyy", "MMMM d, yyyy", "MMM d yyyy",
              "d MMM yyyy", "MM-dd-yyyy", "M/d/yyyy' 10:11:12 AM'", "d MMMM yyyy", "MMM d, yyyy", "yyyy-MM-dd'T10:11:12+02:00'"]


def q_date_forms(spark, sf_dir):
    """Every accepted form of every order's date; two-digit years and dotted day-first dates where they are unambiguous."""
    o = FX.spread(FX.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("d")))
    forms = [F.struct(F.lit(i).alias("form"), F.date_format("d", f).alias("text")) for i, f in enumerate(DATE_FORMS)]
    late = F.dayofmonth("d") > 12
    forms += [F.struct(F.lit(100).alias("form"), F.date_format("d", "M/d/yy").alias("text")),
              F.struct(F.lit(101).alias("form"), F.when(late, F.date_format("d", "dd.MM.yyyy")).alias("text")),
              F.struct(F.lit(102).alias("form"), F.when(late, F.date_format("d", "d/M/yyyy")).alias("text")),
              F.struct(F.lit(103).alias("form"), F.date_format("d", "MMMM yyyy").alias("text")),
              F.struct(F.lit(104).alias("form"), F.date_format("d", "yyyy-MM-dd' 25:61'").alias("text"))]
    rows = o.select("o_orderkey", F.explode(F.array(*forms)).alias("f")).select("o_orderkey", "f.form", "f.text")
    return rows.select("o_orderkey", "form", V.date_norm("text").alias("day"))


QUERIES.update({
    "csv_scan": q_csv_scan,
    "property_scan": q_property_scan,
    "csv_roundtrip": q_csv_roundtrip,
    "multi_bucket_write": q_multi_bucket_write,
    "tenant_database": q_tenant_database,
    "diagnostics": q_diagnostics,
    "date_forms": q_date_forms,
    "typed_view": q_typed_view,
    "catalog_query": q_catalog_query,
    "queue_pending": q_queue_pending,
    "second_template": q_second_template,
    "plugin_template": q_plugin_template,
    "field_dictionary": q_field_dictionary,
    "stream_notifications": q_stream_notifications,
    "stream_convert": q_stream_convert,
    "backfill": q_backfill,
    "crash_replay": q_crash_replay,
    "queue_convert": q_queue_convert,
    "late_sidecar": q_late_sidecar,
    "tenant_tables": q_tenant_tables,
})
