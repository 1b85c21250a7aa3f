"""EAV record fixtures derived from the driver's tables.

The record format has no public sample data, so the test inputs are spelled
from ``orders``, ``lineitem``, ``nation``, ``region``, ``supplier``, ``part``
and ``customer`` (and ``events`` for a second shape).  Files are simulated by
``src = 'f' || o_orderkey % 4``; ``ord`` (decimal(38,0)) is the row's place inside its file.
Every row is produced by a narrow projection or one N:1 join with a dimension,
so building the fixture is a map-only job apart from that join.

Column layout (all strings except ``ord``)::

    src, ord, filename, yearend, entityid, entityname, bundleguid,
    lastmodified, cwguid, form, group_, id, data
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavflow.functions import paths as P
from eavflow.plans.spec import HEADER_COLS, RECORD_COLS
from eavflow.plans.stage import Stage
from eavflow.session import drop_path, file_system, setting, shuffles_freed

EAV_COLS = ["src", "ord"] + HEADER_COLS + ["form", "group_", "id", "data"]

# Fixed values of the fixture recipe (shared with the SQL oracle).
N_FILES = 4
SENTINEL_KNOWN = "111111111111"
SENTINEL_UNKNOWN = "222222222222"
LOOKUP_ORD_BASE = 2 * 10 ** 17    # lookup rows sit between records and links
LOOKUP_CLASS_STEP = 10 ** 12
ORD = "decimal(38,0)"
SPREAD_ROWS = 100_000       # source rows a task makes records of: about a million records
PART_ROWS = 1_000_000       # records a task sorts and writes as its part of a file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal the rows of a source table out evenly before rows are generated from them.

    The test tables are single-row-group files, read by one task each; real
    record sets are many files.  A task gets at most ``SPREAD_ROWS`` of the ``rows``
    (those of ``df`` if not said), so its share does not grow with the table.
    """
    rows = df.count() if rows is None else rows
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SPREAD_ROWS)))


def _s(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else _s(p) for p in parts])


def _date_text(ts: Column, key: Column) -> Column:
    y = _s(F.year(ts))
    m = F.lpad(_s(F.month(ts)), 2, "0")
    d = F.lpad(_s(F.dayofmonth(ts)), 2, "0")
    return (F.when(key % 3 == 0, F.concat(y, F.lit("-"), m, F.lit("-"), d))
             .when(key % 3 == 1, F.concat(m, F.lit("/"), d, F.lit("/"), y))
             .otherwise(F.concat(y, m, d)))


def _fsa_code(ok: Column, ck: Column) -> Column:
    m = ok % 10
    return (F.when(m == 0, F.lit(SENTINEL_KNOWN))
             .when(m == 1, F.lit(SENTINEL_UNKNOWN))
             .when(m == 2, F.lit(None).cast("string"))
             .otherwise(_cat("GRP", ck % 25, ",GRP", ok % 25, "|AO", ok % 5, ",AO", ck % 5)))


def record_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``RISK`` row per (order, attribute); some orders get extra rows."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name")
    o = spread(o.join(c, "o_custkey", "left"), o.count())
    ok, ck, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    null = F.lit(None).cast("string")
    attrs = [
        (0, "R_IDENTIFIER", _cat("R", ok), F.lit(True)),
        (1, "R_NEWNAME", F.col("o_orderpriority"), F.lit(True)),
        (2, "ISMODDATE", _date_text(F.col("o_orderdate"), ok), F.lit(True)),
        (3, "R_FSA", _fsa_code(ok, ck), F.lit(True)),
        (4, "R_FRF", _cat("FT", ok % 7), F.lit(True)),
        (5, "R_SIGNIFICANT", F.when(st == "F", "1").when(st == "O", "0").otherwise(null), F.lit(True)),
        (6, "R_MANRESPDD", _s(ck % 3), F.lit(True)),
        (7, "R_AUDRESPDD", F.when(ck % 4 == 0, "1").when(ck % 4 == 1, "Y")
                             .when(ck % 4 == 2, "").otherwise(null), F.lit(True)),
        (8, "R_ENTITY", F.col("c_name"), F.lit(True)),
        (9, "R_BC", st, F.lit(True)),
        (10, "R_NOTE", st, ok % 7 == 0),
        (11, "R_SIGNIFICANT", F.lit("1"), ok % 5 == 0),
    ]
    arr = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("id"),
                             d.cast("string").alias("data"), keep.alias("keep"))
                    for k, i, d, keep in attrs])
    src = _cat("f", ok % N_FILES)
    rows = (o.select("*", F.explode(arr).alias("a"))
             .where(F.col("a.keep"))
             .select(src.alias("src"), (ok * 16 + F.col("a.k")).alias("ord"),
                     F.col("a.k").alias("k"), F.col("a.id").alias("id"),
                     F.col("a.data").alias("data"), ok.alias("_ok"), ck.alias("_ck"),
                     F.col("o_orderdate"), F.col("c_name")))
    return rows.select(
        "src", F.col("ord").cast(ORD).alias("ord"),
        F.concat(F.col("src"), F.lit(".csv")).alias("filename"),
        _s(F.year("o_orderdate")).alias("yearend"),
        _s("_ck").alias("entityid"),
        F.col("c_name").alias("entityname"),
        _cat("bundle-", F.col("src")).alias("bundleguid"),
        _s("ord").alias("lastmodified"),
        _cat("cw", F.col("k")).alias("cwguid"),
        _cat("R", F.col("_ok")).alias("form"),
        F.lit("RISK").alias("group_"), "id", "data")


def link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three link attributes per line item: MEMBER_B, RELATION_TYPE, MEMBER_A."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    odd = ln % 2 == 1
    arr = F.array(
        F.struct(F.lit(0).alias("j"), F.lit("MEMBER_B").alias("id"), _cat("R", ok).alias("data")),
        F.struct(F.lit(1).alias("j"), F.lit("RELATION_TYPE").alias("id"),
                 F.when(odd, "C2R").otherwise("R2I").alias("data")),
        F.struct(F.lit(2).alias("j"), F.lit("MEMBER_A").alias("id"),
                 F.when(odd, _cat("C", sk)).otherwise(_cat("I", pk)).alias("data")),
    )
    src = _cat("f", ok % N_FILES)
    # decimal places of their own for each key: 12 + 1 + 11 + 10 + 1 digits, after every other row
    at = F.concat(_s(ok), _s(ln), F.lpad(_s(pk), 11, "0"), F.lpad(_s(sk), 10, "0"))
    return _with_headers(
        li.select(src.alias("src"), _cat("L", ok, "-", ln, "-", pk, "-", sk).alias("form"),
                  at.alias("_at"), F.explode(arr).alias("a"))
          .select("src", F.concat("_at", _s("a.j")).cast(ORD).alias("ord"), "form",
                  F.lit("LINK").alias("group_"), F.col("a.id").alias("id"),
                  F.col("a.data").alias("data")))


def _with_headers(df: DataFrame) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select(
        "src", "ord", F.concat(F.col("src"), F.lit(".csv")).alias("filename"),
        *[null.alias(c) for c in HEADER_COLS[1:]], "form", "group_", "id", "data")


def _per_file(df: DataFrame, cls: int, key: Column) -> DataFrame:
    """Repeat dictionary rows in every simulated file (explode, no join)."""
    files = F.array(*[F.lit(f"f{i}") for i in range(N_FILES)])
    return _with_headers(
        df.select(F.explode(files).alias("src"),
                  (F.lit(LOOKUP_ORD_BASE + cls * LOOKUP_CLASS_STEP) + key).cast(ORD).alias("ord"),
                  "form", "group_", "id", "data"))


def lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, label, category, indicator and target-name rows of every file."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    s = table(spark, sf_dir, "supplier")
    p = table(spark, sf_dir, "part")
    nk, rk = F.col("n_nationkey"), F.col("r_regionkey")
    parts = [
        _per_file(n.select(nk.alias("k"), _cat("GRP", nk).alias("form"), F.lit("FSA").alias("group_"),
                           F.lit("FSA_NAME").alias("id"), F.col("n_name").alias("data")),
                  1, F.col("k")),
        _per_file(r.select(rk.alias("k"), _cat("AOF", rk).alias("form"), F.lit("ASSERT").alias("group_"),
                           _cat("AO", rk).alias("id"),
                           F.when(rk == 4, F.lit("x|12-Custom|Other"))
                            .otherwise(_cat("x|y|", F.col("r_name"))).alias("data")),
                  2, F.col("k")),
        _per_file(r.where(rk == 0).select(rk.alias("k"), F.lit(SENTINEL_KNOWN).alias("form"),
                                          F.lit("PERVASIVECAT").alias("group_"),
                                          F.lit("PERVASIVECATNAME").alias("id"),
                                          F.lit("Pervasive").alias("data")),
                  3, F.col("k")),
        _per_file(n.where(nk < 5).select(nk.alias("k"), _cat("FT", nk).alias("form"),
                                         F.lit("FRFTYPE").alias("group_"), F.lit("FRFTYPENAME").alias("id"),
                                         _cat("Type ", nk).alias("data")),
                  4, F.col("k")),
        _per_file(s.select(F.col("s_suppkey").alias("k"), _cat("C", F.col("s_suppkey")).alias("form"),
                           F.lit("CONTROL").alias("group_"), F.lit("C_NAME").alias("id"),
                           F.col("s_name").alias("data")),
                  5, F.col("k")),
        _per_file(p.select(F.col("p_partkey").alias("k"), _cat("I", F.col("p_partkey")).alias("form"),
                           F.lit("RPTITEM").alias("group_"), F.lit("NAME").alias("id"),
                           F.concat(F.col("p_name"), F.lit(" "), _s("p_partkey")).alias("data")),
                  6, F.col("k")),
    ]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return out


def eav_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full EAV fixture: records, links and per-file dictionaries."""
    return (record_rows(spark, sf_dir)
            .unionByName(link_rows(spark, sf_dir))
            .unionByName(lookup_rows(spark, sf_dir))
            .select(*EAV_COLS))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second shape: append-only events as EAV rows, ord = event id * 4 + row of the event.

    form = user id, id = event type, data = value (2 decimals), group
    ``EVENT``; one simulated file per ``user_id % 4``.  A signup also writes
    the user's plan code, a view a three-way flag; plan names stand in every file.
    """
    e = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    uid, eid, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    src = _cat("e", uid % N_FILES)
    attr = F.filter(F.array(
        F.struct(F.lit(0).alias("j"), kind.alias("id"), F.col("value").cast("decimal(18,2)").cast("string").alias("data")),
        F.when(kind == "signup", F.struct(F.lit(1).alias("j"), F.lit("plan").alias("id"), _cat("P", uid % 7).alias("data"))),
        F.when(kind == "view", F.struct(F.lit(2).alias("j"), F.lit("active").alias("id"), _s(eid % 3).alias("data"))),
    ), lambda x: x.isNotNull())
    rows = e.select(
        src.alias("src"), eid.alias("_e"),
        F.concat(src, F.lit(".csv")).alias("filename"),
        _s(F.year("ts")).alias("yearend"), _s(uid).alias("entityid"),
        _cat("user-", uid).alias("entityname"), _cat("bundle-", src).alias("bundleguid"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("lastmodified"),
        _s(eid).alias("cwguid"), _cat("U", uid).alias("form"), F.lit("EVENT").alias("group_"),
        F.explode(attr).alias("a"))
    rows = rows.withColumns({"ord": (F.col("_e") * 4 + F.col("a.j")).cast(ORD), "id": F.col("a.id"), "data": F.col("a.data")})
    n = table(spark, sf_dir, "nation").where("n_nationkey < 5")
    files = F.array(*[F.lit(f"e{i}") for i in range(N_FILES)])
    names = _with_headers(n.select(
        F.explode(files).alias("src"), (F.lit(LOOKUP_ORD_BASE) + F.col("n_nationkey")).cast(ORD).alias("ord"),
        _cat("P", F.col("n_nationkey")).alias("form"), F.lit("FRFTYPE").alias("group_"),
        F.lit("FRFTYPENAME").alias("id"), _cat("Plan ", F.col("n_name")).alias("data")))
    return rows.select(*EAV_COLS).unionByName(names.select(*EAV_COLS))


# ---------------------------------------------------------------------------
# Object-path fixtures from ``pages``: one object per page.  Roles (folder,
# suffix, sidecar, ledger, queue ...) are assigned by residues of page_id so
# that every role has members at every scale; all pages always flow through.
# ---------------------------------------------------------------------------

GATE_ROLE_PROPS = {1: ["CWAuditSource"], 2: ["CWCustomProperty.CWAuditSource", "Title"],
                   3: ["Title"], 4: ["cwauditsource"], 5: ["CWAuditSource", "CWAuditSource"]}
LEDGER_TS = 1_700_000_000   # fixed clock for deterministic ledger rows


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, bucket, tenant, folder, key, url for every page."""
    pid = F.col("page_id")
    bucket = F.when(pid % 11 == 0, F.lit("cv-data")).otherwise(_cat("b", pid % 3))
    tenant = _cat("tenant-", pid % 5, "-x")
    folder = (F.when(pid % 4 < 2, F.lit("cv")).when(pid % 4 == 2, F.lit("metadata"))
               .otherwise(F.lit("cvrisk")))
    suffix = F.when(pid % 6 == 5, F.lit(".json")).otherwise(F.lit(".csv"))
    deep = F.when(pid % 13 == 0, F.lit("/extra")).otherwise(F.lit(""))
    key = F.concat(tenant, F.lit("/"), folder, deep, F.lit("/"), _s(pid), suffix)
    return (table(spark, sf_dir, "pages").select("page_id")
            .select("page_id", bucket.alias("bucket"), tenant.alias("tenant"),
                    folder.alias("folder"), key.alias("key"))
            .withColumn("url", F.concat(F.lit("s3://"), F.col("bucket"), F.lit("/"), F.col("key"))))


def record_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that the listing keeps: keyword ``/cv/`` and suffix ``.csv``."""
    o = objects(spark, sf_dir)
    return o.where(F.col("key").contains("/cv/") & F.col("key").endswith(".csv"))


def property_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sidecar rows (src = record url, propertyname) by role ``page_id % 7``."""
    o = record_objects(spark, sf_dir)
    role = F.col("page_id") % 7
    props = F.when(role == 1, F.array(F.lit("CWAuditSource")))
    for r, names in GATE_ROLE_PROPS.items():
        props = props if r == 1 else props.when(role == r, F.array(*[F.lit(n) for n in names]))
    return o.select(F.col("url").alias("src"), F.explode(props).alias("propertyname"))


OUT_ROOT = "s3://outputs"     # where the path fixtures say outputs lie


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files already processed: ``page_id % 9 < 2``."""
    o = record_objects(spark, sf_dir).where(F.col("page_id") % 9 < 2)
    return o.select(F.col("url").alias("src"), "bucket",
                    F.lit(LEDGER_TS).cast("bigint").alias("ts"),
                    F.lit("converted").alias("status"),
                    F.when(P.path_parts("url")["ok"], P.output_location("url", OUT_ROOT))
                     .otherwise(F.lit("unsupported path")).alias("detail"),
                    (F.col("page_id") % 50).cast("long").alias("n_records"))


def output_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs that already exist: ``page_id % 8 == 0``."""
    return record_objects(spark, sf_dir).where(F.col("page_id") % 8 == 0).select(F.col("url").alias("src"))


def queue_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue puts of every record object, twice when ``page_id % 10 == 0``."""
    o = record_objects(spark, sf_dir)
    reps = F.when(F.col("page_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return o.select(F.col("url").alias("src"), "bucket", F.explode(reps).alias("put_no"))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON upload notification per page (text column ``body``).

    Keys are percent/plus-encoded; every third page carries a second record
    for a ``/metadata/`` object and every fourth one for a ``.json`` object
    among the records, which intake must skip.
    """
    o = objects(spark, sf_dir).select("page_id", "bucket", "tenant")
    pid = F.col("page_id")
    enc_cv = F.concat(F.col("tenant"), F.lit("/cv/report+"), _s(pid), F.lit("%26v1.csv"))
    enc_md = F.concat(F.col("tenant"), F.lit("/metadata/report+"), _s(pid), F.lit(".csv"))
    enc_js = F.concat(F.col("tenant"), F.lit("/cv/report+"), _s(pid), F.lit(".json"))

    def rec(key):
        return F.concat(F.lit('{"s3":{"bucket":{"name":"'), F.col("bucket"),
                        F.lit('"},"object":{"key":"'), key, F.lit('"}}}'))
    body = F.concat(F.lit('{"Records":['), rec(enc_cv),
                    F.when(pid % 3 == 0, F.concat(F.lit(","), rec(enc_md))).otherwise(F.lit("")),
                    F.when(pid % 4 == 0, F.concat(F.lit(","), rec(enc_js))).otherwise(F.lit("")),
                    F.lit("]}"))
    return o.select("page_id", body.alias("body"))


def file_url(k: int) -> str:
    """The URL of fixture file ``f<k>``: four tenants in two buckets."""
    return f"s3://b{k % 2}/tenant-{k}/cv/f{k}.csv"


def with_urls(rec: DataFrame, urls: dict[str, str] | None = None) -> DataFrame:
    """The EAV fixture with record URLs for its simulated files."""
    urls = urls or {f"f{k}": file_url(k) for k in range(N_FILES)}
    src = F.col("src")
    for old, new in urls.items():
        src = F.when(F.col("src") == old, F.lit(new)).otherwise(src)
    return rec.withColumn("src", src)


def put(spark: SparkSession, path: str, text: str) -> None:
    """One small object."""
    fs, p = file_system(spark, path)
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()


def write_objects(rec: DataFrame, paths: dict[str, str], columns: list[str] = RECORD_COLS) -> None:
    """Write the simulated files in ``paths`` (src -> path) as CSV objects of exactly that name.

    Rows keep their ``ord`` order; ``columns`` is the header, unknown ones empty.
    Rows are made once, as the lines they become, and staged: they are counted, sampled
    and sorted from there.  A file is written as many parts, ranges of its rows, that are
    then put together; what it was made from goes before the next one is begun.
    """
    spark = rec.sparkSession
    cols = [F.col(c) if c in RECORD_COLS else F.lit("").alias(c) for c in columns]
    line = F.to_csv(F.struct(*cols), {"escape": '"', "emptyValue": "", "nullValue": ""})
    with Stage(spark) as stage:
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(paths))):     # not sorted by file first
            lines = stage.table(rec.where(F.col("src").isin(list(paths))).select(F.col("src").alias("_file"), "ord", line.alias("line")),
                                "object-lines", ["_file"])
        for src, path in paths.items():
            own, tmp = lines.where(F.col("_file") == src).select("ord", "line"), stage.path("objects")
            parts = max(spark.sparkContext.defaultParallelism, -(-own.count() // PART_ROWS))
            with shuffles_freed(spark):
                own.repartitionByRange(parts, "ord").sortWithinPartitions("ord").drop("ord").write.text(tmp)
            drop_path(spark, f"{lines.stage_path}/_file={src}")
            fs, folder = file_system(spark, tmp)
            found = sorted((f.getPath().getName(), f.getLen()) for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
            _put_together(spark, path, ",".join(columns) + "\n", [(f"{tmp}/{name}", size) for name, size in found if size])
            drop_path(spark, tmp)


def _put_together(spark: SparkSession, path: str, header: str, parts: list[tuple[str, int]]) -> None:
    """One object of a header and parts (path, bytes), in this order.

    In a folder of files each task writes parts to their own places in the
    object; other stores join the parts themselves, or have them streamed into the object.
    """
    put(spark, path, header)
    fs, target = file_system(spark, path)
    if fs.getUri().getScheme() != "file":
        jpath = spark._jvm.org.apache.hadoop.fs.Path
        those = spark.sparkContext._gateway.new_array(jpath, len(parts))
        for i, (part, _) in enumerate(parts):
            those[i] = jpath(part)
        try:
            fs.concat(target, those)
        except Exception as e:
            if "UnsupportedOperationException" not in f"{type(e).__name__} {e}":
                raise
            _stream(spark, path, header, parts)
        return
    plain = lambda x: file_system(spark, x)[1].toUri().getPath()
    out, at, places = plain(path), len(header.encode()), []
    for part, size in parts:
        places.append((plain(part), at))
        at += size

    def place(part):
        import os
        import shutil
        with open(part[0], "rb") as a, open(os.open(out, os.O_WRONLY), "wb") as b:
            b.seek(part[1])
            shutil.copyfileobj(a, b, 1 << 22)
        # the part's room is free from here on; a second try finds it empty and its bytes in their place
        os.truncate(part[0], 0)

    # the object's checksum file is that of its header
    folder, name = out.rsplit("/", 1)
    drop_path(spark, f"{folder}/.{name}.crc")
    if places:
        spark.sparkContext.parallelize(places, len(places)).foreach(place)


def _stream(spark: SparkSession, path: str, header: str, parts: list[tuple[str, int]]) -> None:
    """For stores that cannot join objects: one stream, a buffer at a time."""
    fs, target = file_system(spark, path)
    out = fs.create(target)
    out.write(bytearray(header.encode()))
    for part, _ in parts:
        source, p = file_system(spark, part)
        a = source.open(p)
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(a, out, 1 << 22, False)
        a.close()
        source.delete(p, False)
    out.close()
