"""Independent SQL formulations of every registered query (DuckDB dialect).

The driver registers the parquet tables as views and runs these next to the
Spark queries.  Each statement is self-contained: it spells the same EAV
fixture as ``sources/fixtures.py`` from the raw tables and then states the
operator's semantics directly in SQL (``arg_max_null``/``arg_min_null`` keep a
null value, as Spark's ``max_by``/``min_by`` do).
"""

from __future__ import annotations

# The contract of the record files and of the table, spelled here
# a second time so that a slip in the engine's own mapping shows.
HEADER = ["yearend", "entityid", "entityname", "bundleguid", "filename", "lastmodified", "cwguid"]
FIELDS = [
    ("rid", "R_IDENTIFIER", "Identifier", "copy"),
    ("name", "R_NEWNAME", "Risk Name", "copy"),
    ("rentity", "R_ENTITY", "Entities", "copy"),
    ("dateId", "ISMODDATE", "Date Identified", "date"),
    ("desc", "R_NAME", "Risk Description", "copy"),
    ("whatwrong", "R_WHATGOWRONG", "What Can Go Wrong", "copy"),
    ("fsa", "R_FSA", "Financial Statement Areas", "code_names"),
    ("assert", "R_FSA", "Assertions", "code_labels"),
    ("bc", "R_BC", "Business Cycles", "copy"),
    ("sri", "R_FRF", "Significant Risk Indicators", "lookup_or_self"),
    ("significant", "R_SIGNIFICANT", "Significant Risk", "yes_no"),
    ("likelihood", "R_LLHOCCUR", "Likelihood to Occur", "copy"),
    ("m_impact", "R_DOLLARIMPACT", "Monetary Impact", "copy"),
    ("inherent", "R_INHERENT", "Inherent Risk", "copy"),
    ("ctrl_r", "R_MANRESP", "Control Risk", "copy"),
    ("p_rmm", "R_RMM", "Potential RMM", "copy"),
    ("residual", "R_RRISK", "Residual Risk", "copy"),
    ("rmm", "R_OVRISK", "RMM", "copy"),
    ("procedures", "R_REQSPEC", "Procedures Other Than Substantive", "copy"),
    ("m_response", "R_MRESPONSE", "Management Response", "copy"),
    ("treatment", "R_MANRESPDD", "Risk Treatment/Mitigation", "yes_no_some"),
    ("a_response", "R_ARESPONSE", "Audit Response", "copy"),
    ("source", "R_SOURCEREF", "Source/Reference", "copy"),
    ("addressed", "R_DESTREF", "Addressed", "copy"),
    ("assocd_ctrl", "MEMBER_A", "Associated Controls", "link_name"),
    ("assocd_item", "MEMBER_A", "Associated Reportable Items", "link_name"),
    ("aud_addressed", "R_AUDRESPDD", "Audit has properly addressed this risk", "yes_no"),
    ("r_forward", "R_RFD", "Roll forward", "yes_no"),
]
COLUMNS = HEADER + [f[0] for f in FIELDS]
SENT = ("'111111111111', '222222222222', '333333333333', '444444444444', '555555555555', "
        "'666666666666', '777777777777', '888888888888', '999999999999'")
GATE_IN = "'CWCustomProperty.CWAuditSource', 'CWAuditSource'"
INT_COLUMNS = ["yearend", "entityid"]

# -- fixture ---------------------------------------------------------------

_ORDERS = """
o AS (
  SELECT o.o_orderkey AS ok, o.o_custkey AS ck, o.o_orderstatus AS st,
         o.o_orderdate AS od, o.o_orderpriority AS pr, c.c_name AS cn,
         'f' || CAST(o.o_orderkey % 4 AS VARCHAR) AS src,
         CAST(year(o.o_orderdate) AS VARCHAR) AS yy,
         lpad(CAST(month(o.o_orderdate) AS VARCHAR), 2, '0') AS mm,
         lpad(CAST(day(o.o_orderdate) AS VARCHAR), 2, '0') AS dd
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
),
ra AS (
  SELECT src, ok, ck, od, cn, 0 AS k, 'R_IDENTIFIER' AS id, 'R' || CAST(ok AS VARCHAR) AS data FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 1, 'R_NEWNAME', pr FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 2, 'ISMODDATE',
    CASE ok % 3 WHEN 0 THEN yy || '-' || mm || '-' || dd
                WHEN 1 THEN mm || '/' || dd || '/' || yy
                ELSE yy || mm || dd END FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 3, 'R_FSA',
    CASE ok % 10 WHEN 0 THEN '111111111111' WHEN 1 THEN '222222222222' WHEN 2 THEN NULL
    ELSE 'GRP' || CAST(ck % 25 AS VARCHAR) || ',GRP' || CAST(ok % 25 AS VARCHAR)
         || '|AO' || CAST(ok % 5 AS VARCHAR) || ',AO' || CAST(ck % 5 AS VARCHAR) END FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 4, 'R_FRF', 'FT' || CAST(ok % 7 AS VARCHAR) FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 5, 'R_SIGNIFICANT',
    CASE st WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE NULL END FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 6, 'R_MANRESPDD', CAST(ck % 3 AS VARCHAR) FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 7, 'R_AUDRESPDD',
    CASE ck % 4 WHEN 0 THEN '1' WHEN 1 THEN 'Y' WHEN 2 THEN '' ELSE NULL END FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 8, 'R_ENTITY', cn FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 9, 'R_BC', st FROM o
  UNION ALL SELECT src, ok, ck, od, cn, 10, 'R_NOTE', st FROM o WHERE ok % 7 = 0
  UNION ALL SELECT src, ok, ck, od, cn, 11, 'R_SIGNIFICANT', '1' FROM o WHERE ok % 5 = 0
),
recrows AS (
  SELECT src, ok * 16 + k AS ord, src || '.csv' AS filename,
         CAST(year(od) AS VARCHAR) AS yearend, CAST(ck AS VARCHAR) AS entityid,
         cn AS entityname, 'bundle-' || src AS bundleguid,
         CAST(ok * 16 + k AS VARCHAR) AS lastmodified, 'cw' || CAST(k AS VARCHAR) AS cwguid,
         'R' || CAST(ok AS VARCHAR) AS form, 'RISK' AS group_, id, data
  FROM ra
)"""

_LINKS = """
li AS (
  SELECT 'f' || CAST(l_orderkey % 4 AS VARCHAR) AS src,
         ((CAST(l_orderkey * 10 + l_linenumber AS HUGEINT) * 100000000000 + l_partkey) * 10000000000 + l_suppkey) * 10 AS base,
         'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
             || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS form,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
),
linkrows AS (
  SELECT src, base AS ord, form, 'MEMBER_B' AS id, 'R' || CAST(l_orderkey AS VARCHAR) AS data FROM li
  UNION ALL SELECT src, base + 1, form, 'RELATION_TYPE',
    CASE WHEN l_linenumber % 2 = 1 THEN 'C2R' ELSE 'R2I' END FROM li
  UNION ALL SELECT src, base + 2, form, 'MEMBER_A',
    CASE WHEN l_linenumber % 2 = 1 THEN 'C' || CAST(l_suppkey AS VARCHAR)
         ELSE 'I' || CAST(l_partkey AS VARCHAR) END FROM li
)"""

_DICT = """
files AS (SELECT 'f' || CAST(i AS VARCHAR) AS src FROM range(4) t(i)),
dictrows AS (
  SELECT 200000000000000000 + 1000000000000 + n_nationkey AS ord, 'GRP' || CAST(n_nationkey AS VARCHAR) AS form,
         'FSA' AS group_, 'FSA_NAME' AS id, n_name AS data FROM nation
  UNION ALL SELECT 200000000000000000 + 2000000000000 + r_regionkey, 'AOF' || CAST(r_regionkey AS VARCHAR),
         'ASSERT', 'AO' || CAST(r_regionkey AS VARCHAR),
         CASE WHEN r_regionkey = 4 THEN 'x|12-Custom|Other' ELSE 'x|y|' || r_name END FROM region
  UNION ALL SELECT 200000000000000000 + 3000000000000 + r_regionkey, '111111111111', 'PERVASIVECAT',
         'PERVASIVECATNAME', 'Pervasive' FROM region WHERE r_regionkey = 0
  UNION ALL SELECT 200000000000000000 + 4000000000000 + n_nationkey, 'FT' || CAST(n_nationkey AS VARCHAR),
         'FRFTYPE', 'FRFTYPENAME', 'Type ' || CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey < 5
  UNION ALL SELECT 200000000000000000 + 5000000000000 + s_suppkey, 'C' || CAST(s_suppkey AS VARCHAR),
         'CONTROL', 'C_NAME', s_name FROM supplier
  UNION ALL SELECT 200000000000000000 + 6000000000000 + p_partkey, 'I' || CAST(p_partkey AS VARCHAR),
         'RPTITEM', 'NAME', p_name || ' ' || CAST(p_partkey AS VARCHAR) FROM part
)"""

_EAV = """
eav AS (
  SELECT src, ord, filename, yearend, entityid, entityname, bundleguid, lastmodified, cwguid,
         form, group_, id, data FROM recrows
  UNION ALL
  SELECT src, ord, src || '.csv', NULL, NULL, NULL, NULL, NULL, NULL, form, 'LINK', id, data FROM linkrows
  UNION ALL
  SELECT f.src, d.ord, f.src || '.csv', NULL, NULL, NULL, NULL, NULL, NULL, d.form, d.group_, d.id, d.data
  FROM dictrows d CROSS JOIN files f
)"""

FIXTURE_CTES = ",".join([_ORDERS, _LINKS, _DICT, _EAV])

FIXTURE_IDS = ["R_IDENTIFIER", "R_NEWNAME", "ISMODDATE", "R_FSA", "R_FRF", "R_SIGNIFICANT",
               "R_MANRESPDD", "R_AUDRESPDD", "R_ENTITY", "R_BC", "R_NOTE"]


def with_fixture(*ctes: str, body: str) -> str:
    extra = "".join("," + c for c in ctes)
    return f"WITH {FIXTURE_CTES}{extra}\n{body}"


def q(name: str) -> str:
    return '"' + name + '"'


# -- record-level CTEs ----------------------------------------------------

def _pv(ids) -> str:
    items = ["min(ord) AS first_ord"]
    items += [f"arg_max_null({h}, ord) AS {h}" for h in HEADER]
    items += [f"arg_max_null(data, ord) FILTER (WHERE id = '{i}') AS {q('a__' + i)}" for i in ids]
    sel = ",\n    ".join(items)
    return f"""
pv AS (
  SELECT src, form,
    {sel}
  FROM eav WHERE group_ = 'RISK' AND id IS NOT NULL
  GROUP BY src, form
)"""


RISK_IDS = list(dict.fromkeys(f[1] for f in FIELDS if f[3] != "link_name"))

_DATE_FMTS = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y%m%d", "%Y%m%d%H%M%S",
              "%m/%d/%Y", "%d/%m/%Y", "%b %d, %Y", "%d %B %Y"]


def date_sql(x: str) -> str:
    tries = ", ".join(f"try_strptime({x}, '{f}')" for f in _DATE_FMTS)
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} "
            f"ELSE strftime(coalesce({tries}), '%Y-%m-%d') END")


def yes_no_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} WHEN {x} = '1' THEN 'Yes' ELSE 'No' END"


def yes_no_some_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} WHEN {x} = '1' THEN 'Yes' "
            f"WHEN {x} = '0' THEN 'No' ELSE 'Some' END")


def label_sql(x: str) -> str:
    p = f"string_split({x}, '|')"
    return f"CASE WHEN {p}[-1] = 'Other' THEN substr({p}[-2], 4) ELSE {p}[-1] END"


_FSA = f"""
catd AS (SELECT src, form, arg_min_null(data, ord) AS cat FROM eav
         WHERE group_ = 'PERVASIVECAT' AND id = 'PERVASIVECATNAME' GROUP BY src, form),
fsad AS (SELECT src, form, arg_min_null(data, ord) AS nm FROM eav
         WHERE group_ = 'FSA' AND id = 'FSA_NAME' GROUP BY src, form),
fsatok AS (
  SELECT src, first_ord, tok FROM (
    SELECT src, first_ord, unnest(string_split_regex({q('a__R_FSA')}, '[|,]')) AS tok
    FROM pv WHERE {q('a__R_FSA')} NOT IN ({SENT})) t
  WHERE contains(tok, 'GRP')
),
fsaitem AS (
  SELECT src, first_ord, item FROM (
    SELECT t.src, t.first_ord, unnest(string_split(d.nm, ',')) AS item
    FROM fsatok t JOIN fsad d ON d.src = t.src AND d.form = t.tok WHERE d.nm IS NOT NULL) u
  WHERE item <> ''
),
fsalist AS (SELECT src, first_ord, array_to_string(list_sort(list_distinct(list(item))), ',') AS items
            FROM fsaitem GROUP BY src, first_ord),
fsa AS (
  SELECT p.src, p.first_ord,
    CASE WHEN p.{q('a__R_FSA')} IN ({SENT}) THEN c.cat ELSE coalesce(l.items, '') END AS fsa
  FROM pv p
  LEFT JOIN catd c ON c.src = p.src AND c.form = p.{q('a__R_FSA')}
  LEFT JOIN fsalist l ON l.src = p.src AND l.first_ord = p.first_ord
)"""

_ASSERT = f"""
lbd AS (SELECT src, id, arg_min_null(data, ord) AS lb FROM eav WHERE contains(id, 'AO') GROUP BY src, id),
astok AS (
  SELECT src, first_ord, tok FROM (
    SELECT src, first_ord, unnest(string_split_regex({q('a__R_FSA')}, '[|,]')) AS tok
    FROM pv WHERE {q('a__R_FSA')} IS NOT NULL) t
  WHERE contains(tok, 'AO')
),
asitem AS (
  SELECT src, first_ord, item FROM (
    SELECT t.src, t.first_ord, unnest(string_split({label_sql('d.lb')}, ',')) AS item
    FROM astok t JOIN lbd d ON d.src = t.src AND d.id = t.tok) u
  WHERE item <> '' AND item IS NOT NULL
),
aslist AS (SELECT src, first_ord, array_to_string(list_sort(list_distinct(list(item))), ',') AS items
           FROM asitem GROUP BY src, first_ord),
asr AS (
  SELECT p.src, p.first_ord, coalesce(l.items, '') AS asrt
  FROM pv p LEFT JOIN aslist l ON l.src = p.src AND l.first_ord = p.first_ord
)"""

_SRI = f"""
indd AS (SELECT src, form, arg_min_null(data, ord) AS d FROM eav
         WHERE group_ = 'FRFTYPE' AND id = 'FRFTYPENAME' GROUP BY src, form),
sri AS (
  SELECT p.src, p.first_ord,
    CASE WHEN p.{q('a__R_FRF')} IS NULL OR p.{q('a__R_FRF')} = '' THEN p.{q('a__R_FRF')}
         WHEN i.form IS NOT NULL THEN i.d ELSE p.{q('a__R_FRF')} END AS sri
  FROM pv p LEFT JOIN indd i ON i.src = p.src AND i.form = p.{q('a__R_FRF')}
)"""

_LINK = """
mbd AS (SELECT src, data, arg_min_null(form, ord) AS lf FROM eav WHERE id = 'MEMBER_B' GROUP BY src, data),
rtd AS (SELECT DISTINCT src, form, data FROM eav WHERE id = 'RELATION_TYPE'),
mad AS (SELECT src, form, arg_min_null(data, ord) AS target FROM eav WHERE id = 'MEMBER_A' GROUP BY src, form),
nmd AS (SELECT src, form, id, arg_min_null(data, ord) AS nm FROM eav WHERE id IN ('C_NAME', 'NAME')
        GROUP BY src, form, id),
walk AS (
  SELECT p.src, p.first_ord, m.lf, a.target FROM pv p
  JOIN mbd m ON m.src = p.src AND m.data = p.form
  JOIN mad a ON a.src = p.src AND a.form = m.lf
  WHERE p.form <> ''
),
lnk AS (
  SELECT p.src, p.first_ord,
    (SELECT n.nm FROM walk w JOIN rtd r ON r.src = w.src AND r.form = w.lf AND r.data = 'C2R'
       JOIN nmd n ON n.src = w.src AND n.form = w.target AND n.id = 'C_NAME'
     WHERE w.src = p.src AND w.first_ord = p.first_ord) AS assocd_ctrl,
    (SELECT n.nm FROM walk w JOIN rtd r ON r.src = w.src AND r.form = w.lf AND r.data = 'R2I'
       JOIN nmd n ON n.src = w.src AND n.form = w.target AND n.id = 'NAME'
     WHERE w.src = p.src AND w.first_ord = p.first_ord) AS assocd_item
  FROM pv p
)"""


def _wide_select() -> str:
    cols = ["p.src AS src"] + [f"p.{h} AS {h}" for h in HEADER]
    scalar = {"copy": lambda x: x, "yes_no": yes_no_sql, "yes_no_some": yes_no_some_sql, "date": date_sql}
    joined = {"code_names": "fsa.fsa", "code_labels": "asr.asrt", "lookup_or_self": "sri.sri"}
    for out, source, _, kind in FIELDS:
        raw = f"p.{q('a__' + source)}"
        e = scalar[kind](raw) if kind in scalar else joined.get(kind, f"lnk.{out}")
        cols.append(f"{e} AS {q(out)}")
    return ",\n  ".join(cols)


def _wide_from() -> str:
    return """FROM pv p
  JOIN fsa ON fsa.src = p.src AND fsa.first_ord = p.first_ord
  JOIN asr ON asr.src = p.src AND asr.first_ord = p.first_ord
  JOIN sri ON sri.src = p.src AND sri.first_ord = p.first_ord
  JOIN lnk ON lnk.src = p.src AND lnk.first_ord = p.first_ord"""


def wide_view() -> str:
    return with_fixture(_pv(RISK_IDS), _FSA, _ASSERT, _SRI, _LINK,
                        body=f"SELECT\n  {_wide_select()}\n{_wide_from()}")


def record_filter() -> str:
    return with_fixture(body="SELECT src, ord, form, id, data FROM eav WHERE group_ = 'RISK' AND id IS NOT NULL")


def pivot_last() -> str:
    cols = ", ".join(f"{q('a__' + i)} AS {q(i)}" for i in FIXTURE_IDS)
    return with_fixture(_pv(FIXTURE_IDS), body=f"SELECT src, form, {cols} FROM pv")


def last_attrs() -> str:
    return with_fixture(_pv([]),
                        body=f"SELECT src, form, {', '.join(HEADER)} FROM pv")


def ordered_view() -> str:
    return with_fixture(_pv(["R_IDENTIFIER"]),
                        body=f"SELECT src, form, first_ord, {q('a__R_IDENTIFIER')} AS rid FROM pv")


def yes_no() -> str:
    return with_fixture(body=f"""SELECT src, ord, id, data, {yes_no_sql('data')} AS yn FROM eav
WHERE group_ = 'RISK' AND id IN ('R_SIGNIFICANT', 'R_AUDRESPDD')""")


def yes_no_some() -> str:
    return with_fixture(body=f"""SELECT src, ord, id, data, {yes_no_some_sql('data')} AS yns FROM eav
WHERE group_ = 'RISK' AND id IN ('R_MANRESPDD', 'R_SIGNIFICANT', 'R_AUDRESPDD')""")


def date_norm() -> str:
    return with_fixture(body=f"""SELECT src, ord, data, {date_sql('data')} AS day FROM eav
WHERE group_ = 'RISK' AND id IN ('ISMODDATE', 'R_NEWNAME')""")


def token_split() -> str:
    return with_fixture(body="""SELECT src, ord, pos, tok, contains(tok, 'GRP') AS is_name, contains(tok, 'AO') AS is_label
FROM (SELECT src, ord, unnest(string_split_regex(data, '[|,]')) AS tok,
             unnest(range(0, len(string_split_regex(data, '[|,]')))) AS pos
      FROM eav WHERE group_ = 'RISK' AND id = 'R_FSA' AND data IS NOT NULL) t""")


def path_label() -> str:
    return with_fixture(body=f"SELECT src, ord, id, data, {label_sql('data')} AS label FROM eav WHERE contains(id, 'AO')")


def category_lookup() -> str:
    return with_fixture(_pv(["R_FSA"]), _FSA, body=f"""SELECT p.src, p.form, p.{q('a__R_FSA')} AS code, c.cat AS cat
FROM pv p LEFT JOIN catd c ON c.src = p.src AND c.form = p.{q('a__R_FSA')}
WHERE p.{q('a__R_FSA')} IN ({SENT})""")


def token_names() -> str:
    return with_fixture(_pv(["R_FSA"]), _FSA, body="""SELECT p.src, p.form, fsa.fsa AS fsa
FROM pv p JOIN fsa ON fsa.src = p.src AND fsa.first_ord = p.first_ord""")


def token_labels() -> str:
    return with_fixture(_pv(["R_FSA"]), _ASSERT, body=f"""SELECT p.src, p.form, asr.asrt AS {q('assert')}
FROM pv p JOIN asr ON asr.src = p.src AND asr.first_ord = p.first_ord""")


def lookup_or_self() -> str:
    return with_fixture(_pv(["R_FRF"]), _SRI, body="""SELECT p.src, p.form, sri.sri AS sri
FROM pv p JOIN sri ON sri.src = p.src AND sri.first_ord = p.first_ord""")


def link_control() -> str:
    return with_fixture(_pv(["R_IDENTIFIER"]), _LINK, body="""SELECT p.src, p.form, lnk.assocd_ctrl AS assocd_ctrl
FROM pv p JOIN lnk ON lnk.src = p.src AND lnk.first_ord = p.first_ord""")


def link_item() -> str:
    return with_fixture(_pv(["R_IDENTIFIER"]), _LINK, body="""SELECT p.src, p.form, lnk.assocd_item AS assocd_item
FROM pv p JOIN lnk ON lnk.src = p.src AND lnk.first_ord = p.first_ord""")


ORACLES = {
    "wide_view": wide_view,
    "record_filter": record_filter,
    "pivot_last": pivot_last,
    "last_attrs": last_attrs,
    "ordered_view": ordered_view,
    "yes_no": yes_no,
    "yes_no_some": yes_no_some,
    "date_norm": date_norm,
    "token_split": token_split,
    "path_label": path_label,
    "category_lookup": category_lookup,
    "token_names": token_names,
    "token_labels": token_labels,
    "lookup_or_self": lookup_or_self,
    "link_control": link_control,
    "link_item": link_item,
}


def all_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}


# -- path fixtures -----------------------------------------------------------

_OBJ = """
obj0 AS (
  SELECT page_id,
    CASE WHEN page_id % 11 = 0 THEN 'cv-data' ELSE 'b' || CAST(page_id % 3 AS VARCHAR) END AS bucket,
    'tenant-' || CAST(page_id % 5 AS VARCHAR) || '-x' AS tenant,
    CASE WHEN page_id % 4 < 2 THEN 'cv' WHEN page_id % 4 = 2 THEN 'metadata' ELSE 'cvrisk' END AS folder,
    CASE WHEN page_id % 6 = 5 THEN '.json' ELSE '.csv' END AS sfx,
    CASE WHEN page_id % 13 = 0 THEN '/extra' ELSE '' END AS deep
  FROM pages
),
objs AS (
  SELECT page_id, bucket, tenant, folder, key, 's3://' || bucket || '/' || key AS url FROM (
    SELECT *, tenant || '/' || folder || deep || '/' || CAST(page_id AS VARCHAR) || sfx AS key FROM obj0) t
),
recobj AS (SELECT *, 's3://outputs/bucket=' || bucket || '/tenant=' || tenant || '/file=' || CAST(page_id AS VARCHAR) || '.csv' AS out_at
           FROM objs WHERE contains(key, '/cv/') AND key LIKE '%.csv'),
parts AS (
  SELECT url, page_id, bucket AS obucket, string_split(url, '/') AS p FROM recobj
),
props AS (
  SELECT url AS src, 'CWAuditSource' AS propertyname FROM recobj WHERE page_id % 7 = 1
  UNION ALL SELECT url, 'CWCustomProperty.CWAuditSource' FROM recobj WHERE page_id % 7 = 2
  UNION ALL SELECT url, 'Title' FROM recobj WHERE page_id % 7 = 2
  UNION ALL SELECT url, 'Title' FROM recobj WHERE page_id % 7 = 3
  UNION ALL SELECT url, 'cwauditsource' FROM recobj WHERE page_id % 7 = 4
  UNION ALL SELECT url, 'CWAuditSource' FROM recobj WHERE page_id % 7 = 5
  UNION ALL SELECT url, 'CWAuditSource' FROM recobj WHERE page_id % 7 = 5
),
ledger AS (
  SELECT url AS src, bucket, CAST(1700000000 AS BIGINT) AS ts, 'converted' AS status,
         CASE WHEN page_id % 13 = 0 THEN 'unsupported path' ELSE out_at END AS detail, CAST(page_id % 50 AS BIGINT) AS n_records
  FROM recobj WHERE page_id % 9 < 2
),
outputs AS (SELECT url AS src FROM recobj WHERE page_id % 8 = 0),
queue AS (SELECT DISTINCT url AS src, bucket FROM recobj)"""


def with_objects(body: str) -> str:
    return f"WITH {_OBJ}\n{body}"


def _parts_sql(u: str) -> tuple[str, ...]:
    p = f"string_split({u}, '/')"
    ok = f"coalesce(len({p}) = 6 AND {p}[2] = '', false)"
    return p, ok


def list_keys() -> str:
    return with_objects("SELECT key, url FROM objs WHERE key LIKE '%.csv' AND contains(key, '/cv/')")


def path_parts() -> str:
    p, ok = _parts_sql("url")
    return with_objects(f"""SELECT url, {p}[3] AS bucket, {p}[4] AS tenant, {p}[5] AS folder, {p}[6] AS file,
  {ok} AS ok FROM objs""")


def _sibling(u: str, folder: str) -> str:
    p, ok = _parts_sql(u)
    return (f"CASE WHEN {ok} THEN regexp_extract({u}, '^([^/]*//)', 1) || {p}[3] || '/' || {p}[4] "
            f"|| '/{folder}/' || {p}[6] END")


def sibling_path() -> str:
    return with_objects(f"SELECT url, {_sibling('url', 'cvrisk')} AS out_url, "
                        f"{_sibling('url', 'metadata')} AS meta_url FROM recobj")


def tenant_db_name() -> str:
    return with_objects("SELECT DISTINCT tenant, 'tenant_' || replace(tenant, '-', '') AS db_name FROM objs")


def notif_decode() -> str:
    return with_objects("""SELECT bucket, tenant || '/cv/report ' || CAST(page_id AS VARCHAR) || '&v1.csv' AS key,
  's3://' || bucket || '/' || tenant || '/cv/report ' || CAST(page_id AS VARCHAR) || '&v1.csv' AS url FROM objs
UNION ALL
SELECT bucket, tenant || '/metadata/report ' || CAST(page_id AS VARCHAR) || '.csv',
  's3://' || bucket || '/' || tenant || '/metadata/report ' || CAST(page_id AS VARCHAR) || '.csv'
FROM objs WHERE page_id % 3 = 0
UNION ALL
SELECT bucket, tenant || '/cv/report ' || CAST(page_id AS VARCHAR) || '.json',
  's3://' || bucket || '/' || tenant || '/cv/report ' || CAST(page_id AS VARCHAR) || '.json'
FROM objs WHERE page_id % 4 = 0""")


def gate_semi() -> str:
    return with_objects(f"""SELECT url AS src FROM recobj
WHERE url IN (SELECT src FROM props WHERE propertyname IN ({GATE_IN}))""")


def pending_anti() -> str:
    return with_objects("SELECT url AS src FROM recobj WHERE url NOT IN (SELECT src FROM ledger)")


def output_anti() -> str:
    return with_objects("""SELECT url AS src, CASE WHEN url IN (SELECT src FROM outputs) THEN 'already_converted'
  ELSE 'pending' END AS status FROM recobj""")


def queue_dedupe() -> str:
    return with_objects("SELECT src, bucket FROM queue")


def queue_drain() -> str:
    return with_objects("SELECT src FROM queue WHERE src NOT IN (SELECT src FROM ledger)")


def has_pending() -> str:
    return with_objects("SELECT count(*) > 0 AS has_pending FROM (SELECT 1 FROM queue LIMIT 1) t")


def _outcome_cte() -> str:
    p, ok = _parts_sql("r.url")
    return f""",
outcome AS (
  SELECT r.url AS src, r.bucket,
    CASE WHEN NOT {ok} THEN 'bad_path'
         WHEN r.url IN (SELECT src FROM outputs) THEN 'already_converted'
         WHEN r.url IN (SELECT src FROM props WHERE propertyname IN ({GATE_IN})) THEN 'converted'
         ELSE 'rejected' END AS status,
    CASE WHEN NOT {ok} THEN 'unsupported path'
         WHEN r.url IN (SELECT src FROM outputs)
           OR r.url IN (SELECT src FROM props WHERE propertyname IN ({GATE_IN})) THEN r.out_at
         ELSE 'Was not created by AuditINT' END AS detail
  FROM recobj r WHERE r.url NOT IN (SELECT src FROM ledger)
)"""


def convert_status() -> str:
    return f"WITH {_OBJ}{_outcome_cte()}\nSELECT src, bucket, status, detail FROM outcome"


def ledger_upsert() -> str:
    return f"""WITH {_OBJ}{_outcome_cte()}
SELECT src, bucket, ts, status, detail, n_records FROM ledger
UNION ALL
SELECT src, bucket, CAST(1700000060 AS BIGINT) AS ts, CASE WHEN status = 'rejected' AND bucket = 'b1' THEN 'converted' ELSE status END AS status,
  detail, CASE WHEN status = 'rejected' AND bucket = 'b1' THEN CAST(7 AS BIGINT) END AS n_records FROM outcome
WHERE src NOT IN (SELECT src FROM ledger)"""


ORACLES.update({
    "list_keys": list_keys,
    "path_parts": path_parts,
    "sibling_path": sibling_path,
    "tenant_db_name": tenant_db_name,
    "notif_decode": notif_decode,
    "gate_semi": gate_semi,
    "pending_anti": pending_anti,
    "output_anti": output_anti,
    "queue_dedupe": queue_dedupe,
    "queue_drain": queue_drain,
    "has_pending": has_pending,
    "convert_status": convert_status,
    "ledger_upsert": ledger_upsert,
})


# -- I/O, templates, streams ---------------------------------------------------

def _wide_ctes() -> list[str]:
    return [_pv(RISK_IDS), _FSA, _ASSERT, _SRI, _LINK,
            f"\nwv AS (SELECT\n  {_wide_select()}\n{_wide_from()})"]


def _nullif_cols(prefix: str = "") -> str:
    return ", ".join(f"nullif({prefix}{q(c)}, '') AS {q(c)}" for c in COLUMNS)


# the fixture's record URLs: s3://b<k % 2>/tenant-<k>/cv/f<k>.csv
_K = "CAST(substr(src, 2) AS INTEGER)"
_KEYS = f"'b' || CAST({_K} % 2 AS VARCHAR) AS bucket, 'tenant-' || substr(src, 2) AS tenant, src || '.csv' AS file"


def csv_scan() -> str:
    cols = ", ".join(f"nullif({c}, '') AS {c}" for c in HEADER + ["form", "group_", "id", "data"])
    return with_fixture(body=f"SELECT src AS file, {cols} FROM eav")


def property_scan() -> str:
    return with_objects("SELECT r.page_id AS p_page, p.propertyname FROM props p JOIN recobj r ON r.url = p.src")


def csv_roundtrip() -> str:
    return with_fixture(*_wide_ctes(), body=f"SELECT {_nullif_cols()}, {_KEYS} FROM wv")


def multi_bucket_write() -> str:
    return with_fixture(_pv(["R_IDENTIFIER"]), body=f"""SELECT CASE src WHEN 'f0' THEN 'b0' ELSE 'b1' END AS bucket,
  CASE src WHEN 'f2' THEN 't-2' ELSE 't-1' END AS tenant, CASE src WHEN 'f2' THEN 'y=1.csv' ELSE 'x.csv' END AS file,
  {q('a__R_IDENTIFIER')} AS rid FROM pv WHERE src <> 'f3'""")


def typed_view() -> str:
    items = []
    for c in COLUMNS:
        out = "dateid" if c == "dateId" else c
        if c in INT_COLUMNS:
            items.append(f"TRY_CAST(nullif({q(c)}, '') AS INTEGER) AS {q(out)}")
        else:
            items.append(f"nullif({q(c)}, '') AS {q(out)}")
    return with_fixture(*_wide_ctes(), body=f"SELECT {', '.join(items)} FROM wv")


def catalog_query() -> str:
    return with_fixture(*_wide_ctes(), body="""SELECT TRY_CAST(yearend AS INTEGER) AS yearend, nullif(significant, '') AS significant,
  count(*) AS n_risks, count(nullif(assocd_ctrl, '')) AS n_with_ctrl, count(nullif(assocd_item, '')) AS n_with_item
FROM wv GROUP BY ALL""")


def tenant_database() -> str:
    return with_objects("""SELECT tenant, 'tenant_' || replace(tenant, '-', '') AS db_name, count(*) AS n_objects
FROM objs GROUP BY tenant""")


def diagnostics() -> str:
    return with_fixture(_pv(["R_NEWNAME", "R_FRF"]), body=f"""SELECT src, form, 'day' AS field, {q('a__R_NEWNAME')} AS token,
  'unreadable date' AS reason FROM pv WHERE {q('a__R_NEWNAME')} <> ''
UNION ALL SELECT src, form, 'kinds', {q('a__R_FRF')}, 'no lookup row' FROM pv WHERE contains({q('a__R_FRF')}, 'FT')""")


def date_forms() -> str:
    return """SELECT o_orderkey, CAST(form AS INTEGER) AS form,
  CASE WHEN form IN (101, 102) AND day(o_orderdate) <= 12 THEN NULL WHEN form IN (103, 104) THEN NULL
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders, (SELECT unnest(list_concat(range(18), range(100, 105))) AS form) f"""


def queue_pending() -> str:
    return with_objects("SELECT src, bucket FROM queue")


def field_dictionary() -> str:
    parts = []
    for out, source, desc, kind in FIELDS:
        parts.append(f"SELECT '{out}' AS {q('column')}, '{source}' AS source_id, '{desc}' AS description, "
                     f"'{kind}' AS kind, count({q(out)}) AS n_values FROM wv")
    return with_fixture(*_wide_ctes(), body="\nUNION ALL ".join(parts))


_EVENT_ROWS = """
e0 AS (SELECT *, 'e' || CAST(user_id % 4 AS VARCHAR) AS src FROM events),
ea AS (
  SELECT *, 0 AS j, event_type AS id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS data FROM e0
  UNION ALL SELECT *, 1, 'plan', 'P' || CAST(user_id % 7 AS VARCHAR) FROM e0 WHERE event_type = 'signup'
  UNION ALL SELECT *, 2, 'active', CAST(event_id % 3 AS VARCHAR) FROM e0 WHERE event_type = 'view'
),
ev AS (
  SELECT src, event_id * 4 + j AS ord, src || '.csv' AS filename, CAST(year(ts) AS VARCHAR) AS yearend,
         CAST(user_id AS VARCHAR) AS entityid, 'user-' || CAST(user_id AS VARCHAR) AS entityname,
         'bundle-' || src AS bundleguid, strftime(ts, '%Y-%m-%d %H:%M:%S') AS lastmodified,
         CAST(event_id AS VARCHAR) AS cwguid, 'U' || CAST(user_id AS VARCHAR) AS form, id, data
  FROM ea
)"""


def _event_last(i: str) -> str:
    return f"arg_max_null(data, ord) FILTER (WHERE id = '{i}')"


def second_template() -> str:
    hdr = ", ".join(f"arg_max_null({h}, ord) AS {h}" for h in HEADER)
    last = _event_last
    kinds = ["view", "click", "purchase", "error", "signup"]
    cols = ", ".join(f"{last(k)} AS last_{k}" for k in kinds)
    return f"""WITH {_EVENT_ROWS},
u AS (SELECT src, {hdr}, {cols}, {last('plan')} AS plan0, {last('active')} AS active0 FROM ev WHERE id IS NOT NULL GROUP BY src, form)
SELECT u.src, {', '.join('u.' + h for h in HEADER)}, {', '.join('u.last_' + k for k in kinds)},
  coalesce('Plan ' || n.n_name, u.plan0) AS plan, {yes_no_some_sql('u.active0')} AS active
FROM u LEFT JOIN nation n ON n.n_nationkey < 5 AND u.plan0 = 'P' || CAST(n.n_nationkey AS VARCHAR)"""


def plugin_template() -> str:
    hdr = ", ".join(f"arg_max_null({h}, ord) AS {h}" for h in HEADER)
    return f"""WITH {_EVENT_ROWS},
u AS (SELECT src, {hdr}, {_event_last('plan')} AS plan, {_event_last('view')} AS view0, {_event_last('active')} AS active0
      FROM ev WHERE id IS NOT NULL GROUP BY src, form),
p AS (SELECT src, data AS code, arg_min(form, ord) AS plan_first, CAST(count(*) AS VARCHAR) AS plan_uses
      FROM ev WHERE id = 'plan' GROUP BY src, data),
a AS (SELECT src, data AS code, arg_max(form, ord) AS n FROM ev WHERE id = 'active' AND data <> '0' GROUP BY src, data)
SELECT u.src, {', '.join('u.' + h for h in HEADER)}, u.plan, p.plan_first, p.plan_uses,
  CASE WHEN CAST(u.view0 AS DECIMAL(18,2)) >= 50 THEN 'high' WHEN u.view0 IS NOT NULL THEN 'low' END AS view_band,
  coalesce(a.n, u.active0) AS active_alike
FROM u LEFT JOIN p ON u.src = p.src AND u.plan = p.code LEFT JOIN a ON u.src = a.src AND u.active0 = a.code"""


def stream_notifications() -> str:
    return with_objects("""SELECT DISTINCT 's3://' || bucket || '/' || tenant || '/cv/report ' || CAST(page_id AS VARCHAR)
  || '&v1.csv' AS src, bucket FROM objs""")


def stream_convert() -> str:
    return with_fixture(*_wide_ctes(), body=f"""SELECT {_nullif_cols()}, {_KEYS}, 'converted' AS status,
  count(*) OVER (PARTITION BY src) AS n_records FROM wv WHERE src <> 'f3'""")


def queue_convert() -> str:
    return f"SELECT *, CAST(0 AS BIGINT) AS n_waiting FROM ({stream_convert()}) v"


def tenant_tables() -> str:
    return with_fixture(_pv(["R_IDENTIFIER", "R_SIGNIFICANT"]), body=f"""SELECT 'tenant' || substr(src, 2) AS db, {_KEYS},
  {q('a__R_IDENTIFIER')} AS rid, nullif({yes_no_sql(q('a__R_SIGNIFICANT'))}, '') AS significant FROM pv WHERE src <> 'f3'""")


def backfill() -> str:
    url = f"'s3://b' || CAST({_K} % 2 AS VARCHAR) || '/tenant-' || substr(src, 2) || '/cv/' || src || '.csv'"
    at = f"'/bucket=b' || CAST({_K} % 2 AS VARCHAR) || '/tenant=tenant-' || substr(src, 2) || '/file=' || src || '.csv'"
    no = "'Was not created by AuditINT'"
    return with_fixture(_pv([]), body=f"""SELECT {url} AS url, 'b' || CAST({_K} % 2 AS VARCHAR) AS bucket,
  CAST(CASE WHEN src = 'f3' THEN 1700000060 ELSE 1700000000 END AS BIGINT) AS ts,
  CASE WHEN src = 'f1' THEN 'rejected' ELSE 'converted' END AS status,
  CASE WHEN src <> 'f1' THEN CAST(count(*) AS BIGINT) END AS n_records,
  CASE WHEN src = 'f1' THEN {no} ELSE {at} END AS detail
FROM pv GROUP BY src
UNION ALL SELECT 's3://b0/tenant-0/cv/deep/d.csv', 'b0', 1700000000, 'bad_path', NULL, 'unsupported path'
UNION ALL SELECT 's3://b1/tenant-1/cv/e.csv', 'b1', 1700000000, 'rejected', NULL, {no}""")


ORACLES.update({
    "csv_scan": csv_scan,
    "property_scan": property_scan,
    "csv_roundtrip": csv_roundtrip,
    "multi_bucket_write": multi_bucket_write,
    "tenant_database": tenant_database,
    "diagnostics": diagnostics,
    "date_forms": date_forms,
    "typed_view": typed_view,
    "catalog_query": catalog_query,
    "queue_pending": queue_pending,
    "second_template": second_template,
    "plugin_template": plugin_template,
    "field_dictionary": field_dictionary,
    "stream_notifications": stream_notifications,
    "stream_convert": stream_convert,
    "backfill": backfill,
    "crash_replay": stream_convert,
    "queue_convert": queue_convert,
    "late_sidecar": stream_convert,
    "tenant_tables": tenant_tables,
})
