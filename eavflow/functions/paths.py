"""Object-path and notification helpers (Column -> Column)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Object layout ``scheme://bucket/tenant/table/file`` and the
# table folders used by the conversion.
RECORD_FOLDER = "cv"
OUTPUT_FOLDER = "cvrisk"
METADATA_FOLDER = "metadata"
RECORD_KEYWORD = "/cv/"
RECORD_SUFFIX = ".csv"
#: Characters that a partition folder's name escapes as %XX (fixed values of the Hive layout), '%' first.
ESCAPED = "%\"#'*/:=?\\{[]^"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_parts(url) -> Column:
    """V9: struct(bucket, tenant, folder, file, ok).

    ``ok`` is true only for exactly four parts after the scheme; deeper and
    shallower paths are rejected instead of being cut (reference truncates).
    """
    parts = F.split(_c(url), "/")
    n = F.size(parts)
    scheme_ok = F.try_element_at(parts, F.lit(2)) == ""
    return F.struct(
        F.try_element_at(parts, F.lit(3)).alias("bucket"),
        F.try_element_at(parts, F.lit(4)).alias("tenant"),
        F.try_element_at(parts, F.lit(5)).alias("folder"),
        F.try_element_at(parts, F.lit(6)).alias("file"),
        (F.coalesce((n == 6) & scheme_ok, F.lit(False))).alias("ok"),
    )


def sibling_path(url, folder: str) -> Column:
    """Same object in another table folder (only the folder is swapped)."""
    p = path_parts(url)
    scheme = F.regexp_extract(_c(url), r"^([^/]*//)", 1)
    return F.when(p["ok"], F.concat(scheme, F.concat_ws("/", p["bucket"], p["tenant"],
                                                        F.lit(folder), p["file"])))


def record_of(url) -> Column:
    """The record URL that a sidecar URL belongs to; null for any other URL."""
    return F.when(path_parts(url)["folder"] == METADATA_FOLDER, sibling_path(url, RECORD_FOLDER))


def build_url(bucket, key, scheme: str = "s3://") -> Column:
    """V8: scheme + bucket + '/' + key."""
    return F.concat(F.lit(scheme), _c(bucket), F.lit("/"), _c(key))


def url_decode_plus(c) -> Column:
    """V7: percent-decoding with '+' as space; null when the escape is broken."""
    return F.try_url_decode(_c(c))


def tenant_db_name(tenant, prefix: str = "tenant_") -> Column:
    """Per-tenant database name: the caller's prefix + tenant without dashes."""
    return F.concat(F.lit(prefix), F.replace(_c(tenant), F.lit("-"), F.lit("")))


def percent_decode(c) -> Column:
    """Percent-decoding that leaves '+' alone (URI paths, unlike form data)."""
    return F.try_url_decode(F.replace(_c(c), F.lit("+"), F.lit("%2B")))


def plain_path(c) -> Column:
    """One spelling of a file path: ``file:/x`` and ``file:///x`` are the same."""
    c = _c(c)
    return F.when(c.startswith("file:///") & ~c.startswith("file:////"), c).otherwise(F.regexp_replace(c, "^file:/+", "file:///"))


def scanned_path() -> Column:
    """The decoded path of the file a row was read from."""
    path = F.col("_metadata.file_path")
    return plain_path(F.when(path.contains("%"), percent_decode(path)).otherwise(path))


def glob_escape(path: str) -> str:
    """A path for a reader, which takes ``{}[]*?\\`` for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


@dataclass(frozen=True)
class Store:
    """Where the objects of logical URLs lie: URL = ``scheme`` + rest, path = ``root`` + rest.

    In an object store both are the same; a test or a mount has another root.
    """

    root: str = "s3://"
    scheme: str = "s3://"

    def __post_init__(self):
        root = re.sub("^file:/+", "file:///", self.root if ":/" in self.root else "file://" + self.root)
        object.__setattr__(self, "root", root.rstrip("/") + "/" if not root.endswith("//") else root)

    def url(self, path) -> Column:
        p = plain_path(path)
        return F.concat(F.lit(self.scheme), F.substring(p, len(self.root) + 1, 1 << 30))

    def path(self, url) -> Column:
        return F.concat(F.lit(self.root), F.substring(_c(url), len(self.scheme) + 1, 1 << 30))

    def at(self, rest: str) -> str:
        return self.root + rest


def output_keys(src) -> tuple[Column, Column, Column]:
    """(bucket, tenant, file) of the output of a record URL: the whole URL, so two inputs never share an output.

    A URL outside the layout goes to ``_unknown`` under its file name prefixed
    by a hash of the whole URL.
    """
    s = _c(src)
    p = path_parts(s)
    unknown = F.lit("_unknown")
    other = F.concat(F.hex(F.xxhash64(s)), F.lit("-"), F.element_at(F.split(s, "/"), -1))
    return (F.when(p["ok"], p["bucket"]).otherwise(unknown), F.when(p["ok"], p["tenant"]).otherwise(unknown),
            F.when(p["ok"], p["file"]).otherwise(other))


def output_location(src, out_root: str) -> Column:
    """The folder that holds the output of a record URL."""
    def escaped(c: Column) -> Column:
        for x in ESCAPED:
            c = F.replace(c, F.lit(x), F.lit(f"%{ord(x):02X}"))
        return c
    b, t, f = (escaped(c) for c in output_keys(src))
    return F.concat(F.lit(out_root.rstrip("/") + "/bucket="), b, F.lit("/tenant="), t, F.lit("/file="), f)


def is_record_key(key) -> Column:
    """Record files: keyword in the key and the suffix at its end."""
    k = _c(key)
    return k.contains(RECORD_KEYWORD) & k.endswith(RECORD_SUFFIX)
