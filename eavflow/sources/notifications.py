"""S7 + V7 + V8: upload notifications (JSON text) -> file URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavflow.functions import paths as P

NOTIFICATION_SCHEMA = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
            T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
        ])),
    ]))),
])


def decode(notes: DataFrame, body: str = "body") -> DataFrame:
    """Every record of every notification: ``bucket, key, url`` (key decoded)."""
    parsed = notes.select(F.from_json(F.col(body), NOTIFICATION_SCHEMA).alias("n"))
    recs = parsed.select(F.explode("n.Records").alias("r"))
    key = P.url_decode_plus(F.col("r.s3.object.key"))
    return recs.select(F.col("r.s3.bucket.name").alias("bucket"), key.alias("key")) \
               .withColumn("url", P.build_url("bucket", "key"))


def record_uploads(notes: DataFrame, body: str = "body") -> DataFrame:
    """I1 filter: only uploads of record files (keyword in the key, suffix at its end)."""
    return decode(notes, body).where(P.is_record_key("key"))
