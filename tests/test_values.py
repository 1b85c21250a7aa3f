from pyspark.sql import functions as F

from eavflow.functions import paths as P
from eavflow.functions import values as V


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(col).collect()]


def test_yes_no(spark):
    assert one(spark, V.yes_no("v"), [None, "", "1", "0", "Y", "x"]) == [None, "", "Yes", "No", "No", "No"]


def test_yes_no_some(spark):
    assert one(spark, V.yes_no_some("v"), [None, "", "1", "0", "9", "2"]) == [None, "", "Yes", "No", "Some", "Some"]


def test_dates(spark):
    got = one(spark, V.date_norm("v"), ["17/08/2020", "8/7/2020", "bad", "", None, "2020-08-17",
                                        "20200817", "08/17/2020", "Aug 17, 2020", "17 August 2020",
                                        "2020-08-17T10:11:12", "2020-08-17 10:11:12", "20200817101112"])
    assert got == ["2020-08-17", "2020-08-07", None, "", None] + ["2020-08-17"] * 8
    forms = ["2020/08/17", "2020-08-17T10:11:12Z", "2020-08-17T10:11:12.123", "2020-08-17 10:11:12.0", "2020-08-17 10:11",
             "17-Aug-2020", "August 17, 2020", "Aug 17 2020", "17 Aug 2020", "08-17-2020", "17.08.2020", "8/17/20",
             "8/17/2020 10:11:12 AM", "2020-8-17", "aug. 17, 2020", "17 AUGUST 2020", "2020-08-17T10:11:12+02:00", " 2020-08-17 "]
    assert one(spark, V.date_norm("v"), forms) == ["2020-08-17"] * len(forms)
    # incomplete, impossible or mixed
    bad = ["Aug 2020", "2020-08", "10:11", "2020-02-30", "13/13/2020", "2020-08-17 25:11", "2020-08/17", "Foo 17, 2020", "20201332"]
    assert one(spark, V.date_norm("v"), bad) == [None] * len(bad)
    assert one(spark, V.date_norm("v"), ["8/7/69", "8/7/70", "8/7/99"]) == ["2069-08-07", "1970-08-07", "1999-08-07"]
    assert one(spark, V.date_unreadable("v"), ["bad", "", None, "8/7/2020"]) == [True, False, False, False]


def test_token_split(spark):
    assert one(spark, V.token_split("v"), ["GRP1,GRP2|AO1,AO2"]) == [["GRP1", "GRP2", "AO1", "AO2"]]


def test_path_label(spark):
    got = one(spark, V.path_label("v"), ["x|y|Label", "a|12-Custom|Other", "Other", "Solo", None, "a|ab|Other"])
    assert got == ["Label", "Custom", None, "Solo", None, ""]


def test_path_parts_and_siblings(spark):
    urls = ["s3://b/t-1/cv/f.csv", "s3://b/t/cv/extra/f.csv", "s3://cv-data/t/cv/cv.csv", "s3://b/t/f.csv"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(P.path_parts("u").alias("p"), P.sibling_path("u", "cvrisk").alias("o"),
                     P.sibling_path("u", "metadata").alias("m"), P.tenant_db_name(F.lit("a-b-c"), "x_").alias("d")).collect()
    assert [r.p.ok for r in rows] == [True, False, True, False]
    assert rows[0].o == "s3://b/t-1/cvrisk/f.csv" and rows[0].m == "s3://b/t-1/metadata/f.csv"
    assert rows[1].o is None                                  # deeper path rejected, not truncated
    assert rows[2].o == "s3://cv-data/t/cvrisk/cv.csv"        # only the folder is swapped
    assert rows[0].d == "x_abc"


def test_url_decode(spark):
    assert one(spark, P.url_decode_plus("v"), ["t/cv/a+b%26c.csv", "bad%zz"]) == ["t/cv/a b&c.csv", None]
