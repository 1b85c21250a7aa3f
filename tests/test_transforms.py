"""Value functions that a template brings along: scalars, lookups of their own, whole transforms."""

import pytest
from pyspark.sql import functions as F

from eavflow.operators.file_index import Dictionary
from eavflow.plans import pipeline
from eavflow.plans.spec import FieldSpec, Lookups, Template
from eavflow.plans.transforms import KeyedLookup, Scalar, Transform, dictionaries, raw
from tests.conftest import eav

ROWS = [
    ("A1", "ASSET", "owner", "u1"), ("A1", "ASSET", "cost", "12"), ("A1", "ASSET", "tag", "x y"),
    ("A2", "ASSET", "owner", "u2"), ("A2", "ASSET", "cost", "many"),
    ("A3", "ASSET", "owner", "gone"), ("A3", "ASSET", "owner", None),
    ("A4", "ASSET", "owner", "gone"), ("A5", "ASSET", "tag", None), (None, "ASSET", "owner", "u1"),
    ("u1", "USER", "USERNAME", "Ann"), ("u1", "USER", "USERNAME", "Later"), ("u2", "USER", "USERNAME", None),
    (None, "USER", "USERNAME", "Nobody"), ("u1", "OTHER", "USERNAME", "no"),
]
USERS = Dictionary("users", "group_ = 'USER' AND id = 'USERNAME'", "form",
                   (("name", "min_by(data, ord)"), ("rows", "count(1)")))


class Siblings(Transform):
    """How many other records of the file have the value: a join of the records with themselves, aggregated."""

    def enrich(self, idx, tpl, fields):
        out = []
        for f in fields:
            own = idx.records.where(raw(f).isNotNull())
            n = own.groupBy("src", raw(f).alias("v")).agg((F.count(F.lit(1)) - 1).alias("n"))
            out.append(own.select("src", "rk", raw(f).alias("v")).join(n, ["src", "v"]).select(
                "src", "rk", F.lit(f.out).alias("kind"), F.col("n").cast("string").alias("value"), F.lit(True).alias("hit")))
        return out, []

    def folds(self, f):
        return [F.max(F.when(F.col("kind") == f.out, F.col("value"))).alias(f"{f.out}__n")]

    def column(self, f, tpl):
        return F.coalesce(F.col(f"{f.out}__n"), F.lit("0"))


TEMPLATE = Template("Assets", "ASSET", ("entityid",), (
    FieldSpec("owner", "owner", "Owner"),
    FieldSpec("owner_name", "owner", "Owner's name", KeyedLookup(USERS, "name", report=True)),
    FieldSpec("owner_shown", "owner", "Owner's name or code", KeyedLookup(USERS, "name", or_self=True)),
    FieldSpec("owner_rows", "owner", "Rows that name the owner", KeyedLookup(USERS, "rows")),
    FieldSpec("cost", "cost", "Cost", Scalar(lambda c: F.try_to_number(c, F.lit("999")).cast("int"),
                                             lambda c: c.isNotNull() & ~c.rlike(r"^\d+$"), "no number")),
    FieldSpec("tag", "tag", "Tag", Scalar(F.upper)),
    FieldSpec("alike", "owner", "Others of the owner", Siblings()),
), lookups=Lookups())


@pytest.fixture(scope="module")
def conv(spark):
    rec = eav(spark, ROWS, "f").unionByName(eav(spark, [("B1", "ASSET", "owner", "u1")], "g"))
    return pipeline.convert(rec, TEMPLATE)


def test_a_template_brings_its_own_lookups(conv):
    got = {(r.src, r.form): r for r in conv.view.collect()}
    assert len(got) == 7
    shown = lambda k: tuple(got[k][c] for c in ("owner", "owner_name", "owner_shown", "owner_rows", "alike"))
    assert shown(("f", "A1")) == ("u1", "Ann", "Ann", "2", "1")
    assert shown(("f", "A2")) == ("u2", None, None, "1", "0")                # a match whose value is null
    assert shown(("f", "A3")) == (None, None, None, None, "0")               # the last write is null
    assert shown(("f", "A4")) == ("gone", None, "gone", None, "0")
    assert shown(("f", None)) == ("u1", "Ann", "Ann", "2", "1")
    assert shown(("g", "B1")) == ("u1", None, "u1", None, "0")               # lookups never cross files
    assert (got[("f", "A1")].cost, got[("f", "A2")].cost, got[("f", "A1")].tag, got[("f", "A5")].tag) == ("12", None, "X Y", None)


def test_their_diagnostics(conv):
    got = sorted((r.src, r.form, r.field, r.token, r.reason) for r in conv.diagnostics.collect())
    assert got == [("f", "A2", "cost", "many", "no number"), ("f", "A4", "owner_name", "gone", "no lookup row"),
                   ("g", "B1", "owner_name", "u1", "no lookup row")]


def test_all_lookups_are_one_dictionary_of_one_index(conv):
    assert dictionaries(TEMPLATE) == [USERS]
    assert list(conv.index.extra) == ["users"] and conv.index.sizes["users"] > 0
    assert sorted((r.src, r.key, r.name, r.rows) for r in conv.index.extra["users"].collect()) == [
        ("f", "u1", "Ann", 2), ("f", "u2", None, 1)]                         # a null key is left out


def test_no_records_and_bad_templates(spark):
    none = eav(spark, ROWS[:1], "f").where("false")
    made = pipeline.convert(none, TEMPLATE)
    assert made.view.count() == 0 and made.diagnostics.count() == 0
    other = Dictionary("users", "true", "id", (("name", "max(data)"),))
    clash = Template("Clash", "ASSET", (), (FieldSpec("a", "a", "", KeyedLookup(USERS, "name")),
                                            FieldSpec("b", "b", "", KeyedLookup(other, "name"))))
    with pytest.raises(ValueError, match="two dictionaries"):
        pipeline.convert(none, clash)
    with pytest.raises(ValueError, match="no transform is named 'odd'"):
        pipeline.convert(none, Template("Odd", "ASSET", (), (FieldSpec("a", "a", "", "odd"),)))
    with pytest.raises(ValueError, match="letters, digits"):
        Dictionary("a b", "true", "id", ())
