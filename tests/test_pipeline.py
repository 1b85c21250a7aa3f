"""Planted cases: one literal input per rule of the conversion."""

import pytest
from pyspark.sql import functions as F

from eavflow.plans import pipeline
from eavflow.plans.spec import RISK_TEMPLATE
from tests.conftest import eav

R = "RISK"
RECORDS = [
    ("R1", R, "R_IDENTIFIER", "R1"), ("R1", R, "R_NAME", "first"), ("R1", R, "R_NAME", None),
    (None, R, "R_IDENTIFIER", "N1"), (None, R, "R_NEWNAME", "nn"),
    ("R2", R, "R_FSA", "111111111111"),
    ("R3", R, "R_FSA", "333333333333"),
    ("R4", R, "R_FSA", None),
    ("R5", R, "R_FSA", "X1,X2"),
    ("R6", R, "R_FSA", "GRP9,GRP1"),
    ("R7", R, "R_FSA", "AO7,AO1"),
    ("R8", R, "R_FSA", "AO8"),
    ("R9", R, "R_FSA", "GRP2"),
    ("R10", R, "R_FRF", "FTN"), ("R11", R, "R_FRF", "FTX"), ("R12", R, "R_FRF", ""),
    ("R13", R, "R_IDENTIFIER", "R13"), ("R14", R, "R_IDENTIFIER", "R14"),
    ("R15", R, "R_SIGNIFICANT", "Y"), ("R15", R, "R_MANRESPDD", "9"), ("R15", R, "R_RFD", ""),
    ("R16", R, "ISMODDATE", "17/08/2020"), ("R17", R, "ISMODDATE", "8/7/2020"),
    ("R18", R, "ISMODDATE", "bad"),
    ("R19", R, "R_UNMAPPED", "x"),
]
LOOKUPS = [
    ("111111111111", "PERVASIVECAT", "PERVASIVECATNAME", "Pervasive"),
    ("GRP1", "FSA", "FSA_NAME", "Name1"), ("GRP2", "FSA", "FSA_NAME", "Alpha, Beta"),
    ("AOF1", "ASSERT", "AO1", "x|y|Label"), ("AOF7", "ASSERT", "AO7", "a|12-Custom|Other"),
    ("AOF8", "ASSERT", "AO8", "Other"),
    ("FTN", "FRFTYPE", "FRFTYPENAME", None),
    ("I1", "RPTITEM", "NAME", "Item one"), ("C1", "CONTROL", "C_NAME", "Ctrl one"),
    ("L1", "LINK", "MEMBER_B", "R13"), ("L1", "LINK", "RELATION_TYPE", "R2I"), ("L1", "LINK", "MEMBER_A", "I1"),
    ("L2", "LINK", "MEMBER_B", "R13"), ("L2", "LINK", "RELATION_TYPE", "C2R"), ("L2", "LINK", "MEMBER_A", "C1"),
    ("L3", "LINK", "MEMBER_B", "R14"), ("L3", "LINK", "RELATION_TYPE", "C2R"),
]


@pytest.fixture(scope="module")
def conv(spark):
    rec = eav(spark, RECORDS + LOOKUPS, "f").unionByName(
        eav(spark, [("GRP1", "FSA", "FSA_NAME", "OtherName"), ("G1", R, "R_FSA", "GRP1")], "g"))
    c = pipeline.convert(rec, RISK_TEMPLATE)
    view = c.view.collect()
    forms = {(r.src, r.first_ord): r for r in c.index.records.select("src", "rk", "form")
             .withColumnRenamed("rk", "first_ord").collect()}
    rows = {(r.src, forms[(r.src, r.first_ord)].form): r for r in view}
    return rows, c.diagnostics.collect(), view


def test_last_write_wins_even_null(conv):
    rows, _, _ = conv
    assert rows[("f", "R1")]["desc"] is None and rows[("f", "R1")].rid == "R1"


def test_null_form_is_one_record(conv):
    rows, _, view = conv
    r = rows[("f", None)]
    assert r.rid == "N1" and r.name == "nn" and r.assocd_ctrl is None and r.assocd_item is None
    assert len(view) == len({k for k in rows})


def test_sentinels(conv):
    rows, _, _ = conv
    assert rows[("f", "R2")].fsa == "Pervasive" and rows[("f", "R2")]["assert"] == ""
    assert rows[("f", "R3")].fsa is None


def test_empty_lists(conv):
    rows, _, _ = conv
    assert rows[("f", "R4")].fsa == "" and rows[("f", "R4")]["assert"] == ""
    assert rows[("f", "R5")].fsa == ""


def test_missing_token_skipped_with_diagnostics(conv):
    rows, diags, _ = conv
    assert rows[("f", "R6")].fsa == "Name1"
    assert any(d.form == "R6" and d.token == "GRP9" and d.field == "fsa" for d in diags)


def test_labels(conv):
    rows, diags, _ = conv
    assert rows[("f", "R7")]["assert"] == "Custom,Label"        # 'Other' item stays separate
    assert rows[("f", "R8")]["assert"] == ""
    assert any(d.form == "R8" and d.token == "AO8" for d in diags)


def test_name_with_comma_splits(conv):
    rows, _, _ = conv
    assert rows[("f", "R9")].fsa == " Beta,Alpha"                # no trimming; sorted


def test_lookup_or_self(conv):
    rows, _, _ = conv
    assert rows[("f", "R10")].sri is None                        # row exists, data null
    assert rows[("f", "R11")].sri == "FTX"                       # no row: value itself
    assert rows[("f", "R12")].sri == ""


def test_link_walk_first_link_only(conv):
    rows, _, _ = conv
    assert rows[("f", "R13")].assocd_ctrl is None and rows[("f", "R13")].assocd_item == "Item one"
    assert rows[("f", "R14")].assocd_ctrl is None               # no MEMBER_A


def test_flags(conv):
    rows, _, _ = conv
    r = rows[("f", "R15")]
    assert (r.significant, r.treatment, r.r_forward) == ("No", "Some", "")


def test_dates(conv):
    rows, diags, _ = conv
    assert rows[("f", "R16")].dateId == "2020-08-17" and rows[("f", "R17")].dateId == "2020-08-07"
    assert rows[("f", "R18")].dateId is None
    assert any(d.form == "R18" and d.reason == "unreadable date" for d in diags)


def test_unmapped_only_record_survives(conv):
    rows, _, _ = conv
    assert ("f", "R19") in rows and rows[("f", "R19")].lastmodified is not None


def test_scope_is_per_file(conv):
    rows, _, _ = conv
    assert rows[("g", "G1")].fsa == "OtherName"


def test_header_from_last_row(conv):
    rows, _, _ = conv
    # R1's last row is its third row (ord 2): lastmodified carries the ord
    assert rows[("f", "R1")].lastmodified == "2"


def test_shuffled_input_same_result(spark, conv):
    _, _, view = conv
    rec = eav(spark, RECORDS + LOOKUPS, "f").unionByName(
        eav(spark, [("GRP1", "FSA", "FSA_NAME", "OtherName"), ("G1", R, "R_FSA", "GRP1")], "g"))
    shuffled = rec.repartition(5).orderBy(F.rand(7))
    again = pipeline.convert(shuffled, RISK_TEMPLATE).view.collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, view), key=str)


def test_second_file_does_not_change_first(spark, conv):
    _, _, view = conv
    alone = pipeline.convert(eav(spark, RECORDS + LOOKUPS, "f"), RISK_TEMPLATE).view.collect()
    with_f = sorted((tuple(r) for r in view if r.src == "f"), key=str)
    assert sorted(map(tuple, alone), key=str) == with_f
