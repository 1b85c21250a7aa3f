"""Declarative field mapping: which attribute feeds which output column, how.

A ``Template`` bundles the record group, the header columns, the field list and
the lookup conventions of one kind of record file.  The kind of a ``FieldSpec``
names a built-in transform or is a transform of the caller's own
(``transforms.Transform``): Columns and joins, so a template needs no Python UDFs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# Transform kinds
COPY = "copy"
YES_NO = "yes_no"
YES_NO_SOME = "yes_no_some"
DATE = "date"
CODE_NAMES = "code_names"        # sentinel category or token -> name list
CODE_LABELS = "code_labels"      # token -> label path list
LOOKUP_OR_SELF = "lookup_or_self"
LINK_NAME = "link_name"


@dataclass(frozen=True)
class FieldSpec:
    out: str                 # output column
    source_id: str           # attribute id the value comes from
    desc: str                # human description
    kind: Any = COPY         # a name from above, or a transform
    param: str | None = None  # relation for LINK_NAME


@dataclass(frozen=True)
class Lookups:
    """Where each lookup finds its dictionary rows inside the same file."""
    category_group: str = "PERVASIVECAT"
    category_id: str = "PERVASIVECATNAME"
    sentinels: tuple = ()
    name_group: str = "FSA"
    name_id: str = "FSA_NAME"
    name_marker: str = "GRP"
    label_marker: str = "AO"
    indicator_group: str = "FRFTYPE"
    indicator_id: str = "FRFTYPENAME"
    link_member_record: str = "MEMBER_B"
    link_relation: str = "RELATION_TYPE"
    link_member_target: str = "MEMBER_A"
    # relation -> id of the target's name attribute
    link_targets: tuple = ()


@dataclass(frozen=True)
class Template:
    name: str
    group: str
    header: tuple
    fields: tuple
    gate_properties: tuple = ()
    lookups: Lookups = field(default_factory=Lookups)

    @property
    def columns(self) -> list[str]:
        return list(self.header) + [f.out for f in self.fields]

    @property
    def source_ids(self) -> list[str]:
        seen: list[str] = []
        for f in self.fields:
            if getattr(f.kind, "reads_source", f.kind != LINK_NAME) and f.source_id not in seen:
                seen.append(f.source_id)
        return seen

    def link_name_id(self, relation: str) -> str:
        return dict(self.lookups.link_targets)[relation]


# ---------------------------------------------------------------------------
# The audit risk template.  Output column names, attribute ids,
# descriptions, group and property names are the data contract of the record
# files and of the registered table; they must stay exactly as written.
# ---------------------------------------------------------------------------
RISK_HEADER = ("yearend", "entityid", "entityname", "bundleguid", "filename",
               "lastmodified", "cwguid")

# The columns of a record file.
HEADER_COLS = ["filename", "yearend", "entityid", "entityname", "bundleguid",
               "lastmodified", "cwguid"]
RECORD_COLS = HEADER_COLS + ["form", "group_", "id", "data"]

# The ledger's text for a file whose sidecar does not pass the gate.
NOT_CREATED_BY = "Was not created by "

RISK_FIELDS = (
    FieldSpec("rid", "R_IDENTIFIER", "Identifier"),
    FieldSpec("name", "R_NEWNAME", "Risk Name"),
    FieldSpec("rentity", "R_ENTITY", "Entities"),
    FieldSpec("dateId", "ISMODDATE", "Date Identified", DATE),
    FieldSpec("desc", "R_NAME", "Risk Description"),
    FieldSpec("whatwrong", "R_WHATGOWRONG", "What Can Go Wrong"),
    FieldSpec("fsa", "R_FSA", "Financial Statement Areas", CODE_NAMES),
    FieldSpec("assert", "R_FSA", "Assertions", CODE_LABELS),
    FieldSpec("bc", "R_BC", "Business Cycles"),
    FieldSpec("sri", "R_FRF", "Significant Risk Indicators", LOOKUP_OR_SELF),
    FieldSpec("significant", "R_SIGNIFICANT", "Significant Risk", YES_NO),
    FieldSpec("likelihood", "R_LLHOCCUR", "Likelihood to Occur"),
    FieldSpec("m_impact", "R_DOLLARIMPACT", "Monetary Impact"),
    FieldSpec("inherent", "R_INHERENT", "Inherent Risk"),
    FieldSpec("ctrl_r", "R_MANRESP", "Control Risk"),
    FieldSpec("p_rmm", "R_RMM", "Potential RMM"),
    FieldSpec("residual", "R_RRISK", "Residual Risk"),
    FieldSpec("rmm", "R_OVRISK", "RMM"),
    FieldSpec("procedures", "R_REQSPEC", "Procedures Other Than Substantive"),
    FieldSpec("m_response", "R_MRESPONSE", "Management Response"),
    FieldSpec("treatment", "R_MANRESPDD", "Risk Treatment/Mitigation", YES_NO_SOME),
    FieldSpec("a_response", "R_ARESPONSE", "Audit Response"),
    FieldSpec("source", "R_SOURCEREF", "Source/Reference"),
    FieldSpec("addressed", "R_DESTREF", "Addressed"),
    FieldSpec("assocd_ctrl", "MEMBER_A", "Associated Controls", LINK_NAME, "C2R"),
    FieldSpec("assocd_item", "MEMBER_A", "Associated Reportable Items", LINK_NAME, "R2I"),
    FieldSpec("aud_addressed", "R_AUDRESPDD", "Audit has properly addressed this risk", YES_NO),
    FieldSpec("r_forward", "R_RFD", "Roll forward", YES_NO),
)

RISK_SENTINELS = ("111111111111", "222222222222", "333333333333", "444444444444",
                  "555555555555", "666666666666", "777777777777", "888888888888",
                  "999999999999")

RISK_GATE_PROPERTIES = ("CWCustomProperty.CWAuditSource", "CWAuditSource")

RISK_TEMPLATE = Template(
    name="AuditINT",
    group="RISK",
    header=RISK_HEADER,
    fields=RISK_FIELDS,
    gate_properties=RISK_GATE_PROPERTIES,
    lookups=Lookups(sentinels=RISK_SENTINELS,
                    link_targets=(("C2R", "C_NAME"), ("R2I", "NAME"))),
)

# Integer columns of the registered (typed) table.
TYPED_INT_COLUMNS = ("yearend", "entityid")


# A second template over a different record shape (user events), used to show
# that group, fields and name travel together.  Our own definition.
EVENT_TEMPLATE = Template(
    name="UserEvents",
    group="EVENT",
    header=RISK_HEADER,
    fields=(
        FieldSpec("last_view", "view", "Last view value"),
        FieldSpec("last_click", "click", "Last click value"),
        FieldSpec("last_purchase", "purchase", "Last purchase value"),
        FieldSpec("last_error", "error", "Last error value"),
        FieldSpec("last_signup", "signup", "Last signup value"),
        FieldSpec("plan", "plan", "Plan name, or its code", LOOKUP_OR_SELF),
        FieldSpec("active", "active", "Active", YES_NO_SOME),
    ),
)

# Fields that leave diagnostics behind: a text that is no date, codes without a name row.
DIAGNOSTIC_TEMPLATE = Template(
    name="Diagnostics",
    group="RISK",
    header=RISK_HEADER,
    fields=(
        FieldSpec("day", "R_NEWNAME", "Not a date", DATE),
        FieldSpec("kinds", "R_FRF", "Codes that no name row has", CODE_NAMES),
    ),
    lookups=Lookups(name_marker="FT"),
)
