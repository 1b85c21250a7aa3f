"""Scalar value functions (Column -> Column), all JVM-side built-ins.

Spark runs with ANSI mode on, so every lookup that can miss uses the ``try_``
variant (``try_element_at``, ``try_to_timestamp``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-digit years below this are 20xx, the others 19xx.
YEAR_PIVOT = 70
# A time of day after a complete date; the day is all that is kept.
_TIME = r"(?i)(?:T|,? +)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?(?: *[ap]m)?(?: *(?:Z|UTC|GMT|[+-]\d{2}:?\d{2}))?$"
_MONTH = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"

# Code-list separators and the label path separator.
TOKEN_SPLIT = r"[|,]"
LABEL_SPLIT = r"\|"
OTHER_LABEL = "Other"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c) -> Column:
    """True for null or ''."""
    c = _c(c)
    return c.isNull() | (c == "")


def yes_no(c) -> Column:
    """V1: null/'' unchanged, '1' -> Yes, anything else -> No."""
    c = _c(c)
    return F.when(blank(c), c).when(c == "1", F.lit("Yes")).otherwise(F.lit("No"))


def yes_no_some(c) -> Column:
    """V2: null/'' unchanged, '1' -> Yes, '0' -> No, anything else -> Some."""
    c = _c(c)
    return (F.when(blank(c), c).when(c == "1", F.lit("Yes"))
             .when(c == "0", F.lit("No")).otherwise(F.lit("Some")))


def parse_date(c) -> Column:
    """The day of a complete date, as a timestamp; null if it is none.

    Year first (``2020-8-7``, ``2020/08/17``, ``20200817``, ``20200817101112``),
    month before day and, where that is no date, day before month
    (``8/17/2020``, ``17.08.2020``, ``8/7/20``), or with an English month name
    (``Aug 17, 2020``, ``17-Aug-2020``).  A time of day and a zone may follow.
    """
    def made(y_m_d: Column) -> Column:
        return F.try_to_timestamp(y_m_d, F.lit("yyyy-M-d"))

    def number(name: Column) -> Column:
        at = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(name, 1, 3)))
        return F.floor((at + 2) / 3).cast("string")

    def named(day: Column, pattern: str, month: int, at: int) -> Column:
        part = lambda i: F.regexp_extract(day, pattern, i)
        return made(F.concat_ws("-", part(3), number(part(month)), part(at)))

    sep = r"([-/.])"
    year_first = rf"^(\d{{4}}){sep}(\d{{1,2}})\2(\d{{1,2}})$"
    compact = r"^(\d{4})(\d{2})(\d{2})(?:(?:[01]\d|2[0-3])[0-5]\d[0-5]\d)?$"
    year_last, short_last = (rf"^(\d{{1,2}}){sep}(\d{{1,2}})\2(\d{{{n}}})$" for n in (4, 2))
    month_day, day_month = rf"(?i)^{_MONTH}[ -](\d{{1,2}}),?[ -](\d{{4}})$", rf"(?i)^(\d{{1,2}})[ -]{_MONTH},?[ -](\d{{4}})$"

    def read(day: Column) -> Column:
        # the forms exclude each other; a matching one is rewritten at once
        century = F.when(F.substring(day, -2, 2).cast("int") < YEAR_PIVOT, F.lit("20")).otherwise(F.lit("19"))
        either = lambda pattern, front: F.coalesce(*[
            made(F.concat(front, F.regexp_replace(day, pattern, order))) for order in ("$4-$1-$3", "$4-$3-$1")])
        return (F.when(day.rlike(year_first), made(F.regexp_replace(day, year_first, "$1-$3-$4")))
                 .when(day.rlike(compact), made(F.regexp_replace(day, compact, "$1-$2-$3")))
                 .when(day.rlike(year_last), either(year_last, F.lit("")))
                 .when(day.rlike(short_last), either(short_last, century))
                 .when(day.rlike(month_day), named(day, month_day, 1, 2))
                 .when(day.rlike(day_month), named(day, day_month, 2, 1)))

    text = F.trim(_c(c))
    day = F.when(text.contains(":"), F.regexp_replace(text, _TIME, "")).otherwise(text)
    return F.get(F.transform(F.array(day), read), 0)    # the text without its time is made once


def date_norm(c) -> Column:
    """V3: null/'' unchanged, else ``yyyy-MM-dd`` text; unreadable -> null."""
    c = _c(c)
    return F.when(blank(c), c).otherwise(F.date_format(parse_date(c), "yyyy-MM-dd"))


def date_unreadable(c) -> Column:
    """True where V3 turns a non-blank value into null (a diagnostics row)."""
    c = _c(c)
    return ~blank(c) & parse_date(c).isNull()


def token_split(c) -> Column:
    """V4: split a code list on '|' then ','; one flat array of tokens."""
    return F.split(_c(c), TOKEN_SPLIT)


def path_label(c) -> Column:
    """V5: last '|' segment, or if that is 'Other' the previous one from its 4th char.

    Null when the text is null or when 'Other' has no previous segment.
    """
    parts = F.split(_c(c), LABEL_SPLIT)
    last = F.try_element_at(parts, F.lit(-1))
    prev = F.try_element_at(parts, F.lit(-2))
    return F.when(last == OTHER_LABEL, F.substring(prev, 4, 1 << 30)).otherwise(last)


def list_items(c) -> Column:
    """Items of a comma list with empties dropped (names may carry commas)."""
    return F.filter(F.split(_c(c), ","), lambda x: x != "")


def join_sorted_distinct(arr) -> Column:
    """A3 finish: distinct items, sorted (the reference's order is undefined), ','-joined."""
    return F.array_join(F.array_sort(F.array_distinct(_c(arr))), ",")
