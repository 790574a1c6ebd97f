"""Decoding of export text into typed values, as Column expressions.

Amounts are positive for credit and negative for debit; quantities are positive inward and
negative outward. Text that cannot be read becomes 0 (numbers), NULL (dates) or '' (text);
``readable`` tells the two apart for the quality table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schema import TYPES

_LEADING_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_DAYS = r"^(\d+)\sDays$"
_NOT_NUMERIC = r"[^0-9.\-]+"

# Entity -> character, replaced in this order (so "&amp;lt;" ends as "<").
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}


def leading_number(raw: Column, sql_type: str = "decimal(17,2)") -> Column:
    """The number at the start of the text, NULL when there is none."""
    # an unmatched pattern yields '', which is no number
    return F.regexp_extract(F.trim(raw), _LEADING_NUMBER, 0).try_cast(sql_type)


def home_currency(raw: Column) -> Column:
    """``"$ 100 @ 70/$ = Rs 7000"`` -> ``"7000"``; text without ``=`` is unchanged."""
    return F.when(
        raw.contains("="),
        F.regexp_replace(F.trim(F.split(raw, "=").getItem(1)), _NOT_NUMERIC, ""),
    ).otherwise(raw)


def foreign_amount(raw: Column, sql_type: str = "decimal(17,2)") -> Column:
    """The foreign-currency part of ``"-$ 100 @ 70/$ = -Rs 7000"``, 0 without one.

    The sign is that of the home-currency amount.
    """
    part = F.trim(F.split(raw, "@").getItem(0))
    magnitude = F.abs(leading_number(F.regexp_replace(part, r"[^0-9.]+", ""), sql_type))
    negative = leading_number(home_currency(raw), sql_type) < 0
    value = F.when(negative, -magnitude).otherwise(magnitude)
    return F.coalesce(F.when(raw.contains("@"), value), F.lit(0)).cast(sql_type)


def currency_symbol(raw: Column) -> Column:
    """The currency sign written before or after the first number, '' if none."""
    first = F.trim(F.split(F.coalesce(raw, F.lit("")), "@").getItem(0))
    return F.trim(F.regexp_replace(first, r"[-+0-9.,()\s]+", ""))


def minus_marker(raw: Column) -> Column:
    """``"(-)5"`` -> ``"-5"``."""
    return F.when(raw.contains("(-)"), F.regexp_replace(raw, r"\(-\)\s*", "-")).otherwise(raw)


def date_value(raw: Column) -> Column:
    """``yyyyMMdd`` (or ISO ``yyyy-MM-dd``) -> date, anything else NULL."""
    return F.coalesce(
        F.when(F.length(raw) == 8, F.try_to_date(raw, "yyyyMMdd")),
        F.when(F.length(raw) == 10, F.try_to_date(raw, "yyyy-MM-dd")),
    )


def short_date(raw: Column, pivot: int = 71) -> Column:
    """``1-Apr-20`` -> 2020-04-01; two-digit years above ``pivot`` belong to the 1900s."""
    short = F.try_to_date(F.trim(raw), "d-MMM-yy")
    return F.when(F.year(short) % 100 > pivot, F.add_months(short, -1200)).otherwise(short)


def logical(raw: Column) -> Column:
    return F.coalesce((raw == "Yes") | (raw == "1"), F.lit(False)).cast("tinyint")


def days(raw: Column) -> Column:
    """``"30 Days"`` -> 30, everything else 0."""
    return F.coalesce(F.regexp_extract(F.trim(raw), _DAYS, 1).try_cast("int"), F.lit(0))


def character_references(raw: Column) -> Column:
    """``"a&#2350;b"`` -> ``"aमb"``: numeric references become the characters they name."""
    def resolve(piece: Column) -> Column:
        code = F.regexp_extract(piece, r"^(\d+);", 1)
        point = code.try_cast("int")
        valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point)), 8, "0")), "UTF-32")
        rest = F.substring(piece, F.length(code) + 2, F.length(piece))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&#"), piece))

    pieces = F.split(raw, "&#")
    return F.concat(pieces.getItem(0), F.array_join(
        F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolve), ""))


def text(raw: Column) -> Column:
    """Resolve character references and entities, drop tabs."""
    resolved = F.when(raw.contains("&#"), character_references(raw)).otherwise(raw)
    for entity, char in ENTITIES.items():
        resolved = F.replace(resolved, F.lit(entity), F.lit(char))
    out = F.when(raw.contains("&"), resolved).otherwise(raw)
    return F.replace(out, F.lit("\t"), F.lit(""))


def export_text(raw: Column) -> Column:
    """Clean one line of delimited export text: envelope, blank tags, tabs and entities."""
    out = F.regexp_replace(raw, r"</?ENVELOPE>|<FLDBLANK></FLDBLANK>|&tab;", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\s*[\r\n]+", ""), "\t", " ")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.regexp_replace(out, r"&#\d+;", "")


def signed_amount(raw: Column, is_debit: Column, sql_type: str = "decimal(17,2)") -> Column:
    value = F.abs(F.coalesce(leading_number(minus_marker(raw), sql_type), F.lit(0)))
    return F.when(is_debit, -value).otherwise(value).cast(sql_type)


def signed_quantity(value: Column, inward: Column) -> Column:
    """Outward movements are negative whatever sign the text had."""
    return F.when(inward, value).otherwise(-F.abs(value))


def _number_text(kind: str, raw: Column) -> Column:
    """The part of the text in which the number is looked for."""
    if kind in ("quantity", "time"):
        return F.split(F.trim(raw), " ").getItem(0)
    if kind == "rate":
        # the unit goes before anything else: it may hold digits, in both currencies
        home = F.when(raw.contains("="), F.split(raw, "=").getItem(1)).otherwise(raw)
        per_unit = F.trim(F.split(home, "/").getItem(0))
        return F.when(raw.contains("="), F.regexp_replace(per_unit, _NOT_NUMERIC, "")).otherwise(per_unit)
    return home_currency(minus_marker(F.trim(raw)))


def decode(kind: str, raw: Column) -> Column:
    """``raw`` text as a value of ``kind``, defaults filled in."""
    if kind == "text":
        return F.coalesce(text(raw), F.lit(""))
    if kind == "date":
        return date_value(raw)
    if kind == "logical":
        return logical(raw)
    if kind == "days":
        return days(raw)
    sql_type = TYPES[kind]
    return F.coalesce(leading_number(_number_text(kind, raw), sql_type), F.lit(0)).cast(sql_type)


def readable(kind: str, raw: Column) -> Column:
    """Whether non-blank ``raw`` can be read as ``kind``."""
    if kind == "text":
        return F.lit(True)
    if kind == "date":
        return date_value(raw).isNotNull()
    if kind == "logical":
        return raw.isin("Yes", "No", "1", "0")
    if kind == "days":
        return F.trim(raw).rlike(_DAYS)
    return leading_number(_number_text(kind, raw), TYPES[kind]).isNotNull()
