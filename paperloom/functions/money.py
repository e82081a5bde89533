"""Numbers as they stand in documents: parsing, tolerant comparison, safe arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def parse_decimal(value: Column) -> Column:
    """An exact decimal from text with currency signs and separators; null if there is none."""
    bare = F.regexp_replace(value.cast("string"), r"[₹,$\s]", "")
    return F.nullif(bare, F.lit("")).try_cast(MONEY)


def parse_number(text: Column) -> Column:
    """The first unsigned number in a table cell as a double, 0.0 if there is none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[₹$€£, ]", "")
    first = F.regexp_extract(bare, r"([0-9]+\.?[0-9]*)", 1)
    return F.coalesce(F.nullif(first, F.lit("")).try_cast("double"), F.lit(0.0))


def clean_amount(text: Column) -> Column:
    """A bare amount as text, null if something else than one number is left."""
    bare = F.regexp_replace(text, r"[₹$€£, ]", "")
    return F.when(bare.rlike(r"^[0-9]+\.?[0-9]*\z"), bare)


def safe_float(value: Column) -> Column:
    bare = F.regexp_replace(value.cast("string"), r"[,₹$]", "")
    return F.coalesce(F.trim(bare).try_cast("double"), F.lit(0.0))


def safe_divide(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def percentage(part: Column, whole: Column) -> Column:
    return safe_divide(part * 100, whole)


def round_to_currency(value: Column) -> Column:
    """Half up on the decimal value, at two places."""
    return F.round(value.cast("decimal(30,10)"), 2)


def within(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    return F.abs(a - b) <= F.lit(Decimal(str(tolerance)))


def hsn_is_valid(code: Column) -> Column:
    """4, 6 or 8 digits."""
    return F.trim(code.cast("string")).rlike(r"^([0-9]{4}|[0-9]{6}|[0-9]{8})\z")
