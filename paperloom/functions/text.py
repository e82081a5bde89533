"""Header fields from text: cascades of patterns with guards, dates, addresses, formats.

A cascade tries patterns in order of priority, and within a pattern the matches from left to
right; the first match that its guard accepts is the field. As an expression: the matches of
all patterns concatenated, filtered, and the first taken.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import clean_amount

# Patterns, formats and word lists that decide results. Character classes are
# spelled out so that Java and RE2 read them alike.
_W = r"[\p{L}\p{N}_\-/]"
_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_NUMERIC_DATE = r"[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4}"
_WORD_DATE = rf"[0-9]{{1,2}}\s+(?:{_MONTHS})[\p{{L}}\p{{N}}_]*\s+[0-9]{{2,4}}"
_GSTIN = r"[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][A-Z0-9]Z[A-Z0-9]"
INVOICE_NUMBER = (
    rf"invoice\s*(?:no|number|#)[\s:]*({_W}+)",
    rf"inv\s*(?:no|#)[\s:]*({_W}+)",
    rf"bill\s*(?:no|number|#)[\s:]*({_W}+)",
    rf"receipt\s*(?:no|number|#)[\s:]*({_W}+)",
)
DATE = (
    rf"date[\s:]*({_NUMERIC_DATE}|{_WORD_DATE})",
    rf"invoice\s*date[\s:]*({_NUMERIC_DATE}|{_WORD_DATE})",
    rf"bill\s*date[\s:]*({_NUMERIC_DATE}|{_WORD_DATE})",
    rf"({_NUMERIC_DATE})",
    rf"({_WORD_DATE})",
)
GST = (
    rf"GSTIN[\s:]*({_GSTIN}|[A-Z0-9]{{15}})",
    rf"GST\s*(?:NO|NUMBER)[\s:]*({_GSTIN}|[A-Z0-9]{{15}})",
    rf"TAX\s*(?:ID|NUMBER)[\s:]*({_GSTIN}|[A-Z0-9]{{15}})",
    rf"({_GSTIN})",
)
PO_NUMBER = (
    rf"po\s*(?:no|number)[\s:]*({_W}+)",
    rf"purchase\s*order[\s:]*({_W}+)",
    rf"order\s*(?:no|number)[\s:]*({_W}+)",
    rf"ref\s*(?:no|number)[\s:]*({_W}+)",
)
AMOUNT = (
    r"total[\s:]*(?:amount)?[\s:]*(?:rs\.?|₹)?\s*([0-9,]+\.?[0-9]*)",
    r"grand\s*total[\s:]*(?:rs\.?|₹)?\s*([0-9,]+\.?[0-9]*)",
    r"final\s*amount[\s:]*(?:rs\.?|₹)?\s*([0-9,]+\.?[0-9]*)",
    r"net\s*amount[\s:]*(?:rs\.?|₹)?\s*([0-9,]+\.?[0-9]*)",
)
_AMOUNT = r"[\s:]*(?:rs\.?|₹|inr)?\s*([0-9][0-9,]*\.?[0-9]*)"
_RATE = r"\s*(?:\(?@?\s*[0-9]+\.?[0-9]*\s*%\s*\)?)?"
SUMS = {
    "subtotal": (rf"sub\s*-?\s*total(?:\s*amount)?{_AMOUNT}", rf"taxable\s*(?:amount|value){_AMOUNT}"),
    "total_discount": (rf"discount{_RATE}{_AMOUNT}",),
    "total_gst": (rf"total\s*gst{_RATE}{_AMOUNT}", rf"gst\s*amount{_AMOUNT}", rf"total\s*tax{_AMOUNT}", rf"tax\s*amount{_AMOUNT}"),
}
GST_PARTS = tuple(rf"{p}gst{_RATE}{_AMOUNT}" for p in ("c", "s", "i"))
_STATED = r"\s*\(?\s*@?\s*([0-9]+\.?[0-9]*)\s*%"
GST_RATES = (rf"(?:^|[^csi])gst{_STATED}", rf"igst{_STATED}", rf"cgst{_STATED}", rf"sgst{_STATED}")
#: Labels of other sums that hold the word total.
NOT_THE_TOTAL = r"sub\s*-?\s*total|total\s*(?:discount|gst|tax)"
ADDRESS_STARTS = ("ship to", "shipping address", "deliver to", "delivery address", "bill to", "billing address", "address", "consignee")
ADDRESS_ENDS = ("phone", "tel", "mobile", "email", "website", "gstin", "gst", "invoice", "bill", "date", "po number", "order")
ADDRESS_LINES = 5
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DATES_IN_TEXT = (
    r"\b([0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4})\b",
    r"\b([0-9]{2,4}[/-][0-9]{1,2}[/-][0-9]{1,2})\b",
    r"(?i)\b[0-9]{1,2}\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+[0-9]{2,4}\b",
    r"(?i)\b(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+[0-9]{1,2},?\s+[0-9]{2,4}\b",
)
GST_TO_NORMALISE = r"^[0-9]{2}[A-Z0-9]{10}[A-Z][0-9][A-Z][0-9A-Z]\z"
FORMATS = {
    "invoice_number": r"^[A-Z0-9\-/]{3,20}\z",
    "gst_number": r"^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]\z",
    "pan_number": r"^[A-Z]{5}[0-9]{4}[A-Z]\z",
    "pincode": r"^[1-9][0-9]{5}\z",
    "phone": r"^[6-9][0-9]{9}\z",
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z",
}


def _found(text: Column, pattern: str) -> Column:
    """Group 1 of all matches of one pattern, which has no alternatives outside of groups. A text
    without the letters that the pattern begins with is not searched."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    start = re.match("(?:[A-Za-z](?![*?{]))*", pattern)[0]
    return F.when(F.contains(text, F.lit(start)), found).otherwise(F.array().cast("array<string>")) if start else found


def matches(text: Column, patterns: Sequence[str]) -> Column:
    """Group 1 of all matches, by pattern, then by position."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*[_found(text, p) for p in patterns])


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def first_match(text: Column, patterns: Sequence[str], read: Callable[[Column], Column]) -> Column:
    """The first match that ``read`` makes something of. Later patterns are tried only if earlier
    ones give nothing."""
    text = F.coalesce(text, F.lit(""))

    def of(pattern: str) -> Column:
        found = F.transform(_found(text, pattern), read)
        return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))

    return F.coalesce(*[of(p) for p in patterns])


def _long_enough(x: Column) -> Column:
    return F.when(F.length(x) > 2, x)


def invoice_number(text: Column, low: Column | None = None) -> Column:
    """``low`` is the text in lower case, where it is at hand; the same below."""
    return F.upper(first_match(F.lower(text) if low is None else low, INVOICE_NUMBER, _long_enough))


def po_number(text: Column, low: Column | None = None) -> Column:
    return F.upper(first_match(F.lower(text) if low is None else low, PO_NUMBER, _long_enough))


def total_amount(text: Column, low: Column | None = None) -> Column:
    """The first amount after a total label, as text. "Subtotal" holds such a label too."""
    return first_match(F.lower(text) if low is None else low, AMOUNT, clean_amount)


def final_total(text: Column, low: Column | None = None) -> Column:
    """As ``total_amount``, but labels of other sums (a subtotal, a total of discounts or taxes) are no total labels."""
    return first_match(F.regexp_replace(F.lower(text) if low is None else low, NOT_THE_TOTAL, "#"), AMOUNT, clean_amount)


def sums(text: Column, low: Column | None = None) -> dict[str, Column]:
    """subtotal, total_discount and total_gst, each the first amount after one of its labels, as text, and gst_rate, the
    percentage that stands with a GST label. Without labels of their own, GST and its rate are the sums of their parts."""
    low = F.lower(text) if low is None else low
    out = {name: first_match(low, patterns, clean_amount) for name, patterns in SUMS.items()}

    def from_parts(own: Column) -> Column:
        parts = [first_match(own, (p,), clean_amount).try_cast("decimal(18,4)") for p in GST_PARTS]
        zero = F.lit(0).cast("decimal(18,4)")
        added = sum((F.coalesce(p, zero) for p in parts[1:]), F.coalesce(parts[0], zero))
        return F.when(F.coalesce(*parts).isNotNull(), added.cast("string"))

    whole, *parts = [first_match(low, (p,), clean_amount).try_cast("decimal(8,4)") for p in GST_RATES]
    zero = F.lit(0).cast("decimal(8,4)")
    added = F.when(F.coalesce(*parts).isNotNull(), sum((F.coalesce(p, zero) for p in parts[1:]), F.coalesce(parts[0], zero)))
    return out | {"total_gst": F.coalesce(out["total_gst"], from_parts(low)), "gst_rate": F.coalesce(whole, added).cast("string")}


def gstin_is_valid(value: Column) -> Column:
    return value.rlike(rf"^{_GSTIN}\z")


def gst_numbers(text: Column, distinct: bool = False) -> Column:
    """All valid GST numbers; one behind a label is found by its label and by its form."""
    found = let(F.upper(text), lambda up: F.filter(matches(up, GST), gstin_is_valid))
    return F.array_distinct(found) if distinct else found


def invoice_date(text: Column, low: Column | None = None) -> Column:
    """The first date that can be read, as an ISO date string."""
    return first_match(F.lower(text) if low is None else low, DATE, normalise_date)


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-M-d")


def normalise_date(text: Column) -> Column:
    """ISO date string of day-month-year, else month-day-year, else a date with an English month
    name; null for anything else. Years of two digits are 1969 to 2068."""
    part = lambda p, i: F.get(p, F.lit(i))

    def numeric(p: Column) -> Column:
        y = part(p, 2)
        year = F.when(F.length(y) == 4, y).when(y >= "69", F.concat(F.lit("19"), y)).otherwise(F.concat(F.lit("20"), y))
        return F.coalesce(_date(year, part(p, 1), part(p, 0)), _date(year, part(p, 0), part(p, 1)))

    def named(p: Column, day: int, name: int) -> Column:
        full, short = F.array(*map(F.lit, MONTHS)), F.array(*[F.lit(m[:3]) for m in MONTHS])
        month = F.greatest(F.array_position(full, part(p, name)), F.array_position(short, part(p, name)))
        return F.when(month > 0, _date(part(p, 2), month.cast("string"), part(p, day)))

    def read(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^[0-9]{1,2}(/[0-9]{1,2}/|-[0-9]{1,2}-)([0-9]{4}|[0-9]{2})\z"), let(F.split(s, "[-/]"), numeric))
            .when(s.rlike(r"^[0-9]{1,2} [a-z]+ [0-9]{4}\z"), let(F.split(s, " "), lambda p: named(p, 0, 1)))
            .when(s.rlike(r"^[a-z]+ [0-9]{1,2}, [0-9]{4}\z"), let(F.split(s, ",? "), lambda p: named(p, 1, 0)))
        )

    return F.date_format(let(F.lower(F.regexp_replace(F.trim(text), r"\s+", " ")), read), "yyyy-MM-dd")


def ends_address(line: Column) -> Column:
    low = F.lower(F.trim(line))
    return low.rlike("|".join(ADDRESS_ENDS)) | (F.length(low) < 3)


def shipping_address(text: Column) -> Column:
    """Up to five lines below the first line with an address label, as far as none ends it."""
    first = lambda flags: F.array_position(flags, F.lit(True)).cast("int")

    def below(lines: Column, start: Column) -> Column:
        own = F.slice(lines, start + 1, F.lit(ADDRESS_LINES))
        return let(own, lambda x: let(first(F.transform(x, ends_address)), lambda stop: F.when(stop > 0, F.slice(x, F.lit(1), stop - 1)).otherwise(x)))

    def read(lines: Column) -> Column:
        start = first(F.transform(lines, lambda x: F.lower(x).rlike("|".join(ADDRESS_STARTS))))
        return let(start, lambda at: F.when(at > 0, below(lines, at)))

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))
    return let(let(lines, read), lambda kept: F.when(F.size(kept) > 0, F.array_join(kept, "\n")))


def clean_text(text: Column) -> Column:
    one = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"[^\p{L}\p{N}_\s.\-()\[\]/\\:;,@#]", "")
    return F.coalesce(one, F.lit(""))


def numbers_in(text: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([0-9]+\.?[0-9]*)"), F.lit(1))
    return F.transform(found, lambda x: x.try_cast("double"))


def has_format(value: Column, kind: str) -> Column:
    """Whether a trimmed value has the form of its kind; null for null and empty values."""
    s = F.trim(value.cast("string"))
    return F.when(s != "", s.rlike(FORMATS[kind]))


def is_phone(value: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(value, F.lit("")), r"[^0-9+]", "")
    return bare.rlike(r"^(\+91|91)?[0-9]{10}\z")


def is_email(value: Column) -> Column:
    return F.coalesce(value.rlike(FORMATS["email"]), F.lit(False))


def is_pincode(value: Column) -> Column:
    return F.coalesce(F.trim(value).rlike(r"^[0-9]{6}\z"), F.lit(False))


def near_keyword(text: Column, keyword: str, window: int = 50) -> Column:
    """The text within ``window`` characters of the first keyword, null without it."""
    at = F.locate(keyword.lower(), F.lower(text))
    start = F.greatest(at - window, F.lit(1))
    return F.when(at > 0, F.substring(text, start, at - start + F.lit(len(keyword) + window)))


def beside_label(text: Column, label: str) -> Column:
    """The second column of the first line of a two-column text whose first column is the label."""
    rows = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.split(F.trim(x), r"\s{2,}|\t"))
    hit = F.filter(rows, lambda r: (F.lower(F.get(r, F.lit(0))) == label.lower()) & (F.size(r) > 1))
    return F.get(F.get(hit, F.lit(0)), F.lit(1))


def dates_in(text: Column) -> Column:
    """All dates of a text by four forms, form by form; of dates with a month's name the first three
    letters of that name."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in DATES_IN_TEXT])


def normalise_gst(text: Column) -> Column:
    """Upper case without white space where that has the form of 16 characters, else the text as it is;
    empty for null."""
    bare = F.regexp_replace(F.upper(text), r"\s+", "")
    return F.coalesce(F.when(bare.rlike(GST_TO_NORMALISE), bare).otherwise(text), F.lit(""))


def standard_date(text: Column) -> Column:
    """dd/MM/yyyy of a date in one of the forms of ``normalise_date``, an ISO date, or one with a
    month's name between hyphens; null for anything else."""
    bare = F.trim(text)
    iso = F.when(bare.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), F.try_to_date(bare, "yyyy-M-d"))
    named = F.regexp_replace(bare, r"^([0-9]{1,2})-([A-Za-z]+)-([0-9]{4})\z", "$1 $2 $3")
    return F.date_format(F.coalesce(iso, F.try_to_date(normalise_date(named), "yyyy-MM-dd")), "dd/MM/yyyy")


def pattern_strength(text: Column, pieces: Sequence[str]) -> Column:
    """How far a text follows a pattern given in pieces: 1.0 for a whole match, else the share of
    leading pieces that it begins with, one of them more being counted for what follows a whole match."""
    n = len(pieces)
    out = F.when(text.rlike("^" + "".join(pieces) + r"\z"), 1.0).when(text.rlike("^" + "".join(pieces)), n / (n + 1))
    for k in range(n - 1, 0, -1):
        out = out.when(text.rlike("^" + "".join(pieces[:k])), k / n)
    return out.otherwise(0.0)


def nested_get(json: Column, keys: Sequence[str], default: str | None = None) -> Column:
    """The value at a path of keys in a JSON text, as text; the default where a key or its value is missing."""
    path = "$" + "".join(f"['{k}']" for k in keys)
    return F.coalesce(F.get_json_object(json, path), F.lit(default).cast("string"))
