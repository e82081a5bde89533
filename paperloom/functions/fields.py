"""Single fields: whether they have their form, where in a text they are sought, which are kept; names of files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# Keywords that stand near a field, forms of dates.
KEYWORDS = {
    "invoice_number": ("invoice number", "invoice no", "inv no", "bill no", "bill number", "receipt no"),
    "invoice_date": ("invoice date", "bill date", "date"),
    "po_number": ("purchase order", "po number", "po no", "order no"),
    "final_total": ("grand total", "final amount", "net amount", "total"),
}
DATE_FORMS = (
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z", "d/M/yyyy"), (r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}\z", "d-M-yyyy"), (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z", "yyyy-M-d"),
    (r"^[0-9]{1,2}-[A-Z][a-z]{2}-[0-9]{4}\z", "d-MMM-yyyy"), (r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}\z", "d MMM yyyy"),
)
READERS = {"invoice_number": X.invoice_number, "invoice_date": X.invoice_date, "po_number": X.po_number, "final_total": X.total_amount}


def date_is_valid(value: Column) -> Column:
    """Whether a text is a day of the calendar in one of the usual forms, day before month."""
    days = [F.when(value.rlike(form), F.try_to_date(value, pattern)) for form, pattern in DATE_FORMS]
    return F.coalesce(*days).isNotNull()


def has_form(value: Column, kind: str) -> Column:
    """Whether a field has its form: ``invoice_number`` (3 to 20 capitals, digits, dashes and slashes, a digit
    among them), ``gst_number``, ``date``, or another kind of ``text.FORMATS``. False for null and empty values."""
    if kind == "date":
        fits = date_is_valid(value)
    elif kind == "invoice_number":
        fits = value.rlike(X.FORMATS[kind]) & value.rlike("[0-9]")
    else:
        fits = value.rlike(X.FORMATS[kind])
    return F.coalesce(fits, F.lit(False))


def in_context(text: Column, field: str, window: int = 50) -> Column:
    """The field as its cascade reads it within ``window`` characters of the first of its keywords that
    leads to one; keywords are tried in order."""
    read = READERS[field]
    return F.coalesce(*[read(X.near_keyword(text, k, window)) for k in KEYWORDS[field]])


def collapsed(text: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def confident(fields: Column, threshold: float = 0.5) -> Column:
    """Of a map of fields (structs with a confidence) those that reach the threshold."""
    return F.map_filter(fields, lambda _, f: F.coalesce(f["confidence"] >= threshold, F.lit(False)))


def extension(path: Column) -> Column:
    """The extension of a path with its dot, in lower case; empty if there is none. A name that begins with its only dot has none."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]*)$", 1))


def is_pdf(path: Column) -> Column:
    return extension(path) == ".pdf"


def output_name(path: Column, suffix: str, kind: str) -> Column:
    """``<name without extension>_<suffix>.<kind>`` of the path's last part."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.concat(F.substring(name, F.lit(1), F.length(name) - F.length(extension(path))), F.lit(f"_{suffix}.{kind}"))


def json_text(record: Column, pretty: bool = True) -> Column:
    """A record as JSON with ISO dates and times; nulls stay as such."""
    return F.to_json(record, {"pretty": str(pretty).lower(), "ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
