"""Verification of extracted invoices: arithmetic, tax, formats, dates, and what follows.

Every check ends as rows (doc_id, check, ordinal, is_valid, errors, warnings); flags aggregate
them. Amounts are exact decimals. A difference above the tolerance is an error, one above half
of it a warning. What a check finds is a pair of column expressions, errors and warnings; all
checks of an invoice read one row, the invoice joined to one aggregate of its items.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import hsn_is_valid, parse_decimal
from ..functions.scores import category
from ..functions.text import FORMATS, has_format

TOLERANCE = Decimal("0.01")
CENT = Decimal("0.01")
CHECK = ("doc_id", "check", "ordinal", "is_valid", "errors", "warnings")


def _none() -> Column:
    return F.array().cast("array<string>")


def _listed(*messages: Column) -> Column:
    return F.array_compact(F.array(*messages))


def _band(difference: Column, tolerance: Decimal, what: str) -> tuple[Column, Column]:
    """The error and the warning of a difference, each null if there is none."""
    error = F.when(difference > F.lit(tolerance), F.concat(F.lit(f"{what} is off by "), difference.cast("string")))
    minor = (difference > F.lit(tolerance / 2)) & (difference <= F.lit(tolerance))
    return error, F.when(minor, F.concat(F.lit(f"{what} is slightly off by "), difference.cast("string")))


def check_items(items: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """``items`` with expected, difference, is_valid, errors and warnings for each row.

    Expected is quantity times price, less the discount (in percent or as an amount). Missing
    numbers are warnings; a discount that can't be read is an error, as is a wrong total.
    """
    quantity, price = parse_decimal(F.col("quantity")), parse_decimal(F.col("unit_price"))
    total, discount = parse_decimal(F.col("total_amount")), parse_decimal(F.col("discount"))
    known = quantity.isNotNull() & price.isNotNull()
    gross = quantity * price
    less = (
        F.when(discount <= 0, gross.cast("decimal(38,6)"))
        .when(F.col("discount_type") == "percentage", (gross * (100 - discount) * F.lit(CENT)).cast("decimal(38,6)"))
        .otherwise((gross - discount).cast("decimal(38,6)"))
    )
    expected = F.when(known & discount.isNotNull(), less)
    difference = F.abs(F.col("expected") - total)
    error, minor = _band(F.col("difference"), tolerance, "total")
    unreadable = F.when(known & discount.isNull(), F.lit("discount can't be read"))
    hsn = F.nullif(F.trim("hsn_code"), F.lit(""))
    return (
        items.withColumn("expected", expected)
        .withColumn("difference", difference)
        .withColumn("errors", _listed(error, unreadable))
        .withColumn(
            "warnings",
            _listed(
                minor,
                F.when(~known, F.lit("quantity or unit price is missing")),
                F.when(known & discount.isNotNull() & total.isNull(), F.lit("total is missing")),
                F.when(hsn.isNotNull() & ~hsn_is_valid(hsn), F.concat(F.lit("HSN code has no known form: "), hsn)),
            ),
        )
        .withColumn("is_valid", F.size("errors") == 0)
    )


def _item_findings(items: DataFrame, tolerance: Decimal) -> DataFrame:
    numbered = lambda c: F.transform(F.col(c), lambda m: F.concat(F.lit("Item "), F.col("line_no"), F.lit(": "), m))
    return check_items(items, tolerance).withColumns({"_e": numbered("errors"), "_w": numbered("warnings")})


def _gathered(c: str) -> Column:
    return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line_no", c))), lambda s: s[c]))


def items_check(items: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """The check of all items per document, with the numbers of rows and of valid rows."""
    return _item_findings(items, tolerance).groupBy("doc_id").agg(
        F.lit("line_items").alias("check"),
        F.lit(1).alias("ordinal"),
        F.bool_and("is_valid").alias("is_valid"),
        _gathered("_e").alias("errors"),
        _gathered("_w").alias("warnings"),
        F.count(F.lit(1)).alias("n_items"),
        F.count_if("is_valid").alias("n_valid"),
    )


def _read(name: str) -> Column:
    """An amount of the invoice, null if it can't be read."""
    return parse_decimal(F.col(name))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(Decimal("0")))


def _item_totals() -> list[Column]:
    """Aggregates of an invoice's items: the sum of readable totals, how many can't be read, and the GST
    of those whose rate can be read too."""
    total, rate = _read("total_amount"), _read("gst_rate")
    return [
        F.sum(total).alias("items_total"),
        F.count_if(total.isNull()).alias("n_unread"),
        F.sum((total * rate * F.lit(CENT)).cast("decimal(28,6)")).alias("items_gst"),
    ]


def _subtotal_findings(calculated: Column, extracted: Column, n_unread: Column, tolerance: Decimal) -> tuple[Column, Column]:
    error, minor = _band(F.abs(calculated - extracted), tolerance, "subtotal")
    unread = F.transform(F.sequence(F.lit(1).cast("long"), n_unread), lambda i: F.lit("an item's total can't be read"))
    return _listed(error), F.concat(F.when(n_unread > 0, unread).otherwise(_none()), _listed(minor, F.when(extracted.isNull(), F.lit("subtotal can't be read"))))


def _total_findings(calculated: Column, extracted: Column, tolerance: Decimal) -> tuple[Column, Column]:
    error, minor = _band(F.abs(calculated - extracted), tolerance, "final total")
    return _listed(error), _listed(minor, F.when(extracted.isNull(), F.lit("final total can't be read")))


def _gst_findings(calculated: Column, extracted: Column, tolerance: Decimal) -> tuple[Column, Column]:
    """Only an error band."""
    return _listed(_band(F.abs(calculated - extracted), tolerance, "GST")[0]), _none()


def _check_rows(rows: DataFrame, name: str, ordinal: int, findings: tuple[Column, Column], *more: str) -> DataFrame:
    found = rows.select("*", findings[0].alias("errors"), findings[1].alias("warnings"))
    return found.select("doc_id", F.lit(name).alias("check"), F.lit(ordinal).alias("ordinal"), (F.size("errors") == 0).alias("is_valid"), "errors", "warnings", *more)


def _compared(rows: DataFrame, calculated: Column, extracted: Column, *more: str) -> DataFrame:
    own = rows.select("doc_id", calculated.alias("calculated"), extracted.alias("extracted"), *more)
    return own.withColumn("difference", F.abs(F.col("calculated") - F.col("extracted")))


_CALCULATED, _EXTRACTED = "calculated", "extracted"


def check_subtotal(items: DataFrame, invoices: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """Sum of readable item totals against the invoice's subtotal."""
    sums = items.groupBy("doc_id").agg(*_item_totals()[:2])
    joined = invoices.select("doc_id", "subtotal").join(sums, "doc_id", "left").withColumn("n_unread", F.coalesce("n_unread", F.lit(0)))
    rows = _compared(joined, _or_zero(F.col("items_total")), _read("subtotal"), "n_unread")
    found = _subtotal_findings(F.col(_CALCULATED), F.col(_EXTRACTED), F.col("n_unread"), tolerance)
    return _check_rows(rows, "subtotal", 2, found, "calculated", "extracted", "difference")


def _final_total(other_charges: Decimal) -> Column:
    return _or_zero(_read("subtotal")) - _or_zero(_read("total_discount")) + _or_zero(_read("total_gst")) + F.lit(other_charges)


def check_final_total(invoices: DataFrame, tolerance: Decimal = TOLERANCE, other_charges: Decimal = Decimal("0")) -> DataFrame:
    """Subtotal less discount plus GST plus other charges against the final total; parts that
    can't be read count 0."""
    rows = _compared(invoices, _final_total(other_charges), _read("total_amount"))
    found = _total_findings(F.col(_CALCULATED), F.col(_EXTRACTED), tolerance)
    return _check_rows(rows, "final_total", 3, found, "calculated", "extracted", "difference")


def gst_by_rate(items: DataFrame) -> DataFrame:
    """Taxable amount, GST and item numbers per document and rate; unreadable items are left out."""
    rows = items.select("doc_id", "line_no", parse_decimal(F.col("gst_rate")).alias("gst_rate"), parse_decimal(F.col("total_amount")).alias("taxable"))
    known = rows.where(F.col("gst_rate").isNotNull() & F.col("taxable").isNotNull())
    return known.groupBy("doc_id", "gst_rate").agg(
        F.sum("taxable").alias("taxable_amount"),
        F.sum((F.col("taxable") * F.col("gst_rate") * F.lit(CENT)).cast("decimal(28,6)")).alias("gst_amount"),
        F.sort_array(F.collect_list("line_no")).alias("items"),
    )


def check_gst(items: DataFrame, invoices: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """GST over all rates against the invoice's; only an error band."""
    sums = items.groupBy("doc_id").agg(_item_totals()[2])
    joined = invoices.select("doc_id", "total_gst").join(sums, "doc_id", "left")
    rows = _compared(joined, _or_zero(F.col("items_gst")), _or_zero(_read("total_gst")))
    return _check_rows(rows, "gst", 5, _gst_findings(F.col(_CALCULATED), F.col(_EXTRACTED), tolerance), "calculated", "extracted", "difference")


def gst_components(rows: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """Per component (cgst, sgst, igst): rate times subtotal against the amount. Columns
    ``<component>_rate`` and ``<component>_amount`` beside doc_id and subtotal."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("component"), parse_decimal(F.col(f"{c}_rate")).alias("rate"), parse_decimal(F.col(f"{c}_amount")).alias("amount"))
        for c in ("cgst", "sgst", "igst")
    ])
    long = rows.select("doc_id", parse_decimal(F.col("subtotal")).alias("s"), F.explode(cells).alias("c")).select("doc_id", "s", "c.*").where("rate IS NOT NULL")
    calculated = (F.col("s") * F.col("rate") * F.lit(CENT)).cast("decimal(28,6)")
    return long.select(
        "doc_id", "component", calculated.alias("calculated"), "amount", (F.abs(calculated - F.coalesce("amount", F.lit(Decimal("0")))) <= F.lit(tolerance)).alias("check_passed")
    )


def date_findings(as_of: str) -> tuple[list[Column], list[Column]]:
    """Errors and warnings on invoice_date and due_date, checked only where both are present."""
    first, due = F.try_to_date("invoice_date", "yyyy-MM-dd"), F.try_to_date("due_date", "yyyy-MM-dd")
    now = F.lit(as_of).cast("date")
    both = (F.coalesce("invoice_date", F.lit("")) != "") & (F.coalesce("due_date", F.lit("")) != "")
    read = both & first.isNotNull() & due.isNotNull()
    errors = [F.when(both & ~read, F.lit("dates can't be read"))]
    warnings = [
        F.when(read & (due < first), F.lit("due date is before the invoice date")),
        F.when(read & (first > F.date_add(now, 30)), F.lit("invoice date is more than 30 days ahead")),
        F.when(read & (first < F.date_sub(now, 3650)), F.lit("invoice date is more than 10 years back")),
    ]
    return errors, warnings


def amount_findings() -> list[Column]:
    subtotal, total, gst = (parse_decimal(F.col(c)) for c in ("subtotal", "total_amount", "total_gst"))
    return [
        F.when(subtotal < 0, F.lit("subtotal is negative")),
        F.when(total < 0, F.lit("total is negative")),
        F.when(gst < 0, F.lit("GST is negative")),
        F.when((total > 0) & (total < subtotal * F.lit(Decimal("0.5"))), F.lit("total is under half of the subtotal")),
    ]


def _format_findings(columns: list[str], as_of: str) -> tuple[Column, Column]:
    wrong = [F.when(~has_format(F.col(c), c), F.concat(F.lit(f"{c} has a wrong form: "), F.col(c))) for c in FORMATS if c in columns]
    errors, warnings = date_findings(as_of)
    return _listed(*wrong, *errors), _listed(*warnings, *amount_findings())


def check_formats(invoices: DataFrame, as_of: str) -> DataFrame:
    """Identifiers by their forms, dates and amounts by their logic."""
    return _check_rows(invoices, "formats", 4, _format_findings(invoices.columns, as_of))


def all_checks(items: DataFrame, invoices: DataFrame, as_of: str, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """The five checks of every invoice as rows; without items there is nothing wrong with them.

    One aggregate over the items, one join to the invoices, and all checks as one array of structs."""
    sums = _item_findings(items, tolerance).groupBy("doc_id").agg(_gathered("_e").alias("_errors"), _gathered("_w").alias("_warnings"), *_item_totals())
    rows = invoices.join(sums, "doc_id", "left")
    total = _final_total(Decimal("0"))
    found = {
        "line_items": (F.coalesce("_errors", _none()), F.coalesce("_warnings", _none())),
        "subtotal": _subtotal_findings(_or_zero(F.col("items_total")), _read("subtotal"), F.coalesce("n_unread", F.lit(0).cast("long")), tolerance),
        "final_total": _total_findings(total, _read("total_amount"), tolerance),
        "formats": _format_findings(invoices.columns, as_of),
        "gst": _gst_findings(_or_zero(F.col("items_gst")), _or_zero(_read("total_gst")), tolerance),
    }
    cells = [F.struct(F.lit(k).alias("check"), F.lit(i).alias("ordinal"), e.alias("errors"), w.alias("warnings")) for i, (k, (e, w)) in enumerate(found.items(), 1)]
    out = rows.select("doc_id", F.explode(F.array(*cells)).alias("c")).select("doc_id", "c.*")
    return out.withColumn("is_valid", F.size("errors") == 0).select(*CHECK)


def flags(checks: DataFrame) -> DataFrame:
    """Status, recommendation and confidence per document. Errors of valid checks don't count;
    calculations_valid is that of the last of subtotal and final_total."""
    errors = F.when(~F.col("is_valid"), F.size("errors")).otherwise(0)
    of = lambda *names: F.max_by(F.when(F.col("check").isin(*names), F.col("is_valid")), F.when(F.col("check").isin(*names), F.col("ordinal")))
    rows = checks.groupBy("doc_id").agg(
        F.sum(errors).alias("n_errors"),
        F.sum(F.size("warnings")).alias("n_warnings"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if("is_valid").alias("n_passed"),
        *[F.coalesce(of(*names), F.lit(False)).alias(out) for out, names in (
            ("line_items_valid", ("line_items",)), ("calculations_valid", ("subtotal", "final_total")), ("formats_valid", ("formats",)), ("gst_valid", ("gst",)),
        )],
    )
    e, w = F.col("n_errors"), F.col("n_warnings")
    score = F.col("n_passed") / F.col("n_checks") - F.least(e * 0.1, F.lit(0.5)) - F.least(w * 0.02, F.lit(0.2))
    status = (
        F.when((e == 0) & (w == 0), "valid").when((e == 0) & (w <= 3), "valid_with_warnings").when(e == 0, "questionable")
        .when(e <= 2, "invalid_minor").otherwise("invalid_major")
    )
    advice = (
        F.when((e == 0) & (w == 0), "approved").when((e == 0) & (w <= 3), "approved_with_review")
        .when(e <= 2, "manual_review_required").otherwise("rejected")
    )
    return rows.withColumns({"confidence_score": F.round(F.greatest(F.lit(0.0), score), 6), "overall_status": status, "recommendation": advice})


def confidence_report(fields: DataFrame) -> DataFrame:
    """Per document over rows (doc_id, field, confidence): mean, counts and fields by category,
    share of high ones, recommendations."""
    c = F.col("confidence")
    names = lambda k: F.sort_array(F.collect_list(F.when(category(c) == k, F.col("field"))))
    rows = fields.groupBy("doc_id").agg(
        F.avg(c).alias("overall_confidence"),
        F.count(c).alias("total_fields"),
        *[F.count_if(category(c) == k).alias(f"{k}_count") for k in ("high", "medium", "low")],
        *[names(k).alias(f"{k}_fields") for k in ("high", "medium", "low")],
    )
    share = F.col("high_count") / F.col("total_fields") * 100
    return rows.withColumn("high_percentage", share).withColumn(
        "recommendations",
        _listed(
            F.when(F.col("overall_confidence") < 0.5, F.lit("Overall confidence is low; review by hand."))
            .when(F.col("overall_confidence") < 0.7, F.lit("Overall confidence is moderate; review critical fields.")),
            F.when(F.size("low_fields") > 0, F.concat(F.lit("Low confidence: "), F.array_join("low_fields", ", "))),
            F.when(share < 50, F.lit("Fewer than half of the fields have high confidence; process a better image.")),
        ),
    )


def with_ocr_confidence(fields: DataFrame, ocr: DataFrame) -> DataFrame:
    """Fields with their category and, where there is one, the OCR confidence of the same name."""
    return fields.join(ocr.select("doc_id", "field", F.col("confidence").alias("ocr_confidence")), ["doc_id", "field"], "left").withColumn(
        "category", category(F.col("confidence"))
    )


def missing_fields(fields: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Per document the required fields without a value, in the order required."""
    present = F.collect_set(F.when(F.col("value").isNotNull(), F.col("field")))
    wanted = F.array(*map(F.lit, required))
    return fields.groupBy("doc_id").agg(present.alias("p")).select("doc_id", F.array_except(wanted, "p").alias("missing"))


def likely_ocr_errors(items: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Items with a confidence below the threshold, and which; ``confidence_scores`` is a map."""
    low = F.map_filter("confidence_scores", lambda _, v: v < threshold)
    return items.withColumn("low_fields", F.sort_array(F.map_keys(low))).where(F.size("low_fields") > 0)


def integrity_score(checks: DataFrame) -> DataFrame:
    """Share of passed checks per document."""
    return checks.groupBy("doc_id").agg((F.count_if("is_valid") / F.count(F.lit(1))).alias("data_integrity_score"))


def verification_score(parts: Mapping[str, Column]) -> Column:
    """Mean of the given scores."""
    return sum(parts.values(), F.lit(0.0)) / len(parts)


def passed_flags(checks: DataFrame) -> DataFrame:
    """Per document which groups of checks passed, and the names of those that failed, in their order."""
    of = lambda *names: F.bool_and(F.when(F.col("check").isin(*names), F.col("is_valid")))
    failed = F.array_sort(F.collect_list(F.when(~F.col("is_valid"), F.struct("ordinal", "check"))))
    return checks.groupBy("doc_id").agg(
        F.coalesce(of("line_items"), F.lit(True)).alias("all_line_items_verified"),
        F.coalesce(of("subtotal", "final_total"), F.lit(True)).alias("totals_verified"),
        F.bool_and("is_valid").alias("overall_verification_passed"),
        F.transform(failed, lambda s: s["check"]).alias("failed_checks"),
    )


def sectioned_report(fields: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """Per document the sections of a confidence report. ``fields`` are (doc_id, field, value,
    confidence), ``items`` are (doc_id, line_no, confidence).

    field_verification maps each field to its confidence and presence, line_items_verification
    lists the items' confidences, summary tells whether all fields reach ``least``, their mean, and
    which do not."""
    c = F.col("confidence")
    cell = F.struct("field", F.struct(c.alias("confidence"), F.col("value").isNotNull().alias("present")).alias("v"))
    own = fields.groupBy("doc_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(cell))).alias("field_verification"),
        F.struct(
            F.bool_and(c >= least).alias("all_fields_confident"),
            F.avg(c).alias("average_field_confidence"),
            F.sort_array(F.collect_list(F.when(c < least, F.col("field")))).alias("low_confidence_fields"),
        ).alias("summary"),
    )
    rows = items.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "confidence"))).alias("line_items_verification"))
    none = F.array().cast(rows.schema["line_items_verification"].dataType)
    return own.join(rows, "doc_id", "left").select("doc_id", "field_verification", F.coalesce("line_items_verification", none).alias("line_items_verification"), "summary")


def verification_summary(fields: DataFrame, checks: DataFrame, least: float = 0.8) -> DataFrame:
    """Per document: mean confidence of its fields, whether all checks passed and all fields are
    confident, how many of both are not, and what to do."""
    c = F.col("confidence")
    per = fields.groupBy("doc_id").agg(F.avg(c).alias("overall_confidence"), F.count_if(c < least).alias("_low"))
    rows = per.join(passed_flags(checks), "doc_id", "left")
    failed = F.coalesce(F.size("failed_checks"), F.lit(0))
    return rows.select(
        "doc_id",
        "overall_confidence",
        (F.coalesce("overall_verification_passed", F.lit(True)) & (F.col("_low") == 0)).alias("verification_passed"),
        (failed + F.col("_low")).alias("issues_found"),
        _listed(
            F.when(failed > 0, F.concat(F.lit("Review failed checks: "), F.array_join("failed_checks", ", "))),
            F.when(F.col("_low") > 0, F.lit("Review fields of low confidence.")),
        ).alias("recommendations"),
    )
