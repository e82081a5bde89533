"""Shapes of results: nested invoice documents, sheets, verification reports, flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import safe_float

ITEM_COLUMNS = ("description", "hsn_code", "quantity", "unit_price", "total_amount", "gst_rate", "gst_amount")


def _or_default(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default).alias(name) if name in df.columns else default.alias(name)


def item_rows(items: DataFrame) -> DataFrame:
    """doc_id, line_no and the seven item columns with defaults."""
    text = [_or_default(items, c, F.lit("")) for c in ITEM_COLUMNS[:2]]
    numbers = [(safe_float(F.col(c)) if c in items.columns else F.lit(0.0)).alias(c) for c in ITEM_COLUMNS[2:]]
    return items.select("doc_id", "line_no", *text, *numbers)


def invoice_documents(invoices: DataFrame, items: DataFrame, extracted_at: str = "") -> DataFrame:
    """One nested record per invoice: invoice_info, line_items, totals, seals_signatures, metadata."""
    cell = F.struct("line_no", F.struct(*ITEM_COLUMNS).alias("item"))
    lists = item_rows(items).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(cell)), lambda s: s["item"]).alias("line_items"))
    kind = lists.schema["line_items"].dataType.simpleString()
    joined = invoice_heads(invoices, extracted_at).join(lists, "doc_id", "left")
    return joined.select("doc_id", "invoice_info", F.coalesce("line_items", F.array().cast(kind)).alias("line_items"), "totals", "seals_signatures", "metadata")


def invoice_heads(invoices: DataFrame, extracted_at: str = "") -> DataFrame:
    """The nested records without their line items."""
    d = invoices
    text = lambda *names: [_or_default(d, n, F.lit("")) for n in names]
    number = lambda n: (safe_float(F.col(n)) if n in d.columns else F.lit(0.0)).alias(n)
    return d.select(
        "doc_id",
        F.struct(*text("invoice_number", "invoice_date", "po_number", "vendor_name", "vendor_gst", "buyer_name", "buyer_gst", "shipping_address")).alias("invoice_info"),
        F.struct(number("subtotal"), number("discount"), number("total_gst"), number("final_total")).alias("totals"),
        F.struct(
            _or_default(d, "seals_detected", F.lit(False)).alias("detected"), _or_default(d, "seal_count", F.lit(0)).alias("count"),
            _or_default(d, "seal_file_paths", F.array().cast("array<string>")).alias("file_paths"),
        ).alias("seals_signatures"),
        F.struct(
            F.lit(extracted_at).alias("extraction_timestamp"), _or_default(d, "source_file", F.lit("")), _or_default(d, "total_pages", F.lit(1)),
            _or_default(d, "processing_time", F.lit(0.0)),
        ).alias("metadata"),
    )


def _unpivot(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """(doc_id, pos, then one column for each part of a row) from literal labels and columns."""
    cells = F.array(*[F.struct(F.lit(i).alias("pos"), *[c.cast("string").alias(f"c{j}") for j, c in enumerate(r)]) for i, r in enumerate(rows)])
    return df.select("doc_id", F.explode(cells).alias("r")).select("doc_id", "r.*")


def summary_sheet(documents: DataFrame) -> DataFrame:
    """The field and value rows of the summary sheet, by position; ``invoice_heads`` are enough."""
    f, blank = F.col, F.lit("")
    i, t, m = "invoice_info", "totals", "metadata"
    rows = [
        ("Field", F.lit("Value")),
        ("Invoice Number", f(f"{i}.invoice_number")), ("Invoice Date", f(f"{i}.invoice_date")), ("PO Number", f(f"{i}.po_number")),
        ("Vendor Name", f(f"{i}.vendor_name")), ("Vendor GST", f(f"{i}.vendor_gst")), ("Buyer Name", f(f"{i}.buyer_name")), ("Buyer GST", f(f"{i}.buyer_gst")),
        ("", blank), ("Financial Summary", blank),
        ("Subtotal", f(f"{t}.subtotal")), ("Discount", f(f"{t}.discount")), ("Total GST", f(f"{t}.total_gst")), ("Final Total", f(f"{t}.final_total")),
        ("", blank), ("Processing Info", blank),
        ("Extraction Date", f(f"{m}.extraction_timestamp")), ("Source File", f(f"{m}.source_file")), ("Total Pages", f(f"{m}.total_pages")),
    ]
    return _unpivot(documents, [(F.lit(k), v) for k, v in rows]).withColumnsRenamed({"c0": "field", "c1": "value"})


def verification_sheet(results: DataFrame) -> DataFrame:
    """Check rows with PASS or FAIL; a check that was not made counts as passed."""
    ok = lambda c: F.when(_or_default(results, c, F.lit(True)), "PASS").otherwise("FAIL")
    seals = _or_default(results, "seals_detected", F.lit(False))
    rows = [
        (F.lit("Overall Confidence"), F.lit("INFO"), _or_default(results, "overall_confidence", F.lit(0.0))),
        (F.lit("Line Item Calculations"), ok("line_item_calc_valid"), F.lit("")),
        (F.lit("Subtotal Verification"), ok("subtotal_valid"), F.lit("")),
        (F.lit("Total Verification"), ok("total_valid"), F.lit("")),
        (F.lit("Seals Detected"), F.when(seals, "YES").otherwise("NO"), _or_default(results, "signature_count", F.lit(0))),
    ]
    return _unpivot(results, rows).withColumnsRenamed({"c0": "item", "c1": "status", "c2": "value"})


def verification_report(results: DataFrame, reported_at: str = "") -> DataFrame:
    """One nested report per document; what ``results`` lacks gets a default."""
    d = lambda name, default: _or_default(results, name, F.lit(default))
    none = F.array().cast("array<string>")
    many = lambda name: _or_default(results, name, none)
    scores = [d(f"{n}_confidence", 0.0).alias(n) for n in ("invoice_number", "invoice_date", "vendor_info", "line_items", "totals")]
    return results.select(
        "doc_id",
        d("overall_confidence", 0.0),
        d("verification_status", "PENDING"),
        F.lit(reported_at).alias("timestamp"),
        F.struct(*scores).alias("field_confidence_scores"),
        F.struct(
            d("line_item_calc_valid", True).alias("line_item_calculations"), d("subtotal_valid", True).alias("subtotal_verification"),
            d("total_valid", True).alias("total_verification"), d("gst_calc_valid", True).alias("gst_calculations"),
        ).alias("mathematical_verification"),
        F.struct(many("missing_fields"), many("low_confidence_fields"), many("calculation_errors"), many("format_issues")).alias("data_quality_flags"),
        F.struct(d("seals_detected", False), d("signature_count", 0), d("authenticity_score", 0.0)).alias("seal_signature_verification"),
        many("recommendations"),
        F.struct(d("ocr_engine", ""), d("processing_time", 0.0), d("image_quality_score", 0.0)).alias("processing_metadata"),
    )


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as flat columns, their names joined."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, (*path, field.name))
            else:
                yield (*path, field.name)

    return df.select(*[F.col(".".join(f"`{x}`" for x in p)).alias(separator.join(p)) for p in leaves(df.schema, ())])


def drop_empty(values: Column) -> Column:
    """A map without null and empty values."""
    return F.map_filter(values, lambda _, v: v.isNotNull() & (v != ""))


def column_widths(df: DataFrame, most: int = 50) -> DataFrame:
    """Display width of each column: its longest value plus 2, at most ``most``."""
    longest = [F.max(F.length(F.col(c).cast("string"))).alias(c) for c in df.columns]
    wide = df.agg(*longest)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.least(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c))) + 2, F.lit(most)).alias("width")) for c in df.columns])
    return wide.select(F.explode(cells).alias("r")).select("r.*")


def write_outputs(documents: DataFrame, report: DataFrame, folder: str, checks: DataFrame | None = None) -> dict[str, str]:
    """Nested documents and reports as JSON lines, sheets (with ``checks``, that of verification too)
    as CSV; the folders written."""
    paths = {k: f"{folder}/{k}" for k in ("json", "report", "invoice_summary", "line_items")}
    documents.write.mode("overwrite").json(paths["json"])
    report.write.mode("overwrite").json(paths["report"])
    summary_sheet(documents).write.mode("overwrite").option("header", True).csv(paths["invoice_summary"])
    rows = documents.select("doc_id", F.posexplode("line_items").alias("line_no", "i")).select("doc_id", "line_no", "i.*")
    rows.write.mode("overwrite").option("header", True).csv(paths["line_items"])
    if checks is not None:
        paths["verification"] = f"{folder}/verification"
        checks.write.mode("overwrite").option("header", True).csv(paths["verification"])
    return paths
