"""One query per operator, over invoices derived from the tables (sources.invoices)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money, scores
from ..functions import text as X
from ..operators import imaging, layout, ocr, output, regions, verify
from ..sources import invoices as S
from . import extraction

AS_OF = "1998-12-01"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return S.table(spark, d, name)


def _items(spark, d) -> DataFrame:
    return S.items(_t(spark, d, "lineitem"))


def _invoices(spark, d) -> DataFrame:
    return S.invoices(_t(spark, d, "orders"), _t(spark, d, "lineitem"))


def _blocks(spark, d) -> DataFrame:
    return S.blocks(_t(spark, d, "lineitem"))


def _texts(spark, d) -> DataFrame:
    own = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return S.texts(S.spread(own))


def _double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def _counts() -> list[Column]:
    return [F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings")]


def verify_line_items(spark, d):
    return verify.check_items(_items(spark, d)).select("doc_id", "line_no", *_double("expected", "difference"), "is_valid", *_counts())


def verify_items_by_document(spark, d):
    return verify.items_check(_items(spark, d)).select("doc_id", "is_valid", "n_items", "n_valid", *_counts())


def verify_subtotal(spark, d):
    return verify.check_subtotal(_items(spark, d), _invoices(spark, d)).select("doc_id", "is_valid", *_counts(), *_double("calculated", "extracted", "difference"))


def verify_final_total(spark, d):
    return verify.check_final_total(_invoices(spark, d)).select("doc_id", "is_valid", *_counts(), *_double("calculated", "extracted", "difference"))


def gst_by_rate(spark, d):
    listed = F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items")
    return verify.gst_by_rate(_items(spark, d)).select("doc_id", *_double("gst_rate", "taxable_amount", "gst_amount"), listed)


def verify_gst(spark, d):
    return verify.check_gst(_items(spark, d), _invoices(spark, d)).select("doc_id", "is_valid", *_double("calculated", "extracted", "difference"))


def gst_components(spark, d):
    own = _invoices(spark, d).select("doc_id", "subtotal", (F.col("doc_id") % 2 * 9).cast("string").alias("cgst_rate"), F.lit("9").alias("sgst_rate"), F.when(F.col("doc_id") % 5 == 0, "18").alias("igst_rate"),
        F.lit("100").alias("cgst_amount"), (money.parse_decimal(F.col("subtotal")) * F.lit(9) / F.lit(100)).cast("decimal(18,2)").cast("string").alias("sgst_amount"), F.lit(None).cast("string").alias("igst_amount"))
    return verify.gst_components(own).select("doc_id", "component", *_double("calculated", "amount"), "check_passed")


def validate_formats(spark, d):
    return verify.check_formats(_invoices(spark, d), AS_OF).select("doc_id", "is_valid", *_counts())


def verify_flags(spark, d):
    return extraction.verify_invoices(_items(spark, d), _invoices(spark, d), AS_OF)


def data_integrity(spark, d):
    return verify.integrity_score(verify.all_checks(_items(spark, d), _invoices(spark, d), AS_OF))


def _fields(spark, d) -> DataFrame:
    names = ("invoice_number", "invoice_date", "vendor", "line_items", "totals")
    cells = F.array(*[F.struct(F.lit(n).alias("field"), (((F.col("o_orderkey") * 13 + i * 29) % 101) / 100).alias("confidence")) for i, n in enumerate(names)])
    return _t(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.explode(cells).alias("f")).select("doc_id", "f.*")


def confidence_report(spark, d):
    r = verify.confidence_report(_fields(spark, d))
    return r.select(
        "doc_id", F.round("overall_confidence", 6).alias("overall_confidence"), "total_fields", "high_count", "medium_count", "low_count",
        F.array_join("low_fields", ",").alias("low_fields"), F.round("high_percentage", 6).alias("high_percentage"), F.size("recommendations").alias("n_recommendations"),
    )


def confidence_categories(spark, d):
    c = F.col("confidence")
    return _fields(spark, d).groupBy("field", scores.category(c).alias("category"), scores.grade(c).alias("grade")).agg(F.count(F.lit(1)).alias("n"))


def ocr_confidence_join(spark, d):
    own = _fields(spark, d)
    other = own.where("confidence >= 0.2").select("doc_id", "field", F.round(1 - F.col("confidence"), 2).alias("confidence"))  # OCR finds none of the rest
    return verify.with_ocr_confidence(own, other)


def missing_fields(spark, d):
    own = extraction.long_fields(extraction.header_fields(_texts(spark, d)))
    found = verify.missing_fields(own, ("invoice_number", "invoice_date", "po_number", "vendor_gst", "shipping_address", "final_total"))
    return found.select("doc_id", F.array_join("missing", ",").alias("missing"))


def likely_ocr_errors(spark, d):
    names = ("quantity", "unit_price", "total_amount")
    key = F.col("doc_id") * 17 + F.col("line_no") * 31
    conf = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), (key + i * 37) % 101 / 100)])
    own = _items(spark, d).select("doc_id", "line_no", conf.alias("confidence_scores"))
    return verify.likely_ocr_errors(own).select("doc_id", "line_no", F.array_join("low_fields", ",").alias("low_fields"))


def weighted_confidence(spark, d):
    own = _fields(spark, d).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("field", "confidence"))), lambda s: s["confidence"]).alias("v"))
    weights = F.transform(F.sequence(F.lit(1), F.size("v")), lambda i: i.cast("double"))
    return own.select("doc_id", F.round(scores.weighted_mean(F.col("v"), weights), 6).alias("weighted"), F.round(scores.normalise(F.get("v", F.lit(0)), 0.2, 0.8), 6).alias("normalised"))


def field_confidence(spark, d):
    own = _texts(spark, d)
    found = X.invoice_number(F.col("text"))
    return own.select("doc_id", F.round(scores.field_confidence(found, F.col("doc_id") % 100 / 100), 6).alias("confidence"))


def amounts_parsed(spark, d):
    own = _items(spark, d)
    return own.select(
        "doc_id", "line_no", money.parse_decimal(F.col("unit_price")).cast("double").alias("unit_price"), money.safe_float(F.col("quantity")).alias("quantity"),
        money.parse_number(F.col("hsn_code")).alias("number_in_hsn"), F.coalesce(money.hsn_is_valid(F.col("hsn_code")), F.lit(False)).alias("hsn_is_valid"),
        money.safe_divide(money.safe_float(F.col("total_amount")), money.safe_float(F.col("quantity"))).alias("unit_total"),
    )


def extract_header(spark, d):
    return extraction.header_fields(_texts(spark, d))


def extract_gst_all(spark, d):
    return _texts(spark, d).select("doc_id", F.posexplode(X.gst_numbers(F.col("text"))).alias("pos", "gst_number"))


def normalize_date(spark, d):
    return _texts(spark, d).select("doc_id", X.normalise_date(F.col("date_text")).alias("iso_date"))


def clean_text(spark, d):
    t = F.col("text")
    cleaned = X.clean_text(t)
    return _t(spark, d, "documents").select("doc_id", F.length(cleaned).alias("n_clean"), F.md5(cleaned.cast("binary")).alias("digest"))


def numbers_from_text(spark, d):
    n = X.numbers_in(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.size(n).alias("n_numbers"), F.array_max(n).alias("largest"))


def contact_formats(spark, d):
    return _texts(spark, d).select("doc_id", X.is_email(F.col("email")).alias("email"), X.is_phone(F.col("phone")).alias("phone"), X.is_pincode(F.col("pincode")).alias("pincode"))


def near_keyword(spark, d):
    return _texts(spark, d).select("doc_id", X.near_keyword(F.col("text"), "gstin", 20).alias("context"))


def _ocr_blocks(spark, d) -> DataFrame:
    """Words of pages, by two engines, from the line items."""
    own = _items(spark, d)
    part = F.substring("description", 6, 20).cast("long")
    return own.select(
        "doc_id", (F.col("line_no") % 2 + 1).cast("int").alias("page_number"), F.col("line_no").alias("block_pos"),
        F.when(part % 4 == 0, "two words").otherwise(F.concat(F.lit("w"), part)).alias("text"), (part * 7 % 101 / 100).alias("confidence"),
        (F.col("line_no") * 20 + part % 9).cast("int").alias("x1"), (F.floor(F.col("line_no") / 4) * 30).cast("int").alias("y1"),
        (F.col("line_no") * 20 + part % 9 + 12).cast("int").alias("x2"), (F.floor(F.col("line_no") / 4) * 30 + 20).cast("int").alias("y2"),
        F.when(part % 2 == 0, "tesseract").otherwise("easyocr").alias("engine"),
    )


def filter_by_confidence(spark, d):
    return ocr.confident(_ocr_blocks(spark, d)).select("doc_id", "page_number", "block_pos", "text", "confidence")


def confidence_buckets(spark, d):
    return ocr.buckets(_ocr_blocks(spark, d)).withColumn("average_confidence", F.round("average_confidence", 6))


def blocks_in_region(spark, d):
    own = _ocr_blocks(spark, d)
    asked = own.select("doc_id", "page_number").distinct()
    cells = F.array(*[F.struct(F.lit(i).alias("region_id"), F.lit(x).alias("x1"), F.lit(y).alias("y1"), F.lit(x + 70).alias("x2"), F.lit(y + 25).alias("y2")) for i, (x, y) in enumerate(((0, 0), (60, 20)))])
    return layout.blocks_in_regions(own, asked.withColumn("r", F.explode(cells)).select("doc_id", "page_number", "r.*")).drop("confidence")


def merge_blocks(spark, d):
    return ocr.merge_neighbours(_ocr_blocks(spark, d), 12).withColumn("mean_confidence", F.round("mean_confidence", 6))


def best_engine(spark, d):
    per = ocr.page_results(_ocr_blocks(spark, d), ["doc_id", "page_number", "engine"])
    best = ocr.best_engine(per.withColumn("average_confidence", F.round("average_confidence", 9)), "tesseract")
    return best.select("doc_id", "page_number", "engine", "n_blocks", F.round("average_confidence", 6).alias("average_confidence"), "fallback_used")


def combine_pages(spark, d):
    own = _ocr_blocks(spark, d)
    pages = ocr.page_results(own).withColumn("engine", F.lit("tesseract"))
    out = ocr.combine_pages(pages.withColumn("engine", F.when(F.col("page_number") == 1, "tesseract").otherwise("easyocr")))
    return out.select("doc_id", "combined_text", "total_word_count", F.round("average_confidence", 6).alias("average_confidence"), "total_pages", F.array_join("engines_used", ",").alias("engines_used"))


def table_rows(spark, d):
    return layout.table_rows(_blocks(spark, d)).select("doc_id", "row_no", F.array_join("cells", "|").alias("cells"))


def table_regions_ocr(spark, d):
    return layout.regions_from_headers(_blocks(spark, d)).select("doc_id", "header_pos", "x1", "y1", "x2", "y2", "n_blocks")


def column_roles(spark, d):
    heads = layout.table_rows(_blocks(spark, d)).where("row_no = 0")
    return heads.select("doc_id", F.posexplode("cells").alias("at", "header")).select("doc_id", "at", layout.role(F.col("header")).alias("role"))


def line_items_parsed(spark, d):
    return layout.parse_items(layout.table_rows(_blocks(spark, d))).select("doc_id", "row_no", "description", "hsn_code", "quantity", "unit_price", "total_amount")


def locate_field(spark, d):
    fields = _items(spark, d).select("doc_id", F.concat(F.lit("item_"), "line_no").alias("field"), F.col("description").alias("value"))
    return layout.locate_text(fields, _blocks(spark, d)).select("doc_id", "field", "value", "confidence", "x1", "y1", "source_text")


def nearest_block(spark, d):
    return layout.nearest_to_keyword(_blocks(spark, d), "Qty").select("doc_id", "text")


def _regions(spark, d) -> DataFrame:
    own = S.items(_t(spark, d, "lineitem"))
    part = F.substring("description", 6, 20).cast("long")
    line = F.col("line_no")
    x, y = part * 37 % 900, (part * 53 + line * 71) % 900
    kind = F.get(F.array(F.lit("circular_seal"), F.lit("signature_box"), F.lit("handwritten_signature")), (line % 3).cast("int"))
    return own.select(
        "doc_id", F.lit(1).alias("page_number"), line.alias("region_id"), kind.alias("type"), (part % 97 / 100).alias("confidence"), x.cast("int").alias("x1"), y.cast("int").alias("y1"),
        (x + 80 + part % 300).cast("int").alias("x2"), (y + 80 + part % 170).cast("int").alias("y2"),
    )


def iou_pairs(spark, d):
    return regions.overlapping_pairs(_regions(spark, d)).select("doc_id", "region_id", "other_id", F.round("iou", 9).alias("iou"))


def seal_presence(spark, d):
    own = _regions(spark, d)
    docs = _t(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"))
    out = regions.seal_presence(docs, own)
    listed = F.array_join(F.transform(F.map_entries("seal_types"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.select("doc_id", "has_seals", "total_detections", listed.alias("seal_types"), "highest_confidence", F.round("average_confidence", 6).alias("average_confidence"), "validation_status")


def _contours(spark, d) -> DataFrame:
    p = F.col("l_partkey")
    return _t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), p.alias("contour"), (p * 13 % 60000).cast("double").alias("area"), (p * 7 % 900 + 1).cast("double").alias("perimeter"), (p % 11).cast("int").alias("vertices"),
        (p % 300 + 1).cast("int").alias("width"), (p % 90 + 1).cast("int").alias("height"), (p % 61 / 60).alias("content_density"), (p % 51 / 100).alias("stroke_density"), (p % 99 / 100).alias("solidity"),
    )


def seal_candidates(spark, d):
    own = _contours(spark, d)
    cols = ["doc_id", "contour", "type", "confidence"]
    parts = [f(own).select(*cols) for f in (regions.circular_seals, regions.signature_boxes, regions.handwriting)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("confidence", F.round("confidence", 9))


def otsu_threshold(spark, d):
    own = _t(spark, d, "lineitem").select((F.col("l_orderkey") % 500).alias("page"), ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 256).alias("value"))
    return imaging.otsu_threshold(own.groupBy("page", "value").agg(F.count(F.lit(1)).alias("n")), ["page"])


def deskew_angle(spark, d):
    own = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), ((F.col("l_partkey") % 1200) / 10 - 60).alias("angle"))
    return imaging.deskew_angle(own, ["page"]).withColumn("angle", F.round("angle", 6))


def _heads(spark, d) -> DataFrame:
    return _invoices(spark, d).withColumnsRenamed({"gst_number": "vendor_gst", "total_discount": "discount", "total_amount": "final_total"})


def _documents(spark, d) -> DataFrame:
    return output.invoice_documents(_heads(spark, d), _items(spark, d))


def invoice_json(spark, d):
    items = F.col("line_items")
    return _documents(spark, d).select(
        "doc_id", "invoice_info.invoice_number", "invoice_info.vendor_gst", "totals.subtotal", "totals.discount", "totals.total_gst", "totals.final_total",
        F.size(items).alias("n_items"), F.get(items, F.lit(0))["description"].alias("first_description"), F.get(items, F.size(items) - 1)["quantity"].alias("last_quantity"),
    )


def summary_sheet(spark, d):
    rows = output.summary_sheet(output.invoice_heads(_heads(spark, d)))
    number = F.col("value").try_cast("double")
    return rows.select("doc_id", "pos", "field", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))


def verification_sheet(spark, d):
    f = verify_flags(spark, d).select("doc_id", F.col("line_items_valid").alias("line_item_calc_valid"), F.col("calculations_valid").alias("total_valid"))
    return output.verification_sheet(f).select("doc_id", "pos", "item", "status")


def verification_report(spark, d):
    f = verify_flags(spark, d).select("doc_id", F.col("confidence_score").alias("overall_confidence"), F.col("overall_status").alias("verification_status"), F.col("gst_valid").alias("gst_calc_valid"))
    return output.flatten(output.verification_report(f)).select(
        "doc_id", "overall_confidence", "verification_status", "mathematical_verification_gst_calculations", "mathematical_verification_subtotal_verification", "field_confidence_scores_totals"
    )


def run_status(spark, d):
    f = verify_flags(spark, d)
    return f.groupBy("overall_status", "recommendation").agg(F.count(F.lit(1)).alias("n"))


QUERIES = [
    verify_line_items, verify_items_by_document, verify_subtotal, verify_final_total, gst_by_rate, verify_gst, gst_components, validate_formats, verify_flags, data_integrity,
    confidence_report, confidence_categories, ocr_confidence_join, missing_fields, likely_ocr_errors, weighted_confidence, field_confidence, amounts_parsed,
    extract_header, extract_gst_all, normalize_date, clean_text, numbers_from_text, contact_formats, near_keyword,
    filter_by_confidence, confidence_buckets, blocks_in_region, merge_blocks, best_engine, combine_pages,
    table_rows, table_regions_ocr, column_roles, line_items_parsed, locate_field, nearest_block,
    iou_pairs, seal_presence, seal_candidates, otsu_threshold, deskew_angle,
    invoice_json, summary_sheet, verification_sheet, verification_report, run_status,
]
