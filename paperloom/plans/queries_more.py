"""More queries, one per operator: text helpers, reports, regions, numbers and sheets."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions import text as X
from ..operators import imaging, layout, ocr, output, regions, verify
from ..sources import invoices as S
from . import extraction
from . import queries as Q


def _headers(spark, d) -> DataFrame:
    return S.headers(S.table(spark, d, "orders"))


def _checks(spark, d) -> DataFrame:
    return verify.all_checks(Q._items(spark, d), Q._invoices(spark, d), Q.AS_OF)


def dates_in_text(spark, d):
    return Q._texts(spark, d).select("doc_id", F.posexplode(X.dates_in(F.col("text"))).alias("pos", "found"))


def gst_normalised(spark, d):
    g = F.col("gst_number")
    sixteen = F.lower(F.concat(F.substring(g, 1, 2), F.lit(" "), F.regexp_replace(F.substring(g, 3, 20), "F1", "FQ1")))
    given = F.when(F.length("email") > 18, sixteen).otherwise(g)
    return _headers(spark, d).select("doc_id", X.normalise_gst(given).alias("gst"))


def standard_dates(spark, d):
    form = F.month("day") % 5
    given = (
        F.when(form == 0, F.date_format("day", "dd/MM/yyyy")).when(form == 1, F.date_format("day", "dd-MMM-yyyy")).when(form == 2, F.date_format("day", "yyyy-MM-dd"))
        .when(form == 3, F.date_format("day", "MMMM d, yyyy")).otherwise("no date")
    )
    return _headers(spark, d).select("doc_id", X.standard_date(given).alias("standard"))


def pattern_strength(spark, d):
    n = F.col("invoice_number")
    given = F.when(F.month("day") == 1, F.substring(n, 1, 8)).when(F.month("day") == 2, F.concat(n, F.lit("x"))).otherwise(n)
    return _headers(spark, d).select("doc_id", X.pattern_strength(given, ("INV-", "[0-9]{4}", "-", "[0-9]{6}")).alias("strength"))


def nested_values(spark, d):
    json = F.concat(F.lit('{"info": {"number": "'), "invoice_number", F.lit('"'), F.when(F.month("day") > 6, F.concat(F.lit(', "buyer": {"id": '), "customer", F.lit("}"))).otherwise(""), F.lit("}}"))
    return _headers(spark, d).select(
        "doc_id", X.nested_get(json, ("info", "number")).alias("number"), X.nested_get(json, ("info", "buyer", "id"), "none").alias("buyer"), X.nested_get(json, ("totals", "x")).alias("missing")
    )


def passed_flags(spark, d):
    return verify.passed_flags(_checks(spark, d)).withColumn("failed_checks", F.array_join("failed_checks", ","))


def _valued_fields(spark, d) -> DataFrame:
    return Q._fields(spark, d).withColumn("value", F.when(F.col("confidence") >= 0.1, F.col("field")))


def _item_confidences(spark, d) -> DataFrame:
    return Q._ocr_blocks(spark, d).select("doc_id", F.col("block_pos").alias("line_no"), "confidence")


def sectioned_report(spark, d):
    r = verify.sectioned_report(_valued_fields(spark, d), _item_confidences(spark, d))
    lines = F.col("line_items_verification")
    return r.select(
        "doc_id", F.size("field_verification").alias("n_fields"), F.size(F.filter(F.map_values("field_verification"), lambda v: v["present"])).alias("n_present"), "summary.all_fields_confident",
        F.round("summary.average_field_confidence", 6).alias("average_field_confidence"), F.array_join("summary.low_confidence_fields", ",").alias("low_confidence_fields"),
        F.size(lines).alias("n_items"), F.get(lines, F.lit(0))["confidence"].alias("first_item"), F.col("field_verification")["vendor"]["confidence"].alias("vendor"),
    )


def verification_summary(spark, d):
    r = verify.verification_summary(Q._fields(spark, d), _checks(spark, d))
    return r.select("doc_id", F.round("overall_confidence", 6).alias("overall_confidence"), "verification_passed", "issues_found", F.size("recommendations").alias("n_recommendations"))


def verification_score(spark, d):
    parts = {c: (F.col("o_orderkey") * k % 101 / 100).cast("double") for c, k in (("arithmetic", 7), ("formats", 11), ("seals", 13))}
    return S.table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.round(verify.verification_score(parts), 6).alias("score"))


def bucket_texts(spark, d):
    joined = [F.array_join(c, "|").alias(c) for c in ("high", "medium", "low")]
    return ocr.bucket_texts(Q._ocr_blocks(spark, d)).select("doc_id", "page_number", *joined)


def region_text(spark, d):
    own = Q._ocr_blocks(spark, d)
    box = [F.lit(v).cast("int").alias(c) for c, v in (("region_id", 1), ("x1", 40), ("y1", 0), ("x2", 110), ("y2", 40))]
    return ocr.text_in_region(own, own.select("doc_id", "page_number").distinct().select("*", *box)).withColumn("average_confidence", F.round("average_confidence", 6))


def ocr_metrics(spark, d):
    pages = F.explode(F.array(F.lit(1), F.lit(2))).alias("page_number")
    times = S.table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), pages, (F.col("o_orderkey") % 7 / 2).alias("seconds"))
    rounded = [F.round(c, 6).alias(c) for c in ("average_confidence", "blocks_a_second")]
    return ocr.metrics(Q._ocr_blocks(spark, d), times).select("doc_id", "page_number", "processing_time", "text_blocks_detected", *rounded)


def _faded_blocks(spark, d) -> DataFrame:
    """Blocks whose header cells are unreadable where the engine was unsure."""
    faded = (F.col("block_pos") < 5) & (F.col("confidence") < 0.75)
    return Q._blocks(spark, d).withColumn("text", F.when(faded, "#").otherwise(F.col("text")))


def table_regions(spark, d):
    return layout.table_regions(_faded_blocks(spark, d)).select("doc_id", "x1", "y1", "x2", "y2", "confidence", "method")


def table_regions_grid(spark, d):
    return layout.regions_from_grid(Q._blocks(spark, d)).select("doc_id", "x1", "y1", "x2", "y2", "n_rows")


def _boxes(spark, d) -> DataFrame:
    """Ruled boxes beside and around the tables."""
    k = F.col("o_orderkey")
    cell = lambda i, x1, y1, x2, y2: F.struct(F.lit(i).alias("box_id"), *[v.cast("int").alias(n) for n, v in (("x1", x1), ("y1", y1), ("x2", x2), ("y2", y2))])
    cells = F.array(
        cell(1, k % 60, F.lit(90), k % 300 + 250, F.lit(230)), cell(2, F.lit(240), k % 90 + 60, F.lit(600), k % 90 + 180), cell(3, F.lit(0), F.lit(0), F.lit(150), k % 400 + 20)
    )
    return S.table(spark, d, "orders").select(k.alias("doc_id"), F.lit(1).alias("page_number"), F.explode(cells).alias("b")).select("doc_id", "page_number", "b.*")


def table_regions_boxes(spark, d):
    return layout.regions_from_boxes(_boxes(spark, d), Q._blocks(spark, d)).select("doc_id", "box_id", "n_blocks", "confidence")


def rows_in_regions(spark, d):
    own = _boxes(spark, d).withColumnRenamed("box_id", "region_id")
    return layout.rows_of_regions(Q._blocks(spark, d), own).select("doc_id", "region_id", "row_no", F.array_join("cells", "|").alias("cells"))


def content_density(spark, d):
    value = (F.col("l_partkey") * 7 % 256).cast("long")
    pixels = S.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.unhex(F.concat_ws("", F.collect_list(F.lpad(F.hex(value), 2, "0")))).alias("data"))
    return pixels.select("doc_id", F.round(imaging.content_density(), 9).alias("density"))


def suppress_overlaps(spark, d):
    return regions.suppress_overlaps(Q._regions(spark, d)).select("doc_id", "region_id", "type", "confidence")


def item_sheet(spark, d):
    return output.item_rows(Q._items(spark, d))


def sheet_widths(spark, d):
    return output.column_widths(Q._items(spark, d).select("description", "hsn_code", "quantity", "unit_price", "total_amount"))


def amount_helpers(spark, d):
    i = Q._items(spark, d)
    total, price = money.parse_decimal(F.col("total_amount")), money.parse_decimal(F.col("unit_price"))
    return i.select(
        "doc_id", "line_no", F.round(money.percentage(price.cast("double"), total.cast("double")), 6).alias("share"), money.round_to_currency(total).cast("double").alias("rounded"),
        F.coalesce(money.within(total, F.round(total, 2)), F.lit(False)).alias("is_near"),
    )


def fields_kept(spark, d):
    h = _headers(spark, d)
    cells = F.create_map(*[x for c in ("invoice_number", "pincode") for x in (F.lit(c), F.col(c))], F.lit("phone"), F.when(F.month("day") > 3, F.col("phone")), F.lit("note"), F.when(F.month("day") > 9, "seen").otherwise(""))
    return h.select("doc_id", F.array_join(F.array_sort(F.map_keys(output.drop_empty(cells))), ",").alias("kept"))


def _stand_ins():
    """A rasteriser and an engine for files that are texts: the bytes are one row of pixels, each line is a
    block, and pages with a short phone number can't be read."""

    def pages(content):
        yield np.frombuffer(bytes(content), np.uint8).reshape(1, -1)

    def engine(image):
        text = image.tobytes().decode()
        if "Phone: 12345\n" in text:
            raise RuntimeError("unreadable page")
        return [(line, 0.9, 0, 40 * n, 400, 40 * n + 20) for n, line in enumerate(text.split("\n"))]

    return pages, engine


def files_to_headers(spark, d):
    pages, engine = _stand_ins()
    files = Q._texts(spark, d).select("doc_id", F.encode("text", "UTF-8").alias("content"))
    texts = extraction.document_texts(extraction.read_files(files, pages, engine))
    return extraction.header_fields(texts, "n_pages", "error")


QUERIES = [
    files_to_headers, dates_in_text, gst_normalised, standard_dates, pattern_strength, nested_values, passed_flags, sectioned_report, verification_summary, verification_score,
    bucket_texts, region_text, ocr_metrics, table_regions, table_regions_grid, table_regions_boxes, rows_in_regions, content_density, suppress_overlaps,
    item_sheet, sheet_widths, amount_helpers, fields_kept,
]
