"""Queries over page images: files through the page source and the file sink, seals from pixels."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fields
from ..functions import text as X
from ..operators import imaging, ocr, regions, seals, workbook
from ..sources import documents, pages, scans
from ..sources import invoices as S
from . import oracles
from . import queries as Q


@F.pandas_udf(T.LongType())
def _sum(data: pd.Series) -> pd.Series:
    return pd.Series([int(np.frombuffer(d, np.uint8).sum(dtype=np.int64)) for d in data])


def page_files(spark, d):
    """Files of several pages to images of one page with their names, and back: pixels summed after both trips."""
    folder = f"{scans.shared_folder(spark)}/page_files-{uuid.uuid4().hex}"
    pages.write_files(scans.numbered_files(S.table(spark, d, "supplier")), folder)
    read = pages.read_pages(spark, f"{folder}/scans", partition_bytes=1 << 16)
    name = F.concat(F.lit("images/"), F.col("doc_id"), F.lit("_"), documents.page_file_name("page"))
    pages.write_files(read.where("error IS NULL").withColumn("file_name", name), folder)
    back = pages.read_pages(spark, f"{folder}/images", "doc_id string, height int, width int, data binary")
    return back.select("doc_id", "height", "width", _sum("data").alias("total"))


def _suppliers(spark, d):
    """The suppliers over all cores: their pages are a thousand times as large as their file, which is one task."""
    return S.spread(S.table(spark, d, "supplier"))


def seals_on_pages(spark, d):
    found = seals.detect(scans.marked_pages(_suppliers(spark, d)))
    return found.select("doc_id", "type", "x1", "y1", "x2", "y2")


def seals_by_document(spark, d):
    suppliers = S.table(spark, d, "supplier")
    out = regions.seal_presence(suppliers.select(F.col("s_suppkey").alias("doc_id")), seals.detect(scans.marked_pages(_suppliers(spark, d))))
    return out.select("doc_id", "has_seals", "total_detections", F.to_json("seal_types").alias("seal_types"), "validation_status")


def colour_pages(spark, d):
    """Colour files turned to grey by the preprocessing; the page itself gives the channels' sums."""
    folder = f"{scans.shared_folder(spark)}/colour_pages-{uuid.uuid4().hex}"
    pages.write_files(scans.coloured_files(S.table(spark, d, "supplier")), folder)
    grey = imaging.preprocess(pages.read_pages(spark, folder), ("grey",))
    return grey.select("doc_id", "height", "width", "channels", _sum("data").alias("total"))


def ink_engine(image: np.ndarray) -> list[tuple]:
    """Reads a picture as one word: the number of its dark pixels, in their box."""
    y, x = np.nonzero(image < 128)
    return [(str(len(x)), len(x) / image.size, int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1)] if len(x) else []


def region_ocr(spark, d):
    suppliers = S.table(spark, d, "supplier")
    read = documents.recognise_regions(scans.marked_pages(S.spread(suppliers)), scans.box_regions(suppliers), ink_engine)
    return read.select("doc_id", "region_id", "text", F.round("confidence", 9).alias("confidence"), "x1", "y1", "x2", "y2", "error")


def workbook_cells(spark, d):
    """Workbooks of all invoices, and the cells that are read back from their bytes."""
    found = workbook.cells(workbook.invoice_workbooks(Q._documents(spark, d)))
    at = lambda row, name: F.max(F.when((F.col("sheet") == "Invoice Summary") & (F.col("row") == row) & (F.col("column") == 2), F.col(name)))
    items = F.count_if((F.col("sheet") == "Line Items") & (F.col("row") > 1) & (F.col("column") == 1))
    return found.groupBy("doc_id").agg(at(2, "text").alias("invoice_number"), at(14, "number").alias("final_total"), at(19, "number").alias("pages"), items.alias("n_items"))


def sums_in_text(spark, d):
    """Sums and rate of texts that state them in four ways, or not at all."""
    k = F.col("o_orderkey")
    money = lambda c: F.format_number(c.cast("decimal(18,2)"), 2)
    sub, off, part, total = 1000 + k % 9000, k % 50, k % 700 + F.lit(0.5), 5000 + k % 99000
    form = k % 5
    lines = [
        F.when(form == 0, F.concat(F.lit("Subtotal: Rs. "), money(sub))).when(form == 1, F.concat(F.lit("Sub - Total "), sub.cast("string"))).when(form == 2, F.concat(F.lit("Taxable Value: ₹"), money(sub))).otherwise("Items"),
        F.when(form.isin(0, 2), F.concat(F.lit("Discount (5%): "), money(off))).when(form == 1, F.concat(F.lit("Total Discount "), off.cast("string"))).otherwise("-"),
        F.when(form == 0, F.concat(F.lit("CGST @ 9%: "), money(part), F.lit("\nSGST @ 9%: "), money(part))).when(form == 1, F.concat(F.lit("IGST 12% "), money(part)))
        .when(form == 2, F.concat(F.lit("Total GST @ 18%: "), money(part))).when(form == 3, F.concat(F.lit("GST Amount: Rs "), money(part))).otherwise("-"),
        F.when(form == 4, F.concat(F.lit("Net Amount: "), money(total))).otherwise(F.concat(F.lit("Grand Total: ₹"), money(total))),
    ]
    text = F.concat_ws("\n", *lines)
    low = F.lower(text)
    found = X.sums(text, low) | {"final_total": X.final_total(text, low)}
    return S.table(spark, d, "orders").select(k.alias("doc_id"), *[c.try_cast("decimal(18,2)").cast("double").alias(n) for n, c in found.items()])


def field_verdicts(spark, d):
    """Forms of numbers, GST numbers and dates, some of them broken by rule."""
    k = F.col("o_orderkey")
    number = F.when(k % 6 == 0, "INV").when(k % 6 == 1, F.concat(F.lit("INV@"), k)).when(k % 6 == 2, "").otherwise(F.concat(F.lit("INV-2024/"), k % 1000000))
    gst = F.concat(F.lpad((k % 37).cast("string"), 2, "0"), F.lit("AABCU9603R1Z"), F.when(k % 4 == 0, "").otherwise("V"))
    day, month = k % 33 + 1, k % 14
    date = F.when(k % 3 == 0, F.concat_ws("/", day, month, F.lit("2024"))).when(k % 3 == 1, F.concat_ws("-", F.lit("2023"), month, day)).otherwise(F.concat(day, F.lit("-May-2024")))
    return S.table(spark, d, "orders").select(k.alias("doc_id"), fields.has_form(number, "invoice_number").alias("number"), fields.has_form(gst, "gst_number").alias("gst"), fields.has_form(date, "date").alias("date"))


def fields_in_context(spark, d):
    """Fields far from and near to their keywords, and the texts with their white space levelled."""
    k = F.col("o_orderkey")
    far = F.repeat(F.lit("x "), (k % 60).cast("int"))
    text = F.concat(F.lit("Order No: AB-1  \n"), F.lit(" Invoice Number "), far, F.lit(" Invoice Number INV-"), k, F.lit(" for\t services "), F.when(k % 2 == 0, F.concat(F.lit("Total: "), k % 1000, F.lit(".50"))).otherwise(""))
    return S.table(spark, d, "orders").select(k.alias("doc_id"), fields.in_context(text, "po_number").alias("po"), fields.in_context(text, "final_total").alias("total"), F.length(fields.collapsed(text)).alias("n_chars"))


def confident_fields(spark, d):
    k = F.col("o_orderkey")
    cells = [x for i, n in enumerate(("invoice_number", "invoice_date", "vendor_gst")) for x in (F.lit(n), F.struct(F.lit("v").alias("value"), F.when((k + i) % 11 > 0, (k * (i + 3) % 101) / 100).alias("confidence")))]
    return S.table(spark, d, "orders").select(k.alias("doc_id"), F.array_join(F.array_sort(F.map_keys(fields.confident(F.create_map(*cells)))), ",").alias("kept"))


def row_heights(spark, d):
    return ocr.heights(Q._blocks(spark, d)).select("doc_id", F.array_join("heights", ",").alias("heights"))


def file_names(spark, d):
    k = F.col("s_suppkey")
    path = F.concat(F.lit("/in/v1.2/"), F.when(k % 5 == 0, ".hidden").otherwise(F.concat(F.lit("Scan."), k)), F.element_at(F.array(*map(F.lit, (".PDF", ".pdf", "", ".tar.gz"))), (k % 4 + 1).cast("int")))
    return S.table(spark, d, "supplier").select(k.alias("doc_id"), fields.extension(path).alias("extension"), fields.is_pdf(path).alias("is_pdf"), fields.output_name(path, "out", "json").alias("name"))


def ocr_result_files(spark, d):
    """OCR results of made pages as a JSON file for each document, written by the file sink and read back."""
    suppliers = S.table(spark, d, "supplier")
    words = documents.recognise(scans.marked_pages(suppliers), ink_engine)
    folder = f"{scans.shared_folder(spark)}/ocr_results-{uuid.uuid4().hex}"
    pages.write_files(ocr.result_files(words), folder)
    block = "struct<text: string, confidence: double, bbox: array<int>>"
    kind = f"doc_id long, total_pages int, pages array<struct<page_number: int, n_blocks: int, text_blocks: array<{block}>>>"
    read = spark.read.schema(kind).option("multiLine", True).option("pathGlobFilter", "*_ocr.json").json(folder)
    page = F.get("pages", F.lit(0))
    return read.select("doc_id", "total_pages", page["n_blocks"].alias("n_blocks"), F.get(page["text_blocks"], F.lit(0))["text"].alias("text"), F.array_join(F.get(page["text_blocks"], F.lit(0))["bbox"], ",").alias("bbox"))


QUERIES = (page_files, seals_on_pages, seals_by_document, colour_pages, region_ocr, workbook_cells, sums_in_text, field_verdicts, fields_in_context, confident_fields, row_heights, file_names, ocr_result_files)

_MARKS = """
WITH marks AS (
  SELECT s_suppkey AS s, CASE WHEN s_suppkey % 5 <> 0 THEN 15 + 3 * (s_suppkey % 3) END AS r,
         s_suppkey % 7 <> 0 AS boxed FROM supplier
), found AS (
  SELECT s AS doc_id, 'circular_seal' AS type, CAST(40 + s % 50 - r AS INTEGER) AS x1, CAST(45 + s % 7 - r AS INTEGER) AS y1,
         CAST(40 + s % 50 + r + 1 AS INTEGER) AS x2, CAST(45 + s % 7 + r + 1 AS INTEGER) AS y2
  FROM marks WHERE r IS NOT NULL
  UNION ALL
  SELECT s, 'signature_box', CAST(20 + s % 40 - 1 AS INTEGER), CAST(100 + s % 11 - 1 AS INTEGER), -- of the two pixels at a step the first is the edge
         CAST(20 + s % 40 + 110 AS INTEGER), CAST(100 + s % 11 + 24 AS INTEGER)
  FROM marks WHERE boxed
)
"""

SQL = {
    "page_files": """
SELECT format('S{:06d}_page_{:03d}', s_suppkey, p) AS doc_id, CAST(6 + s_suppkey % 5 AS INTEGER) AS height, CAST(5 + s_suppkey % 7 AS INTEGER) AS width,
       CAST(list_sum(list_transform(range((6 + s_suppkey % 5) * (5 + s_suppkey % 7)), lambda i: (s_suppkey * 31 + p * 17 + i * 7) % 256)) AS BIGINT) AS total
FROM supplier, range(1, 4) AS r(p) WHERE p <= 1 + s_suppkey % 3
""",
    "colour_pages": """
WITH p AS (SELECT s_suppkey AS s, unnest(range((4 + s_suppkey % 3) * (6 + s_suppkey % 4))) AS i FROM supplier),
v AS (SELECT s, (s * 53 + 3 * i * 37) % 256 AS r, (s * 53 + (3 * i + 1) * 37 + 11) % 256 AS g, (s * 53 + (3 * i + 2) * 37 + 22) % 256 AS b FROM p)
SELECT format('C{:06d}', s) AS doc_id, CAST(4 + s % 3 AS INTEGER) AS height, CAST(6 + s % 4 AS INTEGER) AS width, CAST(1 AS INTEGER) AS channels,
       CAST(sum((19595 * r + 38470 * g + 7471 * b + 32768) // 65536) AS BIGINT) AS total
FROM v GROUP BY s
""",
    "workbook_cells": f"""WITH {oracles._INVOICES}, l AS (SELECT doc_id, count(*) AS n FROM items GROUP BY doc_id)
SELECT doc_id, nullif(invoice_number, '') AS invoice_number, CAST(final AS DOUBLE) AS final_total, CAST(1 AS DOUBLE) AS pages, coalesce(n, 0) AS n_items FROM inv LEFT JOIN l USING (doc_id)""",
    "sums_in_text": """
SELECT o_orderkey AS doc_id, CASE WHEN f < 3 THEN CAST(1000 + o_orderkey % 9000 AS DOUBLE) END AS subtotal, CASE WHEN f < 3 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS total_discount,
       CASE WHEN f = 0 THEN 2 * (o_orderkey % 700 + CAST(0.5 AS DOUBLE)) WHEN f < 4 THEN o_orderkey % 700 + CAST(0.5 AS DOUBLE) END AS total_gst,
       CASE f WHEN 0 THEN CAST(18 AS DOUBLE) WHEN 1 THEN 12 WHEN 2 THEN 18 END AS gst_rate, CAST(5000 + o_orderkey % 99000 AS DOUBLE) AS final_total
FROM (SELECT *, o_orderkey % 5 AS f FROM orders)
""",
    "field_verdicts": """
SELECT o_orderkey AS doc_id, o_orderkey % 6 > 2 AS number, o_orderkey % 4 <> 0 AS gst,
       CASE WHEN o_orderkey % 3 = 2 THEN day <= 31 ELSE month BETWEEN 1 AND 12 AND
         day <= CASE WHEN month IN (4, 6, 9, 11) THEN 30 WHEN month = 2 THEN CASE WHEN o_orderkey % 3 = 0 THEN 29 ELSE 28 END ELSE 31 END END AS date
FROM (SELECT *, o_orderkey % 33 + 1 AS day, o_orderkey % 14 AS month FROM orders)
""",
    "fields_in_context": """
SELECT o_orderkey AS doc_id, 'AB-1' AS po, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 1000)::VARCHAR || '.50' END AS total,
       CAST(len('Order No: AB-1 Invoice Number ') + 2 * (o_orderkey % 60) + len('Invoice Number INV-' || o_orderkey || ' for services')
         + CASE WHEN o_orderkey % 2 = 0 THEN len(' Total: .50') + len((o_orderkey % 1000)::VARCHAR) ELSE 0 END AS INTEGER) AS n_chars
FROM orders
""",
    "confident_fields": """
SELECT o_orderkey AS doc_id, concat_ws(',', CASE WHEN (o_orderkey + 1) % 11 > 0 AND o_orderkey * 4 % 101 >= 50 THEN 'invoice_date' END, CASE WHEN o_orderkey % 11 > 0 AND o_orderkey * 3 % 101 >= 50 THEN 'invoice_number' END,
       CASE WHEN (o_orderkey + 2) % 11 > 0 AND o_orderkey * 5 % 101 >= 50 THEN 'vendor_gst' END) AS kept FROM orders
""",
    "row_heights": f"""WITH {oracles._BLOCKS} SELECT doc_id, array_to_string(list_sort(list(DISTINCT y1)), ',') AS heights FROM blocks GROUP BY doc_id""",
    "file_names": """
WITH p AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN '.hidden' ELSE 'Scan.' || s_suppkey END AS stem, ['.PDF', '.pdf', '', '.tar.gz'][s_suppkey % 4 + 1] AS more FROM supplier),
e AS (SELECT *, CASE WHEN more = '.tar.gz' THEN '.gz' WHEN more <> '' THEN more WHEN k % 5 = 0 THEN '' ELSE '.' || k END AS ext FROM p)
SELECT k AS doc_id, lower(ext) AS extension, lower(ext) = '.pdf' AS is_pdf, left(stem || more, len(stem || more) - len(ext)) || '_out.json' AS name FROM e
""",
    "ocr_result_files": """
WITH m AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 <> 0 THEN 15 + 3 * (s_suppkey % 3) END AS r, s_suppkey % 7 <> 0 AS boxed FROM supplier WHERE s_suppkey % 35 <> 0),
a AS (SELECT k, coalesce(r, 0) AS r, boxed, coalesce((SELECT CAST(sum(2 * CAST(floor(sqrt(CAST(m.r * m.r - y * y AS DOUBLE))) AS BIGINT) + 1) AS BIGINT) FROM range(-21, 22) AS t(y) WHERE abs(y) <= m.r), 0) AS disc FROM m)
SELECT k AS doc_id, CAST(1 AS INTEGER) AS total_pages, CAST(1 AS INTEGER) AS n_blocks, (disc + CASE WHEN boxed THEN 2640 ELSE 0 END)::VARCHAR AS text,
  concat_ws(',', CASE WHEN r = 0 THEN 20 + k % 40 WHEN boxed THEN least(40 + k % 50 - r, 20 + k % 40) ELSE 40 + k % 50 - r END, CASE WHEN r = 0 THEN 100 + k % 11 ELSE 45 + k % 7 - r END,
    CASE WHEN r = 0 THEN 130 + k % 40 WHEN boxed THEN greatest(41 + k % 50 + r, 130 + k % 40) ELSE 41 + k % 50 + r END, CASE WHEN boxed THEN 124 + k % 11 ELSE 46 + k % 7 + r END) AS bbox
FROM a
""",
    "region_ocr": """
SELECT s_suppkey AS doc_id, CAST(0 AS INTEGER) AS region_id, '2640' AS text, round(2640 / 4080.0, 9) AS confidence, CAST(20 + s_suppkey % 40 AS INTEGER) AS x1,
       CAST(100 + s_suppkey % 11 AS INTEGER) AS y1, CAST(130 + s_suppkey % 40 AS INTEGER) AS x2, CAST(124 + s_suppkey % 11 AS INTEGER) AS y2, CAST(NULL AS VARCHAR) AS error
FROM supplier WHERE s_suppkey % 7 <> 0
UNION ALL
SELECT s_suppkey, 1, NULL, NULL, NULL, NULL, NULL, NULL, 'the region lies outside its page' FROM supplier WHERE s_suppkey % 9 = 0
""",
    "seals_on_pages": _MARKS + "SELECT * FROM found",
    "seals_by_document": _MARKS + """
SELECT s AS doc_id, count(type) > 0 AS has_seals, count(type) AS total_detections,
       CASE WHEN count(type) = 0 THEN '{}' ELSE '{' || string_agg(DISTINCT '"' || type || '":1', ',' ORDER BY '"' || type || '":1') || '}' END AS seal_types,
       CASE WHEN count(type) = 0 THEN 'no_seals_detected' ELSE 'high_confidence' END AS validation_status
FROM marks LEFT JOIN found ON doc_id = s GROUP BY s
""",
}
