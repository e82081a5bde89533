"""The whole path from text and blocks to verified, nested invoices, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.money import parse_decimal
from ..operators import imaging, layout, output, seals, verify, workbook
from ..sources import documents
from ..sources.pages import write_files


def header_fields(texts: DataFrame, *keep: str, with_sums: bool = False) -> DataFrame:
    """The header fields of rows (doc_id, text), and the columns to ``keep``. The text is lowered and its GST numbers are
    sought once. ``with_sums`` adds subtotal, total_discount, total_gst and gst_rate; labels that hold the word total
    but belong to these are then no labels of the final total."""
    t = F.col("text")
    low, gst = F.col("_x.low"), F.col("_x.gst")
    once = F.struct(F.lower(t).alias("low"), X.gst_numbers(t, distinct=True).alias("gst"))
    return texts.withColumn("_x", F.explode(F.array(once))).select(
        "doc_id",
        X.invoice_number(t, low).alias("invoice_number"),
        X.invoice_date(t, low).alias("invoice_date"),
        X.po_number(t, low).alias("po_number"),
        F.get(gst, F.lit(0)).alias("vendor_gst"),
        F.get(gst, F.lit(1)).alias("buyer_gst"),
        X.shipping_address(t).alias("shipping_address"),
        (X.final_total if with_sums else X.total_amount)(t, low).alias("final_total"),
        *[c.alias(n) for n, c in (X.sums(t, low) if with_sums else {}).items()],
        *keep,
    )


def long_fields(headers: DataFrame) -> DataFrame:
    """(doc_id, field, value) of every header field."""
    names = [c for c in headers.columns if c != "doc_id"]
    return headers.select("doc_id", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in names])).alias("f")).select("doc_id", "f.*")


def extract_invoices(texts: DataFrame, blocks: DataFrame, extracted_at: str = "") -> DataFrame:
    """Nested documents from page texts and OCR blocks."""
    items = layout.parse_items(layout.table_rows(blocks)).withColumnRenamed("row_no", "line_no")
    return output.invoice_documents(header_fields(texts), items, extracted_at)


def verify_invoices(items: DataFrame, invoices: DataFrame, as_of: str) -> DataFrame:
    return verify.flags(verify.all_checks(items, invoices, as_of))


def document_texts(words: DataFrame) -> DataFrame:
    """Per document the text of its pages in order (a line for each row of blocks), the number of its
    pages, and the first error among them."""
    lines = layout.page_lines(words.where("error IS NULL"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda s: s["text"]), "\n\n")
    per = lines.groupBy("doc_id").agg(text.alias("text"))
    pages = words.groupBy("doc_id").agg(F.count_distinct(F.when(F.col("page_number") > 0, F.col("page_number"))).alias("n_pages"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("page_number"))).alias("error"))
    return pages.join(per, "doc_id", "left")


def read_files(files: DataFrame, rasteriser: documents.Rasteriser, primary: documents.Engine, fallback: documents.Engine | None = None, steps: tuple[str, ...] = (), threshold: float = 0.6) -> DataFrame:
    """Words of all pages of files (doc_id, content), and a row with an error for what failed."""
    return documents.recognise(prepared_pages(files, rasteriser, steps), primary, fallback, threshold)


def prepared_pages(files: DataFrame, rasteriser: documents.Rasteriser, steps: tuple[str, ...] = ()) -> DataFrame:
    """The pages of files after the named steps."""
    pages = documents.rasterise(files, rasteriser)
    return imaging.preprocess(pages, steps) if steps else pages


def process_files(files: DataFrame, folder: str, as_of: str, rasteriser: documents.Rasteriser, primary: documents.Engine, fallback: documents.Engine | None = None, steps: tuple[str, ...] = (), extras: tuple[str, ...] = ()) -> dict[str, str]:
    """Files to written results: words, nested documents, verification flags and reports, sheets, and
    what failed. OCR runs once: its words are written first, and all that follows reads them.

    ``extras``: ``seals`` (seals and signatures of the pages, their images, and their place in the documents),
    ``images`` (the pages that OCR has read, as PNG) and ``workbooks`` (one for each document). Where pixels are needed
    twice, pages are written once and read by all.

    Subtotal, discount, GST and its rate are read by their labels. A subtotal that the text lacks is taken from
    the lines. The GST of the lines is compared only where a rate is stated and no discount lies between: what a
    document doesn't say is not held against it."""
    spark = files.sparkSession
    paths = {k: f"{folder}/{k}" for k in ("words", "flags", "failures", *extras)}
    pages = prepared_pages(files, rasteriser, steps)
    if {"seals", "images"} & {*extras}:
        paths["pages"] = f"{folder}/pages"
        pages.write.mode("overwrite").parquet(paths["pages"])
        pages = spark.read.parquet(paths["pages"])
    documents.recognise(pages, primary, fallback).write.mode("overwrite").parquet(paths["words"])
    words = spark.read.parquet(paths["words"])
    blocks, texts = words.where("error IS NULL"), document_texts(words)
    heads = header_fields(texts.where("text IS NOT NULL"), with_sums=True)
    items = layout.parse_items(layout.item_rows(layout.table_rows(blocks)))
    items = items.withColumns({"line_no": F.row_number().over(Window.partitionBy("doc_id").orderBy("page_number", "row_no")), **{c: F.col(c).cast("string") for c in ("quantity", "unit_price", "total_amount")}})
    items = items.select("doc_id", "line_no", "description", "hsn_code", "quantity", "unit_price", "total_amount", F.lit("0").alias("discount"), F.lit("amount").alias("discount_type"))
    lines = items.groupBy("doc_id").agg(F.sum(F.col("total_amount").try_cast("decimal(18,4)")).cast("string").alias("_lines"))
    known = heads.join(lines, "doc_id", "left").withColumn("subtotal", F.coalesce("subtotal", "_lines")).drop("_lines")
    invoices = known.withColumns({"due_date": F.lit(None).cast("string"), "gst_number": F.col("vendor_gst"), "total_amount": F.col("final_total")})
    heads = known.withColumnRenamed("total_discount", "discount")
    if "images" in extras:
        write_files(documents.page_files(pages, "processed_page"), paths["images"], "overwrite")
    if "seals" in extras:
        heads = heads.join(_written_seals(pages, folder), "doc_id", "left")
    rates = known.select("doc_id", F.when(parse_decimal(F.col("total_discount")).isNull() | (parse_decimal(F.col("total_discount")) == 0), F.col("gst_rate")).alias("gst_rate"))
    items = items.join(rates, "doc_id", "left")
    checks = verify.all_checks(items, invoices, as_of).join(rates, "doc_id", "left")
    silent = (F.col("check") == "gst") & F.col("gst_rate").isNull()
    none = F.array().cast("array<string>")
    checks = checks.withColumns({"is_valid": silent | F.col("is_valid"), "errors": F.when(silent, none).otherwise(F.col("errors"))}).drop("gst_rate")
    flags = verify.flags(checks)
    flags.write.mode("overwrite").parquet(paths["flags"])
    words.where("error IS NOT NULL").select("doc_id", "page_number", "error").write.mode("overwrite").json(paths["failures"])
    judged = spark.read.parquet(paths["flags"]).select("doc_id", F.col("confidence_score").alias("overall_confidence"), F.col("overall_status").alias("verification_status"), F.col("line_items_valid").alias("line_item_calc_valid"), F.col("calculations_valid").alias("total_valid"), F.col("gst_valid").alias("gst_calc_valid"))
    nested, checked = output.invoice_documents(heads, items), output.verification_sheet(judged)
    written = output.write_outputs(nested, output.verification_report(judged), folder, checked)
    if "workbooks" in extras:
        books = workbook.invoice_workbooks(nested, checked)
        write_files(books.select(F.concat(F.col("doc_id").cast("string"), F.lit(".xlsx")).alias("file_name"), "content"), paths["workbooks"], "overwrite")
    return paths | written


def _written_seals(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the pages' seals and their images; seals_detected, seal_count and seal_file_paths of each document that has any."""
    spark = pages.sparkSession
    seals.detect(pages).write.mode("overwrite").parquet(f"{folder}/seals")
    found = spark.read.parquet(f"{folder}/seals")
    cut = seals.crop_files(pages.where("error IS NULL"), found)
    write_files(cut, f"{folder}/seal_images", "overwrite")
    names = F.array_sort(F.collect_list(F.concat(F.lit("seal_images/"), "file_name")))
    return cut.select("doc_id", "file_name").groupBy("doc_id").agg(F.lit(True).alias("seals_detected"), F.count(F.lit(1)).alias("seal_count"), names.alias("seal_file_paths"))
