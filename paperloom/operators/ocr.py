"""What follows OCR: engine choice, filters, merging of neighbours, pages into documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fields import json_text

PAGE = ["doc_id", "page_number"]


def tesseract_blocks(raw: DataFrame) -> DataFrame:
    """Blocks from one row per page of parallel arrays (text, left, top, width, height, conf):
    empty texts and confidences of 0 or less are dropped, confidences become 0 to 1."""
    z = F.arrays_zip("text", "left", "top", "width", "height", "conf")
    at = raw.select(*PAGE, F.posexplode(z).alias("block_pos", "w"))
    kept = at.where((F.trim("w.text") != "") & (F.col("w.conf") > 0))
    return kept.select(
        *PAGE, "block_pos", F.trim("w.text").alias("text"), (F.col("w.conf") / 100).alias("confidence"), F.col("w.left").alias("x1"), F.col("w.top").alias("y1"),
        (F.col("w.left") + F.col("w.width")).alias("x2"), (F.col("w.top") + F.col("w.height")).alias("y2"),
    )


def quad_blocks(raw: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Blocks from rows (quad, text, confidence) of four points: the box is the quad's hull."""
    side = lambda i, f: f(F.transform("quad", lambda p: F.get(p, F.lit(i))))
    return raw.where(F.col("confidence") >= threshold).select(
        *PAGE, "block_pos", "text", "confidence", side(0, F.array_min).alias("x1"), side(1, F.array_min).alias("y1"), side(0, F.array_max).alias("x2"), side(1, F.array_max).alias("y2")
    )


def page_results(blocks: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """Full text in block order, number of one-word blocks and mean confidence per page."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_pos", "text"))), lambda s: s["text"]), " ")
    single = F.count_if(F.size(F.split(F.trim("text"), r"\s+")) == 1)
    return blocks.groupBy(*keys).agg(
        text.alias("full_text"), single.alias("word_count"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("average_confidence"), F.count(F.lit(1)).alias("n_blocks")
    )


def best_engine(results: DataFrame, primary: str, threshold: float = 0.6) -> DataFrame:
    """Per page one row of ``results`` (engine, n_blocks, average_confidence): the primary
    engine's unless it is missing, empty or below the threshold and another is better."""
    is_primary = F.col("engine") == primary
    fine = is_primary & (F.col("average_confidence") >= threshold) & (F.col("n_blocks") > 0)
    order = Window.partitionBy(*PAGE).orderBy(F.desc(fine), F.desc("average_confidence"), F.desc(is_primary), "engine")
    return results.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank").withColumn("fallback_used", ~is_primary)


def confident(blocks: DataFrame, least: float = 0.8) -> DataFrame:
    return blocks.where(F.col("confidence") >= least)


def combine_pages(pages: DataFrame) -> DataFrame:
    """Documents from page results: non-empty texts in page order with blank lines between,
    summed words, mean of the positive page confidences (else 0.0), engines."""
    texts = F.transform(F.array_sort(F.collect_list(F.when(F.col("full_text") != "", F.struct("page_number", "full_text")))), lambda s: s["full_text"])
    mean = F.avg(F.when(F.col("average_confidence") > 0, F.col("average_confidence")))
    return pages.groupBy("doc_id").agg(
        F.array_join(texts, "\n\n").alias("combined_text"), F.sum("word_count").alias("total_word_count"), F.coalesce(mean, F.lit(0.0)).alias("average_confidence"),
        F.count(F.lit(1)).alias("total_pages"), F.sort_array(F.collect_set("engine")).alias("engines_used"),
    )


def merge_neighbours(blocks: DataFrame, gap: int = 10, line: str = "y1") -> DataFrame:
    """Blocks of one line (equal ``line``) whose horizontal gaps are at most ``gap`` as one block."""
    order = Window.partitionBy(*PAGE, line).orderBy("x1", "block_pos")
    far = F.col("x1") - F.max("x2").over(order.rowsBetween(Window.unboundedPreceding, -1)) > gap
    marked = blocks.withColumn("island", F.sum(far.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x1", "block_pos", "text"))), lambda s: s["text"]), " ")
    merged = marked.withColumn("island", F.coalesce("island", F.lit(0))).groupBy(*PAGE, line, "island")
    box = [F.min("x1").alias("left"), F.min("y1").alias("top"), F.max("x2").alias("right"), F.max("y2").alias("bottom")]
    return merged.agg(text.alias("merged_text"), F.avg("confidence").alias("mean_confidence"), F.count(F.lit(1)).alias("n_merged"), *box).drop("island")


def buckets(blocks: DataFrame, high: float = 0.9, medium: float = 0.6) -> DataFrame:
    """Number of blocks and mean confidence per page and bucket."""
    c = F.col("confidence")
    name = F.when(c >= high, "high").when(c >= medium, "medium").otherwise("low")
    return blocks.groupBy(*PAGE, name.alias("bucket")).agg(F.count(F.lit(1)).alias("n_blocks"), F.avg(c).alias("average_confidence"))


def is_whole(blocks: DataFrame) -> DataFrame:
    """Per page whether every block has a text and a box."""
    boxed = F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull()
    return blocks.groupBy(*PAGE).agg(F.bool_and((F.trim(F.coalesce("text", F.lit(""))) != "") & boxed).alias("is_whole"))


def in_region(x1: int, y1: int, x2: int, y2: int) -> Column:
    """Strict overlap of a block with a fixed region."""
    return (F.col("x1") < x2) & (F.col("x2") > x1) & (F.col("y1") < y2) & (F.col("y2") > y1)


def bucket_texts(blocks: DataFrame, high: float = 0.9, medium: float = 0.6) -> DataFrame:
    """The texts of each page's blocks by bucket of confidence (``high``, ``medium``, ``low``), in block order."""
    c = F.col("confidence")
    of = lambda test: F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("block_pos", "text")))), lambda s: s["text"])
    return blocks.groupBy(*PAGE).agg(of(c >= high).alias("high"), of((c >= medium) & (c < high)).alias("medium"), of(c < medium).alias("low"))


def text_in_region(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Per region (region_id) of a page the text, number and mean confidence of the blocks that overlap
    it, in block order; empty regions give no row."""
    f = F.col
    over = (f("b.x1") < f("r.x2")) & (f("b.x2") > f("r.x1")) & (f("b.y1") < f("r.y2")) & (f("b.y2") > f("r.y1"))
    pairs = blocks.alias("b").join(regions.alias("r"), PAGE).where(over)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b.block_pos", "b.text"))), lambda s: s["text"]), " ")
    return pairs.groupBy(*PAGE, "r.region_id").agg(text.alias("text"), F.count(F.lit(1)).alias("n_blocks"), F.avg("b.confidence").alias("average_confidence"))


def metrics(blocks: DataFrame, timings: DataFrame) -> DataFrame:
    """Per page of ``timings`` (seconds): processing time, number of blocks, their mean confidence (0.0 for none) and blocks a second."""
    per = blocks.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("c"))
    n = F.coalesce("n", F.lit(0))
    return timings.join(per, PAGE, "left").select(
        *PAGE, F.col("seconds").alias("processing_time"), n.alias("text_blocks_detected"), F.coalesce("c", F.lit(0.0)).alias("average_confidence"),
        F.coalesce(F.try_divide(n, F.col("seconds")), F.lit(0.0)).alias("blocks_a_second"),
    )


def heights(blocks: DataFrame) -> DataFrame:
    """The distinct upper edges of each page's blocks, ascending."""
    return blocks.groupBy(*PAGE).agg(F.array_sort(F.collect_set("y1")).alias("heights"))


def result_files(words: DataFrame) -> DataFrame:
    """OCR results (as from ``sources.documents.recognise``) as one JSON file for each document: file_name
    (``<doc_id>_ocr.json``) and content, for the file sink. Pages are in order, each with its blocks, their number
    and mean confidence, and its error; a document's pages meet in one row."""
    boxes = F.struct("block_pos", "text", "confidence", F.array("x1", "y1", "x2", "y2").alias("bbox"))
    read = F.when(F.col("error").isNull(), boxes)
    per_page = words.groupBy(*PAGE).agg(
        F.array_sort(F.collect_list(read)).alias("text_blocks"), F.count(read).alias("n_blocks"), F.coalesce(F.avg(F.when(F.col("error").isNull(), F.col("confidence"))), F.lit(0.0)).alias("average_confidence"),
        F.bool_or("fallback_used").alias("fallback_used"), F.max("error").alias("error"),
    )
    page = F.struct("page_number", "text_blocks", "n_blocks", "average_confidence", "fallback_used", "error")
    per_document = per_page.groupBy("doc_id").agg(F.array_sort(F.collect_list(page), lambda a, b: a["page_number"] - b["page_number"]).alias("pages"))
    record = F.struct(F.col("doc_id"), F.size("pages").alias("total_pages"), F.col("pages"))
    return per_document.select(F.concat(F.col("doc_id").cast("string"), F.lit("_ocr.json")).alias("file_name"), F.encode(json_text(record), "UTF-8").alias("content"))
