"""Scanned documents: files, their pages and their text, with pluggable engines.

No rasteriser or OCR engine is part of this package. A rasteriser is a function from the bytes
of a file to pages (uint8 arrays: 2-d for grey, with a third axis of three for colour), an engine one from such a page to words
(text, confidence 0 to 1, x1, y1, x2, y2). Both run once per file or page inside Arrow batches;
a file that fails becomes a row with its error, it doesn't end the job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.imaging import pixels

Rasteriser = Callable[[bytes], Iterable[np.ndarray]]
Engine = Callable[[np.ndarray], Iterable[tuple[str, float, int, int, int, int]]]
#: Bytes of page pixels that a task gathers before it hands them on.
BATCH_BYTES = 32 << 20
PAGE_COLUMNS = ["doc_id", "page_number", "height", "width", "channels", "data", "error"]
WORD_COLUMNS = ["doc_id", "page_number", "block_pos", "text", "confidence", "x1", "y1", "x2", "y2", "fallback_used", "error"]


def scan_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """One row per file below ``folder``: doc_id (its path from there, without extension), path, size_mb, content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    inner = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", folder).strip("/")
    below = F.regexp_extract("path", rf"^.*?/{re.escape(inner)}/(.*?)(\.[^./]*)?$", 1)
    doc_id = F.coalesce(F.nullif(below, F.lit("")), F.col("path"))
    return files.select(doc_id.alias("doc_id"), "path", F.round(F.col("length") / 1048576, 2).alias("size_mb"), "content")


def rasterise(files: DataFrame, engine: Rasteriser) -> DataFrame:
    """Pages (page_number from 1, height, width, channels, data) of each file; one row with an error for a
    file that fails or has no pages. Pages that come before a failure stay."""

    def run(frames):
        rows, size = [], 0
        for f in frames:
            for doc, content in zip(f["doc_id"], f["content"], strict=True):
                try:
                    n = 0
                    for n, image in enumerate(engine(content), 1):
                        data = np.ascontiguousarray(image).astype(np.uint8).tobytes()
                        rows.append((doc, n, *image.shape[:2], 1 if image.ndim == 2 else image.shape[2], data, None))
                        size += len(data)
                        if size >= BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=PAGE_COLUMNS)
                            rows, size = [], 0
                    if not n:
                        raise ValueError("no pages")
                except Exception as e:  # an engine may raise anything; the file is reported, the job goes on
                    rows.append((doc, 0, 0, 0, 1, b"", str(e) or type(e).__name__))
        if rows:
            yield pd.DataFrame(rows, columns=PAGE_COLUMNS)

    kind = files.schema["doc_id"].dataType.simpleString()
    return files.select("doc_id", "content").mapInPandas(run, f"doc_id {kind}, page_number int, height int, width int, channels int, data binary, error string")


def mean_confidence(words: list) -> float:
    return sum(w[1] for w in words) / len(words) if words else 0.0


def engine_words(engine: Engine, image: np.ndarray) -> tuple[list, str | None]:
    """The words with a text and a confidence above 0, or the error."""
    try:
        return [w for w in engine(image) if w[0].strip() and w[1] > 0], None
    except Exception as e:  # an engine may raise anything; the page is reported, the job goes on
        return [], str(e) or type(e).__name__


def words_or_fallback(image: np.ndarray, primary: Engine, fallback: Engine | None, threshold: float) -> tuple[list, str | None, bool]:
    """Words, error, and whether they are the fallback's: it runs only where the primary fails, finds nothing or
    has a mean confidence below the threshold; the better of the two counts, the primary at equals."""
    words, error = engine_words(primary, image)
    if fallback and (error or mean_confidence(words) < threshold):
        other, failed = engine_words(fallback, image)
        if not failed and (error or mean_confidence(other) > mean_confidence(words)):
            return other, None, True
    return words, error, False


def recognise(pages: DataFrame, primary: Engine, fallback: Engine | None = None, threshold: float = 0.6) -> DataFrame:
    """Blocks of each page, by ``words_or_fallback``.

    A page that comes with an error, or on which every engine that ran fails, becomes one row with
    the error, block_pos -1 and no text. A page without words gives no row."""

    def run(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                words, error, used = [], r.error, False
                if not error:
                    words, error, used = words_or_fallback(pixels(r.data, r.height, r.width, r.channels), primary, fallback, threshold)
                if error:
                    rows.append((r.doc_id, r.page_number, -1, None, None, None, None, None, None, used, error))
                rows += [(r.doc_id, r.page_number, i, *w, used, None) for i, w in enumerate(words)]
            frame = pd.DataFrame(rows, columns=WORD_COLUMNS, dtype=object)
            yield frame

    kind = pages.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, page_number int, block_pos int, text string, confidence double, x1 int, y1 int, x2 int, y2 int, fallback_used boolean, error string"
    return pages.select("doc_id", "page_number", "height", "width", channels_of(pages), "data", "error").mapInPandas(run, schema)


def channels_of(pages: DataFrame) -> Column:
    return (F.coalesce("channels", F.lit(1)) if "channels" in pages.columns else F.lit(1)).cast("int").alias("channels")


def recognise_regions(pages: DataFrame, boxes: DataFrame, primary: Engine, fallback: Engine | None = None, threshold: float = 0.6) -> DataFrame:
    """Blocks of regions of pages: ``boxes`` (doc_id, page_number, region_id, x1, y1, x2, y2) are cut from their
    page and each is read as ``recognise`` reads a page. Rows have the region's id, its box (region_x1 ...),
    and the block's box in the page's pixels.

    A region is clamped to its page; one with nothing left, one on which every engine fails, and one whose page
    carries an error or is missing is a row with the error and block_pos -1. A region without words gives no row.
    The regions of a page travel in its row, so its pixels are sent and decoded once. The join hashes the regions and
    streams the pages: pixels that an expression makes look small to the optimiser, which would broadcast them."""
    per_page = boxes.groupBy("doc_id", "page_number").agg(F.collect_list(F.struct("region_id", "x1", "y1", "x2", "y2")).alias("regions")).hint("shuffle_hash")
    own = per_page.join(pages.select("doc_id", "page_number", "height", "width", channels_of(pages), "data", "error"), ["doc_id", "page_number"], "left")
    columns = ["doc_id", "page_number", "region_id", "region_x1", "region_y1", "region_x2", "region_y2", *WORD_COLUMNS[2:]]

    def run(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                gone = r.data is None
                image = None if gone or r.error else pixels(r.data, int(r.height), int(r.width), int(r.channels))
                for g in r.regions:
                    x1, y1 = max(0, g["x1"]), max(0, g["y1"])
                    error, used, words = r.error or ("no such page" if gone else None), False, []
                    if not error:
                        cut = image[y1 : max(0, g["y2"]), x1 : max(0, g["x2"])]
                        words, error, used = words_or_fallback(cut, primary, fallback, threshold) if cut.size else ([], "the region lies outside its page", False)
                    head = (r.doc_id, r.page_number, g["region_id"], g["x1"], g["y1"], g["x2"], g["y2"])
                    if error:
                        rows.append((*head, -1, None, None, None, None, None, None, used, error))
                    rows += [(*head, i, t, c, a + x1, b + y1, d + x1, e + y1, used, None) for i, (t, c, a, b, d, e) in enumerate(words)]
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    kind, region = pages.schema["doc_id"].dataType.simpleString(), boxes.schema["region_id"].dataType.simpleString()
    box = ", ".join(f"region_{c} int" for c in ("x1", "y1", "x2", "y2"))
    schema = f"doc_id {kind}, page_number int, region_id {region}, {box}, block_pos int, text string, confidence double, x1 int, y1 int, x2 int, y2 int, fallback_used boolean, error string"
    return own.select("doc_id", "page_number", "height", "width", "channels", "data", "error", "regions").mapInPandas(run, schema)


def page_counts(pages: DataFrame) -> DataFrame:
    """Per file the number of its pages, and its error if it has one."""
    return pages.groupBy("doc_id").agg(F.count_if(F.col("page_number") > 0).alias("n_pages"), F.max("error").alias("error"))


def page_file_name(prefix: str, extension: str = "png"):
    """``<prefix>_<page as three digits>.<extension>``."""
    return F.format_string(f"{prefix}_%03d.{extension}", F.col("page_number"))


def write_page_images(pages: DataFrame, folder: str) -> None:
    """Pixels of every page as portable grey maps (a header, then the bytes), in one Parquet row each with
    the file name it would have; folders of single small files don't scale."""
    head = F.encode(F.format_string("P5\n%d %d\n255\n", "width", "height"), "US-ASCII")
    name = F.concat_ws("/", "doc_id", page_file_name("page", "pgm"))
    pages.where("error IS NULL").select("doc_id", "page_number", name.alias("file_name"), F.concat(head, "data").alias("content")).write.mode("overwrite").parquet(folder)


def page_files(pages: DataFrame, prefix: str = "page", extension: str = "png") -> DataFrame:
    """Pages without errors as images for the file sink, each named below its document."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit("/"), page_file_name(prefix, extension))
    return pages.where("error IS NULL").select(name.alias("file_name"), "height", "width", channels_of(pages), "data")
