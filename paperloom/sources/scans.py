"""Made page images, by rule from the supplier table: the tables hold no pictures of their own.

``marked_pages`` are white pages with a round seal and a filled signature box where the supplier's number
says so; ``numbered_pages`` hold pixels that a formula gives. Both are built of expressions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The marked page.
HEIGHT, WIDTH = 160, 200
BOX_WIDTH, BOX_HEIGHT = 110, 24


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a session on this machine alone may name none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.partition("[")[0] == "local":
        return "/tmp/checkpoints"
    raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")


def marks(suppliers: DataFrame) -> DataFrame:
    """doc_id, and where the supplier's page has its seal (cx, cy, r; null for none) and box (bx, by; null for none)."""
    s = F.col("s_suppkey")
    sealed, boxed = s % 5 != 0, s % 7 != 0
    return suppliers.select(
        s.alias("doc_id"),
        F.when(sealed, 40 + s % 50).cast("int").alias("cx"), F.when(sealed, 45 + s % 7).cast("int").alias("cy"), F.when(sealed, 15 + 3 * (s % 3)).cast("int").alias("r"),
        F.when(boxed, 20 + s % 40).cast("int").alias("bx"), F.when(boxed, 100 + s % 11).cast("int").alias("by"),
    )


def marked_pages(suppliers: DataFrame) -> DataFrame:
    """One grey page for each supplier: doc_id, page_number, height, width, channels, data, error."""
    white = lambda n: F.repeat(F.lit("FF"), n)
    line = lambda start, n: F.concat(white(start), F.repeat(F.lit("00"), n), white(WIDTH - start - n))

    def row(y: Column) -> Column:
        dy = F.abs(y - F.col("cy"))
        half = F.floor(F.sqrt((F.col("r") * F.col("r") - dy * dy).cast("double"))).cast("int")
        in_seal, in_box = F.coalesce(dy <= F.col("r"), F.lit(False)), F.coalesce((y >= F.col("by")) & (y < F.col("by") + BOX_HEIGHT), F.lit(False))
        return F.when(in_seal, line(F.col("cx") - half, 2 * half + 1)).when(in_box, line(F.col("bx"), F.lit(BOX_WIDTH))).otherwise(white(F.lit(WIDTH)))

    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(HEIGHT - 1)), row), ""))
    return marks(suppliers).select("doc_id", F.lit(1).alias("page_number"), F.lit(HEIGHT).alias("height"), F.lit(WIDTH).alias("width"), F.lit(1).alias("channels"), data.alias("data"), F.lit(None).cast("string").alias("error"))


def numbered_files(suppliers: DataFrame) -> DataFrame:
    """One file of one to three grey pages for each supplier: file_name and content (portable maps, one after another)."""
    s = F.col("s_suppkey")
    height, width = 6 + s % 5, 5 + s % 7
    head = F.encode(F.format_string("P5\n%d %d\n255\n", width, height), "US-ASCII")

    def page(p: Column) -> Column:
        value = lambda i: F.lpad(F.hex((s * 31 + p * 17 + i * 7) % 256), 2, "0")
        return F.concat(head, F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), (height * width - 1).cast("int")), value), "")))

    pages = F.transform(F.sequence(F.lit(1), (1 + s % 3).cast("int")), page)
    return suppliers.select(F.format_string("scans/S%06d.pgm", s).alias("file_name"), F.aggregate(pages, F.lit(b""), lambda acc, x: F.concat(acc, x)).alias("content"))


def coloured_files(suppliers: DataFrame) -> DataFrame:
    """One file with one colour page for each supplier: file_name and content."""
    s = F.col("s_suppkey")
    height, width = 4 + s % 3, 6 + s % 4
    value = lambda i: F.lpad(F.hex((s * 53 + i * 37 + (i % 3) * 11) % 256), 2, "0")
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), (height * width * 3 - 1).cast("int")), value), ""))
    head = F.encode(F.format_string("P6\n%d %d\n255\n", width, height), "US-ASCII")
    return suppliers.select(F.format_string("C%06d.ppm", s).alias("file_name"), F.concat(head, data).alias("content"))


def box_regions(suppliers: DataFrame, pad: int = 5) -> DataFrame:
    """The padded boxes of the marked pages as regions, and for every ninth supplier one outside its page."""
    own = marks(suppliers).where("bx IS NOT NULL").select(
        "doc_id", F.lit(1).alias("page_number"), F.lit(0).alias("region_id"), (F.col("bx") - pad).alias("x1"), (F.col("by") - pad).alias("y1"), (F.col("bx") + BOX_WIDTH + pad).alias("x2"), (F.col("by") + BOX_HEIGHT + pad).alias("y2")
    )
    outside = suppliers.where("s_suppkey % 9 = 0").select(F.col("s_suppkey").alias("doc_id"), F.lit(1).alias("page_number"), F.lit(1).alias("region_id"), F.lit(WIDTH).alias("x1"), F.lit(0).alias("y1"), F.lit(WIDTH + 9).alias("x2"), F.lit(9).alias("y2"))
    return own.unionByName(outside)
