"""Seal and signature regions: gates on measured contours, overlap, suppression, presence."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Gates on contour measures.
MIN_AREA, MAX_AREA, LEAST_CIRCULARITY = 500, 50000, 0.4
LEAST_IOU = 0.3


def seal_gate() -> tuple[Column, Column]:
    """Whether a contour (area, perimeter) is a round one of middling area, and the confidence."""
    circularity = 4 * math.pi * F.col("area") / (F.col("perimeter") * F.col("perimeter"))
    sized = (F.col("area") > MIN_AREA) & (F.col("area") < MAX_AREA) & (F.col("perimeter") > 0)
    return sized & (circularity > LEAST_CIRCULARITY), F.least(circularity * 2, F.lit(1.0))


def box_gate() -> tuple[Column, Column]:
    """Whether a contour (area, vertices, width, height, content_density) is a box with something in it."""
    aspect = F.col("width") / F.col("height")
    sized = (F.col("area") > MIN_AREA) & (F.col("area") < MAX_AREA) & F.col("vertices").between(4, 8) & (F.col("height") > 0)
    return sized & (aspect > 0.2) & (aspect < 5) & (F.col("content_density") > 0.1), F.least(F.col("content_density") * 2, F.lit(1.0))


def handwriting_gate() -> tuple[Column, Column]:
    """Whether a contour (area, width, height, stroke_density, solidity) is wide, sparse and ragged."""
    aspect, d, s = F.col("width") / F.col("height"), F.col("stroke_density"), F.col("solidity")
    sized = (F.col("area") > 200) & (F.col("area") < 20000) & (F.col("height") > 0) & (aspect > 1.5) & (aspect < 8)
    return sized & (d > 0.05) & (d < 0.4) & (s < 0.8), F.least((1 - s) * d * 3, F.lit(1.0))


def _gated(contours: DataFrame, gate: tuple[Column, Column], name: str) -> DataFrame:
    return contours.where(gate[0]).withColumn("type", F.lit(name)).withColumn("confidence", gate[1])


def circular_seals(contours: DataFrame) -> DataFrame:
    """From area and perimeter: round contours of middling area."""
    circularity = 4 * math.pi * F.col("area") / (F.col("perimeter") * F.col("perimeter"))
    return _gated(contours, seal_gate(), "circular_seal").withColumn("circularity", circularity)


def signature_boxes(contours: DataFrame) -> DataFrame:
    """From area, vertices, width, height and content density: boxes with something in them."""
    return _gated(contours, box_gate(), "signature_box")


def handwriting(contours: DataFrame) -> DataFrame:
    """From area, width, height, stroke density and solidity: wide, sparse, ragged contours."""
    return _gated(contours, handwriting_gate(), "handwritten_signature")


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two box structs (x1, y1, x2, y2); 0 where they only touch."""
    w = F.greatest(F.lit(0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    both = (w * h).cast("double")
    area = lambda x: (x["x2"] - x["x1"]) * (x["y2"] - x["y1"])
    return F.when(both > 0, both / (area(a) + area(b) - both)).otherwise(F.lit(0.0))


def overlapping_pairs(regions: DataFrame, least: float = 0.0) -> DataFrame:
    """Pairs of regions of one page (region_id) with an IoU above ``least``.

    Regions are dealt to cells of 256 pixels, so that only those meet that share a cell; of the
    cells that two share the one with their intersection's corner counts.
    """
    box = F.struct("x1", "y1", "x2", "y2")
    size = 256
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    own = regions.select("doc_id", "page_number", "region_id", box.alias("box"), "x1", "y1", "x2", "y2")
    dealt = own.withColumn("cx", cells("x1", "x2")).withColumn("cy", cells("y1", "y2")).select("doc_id", "page_number", "cx", "cy", "region_id", "box")
    other = dealt.withColumnsRenamed({"region_id": "other_id", "box": "other_box"})
    pairs = dealt.join(other, ["doc_id", "page_number", "cx", "cy"]).where(F.col("region_id") < F.col("other_id"))
    corner = (F.floor(F.greatest("box.x1", "other_box.x1") / size) == F.col("cx")) & (F.floor(F.greatest("box.y1", "other_box.y1") / size) == F.col("cy"))
    scored = pairs.where(corner).select("doc_id", "page_number", "region_id", "other_id", iou(F.col("box"), F.col("other_box")).alias("iou"))
    return scored.where(F.col("iou") > least)


def suppress_overlaps(regions: DataFrame, most: float = LEAST_IOU, keys: tuple[str, ...] = ("doc_id", "page_number")) -> DataFrame:
    """Regions in order of confidence (then region_id), each kept unless its IoU with a kept one
    exceeds ``most``. One page's regions are folded over within the row of an aggregate."""
    rest = [c for c in regions.columns if c not in (*keys, "confidence", "region_id", "x1", "y1", "x2", "y2")]
    cell = F.struct((-F.col("confidence")).alias("order"), "region_id", "x1", "y1", "x2", "y2", "confidence", *rest)
    pages = regions.groupBy(*keys).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    kind = pages.schema["cells"].dataType.simpleString()
    kept = F.aggregate(
        "cells",
        F.array().cast(kind),
        lambda acc, r: F.when(F.exists(acc, lambda k: iou(k, r) > most), acc).otherwise(F.array_append(acc, r)),
    )
    return pages.select(*keys, F.explode(kept).alias("r")).select(*keys, "r.*").drop("order")


def seal_presence(documents: DataFrame, regions: DataFrame) -> DataFrame:
    """Per document of ``documents``: number of regions, by type, greatest and mean confidence, status."""
    types = regions.groupBy("doc_id", "type").agg(F.count(F.lit(1)).alias("n"), F.max("confidence").alias("top"), F.sum("confidence").alias("sum"))
    per = types.groupBy("doc_id").agg(
        F.sum("n").alias("total_detections"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("seal_types"),
        F.max("top").alias("highest_confidence"),
        (F.sum("sum") / F.sum("n")).alias("average_confidence"),
    )
    out = documents.select("doc_id").distinct().join(per, "doc_id", "left")
    c = F.round("average_confidence", 9)  # so that the order in which confidences are added can't decide
    status = F.when(c.isNull(), "no_seals_detected").when(c > 0.7, "high_confidence").when(c > 0.4, "medium_confidence").otherwise("low_confidence")
    return out.select(
        "doc_id",
        F.col("total_detections").isNotNull().alias("has_seals"),
        F.coalesce("total_detections", F.lit(0)).alias("total_detections"),
        F.coalesce("seal_types", F.create_map().cast("map<string,bigint>")).alias("seal_types"),
        F.coalesce("highest_confidence", F.lit(0.0)).alias("highest_confidence"),
        F.coalesce("average_confidence", F.lit(0.0)).alias("average_confidence"),
        status.alias("validation_status"),
    )


def crop_boxes(regions: DataFrame, pad: int = 10) -> DataFrame:
    """Boxes padded and clamped to their page (width, height), and the file name of each crop."""
    order = F.col("region_id").cast("string")
    return regions.withColumns({
        "x1": F.greatest(F.lit(0), F.col("x1") - pad), "y1": F.greatest(F.lit(0), F.col("y1") - pad),
        "x2": F.least(F.col("width"), F.col("x2") + pad), "y2": F.least(F.col("height"), F.col("y2") + pad),
        "file_name": F.concat(F.col("type"), F.lit("_"), order, F.lit("_conf_"), F.format_string("%.2f", "confidence"), F.lit(".png")),
    }).where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
