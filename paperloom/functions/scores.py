"""Confidence scores: categories, normalisation, means, and the score of an extracted field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two category scales. The first is exclusive, the second inclusive.
HIGH, MEDIUM = 0.8, 0.5
SCALE = (("HIGH", 0.9), ("MEDIUM", 0.7), ("LOW", 0.5))


def category(confidence: Column) -> Column:
    return F.when(confidence > HIGH, "high").when(confidence > MEDIUM, "medium").otherwise("low")


def grade(confidence: Column) -> Column:
    out = None
    for name, least in SCALE:
        out = F.when(confidence >= least, name) if out is None else out.when(confidence >= least, name)
    return out.otherwise("VERY_LOW")


def normalise(value: Column, low: float, high: float) -> Column:
    """Min-max to 0..1, clamped; 0.0 for an empty range."""
    if high == low:
        return F.lit(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low)))


def weighted_mean(values: Column, weights: Column) -> Column:
    """Of two arrays: the weighted mean, the plain mean if the lengths differ, 0.0 for none."""
    add = lambda acc, x: acc + x
    total = lambda a: F.aggregate(a, F.lit(0.0), add)
    plain = F.try_divide(total(values), F.size(values))
    weighted = F.try_divide(total(F.zip_with(values, weights, lambda v, w: v * w)), total(weights))
    return F.coalesce(F.when(F.size(values) == F.size(weights), weighted).otherwise(plain), F.lit(0.0))


def field_confidence(text: Column, ocr_confidence: Column) -> Column:
    """The OCR confidence, moved by the length and the characters of the field, within 0..1."""
    n = F.length(text)
    moved = (
        ocr_confidence
        + F.when(n >= 5, 0.1).when(n <= 2, -0.2).otherwise(0.0)
        + F.when(text.rlike(r"^[A-Za-z0-9\-/]+\z"), 0.1).otherwise(0.0)
        - F.when(text.rlike(r"[^\p{L}\p{N}_\s\-/.,]"), 0.1).otherwise(0.0)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved))
