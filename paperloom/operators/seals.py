"""Seals and signatures from pixels: three masks of a page, outlines, gates, suppression.

A page is read once. Its three detectors see different masks: dark strokes against a Gaussian mean
(round seals), closed thin edges (boxes), and strokes against a plain mean (handwriting). Of each mask
only outermost outlines count, holes filled. What is measured goes through the gates of ``regions`` and
overlapping regions are suppressed, both relational.

Masks are whole-image numpy operations; connected groups are found over the runs of a mask by
pointer jumping, so no Python loop runs over pixels. Outlines are walked only for groups whose box can
pass a gate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import imaging, regions

# Sizes and differences of the masks, edge strengths, least areas of the gates.
SEAL_SIZE, SEAL_LESS = 11, 2
HAND_SIZE, HAND_LESS = 15, 5
WEAK_EDGE, STRONG_EDGE = 50, 150
INK_BELOW = 200
LEAST_AREA = {"circular_seal": 500, "signature_box": 500, "handwritten_signature": 200}
DETECTORS = tuple(LEAST_AREA)
MEASURES = (
    "page_number int, detector string, region_id int, x1 int, y1 int, x2 int, y2 int, area double, perimeter double, vertices int, "
    "width int, height int, content_density double, stroke_density double, solidity double"
)


def blurred(image: np.ndarray, taps: np.ndarray, edge: str = "reflect") -> np.ndarray:
    """Weighted means along rows, then columns, as doubles; outside the page it is mirrored or goes on."""
    out = image.astype(np.float64)
    r = len(taps) // 2
    for axis in (1, 0):
        if edge == "reflect" and out.shape[axis] <= r:
            edge = "edge"
        wide = np.pad(out, [(r, r) if a == axis else (0, 0) for a in (0, 1)], mode=edge)
        n = out.shape[axis]
        out = sum(t * (wide[:, i : i + n] if axis else wide[i : i + n]) for i, t in enumerate(taps))
    return out


def gaussian_taps(size: int) -> np.ndarray:
    if size in (3, 5):
        return np.array([1, 2, 1] if size == 3 else [1, 4, 6, 4, 1]) / (4 if size == 3 else 16)
    spread = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * spread**2))
    return k / k.sum()


def window_means(image: np.ndarray, size: int) -> np.ndarray:
    """Mean of the square around each pixel from a summed-area table: four look-ups, whatever the size."""
    r = size // 2
    h, w = image.shape
    table = np.zeros((h + size, w + size), np.int64)
    np.cumsum(np.cumsum(np.pad(image, r, mode="edge"), axis=0, dtype=np.int64), axis=1, out=table[1:, 1:])
    return (table[size:, size:] - table[:-size, size:] - table[size:, :-size] + table[:-size, :-size]) / (size * size)


def shifted(mask: np.ndarray, places: list[tuple[int, int]], dilate: bool) -> np.ndarray:
    """Any (or all) of the pixels at the places (down, right) from each; what lies outside has no say."""
    h, w = mask.shape
    out = np.full((h, w), not dilate)
    for dy, dx in places:
        y, x = slice(max(0, -dy), min(h, h - dy)), slice(max(0, -dx), min(w, w - dx))
        own = mask[max(0, dy) : max(0, min(h, h + dy)), max(0, dx) : max(0, min(w, w + dx))]
        if dilate:
            out[y, x] |= own
        else:
            out[y, x] &= own
    return out


SQUARE = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
#: An ellipse in two by two pixels, about its lower right one.
SMALL_ELLIPSE = [(-1, 0), (0, -1), (0, 0)]


def closed(mask: np.ndarray, places: list[tuple[int, int]]) -> np.ndarray:
    return shifted(shifted(mask, places, True), places, False)


def thin_edges(image: np.ndarray, weak: int = WEAK_EDGE, strong: int = STRONG_EDGE) -> np.ndarray:
    """Edges one pixel wide: gradients above ``weak`` that are largest across the edge, and hang together
    with one above ``strong``. The direction across is one of four, by its tangent; of equal neighbours
    along a row or column the first counts, on diagonals none."""
    h, w = image.shape
    if not h or not w:
        return np.zeros((h, w), bool)
    g = np.pad(image.astype(np.int32), 1, mode="edge")  # the largest value below is some 80 million
    dx = g[:-2, 2:] + 2 * g[1:-1, 2:] + g[2:, 2:] - g[:-2, :-2] - 2 * g[1:-1, :-2] - g[2:, :-2]
    dy = g[2:, :-2] + 2 * g[2:, 1:-1] + g[2:, 2:] - g[:-2, :-2] - 2 * g[:-2, 1:-1] - g[:-2, 2:]
    size = np.abs(dx) + np.abs(dy)
    m = np.pad(size, 1)
    at = lambda y, x: m[1 + y : 1 + y + h, 1 + x : 1 + x + w]
    low, tangent = np.abs(dy) << 15, np.abs(dx) * 13573  # 13573 is the tangent of 22.5 degrees in 15 bits
    level = low < tangent
    upright = low > tangent + (np.abs(dx) << 16)
    falling = (dx ^ dy) < 0
    slant = np.where(falling, (size > at(-1, 1)) & (size > at(1, -1)), (size > at(-1, -1)) & (size > at(1, 1)))
    largest = np.where(level, (size > at(0, -1)) & (size >= at(0, 1)), np.where(upright, (size > at(-1, 0)) & (size >= at(1, 0)), slant))
    thin = largest & (size > weak)
    found = Groups(thin)
    keeps = np.zeros(found.n, bool)
    for_run = found.group
    loud = np.add.reduceat(np.append((size > strong).ravel(), False).astype(np.int64), np.stack([found.start, found.stop], 1).ravel())[::2] > 0 if len(for_run) else np.zeros(0, bool)
    np.logical_or.at(keeps, for_run, loud)
    return found.painted(keeps)


class Groups:
    """The groups of true pixels that touch (corners included, or sides only), from the runs of the mask:
    ``start`` and ``stop`` of each run in the flat image, and the number of its group. Groups are numbered
    by their first pixels."""

    def __init__(self, mask: np.ndarray, corners: bool = True):
        h, w = mask.shape
        self.shape = (h, w)
        wide = np.zeros(1 + h * (w + 1), bool)
        wide[1:].reshape(h, w + 1)[:, :w] = mask
        change = np.flatnonzero(wide[1:] != wide[:-1])
        a, b = change[::2], change[1::2]  # in rows of w + 1, whose last pixel is false
        self.row = a // (w + 1)
        self.left, self.right = a - self.row * (w + 1), b - self.row * (w + 1)
        self.start, self.stop = a - self.row, b - self.row
        reach = 1 if corners else 0
        # runs of the next row that touch run i are those from ``first`` to before ``last``
        first = np.searchsorted(b, a + (w + 1) + (1 - reach), "left")
        last = np.searchsorted(a, b + (w + 1) - (1 - reach), "right")
        many = np.maximum(last - first, 0)
        upper = np.repeat(np.arange(len(a)), many)
        lower = np.arange(len(upper)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        near = self.row[lower] == self.row[upper] + 1
        upper, lower = upper[near], lower[near]
        root = np.arange(len(a))
        while len(upper):
            one, two = root[upper], root[lower]
            open_ = one != two
            if not open_.any():
                break
            upper, lower, one, two = upper[open_], lower[open_], one[open_], two[open_]
            np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
        roots, self.group = np.unique(root, return_inverse=True)
        self.n = len(roots)
        self.first = roots  # the run with the first pixel

    def boxes(self) -> np.ndarray:
        """x1, y1, x2, y2 of each group."""
        out = np.zeros((self.n, 4), np.int64)
        out[:, :2] = np.iinfo(np.int64).max
        np.minimum.at(out[:, 0], self.group, self.left)
        np.minimum.at(out[:, 1], self.group, self.row)
        np.maximum.at(out[:, 2], self.group, self.right)
        np.maximum.at(out[:, 3], self.group, self.row + 1)
        return out

    def painted(self, keeps: np.ndarray) -> np.ndarray:
        """A mask of the groups that are kept."""
        flags = np.zeros(self.shape[0] * self.shape[1] + 1, np.int32)
        own = keeps[self.group]
        np.add.at(flags, self.start[own], 1)
        np.add.at(flags, self.stop[own], -1)
        return (np.cumsum(flags)[:-1] > 0).reshape(self.shape)

    def mask(self, i: int, box: np.ndarray) -> np.ndarray:
        x1, y1, x2, y2 = box
        out = np.zeros((y2 - y1, x2 - x1), bool)
        for k in np.flatnonzero(self.group == i):
            out[self.row[k] - y1, self.left[k] - x1 : self.right[k] - x1] = True
        return out


def outermost(mask: np.ndarray, found: Groups) -> np.ndarray:
    """Which groups lie in no hole of another: what is above their first pixel hangs together with the
    outside (by sides)."""
    h, w = mask.shape
    around = Groups(~np.pad(mask, 1), corners=False)
    if not found.n:
        return np.zeros(0, bool)
    y, x = found.row[found.first], found.left[found.first]  # the pixel above, in the padded image
    above = np.searchsorted(around.start, y * (w + 2) + x + 1, "right") - 1
    return around.group[above] == around.group[0]


def held(box: np.ndarray, boxes: np.ndarray) -> bool:
    """Whether a box lies inside another on all sides; what does not is in no hole."""
    return bool(((boxes[:, :2] < box[:2]).all(axis=1) & (boxes[:, 2:] > box[2:]).all(axis=1)).any())


def masks(image: np.ndarray) -> dict[str, np.ndarray]:
    """What each detector sees of a grey page."""
    soft = np.rint(blurred(image, gaussian_taps(5)))
    seal = soft <= np.rint(blurred(soft, gaussian_taps(SEAL_SIZE), "edge")) - SEAL_LESS
    box = closed(thin_edges(image), SQUARE)
    soft = np.rint(blurred(image, gaussian_taps(3)))
    hand = closed(soft <= np.rint(window_means(soft.astype(np.int64), HAND_SIZE)) - HAND_LESS, SMALL_ELLIPSE)
    return dict(zip(DETECTORS, (seal, box, hand), strict=True))


def measured(image: np.ndarray) -> list[tuple]:
    """What the gates read of each outermost outline, for each detector, in the order of first pixels."""
    out = []
    number = 0
    for detector, mask in masks(image).items():
        found = Groups(mask)
        boxes = found.boxes()
        # an outline's area is below that of the box between the centres of its outermost pixels
        fits = np.flatnonzero((boxes[:, 2] - boxes[:, 0] - 1) * (boxes[:, 3] - boxes[:, 1] - 1) > LEAST_AREA[detector])
        if any(held(boxes[i], boxes) for i in fits):
            fits = fits[outermost(mask, found)[fits]]
        for i in fits:
            x1, y1, x2, y2 = map(int, boxes[i])
            line = imaging.outline(found.mask(i, boxes[i]))
            area = imaging._area(line)
            if area <= LEAST_AREA[detector]:
                continue
            whole = imaging._area(imaging.hull(line))
            ink, strokes = float((image[y1:y2, x1:x2] <= INK_BELOW).mean()), float(mask[y1:y2, x1:x2].mean())
            out.append((detector, number, x1, y1, x2, y2, area, imaging.perimeter(line), imaging.corners(line), x2 - x1, y2 - y1, ink, strokes, area / whole if whole else 0.0))
            number += 1
    return out


def outlines(pages: DataFrame) -> DataFrame:
    """Measures of the outlines that each page's detectors find, in one pass over the page; pages
    with an error are left out. Colour pages (``channels`` 3) are turned to grey first."""

    def run(frames):
        columns = ["doc_id", *(c.split()[0] for c in MEASURES.split(", "))]
        for f in frames:
            for r in f.itertuples(index=False):
                image = imaging.to_grey(imaging.pixels(r.data, r.height, r.width, r.channels))
                rows = [(r.doc_id, r.page_number, *m) for m in measured(image)]
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    kind = pages.schema["doc_id"].dataType.simpleString()
    own = pages.where("error IS NULL") if "error" in pages.columns else pages
    channels = F.col("channels") if "channels" in pages.columns else F.lit(1).alias("channels")
    return own.select("doc_id", "page_number", "height", "width", channels, "data").mapInPandas(run, f"doc_id {kind}, {MEASURES}")


def detect(pages: DataFrame) -> DataFrame:
    """The seals and signatures of each page: doc_id, page_number, region_id, type, confidence, x1, y1, x2,
    y2, and what was measured. Each detector's outlines pass its own gate; of regions that overlap by more
    than ``regions.LEAST_IOU`` the most confident one stays, at equals the first found."""
    gates = {"circular_seal": regions.seal_gate(), "signature_box": regions.box_gate(), "handwritten_signature": regions.handwriting_gate()}
    passes, confidence = F.lit(False), F.lit(None).cast("double")
    for name, (gate, score) in gates.items():
        own = F.col("detector") == name
        passes, confidence = F.when(own, gate).otherwise(passes), F.when(own, score).otherwise(confidence)
    found = outlines(pages).where(passes).withColumn("confidence", confidence).withColumnRenamed("detector", "type")
    return regions.suppress_overlaps(found)


def crop_files(pages: DataFrame, found: DataFrame) -> DataFrame:
    """The found regions, padded, as images for the file sink: doc_id, page_number, file_name (document, page,
    then type, number and confidence), height, width, channels, data."""
    sizes = pages.select("doc_id", "page_number", "height", "width", *(["channels"] if "channels" in pages.columns else []))
    boxes = regions.crop_boxes(found.drop("height", "width").join(sizes, ["doc_id", "page_number"]))
    place = F.format_string("%s/page_%03d/", F.col("doc_id").cast("string"), F.col("page_number"))
    cut = imaging.crops(pages, boxes.withColumn("file_name", F.concat(place, "file_name")))
    channels = F.coalesce("channels", F.lit(1)) if "channels" in cut.columns else F.lit(1)
    return cut.select("doc_id", "page_number", "file_name", (F.col("y2") - F.col("y1")).alias("height"), (F.col("x2") - F.col("x1")).alias("width"), channels.alias("channels"), "data")
