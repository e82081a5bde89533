"""Page images: thresholds, denoising, morphology, quality.

A page is a row (doc_id, page_number, height, width, data) of 8-bit values, row by row; with a column
``channels`` of 3, each pixel has its red, green and blue value one after another.
Kernels run on one page at a time inside Arrow batches; what counts over pixels of many pages
(histograms, thresholds) is relational.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sizes, spreads, thresholds and factors of the kernels.
BILATERAL_RADIUS, BILATERAL_SPREAD = 4, 75.0
ADAPTIVE_SIZE, ADAPTIVE_LESS, FIXED_THRESHOLD = 11, 2, 127
CONTRAST, BRIGHTNESS, SHARPNESS = 1.2, 1.1, 1.1
EDGE_STRENGTH, LINE_VOTES, MOST_SKEW, LEAST_SKEW = 150, 100, 45.0, 0.5
RULE_LENGTH = 40
NLM_STRENGTH, NLM_PATCH, NLM_SEARCH = 10.0, 7, 21
#: Bytes of page pixels that a task gathers before it hands them on; rows that non-local means take at once.
BATCH_BYTES, NLM_STRIP = 32 << 20, 128
GREY_WEIGHTS = (19595, 38470, 7471)  # red, green and blue, of 65536


def otsu_threshold(histogram: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, from rows (value, n): the smallest value that, as the upper bound of the dark
    class, separates the classes with the largest variance between them."""
    up = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    h = histogram.select(
        *keys, "value", F.sum("n").over(up).alias("w0"), F.sum(F.col("n") * F.col("value")).over(up).alias("s0"),
        F.sum("n").over(whole).alias("w"), F.sum(F.col("n") * F.col("value")).over(whole).alias("s"),
    )
    w1 = F.col("w") - F.col("w0")
    apart = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1
    scored = h.withColumn("between", F.when(w1 > 0, F.round(F.col("w0") * w1 * apart * apart / (F.col("w") * F.col("w")), 6)).otherwise(F.lit(0.0)))
    return scored.groupBy(*keys).agg(F.max_by("value", F.struct("between", -F.col("value"))).alias("threshold"))


def _grey(data: bytes, height: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width)


def pixels(data: bytes, height: int, width: int, channels: int | None = 1) -> np.ndarray:
    """A page's pixels: height x width, with a third axis of red, green and blue if it has colours."""
    flat = np.frombuffer(data, np.uint8)
    return flat.reshape(height, width) if channels in (None, 1) else flat.reshape(height, width, channels)


def to_grey(image: np.ndarray) -> np.ndarray:
    """Luma of a colour page, in whole numbers and rounded; a grey one as it is."""
    if image.ndim == 2:
        return image
    weighed = sum(w * image[..., c].astype(np.int64) for c, w in enumerate(GREY_WEIGHTS))
    return ((weighed + (1 << 15)) >> 16).astype(np.uint8)


def _windows(image: np.ndarray, size: int) -> np.ndarray:
    return sliding_window_view(np.pad(image, size // 2, mode="edge"), (size, size))


def median(image: np.ndarray, size: int = 5) -> np.ndarray:
    return np.median(_windows(image, size), axis=(2, 3)).astype(np.uint8)


def gaussian(image: np.ndarray) -> np.ndarray:
    k = np.array([1, 4, 6, 4, 1], np.float64) / 16
    return np.rint(np.einsum("ijkl,k,l->ij", _windows(image, 5), k, k)).astype(np.uint8)


def bilateral(image: np.ndarray) -> np.ndarray:
    """Mean of the disc around each pixel, weighed by distance in place and in grey value."""
    g, r = image.astype(np.float64), BILATERAL_RADIUS
    h, w = g.shape
    padded = np.pad(g, r, mode="edge")
    total, weight = np.zeros_like(g), np.zeros_like(g)
    for y in range(-r, r + 1):
        for x in range(-r, r + 1):
            if x * x + y * y <= r * r:
                other = padded[r + y : r + y + h, r + x : r + x + w]
                near = np.exp(-((other - g) ** 2 + x * x + y * y) / (2 * BILATERAL_SPREAD**2))
                total += near * other
                weight += near
    return np.rint(total / weight).astype(np.uint8)


def bilateral_colour(image: np.ndarray) -> np.ndarray:
    """As ``bilateral``, all channels with one weight, by the sum of their differences."""
    g, r = image.astype(np.float64), BILATERAL_RADIUS
    h, w, _ = g.shape
    padded = np.pad(g, ((r, r), (r, r), (0, 0)), mode="edge")
    total, weight = np.zeros_like(g), np.zeros((h, w, 1))
    for y in range(-r, r + 1):
        for x in range(-r, r + 1):
            if x * x + y * y <= r * r:
                other = padded[r + y : r + y + h, r + x : r + x + w]
                apart = np.abs(other - g).sum(axis=2, keepdims=True)
                near = np.exp(-(apart * apart + x * x + y * y) / (2 * BILATERAL_SPREAD**2))
                total += near * other
                weight += near
    return np.rint(total / weight).astype(np.uint8)


def non_local_means(image: np.ndarray, strength: float = NLM_STRENGTH, patch: int = NLM_PATCH, search: int = NLM_SEARCH) -> np.ndarray:
    """Mean of the pixels around each, weighed by how alike the patches about them are: exp of minus
    their mean squared difference (over the channels too) by ``strength`` squared. For each of the shifts the
    patch distances of a strip of rows come from one summed-area table, so the cost is that of the
    shifts alone, whatever the patch, and memory that of a strip. Outside the page is its mirror image."""
    g = image if image.ndim == 3 else image[:, :, None]
    h, w, channels = g.shape
    if not g.size:
        return image
    p, r = patch // 2, search // 2
    columns, rows = (np.pad(np.arange(n), p + r, mode="reflect" if n > 1 else "edge") for n in (w, h))
    out = np.empty_like(g)
    for top in range(0, h, NLM_STRIP):
        n = min(NLM_STRIP, h - top)
        own = g[rows[top : top + n + 2 * (p + r)]][:, columns].astype(np.float32)
        centre = own[r : r + n + 2 * p, r : r + w + 2 * p]
        total, weight = np.zeros((n, w, channels), np.float32), np.zeros((n, w, 1), np.float32)
        for y in range(search):
            for x in range(search):
                other = own[y : y + n + 2 * p, x : x + w + 2 * p]
                apart = np.square(other - centre).sum(axis=2, dtype=np.float64)
                table = np.zeros((n + patch, w + patch))
                np.cumsum(np.cumsum(apart, axis=0), axis=1, out=table[1:, 1:])
                mean = (table[patch:, patch:] - table[:-patch, patch:] - table[patch:, :-patch] + table[:-patch, :-patch]) / (patch * patch * channels)
                near = np.exp(-np.maximum(mean, 0) / (strength * strength)).astype(np.float32)[:, :, None]
                total += near * other[p : p + n, p : p + w]
                weight += near
        out[top : top + n] = np.rint(total / weight)
    return out.reshape(image.shape)


def _otsu(image: np.ndarray) -> int:
    n = np.bincount(image.ravel(), minlength=256).astype(np.float64)
    w0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    w1 = w0[-1] - w0
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.nan_to_num(w0 * w1 * (s0 / w0 - (s0[-1] - s0) / w1) ** 2)
    return int(np.argmax(between))


def _two(bright: np.ndarray) -> np.ndarray:
    return np.where(bright, 255, 0).astype(np.uint8)


def binarise(image: np.ndarray) -> np.ndarray:
    """255 above the image's own Otsu threshold, else 0."""
    return _two(image > _otsu(image))


def binarise_fixed(image: np.ndarray) -> np.ndarray:
    return _two(image > FIXED_THRESHOLD)


def binarise_adaptive(image: np.ndarray) -> np.ndarray:
    """255 above the Gaussian mean of the pixel's surroundings less a constant, else 0."""
    spread = 0.3 * ((ADAPTIVE_SIZE - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(ADAPTIVE_SIZE) - ADAPTIVE_SIZE // 2) ** 2) / (2 * spread**2))
    mean = np.einsum("ijkl,k,l->ij", _windows(image, ADAPTIVE_SIZE), k / k.sum(), k / k.sum())
    return _two(image > np.rint(mean) - ADAPTIVE_LESS)


def close_and_open(image: np.ndarray) -> np.ndarray:
    """Grey closing, then opening, with a 3 by 3 square: thin lines and specks go."""
    low = lambda x: _windows(x, 3).min(axis=(2, 3))
    high = lambda x: _windows(x, 3).max(axis=(2, 3))
    return high(low(low(high(image))))


def _blend(base: np.ndarray | float, image: np.ndarray, factor: float) -> np.ndarray:
    return np.clip(base + (image.astype(np.float64) - base) * factor, 0, 255).astype(np.uint8)


def sharpen(image: np.ndarray, factor: float = SHARPNESS) -> np.ndarray:
    """Away from the smoothed image; the outermost pixels stay."""
    if min(image.shape) < 3:
        return image
    smooth = image.astype(np.float64)
    smooth[1:-1, 1:-1] = np.rint((sliding_window_view(image, (3, 3)).sum(axis=(2, 3)) + 4.0 * image[1:-1, 1:-1]) / 13)
    return _blend(smooth, image, factor)


def contrast(image: np.ndarray) -> np.ndarray:
    """Away from the mean grey, then brighter, then sharper."""
    if not image.size:
        return image
    return sharpen(_blend(0.0, _blend(float(int(image.mean() + 0.5)), image, CONTRAST), BRIGHTNESS))


def _lanczos(old: int, new: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``new`` places the indices and weights of the six old ones around it."""
    centre = (np.arange(new) + 0.5) * old / new - 0.5
    at = np.floor(centre).astype(int)[:, None] + np.arange(-2, 4)
    x = at - centre[:, None]
    weight = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0) * ((at >= 0) & (at < old))
    return np.clip(at, 0, old - 1), weight / weight.sum(axis=1, keepdims=True)


def enlarge(image: np.ndarray, least_height: int = 1200) -> np.ndarray:
    """By windowed sinc to ``least_height`` if the page is lower; the width follows."""
    h, w = image.shape
    if h >= least_height or not h or not w:
        return image
    g = image.astype(np.float64)
    for axis, new in ((1, max(1, w * least_height // h)), (0, least_height)):
        at, weight = _lanczos(g.shape[axis], new)
        taps = [np.take(g, at[:, k], axis) * (weight[:, k] if axis else weight[:, k, None]) for k in range(6)]
        g = sum(taps[1:], taps[0])
    return np.clip(np.rint(g), 0, 255).astype(np.uint8)


def line_angles(image: np.ndarray) -> np.ndarray:
    """Degrees from level of the straight lines that at least ``LINE_VOTES`` edge pixels lie on, by
    votes over whole degrees and distances."""
    if min(image.shape, default=0) < 3:
        return np.empty(0)
    g = image.astype(np.int64)
    dx = g[:-2, 2:] + 2 * g[1:-1, 2:] + g[2:, 2:] - g[:-2, :-2] - 2 * g[1:-1, :-2] - g[2:, :-2]
    dy = g[2:, :-2] + 2 * g[2:, 1:-1] + g[2:, 2:] - g[:-2, :-2] - 2 * g[:-2, 1:-1] - g[:-2, 2:]
    y, x = np.nonzero(np.abs(dx) + np.abs(dy) > EDGE_STRENGTH)
    out = []
    for degrees in range(180):
        t = np.radians(degrees)
        distance = np.rint(x * np.cos(t) + y * np.sin(t)).astype(int)
        votes = np.bincount(distance - distance.min()) if len(distance) else np.empty(0, int)
        out += [degrees - 90.0] * int((votes >= LINE_VOTES).sum())
    return np.array([a for a in out if abs(a) <= MOST_SKEW])


def rotate(image: np.ndarray, degrees: float) -> np.ndarray:
    """Counter-clockwise by the nearest pixel, on a page large enough, white where nothing was."""
    t = np.radians(degrees)
    c, s = np.cos(t), np.sin(t)
    h, w = image.shape
    new_h, new_w = int(np.ceil(abs(w * s) + abs(h * c) - 1e-9)), int(np.ceil(abs(w * c) + abs(h * s) - 1e-9))
    y, x = np.mgrid[0:new_h, 0:new_w]
    y, x = y + 0.5 - new_h / 2, x + 0.5 - new_w / 2
    old_x, old_y = np.floor(c * x - s * y + w / 2).astype(int), np.floor(s * x + c * y + h / 2).astype(int)
    inside = (old_x >= 0) & (old_x < w) & (old_y >= 0) & (old_y < h)
    return np.where(inside, image[np.clip(old_y, 0, h - 1), np.clip(old_x, 0, w - 1)], 255).astype(np.uint8)


def deskew(image: np.ndarray) -> np.ndarray:
    """Turned back by the median angle of its lines, if that is beyond ``LEAST_SKEW``."""
    angles = line_angles(image)
    skew = float(np.median(angles)) if len(angles) else 0.0
    return rotate(image, skew) if abs(skew) > LEAST_SKEW else image


def per_channel(step: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    """The step on a grey page, or on each channel of a colour page."""
    return lambda image: step(image) if image.ndim == 2 else np.stack([step(image[:, :, c]) for c in range(image.shape[2])], axis=2)


def contrast_any(image: np.ndarray) -> np.ndarray:
    """As ``contrast``; a colour page goes away from the mean of its greys."""
    if image.ndim == 2 or not image.size:
        return contrast(image)
    return per_channel(sharpen)(_blend(0.0, _blend(float(int(to_grey(image).mean() + 0.5)), image, CONTRAST), BRIGHTNESS))


def deskew_any(image: np.ndarray) -> np.ndarray:
    """As ``deskew``; a colour page is turned by the lines of its greys."""
    if image.ndim == 2:
        return deskew(image)
    angles = line_angles(to_grey(image))
    skew = float(np.median(angles)) if len(angles) else 0.0
    return per_channel(lambda c: rotate(c, skew))(image) if abs(skew) > LEAST_SKEW else image


def on_grey(step: Callable[[np.ndarray], np.ndarray], colours: bool = False) -> Callable[[np.ndarray], np.ndarray]:
    """The step on the greys of a page; with ``colours`` a colour page keeps three (equal) channels."""
    return lambda image: np.repeat(step(to_grey(image))[:, :, None], 3, axis=2) if colours and image.ndim == 3 else step(to_grey(image))


STEPS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "resize": per_channel(enlarge), "denoise": lambda image: bilateral(image) if image.ndim == 2 else bilateral_colour(image), "median": per_channel(median),
    "smooth": per_channel(gaussian), "nlm": non_local_means, "enhance_contrast": contrast_any, "sharpen": per_channel(sharpen), "deskew": deskew_any,
    "remove_borders": on_grey(close_and_open, True), "grey": to_grey, "binarize": on_grey(binarise), "binarize_adaptive": on_grey(binarise_adaptive), "binarize_fixed": on_grey(binarise_fixed),
}
DEFAULT_STEPS = ("resize", "denoise", "enhance_contrast", "deskew", "remove_borders", "binarize")


def preprocess(pages: DataFrame, steps: Sequence[str] = DEFAULT_STEPS) -> DataFrame:
    """Pages after the named steps, with the steps done. Unknown steps are passed over; a page that
    fails keeps its pixels and carries the error, as does one that comes with an error. Colour pages
    (``channels`` 3) stay so until a step makes them grey. Pages leave a task by ``BATCH_BYTES`` of pixels."""
    known = [s for s in steps if s in STEPS]
    columns = ["doc_id", "page_number", "height", "width", "channels", "data", "steps", "error"]

    def run(frames):
        rows, size = [], 0
        for f in frames:
            for r in f.itertuples(index=False):
                done, error, image = [], r.error, None
                if not error:
                    try:
                        image = pixels(r.data, r.height, r.width, r.channels)
                        for s in known:
                            image = STEPS[s](image)
                        done = known
                    except ValueError as e:
                        error = str(e)
                if error:
                    rows.append((r.doc_id, r.page_number, r.height, r.width, r.channels, r.data, [], error))
                else:
                    rows.append((r.doc_id, r.page_number, *image.shape[:2], 1 if image.ndim == 2 else 3, image.tobytes(), done, None))
                size += len(rows[-1][5] or b"")
                if size >= BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    kind = pages.schema["doc_id"].dataType.simpleString()
    error = F.col("error") if "error" in pages.columns else F.lit(None).cast("string").alias("error")
    channels = F.coalesce("channels", F.lit(1)) if "channels" in pages.columns else F.lit(1)
    schema = f"doc_id {kind}, page_number int, height int, width int, channels int, data binary, steps array<string>, error string"
    return pages.select("doc_id", "page_number", "height", "width", channels.cast("int").alias("channels"), "data", error).mapInPandas(run, schema)


def components(dark: np.ndarray) -> list[tuple[int, int, int, int, np.ndarray]]:
    """(x1, y1, x2, y2, mask) of each group of true pixels that touch, corners included, in the order of
    their first pixels. Runs of a row are joined to those of the row above."""
    parent: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs, above = [], []
    for y, row in enumerate(dark):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], row.astype(np.int8), [0]])))
        own = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            k = len(parent)
            parent.append(k)
            for a2, b2, other in above:
                if a2 <= b and a <= b2:
                    low, high = sorted((root(k), root(other)))
                    parent[high] = low
            own.append((a, b, k))
            runs.append((y, a, b, k))
        above = own
    groups: dict[int, list] = {}
    for y, a, b, k in runs:
        groups.setdefault(root(k), []).append((y, a, b))
    out = []
    for own in groups.values():
        x1, y1, x2, y2 = min(a for _, a, _ in own), own[0][0], max(b for _, _, b in own), own[-1][0] + 1
        mask = np.zeros((y2 - y1, x2 - x1), dtype=bool)
        for y, a, b in own:
            mask[y - y1, a - x1 : b - x1] = True
        out.append((x1, y1, x2, y2, mask))
    return out


def outline(mask: np.ndarray) -> np.ndarray:
    """Points (x, y) of the outer border of a component, walked once around with the component on the right."""
    wide = mask.shape[1] + 2  # a frame of false pixels takes the place of bounds
    framed = np.zeros((mask.shape[0] + 2, wide), np.uint8)
    framed[1:-1, 1:-1] = mask
    inked = framed.tobytes()
    steps = (1, wide + 1, wide, wide - 1, -1, -wide - 1, -wide, 1 - wide)
    # from a heading, the eight directions in the order in which they are tried
    turns = [[((facing + 6 + turn) % 8, steps[(facing + 6 + turn) % 8]) for turn in range(8)] for facing in range(8)]
    at = start = wide + 1 + int(np.argmax(mask[0]))
    facing, first, out = 0, None, [start]
    while True:
        for k, step in turns[facing]:
            if inked[at + step]:
                break
        else:
            break
        if at == start and k == first:
            out.pop()
            break
        if first is None:
            first = k
        at += step
        facing = k
        out.append(at)
    y, x = np.divmod(np.array(out), wide)
    return np.stack([x - 1, y - 1], axis=1)


def _area(points: np.ndarray) -> float:
    x, y = points[:, 0].astype(np.float64), points[:, 1].astype(np.float64)
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull. Only the first and the last point of each row can be one."""
    ordered = points[np.lexsort((points[:, 0], points[:, 1]))]
    ends = np.flatnonzero(np.diff(ordered[:, 1], prepend=ordered[:1, 1] - 1, append=ordered[-1:, 1] + 1))
    ordered = sorted({(x, y) for x, y in ordered[np.append(ends[:-1], ends[1:] - 1)].tolist()})
    if len(ordered) < 3:
        return np.array(ordered)

    def half(own):
        out: list = []
        for x, y in own:
            while len(out) > 1:
                (x1, y1), (x2, y2) = out[-2:]
                if (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) > 0:
                    break
                out.pop()
            out.append((x, y))
        return out[:-1]

    return np.array(half(ordered) + half(ordered[::-1]))


def corners(points: np.ndarray, share: float = 0.02) -> int:
    """Number of corners left when an outline is simplified to within ``share`` of its length."""
    most = share * perimeter(points)

    def kept(a: int, b: int) -> int:
        if b - a < 2:
            return 0
        p, q, own = points[a].astype(float), points[b % len(points)].astype(float), points[a + 1 : b].astype(float)
        d = q - p
        length = np.hypot(*d)
        away = np.abs(d[0] * (own[:, 1] - p[1]) - d[1] * (own[:, 0] - p[0])) / length if length else np.hypot(*(own - p).T)
        k = int(np.argmax(away))
        return 1 + kept(a, a + 1 + k) + kept(a + 1 + k, b) if away[k] > most else 0

    if len(points) < 3:
        return len(points)
    far = int(np.argmax(np.hypot(*(points - points[0]).T)))
    return 2 + kept(0, far) + kept(far, len(points))


def perimeter(points: np.ndarray) -> float:
    return float(np.hypot(*(points - np.roll(points, -1, axis=0)).T).sum())


CONTOURS = "page_number int, region_id int, x1 int, y1 int, x2 int, y2 int, area double, perimeter double, vertices int, width int, height int, content_density double, stroke_density double, solidity double"


def contours(pages: DataFrame) -> DataFrame:
    """Components of each page's dark pixels (below the mean of their surroundings) with what the seal
    gates measure: area and length of the outline, its corners, the box, the share of dark pixels in
    the box (by the page's Otsu threshold) and of the component's own, and area over that of the hull.
    Components of a single row or column are left out, as are pages with an error."""

    def run(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                image = _grey(r.data, r.height, r.width)
                ink = image <= _otsu(image)
                for i, (x1, y1, x2, y2, mask) in enumerate(components(binarise_adaptive(gaussian(image)) == 0)):
                    if min(mask.shape) > 1:
                        line = outline(mask)
                        area, whole = _area(line), _area(hull(line))
                        rows.append((
                            r.doc_id, r.page_number, i, x1, y1, x2, y2, area, perimeter(line), corners(line), x2 - x1, y2 - y1,
                            float(ink[y1:y2, x1:x2].mean()), float(mask.mean()), area / whole if whole else 0.0,
                        ))
            yield pd.DataFrame(rows, columns=["doc_id", *(c.split()[0] for c in CONTOURS.split(", "))])

    kind = pages.schema["doc_id"].dataType.simpleString()
    own = pages.where("error IS NULL") if "error" in pages.columns else pages
    return own.select("doc_id", "page_number", "height", "width", "data").mapInPandas(run, f"doc_id {kind}, {CONTOURS}")


def ruled_boxes(pages: DataFrame) -> DataFrame:
    """Boxes (box_id) of the groups of ruled lines on each page: dark runs of at least ``RULE_LENGTH``
    pixels along a row or a column."""

    def runs(dark: np.ndarray) -> np.ndarray:
        if dark.shape[1] < RULE_LENGTH:
            return np.zeros_like(dark)
        whole = sliding_window_view(dark, RULE_LENGTH, axis=1).all(axis=2)
        out = np.zeros_like(dark)
        for k in range(RULE_LENGTH):
            out[:, k : k + whole.shape[1]] |= whole
        return out

    def run(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                image = _grey(r.data, r.height, r.width)
                dark = image <= min(_otsu(image), 254)
                found = components(runs(dark) | runs(dark.T).T)
                rows += [(r.doc_id, r.page_number, i, *box) for i, (*box, _) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["doc_id", "page_number", "box_id", "x1", "y1", "x2", "y2"])

    kind = pages.schema["doc_id"].dataType.simpleString()
    own = pages.where("error IS NULL") if "error" in pages.columns else pages
    return own.select("doc_id", "page_number", "height", "width", "data").mapInPandas(run, f"doc_id {kind}, page_number int, box_id int, x1 int, y1 int, x2 int, y2 int")


def crops(pages: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pixels of boxes (as from ``regions.crop_boxes``) cut from their pages: boxes' columns, and data."""

    @F.pandas_udf("binary")
    def cut(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
        return pd.Series([pixels(d, h, w, n)[b:e, a:c].tobytes() for h, w, n, d, a, b, c, e in zip(height, width, channels, data, x1, y1, x2, y2, strict=True)])

    channels = F.coalesce("channels", F.lit(1)) if "channels" in pages.columns else F.lit(1)
    own = pages.select("doc_id", "page_number", F.col("height").alias("_h"), F.col("width").alias("_w"), channels.cast("int").alias("_n"), F.col("data").alias("_d"))
    joined = boxes.join(own, ["doc_id", "page_number"])
    return joined.withColumn("data", cut("_h", "_w", "_n", "_d", "x1", "y1", "x2", "y2")).drop("_h", "_w", "_n", "_d")


@F.pandas_udf(T.DoubleType())
def _quality(height: pd.Series, width: pd.Series, data: pd.Series) -> pd.Series:
    out = []
    for h, w, d in zip(height, width, data, strict=True):
        if d is None or not h or not w or len(d) != h * w:
            out.append(0.5)
            continue
        g = np.pad(_grey(d, h, w).astype(np.float64), 1, mode="symmetric")
        laplace = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
        out.append(min(1.0, laplace.var() / 1000))
    return pd.Series(out)


def quality_score() -> Column:
    """Variance of the Laplacian over 1000, at most 1; 0.5 for a page that can't be read."""
    return _quality("height", "width", "data")


@F.pandas_udf(T.DoubleType())
def _density(data: pd.Series) -> pd.Series:
    return pd.Series([0.0 if not d else float((np.frombuffer(d, np.uint8) <= 200).mean()) for d in data])


def content_density() -> Column:
    """Share of pixels that are not near white."""
    return _density("data")


def deskew_angle(angles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the median of line angles (degrees) within 45 of level; 0.0 unless beyond 0.5."""
    level = angles.where(F.abs("angle") <= 45).groupBy(*keys).agg(F.median("angle").alias("angle"))
    return level.withColumn("angle", F.when(F.abs("angle") > 0.5, F.col("angle")).otherwise(F.lit(0.0)))
