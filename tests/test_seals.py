import numpy as np
import pytest

from paperloom.operators import imaging, seals

PAGE = "doc_id long, page_number int, height int, width int, data binary"


def flood(mask, corners=True):
    """Groups by flood fill, as lists of flat places in the order of their first pixels."""
    h, w = mask.shape
    near = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (corners or not (dy and dx))]
    seen, out = np.zeros_like(mask), []
    for y, x in zip(*np.nonzero(mask), strict=True):
        if not seen[y, x]:
            seen[y, x], todo, own = True, [(y, x)], []
            while todo:
                a, b = todo.pop()
                own.append(a * w + b)
                for dy, dx in near:
                    c, d = a + dy, b + dx
                    if 0 <= c < h and 0 <= d < w and mask[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        todo.append((c, d))
            out.append(sorted(own))
    return out


def random_masks():
    rng = np.random.default_rng(2)
    return [rng.random(size=(h, w)) < p for h, w, p in ((1, 1, 1), (1, 9, 0.5), (9, 1, 0.5), (20, 30, 0.3), (25, 17, 0.5), (30, 30, 0.62), (5, 5, 0), (40, 40, 0.45))]


@pytest.mark.parametrize("corners", [True, False])
def test_groups_equal_a_flood_fill(corners):
    for mask in random_masks():
        found = seals.Groups(mask, corners)
        want = flood(mask, corners)
        got = [[] for _ in range(found.n)]
        for g, a, b in zip(found.group, found.start, found.stop, strict=True):
            got[g] += range(a, b)
        assert got == want
        for i, own in enumerate(want):
            y, x = np.divmod(own, mask.shape[1])
            box = found.boxes()[i]
            assert box.tolist() == [x.min(), y.min(), x.max() + 1, y.max() + 1]
            assert found.mask(i, box).sum() == len(own) and found.mask(i, box)[y - box[1], x - box[0]].all()
        keeps = np.arange(found.n) % 2 == 0
        assert set(np.flatnonzero(found.painted(keeps))) == {p for own in want[::2] for p in own}


def test_only_groups_in_no_hole_are_outermost():
    for mask in random_masks():
        outside = {p for p in flood(~np.pad(mask, 1), False)[0]}
        want = [any((y + 1 + dy) * (mask.shape[1] + 2) + x + 1 + dx in outside for y, x in (divmod(p, mask.shape[1]) for p in own) for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1))) for own in flood(mask)]
        assert seals.outermost(mask, seals.Groups(mask)).tolist() == want


def test_window_means_and_shifts_equal_loops():
    rng = np.random.default_rng(4)
    image = rng.integers(0, 256, (13, 11))
    wide = np.pad(image, 3, mode="edge")
    assert np.allclose(seals.window_means(image, 7), [[wide[y : y + 7, x : x + 7].mean() for x in range(11)] for y in range(13)])
    mask = rng.random((9, 7)) < 0.4
    for places in (seals.SQUARE, seals.SMALL_ELLIPSE, [(-20, 0)]):
        near = lambda y, x: [mask[y + a, x + b] for a, b in places if 0 <= y + a < 9 and 0 <= x + b < 7]  # noqa: E731, B023
        assert seals.shifted(mask, places, True).tolist() == [[any(near(y, x)) for x in range(7)] for y in range(9)]
        assert seals.shifted(mask, places, False).tolist() == [[all(near(y, x)) for x in range(7)] for y in range(9)]
    taps = seals.gaussian_taps(11)
    wide = np.pad(image, 5, mode="reflect").astype(float)
    assert np.allclose(seals.blurred(image, taps), [[(wide[y : y + 11, x : x + 11] * np.outer(taps, taps)).sum() for x in range(11)] for y in range(13)])


def loop_edges(image, weak, strong):
    h, w = image.shape
    g = np.pad(image.astype(int), 1, mode="edge")
    grad = {}
    for y in range(h):
        for x in range(w):
            k = g[y : y + 3, x : x + 3]
            grad[y, x] = ((k[:, 2] * [1, 2, 1]).sum() - (k[:, 0] * [1, 2, 1]).sum(), (k[2] * [1, 2, 1]).sum() - (k[0] * [1, 2, 1]).sum())
    size = lambda y, x: abs(grad[y, x][0]) + abs(grad[y, x][1]) if (y, x) in grad else 0
    thin = np.zeros((h, w), bool)
    for (y, x), (dx, dy) in grad.items():
        m = size(y, x)
        angle = np.degrees(np.arctan2(abs(dy), abs(dx)))
        if m <= weak:
            continue
        if angle < 22.5:
            thin[y, x] = m > size(y, x - 1) and m >= size(y, x + 1)
        elif angle > 67.5:
            thin[y, x] = m > size(y - 1, x) and m >= size(y + 1, x)
        else:
            s = -1 if (dx < 0) != (dy < 0) else 1
            thin[y, x] = m > size(y - 1, x - s) and m > size(y + 1, x + s)
    out = np.zeros_like(thin)
    for own in flood(thin):
        if any(size(*divmod(p, w)) > strong for p in own):
            out.ravel()[own] = True
    return out


def test_thin_edges_equal_a_loop():
    rng = np.random.default_rng(8)
    for image in (rng.integers(0, 256, (24, 31)), np.kron(rng.integers(0, 256, (5, 6)), np.ones((6, 5), int)), rng.integers(0, 60, (20, 20)), np.full((3, 3), 7), np.zeros((1, 8), int)):
        assert np.array_equal(seals.thin_edges(image.astype(np.uint8)), loop_edges(image, 50, 150))
    edge = seals.thin_edges(np.where(np.arange(40)[None, :] < 20, 0, 255).repeat(30, 0).astype(np.uint8))
    assert edge.sum(axis=1).tolist() == [1] * 30  # one pixel wide


def disc(h, w, cy, cx, r):
    y, x = np.mgrid[0:h, 0:w]
    return (y - cy) ** 2 + (x - cx) ** 2 <= r * r


def test_a_ring_measures_as_its_disc_and_hides_what_it_holds():
    whole = disc(80, 80, 40, 40, 25)
    ring = whole & ~disc(80, 80, 40, 40, 20)
    ring |= disc(80, 80, 40, 40, 5)
    found = seals.Groups(ring)
    assert found.n == 2 and seals.outermost(ring, found).tolist() == [True, False]
    box = found.boxes()[0]
    area = lambda m: imaging._area(imaging.outline(m))
    assert area(found.mask(0, box)) == area(whole[15:66, 15:66])


def page_with(*shapes, size=(300, 420)):
    image = np.full(size, 255, np.uint8)
    for value, mask in shapes:
        image[mask] = value
    return image


def rectangle(size, x1, y1, x2, y2):
    out = np.zeros(size, bool)
    out[y1:y2, x1:x2] = True
    return out


def stroke(size, x, y, length):
    out = np.zeros(size, bool)
    for i in range(length):
        at = y + int(12 * np.sin(i / 5))
        out[at - 1 : at + 1, x + i] = True
    return out


def test_detection_from_pixels(spark):
    size = (300, 420)
    ring = disc(*size, 70, 80, 30) & ~disc(*size, 70, 80, 25)
    box = rectangle(size, 200, 40, 320, 66)  # full, so that its ink outweighs its roundness
    image = page_with((0, ring), (0, box), (40, stroke(size, 60, 220, 110)))
    blank = np.full((50, 60), 255, np.uint8)
    colour = np.stack([image] * 3, 2)
    rows = [(1, 1, *size, 1, image.tobytes(), None), (1, 2, 50, 60, 1, blank.tobytes(), None), (2, 1, *size, 3, colour.tobytes(), None), (3, 1, 0, 0, 1, b"", "broken")]
    pages = spark.createDataFrame(rows, "doc_id long, page_number int, height int, width int, channels int, data binary, error string")
    got = [r for r in seals.detect(pages).collect()]
    assert {r.doc_id for r in got} == {1, 2} and all(r.page_number == 1 for r in got)
    one = sorted((r.type, r.x1, r.y1, r.x2, r.y2, round(r.confidence, 9)) for r in got if r.doc_id == 1)
    assert one == sorted((r.type, r.x1, r.y1, r.x2, r.y2, round(r.confidence, 9)) for r in got if r.doc_id == 2)
    at = {t: (x1, y1, x2, y2) for t, x1, y1, x2, y2, _ in one}
    assert len(one) == 3 and set(at) == set(seals.DETECTORS)
    near = lambda a, b, most: all(abs(p - q) <= most for p, q in zip(a, b, strict=True))
    assert near(at["circular_seal"], (50, 40, 111, 101), 3) and near(at["signature_box"], (200, 40, 320, 66), 3) and near(at["handwritten_signature"], (60, 207, 170, 232), 4)
    assert seals.detect(pages.where("doc_id = 9")).count() == 0


def test_speckled_page_walks_few_outlines(monkeypatch):
    image = page_with((0, np.random.default_rng(1).random((400, 400)) < 0.02), size=(400, 400))
    walked = []
    own = imaging.outline
    monkeypatch.setattr(imaging, "outline", lambda m: walked.append(m.shape) or own(m))
    seals.measured(image)
    assert len(walked) < 30  # hundreds of specks are passed over by their boxes


def test_hulls_equal_those_of_all_points():
    rng = np.random.default_rng(6)
    for n, most in [(1, 3), (2, 2), (3, 9), (9, 3), (40, 8), (60, 40)] * 20:
        points = rng.integers(0, most, (n, 2))
        own = {tuple(p) for p in points.tolist()}
        cross = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        inside = lambda p: any(min(a, b) < p < max(a, b) and cross(a, b, p) == 0 for a in own for b in own) or any(
            cross(a, b, p) > 0 and cross(b, c, p) > 0 and cross(c, a, p) > 0 for a in own for b in own for c in own)
        if n < 12:
            assert {tuple(p) for p in imaging.hull(points).tolist()} == {p for p in own if not inside(p)}
        again = imaging.hull(imaging.hull(points))
        assert np.array_equal(again, imaging.hull(points)) and {tuple(p) for p in again.tolist()} <= own


def test_pages_of_a_small_table_are_dealt_over_the_cores(spark, data):
    """One file of keys is one task, in which all pages were made and read."""
    from paperloom.plans import queries_pages

    assert spark.read.parquet(f"{data}/supplier.parquet").rdd.getNumPartitions() == 1
    for query in (queries_pages.seals_on_pages, queries_pages.seals_by_document):
        assert "RoundRobinPartitioning(4)" in query(spark, data)._jdf.queryExecution().executedPlan().toString()
