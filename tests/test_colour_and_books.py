import io
import zipfile
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import imaging, output, workbook
from paperloom.sources import documents

PAGE = "doc_id long, page_number int, height int, width int, channels int, data binary, error string"


def colour(seed, h, w):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def test_greys_of_colours():
    assert imaging.to_grey(np.array([[[255, 255, 255], [0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255]]], np.uint8)).tolist() == [[255, 0, 76, 150, 29]]
    image = colour(1, 5, 6)
    assert np.abs(imaging.to_grey(image) - image @ np.array([0.299, 0.587, 0.114])).max() <= 0.51
    assert np.array_equal(imaging.pixels(image.tobytes(), 5, 6, 3), image)


def test_steps_on_colour_pages(spark):
    image, grey = colour(2, 30, 20), np.random.default_rng(3).integers(0, 256, (30, 20), dtype=np.uint8)
    both = np.repeat(grey[:, :, None], 3, axis=2)
    for name in ("median", "smooth", "sharpen", "resize", "nlm", "remove_borders"):
        step = imaging.STEPS[name] if name != "resize" else lambda x: imaging.per_channel(lambda c: imaging.enlarge(c, 40))(x)
        out = step(both)
        assert out.ndim == 3 and all(np.array_equal(out[:, :, c], step(grey)) for c in range(3)), name
    for name in ("denoise", "enhance_contrast", "deskew"):
        assert imaging.STEPS[name](image).shape == image.shape
    for name in ("grey", "binarize", "binarize_adaptive", "binarize_fixed"):
        assert np.array_equal(imaging.STEPS[name](image), imaging.STEPS[name](imaging.to_grey(image)))
    rows = [(1, 1, 30, 20, 3, image.tobytes(), None), (2, 1, 30, 20, 1, grey.tobytes(), None), (3, 1, 30, 20, 3, b"x", None), (4, 0, 0, 0, 1, b"", "broken"), (5, 1, 30, 20, None, grey.tobytes(), None)]
    got = {r.doc_id: r for r in imaging.preprocess(spark.createDataFrame(rows, PAGE), ("median", "binarize")).collect()}
    assert got[1].channels == 1 and bytes(got[1].data) == imaging.binarise(imaging.to_grey(imaging.per_channel(imaging.median)(image))).tobytes()
    assert got[2].data == got[5].data and got[3].error and got[3].channels == 3 and got[4].error == "broken"
    kept = imaging.preprocess(spark.createDataFrame(rows[:1], PAGE), ("median",)).first()
    assert kept.channels == 3 and bytes(kept.data) == imaging.per_channel(imaging.median)(image).tobytes()


def test_bilateral_of_colours_equals_a_loop():
    g = colour(5, 7, 6).astype(float)
    wide = np.pad(g, ((4, 4), (4, 4), (0, 0)), mode="edge")
    out = np.zeros_like(g)
    for y in range(7):
        for x in range(6):
            total, weight = 0.0, 0.0
            for dy in range(-4, 5):
                for dx in range(-4, 5):
                    if dy * dy + dx * dx <= 16:
                        other = wide[y + 4 + dy, x + 4 + dx]
                        w = np.exp(-(np.abs(other - g[y, x]).sum() ** 2 + dy * dy + dx * dx) / (2 * 75.0**2))
                        total, weight = total + w * other, weight + w
            out[y, x] = np.rint(total / weight)
    assert np.array_equal(imaging.bilateral_colour(g.astype(np.uint8)), out.astype(np.uint8))


def loop_nlm(image, strength, patch, search):
    g = (image if image.ndim == 3 else image[:, :, None]).astype(float)
    h, w, _ = g.shape
    p, r = patch // 2, search // 2
    wide = np.pad(g, ((p + r, p + r), (p + r, p + r), (0, 0)), mode="reflect")
    out = np.zeros_like(g)
    for y in range(h):
        for x in range(w):
            total, weight = 0.0, 0.0
            own = wide[y + r : y + r + patch, x + r : x + r + patch]
            for dy in range(search):
                for dx in range(search):
                    other = wide[y + dy : y + dy + patch, x + dx : x + dx + patch]
                    k = np.exp(-((own - other) ** 2).mean() / strength**2)
                    total, weight = total + k * other[p, p], weight + k
            out[y, x] = total / weight
    return out.reshape(image.shape)


@pytest.mark.parametrize("image", [np.random.default_rng(1).integers(90, 120, (14, 11)), np.random.default_rng(2).integers(0, 256, (9, 10, 3))])
def test_non_local_means_equals_a_loop(image, monkeypatch):
    for strip in (128, 4):
        monkeypatch.setattr(imaging, "NLM_STRIP", strip)
        got = imaging.non_local_means(image.astype(np.uint8), 10.0, 3, 7)
        assert np.abs(got - loop_nlm(image, 10.0, 3, 7)).max() <= 0.51
    assert imaging.non_local_means(np.zeros((0, 4), np.uint8)).shape == (0, 4)
    flat = np.full((30, 30), 77, np.uint8)
    assert np.array_equal(imaging.non_local_means(flat), flat)


def test_non_local_means_takes_noise_and_keeps_edges():
    clean = np.where(np.arange(60)[None, :] < 30, 60, 200).repeat(40, 0)
    noisy = np.clip(clean + np.random.default_rng(4).normal(0, 8, clean.shape), 0, 255).astype(np.uint8)
    got = imaging.non_local_means(noisy).astype(float)
    assert np.abs(got - clean).mean() < 0.5 * np.abs(noisy - clean).mean() and got[:, 31].mean() - got[:, 28].mean() > 130


def ink_engine():
    def ink(image):
        y, x = np.nonzero(image < 128)
        if image.shape == (3, 3):
            raise RuntimeError("too small")
        return [(str(len(x)), 0.9, int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1)] if len(x) else []

    return ink


def test_regions_are_read_in_the_page(spark):
    ink = ink_engine()
    image = np.full((40, 50), 255, np.uint8)
    image[10:20, 15:25] = 0
    rows = [(1, 1, 40, 50, 1, image.tobytes(), None), (2, 1, 0, 0, 1, b"", "broken")]
    boxes = [(1, 1, "a", 12, 5, 30, 30), (1, 1, "b", -5, -5, 18, 12), (1, 1, "c", 60, 0, 70, 9), (1, 1, "d", 30, 30, 33, 33), (1, 1, "e", 30, 0, 50, 9), (2, 1, "f", 0, 0, 9, 9), (3, 1, "g", 0, 0, 9, 9), (1, 1, "h", 30, 30, 20, 20)]
    pages, regions = spark.createDataFrame(rows, PAGE), spark.createDataFrame(boxes, "doc_id long, page_number int, region_id string, x1 int, y1 int, x2 int, y2 int")
    got = {r.region_id: r for r in documents.recognise_regions(pages, regions, ink).collect()}
    block = lambda r: (r.text, r.x1, r.y1, r.x2, r.y2, r.region_x1, r.block_pos)
    assert block(got["a"]) == ("100", 15, 10, 25, 20, 12, 0) and block(got["b"]) == ("6", 15, 10, 18, 12, -5, 0)
    errors = {k: r.error for k, r in got.items() if r.error}
    assert errors == {"c": "the region lies outside its page", "d": "too small", "f": "broken", "g": "no such page", "h": "the region lies outside its page"} and "e" not in got
    helped = {r.region_id: (r.text, r.fallback_used) for r in documents.recognise_regions(pages, regions, ink, lambda i: [("help", 0.5, 0, 0, 1, 1)]).where("error IS NULL").collect()}
    assert helped["d"] == helped["e"] == ("help", True) and helped["a"] == ("100", False)
    assert documents.recognise_regions(pages, regions.where("false"), ink).count() == 0


def rows_of(content, sheet):
    out = {}
    for name, row, column, text, number in workbook.read_cells(content):
        if name == sheet:
            out[row, column] = number if text is None else text
    return out


def test_workbooks_are_well_formed_and_read_back(spark):
    odd = "a<b>&\"'\x01_x0041_ \r\n\té\U0001f600"
    content = workbook.workbook_bytes([("Über [1]/2", [[("h", None), (None, 1.5)], [(odd, None), (None, float("nan"))], [(None, None), (None, 1e300)]]), ("empty", [])])
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        assert z.testzip() is None
        for name in z.namelist():
            ElementTree.fromstring(z.read(name))
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
        assert '<c r="A1" s="1"' in sheet and f'width="{len(odd) + 2}"' in sheet and 'state="' not in sheet
    assert rows_of(content, "Über  1  2") == {(1, 1): "h", (1, 2): 1.5, (2, 1): odd, (2, 2): "nan", (3, 2): 1e300}
    assert content == workbook.workbook_bytes([("Über [1]/2", [[("h", None), (None, 1.5)], [(odd, None), (None, float("nan"))], [(None, None), (None, 1e300)]]), ("empty", [])])
    assert [workbook.letters(n) for n in (1, 26, 27, 702, 703)] == ["A", "Z", "AA", "ZZ", "AAA"] and all(workbook.column_of(f"{workbook.letters(n)}7") == n for n in range(1, 2000))


def test_a_long_sheet_goes_on(monkeypatch):
    monkeypatch.setattr(workbook, "MOST_ROWS", 3)
    cells = workbook.read_cells(workbook.workbook_bytes([("x" * 40, [[(str(i), None)] for i in range(7)])]))
    assert [c[0] for c in cells] == ["x" * 31] * 3 + ["x" * 23 + " (2)"] * 3 + ["x" * 23 + " (3)"] and [c[3] for c in cells] == [str(i) for i in range(7)]


def test_workbooks_of_invoices(spark):
    heads = spark.createDataFrame([(1, "INV-1", 90.5), (2, None, None)], "doc_id long, invoice_number string, final_total double")
    items = spark.createDataFrame([(1, 2, "b", 2.0), (1, 1, "a", 1.0)], "doc_id long, line_no int, description string, quantity double")
    checks = output.verification_sheet(spark.createDataFrame([(1, 0.75)], "doc_id long, overall_confidence double"))
    books = workbook.invoice_workbooks(output.invoice_documents(heads, items), checks)
    got = {r.doc_id: bytes(r.content) for r in books.collect()}
    assert set(got) == {1, 2}
    summary = rows_of(got[1], "Invoice Summary")
    assert summary[2, 1] == "Invoice Number" and summary[2, 2] == "INV-1" and summary[14, 2] == 90.5 and summary[19, 2] == 1
    lines = rows_of(got[1], "Line Items")
    assert [lines[r, 1] for r in (1, 2, 3)] == ["description", "a", "b"] and lines[3, 3] == 2.0
    assert rows_of(got[1], "Verification")[2, 3] == 0.75 and (3, 1) not in rows_of(got[2], "Verification") and rows_of(got[2], "Line Items")[1, 1] == "description"
    bad = spark.createDataFrame([(7, b"no zip"), (8, None)], "doc_id long, content binary")
    assert {r.doc_id: bool(r.error) for r in workbook.cells(bad).collect()} == {7: True, 8: True}
    assert workbook.cells(books).where(F.col("error").isNotNull()).count() == 0


def test_pixels_are_not_broadcast_for_their_regions(spark, data):
    """Pages made by expressions look as small as the table of their keys."""
    from paperloom.plans import queries_pages

    plan = queries_pages.region_ocr(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan and "BuildLeft" in plan


def test_workbooks_are_made_many_at_a_time(spark, monkeypatch):
    """No group of its own for each document; null ids, repeats and orders as they were, bytes as the standard library's."""
    monkeypatch.setattr(workbook, "DOCUMENTS_AT_ONCE", 3)
    cells = lambda *x: [(None, float(v)) if isinstance(v, int) else (v, None) for v in x]
    rows = [(d, s, n, cells(f"{d} {s} {n}", n)) for d in (1, 2, 3, 4, None) for s in (1, 0) for n in (3, 1, 2)] + [(2, 1, 2, cells("2 1 2", 2)), (2, 1, 1, []), (9, 1, 1, cells("x"))]
    frame = spark.createDataFrame(rows, f"doc_id long, sheet_no int, row_no long, cells array<{workbook.CELL}>")
    books = workbook.workbooks(frame, [("A", None), ("B", ("h", "i"))])
    assert "FlatMapGroupsInPandas" not in books._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: bytes(r.content) for r in books.collect()}
    assert set(got) == {1, 2, 3, 4, 9, None}
    for d, content in got.items():
        a, b = ([cells for _, _, n, cells in sorted((r for r in rows if r[0] == d and r[1] == s), key=lambda r: r[2])] for s in (0, 1))
        # rows 1 of document 2's second sheet tie: one of them is empty, and either may come first
        assert content in [workbook.workbook_bytes([("A", a), ("B", [[("h", None), ("i", None)], *own])]) for own in (b, [b[1], b[0], *b[2:]] if len(b) > 1 else b)]
    own = [("A", [[("x & y", None), (None, 0.1)]]), ("B", [])]
    short = workbook.workbook_bytes(own)
    monkeypatch.setattr(workbook, "LONG_FILE", 0)
    assert workbook.workbook_bytes(own) == short
