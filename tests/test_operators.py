import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom import config
from paperloom.operators import imaging, layout, ocr, output, regions, verify
from paperloom.plans import extraction, queries, queries_more
from paperloom.sources import documents
from paperloom.streaming import files

ITEM = "doc_id long, line_no int, description string, hsn_code string, quantity string, unit_price string, total_amount string, discount string, discount_type string, gst_rate string"


def item(n, q, p, t, discount="0", kind="amount", hsn="8471", rate="18"):
    return (1, n, "x", hsn, q, p, t, discount, kind, rate)


@pytest.mark.parametrize(
    ("row", "valid", "warnings"),
    [
        (item(1, "2", "100", "200"), True, 0), (item(1, "2", "100", "150"), False, 0), (item(1, "3", "33.33", "99.99"), True, 0), (item(1, "3", "33.33", "100.00"), True, 1),
        (item(1, "1", "1", "1.005"), True, 0), (item(1, "1", "1", "1.006"), True, 1), (item(1, "1", "1", "1.011"), False, 0), (item(1, "x", "1", "1"), True, 1), (item(1, None, "1", "1"), True, 1),
        (item(1, "1", "1", None), True, 1), (item(1, "1", "1", "1", discount="?"), False, 0), (item(1, "2", "100", "180", "10", "percentage"), True, 0), (item(1, "2", "100", "190", "10"), True, 0),
        (item(1, "2", "100", "200", hsn="12A"), True, 1), (item(1, "2", "100", "200", hsn=None), True, 0),
    ],
)
def test_item_checks(spark, row, valid, warnings):
    r = verify.check_items(spark.createDataFrame([row], ITEM)).first()
    assert (r.is_valid, len(r.warnings)) == (valid, warnings)


def test_empty_items_give_no_rows(spark):
    assert verify.items_check(spark.createDataFrame([], ITEM)).count() == 0


def test_flags_ladder(spark):
    rows = []
    for doc, (errors, warnings) in enumerate([(0, 0), (0, 3), (0, 4), (2, 0), (3, 0)]):
        rows.append((doc, "line_items", 1, errors == 0, ["e"] * errors, ["w"] * warnings))
        rows.append((doc, "subtotal", 2, False if errors else True, [], []))
        rows.append((doc, "final_total", 3, True, [], []))
    df = spark.createDataFrame(rows, "doc_id long, check string, ordinal int, is_valid boolean, errors array<string>, warnings array<string>")
    got = {r.doc_id: r for r in verify.flags(df).collect()}
    assert [got[i].overall_status for i in range(5)] == ["valid", "valid_with_warnings", "questionable", "invalid_minor", "invalid_major"]
    assert [got[i].recommendation for i in range(5)] == ["approved", "approved_with_review", "manual_review_required", "manual_review_required", "rejected"]
    assert got[3].calculations_valid and not got[3].line_items_valid and not got[3].gst_valid  # the later check decides; an absent one is false
    assert got[1].confidence_score == pytest.approx(1 - 0.06)


def test_confidence_report(spark):
    rows = [(1, f, c) for f, c in zip("abcd", (0.9, 0.8, 0.7, 0.6), strict=True)]
    r = verify.confidence_report(spark.createDataFrame(rows, "doc_id long, field string, confidence double")).first()
    assert r.overall_confidence == pytest.approx(0.75)
    assert (r.high_count, r.medium_count, r.low_count, r.high_percentage, len(r.recommendations)) == (1, 3, 0, 25.0, 1)


BLOCK = "doc_id long, page_number int, block_pos int, text string, confidence double, x1 int, y1 int, x2 int, y2 int"


def grid(rows, doc=1):
    return [(doc, 1, i * 10 + j, t, 0.9, 50 + 100 * j, 100 + 30 * i, 130 + 100 * j, 120 + 30 * i) for i, r in enumerate(rows) for j, t in enumerate(r)]


def test_table_to_items(spark):
    table = [["Description", "HSN", "Qty", "Rate", "Amount"], ["Laptop Computer", "8471", "2", "45000", "90000"], ["Software License", "9983", "1", "15000", "15000"], ["short"]]
    blocks = spark.createDataFrame(grid(table), BLOCK)
    got = layout.parse_items(layout.table_rows(blocks)).orderBy("row_no").collect()
    assert [tuple(r)[3:8] for r in got] == [("Laptop Computer", "8471", 2.0, 45000.0, 90000.0), ("Software License", "9983", 1.0, 15000.0, 15000.0)]
    regions_ = layout.table_regions(blocks)
    assert regions_.where("method = 1").count() == regions_.count() == 5


def test_items_fall_back_within_the_row(spark):
    table = [["A", "B", "C"], ["Widget", "3", "45.50"], ["", "", ""]]
    got = layout.parse_items(layout.table_rows(spark.createDataFrame(grid(table), BLOCK))).collect()
    assert [tuple(r)[3:8] for r in got] == [("Widget", "", 3.0, 3.0, 45.5)]


def test_rows_are_anchored_at_their_first_block(spark):
    rows = [(1, 1, i, str(i), 0.9, 10 * i, y, 10 * i + 5, y + 5) for i, y in enumerate((0, 10, 20))]
    got = layout.numbered_rows(spark.createDataFrame(rows, BLOCK)).orderBy("block_pos").collect()
    assert [r.row_no for r in got] == [0, 0, 1]


def test_row_folds_equal_a_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(d, 1, i, str(i), 0.9, int(rng.integers(500)), int(rng.integers(200)), 0, 0) for d in range(20) for i in range(int(rng.integers(1, 40)))]
    got = {(r.doc_id, r.block_pos): r.row_no for r in layout.numbered_rows(spark.createDataFrame(rows, BLOCK)).collect()}
    for d in range(20):
        anchor, n = None, -1
        for y, i in sorted((r[6], r[2]) for r in rows if r[0] == d):
            if anchor is None or abs(y - anchor) > 15:
                anchor, n = y, n + 1
            assert got[d, i] == n


def test_grid_and_boxes(spark):
    blocks = spark.createDataFrame(grid([["1", "2", "3"], ["4", "5", "6"], ["7"]]), BLOCK)
    r = layout.regions_from_grid(blocks).first()
    assert (r.x1, r.y1, r.x2, r.y2, r.n_rows) == (50, 100, 330, 150, 2)
    boxes = spark.createDataFrame([(1, 1, 0, 40, 90, 340, 200), (1, 1, 1, 0, 0, 10, 10)], "doc_id long, page_number int, box_id int, x1 int, y1 int, x2 int, y2 int")
    assert [(r.box_id, r.n_blocks) for r in layout.regions_from_boxes(boxes, blocks).collect()] == [(0, 7)]
    assert layout.table_regions(blocks, boxes).select("method").distinct().collect()[0].method == 2
    inside = spark.createDataFrame([(1, 1, 5, 40, 90, 340, 155)], "doc_id long, page_number int, region_id int, x1 int, y1 int, x2 int, y2 int")
    assert [r.cells for r in layout.rows_of_regions(blocks, inside).orderBy("row_no").collect()] == [["1", "2", "3"], ["4", "5", "6"]]


def test_locate_text(spark):
    blocks = spark.createDataFrame([(1, 1, 0, "INVOICE", 0.95, 1, 2, 3, 4), (1, 1, 1, "INV-1", 0.9, 5, 6, 7, 8), (1, 1, 2, "inv-1 x", 0.9, 9, 9, 9, 9), (1, 1, 3, "zero", 0.0, 1, 1, 1, 1)], BLOCK)
    fields = spark.createDataFrame([(1, "a", "INV-1"), (1, "b", "none"), (1, "c", "zero")], "doc_id long, field string, value string")
    got = {r.field: (r.confidence, r.x1, r.source_text) for r in layout.locate_text(fields, blocks).collect()}
    assert got == {"a": (0.9, 5, "INV-1"), "b": (0.5, 0, "none"), "c": (0.5, 0, "zero")}


def test_ocr_results(spark):
    raw = spark.createDataFrame([(1, 1, ["INVOICE", " ", "NUMBER:"], [10, 0, 80], [20, 0, 20], [60, 1, 50], [15, 1, 15], [95.0, 90.0, -1.0])], "doc_id long, page_number int, text array<string>, left array<int>, top array<int>, width array<int>, height array<int>, conf array<double>")
    b = ocr.tesseract_blocks(raw).collect()
    assert [(r.text, r.confidence, r.x2, r.y2) for r in b] == [("INVOICE", 0.95, 70, 35)]
    quads = spark.createDataFrame([(1, 1, 0, [[10, 20], [70, 20], [70, 35], [10, 35]], "x", 0.6), (1, 1, 1, [[0, 0]], "y", 0.5)], "doc_id long, page_number int, block_pos int, quad array<array<int>>, text string, confidence double")
    assert [tuple(r)[5:] for r in ocr.quad_blocks(quads).collect()] == [(10, 20, 70, 35)]
    near = spark.createDataFrame([(1, 1, 0, "a", 0.9, 10, 0, 70, 9), (1, 1, 1, "b", 0.9, 75, 0, 130, 9), (1, 1, 2, "c", 0.9, 200, 0, 210, 9)], BLOCK)
    assert [r.merged_text for r in ocr.merge_neighbours(near).orderBy("left").collect()] == ["a b", "c"]
    assert ocr.is_whole(near).first().is_whole and not ocr.is_whole(near.withColumn("text", F.lit(" "))).first().is_whole


def test_best_engine_keeps_the_primary_at_equals(spark):
    rows = [(1, 1, "tesseract", 3, 0.5), (1, 1, "easyocr", 3, 0.5), (2, 1, "tesseract", 3, 0.5), (2, 1, "easyocr", 1, 0.7), (3, 1, "tesseract", 3, 0.65), (3, 1, "easyocr", 1, 0.99), (4, 1, "easyocr", 1, 0.1)]
    got = ocr.best_engine(spark.createDataFrame(rows, "doc_id long, page_number int, engine string, n_blocks int, average_confidence double"), "tesseract")
    assert {r.doc_id: (r.engine, r.fallback_used) for r in got.collect()} == {1: ("tesseract", False), 2: ("easyocr", True), 3: ("tesseract", False), 4: ("easyocr", True)}


def iou(a, b):
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    i = w * h
    return i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i) if i else 0.0


def test_suppression_equals_a_loop(spark, data):
    got = {(r.doc_id, r.region_id) for r in queries_more.suppress_overlaps(spark, data).collect()}
    rows: dict = {}
    for r in queries._regions(spark, data).collect():
        rows.setdefault(r.doc_id, []).append(r)
    want = set()
    for doc, own in rows.items():
        kept: list = []
        for r in sorted(own, key=lambda r: (-r.confidence, r.region_id)):
            box = (r.x1, r.y1, r.x2, r.y2)
            if all(iou(box, k) <= 0.3 for k in kept):
                kept.append(box)
                want.add((doc, r.region_id))
    assert got == want


def test_crop_boxes(spark):
    df = spark.createDataFrame([(1, 7, "seal", 0.876, 5, 5, 95, 50, 100, 200)], "doc_id long, region_id int, type string, confidence double, x1 int, y1 int, x2 int, y2 int, width int, height int")
    r = regions.crop_boxes(df).first()
    assert (r.x1, r.y1, r.x2, r.y2, r.file_name) == (0, 0, 100, 60, "seal_7_conf_0.88.png")


def test_outputs(spark, tmp_path):
    inv = spark.createDataFrame([(1, "INV-1", "1,250.00"), (2, None, None)], "doc_id long, invoice_number string, subtotal string")
    items = spark.createDataFrame([item(2, "1", "2", "2"), item(1, "2", "100", "200")], ITEM)
    docs = output.invoice_documents(inv, items)
    got = {r.doc_id: r for r in docs.collect()}
    assert got[1].totals.subtotal == 1250.0 and [i.quantity for i in got[1].line_items] == [2.0, 1.0]
    assert got[2].line_items == [] and got[2].invoice_info.invoice_number == "" and got[2].metadata.total_pages == 1
    report = output.verification_report(inv.select("doc_id"))
    assert report.first().verification_status == "PENDING"
    assert output.summary_sheet(docs).where("doc_id = 1").count() == 19
    assert "totals_subtotal" in output.flatten(docs).columns
    paths = output.write_outputs(docs, report, str(tmp_path))
    rows = [json.loads(x) for f in (tmp_path / "json").glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(r["doc_id"] for r in rows) == [1, 2]
    assert spark.read.option("header", True).csv(paths["line_items"]).columns[:2] == ["doc_id", "line_no"]
    widths = {r.column: r.width for r in output.column_widths(inv).collect()}
    assert widths["subtotal"] == 10 and widths["invoice_number"] == 16
    assert spark.range(1).select(output.drop_empty(F.create_map(F.lit("a"), F.lit(""), F.lit("b"), F.lit("x")))).first()[0] == {"b": "x"}


def page(image, doc=1):
    return (doc, 1, image.shape[0], image.shape[1], bytearray(image.astype(np.uint8).tobytes()))


PAGE = "doc_id long, page_number int, height int, width int, data binary"


def test_image_kernels(spark):
    flat, edge = np.full((40, 30), 120), np.zeros((40, 30))
    edge[:, 15:] = 240
    df = spark.createDataFrame([page(flat, 1), page(edge, 2), (3, 1, 9, 9, bytearray(b"x"))], PAGE)
    quality = {r.doc_id: r.q for r in df.select("doc_id", imaging.quality_score().alias("q")).collect()}
    assert quality[1] == 0.0 and quality[2] == 1.0 and quality[3] == 0.5
    done = {r.doc_id: r for r in imaging.preprocess(df, ("denoise", "unknown", "binarize")).collect()}
    assert done[2].steps == ["denoise", "binarize"] and set(done[2].data) == {0, 255} and done[3].error
    density = {r.doc_id: r.d for r in df.select("doc_id", imaging.content_density().alias("d")).collect()}
    assert density[1] == 1.0 and density[2] == 0.5
    assert imaging.enlarge(np.zeros((10, 20), np.uint8), 40).shape == (40, 80)
    speck = np.full((9, 9), 255, np.uint8)
    speck[4, 4] = 0
    assert (imaging.close_and_open(speck) == 255).all() and (imaging.median(speck) == 255).all()
    assert (imaging.gaussian(np.full((6, 6), 7, np.uint8)) == 7).all()


def test_otsu_equals_the_kernel(spark):
    rng = np.random.default_rng(1)
    image = np.concatenate([rng.normal(60, 10, 500), rng.normal(180, 15, 700)]).clip(0, 255).astype(np.uint8).reshape(30, 40)
    rows = [(1, int(v), int(n)) for v, n in zip(*np.unique(image, return_counts=True), strict=True)]
    t = imaging.otsu_threshold(spark.createDataFrame(rows, "doc_id long, value int, n long"), ["doc_id"]).first().threshold
    assert ((image > t) == (imaging.binarise(image) == 255)).all()


def engines():
    """Functions that are pickled by value."""

    def pages(content):
        if content == b"bad":
            raise OSError("broken file")
        for n in range(content[0] - 48):
            yield np.full((4, 5), n, np.uint8)

    def weak(image):
        return [("weak", 0.3, 0, 0, 1, 1)]

    def strong(image):
        return [("strong", 0.9, 0, 0, 1, 1), (" ", 0.9, 0, 0, 1, 1)]

    return pages, weak, strong


def test_files_to_blocks(spark, tmp_path):
    fake_pages, weak_engine, strong_engine = engines()
    for name, content in (("a", b"2"), ("b", b"bad"), ("c", b"0")):
        (tmp_path / f"{name}.pdf").write_bytes(content)
    (tmp_path / "d.txt").write_bytes(b"1")
    scanned = documents.scan_files(spark, str(tmp_path))
    assert sorted(r.doc_id for r in scanned.select("doc_id").collect()) == ["a", "b", "c"]
    pages = documents.rasterise(scanned, fake_pages)
    assert sorted((r.doc_id, r.page_number, r.error) for r in pages.select("doc_id", "page_number", "error").collect()) == [("a", 1, None), ("a", 2, None), ("b", 0, "broken file"), ("c", 0, "no pages")]
    words = documents.recognise(pages, weak_engine, strong_engine).orderBy("page_number")
    assert sorted((r.doc_id, r.error) for r in words.where("error IS NOT NULL").collect()) == [("b", "broken file"), ("c", "no pages")]
    got = words.where("error IS NULL").collect()
    assert [(r.doc_id, r.page_number, r.text, r.fallback_used) for r in got] == [("a", 1, "strong", True), ("a", 2, "strong", True)]
    assert documents.recognise(pages, strong_engine, weak_engine).where("fallback_used").count() == 0


def test_file_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"{n}.pdf").write_bytes(b"x" * (n + 1))
    run = lambda: files.extract_stream(files.file_stream(spark, str(tmp_path / "in")), lambda b: b.select("path", "length"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    run()
    (tmp_path / "in" / "9.pdf").write_bytes(b"late")
    run()
    assert sorted(r.length for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4]


def test_extraction_plan(spark):
    texts = spark.createDataFrame([(1, "Invoice Number: INV-7\nDate: 01/02/2024\nTotal: 90000")], "doc_id long, text string")
    blocks = spark.createDataFrame(grid([["Description", "HSN", "Qty", "Rate", "Amount"], ["Laptop", "8471", "2", "45000", "90000"]]), BLOCK)
    r = extraction.extract_invoices(texts, blocks).first()
    assert (r.invoice_info.invoice_number, r.invoice_info.invoice_date, r.totals.final_total, r.line_items[0].total_amount) == ("INV-7", "2024-02-01", 90000.0, 90000.0)


def test_config(tmp_path):
    (tmp_path / "c.json").write_text('{"ocr": {"threshold": 0.7, "nope": 1}, "other": 2}')
    s = config.load(str(tmp_path / "c.json"), {"PAPERLOOM_PDF_DPI": "150"})
    assert (s.ocr.threshold, s.pdf.dpi, s.issues()) == (0.7, 150, [])
    assert len(config.Settings().update({"ocr": {"threshold": 2.0}, "pdf": {"dpi": 0, "page_format": "GIF"}}).issues()) == 3


def plain_components(dark):
    seen, out = np.zeros(dark.shape, bool), []
    for y, x in zip(*np.nonzero(dark), strict=True):
        if not seen[y, x]:
            stack, own = [(y, x)], []
            seen[y, x] = True
            while stack:
                a, b = stack.pop()
                own.append((a, b))
                for c in range(max(0, a - 1), min(dark.shape[0], a + 2)):
                    for d in range(max(0, b - 1), min(dark.shape[1], b + 2)):
                        if dark[c, d] and not seen[c, d]:
                            seen[c, d] = True
                            stack.append((c, d))
            ys, xs = zip(*own, strict=True)
            out.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(own)))
    return sorted(out)


def test_components_equal_a_flood_fill():
    rng = np.random.default_rng(4)
    for share in (0.1, 0.3, 0.5, 0.7):
        dark = rng.random((25, 31)) < share
        assert sorted((a, b, c, d, int(m.sum())) for a, b, c, d, m in imaging.components(dark)) == plain_components(dark)
    assert imaging.components(np.zeros((3, 3), bool)) == []


def test_outlines_and_hulls():
    square = np.zeros((30, 40), bool)
    square[3:23, 5:35] = True
    (x1, y1, x2, y2, mask), = imaging.components(square)
    line = imaging.outline(mask)
    assert (x1, y1, x2, y2) == (5, 3, 35, 23) and imaging._area(line) == 29 * 19 and imaging.perimeter(line) == 2 * (29 + 19)
    assert imaging.corners(line) == 4 and len(imaging.hull(line)) == 4
    y, x = np.mgrid[0:101, 0:101]
    (*_, disc), = imaging.components((x - 50) ** 2 + (y - 50) ** 2 <= 45**2)
    line = imaging.outline(disc)
    assert 0.85 < 4 * np.pi * imaging._area(line) / imaging.perimeter(line) ** 2 <= 1 and imaging._area(imaging.hull(line)) >= imaging._area(line)
    assert len(imaging.outline(np.ones((1, 1), bool))) == 1


def test_kernels_equal_plain_loops():
    rng = np.random.default_rng(8)
    image = rng.integers(0, 256, (12, 14)).astype(np.uint8)
    padded, r = np.pad(image.astype(float), 4, mode="edge"), range(-4, 5)
    want = np.zeros_like(image)
    for i in range(12):
        for j in range(14):
            cells = [(padded[i + 4 + y, j + 4 + x], x * x + y * y) for y in r for x in r if x * x + y * y <= 16]
            w = [np.exp(-((v - float(image[i, j])) ** 2 + d) / (2 * 75**2)) for v, d in cells]
            want[i, j] = round(sum(a * v for a, (v, _) in zip(w, cells, strict=True)) / sum(w))
    assert (imaging.bilateral(image) == want).all()
    assert (imaging.binarise_fixed(image) == np.where(image > 127, 255, 0)).all()
    step = np.repeat(np.array([[40, 200]], np.uint8), 20, axis=0).repeat(20, axis=1)
    assert (imaging.binarise_adaptive(np.full((15, 15), 90, np.uint8)) == 255).all() and 0 in imaging.binarise_adaptive(step)
    assert (imaging.sharpen(np.full((5, 5), 9, np.uint8)) == 9).all() and imaging.sharpen(step)[10].max() > 200
    assert (imaging.enlarge(np.full((10, 8), 77, np.uint8), 40) == 77).all() and imaging.enlarge(step, 40).shape == (40, 80)


def test_deskew():
    page_ = np.full((200, 300), 255, np.uint8)
    page_[40:160:20, 20:280] = 0
    assert imaging.deskew(page_) is page_
    tilted = imaging.rotate(page_, -5)
    assert abs(np.median(imaging.line_angles(tilted)) - 5) <= 1
    straight = imaging.deskew(tilted)
    assert abs(np.median(imaging.line_angles(straight))) <= 1
    assert (imaging.rotate(page_, 90) == np.rot90(page_)).all()


def test_contours_boxes_and_crops(spark):
    image = np.full((260, 420), 255, np.uint8)
    y, x = np.mgrid[0:260, 0:420]
    ring = np.abs(np.hypot(x - 80, y - 80) - 40) < 3
    image[ring] = 0
    for at in (130, 180, 240):
        image[at : at + 2, 150:400] = 0
    for at in (150, 398):
        image[130:242, at : at + 2] = 0
    df = spark.createDataFrame([page(image)], PAGE)
    found = imaging.contours(df)
    seals = regions.circular_seals(found).orderBy(F.desc("circularity")).collect()
    assert [(abs(r.x1 - 37) < 4 and abs(r.y2 - 123) < 4) for r in seals] == [True, False]  # a box of lines is round enough for the gate
    assert seals[0].circularity > 0.85 > 0.7 > seals[1].circularity
    boxes = [(r.x1, r.y1, r.x2, r.y2) for r in imaging.ruled_boxes(df).where("x2 - x1 > 200 AND y2 - y1 > 100").collect()]
    assert boxes == [(150, 130, 400, 242)]
    cut = imaging.crops(df, regions.crop_boxes(found.where("region_id = 0").withColumns({"type": F.lit("circular_seal"), "confidence": F.lit(0.9), "width": F.lit(420), "height": F.lit(260)}))).first()
    assert len(cut.data) == (cut.x2 - cut.x1) * (cut.y2 - cut.y1) and cut.file_name == "circular_seal_0_conf_0.90.png"


def document_engines():
    """Files are text, a page for each form feed; its bytes are the pixels of one row, and words are cut from them."""

    def pages(content):
        if content.startswith(b"broken"):
            raise OSError("broken file")
        for part in content.split(b"\f"):
            yield np.frombuffer(part, np.uint8).reshape(1, -1)

    def engine(image):
        text = image.tobytes().decode()
        if "unreadable" in text:
            raise RuntimeError("engine failed")
        at = 0
        for n, line in enumerate(text.split("\n")):
            for k, cell in enumerate(line.split("|")):
                yield (cell, 0.9, 100 * k, 260 * (n > 5) + 30 * n, 100 * k + 90, 260 * (n > 5) + 30 * n + 20)
                at += 1

    return pages, engine


def test_files_to_verified_invoices(spark, tmp_path):
    pages, engine = document_engines()
    table = "Description|HSN|Qty|Rate|Amount\nLaptop|8471|2|45000|90000\nMouse|8471|3|100|300"
    good = f"TAX INVOICE\nInvoice Number: INV-2024-001\nDate: 15/05/2024\nGSTIN: 07AABCU9603R1ZV\nPO Number: PO-7\nGrand Total: 90300\n{table}"
    summed = good.replace("Grand Total: 90300", "Subtotal: {}\nCGST @ 9%: {}\nSGST @ 9%: 8127\nGrand Total: 106554")
    more = {"e": summed.format(90300, 8127), "f": summed.format(90000, 8127), "g": summed.format(90300, 9127), "h": good.replace("Grand Total: 90300", "Sub-Total: 90300\nDiscount (10%): 9,030\nTotal GST: 14628.60\nGrand Total: 95898.60")}
    for name, content in (("a/x", good), ("b/x", good.replace("INV-2024-001", "INV-2024-002")), ("c", "broken"), ("d", "unreadable\ftext"), *more.items()):
        path = tmp_path / "in" / f"{name}.pdf"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode())
    scanned = documents.scan_files(spark, str(tmp_path / "in"))
    assert sorted(r.doc_id for r in scanned.select("doc_id").collect()) == ["a/x", "b/x", "c", "d", *more]
    assert {r.doc_id: (r.n_pages, r.error) for r in documents.page_counts(documents.rasterise(scanned, pages)).collect()} == {"a/x": (1, None), "b/x": (1, None), "c": (0, "broken file"), "d": (2, None), **dict.fromkeys(more, (1, None))}
    assert imaging.preprocess(documents.rasterise(scanned, pages), ("median",)).where("error IS NULL").count() == 8
    out = extraction.process_files(scanned, str(tmp_path / "out"), "2024-06-01", pages, engine)
    got = {r.doc_id: r for r in spark.read.json(out["json"]).collect()}
    assert set(got) == {"a/x", "b/x", "d", *more} and got["b/x"].invoice_info.invoice_number == "INV-2024-002" and got["a/x"].totals.final_total == 90300.0
    assert [(i.description, i.quantity, i.total_amount) for i in got["a/x"].line_items] == [("Laptop", 2.0, 90000.0), ("Mouse", 3.0, 300.0)]
    assert sorted((r.doc_id, r.page_number, r.error) for r in spark.read.json(out["failures"]).collect()) == [("c", 0, "broken file"), ("d", 1, "engine failed")]
    flags = {r.doc_id: r for r in spark.read.parquet(out["flags"]).collect()}
    assert set(flags) == {"a/x", "b/x", "d", *more} and flags["a/x"].line_items_valid
    judged = {k: (r.overall_status, r.calculations_valid, r.gst_valid, r.n_errors) for k, r in flags.items()}
    assert judged["a/x"][1:] == judged["e"][1:] == judged["h"][1:] == (True, True, 0)
    assert judged["f"][3] == 2 and not judged["f"][1]  # the subtotal is not that of the lines, and the total not its sum
    assert judged["g"][3] == 2 and not judged["g"][2]  # the GST is not that of its rate, nor the total its sum
    assert (got["h"].totals.subtotal, got["h"].totals.discount, got["h"].totals.total_gst, got["h"].totals.final_total) == (90300.0, 9030.0, 14628.6, 95898.6)
    assert spark.read.option("header", True).csv(out["verification"]).count() == 35
    documents.write_page_images(documents.rasterise(scanned, pages), str(tmp_path / "images"))
    images = spark.read.parquet(str(tmp_path / "images")).collect()
    assert sorted(r.file_name for r in images) == sorted(["a/x/page_001.pgm", "b/x/page_001.pgm", "d/page_001.pgm", "d/page_002.pgm", *(f"{k}/page_001.pgm" for k in more)]) and all(bytes(r.content).startswith(b"P5\n") for r in images)
