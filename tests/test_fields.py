import json

import pytest
from pyspark.sql import functions as F

from paperloom import config
from paperloom.functions import fields
from paperloom.functions import text as X
from paperloom.operators import layout, ocr
from paperloom.sources import pages


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    ("kind", "good", "bad"),
    [
        ("invoice_number", ["INV-2024-001", "BILL/2024/001", "12345", "B-2024-789"], ["", "INV", "???", "INVALID@#$", None]),
        ("date", ["15/05/2024", "2024-05-15", "15-May-2024", "29-02-2024"], ["32/13/2024", "2024-15-05", "invalid_date", "", "29-02-2023", "15/05/2024x", None]),
        ("gst_number", ["07AABCU9603R1ZV", "29GGGGG1314R9Z6", "27AAPFU0939F1ZV"], ["INVALID123", "07AABCU9603R1Z", "07AABCU9603R1ZVX", "ABCDEFGHIJKLMNO", "", None]),
    ],
)
def test_forms(spark, kind, good, bad):
    rows = spark.createDataFrame([(v, v in good) for v in good + bad], "v string, fits boolean")
    assert rows.where(fields.has_form(F.col("v"), kind) != F.col("fits")).collect() == []


def test_context_and_white_space(spark):
    assert one(spark, "Additional charges: Invoice Number INV-2024-999 for services", lambda v: fields.in_context(v, "invoice_number", 50)) == "INV-2024-999"
    assert one(spark, "none here", lambda v: fields.in_context(v, "invoice_number")) is None
    assert one(spark, "  Invoice    Number:   INV-2024-001  \n\n  ", fields.collapsed) == "Invoice Number: INV-2024-001" and one(spark, None, fields.collapsed) == ""


def test_confident_fields(spark):
    row = {"invoice_number": ("INV-001", 0.3), "invoice_date": ("15/05/2024", 0.9), "gst_number": ("07AABCU9603R1ZV", 0.4), "po": ("x", None), "at": ("y", 0.5)}
    df = spark.createDataFrame([(row,)], "f map<string, struct<value: string, confidence: double>>")
    assert set(df.select(fields.confident(F.col("f")).alias("f")).first().f) == {"invoice_date", "at"}


def test_names_of_files(spark):
    for path, ext, name in (("/a/b.PDF", ".pdf", "b_x.json"), ("s3://k/v1.2/noext", "", "noext_x.json"), (".hidden", "", ".hidden_x.json"), ("a.tar.gz", ".gz", "a.tar_x.json"), ("dir.d/.env.txt", ".txt", ".env_x.json"), ("", "", "_x.json")):
        assert one(spark, path, fields.extension) == ext and one(spark, path, lambda v: fields.output_name(v, "x", "json")) == name, path
        assert one(spark, path, fields.is_pdf) == (ext == ".pdf")


def test_sums_of_a_text(spark):
    text = "Sub-Total: Rs. 1,000.00\nTotal Discount @ 10%: 100\nCGST (9%): 81\nSGST 9% 81.00\nGrand Total: ₹1,062"
    got = spark.createDataFrame([(text,), ("Total: 5",), (None,)], "t string").select(*[c.alias(n) for n, c in X.sums(F.col("t")).items()], X.final_total(F.col("t")).alias("total")).collect()
    assert [float(v) for v in got[0]] == [1000, 100, 162, 18, 1062]
    assert list(got[1]) == [None, None, None, None, "5"] and list(got[2]) == [None] * 5


def test_ocr_results_as_files(spark, tmp_path):
    schema = "doc_id string, page_number int, block_pos int, text string, confidence double, x1 int, y1 int, x2 int, y2 int, fallback_used boolean, error string"
    rows = [("a/1", 2, 0, "é\"", 0.5, 1, 2, 3, 4, True, None), ("a/1", 1, 1, "b", 0.9, 0, 0, 1, 1, False, None), ("a/1", 1, 0, "a", 0.7, 0, 5, 1, 6, False, None), ("a/1", 10, -1, None, None, None, None, None, None, False, "broken")]
    words = spark.createDataFrame(rows, schema)
    (said,) = pages.write_files(ocr.result_files(words), str(tmp_path)).collect()
    content = (tmp_path / "a/1_ocr.json").read_text("utf-8")
    found = json.loads(content)
    assert said.file_name == "a/1_ocr.json" and "\n" in content and "é" in content and found["total_pages"] == 3
    assert [p["page_number"] for p in found["pages"]] == [1, 2, 10] and [b["text"] for b in found["pages"][0]["text_blocks"]] == ["a", "b"]
    assert found["pages"][0]["average_confidence"] == pytest.approx(0.8) and found["pages"][2]["error"] == "broken" and found["pages"][2]["text_blocks"] == []
    assert found["pages"][1]["text_blocks"][0]["bbox"] == [1, 2, 3, 4]


def test_settings_are_saved_and_read(tmp_path):
    own = config.Settings()
    own.ocr.languages, own.checks.tolerance, own.output_dir = ["en", "hi"], 0.05, "out/"
    for name in ("x/s.json", "s.yaml"):
        pytest.importorskip("yaml") if name.endswith("yaml") else None
        config.save(own, str(tmp_path / name))
        assert config.load(str(tmp_path / name), {}) == own
    assert config.folders(own)["json"] == "out/json" and "checks.tolerance: 0.05" in config.summary(own).split("\n")


def test_table_regions_equal_their_methods(spark):
    block = "doc_id long, page_number int, block_pos int, text string, confidence double, x1 int, y1 int, x2 int, y2 int"
    rows = []
    for doc in range(40):
        for i in range(doc % 12):
            text = "amount" if doc % 3 == 0 and i % 4 == 1 else f"w{i}"
            rows.append((doc, 1, i, text, 0.9, 60 * (i % 4), 30 * (i // 4) + doc % 7, 60 * (i % 4) + 50, 30 * (i // 4) + 20))
    blocks = spark.createDataFrame(rows, block)
    boxes = spark.createDataFrame([(d, 1, 0, -10, -10, 260 + d, 120 + d) for d in range(0, 40, 2)] + [(4, 1, 1, 0, 0, 10, 10)], "doc_id long, page_number int, box_id int, x1 int, y1 int, x2 int, y2 int")
    cols = ["doc_id", "x1", "y1", "x2", "y2", "confidence"]
    methods = [layout.regions_from_headers(blocks), layout.regions_from_boxes(boxes, blocks), layout.regions_from_grid(blocks)]
    by = [sorted(tuple(r) for r in m.select(*cols).collect()) for m in methods]
    for with_boxes in (True, False):
        used = [m for i, m in enumerate(by) if with_boxes or i != 1]
        want, seen = [], set()
        for m in used:
            own = [r for r in m if r[0] not in seen]
            want += own
            seen |= {r[0] for r in own}
        got = layout.table_regions(blocks, boxes if with_boxes else None)
        assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(want)
    plan = layout.table_regions(blocks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
