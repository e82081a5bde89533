import io

import numpy as np

from paperloom.operators import workbook
from paperloom.plans import extraction
from paperloom.sources import codecs, documents


def engines():
    """Pages are portable maps; the engine reads the words that the first pixels of a page hold as bytes."""
    import numpy as np

    def rasteriser(content):
        import io

        from paperloom.sources import codecs

        file = io.BytesIO(bytes(content))
        for entry in codecs.PortableMaps.index(file):
            yield codecs.PortableMaps.load(file, entry)

    def engine(image):
        text = bytes(255 - image[0][: np.flatnonzero(image[0] == 255)[0]]).decode()
        return [(cell, 0.9, 100 * j, 40 * n, 100 * j + 80, 40 * n + 20) for n, line in enumerate(text.split("\n")) for j, cell in enumerate(line.split("|"))]

    return rasteriser, engine


def page_of(text, seal):
    image = np.full((260, 300), 255, np.uint8)
    raw = np.frombuffer(text.encode(), np.uint8)
    image = np.hstack([image, np.full((260, len(raw)), 255, np.uint8)])
    image[0, : len(raw)] = 255 - raw
    if seal:
        y, x = np.mgrid[0:260, 0 : image.shape[1]]
        image[(y - 120) ** 2 + (x - 90) ** 2 <= 30 * 30] = 0
    return image


def test_files_to_invoices_seals_images_and_workbooks(spark, tmp_path):
    text = "Invoice Number: INV-9\nDate: 01/02/2024\nGSTIN: 07AABCU9603R1ZV\nSubtotal: 300\nGST @ 18%: x\nTotal GST: 54\nGrand Total: 354\nDescription|HSN|Qty|Rate|Amount\nMouse|8471|3|100|300"
    folder = tmp_path / "in"
    (folder / "a").mkdir(parents=True)
    (folder / "a/one.pdf").write_bytes(codecs.PortableMaps.dump(page_of(text, True)) + codecs.PortableMaps.dump(page_of("more", False)))
    (folder / "two.pdf").write_bytes(codecs.PortableMaps.dump(page_of(text.replace("Subtotal: 300", "Subtotal: 200"), False)))
    (folder / "bad.pdf").write_bytes(b"no map")
    rasteriser, engine = engines()
    out = extraction.process_files(documents.scan_files(spark, str(folder)), str(tmp_path / "out"), "2024-06-01", rasteriser, engine, extras=("seals", "images", "workbooks"))
    nested = {r.doc_id: r for r in spark.read.json(out["json"]).collect()}
    assert set(nested) == {"a/one", "two"} and (nested["a/one"].totals.subtotal, nested["a/one"].totals.total_gst, nested["a/one"].totals.final_total) == (300.0, 54.0, 354.0)
    one, two = nested["a/one"].seals_signatures, nested["two"].seals_signatures
    assert one.detected and one["count"] == 1
    assert not two.detected and two["count"] == 0 and two.file_paths == []
    (name,) = one.file_paths
    assert name.startswith("seal_images/a/one/page_001/circular_seal_")
    crop = codecs.Png.load(io.BytesIO((tmp_path / "out" / name).read_bytes()))
    assert crop.shape == (81, 81) and crop[40, 40] == 0 and crop[0, 0] == 255
    images = sorted(str(p.relative_to(tmp_path / "out/images")) for p in (tmp_path / "out/images").rglob("*.png"))
    assert images == ["a/one/processed_page_001.png", "a/one/processed_page_002.png", "two/processed_page_001.png"]
    flags = {r.doc_id: r for r in spark.read.parquet(out["flags"]).collect()}
    assert flags["a/one"].n_errors == 0 and flags["a/one"].gst_valid and flags["two"].n_errors == 2 and not flags["two"].calculations_valid
    book = {(s, r, c): t if n is None else n for s, r, c, t, n in workbook.read_cells((tmp_path / "out/workbooks/a/one.xlsx").read_bytes())}
    assert book["Invoice Summary", 2, 2] == "INV-9" and book["Line Items", 2, 1] == "Mouse" and book["Invoice Summary", 14, 2] == 354.0 and ("Verification", 2, 1) in book
    assert [(r.doc_id, r.error) for r in spark.read.json(out["failures"]).collect()] == [("bad", "not a portable map")]
