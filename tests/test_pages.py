import io
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.sources import codecs, pages


def grey(seed, h, w):
    return np.random.default_rng(seed).integers(0, 256, (h, w), dtype=np.uint8)


def colour(seed, h, w):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def page_file(folder, name, images):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(codecs.PortableMaps.dump(i) for i in images))


@pytest.mark.parametrize("image", [grey(1, 7, 5), colour(2, 4, 9), grey(3, 1, 1), np.zeros((0, 3), np.uint8)])
@pytest.mark.parametrize("codec", [codecs.PortableMaps, codecs.Png])
def test_codecs_round_trip(image, codec):
    file = io.BytesIO(codec.dump(image))
    (entry,) = codec.index(file)
    assert np.array_equal(codec.load(file, entry), image) and codec.load(file, entry).shape == image.shape


def test_png_filters_equal_their_definition():
    image = np.cumsum(colour(5, 6, 8) % 5, axis=1).astype(np.uint8)
    rows, step = image.reshape(6, -1).astype(int), 3
    lines = []
    for y, kind in enumerate((0, 1, 2, 3, 4, 4)):
        out = []
        for i, v in enumerate(rows[y]):
            a, b, c = rows[y][i - step] if i >= step else 0, rows[y - 1][i] if y else 0, rows[y - 1][i - step] if y and i >= step else 0
            nearest = min((abs(a + b - c - x), k, x) for k, x in enumerate((a, b, c)))[2]
            out.append((v - (0, a, b, (a + b) // 2, nearest)[kind]) % 256)
        lines.append(bytes([kind, *out]))
    chunk = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
    head = (8).to_bytes(4, "big") + (6).to_bytes(4, "big") + bytes([8, 2, 0, 0, 0])
    data = codecs.PNG_HEAD + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert np.array_equal(codecs.Png.load(io.BytesIO(data)), image)
    broken = data[:60] + bytes([data[60] ^ 1]) + data[61:]
    for bad in (data[:50], broken, b"x"):
        with pytest.raises((ValueError, zlib.error)):
            codecs.Png.load(io.BytesIO(bad), *codecs.Png.index(io.BytesIO(bad)))


def test_headers_of_portable_maps():
    file = io.BytesIO(b"P5 # note\n# 9 9\n 3\t2\n255\n" + bytes(range(6)) + b"P6\n1 1 255 abc")
    index = codecs.PortableMaps.index(file)
    assert [e[1:] for e in index] == [(2, 3, 1), (1, 1, 3)]
    assert codecs.PortableMaps.load(file, index[0]).tolist() == [[0, 1, 2], [3, 4, 5]] and codecs.PortableMaps.load(file, index[1]).tolist() == [[[97, 98, 99]]]
    for bad in (b"P5 3 2 70000 ", b"P4 1 1 1", b"P5 3"):
        with pytest.raises(ValueError):
            codecs.PortableMaps.index(io.BytesIO(bad))


@pytest.fixture
def folder(tmp_path):
    page_file(tmp_path, "a/one.pgm", [grey(i, 40, 30) for i in range(7)])
    page_file(tmp_path, "a/one.ppm", [colour(1, 3, 4)])
    page_file(tmp_path, "two.pgm", [grey(9, 5, 6)])
    (tmp_path / "bad.pgm").write_bytes(b"none")
    (tmp_path / "empty.pgm").write_bytes(b"")
    (tmp_path / "cut.pgm").write_bytes(codecs.PortableMaps.dump(grey(1, 2, 2)) + b"P5 5 5 255 xx")
    (tmp_path / "_hidden.pgm").write_bytes(b"x")
    (tmp_path / "note.txt").write_bytes(b"x")
    return tmp_path


def test_pages_of_files(spark, folder):
    df = pages.read_pages(spark, str(folder), pattern="*.p?m")
    got = {(r.doc_id, r.path.rpartition(".")[2], r.page_number): r for r in df.collect()}
    assert sorted(got) == sorted([*[("a/one", "pgm", i) for i in range(1, 8)], ("a/one", "ppm", 1), ("two", "pgm", 1), ("bad", "pgm", 0), ("empty", "pgm", 0), ("cut", "pgm", 1), ("cut", "pgm", 2)])
    r = got["a/one", "pgm", 3]
    assert (r.n_pages, r.height, r.width, r.channels, r.error) == (7, 40, 30, 1, None) and bytes(r.data) == grey(2, 40, 30).tobytes()
    assert got["a/one", "ppm", 1].channels == 3
    assert got["bad", "pgm", 0].error == "not a portable map" and got["empty", "pgm", 0].error == "no pages"
    assert got["cut", "pgm", 2].error == "pixels break off" and got["cut", "pgm", 2].data is None and got["cut", "pgm", 1].error is None
    everything = pages.read_pages(spark, str(folder)).where("doc_id = 'note'").collect()
    assert [r.error for r in everything] == ["no codec for this kind of file"]


def test_a_large_file_is_split_by_page_ranges(spark, folder):
    df = pages.read_pages(spark, str(folder), pattern="one.pgm", partition_bytes=3000)
    per = df.groupBy(F.spark_partition_id().alias("task")).agg(F.sort_array(F.collect_list("page_number")).alias("p")).collect()
    assert df.rdd.getNumPartitions() == 3 and sorted(r.p for r in per) == [[1, 2], [3, 4], [5, 6, 7]]
    many = pages.read_pages(spark, str(folder), pattern="one.pgm", partition_bytes=100)
    assert sorted(r.page_number for r in many.collect()) == list(range(1, 8)) and many.rdd.getNumPartitions() > 7
    bad = pages.read_pages(spark, str(folder), pattern="bad.pgm", partition_bytes=1)
    assert bad.count() == 1  # one row with the error, not one for each part


class Counting:
    """A codec that tells which pages have been loaded."""

    @staticmethod
    def index(file):
        return codecs.PortableMaps.index(file)

    @staticmethod
    def load(file, entry):
        with open(os.environ["LOADED"], "a") as f:
            f.write(f"{entry[0]}\n")
        return codecs.PortableMaps.load(file, entry)


def test_pixels_are_read_only_if_wanted_and_filters_reach_the_reader(spark, folder, monkeypatch):
    reader = pages.PagesReader(pages.StructType.fromDDL("doc_id string, page_number int"), {"path": str(folder), "pattern": "*.pgm"})
    log = folder / "loaded"
    monkeypatch.setenv("LOADED", str(log))
    reader.codec = "tests.test_pages:Counting"
    (span,) = reader.partitions()
    rows = [r for b in reader.read(span) for r in b.to_pylist()]
    assert len(rows) == 12 and not log.exists()

    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

    other = StringContains(("path",), "x")
    pushing = pages.PushingReader(pages.StructType.fromDDL(pages.PAGES), {"path": str(folder), "pattern": "*.pgm", "codec": "tests.test_pages:Counting"})
    assert list(pushing.pushFilters([In(("doc_id",), ("a/one", "bad")), GreaterThan(("page_number",), 4), IsNotNull(("page_number",)), other])) == [other]
    (span,) = pushing.partitions()
    assert [f.rpartition("/")[2] for f, _ in span.files] == ["one.pgm", "bad.pgm"]
    assert [r["page_number"] for b in pushing.read(span) for r in b.to_pylist()] == [5, 6, 7] and len(log.read_text().split()) == 3
    assert list(pushing.pushFilters([EqualTo(("page_number",), 6)])) == [] and pushing.bounds == (6, 6)


def test_pushed_filters_give_the_same_rows(spark, folder):
    df = lambda: pages.read_pages(spark, str(folder), pattern="*.pgm")
    wanted = lambda d: sorted((r.doc_id, r.page_number) for r in d.where("doc_id IN ('a/one', 'bad') AND page_number <= 2").select("doc_id", "page_number").collect())
    plain = wanted(df())
    spark.conf.set(pages.PUSHDOWN, "true")
    try:
        assert wanted(df()) == plain == [("a/one", 1), ("a/one", 2), ("bad", 0)]
    finally:
        spark.conf.unset(pages.PUSHDOWN)


def test_written_images_are_read_back(spark, tmp_path):
    images = [grey(i, 4 + i, 5) for i in range(5)] + [colour(7, 3, 3)]
    rows = [(f"doc{i % 2}/page_{i:03d}.{e}", i_.shape[0], i_.shape[1], 1 if i_.ndim == 2 else 3, i_.tobytes()) for i, i_ in enumerate(images) for e in ("png", "ppm" if i == 5 else "pgm")]
    rows.append(("odd.png", 9, 9, 1, b"short"))
    rows.append(("odd.webp", 1, 1, 1, b"x"))
    df = spark.createDataFrame(rows, "file_name string, height int, width int, channels int, data binary").repartition(3)
    said = {r.file_name: r for r in pages.write_files(df, str(tmp_path / "out")).collect()}
    assert sorted(said) == sorted(r[0] for r in rows) and said["odd.png"].error and "webp" in said["odd.webp"].error
    out = tmp_path / "out"
    names = sorted(n for p in out.rglob("*") if p.is_file() and (n := str(p.relative_to(out)))[0] not in "._")
    assert names == sorted(r[0] for r in rows[:-2]) and not list((tmp_path / "out").glob(".staging*"))
    assert said["doc0/page_000.png"].bytes == (tmp_path / "out/doc0/page_000.png").stat().st_size
    back = {(r.doc_id, r.path.rpartition(".")[2]): (r.height, r.width, r.channels, bytes(r.data)) for r in pages.read_pages(spark, str(tmp_path / "out")).collect()}
    assert back == {(n.rpartition(".")[0], n.rpartition(".")[2]): (h, w, c, d) for n, h, w, c, d in rows[:-2]}
    pages.write_files(df.where("file_name LIKE 'doc0%'"), str(tmp_path / "out"), "overwrite")
    assert sorted(p.name for p in (tmp_path / "out/doc1").iterdir() if not p.name.startswith(".")) == [] and pages.written(spark, str(tmp_path / "out")).count() == 6


def left(folder):
    return [p for p in folder.rglob("*") if p.is_file()] if folder.exists() else []


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    df = spark.range(8).repartition(4).withColumn("file_name", F.concat("id", F.lit(".bin"))).withColumn("content", F.encode(F.expr("CASE WHEN id = 5 THEN raise_error('no') ELSE 'x' END"), "US-ASCII"))
    with pytest.raises(Exception, match="no"):
        pages.write_files(df, str(tmp_path / "out"))
    assert left(tmp_path / "out") == []
    for name in ("/abs", "../up", ".hidden"):
        with pytest.raises(Exception, match="not a name"):
            pages.write_files(spark.createDataFrame([(name, b"x")], "file_name string, content binary"), str(tmp_path / "out"))
    twice = spark.createDataFrame([("a.bin", b"x"), ("a.bin", b"y")], "file_name string, content binary")
    with pytest.raises(Exception, match="several rows"):
        pages.write_files(twice, str(tmp_path / "out"))
    assert left(tmp_path / "out") == []
    with pytest.raises(Exception, match="rows need"):
        pages.write_files(spark.range(1), str(tmp_path / "out"))


def test_abort_and_killed_attempts(tmp_path):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"file_name": "x/a.bin", "content": b"1"}])
    writer = pages.FileWriter({"path": str(tmp_path / "out")}, False)
    writer.write(iter([batch]))  # an attempt that was killed: its message never arrives
    done = writer.write(iter([batch]))
    writer.commit([done, None])
    assert (tmp_path / "out/x/a.bin").read_bytes() == b"1" and not list((tmp_path / "out").glob(".staging*"))
    again = pages.FileWriter({"path": str(tmp_path / "out")}, False)
    again.abort([again.write(iter([pa.RecordBatch.from_pylist([{"file_name": "x/b.bin", "content": b"2"}])]))])
    assert not (tmp_path / "out/x/b.bin").exists() and not list((tmp_path / "out").glob(".staging*")) and (tmp_path / "out/x/a.bin").exists()


def test_empty_rows_and_folders(spark, tmp_path):
    none = spark.createDataFrame([], "file_name string, content binary")
    assert pages.write_files(none, str(tmp_path / "out")).count() == 0
    assert pages.read_pages(spark, str(tmp_path / "out")).count() == 0
