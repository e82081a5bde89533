"""Page images as a Spark data source, and files as a sink that commits in two phases.

    register(spark)
    spark.read.format("pages").load(folder)
    df.write.format("page_files").mode("append").save(folder)

Reading: a file is split by page ranges once it is larger than ``partition_bytes``, smaller ones share a
task; the driver sees names and lengths only. Columns that a given schema leaves out are not made, so
without ``data`` no pixel is read. Writing: every task writes below a staging folder of the job; files get
their names when all tasks have succeeded, and a job that fails leaves nothing.

Paths are opened through pyarrow's file systems (local paths and URIs), on the executors.
"""

from __future__ import annotations

import fnmatch
import importlib
import json
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from . import codecs

PAGES = "doc_id string, path string, page_number int, n_pages int, height int, width int, channels int, data binary, error string"
#: Bytes of files that a task reads, and of pixels that it hands on at once.
PARTITION_BYTES, BATCH_BYTES = 32 << 20, 16 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if ":" in path.split("/")[0]:
        scheme, _, rest = path.partition(":")
        return pafs.FileSystem.from_uri(f"{scheme}://{'/' + rest.lstrip('/') if scheme == 'file' else rest.lstrip('/')}")
    return pafs.LocalFileSystem(), path


def codec_for(path: str, named: str | None):
    """The codec that ``named`` (module:attribute) gives, else the one for the file's extension."""
    if named:
        module, _, attribute = named.partition(":")
        return getattr(importlib.import_module(module), attribute)
    codec = codecs.BY_EXTENSION.get(path.rpartition(".")[2].lower())
    if not codec:
        raise ValueError("no codec for this kind of file")
    return codec


def doc_id_of(path: str, folder: str) -> str:
    """The path below ``folder``, without extension."""
    below = path[len(folder.rstrip("/")) + 1 :]
    name = posixpath.basename(below)
    return below[: len(below) - len(name)] + (name.rpartition(".")[0] or name)


@dataclass
class Span(ds.InputPartition):
    """Files (path, length) of one task; of a single large file the ``part``-th of ``parts`` page ranges."""

    files: list[tuple[str, int]]
    part: int = 0
    parts: int = 1


class PagesReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = schema.names
        self.schema = schema
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*")
        self.codec = options.get("codec")
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.bounds: tuple[int, int | None] = (0, None)
        self.docs: set | None = None

    def partitions(self) -> list[Span]:
        system, folder = file_system(self.folder)
        found = [f for f in system.get_file_info(pafs.FileSelector(folder, recursive=True)) if f.type == pafs.FileType.File]
        hidden = lambda below: any(x[:1] in "._" for x in below.split("/"))
        kept = []
        for f in sorted(found, key=lambda f: f.path):
            below = f.path[len(folder.rstrip("/")) + 1 :]
            if not hidden(below) and fnmatch.fnmatchcase(f.base_name, self.pattern) and (self.docs is None or doc_id_of(f.path, folder) in self.docs):
                kept.append((f.path, f.size))
        out: list[Span] = []
        lot, size = [], 0
        for path, length in kept:
            if length > self.partition_bytes:
                parts = -(-length // self.partition_bytes)
                out += [Span([(path, length)], i, parts) for i in range(parts)]
                continue
            if lot and size + length > self.partition_bytes:
                out.append(Span(lot))
                lot, size = [], 0
            lot.append((path, length))
            size += length
        return out + [Span(lot)] * bool(lot) or [Span([])]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(self.folder)
        rows: list[dict] = []
        size = 0
        for path, _ in partition.files:
            for row in self.rows(system, folder, path, partition):
                rows.append(row)
                size += len(row["data"] or b"") + 200
                if size >= BATCH_BYTES:
                    yield self.batch(rows)
                    rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        return pa.RecordBatch.from_pylist([{n: r[n] for n in self.names} for r in rows], to_arrow_schema(self.schema))

    def rows(self, system: pafs.FileSystem, folder: str, path: str, span: Span) -> Iterator[dict]:
        row = dict.fromkeys((f.split()[0] for f in PAGES.split(", ")))
        row |= {"doc_id": doc_id_of(path, folder), "path": path}
        least, most = self.bounds
        try:
            with system.open_input_file(path) as file:
                codec = codec_for(path, self.codec)
                entries = codec.index(file)
                if not entries:
                    raise ValueError("no pages")
                n = len(entries)
                for i in range(n * span.part // span.parts, n * (span.part + 1) // span.parts):
                    if i + 1 < least or (most is not None and i + 1 > most):
                        continue
                    own = row | {"page_number": i + 1, "n_pages": n}
                    if {"height", "width", "channels", "data", "error"} & {*self.names}:
                        try:
                            entry = entries[i]
                            if "data" not in self.names and isinstance(codec, type) and issubclass(codec, codecs.PortableMaps):
                                own |= {"height": entry[1], "width": entry[2], "channels": abs(entry[3])}  # the header says it
                            else:
                                image = np.ascontiguousarray(codec.load(file, entry)).astype(np.uint8, copy=False)
                                own |= {"height": image.shape[0], "width": image.shape[1], "channels": 1 if image.ndim == 2 else image.shape[2], "data": image.tobytes()}
                        except Exception as e:  # a codec may raise anything; the page is reported, the others go on
                            own["error"] = str(e) or type(e).__name__
                    yield own
        except Exception as e:  # as above, for the file
            if span.part == 0 and least <= 0:
                yield row | {"page_number": 0, "n_pages": 0, "error": str(e) or type(e).__name__}


class PushingReader(PagesReader):
    """Takes comparisons of doc_id (which files are opened) and page_number (which pages are loaded)."""

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        for f in filters:
            name = getattr(f, "attribute", ())
            least, most = self.bounds
            below = lambda x: x if most is None else min(most, x)  # noqa: E731, B023
            if name == ("doc_id",) and isinstance(f, (ds.EqualTo, ds.In)):
                own = {f.value} if isinstance(f, ds.EqualTo) else {*f.value}
                self.docs = own if self.docs is None else self.docs & own
            elif name == ("page_number",) and isinstance(f, ds.EqualTo):
                self.bounds = (max(least, f.value), below(f.value))
            elif name == ("page_number",) and isinstance(f, (ds.GreaterThan, ds.GreaterThanOrEqual)):
                self.bounds = (max(least, f.value + isinstance(f, ds.GreaterThan)), most)
            elif name == ("page_number",) and isinstance(f, (ds.LessThan, ds.LessThanOrEqual)):
                self.bounds = (least, below(f.value - isinstance(f, ds.LessThan)))
            elif name in (("page_number",), ("doc_id",)) and isinstance(f, ds.IsNotNull):
                continue
            else:
                yield f


class PagesSource(ds.DataSource):
    """One row for each page of the image files below a folder: doc_id (the path from there, without
    extension), path, page_number (from 1), n_pages, height, width, channels (1 or 3), data, error.

    Options: ``pattern`` of file names, ``codec`` (module:attribute; by default chosen by extension),
    ``partition_bytes``, ``push`` (take filters). A file that can't be read is one row with page_number 0
    and its error; a page that can't, a row with its number and its error. Hidden files (names that
    begin with a dot or an underscore) are passed over; an empty folder gives no rows."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        unknown = {*schema.names} - {f.split()[0] for f in PAGES.split(", ")}
        if unknown:
            raise ValueError(f"pages have no column {sorted(unknown)}")
        return (PushingReader if self.options.get("push") == "true" else PagesReader)(schema, self.options)


@dataclass
class Written(ds.WriterCommitMessage):
    """What one task has written, and where."""

    task: str
    names: list[str] = field(default_factory=list)


class FileWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.movers = int(options.get("movers", 16))

    @property
    def staging(self) -> str:
        return f"{file_system(self.folder)[1].rstrip('/')}/.staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _ = file_system(self.folder)
        done = Written(uuid.uuid4().hex)  # an attempt of its own: what a killed one leaves has another name
        top = f"{self.staging}/{done.task}"
        said = []
        for batch in iterator:
            has = {n: batch.column(n).to_pylist() for n in ("file_name", "content", "height", "width", "channels", "data") if n in batch.schema.names}
            for i, name in enumerate(has["file_name"]):
                own = {n: v[i] for n, v in has.items()}
                try:
                    content = own.get("content")
                    if content is None:
                        shape = (own["height"], own["width"]) if own.get("channels") in (None, 1) else (own["height"], own["width"], own["channels"])
                        content = codecs.dumped(np.frombuffer(own["data"], np.uint8).reshape(shape), name)
                except Exception as e:  # one image that can't be made is reported, the others are written
                    said.append({"file_name": name, "bytes": 0, "error": str(e) or type(e).__name__})
                    continue
                if not name or name.startswith(("/", ".", "_")) or ".." in name.split("/"):
                    raise ValueError(f"not a name for a file: {name}")
                self.put(system, f"{top}/files/{name}", content)
                done.names.append(name)
                said.append({"file_name": name, "bytes": len(content), "error": None})
        if said:
            self.put(system, f"{top}/written.json", "".join(json.dumps(x) + "\n" for x in said).encode())
        return done

    @staticmethod
    def put(system: pafs.FileSystem, path: str, content: bytes) -> None:
        system.create_dir(posixpath.dirname(path), recursive=True)
        with system.open_output_stream(path) as out:
            out.write(content)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.folder)
        tasks = [m for m in messages if m]
        seen: set[str] = set()
        twice = {n for m in tasks for n in m.names if n in seen or seen.add(n)}
        if twice:
            raise ValueError(f"several rows have the name {min(twice)}")
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            self.remove_written(system, folder)
        places = {posixpath.dirname(f"{folder}/{n}") for n in seen} | {f"{folder}/_written"}
        for place in sorted(places):
            system.create_dir(place, recursive=True)
        moves = [(f"{self.staging}/{m.task}/files/{n}", f"{folder}/{n}") for m in tasks for n in m.names]
        with ThreadPoolExecutor(self.movers) as pool:
            list(pool.map(lambda x: system.move(*x), moves))
        for m in tasks:
            said = f"{self.staging}/{m.task}/written.json"
            if system.get_file_info(said).type == pafs.FileType.File:
                system.move(said, f"{folder}/_written/{m.task}.json")
        self.put(system, f"{folder}/_SUCCESS", b"")
        self.clear()

    @staticmethod
    def remove_written(system: pafs.FileSystem, folder: str) -> None:
        """Removes the files that earlier jobs have written here, by their own lists."""
        for f in system.get_file_info(pafs.FileSelector(f"{folder}/_written", allow_not_found=True)):
            with system.open_input_stream(f.path) as lines:
                names = [x["file_name"] for x in map(json.loads, lines.read().splitlines()) if not x["error"]]
            for name in names:
                if system.get_file_info(f"{folder}/{name}").type == pafs.FileType.File:
                    system.delete_file(f"{folder}/{name}")
            system.delete_file(f.path)

    def abort(self, messages: list[Written | None]) -> None:
        self.clear()

    def clear(self) -> None:
        system, _ = file_system(self.folder)
        if system.get_file_info(self.staging).type == pafs.FileType.Directory:
            system.delete_dir(self.staging)


class FileSink(ds.DataSource):
    """Writes a file for each row: ``file_name`` (a path below the folder) and either ``content``, or
    ``height``, ``width``, ``data`` and perhaps ``channels``, encoded as the name's extension asks (png,
    pgm, ppm). Other columns are ignored.

    All or nothing: names appear when every task has succeeded (then also ``_SUCCESS``); a failed or
    aborted job, and attempts of killed tasks, leave no file. Two rows with one name are an error. An
    image that can't be encoded is left out and reported. ``written`` lists names, sizes and errors.
    Overwriting removes what earlier jobs of this sink have written to the folder, and nothing else."""

    @classmethod
    def name(cls) -> str:
        return "page_files"

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:
        if "file_name" not in schema.names or not ({"content"} <= {*schema.names} or {"height", "width", "data"} <= {*schema.names}):
            raise ValueError("rows need file_name, and content or height, width and data")
        return FileWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagesSource)
    spark.dataSource.register(FileSink)


def read_pages(spark: SparkSession, folder: str, columns: str | None = None, **options: str | int) -> DataFrame:
    """Pages of the image files below ``folder``. ``columns``, as "doc_id string, page_number int", are
    those that are made; without ``data`` no pixels are read. Filters are pushed where the session allows it."""
    register(spark)
    reader = spark.read.format("pages").option("push", str(spark.conf.get(PUSHDOWN, "false")).lower())
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return (reader.schema(columns) if columns else reader).load(folder)


def write_files(rows: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Writes the rows' files and gives file_name, bytes and error of all that jobs have written there."""
    spark = rows.sparkSession
    register(spark)
    rows.write.format("page_files").mode(mode).save(folder)
    return written(spark, folder)


def written(spark: SparkSession, folder: str) -> DataFrame:
    """file_name, bytes and error of all that jobs of the sink have written to ``folder``."""
    return spark.read.option("pathGlobFilter", "*.json").schema("file_name string, bytes long, error string").json(f"{folder}/_written")
