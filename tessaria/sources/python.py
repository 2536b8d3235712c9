"""Data sources in Python: image files and nested annotations, read in parts by groups of files, with filters and columns pushed."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

#: A task reads files of about so many bytes; a batch that it gives has so many rows at most.
PART_BYTES, BATCH = 64 << 20, 10_000


@dataclass
class Part(ds.InputPartition):
    """Some files: path, size, time of change in microseconds."""

    files: list[tuple[str, int, int]]


def _files(folder: str, pattern: str) -> tuple[pafs.FileSystem, list[pafs.FileInfo]]:
    fs, base = pafs.FileSystem.from_uri(folder)
    found = fs.get_file_info(pafs.FileSelector(base, recursive=True))
    return fs, sorted((f for f in found if f.is_file and fnmatch.fnmatch(f.base_name, pattern) and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)


class FileReader(ds.DataSourceReader):
    """Reads files of a folder, only those whose ``name`` passes the filters that Spark pushes, and only the asked columns.

    ``name`` filters (=, IN, prefix) are answered from the listing, so files that fail them are never opened.
    """

    def __init__(self, schema: T.StructType, options: dict[str, str], pattern: str):
        self.columns = schema.names
        self.folder, self.pattern = options["path"], options.get("pattern", pattern)
        self.part_bytes = int(options.get("partbytes", PART_BYTES))
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, ds.EqualTo) and f.attribute == ("name",):
                self.tests.append(("in", [f.value]))
            elif isinstance(f, ds.In) and f.attribute == ("name",):
                self.tests.append(("in", list(f.value)))
            elif isinstance(f, ds.StringStartsWith) and f.attribute == ("name",):
                self.tests.append(("prefix", f.value))
            else:
                yield f

    def _wanted(self, name: str) -> bool:
        return all(name in v if how == "in" else name.startswith(v) for how, v in self.tests)

    def partitions(self) -> Sequence[Part]:
        _, found = _files(self.folder, self.pattern)
        parts, now, size = [], [], 0
        for f in (f for f in found if self._wanted(f.base_name)):
            now.append((f.path, f.size, int(f.mtime_ns // 1000)))
            size += f.size
            if size >= self.part_bytes:
                parts.append(Part(now))
                now, size = [], 0
        return [*parts, Part(now)] if now or not parts else parts

    def rows(self, fs: pafs.FileSystem, files: list[tuple[str, int, int]]) -> Iterator[tuple]:
        raise NotImplementedError

    def arrow(self) -> pa.Schema:
        raise NotImplementedError

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        schema, held = self.arrow(), []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], f.type) for k, f in enumerate(schema)], schema=schema)

        for row in self.rows(fs, partition.files):
            held.append(row)
            if len(held) == BATCH:
                yield batch()
                held = []
        if held:
            yield batch()


def bitmap_pixels(data: bytes) -> tuple[int, int, np.ndarray]:
    """Width, height and the bytes (blue, green, red) of an uncompressed image of 24 bits a pixel, rows from the top."""
    kind, _, _, _, at, _, width, height, _, bits, packed = struct.unpack_from("<2sIHHIIiiHHI", data)
    if kind != b"BM" or bits != 24 or packed:
        raise ValueError("no uncompressed bitmap of 24 bits")
    line = (3 * width + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, line * abs(height), at).reshape(abs(height), line)[:, : 3 * width]
    return width, abs(height), rows[::-1] if height > 0 else rows


IMAGE = "name string, bytes long, modified timestamp, width int, height int, channels int, size long, total long"
_ARROW = {"name": pa.string(), "bytes": pa.int64(), "modified": pa.timestamp("us", "UTC"), "width": pa.int32(), "height": pa.int32(), "channels": pa.int32(), "size": pa.int64(), "total": pa.int64()}


class ImageReader(FileReader):
    def arrow(self) -> pa.Schema:
        return pa.schema([(c, _ARROW[c]) for c in self.columns])

    def rows(self, fs, files):
        inside = {"width", "height", "channels", "size", "total"} & set(self.columns)
        for path, size, changed in files:
            row = {"name": path.rsplit("/", 1)[-1], "bytes": size, "modified": changed}
            if inside:
                try:
                    with fs.open_input_stream(path) as f:
                        width, height, pixels = bitmap_pixels(f.read())
                except (ValueError, struct.error):
                    continue  # a file that is no image gives no row
                row |= {"width": width, "height": height, "channels": 3, "size": pixels.size, "total": int(pixels.sum(dtype=np.int64)) if "total" in inside else None}
            yield tuple(row[c] for c in self.columns)


class Images(ds.DataSource):
    """Bitmaps of a folder by their size and the sum of their bytes; names and times alone come from the listing.

    Columns are those of the schema that is asked for: without any of the image's own no file is opened.
    """

    @classmethod
    def name(cls) -> str:
        return "tessaria_images"

    def schema(self) -> str:
        return IMAGE

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return ImageReader(schema, self.options, "*.bmp")


ANNOTATION = "name string, image_id long, width int, height int, annotation string"
_ANNOTATION_ARROW = {"name": pa.string(), "image_id": pa.int64(), "width": pa.int32(), "height": pa.int32(), "annotation": pa.string()}


class AnnotationReader(FileReader):
    def arrow(self) -> pa.Schema:
        return pa.schema([(c, _ANNOTATION_ARROW[c]) for c in self.columns])

    def rows(self, fs, files):
        for path, _, _ in files:
            name = path.rsplit("/", 1)[-1]
            with fs.open_input_stream(path) as f:
                for line in f.read().splitlines():  # a document a line
                    if not line.strip():
                        continue
                    document = json.loads(line)
                    image = document.get("image") or {}
                    row = {"name": name, "image_id": image.get("id"), "width": image.get("width"), "height": image.get("height")}
                    for a in document.get("annotations") or []:
                        row["annotation"] = json.dumps(a, ensure_ascii=False, separators=(",", ":")) if "annotation" in self.columns else None
                        yield tuple(row[c] for c in self.columns)


class Annotations(ds.DataSource):
    """Nested annotations, a document ``{"image": {...}, "annotations": [...]}`` a line, as a row for each annotation (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "tessaria_annotations"

    def schema(self) -> str:
        return ANNOTATION

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return AnnotationReader(schema, self.options, "*.json")


LISTING = "path string, name string, length long, modified timestamp, sha256 string"
_LISTING_ARROW = {"path": pa.string(), "name": pa.string(), "length": pa.int64(), "modified": pa.timestamp("us", "UTC"), "sha256": pa.string()}
#: Bytes of a file that are read at a time for its checksum.
CHUNK = 8 << 20


class ListingReader(FileReader):
    def arrow(self) -> pa.Schema:
        return pa.schema([(c, _LISTING_ARROW[c]) for c in self.columns])

    def rows(self, fs, files):
        for path, size, changed in files:
            row = {"path": path, "name": path.rsplit("/", 1)[-1], "length": size, "modified": changed}
            if "sha256" in self.columns:
                digest = hashlib.sha256()
                with fs.open_input_stream(path) as f:
                    while chunk := f.read(CHUNK):
                        digest.update(chunk)
                row["sha256"] = digest.hexdigest()
            yield tuple(row[c] for c in self.columns)


class Listing(ds.DataSource):
    """Files of a folder and all below it by name pattern. Contents are read, in pieces, only where ``sha256`` is asked for."""

    @classmethod
    def name(cls) -> str:
        return "tessaria_files"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return ListingReader(schema, self.options, "*")


def register(spark: SparkSession) -> None:
    """Make these sources known to a session, and let Spark push filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (Images, Annotations, Listing):
        spark.dataSource.register(source)
