"""WARC files as a DataFrame of records.

Spark lists the files (any Hadoop path glob), puts small ones together, starts with
the large ones and prefers the hosts that hold their blocks.  Each task then streams
its files: records are framed by their declared length and leave as Arrow batches of
bounded size, so memory does not depend on the size of a file.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from gzip import BadGzipFile, GzipFile
from io import BufferedReader, RawIOBase
from itertools import count
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

RECORD_SCHEMA = (
    "warc_file STRING, record_no BIGINT, record_type STRING, warc_date STRING, "
    "record_id STRING, content_type STRING, content_length BIGINT, "
    "metadata MAP<STRING,STRING>, content BINARY, content_error STRING, read_error STRING"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("warc_file", pa.string()),
        ("record_no", pa.int64()),
        ("record_type", pa.string()),
        ("warc_date", pa.string()),
        ("record_id", pa.string()),
        ("content_type", pa.string()),
        ("content_length", pa.int64()),
        ("metadata", pa.map_(pa.string(), pa.string())),
        ("content", pa.binary()),
        ("content_error", pa.string()),
        ("read_error", pa.string()),
    ]
)

# The line that opens a record, and the headers that have a column.
_MARK = re.compile(rb"WARC/[0-9]+\.[0-9]")
_COLUMN_OF_HEADER = {
    "WARC-Type": "record_type",
    "WARC-Date": "warc_date",
    "WARC-Record-ID": "record_id",
    "Content-Type": "content_type",
}
_LENGTH_HEADER = "Content-Length"
_LENGTH_PREFIX = _LENGTH_HEADER.lower()

_BLANKS = "".join(map(chr, range(0x21)))
_BLANK_BYTES = bytes(range(0x21))
_CHUNK = 1 << 20
#: A batch is held several times over (rows, Arrow columns, what is sent), in every worker.
_BATCH_BYTES = 2 << 20
_BATCH_RECORDS = 1_000
#: Arrow and Spark hold no more than 2 GiB in one value.
_MAX_ROW_BYTES = (1 << 31) - (1 << 20)
_MAX_LENGTH = (1 << 63) - 1


# Tasks get this module with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _FramingError(Exception):
    """The rest of the file cannot be divided into records."""


def read_warc(
    spark: SparkSession,
    paths: str | list[str],
    content: bool = True,
    max_content_bytes: int | None = None,
) -> DataFrame:
    """Records of the ``.warc`` and ``.warc.gz`` files that match ``paths``.

    A file that is damaged gives the records before the damage and then one row with
    ``read_error`` set.  Failures of the file system are not damage: they fail the task,
    and Spark runs it again.

    ``content=False`` leaves ``content`` NULL and reads past the bytes, for jobs that
    only need headers; ``max_content_bytes`` does so for larger records alone.
    ``content_length`` is set either way.  A record of 2 GiB or more, which no row can
    hold, is read past as well, and ``content_error`` says why its content is missing.
    """
    limit = _MAX_ROW_BYTES if max_content_bytes is None else min(max_content_bytes, _MAX_ROW_BYTES)
    limit = limit if content else -1
    files = spark.read.format("binaryFile").load(paths).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _read_files((path for batch in batches for path in batch.column("path").to_pylist()), limit)

    return files.mapInArrow(read, RECORD_SCHEMA)


def _read_file(path: str, limit: int) -> Iterator[pa.RecordBatch]:
    return _read_files([path], limit)


def _read_files(paths: Iterable[str], limit: int) -> Iterator[pa.RecordBatch]:
    """Small files share a batch, so that many of them do not cost a batch each."""
    rows: list[dict] = []
    size = 0
    for path in paths:
        for row in _rows(path, limit):
            own = len(row.get("content") or b"") + row.pop("header_bytes", 0)
            if rows and (size + own > _BATCH_BYTES or len(rows) == _BATCH_RECORDS):
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_SCHEMA)
                rows, size = [], 0
            rows.append(row)
            size += own
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_SCHEMA)


def _rows(path: str, limit: int) -> Iterator[dict]:
    """The records of one file; damage gives a last row with ``read_error``."""
    with _open(path) as stream:
        records = _records(stream, limit)
        for number in count(1):
            try:
                row = next(records, None)
            except (BadGzipFile, zlib.error, EOFError, _FramingError) as error:
                row = {"read_error": f"{type(error).__name__.lstrip('_')}: {error}"}
            if row is None:
                return
            row.update(warc_file=path, record_no=number)
            yield row
            if "read_error" in row:
                return


class _Unpacked(RawIOBase):
    """Hands over what is unpacked so far before it goes on, so damage ahead loses nothing."""

    def __init__(self, packed: GzipFile) -> None:
        self._packed = packed

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self._packed.read1(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _located(path: str):
    """The pyarrow file system of a path with a scheme, and the path's name there."""
    # Imported here: only tasks open files.
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    # Spark gives paths as they are; in a URI some characters need escaping.
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def _open(path: str, unpack: bool = True) -> BufferedReader:
    filesystem, name = _located(path)
    raw = filesystem.open_input_stream(name, compression=None, buffer_size=_CHUNK)
    unpacked = _Unpacked(GzipFile(fileobj=raw)) if unpack and name.endswith(".gz") else raw
    return BufferedReader(unpacked, _CHUNK)


def create_file(path: str, data: bytes) -> None:
    """Write a whole file from a task; it has its name only once it is complete."""
    filesystem, name = _located(path)
    folder, _, last = name.rpartition("/")
    partial = f"{folder}/.{last}.{uuid4().hex}"
    with filesystem.open_output_stream(partial, compression=None) as out:
        out.write(data)
    filesystem.move(partial, name)


def _records(stream, limit: int) -> Iterator[dict]:
    if not stream.peek(1):
        return
    found = False
    while _find_mark(stream):
        found = True
        row, length = _header(stream)
        row["content_length"] = length
        if length <= limit:
            row["content"] = stream.read(length)
            missing = length - len(row["content"])
        else:
            missing = length - _skip(stream, length)
            if length > _MAX_ROW_BYTES:
                row["content_error"] = f"{length} bytes do not fit into a row"
        if missing:
            raise _FramingError(f"{missing} bytes of content are missing")
        yield row
    if not found:
        raise _FramingError("no record in the file")


def _find_mark(stream) -> bool:
    """Read on to the line that opens the next record; False at the end of the file."""
    at_line_start = True
    while line := stream.readline(_CHUNK):
        if at_line_start and _MARK.match(line):
            while not line.endswith(b"\n"):
                line = stream.readline(_CHUNK)
                if not line:
                    raise _FramingError("the file ends inside a header")
            return True
        at_line_start = line.endswith(b"\n")
    return False


def _header(stream) -> tuple[dict, int]:
    row: dict = {}
    metadata: dict[str, str] = {}
    length = None
    row["header_bytes"] = 0
    for line in _header_lines(stream):
        row["header_bytes"] += len(line)
        name, colon, value = line.partition(":")
        if length is None and colon and name.lower().startswith(_LENGTH_PREFIX):
            length = value.strip(_BLANKS)
        name = name.strip(_BLANKS)
        if name in _COLUMN_OF_HEADER:
            if colon:
                row[_COLUMN_OF_HEADER[name]] = value.strip(_BLANKS)
        elif name != _LENGTH_HEADER:
            metadata[name] = value.strip(_BLANKS)
    row["metadata"] = list(metadata.items())
    digits = (length or "").removeprefix("+")
    if not (digits.isascii() and digits.isdigit()) or int(digits) > _MAX_LENGTH:
        raise _FramingError(f"no usable {_LENGTH_HEADER}: {length}")
    return row, int(digits)


def _header_lines(stream) -> Iterator[str]:
    """The lines up to the blank one, which is read as well."""
    while (line := stream.readline()).strip(_BLANK_BYTES):
        if not line.endswith(b"\n"):
            break
        yield line[:-1].decode("utf-8", "replace")
    if not line.endswith(b"\n"):
        raise _FramingError("the file ends inside a header")


def _skip(stream, length: int) -> int:
    left = length
    while left and (chunk := stream.read(min(left, _CHUNK))):
        left -= len(chunk)
    return length - left
