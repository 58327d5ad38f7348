"""Archives of any size as streams of records.

Spark reads an archive in splits, as the byte runs between newlines with the
place of each, so no row holds a whole archive and any store that Spark reads
will do.  The runs of one archive are sorted by place and pass through one task,
as a deflated member can only be read from its start; the task keeps a few
chunks and one record in memory.
"""

from __future__ import annotations

import io
import re
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20
RECORDS = "source_file string, position long, record string, error string"
#: What a broken archive or member raises.
BROKEN = (zipfile.BadZipFile, tarfile.TarError, zlib.error, struct.error, EOFError)


def archive_runs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, size, place, run): the bytes between the newlines of each file, sorted in one task for each file."""
    runs = spark.read.option("lineSep", "\n").text(paths)
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = runs.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), within.alias("within")).alias("place"),
        F.col("value").cast("binary").alias("run"),
    )
    return rows.repartition("path").sortWithinPartitions("path", "place").select("path", "size", "run")


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """Each file's path and its bytes in chunks; a file's chunks have to be used up before the next file."""
    rows = ((p, n, r) for b in batches for p, n, r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    ahead = next(rows, None)

    def chunks() -> Iterator[bytes]:
        nonlocal ahead
        path, size, held, length, given = ahead[0], ahead[1], [], 0, 0
        while ahead is not None and ahead[0] == path:
            run = ahead[2] + b"\n" if given + length + len(ahead[2]) < size else ahead[2]  # the last run may have no newline
            held.append(run)
            length += len(run)
            if length >= CHUNK:
                given += length
                yield b"".join(held)
                held, length = [], 0
            ahead = next(rows, None)
        if held:
            yield b"".join(held)

    while ahead is not None:
        path, own = ahead[0], chunks()
        yield path, own
        for _ in own:
            pass


class Stream(io.RawIOBase):
    """Chunks as a file that is read once, from its start."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.rest = chunks, b""

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        held, length = [self.rest], len(self.rest)
        while size < 0 or length < size:
            more = next(self.chunks, None)
            if more is None:
                break
            held.append(more)
            length += len(more)
        data = b"".join(held)
        size = len(data) if size < 0 else size
        self.rest = data[size:]
        return data[:size]

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def first_member(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The first member of a zip archive, unpacked chunk by chunk; nothing for an archive without members."""
    stream = Stream(chunks)
    head = stream.read(30)
    if head[:4] != b"PK\x03\x04":
        if head[:4] in (b"PK\x05\x06", b"PK\x06\x06", b""):
            return
        raise zipfile.BadZipFile("no zip archive")
    flags, method = struct.unpack("<HH", head[6:10])
    packed, (name, extra) = struct.unpack("<I", head[18:22])[0], struct.unpack("<HH", head[26:30])
    fields = stream.read(name + extra)[name:]
    if packed == 0xFFFFFFFF:  # the size stands in a field of its own
        at = 0
        while at + 4 <= len(fields):
            kind, n = struct.unpack("<HH", fields[at : at + 4])
            if kind == 1:
                packed = struct.unpack("<Q", fields[at + 12 : at + 20])[0]
            at += 4 + n
    if flags & 1:
        raise zipfile.BadZipFile("the member is encrypted")
    if method == 0 and not flags & 8:
        while packed:
            part = stream.read(min(packed, CHUNK))
            if not part:
                raise zipfile.BadZipFile("the archive ends in a member")
            packed -= len(part)
            yield part
    elif method == 8:
        unpack = zlib.decompressobj(-15)
        while not unpack.eof:
            part = unpack.unconsumed_tail or stream.read(CHUNK)
            if not part:
                raise zipfile.BadZipFile("the archive ends in a member")
            yield unpack.decompress(part, 4 * CHUNK)
    else:
        raise zipfile.BadZipFile(f"method {method} of a member")


def records(chunks: Iterator[bytes], names: tuple[str, ...]) -> Iterator[bytes]:
    """The elements of these names, each whole, from a document in chunks that may have several roots.

    Bytes are looked at once: the search goes on where the last chunk ended.
    """
    some = b"|".join(re.escape(n.encode()) for n in names)
    begin, ends = re.compile(rb"<(" + some + rb")(?=[\s>/])"), {n.encode(): b"</" + n.encode() + b">" for n in names}
    rest, seen, name = bytearray(), 0, None
    for chunk in chunks:
        rest += chunk
        at = 0
        while True:
            if name is None:
                found = begin.search(rest, max(at, seen))
                if not found:
                    at = max(at, len(rest) - max(map(len, ends.values())))
                    seen = at
                    break
                name, at, seen = found[1], found.start(), found.end()
            stop = rest.find(ends[name], seen)
            if stop < 0:
                seen = max(seen, len(rest) - len(ends[name]))
                break
            stop += len(ends[name])
            yield bytes(rest[at:stop])
            name, at, seen = None, stop, stop
        del rest[:at]
        seen -= at


def _batched(rows: Iterator[tuple], columns: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in columns.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "position" else pa.list_(pa.string()) if n == "images" else pa.string()) for n in names])
    held, size = [], 0
    for row in rows:
        held.append(dict(zip(names, row, strict=True)))
        size += len(held[-1]["record"] or "") + 64
        if size > most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _zipped(names: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for path, chunks in _files(batches):
            own, k = path.rsplit("/", 1)[-1], 0
            try:
                for record in records(first_member(chunks), names):
                    yield own, k, record.decode("utf-8", "replace"), None
                    k += 1
            except BROKEN as e:
                yield own, k, None, f"{type(e).__name__}: {e}"

    return _batched(rows(), RECORDS)


def zipped_records(spark: SparkSession, paths: str | list[str], names: tuple[str, ...]) -> DataFrame:
    """(source_file, position, record, error) of the elements of these names in the first member of each zip archive.

    A broken archive gives a last row with ``error`` and no record.
    """
    return archive_runs(spark, paths).mapInArrow(partial(_zipped, names), RECORDS)


PACKED = "source_tar string, source_zip string, position long, record string, images array<string>, error string"


def _members(tar: tarfile.TarFile, names: tuple[str, ...], skip: str) -> Iterator[tuple[str, bytes | None, list[str], str | None]]:
    """(zip, record, images, error) of the zip members of an archive; a broken one gives a row without a record."""
    for member in tar:
        if not member.isfile() or not member.name.lower().endswith(".zip") or skip and re.search(skip, member.name):
            continue
        own = member.name.rsplit("/", 1)[-1]
        data = tar.extractfile(member).read()
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as inner:
                files = sorted(inner.namelist())
                images = sorted(f.rsplit("/", 1)[-1] for f in files if re.search(r"(?i)\.tiff?$", f))
                for f in files:
                    if f.lower().endswith(".xml"):
                        with inner.open(f) as xml:
                            for record in records(iter(partial(xml.read, CHUNK), b""), names):
                                yield own, record, images, None
        except BROKEN as e:
            yield own, None, [], f"{type(e).__name__}: {e}"


def _tarred(names: tuple[str, ...], skip: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for path, chunks in _files(batches):
            own, place = path.rsplit("/", 1)[-1], 0
            try:
                with tarfile.open(fileobj=Stream(chunks), mode="r|") as tar:
                    for inner, record, images, error in _members(tar, names, skip):
                        yield own, inner, place, record and record.decode("utf-8", "replace"), images, error
                        place += 1
            except BROKEN as e:
                yield own, None, place, None, [], f"{type(e).__name__}: {e}"

    return _batched(rows(), PACKED)


def tarred_records(spark: SparkSession, paths: str | list[str], names: tuple[str, ...], skip: str = "") -> DataFrame:
    """Records as in ``zipped_records``, of all XML files of the zip members of tar archives, with the images' names.

    ``skip`` is a pattern of members to leave out.  A member, not an archive, has to fit into memory.
    """
    return archive_runs(spark, paths).mapInArrow(partial(_tarred, names, skip), PACKED)
