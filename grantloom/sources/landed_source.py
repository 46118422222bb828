"""A streaming source of landed files whose offsets are (time, path, length).

Spark's own file stream remembers paths alone, so a file that lands again under its name is never
seen again. Here the offset is the last file taken, in the order of time, path and length; a file
that lands again has a later time and so comes after it. The offset stays one small record however
many files have landed, and a repeated batch plans the same range again.

A file is taken once it has rested for ``rest`` seconds, so that one still being written, or one
with the time of a file already taken, is not passed over. A file moved in with an older time than
the offset's is not seen; :func:`..streaming.landing.take_landed`, which compares with the list of
all files taken, is for folders where that happens. A file that is replaced or removed between
planning and reading gives no row; replaced, it comes with its new time.
"""

from __future__ import annotations

import fnmatch
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "landed_files"
# the columns every binary file source has
FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: Bytes of files that one task reads, at least one file.
TASK_BYTES = 128 << 20
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("modificationTime", pa.timestamp("us", tz="UTC")),
        ("length", pa.int64()),
        ("content", pa.binary()),
    ]
)


@dataclass(frozen=True, order=True)
class Landed:
    """A file by its time in microseconds, its path and its length."""

    time: int = 0
    path: str = ""
    length: int = 0

    def offset(self) -> dict:
        return {"time": self.time, "path": self.path, "length": self.length}


@dataclass
class Share(InputPartition):
    """The files of one task."""

    files: tuple[Landed, ...]


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of ``uri``; one without a scheme is local, and ``file:/x`` is ``file:///x``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _landed(info: fs.FileInfo, base: str) -> Landed:
    # an unknown time would place a file before all others, where it is never seen
    if info.mtime_ns is None:
        raise ValueError(f"the file system tells no time of {info.path}")
    return Landed(info.mtime_ns // 1000, f"{base}/{info.base_name}", info.size)


def listed(folder: str, glob: str) -> list[Landed]:
    """The files of ``folder`` that fit ``glob``, oldest first."""
    system, path = opened(folder)
    found = system.get_file_info(fs.FileSelector(path))
    base = folder.rstrip("/")
    return sorted(
        _landed(x, base) for x in found if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, glob)
    )


def shares(files: list[Landed], most: int = TASK_BYTES) -> list[Share]:
    """Neighbouring files up to ``most`` bytes a task; a larger file has a task of its own."""
    out: list[list[Landed]] = []
    held = most + 1
    for file in files:
        held += file.length
        if held > most:
            out.append([])
            held = file.length
        out[-1].append(file)
    return [Share(tuple(x)) for x in out]


class LandedReader(DataSourceStreamReader):
    """Plans each batch from a listing of names; the contents are read by the tasks."""

    def __init__(self, folder: str, glob: str, rest: float):
        self.folder, self.glob, self.rest = folder, glob, rest
        self.last = Landed()

    def initialOffset(self) -> dict:
        return Landed().offset()

    def latestOffset(self) -> dict:
        until = int((time.time() - self.rest) * 1_000_000)
        rested = [x for x in listed(self.folder, self.glob) if x.time <= until]
        # files may be deleted after they were taken: the offset never goes back
        self.last = max([self.last, *rested[-1:]])
        return self.last.offset()

    def partitions(self, start: dict, end: dict) -> list[Share]:
        after, upto = Landed(**start), Landed(**end)
        self.last = max(self.last, upto)
        return shares([x for x in listed(self.folder, self.glob) if after < x <= upto])

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        base = self.folder.rstrip("/")
        system, folder = opened(base)
        for file in partition.files:
            path = f"{folder}/{file.path.rsplit('/', 1)[1]}"
            try:
                with system.open_input_stream(path) as stream:
                    content = stream.read()
            except FileNotFoundError:
                continue
            now = system.get_file_info(path)
            # looked at after reading, so that what was read is what was planned
            if now.type != fs.FileType.File or _landed(now, base) != file:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([file.path], pa.string()),
                    pa.array([file.time], pa.int64()).cast(_ARROW.field(1).type),
                    pa.array([file.length], pa.int64()),
                    pa.array([content], pa.binary()),
                ],
                schema=_ARROW,
            )


class LandedFiles(DataSource):
    """Options: ``path``, ``glob`` (default all), ``rest`` in seconds (default 10)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return FILES

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(self.options["path"], self.options.get("glob", "*"), float(self.options.get("rest", "10")))


def register(spark: SparkSession) -> None:
    """Makes ``spark.readStream.format("landed_files")`` known to the session."""
    spark.dataSource.register(LandedFiles)
