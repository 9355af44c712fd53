"""Topics with an offset log: publications in order, and a stream that reads them by offset.

A topic has a folder ``_log`` with one small JSON file for each publication, named by its offset
from 0 on without gaps. A publication exists from the moment its file does, which is after its
messages are written whole. So a reader finds what is new by asking for the files after its own
offset: the driver's work follows new publications, not the topic's age, and *now* is the offset
after the latest. Old publications go by moving ``_first`` on and deleting what lies before.

The stream is a Python data source: it plans on the driver and reads Parquet in the tasks, both
through ``pyarrow.fs``, which must reach the store (a file system that all machines share, HDFS,
an object store). Offsets are claimed by linking or moving a finished file to a name that must
not exist; that is atomic in shared file systems and HDFS, while object stores need a single
publisher. Topics in other stores go without a log and are listed.
"""

import json
import os
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pfs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from sluiceway.schemas import MESSAGE

# The source travels to planners and executors whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of Parquet that a task reads, of a part of a file or of several files.
SPLIT_BYTES = 128 << 20
FORMAT = "publications"

_INSTANT = pa.timestamp("us", "UTC")


class PublicationLog:
    """The log of a topic: entries by offset."""

    def __init__(self, topic: str):
        self.topic = topic.rstrip("/")
        self.files, self.base = pfs.FileSystem.from_uri(topic) if "://" in topic else _local(topic)
        self.folder = f"{self.base.rstrip('/')}/_log"

    def exists(self) -> bool:
        return self.files.get_file_info(self.folder).type == pfs.FileType.Directory

    def create(self) -> None:
        self.files.create_dir(self.folder, recursive=True)

    def _path(self, offset: int) -> str:
        # A folder for each thousand, so that none grows without bound.
        return f"{self.folder}/{offset // 1000:012d}/{offset % 1000:03d}.json"

    def has(self, offset: int) -> bool:
        return self.files.get_file_info(self._path(offset)).type == pfs.FileType.File

    def entry(self, offset: int) -> dict:
        return json.loads(self._read(self._path(offset)))

    def first(self) -> int:
        """The lowest offset that is kept."""
        return self._number("_first")

    def next(self, known: int | None = None) -> int:
        """The offset after the latest; ``known`` is one that is not after it.

        It is sought in growing steps and then by halves, so that the number of looks grows
        with the logarithm of what is new.
        """
        low = max(self._number("_hint") if known is None else known, self.first())
        step = 1
        while self.has(low + step - 1):
            low, step = low + step, step * 2
        while step > 1:  # low + step - 1 is free, all before low are taken
            step //= 2
            if self.has(low + step - 1):
                low += step
        return low

    def entered(self, folder: str) -> bool:
        """Whether a publication is in the log, by the mark that is set before its entry. Only
        where there is a mark, which is so after a failure, are entries looked at, latest first."""
        if self.files.get_file_info(self._mark(folder)).type == pfs.FileType.NotFound:
            return False
        return any(self.entry(i)["folder"] == folder for i in range(self.next() - 1, self.first() - 1, -1))

    def _mark(self, folder: str) -> str:
        return f"{self.base}/{folder}/_entering"

    def append(self, folder: str) -> int:
        """Enter a publication whose messages are in a folder of the topic; returns its offset."""
        chosen = pfs.FileSelector(f"{self.base}/{folder}", recursive=True, allow_not_found=True)
        parts = [i for i in self.files.get_file_info(chosen) if i.path.endswith(".parquet")]
        skip = len(self.base) + 1
        entry = {"folder": folder, "files": [[i.path[skip:], i.size] for i in sorted(parts, key=lambda i: i.path)]}
        if parts:
            self.files.open_output_stream(self._mark(folder)).close()
        made = f"{self.folder}/_new-{uuid.uuid4().hex}"
        with self.files.open_output_stream(made) as out:
            out.write(json.dumps(entry).encode())
        offset = self.next()
        while not self._claim(made, self._path(offset)):
            offset = self.next(offset)
        self._note("_hint", offset)
        return offset

    def _claim(self, made: str, path: str) -> bool:
        self.files.create_dir(path.rpartition("/")[0], recursive=True)
        if isinstance(self.files, pfs.LocalFileSystem):
            try:
                os.link(made, path)
            except FileExistsError:
                return False
            os.unlink(made)
            return True
        if self.files.get_file_info(path).type != pfs.FileType.NotFound:
            return False
        try:
            self.files.move(made, path)
        except OSError:
            if self.files.get_file_info(path).type == pfs.FileType.NotFound:
                raise
            return False
        return True

    def drop_before(self, offset: int) -> int:
        """Give up the publications before an offset and delete their messages; returns how many
        there were. A reader that is further behind fails rather than miss them."""
        first, last = self.first(), min(offset, self.next())
        if last <= first:
            return 0
        entries = [self.entry(i) for i in range(first, last)]
        self._note("_first", last)
        for i, entry in zip(range(first, last), entries):
            folder = f"{self.base}/{entry['folder']}"
            if self.files.get_file_info(folder).type == pfs.FileType.Directory:
                self.files.delete_dir(folder)
            self.files.delete_file(self._path(i))
        return last - first

    def _read(self, path: str) -> bytes:
        with self.files.open_input_stream(path) as content:
            return content.read()

    def _number(self, name: str) -> int:
        try:
            return int(self._read(f"{self.folder}/{name}") or 0)
        except FileNotFoundError:
            return 0

    def _note(self, name: str, number: int) -> None:
        """Keep a number, whole at any time; a lower hint than another writer's does no harm."""
        made = f"{self.folder}/_new-{uuid.uuid4().hex}"
        with self.files.open_output_stream(made) as out:
            out.write(str(number).encode())
        self.files.move(made, f"{self.folder}/{name}")


def _local(path: str) -> tuple[pfs.FileSystem, str]:
    return pfs.LocalFileSystem(), path.removeprefix("file:")


class Part(InputPartition):
    """Files of one task, each with the share of its row groups to read: ``nth`` of ``shares``."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


class Publications(DataSource):
    """Streaming source ``publications``: ``path`` is the topic, ``startingOffset`` where a new
    query begins (the first kept one by default). Only the columns of the given schema are read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return MESSAGE

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        start = self.options.get("startingoffset")
        return PublicationReader(self.options["path"], None if start is None else int(start), schema.names)


class PublicationReader(DataSourceStreamReader):
    def __init__(self, topic: str, start: int | None, columns: list[str]):
        self.topic, self.start, self.columns = topic, start, columns
        self.known = None

    def initialOffset(self) -> dict:
        return {"next": PublicationLog(self.topic).first() if self.start is None else self.start}

    def latestOffset(self) -> dict:
        self.known = PublicationLog(self.topic).next(self.known)
        return {"next": self.known}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        log = PublicationLog(self.topic)
        low, high = start["next"], end["next"]
        if low < min(log.first(), high):
            raise ValueError(f"publications from {low} on are gone: the topic begins at {log.first()}")
        parts, open_, load = [], [], 0
        for offset in range(low, high):
            for path, size in log.entry(offset)["files"]:
                shares = max(1, -(-size // SPLIT_BYTES))
                if shares > 1:
                    parts += [Part([(path, nth, shares)]) for nth in range(shares)]
                    continue
                if open_ and load + size > SPLIT_BYTES:
                    parts.append(Part(open_))
                    open_, load = [], 0
                open_.append((path, 0, 1))
                load += size
        return [*parts, Part(open_)] if open_ else parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        log = PublicationLog(self.topic)
        for path, nth, shares in partition.files:
            with log.files.open_input_file(f"{log.base}/{path}") as content:
                file = pq.ParquetFile(content, coerce_int96_timestamp_unit="us")
                groups = range(file.num_row_groups)
                own = [g for g in groups if g * shares // file.num_row_groups == nth]
                batches = file.iter_batches(10_000, row_groups=own, columns=self.columns) if own else ()
                for batch in batches:
                    columns = [batch.column(name) for name in self.columns]
                    # Instants are stored without their zone, which is UTC.
                    columns = [c.cast(_INSTANT) if pa.types.is_timestamp(c.type) else c for c in columns]
                    yield pa.RecordBatch.from_arrays(columns, self.columns)


def read_publications(spark: SparkSession, topic: str, start: int | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Stream of the messages of a topic with a log, from an offset on when the query is new.

    ``columns`` are those of the messages to read; all by default.
    """
    spark.dataSource.register(Publications)
    schema = MESSAGE if not columns else StructType([f for f in MESSAGE if f.name in columns])
    stream = spark.readStream.format(FORMAT).schema(schema).option("path", topic)
    return (stream if start is None else stream.option("startingOffset", start)).load()
