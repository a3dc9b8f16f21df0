"""Where raw records come from, as a port, and a Python data source that streams from it.

A source has partitions whose records are numbered by offsets. A stream plans each micro-batch as
ranges of offsets, which its checkpoint keeps: a restart goes on where the last batch ended, and a
batch that was cut off reads the very same ranges again.
"""

from __future__ import annotations

import os
from abc import ABC, abstractmethod
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

Offsets = dict[str, int]


class EventSource(ABC):
    """A source of records in numbered partitions. It travels to the tasks by pickle."""

    @abstractmethod
    def schema(self) -> T.StructType: ...

    def begin(self) -> Offsets:
        """The first offset of each partition; 0 where it says nothing."""
        return {}

    @abstractmethod
    def end(self) -> Offsets:
        """For each partition, the offset behind its last record so far."""

    @abstractmethod
    def fetch(self, partition: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        """The records with offsets from ``start`` to before ``end``, always the same ones."""

    def processed(self, end: Offsets) -> None:
        """Told, on the driver, that everything before these offsets has been processed."""


class OffsetRange(InputPartition):
    """Some records of a partition: the work of one task."""

    def __init__(self, partition: str, start: int, end: int):
        super().__init__((partition, start, end))
        self.partition, self.start, self.end = partition, start, end


def bounded(start: Offsets, end: Offsets, most: int | None) -> Offsets:
    """Offsets that lie at most ``most`` records behind ``start``, shared out by what is waiting."""
    waiting = {p: max(0, end[p] - start.get(p, 0)) for p in end}
    total = sum(waiting.values())
    if most is None or total <= most:
        return {p: start.get(p, 0) + n for p, n in waiting.items()}
    shares = {p: n * most // total for p, n in waiting.items()}
    left = most - sum(shares.values())
    for p in sorted(waiting):  # what rounding left over
        more = min(left, waiting[p] - shares[p], 1)
        shares[p], left = shares[p] + more, left - more
    return {p: start.get(p, 0) + shares[p] for p in waiting}


def ranges(start: Offsets, end: Offsets, rows_per_task: int) -> list[OffsetRange]:
    out = []
    for p in sorted(end):
        first, last = start.get(p, 0), end[p]
        if last < first:
            raise ValueError(f"partition {p} goes back from {first} to {last}")
        tasks = -(-(last - first) // rows_per_task)
        cuts = [first + (last - first) * i // tasks for i in range(tasks + 1)] if tasks else []
        out += [OffsetRange(p, a, b) for a, b in zip(cuts, cuts[1:])]
    return out


class _StreamReader(DataSourceStreamReader):
    """Plans micro-batches of ``max_rows`` records at most, each in tasks of ``rows_per_task``."""

    def __init__(self, source: EventSource, max_rows: int | None, rows_per_task: int):
        self.source, self.max_rows, self.rows_per_task = source, max_rows, rows_per_task
        self.seen: Offsets | None = None

    def initialOffset(self) -> Offsets:
        begin = self.source.begin()
        return {p: begin.get(p, 0) for p in self.source.end()}

    def latestOffset(self) -> Offsets:
        """Bounded from where the last batch ended. Spark tells that by planning it (a restarted
        query plans an empty one first); a new query plans an empty batch from the beginning."""
        if self.max_rows is None:
            return self.source.end()
        if self.seen is None:
            return self.initialOffset()
        begin = self.source.begin()
        return bounded(begin | self.seen, self.source.end(), self.max_rows)

    def partitions(self, start: Offsets, end: Offsets) -> list[OffsetRange]:
        self.seen = end
        return ranges(self.source.begin() | start, end, self.rows_per_task)

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        return self.source.fetch(partition.partition, partition.start, partition.end)

    def commit(self, end: Offsets) -> None:
        self.source.processed(end)


class _BatchReader(DataSourceReader):
    def __init__(self, source: EventSource, rows_per_task: int):
        self.source, self.rows_per_task = source, rows_per_task

    def partitions(self) -> list[OffsetRange]:
        return ranges(self.source.begin(), self.source.end(), self.rows_per_task) or [OffsetRange("", 0, 0)]

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        if partition.end > partition.start:
            yield from self.source.fetch(partition.partition, partition.start, partition.end)


def register_source(spark: SparkSession, name: str, source: EventSource) -> None:
    """Makes ``read.format(name)`` and ``readStream.format(name)`` read from the source.

    Options: ``maxRows``, the most records of a micro-batch (all there are, if not given), and
    ``rowsPerTask``. With ``maxRows`` a stream needs a trigger that goes on, since Spark asks a
    Python source only once what there is when it runs over all that is available.
    """

    class PortDataSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return source.schema()

        def _rows_per_task(self) -> int:
            return int(self.options.get("rowsPerTask", 1_000_000))

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return _BatchReader(source, self._rows_per_task())

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            most = self.options.get("maxRows")
            return _StreamReader(source, int(most) if most else None, self._rows_per_task())

    spark.dataSource.register(PortDataSource)


def stream_from(
    spark: SparkSession, name: str, max_rows: int | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """The records of a registered source as an unbounded stream."""
    reader = spark.readStream.format(name)
    if max_rows is not None:
        reader = reader.option("maxRows", max_rows)
    if rows_per_task is not None:
        reader = reader.option("rowsPerTask", rows_per_task)
    return reader.load()


class LogSource(EventSource):
    """A log of records in files: a folder per partition, its Parquet files one after the other.

    Records are numbered in order of the files' names. Files may be added behind the last one; how
    many records a file has comes from its footer.
    """

    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.fields = folder, schema
        self.sizes: dict[str, int] = {}  # records of each file; tasks get what planning has read

    def schema(self) -> T.StructType:
        return self.fields

    def _files(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.folder if "://" in self.folder else os.path.abspath(self.folder))

    def _log(self, partition: str) -> tuple[pafs.FileSystem, list[str], list[int]]:
        """The files of a partition and the offset at which each begins, with that of the end."""
        files, root = self._files()
        found = files.get_file_info(pafs.FileSelector(f"{root}/{partition}"))
        paths = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
        starts = [0]
        for path in paths:
            if path not in self.sizes:
                with files.open_input_file(path) as file:
                    self.sizes[path] = pq.read_metadata(file).num_rows
            starts.append(starts[-1] + self.sizes[path])
        return files, paths, starts

    def end(self) -> Offsets:
        files, root = self._files()
        found = files.get_file_info(pafs.FileSelector(root))
        names = [f.base_name for f in found if f.type == pafs.FileType.Directory]
        return {name: self._log(name)[2][-1] for name in names}

    def fetch(self, partition: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        files, paths, starts = self._log(partition)
        at = max(0, bisect_right(starts, start) - 1)
        names, kinds = self.fields.fieldNames(), to_arrow_schema(self.fields)
        while start < end and at < len(paths):
            with files.open_input_file(paths[at]) as file:
                place = starts[at]
                for batch in pq.ParquetFile(file).iter_batches(batch_size=10_000, columns=names):
                    lo, hi = max(start - place, 0), min(end - place, batch.num_rows)
                    place += batch.num_rows
                    if hi > lo:
                        yield batch.slice(lo, hi - lo).select(names).cast(kinds)
            start, at = starts[at + 1], at + 1
