"""Where events go, as a task sees it, and a Python data source that streams into such a sink."""

from __future__ import annotations

import json
import os
import time
import uuid
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from datetime import date, datetime
from typing import Any

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

from remitscope.config import RetryPolicy


class SinkDown(RuntimeError):
    """The sink takes no events at all; the batch is not finished and has to be replayed."""


class EventSink(ABC):
    """A sink of single events. It travels to the tasks by pickle, and each task opens its own.

    ``concurrency`` calls of :meth:`publish` run at a time; above 1 they come from several threads.
    A sink that shows nothing before the whole batch is there returns from :meth:`flush` what
    :meth:`commit` needs, and must bear a second commit of the same batch; others need none of these.
    """

    concurrency = 1

    def payload(self) -> list[Column]:
        """What is handed over of an event, as columns over events; all of it where there are none."""
        return []

    def open(self) -> None:
        """Called once in a task, before its first event."""

    @abstractmethod
    def publish(self, event: dict[str, Any], timeout: float) -> None:
        """Returns once the event is taken; raises if it is not, TimeoutError if that took too long."""

    def check(self) -> None:
        """Raises if the sink as a whole is down. A sink that cannot tell leaves it as it is."""
        raise NotImplementedError

    def flush(self) -> Any:
        """Called once all events of a task are through; the result goes to :meth:`commit`."""

    def close(self) -> None:
        """Called at the end of a task, failed or not."""

    def commit(self, batch: str, messages: list) -> None:
        """Called on the driver with what all tasks returned."""

    def abort(self, batch: str, messages: list) -> None:
        """Called on the driver with what those tasks returned that did not fail."""


def attempt(sink: EventSink, event: dict[str, Any], budget: float) -> tuple[Exception | None, float]:
    """One attempt: its failure, if any, and how long it took. One past the budget has failed."""
    clock = time.monotonic()
    failure = None
    try:
        sink.publish(event, budget)
    except Exception as error:  # whatever a sink raises, the event was not taken
        failure = error
    seconds = time.monotonic() - clock
    if failure is None and seconds > budget:
        failure = TimeoutError(f"took {seconds:.3f} s")
    return failure, seconds


class _Message(WriterCommitMessage):
    def __init__(self, value: Any):
        self.value = value


class SinkWriter(DataSourceStreamWriter):
    """Publishes a micro-batch event by event, with retries; an event that stays out fails its task."""

    def __init__(self, sink: EventSink, name: str, retry: RetryPolicy, budget: float):
        self.sink, self.name, self.retry, self.budget = sink, name, retry, budget

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        self.sink.open()
        try:
            for row in iterator:
                self._publish(row.asDict(recursive=True))
            return _Message(self.sink.flush())
        finally:
            self.sink.close()

    def _publish(self, event: dict[str, Any]) -> None:
        for number in range(1, self.retry.max_attempts + 1):
            failure, _ = attempt(self.sink, event, self.budget)
            if failure is None:
                return
            if number < self.retry.max_attempts:
                time.sleep(self.retry.backoff(number))
        raise SinkDown(f"not published: {failure}") from failure

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.sink.commit(f"{self.name}-{batchId}", [m.value for m in messages if m is not None])

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.sink.abort(f"{self.name}-{batchId}", [m.value for m in messages if m is not None])


def register_sink(
    spark: SparkSession,
    name: str,
    sink: EventSink,
    retry: RetryPolicy = RetryPolicy(),
    budget_ms: int = 5_000,
) -> None:
    """Makes ``writeStream.format(name)`` stream into the sink.

    The option ``run`` tells apart the batches of several queries that share a sink.
    """

    class PortDataSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema: T.StructType, overwrite: bool) -> SinkWriter:
            return SinkWriter(sink, self.options.get("run", name), retry, budget_ms / 1000)

    spark.dataSource.register(PortDataSource)


def _plain(value: Any) -> Any:
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value.hex() if isinstance(value, (bytes, bytearray)) else str(value)


class FolderSink(EventSink):
    """Events as lines of JSON in a folder that all tasks reach; a batch appears as a whole.

    A task writes a file under ``pending``. The commit of a batch is one manifest that names its
    files, put in place by one rename, and readers follow manifests only: what an aborted batch, a
    failed task or a second attempt wrote is never seen, and a batch committed twice counts once.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def _files(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.folder if "://" in self.folder else os.path.abspath(self.folder))

    def open(self) -> None:
        self.path, self.stream, self.n = "", None, 0

    def publish(self, event: dict[str, Any], timeout: float = 0) -> None:
        line = json.dumps(event, default=_plain, ensure_ascii=False).encode() + b"\n"
        if self.stream is None:
            files, root = self._files()
            self.path = f"pending/{uuid.uuid4()}.json"
            files.create_dir(f"{root}/pending", recursive=True)
            self.stream = files.open_output_stream(f"{root}/{self.path}")
        self.stream.write(line)
        self.n += 1

    def check(self) -> None:
        files, root = self._files()
        files.create_dir(f"{root}/pending", recursive=True)

    def flush(self) -> dict | None:
        if self.stream is None:
            return None
        self.stream.close()
        self.stream = None
        return {"path": self.path, "events": self.n}

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()

    def commit(self, batch: str, messages: list) -> None:
        files, root = self._files()
        target = f"{root}/committed/{batch}.json"
        if files.get_file_info(target).type == pafs.FileType.File:
            return
        files.create_dir(f"{root}/committed", recursive=True)
        named = f"{root}/committed/.{uuid.uuid4()}"
        with files.open_output_stream(named) as out:
            out.write(json.dumps([m for m in messages if m]).encode())
        files.move(named, target)

    def abort(self, batch: str, messages: list) -> None:
        files, root = self._files()
        for message in filter(None, messages):
            if files.get_file_info(f"{root}/{message['path']}").type == pafs.FileType.File:
                files.delete_file(f"{root}/{message['path']}")

    def committed(self) -> list[str]:
        """The paths of all files of committed batches."""
        files, root = self._files()
        if files.get_file_info(f"{root}/committed").type != pafs.FileType.Directory:
            return []
        found = []
        for info in files.get_file_info(pafs.FileSelector(f"{root}/committed")):
            if not info.base_name.startswith("."):
                with files.open_input_stream(info.path) as manifest:
                    found += [f"{self.folder}/{m['path']}" for m in json.loads(manifest.read())]
        return sorted(found)


class RecordingSink(FolderSink):
    """A folder sink whose first attempts fail, for trying out what a failing sink does.

    ``fails`` says whether an attempt at an event fails, given the event and how many attempts at
    any event its task has made before.
    """

    def __init__(self, folder: str, fails: Callable[[dict, int], bool] = lambda event, before: False):
        super().__init__(folder)
        self.fails = fails

    def open(self) -> None:
        super().open()
        self.attempts = 0

    def publish(self, event: dict[str, Any], timeout: float = 0) -> None:
        self.attempts += 1
        if self.fails(event, self.attempts - 1):
            raise OSError("sink refused the event")
        super().publish(event, timeout)

    def check(self) -> None:
        raise NotImplementedError


def read_committed(spark: SparkSession, sink: FolderSink, schema: T.StructType | str) -> DataFrame:
    """The events of all committed batches of a folder sink."""
    paths = sink.committed()
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(paths)
