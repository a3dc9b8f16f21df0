"""The read model as a small table that each micro-batch replaces."""

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope.operators.aggregates import roll_up
from remitscope.sinks.publish import query_id
from remitscope.storage import files_of

# A snapshot that is no longer the latest stays this long for those who still read it.
KEEP_SECONDS = 600


class SnapshotWriter:
    """``foreachBatch`` function over the partial aggregates of a query in complete mode.

    Each batch of each query writes a folder of its own; then a pointer, replaced by one rename,
    names it. Folders that were written more than ``keep_seconds`` ago go, except the latest.
    """

    def __init__(self, folder: str, keep_seconds: float = KEEP_SECONDS):
        self.folder, self.keep_seconds = folder, keep_seconds

    def __call__(self, partials: DataFrame, batch_id: int) -> None:
        spark = partials.sparkSession
        now = time.time_ns()
        name = f"{now:020d}-{query_id(spark)}-{batch_id}"
        roll_up(partials).coalesce(1).write.parquet(f"{self.folder}/snapshots/{name}")
        self._point_to(spark, name)
        self._forget(spark, before=f"{now - round(self.keep_seconds * 1e9):020d}", but=name)

    def _point_to(self, spark: SparkSession, name: str) -> None:
        hadoop, path, fs = files_of(spark, f"{self.folder}/.current-{uuid.uuid4()}")
        out = fs.create(path, True)
        out.write(name.encode())
        out.close()
        rename = getattr(hadoop, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        target = hadoop.Path(f"{self.folder}/current")
        hadoop.FileContext.getFileContext(path.toUri(), fs.getConf()).rename(path, target, options)

    def _forget(self, spark: SparkSession, before: str, but: str) -> None:
        _, path, fs = files_of(spark, f"{self.folder}/snapshots")
        for found in fs.listStatus(path):
            if (name := found.getPath().getName()) < before and name != but:
                fs.delete(found.getPath(), True)


def read_snapshot(spark: SparkSession, folder: str, tries: int = 3) -> DataFrame:
    """The latest complete snapshot, all rows from one batch.

    Raises if there is none. A reader that holds the result for longer than snapshots are kept
    gets an error too, never fewer rows.
    """
    for left in range(tries - 1, -1, -1):
        try:
            name = spark.read.text(f"{folder}/current").select(F.max("value")).first()[0]
            return spark.read.parquet(f"{folder}/snapshots/{name}")
        except AnalysisException:  # replaced or cleared between the two reads
            if not left:
                raise
            time.sleep(0.1)
