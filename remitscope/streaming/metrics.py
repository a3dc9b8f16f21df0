"""Totals of what streaming queries observe, kept by a listener."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_COUNTS = "consumed bigint, rejected bigint"


class MetricsListener(StreamingQueryListener):
    """Appends what each micro-batch observed under ``name`` to a table, by query and batch.

    The numbers come along with Spark's own progress report, so no job counts anything; a batch
    reported twice is written to the same place. A batch whose report a crash cut off is not there:
    where the numbers must be exact after a crash, use the publisher's, which come with its ledger.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str = "decode"):
        self.spark, self.folder, self.name = spark, folder, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None or not progress.numInputRows:
            return
        place = f"query_id={progress.id}/batch_id={progress.batchId}"
        row = (seen["consumed"] or 0, seen["rejected"] or 0)
        frame = self.spark.createDataFrame([row], _COUNTS).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.folder}/{place}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Consumed and rejected records and the number of batches, per query."""
    try:
        rows = spark.read.parquet(folder)
    except AnalysisException:  # no batch was reported yet
        rows = spark.createDataFrame([], f"{_COUNTS}, query_id string, batch_id int")
    return rows.groupBy("query_id").agg(
        F.sum("consumed").alias("consumed"), F.sum("rejected").alias("rejected"), F.count("*").alias("batches")
    )
