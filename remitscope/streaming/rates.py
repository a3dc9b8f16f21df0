"""Event rates on a stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_rate(
    rows: DataFrame, seconds: int = 60, ts: str = "ts", lateness: str = "10 minutes"
) -> DataFrame:
    """Rate per tumbling window, given out once the watermark has passed its end."""
    window = F.window(ts, f"{seconds} seconds")
    return (
        rows.withWatermark(ts, lateness)
        .groupBy(window)
        .agg(F.count("*").alias("n"))
        .select(
            F.col("window.start").alias("window_start"),
            "n",
            (F.col("n") / F.lit(float(seconds))).alias("per_second"),
        )
    )
