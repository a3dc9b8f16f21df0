"""Event rates, rate alerts and stalled intervals.

Rates are exact: events in the window divided by its length. (A monitoring system would
extrapolate between the samples that it took of a counter.) All of them first bring the rows down
to one count per time bin with map-side combining, so a minute that holds a third of all rows
costs one row per task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitscope.functions.times import epoch_micros, from_epoch_micros, int_div

_US = 1_000_000
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
DAY_SECONDS = 86_400

# Fixed values of the alerts: window, evaluation interval, threshold per second, hold time.
ALERT_WINDOW_SECONDS = 300
EVALUATION_SECONDS = 10
FAILURES_PER_SECOND = 1.0
FAILURES_HOLD_SECONDS = 300
STALL_HOLD_SECONDS = 600


def _floor_div(number: Column, size: int) -> Column:
    """Exact floor of number / size on bigints, also below 0."""
    divisor = F.lit(size).cast("bigint")
    return int_div(number - F.pmod(number, divisor), divisor)


def _bin(ts: Column, seconds: int) -> Column:
    return _floor_div(epoch_micros(ts), seconds * _US)


def binned_counts(rows: DataFrame, seconds: int, ts: str = "ts") -> DataFrame:
    return rows.groupBy(_bin(F.col(ts), seconds).alias("bin")).agg(F.count("*").alias("n"))


def event_rate(rows: DataFrame, seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Rate per tumbling window; windows without rows are absent."""
    return binned_counts(rows, seconds, ts).select(
        from_epoch_micros(F.col("bin") * seconds * _US).alias("window_start"),
        "n",
        (F.col("n") / F.lit(float(seconds))).alias("per_second"),
    )


def _ticks(seconds: int, step: int) -> int:
    if seconds % step:
        raise ValueError(f"window of {seconds} s is not a multiple of the step of {step} s")
    return seconds // step


def sliding_rate(
    rows: DataFrame,
    seconds: int = 60,
    step: int = EVALUATION_SECONDS,
    ts: str = "ts",
) -> DataFrame:
    """Rate of the window before each evaluation instant; windows without rows are absent.

    Bins of one step are counted first; only their few rows are copied into the windows around.
    """
    ticks = F.sequence(F.col("bin") + 1, F.col("bin") + F.lit(_ticks(seconds, step)))
    return (
        binned_counts(rows, step, ts)
        .select(F.explode(ticks).alias("tick"), "n")
        .groupBy("tick")
        .agg(F.sum("n").alias("n"))
        .select(
            from_epoch_micros((F.col("tick") * step - seconds) * _US).alias("window_start"),
            "n",
            (F.col("n") / F.lit(float(seconds))).alias("per_second"),
        )
    )


def sliding_levels(
    rows: DataFrame, seconds: int, step: int, block: int, ts: str = "ts"
) -> DataFrame:
    """Sliding counts as stretches (first, last, n): the windows that end at the ticks from first
    to last hold n rows each. A tick is a multiple of the step.

    A bin enters the window at one tick and leaves it at another, so two or three changes per bin
    stand for all the windows that hold it. The counts are running sums of the changes. They start
    anew in each block of ticks, where the bins still in the window enter once more; a block must
    not be shorter than the window.
    """
    enters = F.col("bin") + 1
    leaves = enters + F.lit(_ticks(seconds, step))
    next_block = _floor_div(leaves, block) * block

    def change(tick, n):
        return F.struct(tick.alias("tick"), n.alias("n"))

    changes = F.array(
        change(enters, F.col("n")),
        change(leaves, -F.col("n")),
        change(next_block, F.when(enters < next_block, F.col("n")).otherwise(0)),
    )
    in_block = Window.partitionBy("block").orderBy("first")
    block_end = (F.col("block") + 1) * block
    return (
        binned_counts(rows, step, ts)
        .select(F.inline(changes))
        .groupBy(F.col("tick").alias("first"))
        .agg(F.sum("n").alias("n"))
        .withColumn("block", _floor_div(F.col("first"), block))
        .withColumn("n", F.sum("n").over(in_block.rowsBetween(*_SO_FAR)))
        .withColumn("last", F.coalesce(F.lead("first").over(in_block), block_end) - 1)
        .select("first", "last", "n")
    )


def _join_touching(stretches: DataFrame, group: str) -> DataFrame:
    """Joins stretches (first, last, ticks) of a group that follow on from each other."""
    in_order = Window.partitionBy(group).orderBy("first")
    begins = F.coalesce(F.col("first") != F.lag(F.col("last") + 1).over(in_order), F.lit(True))
    return (
        stretches.withColumn("begins", begins)
        .withColumn("chain", F.count_if("begins").over(in_order.rowsBetween(*_SO_FAR)))
        .groupBy(group, "chain")
        .agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.sum("ticks").alias("ticks")
        )
        .select("first", "last", "ticks")
    )


def joined_runs(stretches: DataFrame, block: int) -> DataFrame:
    """Maximal runs (first, last, ticks) of disjoint stretches (first, last), none of which crosses
    from one block of ticks into another.

    Runs are found within the blocks, in parallel. Those that touch the edge of their block, two
    per block at most, are then joined up in one group; each other run only passes through that
    step as a group of its own.
    """
    first, last = F.col("first"), F.col("last")
    at_edge = (F.pmod(first, F.lit(block)) == 0) | (F.pmod(last + 1, F.lit(block)) == 0)
    within = _join_touching(
        stretches.select(
            "first",
            "last",
            (last - first + 1).alias("ticks"),
            _floor_div(first, block).alias("block"),
        ),
        "block",
    )
    return _join_touching(within.withColumn("apart", F.when(~at_edge, first)), "apart")


def rate_alerts(
    rows: DataFrame,
    threshold: float = FAILURES_PER_SECOND,
    hold_seconds: int = FAILURES_HOLD_SECONDS,
    seconds: int = ALERT_WINDOW_SECONDS,
    step: int = EVALUATION_SECONDS,
    ts: str = "ts",
) -> DataFrame:
    """Runs of evaluations whose rate exceeds the threshold for at least the hold time.

    ``start`` and ``end`` are the first and last evaluation instant of the run. The threshold must
    not be negative, since windows without rows are not evaluated.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    block = max(DAY_SECONDS, seconds) // step
    levels = sliding_levels(rows, seconds, step, block, ts)
    firing = levels.where(F.col("n") / F.lit(float(seconds)) > threshold)
    runs = joined_runs(firing, block)
    return runs.where((F.col("last") - F.col("first")) * step >= hold_seconds).select(
        from_epoch_micros(F.col("first") * step * _US).alias("start"),
        from_epoch_micros(F.col("last") * step * _US).alias("end"),
        F.col("ticks").alias("evaluations"),
    )


def stalled_intervals(
    rows: DataFrame,
    silence_seconds: int = ALERT_WINDOW_SECONDS + STALL_HOLD_SECONDS,
    ts: str = "ts",
    as_of: Column | None = None,
) -> DataFrame:
    """Gaps of at least ``silence_seconds`` between consecutive events.

    With ``as_of``, also the stall that is still going on then: from the last event to that
    moment, which stands as its end. An input without events counts as stalled, with no start
    and no length; an ``as_of`` before the last event adds nothing.

    Two events that far apart never share a bin of that length, so the first and last event of
    each bin are enough. Bins meet their successor within a day. The last bin of each day meets
    the first event of the next one; these, one row per day, are the only ones in a common group.
    """
    silence_us = silence_seconds * _US
    day_us = max(DAY_SECONDS * _US, silence_us)
    in_day = Window.partitionBy("day").orderBy("bin")
    over_days = Window.partitionBy("apart").orderBy("day")
    following = F.coalesce(F.col("next_in_day"), F.lead("first_of_day").over(over_days))
    gap_us = F.col("next") - F.col("last")
    gaps = (
        rows.select(epoch_micros(F.col(ts)).alias("us"))
        .groupBy(_floor_div(F.col("us"), silence_us).alias("bin"))
        .agg(F.min("us").alias("first"), F.max("us").alias("last"))
        .withColumn("day", _floor_div(F.col("first"), day_us))
        .withColumn("next_in_day", F.lead("first").over(in_day))
        .withColumn("first_of_day", F.first("first").over(in_day.rowsBetween(*_SO_FAR)))
        .withColumn("apart", F.when(F.col("next_in_day").isNotNull(), F.col("bin")))
        .select("last", following.alias("next"))
        .where(gap_us >= silence_us)
    )
    if as_of is not None:
        ongoing = rows.agg(F.max(epoch_micros(F.col(ts))).alias("last")).select(
            "last", epoch_micros(as_of).alias("next")
        )
        gaps = gaps.unionByName(ongoing.where(F.col("last").isNull() | (gap_us >= silence_us)))
    return gaps.select(
        from_epoch_micros(F.col("last")).alias("last_ts"),
        from_epoch_micros(F.col("next")).alias("next_ts"),
        int_div(gap_us, 1000).alias("gap_ms"),
    )
