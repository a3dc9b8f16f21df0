"""The read model: counts, settled totals and the highest risk as one consistent snapshot.

The fold has two steps. :func:`partial_aggregates` brings any input down to one row per
(status, direction, currency), 128 at most, by plain hash aggregation with map-side combining.
:func:`roll_up` forms the reports from those rows alone, so all of them reflect the same events
and the raw rows are never expanded per report.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions.names import display_name, ordinal

_KEYS = ["status", "direction", "currency"]


def _settled_minor_units():
    return F.sum(F.when(F.col("status") == S.SETTLED_STATUS, F.col("amount.minor_units")))


def partial_aggregates(enriched: DataFrame) -> DataFrame:
    """One row per (status, direction, currency) that occurs.

    The settled total is a gross signed sum; pay-outs add to it. Sums that leave bigint raise
    (ANSI mode).
    """
    return enriched.groupBy("status", "direction", F.col("amount.currency").alias("currency")).agg(
        F.count("*").alias("n"),
        _settled_minor_units().alias("settled_minor_units"),
        F.max("risk_score").alias("max_risk_score"),
    )


def roll_up(partials: DataFrame) -> DataFrame:
    """(dimension, key, n, settled_minor_units, max_risk_score) from the partial rows.

    The ``total`` row is there for empty input too, all zeros. A currency without a settled event
    has no row; one whose settled events sum to 0 has one. Only currency rows carry a settled
    total, as amounts of different currencies do not add up.
    """
    nothing = partials.sparkSession.range(0, 1, 1, 1).select(
        *[F.lit(None).cast("string").alias(name) for name in _KEYS],
        F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("settled_minor_units"),
        F.lit(0).alias("max_risk_score"),
    )
    columns = [F.col(name) for name in _KEYS]
    sets = [[], *[[c] for c in columns]]
    grouped = (
        partials.unionByName(nothing)
        .groupingSets(sets, *columns)
        .agg(
            F.grouping_id(*columns).alias("gid"),
            F.sum("n").alias("n"),
            F.sum("settled_minor_units").alias("settled_minor_units"),
            F.max("max_risk_score").alias("max_risk_score"),
        )
    )
    gid = F.col("gid")
    dimension = (
        F.when(gid == 0b111, "total")
        .when(gid == 0b011, "status")
        .when(gid == 0b101, "direction")
        .otherwise("currency")
    )
    key = F.when(gid == 0b111, F.lit("all")).otherwise(F.coalesce(*columns))
    settled = F.when(gid == 0b110, F.col("settled_minor_units"))
    return grouped.select(
        dimension.alias("dimension"),
        key.alias("key"),
        "n",
        settled.alias("settled_minor_units"),
        "max_risk_score",
    ).where(
        F.col("key").isNotNull()
        & ((F.col("dimension") != "currency") | F.col("settled_minor_units").isNotNull())
    )


def snapshot(enriched: DataFrame) -> DataFrame:
    return roll_up(partial_aggregates(enriched))


def total_processed(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("n"))


def counts_by(events: DataFrame, name: str) -> DataFrame:
    return events.groupBy(name).agg(F.count("*").alias("n"))


def settled_by_currency(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("status") == S.SETTLED_STATUS)
        .groupBy(F.col("amount.currency").alias("currency"))
        .agg(F.sum("amount.minor_units").alias("settled_minor_units"))
    )


def max_risk_score(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.coalesce(F.max("risk_score"), F.lit(0)).alias("max_risk_score"))


def report_lines(snapshot_rows: DataFrame) -> DataFrame:
    """The snapshot as (section, ord, name, value), named and ordered as the API shows it."""
    dimension, key = F.col("dimension"), F.col("key")
    section = (
        F.when(dimension == "status", "byStatus")
        .when(dimension == "direction", "byDirection")
        .otherwise("settled")
    )
    position = (
        F.when(dimension == "status", ordinal(key, S.STATUSES))
        .when(dimension == "direction", ordinal(key, S.DIRECTIONS))
        .otherwise(ordinal(key, S.CURRENCIES))
    )
    name = F.when(dimension == "currency", key).otherwise(display_name(key))
    value = F.when(dimension == "currency", F.col("settled_minor_units")).otherwise(F.col("n"))

    def line(section, position, name, value):
        return F.struct(
            section.alias("section"),
            position.cast("int").alias("ord"),
            name.alias("name"),
            value.cast("bigint").alias("value"),
        )

    totals = F.array(
        line(F.lit("totalProcessed"), F.lit(0), F.lit("all"), F.col("n")),
        line(F.lit("maxRiskScore"), F.lit(0), F.lit("all"), F.col("max_risk_score")),
    )
    listed = F.array(line(section, position, name, value))
    return snapshot_rows.select(F.inline(F.when(dimension == "total", totals).otherwise(listed)))


def read_model(snapshot_rows: DataFrame) -> DataFrame:
    """One row with the scalars and three maps, as a client holds the snapshot."""

    def as_map(dimension, value):
        pairs = F.collect_list(
            F.when(F.col("dimension") == dimension, F.struct("key", F.col(value)))
        )
        return F.map_from_entries(pairs)

    total = F.col("dimension") == "total"
    return snapshot_rows.agg(
        F.max(F.when(total, F.col("n"))).alias("total_processed"),
        F.max(F.when(total, F.col("max_risk_score"))).alias("max_risk_score"),
        as_map("status", "n").alias("by_status"),
        as_map("direction", "n").alias("by_direction"),
        as_map("currency", "settled_minor_units").alias("settled_minor_by_currency"),
    )


def aggregates_document(snapshot_rows: DataFrame) -> DataFrame:
    """One row shaped like the API answer: scalars and three lists in declaration order."""
    lines = report_lines(snapshot_rows)

    def scalar(section):
        return F.max(F.when(F.col("section") == section, F.col("value")))

    def ordered(section, name, value):
        entries = F.collect_list(
            F.when(F.col("section") == section, F.struct("ord", "name", "value"))
        )
        return F.transform(
            F.array_sort(entries), lambda e: F.struct(e["name"].alias(name), e["value"].alias(value))
        )

    return lines.agg(
        scalar("totalProcessed").alias("totalProcessed"),
        scalar("maxRiskScore").cast("int").alias("maxRiskScore"),
        ordered("byStatus", "status", "count").alias("byStatus"),
        ordered("byDirection", "direction", "count").alias("byDirection"),
        ordered("settled", "currency", "settledMinorUnits").alias("settled"),
    )
