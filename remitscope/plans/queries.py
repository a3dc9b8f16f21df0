"""The registered queries: each takes (session, folder of tables) and returns a DataFrame."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions import money as M
from remitscope.functions.times import utc_wall_clock
from remitscope.operators import aggregates, decode, encode, publish_log, rates
from remitscope.operators.admission import TokenBucket, token_bucket_admission
from remitscope.operators.enrich import enrich, positive_amounts, terminal_events
from remitscope.plans import inputs

# Parameters that suit the density of the test tables.
BUCKET = TokenBucket(capacity=1, refill_per_sec=1 / 7200)
BURST = TokenBucket(capacity=50, refill_per_sec=1 / 86_400)
ALERT_THRESHOLD = 0.01
STALLED_UNTIL = "2024-03-01 00:00:00Z"


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the form in which the tables hold them."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: utc_wall_clock(F.col(name)) for name in times})


def _enriched(spark, sf_dir) -> DataFrame:
    return enrich(inputs.payments(spark, sf_dir), now=inputs.as_of())


def _amount(name: str) -> Column:
    return F.col(f"amount.{name}").alias(name)


def enrich_events(spark, sf_dir):
    return _plain_times(
        _enriched(spark, sf_dir).select(
            "event_id",
            "payment_id",
            "direction",
            "account",
            _amount("currency"),
            _amount("minor_units"),
            "status",
            "occurred_at",
            "risk_score",
            "ingest_latency_ms",
            "processed_at",
        )
    )


def ingest_latency(spark, sf_dir):
    return _enriched(spark, sf_dir).select("event_id", "ingest_latency_ms")


def terminal(spark, sf_dir):
    return terminal_events(inputs.payments(spark, sf_dir)).select("event_id", "status")


def positive(spark, sf_dir):
    return positive_amounts(inputs.payments(spark, sf_dir)).select(
        "event_id", _amount("minor_units")
    )


def currency_scale(spark, sf_dir):
    currencies = inputs.payments(spark, sf_dir).select(_amount("currency")).distinct()
    return currencies.select("currency", M.minor_unit_scale(F.col("currency")).alias("scale"))


def format_money(spark, sf_dir):
    text = M.format_money(F.col("amount.currency"), F.col("amount.minor_units"))
    return inputs.payments(spark, sf_dir).select("event_id", text.alias("amount_text"))


def money_add(spark, sf_dir):
    """Each amount plus that of each next event; an id that occurs twice gives both sums."""
    amounts = inputs.payments(spark, sf_dir).select("event_id", "amount")
    following = amounts.select((F.col("event_id") - 1).alias("event_id"), F.col("amount").alias("next_amount"))
    total = M.try_add(F.col("amount"), F.col("next_amount"))
    return (
        amounts.join(following, "event_id")
        .select("event_id", total.alias("total"))
        .select("event_id", "total.sum_minor", "total.mismatch")
    )


def encode_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir).select("event_id", encode.enriched_json().alias("value"))


def record_keys(spark, sf_dir):
    key_hex = F.lower(F.hex(encode.record_key()))
    return inputs.payments(spark, sf_dir).select("event_id", key_hex.alias("key_hex"))


def total_processed(spark, sf_dir):
    return aggregates.total_processed(inputs.payments(spark, sf_dir))


def counts_by_status(spark, sf_dir):
    return aggregates.counts_by(inputs.payments(spark, sf_dir), "status")


def counts_by_direction(spark, sf_dir):
    return aggregates.counts_by(inputs.payments(spark, sf_dir), "direction")


def settled_by_currency(spark, sf_dir):
    return aggregates.settled_by_currency(inputs.payments(spark, sf_dir))


def max_risk_score(spark, sf_dir):
    return aggregates.max_risk_score(_enriched(spark, sf_dir))


def risk_score_distribution(spark, sf_dir):
    return aggregates.counts_by(_enriched(spark, sf_dir), "risk_score")


def aggregates_snapshot(spark, sf_dir):
    return aggregates.snapshot(_enriched(spark, sf_dir))


def aggregates_view(spark, sf_dir):
    return aggregates.report_lines(aggregates.snapshot(_enriched(spark, sf_dir)))


def _decoded(spark, sf_dir) -> DataFrame:
    return decode.decode(inputs.raw_records(spark, sf_dir).select("offset", "value"))


def decode_events(spark, sf_dir):
    return _plain_times(
        decode.accepted(_decoded(spark, sf_dir)).select(
            "offset",
            "payment_id",
            "direction",
            "account",
            _amount("currency"),
            _amount("minor_units"),
            "status",
            "occurred_at",
        )
    )


def poison_records(spark, sf_dir):
    return decode.rejected(_decoded(spark, sf_dir)).select("offset", "reject_reason")


def tombstone_filter(spark, sf_dir):
    return decode.without_tombstones(inputs.raw_records(spark, sf_dir)).select("offset")


def publish_outcomes(spark, sf_dir):
    return publish_log.publish_outcomes(inputs.publish_log(spark, sf_dir))


def published_count(spark, sf_dir):
    return publish_log.published_count(publish_outcomes(spark, sf_dir))


def event_counters(spark, sf_dir):
    return publish_log.event_counters(
        inputs.payments(spark, sf_dir), inputs.publish_log(spark, sf_dir)
    )


def failure_streaks(spark, sf_dir):
    return _plain_times(publish_log.failure_streaks(inputs.publish_log(spark, sf_dir)))


def slow_publishes(spark, sf_dir):
    return publish_log.slow_publishes(inputs.publish_log(spark, sf_dir))


def _failures(spark, sf_dir) -> DataFrame:
    return inputs.publish_log(spark, sf_dir).where(F.col("outcome") == S.FAILED)


def failure_rate_1m(spark, sf_dir):
    return _plain_times(rates.event_rate(_failures(spark, sf_dir)))


def failure_alerts(spark, sf_dir):
    return _plain_times(rates.rate_alerts(_failures(spark, sf_dir), threshold=ALERT_THRESHOLD))


def event_rate_1m(spark, sf_dir):
    return _plain_times(rates.event_rate(inputs.read_events(spark, sf_dir)))


def event_rate_sliding(spark, sf_dir):
    return _plain_times(rates.sliding_rate(inputs.read_events(spark, sf_dir)))


def stalled_intervals(spark, sf_dir):
    until = F.to_timestamp(F.lit(STALLED_UNTIL))
    return _plain_times(rates.stalled_intervals(inputs.read_events(spark, sf_dir), as_of=until))


def token_bucket(spark, sf_dir):
    return token_bucket_admission(inputs.read_events(spark, sf_dir), BUCKET)


def token_bucket_burst(spark, sf_dir):
    """A larger bucket, with a third of all events on one user who asks for more than the refill."""
    hot = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    events = inputs.read_events(spark, sf_dir).withColumn("user_id", hot.cast("bigint"))
    return token_bucket_admission(events, BURST)


QUERIES = {
    "enrich_events": enrich_events,
    "ingest_latency": ingest_latency,
    "terminal_events": terminal,
    "positive_amounts": positive,
    "currency_scale": currency_scale,
    "format_money": format_money,
    "money_add": money_add,
    "encode_enriched": encode_enriched,
    "record_keys": record_keys,
    "total_processed": total_processed,
    "counts_by_status": counts_by_status,
    "counts_by_direction": counts_by_direction,
    "settled_by_currency": settled_by_currency,
    "max_risk_score": max_risk_score,
    "risk_score_distribution": risk_score_distribution,
    "aggregates_snapshot": aggregates_snapshot,
    "aggregates_view": aggregates_view,
    "decode_events": decode_events,
    "poison_records": poison_records,
    "tombstone_filter": tombstone_filter,
    "publish_outcomes": publish_outcomes,
    "published_count": published_count,
    "event_counters": event_counters,
    "failure_streaks": failure_streaks,
    "slow_publishes": slow_publishes,
    "failure_rate_1m": failure_rate_1m,
    "failure_alerts": failure_alerts,
    "event_rate_1m": event_rate_1m,
    "event_rate_sliding": event_rate_sliding,
    "stalled_intervals": stalled_intervals,
    "token_bucket_admission": token_bucket,
    "token_bucket_burst": token_bucket_burst,
}
