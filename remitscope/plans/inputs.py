"""Payment events, raw records and a publish log, derived from the ``events`` table."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions.identifiers import canonical_uuid, uuid_bytes
from remitscope.functions.money import money
from remitscope.functions.times import int_div, utc_instant
from remitscope.operators.encode import event_json

# The instant as of which batch queries enrich.
AS_OF = "2024-01-16 00:00:00Z"


def as_of():
    return F.to_timestamp(F.lit(AS_OF))


def _pick(names: list[str], index) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as stored, with ``ts`` as an instant. The stored times are UTC."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    is_instant = events.schema["ts"].dataType.typeName() == "timestamp"
    return events if is_instant else events.withColumn("ts", utc_instant(F.col("ts")))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment events; eight consecutive rows are the life of one payment."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    number = int_div(event_id, 8)
    cents = F.round(F.col("value") * 100).cast("bigint") * 5000
    return read_events(spark, sf_dir).select(
        event_id,
        canonical_uuid(F.md5(number.cast("string"))).alias("payment_id"),
        F.when(int_div(number, 8) % 2 == 0, "PAY_IN").otherwise("PAY_OUT").alias("direction"),
        F.concat(F.lit("acct-"), user_id.cast("string")).alias("account"),
        money(
            _pick(S.CURRENCIES, number % 8),
            F.when(F.col("event_type") == "error", -cents).otherwise(cents),
        ).alias("amount"),
        _pick(S.STATUSES, (event_id + user_id) % 8).alias("status"),
        F.col("ts").alias("occurred_at"),
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment events as topic records; fourteen of each fifty are damaged, one way each."""
    text = event_json()
    account = F.concat(F.lit('"account":"'), F.col("account"), F.lit('"'))

    def swap(old, new):
        old = old if isinstance(old, Column) else F.lit(old)
        return F.replace(text, old, new if isinstance(new, Column) else F.lit(new))

    minor_units = F.col("amount.minor_units").cast("string")
    kind = F.col("event_id") % 50
    value = (
        F.when(kind == 0, F.substring(text, F.lit(1), int_div(F.length(text), F.lit(2))))
        .when(kind == 1, swap(F.concat(account, F.lit(",")), ""))
        .when(
            kind == 2,
            swap(
                F.concat(F.lit('"minor_units":'), minor_units),
                F.concat(F.lit('"minor_units":"'), minor_units, F.lit('"')),
            ),
        )
        .when(
            kind == 3,
            swap(F.concat(F.lit('"status":"'), F.col("status")), '"status":"SETTLED'),
        )
        .when(kind == 4, F.lit(None))
        .when(kind == 5, swap('Z"', '"'))
        .when(kind == 6, swap(F.col("payment_id"), F.substring("payment_id", 1, 23)))
        .when(kind == 7, swap(account, '"account":5'))
        .when(kind == 8, swap(account, F.concat(account, F.lit(","), account)))
        .when(kind == 9, F.lit(""))
        .when(kind == 10, swap(F.col("payment_id"), F.concat(F.col("payment_id"), F.lit("\\n"))))
        .when(kind == 11, swap('Z"', 'Z\\n"'))
        .when(kind == 12, F.concat(text, F.lit("\u2028")))
        .when(kind == 13, swap(account, F.concat(F.lit('"note":1,"note":2,'), account)))
        .otherwise(text)
    )
    return payments(spark, sf_dir).select(
        uuid_bytes(F.col("payment_id")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit("payments.events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("occurred_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def publish_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four attempts per event, spaced by a doubling backoff of 50 ms."""
    event_id = F.col("event_id")
    needed = 1 + event_id % 5
    attempt = F.col("attempt")
    waited_ms = _pick([0, 50, 150, 350], attempt - 1)
    outcome = (
        F.when(attempt == needed, S.PUBLISHED)
        .when(attempt % 2 == 0, S.TIMED_OUT)
        .otherwise(S.FAILED)
    )
    attempts = read_events(spark, sf_dir).select(
        event_id,
        "user_id",
        "ts",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(4), needed.cast("int")))).alias("attempt"),
    )
    return attempts.select(
        event_id,
        attempt,
        F.concat(F.lit("sink-"), (F.col("user_id") % 10).cast("string")).alias("sink_key"),
        F.timestamp_micros(F.unix_micros("ts") + waited_ms * 1000).alias("ts"),
        outcome.alias("outcome"),
        F.when(outcome == S.TIMED_OUT, F.lit(5001)).otherwise(event_id * 13 % 5000)
        .cast("bigint")
        .alias("duration_ms"),
    )
