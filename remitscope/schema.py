"""Record schemas and the fixed values that every operator shares."""

from pyspark.sql import types as T

# Wire names, in declaration order. The order is the order of every report.
DIRECTIONS = ["PAY_IN", "PAY_OUT"]
STATUSES = [
    "INITIATED",
    "COMPLIANCE_APPROVED",
    "FUNDS_RESERVED",
    "RAIL_SETTLED",
    "LEDGER_POSTED",
    "COMPLETED",
    "FAILED",
    "REJECTED",
]
CURRENCIES = ["USD", "EUR", "MXN", "BRL", "ARS", "BTC", "ETH", "USDC"]

# Decimal places of a minor unit.
CURRENCY_SCALE = {
    "USD": 2,
    "EUR": 2,
    "MXN": 2,
    "BRL": 2,
    "ARS": 2,
    "BTC": 8,
    "ETH": 8,
    "USDC": 6,
}

# Statuses after which a payment no longer changes, and the one that settles it.
TERMINAL_STATUSES = ["COMPLETED", "FAILED", "REJECTED"]
SETTLED_STATUS = "COMPLETED"

# Risk points by magnitude in minor units, whatever the currency.
LARGE_AMOUNT_MINOR = 100_000_000
MEDIUM_AMOUNT_MINOR = 10_000_000
LARGE_AMOUNT_POINTS = 60
MEDIUM_AMOUNT_POINTS = 30
PAY_OUT_POINTS = 15
MAX_RISK_SCORE = 100

MONEY = T.StructType(
    [
        T.StructField("currency", T.StringType()),
        T.StructField("minor_units", T.LongType()),
    ]
)

PAYMENT_EVENT = T.StructType(
    [
        T.StructField("payment_id", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("status", T.StringType()),
        T.StructField("occurred_at", T.TimestampType()),
    ]
)

ENRICHED_EVENT = T.StructType(
    PAYMENT_EVENT.fields
    + [
        T.StructField("risk_score", T.IntegerType()),
        T.StructField("ingest_latency_ms", T.LongType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

# The columns of Spark's Kafka source; files that stand in for a topic carry the same ones.
RAW_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# One row per attempt to publish an event.
PUBLISH_ATTEMPT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("sink_key", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)
PUBLISHED = "PUBLISHED"
FAILED = "FAILED"
TIMED_OUT = "TIMED_OUT"

# RFC 3339 in UTC with all six digits: the default format of to_json cuts to milliseconds.
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
