"""Money, names, identifiers, times and risk on hand-made values."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions import identifiers, money, names, risk, times
from remitscope.operators.enrich import is_terminal
from remitscope.plans import inputs
from remitscope.plans.queries import QUERIES

MIN, MAX = -(2**63), 2**63 - 1


def evaluate(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


@pytest.mark.parametrize(
    "currency, units, text",
    [
        ("USD", 1234, "12.34 USD"),
        ("BTC", 1, "0.00000001 BTC"),
        ("USD", 0, "0.00 USD"),
        ("USD", -50, "-0.50 USD"),
        ("USD", -1234, "-12.34 USD"),
        ("USDC", 1_500_000, "1.500000 USDC"),
        ("MXN", MAX, "92233720368547758.07 MXN"),
        ("MXN", MIN, "-92233720368547758.08 MXN"),
        ("ETH", 123456789012, "1234.56789012 ETH"),
    ],
)
def test_format_money(spark, currency, units, text):
    column = money.format_money(F.col("c"), F.col("m"))
    assert evaluate(spark, [(currency, units)], "c string, m bigint", column) == [text]


def test_scales(spark):
    column = money.minor_unit_scale(F.col("c"))
    found = evaluate(spark, [(c,) for c in [*S.CURRENCIES, "GBP"]], "c string", column)
    assert found == [2, 2, 2, 2, 2, 8, 8, 6, None]


def _pair(spark, left, right):
    ddl = "a struct<currency:string,minor_units:bigint>, b struct<currency:string,minor_units:bigint>"
    return spark.createDataFrame([(left, right)], ddl)


def test_add_same_currency(spark):
    pair = _pair(spark, ("MXN", 100), ("MXN", 250))
    total = pair.select(money.checked_add(F.col("a"), F.col("b"))).first()[0]
    assert tuple(total) == ("MXN", 350)
    assert tuple(pair.select(money.try_add(F.col("a"), F.col("b"))).first()[0]) == (350, False)


def test_add_mismatch(spark):
    pair = _pair(spark, ("USD", 100), ("EUR", 100))
    with pytest.raises(Exception, match="currency mismatch: expected USD but got EUR"):
        pair.select(money.checked_add(F.col("a"), F.col("b"))).collect()
    assert tuple(pair.select(money.try_add(F.col("a"), F.col("b"))).first()[0]) == (None, True)


def test_add_overflow_raises(spark):
    pair = _pair(spark, ("USD", MAX), ("USD", 1))
    with pytest.raises(Exception, match="OVERFLOW"):
        pair.select(money.checked_add(F.col("a"), F.col("b"))).collect()


def test_zero_and_positive(spark):
    assert tuple(evaluate(spark, [("BTC",)], "c string", money.zero(F.col("c")))[0]) == ("BTC", 0)
    column = money.is_positive(F.col("m"))
    assert evaluate(spark, [(1,), (0,), (-1,)], "m bigint", column) == [True, False, False]


def test_magnitude_of_smallest(spark):
    assert evaluate(spark, [(MIN,)], "m bigint", money.magnitude(F.col("m"))) == [2**63]


def test_terminal(spark):
    found = evaluate(spark, [(s,) for s in S.STATUSES], "s string", is_terminal(F.col("s")))
    assert [s for s, t in zip(S.STATUSES, found) if t] == ["COMPLETED", "FAILED", "REJECTED"]


@pytest.mark.parametrize(
    "direction, units, score",
    [
        ("PAY_IN", 1_000, 0),
        ("PAY_OUT", 1_000, 15),
        ("PAY_IN", 9_999_999, 0),
        ("PAY_IN", 10_000_000, 30),
        ("PAY_IN", -10_000_000, 30),
        ("PAY_OUT", 99_999_999, 45),
        ("PAY_IN", 100_000_000, 60),
        ("PAY_OUT", 200_000_000, 75),
        ("PAY_OUT", MIN, 75),
        ("PAY_IN", MAX, 60),
    ],
)
def test_risk(spark, direction, units, score):
    column = risk.risk_score(F.col("d"), F.col("m"))
    assert evaluate(spark, [(direction, units)], "d string, m bigint", column) == [score]


def test_names(spark):
    column = names.display_name(F.col("s"))
    assert evaluate(spark, [("COMPLIANCE_APPROVED",), ("PAY_IN",)], "s string", column) == [
        "ComplianceApproved",
        "PayIn",
    ]
    column = names.ordinal(F.col("s"), S.STATUSES)
    found = evaluate(spark, [("INITIATED",), ("REJECTED",), ("x",)], "s string", column)
    assert found == [0, 7, None]


CANONICAL = "8f2c0000-0000-4abc-8000-00000000000f"


@pytest.mark.parametrize(
    "text, good",
    [
        (CANONICAL, True),
        (CANONICAL.upper(), True),
        (CANONICAL.replace("-", ""), True),
        ("{" + CANONICAL + "}", True),
        ("urn:uuid:" + CANONICAL, True),
        ("{" + CANONICAL.replace("-", "") + "}", False),
        (CANONICAL[:-1], False),
        (CANONICAL[:-1] + "g", False),
        ("8f2c...", False),
        ("", False),
    ],
)
def test_uuid(spark, text, good):
    accepted = identifiers.is_uuid(F.col("u"))
    assert evaluate(spark, [(text,)], "u string", accepted) == [good]
    if good:
        canonical = identifiers.canonical_uuid(F.col("u"))
        assert evaluate(spark, [(text,)], "u string", canonical) == [CANONICAL]
        key = identifiers.uuid_bytes(canonical)
        assert bytes(evaluate(spark, [(text,)], "u string", key)[0]).hex() == CANONICAL.replace(
            "-", ""
        )


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2026-07-12T10:00:00Z", datetime(2026, 7, 12, 10)),
        ("2026-07-12t10:00:00z", datetime(2026, 7, 12, 10)),
        ("2026-07-12 10:00:00.5+02:00", datetime(2026, 7, 12, 8, 0, 0, 500000)),
        ("2026-07-12T10:00:00.123456789Z", datetime(2026, 7, 12, 10, 0, 0, 123456)),
        ("2026-07-12T10:00:00", None),
        ("2026-07-12", None),
        ("2026", None),
        ("2026-13-12T10:00:00Z", None),
        ("2026-02-30T10:00:00Z", None),
        ("noon", None),
    ],
)
def test_rfc3339(spark, text, parsed):
    column = times.parse_rfc3339(F.col("t")).cast("timestamp_ntz")
    assert evaluate(spark, [(text,)], "t string", column) == [parsed]


@pytest.mark.parametrize(
    "micros, ms", [(250_000, 250), (999_999, 999), (1_000, 1), (999, 0), (0, 0), (-5_000_000, 0)]
)
def test_elapsed_ms(spark, micros, ms):
    column = times.elapsed_ms(F.timestamp_micros(F.lit(0)), F.timestamp_micros("us"))
    assert evaluate(spark, [(micros,)], "us bigint", column) == [ms]


def test_utc_times_do_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    walls = [datetime(2024, 3, 31, 2, 30, 1, 123456), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 10, 27, 1)]
    rows = spark.createDataFrame([(w,) for w in walls], "t timestamp_ntz")
    try:
        for name in ("Europe/Berlin", "America/Sao_Paulo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", name)
            instant = times.utc_instant(F.col("t"))
            found = rows.select(F.unix_micros(instant), times.utc_wall_clock(instant)).collect()
            wanted = [(round((w - datetime(1970, 1, 1)) / timedelta(microseconds=1)), w) for w in walls]
            assert [tuple(r) for r in found] == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sums_with_an_id_that_occurs_twice(spark, tmp_path):
    events = inputs.read_events(spark, "/root/testdata/sf0.001").limit(6)
    twice = events.unionByName(events.limit(6).withColumn("value", F.col("value") + 1))
    twice.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES["money_add"](spark, str(tmp_path)).count() == 5 * 4
