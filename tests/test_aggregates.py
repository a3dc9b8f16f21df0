"""The read model on hand-made events."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.operators import aggregates
from remitscope.operators.enrich import enrich, positive_amounts, terminal_events

AT = datetime(2026, 7, 12, 10)


def payments(spark, *rows):
    """Rows of (direction, status, minor units) in MXN, or with a currency as fourth item."""
    full = [
        ("00000000-0000-0000-0000-000000000000", d, "a", (rest[0] if rest else "MXN", m), s, AT)
        for d, s, m, *rest in rows
    ]
    return spark.createDataFrame(full, S.PAYMENT_EVENT)


def model(events):
    snapshot = aggregates.snapshot(enrich(events))
    return aggregates.read_model(snapshot).first().asDict()


def test_counts_and_totals(spark):
    found = model(
        payments(
            spark,
            ("PAY_IN", "COMPLETED", 100_000),
            ("PAY_OUT", "COMPLETED", 50_000),
            ("PAY_IN", "FAILED", 99_900),
        )
    )
    assert found == {
        "total_processed": 3,
        "max_risk_score": 15,
        "by_status": {"COMPLETED": 2, "FAILED": 1},
        "by_direction": {"PAY_IN": 2, "PAY_OUT": 1},
        "settled_minor_by_currency": {"MXN": 150_000},
    }


def test_highest_risk(spark):
    events = payments(
        spark, ("PAY_IN", "COMPLETED", 1_000), ("PAY_OUT", "COMPLETED", 200_000_000)
    )
    assert model(events)["max_risk_score"] == 75
    assert aggregates.max_risk_score(enrich(events)).first()[0] == 75


def test_empty_input_is_all_zeros(spark):
    events = payments(spark)
    assert model(events) == {
        "total_processed": 0,
        "max_risk_score": 0,
        "by_status": {},
        "by_direction": {},
        "settled_minor_by_currency": {},
    }
    assert aggregates.max_risk_score(enrich(events)).first()[0] == 0


def test_currency_without_settled_event_is_absent_but_zero_total_stays(spark):
    events = payments(
        spark,
        ("PAY_IN", "FAILED", 5, "USD"),
        ("PAY_IN", "COMPLETED", 0, "EUR"),
        ("PAY_IN", "COMPLETED", 7, "BTC"),
        ("PAY_IN", "COMPLETED", -7, "BTC"),
    )
    assert model(events)["settled_minor_by_currency"] == {"EUR": 0, "BTC": 0}
    rows = aggregates.settled_by_currency(events).collect()
    assert {r["currency"]: r["settled_minor_units"] for r in rows} == {"EUR": 0, "BTC": 0}


def test_repeated_event_counts_twice(spark):
    events = payments(spark, ("PAY_IN", "COMPLETED", 1), ("PAY_IN", "COMPLETED", 1))
    assert model(events)["settled_minor_by_currency"] == {"MXN": 2}


def test_overflow_raises(spark):
    top = 2**63 - 1
    with pytest.raises(Exception, match="OVERFLOW"):
        model(payments(spark, ("PAY_IN", "COMPLETED", top), ("PAY_IN", "COMPLETED", top)))


def test_document_lists_in_declaration_order(spark):
    events = payments(
        spark,
        ("PAY_OUT", "REJECTED", 1, "USDC"),
        ("PAY_IN", "INITIATED", 1, "BTC"),
        ("PAY_OUT", "COMPLETED", 2, "USDC"),
        ("PAY_IN", "COMPLETED", 3, "EUR"),
        ("PAY_IN", "COMPLIANCE_APPROVED", 3, "EUR"),
    )
    document = aggregates.aggregates_document(aggregates.snapshot(enrich(events))).first()
    assert document["totalProcessed"] == 5
    assert [tuple(r) for r in document["byStatus"]] == [
        ("Initiated", 1),
        ("ComplianceApproved", 1),
        ("Completed", 2),
        ("Rejected", 1),
    ]
    assert [tuple(r) for r in document["byDirection"]] == [("PayIn", 3), ("PayOut", 2)]
    assert [tuple(r) for r in document["settled"]] == [("EUR", 3), ("USDC", 2)]


def test_caller_picks_fields_with_sql(spark):
    events = payments(spark, ("PAY_IN", "COMPLETED", 100_000))
    document = aggregates.aggregates_document(aggregates.snapshot(enrich(events)))
    document.createOrReplaceTempView("aggregates")
    picked = spark.sql("SELECT totalProcessed, settled.currency FROM aggregates").first()
    assert tuple(picked) == (1, ["MXN"])


def test_raw_rows_are_not_expanded_per_report(spark):
    plan = aggregates.snapshot(enrich(payments(spark)))._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("Aggregate" in line for line in lines[expand:])


def test_enrich(spark):
    events = payments(spark, ("PAY_OUT", "COMPLETED", 200_000_000))
    row = enrich(events, now=F.lit("2026-07-12T10:00:00.250Z").cast("timestamp")).first()
    assert (row["risk_score"], row["ingest_latency_ms"]) == (75, 250)
    late = enrich(events, now=F.lit("2026-07-12T09:59:55Z").cast("timestamp")).first()
    assert late["ingest_latency_ms"] == 0


def test_risk_is_replaceable(spark):
    events = payments(spark, ("PAY_OUT", "COMPLETED", 5))
    assert enrich(events, risk=lambda direction, units: units + 1).first()["risk_score"] == 6


def test_predicates(spark):
    events = payments(
        spark, ("PAY_IN", "COMPLETED", 0), ("PAY_IN", "INITIATED", 1), ("PAY_IN", "REJECTED", -1)
    )
    assert terminal_events(events).count() == 2
    assert positive_amounts(events).count() == 1
