"""The strict decode contract, one record per case."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.operators import decode
from remitscope.operators.encode import encode, event_json
from remitscope.operators.enrich import enrich
from remitscope.plans import inputs

BASE = {
    "payment_id": "8f2c0000-0000-0000-0000-000000000001",
    "direction": "PAY_IN",
    "account": "acct-1",
    "amount": {"currency": "MXN", "minor_units": 100},
    "status": "COMPLETED",
    "occurred_at": "2026-07-12T10:00:00.123456Z",
}
TEXT = json.dumps(BASE)


def having(**changes):
    return json.dumps(BASE | changes)


def without(name):
    return json.dumps({k: v for k, v in BASE.items() if k != name})


def amount(text):
    return TEXT.replace('"minor_units": 100', f'"minor_units": {text}')


ACCEPTED = {
    "as is": TEXT,
    "extra fields": having(extra={"a": [1, {"b": 2}]}, risk_score=5),
    "offset": having(occurred_at="2026-07-12T12:00:00.123456+02:00"),
    "plain uuid": having(payment_id="8F2C0000000000000000000000000001"),
    "braced uuid": having(payment_id="{8f2c0000-0000-0000-0000-000000000001}"),
    "urn": having(payment_id="urn:uuid:8f2c0000-0000-0000-0000-000000000001"),
    "blanks around": f" \n\t{TEXT}  ",
    "escaped text": TEXT.replace("acct-1", "\\u0061cct-1"),
    "unknown field twice": TEXT.replace("{", '{"note": 1, "note": 2, ', 1),
    "unknown field thrice, of any kind": TEXT.replace("{", '{"x": [1, {"y": null}], "x": "\\"}{", "x": -0.0, ', 1),
    "unknown field twice in an unknown one": TEXT.replace("{", '{"x": {"y": 1, "y": {"z": 1, "z": 2}}, ', 1),
    "unknown field twice in the amount": TEXT.replace('"currency"', '"x": 1, "x": 2, "currency"'),
    "unknown field twice, once escaped": TEXT.replace("{", '{"note": 1, "n\\u006fte": 2, ', 1),
    "unknown field twice, text that spells a known one": TEXT.replace("{", '{"x": "\\"status\\": 1", "x": "status", ', 1),
    "known names in an unknown field": TEXT.replace("{", '{"x": {"status": 1, "status": 2, "amount": 3}, ', 1),
}
REJECTED = {
    "line feed after uuid": (having(payment_id=BASE["payment_id"] + "\n"), "bad_uuid"),
    "line feed after time": (having(occurred_at=BASE["occurred_at"] + "\n"), "bad_timestamp"),
    "line separator after": (TEXT + "\u2028", "malformed"),
    "next line after": (TEXT + "\u0085", "malformed"),
    "negative zero": (amount("-0"), "malformed"),
    "negative zero, compact": (amount("-0").replace(": ", ":"), "malformed"),
    "known and unknown field twice": (TEXT.replace("{", '{"x": 1, "x": 2, "status": "FAILED", ', 1), "malformed"),
    "known field twice, once escaped": (TEXT.replace("{", '{"x": 1, "x": 2, "st\\u0061tus": "FAILED", ', 1), "malformed"),
    "units twice beside an unknown field": (amount('1, "x": 1, "x": 1, "minor_units": 1'), "malformed"),
    "unknown twice, text after": (TEXT.replace("{", '{"x": 1, "x": 2, ', 1) + " x", "malformed"),
    "unknown twice, element after": (TEXT.replace("{", '{"x": 1, "x": 2, ', 1) + ",{}", "malformed"),
    "unknown twice, forged end": (TEXT.replace("{", '{"x": 1, "x": 2, ', 1) + ',{"seal": 42}] {}', "malformed"),
    "unknown twice, single quotes": (TEXT.replace("{", "{'x': 1, 'x': 2, ", 1), "malformed"),
    "unknown twice, not a number": (TEXT.replace("{", '{"x": NaN, "x": 2, ', 1), "malformed"),
    "unknown twice, leading zero": (TEXT.replace("{", '{"x": 01, "x": 2, ', 1), "malformed"),
    "unknown twice, comment": (TEXT.replace("{", '{"x": 1, "x": 2, /* c */ ', 1), "malformed"),
    "unknown twice, control character": (TEXT.replace("{", '{"x": "\t", "x": 2, ', 1), "malformed"),
    "unknown twice, units as decimal": (amount('1.0, "x": 1, "x": 2'), "malformed"),
    "unknown twice, units with exponent": (amount('1e2, "x": 1, "x": 2'), "malformed"),
    "unknown twice, units as text": (amount('"1", "x": 1, "x": 2'), "malformed"),
    "unknown twice, negative zero": (amount('-0, "x": 1, "x": 2'), "malformed"),
    "unknown twice, amount as text": (having(amount="1").replace("{", '{"x": 1, "x": 2, ', 1), "malformed"),
    "unknown twice, no account": (without("account").replace("{", '{"x": 1, "x": 2, ', 1), "missing_field"),
    "unknown twice, null amount": (having(amount=None).replace("{", '{"x": 1, "x": 2, ', 1), "missing_field"),
    "unknown twice, null units": (amount('null, "x": 1, "x": 2'), "missing_field"),
    "unknown twice, account as number": (having(account=5).replace("{", '{"x": 1, "x": 2, ', 1), "wrong_type"),
    "unknown twice, uuid as number": (having(payment_id=5).replace("{", '{"x": 1, "x": 2, ', 1), "bad_uuid"),
    "unknown twice, unknown status": (having(status="X").replace("{", '{"x": 1, "x": 2, ', 1), "unknown_enum"),
    "leap second": (having(occurred_at="2026-06-30T23:59:60Z"), "bad_timestamp"),
    "offset beyond 18:00": (having(occurred_at="2026-06-30T23:00:00+18:30"), "bad_timestamp"),
    "no value": (None, "tombstone"),
    "truncated": (TEXT[:40], "malformed"),
    "empty": ("", "malformed"),
    "blank": ("  ", "malformed"),
    "null": ("null", "malformed"),
    "array": ("[]", "malformed"),
    "event in an array": (f"[{TEXT}]", "malformed"),
    "positional": ('["8f2c0000-0000-0000-0000-000000000001","PAY_IN","a"]', "malformed"),
    "text": ('"x"', "malformed"),
    "number": ("5", "malformed"),
    "text after": (TEXT + " xx", "malformed"),
    "object after": (TEXT + "{}", "malformed"),
    "element after": (TEXT + ",{}", "malformed"),
    "closing after": (TEXT + "]", "malformed"),
    "forged end": (TEXT + ",42] {}", "malformed"),
    "duplicate key": (TEXT.replace('"account"', '"account": "x", "account"'), "malformed"),
    "duplicate nested key": (amount('1, "minor_units": 2'), "malformed"),
    "single quotes": (TEXT.replace('"', "'"), "malformed"),
    "amount as text": (having(amount="100 MXN"), "malformed"),
    "units as text": (amount('"100"'), "malformed"),
    "units as decimal": (amount("100.0"), "malformed"),
    "units with exponent": (amount("1e2"), "malformed"),
    "units too large": (amount("9223372036854775808"), "malformed"),
    "units as boolean": (amount("true"), "malformed"),
    "no account": (without("account"), "missing_field"),
    "null account": (having(account=None), "missing_field"),
    "wrong case": (TEXT.replace('"account"', '"Account"'), "missing_field"),
    "null amount": (having(amount=None), "missing_field"),
    "no amount": (without("amount"), "missing_field"),
    "null units": (amount("null"), "missing_field"),
    "no currency": (having(amount={"minor_units": 1}), "missing_field"),
    "no time": (without("occurred_at"), "missing_field"),
    "account as number": (having(account=5), "wrong_type"),
    "account as object": (having(account={}), "wrong_type"),
    "short uuid": (having(payment_id="8f2c0000-0000-0000-0000"), "bad_uuid"),
    "uuid as number": (having(payment_id=5), "bad_uuid"),
    "unknown status": (having(status="SETTLED"), "unknown_enum"),
    "lower-case status": (having(status="completed"), "unknown_enum"),
    "unknown direction": (having(direction="IN"), "unknown_enum"),
    "unknown currency": (having(amount={"currency": "GBP", "minor_units": 1}), "unknown_enum"),
    "currency as number": (having(amount={"currency": 1, "minor_units": 1}), "unknown_enum"),
    "no offset": (having(occurred_at="2026-07-12T10:00:00"), "bad_timestamp"),
    "month 13": (having(occurred_at="2026-13-12T10:00:00Z"), "bad_timestamp"),
    "time as number": (having(occurred_at=1), "bad_timestamp"),
}


@pytest.fixture(scope="module")
def decoded(spark):
    values = {**ACCEPTED, **{name: value for name, (value, _) in REJECTED.items()}}
    records = spark.createDataFrame(list(values.items()), "name string, value string")
    records = records.withColumn("value", F.col("value").cast("binary"))
    return {row["name"]: row for row in decode.decode(records).collect()}


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted(decoded, name):
    row = decoded[name]
    assert row["reject_reason"] is None
    assert row["payment_id"] == BASE["payment_id"]
    assert row["account"] == "acct-1"
    assert row["amount"].asDict() == BASE["amount"]
    assert row["occurred_at"] == datetime(2026, 7, 12, 10, 0, 0, 123456)


@pytest.mark.parametrize("name", REJECTED)
def test_rejected(decoded, name):
    assert decoded[name]["reject_reason"] == REJECTED[name][1]


def _records(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "value binary")
    return rows


def test_bytes_that_are_not_text(spark):
    values = [TEXT.replace("acct-1", "acct-é").encode(), TEXT.encode().replace(b"acct-1", b"\xff\xfe")]
    reasons = [r["reject_reason"] for r in decode.decode(_records(spark, values)).collect()]
    assert reasons == [None, "malformed"]


def test_empty_account_and_smallest_amount(spark):
    values = [having(account="").encode(), amount(str(-(2**63))).encode()]
    rows = decode.events_only(decode.decode(_records(spark, values))).collect()
    assert rows[0]["account"] == ""
    assert rows[1]["amount"]["minor_units"] == -(2**63)


def test_tombstones_are_neither_good_nor_poison(spark):
    records = _records(spark, [None, b"x", TEXT.encode()])
    found = decode.decode(records)
    assert decode.accepted(found).count() == 1
    assert decode.rejected(found).count() == 1
    assert decode.without_tombstones(records).count() == 2


def test_encode_then_decode_gives_the_event_back(spark):
    events = decode.events_only(decode.decode(_records(spark, [TEXT.encode()])))
    plain = events.select(event_json().cast("binary").alias("value"))
    again = decode.events_only(decode.decode(plain))
    assert again.collect() == events.collect()
    # The enriched record holds more fields; a reader of plain events ignores them.
    record = encode(enrich(events))
    assert bytes(record.first()["key"]).hex() == BASE["payment_id"].replace("-", "")
    encoded = record.withColumn("value", F.col("value").cast("binary"))
    assert decode.events_only(decode.decode(encoded)).collect() == events.collect()


def test_both_paths_agree(spark):
    """A blank after the first brace changes nothing but the path that a record takes."""
    records = inputs.raw_records(spark, "/root/testdata/sf0.001").select("offset", "value")
    blank = F.regexp_replace(F.col("value").cast("string"), r"^\{", "{ ").cast("binary")
    spaced = records.withColumn("value", blank)
    names = [*S.PAYMENT_EVENT.fieldNames(), "reject_reason"]
    usual = decode.decode(records).where("reject_reason IS NULL").select("offset", *names)
    parsed = decode.decode(spaced).where("reject_reason IS NULL").select("offset", *names)
    assert usual.count() == 740
    assert usual.exceptAll(parsed).count() == 0 and parsed.exceptAll(usual).count() == 0
    reasons = [
        decode.decode(frame).groupBy("reject_reason").count() for frame in (records, spaced)
    ]
    assert sorted(map(str, reasons[0].collect())) == sorted(map(str, reasons[1].collect()))


def test_encoded_object_is_flat(spark):
    now = F.lit("2026-07-12T10:00:01.500000Z").cast("timestamp")
    events = decode.events_only(decode.decode(_records(spark, [TEXT.encode()])))
    found = json.loads(encode(enrich(events, now)).first()["value"])
    assert found == BASE | {
        "risk_score": 0,
        "ingest_latency_ms": 1376,
        "processed_at": "2026-07-12T10:00:01.500000Z",
    }
    assert list(found) == S.ENRICHED_EVENT.fieldNames()


def test_one_parse_per_record(spark):
    """The document is parsed in one place of the plan, filters and projections notwithstanding: as it
    is and, only if that fails, without other fields."""
    found = decode.accepted(decode.decode(_records(spark, [TEXT.encode()])))
    plan = found.select("account", "status")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("parseJson") == 2


def mutated(text, draw):
    """The record with one to three characters dropped, doubled, swapped or put in."""
    for _ in range(draw.randint(1, 3)):
        at = draw.randrange(len(text))
        kind = draw.randrange(4)
        new = draw.choice('"{}[],:0- \\\n\u2028Zz1aE.')
        text = {
            0: text[:at] + text[at + 1 :],
            1: text[:at] + text[at] + text[at:],
            2: text[:at] + new + text[at + 1 :],
            3: text[:at] + new + text[at:],
        }[kind]
    return text


def test_both_paths_agree_on_mutated_records(spark, monkeypatch):
    draw = random.Random(3)
    compact = json.dumps(BASE, separators=(",", ":"))
    texts = [mutated(draw.choice([TEXT, compact]), draw) for _ in range(1500)]
    rows = [(i, text.encode()) for i, text in enumerate(texts)]
    records = spark.createDataFrame(rows, "offset bigint, value binary")

    def found():
        return {row["offset"]: tuple(row) for row in decode.decode(records).collect()}

    with_shortcut = found()
    monkeypatch.setattr(decode, "_usual_layout", lambda: r"(?!)")
    assert found() == with_shortcut
    assert len({row[-1] for row in with_shortcut.values()}) > 4


def test_json_times_do_not_follow_the_session_zone(spark):
    events = decode.events_only(
        decode.decode(spark.createDataFrame([(TEXT.encode(),)], "value binary"))
    ).select(event_json().alias("text"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert '"occurred_at":"2026-07-12T10:00:00.123456Z"' in events.first()["text"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_text_that_spells_a_negative_zero_is_no_amount(spark):
    text = having(extra='"minor_units":-0,', amount={"currency": "MXN", "minor_units": 0})
    (row,) = decode.decode(spark.createDataFrame([(text.encode(),)], "value binary")).collect()
    assert row["reject_reason"] is None and row["amount"]["minor_units"] == 0
