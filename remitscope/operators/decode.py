"""Strict decoding of JSON payment events.

Spark's own JSON readers are more lenient than the contract: they let duplicate keys, text after
the object, numbers for strings and missing fields through. Two paths give the same answer here:

* A record in the usual layout, with just its fields in declared order, is recognised by one
  pattern, which leaves nothing to judge but the calendar, and cut at its quotes.
* Any other record is parsed, once, into a variant and judged field by field.

Fields of other names are ignored, also repeated ones. The parser takes no repeated name at all, so
a record that it refuses is read once more, name by name: if none of the event's own names repeats,
the event's fields alone are judged. Times carry offsets up to 18:00 and no leap seconds, the range
that timestamps have.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitscope import schema as S
from remitscope.functions.identifiers import canonical_uuid, is_uuid
from remitscope.functions.money import money
from remitscope.functions.times import RFC3339, parse_rfc3339

# Why a record is set aside, in the order of the tests.
REJECT_REASONS = [
    "tombstone",
    "malformed",
    "missing_field",
    "wrong_type",
    "bad_uuid",
    "unknown_enum",
    "bad_timestamp",
]

_LEAVES = ["payment_id", "direction", "account", "status", "occurred_at", "amount.currency"]

# Inside of a text, the quotes would carry backslashes.
_NEGATIVE_ZERO = r'"minor_units"[ \t\r\n]*:[ \t\r\n]*-0[ \t\r\n]*[,}]'

_TEXT_FORM = (
    "struct<payment_id: string, direction: string, account: string, "
    "amount: struct<currency: string, minor_units: bigint>, status: string, occurred_at: string>"
)


def _usual_layout() -> str:
    """Pattern of a record that needs no parser: compact or with single blanks after commas and
    colons, without escapes or long numbers."""
    fields = {
        "payment_id": '"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"',
        "direction": f'"(?:{"|".join(S.DIRECTIONS)})"',
        "account": r'"[^"\\\x00-\x1F]*+"',
        "currency": f'"(?:{"|".join(S.CURRENCIES)})"',
        "minor_units": "(?:0|-?[1-9][0-9]{0,17})",
        "status": f'"(?:{"|".join(S.STATUSES)})"',
        "occurred_at": f'"{RFC3339}"',
    }

    def of(struct):
        return r"\{" + ", ?".join(f'"{name}": ?{fields[name]}' for name in struct.names) + r"\}"

    fields["amount"] = of(S.MONEY)
    return rf"^{of(S.PAYMENT_EVENT)}\z"


def _once(*computed: Column) -> Column:
    """Computes the columns in a generator of one row.

    The optimizer does not merge expressions across a generator, so they are computed once per
    row however many filters and projections above refer to them.
    """
    return F.inline(F.array(F.struct(*computed)))


def _usual_fields() -> Column:
    """Fields of a record in the usual layout. Split at the quotes, they have fixed places."""

    def text(place, name):
        return F.get("parts", F.lit(place)).alias(name)

    units = F.btrim(F.get("parts", F.lit(20)), F.lit(":}, ")).cast("bigint")
    return F.struct(
        text(3, "payment_id"),
        text(7, "direction"),
        text(11, "account"),
        money(text(17, "currency"), units).alias("amount"),
        text(23, "status"),
        text(27, "occurred_at"),
    )


# The other readers of JSON are as strict as the parser with these.
_STRICT = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowNumericLeadingZeros": "false",
    "allowUnquotedFieldNames": "false",
    "allowComments": "false",
    "allowBackslashEscapingAnyCharacter": "false",
    "allowUnquotedControlChars": "false",
}


def _are_distinct(object_: Column, struct: T.StructType) -> Column:
    """Whether none of the struct's names occurs twice in an object, given as a map of all its names."""
    own = F.filter(F.map_keys(object_), lambda name: name.isin(struct.names))
    return F.size(own) == F.size(F.array_distinct(own))


def _without_other_fields(text: Column) -> Column:
    """The text of an object with the event's fields alone, or NULL.

    Given for records in which the parser met a repeated name, and sealed like there. A map read from
    JSON keeps repeated names, which tells whether one of the event's own is among them, and a struct
    takes the event's fields whatever else there is. The minor units must be an integer, which stays
    the same as text, or missing; any record that gives NULL here is malformed.
    """
    seal = F.xxhash64("value").cast("string")
    sealed = F.concat(F.lit("["), text, F.lit(',{"seal":'), seal, F.lit("}]"))
    objects = F.from_json(sealed, "array<map<string, string>>", _STRICT)
    event, end = F.get(objects, F.lit(0)), F.get(objects, F.lit(1))
    is_sealed = (F.size(objects) == 2) & (F.map_keys(end) == F.array(F.lit("seal")))
    is_sealed = is_sealed & (F.get(F.map_values(end), F.lit(0)) == seal)
    def given(name: str) -> Column:
        return F.get(F.map_values(event), F.array_position(F.map_keys(event), name).cast("int") - 1)

    amount = F.from_json(given("amount"), "map<string, string>", _STRICT)
    distinct = _are_distinct(event, S.PAYMENT_EVENT) & F.coalesce(_are_distinct(amount, S.MONEY), F.lit(True))
    money_fields = ", ".join(f"{name}: variant" for name in S.MONEY.names)
    fields = ", ".join(
        f"{name}: struct<{money_fields}>" if name == "amount" else f"{name}: variant" for name in S.PAYMENT_EVENT.names
    )
    own = F.get(F.from_json(sealed, f"array<struct<{fields}>>", _STRICT), F.lit(0))
    units = F.schema_of_variant(own["amount"]["minor_units"])
    is_whole = F.coalesce(units.isin("BIGINT", "VOID"), F.lit(True))
    for name in S.PAYMENT_EVENT.names:  # a value that its type does not take would be missing here
        is_whole = is_whole & (given(name).isNull() | own[name].isNotNull())
    return F.when(is_sealed & distinct & is_whole, F.to_json(own))


def _type(path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("doc", path, "variant"))


def _shape_reason() -> Column:
    """Why the parsed document does not have the shape of an event; NULL if it has."""

    def is_missing(path):
        return F.coalesce(_type(f"$[0].{path}") == "VOID", F.lit(True))

    is_sealed = F.coalesce(
        (F.try_variant_get("doc", "$[1]", "bigint") == F.xxhash64("value"))
        & F.try_variant_get("doc", "$[2]", "variant").isNull(),
        F.lit(False),
    )
    units = "amount.minor_units"
    # A negative zero is no integer, but a parser takes it for one.
    is_zero = F.coalesce(F.try_variant_get("doc", f"$[0].{units}", "bigint") == 0, F.lit(False))
    negative_zero = is_zero & F.col("value").cast("string").rlike(_NEGATIVE_ZERO)
    units_unfit = ~is_missing(units) & (_type(f"$[0].{units}") != "BIGINT") | negative_zero
    amount_unfit = ~is_missing("amount") & ~_type("$[0].amount").startswith("OBJECT")
    missing = is_missing(units)
    for path in _LEAVES:
        missing = missing | is_missing(path)
    return (
        F.when(F.col("value").isNull(), "tombstone")
        .when(~is_sealed, "malformed")
        .when(~_type("$[0]").startswith("OBJECT"), "malformed")
        .when(amount_unfit | units_unfit, "malformed")
        .when(missing, "missing_field")
        .when(_type("$[0].account") != "STRING", "wrong_type")
        .when(_type("$[0].payment_id") != "STRING", "bad_uuid")
    )


def _value_reason() -> Column:
    """Why the fields of a well-shaped event are not acceptable; NULL if they are.

    Values of other types are text here, and no number or object spells an enum or a time.
    """
    known = (
        F.col("event.direction").isin(S.DIRECTIONS)
        & F.col("event.status").isin(S.STATUSES)
        & F.col("event.amount.currency").isin(S.CURRENCIES)
    )
    return F.when(~is_uuid(F.col("event.payment_id")), "bad_uuid").when(~known, "unknown_enum")


def decode(records: DataFrame) -> DataFrame:
    """Every record with its event fields and ``reject_reason``, NULL for a good record.

    A parser stops at the end of the first JSON document and ignores what follows. The value is
    therefore parsed as the first element of an array that a hash of the value closes: anything
    between the object and the end of the value breaks the array or moves the hash.
    """
    carried = [name for name in records.columns if name not in S.PAYMENT_EVENT.fieldNames()]
    text = F.col("value").cast("string")
    is_text = F.is_valid_utf8(text)
    parts = F.when(is_text & text.rlike(_usual_layout()), F.split(text, '"'))

    def sealed(event: Column) -> Column:
        return F.concat(F.lit("["), event, F.lit(","), F.xxhash64("value").cast("string"), F.lit("]"))

    is_usual = F.col("parts").isNotNull()
    parsed = F.coalesce(F.try_parse_json(sealed(text)), F.try_parse_json(sealed(_without_other_fields(text))))
    doc = F.when(~is_usual & is_text, parsed)
    parsed_fields = F.try_variant_get("doc", "$[0]", _TEXT_FORM)
    reject_reason = F.coalesce(
        "shape_reason",
        F.when(~F.col("is_usual"), _value_reason()),
        F.when(F.col("occurred_at").isNull(), "bad_timestamp"),
    )
    return (
        records.select(*carried, _once(parts.alias("parts")))
        .select(*carried, "parts", _once(doc.alias("doc")))
        .select(
            *carried,
            _once(
                F.when(~is_usual, _shape_reason()).alias("shape_reason"),
                F.when(is_usual, _usual_fields()).otherwise(parsed_fields).alias("event"),
                is_usual.alias("is_usual"),
            ),
        )
        .select("*", _once(parse_rfc3339(F.col("event.occurred_at")).alias("occurred_at")))
        .select(
            *carried,
            canonical_uuid(F.col("event.payment_id")).alias("payment_id"),
            "event.direction",
            "event.account",
            "event.amount",
            "event.status",
            "occurred_at",
            reject_reason.alias("reject_reason"),
        )
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")


def events_only(decoded: DataFrame) -> DataFrame:
    """The good records as plain payment events."""
    return accepted(decoded).select(*S.PAYMENT_EVENT.fieldNames())


def rejected(decoded: DataFrame) -> DataFrame:
    """Poison records for the quarantine. A record without a value is no poison: it is skipped."""
    reason = F.col("reject_reason")
    return decoded.where(reason.isNotNull() & (reason != "tombstone"))


def without_tombstones(records: DataFrame) -> DataFrame:
    return records.where(F.col("value").isNotNull())
