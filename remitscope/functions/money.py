"""Exact money: a currency and a signed count of its minor units, never a float."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitscope.schema import CURRENCY_SCALE


def money(currency: Column, minor_units: Column) -> Column:
    return F.struct(
        currency.alias("currency"), minor_units.cast("bigint").alias("minor_units")
    )


def zero(currency: Column) -> Column:
    return money(currency, F.lit(0))


def is_positive(minor_units: Column) -> Column:
    return minor_units > 0


def minor_unit_scale(currency: Column) -> Column:
    """Decimal places of a currency; NULL for one that is not supported."""
    scale = F.lit(None).cast("int")
    for places in sorted(set(CURRENCY_SCALE.values())):
        names = [name for name, p in CURRENCY_SCALE.items() if p == places]
        scale = F.when(currency.isin(names), F.lit(places)).otherwise(scale)
    return scale


def checked_add(left: Column, right: Column) -> Column:
    """Sum of two money structs. Raises on different currencies and on bigint overflow."""
    mismatch = F.concat(
        F.lit("currency mismatch: expected "),
        left["currency"],
        F.lit(" but got "),
        right["currency"],
    )
    total = money(left["currency"], left["minor_units"] + right["minor_units"])
    return F.when(left["currency"] == right["currency"], total).otherwise(
        F.raise_error(mismatch)
    )


def try_add(left: Column, right: Column) -> Column:
    """Like :func:`checked_add`, but a mismatch gives a NULL ``sum_minor`` and the flag."""
    same = left["currency"] == right["currency"]
    total = F.when(same, left["minor_units"] + right["minor_units"])
    return F.struct(total.alias("sum_minor"), (~same).alias("mismatch"))


def magnitude(minor_units: Column) -> Column:
    """Absolute value that also holds for the smallest bigint, which ``abs`` would reject."""
    return F.abs(minor_units.cast("decimal(38,0)"))


def magnitude_at_least(minor_units: Column, bound: int) -> Column:
    """``|minor_units| >= bound`` on plain bigints, safe for the smallest one."""
    return (minor_units >= bound) | (minor_units <= -bound)


def format_money(currency: Column, minor_units: Column) -> Column:
    """``12.34 USD``. Works on digits, so the smallest bigint needs no wider type.

    The sign is kept below one major unit (``-0.50 USD``), where plain integer division of the
    amount would lose it.
    """
    scale = minor_unit_scale(currency)
    digits = F.ltrim(minor_units.cast("string"), F.lit("-"))
    digits = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
    whole_digits = F.length(digits) - scale
    return F.concat(
        F.when(minor_units < 0, F.lit("-")).otherwise(F.lit("")),
        F.substring(digits, F.lit(1), whole_digits),
        F.lit("."),
        F.substring(digits, whole_digits + 1, scale),
        F.lit(" "),
        currency,
    )
