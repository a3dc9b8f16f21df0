"""Enum names: allowed sets, declaration order and display form."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordinal(name: Column, declared: list[str]) -> Column:
    """Zero-based declaration order; NULL for a name that is not declared."""
    position = F.array_position(F.array(*[F.lit(n) for n in declared]), name)
    return F.nullif(position, F.lit(0).cast("bigint")) - 1


def display_name(wire_name: Column) -> Column:
    """``COMPLIANCE_APPROVED`` becomes ``ComplianceApproved``."""
    words = F.initcap(F.replace(F.lower(wire_name), F.lit("_"), F.lit(" ")))
    return F.replace(words, F.lit(" "), F.lit(""))
