"""UUID text: the accepted spellings, the canonical text and the 16 bytes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_HYPHENATED = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_ACCEPTED = (
    rf"^([0-9a-fA-F]{{32}}|{_HYPHENATED}|\{{{_HYPHENATED}\}}|urn:uuid:{_HYPHENATED})\z"
)

_ANY_SPELLING = r"^.*?([0-9a-f]{8})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{12})}?\z"


def is_uuid(text: Column) -> Column:
    """Plain, hyphenated, braced and URN spellings, in either case."""
    return text.rlike(_ACCEPTED)


def canonical_uuid(text: Column) -> Column:
    """Lower case, hyphenated. The input must satisfy :func:`is_uuid`."""
    low = F.lower(text)
    return F.when(F.length(text) == 36, low).otherwise(
        F.regexp_replace(low, _ANY_SPELLING, F.lit("$1-$2-$3-$4-$5"))
    )


def uuid_bytes(canonical: Column) -> Column:
    """The 16 raw bytes of a canonical UUID: the key of a published record."""
    return F.unhex(F.replace(canonical, F.lit("-"), F.lit("")))
