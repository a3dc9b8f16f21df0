"""The explainable risk score."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitscope import schema as S
from remitscope.functions.money import magnitude_at_least

AMOUNT_BANDS = (
    (S.LARGE_AMOUNT_MINOR, S.LARGE_AMOUNT_POINTS),
    (S.MEDIUM_AMOUNT_MINOR, S.MEDIUM_AMOUNT_POINTS),
)


def risk_score(
    direction: Column, minor_units: Column, bands=AMOUNT_BANDS
) -> Column:
    """Points of the first band reached, plus the pay-out points, at most 100.

    ``bands`` lists (magnitude, points) from the largest magnitude down.
    """
    amount_points = F.lit(0)
    for bound, points in reversed(bands):
        amount_points = F.when(
            magnitude_at_least(minor_units, bound), F.lit(points)
        ).otherwise(amount_points)
    direction_points = F.when(direction == "PAY_OUT", S.PAY_OUT_POINTS).otherwise(0)
    return F.least(F.lit(S.MAX_RISK_SCORE), amount_points + direction_points)
