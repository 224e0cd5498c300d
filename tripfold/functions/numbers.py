"""Rounding, safe ratios and banding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Grain:
    """How measures are summed so that no order of the summands shows: as fixed-point numbers.

    A value counts to ``digits`` digits after the point, rounded once, if it is below
    10^(18 - digits); larger ones, NaN and infinity are added as doubles beside it. The
    fixed-point number is a bigint of two limbs, ``LIMB`` low bits and the rest, which are
    summed apart and joined once a group. The low sums hold 10^12 rows.
    """

    digits: int

    @property
    def unit(self) -> float:
        return 10.0**self.digits

    @property
    def below(self) -> float:
        return 10.0 ** (18 - self.digits)

    @property
    def whole(self) -> str:
        """Type of a joined total in units, as wide as leaves room for the digits."""
        return f"decimal({37 - self.digits},0)"


LIMB = 22
MONEY = Grain(6)  # amounts below 10^12
MEASURE = Grain(12)  # computed distances, speeds and ratios below 10^6


def rounded(value: Column, scale: int) -> Column:
    """Round half up, once, the decimal digits a double stands for; NaN and infinity stay."""
    return F.round(value.cast("double"), scale)


def fixed_point(value: Column, grain: Grain = MONEY) -> Column:
    """The value in units of the last digit; null if it has no such form."""
    held = value.cast("double")
    return F.when(F.abs(held) < grain.below, F.rint(held * grain.unit).cast("bigint"))


def sum_parts(value: Column, grain: Grain = MONEY) -> dict[str, Column]:
    """Aggregates that add up to a sum: high limbs, low limbs, and what has no fixed-point form."""
    number = fixed_point(value, grain)
    return {
        "high": F.sum(F.shiftright(number, LIMB)),
        "low": F.sum(number.bitwiseAND((1 << LIMB) - 1)),
        "odd": F.sum(F.when(number.isNull(), value.cast("double"))),
    }


def joined_sum(high: Column, low: Column, odd: Column, grain: Grain = MONEY) -> Column:
    """Total of the parts as a double; null if there are none."""
    units = (high.cast("decimal(20,0)") * (1 << LIMB) + low).cast(grain.whole)
    total = (units * F.lit(Decimal(1).scaleb(-grain.digits))).cast("double")
    return F.when(odd.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + odd)


def exact_sum(value: Column, grain: Grain = MONEY) -> Column:
    """Sum as a double, exact to the digits of the grain, however the rows are spread over tasks."""
    return joined_sum(**sum_parts(value, grain), grain=grain)


def exact_avg(value: Column, grain: Grain = MONEY) -> Column:
    return ratio(exact_sum(value, grain), F.count(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Divide as doubles; null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    return rounded(ratio(part, whole) * 100, scale)


def percent_change(before: Column, after: Column, scale: int = 2) -> Column:
    return rounded(ratio((after - before) * 100, before), scale)


def banded(value: Column, upper_bounds: Sequence[tuple[float, str]], last: str) -> Column:
    """Label a value by the first exclusive upper bound above it."""
    (first_bound, first_label), *others = upper_bounds
    label = F.when(value < first_bound, first_label)
    for bound, name in others:
        label = label.when(value < bound, name)
    return label.otherwise(last)


def unit_bucket(value: Column) -> Column:
    """Integer histogram bucket of width one."""
    return F.floor(value)


def optional_amount(frame: DataFrame, name: str) -> Column:
    """Amount column with null as zero; zero too when the frame lacks the column.

    Names compare without regard to case, as Spark resolves them.
    """
    present = {existing.lower() for existing in frame.columns}
    if name.lower() not in present:
        return F.lit(0.0)
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
