"""Text fragments shared by the SQL variants, built from the same parameters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from tripfold.functions.clock import LAST_TIME_BAND, TIME_BANDS
from tripfold.functions.money import DISTANCE_BUCKETS, LAST_DISTANCE_BUCKET
from tripfold.functions.numbers import LIMB, MONEY, Grain
from tripfold.params import SpecialZones, TripWindow
from tripfold.schemas import SURCHARGES


def predicate(window: TripWindow) -> str:
    tests = [f"{name} > 0" for name in window.positive]
    if window.days is not None:
        tests.append(f"pickup_day IN ({listed(window.days)})")
    if window.hours is not None:
        tests.append(f"pickup_hour IN ({listed(window.hours)})")
    return " AND ".join(tests) or "true"


def listed(values: Sequence[int]) -> str:
    return ", ".join(str(int(value)) for value in values)


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    return f"{float(value)!r}D"


def sum_parts(name: str, grain: Grain = MONEY) -> dict[str, str]:
    """Aggregates of a column that add up to its sum: high and low limbs, and the rest."""
    number = f"if(abs({name}) < {double(grain.below)}, bigint(rint({name} * {double(grain.unit)})), NULL)"
    return {
        "high": f"sum(shiftright({number}, {LIMB}))",
        "low": f"sum({number} & {(1 << LIMB) - 1})",
        "odd": f"sum(if({number} IS NULL, double({name}), NULL))",
    }


def joined_sum(high: str, low: str, odd: str, grain: Grain = MONEY) -> str:
    units = f"cast(cast({high} AS decimal(20,0)) * {1 << LIMB} + {low} AS {grain.whole})"
    total = f"double({units} * 0.{'0' * (grain.digits - 1)}1BD)"
    return f"if({odd} IS NULL, {total}, coalesce({total}, 0e0) + {odd})"


def exact_sum(name: str, grain: Grain = MONEY) -> str:
    """Sum of a column as a double, whatever order its rows come in."""
    return joined_sum(**sum_parts(name, grain), grain=grain)


def partials(names: Sequence[str], grain: Grain = MONEY) -> str:
    """The parts of exact sums as columns of a group."""
    return ", ".join(
        f"{total} AS {name}__{part}" for name in names for part, total in sum_parts(name, grain).items()
    )


def merged_sum(name: str, grain: Grain = MONEY) -> str:
    return joined_sum(*(f"sum({name}__{part})" for part in ("high", "low", "odd")), grain)


def exact_avg(name: str, grain: Grain = MONEY) -> str:
    return f"try_divide({exact_sum(name, grain)}, count({name}))"


def exact(value: str, grain: Grain = MONEY) -> str:
    """An expression with the sums and averages of plain columns in it made exact."""
    forms = {"sum": exact_sum, "avg": exact_avg}
    return re.sub(r"\b(sum|avg)\((\w+)\)(?!\s*OVER)", lambda m: forms[m[1]](m[2], grain), value)


def measured(value: str, scale: int) -> str:
    return rounded(exact(value), scale)


def rounded(value: str, scale: int) -> str:
    return f"round(cast({value} AS double), {scale})"


def banded(value: str, upper_bounds: Sequence[tuple[float, str]], last: str) -> str:
    steps = " ".join(f"WHEN {value} < {bound} THEN '{label}'" for bound, label in upper_bounds)
    return f"CASE {steps} ELSE '{last}' END"


def time_band(hour: str) -> str:
    return banded(hour, TIME_BANDS, LAST_TIME_BAND)


def distance_bucket(miles: str) -> str:
    return f"if({miles} IS NULL, NULL, {banded(miles, DISTANCE_BUCKETS, LAST_DISTANCE_BUCKET)})"


def surcharge_total(columns: Sequence[str]) -> str:
    present = {name.lower() for name in columns}
    terms = [f"coalesce({name}, 0e0)" for name in SURCHARGES if name in present]
    return " + ".join(terms) or "0e0"


def special(alias: str, rule: SpecialZones) -> str:
    boroughs = ", ".join(quoted(name) for name in rule.boroughs)
    return (
        f"(coalesce(lower({alias}.zone) RLIKE {quoted(rule.pattern)}, false)"
        f" OR coalesce({alias}.borough IN ({boroughs}), false))"
    )
