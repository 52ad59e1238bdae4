"""Exact decimal arithmetic for averages, ratios and percent changes.

The marts round quotients to 2 decimals.  Dividing a decimal by a count in Spark
keeps only 6 fractional digits once precision hits 38, so ``round(sum / n, 2)``
rounds twice and goes wrong whenever the true quotient lies within 5e-7 below a
half-cent -- which happens once groups exceed ~10^4 rows.  Here the quotient is
rounded once, exactly, with integer arithmetic on ``decimal(38,0)``:

    N = num * 10^k  (an integer),  D = den * 10^(k - scale)
    q, r = N quot D, N rem D;   result = (q + sign(N) * [2|r| >= |D|]) / 10^scale

i.e. round half away from zero, the warehouse's numeric rounding.  Everything is a
built-in expression, so aggregates using it still run partial (map-side) aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgelake.functions._col import col

_INT = "decimal(38,0)"


def round_ratio(num, den, scale: int = 2, num_scale: int = 2) -> Column:
    """``round(num / nullif(den, 0), scale)`` computed exactly.

    ``num`` holds at most ``num_scale`` fractional digits; ``den`` is integral.
    Null when ``den`` is null or zero, or ``num`` is null.
    """
    k = max(scale, num_scale)
    n = (col(num) * F.lit(10 ** k)).cast(_INT)
    d = (F.nullif(col(den), F.lit(0)).cast(_INT) * F.lit(10 ** (k - scale))).cast(_INT)
    r = n % d
    q = ((n - r) / d).cast(_INT)
    bump = F.when(F.abs(r) * 2 >= F.abs(d), F.when(n < 0, F.lit(-1)).otherwise(F.lit(1))).otherwise(F.lit(0))
    return ((q + bump) / F.lit(10 ** scale)).cast(f"decimal(38,{scale})")


def cents(x, scale: int = 2) -> Column:
    """A decimal of ``scale`` fractional digits as a whole number of its smallest units."""
    return (col(x) * F.lit(10 ** scale)).cast("bigint")


def from_cents(x, scale: int = 2) -> Column:
    """The decimal that ``cents`` came from."""
    return (col(x).cast(_INT) * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def cents_ratio(num, den, scale: int = 2) -> Column:
    """``round(num / nullif(den, 0), scale)`` of a whole number of cents ``num``."""
    return from_cents(round_ratio(col(num).cast(_INT), den, scale=0, num_scale=0), scale)


def mean_cents(total, n) -> Column:
    """``total / n`` in whole cents, half away from zero, for sums that fit a long; null when ``n`` is 0."""
    t, d = col(total), F.nullif(col(n), F.lit(0))
    half_up = F.call_function("div", F.abs(t) * 2 + d, d * 2)
    return F.when(t < 0, -half_up).otherwise(half_up)


def avg_exact(x, scale: int = 2, num_scale: int = 2, where=None) -> Column:
    """``round(avg(x) [filter (where cond)], scale)`` as an aggregate expression.

    Like ``avg`` it ignores null inputs; null when no input qualifies.
    """
    v = col(x) if where is None else F.when(where, col(x))
    return round_ratio(F.sum(v), F.count(v), scale=scale, num_scale=num_scale)


def ratio_pct(part, whole, scale: int = 2) -> Column:
    """``round(100.0 * part / nullif(whole, 0), scale)`` for integral counts."""
    return round_ratio(col(part).cast(_INT) * F.lit(100), whole, scale=scale, num_scale=0)


def pct_change(current, previous, scale: int = 2) -> Column:
    """``round(100.0 * (current - previous) / nullif(previous, 0), scale)``."""
    return round_ratio((col(current).cast(_INT) - col(previous).cast(_INT)) * F.lit(100),
                       previous, scale=scale, num_scale=0)
