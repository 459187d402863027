"""Scalar and aggregate column helpers.

Everything here returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen; no Python runs per row.

Rounding. Analyses round means and percentages to two places, half to even.
Rounding a double is fragile (0.125 has an exact binary form, 2.675 does not),
so ``scaled_half_even`` rounds the exact rational ``num / den`` with integer
arithmetic on ``decimal(38,0)``. The result is an exact integer count of
``10**-scale`` units; ``to_scaled_double`` turns it into a double by a single
IEEE division, which any engine computes identically.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT38 = "decimal(38,0)"
_NUM_PLACES = 6


def sum0(c: Column | str) -> Column:
    """Sum that yields 0, not null, when the group has no non-null value."""
    return F.coalesce(F.sum(c), F.lit(0))


def scaled_half_even(num: Column, den: Column, scale: int = 2) -> Column:
    """``round_half_even(num / den * 10**scale)`` as an exact ``decimal(38,0)``.

    ``num`` must be exact (integer or decimal with at most six places) and
    ``den`` an integer. Both are lifted by ``10**6`` so every such ``num``
    becomes an integer. Null or zero ``den`` gives null.
    """
    lift = 10**_NUM_PLACES
    n = (num.cast("decimal(38,6)") * F.lit(lift * 10**scale).cast(_INT38)).cast(_INT38)
    d = den.cast(_INT38) * F.lit(lift).cast(_INT38)
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    an, ad = F.abs(n), F.abs(d)
    r = an % ad
    q = ((an - r) / ad).cast(_INT38)
    twice = r * 2
    bump = (
        F.when(twice > ad, F.lit(1))
        .when(twice == ad, q % 2)
        .otherwise(F.lit(0))
    )
    return F.when(d != 0, (sign * (q + bump)).cast(_INT38))


def to_scaled_double(q: Column, scale: int = 2) -> Column:
    """Exact integer of ``10**-scale`` units to a double."""
    return q.cast("double") / F.lit(float(10**scale))


def ratio_half_even(num: Column, den: Column, scale: int = 2) -> Column:
    """``num / den`` rounded half to even at ``scale`` places, as a double."""
    return to_scaled_double(scaled_half_even(num, den, scale), scale)


def exact_mean(total: Column, count: Column) -> Column:
    """Unrounded mean from an exact sum and a count: one IEEE division."""
    return F.when(count != 0, total.cast("double") / count.cast("double"))


def plain_decimal_string(q: Column, scale: int = 2) -> Column:
    """Render an exact integer of ``10**-scale`` units without trailing zeros.

    ``6667`` -> ``66.67``, ``5000`` -> ``50``, ``5050`` -> ``50.5``. This is the
    shortest decimal text of the rounded value, as a document store prints it.
    ``q`` is referenced several times: pass a column, not a large expression.
    """
    unit = 10**scale
    aq = F.abs(q)
    whole = ((aq - aq % unit) / unit).cast(_INT38).cast("string")
    frac = F.lpad((aq % unit).cast("string"), scale, "0")
    frac = F.regexp_replace(frac, "0+$", "")
    body = F.when(frac == "", whole).otherwise(F.concat(whole, F.lit("."), frac))
    return F.when(q < 0, F.concat(F.lit("-"), body)).otherwise(body)


def guarded_ratio(num: Column, den: Column, when_zero: float | None = 0.0) -> Column:
    """``num / den`` as double; ``when_zero`` if ``den`` is 0, null if null.

    ``try_divide`` keeps ANSI mode from raising on a zero divisor.
    """
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return F.when(den == 0, F.lit(when_zero).cast("double")).otherwise(q)


def match_ci(c: Column | str, pattern: str) -> Column:
    """Case-insensitive regex match, the ``/pattern/i`` of the reference."""
    col = F.col(c) if isinstance(c, str) else c
    p = pattern if pattern.startswith("(?i)") else "(?i)" + pattern
    re.compile(p)  # fail fast on a bad pattern, on the driver
    return col.rlike(p)
