"""Numeric helpers that fix the exact float semantics of the outputs.

* Rounding is half-to-even of ``x * 10**n`` (what ``numpy.round`` does), written as
  ``rint(x * 10**n) / 10**n``; ``F.round`` would round half-up.
* Sums whose operand order matters are folded in a stated order (features of an
  event, buckets of a feature), so repeated runs give the same last bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column | str, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def significant(c: Column | str, digits: int = 10) -> Column:
    """At most ``digits`` significant digits: the stated tolerance when results of two
    engines are compared (a variance near 1e9 has no sixth decimal that does not depend
    on the order of summation).  Operators never use it."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(c))))
    return F.when((c == 0) | c.isNull(), c).otherwise(F.rint(c * scale) / scale)


def is_finite_value(c: Column | str) -> Column:
    """Not null and not NaN (pandas ``dropna`` drops both)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c)


def ordered_sum_expr(arr: str, field: str | None = None) -> str:
    """SQL text: left fold ``((0 + a1) + a2) + ...`` over an array (in order)."""
    x = f"x.{field}" if field else "x"
    return f"aggregate({arr}, CAST(0.0 AS DOUBLE), (acc, x) -> acc + {x})"
