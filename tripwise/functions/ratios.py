"""Exact ratios rounded once, half away from zero, by three routes that agree.

* Whole numbers, and money in cents, that fit 64 bits are divided as such
  (``count_ratio``, ``money_ratio``): no decimal object per row.
* ``half_up_ratio`` divides decimals of moderate precision.  ``a / b`` would be a
  double in Spark; 14 fractional digits in the quotient let the final ``round`` see
  the exact value (a ratio with an integer denominator ``b`` lies either on a
  rounding edge or at least 1/(2*10^s*b) away from it, far above that precision).
* Money of 10^20 and more, up to the 36 whole digits that it is stored with, is
  divided in two limbs of 18 digits (``_by_limbs``): each step keeps its remainder,
  so nothing is rounded before the end and no step needs more than 38 digits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB = 10 ** 18
_WHOLE = "decimal(38,0)"
# below this, 24 whole digits are enough for the quotient
_MODERATE = 1e20


def _lit(n: int) -> Column:
    return F.lit(n).cast(f"decimal({len(str(n))},0)")


def _div(a: Column, b: Column) -> Column:
    """a // b as a bigint, for non-negative numbers."""
    return F.call_function("div", a, b)


def _scaled(units: Column, scale: int) -> Column:
    """A bigint of units of 10^-scale as decimal(38, scale)."""
    return (units.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(38,{scale})")


def half_up_ratio(num: Column, den: Column, scale: int, times: int = 1, num_scale: int = 6) -> Column:
    """round(num * times / den, scale) for an integer-valued ``den``; NULL when den is 0 or NULL.

    ``num`` may carry up to ``num_scale`` fractional digits, and up to 2 from 10^20 on.  There a quotient
    of more than 32 whole digits is NULL; ``money_ratio`` has no such limit.
    """
    d = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))

    def quotient(digits: int, fraction: int) -> Column:
        n = num.cast(f"decimal({digits},{fraction})")
        if times != 1:
            n = (n * F.lit(times).cast("decimal(4,0)")).cast(f"decimal({digits},{fraction})")
        return F.round(F.try_divide(n, d), scale).cast(f"decimal(38,{scale})")

    return (F.when(F.abs(num) < F.lit(_MODERATE), quotient(24 + num_scale, num_scale))
            .otherwise(quotient(38, 2)))


def _of_units(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale) of non-negative bigints."""
    return _scaled(_div(num * F.lit(2 * 10 ** scale) + den, den * F.lit(2)), scale)


def count_ratio(num: Column, den: Column, scale: int) -> Column:
    """``half_up_ratio`` of two bigint counts below 10^(18 - scale); ``den`` must not be 0."""
    return _of_units(num, den, scale)


def _by_limbs(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale) of non-negative decimal(38,2) by a bigint: long division in base 10^18."""
    d = den.cast("decimal(19,0)")
    whole = F.floor(num).cast(_WHOLE)
    cents = ((num % _lit(1)) * _lit(100)).cast("decimal(3,0)")
    high = _div(whole, _lit(_LIMB)).cast("decimal(19,0)")
    rest = ((high % d).cast("decimal(19,0)") * _lit(_LIMB)).cast(_WHOLE) + whole % _lit(_LIMB)
    total = (_div(high, d).cast("decimal(19,0)") * _lit(_LIMB)).cast(_WHOLE) + _div(rest.cast(_WHOLE), d).cast("decimal(19,0)")
    last = ((rest.cast(_WHOLE) % d).cast("decimal(19,0)") * _lit(100) + cents).cast("decimal(22,0)") * _lit(2 * 10 ** scale) + d * _lit(100)
    fraction = _div(last.cast(_WHOLE), (d * _lit(200)).cast("decimal(22,0)"))
    out = f"decimal(38,{scale})"
    # a result that the stored type has no room for (only possible beyond scale 2) is NULL
    return (total.cast(_WHOLE).try_cast(out) + _scaled(fraction, scale)).try_cast(out)


def money_ratio(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale) of non-negative decimal(38,2) money by a bigint count; NULL when den is 0 or NULL."""
    d = F.nullif(den, F.lit(0).cast("bigint"))
    limit = 10 ** (14 - scale)
    cents = (num * F.lit(100).cast("decimal(3,0)")).cast("bigint")
    fits = (num < F.lit(limit).cast("decimal(20,0)")) & (d < limit)
    return (F.when(fits, _of_units(cents, d * F.lit(100), scale))
            .when(num < F.lit(_MODERATE), half_up_ratio(num, d, scale, num_scale=2))
            .otherwise(_by_limbs(num, d, scale)))
