"""Money arithmetic that gives the same digits in every engine.

Rules (see SURVEY 2.13):

* money is ``DECIMAL(12,2)``, a discount percentage ``DECIMAL(5,2)``;
* sums are exact and do not depend on the order rows arrive in (a double
  sum would);
* a discount is applied by multiplying with ``0.01`` as a decimal, never by
  a decimal division (exact, and engines disagree on decimal division);
* ratios are computed in double from exact sums;
* rounding goes through ``DECIMAL(28,8)`` and rounds half away from zero.

Fast exact sums.  A Spark ``SUM`` over a wide DECIMAL keeps a BigDecimal
buffer that is (de)serialised on every update; on order lines that is most
of the query time.  ``sum_gross`` / ``sum_net`` / ... instead turn each line
into an integer number of minor units (cents, or millionths for discounted
amounts), sum the high and the low 20 bits as two ``LONG`` sums and put the
exact DECIMAL back together once per group.  Exact while a group has fewer
than 2**43 lines and every line is below 2**62 minor units; beyond that
ANSI arithmetic raises instead of returning a wrong number.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(12, 2)
PCT = DecimalType(5, 2)
_ROUNDING = DecimalType(28, 8)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_LOW_BITS = 20
_LOW_MASK = (1 << _LOW_BITS) - 1


def minor_units(c: Column | str, scale: int = 2) -> Column:
    """A number as LONG units of ``10 ** -scale`` (cents for money); digits beyond
    that are rounded half away from zero, never cut off."""
    return F.round(_c(c) * F.lit(10 ** scale), 0).cast("long")


def exact_sum(units: Column, scale: int) -> Column:
    """Aggregate: exact SUM of LONG minor units, as DECIMAL(38, scale)."""
    hi = F.sum(F.shiftright(units, _LOW_BITS))
    lo = F.sum(units.bitwiseAND(F.lit(_LOW_MASK)))
    return halves(hi, lo, scale)


def halves(hi: Column, lo: Column, scale: int) -> Column:
    """DECIMAL(38, scale) of the sums of the high bits and of the low 20 bits of minor units."""
    whole = (hi.cast(DecimalType(38, 0)) * F.lit(1 << _LOW_BITS).cast(DecimalType(38, 0))
             + lo.cast(DecimalType(38, 0)))
    return (whole * F.lit(Decimal(1).scaleb(-scale))).cast(DecimalType(38, scale))


def _q(quantity: Column | str) -> Column:
    return _c(quantity).cast("long")


def sum_gross(quantity="quantity", unit_price="unit_price") -> Column:
    """SUM(quantity * unit_price), exact, DECIMAL(38,2)."""
    return exact_sum(_q(quantity) * minor_units(unit_price), 2)


def sum_net(quantity="quantity", unit_price="unit_price", discount_pct="discount_pct") -> Column:
    """SUM(quantity * unit_price * (1 - discount_pct / 100)), exact, DECIMAL(38,6)."""
    return exact_sum(_q(quantity) * minor_units(unit_price)
                     * (F.lit(10000) - minor_units(discount_pct)), 6)


def sum_discount(quantity="quantity", unit_price="unit_price",
                 discount_pct="discount_pct") -> Column:
    """SUM(quantity * unit_price * discount_pct / 100), exact, DECIMAL(38,6)."""
    return exact_sum(_q(quantity) * minor_units(unit_price) * minor_units(discount_pct), 6)


def sum_cost(quantity="quantity", cost_price="cost_price") -> Column:
    """SUM(quantity * cost_price), exact, DECIMAL(38,2)."""
    return exact_sum(_q(quantity) * minor_units(cost_price), 2)


def round_to(c: Column | str, digits: int) -> Column:
    """ROUND(x, digits), half away from zero, on a decimal representation."""
    return F.round(_c(c).cast(_ROUNDING), digits)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator in double; NULL (not an error) when it is 0."""
    return _c(numerator).cast("double") / F.nullif(_c(denominator).cast("double"), F.lit(0.0))


def avg_of(c: Column | str) -> Column:
    """AVG(x) as double sum / count of non-null values (aggregate expression)."""
    x = _c(c)
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0)).cast("double")


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Report form: every DECIMAL column as DOUBLE, names and order kept."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, DecimalType):
            cols.append(F.col(field.name).cast("double").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)
