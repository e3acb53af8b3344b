"""Column expressions: exact money sums, guarded ratios, months and label bands.

Everything here is a native Catalyst expression, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.window import WindowSpec

# Money is summed as whole ten-thousandths in a BIGINT: exact, independent of the
# order in which partitions arrive, and as cheap as a long addition.
UNITS = 10_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(amount: str | Column, scale: int = UNITS) -> Column:
    """Amount in whole ``1/scale`` as BIGINT; NULL for NULL.

    NaN, infinity and amounts beyond 63 bits fail the query: a sum that left them out would
    look right. Finer fractions than ``1/scale`` are rounded row by row; such columns need a
    larger ``scale``.
    """
    scaled = F.rint(col(amount).cast("double") * F.lit(scale))
    misfit = F.concat(F.lit("amount does not fit whole units: "), scaled.cast("string"))
    whole = scaled.try_cast("bigint")
    return F.when(scaled.isNull() | whole.isNotNull(), whole).otherwise(F.raise_error(misfit).cast("bigint"))


def total(amount: str | Column, over: WindowSpec | None = None, scale: int = UNITS) -> Column:
    """Order-independent sum of a column with a fixed number of decimals, as double."""
    s = F.sum(units(amount, scale))
    if over is not None:
        s = s.over(over)
    return s / F.lit(float(scale))


def mean(
    amount: str | Column, over: WindowSpec | None = None, scale: int = UNITS
) -> Column:
    """Order-independent average of a column with a fixed number of decimals, as double."""
    s, n = F.sum(units(amount, scale)), F.count(col(amount))  # units are NULL for NULL alone
    if over is not None:
        s, n = s.over(over), n.over(over)
    return F.try_divide(s / F.lit(float(scale)), n)


def dollars(cents: str | Column) -> Column:
    """Whole cents in dollars; the division already gives the double nearest to two digits."""
    return col(cents) / F.lit(100.0)


def cents(amount: str | Column) -> Column:
    return F.rint(col(amount) * F.lit(100)).cast("bigint")


def pct_of_base(part: Column, base: Column) -> Column:
    """``part / base * 100``; a zero or NULL base counts as 1."""
    return part / F.when(base != 0, base).otherwise(F.lit(1.0)) * F.lit(100.0)


def positive_ratio(num: Column, den: Column, digits: int) -> Column:
    """Rounded ``num / den`` where ``den > 0``, NULL elsewhere."""
    return F.when(den > 0, F.round(F.try_divide(num, den), digits))


def band(value: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first step, from the highest down, that ``value`` reaches."""
    (top, label), *rest = sorted(steps, reverse=True)
    out = F.when(value >= top, F.lit(label))
    for floor, name in rest:
        out = out.when(value >= floor, F.lit(name))
    return out.otherwise(F.lit(default))


# --- months ------------------------------------------------------------------
# A period is the string 'yyyy-MM': it sorts by time and partitions directories. Periods are
# computed as integers; formatting and parsing dates per row costs several times as much.


def _text(year: Column, month: Column) -> Column:
    endings = F.elt(month, *[F.lit(f"-{m:02d}") for m in range(1, 13)])
    return F.concat(year.cast("string"), endings)


def period_text(months: Column) -> Column:
    """Period of a month number (four-digit years)."""
    return _text(F.floor(months / 12), months % 12 + 1)


def period_of(moment: str | Column) -> Column:
    day = F.to_date(col(moment))
    return _text(F.year(day), F.month(day))


def month_number(period: str | Column) -> Column:
    """Months since year 0, so that periods can be subtracted as integers."""
    p = col(period)
    return F.substring(p, 1, 4).cast("int") * 12 + F.substring(p, 6, 2).cast("int") - 1


def one_value(one_row, column: str) -> Column:
    """The single value of a one-row aggregate as a scalar subquery.

    Spark runs it once and embeds the value; nothing passes through Python.
    """
    return one_row.select(column).scalar()
