"""Money arithmetic.

Adding amounts as doubles gives a result that depends on the order in which
rows arrive, so sums are taken in ``DECIMAL(28,8)`` and rounded once, at the
end. A value that such a decimal cannot hold (NaN, an infinity, 1e20 or more)
is added as a double instead: nothing is left out, no cell ends a job, and an
infinite amount gives an infinite total. Averages are that sum by the count.

Every expression here is SQL text, so that the DataFrame form and the SQL form
of a figure are the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_TYPE = "DECIMAL(28,8)"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_text(c: str) -> str:
    """``c`` as a decimal, or NULL where that type cannot hold it."""
    return f"TRY_CAST({c} AS {EXACT_TYPE})"


def rest_text(c: str) -> str:
    """``c`` as a double where it is no such decimal, else NULL."""
    return f"CASE WHEN {exact_text(c)} IS NULL THEN CAST({c} AS DOUBLE) END"


def total_text(exact: str, rest: str, digits: int | None = None) -> str:
    """The sum of a column given by its two parts."""
    whole = f"SUM({exact})" if digits is None else f"ROUND(SUM({exact}), {digits})"
    return f"CASE WHEN SUM({rest}) IS NULL THEN CAST({whole} AS DOUBLE) ELSE COALESCE(CAST(SUM({exact}) AS DOUBLE), 0D) + SUM({rest}) END"


def mean_text(exact: str, rest: str, digits: int) -> str:
    return f"ROUND(TRY_DIVIDE({total_text(exact, rest)}, COUNT({exact}) + COUNT({rest})), {digits})"


def sum_text(c: str, digits: int | None = None) -> str:
    """The sum of ``c`` as a double, exact before it is rounded; NULL without values."""
    return total_text(exact_text(c), rest_text(c), digits)


def avg_text(c: str, digits: int) -> str:
    """The average of ``c``, from the same sum."""
    return f"ROUND(TRY_DIVIDE({sum_text(c)}, COUNT({c})), {digits})"


def money_sum(c: str) -> Column:
    return F.expr(sum_text(c, 2))


def rounded_avg(c: str, digits: int) -> Column:
    return F.expr(avg_text(c, digits))


def money_text(c: str | Column) -> Column:
    """Two decimals, never scientific notation; a value beyond 36 digits, NaN and infinities as Spark prints them."""
    return F.coalesce(F.round(col_of(c).try_cast("decimal(38,4)"), 2).cast("decimal(38,2)").cast("string"), col_of(c).cast("string"))
