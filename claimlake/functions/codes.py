"""Column -> Column helpers. All built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_code(c: ColumnOrName, width: int = 11, fallback: ColumnOrName | None = None) -> Column:
    """Repair a product code to ``width`` characters.

    One character too long -> drop the first character; shorter -> left-pad
    with zeros; otherwise keep the code (or ``fallback`` when given, which
    reproduces the claims-side variant that takes the joined lookup code).
    NULL stays NULL.
    """
    c = _c(c)
    other = c if fallback is None else _c(fallback)
    n = F.length(c)
    return (
        F.when(n == width + 1, F.substring(c, 2, width))
        .when(n < width, F.lpad(c, width, "0"))
        .otherwise(other)
    )


def invalid_length(c: ColumnOrName, width: int) -> Column:
    """True where the code has another length; NULL (not counted) for NULL codes."""
    return F.length(_c(c)) != width


def safe_cast(c: ColumnOrName, dtype: T.DataType | str) -> Column:
    """Cast that yields NULL on malformed input whatever the ANSI setting is."""
    return _c(c).try_cast(dtype)


def merge_flag(key: ColumnOrName) -> Column:
    """1 where a left join found a partner (right key not NULL), else 0."""
    return F.when(_c(key).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def null_label(c: ColumnOrName, label: str) -> Column:
    """Replace NULL by a label for reporting."""
    return F.coalesce(_c(c), F.lit(label))


def differs_or_null(c: ColumnOrName, value) -> Column:
    """``c != value OR c IS NULL`` as one null-safe predicate."""
    return ~_c(c).eqNullSafe(F.lit(value))


def in_or_null(c: ColumnOrName, values: Iterable) -> Column:
    """``c IN values OR c IS NULL``."""
    c = _c(c)
    return c.isin(list(values)) | c.isNull()


def remove_thousands(c: ColumnOrName) -> Column:
    """"12,345" -> "12345" (plain literal replace, no regex engine needed)."""
    return F.replace(_c(c), F.lit(","), F.lit(""))


def ratio_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """round(num / den * 100, digits); NULL when den is 0 or NULL."""
    return F.round(F.try_divide(_c(num), _c(den)) * F.lit(100), digits)
