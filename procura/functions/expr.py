"""Expression helpers shared by operators and reports.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_lit(as_of: str | _dt.datetime) -> Column:
    """The report's fixed "now" as a ``timestamp_ntz`` literal.

    Reports take one as-of instant instead of reading the wall clock so a
    rerun (or a retried task) gives the same rows.
    """
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(as_of).cast("timestamp_ntz")


def day(x: ColumnOrName) -> Column:
    """Truncate a timestamp to midnight, keeping ``timestamp_ntz``."""
    return F.date_trunc("DAY", _c(x)).cast("timestamp_ntz")


def typed_null(name: str, dtype: DataType | str) -> Column:
    """A NULL column of a fixed type (pads a report branch, never ``void``)."""
    return F.lit(None).cast(dtype).alias(name)


def concat_code(cols: Sequence[ColumnOrName], sep: str = ".") -> Column:
    """Join segments with ``sep`` where NULL counts as empty text.

    Separators always stay, so all-NULL segments give ``sep * (n-1)``; this
    is neither ``concat`` (NULL-poisoning) nor ``concat_ws`` (drops
    separators).
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.concat(*parts)


def convert_amount(amount: ColumnOrName, rate: ColumnOrName, dtype: str = "decimal(28,6)") -> Column:
    """Currency conversion: rate NULL or 0 leaves the amount unchanged,
    any other rate multiplies it. The result is re-cast to ``dtype``."""
    amount, rate = _c(amount), _c(rate)
    return (
        F.when(F.coalesce(rate, F.lit(0)) == 0, amount)
        .otherwise(amount * rate)
        .cast(dtype)
    )


def flag_is(col: ColumnOrName, value: str, null_as: str) -> Column:
    """``coalesce(col, null_as) == value``: one explicit NULL policy per flag."""
    return F.coalesce(_c(col), F.lit(null_as)) == F.lit(value)


def effective_on(at: ColumnOrName, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Inclusive validity test ``start <= at <= end`` (NULL bound → false)."""
    at = _c(at)
    return (at >= _c(start)) & (at <= _c(end))


def open_interval_on(at: ColumnOrName, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Validity test where a NULL bound means "open"; all three are compared
    at day precision (midnight)."""
    at = day(at)
    return (at >= day(F.coalesce(_c(start), at))) & (at <= day(F.coalesce(_c(end), at)))


def decode(col: ColumnOrName, pairs: Iterable[tuple[object, object]], default: object = None) -> Column:
    """Searched mapping ``value -> result``; unmatched values give ``default``
    (NULL when omitted). A NULL input matches a NULL search value."""
    col = _c(col)
    expr = None
    for search, result in pairs:
        cond = col.isNull() if search is None else (col == F.lit(search))
        expr = F.when(cond, F.lit(result)) if expr is None else expr.when(cond, F.lit(result))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def norm_text(col: ColumnOrName) -> Column:
    """``upper(trim(x))`` with blank text treated as NULL, for use as an
    equi-join key."""
    return F.upper(F.nullif(F.trim(_c(col)), F.lit("")))


def num_key(col: ColumnOrName) -> Column:
    """Text holding a number, compared with a numeric key: lenient
    ``try_cast`` to bigint (junk → NULL instead of a runtime error)."""
    return _c(col).try_cast("bigint")
