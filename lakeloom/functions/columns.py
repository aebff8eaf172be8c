"""Column expressions shared by the operators and plans."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- money -----------------------------------------------------------------------------
#
# Amounts are summed in DECIMAL: exact whatever the order of addition, no row is rounded first, and only
# the result is. A sum with more digits than the type has is an error, never a cut or a limit value.
# Prices and shares that are whole cents by definition are handled in cents.

EXACT = "decimal(38,15)"  # what a DOUBLE counts as in a sum: 23 digits before the point, 15 behind
CENTS_LIMIT = 9 * 10**13  # amounts whose cents a DOUBLE still tells apart
WHOLE_LIMIT = 10**7  # amounts whose cents add up in a BIGINT over 9e9 rows
_INFINITY = float("inf")


def _finite(c: Column) -> Column:
    """Whether a value is a number; NULL for NULL. NaN is above every number."""
    return F.abs(c.cast("double")) < F.lit(_INFINITY)


def cents(c: str | Column) -> Column:
    """Amount in whole cents. NaN, Infinity and amounts of more than 9e13 are an error."""
    c = _col(c)
    whole = F.floor(c * 100 + 0.5).cast("bigint")
    fits = F.coalesce(F.abs(c) <= F.lit(CENTS_LIMIT), F.lit(True))
    return F.when(fits, whole).otherwise(F.raise_error(F.concat(F.lit("not an amount in cents: "), c.cast("string"))))


def whole_cents(c: str | Column) -> Column:
    """Whether a DOUBLE is a whole number of cents, of an amount up to ``WHOLE_LIMIT``; NULL for NULL."""
    c = _col(c)
    return (F.abs(c) <= F.lit(WHOLE_LIMIT)) & (F.floor(c * 100 + 0.5).cast("double") / 100.0 == c)


def exact(c: str | Column, kind: str = EXACT) -> Column:
    """Amount as DECIMAL. NaN, Infinity and what ``kind`` has no digits for are an error."""
    c = _col(c)
    wrong = F.raise_error(F.concat(F.lit("not an amount: "), c.cast("string")))
    return F.when(F.coalesce(_finite(c), F.lit(True)), c.cast(kind)).otherwise(wrong)


def exact_type(df: DataFrame, c: str) -> str:
    """The DECIMAL that holds sums of a column: its own scale where it has one."""
    kind = df.schema[c].dataType
    if isinstance(kind, DecimalType):
        return f"decimal(38,{kind.scale})"
    return "decimal(38,0)" if isinstance(kind, IntegralType) else EXACT


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of integers, never by way of DOUBLE."""
    return F.call_function("div", a, b)


def _units(n: Column, unit: int) -> Column:
    """``n / unit`` rounded half away from zero, both integers."""
    if unit == 1:
        return n
    whole = _div(F.abs(n) + unit // 2, F.lit(unit).cast("bigint"))
    return F.when(n < 0, -whole).otherwise(whole)


def amount(n: str | Column, places: int = 2) -> Column:
    """Cents as an amount in DOUBLE with ``places`` (0 to 2) decimals, rounded half up."""
    return _units(_col(n), 10 ** (2 - places)).cast("double") / float(10**places)


def exact_sum(c: str | Column, places: int = 1, kind: str = EXACT) -> Column:
    """Sum of amounts, rounded once at the end; NULLs do not count.

    Amounts count with all digits of ``kind`` (see :func:`exact_type` for columns that are DECIMAL
    already). With NaN among the amounts, or Infinity of both signs, the sum is NaN; with
    Infinity of one sign it is that. A sum that ``kind`` has no digits for is an error.
    """
    c = _col(c)
    finite = _finite(c)
    total = F.sum(F.when(finite, c.cast(kind)))
    return F.coalesce(F.sum(F.when(~finite, c.cast("double"))), F.round(total, places).cast("double"))


def mean_half_up(total: str | Column, n: str | Column, places: int = 1, scale: int = 2) -> Column:
    """``total / n`` rounded half up, ``total`` in units of ``10 ** -scale``; NULL where ``n`` is 0.

    In whole numbers of up to 37 digits, because the rounding of a DOUBLE quotient decides ties by accident.
    """
    total, n = _col(total).cast("decimal(38,0)"), _col(n).cast("decimal(20,0)")
    step = F.lit(Decimal(10 ** (scale - places)))
    up, down = 2 * F.abs(total) + step * n, F.when(n > 0, 2 * step * n)
    # The remainder taken off first, the quotient is whole and no digit is lost.
    steps = ((up - up % down) / down).cast("double")
    return F.when(n > 0, F.signum(total).cast("double") * steps / float(10**places))


def net_cents(price: str | Column, discount: str | Column) -> Column:
    """Price less a fractional discount (whole percent), in cents."""
    return _units(cents(price) * (100 - cents(discount)), 100)


def line_amount(
    price: str | Column, quantity: str | Column, factor: str | Column, discount: str | Column
) -> tuple[Column, Column, Column]:
    """Unit price (price x size factor), discount amount and net amount of an order line.

    All with one decimal place; factor and discount have at most two.
    """
    unit = _units(cents(price) * cents(factor), 1000)
    gross = unit * _col(quantity).cast("bigint")
    off = _units(gross * cents(discount), 100)
    return unit.cast("double") / 10.0, off.cast("double") / 10.0, (gross - off).cast("double") / 10.0


# --- dates and times -------------------------------------------------------------------


def date_key(c: str | Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def calendar_columns(c: str | Column) -> list[Column]:
    """Attributes of a date dimension; weekend is Saturday and Sunday."""
    c = _col(c)
    return [
        date_key(c).alias("date_key"),
        c.cast("date").alias("calendar_date"),
        F.year(c).alias("year"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day"),
        F.date_format(c, "EEEE").alias("day_of_week"),
        F.dayofweek(c).isin(1, 7).alias("is_weekend"),
    ]


def plus_seconds(ts: str | Column, seconds: str | Column) -> Column:
    return _col(ts) + F.make_dt_interval(secs=_col(seconds).cast("decimal(18,6)"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end``, fractions cut off."""
    start, end = _col(start).cast("timestamp"), _col(end).cast("timestamp")
    return ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)).cast("bigint")


def iso_seconds(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")


_WINDOW = re.compile(r"\s*(\d{1,2}):00\s*-\s*(\d{1,2}):00\s*")


def hours_in(windows: Iterable[str]) -> set[int]:
    """Whole hours covered by windows such as ``07:00-09:00``; the end is not included.

    A window whose end is not after its start goes on over midnight: ``22:00-02:00`` has four
    hours. Windows that do not start and end on the hour are refused.
    """
    hours: set[int] = set()
    for window in windows:
        found = _WINDOW.fullmatch(window)
        if not found or max(int(found[1]), int(found[2])) > 24:
            raise ValueError(f"not a window of whole hours: {window!r}")
        start, end = int(found[1]), int(found[2])
        length = end - start if end >= start else end - start + 24
        hours |= {(start + i) % 24 for i in range(length)}
    return hours


def in_hours(ts: str | Column, windows: Iterable[str]) -> Column:
    return F.hour(_col(ts)).isin(*sorted(hours_in(windows)))


# --- text and lookup -------------------------------------------------------------------


def mask_email(c: str | Column, keep: int = 2) -> Column:
    """First ``keep`` characters, ``***@`` and the domain.

    An address without ``@`` gives NULL. A local part shorter than ``keep`` shows the ``@``
    itself (``a@b.c`` becomes ``a@***@b.c``), as the masking rule asks for.
    """
    c = _col(c)
    return F.concat(F.substring(c, 1, keep), F.lit("***@"), F.get(F.split(c, "@"), F.lit(1)))


#: What is masked in free text, in this order, and what stands for it.
TEXT_MASKS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[email]"),
    (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "[ip]"),
    (r"\+?[0-9][0-9 ().-]{7,}[0-9]", "[number]"),
)


def mask_text(c: str | Column) -> Column:
    """Free text, such as a log line, with addresses and long numbers replaced. NULL stays NULL."""
    c = _col(c)
    for pattern, mark in TEXT_MASKS:
        c = F.regexp_replace(c, pattern, mark.replace("[", "\\[").replace("]", "\\]"))
    return c


def padded_id(prefix: str, width: int, c: str | Column) -> Column:
    return F.format_string(f"{prefix}%0{width}d", _col(c).cast("bigint"))


def mapped(c: str | Column, table: Mapping, default) -> Column:
    """Dictionary lookup with a default for missing and NULL keys."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), _col(c)), F.lit(default))
