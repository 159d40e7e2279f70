"""Column-level helpers: every one is a plain Spark expression (codegen'd,
JVM-side).  They encode the NULL, date and text rules of the source SQL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_date", "flag", "null_false", "full_years", "days_between", "iso_date",
    "iso_ts", "iso_ts_local", "scaled_round", "numeric_prefix_int", "pct", "ci_key", "ci_equals",
    "map_label", "in_set", "open_ended", "in_window", "overdue",
    "concat_nonnull", "trim_ts_text", "json_bool_default",
]

# Fixed output formats of the document (values that must match the source).
DATE_FMT = "yyyy-MM-dd"
TS_FMT_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TS_FMT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x) -> Column:
    """A literal or column as DATE (``as_of`` may be a python date or text)."""
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x.strftime("%Y-%m-%d")).cast("date")
    if isinstance(x, str) and len(x) == 10 and x[4] == "-":
        return F.lit(x).cast("date")
    return _c(x).cast("date")


def flag(x) -> Column:
    """``IF(x = 1, TRUE, FALSE)``: 1 is true, anything else including NULL is
    false (P12)."""
    return F.coalesce(_c(x) == F.lit(1), F.lit(False))


def null_false(pred: Column) -> Column:
    """Three-valued predicate → two-valued (NULL → false)."""
    return F.coalesce(pred, F.lit(False))


def full_years(start, end) -> Column:
    """Whole years from ``start`` to ``end`` (``TIMESTAMPDIFF(YEAR, …)``):
    a birthday on Feb 29 is reached on Mar 1 in common years (F1)."""
    return F.timestamp_diff("YEAR", as_date(start).cast("timestamp"),
                           as_date(end).cast("timestamp")).cast("int")


def days_between(later, earlier) -> Column:
    """``DATEDIFF(later, earlier)`` on the date part only (F2)."""
    return F.datediff(as_date(later), as_date(earlier))


def iso_date(x) -> Column:
    return F.date_format(_c(x), DATE_FMT)


def iso_ts(x) -> Column:
    return F.date_format(_c(x), TS_FMT_Z)


def iso_ts_local(x) -> Column:
    return F.date_format(_c(x), TS_FMT)


def numeric_prefix_int(x) -> Column:
    """Integer value of the leading digits of a text, 0 when there are none
    or the text is NULL (``CAST(x AS UNSIGNED)`` of MySQL, F4).  ANSI casts
    raise on bad input, so only digits are ever cast."""
    digits = F.regexp_extract(F.trim(_c(x).cast("string")), r"^[0-9]+", 0)
    return F.coalesce(F.when(digits != "", digits.try_cast("int")), F.lit(0))


def pct(num, den, scale: int = 1) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), scale)`` with exact half-up
    rounding (MySQL DECIMAL semantics: halves away from zero), as double (A7).

    Rounding the binary double ``100*num/den`` would turn 0.285 into 0.28 in
    some engines and 0.29 in others, so the rounding is done on integers:
    ``sign · floor((2·100·10^s·|num| + den) / (2·den))`` with the sign of the
    denominator moved to the numerator; the division-by-zero guard is
    mandatory under ANSI mode."""
    n, d = _c(num).cast("long"), _c(den).cast("long")
    nn = n * F.signum(d).cast("long")          # sign moved to the numerator
    dd = F.abs(d)
    m = 10 ** scale
    a = F.abs(nn) * F.lit(200 * m) + dd        # |2·100·10^s·num| + den
    b = dd * F.lit(2)
    q = ((a - F.pmod(a, b)) / b).cast("long")  # exact floor division of non-negatives
    # half away from zero, as ROUND on DECIMAL
    return F.when(d != 0, F.signum(nn) * q.cast("double") / F.lit(float(m)))


def scaled_round(x, factor: str, scale: int, src: str = "decimal(18,2)") -> Column:
    """``ROUND(x * factor, scale)`` in exact decimal arithmetic (half-up, as
    MySQL DECIMAL), returned as double.  Rounding a binary double directly
    disagrees with decimal engines on values ending in 5."""
    from decimal import Decimal
    return F.round(_c(x).cast(src) * F.lit(Decimal(factor)), scale).cast("double")


def ci_key(x) -> Column:
    """Case-insensitive comparison key."""
    return F.upper(_c(x))


def ci_equals(a, b) -> Column:
    return ci_key(a) == ci_key(b)


def map_label(x, mapping: dict, default=None) -> Column:
    """Simple ``CASE x WHEN k THEN v … ELSE default END`` (F14).  ``default``
    may be a Column (e.g. the raw value)."""
    col = _c(x)
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def in_set(x, values) -> Column:
    """Set membership with NULL → false."""
    return null_false(_c(x).isin(list(values)))


def open_ended(end, as_of) -> Column:
    """``end IS NULL OR end >= as_of``."""
    e = _c(end)
    return e.isNull() | (e >= as_date(as_of))


def in_window(active, inactive, as_of) -> Column:
    """``active <= as_of AND inactive >= as_of`` (P8); NULL bounds fail."""
    a = as_date(as_of)
    return null_false((_c(active).cast("date") <= a) & (_c(inactive).cast("date") >= a))


def overdue(last, as_of, days: int = 365) -> Column:
    """``last IS NULL OR DATEDIFF(as_of, last) > days``."""
    l = _c(last)
    return l.isNull() | (days_between(as_of, l) > F.lit(days))


def concat_nonnull(*cols) -> Column:
    """``CONCAT(COALESCE(a,''), COALESCE(b,''))`` (F8)."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def trim_ts_text(x, n: int = 19) -> Column:
    """``NULLIF(LEFT(x, 19), '')``: drop a zone suffix from text time."""
    return F.nullif(F.left(_c(x).cast("string"), F.lit(n)), F.lit(""))


def json_bool_default(x, default: bool = False) -> Column:
    return F.coalesce(_c(x).cast("boolean"), F.lit(default))
