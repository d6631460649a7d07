"""Column expressions shared by every model.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none needs a Python function at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, DataType

from airlens.functions import constants as K


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half(c: Column | str, digits: int) -> Column:
    """Round a double the way ``round(x * 10^n) / 10^n`` does.

    ``F.round`` rounds the shortest decimal text of the double (0.285 -> 0.29)
    while the source pipeline rounds the binary value (0.285 -> 0.28). Scaling
    first and rounding to an integer gives the second behaviour exactly.
    """
    scale = float(10 ** digits)
    return F.round(col(c) * F.lit(scale), 0) / F.lit(scale)


def round_float(c: Column | str, digits: int) -> Column:
    """Round a FLOAT column, keeping the float type (``round(cast(x as float), n)``)."""
    return F.round(col(c).cast("float"), digits)


def count_where(cond: Column) -> Column:
    """``count(*) filter (where cond)``; a null condition is not counted."""
    return F.count_if(cond)


def pct(cond: Column, digits: int = 1) -> Column:
    """Percentage of the group's rows meeting ``cond``, as a rounded double.

    The literal is a double so the arithmetic is double, not decimal.
    """
    return round_half(F.lit(100.0) * F.count_if(cond) / F.count(F.lit(1)), digits)


def argmax_names(values: Sequence[Column | str], names: Sequence[str] = K.POLLUTANTS) -> Column:
    """Names of every column equal to the greatest of ``values``, in the given order.

    Ties are all kept; null values never win; all null gives an empty array.
    """
    cols = [col(v) for v in values]
    top = F.greatest(*cols)
    none = F.array().cast("array<string>")
    # one-element or empty array per column, concatenated: plain code-generated
    # expressions, no lambda evaluated per element
    return F.concat(*[F.when(c == top, F.array(F.lit(n))).otherwise(none) for c, n in zip(cols, names)])


def pollutant_columns(prefix: str, suffix: str = "") -> list[str]:
    """Column names ``<prefix>_<pollutant>[_<suffix>]`` in pollutant order."""
    tail = f"_{suffix}" if suffix else ""
    return [f"{prefix}_{p.lower()}{tail}" for p in K.POLLUTANTS]


def dominant(prefix: str, suffix: str = "") -> Column:
    """Arg-max names over the five pollutant columns named by prefix and suffix
    (``dominant("code")``, ``dominant("pct", "declencheur")``)."""
    return argmax_names(pollutant_columns(prefix, suffix))


def valid_pair(x: Column | str, y: Column | str) -> Column:
    """True when (x, y) is a WGS84 longitude/latitude pair."""
    lo_x, hi_x = K.LONGITUDE_RANGE
    lo_y, hi_y = K.LATITUDE_RANGE
    return col(x).between(lo_x, hi_x) & col(y).between(lo_y, hi_y)


def to_small_int(c: Column | str, data_type: DataType, target: str = "tinyint") -> Column:
    """Cast an index to a small integer type.

    Fractional input (a column with nulls read through pandas arrives as double)
    is rounded half to even first, which is what a float-to-integer cast does in
    the source engine; Spark's own cast would truncate.
    """
    c = col(c)
    if isinstance(data_type, FractionalType):
        c = F.rint(c)
    return c.cast(target)


def bands_ascending(c: Column | str, bands, otherwise: str) -> Column:
    """First label whose exclusive upper bound exceeds the value; null -> ``otherwise``."""
    c = col(c)
    expr = None
    for label, upper in bands:
        expr = F.when(c < upper, F.lit(label)) if expr is None else expr.when(c < upper, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def bands_descending(c: Column | str, bands, otherwise: str) -> Column:
    """First label whose inclusive lower bound the value reaches; null -> ``otherwise``."""
    c = col(c)
    expr = None
    for label, lower in bands:
        expr = F.when(c >= lower, F.lit(label)) if expr is None else expr.when(c >= lower, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def coverage_status(missing: Column | str, yesterday: Column | str) -> Column:
    """OK when nothing is missing, CRITICAL above the fraction of yesterday, else WARN.

    Compared in integers (``den * missing > num * yesterday``) so it is exact.
    """
    num, den = K.COVERAGE_CRITICAL_FRACTION
    m, y = col(missing), col(yesterday)
    return (F.when(m == 0, F.lit(K.STATUS_OK))
            .when(m * den > y * num, F.lit(K.STATUS_CRITICAL))
            .otherwise(F.lit(K.STATUS_WARN)))


def departments_status(missing: Column | str) -> Column:
    m = col(missing)
    return (F.when(m == 0, F.lit(K.STATUS_OK))
            .when(m <= K.DEPARTMENTS_WARN_MAX, F.lit(K.STATUS_WARN))
            .otherwise(F.lit(K.STATUS_CRITICAL)))


def worst_status(*statuses: Column | str) -> Column:
    """CRITICAL if any is CRITICAL, else WARN if any is WARN, else OK (unknown counts as OK)."""
    cols = [col(s) for s in statuses]
    crit = None
    warn = None
    for c in cols:
        is_c = F.coalesce(c == K.STATUS_CRITICAL, F.lit(False))
        is_w = F.coalesce(c == K.STATUS_WARN, F.lit(False))
        crit = is_c if crit is None else (crit | is_c)
        warn = is_w if warn is None else (warn | is_w)
    return (F.when(crit, F.lit(K.STATUS_CRITICAL))
            .when(warn, F.lit(K.STATUS_WARN))
            .otherwise(F.lit(K.STATUS_OK)))
