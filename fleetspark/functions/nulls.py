"""Null-safe column helpers.

pandas treats NaN as missing and comparisons with NaN as false; Spark treats
NaN as a value larger than any number and NULL as missing.  Every float input
is therefore turned into NULL at the source, and every helper below keeps
NULLs where the reference keeps NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(~F.isnan(c), c)


def clip(c, lo=None, hi=None) -> Column:
    """pandas ``clip``: bounds applied, NULL stays NULL (``greatest`` alone
    would turn NULL into the bound)."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def flag(cond: Column) -> Column:
    """Boolean with NULL read as false (numpy comparison with NaN)."""
    return F.coalesce(cond, F.lit(False))


def safe_div(a, b, fill: float = 0.0) -> Column:
    """``a / b`` where ``b != 0``, else ``fill``; a NULL ``b`` gives NULL
    (NaN != 0 in numpy, so the quotient, NaN, is kept)."""
    a, b = col_(a), col_(b)
    return F.when(b.isNull(), F.lit(None).cast("double")).when(b == 0, F.lit(fill)).otherwise(F.try_divide(a, b))


def div_or_null(a, b) -> Column:
    """``a / b.replace(0, NaN)``."""
    a, b = col_(a), col_(b)
    return F.try_divide(a, F.nullif(b, F.lit(0)))


def round_np(c, digits: int) -> Column:
    """numpy/pandas ``round``: ``rint(x * 10**d) / 10**d`` on the binary value
    (half to even after the multiplication).  ``bround`` rounds the decimal
    text instead and differs on values like 5.379 / 4."""
    s = float(10 ** digits)
    return F.rint(col_(c) * F.lit(s)) / F.lit(s)


def r4(c) -> Column:
    return round_np(c, 4)


def r2(c) -> Column:
    return round_np(c, 2)


def fill0(c) -> Column:
    return F.coalesce(col_(c), F.lit(0.0))


def first_non_null(c, *order) -> Column:
    """pandas ``groupby().first()``: first non-null value in row order.
    ``min_by`` skips rows whose ordering value is NULL, so nulls are masked
    out through the ordering struct; the result does not depend on shuffle
    order."""
    c = col_(c)
    return F.min_by(c, F.when(c.isNotNull(), F.struct(*[col_(o) for o in order])))


def first_in_order(c, ord_col: str = "_ord") -> Column:
    """First non-null value by a single long row order (see
    ``sequential.ordered_pass``); primitive buffers keep the aggregate a hash
    aggregate."""
    c = col_(c)
    return F.min_by(c, F.when(c.isNotNull(), F.col(ord_col)))


def seconds_between(later_us, earlier_us) -> Column:
    return (col_(later_us) - col_(earlier_us)) / F.lit(1_000_000.0)
