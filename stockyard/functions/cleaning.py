"""Column cleaning and casting expressions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_lower(c) -> Column:
    """lower(trim(c)) - cities, payment type, categories."""
    return F.lower(F.trim(_c(c)))


def clean_upper(c) -> Column:
    """upper(trim(c)) - states, order status."""
    return F.upper(F.trim(_c(c)))


def clean_trim(c) -> Column:
    """trim(c) - review title and message."""
    return F.trim(_c(c))


def try_cast(c, t: str) -> Column:
    """Cast that yields NULL instead of failing (ANSI mode raises on a bad
    value or an overflow; a flag column reports such rows instead)."""
    return _c(c).try_cast(t)


def cast_money(c) -> Column:
    """decimal(10,2) for price, freight and payment value."""
    return try_cast(c, "decimal(10,2)")


def cast_coordinates(c) -> Column:
    """decimal(10,6) for latitude / longitude."""
    return try_cast(c, "decimal(10,6)")


def cast_score(c) -> Column:
    """Review score as int; a non-numeric score becomes NULL."""
    return try_cast(c, "int")


def cast_date(c) -> Column:
    """Timestamp -> date (calendar date of the stored wall clock)."""
    return F.to_date(_c(c))


def default_zero(c) -> Column:
    """NULL -> 0."""
    return F.coalesce(_c(c), F.lit(0))


def rename_cast(c, t: str, name: str) -> Column:
    """Cast + rename to a model shape (e.g. ``ds`` timestamp, ``y`` double)."""
    return _c(c).cast(t).alias(name)


def string_len(c) -> Column:
    """Length of the trimmed string."""
    return F.length(F.trim(_c(c)))


def round_half_up(c, digits: int) -> Column:
    """floor(c * 10^digits + 0.5) / 10^digits on the binary double value.
    Unlike ``round`` (which rounds the shortest decimal form of the double),
    this gives the same result as the same formula in any SQL engine or in
    numpy, also on exact ties such as 13.13125."""
    scale = float(10 ** digits)
    return F.floor(_c(c) * scale + 0.5) / scale
