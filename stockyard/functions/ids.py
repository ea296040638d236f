"""Id formatting and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def format_id(prefix: str, n, width: int = 8) -> Column:
    """Zero-padded id: ``prefix`` + ``n`` on ``width`` digits (S00000001).
    Longer numbers keep all their digits; order ids by :func:`id_number`."""
    c = F.col(n) if isinstance(n, str) else n
    return F.format_string(f"{prefix}%0{width}d", c)


def id_number(df: DataFrame, column: str) -> Column:
    """The number an id ends in, as a long: the order of ids whatever their
    width (S99999999 comes before S100000000). NULL without digits."""
    if isinstance(df.schema[column].dataType, IntegralType):
        return F.col(column).cast("long")
    return F.regexp_extract(F.col(column), "([0-9]+)$", 1).try_cast("long")
