"""Row filters and semi / anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose key columns are all not null (pushed to the scan)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def filter_not_in(df: DataFrame, column: str, values: Sequence[str],
                  normalize: bool = True) -> DataFrame:
    """Exclude rows whose value is in ``values``. With ``normalize`` the test
    is case- and blank-insensitive. A NULL value is dropped too:
    ``NULL NOT IN (...)`` is unknown."""
    c = F.lower(F.trim(F.col(column))) if normalize else F.col(column)
    vals = [v.lower().strip() for v in values] if normalize else list(values)
    return df.filter(~c.isin(*vals))


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def outside_range(column: str, lo, hi):
    """Predicate: value below ``lo`` or above ``hi`` (NULL -> unknown)."""
    c = F.col(column)
    return (c < lo) | (c > hi)


def latest_rows(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals the per-key maximum (ties all kept).

    The per-key max is a partial + final aggregate (map-side combine, so a
    hot key is reduced before the shuffle), joined back on (key, max value):
    the join is hashed on both columns, so a hot key's rows spread over
    tasks, and only the latest rows find a partner. Keys match null-safely,
    like the grouping."""
    mx = df.groupBy(*keys).agg(F.max(order_col).alias("__max"))
    o = mx.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__max")
    cond = df[order_col] == o["__max"]
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(o[f"__k{i}"])
    return df.join(o, cond, "inner").drop("__max", *[f"__k{i}" for i in range(len(keys))])


def anti_join_ids(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (NOT IN / NOT
    EXISTS). Written as ``left_anti`` on not-null keys so Spark may shuffle
    both sides instead of broadcasting ``other`` (a null-aware NOT IN is
    always planned as a broadcast). Keys of ``other`` are taken as not null
    (ids are declared not null), so SQL's "a NULL in the list empties the
    result" case does not arise."""
    right = drop_null_keys(other.select(*keys), keys)
    return df.join(right, list(keys), "left_anti")
