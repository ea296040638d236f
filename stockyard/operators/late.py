"""Which events of a SKU came late: the smallest set whose removal leaves the
times in order.

The events of a SKU have an order of arrival (their id numbers) and times. What
stays is a longest non-decreasing subsequence of the times; the rest is late. A
running maximum would instead call every event late that follows one event
stamped too far ahead.

A SKU of at most so many events as one task holds is solved whole, by patience
sorting, many SKUs in a batch; its rows are shuffled once. The rest is for SKUs
with more.

An event no earlier than all before it and no later than all after it lies on
every longest subsequence, so it cuts the SKU's events in two: what lies between
two such events is a segment of its own, found with prefix and suffix scans that
stay parallel for a hot SKU. Segments are solved by patience sorting, one at a
time. In a segment too long for a task, an event that lies further from its
place by time than there are late events is late for certain; without these
events the segment falls apart.

Of several longest subsequences the one is kept that ends last and goes back,
step by step, over the latest possible events.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_path, ship_package
from . import windows
from .windows import _filled, dealt, even_buckets, heavy_keys, of_keys, running

K = "sku_id"
# Events of a segment that one task solves.
SEGMENT_ROWS = 1_000_000
HOUR = 3_600_000_000  # in microseconds
NEAR_HOURS = 2


def _mark_longest(values: list, start: int, end: int, keep: list) -> None:
    """Sets ``keep`` for the members of the longest non-decreasing subsequence
    of a run of ``values`` that ends last and whose steps back go to the latest
    possible place."""
    tails: list[int] = []  # the least end of a subsequence of each length
    tops: list[int] = []   # its place
    back: list[int] = []
    for i in range(start, end):
        v = values[i]
        k = bisect_right(tails, v)
        back.append(tops[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            tops.append(i)
        else:
            tails[k], tops[k] = v, i
    i = tops[-1] if tops else -1
    while i >= 0:
        keep[i] = True
        i = back[i - start]


def longest_in_order(t: np.ndarray, starts=(0,)) -> np.ndarray:
    """True for the members of the subsequence of :func:`_mark_longest`, in each
    of the runs that begin at ``starts``."""
    values, keep = t.tolist(), [False] * len(t)
    for a, b in zip(starts, [*starts[1:], len(values)], strict=True):
        _mark_longest(values, a, b, keep)
    return np.array(keep, dtype=bool)


KINDS = pa.array(["hour_slip", "near", "far"])


def solve(t: np.ndarray, starts: np.ndarray, low=None, high=None) -> tuple[np.ndarray, pa.Array]:
    """For the times of runs that begin at ``starts``, between the times that
    end each (Arrow arrays, NULL for none): which events are late, and what kind
    of slip it looks like. ``hour_slip``: an hour more or less puts it between
    its neighbours that stay; ``near``: within two hours of them; ``far``:
    further off."""
    keep = longest_in_order(t, starts.tolist())
    late = np.flatnonzero(~keep)
    run = np.searchsorted(starts, late, "right") - 1
    ends = np.append(starts[1:], len(t))
    place = np.arange(len(t))
    before = np.maximum.accumulate(np.where(keep, place, -1))[late]
    after = np.minimum.accumulate(np.where(keep, place, len(t))[::-1])[::-1][late]

    def bound(at, inside, outer):
        """Times of the neighbours that stay, and where there are any."""
        times, there = t[np.where(inside, at, 0)], inside
        if outer is not None:
            there = inside | np.asarray(outer.is_valid())[run]
            times = np.where(inside, times, micros(outer)[run])
        return times, there

    a, any_a = bound(before, before >= starts[run], low)
    b, any_b = bound(after, after < ends[run], high)
    v = t[late]

    def apart(x):
        return np.maximum(np.where(any_a, a - x, 0), np.where(any_b, x - b, 0))

    kind = np.where((apart(v - HOUR) <= 0) | (apart(v + HOUR) <= 0), 0,
                    np.where(apart(v) <= NEAR_HOURS * HOUR, 1, 2))
    kinds = np.full(len(t), -1)
    kinds[late] = kind
    return ~keep, KINDS.take(pa.array(kinds, mask=kinds < 0))


def micros(column) -> np.ndarray:
    """Times of an Arrow column as microseconds (days for dates, times 86400
    seconds), 0 for NULL."""
    if pa.types.is_date(column.type):
        return np.asarray(pc.fill_null(pc.cast(pc.cast(column, pa.int32()), pa.int64()), 0)) * 86_400_000_000
    unit = pa.timestamp("us", tz=getattr(column.type, "tz", None))
    return np.asarray(pc.fill_null(pc.cast(pc.cast(column, unit), pa.int64()), 0))


def _surrounded(df: DataFrame, order: list, bucket, when: str) -> DataFrame:
    """``df`` with ``__seq`` (place in ``order`` within the SKU), and the latest
    time before and the earliest time after each row."""
    keys = [K] if bucket is None else [K, bucket]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    d = df.withColumn("__seq", F.row_number().over(w).cast("long")) \
        .withColumn("__prev_max", F.max(when).over(before))
    back = Window.partitionBy(*keys).orderBy(F.desc("__seq")).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__next_min", F.min(when).over(back))
    if bucket is None:
        return d
    totals = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.max(when).alias("__hi"), F.min(when).alias("__lo"))
    wb = Window.partitionBy(K).orderBy(bucket)
    earlier = wb.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(K).orderBy(F.desc(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    sums = totals.select(*keys, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
                         F.max("__hi").over(earlier).alias("__hi"), F.min("__lo").over(later).alias("__lo"))
    return d.join(sums, keys) \
        .withColumn("__seq", F.col("__seq") + F.col("__before")) \
        .withColumn("__prev_max", F.greatest("__prev_max", "__hi")) \
        .withColumn("__next_min", F.least("__next_min", "__lo")).drop("__before", "__hi", "__lo")


def _segmented(df: DataFrame, bucket, when: str) -> DataFrame:
    """Adds ``__cut`` and ``__segment`` (how many cuts lie at or before a row)."""
    t = F.col(when)
    cut = F.coalesce(F.col("__prev_max") <= t, F.lit(True)) & F.coalesce(t <= F.col("__next_min"), F.lit(True))
    d = df.withColumn("__cut", cut.cast("int"))
    return running(d, [K], [F.col("__seq")], "__cut", "__segment", "sum",
                   bucket=None if bucket is None else F.col(bucket))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _changes(column: pa.Array) -> np.ndarray:
    """The places from 1 on whose value differs from the one before."""
    here, last = column.slice(1), column.slice(0, len(column) - 1)
    other = pc.or_(pc.fill_null(pc.not_equal(here, last), False), pc.xor(here.is_null(), last.is_null()))
    return np.flatnonzero(np.asarray(other)) + 1


def _solved_runs(rows: DataFrame, keys: list[str], columns: list[str], when: str, ends: bool) -> DataFrame:
    """``columns`` of ``rows``, which lie in runs of equal ``keys``, with
    ``is_late`` and ``late_kind``. With ``ends``, the times around a run are the
    ``__prev_max`` of its first row and the ``__next_min`` of its last."""
    out = T.StructType([*[rows.schema[c] for c in columns], T.StructField("is_late", T.BooleanType()),
                        T.StructField("late_kind", T.StringType())])

    def run(parts):
        held: list = []  # the run that may go on
        for part in parts:
            if not part.num_rows:
                continue
            if held:
                seam = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), part.slice(0, 1)])
                new = any(len(_changes(seam.column(k).combine_chunks())) for k in keys)
            starts = np.unique(np.concatenate([_changes(part.column(k)) for k in keys]))
            if held and not new and not len(starts):
                held.append(part)
                continue
            last = int(starts[-1]) if len(starts) else 0
            done = pa.Table.from_batches([*held, part.slice(0, last)])
            if done.num_rows:
                yield finish(done)
            held = [part.slice(last)]
        if held:
            yield finish(pa.Table.from_batches(held))

    def finish(table):
        table = table.combine_chunks()
        col = {c: table.column(c).combine_chunks() for c in {*keys, when}}
        starts = np.unique(np.concatenate([[0], *[_changes(col[k]) for k in keys]])).astype(np.int64)
        around = ()
        if ends:
            last = np.append(starts[1:], table.num_rows) - 1
            around = [table.column(c).combine_chunks().take(pa.array(at))
                      for c, at in (("__prev_max", starts), ("__next_min", last))]
        late, kinds = solve(micros(col[when]), starts, *around)
        table = table.select(columns).append_column("is_late", pa.array(late)) \
            .append_column("late_kind", kinds)
        return table.combine_chunks().to_batches()[0]

    return rows.mapInArrow(run, out)


def _solved(loose: DataFrame, columns: list[str], when: str) -> DataFrame:
    """Rows of whole segments, with ``is_late`` and ``late_kind``."""
    src = loose.select(*columns, "__segment", "__seq", "__prev_max", "__next_min") \
        .repartition(K, "__segment").sortWithinPartitions(K, "__segment", "__seq")
    return _solved_runs(src, [K, "__segment"], [*columns, "__seq"], when, ends=True)


def _displaced(big: DataFrame, when: str) -> DataFrame:
    """Events of long segments that are late for certain: their places by time
    and by arrival lie further apart than there are late events. An event has
    at least that many others out of order with it, and either it or all of
    them are late. The number is bounded by sets whose removal leaves order:
    events below the running maximum, events above the least time to come, and
    both of these once the events displaced by a quarter of the segment are
    left aside, with them."""
    t, off = F.col(when), F.abs(F.col("__by_time") - F.col("__by_seq"))
    rows = big.select(K, "__segment", "__seq", when, "__prev_max", "__next_min")
    sizes = big.groupBy(K, "__segment").agg(F.count("*").alias("__m"))
    ranked = _numbered(_numbered(rows, [t, F.col("__seq")], "__by_time"), [F.col("__seq")], "__by_seq") \
        .join(sizes, [K, "__segment"]).withColumn("__aside", off > F.col("__m") / 4) \
        .withColumn("__rest", F.when(~F.col("__aside"), t))
    dealt, bucket = even_buckets(ranked, [K], [F.col("__seq")])
    at = None if bucket is None else F.col(bucket)
    # Times of segments that follow one another do not cross, so the scans run
    # over the whole SKU.
    scan = running(dealt, [K], [F.col("__seq")], "__rest", "__above", "max", bucket=at, include_current=False)
    scan = running(scan, [K], [F.desc("__seq")], "__rest", "__below", "min",
                   bucket=None if at is None else -at, include_current=False)
    scan = _written(scan, "late-ranked")

    def many(c):
        return F.sum(F.coalesce(c, F.lit(False)).cast("long"))

    aside, rest = F.col("__aside"), F.col("__rest")
    bounds = scan.groupBy(K, "__segment").agg(F.least(
        many(F.col("__prev_max") > t), many(F.col("__next_min") < t),
        many(aside | (F.col("__above") > rest)), many(aside | (F.col("__below") < rest))).alias("__k"))
    return scan.join(bounds, [K, "__segment"]).where(off > F.col("__k")).select(K, "__seq")


def _numbered(rows: DataFrame, order: list, out: str) -> DataFrame:
    """``out``: the number of each row of a SKU in ``order``."""
    dealt, bucket = even_buckets(rows, [K], order)
    return running(dealt.withColumn("__one", F.lit(1)), [K], order, "__one", out, "sum",
                   bucket=None if bucket is None else F.col(bucket)).drop("__one", "__even")


def _kind(t, before, after):
    """The kind of :func:`solve` as an expression."""
    def gap(hours):
        x = t + F.make_dt_interval(F.lit(0), F.lit(hours))
        return F.coalesce(x < before, F.lit(False)) | F.coalesce(x > after, F.lit(False))

    near = ~F.coalesce(t < before - F.make_dt_interval(F.lit(0), F.lit(NEAR_HOURS)), F.lit(False)) \
        & ~F.coalesce(t > after + F.make_dt_interval(F.lit(0), F.lit(NEAR_HOURS)), F.lit(False))
    return F.when(~gap(-1) | ~gap(1), "hour_slip").when(near, "near").otherwise("far")


def _judged(rest: DataFrame, columns: list[str], order: list, when: str, segment_rows: int) -> DataFrame:
    """``columns`` of rows with a time, ``__seq``, ``is_late`` and ``late_kind``."""
    nothing = [F.lit(False).alias("is_late"), F.lit(None).cast("string").alias("late_kind")]
    dealt, bucket = even_buckets(rest, [K], order)
    marked = _segmented(_surrounded(dealt, order, bucket, when), bucket, when)
    if bucket is not None:
        marked = _written(marked, "late")
    kept = marked.where("__cut = 1").select(*columns, "__seq", *nothing)
    loose = marked.where("__cut = 0")
    if bucket is None:  # few rows: no segment is long
        return kept.union(_solved(loose, columns, when))
    long_ones = loose.groupBy(K, "__segment").agg(F.count("*").alias("__m")) \
        .where(F.col("__m") > segment_rows).select(K, "__segment")
    if long_ones.isEmpty():
        return kept.union(_solved(loose, columns, when))
    big = _written(loose.join(long_ones, [K, "__segment"]), "late-long")
    gone = _written(_displaced(big, when), "late-displaced")
    if gone.isEmpty():
        return kept.union(_solved(loose, columns, when))
    small = _solved(loose.join(long_ones, [K, "__segment"], "left_anti"), columns, when)
    left = big.join(gone, [K, "__seq"], "left_anti").withColumn("__at", F.col("__seq")) \
        .select(*columns, "__at")
    again = _judged(left, [*columns, "__at"], [F.col("__at")], when, segment_rows) \
        .select(*columns, F.col("__at").alias("__seq"), "is_late", "late_kind")
    far = big.join(gone, [K, "__seq"]).select(*columns, "__seq", F.lit(True).alias("is_late"),
                                              F.lit(None).cast("string").alias("late_kind"))
    # What stays around the events that were taken out tells their kind.
    every, bucket = even_buckets(kept.union(small).union(again).union(far), [K], [F.col("__seq")])
    every = every.withColumn("__kept", F.when(~F.col("is_late"), F.col(when)))
    at = None if bucket is None else F.col(bucket)
    every = running(every, [K], [F.col("__seq")], "__kept", "__before", "max", bucket=at)
    every = running(every, [K], [F.desc("__seq")], "__kept", "__after", "min", bucket=None if at is None else -at)
    kind = F.when(F.col("is_late"), F.coalesce("late_kind", _kind(F.col(when), F.col("__before"), F.col("__after"))))
    return every.select(*columns, "__seq", "is_late", kind.alias("late_kind"))


def late_events(events: DataFrame, order: list, when: str = "event_ts",
                segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``events`` with ``is_late`` and ``late_kind`` (NULL where not late).

    ``order`` is the order of arrival within a SKU; it must tell rows with
    different times apart. Rows without a time are not late and do not count.
    Equal times are in order. The rows are dealt by SKU; a SKU with too many of
    them for that goes to buckets of equal size by its order of arrival. A segment that is still longer than ``segment_rows`` once
    no event is out of place by more than the number of late ones is solved in
    one task all the same."""
    ship_package(events.sparkSession)
    columns, timed = events.columns, events.where(F.col(when).isNotNull())
    total, hot = heavy_keys(timed, K, min(segment_rows, 2 * windows.BUCKET_ROWS))
    rest = timed if hot is None else of_keys(timed, K, hot, "left_anti")
    out = _solved_runs(dealt(rest, total, K).sortWithinPartitions(K, *order), [K], columns, when, ends=False)
    if hot is not None:
        rows = of_keys(timed, K, hot, "left_semi")
        out = out.union(_judged(rows.where(F.col(K).isNotNull()), columns, order, when, segment_rows)
                        .select(*out.columns))
        if not hot.where("__heavy IS NULL").isEmpty():  # any other name does, where it is alone
            kind = rows.schema[K].dataType
            named = rows.where(F.col(K).isNull()).withColumn(K, _filled(F.lit(None).cast(kind), kind))
            out = out.union(_judged(named, columns, order, when, segment_rows)
                            .withColumn(K, F.lit(None).cast(kind)).select(*out.columns))
    return out.union(events.where(F.col(when).isNull()).select(
        *columns, F.lit(False), F.lit(None).cast("string")))
