"""Importance resampling towards a target distribution.

Every document is weighed by hashed features: an array holds, for each bucket,
how much commoner its features are in the target texts than in the corpus, and
a document's weight is the sum over its features. Gumbel noise drawn from the
document's id is added, and the best scores are drawn without replacement.

The order comes from a distributed LSD radix sort over the composite key
(score descending, id ascending), least significant digit first. Each pass is
a stable counting sort: parts of bounded size number their rows within each
digit, a prefix sum over digits and parts gives the offset of each (part,
digit), offset plus number is the row's place, and the rows move to the part
that holds their place. The last places are the ranks.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import forget, prepare, written
from stockyard.llm.words import alnum_words, chunks

BUCKETS, RUNS, SEED = 10_000, 3, 42
MIN_WORDS, PERCENT = 20, 5
# Bits of a digit, and rows of a part: several times the number of digits, so
# that offsets are few against rows.
DIGIT_BITS, PART_ROWS = 12, 1 << 17

_SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_features", T.LongType()),
                        T.StructField("weight", T.LongType()), T.StructField("score", T.LongType()),
                        T.StructField("n_words", T.LongType())])
_CELLS = ["doc_id", "n_features", "weight", "score"]
_NUMBERED = T.StructType([*_SCORED.fields[:4], T.StructField("part", T.LongType()),
                          T.StructField("digit", T.IntegerType()), T.StructField("nth", T.LongType())])


def feature_buckets(words: list[bytes], carried: int, runs: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of 1 to ``runs`` words that end past the first
    ``carried`` words: crc32 of the run, continued from that of the run without
    its last word."""
    spaced = [b" " + w for w in words]
    sums, out = list(map(crc32, words)), []
    for k in range(1, runs + 1):
        if k > 1:
            sums = list(map(crc32, spaced[k - 1:], sums))
        out += sums[max(0, carried - k + 1):]
    return np.array(out, dtype=np.int64) % buckets


def text_buckets(text: str | None, runs: int, buckets: int):
    """For each chunk of a text: its number of words, its features' buckets."""
    carry: list[bytes] = []
    for chunk in chunks((text or "").encode()):
        new = alnum_words(chunk)
        words = carry + new
        yield len(new), feature_buckets(words, len(carry), runs, buckets)
        carry = words[max(0, len(words) - runs + 1):] if runs > 1 else []


def bucket_counts(df: DataFrame, text_col: str, runs: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    out = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("n", T.LongType())])

    def run(parts):
        forget()
        held = np.zeros(buckets, dtype=np.int64)
        for part in parts:
            for x in part.column(0):
                for _, at in text_buckets(x.as_py(), runs, buckets):
                    held += np.bincount(at, minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=out.names)

    got = df.select(text_col).mapInArrow(run, out).groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, dtype=np.int64)
    for r in got.collect():  # one row a bucket
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: floor of 1000 times the log of the ratio of its
    smoothed shares in target and source."""
    b, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise in thousandths, from the id (a null id is written as nothing)."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_texts(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, runs: int,
                seed: int) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``n_words`` of every row."""
    buckets = len(gain)

    def run(parts):
        forget()
        for part in parts:
            rows = []
            for i, x in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                n_words = n_features = weight = 0
                for n, at in text_buckets(x.as_py(), runs, buckets):
                    n_words, n_features = n_words + n, n_features + len(at)
                    weight += int(gain[at].sum())
                rows.append((i, n_features, weight, weight + noise(i, seed), n_words))
            cols = list(zip(*rows, strict=True)) or [[] for _ in _SCORED]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=_SCORED.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("x")) \
        .mapInArrow(run, _SCORED)


class Digits:
    """The digits of (score descending, id ascending, null ids last), least
    significant first; ranges that the rows do not use have no digits."""

    def __init__(self, top: int, bottom: int, first: int, last: int, nulls: bool, bits: int):
        self.top, self.first, self.bits = top, first, bits
        spans = [("id", last - first), ("null", int(nulls)), ("score", top - bottom)]
        self.all = [(name, shift) for name, span in spans
                    for shift in range(0, max(0, span).bit_length(), bits)]

    def of(self, batch, k: int) -> np.ndarray:
        """Digit ``k`` of each row of an Arrow batch or table."""
        name, shift = self.all[k]
        col = batch.column("score" if name == "score" else "doc_id")
        if name == "null":
            return np.asarray(col.is_null()).astype(np.int64)
        values = np.asarray(col.fill_null(self.first)).astype(np.int64).view(np.uint64)
        # Differences as unsigned longs: they fit, whatever the signs.
        base = np.array([self.top if name == "score" else self.first]).astype(np.int64).view(np.uint64)
        value = base - values if name == "score" else values - base
        return ((value >> np.uint64(shift)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)


def _nth(digits: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The running number of each row among those with its digit; ``seen`` has
    the rows before, and is brought up to date."""
    order = np.argsort(digits, kind="stable")
    counts = np.bincount(digits, minlength=len(seen))
    starts = np.cumsum(counts) - counts
    out = np.empty(len(digits), dtype=np.int64)
    out[order] = np.arange(len(digits)) - starts[digits[order]]
    out += seen[digits]
    seen += counts
    return out


def _numbered(batch, digits: np.ndarray, part: int, nth: np.ndarray) -> list:
    return [*[batch.column(c) for c in _CELLS], pa.array(np.full(len(digits), part), pa.int64()),
            pa.array(digits, pa.int32()), pa.array(nth, pa.int64())]


def radix_ranks(spark: SparkSession, rows: DataFrame, bits: int = DIGIT_BITS,
                part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` (``doc_id``, ``n_features``, ``weight``, ``score``) with ``place``
    from 0 in the order of score (descending) and id (ascending, null last);
    rows equal in both take successive places."""
    rows = rows.select(*_CELLS)
    ends = rows.agg(F.max("score"), F.min("score"), F.min("doc_id"), F.max("doc_id"),
                    F.max(F.col("doc_id").isNull()), F.count("*")).first()
    if not ends[5]:
        return rows.withColumn("place", F.lit(0).cast("long"))
    first = ends[2] if ends[2] is not None else 0
    digits = Digits(ends[0], ends[1], first, ends[3] if ends[3] is not None else 0, ends[4], bits)
    if not digits.all:  # all rows are equal
        digits.all = [("null", 0)]

    def as_read(parts):
        """First pass: the parts are those in which the rows lie."""
        from pyspark import TaskContext

        forget()
        part, seen = TaskContext.get().partitionId(), np.zeros(1 << bits, dtype=np.int64)
        for batch in parts:
            d = digits.of(batch, 0)
            yield pa.RecordBatch.from_arrays(_numbered(batch, d, part, _nth(d, seen)),
                                             names=_NUMBERED.names)

    def placed(k):
        def run(table: pa.Table) -> pa.Table:
            """Rows go to their places in the part, then are numbered anew."""
            forget()
            part = table.column("part")[0].as_py()
            at = np.asarray(table.column("place")) - part * part_rows
            source = np.empty(len(at), dtype=np.int64)
            source[at] = np.arange(len(at))
            table = table.combine_chunks().take(pa.array(source))
            d = digits.of(table, k)
            nth = _nth(d, np.zeros(1 << bits, dtype=np.int64))
            return pa.table(_numbered(table, d, part, nth), names=_NUMBERED.names)
        return run

    out = None
    for k in range(len(digits.all)):
        if out is None:
            step = rows.mapInArrow(as_read, _NUMBERED)
        else:
            step = out.withColumn("part", F.floor(F.col("place") / part_rows)) \
                .groupBy("part").applyInArrow(placed(k), _NUMBERED)
        step = written(spark, step, f"radix-{k}")
        counts = step.groupBy("part", "digit").agg(F.count("*").alias("n"))
        # At most 2^bits digits: their prefix sum is one small task.
        base = counts.groupBy("digit").agg(F.sum("n").alias("n")).select(
            "digit", (F.sum("n").over(Window.orderBy("digit")) - F.col("n")).alias("base"))
        before = counts.select("part", "digit", (F.sum("n").over(
            Window.partitionBy("digit").orderBy("part")) - F.col("n")).alias("before"))
        offsets = before.join(base, "digit") \
            .select("part", "digit", (F.col("base") + F.col("before")).alias("offset"))
        out = step.join(offsets, ["part", "digit"]) \
            .select(*_CELLS, (F.col("offset") + F.col("nth")).alias("place"))
    return out


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", target_text_col: str = "text", buckets: int = BUCKETS,
             runs: int = RUNS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: int = SEED, bits: int = DIGIT_BITS, part_rows: int = PART_ROWS) -> DataFrame:
    """Draw ``percent`` hundredths of the documents of ``min_words`` words or
    more, as the texts of ``target`` would have them.

    Returns ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of
    every row (1 for the best score; null: not drawn). Ties go to the smaller
    id; a null id comes last among them, and its noise is that of an empty
    name; rows of one id and score take successive ranks in any order. Null and
    empty texts have no features and weight 0; repeated rows count each time; a
    very long text is read in chunks; an empty target leaves smoothed shares;
    an empty table gives an empty result; other columns are ignored. Ids are
    integers.
    """
    prepare(spark)
    if not isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        raise TypeError("ids must be integers: they are digits of the sort key")
    gain = gains(bucket_counts(docs, text_col, runs, buckets),
                 bucket_counts(target, target_text_col, runs, buckets))
    scored = written(spark, score_texts(docs, gain, id_col, text_col, runs, seed), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    draw = percent * able.count() // 100
    drawn = F.when(F.col("place") < draw, F.col("place") + 1).alias("rank")
    others = scored.where(F.col("n_words") < min_words)
    return radix_ranks(spark, able, bits, part_rows).select(*_CELLS, drawn) \
        .union(others.select(*_CELLS, F.lit(None).cast("long").alias("rank")))
