"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over ``GRAM`` bytes cuts every text into phrases: each string of
``length`` bytes belongs to the trigger with the smallest rolling hash inside
it, so equal strings always meet at equal triggers, however repetitive the text.
A phrase is the run of string starts that belong to one trigger, together with
the ``length - 1`` bytes that follow. Distinct phrases are the dictionary, the
order in which texts use them is the parse, and their use counts come from it.

A string repeats if its phrase is used twice, or if it also starts inside
another phrase of the same trigger. For the latter the suffixes of the
dictionary phrases of a trigger are sorted (their suffix array, cut at
``length`` bytes) and neighbours compared: with the use counts this is the
order of the corpus, in which equal strings lie side by side.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import batches_of, forget, prepare, row_key, utf8, written

LENGTH = 200
GRAM = 32           # bytes of the rolling hash
CHUNK = 1 << 23     # string starts parsed at a time
# Dictionary phrases of one trigger whose suffixes one task sorts. The strings
# of a trigger with more are grouped by hash over all tasks instead.
GROUP = 4_096

# The rolling hash: a random odd number for each byte, and a multiplier. Values
# from the splitmix64 rule, so that every task has the same.
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_LOW = np.uint64((1 << 24) - 1)


def _byte_values() -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(_MIX[0])
        x = (x ^ x >> np.uint64(30)) * np.uint64(_MIX[1])
        x = (x ^ x >> np.uint64(27)) * np.uint64(_MIX[2])
    return (x ^ x >> np.uint64(31)) | np.uint64(1)


_BYTES = _byte_values()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position (uint64)."""
    h, power, size = _BYTES[data], np.uint64(_MIX[0]), 1
    with np.errstate(over="ignore"):
        while size < GRAM:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
        h = (h ^ h >> np.uint64(31)) * np.uint64(_MIX[1])
    return h ^ h >> np.uint64(32)


def phrases(text: bytes, length: int = LENGTH):
    """(trigger hash, trigger offset in the phrase, first, last string start)
    arrays of a text's phrases."""
    out = []
    for begin in range(0, max(0, len(text) - length + 1), CHUNK):
        data = np.frombuffer(text[begin:begin + CHUNK + length - 1], dtype=np.uint8)
        starts = len(data) - length + 1
        h = rolling_hash(data)
        low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        span, width = 1, length - GRAM + 1
        while 2 * span <= width:  # smallest of each window of `width` hashes
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:starts], low[width - span:width - span + starts])
        at = (low & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:], [starts])) - 1
        out.append((h[at[first]], at[first] - first, first + begin, last + begin))
    if not out:
        return None
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def repeated_starts(group: list[tuple[bytes, int]], length: int = LENGTH) -> list[np.ndarray]:
    """For the dictionary phrases (text, use count) of one trigger: which
    string starts of each repeat, by their sorted suffixes."""
    suffixes = [(p[j:j + length], k, j) for k, (p, _) in enumerate(group)
                for j in range(len(p) - length + 1)]
    flags = [np.full(max(0, len(p) - length + 1), n > 1) for p, n in group]
    suffixes.sort()
    for (a, k, i), (b, m, j) in zip(suffixes, suffixes[1:], strict=False):
        if a == b:
            flags[k][i] = flags[m][j] = True
    return flags


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags, [0])))).reshape(-1, 2)
    return [(a, b - 1) for a, b in edge.tolist()]


def cut(text: bytes, spans: list[int], length: int = LENGTH) -> tuple[bytes, int, int]:
    """Kept bytes, removed bytes and removed runs, given the repeated string
    starts as (first << 32 | last) numbers."""
    gone = np.zeros(len(text) + 1, dtype=np.int32)
    s = np.array(spans, dtype=np.int64)
    np.add.at(gone, s >> 32, 1)
    np.add.at(gone, (s & 0xFFFFFFFF) + length, -1)
    off = np.cumsum(gone[:-1]) > 0
    kept = np.frombuffer(text, dtype=np.uint8)[~off].tobytes()
    return kept, int(off.sum()), len(runs(off))


_USES = pa.schema([("k", pa.int64()), ("c", pa.int64()), ("i", pa.int64()), ("t", pa.int64()),
                   ("s", pa.int64())])


def repeated_spans(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Repeated string starts of each text: ``i``, ``t`` (the row's key) and
    ``s``, first << 32 | last start of a run."""
    src = docs.where(F.octet_length(text_col) >= length) \
        .select(*row_key(docs, id_col, text_col), F.col(text_col).alias("x"))

    def parse(parts):
        import xxhash
        digest = xxhash.xxh3_64_intdigest
        forget()
        for part in parts:
            cols: list[list] = [[], [], [], [], []]
            for i, t, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                               utf8(part.column(2)), strict=True):
                if (found := phrases(x, length)) is None:
                    continue
                key, off, first, last = found
                mine = [digest(x[a:b + length], o) for a, b, o in
                        zip(first.tolist(), last.tolist(), off.tolist(), strict=True)]
                cols[0].append(key)
                cols[1].append(np.array(mine, dtype=np.uint64))
                cols[2].append(np.full(len(key), i))
                cols[3].append(np.full(len(key), t))
                cols[4].append(first << 32 | last)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in cols], schema=_USES)

    uses = src.mapInArrow(parse, "k long, c long, i long, t long, s long")
    # Triggers that occur more than once; the aggregate combines hot ones
    # before the shuffle. It is written, so that the join is one of two plain
    # shuffles, whose hot partitions Spark can split.
    again = uses.groupBy("k").agg(F.count("*").alias("uses"), F.min("c").alias("lo"),
                                  F.max("c").alias("hi")) \
        .where("uses > 1").select("k", (F.col("lo") != F.col("hi")).alias("mixed"))
    again = written(spark, again, "pfp-triggers")
    shared = written(spark, uses.join(again, "k"), "pfp-uses")
    # The dictionary: one row for each distinct phrase, one of its places.
    book = shared.groupBy("k", "c").agg(
        F.count("*").alias("n"), F.first("mixed").alias("mixed"), F.first("i").alias("i"),
        F.first("t").alias("t"), F.first("s").alias("s"))
    book = written(spark, book, "pfp-book")
    whole = shared.join(book.where("n > 1").select("k", "c"), ["k", "c"]).select("i", "t", "s")
    # Phrases that share their trigger with different ones: fetch their bytes.
    mixed = book.where("mixed")
    sizes = mixed.groupBy("k").agg(F.count("*").alias("m"))
    places = mixed.join(sizes, "k").groupBy("i", "t") \
        .agg(F.collect_list(F.struct("k", "n", "s", "m")).alias("p"))
    held = src.join(places, ["i", "t"])

    def fetch(parts):
        schema = pa.schema([("k", pa.int64()), ("m", pa.int64()), ("n", pa.int64()),
                            ("i", pa.int64()), ("t", pa.int64()), ("s", pa.int64()),
                            ("x", pa.binary())])
        last = None
        for part in parts:
            for i, t, x, p in zip(part.column("i").to_pylist(), part.column("t").to_pylist(),
                                  utf8(part.column("x")), part.column("p").to_pylist(),
                                  strict=True):
                # Copies of a row come one after another; one of them is enough.
                if (i, t) == last:
                    continue
                last = i, t
                yield from batches_of(
                    ((r["k"], r["m"], r["n"], i, t, r["s"],
                      x[r["s"] >> 32:(r["s"] & 0xFFFFFFFF) + length]) for r in p), schema)

    text = written(spark, held.mapInArrow(
        fetch, "k long, m long, n long, i long, t long, s long, x binary"), "pfp-phrases")
    few = text.where(F.col("m") <= group).repartition("k").sortWithinPartitions("k")
    spans_type = pa.schema([("i", pa.int64()), ("t", pa.int64()), ("s", pa.int64())])

    def sort_suffixes(parts):
        def solve(rows):
            # A row that repeats in the table (copies of a text) is one phrase.
            rows = list({(r[3], r[4], r[5]): r for r in rows}.values())
            flags = repeated_starts([(r[6], r[2]) for r in rows], length)
            for r, f in zip(rows, flags, strict=True):
                if r[2] == 1:
                    at = r[5] >> 32
                    for a, b in runs(f):
                        yield r[3], r[4], at + a << 32 | at + b

        def stream():
            now, rows = None, []
            for part in parts:
                for r in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if r[0] != now:
                        yield from solve(rows)
                        now, rows = r[0], []
                    rows.append(r)
            yield from solve(rows)

        yield from batches_of(stream(), spans_type)

    def strings(parts):
        import xxhash
        schema = pa.schema([*[(c, pa.int64()) for c in ("a", "b", "n", "i", "t", "s")]])
        for part in parts:
            def each(part=part):
                for _, _, n, i, t, s, x in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    for j in range(len(x) - length + 1):
                        h = np.frombuffer(xxhash.xxh3_128_digest(x[j:j + length]), dtype="<i8")
                        yield int(h[0]), int(h[1]), n, i, t, (s >> 32) + j
            yield from batches_of(each(), schema)

    found = few.mapInArrow(sort_suffixes, "i long, t long, s long")
    each = text.where(F.col("m") > group).distinct() \
        .mapInArrow(strings, "a long, b long, n long, i long, t long, s long")
    twice = each.groupBy("a", "b").agg(F.sum("n").alias("uses")).where("uses > 1")
    many = each.join(twice, ["a", "b"]).where("n = 1") \
        .select("i", "t", F.col("s").bitwiseOR(F.shiftleft("s", 32)).alias("s"))
    return written(spark, whole.union(found).union(many).distinct(), "pfp-spans")


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", length: int = LENGTH, group: int = GROUP,
                   keep: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts
    elsewhere, in the same or another text, judged on the input.

    One row per input row: the id, ``keep``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` and, if ``with_text``,
    ``kept_text`` (characters that a cut broke are left out). Null texts are
    empty (``kept_text`` stays null); texts below ``length`` bytes stay whole;
    repeated rows are copies of one another and so lose all that is long
    enough; null ids are allowed; an empty table gives an empty result; other
    columns are ignored.
    """
    prepare(spark)
    # Copies of a row have the same spans: they fall together before the shuffle.
    spans = repeated_spans(spark, docs, id_col, text_col, length, group) \
        .groupBy("i", "t").agg(F.collect_set("s").alias("p"))
    cols = [id_col, *[c for c in keep if c not in (id_col, text_col)]]
    inner = [f"v{k}" for k in range(len(cols))]
    src = docs.select(*[F.col(c).alias(v) for c, v in zip(cols, inner, strict=True)],
                      *row_key(docs, id_col, text_col), F.col(text_col).alias("x")) \
        .join(spans, ["i", "t"], "left").select(*inner, "x", "p")
    out = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in cols],
                        T.StructField("n_bytes", T.LongType()),
                        T.StructField("n_removed", T.LongType()),
                        T.StructField("n_spans", T.LongType()),
                        T.StructField("kept_sha256", T.StringType())])
    if with_text:
        out.add("kept_text", T.StringType())

    def run(parts):
        for part in parts:
            rows, kept = [], []
            for x, p in zip(utf8(part.column("x")), part.column("p").to_pylist(), strict=True):
                left, gone, n = cut(x, p, length) if p else (x, 0, 0)
                rows.append((len(x), gone, n, hashlib.sha256(left).hexdigest()))
                kept.append(left)
            made = list(zip(*rows, strict=True)) or [[]] * 4
            cells = [*part.columns[:len(cols)], *[pa.array(c, pa.int64()) for c in made[:3]],
                     pa.array(made[3], pa.string())]
            if with_text:
                null = part.column("x").is_null().to_pylist()
                cells.append(pa.array([None if z else k.decode("utf-8", "ignore")
                                       for z, k in zip(null, kept, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(cells, names=out.names)

    return src.mapInArrow(run, out)
