"""SimHash near-duplicates through multi-index hashing.

Each fingerprint is cut into segments; there is one hash table for each
segment. A fingerprint looks up, in each table, the small Hamming ball around
its own segment value, and complete distances are verified on the matches. The
balls' radii follow the pigeonhole rule (their sum plus the number of segments
exceeds the distance), so no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import forget, prepare, row_key, utf8, written
from stockyard.llm.components import components

SEED, SHINGLE, MAX_BITS = 42, 4, 4
# Up to this many distinct fingerprints a table of 21-bit values has short
# buckets; beyond it two segments of 32 bits are used.
THREE_SEGMENTS = 1 << 27


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text (unsigned)."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    h = np.array([digest(joined[s:e], SEED)
                  for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)],
                 dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The id, ``i`` and ``t`` (the row's key) and ``fp`` (long, the
    fingerprint's 64 bits) of every row."""
    prepare(spark)
    src = docs.select(F.col(id_col).alias("id"), *row_key(docs, id_col, text_col),
                      F.col(text_col).alias("x"))
    out = T.StructType([*src.schema.fields[:3], T.StructField("fp", T.LongType())])

    def run(parts):
        forget()
        for part in parts:
            fps = np.array([fingerprint(t, shingle) for t in utf8(part.column(3))], dtype="<u8")
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(fps.view("<i8"))],
                                             names=out.names)

    return src.mapInArrow(run, out)


def plan_segments(max_bits: int, n_segments: int) -> list[tuple[int, int, int]]:
    """(offset, width, radius) for each segment; radii sum to
    ``max_bits - n_segments + 1``."""
    widths = [64 // n_segments + (i < 64 % n_segments) for i in range(n_segments)]
    spare = max(0, max_bits - n_segments + 1)
    radii = [(spare + i) // n_segments for i in range(n_segments)]
    return [(sum(widths[:i]), w, r) for i, (w, r) in enumerate(zip(widths, radii, strict=True))]


def ball(width: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` bits in a segment of ``width`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1)
            for c in combinations(range(width), r)]


def _segment(col, offset: int, width: int):
    return F.shiftrightunsigned(col, offset).bitwiseAND(F.lit((1 << width) - 1))


def nibble_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints that agree outside of one run of
    ``max_bits`` bits: each is linked to the smallest of its group, so a dense
    group of near copies gives as many links as members, not all pairs."""
    step = max(1, max_bits)
    masks = [(1 << min(step, 64 - k)) - 1 << k for k in range(0, 64, step)]
    signed = [~m if ~m >= -(1 << 63) else ~m + (1 << 64) for m in masks]
    keyed = fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("mask", "rest"))
    small = keyed.groupBy("mask", "rest").agg(F.min("fp").alias("b"), F.max("fp").alias("top")) \
        .where("top <> b").select("mask", "rest", "b")
    return keyed.join(small, ["mask", "rest"]).where("fp <> b").select(F.col("fp").alias("a"), "b")


def near_links(fps: DataFrame, max_bits: int, n_segments: int) -> DataFrame:
    """Pairs of fingerprints of different ``label`` at ``max_bits`` or fewer
    differing bits, by multi-index hashing over (``fp``, ``label``)."""
    found = None
    for offset, width, radius in plan_segments(max_bits, n_segments):
        value = _segment(F.col("fp"), offset, width)
        held = fps.select(value.alias("v"), F.col("fp").alias("b"), F.col("label").alias("lb"))
        asks = fps.select(F.explode(F.array(*[value.bitwiseXOR(F.lit(m))
                                              for m in ball(width, radius)])).alias("v"),
                          F.col("fp").alias("a"), F.col("label").alias("la"))
        hits = asks.join(held, "v").where(
            (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb"))
            & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("la", "lb")
        found = hits if found is None else found.union(hits)
    return found.select(F.col("la").alias("a"), F.col("lb").alias("b"))


def near_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                n_segments: int | None = None) -> DataFrame:
    """Fingerprint and component of every row of ``docs``.

    Columns: ``id``, ``i`` and ``t`` (the row's key), ``fp`` (long), ``root``
    (a fingerprint that names the component) and ``component_id`` (the smallest
    id reachable over links of ``max_bits`` or fewer differing bits, its own
    included). A null or wordless text has fingerprint 0 and links like any
    other; copies share a fingerprint; a null id counts for no minimum (a group
    of null ids only has a null component); an empty table gives an empty
    result; other columns are ignored.
    """
    base = written(spark, fingerprints(spark, docs, id_col, text_col, shingle), "simhash")
    fps = base.groupBy("fp").agg(F.min("id").alias("low")).checkpoint()
    if n_segments is None:
        n_segments = 3 if fps.count() <= THREE_SEGMENTS else 2
    # First the copies that differ within one run of bits, then the links
    # between the groups that this leaves.
    stars = components(spark, nibble_links(fps, max_bits))
    marked = fps.select("fp").join(stars, F.col("fp") == F.col("node"), "left") \
        .select("fp", F.coalesce("label", "fp").alias("label")).checkpoint()
    joined = components(spark, near_links(marked, max_bits, n_segments)) \
        .select(F.col("node").alias("label"), F.col("label").alias("root"))
    rooted = marked.join(joined, "label", "left") \
        .select("fp", F.coalesce("root", "label").alias("root"))
    lows = rooted.join(fps, "fp").groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.join(lows, "root").select("fp", "root", "component_id")
    return base.join(by_fp, "fp").select("id", "i", "t", "fp", "root", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row
    with the smallest id stays (null ids come last; of rows that share an id,
    that with the smallest text hash; of copies in both, the one whose other
    columns sort first). All columns are kept."""
    cells = [f"c{k}" for k in range(len(docs.columns))]
    groups = near_groups(spark, docs, id_col, text_col, shingle, max_bits)
    first = groups.groupBy("root", "i", "t").agg(F.min("id").alias("id"), F.count("*").alias("n")) \
        .groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "t", "i", "n"))
                             .alias("r"))
    stay = written(spark, first.select("r.i", "r.t", "r.n"), "simhash-stay")
    kept = docs.select(*row_key(docs, id_col, text_col),
                       F.struct(*[F.col(c).alias(x) for c, x in zip(docs.columns, cells, strict=True)])
                       .alias("row")).join(stay, ["i", "t"])
    order = F.to_json("row")
    copies = kept.where("n > 1").groupBy("i", "t").agg(F.min_by("row", order).alias("row"))
    rows = kept.where("n = 1").select("row").union(copies.select("row"))
    return rows.select(*[F.col(f"row.{x}").alias(c) for c, x in zip(docs.columns, cells, strict=True)])


def hex_fp(col):
    return F.lower(F.lpad(F.hex(col), 16, "0"))
