"""MinHash near-duplicates: banding, signature checks, exact links, components.

A document's set holds its distinct word shingles, as 64-bit hashes. Its
signature is the least value of each of many universal hash functions. Sets
that agree in all minima of a band share a bucket. Copies of one set are one
node; nodes of a bucket are compared by size and signature, and a link counts
only when the full sets confirm it.

A bucket may hold thousands of variants of one text, so its pairs are never
listed: inside a bucket, arrays of signatures are compared, and every node of a
group that may be linked is joined to the group's centre only. First a node is
checked against the likeliest of its centres, which links most of a group. What
may be linked at all forms families; where a family still has several
components, nodes outside of the largest are compared with all others by matrix
products over their full sets, in tiles of bounded size, of which only links
between components leave the task.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import forget, prepare, written
from stockyard.llm.components import components
from stockyard.llm.words import chunks, space_words

SHINGLE, PERCENT = 2, 80
# A pair at the threshold shares no bucket with a chance of
# (1 - 0.8^4)^32 = 5e-8.
BANDS, ROWS, SEED = 32, 4, 42
# Against how many centres of its buckets a node is checked at first.
CHECKS = 1
# Nodes of a bucket's slice, hashes of a family's slice, columns of a matrix.
SLICE, TILE_HASHES, _COLUMNS = 1024, 1 << 18, 4096
# Signatures may differ from what the threshold lets expect by this many
# standard deviations.
SIGMAS = 5
_HASH_ROWS = 2048


def universal(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of ``n`` multiply-shift hash functions."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)


def shingle_hashes(data: bytes, shingle: int) -> np.ndarray:
    """The set of a text: sorted hashes of its distinct word shingles, of the
    whole sequence if it has fewer words; empty without words."""
    import xxhash

    digest, carry, out = xxhash.xxh3_64_intdigest, [], []
    for chunk in chunks(data):
        words = carry + space_words(chunk)
        if len(words) >= shingle:
            joined = words
            for k in range(1, shingle):
                joined = [p + b" " + q for p, q in zip(joined, words[k:], strict=False)]
            out.append(np.unique(np.array(list(map(digest, joined)), dtype=np.uint64)))
        carry = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
    if not out and carry:
        out = [np.array([digest(b" ".join(carry))], dtype=np.uint64)]
    if not out:
        return np.zeros(0, dtype=np.uint64)
    return out[0] if len(out) == 1 else np.unique(np.concatenate(out))


def signature(hashes: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The 32-bit minimum of each hash function over a set that is not empty."""
    low = None
    for k in range(0, len(hashes), _HASH_ROWS):
        v = hashes[k:k + _HASH_ROWS, None] * odd
        v += add
        part = v.min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return low >> np.uint64(32)


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band of ``rows`` minima."""
    bands = minima[:len(minima) // rows * rows].reshape(-1, rows)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = (key ^ bands[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
    return key


def sketch(minima: np.ndarray) -> np.ndarray:
    """The two lowest bits of each minimum, 32 of them in a long."""
    two = (minima & np.uint64(3)).reshape(-1, 32)
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(two << shifts, axis=1)


def most_mismatches(n: int, percent: int) -> int:
    """Positions in which two sketches of ``n`` minima may differ."""
    p = (1 - percent / 100) * 3 / 4
    return math.ceil(n * p + SIGMAS * math.sqrt(n * p * (1 - p)))


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int,
               seed: int) -> DataFrame:
    """``id``, ``text``, ``n`` (size of the set), ``d1`` and ``d2`` (its
    digest), ``sketch`` and ``keys`` of every row."""
    n_sketch = -(-bands * rows // 32)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = T.StructType([*src.schema.fields, T.StructField("n", T.LongType()),
                        T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                        *[T.StructField(f"s{k}", T.LongType()) for k in range(n_sketch)],
                        T.StructField("keys", T.ArrayType(T.LongType()))])
    odd, add = universal(32 * n_sketch, seed)

    def run(parts):
        import xxhash

        forget()
        for part in parts:
            made = []
            for x in part.column(1):
                hashes = shingle_hashes((x.as_py() or "").encode(), shingle)
                if not len(hashes):
                    made.append((0, 0, 0, *[0] * n_sketch, None))
                    continue
                d = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8")
                minima = signature(hashes, odd, add)
                made.append((len(hashes), int(d[0]), int(d[1]),
                             *sketch(minima).view(np.int64).tolist(),
                             band_keys(minima[:bands * rows], rows).view(np.int64)))
            cols = list(zip(*made, strict=True)) or [[] for _ in out.fields[2:]]
            types = [pa.int64()] * (len(out.fields) - 3) + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                names=out.names)

    return src.mapInArrow(run, out)


def groups_of(parts, n_keys: int):
    """The runs of rows that agree in the first ``n_keys`` columns (longs), as
    Arrow tables, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        if not part.num_rows:
            continue
        keys = np.stack([np.asarray(part.column(k)) for k in range(n_keys)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if held:
            last = held[-1]
            if any(last.column(k)[-1].as_py() != keys[k, 0] for k in range(n_keys)):
                yield pa.Table.from_batches(held)
                held = []
        for a, b in zip([0, *cuts.tolist()], cuts.tolist(), strict=False):
            yield pa.Table.from_batches([*held, part.slice(a, b - a)])
            held = []
        held.append(part.slice(int(cuts[-1]) if len(cuts) else 0))
    if held:
        yield pa.Table.from_batches(held)


def mismatches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many positions each sketch of ``a`` differs from each of ``b``
    (rows of longs)."""
    low, out = np.uint64(0x5555555555555555), 0
    for k in range(a.shape[1]):
        diff = a[:, k, None] ^ b[None, :, k]
        out = out + np.bitwise_count((diff | diff >> np.uint64(1)) & low).astype(np.int32)
    return out


def least_labels(near: np.ndarray) -> np.ndarray:
    """The least index reachable from each over a symmetric relation."""
    label = np.arange(len(near))
    while True:
        low = np.where(near, label[None, :], len(near)).min(axis=1)
        low = np.minimum(label, low)[np.minimum(label, low)]
        if (low == label).all():
            return label
        label = low


def stars(node: np.ndarray, size: np.ndarray, sketches: np.ndarray, percent: int, most: int):
    """In a bucket: (node, centre, mismatches) for every node of a group whose
    sizes and sketches allow links, the centre being the node that is likely
    to link with most others. Mismatches are negative where node and centre
    themselves do not look alike."""
    miss = mismatches(sketches, sketches)
    near = (miss <= most) & (100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size))
    np.fill_diagonal(near, True)
    degree, total = near.sum(axis=1), np.where(near, miss, 0).sum(axis=1)
    if not (degree > 1).any():
        return
    label = least_labels(near)
    for g in np.unique(label[degree > 1]):
        mine = np.flatnonzero(label == g)
        # Most likely partners, then the closest ones, then the smallest node.
        centre = mine[np.lexsort((node[mine], total[mine], -degree[mine]))[0]]
        for k in mine.tolist():
            if k != centre:
                yield int(node[k]), int(node[centre]), int(miss[k, centre]) if near[k, centre] else -1


def bucket_stars(crowd: DataFrame, nodes: DataFrame, n_sketch: int, percent: int, most: int) -> DataFrame:
    """The stars of all buckets. A bucket of more than :data:`SLICE` nodes is
    dealt to tiles, each of two of its slices (or one with itself), so that any
    two of its nodes meet in some tile."""
    slices = crowd.groupBy("key").agg(F.ceil(F.count("*") / SLICE).alias("of")).where("of > 1")
    dealt = crowd.join(slices, "key", "left").withColumn("of", F.coalesce("of", F.lit(1))) \
        .withColumn("s", F.pmod(F.xxhash64("node"), F.col("of")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1))
    tiles = dealt.select("key", "node", "s", other.alias("o")).select(
        "key", F.least("s", "o").alias("i"), F.greatest("s", "o").alias("j"), "node") \
        if slices.count() else dealt.select("key", F.lit(0).cast("long").alias("i"),
                                            F.lit(0).cast("long").alias("j"), "node")
    src = tiles.join(nodes, "node").select("key", "i", "j", "node", "n",
                                           *[f"s{k}" for k in range(n_sketch)]) \
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    out = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "miss")])

    def run(parts):
        forget()
        rows: list[tuple] = []
        for t in groups_of(parts, 3):
            if t.num_rows > 1:
                cols = [np.asarray(t.column(k)) for k in range(3, len(t.schema))]
                rows += stars(cols[0], cols[1], np.stack(cols[2:], axis=1).view(np.uint64), percent, most)
            if len(rows) > 50_000:
                yield _longs(rows, out.names)
                rows = []
        yield _longs(rows, out.names)

    return src.mapInArrow(run, out)


def _longs(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)


@contextmanager
def few_rows_shuffled(spark: SparkSession):
    """Lets Spark drop rows without a partner, by a Bloom filter, before a join
    shuffles them, for tables of any size."""
    base = "spark.sql.optimizer.runtime.bloomFilter."
    ours = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1GB",
            "expectedNumItems": "4000000", "numBits": str(1 << 26)}
    before = {k: spark.conf.get(base + k) for k in ours}
    try:
        for k, v in ours.items():
            spark.conf.set(base + k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(base + k, v)


def confirmed(spark: SparkSession, base: DataFrame, pairs: DataFrame, shingle: int,
              percent: int) -> DataFrame:
    """The ``pairs`` (a stored table with ``miss``) whose full sets reach the
    threshold; many ``a`` share a ``b``."""
    def texts(name, text):
        return base.select(F.col("row").alias(name), F.col("text").alias(text))

    # All rows meet the conditions; they let the planner filter the texts by them.
    centres = written(spark, pairs.groupBy("b").agg(F.max("miss").alias("miss")), "minhash-centres")
    held = written(spark, centres.where("miss >= 0").join(texts("b", "tb"), "b").select("b", "tb"),
                   "minhash-centre-texts")
    both = pairs.where("miss >= 0").select("a", "b").join(texts("a", "ta"), "a").join(held, "b") \
        .select("a", "b", "ta", "tb")
    out = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(parts):
        forget()
        last: dict[str, tuple] = {"a": (None, None), "b": (None, None)}
        for part in parts:
            good = []
            for k, (a, b) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                           strict=True)):
                sets = []
                for name, node, col in (("a", a, 2), ("b", b, 3)):
                    if last[name][0] != node:
                        last[name] = node, shingle_hashes(part.column(col)[k].as_py().encode(), shingle)
                    sets.append(last[name][1])
                common = len(np.intersect1d(*sets, assume_unique=True))
                good.append(100 * common >= percent * (len(sets[0]) + len(sets[1]) - common))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=out.names) \
                .filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, out)


def best_checks(pairs: DataFrame, checks: int) -> DataFrame:
    """For each ``a`` its ``checks`` likeliest partners."""
    order = Window.partitionBy("a").orderBy("miss", "b")
    return pairs.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= checks) \
        .select("a", "b", "miss")


def tile_links(asks: list[np.ndarray], ask_label: np.ndarray, held: list[np.ndarray],
               held_label: np.ndarray, percent: int):
    """Index pairs of linked sets of different labels: enough of them to tell
    what all such links connect. Common sizes are products of 0/1 matrices over
    the hashes that occur on both sides."""
    common = np.zeros((len(asks), len(held)), dtype=np.int64)
    words = np.intersect1d(np.concatenate(asks), np.concatenate(held))
    places = [[np.searchsorted(words, s[np.isin(s, words, assume_unique=True)]) for s in side]
              for side in (asks, held)]
    for start in range(0, len(words), _COLUMNS):
        dense = []
        for side in places:
            block = np.zeros((len(side), min(_COLUMNS, len(words) - start)), dtype=np.float32)
            for k, at in enumerate(side):
                lo, hi = np.searchsorted(at, [start, start + _COLUMNS])
                block[k, at[lo:hi] - start] = 1
            dense.append(block)
        common += (dense[0] @ dense[1].T).astype(np.int64)
    sizes = np.add.outer([len(s) for s in asks], [len(s) for s in held])
    linked = (100 * common >= percent * (sizes - common)) & (ask_label[:, None] != held_label[None, :])
    for k in np.flatnonzero(linked.any(axis=1)).tolist():
        at = np.flatnonzero(linked[k])
        _, first = np.unique(held_label[at], return_index=True)  # one link a label
        for j in at[first].tolist():
            yield k, j


def tiles_of(families: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (``family``, ``i``, ``j``, ``asks``, ``node``, ``label``) of the
    families in which not all is linked: nodes outside of the family's largest
    component ask all nodes. Both sides are dealt to slices of bounded size, and
    each pair of slices is a tile."""
    marked = families.join(labels, "node", "left") \
        .select("family", "node", "n", F.coalesce("label", "node").alias("label"))
    parts = marked.groupBy("family", "label").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    # Two nodes of a family have been compared already.
    mixed = parts.groupBy("family").agg(
        F.max_by("label", F.struct("m", "label")).alias("main"), F.sum("n").alias("n"),
        F.max_by("n", F.struct("m", "label")).alias("main_n"), F.count("*").alias("labels"),
        F.sum("m").alias("m")).where("labels > 1 AND m > 2")
    dealt = marked.join(mixed.select(
        "family", "main", F.ceil(F.col("n") / TILE_HASHES).alias("held_of"),
        F.ceil((F.col("n") - F.col("main_n")) / TILE_HASHES).alias("ask_of")), "family")

    def slice_of(of):
        return F.pmod(F.xxhash64("node"), F.col(of))

    def others(of):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    cells = [F.col("node"), F.col("label")]
    asks = dealt.where("label <> main").select(
        "family", slice_of("ask_of").alias("i"), others("held_of").alias("j"), F.lit(1).alias("asks"), *cells)
    held = dealt.select(
        "family", others("ask_of").alias("i"), slice_of("held_of").alias("j"), F.lit(0).alias("asks"), *cells)
    return asks.union(held)


def family_links(base: DataFrame, tiles: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between different components of a family, on full sets; ``tiles``
    is a stored table."""
    texts = base.select(F.col("row").alias("node"), "text")
    src = tiles.where("asks >= 0").join(texts, "node") \
        .select("family", "i", "j", "asks", "node", "label", "text").repartition("family", "i", "j") \
        .sortWithinPartitions("family", "i", "j", "asks", "node")
    out = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(parts):
        forget()
        for t in groups_of(parts, 3):
            asks = np.asarray(t.column("asks")).astype(bool)
            node, label = np.asarray(t.column("node")), np.asarray(t.column("label"))
            sets = [shingle_hashes(x.as_py().encode(), shingle) for x in t.column("text")]
            side = [np.flatnonzero(asks), np.flatnonzero(~asks)]
            if len(side[0]) and len(side[1]):
                found = tile_links([sets[k] for k in side[0]], label[side[0]],
                                   [sets[k] for k in side[1]], label[side[1]], percent)
                yield _longs([(int(node[side[0][k]]), int(node[side[1][j]])) for k, j in found], out.names)

    return src.mapInArrow(run, out)


def near_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                bands: int = BANDS, rows: int = ROWS, seed: int = SEED,
                checks: int = CHECKS) -> DataFrame:
    """Near-duplicate component of every row.

    Columns: ``doc_id``, ``n_shingles`` (size of its set), ``component_id``
    (the smallest id reachable over links, its own included) and ``kept``
    (whether that is its own id). Sets link when their common part has
    ``percent`` hundredths or more of their union. A null, empty or wordless
    text has an empty set and links with nothing, not even its like; repeated
    rows and ids are copies of one set; a null id counts for no minimum, and a
    group of null ids only has a null component, whose rows count as kept;
    a very long text is read in chunks; an empty table gives an empty result;
    other columns are ignored.
    """
    prepare(spark)
    n_sketch = -(-bands * rows // 32)
    most = most_mismatches(32 * n_sketch, percent)
    base = written(spark, signatures(docs, id_col, text_col, shingle, bands, rows, seed)
                   .withColumn("row", F.monotonically_increasing_id()), "minhash")
    sets = written(spark, base.where("n > 0").groupBy("d1", "d2")
                   .agg(F.min("row").alias("node"), F.min("id").alias("low")), "minhash-sets")
    nodes = base.join(sets.select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")) \
        .where("first <> last").select("key")
    crowd = written(spark, keyed.join(buckets, "key"), "minhash-buckets")
    cells = ["node", "n", *[f"s{k}" for k in range(n_sketch)]]
    found = written(spark, bucket_stars(crowd, nodes.select(*cells), n_sketch, percent, most),
                    "minhash-stars").groupBy("a", "b").agg(F.max("miss").alias("miss"))
    found = written(spark, found, "minhash-pairs")
    first = written(spark, best_checks(found.where("miss >= 0"), checks), "minhash-checks")
    with few_rows_shuffled(spark):
        links = written(spark, confirmed(spark, base, first, shingle, percent), "minhash-links")
    labels = components(spark, links)
    families = components(spark, found.select("a", "b")) \
        .select("node", F.col("label").alias("family")).join(nodes.select("node", "n"), "node")
    tiles = written(spark, tiles_of(families, labels), "minhash-tiles")
    with few_rows_shuffled(spark):
        more = written(spark, family_links(base, tiles, shingle, percent), "minhash-links")
    labels = components(spark, links.union(more))
    rooted = sets.join(labels, "node", "left") \
        .select("d1", "d2", "low", F.coalesce("label", "node").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_set = rooted.join(lows, "root").select("d1", "d2", "component_id")
    cells = ["id", "n", "d1", "d2"]
    full = base.where("n > 0").select(*cells).join(by_set, ["d1", "d2"])
    none = base.where("n = 0").select(*cells, F.col("id").alias("component_id"))
    return full.select("id", "n", "component_id").union(none.select("id", "n", "component_id")) \
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
