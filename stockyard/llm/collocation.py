"""Phrase collocation mining by SETM (set-oriented relational mining).

The occurrence relation of words is persisted in the order of its places.
Each round joins the relation of frequent phrases of k words with itself at
adjacent places of a piece (a merge join: places are in order, so the partner
of a row is the next one), counts the groups, keeps the frequent ones and
semi-joins the relation with them before it is extended again.

A relation is kept as blocks: a row holds the occurrences of some hundred
thousand successive places, as codes into the block's own list of phrases. A
break between pieces takes a place of its own, so nothing joins across it. A
block ends with the few places that follow it, so no phrase is lost at its
end. Counting sends each distinct phrase of a block, with its count, to the
bucket of its key; the bucket returns the ids of the frequent ones to the
blocks that asked. A word in a third of all places is thus one entry a block.
All counts, ids and products are exact integers.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import forget, prepare, written
from stockyard.llm.words import BREAK, chunks, piece_tokens

MAX_WORDS, MIN_COUNT, SUBSUMED_PCT, TOP = 3, 10, 50, 2000
# Places of a block; entries that a bucket takes on average, at most.
BLOCK, BUCKET_ENTRIES = 1 << 19, 1 << 20
MIN_BUCKETS = 64
UNDETERMINED = "und"

_PART = T.StructType([T.StructField("bucket", T.IntegerType()),
                      T.StructField("payload", T.BinaryType()),
                      T.StructField("names", T.BinaryType())])
_RELATION = T.StructType([T.StructField("block", T.LongType()), T.StructField("own", T.IntegerType()),
                          T.StructField("size", T.IntegerType()),
                          T.StructField("codes", T.BinaryType()),
                          T.StructField("parts", T.ArrayType(_PART))])
# Rows of a counting step: answers to blocks, frequent groups, language totals.
ANSWER, GROUP, TOTAL = 0, 1, 2
_COUNTED = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("block", T.LongType()),
                         T.StructField("payload", T.BinaryType()), T.StructField("id", T.LongType()),
                         T.StructField("left", T.LongType()), T.StructField("right", T.LongType()),
                         T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()),
                         T.StructField("a", T.LongType())])
_PART_PA = pa.struct([("bucket", pa.int32()), ("payload", pa.binary()), ("names", pa.binary())])
_RELATION_PA = pa.schema([("block", pa.int64()), ("own", pa.int32()), ("size", pa.int32()),
                          ("codes", pa.binary()), ("parts", pa.list_(_PART_PA))])
_COUNTED_PA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()),
                         ("id", pa.int64()), ("left", pa.int64()), ("right", pa.int64()),
                         ("lang", pa.string()), ("word", pa.string()), ("a", pa.int64())])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of longs, of one length, compressed; the first one is sorted."""
    first = np.diff(arrays[0], prepend=0)
    raw = np.concatenate([first, *arrays[1:]]).astype("<i8").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    """The ``n`` arrays of :func:`pack`, as rows."""
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out = np.frombuffer(raw, "<i8").reshape(n, -1).copy()
    out[0] = np.cumsum(out[0])
    return out


def _codes_out(codes: np.ndarray) -> bytes:
    return pa.compress(codes.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _codes_in(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), "<i4")


def _split(order: np.ndarray, buckets: np.ndarray):
    """(bucket, its positions in ascending order) for each bucket that occurs."""
    by = order[np.argsort(buckets[order], kind="stable")]
    at = buckets[by]
    cuts = np.flatnonzero(np.diff(at)) + 1
    for part in np.split(by, cuts):
        if len(part):
            yield int(buckets[part[0]]), part


def word_block(block: int, tokens: list[bytes], langs: list[str], lang_of: np.ndarray, own: int,
               n_buckets: int) -> tuple:
    """A row of the word relation: place codes, and the distinct (language,
    word) of the block with their counts, by bucket."""
    import xxhash

    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    names = coded.dictionary.to_pylist()
    ids = coded.indices.to_numpy().astype(np.int64)
    if len(langs) > 1:
        ids, inverse = np.unique(ids * len(langs) + lang_of, return_inverse=True)
        keys = [(langs[k % len(langs)], names[k // len(langs)]) for k in ids.tolist()]
    else:
        inverse, keys = ids, [(langs[0], w) for w in names]
    words = np.array([w != BREAK for _, w in keys], dtype=bool)
    code_of = np.where(words, np.cumsum(words), 0)  # breaks are 0, words count from 1
    codes = code_of[inverse]
    full = [f"{quote(g, safe='')} ".encode() + w for g, w in keys if w != BREAK]
    counts = np.bincount(codes[:own], minlength=len(full) + 1)
    buckets = np.array([0, *(xxhash.xxh64_intdigest(x) % n_buckets for x in full)], dtype=np.int64)
    parts = []
    for b, at in _split(np.arange(1, len(full) + 1), buckets):
        blob = b"\n".join(full[k - 1] for k in at.tolist())
        parts.append({"bucket": b, "payload": pack(at, counts[at]),
                      "names": pa.compress(blob, codec="zstd", asbytes=True)
                      + len(blob).to_bytes(8, "little")})
    return block, own, len(codes), _codes_out(codes), parts


def _names(data: bytes) -> list[bytes]:
    blob = pa.decompress(data[:-8], int.from_bytes(data[-8:], "little"), codec="zstd", asbytes=True)
    return blob.split(b"\n")


def word_relation(docs: DataFrame, text_col: str, lang_col: str, max_words: int,
                  n_buckets: int, block_size: int) -> DataFrame:
    """The occurrence relation of words in blocks."""
    ahead = max_words - 1
    src = docs.select(F.col(text_col).alias("x"),
                      F.coalesce(F.col(lang_col), F.lit(UNDETERMINED)).alias("g"))

    def run(parts):
        from pyspark import TaskContext

        forget()
        base, made = TaskContext.get().partitionId() << 32, 0
        tokens: list[bytes] = []
        runs: list[tuple[str, int]] = []  # languages of the tokens, run by run

        def cut(own, size):
            """The first ``size`` tokens as a block, of which ``own`` go."""
            nonlocal tokens, runs, made
            langs: dict[str, int] = {}
            spans, kept, at = [], [], 0
            for g, n in runs:
                here = max(0, min(n, size - at))
                if here:
                    spans.append((langs.setdefault(g, len(langs)), here))
                rest = n - max(0, min(n, own - at))
                if rest:
                    kept.append((g, rest))
                at += n
            lang_of = np.repeat([c for c, _ in spans], [n for _, n in spans])
            row = word_block(base + made, tokens[:size], list(langs), lang_of, own, n_buckets)
            tokens, runs, made = tokens[own:], kept, made + 1
            return pa.RecordBatch.from_pylist([dict(zip(_RELATION_PA.names, row, strict=True))],
                                              schema=_RELATION_PA)

        for part in parts:
            langs = part.column(1).to_pylist()
            for k, x in enumerate(part.column(0)):
                text = x.as_py()
                for chunk in chunks((text or "").encode()):
                    more = piece_tokens(chunk)
                    tokens += more
                    runs.append((langs[k], len(more)))
                    while len(tokens) >= block_size + ahead:
                        yield cut(block_size, block_size + ahead)
                tokens.append(BREAK)
                runs.append((langs[k], 1))
        while tokens:
            own = min(block_size, len(tokens))
            yield cut(own, min(len(tokens), own + ahead))

    return src.mapInArrow(run, _RELATION)


def _rows(kind: int, n: int, **cols) -> pa.RecordBatch:
    arrays = [pa.array(np.full(n, kind), pa.int32()) if f.name == "kind" else
              pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type)
              for f in _COUNTED_PA]
    return pa.RecordBatch.from_arrays(arrays, schema=_COUNTED_PA)


def _answers(table: pa.Table, asked: list[np.ndarray], ids: np.ndarray) -> list[pa.RecordBatch]:
    """To each block the codes and ids of its frequent entries; ``ids`` (-1:
    not frequent) has the entries of all blocks in a row."""
    out, at = [], 0
    for block, codes in zip(table.column("block").to_pylist(), asked, strict=True):
        mine = ids[at:at + len(codes)]
        at += len(codes)
        good = mine >= 0
        if good.any():
            out.append((block, pack(codes[good], mine[good])))
    return [_rows(ANSWER, len(out), block=[b for b, _ in out], payload=[p for _, p in out])]


def count_words(relation: DataFrame, min_count: int, n_buckets: int) -> DataFrame:
    """Frequent words, answers to the blocks, words in all of each language."""
    def run(table: pa.Table) -> pa.Table:
        forget()
        bucket = table.column("bucket")[0].as_py()
        asked = [unpack(p, 2) for p in table.column("payload").to_pylist()]
        names = [w for blob in table.column("names").to_pylist() for w in _names(blob)]
        coded = pa.array(names, pa.binary()).dictionary_encode()
        at = coded.indices.to_numpy()
        words = coded.dictionary.to_pylist()
        totals = np.zeros(len(words), dtype=np.int64)
        np.add.at(totals, at, np.concatenate([a[1] for a in asked]))
        frequent = totals >= min_count
        ids = np.where(frequent, (np.cumsum(frequent) - 1) * n_buckets + bucket, -1)
        split = [w.decode().split(" ", 1) for w in words]
        langs: dict[str, int] = {}
        for (g, _), n in zip(split, totals.tolist(), strict=True):
            langs[g] = langs.get(g, 0) + n
        good = np.flatnonzero(frequent)
        return pa.Table.from_batches([
            *_answers(table, [a[0] for a in asked], ids[at]),
            _rows(GROUP, len(good), id=ids[good], a=totals[good],
                  lang=[unquote(split[k][0]) for k in good], word=[split[k][1] for k in good]),
            _rows(TOTAL, len(langs), lang=[unquote(g) for g in langs], a=list(langs.values()))])

    parts = relation.select("block", F.inline("parts"))
    return parts.groupBy("bucket").applyInArrow(run, _COUNTED)


def count_pairs(relation: DataFrame, min_count: int, n_buckets: int) -> DataFrame:
    """Frequent phrases, as pairs of ids of the phrases without the last and
    without the first word, and answers to the blocks."""
    def run(table: pa.Table) -> pa.Table:
        forget()
        bucket = table.column("bucket")[0].as_py()
        asked = [unpack(p, 4) for p in table.column("payload").to_pylist()]
        left, right, n = (np.concatenate([a[k] for a in asked]) for k in (1, 2, 3))
        order = np.lexsort((right, left))
        sl, sr = left[order], right[order]
        fresh = np.concatenate([[True], (sl[1:] != sl[:-1]) | (sr[1:] != sr[:-1])])
        starts = np.flatnonzero(fresh)
        totals = np.add.reduceat(n[order], starts)
        frequent = totals >= min_count
        gids = np.where(frequent, (np.cumsum(frequent) - 1) * n_buckets + bucket, -1)
        ids = np.empty(len(left), dtype=np.int64)
        ids[order] = gids[np.cumsum(fresh) - 1]
        at = starts[frequent]
        return pa.Table.from_batches([
            *_answers(table, [a[0] for a in asked], ids),
            _rows(GROUP, len(at), id=gids[frequent], left=sl[at], right=sr[at], a=totals[frequent])])

    parts = relation.select("block", F.inline("parts"))
    return parts.groupBy("bucket").applyInArrow(run, _COUNTED)


def _mix(left: np.ndarray, right: np.ndarray, n_buckets: int) -> np.ndarray:
    h = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) \
        + right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def extend(relation: DataFrame, counted: DataFrame, n_buckets: int) -> DataFrame:
    """The relation of phrases that are one word longer: semi-join with the
    frequent groups, then merge join of adjacent places."""
    answers = counted.where(F.col("kind") == ANSWER).groupBy("block") \
        .agg(F.collect_list("payload").alias("answers"))
    src = relation.select("block", "own", "size", "codes").join(answers, "block")

    def run(parts):
        forget()
        for part in parts:
            for row in part.to_pylist():
                yield joined(row)

    def joined(row):
        codes, own = _codes_in(row["codes"], row["size"]), row["own"]
        known = np.full(int(codes.max(initial=0)) + 1, -1, dtype=np.int64)
        for data in row["answers"]:
            code, gid = unpack(data, 2)
            known[code] = gid
        ids = known[codes]
        # Places are in order: the adjacent place of a row is the next one.
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        pair = codes[at].astype(np.int64) * len(known) + codes[at + 1]
        keys, inverse = np.unique(pair, return_inverse=True)
        counts = np.bincount(inverse[at < own], minlength=len(keys))
        left, right = known[keys // len(known)], known[keys % len(known)]
        longer = np.zeros(row["size"], dtype=np.int32)
        longer[at] = inverse + 1
        out = [{"bucket": b, "names": None,
                "payload": pack(k + 1, left[k], right[k], counts[k])}
               for b, k in _split(np.arange(len(keys)), _mix(left, right, n_buckets))]
        made = row["block"], own, row["size"], _codes_out(longer), out
        return pa.RecordBatch.from_pylist([dict(zip(_RELATION_PA.names, made, strict=True))],
                                          schema=_RELATION_PA)

    return src.mapInArrow(run, _RELATION)


def _cut_score(length: int):
    """The lowest-scoring cut: a struct of ``score``, ``k``, ``l`` and ``r``."""
    def whole(c):
        return c.cast("decimal(19,0)")

    cuts = []
    for k in range(1, length):
        first, rest = F.col("L.pre")[k - 1], F.col("R.suf")[length - k - 1]
        top = whole(F.col("C.a")) * whole(F.col("C.a")) * F.lit(1_000_000).cast("decimal(7,0)")
        cuts.append(F.struct(F.call_function("div", top, whole(first) * whole(rest)).alias("score"),
                             F.lit(k).alias("k"), first.alias("l"), rest.alias("r")))
    return F.array_min(F.array(*cuts))


def _levels(spark: SparkSession, counted: list[DataFrame]) -> list[DataFrame]:
    """Frequent phrases of each length: ``id``, ``lang``, ``words``, ``a``,
    counts of their first and last 1, 2, ... words (``pre``, ``suf``), and
    from two words on ``left``, ``right`` (the phrases they extend) and ``cut``."""
    def groups(df):
        return df.where(F.col("kind") == GROUP)

    one = groups(counted[0]).select("id", "lang", F.array("word").alias("words"), "a",
                                    F.array("a").alias("pre"), F.array("a").alias("suf"))
    out = [one]
    for length, df in enumerate(counted[1:], 2):
        c, before = groups(df).alias("C"), out[-1]
        got = c.join(before.alias("L"), F.col("C.left") == F.col("L.id")) \
            .join(before.alias("R"), F.col("C.right") == F.col("R.id")) \
            .select("C.id", "L.lang",
                    F.concat("L.words", F.slice("R.words", -1, 1)).alias("words"), "C.a",
                    F.concat("L.pre", F.array("C.a")).alias("pre"),
                    F.concat("R.suf", F.array("C.a")).alias("suf"),
                    "C.left", "C.right", _cut_score(length).alias("cut"))
        out.append(written(spark, got, f"phrases-{length}"))
    return out


def _top(df: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language: first of slices of a language,
    then of what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = df.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    few = sliced.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def mine(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
         max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
         subsumed_pct: int = SUBSUMED_PCT, top: int = TOP,
         block_size: int = BLOCK) -> DataFrame:
    """The best collocations of 2 to ``max_words`` words of each language.

    Returns ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r``
    (counts of the parts at its lowest-scoring cut), ``n`` (words of the
    language) and ``score`` (floor of 10^6 a a / (l r)), ``top`` rows for each
    language. A phrase is a candidate from ``min_count`` occurrences on, and
    goes if a longer candidate that holds it has at least ``subsumed_pct``
    hundredths of its count.

    Null texts are empty, a null language is ``und``; repeated rows count each
    time; ties go by count, then by the phrase's bytes; a very long text is read
    in chunks and spans blocks; an empty table, or one without frequent phrases,
    gives an empty result; other columns are ignored. A language whose parts
    are all rare has no rows.
    """
    prepare(spark)
    if max_words < 2 or min_count < 1:
        raise ValueError("phrases take two words and one occurrence at least")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = max(MIN_BUCKETS, size // (64 << 20))
    relation = written(spark, word_relation(docs, text_col, lang_col, max_words, n_buckets,
                                            block_size), "words")
    counted = [written(spark, count_words(relation, min_count, n_buckets), "counts-1")]
    n_buckets = max(MIN_BUCKETS, (relation.agg(F.sum("size")).first()[0] or 0) // BUCKET_ENTRIES)
    for length in range(2, max_words + 1):
        longer = extend(relation, counted[-1], n_buckets)
        if length < max_words:
            relation = longer = written(spark, longer, f"relation-{length}")
        counted.append(written(spark, count_pairs(longer, min_count, n_buckets),
                               f"counts-{length}"))
    levels = _levels(spark, counted)
    found = None
    for k, level in enumerate(levels[1:], 1):
        if k + 1 < len(levels):
            up = levels[k + 1]
            most = up.select(F.col("left").alias("id"), "a") \
                .union(up.select(F.col("right").alias("id"), "a")) \
                .groupBy("id").agg(F.max("a").alias("most"))
            level = level.join(most, "id", "left") \
                .where(F.col("most").isNull() | (100 * F.col("most") < subsumed_pct * F.col("a")))
        rows = level.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l",
                            "cut.r", "cut.score")
        found = rows if found is None else found.union(rows)
    totals = counted[0].where(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("a").alias("n"))
    return _top(found, top).join(totals, "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
