"""Language-model scoring with a hashed maximum-entropy model.

A token's probability is that of its class given the two words before it, times
that of the token in its class. The class softmax has hashed features: the word
before, the word before that (a skip), and both together. The ``HEAD`` most
frequent words share classes by rank, and a second softmax with hashed features
of its own tells the words of such a class apart. All other words, seen or not,
belong to a class by their ending and have their smoothed share of its counts.
As context every word counts by itself, rare or not.

Texts are split once: each is written as the numbers of its words, which the
rounds of training and the scoring read. Word counts come from all training
texts, and the weight tables have a row for every ``WORDS_A_ROW`` distinct words,
so the model grows with the corpus. The weights are trained on all of
them too, by distributed updates: in each round every task takes gradient steps
over its own texts from the same start, and the rows of the weight tables are
averaged by how often each task met them.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import batches_of, crc_mod, forget, once, prepare, utf8, written

SIZE = 32                 # words of a head class
HEAD_CLASSES = 16
HEAD = SIZE * HEAD_CLASSES
TAIL_CLASSES = 16
CLASSES = HEAD_CLASSES + TAIL_CLASSES
# Distinct words for each hashed row of the class weights (the word weights have
# half as many rows); the fewest rows, and the most, which take 16 MB.
WORDS_A_ROW, LEAST_ROWS, MOST_ROWS = 64, 1 << 15, 1 << 17
# Training tasks at least, and bytes of texts that a task reads for each byte of
# weights that it sends.
LEAST_TASKS, READ_FOR_SENT = 8, 8
ROUNDS = 2
STEP = 0.8
MINI = 16_384             # tokens of one gradient step
BLOCK = 2_048             # rows of one message of weights
SLICE_BYTES = 1 << 20     # text that is turned into arrays at a time
SLICE_TOKENS = 1 << 18    # tokens that are trained on or scored at a time
RARE_BITS = 22            # of the hash that tells rare words apart as context
COUNT_BYTES = 16 << 20    # text whose words are counted at a time
# Words whose counts every task holds; the counts of rarer ones are joined.
FREQUENT = 300_000
END = b""
_MULT = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def tokens(text: bytes) -> list[bytes]:
    """Words, lower-cased in A-Z, and the end."""
    return [*text.lower().split(), END]


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


def table_rows(distinct: int) -> int:
    """Rows of the class weights for so many distinct words: a power of two."""
    return min(MOST_ROWS, max(LEAST_ROWS, 1 << (distinct // WORDS_A_ROW).bit_length()))


class Vocabulary:
    """The frequent words by rank with their counts, the class totals and the
    sizes of the weight tables. A rarer word has a number past the frequent
    ones that tells its class and a hash."""

    def __init__(self, words: list[bytes], counts: list[int], tail_n: list[int],
                 tail_v: list[int], total: int, distinct: int):
        self.id = {w: k for k, w in enumerate(words)}
        self.n = len(words)
        self.total, self.distinct = total, distinct
        self.rows = table_rows(distinct)
        self.word_rows = self.rows // 2
        c = np.array(counts, dtype=np.float64)
        self._log_c = np.append(np.log10(c + 0.5), 0.0)
        self.start = self.n + (TAIL_CLASSES << RARE_BITS)
        self._cls = np.array([k // SIZE if k < HEAD else HEAD_CLASSES + tail_class(w)
                              for k, w in enumerate(words)] + [0], dtype=np.int64)
        self.norm = np.log10(np.array(tail_n) + 0.5 * (np.array(tail_v) + 1.0))
        head = np.zeros(HEAD)
        head[:min(HEAD, len(c))] = c[:HEAD]
        self.head = np.where(head > 0, np.log(np.maximum(head, 1)), -1e9) \
            .reshape(HEAD_CLASSES, SIZE).astype(np.float32)
        mass = head.reshape(HEAD_CLASSES, SIZE).sum(axis=1)
        self.bias = np.concatenate([np.where(mass > 0, np.log(np.maximum(mass, 1)), -1e9),
                                    np.log(np.array(tail_n) + 0.5)]).astype(np.float32)

    def cls(self, ids: np.ndarray) -> np.ndarray:
        rare = HEAD_CLASSES + (ids - self.n) % TAIL_CLASSES
        return np.where(ids < self.n, self._cls[np.minimum(ids, self.n)], rare)

    def log_c(self, ids: np.ndarray) -> np.ndarray:
        """Log of the smoothed count of frequent words, 0 for rarer ones."""
        return self._log_c[np.minimum(ids, self.n)]

    def read(self, texts: list[bytes]):
        """Flat ids of the tokens of several texts, the first token of each
        text, and the rare words of each."""
        flat: list[bytes] = []
        starts = []
        for t in texts:
            starts.append(len(flat))
            flat += tokens(t)
        ids = np.fromiter(map(self.id.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        late = np.flatnonzero(ids < 0)
        rare: list[dict[bytes, int]] = [{} for _ in texts]
        owner = np.searchsorted(starts, late, side="right") - 1
        words = [flat[at] for at in late.tolist()]
        for k, w in zip(owner.tolist(), words, strict=True):
            seen = rare[k]
            seen[w] = seen.get(w, 0) + 1
        crc = zlib.crc32
        number = np.fromiter(map(crc, words), dtype=np.int64, count=len(words)) >> (32 - RARE_BITS)
        ending = np.fromiter(map(crc, [w[-2:] for w in words]), dtype=np.int64, count=len(words))
        ids[late] = number * TAIL_CLASSES + ending % TAIL_CLASSES + self.n
        return ids, np.array(starts, dtype=np.int64), rare


def slices(texts: list[bytes], size: int = SLICE_BYTES):
    """The texts in runs of about ``size`` bytes (a longer text by itself)."""
    run: list[bytes] = []
    held = 0
    for t in texts:
        if run and held + len(t) > size:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run


def contexts(v: Vocabulary, ids: np.ndarray, starts: np.ndarray, cls: np.ndarray):
    """Hashed rows of the class features (three a token), and of the word
    features of each token's own class."""
    one = np.concatenate(([v.start], ids[:-1]))
    one[starts] = v.start
    two = np.concatenate(([v.start], one[:-1]))
    two[starts] = v.start
    a, b = one.astype(np.uint64), two.astype(np.uint64)
    shift = np.uint64(64 - v.rows.bit_length() + 1)
    with np.errstate(over="ignore"):
        x = [(a + np.uint64(1)) * _MULT[0], (b + np.uint64(1)) * _MULT[1],
             ((a + np.uint64(1)) * _MULT[0] ^ (b + np.uint64(7)) * _MULT[2]) * _MULT[1]]
        rows = [(h >> shift).astype(np.int32) for h in x]
        word = (a * np.uint64(CLASSES) + cls.astype(np.uint64) + np.uint64(1)) * _MULT[2]
    return rows, (word >> np.uint64(64 - v.word_rows.bit_length() + 1)).astype(np.int32)


def softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def log_share(z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row at its own column."""
    z -= z.max(axis=1, keepdims=True)
    mine = z[np.arange(len(z)), own].astype(np.float64)
    np.exp(z, out=z)
    return mine - np.log(z.sum(axis=1, dtype=np.float64))


def class_logits(v: Vocabulary, table: np.ndarray, rows: list[np.ndarray], s: slice) -> np.ndarray:
    z = np.take(table, rows[0][s], axis=0, mode="clip")
    for r in rows[1:]:
        z += np.take(table, r[s], axis=0, mode="clip")
    z += v.bias
    return z


class Weights:
    def __init__(self, v: Vocabulary, classes=None, words=None):
        self.classes = np.zeros((v.rows, CLASSES), np.float32) if classes is None else classes
        self.words = np.zeros((v.word_rows, SIZE), np.float32) if words is None else words

    def log10_p(self, v: Vocabulary, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each token, without the counts of rare words."""
        all_cls = v.cls(ids)
        rows, word = contexts(v, ids, starts, all_cls)
        out = np.empty(len(ids))
        for k in range(0, len(ids), MINI):
            s = slice(k, k + MINI)
            mine, cls = ids[s], all_cls[s]
            log_p = log_share(class_logits(v, self.classes, rows, s), cls)
            head = mine < min(HEAD, v.n)
            h = mine[head]
            log_p[head] += log_share(v.head[cls[head]] + self.words[word[s][head]], h % SIZE)
            got = np.maximum(log_p / math.log(10), -30.0)
            got[~head] += v.log_c(mine[~head]) - v.norm[cls[~head] - HEAD_CLASSES]
            out[s] = got
        return out


class Trainer:
    """Gradient steps over one task's texts (Adagrad, one scale for a row)."""

    def __init__(self, v: Vocabulary, start: Weights):
        self.v = v
        self.w = Weights(v, start.classes.copy(), start.words.copy())
        sizes = v.rows, v.word_rows
        self.seen = tuple(np.zeros(n, np.float32) for n in sizes)
        self.squares = tuple(np.full(n, 1e-2, np.float32) for n in sizes)

    def _update(self, which: int, table: np.ndarray, rows: list[np.ndarray], slope: np.ndarray) -> None:
        """One step for sets of rows, each with the same slopes."""
        used = sum(np.bincount(r, minlength=len(table)) for r in rows)
        at = np.flatnonzero(used)
        place = np.zeros(len(table), dtype=np.int64)
        place[at] = np.arange(len(at))
        sets, columns = [place[r] for r in rows], np.ascontiguousarray(slope.T, dtype=np.float64)
        g = np.empty((len(at), slope.shape[1]), dtype=np.float32)
        for c, x in enumerate(columns):
            g[:, c] = sum(np.bincount(r, x, len(at)) for r in sets)
        sq = self.squares[which]
        sq[at] += np.einsum("ij,ij->i", g, g)
        g *= (-STEP / np.sqrt(sq[at]))[:, None]
        table[at] += g
        self.seen[which][at] += used[at]

    def learn(self, ids: np.ndarray, starts: np.ndarray) -> None:
        v = self.v
        all_cls = v.cls(ids)
        rows, word = contexts(v, ids, starts, all_cls)
        for k in range(0, len(ids), MINI):
            s = slice(k, k + MINI)
            mine, cls = ids[s], all_cls[s]
            slope = softmax(class_logits(v, self.w.classes, rows, s))
            slope[np.arange(len(mine)), cls] -= 1
            self._update(0, self.w.classes, [r[s] for r in rows], slope)
            head = mine < min(HEAD, v.n)
            if head.any():
                slope = softmax(v.head[cls[head]] + self.w.words[word[s][head]])
                slope[np.arange(int(head.sum())), mine[head] % SIZE] -= 1
                self._update(1, self.w.words, [word[s][head]], slope)

    def message(self):
        """(table, block, rows times uses, uses) of what was met."""
        for which, table in enumerate((self.w.classes, self.w.words)):
            n = self.seen[which]
            for b in range(0, len(table), BLOCK):
                if n[b:b + BLOCK].any():
                    yield (which, b, (table[b:b + BLOCK] * n[b:b + BLOCK, None]).tobytes(),
                           n[b:b + BLOCK].tobytes())


def count_words(spark: SparkSession, train: DataFrame, text_col: str) -> DataFrame:
    """``w``, ``c``: every token of the training texts with its count."""
    schema = pa.schema([("w", pa.string()), ("n", pa.int64())])

    def count(parts):
        forget()
        for part in parts:
            for texts in slices(utf8(part.column(0)), COUNT_BYTES):
                seen: Counter = Counter()
                for t in texts:
                    seen.update(tokens(t))
                yield from batches_of(((w.decode(), n) for w, n in seen.items()), schema)

    return written(spark, train.select(text_col).mapInArrow(count, "w string, n long")
                   .groupBy("w").agg(F.sum("n").alias("c")), "lm-counts")


def vocabulary(spark: SparkSession, counts: DataFrame, frequent: int = FREQUENT):
    """The vocabulary, and the count below which a word is left to the join."""
    sizes = sorted(counts.groupBy(F.floor(F.log2("c")).cast("int").alias("b"))
                   .agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect(), reverse=True)
    least, held = 1 << 62, 0
    for r in sizes:
        held += r["v"]
        if held > frequent:
            break
        least = 1 << r["b"]
    top = counts.where(F.col("c") >= least).toPandas()
    top = top.sort_values(["c", "w"], ascending=[False, True])
    words, n = [w.encode() for w in top["w"]], top["c"].tolist()
    head = spark.sparkContext.broadcast(set(words[:HEAD]))

    def tails(parts):
        for part in parts:
            sums = np.zeros((2, TAIL_CLASSES), dtype=np.int64)
            for w, c in zip(utf8(part.column(0)), part.column(1).to_pylist(), strict=True):
                if w not in head.value:
                    k = tail_class(w)
                    sums[0, k] += c
                    sums[1, k] += 1
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAIL_CLASSES)), pa.array(sums[0]),
                                              pa.array(sums[1])], names=["k", "n", "v"])

    tail = {r["k"]: r for r in counts.mapInArrow(tails, "k long, n long, v long")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    get = lambda c: [int(tail[k][c]) if k in tail else 0 for k in range(TAIL_CLASSES)]
    return Vocabulary(words, n, get("n"), get("v"), sum(r["n"] for r in sizes),
                      sum(r["v"] for r in sizes)), least


def as_bytes(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers of several texts (from one bound to the next) as binary cells."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * 4).astype("<i4").tobytes()), pa.py_buffer(ids.astype("<i4").tobytes())])


def runs_of(column: pa.Array):
    """Token numbers of several texts in a row, and the first token of each
    text, from the cells of :func:`as_bytes`; about ``SLICE_TOKENS`` at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, "<i4")[column.offset:column.offset + len(column) + 1].astype(np.int64) // 4
    flat = np.frombuffer(data, "<i4", int(bounds[-1]))
    k = 0
    while k < len(column):
        to = max(k + 1, int(np.searchsorted(bounds, bounds[k] + SLICE_TOKENS, side="right")) - 1)
        yield flat[bounds[k]:bounds[to]].astype(np.int64), bounds[k:to] - bounds[k]
        k = to


def encoded(spark: SparkSession, docs: DataFrame, held, vocab, id_col: str, text_col: str,
            rounds: int) -> DataFrame:
    """Every text as the numbers of its words (``ids``), with what the words
    give without the model: ``n_tokens``, ``n_known``, ``base`` and the rare
    words. ``r`` numbers the rows, ``lot`` is the round a text is trained in."""
    lot = F.pmod(F.xxhash64(id_col, F.lit("round")), F.lit(rounds)).cast("long")
    src = docs.select(F.monotonically_increasing_id().alias("r"), F.col(id_col).alias("d"),
                      held.alias("held_out"), lot.alias("lot"), F.col(text_col).alias("x"))
    out = T.StructType([*src.schema.fields[:4], *[
        T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")],
        T.StructField("base", T.DoubleType()), T.StructField("ids", T.BinaryType()),
        T.StructField("rare", T.ArrayType(T.StructType([
            T.StructField("w", T.StringType()), T.StructField("n", T.LongType())])))])
    token = uuid.uuid4().hex

    def run(parts):
        v = once(token, lambda: vocab.value)
        for part in parts:
            done = 0
            for texts in slices(utf8(part.column(4))):
                ids, starts, rare = v.read(texts)
                bounds = np.append(starts, len(ids))
                words = [(x.decode(), k) for r in rare for x, k in r.items()]
                ends = np.cumsum([0, *map(len, rare)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.slice(done, len(texts)).columns[:4], pa.array(np.diff(bounds)),
                     pa.array(np.add.reduceat((ids < v.n).astype(np.int64), starts)),
                     pa.array(np.add.reduceat(v.log_c(ids), starts)),
                     as_bytes(ids, bounds),
                     pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                         [pa.array([a for a, _ in words], pa.string()),
                          pa.array([b for _, b in words], pa.int64())], names=["w", "n"]))],
                    names=out.names)
                done += len(texts)

    return written(spark, src.mapInArrow(run, out), "lm-encoded")


def train_weights(spark: SparkSession, train: DataFrame, vocab, rounds: int = ROUNDS) -> Weights:
    """Weights after ``rounds`` rounds, each over its own share of the texts
    (``lot``, ``n_tokens``, ``ids``)."""
    w = Weights(vocab.value)
    read = 4 * (train.agg(F.sum("n_tokens")).first()[0] or 0) // rounds
    tasks = max(LEAST_TASKS, read // (READ_FOR_SENT * (w.classes.nbytes + w.words.nbytes)))
    few = train.coalesce(tasks)
    for k in range(rounds):
        start = spark.sparkContext.broadcast((w.classes, w.words))
        token = uuid.uuid4().hex

        def learn(parts, start=start, token=token):
            trainer = None
            for part in parts:
                if trainer is None:
                    v = once(token, lambda: vocab.value)
                    trainer = Trainer(v, Weights(v, *start.value))
                for ids, starts in runs_of(part.column(0)):
                    trainer.learn(ids, starts)
            if trainer is not None:
                for which, b, x, n in trainer.message():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([which]), pa.array([b]), pa.array([x], pa.binary()),
                         pa.array([n], pa.binary())], names=["which", "b", "x", "n"])

        sent = few.where(F.col("lot") == k).select("ids") \
            .mapInArrow(learn, "which long, b long, x binary, n binary").rdd
        # Added up in two steps, so that no task reads a message of every task.
        groups = math.isqrt(sent.getNumPartitions()) + 1
        add = lambda a, b: (a[0] + b[0], a[1] + b[1])
        merged = sent.mapPartitionsWithIndex(lambda task, rows, groups=groups: (
            ((r[0], r[1], task % groups), (np.frombuffer(r[2], np.float32),
                                           np.frombuffer(r[3], np.float32))) for r in rows)) \
            .reduceByKey(add, 24 * groups).map(lambda r: (r[0][:2], r[1])) \
            .reduceByKey(add, 24).collect()
        for (which, b), (x, n) in merged:
            table = w.words if which else w.classes
            met = n > 0
            table[b:b + BLOCK][met] = x.reshape(len(n), -1)[met] / n[met, None]
    return w


def score_texts(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", held_out_mod: int = 5,
                frequent: int = FREQUENT) -> DataFrame:
    """Score every whole text, learning from those that are not held out.

    Columns: the id, ``held_out``, ``n_tokens`` (the end counts), ``n_known``,
    ``train_tokens``, ``base_score`` (add-half unigram) and ``score`` (this
    model), both log10 of the text's probability. A null text is empty: its
    end alone is scored. Words that no training text holds have the smoothed
    share of an unseen word of their class. Null ids and repeated rows are rows
    like any other; an empty table gives an empty result; other columns are
    ignored.
    """
    prepare(spark)
    held = crc_mod(id_col, held_out_mod) == 1
    train = docs.where(~held)
    counts = count_words(spark, train, text_col)
    v, least = vocabulary(spark, counts, frequent)
    vocab = spark.sparkContext.broadcast(v)
    read = encoded(spark, docs, held, vocab, id_col, text_col, ROUNDS)
    w = train_weights(spark, read.where(~F.col("held_out")), vocab)
    model = spark.sparkContext.broadcast((w.classes, w.words))
    token = uuid.uuid4().hex
    src = read.drop("lot")
    out = T.StructType([*[f for f in src.schema.fields if f.name != "ids"],
                        T.StructField("score", T.DoubleType())])
    kept = out.names[:-1]

    def run(parts):
        v = once(token, lambda: vocab.value)
        weights = Weights(v, *model.value)
        for part in parts:
            scores = []
            for ids, starts in runs_of(part.column("ids")):
                scores.append(np.add.reduceat(weights.log10_p(v, ids, starts), starts))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept],
                 pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=out.names)

    got = written(spark, src.mapInArrow(run, out), "lm-scored")
    # The counts of rarer words meet the texts that hold them by a join.
    asks = got.select("r", F.explode("rare").alias("a")).select("r", "a.w", "a.n")
    few = counts.where(F.col("c") < least)
    late = asks.join(few, "w", "left").groupBy("r").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("late"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"))
    norm = float(np.log10(v.total + 0.5 * (v.distinct + 1)))
    late_sum = F.coalesce("late", F.lit(0.0))
    return got.drop("rare").join(late, "r", "left").select(
        F.col("d").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + late_sum - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("score") + late_sum).alias("score"))
