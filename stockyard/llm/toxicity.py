"""Toxicity from class-conditional Kneser-Ney models.

Two character models of words, one of the toxic and one of the ordinary class,
share their backoff: only the longest context is counted by class, and what a
class has not seen there is smoothed with Kneser-Ney continuation counts pooled
over both classes. A text is judged by its length-normalised log-likelihood
ratio, of the whole text and of its most toxic short passage, through a
logistic curve fitted on labelled rows that the counts did not see.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import crc_mod, forget, once, prepare, texts

ORDER = 6           # characters of the longest n-gram
DISCOUNT = 0.75
PASSAGE = 3         # words of a passage
# Labelled rows of each class that a fit reads at most (by hash of the id); a
# model holds all n-grams of these rows.
FIT_ROWS = 4_000
# Words and n-grams whose ratios one worker remembers.
WORD_CACHE = 150_000
SLICE_CHARS = 1 << 20  # text whose words are looked up together
WORD_SLICE = 10_000    # words whose n-grams are arrays at a time
_SEED, _MULT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between marks; short ones at its start only."""
    w = "^" + word + "$"
    return [w[max(0, i + 1 - n):i + 1] for i in range(1, len(w)) if i + 1 >= n or n == ORDER]


def windows(ws: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``grams(w, ORDER)`` of all words as rows of ``ORDER`` code points, filled
    up with zeros on the left: word number, length, code points."""
    codes = np.frombuffer("".join(f"^{w}$" for w in ws).encode("utf-32-le"), dtype="<u4")
    size = np.fromiter(map(len, ws), np.int64, len(ws)) + 2
    word = np.repeat(np.arange(len(ws)), size)
    offset = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    at = np.flatnonzero(offset)
    n = np.minimum(offset[at] + 1, ORDER)
    out = np.zeros((len(at), ORDER), dtype=np.uint32)
    for j in range(ORDER):
        out[:, ORDER - 1 - j] = np.where(j < n, codes[np.maximum(at - j, 0)], 0)
    return word[at], n, out


def pack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two longs that name an n-gram: three code points of 21 bits in each."""
    c = codes.astype(np.int64)
    return c[:, 0] << 42 | c[:, 1] << 21 | c[:, 2], c[:, 3] << 42 | c[:, 4] << 21 | c[:, 5]


def unpack(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    mask = (1 << 21) - 1
    return np.stack([(x >> k & mask).astype(np.uint32) for x in (hi, lo) for k in (42, 21, 0)],
                    axis=1)


def _chain(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h + c) * _MULT
    h = (h ^ (h >> np.uint64(32))) * _MULT
    return h ^ (h >> np.uint64(29))


def _key(codes: np.ndarray, n: np.ndarray, skip: int = 0) -> np.ndarray:
    """64-bit hash of the ``n`` code points before the last ``skip`` ones."""
    h = np.full(len(codes), _SEED)
    for k in range(1, ORDER + 1 - skip):
        h = np.where(n >= k, _chain(h, codes[:, ORDER - skip - k]), h)
    return h


class Counts:
    """Sums of the columns of ``values`` by key: sorted arrays, zero for keys
    that are not held."""

    def __init__(self, keys: np.ndarray, values: list[np.ndarray]):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
        self.keys = keys[first]
        self.values = []
        for v in values:
            v = np.add.reduceat(v[order].astype(np.int64), first) if len(keys) else v[:0]
            self.values.append(v.astype(np.int32) if not len(v) or v.max() < 1 << 31 else v)

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        if not len(self.keys):
            return [np.zeros(len(keys), dtype=np.int64) for _ in self.values]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return [np.where(known, v[at], 0) for v in self.values]


class PackedPair:
    """The models of ``KneserNeyPair`` with all n-grams in sorted arrays, keyed
    by hash: some 60 bytes an n-gram, and words are judged together."""

    def __init__(self, codes: np.ndarray, both: np.ndarray):
        """n-grams (rows of code points) and their (toxic, ordinary) counts."""
        used = both.any(axis=1)
        codes, both = codes[used], both[used]
        n = (codes != 0).sum(axis=1)
        self.top = Counts(_key(codes, n), [both[:, 0], both[:, 1]])
        self.context = Counts(_key(codes, n - 1, 1), [both[:, 0], both[:, 1],
                                                      both[:, 0] > 0, both[:, 1] > 0])
        # Pooled continuation counts, level by level as in KneserNeyPair.
        row, parts = np.arange(len(codes)), []
        while len(row):
            longer = n > 1
            row, n = row[longer], n[longer] - 1
            key, first, count = np.unique(_key(codes[row], n), return_index=True,
                                          return_counts=True)
            row, n = row[first], n[first]
            parts.append((key, count, _key(codes[row], n - 1, 1)))
        key, count, before = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else \
            [np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.uint64)]
        self.cont = Counts(key, [count])
        _, first = np.unique(key, return_index=True)
        one = np.zeros(len(key), dtype=np.int64)
        one[first] = 1  # an n-gram of several levels is one kind
        self.after = Counts(before, [count, one])
        self._floor = 1.0 / (float(self.after(np.array([_SEED]))[1][0]) + 1)

    def ratios(self, ws: list[str]) -> list[float]:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        out: list[float] = []
        for k in range(0, len(ws), WORD_SLICE):
            part = ws[k:k + WORD_SLICE]
            word, n, codes = windows(part)
            out += np.bincount(word, weights=self._ratio(codes, n), minlength=len(part)).tolist()
        return out

    def _ratio(self, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
        hi, lo = pack(codes)
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        new = np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.cumsum(new) - 1
        codes, n = codes[order[new]], n[order[new]]
        low = np.full(len(codes), self._floor)
        gram = before = np.full(len(codes), _SEED)
        for k in range(1, ORDER):  # the backoff: gram[1:] and its suffixes
            at = np.flatnonzero(n > k)
            gram = gram.copy()
            gram[at] = _chain(gram[at], codes[at, ORDER - k])
            total, kinds = self.after(before[at])
            count, = self.cont(gram[at])
            share = (np.maximum(count - DISCOUNT, 0.0) + DISCOUNT * kinds * low[at]) \
                / np.maximum(total, 1)
            low[at] = np.where(total > 0, share, low[at])
            before = before.copy()
            before[at] = _chain(before[at], codes[at, ORDER - 1 - k])
        counts, totals = self.top(_key(codes, n)), self.context(before)
        p = [np.where(totals[c] > 0, (np.maximum(counts[c] - DISCOUNT, 0.0)
                                      + DISCOUNT * totals[2 + c] * low)
                      / np.maximum(totals[c], 1), low) for c in (0, 1)]
        return np.log(p[0] / p[1])[back]


class KneserNeyPair:
    """Both class models from the counts of top-order n-grams by class, in plain
    dicts; ``PackedPair`` gives the same ratios for many n-grams.

    ``top`` maps an n-gram (up to ``ORDER`` characters; shorter ones start
    with the word mark) to (toxic, ordinary) counts.
    """

    def __init__(self, top: dict[str, tuple[int, int]]):
        self.top = top
        self.total = ({}, {})  # context -> tokens of a class
        self.kinds = ({}, {})  # context -> distinct next characters of a class
        for g, both in top.items():
            for c in (0, 1):
                if both[c]:
                    h = g[:-1]
                    self.total[c][h] = self.total[c].get(h, 0) + both[c]
                    self.kinds[c][h] = self.kinds[c].get(h, 0) + 1
        # Pooled continuation counts, order by order: how many distinct
        # characters precede an n-gram.
        self.cont: dict[str, int] = {}
        level = set(top)
        while level:
            shorter: Counter = Counter(g[1:] for g in level if len(g) > 1)
            for g, n in shorter.items():
                self.cont[g] = self.cont.get(g, 0) + n
            level = {g for g in shorter if g}
        self.after: dict[str, int] = {}
        self.spread: dict[str, int] = {}
        for g, n in self.cont.items():
            if g:
                self.after[g[:-1]] = self.after.get(g[:-1], 0) + n
                self.spread[g[:-1]] = self.spread.get(g[:-1], 0) + 1
        self._shared: dict[str, float] = {}
        self._ratios: dict[str, float] = {}
        self._floor = 1.0 / (self.spread.get("", 0) + 1)

    def shared(self, gram: str) -> float:
        """Pooled backoff probability of the last character after the rest."""
        p = self._shared.get(gram)
        if p is None:
            h = gram[:-1]
            low = self.shared(gram[1:]) if h else self._floor
            n = self.after.get(h, 0)
            p = low if not n else (max(self.cont.get(gram, 0) - DISCOUNT, 0.0)
                                   + DISCOUNT * self.spread[h] * low) / n
            if len(self._shared) < WORD_CACHE:
                self._shared[gram] = p
        return p

    def ratio(self, word: str) -> float:
        """log P(word | toxic) - log P(word | ordinary)."""
        out = 0.0
        for g in grams(word, ORDER):
            x = self._ratios.get(g)
            out += self._ratio(g) if x is None else x
        return out

    def _ratio(self, gram: str) -> float:
        h, p = gram[:-1], []
        if h not in self.total[0] and h not in self.total[1]:
            return 0.0
        low = self.shared(gram[1:]) if len(gram) > 1 else self._floor
        for c in (0, 1):
            n = self.total[c].get(h, 0)
            p.append(low if not n else (max(self.top.get(gram, (0, 0))[c] - DISCOUNT, 0.0)
                                        + DISCOUNT * self.kinds[c][h] * low) / n)
        x = math.log(p[0] / p[1])
        if len(self._ratios) < WORD_CACHE:
            self._ratios[gram] = x
        return x


class Scorer:
    def __init__(self, pair: PackedPair, curve: tuple[float, ...] = ()):
        self.pair, self.curve, self.known = pair, curve, {}

    def features(self, docs: list[str]) -> list[tuple[float, float]]:
        """Log-likelihood ratio a word: of each text, of its worst passage."""
        out: list[tuple[float, float]] = []
        held, size = [], 0
        for k, text in enumerate(docs):
            held.append(words(text))
            size += len(text)
            if size >= SLICE_CHARS or k == len(docs) - 1:
                out += self._features(held)
                held, size = [], 0
        return out

    def _features(self, held: list[list[str]]) -> list[tuple[float, float]]:
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        new = list({w for ws in held for w in ws if w not in self.known})
        self.known.update(zip(new, self.pair.ratios(new), strict=True))
        out = []
        for ws in held:
            if not ws:
                out.append((0.0, 0.0))
                continue
            sums = np.cumsum([0.0, *map(self.known.__getitem__, ws)])
            k = min(PASSAGE, len(ws))
            out.append((float(sums[-1]) / len(ws), float((sums[k:] - sums[:-k]).max()) / k))
        return out

    def scores(self, docs: list[str]) -> list[float]:
        a, b, c = self.curve
        return [1.0 / (1.0 + math.exp(-min(max(a * x + b * y + c, -30.0), 30.0)))
                for x, y in self.features(docs)]


def fit_curve(x: np.ndarray, y: np.ndarray, toxic: float = 0.5,
              steps: int = 50) -> tuple[float, ...]:
    """Logistic regression of ``y`` on two features, by Newton steps with a
    small ridge; the rows are weighted so that ``toxic`` is the share of the
    toxic class, as among all labelled rows. Texts without evidence then stay
    ordinary, also where some of them bear a toxic label."""
    z = np.column_stack([x, np.ones(len(x))])
    share = np.where(y == 1, toxic / max(y.sum(), 1), (1 - toxic) / max((1 - y).sum(), 1)) * len(y)
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (share * (p - y)) + 1e-2 * w
        hess = (z * (share * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return tuple(w.tolist())


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", held_out_mod: int = 5,
        fit_rows: int = FIT_ROWS) -> tuple[PackedPair, tuple[float, ...]]:
    """Both class models and the curve, from labelled rows outside the fold
    that is held out (remainder 0). At most about ``fit_rows`` rows of each
    class are read, chosen by a hash of the id. The counts of each half judge
    the other half for the curve; the model itself uses both."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
                         & (crc_mod(id_col, held_out_mod) != 0)) \
        .select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    nothing = PackedPair(np.zeros((0, ORDER), dtype=np.uint32), np.zeros((0, 2), dtype=np.int64))
    if not n.get(0) or not n.get(1):
        return nothing, (0.0, 0.0, 30.0 if n.get(1) else -30.0)
    spot = F.pmod(F.xxhash64("i", F.lit("fit")), F.lit(1_000_000)) / 1_000_000
    picked = known.where(spot < F.when(F.col("y") == 1, min(1.0, fit_rows / n[1]))
                         .otherwise(min(1.0, fit_rows / n[0])))
    fold = F.pmod(F.xxhash64("i", F.lit("fold")), F.lit(2)).cast("int")
    # The picked ids are bounded by fit_rows, so they may be broadcast.
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")) \
        .join(F.broadcast(picked), "i").select(fold.alias("f"), "y", "t")
    def count(parts):
        forget()
        for part in parts:
            seen: dict = {}
            for f, y, t in zip(*[c.to_pylist() for c in part.columns], strict=True):
                seen.setdefault((f, y), Counter()).update(words(t or ""))
            for (f, y), w in seen.items():
                ws, ks = list(w), np.fromiter(w.values(), np.int64, len(w))
                for k in range(0, len(ws), WORD_SLICE):
                    word, _, codes = windows(ws[k:k + WORD_SLICE])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(word), f, dtype=np.int32)),
                         pa.array(np.full(len(word), y, dtype=np.int32)),
                         *map(pa.array, pack(codes)), pa.array(ks[k:k + WORD_SLICE][word])],
                        names=["f", "y", "hi", "lo", "n"])

    cell = lambda f, y: F.sum(F.when((F.col("f") == f) & (F.col("y") == y), F.col("n"))
                              .otherwise(0)).cast("int").alias(f"n{f}{y}")
    # All n-grams of the bounded sample: 32 bytes each on the driver.
    got = rows.mapInArrow(count, "f int, y int, hi long, lo long, n long") \
        .groupBy("hi", "lo").agg(*[cell(f, y) for f in (0, 1) for y in (0, 1)]).toPandas()
    codes = unpack(got["hi"].to_numpy(), got["lo"].to_numpy())
    # Toxic and ordinary counts of both halves.
    c = got[["n01", "n00", "n11", "n10"]].to_numpy()
    del got

    # Without both classes in both halves, the whole judges itself.
    halves = [c[:, :2], c[:, 2:]] if (c.sum(axis=0) > 0).all() else [c[:, :2] + c[:, 2:]]
    models = spark.sparkContext.broadcast([PackedPair(codes, x) for x in halves])

    def judge(parts):
        forget()
        pairs = [Scorer(pair) for pair in models.value]
        for part in parts:
            f, y, t = [c.to_pylist() for c in part.columns]
            x = [(0.0, 0.0)] * len(f)
            for half in (0, 1):
                at = [k for k, a in enumerate(f) if a == half]
                found = pairs[(1 - half) % len(pairs)].features([t[k] or "" for k in at])
                for k, v in zip(at, found, strict=True):
                    x[k] = v
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array([v[0] for v in x], pa.float64()),
                 pa.array([v[1] for v in x], pa.float64())], names=["y", "a", "b"])

    seen = rows.mapInArrow(judge, "y int, a double, b double").toPandas().sort_values(["y", "a", "b"])
    if seen["y"].nunique() < 2:
        return nothing, (0.0, 0.0, 30.0 if (seen["y"] == 1).any() else -30.0)
    models.destroy()
    return PackedPair(codes, c[:, :2] + c[:, 2:]), fit_curve(
        seen[["a", "b"]].to_numpy(), seen["y"].to_numpy(dtype=float), n[1] / (n[0] + n[1]))


def score_texts(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "toxic", keep: tuple[str, ...] = (),
                with_text: bool = False, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``held_out``, ``score`` (0 to 1) and ``predicted`` for every whole text.

    Columns: the id, ``keep``, the three results and, if ``with_text``, the
    text. Null and wordless texts get the score of a text without evidence;
    without labels of both classes every score is 0 (or 1, if all labels are
    toxic); null ids and repeated rows are scored like any other; labels that
    are null or of unknown documents are ignored; an empty table gives an empty
    result; other columns are ignored.
    """
    prepare(spark)
    model = spark.sparkContext.broadcast(
        fit(spark, docs, labels, id_col, text_col, label_col, fit_rows=fit_rows))
    cols = [id_col, *[c for c in keep if c != text_col]]
    src = docs.select(*cols, (crc_mod(id_col, 5) == 0).alias("held_out"), text_col)
    out = T.StructType([*src.schema.fields[:-1], T.StructField("score", T.DoubleType()),
                        T.StructField("predicted", T.IntegerType())])
    if with_text:
        out.add(src.schema.fields[-1])

    token = uuid.uuid4().hex

    def run(parts):
        scorer = once(token, lambda: Scorer(*model.value))
        for part in parts:
            s = scorer.scores(texts(part.column(len(cols) + 1)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(s, pa.float64()),
                 pa.array([int(v >= 0.5) for v in s], pa.int32()),
                 *part.columns[len(part.columns) - 1:][:with_text]], names=out.names)

    return src.mapInArrow(run, out)
