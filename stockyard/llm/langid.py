"""Language identification by words, backing off to character n-grams.

A word that the training texts hold is scored by its log frequency in each
language. An unseen word is scored by its longest known character n-grams: all
of five characters if any is known, else of four, and so on down to one.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import crc_mod, forget, once, prepare, texts, written

LONGEST = 5
SMOOTHING = 0.5
# Training texts of each language that a fit reads at most (by hash of the
# id); a model holds all words and n-grams of these texts.
FIT_ROWS = 3_000
# Scores (words times languages) that one worker remembers, characters of a text
# split at a time, words looked up together.
CACHED_SCORES = 4_000_000
SLICE_CHARS = 1 << 18
WORD_SLICE = 8_192
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_APART = re.compile(r"[\W\d_]")
_SEED, _MULT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[str]:
    """Lower-case runs of letters (a run without any letter is no word)."""
    found = _WORD.findall(text.lower())
    return found if text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def slices(text: str, size: int = SLICE_CHARS):
    """The text in parts of about ``size`` characters, cut where no word is."""
    at = 0
    while len(text) - at > size:
        cut = _APART.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


def word_keys(ws: list[str]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w.encode()) for w in ws], dtype=np.uint64).view(np.int64)


def _hashed(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the ``n`` code points from each place."""
    h = np.full(len(at), _SEED + np.uint64(n))
    for k in range(n):
        h = (h + codes[at + k]) * _MULT
        h ^= h >> np.uint64(32)
        h *= _MULT
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def gram_keys(ws: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``grams(w, n)`` of all words, and the word of each."""
    mark = "" if n == 1 else "^"
    codes = np.frombuffer("".join([f"{mark}{w}{'$' if mark else ''}" for w in ws]).encode("utf-32-le"),
                          dtype="<u4").astype(np.uint64)
    size = np.fromiter(map(len, ws), np.int64, len(ws)) + (2 if mark else 0)
    start = np.cumsum(size) - size
    count = np.maximum(size - n + 1, 0)
    owner = np.repeat(np.arange(len(ws)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + start[owner]
    return _hashed(codes, at, n), owner


def grams_by_key(counts: dict[str, list[int]], n: int) -> dict[int, list[int]]:
    """Counts of n-grams of ``n`` characters by their keys."""
    held = [g for g in counts if len(g) == n]
    codes = np.frombuffer("".join(held).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    keys = _hashed(codes, np.arange(0, n * len(held), n), n)
    return dict(zip(keys.tolist(), [counts[g] for g in held], strict=True))


class LogCounts:
    """Log frequencies by language of words or n-grams, which are keyed by hash:
    sorted arrays that hold only the languages with a count."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, count: np.ndarray, n_langs: int):
        order = np.lexsort((lang, key))
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else order
        self.keys, self.ends = key[first], np.append(first, len(key))
        self.lang = lang[order].astype(np.int32)
        count = count[order]
        self.count = count.astype(np.int32) if not len(count) or count.max() < 1 << 31 else count
        self.total = np.bincount(self.lang, weights=count, minlength=n_langs) \
            + SMOOTHING * len(self.keys)
        self.absent = np.log(SMOOTHING / self.total) if len(key) else self.total

    @staticmethod
    def of(counts: dict[int, list[int]], n_langs: int) -> LogCounts:
        held = [(key, k, n) for key, row in counts.items() for k, n in enumerate(row) if n]
        return LogCounts(*np.array(held, dtype=np.int64).reshape(-1, 3).T, n_langs)

    def mean(self, keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For ``n`` owners: the mean log frequencies of those of their keys
        that are held (owners x languages), and how many are."""
        n_langs = len(self.total)
        if not len(self.keys) or not len(keys):
            return np.zeros((n, n_langs)), np.zeros(n, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        at, owner = at[known], owner[known]
        held = np.bincount(owner, minlength=n)
        # The languages with a count, key by key, as differences to one without.
        size = self.ends[at + 1] - self.ends[at]
        flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.ends[at], size)
        lang = self.lang[flat]
        more = np.log((self.count[flat] + SMOOTHING) / self.total[lang]) - self.absent[lang]
        sums = np.bincount(np.repeat(owner, size) * n_langs + lang, more, n * n_langs)
        return sums.reshape(n, n_langs) / np.maximum(held, 1)[:, None] + self.absent, held


class LanguageModel:
    """Log frequencies of words and n-grams by language, from dicts or, for
    n-grams of one character, two and so on, ``LogCounts``."""

    def __init__(self, langs: list[str], word_counts: dict[str, list[int]] | LogCounts,
                 gram_counts: dict[str, list[int]] | list[LogCounts]):
        self.langs = langs
        if isinstance(word_counts, dict):
            keys = word_keys(list(word_counts)).tolist()
            word_counts = LogCounts.of(dict(zip(keys, word_counts.values(), strict=True)), len(langs))
            gram_counts = [LogCounts.of(grams_by_key(gram_counts, n), len(langs))
                           for n in range(1, LONGEST + 1)]
        self.words, self.grams = word_counts, gram_counts
        self.row: dict[str, int] = {}
        self.rows = np.zeros((1024, len(langs)), dtype=np.float64)

    def scores(self, ws: list[str]) -> np.ndarray:
        """Log frequencies of distinct words: words x languages."""
        out, held = self.words.mean(word_keys(ws), np.arange(len(ws)), len(ws))
        left = np.flatnonzero(held == 0)
        out[left] = 0.0
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            some = [ws[k] for k in left.tolist()]
            got, held = self.grams[n - 1].mean(*gram_keys(some, n), len(some))
            out[left[held > 0]] = got[held > 0]
            left = left[held == 0]
        return out

    def _remember(self, ws: set[str]) -> None:
        """Rows for words that have none."""
        new = [w for w in ws if w not in self.row]
        if (len(self.row) + len(new)) * len(self.langs) > CACHED_SCORES:
            self.row.clear()
            new = list(ws)
        need = len(self.row) + len(new)
        if need > len(self.rows):
            self.rows = np.concatenate([self.rows[:len(self.row)], np.zeros(
                (max(need, 2 * len(self.rows)) - len(self.row), len(self.langs)))])
        for k in range(0, len(new), WORD_SLICE):
            some = new[k:k + WORD_SLICE]
            at = len(self.row)
            self.rows[at:at + len(some)] = self.scores(some)
            self.row.update(zip(some, range(at, at + len(some)), strict=True))

    def _sum(self, found: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.row.__getitem__, found), np.int64, len(found))
        if len(at) <= 1024:
            return self.rows[at].sum(axis=0)
        times = np.bincount(at)
        met = np.flatnonzero(times)
        return sum(times[met[k:k + 1024]] @ self.rows[met[k:k + 1024]] for k in range(0, len(met), 1024))

    def predict_all(self, found_texts: list[str]) -> list[tuple[str, float]]:
        """Language and its share of the posterior for each text."""
        out: list = [(UNDETERMINED, 0.0)] * len(found_texts)
        if not self.langs:
            return out
        size = max(1 << 12, SLICE_CHARS // max(1, len(self.langs) // 16))
        totals: dict[int, np.ndarray] = {}
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle():
            self._remember({w for _, found in waiting for w in found})
            for k, found in waiting:
                s = self._sum(found)
                totals[k] = totals[k] + s if k in totals else s
            waiting.clear()

        for k, text in enumerate(found_texts):
            for part in slices(text, size):
                if found := words(part):
                    waiting.append((k, found))
                    held += len(part)
                if held > size:
                    settle()
                    held = 0
        settle()
        for k, total in totals.items():
            best = int(total.argmax())
            out[k] = self.langs[best], float(1.0 / np.exp(total - total[best]).sum())
        return out

    def predict(self, text: str) -> tuple[str, float]:
        return self.predict_all([text])[0]


def fit(spark: SparkSession, docs: DataFrame, train: Column, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> tuple:
    """Languages and the counts of their words and n-grams, from the rows that
    ``train`` selects. At most about ``fit_rows`` texts of each language are
    read, chosen by a hash of the id; they are counted where they lie, and all
    counts of this sample come to the driver, by hash."""
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    n = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang"))
         .agg(F.count("*").alias("n")).collect()}
    if not n:
        return [], {}, {}
    langs = sorted(n)
    spot = F.pmod(F.xxhash64(id_col, F.lit("fit")), F.lit(1_000_000)) / 1_000_000
    share = spark.createDataFrame([(k, min(1.0, fit_rows / n[k])) for k in langs],
                                  "__l string, __share double")
    picked = rows.join(share, F.col(lang_col) == F.col("__l")).where(spot < F.col("__share")) \
        .select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    number = {lang: k for k, lang in enumerate(langs)}

    def count(parts):
        forget()
        for part in parts:
            seen: dict[str, Counter] = {}
            for lang, t in zip(*[c.to_pylist() for c in part.columns], strict=True):
                seen.setdefault(lang, Counter()).update(words(t))
            for lang, w in seen.items():
                ws, n = list(w), np.fromiter(w.values(), np.int64, len(w))
                yield rows_of(number[lang], 0, word_keys(ws), n)
                for size in range(1, LONGEST + 1):
                    for k in range(0, len(ws), WORD_SLICE):
                        key, owner = gram_keys(ws[k:k + WORD_SLICE], size)
                        key, at = np.unique(key, return_inverse=True)
                        yield rows_of(number[lang], size, key, np.bincount(
                            at, n[k:k + WORD_SLICE][owner], len(key)).astype(np.int64))

    def rows_of(lang, kind, key, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), lang, np.int32)), pa.array(np.full(len(key), kind, np.int32)),
             pa.array(key), pa.array(n)], names=["l", "k", "g", "n"])

    # All words and n-grams of the bounded sample, one kind after another: 20
    # bytes each and language.
    got = written(spark, picked.mapInArrow(count, "l int, k int, g long, n long")
                  .groupBy("k", "g", "l").agg(F.sum("n").alias("n")), "langid-counts")
    held = []
    for k in range(LONGEST + 1):
        part = got.where(F.col("k") == k).select("g", "l", "n").toPandas()
        held.append(LogCounts(*[part[c].to_numpy() for c in ("g", "l", "n")], len(langs)))
    return langs, held[0], held[1:]


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", held_out_mod: int = 3,
             fit_rows: int = FIT_ROWS) -> DataFrame:
    """``held_out``, ``lang_pred`` and ``score`` for every whole text.

    Only rows outside the held-out fold teach, by their text and language.
    The score is the language's share of the posterior. A text that is null or
    has no letter is ``und`` with score 0, and so is every text if no language
    was learned. Ties go to the language that sorts first. A very long text is
    read in parts, cut between words, and summed up. Null ids and repeated rows
    stay as they are; an empty table gives an empty result; other columns are
    ignored.
    """
    prepare(spark)
    learned = fit(spark, docs, crc_mod(id_col, held_out_mod) != 1, id_col, text_col, lang_col,
                  fit_rows)
    model = spark.sparkContext.broadcast(learned)
    src = docs.select(id_col, (crc_mod(id_col, held_out_mod) == 1).alias("held_out"), text_col)
    out = T.StructType([*src.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType())])

    token = uuid.uuid4().hex

    def run(parts):
        m = once(token, lambda: LanguageModel(*model.value))
        for part in parts:
            got = m.predict_all(texts(part.column(2)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array([a for a, _ in got], pa.string()),
                 pa.array([b for _, b in got], pa.float64())], names=out.names)

    return src.mapInArrow(run, out)
