"""Benchmark decontamination with a generalised suffix automaton.

The words of all normalised test items go into one suffix automaton. Documents
are streamed through it word by word; the automaton's state and matching
length say, at each word, which windows of test items end there.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import once, prepare, row_key, to_batch, utf8, written

WINDOW = 10
# UTF-8 bytes of test items in one automaton (a longer item has one of its own),
# which takes far more memory than they do. More items are handled in further
# passes over the documents: a worker holds one automaton, a job one broadcast.
BLOCK_BYTES = 1 << 20

# A word is a run of digits, letters a-z and non-ASCII characters. Mapping all
# other bytes to a space, and A-Z to a-z, leaves the words to bytes.split().
_NORMAL = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class ItemAutomaton:
    """Generalised suffix automaton over the words of test items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.items: list[str] = []
        lines = []
        for name, text in items:
            if seq := [self.ids.setdefault(w, len(self.ids)) for w in words(text)]:
                self.items.append(name)
                lines.append(seq)
                last = 0
                for w in seq:
                    last = self._extend(last, w)
        # The windows: (state, length) -> items that hold that word sequence.
        # Those that end in a state are listed for it and all longer matches.
        self.shortest = min([window, *map(len, lines)])
        held: dict[int, dict[int, set[int]]] = {}
        for k, seq in enumerate(lines):
            n = min(window, len(seq))
            state = length = 0
            for w in seq:
                state, length = self.step(state, length, w)
                at = state
                while self.link[at] >= 0 and self.len[self.link[at]] >= n:
                    at = self.link[at]
                if length >= n:
                    held.setdefault(at, {}).setdefault(n, set()).add(k)
        # found[state]: (window length, items) along its suffix links.
        self.found: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(self.len)
        for s in sorted(range(len(self.len)), key=self.len.__getitem__):
            own = tuple((n, frozenset(x)) for n, x in sorted(held.get(s, {}).items()))
            self.found[s] = own + (self.found[self.link[s]] if self.link[s] >= 0 else ())

    def _extend(self, last: int, w: int) -> int:
        """Append a word to the string that ends in ``last``; items share the
        states of what they have in common."""
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, w, q)
        new = self._state({}, self.len[last] + 1, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, edges: dict[int, int], length: int, link: int) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(dict(self.next[q]), self.len[p] + 1, self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The longest suffix of what was read, and ``w``, that items hold."""
        while w not in self.next[state]:
            if state == 0:
                return 0, 0
            state = self.link[state]
            length = self.len[state]
        return self.next[state][w], length + 1

    def scan(self, tokens: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Hit flags of a text's words and the items whose windows occur."""
        hit = np.zeros(len(tokens) + 1, dtype=np.int32)
        if len(tokens) < self.shortest or not self.ids:
            return hit[:-1].astype(bool), set()
        get = self.ids.get
        ids = np.array([get(t, -1) for t in tokens], dtype=np.int64)
        # A match lies within a run of words that items know; shorter runs
        # than the shortest window hold none.
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0]))))
        seen: set[int] = set()
        for lo, hi in edge.reshape(-1, 2).tolist():
            if hi - lo < self.shortest:
                continue
            state = length = 0
            for at, w in enumerate(ids[lo:hi].tolist(), lo + 1):
                state, length = self.step(state, length, w)
                if length >= self.shortest:
                    for n, items in self.found[state]:
                        if length >= n:
                            hit[at - n] += 1
                            hit[at] -= 1
                            seen |= items
        return np.cumsum(hit[:-1]) > 0, {self.items[k] for k in seen}


def item_blocks(spark: SparkSession, items: DataFrame, id_col: str, text_col: str,
                block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """The test items (``i``, ``t``) dealt by hash to blocks (``block``) of bounded
    size, and the numbers of the blocks that hold any.

    A null id is written as an empty string; repeated rows count as one item.
    """
    rows = written(spark, items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
        F.col(text_col).alias("t")).where(F.col("t").isNotNull()).distinct(), "test-items")
    size = F.sum(F.octet_length("t")).alias("size")
    n = max(1, math.ceil((rows.agg(size).first()["size"] or 0) / block_bytes))
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
        sizes = dealt.groupBy("block").agg(size, F.count("*").alias("items")).collect()
        if all(r["size"] <= block_bytes or r["items"] == 1 for r in sizes):
            return dealt, sorted(r["block"] for r in sizes)
        n *= 2


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType())])


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW,
                  with_text: bool = False, keep: tuple[str, ...] = (),
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Mark (and, with ``with_text``, cut out) the words inside item windows.

    One row per document row: the id, ``keep`` columns, the number of words,
    of hit words and of items found, the SHA-256 of those item ids (sorted as
    strings, comma-joined), ``contaminated`` and, if ``with_text``,
    ``clean_text``: the text without its hit spans (from the first to the last
    hit word of a run). Null or wordless texts have no words; null ids and
    repeated rows stay as they are; with no items nothing is hit; other
    columns are ignored.

    Items of one block are held against the documents in one pass. Of more
    blocks, each has a pass of its own that writes the hits by row key; they are
    joined to the documents in the end.
    """
    prepare(spark)
    dealt, blocks = item_blocks(spark, items, item_id, item_text, block_bytes)

    def held(block: int):
        found = dealt.where(F.col("block") == block).orderBy("i", "t").collect()
        return spark.sparkContext.broadcast([(r["i"], r["t"].encode()) for r in found])

    src = docs.select(id_col, *keep, text_col)
    n_keep = 1 + len(keep)
    if len(blocks) > 1:
        passes = []
        for block in blocks:
            one = held(block)
            passes.append(written(spark, _hits(src, id_col, text_col, one, window), "item-hits"))
            one.destroy()
        # At most one row of a key from each pass.
        hits = reduce(DataFrame.union, passes).groupBy("i", "t").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.flatten(F.collect_list("items")).alias("items"))
        key = row_key(src, id_col, text_col)
        src = src.withColumns({"_key_i": key[0], "_key_t": key[1]}) \
            .join(hits.select(F.col("i").alias("_key_i"), F.col("t").alias("_key_t"),
                              F.col("spans").alias("_spans"), F.col("items").alias("_items")),
                  ["_key_i", "_key_t"], "left") \
            .select(*src.columns, "_spans", "_items")
    single = held(blocks[0]) if len(blocks) == 1 else None
    out = T.StructType([*[src.schema[c] for c in (id_col, *keep)], *RESULT.fields])
    if with_text:
        out.add("clean_text", T.StringType())

    token = uuid.uuid4().hex

    def run(parts):
        machine = once(token, lambda: ItemAutomaton(single.value, window)) if single else None
        for part in parts:
            raw = utf8(part.column(n_keep))
            if part.num_columns > n_keep + 1:
                found = zip(*[part.column(n_keep + k).to_pylist() for k in (1, 2)], strict=True)
                rows = [_row(t, w := words(t), _flags(len(w), spans), set(items or ()), with_text)
                        for t, (spans, items) in zip(raw, found, strict=True)]
            else:
                rows = [_row(t, w := words(t), *(machine.scan(w) if machine else (
                    np.zeros(len(w), dtype=bool), set())), with_text) for t in raw]
            cols = list(zip(*rows, strict=True)) or [[]] * (len(RESULT) + with_text)
            if with_text:
                old = part.column(n_keep).to_pylist()
                cols[-1] = [t if c is None else c for t, c in zip(old, cols[-1], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n_keep],
                 *[pa.array(c, type=t) for c, t in zip(cols, _TYPES, strict=False)]],
                names=out.names)

    return src.mapInArrow(run, out)


_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string())


def _hits(src: DataFrame, id_col: str, text_col: str, block, window: int) -> DataFrame:
    """For each row key with hits: the runs of hit words (from, to, from, ...)
    and the items found."""
    token = uuid.uuid4().hex
    schema = pa.schema([("i", pa.int64()), ("t", pa.int64()), ("spans", pa.list_(pa.int32())),
                        ("items", pa.list_(pa.string()))])

    def run(parts):
        machine = once(token, lambda: ItemAutomaton(block.value, window))
        for part in parts:
            out = []
            for i, t, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                 utf8(part.column(2)), strict=True):
                hit, found = machine.scan(words(raw))
                if found:
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0]))))
                    out.append((i, t, edge.tolist(), sorted(found)))
            yield to_batch(out, schema)

    return src.select(*row_key(src, id_col, text_col), F.col(text_col).alias("raw")) \
        .mapInArrow(run, "i long, t long, spans array<int>, items array<string>") \
        .dropDuplicates(["i", "t"])


def _flags(n: int, spans: list[int] | None) -> np.ndarray:
    hit = np.zeros(n, dtype=bool)
    for lo, hi in np.reshape(spans or [], (-1, 2)).astype(int).tolist():
        hit[lo:hi] = True
    return hit


def _row(text: bytes, tokens: list[bytes], hit: np.ndarray, found: set[str],
         with_text: bool) -> tuple:
    n = int(hit.sum())
    row = (len(tokens), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
           n > 0)
    return (*row, cut_words(text, hit) if n else None) if with_text else row


def cut_words(text: bytes, hit: np.ndarray) -> str:
    """The text without the spans that runs of hit words cover."""
    inside = np.frombuffer(text.translate(_NORMAL), dtype=np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0])))).reshape(-1, 2)
    run = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])))).reshape(-1, 2)
    out, at = [], 0
    for lo, hi in run.tolist():
        out.append(text[at:edge[lo, 0]])
        at = int(edge[hi - 1, 1])
    return b"".join([*out, text[at:]]).decode()
