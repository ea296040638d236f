"""Unigram token counts over a trie of distinct pre-tokens.

Distinct pre-tokens are visited in sorted order, which is a depth-first walk of
their trie; the walk keeps the unigram forward scores of the current path, so a
prefix that many pre-tokens share is scored once. Each terminal stores its
pre-token's count, and texts are sums of terminal counts.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockyard.llm.common import once, prepare, texts

# Terminal counts remembered by one worker between batches.
TERMINALS = 800_000
UNKNOWN_PENALTY = 10.0
SPACE = "▁"


def load_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a sentencepiece file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class TrieCounter:
    """Token counts of pre-tokens under a unigram model.

    The count is that of the segmentation with the highest total score (of
    those with equal score, the fewest tokens). A character that is no piece
    scores below all pieces and counts one token for each UTF-8 byte.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.score = dict(pieces)
        self.unknown = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        sizes: dict[str, set[int]] = {}
        for p in self.score:
            sizes.setdefault(p[-1], set()).add(len(p))
        # Lengths of the pieces that end in a character, shortest first.
        self.sizes = {c: sorted(n) for c, n in sizes.items()}
        self.terminal: dict[str, int] = {}

    def insert(self, pre_tokens) -> None:
        """Score the given distinct pre-tokens, a shared prefix once."""
        if len(self.terminal) >= TERMINALS:
            self.terminal.clear()
        score, sizes, unknown = self.score.get, self.sizes, self.unknown
        path, forward, count = "", [0.0], [0]
        for word in sorted(pre_tokens):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del forward[shared + 1:], count[shared + 1:]
            for i in range(shared, len(word)):
                c = word[i]
                best, n = None, 0
                for size in sizes.get(c, ()):
                    start = i + 1 - size
                    if start < 0:
                        break
                    s = score(word[start:i + 1])
                    if s is not None:
                        s, k = s + forward[start], count[start] + 1
                        if best is None or s > best or s == best and k < n:
                            best, n = s, k
                if c not in self.score:
                    s, k = forward[i] + unknown, count[i] + len(c.encode())
                    if best is None or s > best or s == best and k < n:
                        best, n = s, k
                forward.append(best)
                count.append(n)
            path = word
            self.terminal[word] = count[-1]

    def count_texts(self, batch: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        split = [Counter(t.split()) for t in batch]
        fresh = {w for c in split for w in c if w not in self.terminal}
        if len(fresh) + len(self.terminal) > TERMINALS:
            self.terminal.clear()
            fresh = {w for c in split for w in c}
        self.terminal.update(self._marked(fresh))
        at = self.terminal
        return [(sum(c.values()), sum(n * at[w] for w, n in c.items())) for c in split]

    def _marked(self, words) -> dict[str, int]:
        held, self.terminal = self.terminal, {}
        self.insert(SPACE + w for w in words)
        got = {w[len(SPACE):]: n for w, n in self.terminal.items()}
        self.terminal = held
        return got


def count_tokens(spark: SparkSession, docs: DataFrame, model_path: str,
                 id_col: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``n_pretokens`` and ``n_tokens`` (long) of every whole text.

    A pre-token is a run without white space, with a leading word mark; its
    tokens are those of the best unigram segmentation under the file's piece
    scores. A null or blank text counts 0; null ids and repeated rows stay as
    they are; an empty table gives an empty result; other columns are ignored.
    """
    prepare(spark)
    pieces = spark.sparkContext.broadcast(load_pieces(model_path))
    src = docs.select(id_col, *keep, text_col)
    n_keep = 1 + len(keep)
    out = T.StructType([*[src.schema[c] for c in (id_col, *keep)],
                        T.StructField("n_pretokens", T.LongType()),
                        T.StructField("n_tokens", T.LongType())])

    token = uuid.uuid4().hex

    def run(parts):
        trie = once(token, lambda: TrieCounter(pieces.value))
        for part in parts:
            counts = trie.count_texts(texts(part.column(n_keep)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n_keep], pa.array([a for a, _ in counts], pa.int64()),
                 pa.array([b for _, b in counts], pa.int64())], names=out.names)

    return src.mapInArrow(run, out)
