"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a pre-token exactly one vocabulary token can end its BPE
encoding. An Aho-Corasick automaton over the vocabulary lists the tokens that
end at each position, longest first; a candidate is the prefix's last token if
it may follow the last token of the shorter prefix before it (a test on the
two tokens' merge trees). Back-pointers then give the ids. No merge loop runs
over the text.

The pre-token boundaries come from the tokenizer file's own splitting rule.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stockyard.llm.common import once, prepare, texts

INF = float("inf")
# Units (space-separated pieces), pre-tokens and token pairs remembered by one worker.
UNIT_CACHE = 500_000
PIECE_CACHE = 700_000
PAIR_CACHE = 500_000

# A space with no other white space beside it always starts a new pre-token,
# so text may be cut in front of it.
_CUT = re.compile(r"(?<!\s) (?!\s)")
_DOUBLE_SPACE = re.compile(r"\s\s")
# A word of Latin-1 letters with its leading space is one pre-token by itself.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable character, the alphabet of byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others are numbered from
    256 upwards in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BpeModel:
    """A byte-level BPE tokenizer file as tables for the prefix encoder."""

    def __init__(self, spec: dict):
        m, pre = spec["model"], spec["pre_tokenizer"] or {}
        added = spec.get("added_tokens", [])
        if (m["type"], pre.get("type")) != ("BPE", "ByteLevel") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        if (m.get("dropout") or m.get("ignore_merges") or m.get("continuing_subword_prefix")
                or m.get("end_of_word_suffix") or pre.get("add_prefix_space")
                or not pre.get("use_regex", True)
                or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added)):
            raise ValueError("unsupported option in the tokenizer file")
        self.vocab: dict[str, int] = dict(m["vocab"])
        if missing := set(byte_alphabet().values()) - set(self.vocab):
            raise ValueError(f"the vocabulary lacks {len(missing)} of the 256 single bytes")
        self.special = {a["content"]: a["id"] for a in added}
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for k, pair in enumerate(m["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ids = self.vocab[a], self.vocab[b]
            self.rank.setdefault(ids, k)
            made.setdefault(self.vocab[a + b], (*ids, k))
        self.made = made
        self._lefts: dict[int, list] = {}
        self._rights: dict[int, list] = {}
        self.pairs: dict[int, bool] = {}
        # A merged token is usable only if its own two parts may not be split
        # differently; single characters always are.
        self.usable = {t for t, i in self.vocab.items() if len(t) == 1 or self._reachable(i)}
        back = {c: b for b, c in byte_alphabet().items()}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
            for t, i in [*self.vocab.items(), *self.special.items()]}

    def _reachable(self, token: int) -> bool:
        if token not in self.made:
            return False
        a, b, _ = self.made[token]
        return all(x not in self.made or self._reachable(x) for x in (a, b)) and \
            self._meets(self._spine(a, 1), self._spine(b, 0), self.made[token][2])

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens along the left (0) or right (1) edge of a token's merge
        tree, smallest first, each with the rank at which it grows."""
        known = self._rights if side else self._lefts
        if token not in known:
            chain, grows = [(token, INF)], INF
            while (t := chain[-1][0]) in self.made:
                grows = self.made[t][2]
                chain.append((self.made[t][side], grows))
            known[token] = chain[::-1]
        return known[token]

    def _meets(self, left: list, right: list, own: float = INF) -> bool:
        """Whether two neighbouring tokens grow up without a merge between
        them before rank ``own``: at each moment the edge tokens that exist
        must not merge earlier than either of them grows."""
        i = j = 0
        while True:
            (a, grow_a), (b, grow_b) = left[i], right[j]
            k = self.rank.get((a, b), INF)
            if k < min(own, grow_a) and k <= grow_b:
                return False
            if grow_a == grow_b == INF:
                return True
            if grow_a <= grow_b:  # the left one of two equal merges goes first
                i += 1
            else:
                j += 1

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            got = self.pairs[key] = self._meets(self._spine(a, 1), self._spine(b, 0))
        return got


class PrefixEncoder:
    """Encodes texts with a :class:`BpeModel`; one per Python worker."""

    def __init__(self, model: BpeModel, caches: float = 1.0):
        import ahocorasick
        from tokenizers import pre_tokenizers

        self.model, self.caches = model, caches
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.ends = ahocorasick.Automaton()
        for t in model.usable:
            self.ends.add_word(t, (len(t), model.vocab[t]))
        self.ends.make_automaton()
        self.whole = {t: struct.pack("<I", model.vocab[t]) for t in model.usable}
        self.special = re.compile("|".join(
            re.escape(t) for t in sorted(model.special, key=len, reverse=True))) \
            if model.special else None
        self.units: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = {b: c for b, c in byte_alphabet().items() if ord(c) != b}

    def pre_token(self, piece: str) -> bytes:
        """Packed ids of one pre-token, written in the byte alphabet."""
        got = self.whole.get(piece) or self.pieces.get(piece)
        if got is not None:
            return got
        pairs, follows = self.model.pairs, self.model.may_follow
        last, size = [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        done = 0  # prefixes whose last token is known
        for at, (n, token) in self.ends.iter(piece):
            if at < done:
                continue
            if n <= at:
                before = last[at + 1 - n]
                ok = pairs.get(before << 32 | token)
                if not (follows(before, token) if ok is None else ok):
                    continue
            done = at + 1
            last[done], size[done] = token, n
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        if len(self.pieces) >= self.caches * PIECE_CACHE:
            self.pieces.clear()
        packed = self.pieces[piece] = struct.pack(f"<{len(out)}I", *out)
        return packed

    def unit(self, text: str) -> bytes:
        if _WORD.fullmatch(text):
            packed = self.pre_token(text.encode().decode("latin-1").translate(self.letters))
        else:
            packed = b"".join([self.pre_token(piece) for piece, _ in self.split(text)])
        if len(self.units) >= self.caches * UNIT_CACHE:
            self.units.clear()
        self.units[text] = packed
        return packed

    def _plain(self, text: str) -> list[bytes]:
        parts = _CUT.split(text) if _DOUBLE_SPACE.search(text) else text.split(" ")
        known, unit = self.units.get, self.unit
        units = [parts[0], *[" " + p for p in parts[1:]]]
        return [known(u) or unit(u) for u in units]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.special is None or not self.special.search(text):
            return b"".join(self._plain(text))
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append(struct.pack("<I", self.model.special[m[0]]))
            at = m.end()
        return b"".join([*out, *self._plain(text[at:])])

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.model.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encode_texts(spark: SparkSession, docs: DataFrame, tokenizer_path: str,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
                 keep: tuple[str, ...] = (), caches: float = 1.0) -> DataFrame:
    """Encode and decode every whole text.

    One row per input row: the id, ``keep`` columns, ``n_tokens``,
    ``ids_sha256``, ``decoded_sha256`` and, if ``with_ids``, ``ids``
    (array<int>). A null text is empty and has no ids; a null id and repeated
    rows stay as they are; an empty table gives an empty result; other columns
    are ignored. The tokenizer file (a few MB) is read by the driver and
    broadcast. ``caches`` scales what a worker remembers (about 300 MB at 1).
    """
    prepare(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    src = docs.select(id_col, *keep, text_col)
    fields = [src.schema[c] for c in (id_col, *keep)]
    from pyspark.sql import types as T
    out = T.StructType([*fields, T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        out.add("ids", T.ArrayType(T.IntegerType()))
    n_keep = 1 + len(keep)
    token = uuid.uuid4().hex

    def run(parts):
        coder = once(token, lambda: PrefixEncoder(BpeModel(json.loads(spec.value)), caches))
        for part in parts:
            packed = [coder.encode(t) for t in texts(part.column(n_keep))]
            cols = [*part.columns[:n_keep],
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(coder.decode(p).encode()).hexdigest()
                              for p in packed])]
            if with_ids:
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int32)
                ids = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(cols, names=out.names)

    return src.mapInArrow(run, out)
