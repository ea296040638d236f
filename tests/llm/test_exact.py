"""Operators with an exact answer, against brute force."""

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer, models

from stockyard.llm import bpe, decontam, simhash, suffix_dedup, tokencount
from stockyard.llm.components import components

LONG = "long words of a very long text " * 4000
TEXTS = [None, "", " \n\t", "One two three four five.", "One two three four five.", "é ñ 中文 😀",
         "a", LONG, "<|endoftext|>x<|endoftext|>", "x" * 5000, "tab\tand  double  spaces\r\n"]


def docs(spark, texts, ids=None):
    """Documents with extra columns that clash with result columns."""
    rows = [(ids[k] if ids else k, t, "n", 1.5, k) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, score double, "
                                       "component_id long")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df):
    return {r[0]: r.asDict() for r in df.collect()}


# --- BPE -----------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_library(spark, bpe_path):
    tok = Tokenizer.from_file(bpe_path)
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("aabcd  \n'stlé1<|>.") for _ in range(60)) for _ in range(50)]
    got = by_id(bpe.encode_texts(spark, docs(spark, texts), bpe_path, with_ids=True))
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids)
        raw = np.array(ids, dtype="<u4").tobytes()
        assert got[k]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        back = tok.decode(ids, skip_special_tokens=False).encode()
        assert got[k]["decoded_sha256"] == hashlib.sha256(back).hexdigest()
    assert bpe.encode_texts(spark, empty(spark), bpe_path).count() == 0


def test_bpe_random_tokens(bpe_path):
    with open(bpe_path) as f:
        model = bpe.BpeModel(json.load(f))
    assert len(model.usable) == len(model.vocab)
    coder, tok = bpe.PrefixEncoder(model), Tokenizer.from_file(bpe_path)
    rng, words = random.Random(2), list(model.vocab.values())
    for _ in range(3000):
        s = b"".join(model.bytes_of[rng.choice(words)] for _ in range(4)).decode("utf-8", "ignore")
        assert np.frombuffer(coder.encode(s), "<u4").tolist() == \
            tok.encode(s, add_special_tokens=False).ids


def test_bpe_rejects_other_files(bpe_path):
    with open(bpe_path) as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        bpe.BpeModel(spec)
    spec["pre_tokenizer"]["add_prefix_space"] = False
    del spec["model"]["vocab"]["a"]
    with pytest.raises(ValueError, match="single bytes"):
        bpe.BpeModel(spec)


# --- token counts --------------------------------------------------------

def test_token_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = tokencount.load_pieces(path)
    got = by_id(tokencount.count_tokens(spark, docs(spark, TEXTS), path))
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    trie = tokencount.TrieCounter(pieces)
    known = {p for p, _ in pieces}
    for k, t in enumerate(TEXTS):
        split = (t or "").split()
        assert got[k]["n_pretokens"] == len(split)
        assert got[k]["n_tokens"] == sum(n for _, n in trie.count_texts(split))
        if split and all(c in known for w in split for c in w) and len(t) < 100:
            assert got[k]["n_tokens"] == sum(len(lib.encode("▁" + w).ids) for w in split)
    assert tokencount.count_tokens(spark, empty(spark), path).count() == 0


def test_trie_counts_equal_all_segmentations():
    rng = random.Random(4)
    pieces = [(p, -float(k)) for k, p in enumerate(
        ["▁", "a", "b", "ab", "ba", "▁a", "aba", "bb", "▁ab", "abab"])]
    score = dict(pieces)
    low = min(score.values()) - tokencount.UNKNOWN_PENALTY

    def best(word):
        if not word:
            return 0.0, 0
        out = []
        for n in range(1, len(word) + 1):
            head = word[:n]
            if head in score:
                s, k = score[head], 1
            elif n == 1:
                s, k = low, len(head.encode())
            else:
                continue
            s2, k2 = best(word[n:])
            out.append((s + s2, -(k + k2)))
        s, k = max(out)
        return s, -k

    trie = tokencount.TrieCounter(pieces)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(200)]
    for w, (_, n) in zip(words, trie.count_texts(words), strict=True):
        assert n == best("▁" + w)[1]


# --- SimHash -------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    h = [xxhash.xxh64(" ".join(words[k:k + 4]).encode(), seed=42).intdigest() for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps):
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return [top(x) for x in range(len(fps))]


def test_simhash_groups(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcd ") for _ in range(400)) for _ in range(8)]
    texts = list(TEXTS)
    for k in range(60):
        w = base[k % 8].split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = "zz"
        texts.append(" ".join(w))
    got = by_id(simhash.near_groups(spark, docs(spark, texts)))
    fps = [brute_fingerprint(t) for t in texts]
    assert [got[k]["fp"] % 2**64 for k in range(len(texts))] == fps
    assert [got[k]["component_id"] for k in range(len(texts))] == brute_groups(fps)
    assert len(set(brute_groups(fps))) < len(set(fps))
    assert simhash.near_groups(spark, empty(spark)).count() == 0


@pytest.mark.parametrize("n_segments", [2, 3, 4])
def test_multi_index_loses_no_link(spark, n_segments):
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for f in list(fps):
        for bits in (1, 2, 3, 4, 5):
            x = f
            for b in rng.sample(range(64), bits):
                x ^= 1 << b
            fps.append(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f, f) for f in signed], "fp long, label long")
    got = {(r["a"], r["b"]) for r in simhash.near_links(df, 4, n_segments).collect()}
    want = {tuple(sorted((signed[a], signed[b]))) for a in range(len(fps)) for b in range(a)
            if bin(fps[a] ^ fps[b]).count("1") <= 4}
    assert {tuple(sorted(p)) for p in got} == want


def test_keep_one(spark):
    t = "some words that make a text of their own here"
    rows = [(3, t), (2, t), (2, t), (2, "other text altogether, not at all alike, no"), (None, t),
            (None, "nameless one with words"), (None, "nameless one with words"), (9, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in simhash.keep_one(spark, df).collect()), key=str)
    assert got == sorted([(2, t), (2, rows[3][1]), (None, "nameless one with words"), (8, "")],
                         key=str)


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k)
                                                                          for k in range(30)]
    got = {r["node"]: r["label"] for r in
           components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: r for x, r in root.items() if x in linked}


# --- repeated strings ----------------------------------------------------

def brute_repeats(texts, n):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[k:k + n] for t in raw for k in range(len(t) - n + 1))
    out = []
    for t in raw:
        off = [False] * len(t)
        for k in range(len(t) - n + 1):
            if seen[t[k:k + n]] > 1:
                off[k:k + n] = [True] * n
        kept = bytes(b for b, o in zip(t, off, strict=True) if not o)
        spans = sum(o and (k == 0 or not off[k - 1]) for k, o in enumerate(off))
        out.append((len(t), sum(off), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats(spark, group):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    base, texts = word(2000), list(TEXTS[:7])
    for _ in range(40):
        t = ""
        for _ in range(rng.randint(0, 4)):
            kind, a = rng.random(), rng.randint(0, 1500)
            t += (base[a:a + rng.randint(1, 500)] if kind < .4 else word(rng.randint(1, 300))
                  if kind < .6 else rng.choice("ab") * rng.randint(1, 400) if kind < .8
                  else ("xy" + rng.choice("pq")) * rng.randint(1, 200))
        texts.append(t)
    texts += [texts[9], base]
    ids = [None if k == 8 else k for k in range(len(texts))]
    got = by_id(suffix_dedup.remove_repeats(spark, docs(spark, texts, ids), group=group))
    for i, want in zip(ids, brute_repeats(texts, 200), strict=True):
        assert tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == want


def test_phrases_cover_each_start_once(monkeypatch):
    rng = random.Random(11)
    text = bytes(rng.choice(b"abcd") for _ in range(5000)) + b"a" * 1500 + b"xyz" * 400

    def triggers():
        key, off, first, last = suffix_dedup.phrases(text)
        out = {}
        for k, o, a, b in zip(key.tolist(), off.tolist(), first.tolist(), last.tolist(), strict=True):
            for start in range(a, b + 1):
                assert start not in out and start <= a + o <= start + 200 - suffix_dedup.GRAM
                out[start] = (k, a + o)
        return out

    whole = triggers()
    assert sorted(whole) == list(range(len(text) - 199))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    assert triggers() == whole


def test_repeats_edge_tables(spark):
    assert suffix_dedup.remove_repeats(spark, empty(spark)).count() == 0
    t = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(300))
    twice = spark.createDataFrame([(1, t), (1, t), (2, "short")], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(spark, twice, with_text=True).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["kept_text"]) for r in got) == \
        [(1, 300, ""), (1, 300, ""), (2, 0, "short")]


# --- decontamination -----------------------------------------------------

def brute_hits(items, text, n):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: words.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    d, found = low(text), set()
    hit = [False] * len(d)
    for name, t in items:
        q = low(t)
        k = min(n, len(q))
        for i in range(len(q) - k + 1 if q else 0):
            for j in range(len(d) - k + 1):
                if d[j:j + k] == q[i:i + k]:
                    found.add(str(name))
                    hit[j:j + k] = [True] * k
    return len(d), sum(hit), len(found), ",".join(sorted(found))


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontamination(spark, block):
    rng = random.Random(9)
    some = lambda n: " ".join(rng.choice(["Aa", "b", "cé", "d1", "e"]) for _ in range(n))
    items = [(10, some(15)), (9, some(12)), (3, some(4)), (4, None), (5, "..."), (6, some(30)),
             (6, some(11)), (None, some(10)), (7, "b")]
    texts = list(TEXTS) + [some(rng.randint(0, 60)) for _ in range(30)] + \
        [f"xx {items[k][1]} yy" for k in (0, 1, 2, 5)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontam.decontaminate(spark, docs(spark, texts), table, with_text=True,
                                       block_bytes=block))
    named = [("" if i is None else i, t) for i, t in items]
    for k, t in enumerate(texts):
        n, hit, n_items, names = brute_hits(named, t, 10)
        r = got[k]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, n_items)
        assert r["items_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert r["contaminated"] == (hit > 0)
        if not hit:
            assert r["clean_text"] == t
        else:
            assert len(decontam.words(r["clean_text"].encode())) == n - hit
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in by_id(
        decontam.decontaminate(spark, docs(spark, TEXTS), none)).values())
    assert decontam.decontaminate(spark, empty(spark), table).count() == 0


def test_decontamination_holds_one_block(spark, monkeypatch):
    """Each pass broadcasts one bounded block, and none is left when the next comes."""
    from pyspark.core.broadcast import Broadcast
    words = [f"w{k}" for k in range(400)]
    rng = random.Random(2)
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(60)]
    texts = [f"aa {items[k][1]} {items[59 - k][1]} bb" for k in range(30)] + ["", None, "nothing"]
    sizes, alive = [], set()
    broadcast, destroy = type(spark.sparkContext).broadcast, Broadcast.destroy

    def held(self, value):
        assert not alive
        sizes.append(sum(len(t) for _, t in value))
        out = broadcast(self, value)
        alive.add(id(out))
        return out

    def gone(self, *a):
        alive.discard(id(self))
        return destroy(self, *a)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", held)
    monkeypatch.setattr(Broadcast, "destroy", gone)
    # A repeated row gets its result once for each copy.
    twice = docs(spark, texts).union(docs(spark, texts).where("doc_id = 3"))
    got = decontam.decontaminate(spark, twice, spark.createDataFrame(items, "item_id long, text string"),
                                 block_bytes=1200).collect()
    assert len(got) == len(texts) + 1
    assert len(sizes) > 2 and max(sizes) <= 1200 and not alive
    assert sorted(r["n_hit"] for r in got) == [0] * 3 + [24] * 31
    assert {r["n_items"] for r in got if r["n_hit"]} == {2}
