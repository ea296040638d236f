"""Operators that learn: contracts, held-out accuracy, edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stockyard.llm import ann, langid, lm, toxicity, urlfilter
from stockyard.llm.queries import URL_RULES

SF = "/root/testdata/sf0.01"
EDGE = [None, "", "123 !?", "x" * 20000, "der die das " * 5000]


def crc(i, n):
    return 0 if i is None else zlib.crc32(str(i).encode()) % n


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- language ------------------------------------------------------------

def test_language(spark):
    docs = table(spark, "documents")
    extra = spark.createDataFrame([(10_000 + k, t, None, "s", 0) for k, t in enumerate(EDGE)],
                                  docs.schema)
    got = {r["doc_id"]: r for r in langid.identify(
        spark, docs.union(extra).selectExpr("*", "1 as score", "2 as held_out")).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) + len(EDGE)
    tested = [r for r in rows if crc(r["doc_id"], 3) == 1]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in tested]) > 0.98
    assert all(got[r["doc_id"]]["held_out"] for r in tested)
    assert [got[10_000 + k]["lang_pred"] for k in range(3)] == ["und"] * 3
    assert got[10_004]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_backs_off():
    m = langid.LanguageModel(["a", "b"], {"known": [5, 0]},
                             {"xyz": [0, 9], "abc": [9, 0], "x": [9, 0], "q": [3, 1]})
    assert m.predict("known")[0] == "a"
    assert m.predict("wxyzw")[0] == "b"   # the trigram decides, not the letter
    assert m.predict("x")[0] == "a"
    assert m.predict("ü")[0] == "a"       # nothing known: a tie


def test_language_keeps_rare_words(spark):
    """The words of a small language count beside many more frequent ones, though
    their n-grams belong to words of another language."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=9))
    ids = [k for k in range(400) if crc(k, 3) != 1]
    own = [word() for _ in range(60)]
    rows = [(ids[k], " ".join([word() for _ in range(1800)] * 2
                              + [f"q{w}q" for w in own] * 10 * (k % 2)), "xy"[k % 2])
            for k in range(100)]
    rows.append((ids[100], " ".join(own), "z"))
    held = [k for k in range(400) if crc(k, 3) == 1][:20]
    rows += [(k, " ".join(rng.sample(own, 5)), None) for k in held]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark, spark.createDataFrame(
        rows, "doc_id long, text string, lang string")).collect()}
    assert [got[k] for k in held] == ["z"] * 20


def test_language_without_training(spark):
    nothing = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in langid.identify(spark, nothing).collect()] == [("und", 0.0)]
    assert langid.identify(spark, nothing.limit(0)).count() == 0


# --- toxicity ------------------------------------------------------------

def labelled(spark, n=600):
    rng = random.Random(3)
    docs, labels = [], []
    for k in range(n):
        w = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(60)]
        if k % 3 == 0:
            w[rng.randrange(60)] = "zorky" + rng.choice("abc")
        docs.append((k, " ".join(w), "score"))
        labels.append((k, int(k % 3 == 0)))
    docs += [(n + k, t, "score") for k, t in enumerate(EDGE)] + [(None, "zorkya", "score")]
    labels += [(None, 1), (n + 1, None), (10**9, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"), n)


def test_toxicity(spark):
    docs, labels, n = labelled(spark)
    got = {r["doc_id"]: r for r in toxicity.score_texts(spark, docs, labels).collect()}
    assert len(got) == n + len(EDGE) + 1
    tested = [k for k in range(n) if crc(k, 5) == 0]
    assert all(got[k]["held_out"] for k in tested)
    assert np.mean([got[k]["predicted"] == (k % 3 == 0) for k in tested]) > 0.95
    assert got[n]["score"] == got[n + 1]["score"] == got[n + 2]["score"]
    assert got[None]["predicted"] == 1 and got[n]["predicted"] == 0
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_toxicity_without_labels(spark):
    docs, labels, _ = labelled(spark, 6)
    got = toxicity.score_texts(spark, docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in got} == {0} and len(got) == 6 + len(EDGE) + 1
    assert toxicity.score_texts(spark, docs.limit(0), labels).count() == 0


def packed(words):
    """PackedPair and KneserNeyPair of (word, toxic count, ordinary count)."""
    top = {}
    for w, *n in words:
        for g in toxicity.grams(w, toxicity.ORDER):
            top[g] = tuple(np.add(top.get(g, (0, 0)), n).tolist())
    codes = np.array([[0] * (toxicity.ORDER - len(g)) + [ord(c) for c in g] for g in top], dtype="u4")
    assert (toxicity.unpack(*toxicity.pack(codes)) == codes).all()
    return toxicity.PackedPair(codes, np.array(list(top.values()))), toxicity.KneserNeyPair(top)


def test_packed_pair_is_kneser_ney_pair():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé中𐐨") for _ in range(rng.randint(1, 9)))
    pair, plain = packed([(word(), rng.randrange(3), rng.randrange(1, 4)) for _ in range(300)]
                         + [("zorky", 2, 0)])
    ws = [*(word() for _ in range(300)), "zorky", "zorkyx", "unseen", "a"]
    assert pair.ratios(ws) == pytest.approx([plain.ratio(w) for w in ws], abs=1e-9)
    assert toxicity.PackedPair(np.zeros((0, 6), dtype="u4"), np.zeros((0, 2), dtype=int)) \
        .ratios(["any", "word"]) == [0.0, 0.0]


def test_toxicity_keeps_rare_grams(spark):
    """A toxic expression counts however many ordinary n-grams are as frequent."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + k) for k in range(3000)]
    plain = [" ".join("".join(rng.choices(letters, k=8)) for _ in range(400)) for _ in range(240)]
    docs = [(k, t) for k, t in enumerate(plain)]
    # One expression in each toxic text, in two texts each.
    marks = ["zz" + "".join(rng.choices("abcdefghij", k=8)) for _ in range(12)]
    docs += [(1000 + k, marks[k % 12]) for k in range(24)]
    labels = [(k, int(k >= 1000)) for k, _ in docs]
    pair, _ = toxicity.fit(spark, spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(labels, "doc_id long, toxic int"))
    known = {t for k, t in docs if k >= 1000 and crc(k, 5)}
    assert len(pair.top.keys) > 600_000
    assert all(x > 0 for x in pair.ratios(sorted(known)))


def test_kneser_ney_sums_to_one():
    words = Counter({"abc": 3, "abd": 1, "b": 2})
    top = {}
    for c in (0, 1):
        for w, n in words.items():
            for g in toxicity.grams(w, toxicity.ORDER):
                row = top.setdefault(g, [0, 0])
                row[c] += n if c == 0 or w != "abd" else 0
    pair = toxicity.KneserNeyPair({g: tuple(v) for g, v in top.items()})
    # The pooled backoff is a distribution over the seen characters and one more.
    chars = {g[-1] for g in pair.cont if g}
    for h in ("", "a", "ab", "zz"):
        total = sum(pair.shared(h + c) for c in chars) + pair.shared(h + "\0")
        assert total == pytest.approx(1.0)


# --- language model ------------------------------------------------------

@pytest.mark.parametrize("frequent", [300_000, 500])
def test_lm(spark, frequent):
    docs = table(spark, "documents").where("doc_id < 300").select("doc_id", "text")
    edge = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(EDGE)] + [
        (None, "a b"), (7, "repeated id")], docs.schema)
    docs = docs.union(edge).selectExpr("*", "1 as r", "2 as c", "3 as score")
    got = lm.score_texts(spark, docs, frequent=frequent).collect()
    rows = docs.collect()
    assert len(got) == len(rows)

    def low(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", t), None]

    c = Counter(w for r in rows if crc(r["doc_id"], 5) != 1 for w in low(r["text"]))
    n, v = sum(c.values()), len(c)
    want = sorted((str(r["doc_id"]), crc(r["doc_id"], 5) == 1, len(w), sum(c[x] > 0 for x in w), n,
                   round(sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w), 5))
                  for r in rows for w in [low(r["text"])])
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 5)) for r in got) == want
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_lm_is_a_distribution():
    """Class and word probabilities of one context sum to one over the known
    words and one unseen word of each tail class."""
    words = [f"w{k}".encode() for k in range(700)]
    counts = list(range(1000, 300, -1))
    tail = np.zeros((2, lm.TAIL_CLASSES), dtype=int)
    for w, c in list(zip(words, counts, strict=True))[lm.HEAD:]:
        tail[:, lm.tail_class(w)] += (c, 1)
    v = lm.Vocabulary(words, counts, tail[0].tolist(), tail[1].tolist(), sum(counts), len(words))
    rng = np.random.RandomState(0)
    w = lm.Weights(v, rng.randn(v.rows, lm.CLASSES).astype("f4"),
                   rng.randn(v.word_rows, lm.SIZE).astype("f4"))
    ids = np.arange(len(words) + lm.TAIL_CLASSES)
    flat = np.stack([np.full_like(ids, 5), ids], axis=1).ravel()
    p = 10 ** w.log10_p(v, flat, np.arange(0, len(flat), 2))[1::2]
    # A rare word's own count is joined later: an unseen word has half a count.
    p[len(words):] *= 0.5
    assert p.sum() == pytest.approx(1.0, abs=1e-4)


def test_lm_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_texts(spark, none).count() == 0
    held = next(k for k in range(99) if crc(k, 5) == 1)
    one = spark.createDataFrame([(held, "only a held-out text")], "doc_id long, text string")
    r = lm.score_texts(spark, one).collect()[0]
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)


# --- URLs ----------------------------------------------------------------

def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(r), r, v) for v, r in URL_RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[r.index("/"):])]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "https://example.org/en/1x?q",
        "https://notexample.org/en/1", "http://org", "http://org/", "http://a.com/de/x#y", "x://y://z.com/fr/",
        "http://b.com?/de/", "http://É.com/fr/", "http://a.com/de", "http://h\nx.com/fr/a\nb", "http://a.net/" + "p/" * 3000]


def test_url_rules_and_trees(spark):
    pages = table(spark, "pages").select("page_id", "url")
    more = spark.createDataFrame([(10_000 + k, u) for k, u in enumerate(URLS)] + [(None, "http://q.net/")],
                                 pages.schema)
    every = pages.union(more).selectExpr("*", "'h' as host", "1 as score", "2 as n")
    got = {r["page_id"]: r for r in urlfilter.judge(spark, every, URL_RULES).collect()}
    assert len(got) == every.count()
    for r in every.collect():
        host, path, rule, verdict = brute_rule(r["url"])
        g = got[r["page_id"]]
        assert (g["host"], g["path"], g["rule"]) == (host, path, rule)
        assert g["verdict"] in ("allow", "block") and (verdict is None or g["verdict"] == verdict)
        assert (g["score"] is None) == (rule is not None)


def test_url_trees_learn(spark):
    rng = random.Random(2)
    host = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    good = [f"https://{host()}.org/en/{rng.randrange(99)}" for _ in range(150)]
    bad = [f"http://example.org/es/{rng.randrange(10**6)}?a=1&b=2&c=3" for _ in range(150)]
    new = [f"https://{host()}.net/en/{k}" for k in range(9)] + \
        [f"http://{host()}.net/xx/{10**6 + k}?a=1&b=2&c=3" for k in range(9)]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(new + good + bad)],
                               "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(spark, df, URL_RULES).collect()}
    assert [got[k] for k in range(18)] == ["allow"] * 9 + ["block"] * 9


def test_url_counts_cover_all_labelled(spark):
    """The domain alone tells the classes apart, and most domains are not in the
    fit sample."""
    rows = [(f"d{k:03}", ("de", "fr")[k % 2], j) for k in range(300) for j in range(12)]
    df = [(k, f"http://{d}.com/{x}/{j:02}") for k, (d, x, j) in enumerate(rows)]
    df += [(10_000 + k, f"http://d{k:03}.com/zz/00") for k in range(300)]
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(
        spark, spark.createDataFrame(df, "page_id long, url string"), URL_RULES,
        fit_rows=200).collect()}
    assert len(got) == len(df)
    assert np.mean([got[10_000 + k] == ("block", "allow")[k % 2] for k in range(300)]) > 0.97


def test_url_sample_holds_the_rare_class(spark):
    df = spark.range(5000).selectExpr("id as page", "concat('u', id) as url",
                                      "cast(id % 1000 = 7 as int) as y")
    got = urlfilter.draw(spark, df, {0: 4995, 1: 5}, 100).collect()
    assert sorted(r["page"] for r in got if r["y"] == 1) == [7, 1007, 2007, 3007, 4007]
    assert len(got) == 100
    share = sum(r["weight"] for r in got if r["y"] == 1) / sum(r["weight"] for r in got)
    assert share == pytest.approx(5 / 5000)
    copies = spark.range(5000).selectExpr("1L as page", "'u' as url", "cast(id = 0 as int) as y")
    got = urlfilter.draw(spark, copies, {0: 4999, 1: 1}, 100).collect()
    assert sorted(r["y"] for r in got) == [0] * 99 + [1]


def test_url_one_sided(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (2, "http://a.com/de/")], "page_id long, url string")
    one = {r["page_id"]: r["verdict"] for r in urlfilter.judge(spark, df, URL_RULES).collect()}
    assert one == {1: "block", 2: "block"}
    got = urlfilter.judge(spark, df.where("page_id = 1"), URL_RULES).collect()
    assert [r["verdict"] for r in got] == ["allow"]
    assert urlfilter.judge(spark, df.limit(0), URL_RULES).count() == 0


# --- nearest neighbours --------------------------------------------------

def exact(ids, x, query, k):
    u = x / np.sqrt((x * x).sum(1))[:, None]
    at = int(np.flatnonzero(ids == query)[0])
    s = np.where(ids == query, -2, (u * u[at]).sum(1))
    order = np.lexsort((ids, -np.round(s, 12)))[:k]
    return [(int(ids[j]), s[j]) for j in order if s[j] > -2]


def test_nearest_neighbours(spark):
    rng = np.random.RandomState(1)
    centres = rng.randn(20, 16)
    x = (centres[rng.randint(0, 20, 3000)] + 0.3 * rng.randn(3000, 16)).astype("f4").astype(float)
    x[500:1500] = x[500]                    # a hot vector
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(5000, None, 1), (5050, [0.0] * 16, 1), (5100, [float("nan")] * 16, 1),
             (5150, [None] * 16, 1), (5200, [float("inf")] * 16, 1), (None, [1.0] * 16, 1),
             (5250, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in ann.nearest_neighbours(spark, df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 3000, 50))
    ids, hit, near = np.arange(3000), 0, 0
    for q, found in got.items():
        want = exact(ids, x, q, 5)
        assert len(found) == 5 and all(q != i for i, _ in found)
        hit += len({i for i, _ in want} & {i for i, _ in found})
        near += sum(s >= want[-1][1] - 1e-9 for _, s in found)
    assert near / 300 >= 0.9 and hit / 300 >= 0.85
    assert [i for i, _ in got[1000]] == [500, 501, 502, 503, 504]


def test_nearest_neighbours_small(spark):
    schema = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (50, [2.0, 0.0]), (51, [0.0, 1.0])], schema)
    got = [tuple(r)[:3] for r in ann.nearest_neighbours(spark, three)
           .orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 50), (0, 2, 51), (50, 1, 0), (50, 2, 51)]
    assert ann.nearest_neighbours(spark, three.limit(0)).count() == 0
    assert ann.nearest_neighbours(spark, three.where("vec_id = 0")).count() == 0


def test_recall_of_a_crowded_leaf(spark, caplog, monkeypatch):
    """One leaf holds all rows: its own tree is opened until the recall is reached."""
    x = np.random.RandomState(5).randn(1200, 24)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    index = ann.Index(spark, df, "vec_id", "embedding", leaf_rows=8, sample_rows=6)
    assert index.n_leaves < 8
    visits, reached = index.calibrate(index.rows, 5, 0.99, test_queries=40)
    assert reached >= 0.99 and visits > index.n_leaves
    monkeypatch.setattr(ann.Index, "calibrate", lambda *a, **b: (4, 0.5))
    ann.nearest_neighbours(spark, df)
    assert "recall 0.500" in caplog.text


def test_queries_are_streamed(spark):
    """A shard's queries come in batches, not as one group."""
    x = np.random.RandomState(6).randn(900, 8)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        index = ann.Index(spark, df, "vec_id", "embedding", leaf_rows=32, shard_rows=200)
        found = index.search(index.rows, 3, index.n_leaves)
        got = [(r["query_id"], r["vec_id"]) for r in found.orderBy("query_id", "rank").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == [(q, i) for q in range(900) for i, _ in exact(np.arange(900), x, q, 3)]
    assert "CoGroup" not in found._jdf.queryExecution().toString()


def test_tree_visits_every_leaf_once():
    x = np.random.RandomState(0).randn(500, 8)
    tree = ann.KMeansTree(x, 20)
    assert sorted(tree.best_bins(x[0], 10**6)) == list(range(tree.n_leaves))
    assert len(np.unique(tree.file(x))) == tree.n_leaves
    assert ann.KMeansTree(np.ones((100, 8)), 20).n_leaves == 1
