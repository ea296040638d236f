"""URL filters: host and path rules, and gradient-boosted trees for the rest.

URLs that a rule decides are the labelled ones; the trees learn from lexical
features of a bounded sample of them, and from suffix and domain counts of all
of them, and judge the URLs that no rule fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm.common import prepare, written

# Labelled URLs that a fit reads at most (by hash), and the ensemble's size.
FIT_ROWS = 20_000
TREES, DEPTH, STEP = 16, 4, 0.3
SMOOTHING = 5.0
FOLDS = 5  # of labelled URLs; a sample row's counts leave out its own fold
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = ("n_url", "n_host", "n_path", "n_query", "depth", "labels", "digits", "host_digits",
            "hyphens", "entropy", "params", "https", "suffix_rate", "suffix_log_n", "domain_rate",
            "domain_log_n")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits. Rules
    are (verdict, "host/path start"); of equally long ones that with the longer
    host wins, then a block."""
    out, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[0] == "block")):
        name, at = rule.split("/", 1)
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) \
            & F.startswith(path, F.lit("/" + at))
        out = F.when(fits, F.lit(rule)).otherwise(out)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return out, verdict


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def lexical(pages: DataFrame) -> DataFrame:
    """Lexical features from ``url``, ``host`` and ``path`` (null: empty)."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, "(?s)[?]([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1))
    share = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(
        c != "", (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / F.length(c) / n)
        .otherwise(0.0))
    entropy = F.aggregate(share, F.lit(0.0),
                          lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    labels = F.split(host, "[.]")
    return pages.withColumns({
        "n_url": F.length(url).cast("double"), "n_host": F.length(host).cast("double"),
        "n_path": F.length(path).cast("double"), "n_query": F.length(query).cast("double"),
        "depth": _count(path, "/").cast("double"), "labels": F.size(labels).cast("double"),
        "digits": _count(url, "0123456789") / n,
        "host_digits": _count(host, "0123456789").cast("double"),
        "hyphens": _count(host, "-").cast("double"), "entropy": entropy,
        "params": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        "https": F.startswith(url, F.lit("https:")).cast("double"),
        "suffix": F.element_at(labels, -1),
        "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")})


def _rates(df: DataFrame, stats: DataFrame, name: str, folds: DataFrame | None) -> DataFrame:
    """Share of blocked labelled URLs with the same suffix or domain, and their
    number; with ``folds``, without those of the row's own fold. (Without the
    row's own label alone, the share would tell that label.)"""
    # One row for each suffix or domain of all labelled URLs: no broadcast hint,
    # Spark goes by the size of the written table.
    df = df.join(stats.select(name, "n", "blocked"), name, "left")
    n, bad = F.coalesce("n", F.lit(0)), F.coalesce("blocked", F.lit(0))
    if folds is not None:
        df = df.join(folds.select(name, "fold", F.col("n").alias("n_own"),
                                  F.col("blocked").alias("bad_own")), [name, "fold"], "left")
        n, bad = n - F.coalesce("n_own", F.lit(0)), bad - F.coalesce("bad_own", F.lit(0))
    return df.withColumn(f"{name}_rate", (bad + SMOOTHING / 2) / (n + SMOOTHING)) \
        .withColumn(f"{name}_log_n", F.log1p(n.cast("double"))) \
        .drop("n", "blocked", "n_own", "bad_own")


def judge(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]],
          id_col: str = "page_id", url_col: str = "url", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every URL.

    ``score`` is the trees' probability of a block (null where a rule decides);
    the verdict is the rule's, else block from one half on. A null URL, or one
    without ``://``, has empty host and path, fits no rule and is judged by the
    trees. If rules decide no URL, all others are allowed; if they decide all
    labelled ones alike, the others get that verdict. Null ids and repeated
    rows are judged like any other; an empty table gives an empty result; other
    columns are ignored.
    """
    prepare(spark)
    url = F.col("url")
    base = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url")) \
        .withColumn("host", host_of(url)).withColumn("path", path_of(url))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = lexical(base.withColumn("rule", rule).withColumn("given", verdict)) \
        .withColumn("y", F.when(F.col("given") == "block", 1).when(F.col("given") == "allow", 0))
    known = base.where(F.col("y").isNotNull()).withColumn(
        "fold", F.pmod(F.xxhash64("page", "url", F.lit("fold")), F.lit(FOLDS)))
    # Partial aggregates of all labelled URLs; a domain lies within one suffix.
    sums = [F.sum(c).alias(c) for c in ("n", "blocked")]
    domain_folds = written(spark, known.groupBy("suffix", "domain", "fold").agg(
        F.count("*").alias("n"), F.sum("y").alias("blocked")), "url-domain-folds")
    suffix_folds = written(spark, domain_folds.groupBy("suffix", "fold").agg(*sums),
                           "url-suffix-folds")
    domains = written(spark, domain_folds.groupBy("domain").agg(*sums), "url-domains")
    suffixes = written(spark, suffix_folds.groupBy("suffix").agg(*sums), "url-suffixes")
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("blocked").alias("bad")).first()
    n = {1: total["bad"] or 0, 0: (total["n"] or 0) - (total["bad"] or 0)}
    if not n[0] or not n[1]:
        same = "block" if n[1] else "allow"
        return _result(base.withColumn("p", F.lit(1.0 if n[1] else 0.0)), id_col, same)
    sample = draw(spark, known, n, fit_rows)
    model = fit(_rates(_rates(sample, suffixes, "suffix", suffix_folds),
                       domains, "domain", domain_folds))
    rest = _rates(_rates(base.where(F.col("y").isNull()), suffixes, "suffix", None),
                  domains, "domain", None)
    scored = model.transform(_features(rest)) \
        .withColumn("p", _second(F.col("probability")))
    return _result(scored, id_col).union(_result(known.withColumn("p", F.lit(None).cast("double")),
                                                 id_col))


def draw(spark: SparkSession, known: DataFrame, n: dict[int, int], fit_rows: int) -> DataFrame:
    """About ``fit_rows`` labelled URLs, those of the lowest hashes of each class
    (half of them, or all of a smaller class), with ``weight``: the classes weigh
    as they do among all ``n`` labelled URLs."""
    hashed = known.withColumn("h", F.pmod(F.xxhash64("page", "url"), F.lit(1 << 52)))
    most = {y: max(1, fit_rows - min(n[1 - y], fit_rows // 2)) for y in n}
    parts = {}
    for y, k in most.items():
        mine = hashed.where(F.col("y") == y)
        # The hash of copies is one: where few URLs repeat, none may lie below.
        low = mine.where(F.col("h") < min(1.0, 2 * k / n[y]) * (1 << 52))
        for some in (low, mine):
            parts[y] = written(spark, some.orderBy("h").limit(k).drop("h"), "url-sample")
            if held := parts[y].count():
                break
        parts[y] = parts[y].withColumn("weight", F.lit(n[y] / held))
    both = parts[0].union(parts[1])
    mean = sum(n.values()) / both.count()
    return both.withColumn("weight", F.col("weight") / mean)


def _features(df: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def _second(probability: Column) -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(probability)[1]


def fit(sample: DataFrame):
    """Gradient-boosted trees on the features of labelled URLs."""
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(labelCol="y", featuresCol="features", weightCol="weight", maxIter=TREES, maxDepth=DEPTH,
                         stepSize=STEP, seed=7).fit(_features(sample))


def _result(df: DataFrame, id_col: str, same: str | None = None) -> DataFrame:
    own = F.lit(same) if same else F.when(F.col("p") >= 0.5, "block").otherwise("allow")
    return df.select(F.col("page").alias(id_col), "host", "path", "rule",
                     F.coalesce("given", own).alias("verdict"),
                     F.when(F.col("rule").isNull(), F.col("p")).alias("score"))
