"""Approximate nearest neighbours by cosine: a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is filed under one leaf. A
query walks the tree best-bin-first: a priority queue holds the branches met
so far by their distance, and the nearest one is opened next, until a number of
leaves is reached. That number is widened until the recall measured against
brute force, on a sample of queries, reaches the target.

Neighbouring leaves form a block, whose rows are dealt to shards of bounded size;
a query meets each shard once, with the leaves it visits there, and the queries
of a shard are streamed past its rows, however many they are. A crowded leaf
gets a tree of its own inside a shard, searched in the same way, so a leaf with
a third of all rows is neither one task nor one long scan.
"""

from __future__ import annotations

import heapq
import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import prepare, written

_LOG = logging.getLogger(__name__)

BRANCH = 8
LEAF_ROWS = 256           # rows of a leaf, on average
SAMPLE_ROWS = 20_000      # rows that the tree is fitted on
BLOCK_LEAVES = 16         # neighbouring leaves that are searched together
SHARD_ROWS = 16_384       # rows of a block that one group holds
TEST_QUERIES = 200        # queries of the calibration
RECALL = 0.93             # recall that the calibration asks for
BLOCK = 2_048


class KMeansTree:
    """k-means applied again and again to its own clusters."""

    def __init__(self, rows: np.ndarray, leaf_rows: int, branch: int = BRANCH, seed: int = 1):
        self.centres: list[np.ndarray | None] = []  # of a node's children
        self.children: list[list[int]] = []
        self.leaf: list[int] = []                   # leaf number, or -1
        self.n_leaves = 0
        rng = np.random.RandomState(seed)
        todo = [(self._node(), rows)]
        while todo:
            node, x = todo.pop(0)
            parts = self._split(x, branch, rng) if len(x) > leaf_rows else None
            if parts is None:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1
                continue
            centres, member = parts
            self.centres[node] = centres
            self.children[node] = [self._node() for _ in centres]
            todo += [(c, x[member == k]) for k, c in enumerate(self.children[node])]

    def _node(self) -> int:
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    @staticmethod
    def _split(x: np.ndarray, branch: int, rng, rounds: int = 8):
        different = np.unique(x[rng.permutation(len(x))[:BLOCK]], axis=0)
        if len(different) < 2:
            return None
        centres = different[rng.permutation(len(different))[:branch]]
        for _ in range(rounds):
            member = nearest(x, centres)
            used = np.unique(member)
            centres = np.stack([x[member == k].mean(axis=0) for k in used])
        member = nearest(x, centres)
        used, member = np.unique(member, return_inverse=True)
        return (centres[used], member) if len(used) > 1 else None

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the nearest branch."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if self.leaf[node] >= 0:
                out[at] = self.leaf[node]
            elif len(at):
                member = nearest(rows[at], self.centres[node])
                todo += [(c, at[member == k]) for k, c in enumerate(self.children[node])]
        return out

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves that a best-bin-first walk reaches."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                found.append(self.leaf[node])
            else:
                far = ((self.centres[node] - query) ** 2).sum(axis=1)
                for d, c in zip(far.tolist(), self.children[node], strict=True):
                    heapq.heappush(queue, (d, c))
        return found


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([(half - x[k:k + BLOCK] @ centres.T).argmin(axis=1)
                           for k in range(0, len(x), BLOCK)]) if len(x) else np.zeros(0, int)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (through their largest component, so that no
    square overflows)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
        label: np.ndarray | None = None, asked: np.ndarray | None = None):
    """(query id, row id, cosine) of the ``k`` nearest ids of each query but its
    own, an id of several rows by the nearest of them; ties to smaller ids. With ``label`` (of a row) and ``asked`` (query
    x label) a query sees only rows of the labels it asks for. The sum of each
    cosine is taken in the order of the components, alike for equal rows."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    label = None if label is None else label[order]
    firsts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else order
    for start in range(0, len(q), 64):  # bounded products
        rough = q[start:start + 64] @ x.T
        if label is not None:
            rough[~asked[start:start + 64][:, label]] = -2.0
        for i, v, s in zip(q_ids[start:start + 64].tolist(), q[start:start + 64], rough, strict=True):
            s[ids == i] = -2.0
            # The product rounds as it likes: all rows about as near as the k-th
            # get their exact cosine, so that ties are settled by id.
            each = s if len(firsts) == len(s) else np.maximum.reduceat(s, firsts)
            cut = np.partition(each, len(each) - k)[len(each) - k] - 1e-9 if len(each) > k else -1.5
            near = np.flatnonzero(s >= max(cut, -1.5))
            exact = np.minimum(np.maximum((x[near] * v).sum(axis=1), -1.0), 1.0)
            best = np.argsort(-exact, kind="stable")
            if len(each) < len(s):  # the nearest row of each id
                best = best[np.sort(np.unique(ids[near[best]], return_index=True)[1])]
            yield from ((i, int(ids[near[j]]), float(exact[j])) for j in best[:k])


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``v`` (array<double>) of the vectors that take part: of the
    most frequent length, without null or non-finite components, not zero. Rows
    may repeat an id, with the same vector or another."""
    d = rows.select(F.col(id_col).cast("long").alias("id"),
                    F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull()) \
        .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))") \
        .where("exists(v, x -> x <> 0)")
    sizes = d.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c"))
    best = sizes.orderBy(F.desc("c"), "n").limit(1).collect()
    return d.where(F.size("v") == (best[0]["n"] if best else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return unit(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, 1))


_PAIRS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _pairs(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(cols, _PAIRS, strict=True)], schema=_PAIRS)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest ids of each query id; pairs may repeat."""
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def brute_force(spark: SparkSession, rows: DataFrame, queries: list, k: int) -> DataFrame:
    """Exact nearest rows of a bounded set of queries (id, vector), against
    all rows in blocks."""
    if not queries:
        return spark.createDataFrame([], "query_id long, vec_id long, score double")
    held = spark.sparkContext.broadcast((np.array([q[0] for q in queries]),
                                         unit(np.array([q[1] for q in queries]))))

    def run(parts):
        for part in parts:
            if part.num_rows:
                yield _pairs(list(top(*held.value, part.column(0).to_numpy(),
                                      matrix(part.column(1)), k)))

    return rows.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score double")


class Index:
    """Rows of an embedding table filed under the leaves of a tree."""

    def __init__(self, spark: SparkSession, rows: DataFrame, id_col: str, vec_col: str,
                 leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS,
                 shard_rows: int = SHARD_ROWS):
        prepare(spark)
        self.spark, self.leaf_rows = spark, leaf_rows
        self.rows = written(spark, usable(rows, id_col, vec_col), "ann-rows")
        self.n = self.rows.count()
        if not self.n:
            return
        spot = F.pmod(F.xxhash64("id", F.lit("tree")), F.lit(1_000_000)) / 1_000_000
        picked = self.rows.where(spot < sample_rows / self.n).limit(2 * sample_rows) \
            .select("id", "v").toPandas().sort_values("id") \
            if self.n > sample_rows else self.rows.toPandas().sort_values("id")
        sample = unit(np.stack(picked["v"].to_numpy()))
        # Leaves of the sample that stand for leaf_rows rows of the table.
        tree = KMeansTree(sample, max(8, math.ceil(leaf_rows * len(sample) / self.n)))
        self.tree = spark.sparkContext.broadcast(tree)
        self.n_leaves = tree.n_leaves

        def file(parts):
            for part in parts:
                leaf = self_tree.value.file(matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaf)],
                                                 names=["id", "v", "leaf"])

        self_tree = self.tree
        filed = self.rows.mapInArrow(file, "id long, v array<double>, leaf long")
        self.filed = written(spark, filed, "ann-leaves")
        # Shards of each block of leaves; no more rows than the tree has leaves.
        self.shards = {r["block"]: max(1, math.ceil(r["n"] / shard_rows)) for r in
                       self.filed.groupBy(F.floor(F.col("leaf") / BLOCK_LEAVES).alias("block"))
                       .agg(F.count("*").alias("n")).collect()}

        # Visits at which the trees of crowded leaves are searched whole, too.
        self.widest = max(self.n_leaves, self.filed.groupBy("leaf").count()
                          .agg(F.max("count")).first()[0])

    def search(self, queries: DataFrame, k: int, visits: int) -> DataFrame:
        """The ``k`` nearest rows found of each query (``id``, ``v``)."""
        tree = self.tree
        shards = self.spark.sparkContext.broadcast(self.shards)
        large = 4 * self.leaf_rows

        def route(parts):
            for part in parts:
                at, block, shard, leaves = [], [], [], []
                for i, v in enumerate(matrix(part.column(1))):
                    mine: dict[int, list[int]] = {}
                    for b in tree.value.best_bins(v, visits):
                        mine.setdefault(b // BLOCK_LEAVES, []).append(b)
                    for b, found in mine.items():
                        for n in range(shards.value.get(b, 0)):
                            at.append(i)
                            block.append(b)
                            shard.append(n)
                            leaves.append(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), pa.array(shard, pa.int64()),
                     pa.array(leaves, pa.list_(pa.int64())),
                     part.column(0).take(pa.array(at, pa.int64())),
                     part.column(1).take(pa.array(at, pa.int64()))],
                    names=["block", "shard", "leaves", "id", "v"])

        asked = queries.select("id", "v").mapInArrow(
            route, "block long, shard long, leaves array<long>, id long, v array<double>")
        many = {b: n for b, n in self.shards.items() if n > 1}
        block = F.floor(F.col("leaf") / BLOCK_LEAVES).cast("long")
        count = F.lit(1) if not many else F.coalesce(F.try_element_at(
            F.create_map(*[F.lit(x) for pair in many.items() for x in pair]), block), F.lit(1))
        held = self.filed.withColumn("block", block) \
            .withColumn("shard", F.pmod(F.xxhash64("id"), count).cast("long"))

        def look(parts):
            # Sorted by group, rows before queries: the rows of a group are held
            # (a bounded shard), its queries are streamed past them.
            key, rows, shard = None, [], None
            for part in parts:
                group = np.stack([part.column(k).to_numpy() for k in range(3)], axis=1)
                cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(group)], strict=True):
                    if lo == hi:
                        continue
                    some, now = part.slice(lo, hi - lo), tuple(group[lo, :2])
                    if now != key:
                        key, rows, shard = now, [], None
                    if not group[lo, 2]:
                        rows.append(some)
                    elif rows:
                        shard = shard or Shard(pa.Table.from_batches(rows), large)
                        yield _pairs(list(shard.search(some, k, visits)))

        both = held.select("block", "shard", F.lit(0).alias("asks"), "leaf",
                           F.lit(None).cast("array<long>").alias("leaves"), "id", "v").union(
            asked.select("block", "shard", F.lit(1), F.lit(None).cast("long"), "leaves", "id", "v"))
        pairs = both.repartition("block", "shard") \
            .sortWithinPartitions("block", "shard", "asks", "id") \
            .mapInArrow(look, "query_id long, vec_id long, score double")
        return _best(pairs, k)

    def calibrate(self, queries: DataFrame, k: int, recall: float = RECALL,
                  test_queries: int = TEST_QUERIES, visits: int = 4) -> tuple[int, float]:
        """Leaf visits at which the sampled queries reach ``recall`` of their
        exact neighbours (rows as near as the k-th count), and that recall."""
        n = queries.count()
        spot = F.pmod(F.xxhash64("id", F.lit("test")), F.lit(1_000_000)) / 1_000_000
        some = queries.where(spot < 1.5 * test_queries / max(n, 1)).limit(test_queries) \
            .select("id", "v").collect()
        if not some:
            return visits, 1.0
        some = [(r["id"], list(r["v"])) for r in some]
        asked = self.spark.createDataFrame(some, "id long, v array<double>")
        exact = _best(brute_force(self.spark, self.rows, some, k), k).collect()
        if not exact:  # no other row to find
            return visits, 1.0
        reached = self._ranks(some, exact)
        worst: dict = {}
        for r in exact:
            worst[r["query_id"]] = min(r["score"], worst.get(r["query_id"], 2.0))
        while True:
            # Widen until the leaves of enough exact neighbours are visited,
            # then measure the search itself.
            while (reached < visits).mean() < recall and visits < self.n_leaves:
                visits += (visits + 1) // 2
            got = self.search(asked, k, visits).collect()
            share = sum(r["score"] >= worst[r["query_id"]] - 1e-12 for r in got) / len(exact)
            if share >= recall or visits >= self.widest:
                return visits, share
            visits += (visits + 1) // 2

    def _ranks(self, queries: list, exact: list) -> np.ndarray:
        """For each exact neighbour, how many leaves its query visits before
        the neighbour's own (a bounded set of queries and neighbours)."""
        ids = self.spark.createDataFrame([(r["vec_id"],) for r in exact], "id long").distinct()
        leaf = {r["id"]: r["leaf"] for r in self.filed.join(F.broadcast(ids), "id")
                .groupBy("id").agg(F.min("leaf").alias("leaf")).collect()}
        tree = self.tree.value
        order = {i: {b: k for k, b in enumerate(tree.best_bins(v, self.n_leaves))}
                 for i, v in zip([q[0] for q in queries], unit(np.array([q[1] for q in queries])),
                                 strict=True)}
        return np.array([order[r["query_id"]][leaf[r["vec_id"]]] for r in exact])


class Shard:
    """Rows of a block, labelled by leaf; a crowded leaf gets a tree of its own."""

    def __init__(self, rows: pa.Table, large: int):
        self.ids, self.x = rows["id"].to_numpy(), matrix(rows["v"].combine_chunks())
        leaf = rows["leaf"].to_numpy()
        self.label = np.zeros(len(leaf), dtype=np.int64)
        self.leaves: list[tuple[int, int, KMeansTree | None]] = []  # leaf, first label, its tree
        self.n = 0
        for b in np.unique(leaf).tolist():
            at = np.flatnonzero(leaf == b)
            tree = KMeansTree(self.x[at], large // 4) if len(at) > large else None
            self.label[at] = self.n + (tree.file(self.x[at]) if tree else 0)
            self.leaves.append((b, self.n, tree))
            self.n += tree.n_leaves if tree else 1

    def search(self, queries: pa.RecordBatch, k: int, visits: int):
        """(query id, row id, cosine) of the rows found for a batch of queries."""
        vectors = matrix(queries.column("v"))
        wanted = [set(x) for x in queries.column("leaves").to_pylist()]
        table = np.zeros((len(wanted), self.n), dtype=bool)
        for b, first, tree in self.leaves:
            for i in [i for i, found in enumerate(wanted) if b in found]:
                # The own tree of a crowded leaf is walked in the same way.
                opens = tree.best_bins(vectors[i], visits) if tree else [0]
                table[i, [first + c for c in opens]] = True
        return top(queries.column("id").to_numpy(), vectors, self.ids, self.x, k, self.label, table)


def nearest_neighbours(spark: SparkSession, rows: DataFrame, query_mod: int = 50, k: int = 5,
                       id_col: str = "vec_id", vec_col: str = "embedding",
                       recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest rows
    found of every row whose id is divisible by ``query_mod``.

    Null ids and vectors that are null, zero or hold null or non-finite
    components take no part, nor do vectors of another length than the most
    frequent one. Ids stand for all their rows: of a query id or a candidate id
    with several vectors (or copies of one) the nearest pair counts, so each
    candidate id is there once, and never for its own id. Ties go to smaller
    ids; an empty table gives an empty result; other columns are ignored.
    """
    index = Index(spark, rows, id_col, vec_col)
    if not index.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.rows.where(F.col("id") % query_mod == 0)
    visits, reached = index.calibrate(queries, k, recall)
    if reached < recall:
        _LOG.warning("recall %.3f of %d leaf visits is below the %.3f asked for",
                     reached, visits, recall)
    return index.search(queries, k, visits) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
