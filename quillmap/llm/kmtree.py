"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; every row is indexed in the leaf it descends to. A query opens nodes from a
priority queue, nearest centre first, and visits leaves in the order it meets them. How many it visits is widened until
the recall reaches the target on sample queries whose true neighbours are found by brute force. Distances to what the
leaves hold are exact, on the original vectors, in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import bounded_batches, read_table, written
from .nearset import _grouped
from .vectors import matrix, unpack, usable

#: Bounds of the sample the tree is fitted on (rows, and numbers in them) and of the queries it is calibrated on.
SAMPLE_ROWS, SAMPLE_NUMBERS, SAMPLE_QUERIES = 20_000, 4_000_000, 100
BRANCH, LEAF_ROWS, MOST_LEAVES = 8, 400, 2_000
RECALL = 0.97
#: Rows, and queries, of a leaf that one task compares.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 512


class Tree:
    """Nodes by number: centres, children (none for leaves) and leaf numbers."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 10):
        self.centres: list[np.ndarray] = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1])]
        self.children: list[list[int]] = [[]]
        rng = np.random.default_rng(seed)
        heap = [(-len(sample), 0, np.arange(len(sample)))]
        n_leaves = 1
        while heap and n_leaves < leaves:
            _, node, at = heapq.heappop(heap)
            groups = self._kmeans(sample[at], rng) if len(at) > BRANCH else []
            if len(groups) < 2:
                continue
            for centre, inner in groups:
                self.centres.append(centre)
                self.children.append([])
                self.children[node].append(len(self.centres) - 1)
                heapq.heappush(heap, (-len(inner), len(self.centres) - 1, at[inner]))
            n_leaves += len(groups) - 1
        self.leaf = np.full(len(self.centres), -1, np.int64)
        ends = [i for i, c in enumerate(self.children) if not c]
        self.leaf[ends] = np.arange(len(ends))
        self.n_leaves = len(ends)
        self.matrix = np.array(self.centres)

    @staticmethod
    def _kmeans(x: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        c = x[rng.choice(len(x), min(BRANCH, len(x)), replace=False)].copy()
        for _ in range(12):
            near = _square(x, c).argmin(1)
            for k in range(len(c)):
                if (near == k).any():
                    c[k] = x[near == k].mean(0)
        near = _square(x, c).argmin(1)
        return [(c[k], np.flatnonzero(near == k)) for k in range(len(c)) if (near == k).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf each row descends to."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            kids = self.children[node]
            if not kids:
                out[at] = self.leaf[node]
                continue
            near = _square(x[at], self.matrix[kids]).argmin(1)
            todo += [(kid, at[near == k]) for k, kid in enumerate(kids) if (near == k).any()]
        return out

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        far = _square(q[None, :], self.matrix)[0].tolist()
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if not self.children[node]:
                yield int(self.leaf[node])
            for kid in self.children[node]:
                heapq.heappush(heap, (far[kid], kid))


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :], 0)


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d = x - q
    return np.sqrt((d * d).sum(1))


def _nearest(q: np.ndarray, q_id: int, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, float]]:
    """(place in ids, distance): nearest first, ties to the smaller id, rows with the query's id left out."""
    d = _distances(q, x)
    d[ids == q_id] = np.inf
    near = np.argpartition(d, k - 1)[:k] if len(d) > k else np.arange(len(d))
    near = np.flatnonzero(d <= d[near].max()) if len(near) else near
    near = near[np.lexsort((ids[near], d[near]))][:k]
    return [(int(i), float(d[i])) for i in near if np.isfinite(d[i])]


def search(vectors: DataFrame, k: int = 10, every: int = 100, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id, score: the k nearest found of each row whose id is divisible by `every`.

    Candidates are all rows but those with the query's id; fewer than k are all returned. Ties go to the smaller id.
    Vectors null, zero or holding null or non-finite parts take no part, nor do rows without an id or of another length
    than most (of equally common lengths the smaller). Of rows that share a query's id the smallest vector asks.
    The sample queries' recall is at least `recall` or all leaves are visited. Other columns are left out.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(F.col("id").isNotNull() & usable("vec"))
    result = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], result)
    dim, total = lengths[0]["d"], lengths[0]["n"]
    rows = rows.where(F.size("vec") == dim)
    bound = max(BRANCH, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dim))
    share = min(1.0, 0.95 * bound / total)
    sample = rows.where(F.pmod(F.xxhash64("id", "vec"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(bound).select("vec").collect()
    x = np.array([r["vec"] for r in sample], np.float64).reshape(-1, dim)
    x = x[np.lexsort(x.T)]
    tree = Tree(x, min(MOST_LEAVES, max(1, total // LEAF_ROWS)))
    shared = spark.sparkContext.broadcast(tree)  # at most MOST_LEAVES leaves

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = matrix(b.column(1))
                yield pa.record_batch([pa.array(shared.value.assign(m)), b.column(0), pa.array([v.tobytes() for v in m], pa.binary())], ["leaf", "id", "vec"])

    indexed = written(rows.mapInArrow(index, "leaf long, id long, vec binary"), "ann-index")
    counts = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row for each leaf
    asked = indexed.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"))
    widest = _calibrate(indexed, asked, tree, counts, k, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q_id, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                leaves, held = [], 0
                for leaf in shared.value.visits(np.frombuffer(vec)):
                    if len(leaves) >= widest and held > k:
                        break
                    leaves.append(leaf)
                    held += counts.get(leaf, 0)
                yield pa.record_batch([pa.array(leaves, pa.int64()), pa.array([q_id] * len(leaves), pa.int64()), pa.array([vec] * len(leaves), pa.binary())], ["leaf", "id", "vec"])

    asks = asked.mapInArrow(visit, "leaf long, id long, vec binary")
    per = asks.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("pieces"))
    size = spark.createDataFrame([(a, -(-n // BLOCK_ROWS)) for a, n in counts.items()], "leaf long, blocks int")
    plan = F.broadcast(per.join(F.broadcast(size), "leaf"))  # a row for each leaf
    held = indexed.join(plan, "leaf").withColumn("blk", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    asks = asks.join(plan, "leaf").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")).withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("leaf", "blk", "piece").alias("grp")
    both = held.select(key, F.lit(False).alias("asks"), "id", "vec").union(asks.select(key, F.lit(True).alias("asks"), "id", "vec"))

    def compare(_: int, cols: list[list]) -> list[tuple[int, int, float]]:
        asks, ids, vec = np.array(cols[1], bool), np.array(cols[2], np.int64), unpack(cols[3])
        x, at = vec[~asks], ids[~asks]
        return [(int(q), int(at[i]), s) for q, v in zip(ids[asks], vec[asks], strict=True) for i, s in _nearest(v, q, x, at, k)] if len(x) else []

    found = _grouped(both, "grp", "query_id long, vec_id long, score double", compare)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrate(indexed: DataFrame, asked: DataFrame, tree: Tree, counts: dict[int, int], k: int, recall: float) -> int:
    """The fewest leaves to visit that find the share `recall` of the sample queries' true neighbours."""
    picked = asked.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_QUERIES).collect()
    if not picked:
        return tree.n_leaves
    queries = [(r["id"], bytes(r["vec"])) for r in picked]

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int, int]]] = {q: [] for q, _ in queries}
        for b in batches:
            if not b.num_rows:
                continue
            leaf, ids, x = b.column(0).to_numpy(), b.column(1).to_numpy(), unpack(b.column(2).to_pylist())
            for q, v in queries:
                new = [(s, int(ids[i]), int(leaf[i])) for i, s in _nearest(np.frombuffer(v), q, x, ids, k)]
                best[q] = sorted(best[q] + new)[:k]
        out = [(q, i, a, s) for q, found in best.items() for s, i, a in found]
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], ["q", "id", "leaf", "score"])

    near = indexed.mapInArrow(brute, "q long, id long, leaf long, score double")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("score", "id"))).where(F.col("rank") <= k)
    place = {q: {leaf: i for i, leaf in enumerate(tree.visits(np.frombuffer(v)))} for q, v in queries}
    at = np.sort([place[r["q"]][r["leaf"]] for r in near.collect()])  # k for each sample query
    return int(at[min(len(at) - 1, int(np.ceil(recall * len(at))) - 1)]) + 1 if len(at) else tree.n_leaves


def op10_kmtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))
