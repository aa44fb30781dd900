"""Near-duplicate documents by a chosen-path similarity join over sets of word shingles.

1. Each document becomes its set of shingles, known by a 128-bit hash of the set; equal sets are one class.
2. Trees: in each of a number of independent trees a class goes down the branch named by its minwise token. Nodes with one class
   are done; those of up to NODE classes are compared exhaustively on sketches; larger ones branch again, up to DEPTH
   tokens deep. A pair of similarity s stays together at d tokens with probability s^d in each tree, so all trees miss it
   with probability (1 - s^d)^trees. trees_for() takes as many that at DEPTH tokens, where nodes stay crowded, this is
   MISS at most for a pair just at the threshold: 20 for s = 0.85 (7.7e-5 at six tokens; 16 trees: 5e-4), 31 for s = 0.8
   (8.1e-5; 16 trees: 0.8%).
3. What the sketches hold to be similar, with a margin of four standard deviations, and what is still together in a large
   node at the bottom, makes rough clusters.
4. Within each rough cluster links are confirmed on full sets. Only documents outside the cluster's largest component have
   to be compared with all others; so families of thousands of copies take few comparisons, and no pair is skipped that
   could change a component. Clusters too large for a task are first compared with their most central member, in chunks,
   then what that leaves over is compared with every chunk.
5. Components of the confirmed links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import bounded_batches, components, drop_written, mix64, private, read_table, row_key, utf8_buffer, written
from .shingles import shingle_sets

DEPTH, NODE = 6, 48
#: Trees at least, and the chance that all trees miss a pair at the threshold, at most.
TREES, MISS = 16, 1e-4
#: Shingles, and documents, of a cluster (or chunk of one) that one task compares.
TASK_SHINGLES, TASK_DOCS = 1 << 20, 2_000


def trees_for(similarity: float) -> int:
    """So many trees that a pair of this similarity is missed by all, at DEPTH tokens, with probability MISS at most."""
    together = similarity**DEPTH
    return TREES if together >= 1 else max(TREES, math.ceil(math.log(MISS) / math.log1p(-together)))


@lru_cache
def _hashes(width: int) -> tuple[np.ndarray, np.ndarray]:
    a = (mix64(np.arange(1, width + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return a, (mix64(np.arange(5001, 5001 + width, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def minwise(s: np.ndarray, trees: int) -> np.ndarray:
    """The trees * DEPTH minwise values of a set of 64-bit hashes."""
    a, b = _hashes(trees * DEPTH)
    h = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(h), 4096):  # bounds memory for long texts
        part = h[lo : lo + 4096]
        np.minimum(out, (part[None, :] * a[:, None] + b[:, None]).min(1), out=out)
    return out


def sketches(docs: DataFrame, k: int, trees: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, _rk, n, cls, mh): set size, the set's 128-bit hash (null if empty) and its minwise values."""
    rows = docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_rk"), F.col(text_col).alias("_text"))
    kind = dict(rows.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sets = shingle_sets(*utf8_buffer(b.column(2)), k)
                cls = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                mh = [minwise(s, trees).tobytes() if len(s) else None for s in sets]
                yield pa.record_batch([b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()), pa.array(mh, pa.binary())], ["_id", "_rk", "n", "cls", "mh"])

    return rows.mapInArrow(run, f"_id {kind}, _rk long, n long, cls binary, mh binary")


def _branches(classes: DataFrame, trees: int) -> DataFrame:
    """(key, cls, path): a row for each class and tree; key names the node after one token, path has the tokens below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            mh = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(n, trees, DEPTH)
            key = mix64(mh[:, :, 0].astype(np.uint64) + (np.arange(1, trees + 1, dtype=np.uint64) << np.uint64(32))[None, :])
            path = np.ascontiguousarray(mh[:, :, 1:]).reshape(n * trees, -1).tobytes()
            width = 4 * (DEPTH - 1)
            yield pa.record_batch(
                [pa.array(key.reshape(-1).view(np.int64)), b.column(0).take(pa.array(np.repeat(np.arange(n), trees))), pa.Array.from_buffers(pa.binary(width), n * trees, [None, pa.py_buffer(path)]).cast(pa.binary())],
                ["key", "cls", "path"],
            )

    return classes.select("cls", "mh").mapInArrow(run, "key long, cls binary, path binary")


def _grouped(df: DataFrame, key: str, schema: str, f) -> DataFrame:
    """f(key, columns as numpy object arrays) for each run of equal keys; groups are small by construction."""
    names = df.columns
    df = df.repartition(key).sortWithinPartitions(key)
    at = names.index(key)
    fields = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] | None = None

        def emit(cols: list[list]) -> Iterator[pa.RecordBatch]:
            k = cols[at]
            lo, out = 0, []
            for i in range(1, len(k) + 1):
                if i == len(k) or k[i] != k[lo]:
                    out += f(k[lo], [c[lo:i] for c in cols])
                    lo = i
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], fields)

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            if held is not None:
                cols = [h + c for h, c in zip(held, cols, strict=True)]
            last = cols[at][-1] if cols[at] else None
            cut = len(cols[at])
            while cut and cols[at][cut - 1] == last:
                cut -= 1
            if cut:
                yield from emit([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None and held[at]:
            yield from emit(held)

    return df.mapInArrow(run, schema)


def rough_links(classes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links of a forest whose components hold every pair that reaches the similarity, but for what all trees miss."""
    spark = classes.sparkSession
    cur, small, tables = _branches(classes, trees_for(similarity)), [], []
    edges = None
    for depth in range(DEPTH):
        cur = written(cur, "node-rows") if depth == 0 else cur
        met = cur.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        nodes = written(cur.join(met, "key"), "nodes")
        drop_written(spark, cur) if depth == 0 else None
        tables.append(nodes)
        small.append(nodes.where(F.col("n") <= NODE).select("key", "cls"))
        large = nodes.where(F.col("n") > NODE)
        if depth == DEPTH - 1:
            low = large.groupBy("key").agg(F.min("cls").alias("b"))
            edges = large.join(low, "key").where("cls != b").select(F.col("cls").alias("a"), "b").distinct()
        elif large.isEmpty():
            break
        else:
            cur = large.select(F.expr(f"xxhash64(key, substring(path, {4 * depth + 1}, 4))").alias("key"), "cls", "path")
    rows = small[0]
    for s in small[1:]:
        rows = rows.unionByName(s)
    # The same few classes meet in many trees: one node of each membership is enough.
    same = rows.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
    once = same.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    rows = rows.join(once, "key", "left_semi").join(classes.select("cls", "mh"), "cls").select("key", "cls", "mh")
    width = trees_for(similarity) * DEPTH
    least = similarity - 4.2 * (similarity * (1 - similarity) / width) ** 0.5

    def compare(_: int, cols: list[list]) -> list[tuple[bytes, bytes]]:
        cls = cols[1]
        m = np.frombuffer(b"".join(cols[2]), np.uint32).reshape(len(cls), width)
        root = list(range(len(cls)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in range(len(cls) - 1):
            for j in np.flatnonzero((m[i + 1 :] == m[i]).sum(1) >= least * width).tolist():
                a, b = find(i), find(i + 1 + j)
                root[max(a, b)] = min(a, b)
        return [(cls[i], cls[find(i)]) for i in range(len(cls)) if find(i) != i]

    found = _grouped(rows, "key", "a binary, b binary", compare)
    out = written(found if edges is None else found.union(edges), "rough")
    drop_written(spark, *tables)
    return out


class _Sets:
    """The distinct classes of a task, their full sets side by side, and a union-find over them."""

    def __init__(self, cls: list[bytes], texts: pa.Array, k: int):
        self.cls, first = np.unique(np.array(cls, object), return_index=True)
        sets = shingle_sets(*utf8_buffer(texts.take(pa.array(first))), k)
        self.size = np.array([len(s) for s in sets], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        self.values, self.ids = np.unique(flat, return_inverse=True)
        self.comp = np.arange(len(self.cls))

    def links(self, i: int, num: int, den: int) -> np.ndarray:
        """All others that i is linked with: den * intersection >= num * union."""
        mark = np.zeros(len(self.values), np.int64)
        mark[self.ids[self.start[i] : self.start[i] + self.size[i]]] = 1
        both = np.add.reduceat(mark[self.ids], self.start)
        hit = den * both >= num * (self.size[i] + self.size - both)
        hit[i] = False
        return np.flatnonzero(hit)

    def join(self, i: int, others: np.ndarray) -> None:
        merged = np.unique(self.comp[np.append(others, i)])
        self.comp[np.isin(self.comp, merged)] = merged[0]

    def settle(self, num: int, den: int, only: np.ndarray | None = None) -> None:
        """Compare until every document not yet compared with all others is in the largest component (or not in only)."""
        todo = np.ones(len(self.cls), bool) if only is None else only.copy()
        while True:
            main = np.bincount(self.comp).argmax()
            left = np.flatnonzero(todo & (self.comp != main)) if not todo.all() else np.flatnonzero(todo)
            if not len(left):
                return
            todo[left[0]] = False
            self.join(left[0], self.links(left[0], num, den))

    def edges(self) -> list[tuple[bytes, bytes]]:
        return [(self.cls[i], self.cls[c]) for i, c in enumerate(self.comp.tolist()) if i != c]


def _confirm(rows: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """(a, b): spanning links within each group of rows (grp, role, cls, text): all of role 0 and 1 with all of role 1.

    A group with no role 0 is compared with itself. Roles: 1 has to be compared with everything, 0 only with those.
    """

    def run(grp: int, cols: list[list]) -> list[tuple[bytes, bytes]]:
        sets = _Sets(cols[2], pa.array(cols[3], pa.large_string()), k)
        if min(cols[1]) == 1:
            sets.settle(num, den)
            return sets.edges()
        urgent = {c for c, r in zip(cols[2], cols[1], strict=True) if r == 1}
        only = np.array([c in urgent for c in sets.cls], bool)
        for i in np.flatnonzero(only).tolist():
            sets.join(i, sets.links(i, num, den))
        return sets.edges()

    return _grouped(rows.select("grp", "role", "cls", "text"), "grp", "a binary, b binary", run)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _rk, n_shingles, lead): one row per document; lead is a struct (none, _id, _rk) naming its group's first row.

    Links: den * intersection >= num * union of the shingle sets. Words are what stands between ASCII white space, A-Z
    lower-cased; texts of fewer than k words have one shingle; null, empty and blank texts have none and lead themselves.
    The first row of a group has its smallest id (null ids last, then by a hash of id and text). Equal ids with different
    texts are documents of their own. A very long text is hashed in pieces; its set is held at once. Other columns are left
    out, whatever their names. No rows: no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    all_rows = written(sketches(docs, k, trees_for(num / den), id_col, text_col), "sketches")
    lead = F.struct(F.col("_id").isNull().alias("none"), "_id", "_rk")
    classes = written(all_rows.where("cls is not null").groupBy("cls").agg(F.min(lead).alias("first"), F.min("n").alias("n"), F.min("mh").alias("mh")), "classes")
    slim = written(all_rows.select("_id", "_rk", "n", "cls"), "doc-classes")
    drop_written(spark, all_rows)
    rough = rough_links(classes, num / den)
    links = None
    if not rough.isEmpty():
        clusters = components(rough)
        links = _links(docs, classes, clusters, k, num, den, id_col, text_col)
        drop_written(spark, clusters)
    drop_written(spark, rough)
    heads = classes.select("cls", "first")
    if links is not None:
        named = links.join(heads, "cls")
        low = named.groupBy("root").agg(F.min("first").alias("low"))
        heads = heads.join(named.select("cls", "root").join(low, "root").select("cls", "low"), "cls", "left").select("cls", F.coalesce("low", "first").alias("first"))
        heads = written(heads, "heads")
        drop_written(spark, classes, links)
    out = slim.join(heads, "cls", "left")
    return out.select(F.col("_id").alias(id_col), "_rk", F.col("n").alias("n_shingles"), F.coalesce("first", lead).alias("lead"))


def _links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(cls, root): components of confirmed links, for classes that have a link."""
    # components() names the smallest node but leaves that node itself out
    member = clusters.select(F.col("node").alias("cls"), F.col("component").alias("cluster"))
    member = member.union(member.select(F.col("cluster").alias("cls"), "cluster").distinct())
    member = written(member.join(classes, "cls").select("cls", "cluster", "first", "n", "mh"), "members")
    size = member.groupBy("cluster").agg(F.sum("n").alias("s"), F.count("*").alias("c"))
    size = size.select("cluster", F.greatest(F.ceil(F.col("s") / TASK_SHINGLES), F.ceil(F.col("c") / TASK_DOCS)).cast("int").alias("chunks"))
    texts = docs.select(F.col(id_col).alias("_i"), row_key(id_col, text_col).alias("_r"), F.col(text_col).alias("text"))
    placed = member.drop("mh").join(size, "cluster").withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    placed = placed.select("cls", "cluster", "chunks", "chunk", F.col("first._id").alias("_id"), F.col("first._rk").alias("_rk"), "n")
    full = texts.join(placed, F.expr("_i <=> _id and _r = _rk")).select("cls", "cluster", "chunks", "chunk", "text")
    big = size.where("chunks > 1").select("cluster", "chunks")
    spark = docs.sparkSession
    if big.isEmpty():
        edges = written(_confirm(full.select(F.xxhash64("cluster").alias("grp"), F.lit(1).alias("role"), "cls", "text"), num, den, k), "links")
        roots = _rooted(edges)
        drop_written(spark, member, edges)
        return roots
    full = written(full, "members-text")
    inner = _confirm(full.where("chunks = 1").select(F.xxhash64("cluster").alias("grp"), F.lit(1).alias("role"), "cls", "text"), num, den, k)
    # The most central member: its sketch agrees most with the values most common in its cluster.
    width = trees_for(num / den) * DEPTH
    large = member.join(big, "cluster").select("cluster", "cls", F.posexplode(F.expr(f"transform(sequence(0, {width - 1}), i -> substring(mh, 4 * i + 1, 4))")).alias("pos", "v"))
    votes = large.groupBy("cluster", "pos", "v").agg(F.count("*").alias("c"))
    modal = votes.groupBy("cluster", "pos").agg(F.max_by("v", F.struct("c", "v")).alias("v"))
    agree = large.join(modal, ["cluster", "pos", "v"]).groupBy("cluster", "cls").agg(F.count("*").alias("c"))
    centre = agree.groupBy("cluster").agg(F.max_by("cls", F.struct("c", "cls")).alias("cls"))
    hub = full.where("chunks > 1").join(centre, ["cluster", "cls"], "left_semi").select("cluster", "cls", "text", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    part = full.where("chunks > 1")
    keyed = part.select(F.xxhash64("cluster", "chunk").alias("grp"), F.lit(0).alias("role"), "cls", "text").union(hub.select(F.xxhash64("cluster", "chunk").alias("grp"), F.lit(1).alias("role"), "cls", "text"))
    star = written(_confirm(keyed, num, den, k).union(inner), "links")
    # What the centre isn't linked with is compared with everything, chunk by chunk.
    roots = _rooted(star)
    main = roots.join(centre.select("cls"), "cls", "left_semi").select("root")
    linked = roots.join(main, "root", "left_semi").select("cls")
    rest = written(part.join(linked, "cls", "left_anti"), "rest")
    if rest.isEmpty():
        drop_written(spark, member, full, star, rest)
        return roots
    parts = rest.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / TASK_DOCS), F.ceil(F.sum(F.length("text")) / (8 * TASK_SHINGLES))).cast("int").alias("parts"))
    rest = rest.join(parts, "cluster").withColumn("piece", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("parts")).cast("int"))
    every = part.join(parts, "cluster").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    urgent = rest.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    key = F.xxhash64("cluster", "chunk", "piece").alias("grp")
    second = _confirm(every.select(key, F.lit(0).alias("role"), "cls", "text").union(urgent.select(key, F.lit(1).alias("role"), "cls", "text")), num, den, k)
    edges = written(star.union(second), "links")
    drop_written(spark, member, full, star, rest, roots)
    roots = _rooted(edges)
    drop_written(spark, edges)
    return roots


def _rooted(edges: DataFrame) -> DataFrame:
    c = components(edges)
    roots = written(c.select(F.col("node").alias("cls"), F.col("component").alias("root")).union(c.select(F.col("component").alias("cls"), F.col("component").alias("root")).distinct()), "roots")
    drop_written(edges.sparkSession, c)
    return roots


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), k=3, num=85, den=100)
    return found.select("doc_id", "n_shingles", F.col("lead._id").alias("component_id"), F.expr("doc_id <=> lead._id").alias("kept"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8. Of equal rows one stays too.

    Null, empty and blank texts have no copies but rows equal in id and text. Texts of any length are compared whole.
    Columns stay as they are, whatever their names. No rows: no rows.
    """
    found = near_duplicates(docs)
    i, r, key, n = private(docs, "_id", "_rk", "_key", "_n")
    stay = found.where(F.expr("doc_id <=> lead._id and _rk = lead._rk")).select(F.col("doc_id").alias(i), F.col("_rk").alias(r)).distinct()
    rows = docs.withColumn(key, row_key()).join(stay, F.expr(f"doc_id <=> `{i}` and `{key}` = `{r}`")).drop(i, r)
    numbered = rows.withColumn(n, F.row_number().over(Window.partitionBy("doc_id", key).orderBy("doc_id")))
    return numbered.where(F.col(n) == 1).select(*docs.columns)
