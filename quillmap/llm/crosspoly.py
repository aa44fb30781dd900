"""Embedding near-dedup by cross-polytope hashing.

A hash turns the unit vector by three rounds of random signs and a fast Hadamard transform and names the coordinate of
largest magnitude with its sign. HASHES of them make a bucket; each of TABLES tables keeps a vector in its own bucket and
in the next likely ones (multiprobe: the runner-up coordinates that lost by least). Vectors meet in any common bucket;
cosines are verified in double precision. A pair is counted in one bucket it has in common, that of least key, so nothing
is counted twice and no list of pairs is ever built. Equal vectors are collapsed first. Buckets are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, components, drop_written, mix64, read_table, written
from .nearset import _grouped
from .vectors import matrix, usable

TABLES, HASHES, PROBES = 10, 2, 3
#: Vectors of a bucket that one task compares with as many.
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, orthonormal; rows of 2^k."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def signs(dim: int, seed: int) -> np.ndarray:
    """(3, dim) of +1 and -1."""
    return np.where(mix64(np.arange(3 * dim, dtype=np.uint64) + np.uint64(seed << 32)) >> np.uint64(63), 1.0, -1.0).reshape(3, dim)


def codes(unit: np.ndarray) -> np.ndarray:
    """(n, TABLES, PROBES) bucket numbers of unit vectors, below 2^31, likeliest first."""
    n, d = unit.shape
    size = 1 << max(1, (d - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :d] = unit
    out = np.empty((n, TABLES, PROBES), np.int64)
    rows = np.arange(n)
    for t in range(TABLES):
        first, second, gap = [], [], []
        for j in range(HASHES):
            y = x
            for s in signs(size, t * HASHES + j + 1):
                y = hadamard(y * s)
            mag = np.abs(y)
            a = mag.argmax(1)
            top = mag[rows, a].copy()
            mag[rows, a] = -1
            b = mag.argmax(1)
            first.append(2 * a + (y[rows, a] < 0))
            second.append(2 * b + (y[rows, b] < 0))
            gap.append(top - mag[rows, b])
        # Probes: none, or one, or both hashes take their runner-up, by the sum of what they lost.
        options = np.array([[(p >> j) & 1 for j in range(HASHES)] for p in range(1 << HASHES)])
        cost = options @ np.array(gap)
        order = np.argsort(cost, axis=0, kind="stable")[:PROBES]
        for p in range(PROBES):
            pick = options[order[p]]
            code = np.zeros(n, np.int64)
            for j in range(HASHES):
                code = code * (2 * size) + np.where(pick[:, j] == 1, second[j], first[j])
            out[:, t, p] = code
    if size > 1 << 14:  # codes of more than 31 bits: two that share what is kept share a bucket, and are verified as all are
        out = (mix64(out) >> np.uint64(33)).astype(np.int64)
    return out


def _units(m: np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision."""
    m = m.astype(np.float64)
    m /= np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1))[:, None]


def _hashed(classes: DataFrame, kind: str) -> DataFrame:
    """(cid, lab, mult, vec, codes): vec as it is, in bytes of kind (`<f4` or `<f8`), codes as int32 bytes, for classes of one length a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = np.array(b.column(3).value_lengths().to_pylist(), np.int64)
            for d in np.unique(lengths):
                part = b.filter(pa.array(lengths == d))
                m = matrix(part.column(3))
                c = codes(_units(m)).astype(np.int32)
                lab = mix64(part.column(1).to_numpy().view(np.uint64) + np.uint64(d)).view(np.int64)
                yield pa.record_batch([part.column(0), pa.array(lab), part.column(2), pa.array([x.tobytes() for x in m.astype(kind)], pa.binary()), pa.array([x.tobytes() for x in c], pa.binary())], ["cid", "lab", "mult", "vec", "codes"])

    return classes.mapInArrow(run, "cid binary, lab long, mult long, vec binary, codes binary")


def _keys(hashed: DataFrame) -> DataFrame:
    """(key, cid): every bucket of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                key = _bucket_keys(b.column(1).to_numpy(), np.frombuffer(b"".join(b.column(2).to_pylist()), np.int32).astype(np.int64).reshape(b.num_rows, TABLES, PROBES))
                yield pa.record_batch([pa.array(key.reshape(-1)), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), TABLES * PROBES)))], ["key", "cid"])

    return hashed.select("cid", "lab", "codes").mapInArrow(run, "key long, cid binary")


def _bucket_keys(lab: np.ndarray, code: np.ndarray) -> np.ndarray:
    table = (np.arange(1, TABLES + 1, dtype=np.uint64) << np.uint64(48))[None, :, None]
    return mix64(mix64(lab.view(np.uint64))[:, None, None] ^ (code.view(np.uint64) + table)).view(np.int64)


def linked(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id, kept: one row per vector.

    Links: equal labels, not null, and a cosine of at least `least` in double precision. n_links counts other rows;
    component_id is the smallest id reachable, itself included; kept: it is its own. Vectors that are null, zero or
    hold null or non-finite parts, those without a label, and those of different lengths link with nothing. Equal rows
    are linked vectors of their own. A null id counts as a link and names no component unless all are null; it is never
    kept. Other columns are left out.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    named = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vec_col).alias("_vec"))
    rows = _with_class(named).where("cid is not null")
    classes = rows.groupBy("cid", "_label").agg(F.min("_id").alias("low"), F.count("*").alias("mult"), F.any_value("vec").alias("vec"))
    classes = written(classes.select("cid", F.xxhash64("_label").alias("lab"), "mult", "vec", "low"), "vec-classes")
    # What every bucket gets of a vector: in single precision where the table has no more, so that nothing is lost.
    kind = "<f4" if dict(vectors.dtypes)[vec_col] == "array<float>" else "<f8"
    hashed = written(_hashed(classes.select("cid", "lab", "mult", "vec"), kind), "vec-codes")
    keys = _keys(hashed)
    met = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows_ = keys.join(met, "key").withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows_ = rows_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows_ = rows_.select("key", "cid", "blk", (F.col("blk") == F.col("other")).alias("alone"), F.xxhash64("key", F.least("blk", "other"), F.greatest("blk", "other")).alias("grp"))
    full = rows_.join(hashed, "cid").select("grp", "key", "blk", "cid", "lab", "mult", "vec", "codes", "alone")

    def compare(_: int, cols: list[list]) -> list[tuple[bytes, bytes, int]]:
        blk, lab, mult = (np.array(cols[i]) for i in (2, 4, 5))
        here = cols[1][0]
        cid, vec = cols[3], _units(np.frombuffer(b"".join(cols[6]), kind).reshape(len(cols[6]), -1))
        code = np.frombuffer(b"".join(cols[7]), np.int32).astype(np.int64).reshape(len(cid), TABLES, PROBES)
        n = len(cid)
        links, root = np.zeros(n, np.int64), np.arange(n)
        two = not cols[8][0]
        if two and blk.min() == blk.max():
            return []  # the other block is empty
        left = np.flatnonzero(blk == blk.min())
        right = np.flatnonzero(blk == blk.max())
        for lo in range(0, len(left), 256):
            a = left[lo : lo + 256]
            cos = vec[a] @ vec[right].T
            i, j = np.nonzero((cos >= least) & (lab[a][:, None] == lab[right][None, :]))
            i, j = a[i], right[j]
            if not two:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            for s in range(0, len(i), 1 << 16):  # the common bucket of least key is the one that counts
                p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                same = code[p][:, :, :, None] == code[q][:, :, None, :]
                flat = same.any(3).reshape(len(p), -1)
                first = np.where(flat, _bucket_keys(lab[p], code[p]).reshape(len(p), -1), np.iinfo(np.int64).max).min(1)
                count = flat.any(1) & (first == here)
                np.add.at(links, p[count], mult[q[count]])
                np.add.at(links, q[count], mult[p[count]])
            for x in np.unique(i).tolist():
                merged = np.unique(root[np.append(j[i == x], x)])
                if len(merged) > 1:
                    root[np.isin(root, merged)] = merged[0]
        return [(cid[x], cid[r], m) for x, (r, m) in enumerate(zip(root.tolist(), links.tolist(), strict=True)) if m or r != x]

    found = written(_grouped(full, "grp", "a binary, b binary, m long", compare), "vec-links")
    total = found.groupBy(F.col("a").alias("cid")).agg(F.sum("m").alias("m"))
    settled = components(found.select("a", "b"))
    comp = settled.union(settled.select(F.col("component").alias("node"), "component").distinct())
    low = comp.join(classes.select(F.col("cid").alias("node"), "low"), "node").withColumnRenamed("node", "cid")
    least_of = low.groupBy("component").agg(F.min("low").alias("best"))
    heads = low.join(least_of, "component").select("cid", "best")
    per = classes.select("cid", "mult", "low").join(total, "cid", "left").join(heads, "cid", "left")
    per = written(per.select(F.col("cid").alias("_c"), (F.coalesce("m", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("best", "low").alias("component_id")), "vec-heads")
    drop_written(spark, classes, hashed, found, settled)
    # Unusable vectors stand beside: they have no class.
    out = _with_class(named).join(per, F.col("cid") == F.col("_c"), "left")
    return out.select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("_c").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn("kept", F.coalesce(F.expr(f"`{id_col}` = component_id"), F.lit(False)))


def _with_class(named: DataFrame) -> DataFrame:
    """(_id, _label, vec, cid): cid names the label and vector by 128 bits, null for those that take no part.

    The hash folds its arguments from left to right, so the seeds come first: two states that run over all of the vector.
    """
    rows = named.select("_id", F.col("_label").cast("string").alias("_label"), F.col("_vec").cast("array<double>").alias("vec"))
    hexed = [F.lpad(F.hex(F.xxhash64(F.lit(seed), "_label", "vec")), 16, "0") for seed in (1, 2)]
    return rows.withColumn("cid", F.when(F.col("_label").isNotNull() & usable("vec"), F.unhex(F.concat(*hexed))))


def op7_crosspoly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.98),
c as (select vec_id as s, vec_id as t from embeddings union select c.s, l.b from c join l on l.a = c.t),
m as (select s, min(t) as t from c group by s),
n as (select a, count(*) as n from l group by a)
select e.vec_id, coalesce(n, 0) as n_links, t as component_id, e.vec_id = t as kept
from embeddings e join m on m.s = e.vec_id left join n on n.a = e.vec_id
"""
