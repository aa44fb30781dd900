"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents (by a hash of the document). From the targets follows how often a source
is taken whole and what remains; the remainder is met exactly by whole permuted blocks and one last block that is taken
document by document. The block quotas of all sources are then split among the output shards by a binary tree: a node
halves its shards and draws, without replacement, how many blocks of each source go left. Each shard draws disjoint runs
of every source's permuted blocks, as many as the tree gave it, and shuffles what it got by a hash of its own. What the mix
takes of a document is what the shards drew of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import read_table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: Shards, and blocks of a source, at least and at most; words of a shard, and documents of a block, in between. All sources
#: together have at most as many blocks as the last says, or one each.
SHARDS, SHARDS_MOST, SHARD_WORDS = 16, 65_536, 4_000_000
BLOCKS, BLOCKS_MOST, BLOCK_DOCS, ALL_BLOCKS = 256, 65_536, 2_000, 4_000_000
#: Sources are named in a mixing recipe, one weight each; more than this is not a recipe and raises.
MAX_SOURCES = 100_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Targets that sum to share * sum(sizes), in proportion to the weights but at most `most` times a source's size.

    What a capped source cannot take goes to the others by weight, again until none is above its cap.
    A share above `most` cannot be met: then every source stands at its cap.
    """
    out, left = [0.0] * len(sizes), Fraction(share) * sum(sizes)
    open_ = [i for i in range(len(sizes)) if sizes[i] > 0]
    cap = {i: Fraction(most) * sizes[i] for i in open_}
    w = {i: Fraction(weights[i]) for i in open_}
    while open_:
        total = sum(w[i] for i in open_)
        over = [i for i in open_ if left * w[i] > cap[i] * total]
        if not over:
            for i in open_:
                out[i] = float(left * w[i] / total)
            break
        for i in over:
            out[i] = float(cap[i])
            left -= cap[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shard, source) block counts: columns sum to the quotas, shards are as equal in blocks as can be."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def descend(lo: int, hi: int, counts: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = counts
            return
        mid = (lo + hi) // 2
        total = int(counts.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(counts, take, method="marginals") if total else counts * 0
        descend(lo, mid, left)
        descend(mid, hi, counts - left)

    if len(quotas):
        descend(0, shards, quotas.astype(np.int64))
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, shards: int | None = None, blocks: int | None = None, seed: int = 9, whole: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each document: id, source, size, source_size, target, taken, copies, then the columns in keep.

    taken: words the mix takes, repeats counted. copies: one struct (shard, place, words) for each time the document is
    taken; words are below size only for a source's last document, and never with whole=True. A document that the mix
    doesn't take has taken 0 and no copies; so has a null or blank text, of size 0. A null source is a source, last in
    order. Equal rows are documents of their own. weights repeat over the sources in code point order. Equal inputs give
    equal mixes. A very long text is a document as any other: it can exceed what a source has left, then nothing (whole=True)
    or a part of it is counted. Columns not named here are not looked at; those in keep are prefixed with keep_. No rows: no
    rows. shards, blocks: by default as many as the words and documents call for.
    """
    return _mix(docs, id_col, text_col, source_col, weights, share, most, shards, blocks, seed, whole, keep)[0]


def _mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float], share: float, most: float, shards: int | None, blocks: int | None, seed: int, whole: bool, keep: Sequence[str]) -> tuple[DataFrame, int]:
    """mix() and how many shards there are."""
    spark = docs.sparkSession
    if blocks is None:
        n, sources = docs.agg(F.count("*"), F.count_distinct(F.struct(source_col))).first()
        blocks = max(1, min(max(BLOCKS, min(BLOCKS_MOST, n // BLOCK_DOCS)), ALL_BLOCKS // max(1, sources)))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("_rk"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"), *(F.col(c).alias(f"keep_{c}") for c in keep),
    ).withColumn("_block", F.pmod("_rk", F.lit(blocks)).cast("int"))
    if not keep:
        rows = written(rows, "mix-sizes")
    per_block = written(rows.groupBy("_src", "_block").agg(F.sum("_size").alias("_words")), "mix-words")
    # One row for each source of the recipe: the bound is checked before anything comes to the driver.
    found = per_block.groupBy("_src").agg(F.sum("_words").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = sorted(((r["_src"], r["n"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    targets = water_fill([n for _, n in found], [weights[i % len(weights)] for i in range(len(found))], share, most)
    if shards is None:
        shards = max(SHARDS, min(SHARDS_MOST, int(share * sum(n for _, n in found)) // SHARD_WORDS))
    plan = []
    for (src, n), target in zip(found, targets, strict=True):
        goal = round(target)
        passes = goal // n if n else 0
        plan.append((src, n, target, passes, goal - passes * n))
    recipe = spark.createDataFrame(plan, "_s string, source_size long, target double, _passes int, _rest long")
    # A source has at most `blocks` blocks, so this window is bounded however hot the source is.
    by_source = Window.partitionBy("_src").orderBy(F.xxhash64(F.lit(seed), "_block"), "_block")
    upto = by_source.rowsBetween(Window.unboundedPreceding, 0)
    placed = per_block.join(F.broadcast(recipe), F.expr("_src <=> _s")).drop("_s")
    placed = placed.withColumn("_before", F.sum("_words").over(upto) - F.col("_words"))
    placed = placed.withColumn("_full", F.expr("_before + _words <= _rest and _words > 0")).withColumn("_edge", F.expr("_before < _rest and _before + _words > _rest"))
    placed = placed.withColumn("_times", F.expr("_passes + cast(_full or _edge as int)"))
    placed = written(placed.withColumn("_first", F.sum("_times").over(upto) - F.col("_times")), "mix-blocks")
    # The tree deals out block instances: of a source, instances _first .. _first + _times of its permuted blocks.
    quota = {r["_src"]: r["q"] for r in placed.groupBy("_src").agg(F.sum("_times").alias("q")).collect()}
    dealt = split_tree(np.array([quota.get(s, 0) for s, _ in found], np.int64), shards, seed)
    runs = spark.createDataFrame([(s, np.repeat(np.arange(shards), dealt[:, i]).tolist()) for i, (s, _) in enumerate(found)], "_s string, _drawn array<int>")
    at = placed.join(F.broadcast(runs), F.expr("_src <=> _s")).withColumn("_shards", F.expr("case when _times > 0 then slice(_drawn, cast(_first + 1 as int), cast(_times as int)) end"))
    at = at.select(F.col("_src").alias("_s"), F.col("_block").alias("_b"), "source_size", "target", "_passes", "_rest", "_before", "_full", "_edge", "_shards")
    if len(found) * blocks <= 40_000:  # some 4 MB; beyond, an equi-join
        at = F.broadcast(at)
    joined = rows.join(at, F.expr("_src <=> _s and _block = _b")).drop("_s", "_b")
    # Within the one block at a source's edge documents are taken in hashed order until the remainder is met.
    order = Window.partitionBy("_src", "_block").orderBy(F.xxhash64(F.lit(seed + 1), "_rk"), "_rk", "_id", "_size")
    edge = joined.where("_edge").withColumn("_pre", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    left = "_rest - _before - _pre"
    edge = edge.withColumn("_part", F.expr(f"case when {left} >= _size - ({left}) then _size else 0L end" if whole else f"greatest(0L, least(_size, {left}))")).drop("_pre")
    rest = joined.where("not _edge").withColumn("_part", F.expr("case when _full then _size else 0L end"))
    copies = """filter(transform(sequence(0, _passes), i -> struct(get(_shards, i) as shard, xxhash64(_rk, i) as place,
        case when i < _passes then _size else _part end as words)), t -> t.words > 0)"""
    out = rest.unionByName(edge).withColumn("copies", F.expr(copies))
    out = out.select(
        F.col("_id").alias(id_col), F.col("_src").alias("source"), F.col("_size").alias("size"), "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"), "copies", *(f"keep_{c}" for c in keep),
    )
    return out, shards


def shuffled(mixed: DataFrame, shards: int | None = None) -> DataFrame:
    """The mix as its shards: a row for each copy, partition k holding shard k, shuffled within it by place."""
    if shards is None:
        shards = (mixed.agg(F.max(F.array_max(F.transform("copies", lambda c: c["shard"])))).first()[0] or 0) + 1
    return mixed.select("*", F.inline("copies")).drop("copies").repartitionById(shards, "shard").sortWithinPartitions("place")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.transform("copies", lambda c: c["shard"]).alias("shards"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole ones only, with the columns of documents: a partition for each shard
    that the tree filled, in its shuffled order.

    Null and blank texts have no words and go. Other columns stay, whatever their names. No rows: no rows.
    """
    mixed, shards = _mix(docs, "doc_id", "text", "source", WEIGHTS, 1.5, 2.0, None, None, 9, True, docs.columns)
    rows = shuffled(mixed.select("copies", *(f"keep_{c}" for c in docs.columns)), shards)
    return rows.select(*(F.col(f"keep_{c}").alias(c) for c in docs.columns))
