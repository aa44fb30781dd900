"""Reports as small frames; show() prints one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import METHODS, PRECISION
from ..functions import text as T

# Score bands and the grid of minimum score and margin.
BANDS = (0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80)
GRID = ((0.60, 0.10), (0.65, 0.10), (0.70, 0.15), (0.70, 0.20))


def percent(part: Column, whole: Column) -> Column:
    """Null where there is nothing to divide by."""
    return F.try_divide(F.lit(100.0) * part, whole)


def run_summary(corpus: DataFrame) -> DataFrame:
    """rows, with_occupation, pct: of a finished corpus."""
    return corpus.agg(F.count("*").alias("rows"), F.count("occupation").alias("with_occupation")).withColumn("pct", percent(F.col("with_occupation"), F.col("rows")))


def pipeline_summary(corpus: DataFrame, titles: DataFrame | None = None, skills: DataFrame | None = None) -> DataFrame:
    """One row: rows, with_occupation, pct; of the title stage rows, matched and exact ones; of the skill stage the mentions
    kept, in all and by each rung. Columns of a stage that did not run are null."""
    out = run_summary(corpus)
    title = ["title_rows", "titles_matched", "titles_exact"]
    if titles is not None:
        of = titles.agg(F.count("*").alias(title[0]), F.count("esco_occupation").alias(title[1]), F.count_if(F.col("match_method") == "exact").alias(title[2]))
        out = out.crossJoin(of)  # one row by one row
    else:
        out = out.withColumns({c: F.lit(None).cast("long") for c in title})
    kept = [f"mentions_{m}" for m in METHODS]
    if skills is not None:
        out = out.crossJoin(skills.agg(*(F.coalesce(F.sum(f"n_skills_{m}"), F.lit(0)).alias(f"mentions_{m}") for m in METHODS)))
    else:
        out = out.withColumns({c: F.lit(None).cast("long") for c in kept})
    return out.withColumn("mentions_kept", sum((F.col(c) for c in kept[1:]), F.col(kept[0])))


def title_summary(titles: DataFrame) -> DataFrame:
    """One row: rows, matched, pct, exact_pct (what exact matching alone gives), distinct occupations."""
    hit = F.count("match_method")
    return titles.agg(F.count("*").alias("rows"), hit.alias("matched"), F.count_if(F.col("match_method") == "exact").alias("_e"), F.countDistinct("esco_occupation").alias("occupations")).select(
        "rows", "matched", percent(F.col("matched"), F.col("rows")).alias("pct"), percent(F.col("_e"), F.col("rows")).alias("exact_pct"), "occupations"
    )


def skill_summary(skills: DataFrame) -> DataFrame:
    """One row: kept mentions, exact ones among them, distinct skills kept. A skill named twice counts twice as mentions."""
    rows = skill_mentions(skills)
    return rows.agg(F.count("method").alias("kept"), F.count_if(F.col("method") == "exact").alias("exact"), F.countDistinct("skill").alias("skills"))


def method_counts(rows: DataFrame, method: str = "match_method") -> DataFrame:
    """method, n, pct for each rung and `unmatched`, also where a rung took nothing."""
    spark = rows.sparkSession
    found = rows.groupBy(F.coalesce(method, F.lit("unmatched")).alias("method")).agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(m,) for m in (*METHODS, "unmatched")], "method string").join(found, "method", "left")
    every = every.withColumn("n", F.coalesce("n", F.lit(0)))
    return every.crossJoin(every.agg(F.sum("n").alias("_all"))).select("method", "n", percent(F.col("n"), F.col("_all")).alias("pct"))


def skill_mentions(corpus: DataFrame) -> DataFrame:
    """skill, method of every slot of every posting."""
    return corpus.select(F.explode(F.arrays_zip("skills", "skill_match_methods")).alias("s")).select(F.col("s.skills").alias("skill"), F.col("s.skill_match_methods").alias("method"))


def precision_estimate(counts: DataFrame) -> DataFrame:
    """precision: the rungs' hand-judged precision, weighted by how often each matched; null if nothing did."""
    known = counts.sparkSession.createDataFrame(list(PRECISION.items()), "method string, p double")
    rows = counts.join(known, "method")
    return rows.agg(F.try_divide(F.sum(F.col("n") * F.col("p")), F.sum("n")).alias("precision"))


def top_by_method(rows: DataFrame, label: str, method: str, n: int = 20) -> DataFrame:
    """method, label, n, rank: each rung's most frequent labels, ties by label. Counted before they are ranked."""
    counts = rows.where(F.col(method).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(method).alias("method"), F.col(label).alias("label")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("method").orderBy(F.desc("n"), "label"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def shuffled(by: str, seed: int) -> Column:
    """A hash of a column and the seed, by which samples are drawn: the same ones each time, on any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(by)))


def sample(rows: DataFrame, by: str, n: int = 30, seed: int = 42) -> DataFrame:
    """n rows by a hash of a column and the seed. A report, so it is limited."""
    return rows.orderBy(shuffled(by, seed), by).limit(n)


def via(canonical: str, label: str) -> Column:
    """The label a match went through, where it isn't the canonical one."""
    return F.when(~T.same_label(F.col(canonical), F.col(label)), F.col(label))


def pair_sample(titles: DataFrame, n: int = 30, seed: int = 42) -> DataFrame:
    rows = titles.where("match_method = 'embedding_ce'").select("title", "esco_score", "esco_occupation", via("esco_occupation", "esco_matched_label").alias("via"))
    return sample(rows, "title", n, seed)


def skill_pair_sample(scores: DataFrame, n: int = 30, seed: int = 42) -> DataFrame:
    rows = scores.where("method = 'embedding_ce'").select("text", "match_score", "canonical", via("canonical", "label").alias("via"))
    return sample(rows, "text", n, seed)


def unmatched_closest(titles: DataFrame, n: int = 40) -> DataFrame:
    """Scored but not accepted, closest first."""
    rows = titles.where("match_method is null and esco_best_guess is not null")
    return rows.orderBy(F.desc("esco_best_score"), "title", "job_id").limit(n).select("job_id", F.substring("title", 1, 44).alias("title"), "esco_best_guess", "esco_best_score")


def unmatched_unscored(titles: DataFrame, n: int = 40) -> DataFrame:
    return titles.where("match_method is null and esco_best_guess is null").orderBy("title", "job_id").limit(n).select("job_id", F.substring("title", 1, 70).alias("title"))


def unmatched_terms(scores: DataFrame, n: int = 40) -> DataFrame:
    return scores.where("method is null").orderBy(F.desc("score"), "text").limit(n).select("text", "guess", "score")


def deciles(scores: DataFrame, col: str = "score") -> DataFrame:
    """q (0 to 100 by 10), value: exact, interpolated."""
    steps = [i / 10 for i in range(11)]
    row = scores.agg(F.percentile(col, F.array(*map(F.lit, steps))).alias("v"))
    return row.select(F.posexplode("v").alias("i", "value")).select((F.col("i") * 10).cast("long").alias("q"), "value")


def threshold_counts(scores: DataFrame, thresholds: Sequence[float] = BANDS) -> DataFrame:
    """threshold, n at or above it: one pass over the scores."""
    row = scores.agg(F.array(*(F.struct(F.lit(t).alias("threshold"), F.count_if(F.col("score") >= t).alias("n")) for t in thresholds)).alias("a"))
    return row.select(F.inline("a"))


def band_counts(scores: DataFrame, bands: Sequence[float] = BANDS) -> DataFrame:
    """lo, hi, n of the half-open bands; the last ends at 1.01."""
    edges = [*bands, 1.01]
    row = scores.agg(F.array(*(F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi"), F.count_if((F.col("score") >= a) & (F.col("score") < b)).alias("n")) for a, b in zip(edges, edges[1:], strict=False))).alias("a"))
    return row.select(F.inline("a"))


def band_samples(scores: DataFrame, bands: Sequence[float] = BANDS, per_band: int = 8, seed: int = 0) -> DataFrame:
    """lo, text and the rest of the row: some of each band, by hash."""
    edges = [*bands, 1.01]
    band = F.lit(None).cast("double")
    for a, b in zip(edges, edges[1:], strict=False):
        band = F.when((F.col("score") >= a) & (F.col("score") < b), F.lit(a)).otherwise(band)
    rank = F.row_number().over(Window.partitionBy("lo").orderBy(shuffled("text", seed), "text"))
    return scores.withColumn("lo", band).where("lo is not null").withColumn("_r", rank).where(F.col("_r") <= per_band).drop("_r")


def margin_grid(scores: DataFrame, below: float, grid: Sequence[tuple[float, float]] = GRID) -> DataFrame:
    """min_score, min_margin, n: texts under the threshold that each pair of bounds would take."""
    cells = (F.struct(F.lit(s).alias("min_score"), F.lit(m).alias("min_margin"), F.count_if((F.col("score") < below) & (F.col("score") >= s) & (F.col("margin") >= m)).alias("n")) for s, m in grid)
    return scores.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def margin_deciles(scores: DataFrame, below: float) -> DataFrame:
    """Deciles of the margin of texts under the threshold; no rows if there are none."""
    return deciles(scores.where(F.col("score") < below), "margin").where("value is not null")


def margin_grid_samples(scores: DataFrame, below: float, grid: Sequence[tuple[float, float]] = GRID, per_cell: int = 8, seed: int = 0) -> DataFrame:
    """min_score, min_margin and the row: for each pair of bounds some of the texts under the threshold that it would take."""
    cells = F.array(*(F.struct(F.lit(s).alias("min_score"), F.lit(m).alias("min_margin")) for s, m in grid))
    rows = scores.where(F.col("score") < below).select("*", F.inline(cells)).where("score >= min_score and margin >= min_margin")
    rank = F.row_number().over(Window.partitionBy("min_score", "min_margin").orderBy(shuffled("text", seed), "text"))
    return rows.withColumn("_r", rank).where(F.col("_r") <= per_cell).drop("_r")


def show(title: str, df: DataFrame, n: int = 100) -> None:
    print("\n" + "=" * 60 + f"\n{title}\n" + "=" * 60)
    df.show(n, truncate=70)
