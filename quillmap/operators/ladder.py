"""The acceptance ladder: exact, similarity, margin, pair score; the first rung that holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import METHODS, Ladder
from ..functions import arrays as A
from ..functions import text as T
from . import exact, vectors

Embed = Callable[[DataFrame], DataFrame]


def verdict(score: Column, margin: Column, ladder: Ladder) -> Column:
    """The vector rung a text stands on, or null. A null margin fails the margin rung only."""
    near = (score >= ladder.margin_min_score) & (margin >= ladder.margin)
    return F.when(score >= ladder.similarity, "embedding").when(near, "embedding_margin")


def score_texts(texts: DataFrame, index: DataFrame, embed: Embed, scorer: vectors.PairScorer | Column | None, ladder: Ladder) -> DataFrame:
    """One row for each distinct text: best guess, score, margin, pair result, and the ladder's method, label and score.

    The k best labels are found once and kept as one row for each text; the pair scorer sees only texts that no vector rung
    took, filtered out before it.
    """
    encoded = embed(texts.select("text"))
    k = max(2, ladder.pair_top_k)
    ranked = vectors.top_k(encoded.select("text", "embedding"), index.select("label_idx", "embedding"), k)
    top = ranked.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("rank", "label_idx", "score"))).alias("_top"))
    names = index.select("label_idx", "label", "uri", "canonical")
    first, second = F.col("_top")[0], F.get("_top", F.lit(1))
    best = top.select("text", "_top", first["label_idx"].alias("label_idx"), first["score"].alias("score"), (first["score"] - second["score"]).alias("margin")).join(names, "label_idx")
    best = best.select("text", "_top", F.col("canonical").alias("guess"), F.col("uri").alias("guess_uri"), F.col("label").alias("guess_label"), "score", "margin", verdict(F.col("score"), F.col("margin"), ladder).alias("method"))
    if not (ladder.use_pair_scorer and scorer is not None):
        nothing = {c: F.lit(None).cast(t) for c, t in (("ce_canonical", "string"), ("ce_uri", "string"), ("ce_label", "string"), ("ce_score", "double"))}
        out = best.drop("_top").withColumns(nothing)
    else:
        todo = best.where("method is null").select("text", F.inline("_top")).where(F.col("rank") <= ladder.pair_top_k)
        pairs = todo.join(names.select("label_idx", "label"), "label_idx")
        found = vectors.best_pair(vectors.score_pairs(pairs, scorer)).join(names, "label_idx")
        found = found.select("text", F.col("canonical").alias("ce_canonical"), F.col("uri").alias("ce_uri"), F.col("label").alias("ce_label"), "ce_score")
        out = best.drop("_top").join(found, "text", "left")
    ce = F.col("ce_score") >= ladder.pair_score
    pick = lambda a, b: F.when(F.col("method").isNotNull(), F.col(a)).when(ce, F.col(b))
    return out.withColumns({
        "canonical": pick("guess", "ce_canonical"), "uri": pick("guess_uri", "ce_uri"), "label": pick("guess_label", "ce_label"),
        "match_score": pick("score", "ce_score"), "method": F.coalesce("method", F.when(ce, "embedding_ce")),
    })


def title_texts(titles: DataFrame, use_clean_title: bool = True) -> DataFrame:
    """title, text of the distinct titles worth scoring: what is encoded, neither empty nor a generic role."""
    rows = titles.select("title").distinct().withColumn("text", T.prepare_text(F.col("title"), use_clean_title))
    return rows.where((F.col("text") != "") & ~F.col("text").isin(T.GENERIC_ROLES))


_TITLE = ["esco_occupation", "match_method", "esco_score", "esco_matched_label", "esco_uri", "esco_best_guess", "esco_best_score", "esco_best_margin", "esco_ce_score"]


def title_results(corpus: DataFrame, lookup: DataFrame, targets: DataFrame, index: DataFrame, embed: Embed, scorer: vectors.PairScorer | Column | None, ladder: Ladder, use_clean_title: bool = True, use_candidates: bool = True) -> DataFrame:
    """_title and the outcome of the ladder, for each distinct title that matched exactly or was scored."""
    matched = exact.canonical_uri(exact.match_titles_exact(corpus, targets, use_candidates), lookup)
    named = F.col("occupation") != ""
    nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(_TITLE[5:], ("string", "double", "double", "double"), strict=True)]
    hit = matched.select(F.col("title").alias("_title"), F.col("occupation").alias(_TITLE[0]), F.when(named, "exact").alias(_TITLE[1]), F.when(named, 1.0).alias(_TITLE[2]), F.col("occupation").alias(_TITLE[3]), F.col("uri").alias(_TITLE[4]), *nothing)
    open_ = title_texts(corpus.select("title").distinct().join(matched, "title", "left_anti"), use_clean_title)
    scores = score_texts(open_.select("text").distinct(), index, embed, scorer, ladder)
    scored = open_.join(scores, "text").select(F.col("title").alias("_title"), *(F.col(a).alias(b) for a, b in zip(("canonical", "method", "match_score", "label", "uri", "guess", "score", "margin", "ce_score"), _TITLE, strict=True)))
    return hit.unionByName(scored)


def with_titles(corpus: DataFrame, results: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """corpus and (some of) the columns of title_results(), null where a title has none."""
    return corpus.join(results, F.col("title") == F.col("_title"), "left").select(*corpus.columns, *(columns or _TITLE))


def match_titles(corpus: DataFrame, lookup: DataFrame, targets: DataFrame, index: DataFrame, embed: Embed, scorer: vectors.PairScorer | Column | None, ladder: Ladder, use_clean_title: bool = True, use_candidates: bool = True) -> DataFrame:
    """corpus and esco_occupation, match_method, esco_score, esco_matched_label, esco_uri, the best guess, its score and margin, ce_score.

    Guesses are kept for every scored row, accepted or not; rows that match exactly are not scored.
    """
    return with_titles(corpus, title_results(corpus, lookup, targets, index, embed, scorer, ladder, use_clean_title, use_candidates))


def list_results(corpus: DataFrame, targets: DataFrame, index: DataFrame, embed: Embed, scorer: vectors.PairScorer | Column | None, ladder: Ladder) -> DataFrame:
    """_list, pos, raw, canonical, method: the outcome of the ladder for each slot of each distinct list of skills."""
    slots = exact.skill_slots(corpus)
    found = slots.join(exact.match_terms_exact(slots, targets).withColumnRenamed("canonical", "_c"), "raw", "left")
    found = found.withColumn("text", F.when(F.col("_c").isNull(), T.strip(F.col("raw"))))
    texts = found.where("text is not null and text != ''").select("text").distinct()
    scores = score_texts(texts, index, embed, scorer, ladder).select("text", F.col("canonical").alias("_s"), F.col("method").alias("_m"))
    return found.join(scores, "text", "left").select("_list", "pos", "raw", F.coalesce("_c", "_s").alias("canonical"), F.when(F.col("_c").isNotNull(), "exact").otherwise(F.col("_m")).alias("method"))


def with_skills(corpus: DataFrame, results: DataFrame, raw: str = "skills") -> DataFrame:
    """corpus with skills as canonical-or-null slots of the lists in raw, skill_match_methods, skills_dropped_terms, and a count for each method."""
    rows = exact.align(corpus, results, raw, skills=F.col("canonical"), skill_match_methods=F.col("method"), _raw=F.col("raw"))
    left = F.filter(F.arrays_zip("_raw", "skill_match_methods"), lambda s: s["skill_match_methods"].isNull())
    rows = rows.withColumn("skills_dropped_terms", A.field_of(left, "_raw")).drop("_raw")
    return rows.withColumns({f"n_skills_{m}": A.count_value(F.col("skill_match_methods"), m) for m in METHODS})


def match_skills(corpus: DataFrame, targets: DataFrame, index: DataFrame, embed: Embed, scorer: vectors.PairScorer | Column | None, ladder: Ladder) -> DataFrame:
    """with_skills() over the corpus's own lists."""
    return with_skills(corpus, list_results(corpus, targets, index, embed, scorer, ladder))
