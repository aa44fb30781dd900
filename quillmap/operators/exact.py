"""Exact matching on normalized keys.

Titles and terms are made distinct before anything is computed on them; joins are plain equi-joins, so Catalyst and AQE
pick broadcast or shuffle by the lookup's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import text as T


def with_canonical(lookup: DataFrame, concepts: DataFrame) -> DataFrame:
    """label_key, uri, canonical."""
    return lookup.join(concepts.select("uri", "canonical"), "uri").select("label_key", "uri", "canonical")


def match_titles_exact(titles: DataFrame, targets: DataFrame, use_candidates: bool = True) -> DataFrame:
    """title, occupation of the distinct titles that match: of a title's candidates the first that is a key of targets."""
    distinct = titles.select("title").where(~T.blank(F.col("title"))).distinct()
    if use_candidates:
        forms = distinct.select("title", F.posexplode(T.title_candidates(F.col("title"))).alias("at", "form"))
        forms = forms.select("title", "at", F.col("form.key").alias("label_key"))
    else:
        forms = distinct.select("title", F.lit(0).alias("at"), T.normalize(F.col("title")).alias("label_key"))
    return forms.join(targets, "label_key").groupBy("title").agg(F.min_by("canonical", "at").alias("occupation"))


def canonical_uri(matches: DataFrame, lookup: DataFrame, label: str = "occupation") -> DataFrame:
    """matches and uri: the concept that owns the canonical label's key, which need not be the one that matched."""
    keyed = matches.withColumn("_key", T.normalize(F.col(label)))
    return keyed.join(lookup.select(F.col("label_key").alias("_key"), "uri"), "_key", "left").drop("_key")


def list_key(c: Column) -> Column:
    """A 128-bit name of a list's slots in their order; null for an empty or null one."""
    return F.when(F.size(c) > 0, F.md5(F.to_json(c)))


def skill_slots(corpus: DataFrame, skills: str = "skills") -> DataFrame:
    """_list, pos, raw: one row for each slot of each distinct list. What a slot becomes depends on its list alone, not on
    who has it, so rows need no identity: repeated and null ids do no harm, and repeated lists are done once."""
    lists = corpus.select(list_key(F.col(skills)).alias("_list"), F.col(skills).alias("_slots")).where("_list is not null")
    return lists.distinct().select("_list", F.posexplode("_slots").alias("pos", "raw"))


def match_terms_exact(slots: DataFrame, targets: DataFrame) -> DataFrame:
    """raw, canonical of the distinct terms that match."""
    terms = slots.select("raw").where("raw is not null").distinct().withColumn("label_key", T.normalize(F.col("raw")))
    return terms.join(targets, "label_key").select("raw", "canonical")


def term_counts(corpus: DataFrame, skills: str = "skills") -> DataFrame:
    """raw, n: how many slots of all postings hold each term."""
    return corpus.select(F.explode(skills).alias("raw")).where("raw is not null").groupBy("raw").agg(F.count("*").alias("n"))


def align(corpus: DataFrame, slots: DataFrame, of: str = "skills", **columns: Column) -> DataFrame:
    """corpus with one array for each expression over the slots (from skill_slots) of its list, in slot order; rows without slots get empty ones."""
    names = list(columns)
    rows = slots.select("_list", F.struct("pos", *(e.alias(n) for n, e in columns.items())).alias("s"))
    grouped = rows.groupBy("_list").agg(F.array_sort(F.collect_list("s")).alias("_s")).withColumnRenamed("_list", "_l")
    arrays = [F.coalesce(A.field_of(F.col("_s"), n), F.array().cast("array<string>")).alias(n) for n in names]
    return corpus.join(grouped, list_key(F.col(of)) == F.col("_l"), "left").select(*(c for c in corpus.columns if c not in names), *arrays)


def rule_stage(corpus: DataFrame, occupation_targets: DataFrame, skill_targets: DataFrame, drop_unmatched: bool = False, use_candidates: bool = True) -> DataFrame:
    """skills replaced by canonical-or-null slots, occupation appended."""
    titles = match_titles_exact(corpus, occupation_targets, use_candidates)
    slots = skill_slots(corpus)
    found = slots.join(match_terms_exact(slots, skill_targets), "raw", "left")
    out = align(corpus, found, "skills", skills=F.col("canonical")).join(titles, "title", "left")
    out = out.select(*corpus.columns, "occupation")
    return out.dropna(subset=["occupation"]) if drop_unmatched else out
