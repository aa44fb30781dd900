"""The whole run: load, rule stage, title ladder, skill ladder, export. `python -m quillmap.plans.pipeline` runs it."""

from __future__ import annotations

import dataclasses
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DESCRIPTION_TOKENS, QUERY_TOKENS, Config
from ..operators import exact, export, ladder, lookup, reports, vectors
from ..sources import stores, tables


@dataclass
class PipelineResult:
    corpus: DataFrame
    titles: DataFrame | None
    skills: DataFrame | None


def merge_stage(corpus: DataFrame, stage: DataFrame, columns: list[str]) -> DataFrame:
    """The stage's columns folded into the corpus by job_id, in place of those of the same name.

    Null ids meet null ids, and an id that stands several times on both sides gives every pair: for frames whose ids are
    unique. run_stages() does without it.
    """
    new = [c for c in columns if c in stage.columns and c != "job_id"]
    right = stage.select(F.col("job_id").alias("_job"), *new)
    return corpus.drop(*new).join(right, F.expr("job_id <=> _job"), "left").drop("_job")


def run_stages(corpus: DataFrame, taxonomies: dict[str, tuple[DataFrame, DataFrame]], config: Config, encoder: vectors.Encoder | Callable[[DataFrame, str], DataFrame], scorer: vectors.PairScorer | Column | None, vector_dir: str | None = None) -> PipelineResult:
    """All stages over job_id, title, skills; raw skills stay as skills_raw. One plan, nothing is run here but the indexes.

    Every stage adds columns to the rows it is given, by title or by list of skills, so repeated and null ids keep rows of
    their own. encoder: a model, or a function from a frame and its text column to the frame with embedding. With vector_dir
    the index vectors are kept there, under the encoder's name and a signature of the texts.
    """
    occupation_lookup, occupations = taxonomies["occupations"]
    skill_lookup, skill_concepts = taxonomies["skills"]
    occupation_targets = exact.with_canonical(occupation_lookup, occupations)
    skill_targets = exact.with_canonical(skill_lookup, skill_concepts)
    out = exact.rule_stage(corpus.withColumn("skills_raw", F.col("skills")), occupation_targets, skill_targets, config.drop_unmatched == "after_exact", config.use_candidates)
    tokens = DESCRIPTION_TOKENS if config.use_description else QUERY_TOKENS
    native = callable(encoder)
    embed = lambda df: encoder(df, "text") if native else vectors.embed(df, encoder)

    def indexed(concepts: DataFrame, skip_generic: bool) -> DataFrame:
        index = lookup.with_embed_text(lookup.target_index(concepts, skip_generic), config.use_description)
        if native:
            return encoder(index, "embed_text")
        encode = lambda df: vectors.embed(df, encoder, "embed_text", max_tokens=tokens)
        return encode(index) if vector_dir is None else stores.cached_vectors(index, encode, f"{encoder.name}-{tokens}", vector_dir)

    titles = skills = None
    if config.run_titles:
        found = ladder.title_results(corpus, occupation_lookup, occupation_targets, indexed(occupations, True), embed, scorer, config.titles, config.use_clean_title, config.use_candidates)
        titles = ladder.with_titles(corpus, found)
        out = ladder.with_titles(out, found, ["esco_occupation", "esco_uri", "match_method"]).withColumn("occupation", F.coalesce("esco_occupation", "occupation"))
    if config.run_skills:
        found = ladder.list_results(corpus, skill_targets, indexed(skill_concepts, False), embed, scorer, config.skills)
        skills = ladder.with_skills(corpus, found)
        out = ladder.with_skills(out, found, "skills_raw")
    if config.drop_unmatched == "after_all":
        out = out.dropna(subset=["occupation"])
    return PipelineResult(out, titles, skills)


def run(spark: SparkSession, config: Config, encoder: vectors.Encoder, scorer: vectors.PairScorer | None) -> PipelineResult:
    files = {n: config.data(n) for n in (tables.POSTINGS, tables.SKILLS, tables.OCCUPATIONS_FILE, tables.SKILLS_FILE)}
    tables.require_files(list(files.values()))
    corpus = stores.load_all(spark, config.cached("corpus"), lambda: tables.load_corpus(spark, files[tables.POSTINGS], files[tables.SKILLS], config.sample_size), config.use_cache)
    taxonomies = tables.load_taxonomies(spark, files[tables.OCCUPATIONS_FILE], files[tables.SKILLS_FILE])
    result = run_stages(corpus, taxonomies, config, encoder, scorer, os.path.join(config.cache_dir, "vectors"))
    if config.save_output:
        found = {"corpus": result.corpus, "titles": result.titles, "skills": result.skills}
        stores.save_run(spark, config.cached("run"), {k: v for k, v in found.items() if v is not None}, dataclasses.asdict(config))
    return result


def export_run(spark: SparkSession, config: Config) -> DataFrame:
    saved, _ = stores.load_run(spark, config.cached("run"), ["corpus"])
    _, occupations = tables.load_occupations(spark, config.data(tables.OCCUPATIONS_FILE))
    groups = tables.load_groups(spark, config.data(tables.GROUPS_FILE))
    return export.flatten(saved["corpus"], occupations, groups, config.min_skills)


def main() -> int:
    spark = SparkSession.builder.appName("quillmap").getOrCreate()
    config = Config()
    try:
        result = run(spark, config, vectors.TransformerEncoder(), vectors.TransformerPairScorer())
        out = export_run(spark, config) if config.save_output else None
    except FileNotFoundError as e:
        print(f"ERROR: {e}")
        return 1
    reports.show("SUMMARY", reports.run_summary(result.corpus))
    if out is not None:
        stores.export_csv(out, config.data("job_skill_esco_name.csv"))
        reports.show("EXPORT", export.export_summary(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
