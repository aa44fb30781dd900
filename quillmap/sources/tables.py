"""CSV sources with declared schemas, null tokens and an explicit row ordinal."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Cells that stand for a missing value, and the inputs' columns and encodings.
NULL_TOKENS = ["", "NA", "N/A", "n/a", "NULL", "null", "None", "NaN", "nan", "-NaN", "-nan", "#N/A", "#N/A N/A", "#NA", "<NA>", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN"]
LATIN1 = "ISO-8859-1"
CONCEPT = ["conceptUri", "preferredLabel", "altLabels", "hiddenLabels", "description"]
OCCUPATION, SKILL = {"code": "code", "isco_group": "iscoGroup"}, {"skill_type": "skillType", "reuse_level": "reuseLevel"}
POSTINGS, SKILLS, OCCUPATIONS_FILE, SKILLS_FILE, GROUPS_FILE = "linkedin_job_postings.csv", "job_skills.csv", "occupations_en.csv", "skills_en.csv", "ISCOGroups_en.csv"


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def read_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """The named columns as strings, and `ord`, the row's place in the file; of several files, in the order of their names.

    Rows of the wrong length are kept, short ones filled with nulls. Cells may hold line breaks, so a file is one task
    that numbers its rows in order: convert to Parquet once (see stores.py) and read that afterwards, or hand over several
    files, each a task of its own; then one more pass counts the rows of each.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    raw = raw.option("encoding", encoding).option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("inferSchema", False).csv(path)
    cells = [null_tokens(F.col(f"`{c}`")).alias(c) for c in columns]
    if len(raw.inputFiles()) < 2:
        return raw.select(*cells, F.monotonically_increasing_id().alias("ord"))
    rows = raw.select(*cells, F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    files = rows.groupBy("_file").agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each file
    files = files.select(F.col("_file").alias("_name"), (before - F.col("_low")).alias("_shift"))
    return rows.join(files, F.col("_file") == F.col("_name")).select(*columns, (F.col("_at") + F.col("_shift")).alias("ord"))


def require_files(paths: list[str]) -> None:
    """Fail before any plan is built, naming all that is missing."""
    missing = [p for p in paths if "://" not in p and not os.path.exists(p)]
    if missing:
        raise FileNotFoundError("missing: " + ", ".join(missing))


def first_per_key(df: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    """The first writer wins, also with a null value; partial aggregates per task, one shuffle of one row a key."""
    return df.groupBy(key).agg(F.min_by(F.struct(value), order)[value].alias(value))


def last_per_key(df: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    return df.groupBy(key).agg(F.max_by(F.struct(value), order)[value].alias(value))


def load_postings(spark: SparkSession, path: str, n_rows: int | None = None) -> DataFrame:
    """job_id, title, ord: the first n_rows rows read, then those with a title."""
    df = read_csv(spark, path, ["job_link", "job_title"], LATIN1)
    df = df if n_rows is None else df.where(F.col("ord") < n_rows)
    return df.dropna(subset=["job_title"]).select(F.col("job_link").alias("job_id"), F.col("job_title").alias("title"), "ord")


def lookup_by_link(spark: SparkSession, path: str, links: DataFrame) -> DataFrame:
    """job_id, job_skills of the wanted links, the first row of each: a semi join before the aggregation."""
    df = read_csv(spark, path, ["job_link", "job_skills"], LATIN1).withColumnRenamed("job_link", "job_id")
    return first_per_key(df.join(links.select("job_id"), "job_id", "left_semi"), "job_id", "job_skills")


def load_corpus(spark: SparkSession, postings: str, skills: str, n_rows: int | None = None) -> DataFrame:
    """job_id, title, skills: postings with their terms, an empty list where there are none."""
    require_files([postings, skills])
    rows = load_postings(spark, postings, n_rows)
    return with_skills(rows, lookup_by_link(spark, skills, rows)).select("job_id", "title", "skills")


def with_skills(rows: DataFrame, cells: DataFrame) -> DataFrame:
    return rows.join(cells, "job_id", "left").withColumn("skills", T.split_list_cell(F.col("job_skills"))).drop("job_skills")


def concepts(raw: DataFrame, extra: dict[str, str]) -> DataFrame:
    """uri, canonical, variants, description, the extras, pos: of a repeated uri the last record at its first place."""
    label = T.strip(F.coalesce("preferredLabel", F.lit("nan")))
    variants = F.array_sort(F.array_distinct(F.concat(F.array(label), T.split_variants(F.col("altLabels")), T.split_variants(F.col("hiddenLabels")))))
    rows = raw.select(F.col("conceptUri").alias("uri"), label.alias("canonical"), variants.alias("variants"), "description", *(F.col(c).alias(n) for n, c in extra.items()), "ord")
    fields = [c for c in rows.columns if c not in ("uri", "ord")]
    return rows.groupBy("uri").agg(F.max_by(F.struct(*fields), "ord").alias("r"), F.min("ord").alias("pos")).select("uri", "r.*", "pos")


def lookup(raw: DataFrame) -> DataFrame:
    """label_key, uri: every variant of every row, the first writer wins."""
    label = T.strip(F.coalesce("preferredLabel", F.lit("nan")))
    variants = F.concat(F.array(label), T.split_variants(F.col("altLabels")), T.split_variants(F.col("hiddenLabels")))
    keys = raw.select(F.col("conceptUri").alias("uri"), "ord", F.explode(F.array_distinct(F.transform(variants, T.normalize))).alias("label_key"))
    return first_per_key(keys, "label_key", "uri")


def load_occupations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lookup, concepts)."""
    raw = read_csv(spark, path, [*CONCEPT, *OCCUPATION.values()])
    return lookup(raw), concepts(raw, OCCUPATION)


def load_skills(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    raw = read_csv(spark, path, [*CONCEPT, *SKILL.values()])
    return lookup(raw), concepts(raw, SKILL)


def load_taxonomies(spark: SparkSession, occupations: str, skills: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    require_files([occupations, skills])
    return {"occupations": load_occupations(spark, occupations), "skills": load_skills(spark, skills)}


def taxonomy_counts(taxonomies: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """kind, concepts, labels: how many concepts and label keys each vocabulary has."""
    rows = [c.agg(F.count("*").alias("concepts")).crossJoin(found.agg(F.count("*").alias("labels"))).select(F.lit(kind).alias("kind"), "*") for kind, (found, c) in taxonomies.items()]  # one row by one row
    return rows[0] if len(rows) == 1 else rows[0].unionByName(taxonomy_counts(dict(list(taxonomies.items())[1:])))


def group_labels(raw: DataFrame) -> DataFrame:
    """code, label of the occupation groups: codes stripped, the last writer wins."""
    rows = raw.select(T.strip(F.col("code")).alias("code"), F.col("preferredLabel").alias("label"), "ord")
    return last_per_key(rows, "code", "label")


def load_groups(spark: SparkSession, path: str) -> DataFrame:
    return group_labels(read_csv(spark, path, ["code", "preferredLabel"]))
