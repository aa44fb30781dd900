"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, BPE. Each stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmap.llm import bpe, langid, linededup, mixing, nearset
from quillmap.llm._common import drop_written, read_table, written

STAGES = [
    ("language_id", langid.pipeline_stage),
    ("line_dedup", linededup.pipeline_stage),
    ("near_dedup", nearset.pipeline_stage),
    ("mixing", mixing.pipeline_stage),
    ("bpe", bpe.pipeline_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage gives of the documents in sf_dir. A stage's table is removed once the next one is written.

    Null and empty texts go in the first stage; repeated rows and ids, nulls in other columns, ties, texts of any length and
    columns of any name are what each stage says. An empty table gives no rows.
    """
    docs, made = read_table(spark, sf_dir, "documents"), False
    for name, stage in STAGES:
        now = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if made:
            drop_written(spark, docs)
        docs, made = now, True
    return docs


#: The first stage is a trained model, the fourth a seeded draw: not SQL. Tests hold each against brute force.
ORACLE_SQL = None
