"""Target frames: lookups and the label index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def target_index(concepts: DataFrame, skip_generic: bool = False) -> DataFrame:
    """label_idx, label, uri, label_key, canonical, description: the first label of each key, in order of concept and variant.

    Generic roles may be left out: before the first of a key is chosen, so the two steps commute. The numbering is one
    window over the labels of a vocabulary, the only thing here that is ordered as a whole.
    """
    rows = concepts.select("uri", "canonical", "description", "pos", F.posexplode("variants").alias("variant", "label"))
    rows = rows.withColumn("label_key", T.normalize(F.col("label"))).where("label_key != ''")
    if skip_generic:
        rows = rows.where(~F.col("label_key").isin(T.GENERIC_ROLES))
    first = rows.groupBy("label_key").agg(F.min_by(F.struct("label", "uri", "canonical", "description", "pos", "variant"), F.struct("pos", "variant")).alias("r")).select("label_key", "r.*")
    number = F.row_number().over(Window.orderBy("pos", "variant")) - 1
    return first.select(number.alias("label_idx"), "label", "uri", "label_key", "canonical", "description")


def with_embed_text(index: DataFrame, use_description: bool = False, chars: int = 200) -> DataFrame:
    text = T.embed_text(F.col("label"), F.col("description"), chars) if use_description else F.col("label")
    return index.withColumn("embed_text", text)
