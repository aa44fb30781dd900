"""Encoders, exact top-k by inner product, margins and pair scoring."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of label vectors that a task holds; a larger index is cut into blocks. Queries of a part that meets such a block.
PASS_BYTES = 64 << 20
QUERY_BLOCK, PART_ROWS = 512, 50_000
#: Scores are rounded to so many digits before they are ranked, so that equal ones tie and the label index decides.
DIGITS = 9


class Encoder(Protocol):
    name: str

    def encode(self, texts: list[str], max_tokens: int = 64) -> np.ndarray:
        """Rows of unit length."""


class PairScorer(Protocol):
    name: str

    def score(self, left: list[str], right: list[str]) -> np.ndarray:
        """Relevance from 0 to 1."""


class TrigramEncoder:
    """A stand-in where no model is at hand: hashed character trigrams. Says nothing of a model's quality."""

    def __init__(self, dim: int = 256):
        self.dim, self.name = dim, f"trigram{dim}"

    def encode(self, texts: list[str], max_tokens: int = 64) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            t = f"  {' '.join(t.lower().split()[:max_tokens])} "
            for j in range(len(t) - 2):
                h = zlib.crc32(t[j : j + 3].encode())
                out[i, h % self.dim] += 1 if h >> 31 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class TransformerEncoder:
    """A sentence encoder: mask-weighted mean of the last states, unit length. Loaded once in each worker."""

    _loaded: dict = {}

    def __init__(self, model: str = "sentence-transformers/all-MiniLM-L6-v2", batch: int = 256):
        self.model, self.batch, self.name = model, batch, model.replace("/", "_")

    def encode(self, texts: list[str], max_tokens: int = 64) -> np.ndarray:
        import torch
        from transformers import AutoModel, AutoTokenizer

        if self.model not in self._loaded:
            device = "cuda" if torch.cuda.is_available() else "cpu"
            self._loaded[self.model] = AutoTokenizer.from_pretrained(self.model), AutoModel.from_pretrained(self.model).to(device).eval(), device
        tokens, model, device = self._loaded[self.model]
        out = []
        with torch.inference_mode():
            for lo in range(0, len(texts), self.batch):
                x = tokens(texts[lo : lo + self.batch], padding=True, truncation=True, max_length=max_tokens, return_tensors="pt").to(device)
                h, mask = model(**x).last_hidden_state, x["attention_mask"].unsqueeze(-1).float()
                v = (h * mask).sum(1) / mask.sum(1).clamp(min=1e-9)
                out.append(torch.nn.functional.normalize(v, dim=1).float().cpu().numpy())
        return np.concatenate(out) if out else np.empty((0, 1), np.float32)


class TokenOverlap:
    """A stand-in pair scorer: Jaccard similarity of the words."""

    name = "overlap"

    def score(self, left: list[str], right: list[str]) -> np.ndarray:
        pairs = [(set(a.lower().split()), set(b.lower().split())) for a, b in zip(left, right, strict=True)]
        return np.array([len(a & b) / len(a | b) if a | b else 0.0 for a, b in pairs])


class TransformerPairScorer:
    """A cross-encoder: the sigmoid of its logit on the joint sequence."""

    _loaded: dict = {}

    def __init__(self, model: str = "cross-encoder/ms-marco-MiniLM-L-6-v2", batch: int = 64, max_tokens: int = 64):
        self.model, self.batch, self.max_tokens, self.name = model, batch, max_tokens, model.replace("/", "_")

    def score(self, left: list[str], right: list[str]) -> np.ndarray:
        import torch
        from transformers import AutoModelForSequenceClassification, AutoTokenizer

        if self.model not in self._loaded:
            device = "cuda" if torch.cuda.is_available() else "cpu"
            self._loaded[self.model] = AutoTokenizer.from_pretrained(self.model), AutoModelForSequenceClassification.from_pretrained(self.model).to(device).eval(), device
        tokens, model, device = self._loaded[self.model]
        out = []
        with torch.inference_mode():
            for lo in range(0, len(left), self.batch):
                x = tokens(left[lo : lo + self.batch], right[lo : lo + self.batch], padding=True, truncation=True, max_length=self.max_tokens, return_tensors="pt").to(device)
                out.append(torch.sigmoid(model(**x).logits.squeeze(-1)).float().cpu().numpy())
        return np.concatenate(out) if out else np.empty(0)


def embed(df: DataFrame, encoder: Encoder, text: str = "text", out: str = "embedding", max_tokens: int = 64) -> DataFrame:
    """df and its vectors; give it distinct texts."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(encoder.encode(s.fillna("").tolist(), max_tokens).astype(np.float32)))

    return df.withColumn(out, run(F.col(text)))


def letter_vector(c: Column) -> Column:
    """A native stand-in: how often each letter a to z stands in a lower-cased text, scaled to unit length."""
    counts = F.array(*(F.length(c) - F.length(F.replace(c, F.lit(x))) for x in map(chr, range(97, 123))))
    counts = F.transform(counts, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(counts, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


def _ranked(rows: pd.DataFrame, ids: list[str], vec: str, at: np.ndarray, m: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """The k best of some labels for each row, in blocks of queries; at: label indexes in order, m: their vectors."""
    rows = rows[rows[vec].notna()]
    n = min(k, len(at))
    for b in range(0, len(rows) if n else 0, QUERY_BLOCK):
        part = rows.iloc[b : b + QUERY_BLOCK]
        s = np.round(np.array(part[vec].tolist(), np.float64) @ m.T, DIGITS)
        order = np.argsort(-s, axis=1, kind="stable")[:, :n]
        out = part[ids].loc[part.index.repeat(n)].copy()
        out["label_idx"], out["score"] = at[order].ravel().astype(np.int32), np.take_along_axis(s, order, 1).ravel()
        yield out


def top_k(queries: DataFrame, labels: DataFrame, k: int, vec: str = "embedding", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """query columns, label_idx, score, rank (from 1): the k labels of largest inner product, ties to the smaller index.

    Blocks of queries are multiplied with blocks of labels, in double precision. An index of up to pass_bytes goes to the
    executors as one block; a larger one is cut into blocks of that size, which meet parts of the queries by a cogroup, so
    that neither the driver nor a task holds more than a block. Each query's best of all blocks are then ranked.
    """
    spark = queries.sparkSession
    ids = [c for c in queries.columns if c != vec]
    held = labels.where(F.col(vec).isNotNull()).select("label_idx", F.col(vec).cast("array<double>").alias("v"))
    one = held.select(F.size("v")).first()  # all have one length; counting the labels needs no vectors
    blocks = -(-labels.count() * 8 * max(1, one[0]) // pass_bytes) if one else 0
    schema = ", ".join([*(f"`{n}` {t}" for n, t in queries.dtypes if n != vec), "label_idx int, score double"])
    if blocks <= 1:
        part = held.orderBy("label_idx").toArrow()  # at most pass_bytes
        flat = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        sent = spark.sparkContext.broadcast((part.column("label_idx").to_numpy(), flat.reshape(part.num_rows, -1) if part.num_rows else flat.reshape(0, 0)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                yield from _ranked(rows, ids, vec, *sent.value, k)

        found = queries.mapInPandas(run, schema)
    else:
        parts = max(1, queries.count() // PART_ROWS)
        asked = queries.withColumn("_part", F.pmod(F.xxhash64(*ids), F.lit(parts)).cast("int")).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        held = held.withColumn("_block", F.pmod(F.xxhash64("label_idx"), F.lit(blocks)).cast("int")).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

        def meet(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values("label_idx")
            got = list(_ranked(rows.reset_index(drop=True), ids, vec, own["label_idx"].to_numpy(), np.array(own["v"].tolist(), np.float64), k)) if len(own) else []
            return pd.concat(got) if got else pd.DataFrame({c: pd.Series(dtype=object) for c in [*ids, "label_idx", "score"]})

        found = asked.groupBy("_part", "_block").cogroup(held.groupBy("_part", "_block")).applyInPandas(meet, schema)
    w = Window.partitionBy(*ids).orderBy(F.desc("score"), "label_idx")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_with_margin(ranked: DataFrame, by: str = "text") -> DataFrame:
    """by, label_idx, score, margin: the best label, and by how much it beats the runner-up (null if there is none)."""
    second = F.max(F.when(F.col("rank") == 2, F.col("score")))
    best = F.max(F.when(F.col("rank") == 1, F.col("score")))
    return ranked.where("rank <= 2").groupBy(by).agg(F.max(F.when(F.col("rank") == 1, F.col("label_idx"))).alias("label_idx"), best.alias("score"), (best - second).alias("margin"))


def score_pairs(pairs: DataFrame, scorer: PairScorer | Column, left: str = "text", right: str = "label", out: str = "ce_score") -> DataFrame:
    """pairs and their score, by a scorer or by a native expression."""
    if isinstance(scorer, Column):
        return pairs.withColumn(out, scorer)

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series(scorer.score(a.fillna("").tolist(), b.fillna("").tolist()).astype(np.float64))

    return pairs.withColumn(out, run(F.col(left), F.col(right)))


def best_pair(scored: DataFrame, by: str = "text", out: str = "ce_score") -> DataFrame:
    """by, label_idx, ce_score, bi_score: the pair of highest score, the better ranked of equals."""
    r = F.max_by(F.struct("label_idx", F.col(out).alias("ce_score"), F.col("score").alias("bi_score")), F.struct(F.col(out), -F.col("rank")))
    return scored.groupBy(by).agg(r.alias("r")).select(by, "r.*")
