"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 and -1; one binary classifier for each bit tells the languages that have +1 there
from those that have -1, by the log-odds of hashed byte n-grams. A text's bits are decoded to the codeword of least
logistic loss, each bit weighted by how well it separates the training languages; where the chosen codeword's probability
is below AMBIGUOUS, the runner-up being nearly as near, the text is flagged as ambiguous. Counts are taken over all labelled rows, not a sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, read_table, utf8_buffer

BUCKETS = 1 << 15
#: Labels whose n-grams a task counts before it hands them on; codes tried for the best one, and cells of their distances.
HELD, TRIALS, CELLS = 64, 400, 1 << 22
#: Positions scored at once: bounds memory whatever a text's length.
CHUNK = 1 << 18
#: A text is ambiguous if the best codeword's probability is below this.
AMBIGUOUS = 0.6
LETTER = regex.compile(r"\p{L}")

_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def ngram_ids(raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hashed trigram for each byte: itself and the two before it, of the same text (blanks before its start).

    A-Z are lower-cased, bytes that are neither letters nor beyond ASCII are blanks.
    """
    c = _FOLD[raw]
    one, two = np.empty_like(c), np.empty_like(c)
    one[:1], one[1:] = 32, c[:-1]
    two[:2], two[2:] = 32, c[:-2]
    s = start[start < len(c)]
    one[s] = two[s] = 32
    s = s + 1
    two[s[s < len(c)]] = 32
    key = (two << np.uint32(16)) | (one << np.uint32(8)) | c
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(17)


def codewords(n: int, seed: int = 6) -> np.ndarray:
    """(n, bits) of +1 and -1: random codes of 15 bits or more, the best of many by least distance between codewords.

    The more languages, the fewer codes are tried; all codewords differ.
    """
    bits = max(15, 3 * math.ceil(math.log2(max(n, 2))) + 6)
    rng = np.random.default_rng(seed)
    best, far = None, -1.0
    for _ in range(max(1, min(TRIALS, CELLS // (n * n + 1)))):
        code = rng.choice(np.array([-1.0, 1.0]), (n, bits))
        if n > 1:
            flat = np.abs(code.sum(0)) == n
            code[rng.integers(n), flat] *= -1
            if n * n > CELLS:  # more than 2,000: told apart, not compared in pairs
                while len(np.unique(code, axis=0)) < n:
                    code = rng.choice(np.array([-1.0, 1.0]), (n, bits))
                return code
            dist = (bits - code @ code.T) / 2
            np.fill_diagonal(dist, bits)
            if dist.min() + dist.mean() / 1e3 > far and dist.min() > 0:
                best, far = code, dist.min() + dist.mean() / 1e3
        else:
            best = code
    return best if best is not None else codewords(n, seed + 1)


class Model:
    """langs, their codewords, the bit classifiers' weights and the bits' weights in decoding.

    counts: of each language the buckets that occur, and how often. Languages are taken one at a time, so memory doesn't
    grow with their number, but for these counts.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        n = len(self.langs)
        self.code = codewords(n)

        def share(lang: str) -> np.ndarray:
            at, c = counts[lang]
            out = np.full(BUCKETS, 0.5)
            out[at] += c
            return out / (c.sum() + 0.5 * BUCKETS)

        pos, neg = (self.code > 0).astype(float), (self.code < 0).astype(float)
        up, down = np.zeros((self.code.shape[1], BUCKETS)), np.zeros((self.code.shape[1], BUCKETS))
        for k, lang in enumerate(self.langs):
            p = share(lang)
            up[pos[k] > 0] += p
            down[neg[k] > 0] += p
        up /= np.maximum(pos.sum(0), 1)[:, None]
        down /= np.maximum(neg.sum(0), 1)[:, None]
        w = np.log(np.maximum(up, 1e-12)) - np.log(np.maximum(down, 1e-12)) if n > 1 else np.zeros_like(up)
        # Each bit is centred halfway between the languages it tells apart and scaled to a margin of 1.
        at = np.array([w @ share(lang) for lang in self.langs])
        lo = np.where(self.code > 0, at, np.inf).min(0)
        hi = np.where(self.code < 0, at, -np.inf).max(0)
        self.shift = np.where(np.isfinite(lo + hi), (lo + hi) / 2, 0.0)
        half = np.where(np.isfinite(lo - hi), (lo - hi) / 2, 1.0)
        self.bit_weight = np.clip(half, 0.02, None) / np.clip(half, 0.02, None).sum()
        self.scale = 1 / np.clip(half, 0.02, None)
        self.weights = np.ascontiguousarray(w.T.astype(np.float32))

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, bits): mean log-odds over all of a text's n-grams, centred and scaled."""
        n = len(offsets) - 1
        total = np.zeros((n, self.weights.shape[1]))
        ids = ngram_ids(raw, offsets[:-1])
        for lo in range(0, len(ids), CHUNK):
            hi = min(lo + CHUNK, len(ids))
            a, b = np.searchsorted(offsets, lo, side="right") - 1, np.searchsorted(offsets, hi, side="left")
            docs = np.arange(a, b)
            begin, end = np.maximum(offsets[docs], lo), np.minimum(offsets[docs + 1], hi)
            docs, begin = docs[end > begin], begin[end > begin]
            total[docs] += np.add.reduceat(self.weights[ids[lo:hi]], begin - lo, axis=0, dtype=np.float64)
        mean = total / np.maximum(np.diff(offsets), 1)[:, None]
        return (mean - self.shift) * self.scale

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """(texts, langs): the logistic losses of the bits against each codeword, weighted by the bits' weights."""
        sharp = 6.0
        loss = np.zeros((len(margins), len(self.langs)))
        for k in range(len(self.langs)):
            loss[:, k] = np.logaddexp(0, -sharp * margins * self.code[k]) @ self.bit_weight
        return loss

    @staticmethod
    def decode(loss: np.ndarray) -> np.ndarray:
        """(texts, langs): probabilities from the losses."""
        z = -4 * loss
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(1, keepdims=True)

    @staticmethod
    def rejects(loss: np.ndarray) -> np.ndarray:
        """Texts whose bits speak against every codeword: they lose more than twice what bits that say nothing lose."""
        return loss.min(1) > 2 * np.log(2)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from every row with a text and a label; None if there is none. A label is what stands there, however many there are."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, h in total.items():
                at = np.flatnonzero(h)
                # a text without bytes makes its label known too
                at = at if len(at) else np.array([0])
                yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(h[at].astype(np.int64))], ["lang", "bucket", "c"])
            total.clear()

        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for lang in sorted(set(langs.tolist())):
                raw, off = utf8_buffer(b.column(1).filter(pa.array(langs == lang)))
                h = np.bincount(ngram_ids(raw, off[:-1]), minlength=BUCKETS)
                total[lang] = total[lang] + h if lang in total else h
                if len(total) >= HELD:
                    yield from emit()
        yield from emit()

    got = rows.mapInArrow(count, "lang string, bucket int, c long").groupBy("lang", "bucket").agg(F.sum("c").alias("c")).toArrow()
    if not got.num_rows:
        return None
    langs, at, c = np.array(got.column("lang").to_pylist(), object), got.column("bucket").to_numpy(), got.column("c").to_numpy()
    order = np.lexsort((at, langs.astype(str)))
    langs, at, c = langs[order], at[order], c[order]
    cuts = np.flatnonzero(np.append(True, langs[1:] != langs[:-1])).tolist()
    return Model({langs[x]: (at[x:y], c[x:y]) for x, y in zip(cuts, [*cuts[1:], len(langs)], strict=True)})


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, lang_pred, score (0 to 1), ambiguous, has_letter, rejected, then the columns in keep (as keep_<name>); one row for each row.

    A null text, one without a letter, and any text if nothing was learned, is `und` with score 0, neither ambiguous nor
    rejected. Scores are the decoded probability of the chosen language; ties go to the smaller code. rejected: see
    Model.rejects(). Whole texts, of any length in pieces; other columns are left out. No rows: no rows.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits of the code; bits grow with the logarithm of the labels
    names = [id_col, text_col, *keep]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            lang, score, out = np.array(["und"] * n, object), np.zeros(n), np.zeros(n, bool)
            texts = b.column(1).to_pylist()
            known = np.array([bool(t) and LETTER.search(t) is not None for t in texts], bool)
            if m is not None and known.any():
                loss = m.losses(m.margins(*utf8_buffer(b.column(1).filter(pa.array(known)))))
                p = m.decode(loss)
                best = p.argmax(1)
                lang[known], score[known], out[known] = np.array(m.langs, object)[best], p[np.arange(len(best)), best], m.rejects(loss)
            yield pa.record_batch([b.column(0), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array((lang != "und") & (score < AMBIGUOUS)), pa.array(known), pa.array(out), *b.columns[2:]], [id_col, "lang_pred", "score", "ambiguous", "has_letter", "rejected", *(f"keep_{k}" for k in keep)])

    schema = ", ".join([f"`{id_col}` {kinds[id_col]}, lang_pred string, score double, ambiguous boolean, has_letter boolean, rejected boolean", *(f"`keep_{k}` {kinds[k]}" for k in keep)])
    return docs.select(*(F.col(x).alias(f"c{i}") for i, x in enumerate(names))).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Fold 0 of 5 by the id's decimal text; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without any letter go, and those that the decoding rejects.

    The decoding rejects a text whose bits speak clearly against every codeword (see Model.rejects): one that is like no
    language learned. An ambiguous text is a text: it stays. With nothing learned every text with a letter stays.
    Null and empty texts go. Other columns stay, whatever their names. No rows: no rows.
    """
    model = fit(docs.where(~held_out()))
    found = identify(docs, model, keep=tuple(docs.columns)).where("has_letter and not rejected")
    return found.select(*(F.col(f"keep_{c}").alias(c) for c in docs.columns))
