"""Language-model scoring of whole documents.

Words are counted exactly over all training documents. The most frequent ones (their number grows with the square root of
the tokens) are listed in a gated recurrent model (see gru.py). It is trained in one pass over all training text, whatever
its amount: the documents are dealt into ROUNDS rounds; in each, every task trains a copy on its documents of that round,
and the copies are averaged by tokens. So the scores depend a little on how the table is partitioned, as any order of
training does. The model also gives the probability of 16 classes of other words (by letters beyond ASCII, punctuation,
digits and length). Of its class an unlisted word has the share (c + 1) / Z, by its corpus count. So the score is a proper
log probability over all words, seen or not, and what it gathers grows with the corpus.

Counts of frequent words go to every executor, in a list of bounded length; those of all others meet the documents'
words in an equi-join. After they are counted, texts are split into words once: training and scoring read what was written
then, a code of four bytes for each word.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, drop_written, read_table, utf8_buffer, written
from .gru import GRU
from .shingles import word_spans

#: Words listed in the model at least (at most those sent); words whose counts are sent to executors.
LISTED, SENT = 2048, 1 << 18
#: Tokens scored side by side, and distinct words a task counts before it hands them on.
TOGETHER, HELD = 4_000_000, 2_000_000
CLASSES, END = 16, 0
#: Leading bits of a word's key by which a place in the list is found.
BITS = 20
#: Rounds that make one pass over all training text; tokens a copy learns from in a round, about, where there are enough;
#: weights in a row of a copy, and copies averaged in one group.
ROUNDS, COPY_TOKENS, PIECE, FAN_IN = 8, 1 << 18, 1 << 16, 32
_ASCII_LETTER = np.array([97 <= b <= 122 or 65 <= b <= 90 for b in range(256)])
#: Of each byte, the bits of a word's class: beyond ASCII; an ASCII byte, no letter (of the last byte, of those before).
_BEYOND, _LAST, _BEFORE = 1, 2, 4
_BITS = bytes(_BEYOND if b >= 128 else 0 if _ASCII_LETTER[b] else _LAST | _BEFORE for b in range(256))
#: Bytes whose words are split at once, about: as many as stay in a core's cache.
CHUNK = 1 << 16


def word_keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key for each word (60 bits of a hash, then 4 of its class; never END), and where each text's words start (n + 1)."""
    keys, starts, lo, size = [np.empty(0, np.int64)], [np.zeros(1, np.int64)], 0, 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1)
        key, at = _word_keys(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        keys.append(key)
        starts.append(at[1:] + size)
        lo, size = hi, size + len(key)
    return np.concatenate(keys), np.concatenate(starts)


def _word_keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, at, s, e = word_spans(raw, offsets)
    if not len(h):
        return np.empty(0, np.int64), at
    bits = np.frombuffer(raw.tobytes().translate(_BITS), np.uint8)
    cls = np.bitwise_or.reduceat(bits, np.stack([s, e - 1], 1).reshape(-1))[::2]  # of all bytes but the last, or of the only one
    last = bits[e - 1]
    cls = (cls & np.where(e - s > 1, np.uint8(_BEYOND | _BEFORE), np.uint8(_BEYOND))) | (last & np.uint8(_BEYOND | _LAST))
    cls |= (e - s > 8).astype(np.uint8) << np.uint8(3)
    key = (h & ~np.uint64(CLASSES - 1)) | cls
    return np.where(key == END, np.uint64(CLASSES), key).view(np.int64), at


def training(id_col: str = "doc_id") -> Column:
    """Not fold 2 of 7 by the id's decimal text; a null id is training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 != 2, F.lit(True))


def count_words(texts: DataFrame) -> DataFrame:
    """(key, c) over a frame with one text column; the end is a token of every text. Each task counts before it shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            k, c = (np.concatenate(x) for x in zip(*held, strict=True))
            u, at = np.unique(k, return_inverse=True)
            return u, np.bincount(at, c).astype(np.int64)

        for b in batches:
            if not b.num_rows:
                continue
            key, _ = word_keys(*utf8_buffer(b.column(0)))
            u, c = np.unique(key, return_counts=True)
            held.append((np.append(u, END), np.append(c, b.num_rows)))
            size += len(u)
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield pa.record_batch(list(map(pa.array, held[0])), ["key", "c"])
                    held, size = [], 0
        if held:
            yield pa.record_batch(list(map(pa.array, merged())), ["key", "c"])

    return texts.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


class Lexicon:
    """Counts of the frequent words, which of them the model lists, and what the corpus has in all."""

    def __init__(self, key: np.ndarray, c: np.ndarray, n: int, v: int, class_sum: np.ndarray, class_n: np.ndarray):
        most = max(LISTED, math.isqrt(n)) - 1
        listed = [int(k) for k in key[:most].tolist() if k != END]
        ident = {k: i + 1 for i, k in enumerate(listed)} | {END: 0}
        order = np.argsort(key)
        self.key, self.c = key[order], c[order]
        self.id = np.array([ident.get(k, -1) for k in self.key.tolist()], np.int64)
        self.n, self.v, self.words = n, v, len(listed) + 1
        at = self.id > 0
        cls = (self.key[at] & (CLASSES - 1)).astype(np.int64)
        self.rest = class_sum - np.bincount(cls, self.c[at], CLASSES)
        self.z = self.rest + (class_n - np.bincount(cls, minlength=CLASSES)) + 1.0
        self.freq = np.zeros(self.words)
        self.freq[self.id[self.id >= 0]] = self.c[self.id >= 0]

        # Of each code, a place in the list or, beyond it, the class of a word that isn't sent: its model id.
        self.ids = np.concatenate([np.where(self.id >= 0, self.id, self.words + (self.key & (CLASSES - 1))), self.words + np.arange(CLASSES)]).astype(np.int32)

    def codes(self, key: np.ndarray) -> np.ndarray:
        """The code of each word (int32): its place in the list, or the list's length and its class."""
        if "starts" not in self.__dict__:  # once in each worker
            self.starts = np.searchsorted(self.key >> np.int64(64 - BITS), np.arange(-(1 << BITS - 1), (1 << BITS - 1) + 1)).astype(np.int32)
        out = (len(self.key) + (key & (CLASSES - 1))).astype(np.int32)
        bucket = (key >> np.int64(64 - BITS)) + (1 << BITS - 1)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        live = np.flatnonzero(at < end)
        at, end, key = at[live], end[live], key[live]
        while len(live):
            same = self.key[at] == key
            out[live[same]] = at[same]
            at += 1
            more = ~same & (at < end)
            live, at, end, key = live[more], at[more], end[more], key[more]
        return out


def split_words(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", train: Column | None = None) -> DataFrame:
    """A written table of two kinds of rows. A document: rid, its own number; id; codes (int32) of its words; round, from 0 on
    for those to train on, else -1. A word of it that isn't sent, of round -2: rid, key, times."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.lit(False).alias("train") if train is None else train.alias("train"))
    kind, sent = rows.schema["id"].dataType.simpleString(), spark.sparkContext.broadcast(lexicon)
    names = ["round", "rid", "id", "codes", "key", "times"]

    def others(b: pa.RecordBatch, rid: int, code: np.ndarray, key: np.ndarray, at: np.ndarray) -> pa.RecordBatch | None:
        out = np.flatnonzero(code >= len(sent.value.key))
        if not len(out):
            return None
        key, doc = key[out], np.searchsorted(at, out, side="right") - 1
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
        none = [pa.nulls(len(new), t) for t in (b.column(0).type, pa.binary())]
        return pa.record_batch([pa.array(np.full(len(new), -2, np.int32)), pa.array(doc[new] + rid), *none, pa.array(key[new]), pa.array(np.diff(np.append(new, len(key))).astype(np.int32))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        turn, rid = part, part << 40
        for b in batches:
            n = b.num_rows
            if n:
                key, at = word_keys(*utf8_buffer(b.column(1)))
                code = sent.value.codes(key)
                if (more := others(b, rid, code, key, at)) is not None:
                    yield more
                learn_ = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
                round_ = np.where(learn_, (turn + np.cumsum(learn_) - 1) % ROUNDS, -1).astype(np.int32)
                turn += int(learn_.sum())
                raw, cuts = code.tobytes(), (4 * at).tolist()
                yield pa.record_batch([pa.array(round_), pa.array(np.arange(rid, rid + n)), b.column(0), pa.array([raw[x:y] for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], names)
                rid += n

    return written(rows.mapInArrow(run, f"round int, rid long, id {kind}, codes binary, key long, times int"), "lm-words", by="round")


def train(words: DataFrame, model: GRU, ids: np.ndarray, tokens: int, rate: float = 1.2e-2) -> list[int]:
    """Train the model on every row of words (round, codes) of rounds from 0 on, once; returns the tokens each round learned from.

    ids: the model's id of each code.

    A task holds one copy and about a million tokens; copies meet piece by piece in a tree of bounded fan-in, and the
    driver gets one copy's worth. Few tokens make few copies. Within a round the rate stands, from round to round it falls.
    """
    spark = words.sparkSession
    names = sorted(model.p)
    cuts = np.cumsum([model.p[k].size for k in names])
    copies = max(1, tokens // (ROUNDS * COPY_TOKENS))
    seen, kinds = [], "pid long, piece int, n long, v binary"

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pid")
        n = rows["n"].sum()
        v = sum(np.frombuffer(x, np.float32) * (m / n) for x, m in zip(rows["v"], rows["n"], strict=True))
        return pd.DataFrame({"pid": [int(key[0])], "piece": [int(key[1])], "n": [int(n)], "v": [v.astype(np.float32).tobytes()]})

    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast((model, ids))
        now = rate * (1 - 0.9 * (r + 0.5) / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, now=now) -> Iterator[pa.RecordBatch]:
            first, ids = sent.value
            own = copy.copy(first)
            own.p = {k: v.copy() for k, v in own.p.items()}
            n = own.train((ids[np.frombuffer(x, np.int32)] for b in batches for x in b.column(0).to_pylist()), now)
            if n:
                flat = np.concatenate([own.p[k].reshape(-1) for k in names])
                for i, lo in enumerate(range(0, len(flat), PIECE)):
                    yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([i], pa.int32()), pa.array([n], pa.int64()), pa.array([flat[lo : lo + PIECE].tobytes()], pa.binary())], ["pid", "piece", "n", "v"])

        part = words.where(F.col("round") == r).select("codes").coalesce(copies)
        parts = part.mapInArrow(run, kinds)
        left = max(2, part.rdd.getNumPartitions())
        while left > 1:
            parts = parts.groupBy(F.expr(f"pid div {FAN_IN}").alias("pid"), "piece").applyInPandas(add, kinds)
            left = math.ceil(left / FAN_IN)
        got = sorted(parts.collect(), key=lambda x: x["piece"])
        sent.unpersist()
        seen.append(got[0]["n"] if got else 0)
        if got:
            flat = np.concatenate([np.frombuffer(x["v"], np.float32) for x in got])
            model.p = {k: v.reshape(model.p[k].shape).copy() for k, v in zip(names, np.split(flat, cuts[:-1]), strict=True)}
    return seen


def count(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, Lexicon]:
    """The counts of all words of these documents, and the lexicon."""
    spark = docs.sparkSession
    bounded_batches(spark)
    counts = written(count_words(docs.select(F.col(text_col).alias("t"))), "lm-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "key").limit(SENT).toArrow()
    per = counts.where(F.col("key") != END).groupBy(F.expr(f"key & {CLASSES - 1}").alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    sums, sizes = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per:
        sums[r["k"]], sizes[r["k"]] = r["c"], r["n"]
    return counts, Lexicon(top.column("key").to_numpy(), top.column("c").to_numpy(), n, v, sums, sizes)


def fitted(words: DataFrame, lexicon: Lexicon) -> GRU:
    """A model trained on every document of split_words() that is to be trained on."""
    model = GRU(lexicon.freq, lexicon.rest, width=max(64, 2 * math.isqrt(lexicon.words)))
    train(words, model, lexicon.ids, lexicon.n)
    return model


def learn(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, Lexicon, GRU]:
    """The counts of all words of these documents, the lexicon and the model, trained on every one of them."""
    counts, lexicon = count(docs, text_col)
    words = split_words(docs, lexicon, text_col, text_col, F.lit(True))
    model = fitted(words, lexicon)
    drop_written(docs.sparkSession, words)
    return counts, lexicon, model


def score(docs: DataFrame, counts: DataFrame, lexicon: Lexicon, model: GRU, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    Words: what stands between ASCII white space, A-Z lower-cased; the end is a token. A null text has the end alone.
    base_score: add-one unigram log10; score: the model's log10 probability. Equal ids and null ids each have their own
    row. A very long text is scored in windows, with the state carried on; its words are held at once, as codes. Other
    columns are left out, whatever their names. With nothing learned every count is 0. No rows: no rows.
    """
    return scored(split_words(docs, lexicon, id_col, text_col), counts, lexicon, model).withColumnRenamed("id", id_col)


def scored(words: DataFrame, counts: DataFrame, lexicon: Lexicon, model: GRU) -> DataFrame:
    """score() of documents that were split into words."""
    spark = words.sparkSession
    # a table of a million tokens a task would have its longest texts run alone, again in every task
    rows = words.where("round >= -1").select("rid", "id", "codes").coalesce(max(spark.sparkContext.defaultParallelism, lexicon.n // TOGETHER))
    kind = rows.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast((lexicon, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, gru = sent.value
        below, listed = np.log10(lex.n + lex.v + 1), len(lex.key)
        log_c = np.concatenate([np.log10(lex.c + 1.0), np.zeros(CLASSES)])  # unseen: the logarithm of 0 + 1
        # of its class an unlisted word has (c + 1) / Z
        rest = np.where(lex.ids >= lex.words, log_c - np.log10(lex.z)[np.concatenate([lex.key & (CLASSES - 1), np.arange(CLASSES)])], 0.0)
        end = lex.codes(np.array([END]))[0]
        held, size = [], 0

        def emit() -> pa.RecordBatch:
            first = [pa.concat_arrays([b.column(j) for b, _ in held]) for j in (0, 1)]
            codes = [c for _, c in held]
            n = np.concatenate([np.array([len(x) for x in c]) for c in codes])
            natural = gru.score([lex.ids[x] for c in codes for x in c])
            known, base, own = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
            at = 0
            for c in codes:
                sizes = n[at : at + len(c)]
                flat = np.concatenate([*c, np.empty(0, np.int32)])
                begin = np.cumsum(sizes) - sizes
                for out, values in ((known, flat < listed), (base, log_c[flat]), (own, rest[flat])):
                    out[at : at + len(c)] = np.add.reduceat(np.append(values.astype(float), 0.0), begin) * (sizes > 0)
                at += len(c)
            known += end < listed
            base += log_c[end] - (n + 1) * below
            out = [pa.array(n + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(natural / np.log(10) + own)]
            return pa.record_batch([*first, *out], ["rid", "id", "n_tokens", "known", "base", "own"])

        for b in batches:
            if b.num_rows:
                held.append((b, [np.frombuffer(x, np.int32) for x in b.column(2).to_pylist()]))
                size += sum(map(len, held[-1][1]))
                if size > TOGETHER:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()

    out = rows.mapInArrow(run, f"rid long, id {kind}, n_tokens long, known long, base double, own double")
    # Words that aren't sent meet their counts; each document has its own number.
    few = words.where("round = -2").select(F.col("rid").alias("r"), "key", "times")
    met = few.join(counts, "key").groupBy("r").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("seen"))
    out = out.join(met, F.col("rid") == F.col("r"), "left")
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0)).cast("long")
    return out.select("id", "n_tokens", (F.col("known") + seen).alias("n_known"), F.lit(int(lexicon.n)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("own") + more).alias("score"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counts, lexicon = count(docs.where(training()))
    words = split_words(docs, lexicon, train=training())
    out = scored(words, counts, lexicon, fitted(words, lexicon)).withColumnRenamed("id", "doc_id")
    return out.withColumn("held_out", ~training()).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
