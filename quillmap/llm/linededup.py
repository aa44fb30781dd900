"""Incremental line dedup: exact reference-count tables behind sharded cuckoo filters.

State: a table (k1, k2, refs) counts in how many documents each line key stands, exactly; adding documents adds to it,
deleting them subtracts, so every step can be undone. Lines whose key has at least `min_docs` references are dropped.
Keys that stand at or above the bound are also kept in cuckoo filters, one for each shard of the key space, which take
insertions and deletions; a filter that gets full is built again, larger, from the exact counts.

Lines and filters meet by shard, whatever their number: a shard's filter comes first, then its lines stream past it. It says
"surely not" for most of them; what it lets through is confirmed by an equi-join with the counts. Only the heaviest keys
(of bounded number: each has more than 1 / HEAVY of all references) are decided where their lines are read, so that no
shard and no key of the join has many rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, mix64, new_path, private, read_table, row_key, written

#: Shards at least; hot keys and lines of a shard, about, where there are more.
SHARDS, SHARD_KEYS, SHARD_LINES = 256, 1 << 18, 1 << 21
#: Keys that are decided without a filter, at most: those with more than this part of all references.
HEAVY = 1000
FILTER = "shard int, shards int, n long, room long, filter binary"
_WS = b" \t\n\r\x0b\x0c"


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased (bytes methods know ASCII only)."""
    return line.strip(_WS).lower()


class CuckooFilter:
    """Partial-key cuckoo hashing: buckets of four 16-bit fingerprints, two possible buckets a key, and a counted stash.

    Keys are 64-bit hashes. contains() has no false negatives, also after deletions: what finds no room after the kicks is
    kept in the stash, where keys of one bucket and fingerprint are counted.
    """

    SLOTS, KICKS, LOAD = 4, 200, 0.84

    def __init__(self, capacity: int):
        self.bits = max(2, int(np.ceil(np.log2(max(1, capacity) / (self.SLOTS * self.LOAD)))))
        self.table = np.zeros((1 << self.bits, self.SLOTS), np.uint16)
        self.stash: Counter[tuple[int, int]] = Counter()
        self.mask = np.uint64((1 << self.bits) - 1)

    @property
    def room(self) -> int:
        """Keys that it takes before it should be built again."""
        return int(self.LOAD * self.table.size)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix64(keys.view(np.uint64))
        finger = (h >> np.uint64(48)).astype(np.uint16)
        finger = np.where(finger == 0, np.uint16(1), finger)
        first = h & self.mask
        return finger, first.astype(np.int64), self._other(first.astype(np.int64), finger)

    def _other(self, bucket: np.ndarray, finger: np.ndarray) -> np.ndarray:
        return (bucket ^ (mix64(finger.astype(np.uint64)) & self.mask).astype(np.int64)).astype(np.int64)

    def _fill(self, bucket: np.ndarray, finger: np.ndarray) -> np.ndarray:
        """Put fingerprints into the free slots of their buckets, as many as there are; which had room."""
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
        rank = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        free = np.cumsum(self.table[at] == 0, axis=1)
        fits = free[:, -1] > rank
        slot = (free == rank[:, None] + 1).argmax(1)
        self.table[at[fits], slot[fits]] = finger[order][fits]
        out = np.zeros(len(bucket), bool)
        out[order[fits]] = True
        return out

    def insert(self, keys: np.ndarray) -> None:
        rng = np.random.default_rng(len(keys))
        finger, a, b = self._places(keys)
        for second in (False, True):  # all that have room at once, then the others one by one
            left = ~self._fill(b if second else a, finger)
            finger, a, b = finger[left], a[left], b[left]
        self._kick(finger, a, rng)

    def _kick(self, finger: np.ndarray, a: np.ndarray, rng: np.random.Generator) -> None:
        other = {}
        for f, at in zip(finger.tolist(), a.tolist(), strict=True):
            for _ in range(self.KICKS):
                slot = int(rng.integers(self.SLOTS))
                f, self.table[at, slot] = int(self.table[at, slot]), f
                if f not in other:
                    other[f] = int(mix64(np.array([f], np.uint64))[0] & self.mask)
                at ^= other[f]
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = f
                    break
            else:
                self.stash[min(at, at ^ other[f]), f] += 1

    def delete(self, keys: np.ndarray) -> None:
        """Only for keys that were inserted."""
        for f, x, y in zip(*(v.tolist() for v in self._places(keys)), strict=True):
            for at in (x, y):
                hit = np.flatnonzero(self.table[at] == f)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break
            else:
                self.stash[min(x, y), f] -= 1
                self.stash += Counter()  # drops what is at 0

    def contains(self, keys: np.ndarray) -> np.ndarray:
        finger, a, b = self._places(keys)
        hit = (self.table[a] == finger[:, None]).any(1) | (self.table[b] == finger[:, None]).any(1)
        if self.stash:
            hit |= np.isin((np.minimum(a, b) << 16) | finger, [(x << 16) | f for x, f in self.stash])
        return hit

    def to_bytes(self) -> bytes:
        stash = np.array([(x, f, n) for (x, f), n in sorted(self.stash.items())], np.int64).reshape(-1, 3)
        return np.array([self.bits, len(stash)], np.int64).tobytes() + stash.tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls.__new__(cls)
        out.bits, n = np.frombuffer(data, np.int64, 2).tolist()
        out.stash = Counter({(x, f): c for x, f, c in np.frombuffer(data, np.int64, 3 * n, 16).reshape(-1, 3).tolist()})
        out.table = np.frombuffer(data, np.uint16, offset=16 + 24 * n).reshape(1 << out.bits, cls.SLOTS).copy()
        out.mask = np.uint64((1 << out.bits) - 1)
        return out


def _lines(rows: DataFrame, distinct: bool = False, heavy: object = None, shards: int = 1) -> DataFrame:
    """(shard, _id, _rk, pos, k1, k2) of the lines of (_id, _rk, _text) with a key of one code point or more.

    distinct: one row for each key of a document. heavy: a broadcast of the keys that are known to go; their lines are dealt
    out evenly to shards of their own, below 0.
    """
    kind = dict(rows.dtypes)["_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sure = heavy.value if heavy is not None else frozenset()
        for b in batches:
            doc, pos, keys, gone = [], [], [], []
            for i, text in enumerate(b.column(2).cast(pa.binary()).to_pylist()):
                seen = set()
                for k, line in enumerate((text or b"").split(b"\n")):
                    if (key := line_key(line)) and not (distinct and key in seen):
                        seen.add(key)
                        doc.append(i)
                        pos.append(k)
                        keys.append(h := hashlib.blake2b(key, digest_size=16).digest())
                        gone.append(h in sure)
            if not doc:
                continue
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            doc, pos = np.array(doc), np.array(pos, np.int32)
            shard = np.where(gone, -1 - np.arange(len(doc)) % (4 * shards), _shard_of(k[:, 0], shards)).astype(np.int32)
            yield pa.record_batch([pa.array(shard), b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.array(pos), pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1]))], ["shard", "_id", "_rk", "pos", "k1", "k2"])

    return rows.mapInArrow(run, f"shard int, _id {kind}, _rk long, pos int, k1 long, k2 long")


def _shard_of(k1: np.ndarray, shards: int) -> np.ndarray:
    return (k1.view(np.uint64) >> np.uint64(40)).astype(np.int64) % shards


def _shard(shards: Column | int) -> Column:
    return (F.shiftrightunsigned("k1", 40) % shards).cast("int")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_rk"), F.col(text_col).alias("_text"))


def count_references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The exact table (k1, k2, refs): in how many documents (rows) each line key stands. Keys are 128-bit hashes."""
    return _lines(_rows(docs, id_col, text_col), distinct=True).groupBy("k1", "k2").agg(F.count("*").alias("refs"))


def merge_references(state: DataFrame, added: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The table after documents were added and others deleted, each given by its own count_references().

    Keys that nobody refers to any more are gone: deleting what was added gives back the table there was.
    """
    parts = [state]
    if added is not None:
        parts.append(added)
    if deleted is not None:
        parts.append(deleted.select("k1", "k2", (-F.col("refs")).alias("refs")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("k1", "k2").agg(F.sum("refs").alias("refs")).where("refs > 0")


def build_filters(refs: DataFrame, min_docs: int = 10, shards: int | None = None) -> DataFrame:
    """(shard, shards, n, room, filter): a cuckoo filter over the keys of each shard that stand at the bound. Shards split the hash
    space evenly; by default there are as many as keys and references call for."""
    hot = refs.where(F.col("refs") >= min_docs).select("k1", "k2")
    if shards is None:
        keys, lines = refs.agg(F.count_if(F.col("refs") >= min_docs), F.coalesce(F.sum("refs"), F.lit(0))).first()
        shards = max(SHARDS, -(-keys // SHARD_KEYS), -(-lines // SHARD_LINES))
    return _built(hot.select(_shard(shards).alias("shard"), F.lit(shards).alias("shards"), "k2"), 1)


def _built(keys: DataFrame, times: int) -> DataFrame:
    """Filters with room for `times` as many keys as there are in (shard, shards, k2)."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(rows["k2"].to_numpy(np.int64))
        f = CuckooFilter(times * len(own))
        f.insert(own)
        return pd.DataFrame({"shard": [key[0]], "shards": [rows["shards"].iloc[0]], "n": [len(own)], "room": [f.room], "filter": [f.to_bytes()]})

    return keys.groupBy("shard").applyInPandas(build, FILTER)


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int = 10) -> DataFrame:
    """The filters after the counts went from before to after: keys that reached the bound go in, those that fell below go out.

    A filter without room for them, or a shard without a filter, is built again from the counts, twice as large as needed.
    """
    first = filters.select("shards").first()
    if first is None:
        return build_filters(after, min_docs)
    shards = first[0]
    a, b = (x.select("k1", "k2", F.col("refs").alias(n)) for x, n in ((before, "r0"), (after, "r1")))
    moved = a.join(b, ["k1", "k2"], "full_outer").select("k1", "k2", (F.coalesce("r0", F.lit(0)) >= min_docs).alias("was"), (F.coalesce("r1", F.lit(0)) >= min_docs).alias("now"))
    moved = moved.where("was != now").select(_shard(shards).alias("shard"), "k2", "now")
    delta = moved.groupBy(F.col("shard").alias("s")).agg(F.sum(F.when(F.col("now"), 1).otherwise(-1)).alias("d"), F.count_if("now").alias("i"))
    full = delta.join(filters.select("shard", "n", "room"), F.col("s") == F.col("shard"), "left").where("n is null or n + i > room").select("s")
    hot = after.where(F.col("refs") >= min_docs).select(_shard(shards).alias("shard"), F.lit(shards).alias("shards"), "k2")
    rebuilt = _built(hot.join(full, F.col("shard") == F.col("s"), "left_semi"), 2)

    def change(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        gone, new = (np.sort(rows.loc[rows["now"] == x, "k2"].to_numpy(np.int64)) for x in (False, True))
        f = CuckooFilter.from_bytes(old["filter"].iloc[0])
        f.delete(gone)
        f.insert(new)
        return pd.DataFrame({"shard": [key[0]], "shards": [shards], "n": [int(old["n"].iloc[0]) + len(new) - len(gone)], "room": [f.room], "filter": [f.to_bytes()]})

    keep, few = (x.join(full, F.col("shard") == F.col("s"), "left_anti") for x in (filters, moved))
    return keep.groupBy("shard").cogroup(few.groupBy("shard")).applyInPandas(change, FILTER).unionByName(rebuilt)


def _sieved(lines: DataFrame, filters: DataFrame) -> DataFrame:
    """The lines that their shard's filter lets through, and those of shards below 0."""
    kind = dict(lines.dtypes)["_id"]
    own = filters.select("shard", "filter", *(F.lit(None).cast(t).alias(n) for n, t in lines.dtypes if n != "shard"))
    both = own.unionByName(lines.withColumn("filter", F.lit(None).cast("binary")))
    both = both.repartition("shard").sortWithinPartitions("shard", F.col("filter").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sieve = None, None
        for b in batches:
            shard = b.column(0).to_numpy()
            cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(shard)], strict=True):
                if shard[lo] != current:
                    current, sieve = int(shard[lo]), None
                if (data := b.column(1)[int(lo)].as_py()) is not None:
                    sieve, lo = CuckooFilter.from_bytes(data), lo + 1
                part = b.slice(int(lo), int(hi - lo))
                if current >= 0:
                    if sieve is None or not part.num_rows:
                        continue
                    part = part.filter(pa.array(sieve.contains(np.ascontiguousarray(part.column(6).to_numpy()))))
                if part.num_rows:
                    yield part.select([0, 2, 3, 4, 5, 6])

    return both.select("shard", "filter", "_id", "_rk", "pos", "k1", "k2").mapInArrow(run, f"shard int, _id {kind}, _rk long, pos int, k1 long, k2 long")


def drop_lines(docs: DataFrame, refs: DataFrame, filters: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' columns with the text's kept lines joined by \\n, and n_lines, n_dropped (long).

    refs and filters: written tables of count_references() and build_filters(). A null or empty text is one empty line; an
    empty key is never dropped. Rows of equal or null ids each keep their own. A very long text is a row as any other; its
    lines are held at once. Input columns named n_lines or n_dropped are replaced, others stay, whatever their names.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    first = filters.select("shards").first()
    total = refs.agg(F.coalesce(F.sum("refs"), F.lit(0))).first()[0]
    many = refs.where(F.col("refs") > max(min_docs, total // HEAVY)).select("k1", "k2").collect()  # at most HEAVY
    heavy = spark.sparkContext.broadcast(frozenset(np.array([r["k1"], r["k2"]], "<i8").tobytes() for r in many))
    passed = written(_sieved(_lines(_rows(docs, id_col, text_col), heavy=heavy, shards=first[0] if first else 1), filters), "line-hits")
    hot = refs.where(F.col("refs") >= min_docs).select("k1", "k2")
    sure = passed.where("shard < 0").select("_id", "_rk", "pos")
    found = passed.where("shard >= 0").join(hot, ["k1", "k2"]).select("_id", "_rk", "pos").unionByName(sure)
    i, r, key, drops = private(docs, "_i", "_r", "_key", "_drops")
    found = found.groupBy(F.col("_id").alias(i), F.col("_rk").alias(r)).agg(F.collect_set("pos").alias(drops))
    joined = docs.withColumn(key, row_key(id_col, text_col)).join(found, F.expr(f"`{id_col}` <=> `{i}` and `{key}` = `{r}`"), "left").select(*docs.columns, drops)
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, n_lines, n_dropped = [], [], []
            for t, drops in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist(), strict=True):
                lines = (t or "").split("\n")
                gone = set(drops or ())
                text.append("\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else t or "")
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
            cols = [*b.columns[: len(names)], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            cols[at] = pa.array(text, pa.string())
            yield pa.record_batch(cols, [*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", n_lines long, n_dropped long")


def dedup(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text", state: str | None = None) -> DataFrame:
    """Count, build the filters, drop: see drop_lines(). state: a folder where counts and filters stay, for later steps."""
    spark = docs.sparkSession
    top = state or new_path(spark, "line-state")
    count_references(docs, id_col, text_col).write.parquet(f"{top}/refs")
    refs = spark.read.schema("k1 long, k2 long, refs long").parquet(f"{top}/refs")
    build_filters(refs, min_docs).write.parquet(f"{top}/filters")
    filters = spark.read.schema(FILTER).parquet(f"{top}/filters")
    return drop_lines(docs, refs, filters, min_docs, id_col, text_col)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; n_chars follows the text. No document goes, also where all its lines do.

    A null text becomes an empty one; other columns stay, whatever their names. No rows: no rows.
    """
    return dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


ORACLE = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
h as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10),
m as (select k.*, h.key is not null as gone from k left join h on k.key = h.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""
