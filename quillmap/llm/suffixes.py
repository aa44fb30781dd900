"""Removal of repeated passages by suffix arrays.

A byte goes if a WINDOW-byte string that covers it also starts in a document with a smaller id.

Routing. Every window has an anchor: the GRAM-byte string of least hash within it. Equal windows have equal anchors, so
windows are compared only within an anchor's group. Successive windows of one anchor make a context (at most CONTEXT
windows); what moves between machines are hashes of anchors and contexts, one row for each segment of documents, anchor
and context, however often they occur there. An anchor seen in one context and one document is done. Contexts that are
equal as a whole, by 64 bits of the anchor and 62 bits of the context, repeat as a whole: among 10^7 contexts of one anchor
two different ones are taken for equal with probability 1e-5.

Suffix arrays. Where an anchor stands in different contexts, the contexts' bytes are sorted: the suffixes smaller than
their successors directly, the rest induced from them by bucket scans (two-stage sorting); adjacent common prefixes of
WINDOW bytes or more are repeated windows.

Documents are first copied to segments in the shared folder; each later pass reads whole segments by name, so texts are
never shuffled, and a lost executor's pass is just read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, mix64, new_path, read_table, utf8_buffer, written
from .shingles import _BASE, _INVERSE, _VALUE, _power

WINDOW, GRAM = 50, 16
CONTEXT = WINDOW - GRAM + 1
#: Documents and bytes of a segment (one document more than the bytes allow), rows read from it at once, and bytes hashed at once.
SEGMENT_DOCS, SEGMENT_BYTES, READ_ROWS, CHUNK = 20_000, 48 << 20, 256, 4 << 20
#: Context bytes sorted in one suffix array (a group that is larger is sorted as a whole).
SORT_BYTES = 1 << 20
NO_ID = (1 << 63) - 1
_CTX_BITS = 62


# --- two-stage suffix sorting ------------------------------------------------------------------------------------


def suffix_array(s: np.ndarray, depth: int, wanted: np.ndarray | None = None, small: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of s (small unsigned values) in the order of their first `depth` symbols; further ties in any order.

    Suffixes smaller than their successor are sorted directly; scanning the buckets from the smallest symbol on then
    induces each larger one from its successor's place. wanted: which suffixes to sort; the successor of a larger one has to
    be wanted too. small: smaller_than_next(s), where it is known.
    """
    n = len(s)
    if not n:
        return np.empty(0, np.int64)
    small = smaller_than_next(s) if small is None else small
    larger = ~small if wanted is None else ~small & wanted
    own = _sort_direct(s, np.flatnonzero(small if wanted is None else small & wanted), depth)
    symbols = int(s.max()) + 1
    own_of = np.split(own, np.searchsorted(s[own], np.arange(1, symbols)))
    waiting: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    if larger[n - 1]:
        waiting[s[n - 1]].append(np.array([n - 1]))  # the last suffix is larger than the empty one after it
    out = []
    for c in range(symbols):
        level = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        while len(level):  # induced ones first, each run length of c after the shorter
            out.append(level)
            level = _induce(s, larger, level, c, waiting)
        if len(own_of[c]):
            out.append(own_of[c])
            _induce(s, larger, own_of[c], c, waiting)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def smaller_than_next(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; runs of one symbol go as the run's end goes."""
    n = len(s)
    less = np.zeros(n, bool)
    differ = np.zeros(n, bool)
    differ[:-1] = s[:-1] != s[1:]
    differ[-1] = True
    less[:-1] = s[:-1] < s[1:]
    at = np.where(differ, np.arange(n), n)
    end = np.minimum.accumulate(at[::-1])[::-1]
    return less[end]


def _words(s: np.ndarray, depth: int) -> np.ndarray:
    """The 7 symbols from each position on as one number (symbols below 512), the text's end being smallest."""
    padded = np.concatenate([s.astype(np.int64) + 1, np.zeros(depth + 7, np.int64)])
    words = padded[: len(padded) - 6] << 54
    for j in range(1, 7):
        words |= padded[j : j + len(words)] << (54 - 9 * j)
    return words


def _sort_direct(s: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the next `depth` symbols."""
    words = _words(s, depth)
    return at[np.lexsort([words[at + j] for j in range(0, depth, 7)][::-1])]


def _induce(s: np.ndarray, larger: np.ndarray, scanned: np.ndarray, c: int, waiting: list[list[np.ndarray]]) -> np.ndarray:
    """Put the larger predecessors of what was scanned at their buckets' ends; those of this bucket are returned."""
    before = scanned[scanned > 0] - 1
    before = before[larger[before]]
    first = s[before]
    here = before[first == c]
    later, symbol = before[first != c], first[first != c]
    if len(later):
        order = np.argsort(symbol, kind="stable")
        later, symbol = later[order], symbol[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        for part in np.split(later, cuts):
            waiting[s[part[0]]].append(part)
    return here


def common_prefixes(s: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in order, the length of the prefix it shares with the one before it, up to depth."""
    out = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    words = _words(s, depth + 7)
    live = np.arange(len(a))
    for j in range(0, depth, 7):
        apart = words[a[live] + j] ^ words[b[live] + j]
        alike = sum((apart >> (63 - 9 * k) == 0).astype(np.int64) for k in range(1, 8))  # whole symbols before the first that differs
        out[live + 1] = np.minimum(depth, j + alike)
        live = live[alike == 7]
        if not len(live):
            break
    return out


def repeated_windows(contexts: list[bytes], first: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each context, the smallest `first` among all contexts that hold each of its windows, by one suffix array.

    Only suffixes that a window starts at are sorted, and those that they are induced from: up to the next one that is
    smaller than its successor, which a context's last byte always is.
    """
    lengths = np.array([len(c) for c in contexts], np.int64)
    s = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8)  # a byte that no UTF-8 has keeps contexts apart
    start = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    small = smaller_than_next(s)
    long = np.flatnonzero(lengths >= window)
    following = np.minimum.accumulate(np.where(small, np.arange(len(s)), len(s))[::-1])[::-1]
    change = np.zeros(len(s) + 1, np.int8)
    change[start[long]] = 1
    change[following[start[long] + lengths[long] - window] + 1] -= 1
    order = suffix_array(s, window, np.cumsum(change[:-1]) > 0, small)
    owner = np.searchsorted(start, order, side="right") - 1
    whole = order + window <= start[owner] + lengths[owner]
    order, owner = order[whole], owner[whole]
    if not len(order):
        return [np.empty(0, np.int64) for _ in contexts]
    run = np.cumsum(common_prefixes(s, order, window) < window) - 1
    low = np.full(run[-1] + 1, NO_ID, np.int64)
    np.minimum.at(low, run, first[owner])
    at = np.full(len(s), NO_ID, np.int64)
    at[order] = low[run]
    return [at[b : b + max(0, n - window + 1)] for b, n in zip(start.tolist(), lengths.tolist(), strict=True)]


# --- anchors and contexts ----------------------------------------------------------------------------------------


def contexts_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, start, windows, key, ctx) of all contexts: place of the text, first window's byte, windows, hashes."""
    n, docs = len(raw), np.diff(offsets)
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    if n < WINDOW or docs.max(initial=0) < WINDOW:
        return none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[raw] * _power(_BASE, n), out=total[1:])
    inverse = _power(_INVERSE, n)
    low = mix64((total[GRAM:] - total[:-GRAM]) * inverse[: n - GRAM + 1])
    size = 1
    while size * 2 <= CONTEXT:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < CONTEXT:
        low = np.minimum(low[: len(low) - (CONTEXT - size)], low[CONTEXT - size :])
    doc = np.repeat(np.arange(len(docs)), np.maximum(docs - WINDOW + 1, 0))
    at = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(np.maximum(docs - WINDOW + 1, 0))[:-1]]), np.maximum(docs - WINDOW + 1, 0)) + offsets[:-1][doc]
    key = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    size_ = np.diff(np.append(begin, len(at)))
    if size_.max() > CONTEXT:  # long runs of one anchor (repetitive text) are cut
        pieces = -(-size_ // CONTEXT)
        inner = np.arange(pieces.sum()) - np.repeat(np.concatenate([[0], np.cumsum(pieces)[:-1]]), pieces)
        begin, size_ = np.repeat(begin, pieces) + inner * CONTEXT, np.minimum(CONTEXT, np.repeat(size_, pieces) - inner * CONTEXT)
    start = at[begin]
    end = start + size_ + WINDOW - 1
    ctx = mix64((total[end] - total[start]) * inverse[start] + size_.astype(np.uint64)) >> np.uint64(64 - _CTX_BITS)
    return doc[begin], start, size_, key[begin].view(np.int64), ctx.view(np.int64)


def _chunks(path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, ids, bytes, offsets) of a segment, a few rows at a time."""
    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_file(at) as f:
        for b in pq.ParquetFile(f).iter_batches(READ_ROWS):
            ids = b.column(0).fill_null(NO_ID).to_numpy()
            raw, off = utf8_buffer(b.column(1))
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, side="right")) - 1)
                yield b.slice(lo, hi - lo), ids[lo:hi], raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                lo = hi


def _collect(path: str) -> tuple[np.ndarray, ...] | None:
    """One row for each anchor and context of a segment: key, context and whether in several ids, lowest id."""
    held: list[tuple[np.ndarray, ...]] = []
    for _, ids, raw, off in _chunks(path):
        doc, _, _, key, ctx = contexts_of(raw, off)
        if len(key):
            held.append((key, ctx, ids[doc]))
    if not held:
        return None
    key, ctx, ident = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((ctx, key))
    k, c = key[order], ctx[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    at = np.flatnonzero(new)
    low, high = np.minimum.reduceat(ident[order], at), np.maximum.reduceat(ident[order], at)
    back = np.argsort(low, kind="stable")  # by id: compresses well
    place = (c[at] << np.int64(1)) | (high > low)
    return k[at][back], place[back], low[back]


def _judge(key: np.ndarray, seg: np.ndarray, place: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of whole anchors, sorted by key: what each segment must know. (seg, key, ctx, first, many, gives)"""
    ctx = place >> np.int64(1)
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    alone = np.repeat(sizes == 1, sizes) & ((place & 1) == 0)
    key, ctx, seg, low, several = key[~alone], ctx[~alone], seg[~alone], low[~alone], (place[~alone] & 1) == 1
    if not len(key):
        return (key,) * 6
    order = np.lexsort((seg, ctx, key))
    key, ctx, seg, low, several = key[order], ctx[order], seg[order], low[order], several[order]
    new_key = np.append(True, key[1:] != key[:-1])
    new_ctx = new_key | np.append(True, ctx[1:] != ctx[:-1])
    at_ctx, at_key = np.flatnonzero(new_ctx), np.flatnonzero(new_key)
    per_ctx = np.diff(np.append(at_ctx, len(key)))
    first = np.repeat(np.minimum.reduceat(low, at_ctx), per_ctx)
    n_ctx = np.add.reduceat(new_ctx.astype(np.int64), at_key)
    many = np.repeat(n_ctx > 1, np.diff(np.append(at_key, len(key))))
    useful = many | np.repeat(np.logical_or.reduceat(several | (low > first), at_ctx), per_ctx)
    # of an anchor whose documents all share one id nothing is smaller
    spread = np.repeat(np.logical_or.reduceat(several | (low > np.repeat(np.minimum.reduceat(low, at_key), np.diff(np.append(at_key, len(key))))), at_key), np.diff(np.append(at_key, len(key))))
    keep = useful & spread
    return seg[keep], key[keep], ctx[keep], first[keep], many[keep], (many & new_ctx)[keep]


class _Verdicts:
    """What one segment knows of its contexts, looked up by anchor and context."""

    def __init__(self, key: np.ndarray, ctx: np.ndarray, first: np.ndarray, mask: np.ndarray):
        name = _named(key, ctx)
        order = np.argsort(name, kind="stable")
        self.name, self.first, self.mask = name[order], first[order], mask[order]

    def find(self, key: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of found ones, their verdicts)."""
        if not len(self.name):
            return (np.empty(0, np.int64),) * 2
        name = _named(key, ctx)
        p = np.minimum(np.searchsorted(self.name, name), len(self.name) - 1)
        hit = np.flatnonzero(self.name[p] == name)
        return hit, p[hit]


def _named(key: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return mix64(key.view(np.uint64) ^ mix64(ctx.view(np.uint64)))


def _removed(ids: np.ndarray, raw: np.ndarray, off: np.ndarray, verdicts: _Verdicts) -> np.ndarray:
    """Which bytes go."""
    doc, start, windows, key, ctx = contexts_of(raw, off)
    gone = np.zeros(len(raw) + 1, np.int32)
    hit, v = verdicts.find(key, ctx)
    later = ids[doc[hit]] > verdicts.first[v]
    h = hit[later]
    np.add.at(gone, start[h], 1)
    np.add.at(gone, start[h] + windows[h] + WINDOW - 1, -1)
    h, m = hit[~later], verdicts.mask[v[~later]]
    for bit in range(CONTEXT) if m.any() else ():
        x = start[h[(m >> np.int64(bit)) & 1 == 1]] + bit
        np.add.at(gone, x, 1)
        np.add.at(gone, x + WINDOW, -1)
    return np.cumsum(gone[:-1]) > 0


# --- the join ----------------------------------------------------------------------------------------------------


def segments(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(seg, path): the documents as files of bounded size in the shared folder. Only files that are named here count."""
    folder = new_path(docs.sparkSession, "segments")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        held: list[pa.RecordBatch] = []
        docs_, size, n = 0, 0, TaskContext.get().partitionId() << 32

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.parquet"
            pq.write_table(pa.Table.from_batches(held), f"{top}/{name}", filesystem=store, compression="zstd", row_group_size=READ_ROWS * 8)
            return pa.record_batch([pa.array([n], pa.int64()), pa.array([f"{folder}/{name}"])], ["seg", "path"])

        for b in batches:
            lo = 0
            while lo < b.num_rows:
                ends = np.cumsum(pc.binary_length(b.column(1).slice(lo)).fill_null(0).to_numpy(zero_copy_only=False))
                take = int(np.searchsorted(ends, SEGMENT_BYTES - size, side="right")) + 1
                take = min(take, SEGMENT_DOCS - docs_, b.num_rows - lo)
                held.append(b.slice(lo, take))
                docs_, size, lo = docs_ + take, size + int(ends[take - 1]), lo + take
                if docs_ >= SEGMENT_DOCS or size >= SEGMENT_BYTES:
                    yield close()
                    held, docs_, size, n = [], 0, 0, n + 1
        if held:
            yield close()

    return rows.mapInArrow(run, "seg long, path string")


def _sorted_groups(df: DataFrame, key: str, schema: str, f) -> DataFrame:
    """f(batch) on batches that hold whole groups of the key, in order; batches are split only between groups."""
    df = df.repartition(key).sortWithinPartitions(key)
    at = df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(at).to_numpy()
            cut = int(np.searchsorted(k, k[-1]))
            if cut == 0 and held and held[-1].column(at)[-1].as_py() == k[0]:
                held.append(b)  # a group longer than a batch
                continue
            if cut:
                yield from f(pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks())
                held = [b.slice(cut)]
            else:
                if held:
                    yield from f(pa.Table.from_batches(held).combine_chunks())
                held = [b]
        if held:
            yield from f(pa.Table.from_batches(held).combine_chunks())

    return df.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, kept (binary), n_bytes, n_removed, n_spans: one row per document.

    kept: the text's UTF-8 bytes that stay (removal may cut within a character). n_spans: maximal runs of removed bytes.
    Matches never cross documents; equal ids are not smaller than each other; a null id is larger than all others. A null
    text is empty. Texts of any length are hashed whole, in one piece each. Other columns are left out, whatever their names.
    No rows: no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    segs = written(segments(docs, id_col, text_col), "segment-names")
    n = max(1, segs.count())

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for seg, path in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (out := _collect(path)) is not None:
                    for lo in range(0, len(out[0]), 50_000):
                        key, place, low = (pa.array(x[lo : lo + 50_000]) for x in out)
                        yield pa.record_batch([key, pa.array(np.full(len(key), seg)), place, low], ["key", "seg", "place", "low"])

    seen = segs.repartition(n, "seg").mapInArrow(collect, "key long, seg long, place long, low long")

    def judge(t: pa.Table) -> Iterator[pa.RecordBatch]:
        out = _judge(*(t.column(i).to_numpy() for i in range(4)))
        if len(out[0]):
            yield pa.record_batch([pa.array(x) for x in out], ["seg", "key", "ctx", "first", "many", "gives"])

    verdicts = written(_sorted_groups(seen, "key", "seg long, key long, ctx long, first long, many boolean, gives boolean", judge), "verdicts")
    masks = written(_masks(verdicts, segs), "masks")
    full = verdicts.join(masks, ["key", "ctx"], "left").select("seg", F.lit(None).cast("string").alias("path"), "key", "ctx", "first", F.coalesce("mask", F.lit(0)).alias("mask"))
    names = segs.select("seg", "path", *(F.lit(0).cast("long").alias(c) for c in ("key", "ctx", "first", "mask")))
    both = names.unionByName(full)

    def strip(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        path = rows["path"].dropna().iloc[0]
        known = rows[rows["path"].isna()]
        verdict = _Verdicts(*(known[c].to_numpy(np.int64) for c in ("key", "ctx", "first", "mask")))
        for b, ids, raw, off in _chunks(path):
            gone = _removed(ids, raw, off, verdict)
            kept, removed, spans = [], [], []
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                g = gone[lo:hi]
                count = int(g.sum())
                kept.append(raw[lo:hi][~g].tobytes() if count else raw[lo:hi].tobytes())
                removed.append(count)
                spans.append(int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum()) if count else 0)
            yield pa.record_batch([b.column(0), pa.array(kept, pa.binary()), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], ["id", "kept", "n_bytes", "n_removed", "n_spans"])

    return _by_segment(both, n, strip, "id long, kept binary, n_bytes long, n_removed long, n_spans long").withColumnRenamed("id", id_col)


def _by_segment(rows: DataFrame, n: int, f, schema: str) -> DataFrame:
    """f(all rows of a segment) for each; segments are bounded, so are their rows."""
    rows = rows.repartition(n, "seg").sortWithinPartitions("seg")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        for b in batches:
            part = b.to_pandas()
            while len(part):
                seg = part["seg"].iloc[0]
                if held and held[0]["seg"].iloc[0] != seg:
                    yield from f(pd.concat(held))
                    held = []
                cut = int(np.searchsorted(part["seg"].to_numpy(), seg, side="right"))
                held.append(part.iloc[:cut])
                part = part.iloc[cut:]
        if held:
            yield from f(pd.concat(held))

    return rows.mapInArrow(run, schema)


def _masks(verdicts: DataFrame, segs: DataFrame) -> DataFrame:
    """(key, ctx, mask): of anchors with several contexts, which windows of a context stand in a document below its first."""
    asked = verdicts.where("many and gives").select("seg", F.lit(None).cast("string").alias("path"), "key", "ctx", "first")
    names = segs.select("seg", "path", *(F.lit(0).cast("long").alias(c) for c in ("key", "ctx", "first")))
    n = max(1, segs.count())

    def give(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        known = rows[rows["path"].isna()]
        if not len(known):
            return
        key, ctx, first = (known[c].to_numpy(np.int64) for c in ("key", "ctx", "first"))
        verdict = _Verdicts(key, ctx, first, first)
        todo = np.ones(len(verdict.name), bool)
        for _, _, raw, off in _chunks(rows["path"].dropna().iloc[0]):
            _, start, windows, k, c = contexts_of(raw, off)
            hit, v = verdict.find(k, c)
            v, one = np.unique(v, return_index=True)
            hit = hit[one]
            hit, v = hit[todo[v]], v[todo[v]]
            if len(hit):
                todo[v] = False
                text = raw.tobytes()
                body = [text[a : a + w + WINDOW - 1] for a, w in zip(start[hit].tolist(), windows[hit].tolist(), strict=True)]
                yield pa.record_batch([pa.array(k[hit]), pa.array(c[hit]), pa.array(verdict.first[v]), pa.array(body, pa.binary())], ["key", "ctx", "first", "body"])

    bodies = _by_segment(names.unionByName(asked), n, give, "key long, ctx long, first long, body binary")

    def sort(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, ctx, first = (t.column(i).to_numpy() for i in range(3))
        body = t.column(3).to_pylist()
        size = np.cumsum([len(x) + 1 for x in body])
        lo = 0
        while lo < len(key):
            hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SORT_BYTES, side="right"))
            hi = max(hi, lo + 1)
            hi = int(np.searchsorted(key, key[hi - 1], side="right")) if hi < len(key) else len(key)
            low = repeated_windows(body[lo:hi], first[lo:hi])
            mask = np.array([int((x < f) @ (np.int64(1) << np.arange(len(x), dtype=np.int64))) if len(x) else 0 for x, f in zip(low, first[lo:hi].tolist(), strict=True)], np.int64)
            some = mask != 0
            if some.any():
                yield pa.record_batch([pa.array(key[lo:hi][some]), pa.array(ctx[lo:hi][some]), pa.array(mask[some])], ["key", "ctx", "mask"])
            lo = hi

    return _sorted_groups(bodies, "key", "key long, ctx long, mask long", sort)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
