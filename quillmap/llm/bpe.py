"""BPE encoding and decoding by forced-boundary splitting.

A merge only ever makes a vocabulary token. So where two neighbouring symbols of a word stand next to each other inside
no token at all, every encoding has a cut. Words are split at these forced boundaries, the fragments are encoded
independently (lowest-ranked merge first) and their ids concatenated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ._common import bounded_batches, map_arrow, read_table

#: Words, and characters of them, that a worker remembers at most; beyond, the memory is cleared.
CACHE, CACHE_CHARS = 350_000, 8 << 20
#: Two ids make one key; what no pair of symbols has as its rank.
SPAN, NONE = 1 << 24, 1 << 40
#: Symbols of a fragment from which it is encoded alone.
LONG = 200
_LOADED: dict[str, BPE] = {}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Table:
    """int64 keys to values: a sorted array behind a table of the keys' hashed places, looked up for whole arrays."""

    BITS = 20

    def __init__(self, plain: dict[int, int]):
        self.plain = plain
        keys = np.array(sorted(plain), np.int64)
        place = self._hash(keys)
        order = np.argsort(place, kind="stable")
        self.keys = keys[order]
        self.values = np.array([plain[k] for k in self.keys.tolist()], np.int64)
        self.start = np.searchsorted(place[order], np.arange((1 << self.BITS) + 1))
        self.depth = int(np.diff(self.start).max(initial=0))

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in keys, or -1."""
        h = self._hash(keys)
        at, end = self.start[h], self.start[h + 1]
        out = np.full(len(keys), -1, np.int64)
        for d in range(self.depth):
            i = np.flatnonzero(at + d < end)
            if not len(i):
                break
            p = at[i] + d
            hit = self.keys[p] == keys[i]
            out[i[hit]] = p[hit]
        return out

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.find(keys) >= 0

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        p = self.find(keys)
        return np.where(p >= 0, self.values[p], default)


class BPE:
    """A byte-level BPE with word ends, read from a tokenizers file: lower-casing, white space dropped, no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = _Table({self.vocab[a] * SPAN + self.vocab[b]: i for i, (a, b) in enumerate(pairs)})
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(*self.vocab.values(), *self.special.values()))
        for t, i in (*self.vocab.items(), *self.special.items()):
            self.tokens[i] = t
        symbols = byte_symbols()
        self.byte_id = np.array([self.vocab[x] for x in symbols], np.int64)
        self.byte_end_id = np.array([self.vocab[x + self.end] for x in symbols], np.int64)
        self.inside = _Table(dict.fromkeys(self._pairs_inside(), 0))
        # What the file's normalizer and pre-tokenizer name: NFC, white space, lower case; then these pieces.
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(self.pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.special_hint = os.path.commonprefix(list(self.special))
        self.packed_special = {t: np.uint32(i).tobytes() for t, i in self.special.items()}
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held: dict[int, int] = {}  # characters of the words in each
        self.known: set[str] = set()
        self.path, self.library = path, None

    def _symbols_of(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _pairs_inside(self) -> set[int]:
        found = set()
        for t in self.vocab:
            s = [self.vocab[x] for x in self._symbols_of(t)]
            found.update(a * SPAN + b for a, b in zip(s, s[1:], strict=False))
        return found

    def split_forced(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where fragments start: at the words' starts and wherever two neighbours stand together inside no token."""
        cut = ~self.inside.has(symbols[:-1] * SPAN + symbols[1:])
        first = np.zeros(len(symbols), bool)
        first[starts] = True
        first[1:] |= cut
        return first

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers; all fragments of all words side by side."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        starts = np.concatenate([[0], ends[:-1]])
        sym = self.byte_id[flat]
        sym[ends - 1] = self.byte_end_id[flat[ends - 1]]
        first = self.split_forced(sym, starts)
        done = self.merge_fragments(sym, first)
        word = np.searchsorted(ends, done[0], side="right")
        data, offsets = done[1].astype("<u4").tobytes(), 4 * np.searchsorted(word, np.arange(len(words) + 1))
        o = offsets.tolist()
        return [data[x:y] for x, y in zip(o, o[1:], strict=False)]

    def merge_fragments(self, sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, id) of what remains. In every round each fragment merges its pair of lowest rank, leftmost of equals."""
        pos, out = np.arange(len(sym)), []
        frag_at = np.flatnonzero(first)
        long = np.flatnonzero(np.diff(np.append(frag_at, len(sym))) > LONG)
        keep = np.ones(len(sym), bool)
        for k in long.tolist():
            x, y = frag_at[k], frag_at[k + 1] if k + 1 < len(frag_at) else len(sym)
            ids = self.encode_fragment(sym[x:y].tolist())
            out.append((np.full(len(ids), x), np.array(ids)))
            keep[x:y] = False
        sym, pos, first = sym[keep], pos[keep], first[keep]
        while len(sym):
            at = np.flatnonzero(first)
            r = np.full(len(sym), NONE, np.int64)
            r[:-1] = self.rank.get(sym[:-1] * SPAN + sym[1:], NONE)
            r[at[1:] - 1] = NONE
            low = np.minimum.reduceat((r << 20) + (np.arange(len(sym)) - np.repeat(at, np.diff(np.append(at, len(sym))))), at)
            active = low < NONE << 20
            live = np.repeat(active, np.diff(np.append(at, len(sym))))
            if not live.all():
                out.append((pos[~live], sym[~live]))
            i = at[active] + (low[active] & ((1 << 20) - 1))
            sym[i] = self.made[low[active] >> 20]
            live[i + 1] = False
            sym, pos, first = sym[live], pos[live], first[live]
        p, s = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(p, kind="stable")
        return p[order], s[order]

    def encode_fragment(self, s: list[int]) -> list[int]:
        """One long fragment, by a linked list and a heap: n log n for words of any length."""
        n, rank, made = len(s), self.rank.plain, self.made.tolist()
        nxt, prev = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, s[i], s[i + 1]) for i in range(n - 1) if (r := rank.get(s[i] * SPAN + s[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if s[i] != a or j < 0 or s[j] != b:
                continue
            s[i], s[j], nxt[i] = made[r], -1, nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            for left in (prev[i], i):
                if left >= 0 and (right := nxt[left]) >= 0 and (q := rank.get(s[left] * SPAN + s[right])) is not None:
                    heapq.heappush(heap, (q, left, s[left], s[right]))
        return [x for x in s if x >= 0]

    def normalize(self, text: str) -> str:
        # Lower-casing is by single characters: no final form of sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def cut(self, text: str) -> list[str]:
        """Normalized pieces. Python's tables may be older than the library's: it does texts with characters unknown here."""
        if not any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self.pieces(self.normalize(text))
        if self.library is None:
            from tokenizers import Regex, Tokenizer, pre_tokenizers

            self.library = Tokenizer.from_file(self.path).normalizer, pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        normalizer, split = self.library
        return [x for x, _ in split.pre_tokenize_str(normalizer.normalize_str(text))]

    def _plain(self, text: str) -> bool:
        """Of characters that any table puts in the same class: then pieces never cross what str.split() splits at."""
        new = set(text) - self.known
        for c in new:
            kind = unicodedata.category(c)
            if kind == "Cn" or "\x1c" <= c <= "\x1f":
                return False
            self.known.add(c)
        return True

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Special tokens first, as they stand in the raw text; the rest normalized, cut into words and encoded."""
        parts: list[tuple[int, dict, list[str]]] = []
        for k, text in enumerate(texts):
            if not text:
                continue
            split = self.at_special.split(text) if self.at_special is not None and self.special_hint in text else [text]
            for i, part in enumerate(split):
                if i % 2:
                    parts.append((k, self.packed_special, [part]))
                elif part:
                    parts.append((k, self.chunks, self.normalize(part).split()) if self._plain(part) else (k, self.words, self.cut(part)))
        for cache in (self.chunks, self.words):
            new = set().union(*(p for _, c, p in parts if c is cache))
            new.difference_update(cache)
            size = sum(map(len, new))
            if len(cache) + len(new) > CACHE or self.held.get(id(cache), 0) + size > CACHE_CHARS:
                cache.clear()
                self.held[id(cache)] = 0
                new = set().union(*(p for _, c, p in parts if c is cache))
                size = sum(map(len, new))
            self.held[id(cache)] = self.held.get(id(cache), 0) + size
            self._learn(cache, list(new))
        out = [b""] * len(texts)
        for k, cache, p in parts:
            out[k] += b"".join(map(cache.__getitem__, p))
        for cache in (self.chunks, self.words):
            if self.held.get(id(cache), 0) > CACHE_CHARS:  # one batch of very long words
                cache.clear()
                self.held[id(cache)] = 0
        return out

    def _learn(self, cache: dict[str, bytes], new: list[str]) -> None:
        pieces = [self.pieces(x) for x in new] if cache is self.chunks else [[x] for x in new]
        words = list(set().union(*pieces))
        ids = dict(zip(words, self.encode_words(words), strict=True))
        cache.update((x, ids[p[0]] if len(p) == 1 else b"".join(map(ids.__getitem__, p))) for x, p in zip(new, pieces, strict=True))

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> str:
        """The file has no decoder: tokens joined by single spaces, special ones among them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load(path: str) -> BPE:
    """One vocabulary for each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = BPE(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary: little-endian unsigned 32-bit), n_tokens, for every row; a null text has no ids.

    Rows with equal or null ids each get their own result. A very long text is encoded whole, in memory that grows with it;
    what a worker remembers doesn't. Other columns are left out, whatever their names. No rows: no rows. One pass, no shuffle.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        ids = bpe.encode_batch(b.column(1).to_pylist())
        return pa.record_batch([b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())], [id_col, "ids", "n_tokens"])

    return map_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids binary, n_tokens long")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The input's columns and decoded (string); null ids decode to null. A column named decoded is replaced."""
    bounded_batches(encoded.sparkSession)
    encoded = encoded.drop("decoded")
    at = encoded.columns.index(ids_col)
    names = encoded.columns

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        text = pa.array([None if x is None else bpe.decode(x) for x in b.column(at).to_pylist()], pa.string())
        return pa.record_batch([*b.columns, text], [*names, "decoded"])

    return map_arrow(encoded, run, ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes) + ", decoded string")


def _digests(b: pa.RecordBatch) -> pa.RecordBatch:
    sha = lambda x: hashlib.sha256(x or b"").hexdigest()
    text = b.column(3).cast(pa.binary())
    return pa.record_batch([b.column(0), b.column(2), pa.array([sha(x) for x in b.column(1).to_pylist()]), pa.array([sha(x) for x in text.to_pylist()])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_path()
    out = decode(encode(read_table(spark, sf_dir, "documents"), path), path)
    return map_arrow(out, _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage, what a trainer reads: doc_id, n_tokens, ids for every row, as encode() has them, also for null and empty texts."""
    return encode(docs, default_path()).select("doc_id", "n_tokens", "ids")
