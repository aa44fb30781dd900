"""The joins against brute force: near sets, repeated passages, vectors, neighbours, language model."""

import math
import os
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quillmap.llm import _common, crosspoly, gru, kmtree, lmscore, nearset, suffixes

SF = "/root/testdata/sf0.01"


def near_brute(rows, k, num, den):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and den * n >= num * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append((r[0] is None, r[0] or 0))
    return [(len(sets[i]), min(low[find(i)])) for i in range(len(rows))]


def family(rng, n, edits, words=60):
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = str(rng.random())
        yield " ".join(w)


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates(spark, docs, monkeypatch, small):
    if small:  # families larger than a node and a task
        monkeypatch.setattr(nearset, "NODE", 6)
        monkeypatch.setattr(nearset, "TASK_DOCS", 15)
    rng = random.Random(7)
    texts = [t for _ in range(10) for t in family(rng, rng.randint(1, 12), 4)] + list(family(rng, 70, 7, 40))
    texts += ["", " \n", None, "one", "ONE", "one two", "x " * 5000, "X  " * 5000, *["tie tie tie tie"] * 4]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "one", "en", "s"), (3, "another text of three", "en", "s")]
    for k, num in ((3, 85), (5, 80)):
        out = nearset.near_duplicates(docs(rows), k, num, 100).collect()
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.lead.none, r.lead._id or 0) for r in out)
        assert got == sorted((r[0] is None, r[0] or 0, n, *low) for r, (n, low) in zip(rows, near_brute(rows, k, num, 100), strict=True))
    assert nearset.near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("tasks", [1, 7])
def test_components(spark, monkeypatch, tasks):
    """Chains, hubs and cliques, in one task and in rounds with hubs kept out of the joins; repeated and looped edges."""
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001 + i) for i in range(900)] + [(5000 + i, 4999) for i in range(500)] + [(rng.randrange(6000, 6400), rng.randrange(6000, 6400)) for _ in range(300)]
    pairs += pairs[::7] + [(9, 9), (299, 5100)]
    rng.shuffle(pairs)
    if tasks > 1:
        monkeypatch.setattr(_common, "TASK_EDGES", len(pairs) // tasks)
        monkeypatch.setattr(_common, "HUBS", 8)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = sorted((i, find(i)) for i in root if find(i) != i)
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(12)
    assert sorted(tuple(r) for r in _common.components(edges).collect()) == want
    blobs = spark.createDataFrame([(b"%05d" % a, b"%05d" % b) for a, b in pairs], "a binary, b binary").repartition(12)
    assert sorted((int(r.node), int(r.component)) for r in _common.components(blobs).collect()) == want
    assert _common.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("num", [80, 85, 95])
def test_trees_reach_the_target(num):
    trees, s = nearset.trees_for(num / 100), num / 100
    assert (1 - s**nearset.DEPTH) ** trees <= 1e-4
    assert len(nearset.minwise(np.arange(9, dtype=np.uint64), trees)) == trees * nearset.DEPTH


def test_near_stage(spark, docs):
    rng = random.Random(1)
    rows = [(i, t, "en", "s") for i, t in enumerate([*family(rng, 9, 2), "alone in the world", "", None])] + [(50, "same row here", "en", "s")] * 3
    out = nearset.pipeline_stage(spark, docs(rows), "")
    want = {low for r, (_, low) in zip(rows, near_brute(rows, 5, 80, 100), strict=True)}
    assert sorted((r.doc_id is None, r.doc_id) for r in out.collect()) == sorted(want) and out.columns == docs([]).columns


def repeats_brute(rows):
    first = {}
    for i, b in rows:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, math.inf), math.inf if i is None else i)
    out = []
    for i, b in rows:
        m = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (math.inf if i is None else i):
                m[p : p + 50] = b"\1" * 50
        out.append((i, len(b), sum(m), sum(1 for p in range(len(b)) if m[p] and not (p and m[p - 1])), bytes(x for x, y in zip(b, m, strict=True) if not y)))
    return out


def test_suffix_array():
    rng = random.Random(1)
    for t in range(200):
        x = np.array([rng.choice((0, 1, 2)) if t % 2 else rng.choice(b"abcab\xff") for _ in range(rng.randint(1, 70))], np.uint8)
        b = x.tobytes()
        order = suffixes.suffix_array(x, 80)
        assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        for d, i, j in zip(suffixes.common_prefixes(x, order, 80).tolist()[1:], order[:-1].tolist(), order[1:].tolist(), strict=True):
            assert b[i : i + d] == b[j : j + d] and b[i : i + d + 1] != b[j : j + d + 1]


def test_segments_of_any_number():
    """Rows of one anchor and two contexts in segments far beyond 2^19, and beyond 2^32."""
    n = 50
    seg = np.concatenate([np.arange(n) + 600_000, np.arange(n) + (7 << 32)])
    ctx = np.arange(2 * n, dtype=np.int64) % 2 + (1 << 61)
    out = suffixes._judge(np.full(2 * n, -5, np.int64), seg, ctx << 1, np.arange(2 * n, dtype=np.int64))
    assert sorted(out[0].tolist()) == sorted(seg.tolist())
    for s, c, first, many, gives in zip(out[0].tolist(), out[2].tolist(), out[3].tolist(), out[4].tolist(), out[5].tolist(), strict=True):
        assert c == ctx[seg == s][0] and first == c - (1 << 61) and many and gives == (s in (600_000, 600_001))


@pytest.mark.parametrize("size", [("SEGMENT_DOCS", 40), ("SEGMENT_BYTES", 3000)])
def test_repeated_passages(spark, docs, monkeypatch, size):
    monkeypatch.setattr(suffixes, *size)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 40))) for _ in range(12)]
    texts = []
    for _ in range(150):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            lo = rng.randrange(len(p))
            parts += [p[lo : lo + rng.randint(30, 200)], word()]
        texts.append(" ".join(parts))
    texts += ["a" * 49, "a" * 50, "a" * 51, "b" * 5000, "ab" * 3000, "b" * 4000 + "c", "", None, texts[3], texts[3], passages[0]]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[5], "en", "s"), (None, texts[5], "en", "s"), (7, texts[9], "en", "s"), (7, texts[9], "en", "s")]
    rng.shuffle(rows)
    out = suffixes.remove_repeats(docs(rows)).collect()
    want = repeats_brute([(i, (t or "").encode()) for i, t, *_ in rows])
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in out)
    assert suffixes.remove_repeats(docs([])).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vec string")


def some_vectors(rng, n, dim=24):
    out = []
    centre = rng.standard_normal((6, dim))
    for i in range(n):
        c = int(rng.integers(0, 8))
        v = centre[c] + rng.standard_normal(dim) * rng.choice([0.02, 0.12]) if c < 6 else rng.standard_normal(dim)
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 2)) if i % 40 else None, "x"))
    out += [(n + 1, None, 1, "x"), (n + 2, [0.0] * dim, 1, "x"), (n + 3, [float("nan")] + [1.0] * (dim - 1), 1, "x"), (n + 4, [None] + [1.0] * (dim - 1), 1, "x"), (n + 5, [float("inf")] * dim, 1, "x"), (n + 6, [1.0, 2.0], 1, "x"), (n + 7, [], 1, "x")]
    return out + [(n + 8 + i, out[0][1], 1, "x") for i in range(5)] + [(n + 20, [2.0, 4.0], 1, "x")]


def fine(r):
    return r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])


def test_crosspoly(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((5, 16))
    assert np.allclose((crosspoly.hadamard(x) ** 2).sum(1), (x**2).sum(1)) and np.allclose(crosspoly.hadamard(crosspoly.hadamard(x)), x)
    monkeypatch.setattr(crosspoly, "BLOCK", 8)
    rows = some_vectors(rng, 400)
    n = len(rows)
    unit = [np.array(r[1], float) / np.linalg.norm(r[1]) if fine(r) and r[2] is not None else None for r in rows]
    links, root = [0] * n, list(range(n))
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    low = {}
    for i, r in enumerate(rows):
        low[root[i]] = min(low.get(root[i], 1 << 60), r[0])
    out = {r.vec_id: r for r in crosspoly.linked(vectors(spark, rows)).collect()}
    assert len(out) == n and max(links) > 16
    for i, r in enumerate(rows):
        assert (out[r[0]].n_links, out[r[0]].component_id, out[r[0]].kept) == (links[i], low[root[i]], low[root[i]] == r[0])
    assert crosspoly.linked(vectors(spark, [])).count() == 0
    assert crosspoly.linked(vectors(spark, [(None, [1.0, 0.0], 1, "x"), (4, [1.0, 0.0], 1, "x")])).where("n_links = 1").count() == 2


def test_kmtree(spark, monkeypatch):
    monkeypatch.setattr(kmtree, "LEAF_ROWS", 40)
    monkeypatch.setattr(kmtree, "BLOCK_ROWS", 16)
    rows = some_vectors(np.random.default_rng(5), 900)
    out = kmtree.search(vectors(spark, rows), every=20).collect()
    good = [r for r in rows if fine(r) and len(r[1]) == 24]
    x, ids = np.array([r[1] for r in good], float), np.array([r[0] for r in good])
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    hit = total = 0
    for q in ids[ids % 20 == 0].tolist():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = ids[np.lexsort((ids, d))[:10]].tolist()
        assert len(got[q]) == 10 and got[q] == sorted(got[q], key=lambda y: (y[1], y[0])) and q not in [v for v, _ in got[q]]
        assert all(s == pytest.approx(d[ids == v][0], abs=1e-12) for v, s in got[q])
        hit, total = hit + len(set(want) & {v for v, _ in got[q]}), total + 10
    assert hit / total >= 0.9
    few = kmtree.search(vectors(spark, [(0, [1.0, 2.0], 1, "x"), (1, [1.0, 3.0], 1, "x"), (2, [1.0, 1.0], 1, "x")]), every=100).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert kmtree.search(vectors(spark, [])).count() == 0 and kmtree.search(vectors(spark, [(0, [1.0], 1, "x")])).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    g = gru.GRU(rng.integers(1, 50, 40).astype(float), rng.integers(1, 9, 3).astype(float), hidden=5, width=8)
    g.p = {k: v.astype(np.float64) for k, v in g.p.items()}
    x, y, start = rng.integers(0, 43, (3, 6)), rng.integers(0, 43, (3, 6)), rng.standard_normal((3, 5))

    def loss():
        h, total = start, 0.0
        for s in range(6):
            h = g.step(x[:, s], h * (x[:, s] != 0)[:, None])[0]
            total -= g.log_probs(h, y[:, s]).sum()
        return total / 18

    grad, rows, _ = g._window(x, y, start)
    assert rows.tolist() == np.unique(x).tolist()
    grad["x"], part = np.zeros_like(g.p["x"]), grad["x"]
    grad["x"][rows] = part
    for k, v in g.p.items():
        for _ in range(8):
            i = tuple(rng.integers(0, s) for s in v.shape)
            if v[i] > -1e8:
                old, e = v[i], 1e-5
                v[i] = old + e
                up = loss()
                v[i] = old - e
                down = loss()
                v[i] = old
                assert abs((up - down) / 2 / e - grad[k][i]) < 1e-6


def test_windows_carry_state():
    rng = np.random.default_rng(1)
    g = gru.GRU(np.ones(60), np.ones(3), hidden=8, width=16)
    texts = [rng.integers(1, 63, n) for n in (0, 1, 31, 32, 33, 200)]
    got = g.score(texts, window=32)
    for t, s in zip(texts, got, strict=True):
        h, last, total = np.zeros((1, 8), np.float32), np.array([0]), 0.0
        for w in [*t.tolist(), 0]:
            h = g.step(last, h)[0]
            last = np.array([w])
            total += g.log_probs(h, last)[0]
        assert s == pytest.approx(total, rel=1e-4)
    one = np.array([[0.1] * 8], np.float32)
    every = sum(math.exp(g.log_probs(one, np.array([i]))[0]) for i in range(63))
    assert every == pytest.approx(1, rel=1e-4)  # listed words and the classes of others


def test_scoring_works_in_pieces_whatever_the_number_of_texts():
    """Neither the states nor the outputs of all texts are held at once, and the pieces change no score."""
    rng = np.random.default_rng(3)
    g = gru.GRU(rng.integers(1, 90, 3000).astype(float), np.ones(16), width=64)
    texts = [rng.integers(1, 3016, n) for n in rng.integers(0, 80, 4000)]
    tracemalloc.start()
    got = g.score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25_000_000
    for i in range(0, 4000, 500):
        assert g.score([texts[i]])[0] == pytest.approx(got[i], rel=1e-5)


def test_word_keys_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(6)
    texts = ["", None, "x" * 300, "é. .é a-b - a. longer-than-8 LONGER-THAN-8", *("".join(rng.choice("aB .é-\n9漢") for _ in range(rng.randint(0, 60))) for _ in range(300))]
    raw = _common.utf8_buffer(pa.array(texts))
    whole = lmscore.word_keys(*raw)
    monkeypatch.setattr(lmscore, "CHUNK", 50)
    assert all((a == b).all() for a, b in zip(lmscore.word_keys(*raw), whole, strict=True))
    letter = lambda c: c in range(97, 123) or c in range(65, 91)
    words = [w for t in texts for w in (t or "").encode().split()]
    want = [any(c >= 128 for c in w) + 2 * (w[-1] < 128 and not letter(w[-1])) + 4 * any(c < 128 and not letter(c) for c in w[:-1]) + 8 * (len(w) > 8) for w in words]
    assert (whole[0] & 15).tolist() == want and whole[1].tolist() == np.cumsum([0, *(len((t or "").encode().split()) for t in texts)]).tolist()


def test_scores(spark, docs, monkeypatch):
    monkeypatch.setattr(lmscore, "SENT", 30)
    monkeypatch.setattr(lmscore, "LISTED", 12)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(("The", "cat", "dog,", "été", "x1")) + (str(rng.randint(0, 40)) if rng.random() < 0.4 else "") for _ in range(rng.randint(0, 50))), "en", "s") for i in range(200)]
    rows += [(500, None, None, None), (501, "", "en", "s"), (None, "the cat", "en", "s"), (5, "cat cat17 cat17", "en", "s"), (5, "cat cat17 cat17", "en", "s"), (502, "never " * 3000, "en", "s")]
    frame = docs(rows)
    out = lmscore.score(frame, *lmscore.learn(frame.where(lmscore.training()))).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i is None, i or 0, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, t, *_ in rows for w in [tokens(t)])
    assert want == sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert all(r.score < 0 for r in out)
    nothing = lmscore.score(frame, *lmscore.learn(docs([]))).collect()
    assert len(nothing) == len(rows) and all(r.n_known == 0 for r in nothing) and lmscore.score(docs([]), *lmscore.learn(docs([]))).count() == 0


def test_model_learns_from_all_text(spark, docs, monkeypatch):
    monkeypatch.setattr(lmscore, "LISTED", 8)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]

    def text(i):
        at = rng.randrange(40)
        return " ".join(words[(at + j) % 40] for j in range(20 + i % 30))

    rows = [(i, text(i), "en", "s") for i in range(2000)]
    frame = docs(rows).repartition(3)
    counts, lexicon, model = lmscore.learn(frame)
    assert lexicon.words == 41 and lexicon.n > 8 * 40 * 40  # listed words grow beyond LISTED: isqrt(n) of them here
    out = lmscore.score(frame, counts, lexicon, model).agg({"score": "sum", "n_tokens": "sum"}).first()
    assert out["sum(score)"] / out["sum(n_tokens)"] > -1.2  # a uniform guess among 40 words is -1.6
    ids = spark.createDataFrame([(i % 2, np.arange(n, dtype=np.int32).tobytes()) for i, n in enumerate((0, 1, 5, 40, 3))], "round int, codes binary").repartition(3)
    seen = lmscore.train(ids, gru.GRU(np.ones(40), np.ones(16)), np.arange(60, dtype=np.int32), 54)
    assert sum(seen) == 54 and seen[:2] == [1 + 6 + 4, 2 + 41]  # each token, ends included, once


def test_documents_beyond_any_sample_change_the_model(docs):
    """A corpus of more than 300,000 tokens, then one more document with a regularity of its own: its score rises."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(1000)), "en", "s") for i in range(320)]
    own = (999, "w1 w2 w3 w4 w5 " * 4000, "en", "s")
    scores = []
    for more in ([], [own]):
        learned = lmscore.learn(docs(rows + more).coalesce(1))
        assert learned[1].n > 300_000
        scores.append(lmscore.score(docs([own]), *learned).first())
    assert scores[1].score > 0.8 * scores[0].score and scores[1].train_tokens > scores[0].train_tokens


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_held_out_scores_beat_the_base(spark):
    rows = lmscore.op4_lm_score(spark, SF).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > 0.97 * rows["sum(base_score)"]
