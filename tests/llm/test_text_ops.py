"""BPE, line dedup, mixing, language ID, WARC on small inputs with every odd case."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmap.llm import bpe, langid, linededup, mixing, warc
from quillmap.llm._common import new_path

ODD = [(1, "The cat sat\non the mat", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (None, "The cat sat", "en", "b"), (4, "x" * 30_000, "en", "b"), (4, "x" * 30_000, "en", "b"), (4, "other text", "fr", "c"), (5, " \n\t", "fr", None)]


def test_bpe_matches_library(spark, docs):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = ["", "<|endoftext|>hi<|startoftext|> it's", "Σας ΣΑΣ İ ß", "a\x1cb\x85c", "²½ Ⅷ a_b 'll", "the" * 3000, "՘a Ᲊb", *("".join(rng.choice("abeth '.,!é漢😀\n ΣḰ") for _ in range(rng.randint(1, 80))) for _ in range(200))]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, None, None, None)]
    out = bpe.decode(bpe.encode(docs(rows), path), path).collect()
    assert len(out) == len(rows)
    for r in out:
        e = lib.encode(texts[r.doc_id] if r.doc_id is not None else "", add_special_tokens=False)
        assert np.frombuffer(r.ids, "<u4").tolist() == e.ids and r.n_tokens == len(e.ids)
        assert r.decoded == lib.decode(e.ids, skip_special_tokens=False)
    assert bpe.encode(docs([]), path).count() == 0


def test_forced_boundaries():
    b = bpe.load(bpe.default_path())
    for token in list(b.vocab)[::97]:
        s = [b.vocab[x] for x in b._symbols_of(token)]
        assert all(x * bpe.SPAN + y in b.inside.plain for x, y in zip(s, s[1:], strict=False))


def test_cuckoo():
    rng = np.random.default_rng(0)
    keys = rng.integers(-(1 << 62), 1 << 62, 5000)
    f = linededup.CuckooFilter(5000)
    f.insert(keys)
    assert f.contains(keys).all() and f.contains(rng.integers(-(1 << 62), 1 << 62, 20_000)).mean() < 0.01
    g = linededup.CuckooFilter.from_bytes(f.to_bytes())
    g.delete(keys[:2500])
    assert g.contains(keys[2500:]).all() and g.contains(keys[:2500]).mean() < 0.01
    tiny = linededup.CuckooFilter(1)
    tiny.insert(keys[:60])  # far beyond its room: the stash keeps the rest
    assert tiny.contains(keys[:60]).all()


def test_cuckoo_holds_what_stays_after_deletions():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 62), 1 << 62, 20_000)
    f = linededup.CuckooFilter(4)  # keys share buckets and fingerprints in the stash
    f.insert(keys)
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all()
    g = linededup.CuckooFilter.from_bytes(f.to_bytes())
    g.delete(keys[10_000:])
    assert not g.stash and not g.table.any()
    for n in (500, 5000):  # to ten times the first capacity, and back
        h = linededup.CuckooFilter(500)
        h.insert(keys[:500])
        h.insert(keys[500:n])
        h.delete(keys[: n // 2])
        assert h.contains(keys[n // 2 : n]).all()


def test_filters_grow_from_the_counts(spark):
    key = lambda i: (i * 0x9E3779B97F4A7C15 + 7) % (1 << 64) - (1 << 63)
    rows = lambda n, hot: spark.createDataFrame([(key(i), key(i + 10**6), 12 if i < hot else 3) for i in range(n)], "k1 long, k2 long, refs long")
    small, large, less = rows(3000, 400), rows(6000, 4000), rows(6000, 100)
    filters = linededup.build_filters(small, shards=3)
    for before, after, hot in ((small, large, 4000), (large, less, 100)):
        filters = spark.createDataFrame(linededup.update_filters(filters, before, after).collect(), linededup.FILTER)
        held = {r.shard: r for r in filters.collect()}
        assert sum(r.n for r in held.values()) == hot and all(r.n <= r.room for r in held.values())
        for i in range(hot):
            k = np.array([key(i), key(i + 10**6)], np.int64)
            f = linededup.CuckooFilter.from_bytes(held[int(linededup._shard_of(k[:1], 3)[0])].filter)
            assert f.contains(k[1:]).all()
    assert linededup.update_filters(filters.limit(0), small, large).count() == linededup.SHARDS


def line_brute(rows, least=10):
    keys = lambda t: [linededup.line_key(x) for x in (t or "").encode().split(b"\n")]
    refs = Counter(k for _, t, *_ in rows for k in set(keys(t)))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        gone = [bool(k) and refs[k] >= least for k in keys(t)]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("heavy", [False, True])
def test_line_dedup_against_brute_force(spark, docs, monkeypatch, heavy, tmp_path):
    """Also with keys so heavy that they are decided where they are read, and with many shards."""
    monkeypatch.setattr(linededup, "SHARD_LINES", 50)
    rng = random.Random(11)
    common = [f"  Common {i}\t" for i in range(30)]
    n = 1500 if heavy else 300
    rows = [(i if rng.random() < 0.9 else rng.choice([None, 7]), "\n".join([*(rng.choice(common).swapcase() for _ in range(rng.randint(0, 3))), *(["the line of all"] if i % 2 else []), *(f"own {rng.randint(0, 2 * n)}" for _ in range(rng.randint(0, 3)))]), "en", "s") for i in range(n)]
    rows += [*ODD, *rows[:3], (90, "the line of all " * 2000 + "\n" + "the line of all\n" * 3000, "en", "s")]
    if heavy:
        monkeypatch.setattr(linededup, "HEAVY", 10)
    frame = docs(rows).withColumnsRenamed({"n_chars": "_drops"}).withColumn("_i", F.lit("x")).withColumn("shard", F.lit(1))
    out = linededup.dedup(frame, state=str(tmp_path / "state"))
    assert out.columns == [*frame.columns, "n_lines", "n_dropped"]
    assert sorted(repr((r.doc_id, r.n_lines, r.n_dropped, r.text)) for r in out.collect()) == line_brute(rows)
    assert spark.read.parquet(str(tmp_path / "state" / "refs")).where("refs < 10").count() > 0  # the whole counts stay
    stage = linededup.pipeline_stage(spark, docs(rows), "")
    assert stage.columns == docs([]).columns and stage.count() == len(rows) and stage.where("n_chars != length(text)").count() == 0
    assert linededup.pipeline_stage(spark, docs([]), "").count() == 0


def test_line_dedup_and_reversal(spark, docs):
    rows = [*ODD, *((100 + i, f"Common  Line\n\tCOMMON line \n own {i}\n\nhello", "en", "a") for i in range(12)), (300, " common  line\n\nrest", "en", "a")]
    out = linededup.dedup(docs(rows)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out if r.doc_id and r.doc_id >= 100}
    assert got[300].text == "\nrest" and got[300].n_dropped == 1 and got[300].n_lines == 3
    assert got[101].text == " own 1\n" and got[101].n_dropped == 3  # `common line` with one space is a key of its own, as common
    kept = sorted(repr((r.doc_id, r.text)) for r in out if not r.doc_id or r.doc_id < 100)
    assert kept == sorted(repr((i, t or "")) for i, t, _, _ in ODD)
    base, more = docs(rows[:14]), docs(rows[14:])
    state = linededup.count_references(base)
    grown = linededup.merge_references(state, added=linededup.count_references(more))
    assert sorted(grown.collect()) == sorted(linededup.count_references(docs(rows)).collect())
    back = linededup.merge_references(grown, deleted=linededup.count_references(more))
    assert sorted(back.collect()) == sorted(state.collect())
    filters = linededup.update_filters(linededup.build_filters(state), state, grown)
    assert filters.agg(F.sum("n")).first()[0] == grown.where("refs >= 10").count()
    undone = linededup.update_filters(filters, grown, back)
    assert undone.agg(F.sum("n")).first()[0] == 0
    assert linededup.dedup(docs([])).count() == 0


def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [3, 1, 2]) == pytest.approx([20, 25 / 3, 50 / 3])
    rng = random.Random(3)
    for _ in range(50):
        n = [rng.randint(0, 100) for _ in range(rng.randint(1, 8))]
        t = mixing.water_fill(n, [(3, 1, 2)[i % 3] for i in range(len(n))])
        assert sum(t) == pytest.approx(1.5 * sum(n)) and all(x <= 2 * m + 1e-9 for x, m in zip(t, n, strict=True))


def test_split_tree():
    q = np.array([7, 0, 40, 3])
    out = mixing.split_tree(q, 5, 1)
    assert (out.sum(0) == q).all() and out.sum(1).max() - out.sum(1).min() <= 2 and (out >= 0).all()
    assert (mixing.split_tree(q, 5, 1) == out).all()


def test_mixing(spark, docs):
    rng = random.Random(5)
    rows = [*ODD, *((1000 + i, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice(["a", "b", "b", "b", "c", None])) for i in range(900))]
    out = mixing.mix(docs(rows)).collect()
    assert len(out) == len(rows)
    by: dict = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies) and all(0 <= c.shard < mixing.SHARDS for c in r.copies)
        s = by.setdefault(r.source, [0, 0, r.target, r.source_size])
        s[0] += r.taken
        s[1] += r.size
    want = mixing.water_fill([by[k][1] for k in ("a", "b", "c", None)], [3, 1, 2, 3])
    for k, t in zip(("a", "b", "c", None), want, strict=True):
        assert by[k][3] == by[k][1] and by[k][2] == pytest.approx(t) and abs(by[k][0] - t) <= 1
    again = mixing.mix(docs(rows).repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    whole = mixing.pipeline_stage(spark, docs(rows), "").collect()
    texts = {(i, t) for i, t, _, _ in rows}
    assert all((r.doc_id, r.text) in texts for r in whole)
    assert abs(sum(len((r.text or "").split()) for r in whole) - 1.5 * sum(v[1] for v in by.values())) < 4 * 60
    assert mixing.mix(docs([])).count() == 0 and mixing.shuffled(mixing.mix(docs(rows))).count() == sum(len(r.copies) for r in out)


def test_mixing_against_brute_force(spark, docs):
    """What each document gives, by a plain walk over permuted blocks; only the hashes are Spark's."""
    rng = random.Random(6)
    rows = [*ODD, *((1000 + i, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice(["a", "b", "b", "b", "c", None])) for i in range(700))]
    frame = docs(rows)
    blocks, seed = 16, 9
    key = F.xxhash64("doc_id", "text", F.lit(seed))
    hashed = frame.select("doc_id", "source", "text", key.alias("rk"), F.xxhash64(F.lit(seed + 1), key).alias("turn"), F.xxhash64(F.lit(seed), F.pmod(key, F.lit(blocks)).cast("int")).alias("order")).collect()
    size = lambda t: len((t or "").encode().split())
    sources = sorted({r.source for r in hashed}, key=lambda s: (s is None, s or ""))
    total = [sum(size(r.text) for r in hashed if r.source == s) for s in sources]
    want = []
    for s, n, target in zip(sources, total, mixing.water_fill(total, [(3, 1, 2)[i % 3] for i in range(len(sources))]), strict=True):
        passes, left = divmod(round(target), n) if n else (0, 0)
        for r in sorted((r for r in hashed if r.source == s), key=lambda r: (r.order, r.rk % blocks, r.turn, r.rk, r.doc_id is not None, r.doc_id or 0)):
            part = min(left, size(r.text))
            left -= part
            want.append((r.doc_id, size(r.text), s, passes * size(r.text) + part))
    out = mixing.mix(frame, blocks=blocks, shards=5).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.size, r.source, r.taken)) for r in out)
    assert all(r.taken == sum(c.words for c in r.copies) for r in out) and {c.shard for r in out for c in r.copies} == set(range(5))


def test_shards_read_back(spark, docs, monkeypatch, tmp_path):
    """The pipeline's stage writes one file for each shard that the tree filled, in shuffled order."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rng = random.Random(9)
    rows = [*ODD, *((1000 + i, f"n{i} " + "w " * rng.randint(0, 60), "en", rng.choice(["a", "b", "b", None])) for i in range(600))]
    frame = docs(rows).withColumn("shard", F.lit("mine")).withColumn("copies", F.lit(1))
    out = mixing.pipeline_stage(spark, frame, "")
    assert out.columns == frame.columns
    out.write.parquet(str(tmp_path / "shards"))
    mixed, shards = mixing._mix(frame, "doc_id", "text", "source", mixing.WEIGHTS, 1.5, 2.0, None, None, 9, True, ["text"])
    want: dict = {}
    for r in mixed.collect():
        for c in r.copies:
            want.setdefault(c.shard, []).append((c.place, r.doc_id, r.keep_text))
    files = spark.read.parquet(str(tmp_path / "shards")).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"), "doc_id", "text").orderBy("f", "n").collect()
    got: dict = {}
    for r in files:
        got.setdefault(r.f, []).append((r.doc_id, r.text))
    assert shards > 16 and len(got) == len(want)
    assert sorted(map(repr, got.values())) == sorted(repr([(i, t) for _, i, t in sorted(w, key=lambda x: x[0])]) for w in want.values())
    assert mixing.pipeline_stage(spark, docs([]), "").count() == 0


def test_langid(spark, docs):
    words = {"en": "the of and to in that is was for on", "fr": "le la et les des une que est pour dans", "de": "der die und das ist nicht ein mit von zu"}
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(words[la].split()) for _ in range(rng.randint(3, 200))), la, "s") for i in range(300) for la in [rng.choice(list(words))]]
    odd = [(9001, None, "en", None), (9002, "", None, None), (9003, "123 !!", "fr", None), (9004, "the of and to in " * 50_000, None, None), (None, "der die und das", None, None)]
    frame = docs(rows + odd)
    model = langid.fit(frame.where(~langid.held_out()))
    out = langid.identify(frame, model, keep=("lang",)).collect()
    assert len(out) == len(rows) + 5 and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r for r in out}
    assert [got[i].lang_pred for i in (9001, 9002, 9003, 9004, None)] == ["und", "und", "und", "en", "de"]
    assert np.mean([got[i].lang_pred == la for i, _, la, _ in rows]) > 0.98
    assert langid.fit(docs([])) is None and {r.lang_pred for r in langid.identify(frame, None).collect()} == {"und"}
    single = langid.fit(docs([(1, "abc", "en", None)]))
    assert langid.identify(docs([(1, "zzz", None, None)]), single).first().lang_pred == "en"
    code = langid.codewords(5)
    assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= 4
    stay = langid.pipeline_stage(spark, frame, "")
    assert stay.columns == frame.columns and stay.count() == len(rows) + 2


def lang_brute(rows):
    """Histograms by plain counting, then every bit and codeword by plain sums."""
    import math

    fold = lambda x: x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32

    def grams(t):
        b = [32, 32, *map(fold, t.encode())]
        return [(((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 0x9E3779B1) & 0xFFFFFFFF) >> 17 for i in range(len(b) - 2)]

    counts: dict = {}
    for _, t, lang, _ in rows:
        if t is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(t))
    langs = sorted(counts)
    code = langid.codewords(len(langs))
    p = {x: {g: (counts[x][g] + 0.5) / (sum(counts[x].values()) + 0.5 * langid.BUCKETS) for g in range(langid.BUCKETS)} for x in langs}
    weight, shift, half = [], [], []
    for j in range(code.shape[1]):
        up, down = ([x for k, x in enumerate(langs) if code[k, j] == s] for s in (1, -1))
        w = [math.log(sum(p[x][g] for x in up) / len(up)) - math.log(sum(p[x][g] for x in down) / len(down)) for g in range(langid.BUCKETS)]
        at = {x: sum(p[x][g] * w[g] for g in range(langid.BUCKETS)) for x in langs}
        lo, hi = min(at[x] for x in up), max(at[x] for x in down)
        weight.append(w)
        shift.append((lo + hi) / 2)
        half.append(max((lo - hi) / 2, 0.02))
    out = {}
    for i, t, _, _ in rows:
        if not t or not any(c.isalpha() for c in t):
            out[i] = ("und", 0.0)
            continue
        g = grams(t)
        margin = [(sum(weight[j][x] for x in g) / len(g) - shift[j]) / half[j] for j in range(code.shape[1])]
        loss = [sum(h / sum(half) * math.log1p(math.exp(-6 * m * c)) for h, m, c in zip(half, margin, row, strict=True)) for row in code]
        e = [math.exp(4 * (min(loss) - x)) for x in loss]
        out[i] = (langs[loss.index(min(loss))], max(e) / sum(e))
    return out


def test_langid_against_brute_force(spark, docs):
    words = {"en": "the of and to in that is", "fr": "le la été des une que", "de": "der die und das für", "eo": "la kaj estas ĉiu"}
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(words[la].split()) for _ in range(rng.randint(1, 12))), la, "s") for i in range(60) for la in [rng.choice(list(words))]]
    rows += [(100, "The kaj", None, "s"), (101, "?", "en", "s"), (102, "été", "fr", "s"), (103, None, "en", "s"), (104, "", "de", "s")]
    frame = docs(rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(frame, langid.fit(frame)).collect()}
    want = lang_brute(rows)
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-4)  # weights are kept in single precision


def test_many_labels(spark, docs, monkeypatch):
    """More labels than a task holds; each has a word of its own."""
    monkeypatch.setattr(langid, "HELD", 16)
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}zq " * 6, f"l{i:03}", "s") for i in range(300)]
    frame = docs(rows)
    model = langid.fit(frame)
    assert len(model.langs) == 300 and len(np.unique(model.code, axis=0)) == 300
    got = langid.identify(frame, model, keep=("lang",)).collect()
    assert np.mean([r.lang_pred == r.keep_lang for r in got]) > 0.9
    assert len(np.unique(langid.codewords(3000), axis=0)) == 3000


def test_language_stage(spark, docs):
    rows = [(i, "the cat and the dog sat in the house of the man", "en", "s") for i in range(20)] + [(30, "123 !?", "en", "s"), (31, "", None, None), (32, None, "fr", "s"), (33, "Ω", None, "s")]
    frame = docs(rows).withColumn("lang_pred", F.lit("x")).withColumn("rejected", F.lit(True))
    out = langid.pipeline_stage(spark, frame, "")
    assert out.columns == frame.columns and sorted(r.doc_id for r in out.collect()) == [*range(20), 33]
    blind = docs([(i, t, None, s) for i, t, _, s in rows])  # nothing learned: every text with a letter stays
    assert langid.pipeline_stage(spark, blind, "").count() == 21 and langid.pipeline_stage(spark, docs([]), "").count() == 0


def test_warc_round_trip(spark):
    big, other = "é" * 200, "<p>" + "x" * 150
    rows = [(5, "http://a/b?c=1", big, 1), (2, "http://é/\r\nX: y", big, 1), (9, None, big, 1), (1, "u", "small", 1), (3, "u", "small", 1), (4, "u", None, 1), (None, "n", other, 1), (7, "n", other, 1), (8, "d", "z" * 300, 1), (8, "d", "z" * 300, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload long")
    manifest = warc.write_archives(pages, new_path(spark, "test"))
    assert manifest.agg(F.sum("captures")).first()[0] == len(rows)
    records = warc.read_records(manifest)
    kinds = {r.record_type: r.n for r in records.groupBy("record_type").agg(F.count("*").alias("n")).collect()}
    assert {r.n_records for r in warc.assemble(records).select("n_records").collect()} == {3}
    assert kinds["request"] == kinds["metadata"] == len(rows) and kinds["response"] + kinds["revisit"] == len(rows)
    out = warc.resolve_revisits(warc.assemble(records)).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        page = r.metadata.get("pageId")
        got.setdefault(page and int(page), []).append((r.response.record_type, r.refers_to, None if r.response.payload is None else r.response.payload.decode()))
        assert r.request.head.startswith("GET /")
    assert got == {
        2: [("response", None, big)], 5: [("revisit", 2, None)], 9: [("revisit", 2, None)], 1: [("response", None, "small")], 3: [("response", None, "small")], 4: [("response", None, "")],
        7: [("response", None, other)], None: [("revisit", 7, None)], 8: [("response", None, "z" * 300)] * 2,
    }
    digests = {r.response.payload_digest for r in out if r.metadata.get("pageId") == "5"}
    assert digests == {"sha256:" + hashlib.sha256(big.encode()).hexdigest()}
    assert warc.read_records(warc.write_archives(pages.limit(0), new_path(spark, "test"))).count() == 0
