"""The stages one after another over the driver's smallest tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_stages(spark):
    import corpus_pipeline
    from quillmap.llm import bpe
    from quillmap.llm._common import read_table, written

    docs = read_table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        kept[name] = docs
    assert kept["line_dedup"].count() == kept["language_id"].count() <= before
    ids = [r.doc_id for r in kept["near_dedup"].collect()]
    assert len(set(ids)) == len(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    b = bpe.load(bpe.default_path())
    assert len(last) == docs.count() and all(b.encode(texts[r.doc_id]) == bytes(r.ids) for r in last)


def odd_rows():
    rows = [(i, f"The cat {i} sat on the mat and looked at the house\nfooter of all\n" + " ".join(f"word{i}x{j}" for j in range(12)), "en", "a" if i % 3 else "b") for i in range(40)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, " \n", "fr", None), (103, "123 !!", "en", "a"), (None, "le chat est dans la maison", "fr", None), (None, None, None, None)]
    rows += [(104, "same text here for all", None, "b")] * 3 + [(104, "another text with that id", "en", "b"), (105, "long " * 20_000 + "x" * 30_000, "en", "a")]
    return rows


def test_run_on_odd_rows(spark, docs, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, clashing names; each stage keeps what it is to keep."""
    import corpus_pipeline
    from quillmap.llm import bpe
    from quillmap.llm._common import shared_dir

    frame = docs(odd_rows())
    for k in ("_rk", "_key", "_n", "shard", "copies", "lang_pred"):
        frame = frame.withColumn(k, frame["source"])
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    b = bpe.load(bpe.default_path())
    got = {(r.doc_id, b.decode(bytes(r.ids))) for r in out}
    assert not {i for i, _ in got} & {100, 101, 102, 103} and (None, b.decode(b.encode("le chat est dans la maison"))) in got
    assert not any("footer" in t for _, t in got) and len({t for i, t in got if i == 104}) == 2
    assert {i for i, _ in got} <= {i for i, *_ in odd_rows()} and all(r.n_tokens * 4 == len(r.ids) for r in out)
    left = [f for f in os.listdir(shared_dir(spark).removeprefix("file://")) if f.startswith("quillmap-stage-") and "bpe" not in f]
    assert not left


def test_run_on_no_rows(spark, docs, tmp_path):
    import corpus_pipeline

    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_bpe_stage(spark, docs):
    from quillmap.llm import bpe

    rows = odd_rows()
    out = bpe.pipeline_stage(spark, docs(rows), "").collect()
    b = bpe.load(bpe.default_path())
    assert sorted(map(repr, ((r.doc_id, bytes(r.ids)) for r in out))) == sorted(map(repr, ((i, b.encode(t or "")) for i, t, *_ in rows)))
    assert bpe.pipeline_stage(spark, docs([]), "").count() == 0


def test_bpe_memory_is_bounded():
    from quillmap.llm import bpe

    b = bpe.BPE(bpe.default_path())
    for k in range(3):
        word = "".join(chr(97 + (i * i + k) % 26) for i in range(400_000))
        assert bpe.load(bpe.default_path()).decode(b.encode(word)).replace(" ", "").replace("</w>", "")[:1000] == word[:1000]
    before = bpe.CACHE_CHARS
    try:
        bpe.CACHE_CHARS = 1000
        b.encode_batch(["a" * 5000, "some words " + "b" * 900])
        assert sum(map(len, [*b.chunks, *b.words])) <= 1000
    finally:
        bpe.CACHE_CHARS = before
