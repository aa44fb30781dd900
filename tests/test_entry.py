"""The driver's contract, and a sample of the catalog against SQL."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SOME = ["clean_title", "title_candidates_exploded", "first_writer_lookup", "concept_variants", "target_index", "exact_uri_relookup", "vector_topk", "vector_margin", "ladder_verdict", "ce_rerank_argmax", "title_ladder", "export_flatten", "calibration_margin_grid",
        "pair_sample", "skill_pair_sample", "band_samples", "margin_grid_samples", "margin_deciles", "pipeline_summary", "repeated_and_null_ids", "whole_run", "csv_postings", "csv_corpus", "csv_export", "taxonomy_counts", "stored_run"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def normal(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("None" if x is None or x != x else f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in df.astype(object).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", SOME)
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    assert normal(got) == normal(want) and len(got)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twentieth_against_brute_force(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(3)
    ids, m = np.arange(100, 190), rng.integers(-3, 4, (90, 8)).astype(np.float32)  # no id below 100; ties
    spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, m, strict=True)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.vec_id, r["rank"]): (r.label_idx, r.score) for r in entry.queries()["vector_topk"](spark, str(tmp_path)).collect()}
    want = {}
    for q in range(0, 90, 20):
        s = m[q] @ m.T
        order = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        want |= {(int(ids[q]), n + 1): (int(ids[j]), float(s[j])) for n, j in enumerate(order)}
    assert got == want
