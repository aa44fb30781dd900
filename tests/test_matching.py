"""Sources, lookups, ladders, export and reports on small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmap.config import Config, Ladder
from quillmap.operators import exact, export, ladder, lookup, reports, vectors
from quillmap.plans import pipeline
from quillmap.sources import stores, tables

RAW = "conceptUri string, preferredLabel string, altLabels string, hiddenLabels string, description string, code string, iscoGroup string, ord long"


def taxonomy(spark):
    return spark.createDataFrame([
        ("A", "statistician", "data analyst", None, "counts", "1", "0110", 0),
        ("B", "data analyst", "bi analyst\n BI  analyst!", "manager\n!!", None, "2", "0120", 1),
        ("C", "Nurse", None, None, None, "3", "2221", 2),
        ("C", "nurse practitioner", "nurse", None, "heals", "3", "2222", 3),
    ], RAW)


def test_lookup_and_relookup(spark):
    raw = taxonomy(spark)
    found, concepts = tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION)
    got = {r.label_key: r.uri for r in found.collect()}
    assert got == {"statistician": "A", "data analyst": "A", "bi analyst": "B", "manager": "B", "": "B", "nurse": "C", "nurse practitioner": "C"}
    rows = {r.uri: r for r in concepts.collect()}
    assert rows["C"].canonical == "nurse practitioner" and rows["C"].pos == 2 and rows["B"].variants == ["!!", "BI  analyst!", "bi analyst", "data analyst", "manager"]
    targets = exact.with_canonical(found, concepts)
    titles = spark.createDataFrame([("bi analyst",), ("data analyst",), ("manager",), (None,), (" ",)], "title string")
    out = exact.canonical_uri(exact.match_titles_exact(titles, targets), found)
    assert {r.title: (r.occupation, r.uri) for r in out.collect()} == {"bi analyst": ("data analyst", "A"), "data analyst": ("statistician", "A")}
    raw_only = exact.match_titles_exact(titles, targets, use_candidates=False)
    assert {r.title for r in raw_only.collect()} == {"bi analyst", "data analyst", "manager"}


def test_index(spark):
    concepts = tables.concepts(taxonomy(spark), tables.OCCUPATION)
    rows = lookup.target_index(concepts, True).orderBy("label_idx").collect()
    assert [(r.label_idx, r.label, r.uri) for r in rows] == [(0, "data analyst", "A"), (1, "statistician", "A"), (2, "BI  analyst!", "B"), (3, "nurse", "C"), (4, "nurse practitioner", "C")]
    assert any(r.label == "manager" for r in lookup.target_index(concepts).collect())


def test_csv_source(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes('job_link,job_title,other\n1,NA,x\n2,None\n3, pad ,y,more\n4,"a ""q"" b",z\n5,"two\nlines",z\n6,Nurse – RN,z\n'.encode())
    rows = {r.job_link: r.job_title for r in tables.read_csv(spark, str(p), ["job_link", "job_title"], tables.LATIN1).collect()}
    assert rows == {"1": None, "2": None, "3": " pad ", "4": 'a "q" b', "5": "two\nlines", "6": "Nurse â\x80\x93 RN"}
    assert [r.job_id for r in tables.load_postings(spark, str(p), 3).collect()] == ["3"]
    with pytest.raises(FileNotFoundError):
        tables.require_files([str(p), str(tmp_path / "none.csv")])


def test_several_csv_files_are_numbered_as_one(spark, tmp_path):
    folder = tmp_path / "several"
    folder.mkdir()
    for name, rows in (("b.csv", ["4,d", "5,e", "6,f"]), ("a.csv", ["1,NA", "2,b", '3,"c\nc"']), ("c.csv", ["7,g"] * 40)):
        (folder / name).write_text("job_link,job_title\n" + "\n".join(rows) + "\n")
    got = tables.read_csv(spark, str(folder), ["job_link"]).orderBy("ord").collect()
    assert [r.ord for r in got] == list(range(46)) and [r.job_link for r in got[:6]] == list("123456")
    assert sorted(r.job_id for r in tables.load_postings(spark, str(folder), 5).collect()) == ["2", "3", "4", "5"]


def test_first_writer_keeps_null(spark):
    cells = spark.createDataFrame([("a", None, 0), ("a", "x", 1), ("b", "Y , z", 2)], "job_id string, job_skills string, ord long")
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "job_id string")
    out = tables.with_skills(rows, tables.first_per_key(cells, "job_id", "job_skills"))
    assert {r.job_id: r.skills for r in out.collect()} == {"a": [], "b": ["y", "z"], "c": []}


def test_top_k_passes_and_edges(spark, monkeypatch):
    rng = np.random.default_rng(0)
    q, m = rng.standard_normal((20, 8)), rng.standard_normal((50, 8))
    m[7] = m[3]
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "q int, embedding array<double>")
    ls = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "label_idx int, embedding array<double>")
    want = {(i, int(j)) for i in range(20) for j in np.argsort(-np.round(q[i] @ m.T, 9), kind="stable")[:4]}
    for size in (1 << 20, 8 * 8 * 7):
        assert {(r.q, r.label_idx) for r in vectors.top_k(qs, ls, 4, pass_bytes=size).collect()} == want
    one = vectors.best_with_margin(vectors.top_k(qs, ls.where("label_idx = 0"), 5), "q").collect()
    assert len(one) == 20 and all(r.margin is None for r in one)
    none = spark.createDataFrame([(99, None)], "q int, embedding array<double>")
    assert vectors.top_k(none, ls, 4, pass_bytes=100).count() == vectors.top_k(none, ls, 4).count() == 0
    monkeypatch.setattr(vectors, "PART_ROWS", 6)
    assert {(r.q, r.label_idx) for r in vectors.top_k(qs, ls, 4, pass_bytes=8 * 8 * 7).collect()} == want
    assert vectors.top_k(qs, ls.where("label_idx < 0"), 5).count() == 0


def test_verdict(spark):
    rows = spark.createDataFrame([(0, 0.90, 0.0), (1, 0.86, 0.25), (2, 0.86, 0.10), (3, 0.84, 0.5), (4, 0.86, None), (5, 0.95, None)], "i int, score double, margin double")
    got = {r.i: r.m for r in rows.select("i", ladder.verdict(F.col("score"), F.col("margin"), Ladder()).alias("m")).collect()}
    assert got == {0: "embedding", 1: "embedding_margin", 2: None, 3: None, 4: None, 5: "embedding"}


def corpus(spark):
    return spark.createDataFrame([
        ("1", "Sr. BI Analyst (Remote)", ["data analyst", "zzz", " nurse ", "data analyst", ""]),
        ("2", "nurse practitionr", []), ("3", None, ["statisticians"]), ("4", "Manager", None), ("5", "qqq www", ["bi analysts", None]),
    ], "job_id string, title string, skills array<string>")


def finished(spark, **settings):
    raw = taxonomy(spark)
    pair = tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION)
    config = Config(titles=Ladder(similarity=0.7, pair_score=0.9), skills=Ladder(similarity=0.6, use_pair_scorer=False), **settings)
    return pipeline.run_stages(corpus(spark), {"occupations": pair, "skills": pair}, config, vectors.TrigramEncoder(), vectors.TokenOverlap()), pair[1]


def test_pipeline_and_export(spark, tmp_path):
    result, concepts = finished(spark)
    rows = {r.job_id: r for r in result.corpus.collect()}
    assert rows["1"].match_method == "exact" and rows["1"].esco_uri == "A" and rows["2"].match_method == "embedding"
    assert rows["1"].skills[:4] == ["statistician", None, "nurse practitioner", "statistician"] and rows["1"].n_skills_exact >= 3
    for r in rows.values():
        assert len(r.skills) == len(r.skill_match_methods) == len(r.skills_raw or [])
        counts = sum(r[f"n_skills_{m}"] for m in ("exact", "embedding", "embedding_margin", "embedding_ce"))
        assert counts + len(r.skills_dropped_terms) == len(r.skills)
    assert rows["4"].match_method is None and rows["4"].occupation is None
    groups = spark.createDataFrame([("01", "Group"), ("0110", "Sub")], "code string, label string")
    out = export.flatten(result.corpus, concepts, groups)
    assert out.columns == export.COLUMNS
    stores.export_csv(out, str(tmp_path / "out"), one_file=True)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out")).collect()
    padded = spark.createDataFrame([(" a ", '"q"', None, "")], "x string, y string, z string, w string")
    stores.export_csv(padded, str(tmp_path / "pad"))
    assert tables.read_csv(spark, str(tmp_path / "pad"), ["x", "y", "z", "w"]).drop("ord").collect() == [(" a ", '"q"', None, None)]
    assert back[0].esco_skills.split(" | ")[0] == "statistician" and back[0].isco_submajor_label == "Group" and back[0].isco_group_code == "0110"
    assert reports.run_summary(result.corpus).first().rows == 5
    thin = export.flatten(corpus(spark), concepts, groups)
    assert thin.count() == 0


def test_rows_of_one_id_and_of_none_keep_their_own(spark):
    raw = taxonomy(spark)
    pair = tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION)
    rows = spark.createDataFrame([("1", "nurse", ["nurse", "zzz"]), ("1", "manager", ["data analyst"]), (None, "nurse", ["bi analyst", None]), (None, "zzz", []), ("2", "nurse", ["nurse", "zzz"])], "job_id string, title string, skills array<string>")
    targets = exact.with_canonical(*pair)
    out = exact.rule_stage(rows, targets, targets)
    key = lambda r: (r.job_id or "", r.occupation or "", [x or "" for x in r.skills])
    want = [("", "", []), ("", "nurse practitioner", ["data analyst", ""]), ("1", "", ["statistician"]), ("1", "nurse practitioner", ["nurse practitioner", ""]), ("2", "nurse practitioner", ["nurse practitioner", ""])]
    assert sorted(map(key, out.collect())) == want
    run = pipeline.run_stages(rows, {"occupations": pair, "skills": pair}, Config(), vectors.TrigramEncoder(), vectors.TokenOverlap())
    assert sorted(map(key, run.corpus.collect())) == want and run.titles.count() == run.skills.count() == 5
    assert {tuple(r.skills_dropped_terms) for r in run.corpus.where("job_id = '1'").collect()} == {("zzz",), ()}
    stage = spark.createDataFrame([(None, "x"), ("1", "y")], "job_id string, note string")
    assert sorted((r.job_id or "", r.note or "") for r in pipeline.merge_stage(rows, stage, ["note"]).collect()) == [("", "x"), ("", "x"), ("1", "y"), ("1", "y"), ("2", "")]


def test_vector_cache_and_descriptions(spark, tmp_path):
    raw = taxonomy(spark)
    index = lookup.target_index(tables.concepts(raw, tables.OCCUPATION), True)
    plain, rich = (lookup.with_embed_text(index, d) for d in (False, True))
    assert {r.embed_text for r in rich.collect()} >= {"statistician - counts", "nurse - heals", "BI  analyst!"}
    calls = []

    def encode(df):
        calls.append(1)
        return vectors.embed(df, vectors.TrigramEncoder(), "embed_text")

    first, again, other = (stores.cached_vectors(x, encode, "trigram", str(tmp_path / "v")) for x in (plain, plain, rich))
    assert len(calls) == 2 and len(list((tmp_path / "v").iterdir())) == 2
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect())) and other.count() == index.count()
    result, _ = finished(spark, use_description=True)
    assert result.titles.where("match_method = 'exact'").count() == 1


def test_summaries(spark):
    result, _ = finished(spark)
    got = reports.pipeline_summary(result.corpus, result.titles, result.skills).first()
    titles, skills = result.titles.collect(), result.skills.collect()
    assert (got.rows, got.title_rows, got.titles_matched, got.titles_exact) == (5, 5, sum(r.esco_occupation is not None for r in titles), 1)
    assert got.mentions_kept == sum(m is not None for r in skills for m in r.skill_match_methods) and got.mentions_exact == sum(m == "exact" for r in skills for m in r.skill_match_methods)
    short = reports.pipeline_summary(result.corpus).first()
    assert short.title_rows is None and short.mentions_kept is None and short.rows == 5
    assert reports.skill_summary(result.skills).first().skills == len({s for r in skills for s in r.skills if s})
    assert reports.title_summary(result.titles).first().matched == got.titles_matched
    scores = spark.createDataFrame([("a", 0.7, 0.2), ("b", 0.9, 0.3), ("c", 0.65, None)], "text string, score double, margin double")
    assert [(r.q, r.value) for r in reports.margin_deciles(scores, 0.8).collect()] == [(10 * i, 0.2) for i in range(11)] and reports.margin_deciles(scores, 0.1).count() == 0
    assert sorted((r.min_score, r.text) for r in reports.margin_grid_samples(scores, 0.8).collect()) == [(0.6, "a"), (0.65, "a"), (0.7, "a"), (0.7, "a")]


def test_drop_unmatched_and_empty(spark):
    early, _ = finished(spark, drop_unmatched="after_exact")
    late, _ = finished(spark, drop_unmatched="after_all")
    assert {r.job_id for r in early.corpus.collect()} == {"1"} and {r.job_id for r in late.corpus.collect()} >= {"1", "2"}
    none = corpus(spark).limit(0)
    assert reports.run_summary(none.withColumn("occupation", F.lit(None).cast("string"))).first().pct is None
    assert reports.precision_estimate(reports.method_counts(none.withColumn("match_method", F.lit(None).cast("string")))).first().precision is None


def test_stores(spark, tmp_path):
    path = str(tmp_path / "c")
    built = stores.load_all(spark, path, lambda: corpus(spark))
    assert stores.load_all(spark, path, lambda: 1 / 0).count() == built.count() == 5
    with pytest.raises(FileNotFoundError):
        stores.load_run(spark, str(tmp_path / "none"), ["corpus"])
    stores.save_run(spark, str(tmp_path / "run"), {"corpus": corpus(spark)}, {"a": 1})
    saved, config = stores.load_run(spark, str(tmp_path / "run"), ["corpus", "titles"])
    assert saved["corpus"].count() == 5 and "titles" not in saved and config == {"a": 1}


def test_run_from_files(spark, tmp_path, capsys, monkeypatch):
    """CSV files in, cache, saved run and export out; a second run reads the cache."""
    data, cache = tmp_path / "data", tmp_path / "cache"
    data.mkdir()
    (data / tables.POSTINGS).write_text("job_link,job_title\nu1,Senior Nurse\nu2,\nu3,data analyst (Remote)\nu3,zzz\n", encoding="latin-1")
    (data / tables.SKILLS).write_text('job_link,job_skills\nu1,"Nurse, zzz"\nu3,"bi analyst,, Nurse"\nu9,none\n', encoding="latin-1")
    head = "conceptUri,preferredLabel,altLabels,hiddenLabels,description,"
    (data / tables.OCCUPATIONS_FILE).write_text(head + 'code,iscoGroup\nA,data analyst,"bi analyst\nanalyst of data",,counts,1,2511\nB,nurse,,,heals,2,2221\n')
    (data / tables.SKILLS_FILE).write_text(head + "skillType,reuseLevel\nS,nurse,,,care,skill,wide\nT,bi analyst,,,,skill,wide\n")
    (data / tables.GROUPS_FILE).write_text("code,preferredLabel\n22,health\n2221,nurses\n25,ICT\n2511,analysts\n")
    monkeypatch.setenv("PREP_DATA_DIR", str(data))
    monkeypatch.setenv("PREP_CACHE_DIR", str(cache))
    config = Config(sample_size=None)
    assert config.data("x") == str(data / "x") and config.cached("run") == str(cache / "run_all") and Config(sample_size=7).tag() == "7"
    pipeline.run(spark, config, vectors.TrigramEncoder(), vectors.TokenOverlap())
    out = sorted(pipeline.export_run(spark, config).collect(), key=lambda r: r.job_link)
    assert [(r.job_link, r.esco_occupation, r.isco_group_label, r.isco_submajor_label, r.esco_skills, r.skills_unmatched) for r in out] == [
        ("u1", "nurse", "nurses", "health", "nurse | ", "zzz"), ("u3", "data analyst", "analysts", "ICT", "bi analyst | nurse", ""),
    ]
    (data / tables.POSTINGS).write_text("job_link,job_title\n")
    again = pipeline.run(spark, config, vectors.TrigramEncoder(), vectors.TokenOverlap())
    assert again.corpus.count() == 3 and stores.load_run(spark, config.cached("run"), ["corpus"])[1]["sample_size"] is None
    reports.show("SUMMARY", reports.run_summary(again.corpus))
    assert "SUMMARY\n====" in capsys.readouterr().out
    counts = {r.kind: (r.concepts, r.labels) for r in tables.taxonomy_counts(tables.load_taxonomies(spark, config.data(tables.OCCUPATIONS_FILE), config.data(tables.SKILLS_FILE))).collect()}
    assert counts == {"occupations": (2, 4), "skills": (2, 2)}


def test_stream(spark, tmp_path):
    from quillmap.streaming import match_stream

    raw = taxonomy(spark)
    targets = exact.with_canonical(tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION))
    src = str(tmp_path / "in")
    corpus(spark).select("job_id", "title").write.parquet(src)
    stream = spark.readStream.schema("job_id string, title string").parquet(src)
    got = []
    q = match_stream(stream, targets, lambda df, n: got.extend(df.collect()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert {r.job_id: r.occupation for r in got}["1"] == "data analyst"
