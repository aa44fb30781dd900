"""All queries of the engine and the SQL that checks them. Each callable takes (spark, sf_dir) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config, Ladder
from ..functions import arrays as A
from ..functions import text as T
from ..operators import exact, export, ladder, lookup, reports, vectors
from ..sources import stores, tables
from . import pipeline
from . import proxies as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = P.sql(oracle)
        return f

    return add


def r6(*names: str) -> list:
    return [F.round(F.col(n), 6).alias(n) for n in names]


# --- text --------------------------------------------------------------------------------------------------------


@query(f"select doc_id, {P.norm('text')} as key from documents")
def normalize_text(spark, sf):
    return P.table(spark, sf, "documents").select("doc_id", T.normalize(F.col("text")).alias("key"))


_CELL = "case when p_partkey % 7 = 0 then null else ' ' || p_name || ' , ,' || upper(p_brand) || ',' || p_type || ' ' end"


@query(f"""select p_partkey, array_to_string(parts, ' | ') as terms, len(parts)::bigint as n from (select p_partkey, coalesce(list_filter(list_transform(
    string_split({_CELL}, ','), lambda y: lower({P.strip('y')})), lambda y: y <> ''), []) as parts from part)""")
def split_list_cell(spark, sf):
    cell = F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit(" "), "p_name", F.lit(" , ,"), F.upper("p_brand"), F.lit(","), "p_type", F.lit(" ")))
    parts = T.split_list_cell(cell)
    return P.table(spark, sf, "part").select("p_partkey", A.join_list(parts).alias("terms"), A.list_length(parts).alias("n"))


@query("select job_id, clean from (" + P.cleaned("select * from titles", "title") + ")")
def clean_title(spark, sf):
    return P.titles(spark, sf).select("job_id", T.clean_title(F.col("title")).alias("clean"))


@query("select title, place, text, label_key from cand")
def title_candidates_exploded(spark, sf):
    rows = P.titles(spark, sf).where("title is not null").select("title").distinct()
    return rows.select("title", F.posexplode(T.title_candidates(F.col("title"))).alias("place", "c")).select("title", F.col("place").cast("long").alias("place"), "c.text", F.col("c.key").alias("label_key"))


@query("select title, text from prepared")
def prepare_text(spark, sf):
    rows = P.titles(spark, sf).where("title is not null").select("title").distinct()
    return rows.select("title", T.prepare_text(F.col("title")).alias("text"))


@query("select uri, case when coalesce(description, '') <> '' then canonical || ' - ' || description[:12] else canonical end as embed_text from concepts")
def embed_text(spark, sf):
    _, concepts, _ = P.vocabulary(spark, sf)
    return concepts.select("uri", T.embed_text(F.col("canonical"), F.col("description"), 12).alias("embed_text"))


@query("select sha1(string_agg(p_name || chr(0), '' order by p_partkey))[:16] as signature from part")
def content_signature(spark, sf):
    return spark.createDataFrame([(stores.content_signature(P.table(spark, sf, "part"), "p_partkey", "p_name"),)], "signature string")


# --- targets -----------------------------------------------------------------------------------------------------


@query("select label_key, uri from lookup")
def first_writer_lookup(spark, sf):
    return P.vocabulary(spark, sf)[0]


@query("select lpad(p_size::varchar, 2, '0') as code, arg_max(p_name, p_partkey) as label from part group by 1")
def last_writer_lookup(spark, sf):
    code = F.concat(F.lit(" "), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    return tables.group_labels(P.table(spark, sf, "part").select(code.alias("code"), F.col("p_name").alias("preferredLabel"), F.col("p_partkey").alias("ord")))


@query("select uri, canonical, array_to_string(variants, ' | ') as variants, description, isco_group, pos from concepts")
def concept_variants(spark, sf):
    _, concepts, _ = P.vocabulary(spark, sf)
    return concepts.select("uri", "canonical", A.join_list(F.col("variants")).alias("variants"), "description", "isco_group", "pos")


@query("select label_idx, label, uri, label_key, canonical from idx")
def target_index(spark, sf):
    _, concepts, _ = P.vocabulary(spark, sf)
    return lookup.target_index(concepts, True).select(F.col("label_idx").cast("long").alias("label_idx"), "label", "uri", "label_key", "canonical")


# --- joins -------------------------------------------------------------------------------------------------------


@query("select o_custkey, arg_min(o_orderkey, o_orderkey) as first_order from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by 1")
def semi_join_scan(spark, sf):
    wanted = P.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = P.table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_orderkey").alias("ord"))
    return tables.first_per_key(rows.join(wanted, "o_custkey", "left_semi"), "o_custkey", "first_order")


@query("""select c_custkey as job_id, coalesce(array_to_string(list_filter(list_transform(string_split(cell, ','), lambda y: lower(trim(y))), lambda y: y <> ''), ' | '), '') as skills
    from customer left join (select o_custkey, string_agg(o_orderpriority, ', ' order by o_orderkey) as cell from orders group by 1) on o_custkey = c_custkey""")
def left_join_default_array(spark, sf):
    cells = P.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("job_id")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("s"))
    cells = cells.select("job_id", F.array_join(F.transform("s", lambda s: s["o_orderpriority"]), ", ").alias("job_skills"))
    rows = P.table(spark, sf, "customer").select(F.col("c_custkey").alias("job_id"))
    return tables.with_skills(rows, cells).select("job_id", A.join_list(F.col("skills")).alias("skills"))


@query("select title, occupation from texact")
def exact_title_match(spark, sf):
    return exact.match_titles_exact(P.titles(spark, sf), P.vocabulary(spark, sf)[2])


@query(f"select r.title, t.canonical as occupation from (select distinct title from titles where title is not null) r join targets t on t.label_key = {P.norm('r.title')}")
def exact_raw_title_match(spark, sf):
    return exact.match_titles_exact(P.titles(spark, sf), P.vocabulary(spark, sf)[2], use_candidates=False)


@query("select title, occupation, uri from texact")
def exact_uri_relookup(spark, sf):
    found, _, targets = P.vocabulary(spark, sf)
    return exact.canonical_uri(exact.match_titles_exact(P.titles(spark, sf), targets), found)


@query("""select t.job_id, string_agg(coalesce(e.canonical, ''), ' | ' order by pos) as skills, string_agg(case when e.raw is not null then 'exact' else '' end, ' | ' order by pos) as methods
    from terms t left join sexact e on e.raw = t.raw group by t.job_id""")
def aligned_skills_exact(spark, sf):
    corpus = P.corpus(spark, sf).where(F.size("skills") > 0)
    slots = exact.skill_slots(corpus)
    found = slots.join(exact.match_terms_exact(slots, P.vocabulary(spark, sf)[2]), "raw", "left")
    out = exact.align(corpus, found, canonical=F.col("canonical"), methods=F.when(F.col("canonical").isNotNull(), "exact"))
    return out.select("job_id", A.join_list(F.col("canonical")).alias("skills"), A.join_list(F.col("methods")).alias("methods"))


@query("""select c.job_id, c.title, coalesce(string_agg(coalesce(e.canonical, ''), ' | ' order by pos) filter (t.raw is not null), '') as skills, any_value(x.occupation) as occupation
    from corpus c join texact x on x.title = c.title left join terms t on t.job_id = c.job_id left join sexact e on e.raw = t.raw group by c.job_id, c.title""")
def rule_stage_drop_unmatched(spark, sf):
    targets = P.vocabulary(spark, sf)[2]
    out = exact.rule_stage(P.corpus(spark, sf), targets, targets, drop_unmatched=True)
    return out.select("job_id", "title", A.join_list(F.col("skills")).alias("skills"), "occupation")


@query("select text from ttexts")
def distinct_unmatched_texts(spark, sf):
    rows = P.titles(spark, sf)
    matched = exact.match_titles_exact(rows, P.vocabulary(spark, sf)[2])
    return ladder.title_texts(rows.join(matched, "title", "left_anti")).select("text").distinct()


@query("""with s as (select c_custkey as job_id, c_name as title, null::varchar as occupation, c_mktsegment as kept from customer),
    g as (select o_custkey as job_id, max(o_orderpriority) as occupation, count(*) as n from orders group by 1)
    select s.job_id, s.title, s.kept, coalesce(g.occupation, s.title) as occupation, g.n from s left join g using (job_id)""")
def merge_stage(spark, sf):
    rows = P.table(spark, sf, "customer").select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("title"), F.lit(None).cast("string").alias("occupation"), F.col("c_mktsegment").alias("kept"))
    stage = P.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("job_id")).agg(F.max("o_orderpriority").alias("occupation"), F.count("*").alias("n"))
    return pipeline.merge_stage(rows, stage, ["occupation", "n"]).withColumn("occupation", F.coalesce("occupation", "title"))


# --- vectors -----------------------------------------------------------------------------------------------------

_EACH = """with q as (select vec_id, embedding::double[] as e from embeddings where vec_id % 20 = 0), l as (select vec_id as label_idx, embedding::double[] as e from embeddings),
  r as (select q.vec_id, label_idx, round(list_inner_product(q.e, l.e), 9) as score, row_number() over (partition by q.vec_id order by round(list_inner_product(q.e, l.e), 9) desc, label_idx) as rank from q, l where label_idx <> q.vec_id qualify rank <= 5),
  b as (select a.vec_id, a.label_idx, a.score, a.score - c.score as margin from r a left join r c on c.vec_id = a.vec_id and c.rank = 2 where a.rank = 1)"""


def _vector_ranks(spark, sf, k=5):
    """Queries: every row whose id is divisible by 20; labels: all other rows."""
    rows = P.table(spark, sf, "embeddings").select("vec_id", "embedding")
    labels = rows.select(F.col("vec_id").cast("int").alias("label_idx"), "embedding")
    found = vectors.top_k(rows.where("vec_id % 20 = 0"), labels, k + 1).where("label_idx != vec_id")
    place = F.row_number().over(Window.partitionBy("vec_id").orderBy("rank"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _vector_scores(spark, sf):
    return vectors.best_with_margin(_vector_ranks(spark, sf), "vec_id")


@query(_EACH + " select vec_id, label_idx::bigint as label_idx, rank, round(score, 6) as score from r")
def vector_topk(spark, sf):
    return _vector_ranks(spark, sf).select("vec_id", F.col("label_idx").cast("long").alias("label_idx"), F.col("rank").cast("long").alias("rank"), *r6("score"))


@query(_EACH + " select vec_id, label_idx::bigint as label_idx, round(score, 6) as score, round(margin, 6) as margin from b")
def vector_margin(spark, sf):
    return _vector_scores(spark, sf).select("vec_id", F.col("label_idx").cast("long").alias("label_idx"), *r6("score", "margin"))


@query(_EACH + " select vec_id, case when score >= 0.5 then 'embedding' when score >= 0.35 and margin >= 0.02 then 'embedding_margin' end as method from b")
def ladder_verdict(spark, sf):
    method = ladder.verdict(F.col("score"), F.col("margin"), Ladder(similarity=0.5, margin_min_score=0.35, margin=0.02))
    return _vector_scores(spark, sf).select("vec_id", method.alias("method"))


@query(_EACH + """ select vec_id, label_idx::bigint as label_idx, ce_score, round(score, 6) as bi_score from (
    select *, ((vec_id * 31 + label_idx * 17) % 5)::double / 5 as ce_score from r) qualify row_number() over (partition by vec_id order by ce_score desc, rank) = 1""")
def ce_rerank_argmax(spark, sf):
    scorer = ((F.col("vec_id") * 31 + F.col("label_idx") * 17) % 5).cast("double") / 5
    best = vectors.best_pair(vectors.score_pairs(_vector_ranks(spark, sf), scorer), "vec_id")
    return best.select("vec_id", F.col("label_idx").cast("long").alias("label_idx"), "ce_score", *r6("bi_score"))


# --- ladders -----------------------------------------------------------------------------------------------------


def _title_rows(spark, sf, corpus):
    found, concepts, targets = P.vocabulary(spark, sf)
    return ladder.match_titles(corpus, found, targets, P.index(concepts, True), P.embed, P.shared_words(), P.LADDER)


def _skill_rows(spark, sf, corpus):
    _, concepts, targets = P.vocabulary(spark, sf)
    return ladder.match_skills(corpus, targets, P.index(concepts, False), P.embed, P.shared_words(), P.LADDER)


def _title_scores(spark, sf):
    _, concepts, targets = P.vocabulary(spark, sf)
    rows = P.titles(spark, sf)
    open_ = ladder.title_texts(rows.join(exact.match_titles_exact(rows, targets), "title", "left_anti"))
    return ladder.score_texts(open_.select("text").distinct(), P.index(concepts, True), P.embed, P.shared_words(), P.LADDER)


_R = "round(esco_score, 6) as esco_score, round(esco_best_score, 6) as esco_best_score, round(esco_best_margin, 6) as esco_best_margin, round(esco_ce_score, 6) as esco_ce_score"


@query(f"select * replace ({_R}) from trows")
def title_ladder(spark, sf):
    rows = _title_rows(spark, sf, P.titles(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("esco_score", "esco_best_score", "esco_best_margin", "esco_ce_score")})


@query("select job_id, skills, methods, dropped, n_skills_exact, n_skills_embedding, n_skills_embedding_margin, n_skills_embedding_ce from skill_rows")
def skill_ladder_writeback(spark, sf):
    rows = _skill_rows(spark, sf, P.corpus(spark, sf))
    return rows.select("job_id", A.join_list(F.col("skills")).alias("skills"), A.join_list(F.col("skill_match_methods")).alias("methods"), A.join_list(F.col("skills_dropped_terms")).alias("dropped"), *(c for c in rows.columns if c.startswith("n_skills")))


@query("""with m as (select coalesce(method, 'unmatched') as method, count(*) as n from slots group by 1), e as (select unnest(['exact', 'embedding', 'embedding_margin', 'embedding_ce', 'unmatched']) as method)
    select method, coalesce(n, 0) as n, round(100.0 * coalesce(n, 0) / sum(n) over (), 6) as pct from e left join m using (method)""")
def skill_method_counts(spark, sf):
    counts = reports.method_counts(reports.skill_mentions(_skill_rows(spark, sf, P.corpus(spark, sf))), "method")
    return counts.select("method", "n", *r6("pct"))


def _finished(spark, sf, corpus=None):
    corpus = P.corpus(spark, sf) if corpus is None else corpus
    found, concepts, targets = P.vocabulary(spark, sf)
    titles = ladder.title_results(corpus, found, targets, P.index(concepts, True), P.embed, P.shared_words(), P.LADDER)
    skills = ladder.list_results(corpus, targets, P.index(concepts, False), P.embed, P.shared_words(), P.LADDER)
    rows = ladder.with_titles(corpus.withColumn("skills_raw", F.col("skills")), titles, ["esco_occupation", "esco_uri", "match_method"])
    return ladder.with_skills(rows, skills, "skills_raw")


def _export(spark, sf):
    _, concepts, _ = P.vocabulary(spark, sf)
    return export.flatten(_finished(spark, sf), concepts, P.groups(spark, sf))


_EXPORT = """select c.job_id as job_link, c.title as job_title, esco_occupation, esco_uri, match_method as title_match_method,
  coalesce(isco_group, '')[:2] as isco_submajor_code, coalesce(g2.label, '') as isco_submajor_label, coalesce(isco_group, '') as isco_group_code, coalesce(g4.label, '') as isco_group_label,
  s.original as job_skills_original, s.n_terms as n_skills_original, s.skills as esco_skills, s.n_matched as n_skills_esco, s.methods as esco_skill_match_methods, s.dropped as skills_unmatched
  from crows c join skill_rows s using (job_id) left join concepts k on k.uri = esco_uri left join groups g4 on g4.code = isco_group left join groups g2 on g2.code = isco_group[:2]
  where esco_uri is not null and s.n_matched >= 1"""


@query(_EXPORT)
def export_flatten(spark, sf):
    return _export(spark, sf)


@query(f"""select count(*) as rows, count(distinct esco_occupation) as occupations, count(distinct isco_submajor_code) as submajors,
    round(avg(n_skills_esco), 6) as mean_skills, round(avg(n_skills_original), 6) as mean_original from ({_EXPORT})""")
def distinct_and_mean(spark, sf):
    return export.export_summary(_export(spark, sf)).select("rows", "occupations", "submajors", *r6("mean_skills", "mean_original"))


# --- reports -----------------------------------------------------------------------------------------------------


@query("select count(*) as rows, count(esco_occupation) as with_occupation, round(100.0 * count(esco_occupation) / count(*), 6) as pct from trows")
def run_summary(spark, sf):
    return reports.run_summary(_title_rows(spark, sf, P.titles(spark, sf)).withColumnRenamed("esco_occupation", "occupation")).select("rows", "with_occupation", *r6("pct"))


@query("""with m as (select coalesce(match_method, 'unmatched') as method, count(*) as n from trows group by 1), e as (select unnest(['exact', 'embedding', 'embedding_margin', 'embedding_ce', 'unmatched']) as method)
    select method, coalesce(n, 0) as n, round(100.0 * coalesce(n, 0) / sum(n) over (), 6) as pct from e left join m using (method)""")
def title_method_counts(spark, sf):
    return reports.method_counts(_title_rows(spark, sf, P.titles(spark, sf))).select("method", "n", *r6("pct"))


@query("select esco_occupation as occupation, count(*) as n from trows where esco_occupation is not null group by 1")
def occupation_counts(spark, sf):
    rows = _title_rows(spark, sf, P.titles(spark, sf)).where("esco_occupation is not null")
    return rows.groupBy(F.col("esco_occupation").alias("occupation")).agg(F.count("*").alias("n"))


@query("""select round(sum(n * p) / sum(n), 6) as precision from (select match_method as method, count(*) as n from trows where match_method is not null group by 1)
    join (values ('exact', 1.0), ('embedding', 0.67), ('embedding_margin', 0.40), ('embedding_ce', 0.60)) v(method, p) using (method)""")
def precision_estimate(spark, sf):
    return reports.precision_estimate(reports.method_counts(_title_rows(spark, sf, P.titles(spark, sf)))).select(*r6("precision"))


@query("select method, canonical as label, count(*) as n, row_number() over (partition by method order by count(*) desc, canonical) as rank from slots where method is not null group by 1, 2 qualify rank <= 20")
def top20_by_method(spark, sf):
    top = reports.top_by_method(reports.skill_mentions(_skill_rows(spark, sf, P.corpus(spark, sf))), "skill", "method")
    return top.withColumn("rank", F.col("rank").cast("long"))


@query("""select (q * 10)::bigint as q, round(quantile_cont(score, q / 10.0), 6) as value from tscores, range(11) r(q) group by r.q""".replace("quantile_cont(score, q / 10.0)", "list_extract(any_value(v), q + 1)").replace("from tscores, range(11) r(q)", "from (select quantile_cont(score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) as v from tscores), range(11) r(q)"))
def calibration_deciles(spark, sf):
    return reports.deciles(_title_scores(spark, sf)).select("q", *r6("value"))


_BANDS = "values (0.45, 0.5), (0.5, 0.55), (0.55, 0.6), (0.6, 0.65), (0.65, 0.7), (0.7, 0.75), (0.75, 0.8), (0.8, 1.01)"


@query(f"select lo::double as lo, hi::double as hi, count_if(score >= lo::double and score < hi::double)::bigint as n from tscores, ({_BANDS}) b(lo, hi) group by 1, 2")
def calibration_bands(spark, sf):
    return reports.band_counts(_title_scores(spark, sf))


@query(f"select lo::double as threshold, count_if(score >= lo::double)::bigint as n from tscores, ({_BANDS}) b(lo, hi) group by 1")
def calibration_thresholds(spark, sf):
    return reports.threshold_counts(_title_scores(spark, sf))


@query("""select s::double as min_score, m::double as min_margin, count_if(score < 0.97::double and score >= s::double and margin >= m::double)::bigint as n
    from tscores, (values (0.60, 0.10), (0.65, 0.10), (0.70, 0.15), (0.70, 0.20)) g(s, m) group by 1, 2""")
def calibration_margin_grid(spark, sf):
    return reports.margin_grid(_title_scores(spark, sf), P.LADDER.similarity)


@query("select job_id, title[:44] as title, esco_best_guess, round(esco_best_score, 6) as esco_best_score from trows where match_method is null and esco_best_guess is not null order by trows.esco_best_score desc, trows.title, job_id limit 40")
def unmatched_closest(spark, sf):
    return reports.unmatched_closest(_title_rows(spark, sf, P.titles(spark, sf))).withColumn("esco_best_score", F.round("esco_best_score", 6))


@query("select job_id, title[:70] as title from trows where match_method is null and esco_best_guess is null order by trows.title nulls first, job_id limit 40")
def unmatched_unscored(spark, sf):
    return reports.unmatched_unscored(_title_rows(spark, sf, P.titles(spark, sf)))


def _skill_scores(spark, sf):
    _, concepts, targets = P.vocabulary(spark, sf)
    slots = P.terms(spark, sf)
    texts = slots.join(exact.match_terms_exact(slots, targets), "raw", "left_anti").select(T.strip(F.col("raw")).alias("text")).where("text != ''").distinct()
    return ladder.score_texts(texts, P.index(concepts, False), P.embed, P.shared_words(), P.LADDER)


@query("select text, guess, round(score, 6) as score from sscores where method is null order by sscores.score desc, text limit 40")
def unmatched_terms(spark, sf):
    return reports.unmatched_terms(_skill_scores(spark, sf)).withColumn("score", F.round("score", 6))


_VIA = "case when lower(%s) <> lower(%s) then %s end as via"


@query(f"""select title, round(esco_score, 6) as esco_score, esco_occupation, {_VIA % ("esco_occupation", "esco_matched_label", "esco_matched_label")}
    from trows where match_method = 'embedding_ce' order by md5('42:' || trows.title), trows.title limit 30""")
def pair_sample(spark, sf):
    """A seeded sample of titles the pair scorer took."""
    return reports.pair_sample(_title_rows(spark, sf, P.titles(spark, sf))).withColumn("esco_score", F.round("esco_score", 6))


@query(f"""select text, round(match_score, 6) as match_score, canonical, {_VIA % ("canonical", "label", "label")}
    from sscores where method = 'embedding_ce' order by md5('42:' || sscores.text), sscores.text limit 30""")
def skill_pair_sample(spark, sf):
    return reports.skill_pair_sample(_skill_scores(spark, sf)).withColumn("match_score", F.round("match_score", 6))


_SHOWN = "text, guess, round(score, 6) as score, round(margin, 6) as margin"


def _shown(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, "text", "guess", *r6("score", "margin"))


@query(f"""select lo::double as lo, {_SHOWN} from tscores, ({_BANDS}) b(lo, hi) where tscores.score >= lo::double and tscores.score < hi::double
    qualify row_number() over (partition by lo order by md5('0:' || text), text) <= 8""")
def band_samples(spark, sf):
    return _shown(reports.band_samples(_title_scores(spark, sf)), "lo")


@query(f"""select s::double as min_score, m::double as min_margin, {_SHOWN} from tscores, (values (0.60, 0.10), (0.65, 0.10), (0.70, 0.15), (0.70, 0.20)) g(s, m)
    where tscores.score < {P.LADDER.similarity}::double and tscores.score >= s::double and tscores.margin >= m::double
    qualify row_number() over (partition by s, m order by md5('0:' || text), text) <= 8""")
def margin_grid_samples(spark, sf):
    return _shown(reports.margin_grid_samples(_title_scores(spark, sf), P.LADDER.similarity), "min_score", "min_margin")


@query(f"""select (q * 10)::bigint as q, round(list_extract(any_value(v), q + 1), 6) as value
    from (select quantile_cont(margin, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) as v from tscores where score < {P.LADDER.similarity}::double), range(11) r(q) group by r.q having any_value(v) is not null""")
def margin_deciles(spark, sf):
    return reports.margin_deciles(_title_scores(spark, sf), P.LADDER.similarity).select("q", *r6("value"))


_KEPT = "count_if(method = 'exact')::bigint as mentions_exact, count_if(method = 'embedding')::bigint as mentions_embedding, count_if(method = 'embedding_margin')::bigint as mentions_embedding_margin, count_if(method = 'embedding_ce')::bigint as mentions_embedding_ce"


@query(f"""with c as (select count(*) as rows, count(esco_occupation) as with_occupation, round(100.0 * count(esco_occupation) / count(*), 6) as pct, count_if(match_method = 'exact')::bigint as titles_exact from crows),
    k as (select {_KEPT}, count(method) as mentions_kept from slots)
    select rows, with_occupation, pct, rows as title_rows, with_occupation as titles_matched, titles_exact, k.* from c, k""")
def pipeline_summary(spark, sf):
    corpus = P.corpus(spark, sf)
    titles, skills = _title_rows(spark, sf, corpus), _skill_rows(spark, sf, corpus)
    return reports.pipeline_summary(titles.withColumnRenamed("esco_occupation", "occupation"), titles, skills).withColumn("pct", F.round("pct", 6))


@query("""select count(*) as rows, count(match_method) as matched, round(100.0 * count(match_method) / count(*), 6) as pct, round(100.0 * count_if(match_method = 'exact') / count(*), 6) as exact_pct,
    count(distinct esco_occupation) as occupations from trows""")
def title_summary(spark, sf):
    return reports.title_summary(_title_rows(spark, sf, P.titles(spark, sf))).withColumns({c: F.round(c, 6) for c in ("pct", "exact_pct")})


@query("""select match_method as method, esco_occupation as label, count(*) as n, row_number() over (partition by match_method order by count(*) desc, esco_occupation) as rank
    from trows where match_method is not null and esco_occupation is not null group by 1, 2 qualify rank <= 20""")
def top20_titles_by_method(spark, sf):
    top = reports.top_by_method(_title_rows(spark, sf, P.titles(spark, sf)), "esco_occupation", "match_method")
    return top.withColumn("rank", F.col("rank").cast("long"))


@query("select count(method) as kept, count_if(method = 'exact')::bigint as exact, count(distinct canonical) as skills from slots")
def skill_summary(spark, sf):
    return reports.skill_summary(_skill_rows(spark, sf, P.corpus(spark, sf)))


@query("select raw, count(*) as n from terms where raw is not null group by 1")
def term_counts(spark, sf):
    return exact.term_counts(P.corpus(spark, sf))


# --- rows of their own, whole runs, stores -----------------------------------------------------------------------

_ODD_ID = "nullif(%s %% 50, 0)::varchar"


@query(f"""select {_ODD_ID % "c.job_id"} as job_id, c.title, s.skills, s.methods, s.dropped, esco_occupation, match_method from crows c join skill_rows s using (job_id)""")
def repeated_and_null_ids(spark, sf):
    """Fifty ids, one of them null, for all postings: every row keeps its own slots and title."""
    corpus = P.corpus(spark, sf).withColumn("job_id", F.nullif(F.col("job_id") % 50, F.lit(0)).cast("string"))
    return _finished(spark, sf, corpus).select("job_id", "title", A.join_list(F.col("skills")).alias("skills"), A.join_list(F.col("skill_match_methods")).alias("methods"), A.join_list(F.col("skills_dropped_terms")).alias("dropped"), "esco_occupation", "match_method")


def _letters(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("embedding", vectors.letter_vector(F.col(text)))


@query("""select c.job_id, esco_occupation as occupation, esco_uri, match_method, s.original, s.skills, s.methods, s.n_skills_embedding_ce
    from crows c join skill_rows s using (job_id)""")
def whole_run(spark, sf):
    """All stages of a run, with native vectors and pair scores."""
    raw = P.taxonomy(spark, sf)
    pair = tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION)
    out = pipeline.run_stages(P.corpus(spark, sf), {"occupations": pair, "skills": pair}, Config(titles=P.LADDER, skills=P.LADDER), _letters, P.shared_words()).corpus
    return out.select("job_id", "occupation", "esco_uri", "match_method", A.join_list(F.col("skills_raw")).alias("original"), A.join_list(F.col("skills")).alias("skills"), A.join_list(F.col("skill_match_methods")).alias("methods"), "n_skills_embedding_ce")


@query("""select label_idx, case when coalesce(description, '') <> '' then label || ' - ' || description[:20] else label end as embed_text from idx""")
def description_index(spark, sf):
    index = lookup.with_embed_text(lookup.target_index(P.vocabulary(spark, sf)[1], True), True, 20)
    return index.select(F.col("label_idx").cast("long").alias("label_idx"), "embed_text")


def _csv(df: DataFrame, spark: SparkSession, order: str, files: int = 3) -> str:
    """df as several CSV files in the shared folder, in order."""
    path = stores.scratch(spark, "csv")
    stores.export_csv(df.repartitionByRange(files, order).sortWithinPartitions(order).drop(order), path)
    return path


@query("select job_id::varchar as job_id, title from titles where job_id <= (select job_id from titles order by job_id limit 1 offset 149) and title is not null")
def csv_postings(spark, sf):
    """Postings written as three CSV files, then the first 150 rows read back, those without a title left out."""
    rows = P.titles(spark, sf).select(F.col("job_id").alias("at"), F.col("job_id").alias("job_link"), F.col("title").alias("job_title"))
    return tables.load_postings(spark, _csv(rows, spark, "at"), 150).select("job_id", "title")


@query("""select t.job_id::varchar as job_id, t.title, coalesce(string_agg(lower(trim(x.raw)), ' | ' order by pos) filter (trim(x.raw) <> ''), '') as skills
    from corpus t left join terms x using (job_id) where t.title is not null group by t.job_id, t.title""")
def csv_corpus(spark, sf):
    """Postings and their terms through two CSV sources, joined by link."""
    corpus = P.corpus(spark, sf).withColumn("at", F.col("job_id")).withColumnRenamed("job_id", "job_link")
    postings = _csv(corpus.select("at", "job_link", F.col("title").alias("job_title")), spark, "at")
    skills = _csv(corpus.select("at", "job_link", F.array_join("skills", ", ").alias("job_skills")), spark, "at")
    return tables.load_corpus(spark, postings, skills).select("job_id", "title", A.join_list(F.col("skills")).alias("skills"))


def _csv_taxonomies(spark, sf):
    raw = P.taxonomy(spark, sf)
    occupations = _csv(raw.withColumn("at", F.col("ord")).drop("ord"), spark, "at", 1)
    skills = raw.select(*tables.CONCEPT, F.lit("skill").alias("skillType"), F.lit("wide").alias("reuseLevel"), F.col("ord").alias("at"))
    return tables.load_taxonomies(spark, occupations, _csv(skills, spark, "at"))


@query("select uri, canonical, array_to_string(variants, ' | ') as variants, description, isco_group, row_number() over (order by pos) - 1 as pos from concepts")
def csv_occupations(spark, sf):
    found = _csv_taxonomies(spark, sf)["occupations"][1]
    return found.select("uri", "canonical", A.join_list(F.col("variants")).alias("variants"), "description", "isco_group", "pos")


@query("select label_key, l.uri, 'skill' as skill_type, 'wide' as reuse_level from lookup l join concepts using (uri)")
def csv_skills(spark, sf):
    found, concepts = _csv_taxonomies(spark, sf)["skills"]
    return found.join(concepts, "uri").select("label_key", "uri", "skill_type", "reuse_level")


@query("""select kind, (select count(*) from concepts) as concepts, (select count(*) from lookup) as labels from (values ('occupations'), ('skills')) k(kind)""")
def taxonomy_counts(spark, sf):
    return tables.taxonomy_counts(_csv_taxonomies(spark, sf))


@query("select code, label from groups")
def csv_groups(spark, sf):
    rows = P.groups(spark, sf).select(F.concat(F.lit(" "), "code").alias("code"), F.col("label").alias("preferredLabel"), F.col("code").alias("at"))
    return tables.load_groups(spark, _csv(rows, spark, "at"))


@query(f"""with e as ({_EXPORT}) select job_link::varchar as job_link, nullif(job_title, '') as job_title, esco_occupation, esco_uri, title_match_method, nullif(isco_submajor_label, '') as isco_submajor_label,
    n_skills_original::varchar as n_skills_original, nullif(esco_skills, '') as esco_skills, nullif(esco_skill_match_methods, '') as esco_skill_match_methods, nullif(skills_unmatched, '') as skills_unmatched from e""")
def csv_export(spark, sf):
    """The export written as CSV and read back: empty cells come back as null."""
    path = stores.scratch(spark, "export")
    stores.export_csv(_export(spark, sf), path)
    names = ["job_link", "job_title", "esco_occupation", "esco_uri", "title_match_method", "isco_submajor_label", "n_skills_original", "esco_skills", "esco_skill_match_methods", "skills_unmatched"]
    return tables.read_csv(spark, path, names).drop("ord")


@query("select job_id, title, coalesce(string_agg(raw, ' | ' order by pos), '') as skills from corpus left join terms using (job_id) group by 1, 2")
def stored_run(spark, sf):
    """A corpus through the cache, then through a saved run."""
    path = stores.scratch(spark, "run")
    rows = stores.load_all(spark, f"{path}/corpus", lambda: P.corpus(spark, sf))
    stores.save_run(spark, f"{path}/run", {"corpus": rows}, {"sf": sf})
    found, _ = stores.load_run(spark, f"{path}/run", ["corpus", "titles"])
    return found["corpus"].select("job_id", "title", A.join_list(F.col("skills")).alias("skills"))


# --- without SQL -------------------------------------------------------------------------------------------------


@query()
def encoder_ladder(spark, sf):
    """The whole run with a stand-in encoder and pair scorer in Arrow batches on distinct texts."""
    raw = P.taxonomy(spark, sf)
    pair = tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION)
    result = pipeline.run_stages(P.corpus(spark, sf), {"occupations": pair, "skills": pair}, Config(), vectors.TrigramEncoder(), vectors.TokenOverlap())
    return result.corpus
