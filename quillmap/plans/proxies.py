"""Stand-in inputs derived from the driver's tables, as frames and as SQL.

Titles are dressed-up part names; the vocabulary has one concept for three of four distinct part names, with alternative
labels that collide on purpose; a posting's terms are its order's part names, some of them changed; groups are nations
and regions. Vectors of texts are letter counts, pairs are scored by the words they share: both can be written in SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Ladder
from ..functions import text as T
from ..operators import exact, lookup, vectors
from ..sources import tables

LADDER = Ladder(similarity=0.97, margin_min_score=0.90, margin=0.02, pair_score=0.30, pair_top_k=5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """job_id, title."""
    k, name = F.col("p_partkey") % 6, F.col("p_name")
    title = (
        F.when(k == 0, F.concat(F.lit("Sr. "), name, F.lit(" II (Remote)")))
        .when(k == 1, F.initcap(name))
        .when(k == 2, F.concat(F.lit("LEAD "), F.upper(name), F.lit(" - Full Time")))
        .when(k == 3, F.concat(F.lit("Associate "), name, F.lit(", Senior / "), F.col("p_brand")))
        .when(k == 4, F.concat(F.lit("Remote - "), name, F.lit("s at Acme 23 0106")))
        .otherwise(F.concat(name, F.lit(" "), F.lower("p_type")))
    )
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("job_id"), F.when(F.col("p_partkey") % 97 != 0, title).alias("title"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw concept rows, as a source gives them."""
    w = Window.orderBy("p_name")  # over the few distinct names
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("first"))
    names = names.select("p_name", "first", (F.row_number().over(w) - 1).cast("long").alias("ord"), F.lead("p_name").over(w).alias("next"))
    word = F.split("p_name", " ")
    swapped = F.concat(F.element_at(word, 2), F.lit(" "), F.element_at(word, 1))
    alt = F.when(F.col("ord") % 3 == 0, F.concat(swapped, F.lit("\n "), F.coalesce("next", F.lit("")))).when(F.col("ord") % 3 == 1, F.concat(F.lit("The "), F.col("p_name")))
    hidden = F.when(F.col("ord") % 5 == 0, F.lit("Manager")).when(F.col("ord") % 5 == 1, F.element_at(word, 2))
    return names.where("ord % 4 != 3").select(
        F.concat(F.lit("c"), F.col("first")).alias("conceptUri"), F.col("p_name").alias("preferredLabel"), alt.alias("altLabels"), hidden.alias("hiddenLabels"),
        F.when(F.col("ord") % 2 == 0, F.concat(F.lit("Makes a "), F.col("p_name"))).alias("description"),
        F.col("first").cast("string").alias("code"), F.lpad((F.col("first") % 25).cast("string"), 4, "0").alias("iscoGroup"), "ord",
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, label."""
    nation = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("code"), F.col("n_name").alias("label"))
    return nation.union(table(spark, sf_dir, "region").select(F.lpad(F.col("r_regionkey").cast("string"), 2, "0"), "r_name"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """job_id, pos, raw of every order's line items; line numbers may repeat, so places are counted."""
    k, name = (F.col("l_orderkey") + F.col("l_linenumber")) % 5, F.col("p_name")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"))
    raw = F.when(k == 0, name).when(k == 1, F.concat(F.lit(" "), F.upper(name), F.lit("!"))).when(k == 2, F.concat(name, F.lit(" handling"))).when(k == 3, F.concat(name, F.lit("s"))).otherwise(F.lit(" "))
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return items.select(F.col("l_orderkey").alias("job_id"), place.alias("pos"), raw.alias("raw"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """job_id, title, skills: orders with the title of one part and their terms."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("k"))
    named = orders.join(titles(spark, sf_dir).withColumnRenamed("job_id", "k"), "k", "left")
    lists = terms(spark, sf_dir).groupBy("job_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "raw"))), lambda s: s["raw"]).alias("skills"))
    return named.join(lists, "job_id", "left").select("job_id", "title", F.coalesce("skills", F.array().cast("array<string>")).alias("skills"))


def vocabulary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lookup, concepts, targets)."""
    raw = taxonomy(spark, sf_dir)
    found, concepts = tables.lookup(raw), tables.concepts(raw, tables.OCCUPATION)
    return found, concepts, exact.with_canonical(found, concepts)


def index(concepts: DataFrame, skip_generic: bool) -> DataFrame:
    return lookup.target_index(concepts, skip_generic).withColumn("embedding", vectors.letter_vector(F.col("label")))


def embed(df: DataFrame) -> DataFrame:
    return df.withColumn("embedding", vectors.letter_vector(F.col("text")))


def shared_words() -> Column:
    """The share of common words in all words of text and label."""
    a, b = F.array_distinct(F.split("text", " ")), F.array_distinct(F.split("label", " "))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


# --- the same in SQL ---------------------------------------------------------------------------------------------

_S = f"[{T.SPACE}]"


def sub(x: str, pattern: str, by: str = "", ignore_case: bool = True) -> str:
    """A fixed pattern as it stands: the classes of the engine that runs the SQL are ASCII, as these inputs are."""
    return f"regexp_replace({x}, '{'(?i)' if ignore_case else ''}{pattern}', '{by}', 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{_S}+|{_S}+$")


def squeeze(x: str) -> str:
    return f"trim({sub(x, f'{_S}+', ' ')})"


def norm(x: str) -> str:
    return squeeze(sub(strip(f"lower({x})"), f"[^{T.WORD}{T.SPACE}+#.]", " "))


def peel(x: str) -> str:
    return strip(sub(sub(x, T.SENIORITY_PREFIX), T.LEVEL_SUFFIX))


def cleaned(rel: str, col: str, out: str = "clean") -> str:
    """rel and the cleaned title. Titles carry few ranks, so four rounds settle each loop."""
    level = lambda x: strip(sub(x, T.LEVEL_SUFFIX))
    q = f"select *, {sub(sub(f'lower({col})', T.PARENTHESES, ' '), '[-/_|]+', ' ')} as x from ({rel})"
    q = f"select * replace ({sub(sub('x', T.JOB_TYPE_WORD, ' '), f'[^{T.WORD}{T.SPACE}+#.]', ' ')} as x) from ({q})"
    q = f"select * replace ({level(squeeze('x'))} as x) from ({q})"
    for pattern, words in ((T.RANK_PREFIX, 1), (T.RANK_SUFFIX, 1), (T.ROLE_PREFIX_WORD, 2)):
        for _ in range(4):
            q = f"select *, {squeeze(sub('x', pattern, ' '))} as s from ({q})"
            q = f"select * exclude (s) replace (case when s = '' or s = x or len(string_split(s, ' ')) < {words} then x else s end as x) from ({q})"
    return f"select * exclude (x), case when {col} is null or {strip(col)} = '' then '' else {squeeze(level('x'))} end as {out} from ({q})"


_GENERIC = "[" + ", ".join(f"'{x}'" for x in T.GENERIC_ROLES) + "]"
_BARE = sub("title", T.PARENTHESES, " ")


def _forms() -> str:
    segments = f"list_filter(list_transform(string_split_regex({_BARE}, '{T.SPLITTERS}'), lambda y: {strip('y')}), lambda y: y <> '')"
    ordered = f"list_transform(list_sort(list_transform({segments}, lambda y, i: {{'n': -length(y), 'i': i, 'y': y}})), lambda s: s.y)"
    whole = f"case when {_BARE} = title then [title] else [title, {_BARE}] end"
    return f"list_concat(list_concat({whole}, list_transform({whole}, lambda y: {peel('y')})), list_concat([clean], flatten(list_transform({ordered}, lambda y: [y, {peel('y')}]))))"


def _vec(x: str) -> str:
    letters = "[" + ", ".join(f"'{c}'" for c in map(chr, range(97, 123))) + "]"
    return f"list_transform({letters}, lambda c: (length({x}) - length(replace({x}, c, '')))::double)"


def _prepared() -> str:
    code = lambda x: strip(sub(x, T.REQUISITION, ignore_case=False))
    q = f"select distinct title, {code(code(strip(sub('title', T.COMPANY_TAIL))))} as t from titles where title is not null"
    q = cleaned(f"select title, case when t = '' then title else t end as t from ({q})", "t")
    return f"select title, case when clean <> '' then clean else {strip('t')} end as text from ({q})"


_TITLE = """case p_partkey % 6 when 0 then 'Sr. ' || p_name || ' II (Remote)'
  when 1 then upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:]
  when 2 then 'LEAD ' || upper(p_name) || ' - Full Time' when 3 then 'Associate ' || p_name || ', Senior / ' || p_brand
  when 4 then 'Remote - ' || p_name || 's at Acme 23 0106' else p_name || ' ' || lower(p_type) end"""


def _scores(prefix: str, texts: str, idx: str) -> dict[str, str]:
    """CTEs of the ladder over a relation of distinct texts and an index."""
    p, d = prefix, LADDER
    jaccard = "len(list_intersect(string_split(text, ' '), string_split(label, ' ')))::double / len(list_distinct(list_concat(string_split(text, ' '), string_split(label, ' '))))"
    return {
        f"{p}sim": f"""select t.text, i.label_idx, i.label, i.uri, i.canonical,
            round(coalesce(case when length(regexp_replace(t.text, '[^a-z]', '', 'g')) > 0 and length(regexp_replace(i.label, '[^a-z]', '', 'g')) > 0 then list_cosine_similarity({_vec('t.text')}, {_vec('i.label')}) end, 0.0), 9) as score
            from {texts} t cross join {idx} i""",
        f"{p}rank": f"select *, row_number() over (partition by text order by score desc, label_idx) as rn from {p}sim qualify rn <= {d.pair_top_k}",
        f"{p}best": f"""select a.text, a.canonical as guess, a.uri as guess_uri, a.label as guess_label, a.score, a.score - b.score as margin,
            case when a.score >= {d.similarity} then 'embedding' when a.score >= {d.margin_min_score} and a.score - b.score >= {d.margin} then 'embedding_margin' end as method
            from {p}rank a left join {p}rank b on a.text = b.text and b.rn = 2 where a.rn = 1""",
        f"{p}ce": f"""select text, canonical as ce_canonical, uri as ce_uri, label as ce_label, ce_score from (
            select *, {jaccard} as ce_score from {p}rank where text in (select text from {p}best where method is null))
            qualify row_number() over (partition by text order by ce_score desc, rn) = 1""",
        f"{p}scores": f"""select text, guess, score, margin, ce_score,
            case when method is not null then guess when ce_score >= {d.pair_score} then ce_canonical end as canonical,
            case when method is not null then guess_uri when ce_score >= {d.pair_score} then ce_uri end as uri,
            case when method is not null then guess_label when ce_score >= {d.pair_score} then ce_label end as label,
            case when method is not null then score when ce_score >= {d.pair_score} then ce_score end as match_score,
            coalesce(method, case when ce_score >= {d.pair_score} then 'embedding_ce' end) as method
            from {p}best left join {p}ce using (text)""",
    }


def _index(skip: bool) -> str:
    generic = f"and not list_contains({_GENERIC}, label_key)" if skip else ""
    return f"""select row_number() over (order by pos, v) - 1 as label_idx, label, uri, label_key, canonical, description from (
        select *, row_number() over (partition by label_key order by pos, v) as rn from (
          select uri, canonical, description, pos, label, v, {norm('label')} as label_key from concepts, unnest(variants) with ordinality as u(label, v))
        where label_key <> '' {generic}) where rn = 1"""


CTES: dict[str, str] = {
    "titles": f"select p_partkey as job_id, case when p_partkey % 97 <> 0 then {_TITLE} end as title from part",
    "names": "select p_name, min(p_partkey) as first, row_number() over (order by p_name) - 1 as ord, lead(p_name) over (order by p_name) as next from part group by p_name",
    "taxonomy": """select 'c' || first as uri, p_name as canonical,
        case ord % 3 when 0 then split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) || chr(10) || ' ' || coalesce(next, '') when 1 then 'The ' || p_name end as alt,
        case ord % 5 when 0 then 'Manager' when 1 then split_part(p_name, ' ', 2) end as hidden,
        case when ord % 2 = 0 then 'Makes a ' || p_name end as description, lpad((first % 25)::varchar, 4, '0') as isco_group, ord from names where ord % 4 <> 3""",
    "concepts": f"""select uri, canonical, description, isco_group, ord as pos, list_sort(list_distinct(list_filter(list_transform(
        list_concat([canonical], list_concat(string_split(coalesce(alt, ''), chr(10)), string_split(coalesce(hidden, ''), chr(10)))), lambda y: {strip('y')}), lambda y: y <> ''))) as variants from taxonomy""",
    "lookup": f"select {norm('label')} as label_key, arg_min(uri, pos) as uri from (select uri, pos, unnest(variants) as label from concepts) group by 1",
    "targets": "select label_key, uri, canonical from lookup join concepts using (uri)",
    "forms": f"select title, list_filter({_forms()}, lambda y: y is not null) as forms from ({cleaned('select distinct title from titles where title is not null', 'title')})",
    "cand": f"""select title, text, label_key, row_number() over (partition by title order by i) - 1 as place from (
        select title, text, i, {norm('text')} as label_key from forms, unnest(forms) with ordinality as u(text, i)
        where {norm('text')} <> '' and not list_contains({_GENERIC}, {norm('text')}) qualify row_number() over (partition by title, {norm('text')} order by i) = 1)""",
    "texact": f"""select m.title, m.occupation, l.uri from (select title, arg_min(canonical, place) as occupation from cand join targets using (label_key) group by title) m
        left join lookup l on l.label_key = {norm('m.occupation')}""",
    "prepared": _prepared(),
    "idx": _index(True),
    "sidx": _index(False),
    "ttexts": f"select distinct text from prepared where text <> '' and not list_contains({_GENERIC}, text) and title not in (select title from texact)",
    **_scores("t", "ttexts", "idx"),
    "title_rows": f"""select r.job_id, r.title, coalesce(e.occupation, s.canonical) as esco_occupation,
        case when e.title is not null then 'exact' else s.method end as match_method, case when e.title is not null then 1.0 else s.match_score end as esco_score,
        coalesce(e.occupation, s.label) as esco_matched_label, case when e.title is not null then e.uri else s.uri end as esco_uri,
        s.guess as esco_best_guess, s.score as esco_best_score, s.margin as esco_best_margin, s.ce_score as esco_ce_score
        from %s r left join texact e on e.title = r.title left join prepared p on p.title = r.title and e.title is null and not list_contains({_GENERIC}, p.text)
        left join tscores s on s.text = p.text""",
    "terms": """select l_orderkey as job_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) as pos, case (l_orderkey + l_linenumber) % 5 when 0 then p_name when 1 then ' ' || upper(p_name) || '!'
        when 2 then p_name || ' handling' when 3 then p_name || 's' else ' ' end as raw from lineitem join part on l_partkey = p_partkey""",
    "corpus": "select o_orderkey as job_id, title from orders left join titles t on t.job_id = o_custkey",
    "sexact": f"select raw, canonical from (select distinct raw, {norm('raw')} as label_key from terms) join targets using (label_key)",
    "stexts": f"select distinct {strip('raw')} as text from terms where raw not in (select raw from sexact) and {strip('raw')} <> ''",
    **_scores("s", "stexts", "sidx"),
    "slots": f"""select t.job_id, t.pos, t.raw, coalesce(e.canonical, s.canonical) as canonical, case when e.raw is not null then 'exact' else s.method end as method
        from terms t left join sexact e on e.raw = t.raw left join sscores s on e.raw is null and s.text = {strip('t.raw')}""",
    "skill_rows": """select o.job_id, count(raw) as n_terms, coalesce(count_if(method = 'exact'), 0)::bigint as n_skills_exact, coalesce(count_if(method = 'embedding'), 0)::bigint as n_skills_embedding,
        coalesce(count_if(method = 'embedding_margin'), 0)::bigint as n_skills_embedding_margin, coalesce(count_if(method = 'embedding_ce'), 0)::bigint as n_skills_embedding_ce,
        coalesce(string_agg(coalesce(canonical, ''), ' | ' order by pos) filter (raw is not null), '') as skills,
        coalesce(string_agg(coalesce(method, ''), ' | ' order by pos) filter (raw is not null), '') as methods,
        coalesce(string_agg(raw, ' | ' order by pos) filter (raw is not null and method is null), '') as dropped,
        coalesce(string_agg(raw, ' | ' order by pos), '') as original, count(canonical) as n_matched
        from (select o_orderkey as job_id from orders) o left join slots using (job_id) group by o.job_id""",
    "groups": "select lpad(n_nationkey::varchar, 4, '0') as code, n_name as label from nation union all select lpad(r_regionkey::varchar, 2, '0'), r_name from region",
}
CTES["trows"] = CTES["title_rows"] % "titles"
CTES["crows"] = CTES.pop("title_rows") % "corpus"


def sql(query: str) -> str:
    """The query after the CTEs it needs."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                visit(CTES[name])
                if name not in need:
                    need.append(name)

    visit(query)
    if not need:
        return query
    rest = ",\n" + query.strip().removeprefix("with ") if query.strip().startswith("with ") else "\n" + query
    return "with " + ",\n".join(f"{n} as materialized ({CTES[n]})" for n in need) + rest
