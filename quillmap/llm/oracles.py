"""SQL for joins that it can express, though only on small tables: it compares every pair of shingles and every window."""

NEAR_SETS = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
r as (select doc_id as s, doc_id as t from documents union select r.s, l.b from r join l on l.a = r.t),
m as (select s, min(t) as component_id from r group by s)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept from documents d join m on m.s = d.doc_id left join n on n.doc_id = d.doc_id
"""

REPEATS = """
with b as (select doc_id, hex(encode(coalesce(text, ''))) as hx, strlen(coalesce(text, '')) as n from documents),
q as (select doc_id, n, 150 * j as o, substr(hx, 300 * j + 1, 398) as px from (select doc_id, hx, n, unnest(range((n + 149) // 150)) as j from b)),
y as (select doc_id, o + i as i, n, px, i as z from (select *, unnest(range(least(150, n - o))) as i from q)),
w as (select doc_id, i, substr(px, 2 * z + 1, 100) as g from y where i + 50 <= n),
f as (select g, min(doc_id) as first from w group by g),
h as (select doc_id, i from w join f using (g) where first < doc_id),
c as (select doc_id, i, substr(px, 2 * z + 1, 2) as x from y),
v as (select c.doc_id, c.i, x, coalesce(max(case when h.i is not null then 1 else 0 end) over (partition by c.doc_id order by c.i rows between 49 preceding and current row), 0) = 1 as gone
  from c left join h on h.doc_id = c.doc_id and h.i = c.i),
e as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as opens from v),
k as (select doc_id, count_if(gone)::bigint as n_removed, count_if(opens)::bigint as n_spans, unhex(coalesce(string_agg(x, '' order by i) filter (not gone), '')) as kept from e group by doc_id)
select b.doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(coalesce(kept, ''::blob)) as kept_sha256 from b left join k using (doc_id)
"""
