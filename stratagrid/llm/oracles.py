"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import mixing, prefix_trie, resample

SQL: dict[str, str] = {
    "op4_source_mixing": mixing.oracle_sql(),
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_importance_resampling": resample.ORACLE_SQL,
    "op2_embedding_near_dedup": """
with recursive v as (
  select vec_id, label, embedding::double[] e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding::double[], lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
c as (select a, min(b) b from reach group by a),
n as (select a, count(*) n from links group by a)
select vec_id, coalesce(n, 0)::bigint n_links, least(vec_id, coalesce(c.b, vec_id)) component_id, least(vec_id, coalesce(c.b, vec_id)) = vec_id kept
from embeddings left join c on c.a = vec_id left join n on n.a = vec_id""",
    "op5_benchmark_decontamination": r"""
with d as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
i as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where text is not null),
win as (select distinct item_id, least(13, len(w)) n, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') t from (select *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) s from i where len(w) > 0)),
sizes as (select distinct n from win),
pos as (select doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') t from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) s from d, sizes where len(w) >= n)),
occ as materialized (select doc_id, s, n, item_id from pos join win using (n, t)),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from occ) group by 1),
its as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) ids from occ group by 1),
bw as materialized (select row_number() over () wid, item_id, v from (select distinct item_id, w[s : s + least(13, len(w)) - 1] v from (select *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) s from i where len(w) > 0))),
terms as (select wid, t, min(o) o from (select wid, unnest(v) t, generate_subscripts(v, 1) o from bw) group by 1, 2),
dpos as materialized (select doc_id, t, p from (select doc_id, unnest(w) t, generate_subscripts(w, 1) p from d) where t in (select t from terms)),
freq as (select t, count(*) f from dpos group by 1),
rare as materialized (select wid, t, k, max(k) over (partition by wid) m from (select wid, t, row_number() over (partition by wid order by coalesce(f, 0), o) k from terms left join freq using (t)) where k <= 3),
near as (select distinct doc_id, item_id from (select l.wid, l.doc_id, l.p from (select wid, doc_id, p from rare join dpos using (t) where k = 1) l join rare r on r.wid = l.wid join dpos q on q.doc_id = l.doc_id and q.t = r.t and abs(q.p - l.p) <= 24
  group by all having count(distinct r.k) = any_value(r.m)) join bw using (wid)),
nears as (select doc_id, string_agg(item_id::varchar, ',' order by item_id::varchar) near_items from near group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(near_items, '') near_items,
  coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) contaminated
from d left join hit using (doc_id) left join its using (doc_id) left join nears using (doc_id)""",
}


def _secrets() -> str:
    from . import secret_scan as s

    kinds = [(s.ASSIGN, s.ASSIGN_LENGTH, 2), (s.ACCESS, s.ACCESS_LENGTH, 0), (s.HEX, s.HEX_LENGTH, 0), (s.NAME, 0, 0), (s.TOKEN, 0, 0), (s.ENDPOINT, 0, 0)]
    parts = []
    for k, (pattern, least, group) in enumerate(kinds):
        p = pattern.replace("'", "''")
        parts.append(
            f"select doc_id, {k} k, start, stop from (select doc_id, g, sum(length(gap) + length(m)) over (partition by doc_id order by i) as stop, stop - length(m) as start from"
            f" (select doc_id, unnest(regexp_extract_all(t, '{p}')) m, unnest(regexp_split_to_array(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) gap,"
            f" unnest(regexp_extract_all(t, '{p}', {group})) g, generate_subscripts(regexp_extract_all(t, '{p}'), 1) i from d)) where length(g) >= {least}"
        )
    names = "['" + "', '".join(s.KINDS) + "']"
    listed = lambda cond: f"string_agg({names}[k + 1] || ':' || start::bigint || ':' || stop::bigint, ',' order by start, k, stop) filter ({cond})"
    return (
        "with d as materialized (select doc_id, coalesce(text, '') t from documents),\nx as materialized (" + "\nunion all ".join(parts) + "),\n"
        "w as (select distinct w.* from x w join x o on w.doc_id = o.doc_id and w.k >= 3 and case when w.k = 4 then o.k in (1, 3, 5) else o.k in (0, 2, 4) end"
        f" and (o.stop <= w.start or w.stop <= o.start) and o.start - w.stop <= {s.SCOPE} and w.start - o.stop <= {s.SCOPE}),\n"
        "l as (select * from w where not exists (select 1 from x o where o.doc_id = w.doc_id and o.k < 3 and o.start < w.stop and w.start < o.stop)),\n"
        "a as (select * from x where k < 3 union all select * from l),\n"
        f"g as (select doc_id, count(*) filter (k = 0) n0, count(*) filter (k = 1) n1, count(*) filter (k = 2) n2, count(*) filter (k >= 3) n3, {listed('k < 3')} base, {listed('true')} every from a group by 1)\n"
        "select d.doc_id, coalesce(n0, 0)::bigint n_assign, coalesce(n1, 0)::bigint n_access, coalesce(n2, 0)::bigint n_hex, coalesce(n3, 0)::bigint n_linked, sha256(coalesce(base, '')) base_sha256, coalesce(every, '') spans from d left join g using (doc_id)"
    )


SQL["op10_secret_scan"] = _secrets()


def _licenses() -> str:
    """Containment in every window of every text, without anchors or MinHash."""
    from . import license_scan as s

    text = lambda x: "'" + x.replace("'", "''") + "'"
    rows = []
    for name, template in s.TEMPLATES.items():
        w = s.words(template)
        _, stride, size = s.length_class(len(w))
        rows.append(f"({text(name)}, {stride}, {size}, [{', '.join(text(x) for x in sorted(s.shingles(w)))}])")
    return (
        "with d as materialized (select row_number() over () r, doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') w from documents),\n"
        f"t(license, stride, size, t) as (values {', '.join(rows)}),\nk as materialized (select license, stride, size, len(t) n, unnest(t) s from t),\n"
        f"p as (select r, doc_id, p, array_to_string(w[p + 1 : p + {s.SHINGLE}], ' ') s from (select r, doc_id, w, unnest(range(0, len(w) - {s.SHINGLE - 1})) p from d)),\n"
        "hit as (select r, doc_id, license, stride, size, n, p, s from p join k using (s)),\n"
        f"win as (select r, doc_id, license, n, start, count(distinct s) c from (select *, unnest(range(greatest(0, ceil((p + {s.SHINGLE} - size) / stride))::bigint, p // stride + 1)) * stride as start from hit) group by all)\n"
        f"select doc_id, license, round(max(c::double / n), 6) containment, min(start)::bigint first_word from win where c::double / n >= {s.THRESHOLD} - 1e-9 group by 1, 2"
    )


SQL["op3_license_scan"] = _licenses()

#: J is at most the share of either document's shingles (by weight) that the other has, which picks the pairs to compute.
SQL["op1_minhash_near_dedup"] = r"""
with recursive d as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
s as materialized (select doc_id, hash(t) t, count(*)::double n from (select doc_id, unnest([array_to_string(w[i : i + 4], ' ') for i in range(1, greatest(2, len(w) - 3))]) t from d where len(w) > 0) group by 1, 2),
total as (select doc_id, sum(n) n from s group by 1),
p as materialized (select a.doc_id a, b.doc_id b from s a join s b on a.t = b.t and a.doc_id < b.doc_id join total ta on ta.doc_id = a.doc_id join total tb on tb.doc_id = b.doc_id
  group by all having sum(a.n) >= 0.8 * any_value(ta.n) - 1e-9 and sum(b.n) >= 0.8 * any_value(tb.n) - 1e-9),
u as materialized (select a, b, t, sum(x) x, sum(y) y from (select a, b, t, n x, 0.0::double y from p join s on doc_id = a union all select a, b, t, 0.0, n from p join s on doc_id = b) group by 1, 2, 3),
r as materialized (select a, b, case when y > 0 then x / y end ratio, sum(x) x, sum(y) y from u group by 1, 2, 3),
j as (select i.a, i.b, sum(i.x / f) j from (select i.a, i.b, i.ratio, any_value(i.x) x, sum(case when k.ratio <= i.ratio then i.ratio * k.y else k.x end) f
  from r i join r k on i.a = k.a and i.b = k.b where i.x > 0 and i.y > 0 group by 1, 2, 3) i group by 1, 2),
links as materialized (select a, b from j where j >= 0.8 - 1e-9 union select b, a from j where j >= 0.8 - 1e-9),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
c as (select a, min(b) b from reach group by 1)
select doc_id, least(doc_id, coalesce(b, doc_id)) class_id, len(w)::bigint n_words, least(doc_id, coalesce(b, doc_id)) = doc_id kept from d left join c on a = doc_id"""
