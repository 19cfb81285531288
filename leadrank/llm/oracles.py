"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_ORACLES: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)

# Every item laid over every text at every offset where at least one word agrees.
_ORACLES["op3_decontamination"] = r"""
with d as (
  select doc_id, row_number() over () as r, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') as w from documents where text is not null
), b as (
  select item_id, row_number() over () as r, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
  from benchmark where text is not null
), dw as (
  select doc_id, r as dr, unnest(w) as word, generate_subscripts(w, 1) as pos from d
), bw as (
  select item_id, r as br, len(w) as n, unnest(w) as word, generate_subscripts(w, 1) as j from b
), m as (
  select doc_id, dr, item_id, br, n, count(*) as n_matched from dw join bw using (word)
  group by doc_id, dr, item_id, br, n, pos - j having count(*) >= 0.8 * n
)
select doc_id, item_id, max(n_matched)::integer as n_matched, max(n)::integer as n_words, round(max(n_matched) / max(n), 6) as overlap
from m group by doc_id, item_id
"""

_ORACLES["op1_quantised"] = r"""
with recursive good as materialized (
  select row_number() over () as r, vec_id, embedding::double[] as v from embeddings
  where len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as materialized (
  select a.r as a, b.r as b from good a join good b on a.r <> b.r and len(a.v) = len(b.v)
  where list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.95
), reach as (
  select r as a, r as b from good
  union
  select reach.a, pairs.b from reach join pairs on reach.b = pairs.a
), named as (
  select reach.a as r, min(good.vec_id) as component_id from reach join good on good.r = reach.b group by reach.a
), counted as (
  select a as r, count(*) as n from pairs group by a
)
select g.vec_id, coalesce(c.n, 0)::bigint as n_links, n.component_id, g.vec_id is not distinct from n.component_id as kept
from good g join named n using (r) left join counted c using (r)
union all
select vec_id, 0::bigint, vec_id, true from embeddings
where not coalesce(len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0, false)
"""

_ORACLES["op2_warc"] = r"""
with p as materialized (
  select row_number() over () as r, page_id, encode(coalesce(html, '')) as body from pages
), d as (
  select r, page_id, octet_length(body)::bigint as payload_bytes, sha1(body) as hexa from p
), bits as (
  select *, list_aggregate(list_transform(range(1, 41), lambda i:
           lpad(bin(('0x' || substr(hexa, i::integer, 1))::integer), 4, '0')), 'string_agg', '') as bit from d
), coded as (
  select page_id, payload_bytes,
         list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (1 + 16 * substr(bit, (5 * i + 1)::integer, 1)::integer + 8 * substr(bit, (5 * i + 2)::integer, 1)::integer
              + 4 * substr(bit, (5 * i + 3)::integer, 1)::integer + 2 * substr(bit, (5 * i + 4)::integer, 1)::integer
              + substr(bit, (5 * i + 5)::integer, 1)::integer), 1)), 'string_agg', '') as payload_digest
  from bits
), lasts as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as last from coded
)
select page_id, payload_bytes, payload_digest, case when page_id = last then 'response' else 'revisit' end as record_type,
       case when page_id <> last then last end as refers_to
from lasts
"""

# The three patterns, letters of the first in either case.
_SECRETS = {
    "assign": (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]+", 0, 16),
}


def _secret_kind(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind by what lies before each: the parts between matches and the matches."""
    return f"""
select r, {number} as kind, '{kind}' as name, a, a + len(m) as b from (
  select r, m, i, list_sum(list_transform(gaps[1:i], lambda x: len(x)))::bigint
            + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: len(x))), 0)::bigint as a
  from (select r, gaps, found, unnest(found) as m, generate_subscripts(found, 1) as i from (
    select r, regexp_split_to_array(t, '{pattern}') as gaps, regexp_extract_all(t, '{pattern}') as found from t)))
where len(regexp_extract(m, '{pattern}', {group})) >= {least}"""


_ORACLES["op6_secrets"] = (
    "with t as materialized (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents), f as ("
    + " union all ".join(_secret_kind(k, name, *of) for k, (name, of) in enumerate(_SECRETS.items()))
    + r"""), g as (
  select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
         string_agg(name || ':' || a || ':' || b, ',' order by a, kind) as spans from f group by r
)
select t.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from t left join g using (r)"""
)

_ORACLES["op7_substrings"] = r"""
with d as materialized (
  select row_number() over () as r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), s as materialized (
  select r, doc_id, start, array_to_string(w[start:start + 49], ' ') as passage
  from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as start from d where len(w) >= 50 and doc_id is not null)
), f as (
  select passage, min(doc_id) as first from s group by passage having min(doc_id) < max(doc_id)
), gone as (
  select distinct r, unnest(range(start, start + 50)) as place from s join f using (passage) where doc_id > first
), of as (
  select r, list(place) as places from gone group by r
), kept as (
  select d.doc_id, d.w, coalesce(len(o.places), 0) as n,
         case when o.places is null then d.w
              else (select list(x.word order by x.place) from (select unnest(d.w) as word, generate_subscripts(d.w, 1) as place) x
                    where not list_contains(o.places, x.place)) end as left_words
  from d left join of o using (r)
)
select doc_id, len(w)::bigint as n_words, n::bigint as n_removed, sha256(coalesce(array_to_string(left_words, ' '), '')) as kept_sha256 from kept
"""


def _clusters(rounds: int = 3, clusters: int = 16, dims: int = 64) -> str:
    """Unrolled rounds; distances and means in whole numbers."""
    steps = f"""
with p as materialized (
  select row_number() over () as r, vec_id, [floor({dims} * x::double)::bigint for x in embedding] as x from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('1:' || vec_id) nulls last, x) - 1 as k, x from p
  qualify k < {clusters}
)"""
    for n in range(rounds + 1):
        steps += f""", a{n} as materialized (
  select p.r, p.vec_id, p.x, c.k, list_sum(list_transform(range(1, {dims + 1}), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))::bigint as d
  from p, c{n} c qualify row_number() over (partition by p.r order by d, c.k) = 1
)"""
        if n < rounds:
            steps += f""", m{n} as materialized (
  select k, list((s - ((s % n) + n) % n) // n order by j) as x from (
    select k, j, sum(v)::bigint as s, count(*) as n from (select k, unnest(x) as v, generate_subscripts(x, 1) as j from a{n}) group by k, j
  ) group by k
), c{n + 1} as materialized (select c.k, coalesce(m.x, c.x) as x from c{n} c left join m{n} m using (k))"""
    return steps + f"""
select a.vec_id, a.k::integer as "cluster", a.d as distance, sum(a.d) over (partition by a.k)::bigint as cluster_inertia,
       sum(a.d) over ()::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c using (k)"""


_ORACLES["op11_clusters"] = _clusters()
