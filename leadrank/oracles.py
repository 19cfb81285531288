"""The queries of ``queries.py`` in DuckDB SQL, over the same tables."""

from __future__ import annotations

from leadrank import fixtures as X
from leadrank.functions.contacts import FIELDS, OTHER_RANK, SLOTS, TITLE_RANKS, slot_column

# Whitespace class and characters as DuckDB writes them.
WS = r"[ \t\n\r\f\x0B]+"
TRIM = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# Characters that Unicode word boundaries count as part of a word.
WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0::DOUBLE"


def words(col: str) -> str:
    return f"CASE WHEN trim({col}, {TRIM}) = '' THEN 0 ELSE len(regexp_split_to_array(trim({col}, {TRIM}), '{WS}')) END"


def clean(col: str) -> str:
    return f"lower(trim(coalesce({col}, ''), {TRIM}))"


KEYS = "phrases(name, weight) AS (VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in X.PHRASES.items()) + ")"
DOCS = "docs AS (SELECT doc_id AS company_id, text AS d, lang, source FROM documents)"

# Dense vectors, keys and sectors.

VECS = """
vecs AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
normed AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM vecs),
unit AS (SELECT vec_id, label, list_transform(v, lambda x: x / n) AS u FROM normed)"""

KEYVECS = """
key_raw AS (SELECT 'key ' || label AS name, 1.0::DOUBLE + label % 5 AS weight, arg_min(v, vec_id) AS v FROM vecs GROUP BY label),
key_norm AS (SELECT name, weight, v, sqrt(list_dot_product(v, v)) AS n FROM key_raw),
keys AS (SELECT name, weight, list_transform(v, lambda x: x / n) AS k FROM key_norm)"""

SECTORVECS = """
sector_dims AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM vecs) GROUP BY label, i),
sector_raw AS (SELECT 'sector ' || label AS name, 1.0::DOUBLE AS weight, list(x ORDER BY i) AS v FROM sector_dims GROUP BY label),
sector_norm AS (SELECT name, weight, v, sqrt(list_dot_product(v, v)) AS n FROM sector_raw),
sectors AS (SELECT name, weight, list_transform(v, lambda x: x / n) AS k FROM sector_norm)"""


def dist(c: str) -> str:
    return f"CASE WHEN 1.0 - {c} < 1e-12 THEN 0.0 ELSE sqrt((1.0 - {c}) * 2.0) END"


def sim(c: str, mode: str) -> str:
    return {
        "cosine": c,
        "euclid": dist(c),
        "mult": f"({dist(c)}) * ({c} + 1.0) / 2.0",
        "legacy_mult": f"({dist(c)}) * {c}",
        "add": f"({c} + 1.0) * 0.25 + 0.5 / (({dist(c)}) + 1.0)",
    }[mode]


def pairs(keys: str, out: str, mode: str) -> str:
    return f"""
{out}_c AS (SELECT vec_id, name, weight, list_dot_product(u, k) AS c FROM unit, {keys}),
{out} AS (SELECT vec_id, name, weight, {sim('c', mode)} AS sim FROM {out}_c)"""


def soft(pairs_name: str, out: str, row_id: str = "vec_id") -> str:
    return f"""
{out}_idf AS (SELECT name, CASE WHEN sum(sim) > 0 THEN ln(count(*) / sum(sim)) END AS idf FROM {pairs_name} GROUP BY name),
{out} AS (SELECT {row_id}, sum(coalesce(sim * idf * weight, 0)) AS x FROM {pairs_name} JOIN {out}_idf USING (name) GROUP BY {row_id})"""


def minmax(x: str) -> str:
    return f"CASE WHEN max({x}) OVER () > min({x}) OVER () THEN ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) ELSE 0.0 END"


def combine(how: str, row_id: str = "vec_id") -> str:
    """``kw`` and ``se`` to ``scored``."""
    if how == "sum":
        return f"""
raw AS (SELECT {row_id}, kw.x AS keyword_score, se.x AS sector_score, kw.x + se.x AS x FROM kw JOIN se USING ({row_id})),
scored AS (SELECT {row_id}, keyword_score, sector_score, {minmax('x')} AS score FROM raw)"""
    return f"""
parts AS (SELECT {row_id}, {minmax('kw.x')} AS keyword_score, {minmax('se.x')} AS sector_score FROM kw JOIN se USING ({row_id})),
raw AS (SELECT *, keyword_score * sector_score AS x FROM parts),
scored AS (SELECT {row_id}, keyword_score, sector_score, {minmax('x')} AS score FROM raw)"""


def scores_out(row_id: str, rank: bool) -> str:
    cols = ", ".join(f"{r6(c)} AS {c}" for c in ("keyword_score", "sector_score", "score"))
    tail = f", row_number() OVER (ORDER BY round(scored.score, 9) DESC, {row_id}) AS rank" if rank else ""
    return f"SELECT {row_id}, {cols}{tail} FROM scored"


def dense_scores(mode: str, how: str, rank: bool) -> str:
    ctes = [VECS, KEYVECS, SECTORVECS, pairs("keys", "kp", mode), pairs("sectors", "sp", mode)]
    ctes += [soft("kp", "kw"), soft("sp", "se"), combine(how)]
    return "WITH " + ",".join(ctes) + " " + scores_out("vec_id", rank)


def pair_query(keys: str, mode: str) -> str:
    return "WITH " + ",".join([VECS, KEYVECS, SECTORVECS, pairs(keys, "p", mode)]) + f" SELECT vec_id, name, {r6('sim')} AS sim FROM p"


def best_sector(mode: str) -> str:
    return "WITH " + ",".join([VECS, SECTORVECS, pairs("sectors", "p", mode)]) + f"""
SELECT vec_id, name AS predicted_sector, {r6('sim')} AS sim FROM p
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, name) = 1"""


# Hashed text vectors.


def hashed(source: str, row_id: str, text: str, dims: int, out: str) -> str:
    """``out(row_id, dim, n)`` and ``out_v(row_id, dim, v)`` with unit length."""
    return f"""
{out}_tok AS (SELECT {row_id}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS tok FROM {source}),
{out} AS (SELECT {row_id}, (('0x' || substr(md5(tok), 1, 8))::BIGINT % {dims})::INTEGER AS dim, count(*) AS n
  FROM {out}_tok WHERE tok <> '' GROUP BY ALL),
{out}_norm AS (SELECT {row_id}, sqrt(sum(n::DOUBLE * n)) AS norm FROM {out} GROUP BY {row_id}),
{out}_v AS (SELECT {row_id}, dim, n / norm AS v FROM {out} JOIN {out}_norm USING ({row_id}))"""


SECTOR_PHRASES = (
    "sector_phrases AS (SELECT DISTINCT unnest(string_split(regexp_replace("
    f"'{X.SECTOR_TEXT}', '([.?!])[\\s\\x0B]+([A-Za-z])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS name, 1.0::DOUBLE AS weight)"
)


def text_pairs(keys: str, out: str, dims: int, row_id: str = "company_id") -> str:
    """Similarities of documents (``dv``) to the phrases of a key table."""
    return (
        hashed(keys, "name", "name", dims, f"{out}_k")
        + f""",
{out}_dot AS (SELECT {row_id}, name, sum(dv_v.v * {out}_k_v.v) AS c FROM dv_v JOIN {out}_k_v USING (dim) GROUP BY ALL),
{out}_c AS (SELECT d.{row_id}, k.name, k.weight, coalesce(x.c, 0.0) AS c FROM dv_norm d CROSS JOIN {keys} k
  LEFT JOIN {out}_dot x ON x.{row_id} = d.{row_id} AND x.name = k.name),
{out} AS (SELECT {row_id}, name, weight, {sim('c', 'mult')} AS sim FROM {out}_c)"""
    )


def text_scored(source: str, dims: int) -> list[str]:
    return [
        KEYS,
        SECTOR_PHRASES,
        hashed(source, "company_id", "d", dims, "dv"),
        text_pairs("phrases", "kp", dims),
        text_pairs("sector_phrases", "sp", dims),
        soft("kp", "kw", "company_id"),
        soft("sp", "se", "company_id"),
        combine("sum", "company_id"),
    ]


# Phrase counts. RE2 has ASCII word boundaries only, so non-word characters are
# doubled and each match takes one of them on either side.


def spread_words(col: str) -> str:
    return f"chr(10) || regexp_replace({col}, '([^{WORD}])', '\\1\\1', 'g') || chr(10)"


def phrase_counts(source: str, row_id: str, text: str) -> str:
    # One branch per phrase, so that each pattern is a constant.
    branches = [
        f"SELECT {row_id}, '{name}' AS name, {weight}::DOUBLE AS weight, "
        f"len(regexp_extract_all(t, '[^{WORD}]{name.replace(' ', '  ')}[^{WORD}]'))::BIGINT AS n FROM spread"
        for name, weight in X.PHRASES.items()
    ]
    return f"""
spread AS MATERIALIZED (SELECT {row_id}, {spread_words(f'lower({text})')} AS t FROM {source}),
counts AS ({' UNION ALL '.join(branches)})"""


def spaced(col: str) -> str:
    marked = f"regexp_replace(lower({col}), '([^\\p{{L}}\\p{{M}}\\p{{N}}_ \\t\\n\\r\\f\\x0B])', ' \\1 ', 'g')"
    return f"trim(regexp_replace({marked}, '{WS}', ' ', 'g'), {TRIM})"


PRESENCE = "sum(weight * (n + CASE WHEN n > 0 THEN 2 ELSE 0 END))"

TF = f"""
tf AS (SELECT company_id, name, weight,
  ((length(d) - length(replace(d, name, ''))) // length(name)) / nullif({words('d')}, 0)::DOUBLE AS tf FROM docs, phrases),
dfs AS (SELECT name, count(*) FILTER (contains(d, name)) AS docs_with, count(*) AS total FROM docs, phrases GROUP BY name),
idfs AS (SELECT name, docs_with, ln(total / (1 + docs_with)) AS idf FROM dfs),
cells AS (SELECT company_id, name, weight, tf, idf, tf * idf AS tfidf FROM tf JOIN idfs USING (name))"""

# Contacts.



def contact(field: str, slot: int) -> str:
    step, values = X.contact_rule(field, slot)
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE (c_custkey + {step}) % {len(values) + 1} {cases} END"


PEOPLE = "people AS (" + " UNION ALL ".join(
    f"SELECT c_custkey AS company_id, {slot} AS slot, "
    + ", ".join(f"{clean(contact(f, slot))} AS {f}" for f in FIELDS)
    + " FROM customer"
    for slot in SLOTS
) + ")"

PLAUSIBLE = f"""
kept AS (SELECT *, string_split(email, '@') AS parts, lower(trim(string_split(email, '@')[1], {TRIM})) AS local FROM people
  WHERE (first_name <> '' OR last_name <> '') AND email <> ''),
good AS (SELECT company_id, slot, title, first_name, last_name, email FROM kept
  WHERE len(parts) = 2 AND contains(parts[2], '.')
    AND (contains(local, first_name) OR contains(local, last_name)
      OR (length(local) <= 3 AND contains(local, substr(first_name, 1, 1)) AND contains(local, substr(last_name, 1, 1)))))"""

TITLE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(title, '{w}')" for w in found) + f" THEN {rank}" for rank, found in TITLE_RANKS
) + f" ELSE {OTHER_RANK} END"

PLACED = f"""
placed AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY {TITLE}, slot) AS place FROM good)"""

COMPACT = (
    "compact AS (SELECT c_custkey AS company_id, "
    + ", ".join(
        f"coalesce(max({f}) FILTER (place = {slot}), '') AS \"{slot_column(f, slot)}\"" for slot in SLOTS for f in FIELDS
    )
    + " FROM customer LEFT JOIN placed ON company_id = c_custkey GROUP BY c_custkey)"
)
CONTACTS = ", ".join([PEOPLE, PLAUSIBLE, PLACED, COMPACT])
EMAIL_1 = f'"{slot_column("email", 1)}"'

# Mail.

MAIL = """
mail AS (SELECT conv_id || '-' || turn AS message_id, turn AS sent, CASE WHEN role IN ('assistant', 'system') THEN 'to' ELSE 'from' END AS direction,
  'c' || conv_id || '@mail.example.com' AS email, 'Subject: Conversation ' || conv_id || chr(10) || chr(10) || text AS content
  FROM conversations),
contacts AS (SELECT DISTINCT 'c' || id || '@mail.example.com' AS email FROM
  (SELECT conv_id AS id FROM conversations UNION ALL SELECT c_custkey FROM customer)),
matched AS (SELECT email, direction, message_id, sent, content FROM mail JOIN contacts USING (email)),
indexed AS (SELECT *, row_number() OVER (PARTITION BY email, direction ORDER BY sent, message_id) AS message_index FROM matched)"""

# Pages.


def without(text: str, opening: str, closing: str) -> str:
    """Text with everything from each opening to its closing (or the end) cut out, piece by piece."""
    pieces = f"regexp_split_to_array({text}, '{opening}')"
    return (
        f"list_reduce(list_prepend('', list_transform({pieces}, lambda p, i: CASE WHEN i = 1 THEN p "
        f"ELSE ' ' || regexp_replace(p, '(?is)^.*?({closing}|\\z)', '') END)), lambda x, y: x || y)"
    )


def visible(html: str) -> str:
    """Text of a page by cutting: comments, elements that are not shown, then tags with their quoted values."""
    out = without(html, "<!--", "-->")
    for element in ("script", "style", "title"):
        out = without(out, f"(?i)<{element}[\\s/>]", f"</{element}\\s*>")
    tag = """<(?:/?[A-Za-z](?:[^>"'']|"[^"]*"|''[^'']*'')*|[!?][^>]*)>"""
    out = f"regexp_replace({out}, '{tag}', ' ', 'g')"
    # The entities of the test pages; the ampersand comes last.
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim(regexp_replace({out}, '{WS}', ' ', 'g'), {TRIM})"


SITE_PAGES = f"""
sited AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS site,
  regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, html FROM pages),
site_pages AS (SELECT site, page_id, {visible('html')} AS text FROM sited
  QUALIFY page_id = min(page_id) OVER (PARTITION BY site) OR regexp_matches(path, '^/en(/|$)'))"""

# Form requests, as the fixture makes them.

FORMS = """
form AS (SELECT c_custkey, c_acctbal, '2024-01-01 00:00:00' AS submitted, lower(c_name) || '@mail.example.com' AS email,
  c_mktsegment || ' goods. Nation ' || c_nationkey AS sector,
  '"' || lower(c_mktsegment) || '"=' || c_nationkey || ',' || chr(10) || 'and the' || chr(10) || chr(10) || 'a=b=c' || chr(10)
    || 'of the=2' || chr(10) || 'of the=3.5' || CASE WHEN c_acctbal < 0 THEN chr(10) || 'broken=many' ELSE '' END AS phrases,
  'https://files.example.com/open?id= f' || c_custkey AS link, 'f' || c_custkey AS file_id FROM customer),
parsed AS (SELECT *, sha256(concat_ws(chr(31), submitted, email, sector, phrases, link)) AS request_id,
  CASE WHEN c_acctbal < 0 THEN 'a weight is not a number' END AS error FROM form)"""

REQUEST_LINES = """
lines AS (SELECT request_id, sector, file_id, unnest(string_split(phrases, chr(10))) AS line,
  generate_subscripts(string_split(phrases, chr(10)), 1) AS pos FROM parsed),
split AS (SELECT request_id, sector, file_id, pos, trim(string_split(line, '=')[1], '"') AS name,
  CASE WHEN len(string_split(line, '=')) = 2 THEN try_cast(trim(string_split(line, '=')[2], ',') AS DOUBLE) ELSE 1.0 END AS weight
  FROM lines)"""

CENTROIDS = "start AS (SELECT label AS cluster, arg_min(v, vec_id) AS c FROM vecs GROUP BY label)"


def lloyd(start: str, out: str) -> str:
    return f"""
{out}_at AS (SELECT vec_id, v, cluster FROM vecs, {start}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(v, c), cluster) = 1),
{out}_dims AS (SELECT cluster, i, avg(x) AS x, count(*) AS n FROM
  (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {out}_at) GROUP BY cluster, i),
{out} AS (SELECT cluster, any_value(n) AS n, list(x ORDER BY i) AS c FROM {out}_dims GROUP BY cluster)"""


def silhouette(distance: str) -> str:
    return f"""WITH {VECS},
d AS (SELECT a.vec_id, a.label, b.label AS other, sum({distance}) AS total, count(*) AS n
  FROM vecs a, vecs b GROUP BY a.vec_id, a.label, b.label),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN total / greatest(n - 1, 1) END) AS a,
  min(CASE WHEN other <> label THEN total / n END) AS b, max(CASE WHEN other = label THEN n END) AS own FROM d GROUP BY vec_id, label)
SELECT vec_id, label, {r6('CASE WHEN own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END')} AS s FROM ab"""


def fitted(ks: str, steps: int = 10, points: int = 4096) -> str:
    """Seeds of a weighted coreset and assign-and-average steps for each k of ``ks``; ends in ``member(k, vec_id, cluster)``."""
    sql = f"""
points AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('0:' || vec_id), vec_id) AS p, v FROM vecs QUALIFY p <= {points}),
heavy AS MATERIALIZED (SELECT p, count(*) AS w FROM (SELECT vec_id, p FROM vecs, (SELECT p, v AS c FROM points)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(v, c), p) = 1) GROUP BY p),
ks AS (SELECT unnest({ks}) AS k),
grown AS (
  SELECT 1 AS i, p, v, w, list_distance(v, first_value(v) OVER o) ** 2 AS gap, first_value(v) OVER o AS c
  FROM points JOIN heavy USING (p) WINDOW o AS (ORDER BY w DESC, p)
  UNION ALL
  SELECT i + 1, p, v, w, least(gap, list_distance(v, first_value(v) OVER o) ** 2), first_value(v) OVER o
  FROM grown WHERE i < (SELECT least(max(k), (SELECT count(*) FROM points)) FROM ks) WINDOW o AS (ORDER BY w * gap DESC, p)
),
m0 AS MATERIALIZED (SELECT k, i - 1 AS cluster, any_value(c) AS c FROM grown, ks WHERE i <= k GROUP BY k, i)"""
    for n in range(steps + 1):
        sql += f""",
a{n} AS MATERIALIZED (SELECT k, vec_id, any_value(v) AS v, min(struct_pack(d := list_distance(v, c), cluster := cluster)).cluster AS cluster FROM vecs, m{n} GROUP BY k, vec_id)"""
        if n < steps:
            sql += f""",
s{n} AS (SELECT k, cluster, list(x ORDER BY j) AS c FROM (SELECT k, cluster, j, avg(x) AS x FROM
  (SELECT k, cluster, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{n}) GROUP BY ALL) GROUP BY ALL),
m{n + 1} AS MATERIALIZED (SELECT k, cluster, coalesce(s.c, m.c) AS c FROM m{n} m LEFT JOIN s{n} s USING (k, cluster))"""
    return sql + f""",
member AS MATERIALIZED (SELECT k, vec_id, cluster FROM a{steps})"""


def swept(rows: int = 1024) -> str:
    """Mean silhouette of the first rows by digest under each fit, with its standard error."""
    return f"""WITH RECURSIVE {VECS},{fitted("range(2, 100)")},
taken AS (SELECT vec_id, v FROM vecs QUALIFY row_number() OVER (ORDER BY sha256('0:' || vec_id), vec_id) <= {rows}),
far AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.v, b.v) AS d FROM taken a, vecs b),
sums AS (SELECT k, a, cluster, sum(d) AS total, count(*) AS n FROM far JOIN member ON member.vec_id = far.b GROUP BY ALL),
ab AS (SELECT s.k, a, max(CASE WHEN s.cluster = own.cluster THEN total / greatest(n - 1, 1) END) AS a_,
  min(CASE WHEN s.cluster <> own.cluster THEN total / n END) AS b_, max(CASE WHEN s.cluster = own.cluster THEN n END) AS n
  FROM sums s JOIN member own ON own.k = s.k AND own.vec_id = s.a GROUP BY s.k, a),
w AS (SELECT k, CASE WHEN n > 1 AND greatest(a_, b_) > 0 AND b_ IS NOT NULL THEN (b_ - a_) / greatest(a_, b_) ELSE 0.0 END AS s FROM ab)
SELECT k::INTEGER AS k, {r6('avg(s)')} AS silhouette,
  {r6('coalesce(sqrt(var_samp(s) / count(*) * (1 - count(*) / (SELECT count(*) FROM vecs))), 0)')} AS error FROM w GROUP BY k"""


PROMPT = (
    "'Name: ' || c_name || CASE WHEN c_acctbal > 0 THEN ', Annual revenue: ' || c_acctbal ELSE '' END"
    " || ', Starred: ' || CASE WHEN c_mktsegment = 'MACHINERY' THEN 'True' ELSE 'False' END || ', Nation: ' || c_nationkey"
)
LABELLED = """
labelled AS (SELECT d.doc_id AS company_id, quality = 1 AS starred, n_chars::DOUBLE AS prior, text
  FROM documents d JOIN labels l USING (doc_id))"""
CHOSEN = f"""
docs2 AS (SELECT doc_id AS company_id, length(text)::INTEGER AS score, ({words('text')})::INTEGER AS words FROM documents),
cut AS (SELECT *, row_number() OVER (ORDER BY score DESC, company_id) AS rank FROM docs2 WHERE words >= 20)"""


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["a1_a2_csv_round_trip"] = "SELECT doc_id AS company_id, text AS \"Description\", lang, source FROM documents"
    q["a3_keywords"] = """
WITH e AS (SELECT p_partkey AS set_id, 1 AS pos, lower(p_name) AS name, p_size::BIGINT AS weight FROM part
  UNION ALL SELECT p_partkey, 2, lower(p_name), p_size + 1 FROM part UNION ALL SELECT p_partkey, 3, lower(p_brand), 5 FROM part)
SELECT set_id, name, arg_max(weight, pos) AS weight FROM e GROUP BY set_id, name"""
    q["a5_vector_cache_miss"] = """
SELECT DISTINCT sha256(text) AS key, length(text) AS chars FROM documents
WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id))"""
    q["a5_cached_clusters"] = f"""
WITH RECURSIVE {DOCS}, {hashed('docs', 'company_id', 'd', 64, 'dv')},
vecs AS MATERIALIZED (SELECT g.company_id AS vec_id, list(coalesce(v, 0.0) ORDER BY i) AS v
  FROM (SELECT company_id, unnest(range(64)) AS i FROM docs WHERE d IS NOT NULL) g
  LEFT JOIN dv_v ON dv_v.company_id = g.company_id AND dim = i GROUP BY g.company_id),{fitted("[5]")}
SELECT cluster::INTEGER AS cluster, count(*) AS n FROM member GROUP BY cluster"""
    q["b1_suffix_clean"] = "SELECT doc_id AS company_id, lang, source FROM documents"
    q["b2_drop_null"] = """
SELECT doc_id AS company_id, text AS "Description" FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND text IS NOT NULL"""
    q["b3_unpack"] = f"WITH {PEOPLE} SELECT * FROM people"
    q["b4_email_ok"] = f"WITH {PEOPLE}, {PLAUSIBLE} SELECT * FROM good"
    q["b5_title_rank"] = f"WITH {PEOPLE} SELECT company_id, slot, title, {TITLE} AS title_rank FROM people"
    q["b6_compact"] = f"WITH {CONTACTS} SELECT * FROM compact"
    q["b7_reachable"] = f"WITH {CONTACTS} SELECT company_id, {EMAIL_1} AS email_1 FROM compact WHERE {EMAIL_1} <> ''"
    q["b8_min_tokens"] = f"SELECT doc_id AS company_id, ({words('text')})::INTEGER AS words FROM documents WHERE {words('text')} >= 20"
    q["b9_contacts_clean"] = "SELECT DISTINCT 'u' || user_id || '@mail.example.com' AS email FROM events WHERE event_type <> 'error'"
    q["b10_label_sample"] = f"""
WITH {LABELLED} SELECT company_id, starred, prior FROM labelled
QUALIFY row_number() OVER (PARTITION BY starred ORDER BY company_id) <= 100"""
    q["c1_sentences"] = f"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.?!]){WS}([A-Za-z])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS p FROM documents)
SELECT doc_id AS company_id, (generate_subscripts(p, 1) - 1)::INTEGER AS pos, unnest(p) AS sentence FROM s"""
    counts = f"WITH {KEYS}, {DOCS}, {phrase_counts('docs', 'company_id', 'd')}"
    q["c2_phrase_counts"] = f"{counts} SELECT company_id, name, n FROM counts"
    q["c3_presence_score"] = f"{counts} SELECT company_id, {PRESENCE} AS score FROM counts GROUP BY company_id"
    q["c4_density"] = f"""{counts}, sc AS (SELECT company_id, {PRESENCE} AS score FROM counts GROUP BY company_id)
SELECT company_id, score, {r6('score * 1e6 / nullif(length(d), 0)')} AS density FROM sc JOIN docs USING (company_id)"""
    q["c5_token_norm"] = f"""
WITH {KEYS}, docs AS (SELECT doc_id AS company_id, {spaced('text')} AS d FROM documents), {phrase_counts('docs', 'company_id', 'd')}
SELECT company_id, name, n FROM counts"""
    cells = f"WITH {KEYS}, {DOCS}, {TF}"
    q["c6_tf"] = f"{cells} SELECT company_id, name, {r6('tf')} AS tf FROM tf"
    q["c7_idf"] = f"{cells} SELECT name, docs_with, {r6('idf')} AS idf FROM idfs"
    q["c8_tfidf"] = f"{cells} SELECT company_id, name, {r6('tfidf')} AS tfidf FROM cells"
    q["c9_firm_scores"] = f"""{cells}, raw AS (SELECT company_id, sum(weight * tfidf) AS x FROM cells GROUP BY company_id)
SELECT company_id, {r6('x')} AS raw, {r6(minmax('x'))} AS score FROM raw"""
    q["c10_reply_tail"] = "SELECT doc_id AS company_id, nullif(regexp_extract(text, '(of [^\\n]*)', 1), '') AS tail FROM documents"
    q["c11_founders"] = """
SELECT c_custkey AS reply_id, 1 AS line, c_name AS name, c_mktsegment[1] || lower(c_mktsegment[2:]) || ' Head, Chair' AS role FROM customer
UNION ALL SELECT c_custkey, 3, 'Bo Ng', 'CTO' FROM customer WHERE c_acctbal > 5000"""
    q["c12_row_prompt"] = f"SELECT c_custkey, {PROMPT} AS prompt FROM customer"
    q["c13_request_table"] = f"""
WITH m AS (SELECT c_custkey, 0 AS pos, 'system' AS role, 'Give one reason in the form: of ...' AS content FROM customer
UNION ALL SELECT c_custkey, 1 + 2 * r_regionkey, 'user', r_name FROM customer, region
UNION ALL SELECT c_custkey, 2 + 2 * r_regionkey, 'assistant', 'of ' || lower(r_name) FROM customer, region
UNION ALL SELECT c_custkey, 1 + 2 * (SELECT count(*) FROM region)::INTEGER, 'user', {PROMPT} FROM customer) SELECT * FROM m"""
    q["c14_row_prefix"] = """
SELECT c_custkey, c_name AS "Name", CASE WHEN row_number() OVER (ORDER BY c_custkey) <= 25 THEN 'Name: ' || c_name END AS result FROM customer"""
    q["c15_page_text"] = f"SELECT page_id, url, {visible('html')} AS text FROM pages"
    q["c16_site_text"] = f"""
WITH {SITE_PAGES} SELECT site, 0::BIGINT AS part, max_by(text, -page_id) || ' ' || coalesce(string_agg(text, '' ORDER BY page_id) FILTER (page_id <> home), '') AS text
FROM (SELECT *, min(page_id) OVER (PARTITION BY site) AS home FROM site_pages) GROUP BY site"""
    q["d1_hash_embed"] = f"WITH {DOCS}, {hashed('docs', 'company_id', 'd', 256, 'dv')} SELECT company_id, dim, {r6('v')} AS v FROM dv_v"
    q["d2_mean_pool"] = f"""
WITH {VECS}, m AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim, v[1] > 0 AS mask FROM vecs)
SELECT label, dim::INTEGER AS dim, {r6('sum(CASE WHEN mask THEN x ELSE 0 END) / greatest(count(*) FILTER (mask), 1e-9)')} AS v FROM m GROUP BY label, dim"""
    q["d3_l2_normalize"] = f"""
WITH {VECS} SELECT vec_id, (generate_subscripts(u, 1) - 1)::INTEGER AS dim, {r6('unnest(u)')} AS v FROM unit"""
    q["d4_hash_embed_raw"] = f"WITH {DOCS}, {hashed('docs', 'company_id', 'd', 256, 'dv')} SELECT company_id, dim, n::DOUBLE AS v FROM dv"
    q["d5_keyword_vectors"] = f"""
WITH {hashed('benchmark', 'item_id', 'text', 256, 'kv')}
SELECT text AS name, (item_id + 1)::DOUBLE AS weight, dim, {r6('v')} AS v FROM kv_v JOIN benchmark USING (item_id)"""
    for name, mode in (("d6_cosine", "cosine"), ("d7_euclid", "euclid"), ("d8_mult", "mult"), ("d9_legacy_mult", "legacy_mult"), ("d10_add", "add")):
        q[name] = pair_query("keys", mode)
    q["e1_phrase_grid"] = f"""
WITH {KEYS}, {DOCS}, {hashed('docs', 'company_id', 'd', 256, 'dv')}, {text_pairs('phrases', 'p', 256)}
SELECT company_id, name, {r6('sim')} AS sim FROM p"""
    q["e2_sector_grid"] = pair_query("sectors", "mult")
    q["e3_contact_messages"] = f"WITH {MAIL} SELECT * FROM matched"
    q["e5_firm_keywords"] = f"{cells} SELECT company_id, name, weight, {r6('tf')} AS tf, {r6('idf')} AS idf FROM cells"
    soft_key = "WITH " + ",".join([VECS, KEYVECS, pairs("keys", "kp", "mult"), soft("kp", "kw")])
    q["f1_soft_idf"] = f"{soft_key} SELECT name, {r6('idf')} AS idf FROM kw_idf"
    q["f2_soft_tfidf"] = f"{soft_key} SELECT vec_id, {r6('x')} AS score FROM kw"
    q["f3_minmax"] = f"SELECT c_custkey, {r6(minmax('c_acctbal'))} AS scaled, 0.0::DOUBLE AS constant FROM customer"
    q["f4_score_sum"] = dense_scores("mult", "sum", False)
    q["f4_score_product"] = dense_scores("mult", "product", False)
    cosine = "WITH " + ",".join([VECS, KEYVECS, pairs("keys", "kp", "cosine")]) + ", s AS (SELECT vec_id, sum(weight * sim) AS x FROM kp GROUP BY vec_id)"
    q["f5_weighted_cosine"] = f"{cosine} SELECT vec_id, {r6('x')} AS score FROM s"
    q["f6_best_sector"] = best_sector("add")
    q["f7_label_stats"] = f"""
WITH {LABELLED}, s AS (SELECT starred, prior, ({words('text')}) / 10.0::DOUBLE AS score FROM labelled)
SELECT starred, count(*) AS n, {r6('avg(score)')} AS mean_score, {r6('stddev_samp(score)')} AS sd_score, {r6('avg(prior)')} AS mean_prior
FROM s GROUP BY starred"""
    q["g1_kmeans"] = f"""WITH RECURSIVE {VECS},{fitted("[10]")}
SELECT cluster::INTEGER AS cluster, count(*) AS n FROM member GROUP BY cluster"""
    q["g4_k_sweep"] = swept()
    q["g1_lloyd_steps"] = f"""
WITH {VECS}, {CENTROIDS}, {lloyd('start', 'one')}, {lloyd('one', 'two')}
SELECT cluster, n, (i - 1)::INTEGER AS dim, {r6('x')} AS v FROM two_dims"""
    q["g2_assign"] = f"WITH {VECS}, {CENTROIDS}, {lloyd('start', 'one')} SELECT vec_id, cluster FROM one_at"
    q["g3_silhouette_exact"] = silhouette("list_distance(a.v, b.v)")
    q["g3_silhouette_squared"] = silhouette("list_distance(a.v, b.v) ** 2")
    q["h1_rank"] = "SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS rank FROM customer"
    q["a2_ranked_round_trip"] = "SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS rank FROM customer"
    q["h2_top_n"] = q["h1_rank"] + " QUALIFY rank <= 500"
    q["h3_choose_top_n"] = f"WITH {CHOSEN} SELECT * FROM cut WHERE rank <= 150"
    q["h3_choose_top_auto"] = f"WITH {CHOSEN} SELECT * FROM cut WHERE rank <= least(100, (SELECT floor(0.1::DOUBLE * count(*)) FROM docs2))"
    q["h4_index"] = f"WITH {MAIL} SELECT email, direction, message_id, message_index FROM indexed"
    q["h5_long"] = f"WITH {MAIL} SELECT email, direction, message_index, content AS message_content FROM indexed"
    q["h6_wide"] = f"WITH {MAIL} SELECT email, 0::BIGINT AS row, " + ", ".join(
        f"max(content) FILTER (direction = '{d}' AND message_index = {i}) AS {d}_{i}" for d in ("from", "to") for i in (1, 2, 3, 4)
    ) + " FROM contacts LEFT JOIN indexed USING (email) GROUP BY email"
    q["h7_message_text"] = """
SELECT conv_id || '-' || turn AS message_id, 'Subject: Conversation ' || conv_id || chr(10) || chr(10) || text AS content
FROM conversations"""
    q["s1_requests"] = f"WITH {FORMS} SELECT request_id, email, file_id, error FROM parsed"
    q["s1_form_sheet"] = f"WITH {FORMS} SELECT email, file_id, error, (SELECT count(*) - 1 FROM parsed) AS last_row FROM parsed"
    q["s2_request_parse"] = f"""
WITH {FORMS}, {REQUEST_LINES} SELECT request_id, sector, file_id, name, weight FROM split WHERE trim(name) <> ''
QUALIFY pos = max(pos) OVER (PARTITION BY request_id, name)"""
    q["s3_request_gate"] = f"""
WITH {FORMS} SELECT file_id, 'list ' || p.c_custkey || CASE c.c_mktsegment WHEN 'BUILDING' THEN '.xlsx' ELSE '.csv' END AS file_name,
  coalesce(error, CASE c.c_mktsegment WHEN 'BUILDING' THEN 'the file is not a .csv' END) AS error
FROM parsed p JOIN customer c USING (c_custkey)"""
    q["s4_scored_requests"] = f"""
WITH {KEYS}, {DOCS}, {hashed('docs', 'company_id', 'd', 256, 'dv')}, {text_pairs('phrases', 'kp', 256)}, {soft('kp', 'kw', 'company_id')},
asked AS (SELECT lower(c_mktsegment) AS email, count(*)::DOUBLE AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL),
raw AS (SELECT email, company_id, sum(coalesce(sim * idf * CASE name WHEN 'and the' THEN n ELSE 1.0 END, 0)) AS x
  FROM kp JOIN kw_idf USING (name), asked WHERE name IN ('and the', 'worthless') GROUP BY ALL),
scored AS (SELECT email, company_id, (x - min(x) OVER w) / (max(x) OVER w - min(x) OVER w) AS s FROM raw WINDOW w AS (PARTITION BY email)),
placed AS (SELECT email, company_id, s, row_number() OVER (PARTITION BY email ORDER BY round(s, 9) DESC, company_id) AS rank
  FROM scored JOIN docs USING (company_id) WHERE {words('d')} >= 20)
SELECT email, company_id, {r6('s')} AS score, rank FROM placed WHERE rank <= 20"""
    lead_docs = f"""
lead_docs AS (SELECT doc_id AS company_id, text AS d, lang, {EMAIL_1} AS email_1 FROM documents JOIN compact ON company_id = doc_id WHERE {EMAIL_1} <> '')"""
    q["l1_lead_ranking"] = "WITH " + ",".join([CONTACTS, lead_docs, *text_scored("lead_docs", 256)]) + f""",
best AS (SELECT company_id, lang, email_1, keyword_score, sector_score, score FROM scored JOIN lead_docs USING (company_id) WHERE {words('d')} >= 20)
SELECT company_id, lang, email_1, {r6('keyword_score')} AS keyword_score, {r6('sector_score')} AS sector_score, {r6('score')} AS score,
  row_number() OVER (ORDER BY round(best.score, 9) DESC, company_id) AS rank FROM best QUALIFY rank <= 500"""
    found = q["l1_lead_ranking"]
    q["l1_lead_requests"] = f"""
WITH l AS ({found}), m AS (SELECT company_id, 0 AS pos, 'system' AS role, 'Give one reason in the form: of ...' AS content FROM l
UNION ALL SELECT company_id, 1 + 2 * r_regionkey, 'user', r_name FROM l, region
UNION ALL SELECT company_id, 2 + 2 * r_regionkey, 'assistant', 'of ' || lower(r_name) FROM l, region
UNION ALL SELECT company_id, 1 + 2 * (SELECT count(*) FROM region)::INTEGER, 'user',
  concat_ws(', ', 'lang: ' || d.lang, 'source: ' || d.source, 'rank: ' || rank) FROM l JOIN documents d ON doc_id = company_id) SELECT * FROM m"""
    q["l1_lead_replies"] = f"""
WITH l AS ({found}), r AS (SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 0 THEN
  'A good match because of ' || lower(c_mktsegment) || ' goods.' || chr(10) || 'More of the same.' ELSE 'No reason.' END AS reply FROM customer WHERE c_acctbal > 0)
SELECT company_id, rank, nullif(regexp_extract(reply, '(of [^\\n]*)', 1), '') AS "WLYB" FROM l LEFT JOIN r ON c_custkey = company_id"""
    q["l2_relevance_rank"] = dense_scores("mult", "sum", True)
    q["l2_text_rank"] = "WITH " + ",".join([DOCS, *text_scored("docs", 2**18)]) + " " + scores_out("company_id", True)
    q["l3_legacy_rank"] = dense_scores("legacy_mult", "product", True)
    q["l4_sector_prediction"] = best_sector("mult")
    q["l5_site_rank"] = f"""
WITH {KEYS}, {SITE_PAGES}, {phrase_counts('site_pages', 'page_id', 'text')},
by_phrase AS (SELECT site, name, weight, sum(n) AS n FROM counts JOIN sited USING (page_id) GROUP BY ALL),
by_site AS (SELECT site, {PRESENCE} AS score FROM by_phrase GROUP BY site),
lengths AS (SELECT site, (sum(length(text)) + 1)::BIGINT AS chars FROM site_pages GROUP BY site),
dense AS (SELECT site, score, chars, score * 1e6 / nullif(chars, 0) AS density FROM by_site JOIN lengths USING (site))
SELECT site, score, chars, {r6('density')} AS density, row_number() OVER (ORDER BY round(dense.density, 9) DESC NULLS LAST, site) AS rank FROM dense"""
    q["l6_cosine_top500"] = f"""
{cosine} SELECT vec_id, {r6('x')} AS score, row_number() OVER (ORDER BY round(x, 9) DESC, vec_id) AS rank FROM s QUALIFY rank <= 500"""
    return q
