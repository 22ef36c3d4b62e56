"""DuckDB SQL for the operators that SQL can express over whole tables."""

from __future__ import annotations

from tidemark.llm.licenses import BASE, TEMPLATES, Templates

# Smallest reachable id over the links (a, b); both directions are walked, each step taking the
# smallest id seen so far along the links.
_COMPONENTS = """
  reach AS (
    SELECT a AS id, a AS seen FROM both_ways
    UNION
    SELECT r.id, w.b FROM reach r JOIN both_ways w ON w.a = r.seen
  ),
  parts AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)"""

OP3 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
  ),
  sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
    FROM words
  ),
  shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
  shared AS (SELECT g FROM shingles GROUP BY g HAVING count(*) > 1),
  few AS (SELECT doc_id, n, g FROM shingles SEMI JOIN shared USING (g)),
  pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM few x JOIN few y ON x.g = y.g AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
  ),
  both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),{_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(component_id, doc_id)) AS component_id
FROM sets LEFT JOIN parts ON id = doc_id
"""

OP10 = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  ),
  pairs AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.93
  ),
  both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),{_COMPONENTS},
  links AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(component_id, vec_id)) AS component_id,
       component_id IS NULL OR component_id >= vec_id AS kept
FROM embeddings LEFT JOIN parts ON parts.id = vec_id LEFT JOIN links ON links.id = vec_id
"""


def _kind(kind: str, rank: int, pattern: str) -> str:
    """Matches of a pattern with their starts: the texts between the matches give the offsets."""
    return f"""
  {kind}_cut AS (
    SELECT doc_id, source, t, regexp_extract_all(t, {pattern}) AS m, regexp_split_to_array(t, {pattern}) AS gap FROM texts WHERE regexp_matches(t, {pattern})
  ),
  {kind}_at AS (
    SELECT doc_id, source, t, m[i] AS m,
           (list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {kind}_cut)
  ),
  {kind} AS (SELECT doc_id, source, t, {rank} AS rank, '{kind}' AS kind, s, s + length(m) AS e, m FROM {kind}_at)"""


_ASSIGN = r"""'((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""

OP5 = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),{_kind("assign", 0, _ASSIGN)},{_kind("access", 1, "'AKIA[A-Z0-9]{14,}'")},{_kind("hex", 2, "'[0-9a-f]{16,}'")},{_kind("opaque", 3, "'[A-Za-z0-9+/_-]{20,}={0,2}'")},
  base AS (
    SELECT doc_id, source, t, rank, kind, s, e, regexp_extract(m, {_ASSIGN}, 2) AS v FROM assign WHERE length(regexp_extract(m, {_ASSIGN}, 2)) >= 12
    UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex
  ),
  bare AS (
    SELECT o.* FROM opaque o WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')
      AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.s < o.e AND o.s < b.e)
  ),
  found AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
  owned AS (SELECT v, count(DISTINCT coalesce(source, '')) AS owners, count(DISTINCT (coalesce(source, ''), t)) AS repositories FROM found GROUP BY v),
  judged AS (
    SELECT f.*, owners, repositories, owners < 3 AND len(list_distinct(string_split(v, ''))) >= 8
           AND NOT regexp_matches(v, '(?i)example|sample|placeholder|changeme|dummy|your|xxxx|0000|1234|abcd') AS live
    FROM found f JOIN owned USING (v)
  ),
  told AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'opaque') AS base_spans,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'opaque' OR live) AS spans,
           count(*) FILTER (live) AS n_live, count(*) FILTER (kind <> 'opaque' AND owners >= 3) AS n_examples,
           max(owners) AS most_owners, max(repositories) AS most_repositories
    FROM judged GROUP BY doc_id
  )
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples,
       coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM documents LEFT JOIN told USING (doc_id)
"""

OP12 = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
  ),
  numbers AS (
    SELECT doc_id, t, n, ('0x' || h[1:8])::UBIGINT % (n + 1) AS x, ('0x' || h[9:16])::UBIGINT % (n + 1) AS y,
           ('0x' || h[17:24])::UBIGINT % 100 AS r, ('0x' || h[25:32])::UBIGINT % 100 AS k
    FROM drawn
  ),
  cuts AS (
    SELECT doc_id, t, n, least(x, y)::BIGINT AS a, greatest(x, y)::BIGINT AS b,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 90 THEN 'plain' WHEN k < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
  )
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
                        ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cuts
"""


def _licenses() -> str:
    """Blocks against all templates: words of both counted, phrases looked for word by word."""
    known, places, listed = Templates(TEMPLATES), [], []
    for k, w in enumerate(known.words):
        rows = [f"({k}, '{known.labels[k]}', '{x}', {known.half[k]}, {known.m[k]}, {known.need[k]})" for x in sorted(set(w))]
        if known.phrase[k]:
            more = "".join(f" JOIN hits h{i} ON h{i}.doc_id = h.doc_id AND h{i}.pos = h.pos + {i} AND h{i}.word = '{x}'" for i, x in enumerate(w[1:], 1))
            places.append(f"SELECT h.doc_id, {k} AS template, '{known.labels[k]}' AS label, h.pos FROM hits h{more} WHERE h.word = '{w[0]}'")
        else:
            listed += rows
    vocabulary = ", ".join(f"('{x}')" for x in known.vocabulary)
    return f"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
  ),
  hits AS MATERIALIZED (
    SELECT doc_id, pos, word FROM (SELECT doc_id, unnest(range(0, len(w))) AS pos, unnest(w) AS word FROM texts) SEMI JOIN (VALUES {vocabulary}) v(word) USING (word)
  ),
  templates(template, label, word, half, m, need) AS (VALUES {", ".join(listed)}),
  blocks AS (SELECT doc_id, template, label, word, m, need, unnest([pos // half, pos // half - 1]) AS block FROM hits JOIN templates USING (word)),
  notices AS (
    SELECT doc_id, label, count(DISTINCT word) / m AS containment FROM blocks WHERE block >= 0
    GROUP BY doc_id, template, label, block, m, need HAVING count(DISTINCT word) >= need
  ),
  phrases AS ({" UNION ALL ".join(places)}),
  base AS (
    SELECT doc_id, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM phrases WHERE template < {len(BASE)} GROUP BY doc_id
  ),
  matched AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
    FROM (SELECT doc_id, label, containment FROM notices UNION ALL SELECT doc_id, label, 1.0::DOUBLE FROM phrases) GROUP BY doc_id
  )
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(b.labels, '') AS base_labels,
       coalesce(m.labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts t LEFT JOIN base b ON b.doc_id = t.doc_id LEFT JOIN matched m ON m.doc_id = t.doc_id
"""


ORACLE = {"op3_combination_prefixes": OP3, "op5_ownership_secrets": OP5, "op10_lattice_near_dedup": OP10,
          "op11_template_containment": _licenses(), "op12_piece_table": OP12}
