"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sentimill.llm import collocations, lexical, mixing, topk_exact, url_filter


def _unit(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _apportion(name: str, children: str, parent: str, child: str, votes: str, seats: str) -> str:
    """CTEs that leave ``name``: the children with their quota, by ranking all quotients that could win."""
    share = f"round({votes} / total * greatest({seats} + (SIGN) * n, 0))::BIGINT"
    sure = f"CASE WHEN total > 0 THEN {share.replace('(SIGN)', '(-1)')} ELSE 0 END"
    most = f"CASE WHEN total > 0 THEN {share.replace('(SIGN)', '1')} ELSE 0 END"
    return f"""{name}_bounded AS MATERIALIZED (
  SELECT *, {sure} AS sure, {most} AS most FROM (
    SELECT *, count(*) OVER (PARTITION BY {parent}) AS n, sum({votes}) OVER (PARTITION BY {parent}) AS total FROM {children})),
{name}_won AS MATERIALIZED (
  SELECT {parent}, {child}, count(*) AS won FROM (
    SELECT *, row_number() OVER (PARTITION BY {parent} ORDER BY {votes} / (2 * seat + 1)::DOUBLE DESC, {child}) AS place FROM (
      SELECT *, unnest(range(sure, most)) AS seat FROM (
        SELECT *, {seats} - sum(sure) OVER (PARTITION BY {parent}) AS rest FROM {name}_bounded)))
  WHERE place <= rest GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT b.*, sure + coalesce(won, 0) AS quota FROM {name}_bounded b LEFT JOIN {name}_won w USING ({parent}, {child}))"""


_B = mixing.BLOCK_WORDS
_DRAWN = "(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))"
MIXING = f"""WITH sized AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{mixing.SEED}:' || {_DRAWN}) AS draw, {_unit(_DRAWN, mixing.SEED + ' shard')} AS unit FROM documents),
weighed AS MATERIALIZED (
  SELECT *, {mixing.MOST} * words AS cap, list_extract({list(mixing.WEIGHTS)}, 1 + ((row_number() OVER (ORDER BY key) - 1) % 3)::INT) AS weight
  FROM (SELECT key, sum(size)::BIGINT AS words, count(*) AS rows FROM sized GROUP BY key)),
levels AS (
  SELECT cap / weight AS full_at,
         ({mixing.SHARE}::DOUBLE * sum(words) OVER () - coalesce(sum(cap) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sources AS MATERIALIZED (
  SELECT *, 0 AS everything, least(cap::DOUBLE, weight * (SELECT coalesce(arg_min(level, full_at), 0) FROM levels WHERE full_at >= level)) AS target,
         greatest(1, ceil(words / {mixing.SHARD_WORDS}), ceil(rows / {mixing.SHARD_ROWS}))::BIGINT AS shards FROM weighed),
seated AS (SELECT *, round(sum(target) OVER () / {_B})::BIGINT AS blocks FROM sources),
{_apportion("by_source", "seated", "everything", "key", "target", "blocks")},
placed AS MATERIALIZED (SELECT s.*, floor(unit * shards)::BIGINT AS shard FROM sized s JOIN sources USING (key)),
shards AS MATERIALIZED (
  SELECT key, shard, shard // {mixing.GROUP_SHARDS} AS bundle, sum(size)::BIGINT AS shard_words FROM placed GROUP BY ALL),
bundles AS (
  SELECT g.*, quota AS blocks FROM (SELECT key, bundle, sum(shard_words)::BIGINT AS bundle_words FROM shards GROUP BY ALL) g
  JOIN by_source USING (key)),
{_apportion("by_bundle", "bundles", "key", "bundle", "bundle_words", "blocks")},
parts AS (SELECT s.*, quota AS blocks FROM shards s JOIN by_bundle USING (key, bundle)),
{_apportion("by_shard", "parts", "key, bundle", "shard", "shard_words", "blocks")},
runs AS MATERIALIZED (
  SELECT key, shard, words AS source_size, target, pieces, CASE WHEN pieces > 0 THEN q // pieces ELSE 0 END AS rounds,
         CASE WHEN pieces > 0 THEN q % pieces ELSE 0 END AS run, floor(start * pieces)::BIGINT AS run_start FROM (
    SELECT key, shard, h.quota AS q, ceil(shard_words / {_B})::BIGINT AS pieces, s.words, s.target,
           {_unit("key || ':' || shard", mixing.SEED + ' start')} AS start
    FROM by_shard h JOIN sources s USING (key))),
ends AS (
  SELECT *, sum(size) OVER (PARTITION BY key, shard ORDER BY draw, size ROWS UNBOUNDED PRECEDING)::BIGINT AS b FROM placed)
SELECT doc_id, size, source_size, target, least(rounds * size
         + greatest(0, least(b, (run_start + run) * {_B}) - greatest(b - size, run_start * {_B}))
         + greatest(0, least(b, (run_start + run - pieces) * {_B}) - (b - size)), {mixing.MOST} * size)::BIGINT AS taken
FROM ends JOIN runs USING (key, shard)"""

_SCALED = f"list_transform(embedding, lambda x: floor({topk_exact.SCALE} * x::DOUBLE))"
TOP_K = f"""WITH usable AS MATERIALIZED (
  SELECT vec_id, {_SCALED} AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)))
WHERE rank <= {topk_exact.K}"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_TERMS = f"regexp_extract_all({_lowered('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
LEXICAL = f"""WITH numbered AS (SELECT row_number() OVER () AS place, doc_id, text FROM documents),
tokens AS (SELECT place, doc_id, unnest({_TERMS}) AS term FROM numbered),
counted AS MATERIALIZED (SELECT place, doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
sizes AS MATERIALIZED (SELECT place, sum(tf)::BIGINT AS n FROM counted GROUP BY place),
totals AS MATERIALIZED (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes),
asked AS MATERIALIZED (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
weights AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, totals GROUP BY term),
scored AS (
  SELECT item_id, place, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (place), totals GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
WHERE rank <= {lexical.K}"""

COLLOCATIONS = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_lowered('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lines AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lines GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM lines, (SELECT unnest(range(1, {collocations.LONGEST} + 1)) AS size) WHERE len(w) >= size),
phrases AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
cuts AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM phrases WHERE size > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, c.k, (2000000::HUGEINT * c.a) // (h.f::HUGEINT + t.f) AS score FROM cuts c
  JOIN phrases h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN phrases t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT p.lang, p.phrase FROM phrases p JOIN phrases q
  ON p.lang = q.lang AND q.size > p.size AND 100::HUGEINT * q.f >= 80::HUGEINT * p.f
  AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')
  WHERE p.size > 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.FIRST}"""

_FITS = [
    (verdict, f"{host}{path}", f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')")
    for verdict, host, path in sorted(url_filter.RULES, key=lambda rule: -len(rule[1] + rule[2]))
]
URLS = f"""SELECT page_id, host, path,
  CASE {" ".join(f"WHEN {fits} THEN '{rule}'" for _, rule, fits in _FITS)} END AS rule,
  CASE {" ".join(f"WHEN {fits} THEN '{verdict}'" for verdict, _, fits in _FITS)} ELSE '{url_filter.DEFAULT}' END AS verdict
FROM (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages))"""

ORACLES = {
    "op1_source_mixing": MIXING,
    "op5_topk_exact": TOP_K,
    "op11_document_tree_search": LEXICAL,
    "op12_collocations": COLLOCATIONS,
    "op13_url_automaton": URLS,
}
