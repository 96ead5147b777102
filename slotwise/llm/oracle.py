"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from slotwise.llm import license_scan, url_filter

_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_NORMAL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _urls() -> str:
    rules = ", ".join(
        f"({_quoted(r.verdict)}, {_quoted(r.where)}, {_quoted(r.where.partition('/')[0])}, "
        f"{_quoted('/' + r.where.partition('/')[2])})"
        for r in url_filter.RULES
    )
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lower.format(r"regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")
    path = r"regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"
    scheme = "lower(string_split(url, '://')[1])"
    plain_host = f"""CASE {scheme} WHEN 'http' THEN regexp_replace({host}, ':(80)?$', '')
      WHEN 'https' THEN regexp_replace({host}, ':(443)?$', '') ELSE {host} END"""
    dot = "lower({0}) IN ('.', '%2e')"
    dots = "lower({0}) IN ('..', '.%2e', '%2e.', '%2e%2e')"
    last = f"string_split({path}, '/')[-1]"
    kept = f"""list_reduce(list_prepend([''], list_transform(string_split({path}, '/')[2:], lambda x: [x])),
      lambda a, x: CASE WHEN {dots.format("x[1]")} THEN a[1:greatest(len(a) - 1, 1)] WHEN {dot.format("x[1]")} THEN a
        ELSE list_concat(a, x) END)"""
    plain_path = f"""CASE WHEN {path} = '' THEN '/' WHEN regexp_matches({path}, {_quoted(url_filter.DOTS)})
      THEN array_to_string({kept}, '/') || CASE WHEN {dot.format(last)} OR {dots.format(last)} THEN '/' ELSE '' END
      ELSE {path} END"""
    query = r"regexp_extract(url, '^(?s:.*?)://[^?#]*(\?[^#]*)', 1)"
    key = f"CASE WHEN contains(url, '://') THEN {plain_host} || {plain_path} || {query} END"
    value = r"""regexp_extract({1}, '(?is)[\s"''/]{0}\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)"""
    trimmed = "trim({0}, '\"'' ' || chr(9) || chr(10) || chr(12) || chr(13))"
    attribute = lambda name, tag="tag": trimmed.format(value.format(name, tag))
    moved = trimmed.format(rf"regexp_extract({attribute('content')}, '(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=(.*)$', 1)")
    code = "CASE WHEN lower(r[3]) = 'x' THEN ('0x' || r[4:len(r) - 1])::BIGINT ELSE r[3:len(r) - 1]::BIGINT END"
    decoded = """list_reduce(list_prepend({0}, list_filter(
      list_distinct(regexp_extract_all({0}, '(?i)&#(?:x[0-9a-f]{{1,6}}|[0-9]{{1,7}});')),
      lambda r: NOT regexp_matches(r, '^&(?:#0*38|#[xX]0*26);$'))),
      lambda t, r: replace(t, r, CASE WHEN {1} BETWEEN 1 AND 55295 OR {1} BETWEEN 57344 AND 1114111
        THEN chr(({1})::INT) ELSE chr(65533) END))""".replace("{1}", f"({code})")
    for name, char in url_filter.NAMED.items():
        decoded = f"replace({decoded}, '&{name};', {_quoted(char)})"
    decoded = f"regexp_replace({decoded}, {_quoted(url_filter.AMPERSAND)}, '&', 'g')"
    resolve = rf"""CASE
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN string_split(base, '://')[1] || ':' || target
    WHEN regexp_matches(target, '^([A-Za-z][A-Za-z0-9+.-]*:|#|$)') THEN NULL
    WHEN starts_with(target, '/') THEN regexp_extract(base, '^(?s:.*?)://[^/?#]*') || target
    WHEN starts_with(target, '?') THEN regexp_extract(base, '^(?s:.*?)://[^?#]*') || target
    ELSE regexp_replace(regexp_extract(base, '^(?s:.*?)://[^/?#]*(?:[^?#]*/)?'), '/$', '') || '/' || target END"""
    return rf"""
WITH RECURSIVE rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules}),
bare AS (
  SELECT url, regexp_replace(html, {_quoted(url_filter.TEXT_ONLY)}, '', 'g') AS bare
  FROM pages WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|refresh')),
tags AS (
  SELECT url, regexp_extract(bare, {_quoted(url_filter.BASE)}) AS base_tag,
    unnest(regexp_extract_all(bare, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM bare),
links AS (
  SELECT url, {attribute('href', 'base_tag')} AS base, {attribute('href')} AS target FROM tags
  WHERE regexp_matches(tag, '(?i)^<link') AND regexp_matches({attribute('rel')}, '(?i)(^|\s)canonical(\s|$)')
  UNION ALL
  SELECT url, {attribute('href', 'base_tag')}, {moved} FROM tags
  WHERE regexp_matches(tag, '(?i)^<meta') AND lower({attribute('http-equiv')}) = 'refresh'),
decoded AS (SELECT url, {decoded.format('base')} AS base_href, {decoded.format('target')} AS target FROM links),
based AS (
  SELECT url, target, CASE WHEN base_href = '' THEN url ELSE coalesce(
    (SELECT {resolve} FROM (SELECT base_href AS target, url AS base)), url) END AS base FROM decoded),
resolved AS (SELECT url AS base, {resolve} AS url FROM based),
edges AS (
  SELECT (SELECT {key} FROM (SELECT base AS url)) AS a, {key} AS b FROM resolved),
both_ways AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
nodes AS (
  SELECT a AS node, {host.replace('url', "'x://' || a")} AS host, {path.replace('url', "'x://' || a")} AS path
  FROM both_ways GROUP BY a),
reached(node) AS (
  SELECT node FROM (
    SELECT node, arg_max(verdict, 2 * length(rule) + (verdict = 'allow')::INT) AS verdict
    FROM nodes JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY node) WHERE verdict = 'block'
  UNION SELECT b FROM reached JOIN both_ways ON a = node),
parsed AS (
  SELECT row_number() OVER () AS row, page_id, {host} AS host, {path} AS path, {key} AS key FROM pages),
ruled AS (
  SELECT row, arg_max(rule, 2 * length(rule) + (verdict = 'allow')::INT) AS rule,
    arg_max(verdict, 2 * length(rule) + (verdict = 'allow')::INT) AS verdict
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  rule IS NULL AND node IS NOT NULL AS inherited
FROM parsed LEFT JOIN ruled USING (row) LEFT JOIN reached ON key = node
"""


_CONTAMINATION = rf"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, {_NORMAL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
placed AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item, n, w[i:i + n - 1] AS gram FROM placed),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_NORMAL_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n),
grams AS (SELECT row, n, i, w[i:i + n - 1] AS gram FROM places),
hits AS (SELECT row, i, n, item FROM grams JOIN windows USING (n, gram)),
covered AS (
  SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY row),
found AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""


def _licenses() -> str:
    phrases = ", ".join(
        f"({_quoted(label)}, {_quoted(phrase)}, {len(phrase.split())})" for phrase, label in license_scan.PHRASES.items()
    )
    templates = ", ".join(
        f"({_quoted(label)}, {_quoted(text)}, {license_scan.block_length(text)})"
        for label, text in license_scan.TEMPLATES.items()
    )
    return rf"""
WITH phrases(label, phrase, n) AS (VALUES {phrases}),
templates AS (
  SELECT label, list_distinct(string_split(text, ' ')) AS t, length
  FROM (VALUES {templates}) AS v(label, text, length)),
docs AS (SELECT row_number() OVER () AS row, doc_id, text, {_NORMAL_WORDS} AS w FROM documents),
near AS (SELECT row, w, p.* FROM docs JOIN phrases p ON contains(array_to_string(w, ' '), phrase)),
starts AS (SELECT row, label, phrase, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM near),
places AS (SELECT row, label, i - 1 AS pos FROM starts WHERE array_to_string(w[i:i + n - 1], ' ') = phrase),
based AS (
  SELECT row, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS base
  FROM places GROUP BY row),
terms AS (SELECT label, unnest(t) AS word, len(t) AS size, length FROM templates),
spots AS (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM docs),
hits AS (SELECT row, pos, terms.* FROM spots JOIN terms USING (word)),
shares AS (
  SELECT a.row, a.label, count(DISTINCT b.word) AS n, count(DISTINCT b.word) / any_value(a.size) AS share,
    ceil({license_scan.THRESHOLD} * any_value(a.size) - 1e-9) AS least
  FROM hits a JOIN hits b ON a.row = b.row AND a.label = b.label AND b.pos BETWEEN a.pos AND a.pos + a.length - 1
  GROUP BY a.row, a.label, a.pos),
alike AS (
  SELECT row, list(DISTINCT label) AS more, max(share) AS score FROM shares WHERE n >= least GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN based USING (row) LEFT JOIN alike USING (row)
"""


_REPEATS = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_SPACE_WORDS} AS w FROM documents),
places AS (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50),
windows AS (SELECT row, doc_id, i, array_to_string(w[i:i + 49], ' ') AS gram FROM places),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM windows GROUP BY gram),
later AS (SELECT row, i FROM windows JOIN firsts USING (gram) WHERE doc_id > first_id),
gone AS (SELECT DISTINCT row, unnest(range(i, i + 50)) AS pos FROM later),
lists AS (SELECT row, list(pos) AS gone FROM gone GROUP BY row),
kept AS (
  SELECT doc_id, len(w) AS n, coalesce(len(gone), 0) AS n_removed,
    CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
      lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS k
  FROM docs LEFT JOIN lists USING (row))
SELECT doc_id, n::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


_RESAMPLING = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS row, doc_id, {_NORMAL_WORDS} AS w FROM documents),
aims AS (SELECT {_NORMAL_WORDS} AS w FROM benchmark),
runs AS (
  SELECT row, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS f
  FROM docs, range(1, 4) AS lengths(n) WHERE len(w) >= n),
aimed AS (
  SELECT unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS f
  FROM aims, range(1, 4) AS lengths(n) WHERE len(w) >= n),
counts AS (SELECT row, f, count(*) AS n FROM runs GROUP BY row, f),
features AS MATERIALIZED (
  SELECT f, row_number() OVER () AS id, hex(encode(f)) AS bytes
  FROM (SELECT f FROM counts UNION SELECT f FROM aimed)),
crc_table AS MATERIALIZED (
  SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS bytes(b)),
crcs(id, rest, c) AS (
  SELECT id, bytes, 4294967295::BIGINT FROM features
  UNION ALL
  SELECT id, substr(rest, 3), xor(v, c >> 8)
  FROM crcs JOIN crc_table ON b = xor(c & 255, ('0x' || substr(rest, 1, 2))::BIGINT) WHERE rest <> ''),
bucketed AS (SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM crcs JOIN features USING (id) WHERE rest = ''),
source AS (SELECT bucket, sum(n) AS s FROM counts JOIN bucketed USING (f) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM aimed JOIN bucketed USING (f) GROUP BY bucket),
totals AS (
  SELECT coalesce((SELECT sum(s) FROM source), 0)::DOUBLE AS s, coalesce((SELECT sum(t) FROM target), 0)::DOUBLE AS t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(target.t, 0) + 1)::DOUBLE * (totals.s + 10000)
    / ((source.s + 1)::DOUBLE * (totals.t + 10000)))) AS gain
  FROM source LEFT JOIN target USING (bucket), totals),
weights AS (
  SELECT row, sum(n) AS n_features, sum(n * gain) AS weight
  FROM counts JOIN bucketed USING (f) JOIN gains USING (bucket) GROUP BY row),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (row)),
placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS r
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN r <= 5 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN r END AS rank
FROM placed
"""


_EMBEDDINGS = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
usable AS (
  SELECT row, vec_id, v FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.row AS a, b.row AS b FROM usable a JOIN usable b
  ON a.row <> b.row AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached(a, b) AS (
  SELECT row, row FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT a AS row, min(vec_id) AS component_id FROM reached JOIN vectors ON b = row GROUP BY a),
counts AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN classes USING (row) LEFT JOIN counts USING (row)
"""


_COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, range(1, 5) AS lengths(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
halves AS (
  SELECT cuts.lang, cuts.phrase, a, cut, l.f AS l, r.f AS r, (2000000 * a::HUGEINT) // (l.f + r.f) AS score
  FROM cuts
  JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
weakest AS (
  SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
spans AS (SELECT lang, w, a, k, unnest(range(2, k)) AS size FROM candidates WHERE k > 2),
starts AS (SELECT *, unnest(range(1, k - size + 2)) AS i FROM spans),
longer AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS f FROM starts GROUP BY ALL),
kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN longer USING (lang, phrase) WHERE 100 * coalesce(longer.f, 0) < 80 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_url_filter": _urls(),
        "op5_decontamination": _CONTAMINATION,
        "op9_license_scan": _licenses(),
        "op10_substring_dedup": _REPEATS,
        "op11_importance_resampling": _RESAMPLING,
        "op12_embedding_dedup": _EMBEDDINGS,
        "op13_collocations": _COLLOCATIONS,
    }
