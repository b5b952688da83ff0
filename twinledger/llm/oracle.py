"""DuckDB SQL for the queries that it can express, each stating the result anew over whole tables.

Byte-pair merges, page trees, the trained classifier and the disclosure
statistics have none; tests hold those against brute force.
"""

from __future__ import annotations

from twinledger.llm import licenses, mixing, secrets

SQL: dict[str, str] = {}

SQL["op1_voronoi_knn"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_inner_product(CAST(q.vector AS DOUBLE[]), CAST(d.vector AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20
"""

# Walks from every vector; components are small enough for that in the given tables.
SQL["op2_metric_range_join"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.x, b.x) / (sqrt(list_inner_product(a.x, a.x)) * sqrt(list_inner_product(b.x, b.x))) >= 0.95
), walk(node, reached) AS (
  SELECT a, b FROM link
  UNION
  SELECT walk.node, link.b FROM walk JOIN link ON walk.reached = link.a
), label AS (SELECT node, min(reached) AS low FROM walk GROUP BY node),
links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN links ON links.a = e.vec_id LEFT JOIN label ON label.node = e.vec_id
"""

_WORDS = r"""
  string_split_regex(trim(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ')
"""

SQL["op7_minhash_jaccard"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter({_WORDS}, lambda x: x <> '') AS words FROM documents
), gram AS (
  SELECT doc_id, unnest(list_distinct(list_transform(
    range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' ')))) AS g
  FROM w WHERE len(words) > 0
), size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM both_have JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE both_have.n / (x.n + y.n - both_have.n) >= 0.8
), walk(node, reached) AS (
  SELECT a, b FROM link
  UNION
  SELECT walk.node, link.b FROM walk JOIN link ON walk.reached = link.a
), label AS (SELECT node, min(reached) AS low FROM walk GROUP BY node),
links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       least(d.doc_id, coalesce(low, d.doc_id)) AS class_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM documents d LEFT JOIN links ON links.a = d.doc_id LEFT JOIN label ON label.node = d.doc_id
"""

# The level at which the clamped shares add up to the whole, by the order in which sources clamp.
SQL["op5_water_filling"] = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORDS}')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place
  FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CASE place WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         {mixing.EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total
  FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER b, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weights
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT CAST(total - held AS DOUBLE) AS rest, CAST(weights AS DOUBLE) AS among
  FROM o WHERE cap >= weight * (total - held) / weights ORDER BY cap / weight, source NULLS LAST LIMIT 1
), t AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), weight * rest / among) AS target
  FROM w, level
), f AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.doc_id, d.source, d.size, f.source_size, f.target, f.whole,
         floor(log2(greatest(d.size, 1))) AS stratum,
         CASE WHEN f.source_size > 0 THEN target - whole * f.source_size ELSE 0 END AS rest,
         md5('mix:' || d.doc_id) AS place
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
), m AS (
  SELECT *, sum(size) OVER (PARTITION BY source, stratum) AS words,
         coalesce(sum(size) OVER (PARTITION BY source, stratum ORDER BY place, doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0 AS middle
  FROM r
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN rest * words / source_size ELSE 0 END AS quota FROM m
), g AS (
  SELECT source, stratum, any_value(words) AS words, any_value(quota) AS quota,
         coalesce(sum(size) FILTER (middle <= quota), 0) AS got
  FROM q GROUP BY source, stratum
), total_missed AS (
  SELECT source, max_by(stratum, (words, stratum)) AS largest,
         CAST(sum(CAST(quota AS DECIMAL(38,6)) - got) AS DOUBLE) AS missed
  FROM g GROUP BY source
), moved AS (
  SELECT g.*, largest, got + missed AS line, got + missed BETWEEN 0 AND words AS fits
  FROM g JOIN total_missed m ON g.source IS NOT DISTINCT FROM m.source
), line AS (
  SELECT source, coalesce(min(stratum) FILTER (fits), any_value(largest)) AS evens,
         coalesce(min_by(line, stratum) FILTER (fits), min(line) FILTER (stratum = largest)) AS line
  FROM moved GROUP BY source
)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN size > 0 AND middle <= CASE WHEN stratum = evens THEN line ELSE quota END
                     THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM q JOIN line ON q.source IS NOT DISTINCT FROM line.source
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _spans(table: str, rank: int, pattern: str, when: str = "true") -> str:
    """Spans of a pattern: positions are the lengths of the pieces and matches before."""
    p = _text(pattern)
    return f"""
  SELECT doc_id, rank, CAST(start AS BIGINT) AS start, CAST(start + length(found) AS BIGINT) AS stop FROM (
    SELECT doc_id, {rank} AS rank, found,
           sum(length(piece) + coalesce(length(before), 0)) OVER (PARTITION BY row ORDER BY pos) AS start
    FROM (SELECT *, lag(found) OVER (PARTITION BY row ORDER BY pos) AS before FROM (
      SELECT doc_id, row, unnest(range(len(founds))) AS pos, unnest(founds) AS found, unnest(pieces[1:len(founds)]) AS piece
      FROM (SELECT doc_id, row, regexp_extract_all(text, {p}) AS founds, string_split_regex(text, {p}) AS pieces FROM {table})
    ))
  ) WHERE {when}"""


_S = secrets
# The patterns that are enough alone, as they are asked for, not as the operator writes them.
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_MIXED = "regexp_matches(found, '[0-9]') AND regexp_matches(found, '[a-z]') AND regexp_matches(found, '[A-Z]')"
SQL["op9_linked_secrets"] = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
every AS (
  {_spans("t", 0, _ASSIGN, f"length(regexp_extract(found, {_text(_ASSIGN)}, 2)) >= 6")}
  UNION ALL {_spans("t", 1, "AKIA[A-Z0-9]+", "length(found) >= 20")}
  UNION ALL {_spans("t", 2, "[0-9a-f]+", "length(found) >= 24")}
  UNION ALL {_spans("t", 3, _S.WEAK_ID)}
  UNION ALL {_spans("t", 4, _S.WEAK_SECRET)}
  UNION ALL {_spans("t", 5, _S.ENDPOINT)}
  UNION ALL {_spans("t", 6, _S.BARE, _MIXED)}
), tiered AS (
  SELECT *, CASE WHEN rank < 3 THEN 0 WHEN rank < 6 THEN 1 ELSE 2 END AS tier,
         CASE WHEN rank IN (1, 3) THEN 'id' WHEN rank = 5 THEN 'endpoint' ELSE 'secret' END AS role
  FROM every
), part AS (
  SELECT * FROM tiered p WHERE NOT EXISTS (
    SELECT 1 FROM tiered o WHERE o.doc_id = p.doc_id AND o.tier < p.tier AND o.start < p.stop AND o.stop > p.start)
), confirmed AS (
  SELECT p.doc_id, p.rank, p.start, p.stop FROM part p JOIN part o
  ON p.doc_id = o.doc_id AND p.role <> o.role AND o.start < p.stop + {_S.SCOPE} AND o.stop > p.start - {_S.SCOPE}
  WHERE p.rank >= 3
  GROUP BY p.doc_id, p.rank, p.start, p.stop, p.role
  HAVING CASE p.role WHEN 'secret' THEN bool_or(o.role IN ('id', 'endpoint')) WHEN 'id' THEN bool_or(o.role = 'secret')
         ELSE bool_or(o.role = 'id') AND bool_or(o.role = 'secret') END
), listed AS (
  SELECT doc_id, rank, start, ['{"', '".join(_S.KINDS)}'][rank + 1] || ':' || start || ':' || stop AS span, stop
  FROM (SELECT doc_id, rank, start, stop FROM every WHERE rank < 3 UNION ALL SELECT * FROM confirmed)
), joined AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
         count(*) FILTER (rank = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
         string_agg(span, ',' ORDER BY start, rank, stop) AS spans
  FROM listed GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined USING (doc_id)
"""


def _rule_rows() -> str:
    return ",\n".join(
        f"({n}, '{label}', '{keyword}', {priority}, CAST({confidence} AS DOUBLE), {_text(expression)})"
        for n, label, keyword, priority, confidence, expression in licenses.rules()
    )


# The base phrases and their labels.
_BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_PHRASES = ", ".join(f"('{' ' + p.replace(' ', '  ') + ' '}', '{label}', {len(p.split())})" for p, label in _BASE.items())
_COUNT = "CAST((length({0}) - length(replace({0}, ' ', ''))) / 2 AS BIGINT)"
SQL["op10_license_rules"] = rf"""
WITH n AS (
  SELECT doc_id, row_number() OVER () AS row, trim(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g')) AS words FROM documents
), t AS (SELECT doc_id, row, CASE WHEN words = '' THEN '' ELSE ' ' || words || ' ' END AS text FROM n),
phrase(expression, label, long) AS (VALUES {_PHRASES}),
rule(rule, label, keyword, priority, confidence, expression) AS (VALUES {_rule_rows()}),
p AS (
  SELECT t.doc_id, t.row, phrase.label, long, string_split(t.text, expression) AS pieces, t.text
  FROM t JOIN phrase ON contains(t.text, expression)
), place AS (
  SELECT row, sum(len(pieces) - 1) AS n_base, list_sort(list(DISTINCT label)) AS base_labels,
         min({_COUNT.format("pieces[1]")}) AS first_word,
         max({_COUNT.format("text")} - {_COUNT.format("pieces[-1]")} - long) AS last_word
  FROM p GROUP BY row
), hit AS (
  SELECT t.row, rule, label, priority, confidence, regexp_extract_all(t.text, expression) AS founds,
         string_split_regex(t.text, expression) AS pieces
  FROM t JOIN rule ON contains(t.text, ' ' || keyword || ' ') AND regexp_matches(t.text, expression)
), piece AS (
  SELECT row, rule, label, priority, confidence, unnest(range(len(founds))) AS pos, unnest(founds) AS found,
         unnest(pieces[1:len(founds)]) AS piece
  FROM hit
), span AS (
  SELECT row, rule, label, priority, confidence, {_COUNT.format("found")} AS long,
         sum({_COUNT.format("piece")} + {_COUNT.format("found")}) OVER (PARTITION BY row, rule ORDER BY pos) AS stop
  FROM piece
), kept AS (
  SELECT * FROM span s WHERE NOT EXISTS (
    SELECT 1 FROM span o WHERE o.row = s.row AND o.priority >= s.priority
      AND o.stop - o.long <= s.stop - s.long AND o.stop >= s.stop
      AND (o.long > s.long OR o.priority > s.priority OR o.rule < s.rule))
), ruled AS (SELECT row, list(DISTINCT label) AS labels, max(confidence) AS score FROM kept GROUP BY row)
SELECT t.doc_id, {_COUNT.format("t.text")} AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       first_word, last_word, array_to_string(coalesce(base_labels, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(ruled.labels, [])))), ',') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 0.7 ELSE 0.0 END::DOUBLE, coalesce(score, 0.0::DOUBLE)) AS score
FROM t LEFT JOIN place USING (row) LEFT JOIN ruled USING (row)
"""

SQL["op13_content_sort"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), g AS (
  SELECT doc_id, content, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM d WINDOW w AS (PARTITION BY content ORDER BY length(text) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM g
"""

# A checksum bit by bit; then rows are walked in order with the cheapest way to each state of the pattern,
# held as the cost in twelve digits and the audit.
_BIT = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
_ADD = "lpad(CAST(CAST({0}[1:12] AS BIGINT) + {1} AS VARCHAR), 12, '0') || {0}[13:] || '{2}'"


def _add(state: str, cost: str, edit: str) -> str:
    return "(" + _ADD.format(state, cost, edit) + ")"


def _turn(state: str, initial: str) -> str:
    """A kept or re-roled turn after ``state``; NULL if the turn must go."""
    roles = "" if initial == "s" else f" ELSE {_add(state, '1 + extra', 'R')}"
    return f"CASE WHEN gone THEN NULL WHEN initial = '{initial}' THEN {_add(state, 'extra', 'K')}{roles} END"


_STATES = f"""
  least(u, {_add("s", "5", "I")}, {_add("y", "5", "I")}, {_add("a", "5", "I")}) AS u,
  least(a, {_add("u", "5", "I")}, {_add("s", "10", "II")}, {_add("y", "10", "II")}) AS a"""
SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE crc AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: {_BIT})),
         4294967295) % 20 AS fault
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged
), seen AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
         left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), faulty AS (
  SELECT *, NOT blank AND again AS duplicate, NOT blank AND NOT again AND final NOT IN ('.', '!', '?') AS truncated,
         blank OR again AS gone
  FROM seen
), line AS (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM faulty),
walk(conv_id, pos, s, y, u, a) AS (
  SELECT conv_id, 0::BIGINT, repeat('0', 12), NULL::VARCHAR, repeat('0', 11) || '5I', repeat('0', 10) || '10II'
  FROM (SELECT DISTINCT conv_id FROM line)
  UNION ALL
  SELECT conv_id, pos, s, y, {_STATES}
  FROM (
    SELECT walk.conv_id, line.pos, {_add("s", "2", "D")} AS s,
           least({_add("y", "2", "D")}, {_turn("s", "s")}) AS y,
           least({_add("u", "2", "D")}, {_turn("s", "u")}, {_turn("y", "u")}, {_turn("a", "u")}) AS u,
           least({_add("a", "2", "D")}, {_turn("u", "a")}) AS a
    FROM walk JOIN line ON walk.conv_id IS NOT DISTINCT FROM line.conv_id AND line.pos = walk.pos + 1
  )
), ended AS (
  SELECT conv_id, CAST(best[1:12] AS BIGINT) AS cost, best[13:] AS audit
  FROM (SELECT conv_id, arg_max(least(s, a), pos) AS best FROM walk GROUP BY conv_id)
), edit AS (
  SELECT conv_id, n, audit[n] AS edit, len(replace(audit[1:n], 'I', '')) AS pos, len(replace(audit[1:n], 'D', '')) AS output,
         len(replace(audit, 'D', '')) AS outputs
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS n FROM ended)
), said AS (
  SELECT edit.conv_id, n,
         CASE WHEN edit = 'K' THEN role WHEN (output + outputs) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
         CASE WHEN edit = 'I' THEN '' ELSE text END AS said
  FROM edit LEFT JOIN line ON edit.conv_id IS NOT DISTINCT FROM line.conv_id AND edit.pos = line.pos
  WHERE edit <> 'D'
), repaired AS (SELECT conv_id, string_agg(said, chr(10) ORDER BY n) AS repaired FROM said GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM line GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM c.conv_id
"""

SQL["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
grp AS (SELECT DISTINCT lang, source, false AS whole FROM d UNION ALL SELECT DISTINCT lang, NULL, true FROM d),
counted AS (
  SELECT lang, source, false AS whole, term, count(*) AS n FROM o GROUP BY lang, source, term
  UNION ALL SELECT lang, NULL, true, term, count(*) FROM o GROUP BY lang, term
), dense AS (
  SELECT g.lang, g.source, g.whole, k.term, coalesce(c.n, 0) AS n
  FROM grp g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source IS NOT DISTINCT FROM g.source AND c.whole = g.whole AND c.term = k.term
), share AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g)::HUGEINT AS p
  FROM dense WINDOW g AS (PARTITION BY lang, whole, source)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  WHERE NOT a.whole AND NOT b.whole GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  WHERE NOT a.whole AND NOT b.whole
  UNION ALL
  SELECT a.lang, a.source, 'term', a.term, a.p - b.p
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND b.whole
  WHERE NOT a.whole AND a.n > 0 AND a.p > b.p
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every
QUALIFY part = 'pair' OR rank <= 50
"""
