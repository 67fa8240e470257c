"""DuckDB SQL of those corpus queries that SQL can express."""

from __future__ import annotations

from graphfeed.llm import (
    divergence, importance, mixing, ngram_lm, quality_rules, secret_scan, suffix_dedup)

_WORD = r"[^\x20\x09-\x0D]+"

# crc32 of the id as text, bit by bit, and its remainder mod 5
_CRC_MOD_5 = """(xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN
  string_split(doc_id::VARCHAR, '')]), lambda crc, b: list_reduce(list_prepend(xor(crc, b),
  [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1
  THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 5)"""

def _quality_rules() -> str:
    tests = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {c} AS cutoff" for rule, values in
        quality_rules.CUTOFFS.items() for c in values)
    risk, share = quality_rules.RISK, quality_rules.RISK / len(quality_rules.CUTOFFS)
    return rf"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '<none>') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '{_WORD}')] AS lines
  FROM documents),
places AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM split WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS tri FROM places),
twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, tri) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM twice)
  GROUP BY doc_id),
counts AS (
  SELECT s.doc_id, stratum, len(w) AS n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len([x for x in w if length(x) <= 2]) AS n_short, {_CRC_MOD_5} < {quality_rules.CHOOSING} AS choosing
  FROM split s LEFT JOIN covered c USING (doc_id)),
marks AS (
  SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
  GROUP BY doc_id HAVING min(quality) = max(quality)),
measured AS (
  SELECT c.*, m.good, u.rule, u.v FROM counts c LEFT JOIN marks m USING (doc_id),
  LATERAL (SELECT 'symbols_per_word' AS rule, n_symbols / greatest(n_words, 1) AS v
    UNION ALL SELECT 'dup_line_share', n_dup_lines / greatest(n_lines, 1)
    UNION ALL SELECT 'repeat_word_share', n_repeat_words / greatest(n_words, 1)
    UNION ALL SELECT 'chars_per_word', word_chars / greatest(n_words, 1)
    UNION ALL SELECT 'short_words', n_short / greatest(n_words, 1)) u),
tests AS ({tests}),
tested AS (
  SELECT stratum, rule, cutoff, sum(good) AS n,
    coalesce(sum(good) FILTER (v > cutoff), 0) AS k,
    coalesce(sum(1 - good) FILTER (v > cutoff), 0) AS bad
  FROM measured JOIN tests USING (rule) WHERE good IS NOT NULL AND choosing GROUP BY stratum, rule, cutoff),
picked AS (
  SELECT stratum, rule, cutoff, bad - k AS gain FROM tested WHERE bad > k AND k <= n * {share}::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad - k DESC, cutoff DESC) = 1),
chosen AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, rule) AS place FROM picked),
firsts AS (
  SELECT stratum, doc_id, min(CASE WHEN v > cutoff THEN place END) AS first
  FROM measured JOIN chosen USING (stratum, rule) WHERE good = 1 AND NOT choosing GROUP BY stratum, doc_id),
certified AS (
  SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (first <= place) AS k
  FROM chosen JOIN firsts USING (stratum) GROUP BY stratum, rule, cutoff, place),
chances AS (
  SELECT *, list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk})
    + (n - i) * ln(1 - {risk})) for i in range(0, (k + 1)::BIGINT)]) AS p
  FROM certified WHERE k <= n * {risk}::DOUBLE),
best AS (
  SELECT stratum, rule, cutoff FROM chances
  WHERE p <= {quality_rules.DOUBT} / (SELECT count(DISTINCT stratum) FROM chosen)),
broken AS (
  SELECT doc_id, string_agg(rule, ',' ORDER BY list_position(
    {list(quality_rules.CUTOFFS)}, rule)) AS rejected_by
  FROM measured JOIN best USING (stratum, rule) WHERE v > cutoff GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND rejected_by IS NULL) AS kept,
  coalesce(rejected_by, '') AS rejected_by
FROM counts LEFT JOIN broken USING (doc_id)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _secret_scan() -> str:
    def kind(name: str, rank: int, pattern: str, keep: str, value: str) -> str:
        return f"""
  SELECT doc_id, '{name}' AS kind, {rank} AS rank, s AS start, s + length(m) AS stop, {value} AS val
  FROM (SELECT doc_id, ms[j] AS m, (coalesce(list_sum([length(x) for x in ps[1:j]]), 0)
          + coalesce(list_sum([length(x) for x in ms[1:j - 1]]), 0))::BIGINT AS s
    FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS j FROM (
      SELECT doc_id, regexp_extract_all(t, {_quoted(pattern)}) AS ms,
             string_split_regex(t, {_quoted(pattern)}) AS ps FROM body))) WHERE {keep}"""
    secret = f"regexp_extract(m, {_quoted(secret_scan.ASSIGN)}, 2)"
    parts = " UNION ALL ".join([
        kind("assign", 0, secret_scan.ASSIGN, f"length({secret}) >= 12", secret),
        kind("access", 1, secret_scan.ACCESS, "length(m) >= 18", "m"),
        kind("hex", 2, secret_scan.HEX, "true", "m"),
        kind("owned", 3, secret_scan.MIXED, "regexp_matches(m, '[0-9]') AND "
             "regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')", "m")])
    return rf"""
WITH body AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
spans AS ({parts}),
owners AS (
  SELECT val, count(DISTINCT source) + count(DISTINCT CASE WHEN source IS NULL THEN 1 END) AS n
  FROM spans JOIN body USING (doc_id) GROUP BY val),
kept AS (
  SELECT s.*, o.n <= {secret_scan.MAX_OWNERS} AS live FROM spans s JOIN owners o USING (val)
  WHERE s.rank < 3 OR (o.n <= {secret_scan.MAX_OWNERS} AND NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.rank < 3
      AND b.start < s.stop AND s.start < b.stop))),
grouped AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
    count(*) FILTER (kind = 'hex') AS h, count(*) FILTER (live) AS live,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base
  FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access,
  coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(live, 0)::BIGINT AS n_live
FROM body LEFT JOIN grouped USING (doc_id)"""


ARCHIVE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
                  sha1(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, n, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY digest, n)
SELECT page_id, p.n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM p LEFT JOIN first USING (digest, n)"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, {mixing.MOST} * source_size AS cap, (ARRAY{mixing.WEIGHTS})[
    (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS w
  FROM sums),
levels AS (
  SELECT *, cap / w AS ratio, ({mixing.SHARE} * (SELECT sum(source_size) FROM sums)
    - coalesce(sum(cap) OVER (ORDER BY cap / w, encode(source) NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, encode(source) NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(cap, w * coalesce((SELECT first(level ORDER BY ratio) FROM levels
    WHERE level <= ratio), 'inf'::DOUBLE)) AS target FROM levels),
placed AS (
  SELECT doc_id, s.source, size, source_size, target, target / greatest(source_size, 1) AS each,
    row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) AS k,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce('s' || s.source, 'n')), 1, 8))::BIGINT
      / 4294967296.0::DOUBLE AS shift
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * least(floor(k * each + shift) - floor((k - 1) * each + shift), ceil(each)))::BIGINT AS taken
FROM placed"""


# lower-case A-Z only
_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")

NGRAM_LM = rf"""
WITH seqs AS (
  SELECT doc_id, {_CRC_MOD_5} = 1 AS held_out,
    list_append(regexp_extract_all({_LOWER}, '{_WORD}'), '') AS w FROM documents),
tokens AS (
  SELECT doc_id, held_out, unnest(w) AS word, unnest(list_prepend('', w[:len(w) - 1])) AS prev,
  FROM seqs),
single AS (SELECT word, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY word),
pairs AS (SELECT prev, word, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY prev, word),
total AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM single),
chances AS (
  SELECT t.*, coalesce(s.c, 0) AS c, (coalesce(s.c, 0) + 0.5) / (n + 0.5 * (v + 1)) AS p,
    coalesce(h.c, 0) AS ch, coalesce(q.c, 0) AS cq, n
  FROM tokens t CROSS JOIN total LEFT JOIN single s ON s.word = t.word
  LEFT JOIN single h ON h.word = t.prev
  LEFT JOIN pairs q ON q.prev = t.prev AND q.word = t.word)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known,
  any_value(n) AS train_tokens, sum(log10(p)) AS base_score,
  sum(log10((cq + {ngram_lm.MU} * p) / (ch + {ngram_lm.MU}))) AS score
FROM chances GROUP BY doc_id, held_out"""

MINHASH = rf"""
WITH RECURSIVE seqs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM seqs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y
    ON x.s = y.s AND x.doc_id < y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM seqs UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT s.doc_id, coalesce(z.n, 0) AS n_shingles, min(r.b) AS component_id,
  s.doc_id = min(r.b) AS kept
FROM seqs s LEFT JOIN sizes z USING (doc_id) JOIN reach r ON r.a = s.doc_id
GROUP BY s.doc_id, z.n"""


IMPORTANCE = rf"""
WITH steps AS (
  SELECT i, list_reduce(list_prepend(i, [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda a, k:
    xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)) AS c FROM range(256) t(i)),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL
  SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
seqs AS (
  SELECT side, r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
feats AS (
  SELECT side, r, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM seqs),
bytes AS (
  SELECT f, unnest(range(1, octet_length(encode(f)) + 1)) AS i, hex(f) AS h FROM (SELECT DISTINCT f FROM feats)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list(('0x' || h[2 * i - 1:2 * i])::BIGINT ORDER BY i)),
    lambda r, b: list_reduce(list_prepend(xor(r, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda a, k:
      xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))),
    4294967295::BIGINT) % {importance.BUCKETS} AS bucket
  FROM bytes GROUP BY f),
placed AS (SELECT side, r, bucket FROM feats JOIN hashed USING (f)),
counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, floor({importance.SCALE} * ln(((t + 1) * (sum(s) OVER () + {importance.BUCKETS}))::DOUBLE
    / ((s + 1) * (sum(t) OVER () + {importance.BUCKETS}))::DOUBLE))::BIGINT AS gain FROM counts),
sums AS (SELECT r, sum(gain) AS total, count(*) AS n FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scores AS (
  SELECT s.doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features,
    coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight, ('0x' || substr(sha256('{importance.SEED}:'
      || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM seqs s LEFT JOIN sums USING (r) WHERE side = 'd'),
noised AS (
  SELECT *, weight + floor(-{importance.SCALE}.0 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM scores),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id) AS k,
    {importance.PERCENT} * count(*) FILTER (words >= {importance.LEAST_WORDS}) OVER () // 100 AS most FROM noised)
SELECT doc_id, n_features, weight, score,
  CASE WHEN words >= {importance.LEAST_WORDS} AND k <= most THEN k END AS rank
FROM ranked"""

SUFFIX_DEDUP = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h FROM documents),
windows AS (
  SELECT r, p, md5_number(substr(h, 2 * p + 1, {2 * suffix_dedup.LENGTH})) AS w FROM (
    SELECT r, h, unnest(range(0, length(h) // 2 - {suffix_dedup.LENGTH} + 1)) AS p FROM texts
    WHERE length(h) >= {2 * suffix_dedup.LENGTH})),
twice AS (SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
marked AS (
  SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > {suffix_dedup.LENGTH}, true) AS new FROM twice),
islands AS (SELECT r, p, count(*) FILTER (new) OVER (PARTITION BY r ORDER BY p) AS k FROM marked),
spans AS (SELECT r, k, min(p) AS a, max(p) + {suffix_dedup.LENGTH} AS b FROM islands GROUP BY r, k),
pieces AS (
  SELECT r, h, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before,
    lead(a) OVER (PARTITION BY r ORDER BY a) IS NULL AS last FROM spans JOIN texts USING (r)),
cut AS (
  SELECT r, sum(b - a) AS gone, count(*) AS n, string_agg(substr(h, 2 * before + 1, 2 * (a - before))
    || CASE WHEN last THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept
  FROM pieces GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
  coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)"""

_KEPT_SHARE = (f"1 + ({divergence.SCALE}::HUGEINT * (n + {divergence.PRIOR})) "
               f"// (total + {divergence.PRIOR} * kept)")

DIVERGENCE = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, {_LOWER} AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
terms AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
kept AS (
  SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
sizes AS (SELECT lang, count(*) AS kept FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM texts),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, kept,
    coalesce(sum(c.n) OVER (PARTITION BY g.lang, g.source), 0) AS total
  FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
of_lang AS (
  SELECT lang, term, sum(n) AS n, any_value(kept) AS kept, sum(sum(n)) OVER (PARTITION BY lang) AS total
  FROM dense GROUP BY lang, term),
p AS (SELECT *, {_KEPT_SHARE} AS p FROM dense),
q AS (SELECT *, {_KEPT_SHARE} AS q FROM of_lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y
      ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
marks AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term)
  WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term', item, value FROM marks)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM ranked
QUALIFY part = 'pair' OR rank <= {divergence.TOP}"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality_rules(),
    "op2_ngram_lm": NGRAM_LM,
    "op3_archive": ARCHIVE,
    "op5_secret_scan": _secret_scan(),
    "op9_mixing": MIXING,
    "op10_minhash": MINHASH,
    "op11_importance": IMPORTANCE,
    "op12_suffix_dedup": SUFFIX_DEDUP,
    "op13_divergence": DIVERGENCE,
}
