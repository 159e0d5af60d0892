"""DuckDB SQL for the queries that SQL can express."""

from trolley.llm import quality

ORACLES = {}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quality():
    strip = lambda keep: f"length(regexp_replace(t, '[^{keep}]', '', 'g'))"
    classes = {
        "lower": strip("a-z"), "upper": strip("A-Z"),
        "beyond_ascii": r"length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))",
        "digit": strip("0-9"), "space": strip(r" \t\n\v\f\r"), "stop": strip(r""".,;:!?''"()\-"""),
    }
    names = [f"c{k}" for k in range(len(classes))]
    chars = ", ".join(f"{sql} AS {name}" for name, sql in zip(names, classes.values()))
    char_list = f"[{', '.join(names)}, n_chars - {' - '.join(names)}]"
    vocabulary = ", ".join(f"'{w}'" for w in quality.VOCABULARY)
    n_words = len(quality.VOCABULARY)
    part = "CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / (p + q)) ELSE 0 END"

    def distance(name):
        return f"""
        SELECT doc_id, lang, round(sqrt(greatest(sum({part.format(x='p')} + {part.format(x='q')}) / 2, 0)), 6) AS d FROM (
          SELECT d.doc_id, r.lang, d.v / d.total AS p, r.v / sum(r.v) OVER (PARTITION BY d.doc_id, r.lang) AS q
          FROM long_{name} d JOIN ref_{name} r USING (k)) GROUP BY ALL"""

    def reference(name):
        return f"""
        SELECT lang, k, sum(floor(v * {quality.SCALE} / total)) AS v FROM long_{name} JOIN base USING (doc_id)
        WHERE NOT base_failed AND lang IN ({', '.join(repr(x) for x in quality.LANGUAGES)}) GROUP BY ALL"""

    return f"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, length(coalesce(text, '')) AS n_chars, {WORDS} AS ws FROM documents
), tok AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM docs
), tri AS (
  SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM tok
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL) WHERE n > 1
), covered AS (SELECT doc_id, count(DISTINCT i) AS n FROM twice GROUP BY 1
), lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs
), dups AS (
  SELECT doc_id, sum(n - 1)::BIGINT AS n FROM (
    SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL)
  GROUP BY 1
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM (
    SELECT doc_id, lang, n_chars, len(ws) AS n_words, length(regexp_replace(t, '[ \\t\\n\\v\\f\\r]', '', 'g')) AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
      coalesce(covered.n, 0) AS n_repeat_words
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id))
), counted AS (SELECT doc_id, n_chars, {chars} FROM docs
), long_char AS (
  SELECT doc_id, n_chars AS total, unnest(range(1, 8)) AS k, unnest({char_list}) AS v FROM counted WHERE n_chars > 0
), hits AS (
  SELECT doc_id, translate(word, '{UPPER}', '{LOWER}') AS w, count(*) AS n FROM tok GROUP BY ALL
), vocabulary AS (SELECT unnest([{vocabulary}]) AS w, unnest(range(1, {n_words + 1})) AS k
), known AS (
  SELECT doc_id, n_words AS total, k, coalesce(n, 0) AS v
  FROM base JOIN vocabulary ON n_words > 0 LEFT JOIN hits USING (doc_id, w)
), long_word AS (
  SELECT * FROM known UNION ALL SELECT doc_id, total, {n_words + 1}, total - sum(v) FROM known GROUP BY doc_id, total
), ref_char AS ({reference('char')}
), ref_word AS ({reference('word')}
), near_char AS (SELECT doc_id, min(d) AS dc FROM ({distance('char')}) GROUP BY 1
), near_word AS (SELECT doc_id, min(d) AS dw FROM ({distance('word')}) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(dc, 0) > 0.3 OR (coalesce(dc, 0) > 0.14 AND coalesce(dw, 0) > 0.3)) AS kept
FROM base LEFT JOIN near_char USING (doc_id) LEFT JOIN near_word USING (doc_id)"""


ORACLES["op10_quality_rules"] = _quality()


# The level is found without rounds: sources by cap per weight, clamped while
# the level that the others would get lies above their own.
ORACLES["op6_mix_sources"] = f"""
WITH sizes AS (
  SELECT doc_id, source, len({WORDS}) AS size,
    CAST('0x' || substr(md5('7:' || doc_id), 1, 8) AS BIGINT) AS digest FROM documents
), totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY 1
), weighted AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM totals
), ranked AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER lower, 0) AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS share
  FROM weighted WINDOW lower AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT left_over, share FROM ranked WHERE weight * left_over <= 3 * source_size * share
  ORDER BY source_size / weight, source LIMIT 1
), filled AS (
  SELECT source, source_size, CASE WHEN weight * left_over > 3 * source_size * share THEN (3 * source_size)::DOUBLE
    ELSE (weight * left_over)::DOUBLE / share END AS target
  FROM weighted, level
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM filled
), placed AS (
  SELECT s.*, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS wanted,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY digest, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM sizes s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, (whole + (size > 0 AND middle <= wanted)::BIGINT) * size AS taken, source,
  whole + (size > 0 AND middle <= wanted)::BIGINT AS times FROM placed"""


# Exact: every pair that shares a shingle is counted; classes of equal sets are
# paired, so large groups of copies stay cheap.
ORACLES["op5_minhash_near_dedup"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents
), words AS (SELECT doc_id, {WORDS} AS ws FROM docs
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM words
), sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS digest FROM shingles GROUP BY 1
), classes AS (SELECT digest, any_value(n) AS n, min(doc_id) AS rep FROM sets GROUP BY 1
), small AS (SELECT rep, n, s FROM classes JOIN shingles ON rep = doc_id
), pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM small a JOIN small b ON a.s = b.s AND a.rep < b.rep
  GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(node, place) AS (
  SELECT rep, rep FROM classes UNION SELECT node, b FROM reach JOIN edges ON place = a
), labels AS (SELECT node, min(place) AS component FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
  coalesce(component, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN sets s USING (doc_id) LEFT JOIN classes c USING (digest) LEFT JOIN labels ON c.rep = node"""


ORACLES["op1_embedding_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(node, place) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT node, b FROM reach JOIN edges ON place = a
), labels AS (SELECT node, min(place) AS component_id FROM reach GROUP BY 1
), counts AS (SELECT a, count(*) AS n FROM edges GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN labels ON vec_id = node LEFT JOIN counts ON vec_id = a"""


# Shares by plain division, every pair of sources over every kept term.
ORACLES["op11_source_divergence"] = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), hits AS (
  SELECT lang, source, doc_id, term, count(*) AS n FROM (SELECT *, unnest(ts) AS term FROM docs) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS total FROM hits GROUP BY 1, 2 HAVING count(*) >= 30
), known AS (SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
  FROM known g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM hits GROUP BY ALL) c USING (lang, source, term)
), sized AS (
  SELECT *, sum(n) OVER own AS own_total, sum(n) OVER whole AS all_total,
    count(*) OVER own AS v FROM cells
  WINDOW own AS (PARTITION BY lang, source), whole AS (PARTITION BY lang)
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (own_total + 5 * v) AS p,
    1 + (1000000000 * (total + 5)) // (all_total + 5 * v) AS q FROM sized
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL
), ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM known a JOIN known b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 50"""


# Runs as stretches of equal words at equal distance. The crc32 of the id is
# worked out bit by bit: each digit is one step that mixes it in and eight that shift.
ORACLES["op12_word_runs"] = rf"""
WITH marked AS (
  SELECT doc_id, {WORDS} AS ws, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(doc_id::VARCHAR, ''), lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, op: CASE WHEN op >= 0 THEN xor(c, op) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END
  )) AS h FROM documents
), shaped AS (
  SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS made, (h // 10) AS g,
    CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM marked
), docs AS (
  SELECT doc_id, n, CASE WHEN made THEN list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i >= a
    THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END]) ELSE ws END AS ws FROM shaped
), words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM docs
), equal AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.w = b.w AND a.i < b.i
), islands AS (
  SELECT doc_id, q, min(i) AS s, count(*) AS m FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, s, m + q AS length, min(q) AS q FROM islands WHERE m + q >= greatest(12, 2 * q) GROUP BY doc_id, s, m + q
), told AS (
  SELECT doc_id, count(*) AS n_runs, arg_max({{'s': s, 'l': length, 'q': q}}, {{'l': length, 's': -s, 'q': -q}}) AS best,
    string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY 1
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY 1
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
  (1000 * best.l) // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)"""
