"""DuckDB SQL of the queries that SQL can express. The others learn a model,
apply a tokenizer file, or hash with a function that SQL lacks."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PIECE_END, _PIECE_WORD = r"[.,;:!?\x0A-\x0D]", r"[^\x20\x09]+"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    # Equal strings found by their digest; starts at most a string's length
    # apart belong to one removed run.
    "op8_suffix_array_dedup": """WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
starts AS (
  SELECT doc_id, pos, md5(substr(x, CAST(2 * pos + 1 AS BIGINT), 400)) AS digest
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 199)) AS pos FROM bytes)),
again AS (SELECT digest FROM starts GROUP BY digest HAVING count(*) > 1),
hits AS (SELECT doc_id, pos FROM starts SEMI JOIN again USING (digest)),
marked AS (
  SELECT *, pos - lag(pos, 1, -1000) OVER (PARTITION BY doc_id ORDER BY pos) > 200 AS fresh FROM hits),
runs AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 200 AS b FROM (
    SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked)
  GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM runs),
kept AS (
  SELECT doc_id, sum(b - a) AS gone, count(*) AS n, max(b) AS tail,
    string_agg(substr(x, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a) AS head
  FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, CAST(2 * coalesce(tail, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)""",
    "op9_benchmark_decontamination": f"""WITH d AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
q AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(_LOWER.format('text'))} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[pos:pos + k - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS pos
        FROM (SELECT *, least(10, len(w)) AS k FROM q WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, k, pos, array_to_string(w[pos:pos + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d CROSS JOIN sizes)),
found AS (SELECT doc_id, pos, k, item FROM places JOIN windows USING (k, t)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM (SELECT DISTINCT doc_id, pos, k FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # All phrases of one to three words, counted as strings.
    "op11_phrase_collocations": f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_extract_all(unnest(string_split_regex({_LOWER.format('text')}, '{_PIECE_END}')), '{_PIECE_WORD}') AS w
  FROM documents),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p
  FROM pieces CROSS JOIN (VALUES (1), (2), (3)) AS sizes(k)),
f AS (
  SELECT lang, k, array_to_string(w[p:p + k - 1], ' ') AS phrase, count(*) AS a FROM places GROUP BY ALL),
found AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM found),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.w, c.k, c.cut, x.a AS l, y.a AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
    FROM found WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
    # crc32 byte by byte over the distinct features, with its table made by rule.
    "op12_importance_resampling": f"""WITH RECURSIVE bits(n, step, c) AS (
  SELECT n, 0, CAST(n AS BIGINT) FROM range(256) AS t(n)
  UNION ALL SELECT n, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE step = 8),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
texts AS (
  SELECT 'd' AS side, k, w FROM docs
  UNION ALL SELECT 'b', row_number() OVER (), {_WORDS.format(_LOWER.format('text'))} FROM benchmark),
features AS (
  SELECT side, k, array_to_string(w[p:p + m - 1], ' ') AS f FROM (
    SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM texts CROSS JOIN (VALUES (1), (2), (3)) AS runs(m))),
bytes AS (
  SELECT f, list_transform(range(0, length(hex(encode(f))) // 2), lambda i:
      CAST(instr('123456789ABCDEF', substr(hex(encode(f)), CAST(2 * i + 1 AS BIGINT), 1)) * 16
        + instr('123456789ABCDEF', substr(hex(encode(f)), CAST(2 * i + 2 AS BIGINT), 1)) AS BIGINT)) AS x
  FROM (SELECT DISTINCT f FROM features)),
buckets AS (
  SELECT f, xor(list_reduce(x, lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]),
    CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM bytes CROSS JOIN crc),
counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM features JOIN buckets USING (f) GROUP BY bucket),
sums AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1.0::DOUBLE) * (s_all + 10000))
    / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain FROM counts CROSS JOIN sums),
weights AS (
  SELECT k, CAST(count(*) AS BIGINT) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY k),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score, len(w) >= 20 AS able
  FROM docs LEFT JOIN weights USING (k)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (able) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND place <= 5 * n // 100 THEN CAST(place AS BIGINT) END AS rank FROM ranked""",
    # Common shingles of all pairs that share one, then all that can be reached.
    "op13_minhash_near_dedup": f"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[CAST(i + 1 AS BIGINT)]) END)) AS s FROM texts),
kinds AS (SELECT min(doc_id) AS d, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT d, n, unnest(s) AS x FROM kinds),
pairs AS (
  SELECT a.d AS a, b.d AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.d < b.d
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.d, b.d HAVING 100 * count(*) >= 80 * (min(a.n) + min(b.n) - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached(a, b) AS (
  SELECT d, d FROM kinds UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
roots AS (SELECT s, min(b) AS component_id FROM reached JOIN kinds ON reached.a = kinds.d GROUP BY s)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept FROM sets LEFT JOIN roots USING (s)""",
}
