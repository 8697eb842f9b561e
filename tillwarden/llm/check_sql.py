"""SQL with the results of those queries that SQL can express, over the same tables."""

HOST_RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), runs AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
), repeated AS (
  SELECT doc_id, i FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + s) AS n
  FROM repeated, (SELECT unnest([0, 1, 2]) AS s) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
              AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS bad FROM f GROUP BY host
), prior AS (
  SELECT avg(bad / n) AS mean, var_pop(bad / n) AS spread FROM hosts
), strength AS (
  SELECT mean, CASE WHEN spread > 0
                    THEN greatest(1.0, least(10000.0, mean * (1 - mean) / spread - 1)) ELSE 10000.0 END AS k
  FROM prior
), verdicts AS (
  SELECT host, (bad + mean * k) / (n + k) <= 0.5 AS host_kept FROM hosts, strength
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_kept,
       NOT base_failed AND host_kept AS kept
FROM f JOIN verdicts USING (host)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, g, array_to_string(w[i : i + g - 1], ' ') AS phrase
  FROM (SELECT lang, w, g, unnest(range(1, len(w) - g + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS g) WHERE len(w) >= g)
), f AS (
  SELECT lang, g, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 100
), whole AS (
  SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang
), c AS (
  SELECT lang, g, phrase, n AS a, string_split(phrase, ' ') AS p FROM f WHERE g > 1
), cuts AS (
  SELECT c.lang, c.g, c.phrase, c.a, k, l.n AS l, r.n AS r, whole.n AS n,
         CAST((CAST(1000 AS HUGEINT) * c.a * whole.n) // (CAST(l.n AS HUGEINT) * r.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, g)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.p[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(p[k + 1 : c.g], ' ')
  JOIN whole ON whole.lang = c.lang
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(p[i : i + h - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT lang, p, a, g, h, unnest(range(1, g - h + 2)) AS i
        FROM (SELECT *, unnest(range(2, g)) AS h FROM c WHERE g > 2))
  GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
  FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM ranked WHERE rank <= 2000
"""

RANKED_SEARCH = r"""
WITH t AS (
  SELECT i, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS i FROM documents)
), d AS (
  SELECT i, doc_id, count(*) AS n FROM t GROUP BY ALL
), s AS (
  SELECT count(*) AS docs, sum(n) AS terms FROM d
), q AS (
  SELECT j, item_id, term, count(*) AS times
  FROM (SELECT j, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT item_id, text, row_number() OVER () AS j FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)))
  GROUP BY ALL
), tf AS (
  SELECT i, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term
), scores AS (
  SELECT j, item_id, doc_id, i,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + CAST((25 * n * docs) // terms AS BIGINT))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (i), s GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""
