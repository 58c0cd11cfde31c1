"""DuckDB SQL for the operators that SQL can express, written without their filters."""

from __future__ import annotations

_words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LICENSE_SCAN = rf"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, text, {_words.format('text')} AS w FROM t),
p AS (SELECT r, unnest(generate_series(2, len(w))) AS i, w FROM d WHERE list_contains(w, 'license')),
base AS (
  SELECT r, i - 2 AS s, w[i - 1] AS label FROM p WHERE w[i] = 'license' AND w[i - 1] IN ('mit', 'apache')
  UNION ALL SELECT r, i - 3, 'gpl' FROM p WHERE i > 2 AND w[i] = 'license' AND w[i - 1] = 'public' AND w[i - 2] = 'general'),
notices(label, notice) AS (VALUES
  ('mit', 'released under the mit license'),
  ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
  ('apache', 'licensed under the apache license version 2 0'),
  ('gpl', 'this work is licensed under the gnu general public license version 3'),
  ('gpl', 'you can redistribute it and or modify it under the terms of the gnu general public license'),
  ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
  ('isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
  ('mpl', 'this source code form is subject to the terms of the mozilla public license'),
  ('cc-by-nc', 'licensed under cc by nc 4 0'),
  ('public-domain', 'this is free and unencumbered software released into the public domain'),
  ('proprietary', 'all rights reserved')),
templates AS (SELECT row_number() OVER () AS t, label, list_distinct(string_split(notice, ' ')) AS words,
    (5 * len(string_split(notice, ' ')) + 3) // 4 AS span FROM notices),
tw AS (SELECT t, label, span, len(words) AS size, unnest(words) AS word FROM templates),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
h AS (SELECT r, t, label, size, count(DISTINCT word) OVER (PARTITION BY r, t ORDER BY i RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS shared
      FROM x JOIN tw USING (word)),
met AS (SELECT r, label, max(shared::DOUBLE / size) AS share FROM h WHERE 5 * shared >= 4 * size GROUP BY ALL),
bl AS (SELECT r, count(*) AS n, min(s) AS a, max(s) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM met) GROUP BY r),
best AS (SELECT r, max(share) AS share FROM met GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
  coalesce(bl.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bl USING (r) LEFT JOIN al USING (r) LEFT JOIN best USING (r)
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, i, lines[i] AS line FROM (
    SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
k AS (SELECT doc_id, i, line, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
first AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, keeper IS NULL OR keeper = doc_id AS stays FROM k LEFT JOIN first USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

COLLOCATIONS = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
    SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS m FROM p) WHERE m <= len(w))),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100),
k AS (SELECT c.*, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:m], ' ') AS rp
    FROM (SELECT c.*, unnest(generate_series(1, m - 1)) AS k FROM c) c),
s AS (SELECT k.*, x.f AS l, y.f AS r, n.n, (1000 * a * n.n) // (x.f * y.f) AS score
    FROM k JOIN f x ON x.lang = k.lang AND x.phrase = lp JOIN f y ON y.lang = k.lang AND y.phrase = rp JOIN n ON n.lang = k.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT DISTINCT x.lang, x.phrase FROM low x JOIN (
    SELECT lang, a, m, array_to_string(w[i:i + q - 1], ' ') AS inner_ FROM (
      SELECT lang, a, m, w, q, unnest(generate_series(1, m - q + 1)) AS i FROM (SELECT c.*, unnest(generate_series(2, m - 1)) AS q FROM c)))
    o ON o.lang = x.lang AND o.inner_ = x.phrase AND 100 * o.a >= 100 * x.a),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM low ANTI JOIN held USING (lang, phrase))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM t WHERE rank <= 2000
"""

HARD_NEGATIVES = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

REPEATED_PASSAGES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT r, doc_id, h, length(h) // 2 AS n FROM d),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT r, doc_id, h, unnest(generate_series(0, n - 50)) AS i FROM n WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(*) > 1),
m AS (SELECT r, i FROM w JOIN f USING (s) WHERE doc_id > first),
b AS (SELECT r, i, substr(h, 2 * i + 1, 2) AS byte FROM (
    SELECT r, h, unnest(generate_series(0, n - 1)) AS i FROM n SEMI JOIN m USING (r))),
c AS (SELECT b.r, b.i, byte, coalesce(max(m.i) OVER (PARTITION BY b.r ORDER BY b.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), -1) >= 0 AS gone
  FROM b LEFT JOIN m ON m.r = b.r AND m.i = b.i),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS begins FROM c),
g AS (SELECT r, count(*) FILTER (gone) AS removed, count(*) FILTER (begins) AS spans, string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN g.r IS NULL THEN h ELSE coalesce(kept, '') END)) AS kept_sha256
FROM n LEFT JOIN g USING (r)
"""
