"""DuckDB SQL for the corpus queries that SQL can express.

Not here: fertility (pieces of a vocabulary), byte-level BPE, sequences and token counts
(byte-pair merges), SimHash (its hash and the closure of links) and language mixtures
(an iterated fit). Tests hold those against plain Python over the libraries themselves.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LICENCES = rf"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
base AS (
  SELECT row_id, i - 1 AS start, CASE
      WHEN w[i] = 'gnu' AND w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license' THEN 'gpl'
      WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
      WHEN w[i] = 'cc' AND w[i + 1] = 'by' THEN 'cc-by'
      WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit' END AS label
  FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts)),
places AS (SELECT * FROM base WHERE label IS NOT NULL),
templates(template, label, body, keys) AS (VALUES
  (0, 'apache-2.0', 'licensed under the apache license version 2 0', 'apache'),
  (1, 'apache-2.0', 'licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at', 'apache'),
  (2, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met', ''),
  (3, 'cc-by-4.0', 'licensed under cc by 4 0', 'cc by'),
  (4, 'cc-by-nc-4.0', 'licensed under cc by nc 4 0', 'cc by nc'),
  (5, 'cc-by-sa-4.0', 'licensed under cc by sa 4 0', 'cc by sa'),
  (6, 'gpl-3.0', 'this work is licensed under the gnu general public license version 3', 'gnu public'),
  (7, 'gpl-notice', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation', 'gnu'),
  (8, 'isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted', ''),
  (9, 'mit-notice', 'released under the mit license', 'mit'),
  (10, 'mit-text', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction', ''),
  (11, 'mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0', 'mozilla')),
cut AS (SELECT template, label, string_split(body, ' ') AS t, string_split(keys, ' ') AS keys, CASE WHEN len(string_split(body, ' ')) >= 12 THEN 4 ELSE 2 END AS g
        FROM templates),
t_words AS (SELECT template, unnest(t) AS word, unnest(range(0, len(t))) AS j, list_contains(keys, unnest(t)) AS key FROM cut),
grams AS (
  SELECT template, j AS t_pos, g, array_to_string(t[j + 1:j + g], ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(t) - g + 1)) AS j FROM cut) WHERE g = 4 OR len(list_intersect(t[j + 1:j + g], keys)) > 0),
scanned AS (
  SELECT row_id, i - 1 AS pos, g, array_to_string(w[i:i + g - 1], ' ') AS gram
  FROM (SELECT row_id, w, g, unnest(range(1, len(w) - g + 2)) AS i FROM texts, (VALUES (2), (4)) AS lengths(g))),
diagonals AS (
  SELECT row_id, template, g, pos - t_pos AS diagonal, min(pos) AS lo, max(pos) AS hi FROM scanned JOIN grams USING (g, gram) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER d <= 3 AND lo <= lag(hi) OVER d + g + 3 AND hi >= lag(lo) OVER d - g - 3
                 THEN 0 ELSE 1 END AS fresh
  FROM diagonals WINDOW d AS (PARTITION BY row_id, template ORDER BY diagonal)),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY row_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked),
extent AS (SELECT row_id, template, span, min(lo) AS first_pos, max(hi) + any_value(g) AS end_pos FROM numbered GROUP BY ALL),
verified AS (
  SELECT m.row_id, m.template, m.span, count(DISTINCT j) AS n, count(DISTINCT j) FILTER (key) AS n_keys
  FROM numbered m JOIN texts x ON x.row_id = m.row_id JOIN t_words tw ON tw.template = m.template JOIN range(-3, 4) AS near(e) ON true
  WHERE j + diagonal + e >= 0 AND w[(j + diagonal + e + 1)::BIGINT] = word GROUP BY ALL),
holding AS (
  SELECT row_id, template, label, span, first_pos, end_pos, n, n::DOUBLE / len(t) AS share
  FROM extent JOIN verified USING (row_id, template, span) JOIN cut USING (template)
  WHERE n >= 0.75 * len(t) AND n_keys = (SELECT count(*) FROM t_words k WHERE k.template = cut.template AND key)
    AND end_pos - first_pos <= len(t) * 1.5 + 3),
spans AS (
  SELECT * FROM holding h WHERE NOT EXISTS (
    SELECT 1 FROM holding o WHERE o.row_id = h.row_id AND o.first_pos < h.end_pos AND h.first_pos < o.end_pos
      AND (o.n > h.n OR (o.n = h.n AND (o.share > h.share OR (o.share = h.share AND o.template < h.template)))))),
named AS (
  SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT row_id, label FROM places UNION SELECT row_id, label FROM spans) GROUP BY row_id),
own AS (
  SELECT row_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY row_id),
best AS (SELECT row_id, max(share) AS score FROM spans GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN own USING (row_id) LEFT JOIN named USING (row_id) LEFT JOIN best USING (row_id)
"""

SECRETS = r"""
WITH rules(place, kind, pattern, grp, least) AS (VALUES
  (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 18),
  (2, 'hex', '[0-9a-f]+', 0, 16),
  (3, 'pem', '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----', 0, 1),
  (4, 'github', 'gh[opsur]_[A-Za-z0-9]{36,}', 0, 1),
  (5, 'slack', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 1),
  (6, 'google', 'AIza[A-Za-z0-9_-]{35}', 0, 1),
  (7, 'jwt', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', 0, 1)),
texts AS (SELECT row_number() OVER () AS row_id, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
cut AS (
""" + "\nUNION ALL\n".join(
    f"""  SELECT row_id, place, string_split(regexp_replace(t, pattern, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts
  FROM texts, (SELECT place, pattern FROM rules WHERE place = {n})""" for n in range(8)) + r"""),
parts AS (
  SELECT row_id, place, part, n, sum(length(part)) OVER (PARTITION BY row_id, place ORDER BY n ROWS UNBOUNDED PRECEDING) AS stop
  FROM (SELECT row_id, place, unnest(parts) AS part, generate_subscripts(parts, 1) AS n FROM cut WHERE len(parts) > 1)),
found AS (
  SELECT row_id, p.place, kind, stop - length(part) AS start, stop
  FROM parts p JOIN rules USING (place)
  WHERE n % 2 = 0 AND CASE WHEN p.place = 0
      THEN length(regexp_extract(part, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2))
      ELSE length(part) END >= least),
told AS (
  SELECT row_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
         coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3), '') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM found GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (row_id)
"""

LINES = """
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM texts),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT keyed.*, coalesce(owner <> doc_id, false) AS gone FROM keyed LEFT JOIN owners USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

LEAKS = rf"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
lengths AS (SELECT DISTINCT n FROM windows),
scanned AS (
  SELECT row_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, lengths WHERE len(w) >= n)),
hits AS (SELECT row_id, i, n, item_id FROM scanned JOIN windows USING (n, gram)),
places AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM (SELECT row_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row_id),
named AS (
  SELECT row_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN places USING (row_id) LEFT JOIN named USING (row_id)
"""

def _vector_codes(rounds: int = 6) -> str:
    """Lloyd's rounds written out: assignments a0 .. a6 by the codebooks c0 .. c6."""
    ctes = [r"""
kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS MATERIALIZED (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS k, floor(4096 * x::DOUBLE)::BIGINT AS x
  FROM (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i, len(v) // 8 AS w FROM kept)),
seeds AS (
  SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e
  FROM (SELECT vec_id, arg_min(r, v) AS r FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT 16)),
c0 AS MATERIALIZED (SELECT p, e, k, x AS c FROM dims JOIN seeds USING (r))"""]
    for n in range(rounds + 1):
        ctes.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := d, e := e)) AS m
  FROM (SELECT r, p, e, sum((x - c) * (x - c))::BIGINT AS d FROM dims JOIN c{n} USING (p, k) GROUP BY r, p, e) GROUP BY r, p)""")
        if n < rounds:
            ctes.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT p, e, k, coalesce((s - (s % n + n) % n) // n, c)::BIGINT AS c
  FROM c{n} LEFT JOIN (SELECT p, m.e AS e, k, sum(x)::BIGINT AS s, count(*) AS n FROM dims JOIN a{n} USING (r, p) GROUP BY ALL) USING (p, e, k))""")
    return "WITH" + ",".join(ctes) + f"""
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, k)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY r) USING (r)
"""


ARCHIVES = """
WITH told AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS top FROM told),
marked AS (SELECT *, top IS NOT NULL AND page_id IS DISTINCT FROM top AS again FROM newest)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda b:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT >> b) & 31) + 1)::INT, 1)),
         'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to
FROM marked
"""


def _conversations() -> str:
    """The best of each state by cost and audit, row after row; then the audit is followed once more to write the repaired rows."""
    def edit(state: str, cost: str, letter: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"
    free = "more + CASE WHEN forced OR role1 <> '{}' THEN 1000000 ELSE 0 END"
    anew = "more + 1 + CASE WHEN forced THEN 1000000 ELSE 0 END"
    user = ", ".join([edit("s2", "2", "D"), *[edit(s, free.format("u"), "K") for s in ("s0", "s1", "s3")],
                      *[edit(s, anew, "R") for s in ("s0", "s1", "s3")]])
    return f"""
WITH RECURSIVE said AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS letters FROM conversations),
checked AS (
  SELECT *, xor(list_reduce(list_transform(letters, lambda c: unicode(c)::BIGINT), lambda crc, b:
    list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
    4294967295::BIGINT), 4294967295) % 20 AS n FROM said),
damaged AS (
  SELECT g, turn, CASE WHEN n = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN n = 1 THEN '' WHEN n = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT * FROM checked UNION ALL SELECT * FROM checked WHERE n = 3) WHERE n > 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i,
                  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS role1, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS before FROM placed),
steps AS MATERIALIZED (
  SELECT g, i, role1, fault IN ('blank', 'duplicate') AS forced, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM judged),
walk AS (
  SELECT DISTINCT g, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, {{'c': 1000000::BIGINT, 'a': ''}} AS s1,
         {{'c': 5::BIGINT, 'a': 'I'}} AS s2, {{'c': 10::BIGINT, 'a': 'II'}} AS s3 FROM said
  UNION ALL
  SELECT g, i, d0, d1, u, least(d3, {edit("u", "5", "I")})
  FROM (SELECT *, least(d2, {edit("d0", "5", "I")}, {edit("d1", "5", "I")}, {edit("d3", "5", "I")}) AS u
        FROM (SELECT steps.g, steps.i, {edit("s0", "2", "D")} AS d0, least({edit("s1", "2", "D")}, {edit("s0", free.format("s"), "K")}) AS d1,
                     least({user}) AS d2,
                     least({edit("s3", "2", "D")}, {edit("s2", free.format("a"), "K")}, {edit("s2", anew, "R")}) AS d3
              FROM walk JOIN steps ON steps.g = walk.g AND steps.i = walk.i + 1))),
best AS (SELECT g, least(s0, s3).c AS cost, least(s0, s3).a AS audit FROM walk QUALIFY row_number() OVER (PARTITION BY g ORDER BY i DESC) = 1),
letters AS (
  SELECT g, unnest(string_split(audit, '')) AS letter, unnest(range(1, len(audit) + 1)) AS j FROM best WHERE audit <> ''),
counted AS (
  SELECT *, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS e FROM letters WINDOW w AS (PARTITION BY g ORDER BY j)),
met AS (
  SELECT c.g, letter, e, role, text, max((letter = 'K' AND role1 = 's')::INT) OVER (PARTITION BY c.g) AS sys
  FROM counted c LEFT JOIN judged r ON r.g = c.g AND r.i = c.i AND letter <> 'I'),
written AS (
  SELECT g, string_agg(CASE WHEN letter = 'K' THEN role WHEN (e - coalesce(sys, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                       || ':' || coalesce(text, ''), chr(10) ORDER BY e) AS lines FROM met WHERE letter <> 'D' GROUP BY g),
told AS (
  SELECT g, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || role1 NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY g)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
       sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM said) LEFT JOIN told USING (g) LEFT JOIN best USING (g) LEFT JOIN written USING (g)
"""


SQL = {
    "op2_licence_diagonals": LICENCES,
    "op3_secret_ledger": SECRETS,
    "op7_line_bitmaps": LINES,
    "op10_decontamination": LEAKS,
    "op11_vector_codes": _vector_codes(),
    "op12_zip_warc": ARCHIVES,
    "op13_conversation_repair": _conversations(),
}
