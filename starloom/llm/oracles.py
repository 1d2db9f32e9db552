"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"
_LETTERS = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

# Smallest node reachable over ``link`` (a, b), both directions.
_REACH = """
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS node, a AS seen FROM edge UNION
          SELECT reach.node, edge.b FROM reach JOIN edge ON edge.a = reach.seen),
root AS (SELECT node, min(seen) AS root FROM reach GROUP BY node)"""

ORACLES = {
    "op1_superminhash": f"""
WITH RECURSIVE text_words AS (SELECT doc_id, {_SPACED} AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS s FROM text_words),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_have AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
              FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_have h JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * h.n >= 85 * (x.n + y.n - h.n)),{_REACH}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id,
       doc_id = coalesce(root, doc_id) AS kept
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN root ON node = doc_id""",
    "op4_pca_tiles": f"""
WITH RECURSIVE vector AS (
  SELECT vec_id, label, CAST(embedding AS double[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM vector x JOIN vector y
         ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
         WHERE list_cosine_similarity(x.v, y.v) >= 0.93),{_REACH},
links AS (SELECT a, count(*) AS n FROM edge GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id,
       vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN links ON a = vec_id LEFT JOIN root ON node = vec_id""",
    "op8_decontamination": f"""
WITH item AS (SELECT cast(item_id AS varchar) AS item_id, {_LETTERS} AS w FROM benchmark),
test_window AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
                               lambda i: w[i:i + least(len(w), 13) - 1])) AS win
  FROM item WHERE len(w) > 0),
doc AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
place AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
          FROM doc JOIN (SELECT DISTINCT n FROM test_window) ON n <= len(w)),
found AS (SELECT doc_id, i, p.n, item_id FROM place p
          JOIN test_window t ON t.n = p.n AND t.win = p.w[p.i:p.i + p.n - 1]),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM found))
        GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_conversation_trie": """
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
original AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM said GROUP BY conv_id),
-- CRC-32 of the decimal number, bit by bit
checked AS (SELECT conv_id, turns, xor(list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, step: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h FROM original),
rebuilt AS (SELECT c.conv_id, coalesce(b.turns, [])[1:c.h] || c.turns[c.h + 1:] AS turns
            FROM checked c LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefix AS (SELECT conv_id, turns[1:d] AS node, d, d = len(turns) AS ends
           FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
node AS (SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE
                  len(regexp_extract_all(any_value(node[d].text), '[^\x20\x09-\x0D]+')) END AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
         FROM prefix GROUP BY node, d),
child AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
known AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN child USING (node)),
below AS (SELECT above AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
          FROM (SELECT node[1:unnest(range(0, depth + 1))] AS above, n_children, saved FROM known) GROUP BY above)
SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below b ON b.node = k.node
LEFT JOIN node p ON k.depth > 0 AND p.node = k.node[1:k.depth - 1]""",
    "op12_source_mixing": f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
               FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT source, source_size, 3 * source_size AS most,
                   1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight FROM per_source),
-- sources by how soon they reach their cap; the first whose share fits sets everyone's
step AS (SELECT *, most::DOUBLE / weight AS ratio,
                (SELECT sum(source_size) FROM weighed)
                  - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                sum(weight) OVER (ORDER BY most::DOUBLE / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
         FROM weighed),
level AS (SELECT rest::DOUBLE AS rest, weights::DOUBLE AS weights FROM step
          WHERE rest::DOUBLE * weight / weights <= most ORDER BY ratio, source LIMIT 1),
targeted AS (SELECT source, source_size, least(most::DOUBLE, rest * weight / weights) AS target FROM weighed, level),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targeted),
tried AS (SELECT doc_id, size, r.source, source_size, target, seed,
                 floor(rate)::BIGINT + (('0x' || md5(seed || ':' || doc_id)[1:13])::BIGINT::DOUBLE / 4503599627370496
                                        < rate - floor(rate))::BIGINT AS copies
          FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source, range(16) AS k(seed)),
best AS (SELECT source, arg_min(seed, (miss, seed)) AS seed
         FROM (SELECT source, seed, abs(sum(size * copies) - any_value(target)) AS miss FROM tried GROUP BY source, seed)
         GROUP BY source)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken
FROM tried t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.seed = b.seed""",
    "op13_ranked_search": f"""
WITH doc AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
size AS (SELECT doc_id, len(w)::BIGINT AS n FROM doc WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM size),
posting AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM posting, total GROUP BY term, docs),
asked AS (SELECT DISTINCT item_id, unnest({_LETTERS}) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::BIGINT AS score
           FROM asked JOIN posting USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
}
