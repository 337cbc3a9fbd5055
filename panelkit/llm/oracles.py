"""DuckDB SQL that gives the rows of the registered queries."""

from panelkit.llm import licenses as scans

def crc32(text: str) -> str:
    """SQL for the CRC-32 of a text in UTF-8, by the contribution of each bit of the byte shifted out."""

    def step(c: int) -> int:
        return (c >> 1) ^ (0xEDB88320 if c & 1 else 0)

    shifted = "c >> 8"
    for bit in range(8):
        part = 1 << bit
        for _ in range(8):
            part = step(part)
        shifted = f"xor({shifted}, {part} * ((xor(c, b) >> {bit}) & 1))"
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {shifted}), 4294967295)"


ARCHIVE = r"""
WITH known AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest FROM pages
), best AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest, size) AS top FROM known
)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id < top THEN top END AS refers_to
FROM best
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS digest
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sized GROUP BY source
), weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM per_source
), rated AS (
  SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT]::DOUBLE AS weight, 3 * source_size AS top FROM weighed
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER (ORDER BY top / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY top / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM rated
), wanted AS (
  SELECT source, source_size, n, place,
         CASE WHEN level <= top / weight THEN max(CASE WHEN level <= top / weight THEN level END) OVER () * weight
              ELSE top::DOUBLE END AS target,
         ceil(sum(source_size) OVER () / 16)::BIGINT AS blocks
  FROM levels
), quotients AS (
  SELECT place, blocks, row_number() OVER (ORDER BY target / (2 * i + 1) DESC, place) AS seat
  FROM (SELECT *, unnest(range(0, (target / 16)::BIGINT + 40)) AS i FROM wanted WHERE target > 0)
), quotas AS (
  SELECT place, count(*) AS quota FROM quotients WHERE seat <= blocks GROUP BY place
), placed AS (
  SELECT s.*, w.place, w.source_size, w.target, coalesce(q.quota, 0) AS quota,
         ('0x' || left(s.digest, 8))::BIGINT % ceil(w.n / 2048)::BIGINT AS shard
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source LEFT JOIN quotas q ON q.place = w.place
), shards AS (
  SELECT place, source, shard, quota, sum(size)::BIGINT AS total FROM placed GROUP BY ALL
), shard_quotients AS (
  SELECT place, shard, quota, row_number() OVER (PARTITION BY place ORDER BY total / (2 * i + 1) DESC, shard) AS seat
  FROM (SELECT *, unnest(range(0, (3 * total / 16)::BIGINT + 40)) AS i FROM shards WHERE total > 0)
), shard_quotas AS (
  SELECT place, shard, count(*) AS won FROM shard_quotients WHERE seat <= quota GROUP BY place, shard
), takes AS (
  SELECT s.place, s.shard, s.total, least(coalesce(q.won, 0) * 16, 3 * s.total)::BIGINT AS take,
         (('0x' || left(md5('7:' || coalesce(s.source, '') || ':' || s.shard), 8))::BIGINT
           % greatest(ceil(s.total / 16)::BIGINT, 1)) * 16 AS start
  FROM shards s LEFT JOIN shard_quotas q ON q.place = s.place AND q.shard = s.shard
), runs AS (
  SELECT *, CASE WHEN total > 0 THEN take // total ELSE 0 END AS passes,
         take - CASE WHEN total > 0 THEN take // total ELSE 0 END * total AS run
  FROM takes
), spread AS (
  SELECT p.*, sum(size) OVER (PARTITION BY p.place, p.shard ORDER BY digest, doc_id, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - size AS lead
  FROM placed p
)
SELECT doc_id, source, size, source_size, target,
       (passes * size + greatest(0, least(lead + size, start + run) - greatest(lead, start))
        + greatest(0, least(lead + size, start + run - total) - lead))::BIGINT AS taken
FROM spread s JOIN runs r ON r.place = s.place AND r.shard = s.shard
"""

ROLLUPS = r"""
WITH both_counts AS (
  SELECT source, lang, coalesce(lang = 'en', false) AS english,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS blanks,
         len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]')) AS runs
  FROM documents
)
SELECT source, lang, CASE WHEN english THEN 'blanks-1' ELSE 'runs-2' END AS tokenizer,
       count(*)::BIGINT AS n_docs, sum(CASE WHEN english THEN blanks ELSE runs END)::BIGINT AS n_tokens
FROM both_counts WHERE blanks >= 50 GROUP BY ALL
"""

NEAREST = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q, row_number() OVER () AS r
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.r <> b.r WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SHARDS = f"""
WITH sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32
  FROM documents
), placed AS (
  SELECT *, ((sum(size) OVER before - size) * 16 // sum(size) OVER ())::INT AS shard
  FROM sized WINDOW before AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
       NULL::INT AS grown_shard
FROM placed
"""

LEXICAL = r"""
WITH doc_terms AS (
  SELECT d, doc_id, unnest(list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM (SELECT *, row_number() OVER () AS d FROM documents)
), item_terms AS (
  SELECT DISTINCT i, item_id, unnest(list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)
), frequencies AS (
  SELECT d, doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY d)::BIGINT AS n FROM doc_terms GROUP BY d, doc_id, term
), corpus AS (
  SELECT count(DISTINCT d) AS docs, count(*) AS total FROM doc_terms
), weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT docs FROM corpus) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM frequencies GROUP BY term
), scored AS (
  SELECT i, item_id, d, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
  FROM item_terms JOIN frequencies USING (term) JOIN weights USING (term), corpus GROUP BY i, item_id, d, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

#: every state's moves by one row or insertion, written out: system, then user and assistant in turn
STRUCTURE = f"""
WITH RECURSIVE ids AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)
), drawn AS (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(v.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS draw
  FROM conversations v JOIN ids ON v.conv_id IS NOT DISTINCT FROM ids.conv_id
), damaged AS (
  SELECT c, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE draw <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha1(text)) AS n, left(role, 1) AS initial,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM damaged
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         n > 1 AND lag(initial) OVER (PARTITION BY c ORDER BY n) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed
), moves(state, role, following) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts(state, following, cost, edits) AS (
  VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
         (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')
), options AS (
  SELECT c, n, state, following, CASE WHEN initial = moves.role THEN 0 ELSE 2 END + (fault = 'truncated')::INT AS cost,
         CASE WHEN initial = moves.role THEN 'K' ELSE 'R' END AS edit
  FROM faults, moves WHERE fault NOT IN ('blank', 'duplicate') AND (initial = moves.role OR moves.role <> 's')
  UNION ALL
  SELECT c, n, state, state, 3, 'D' FROM faults, (VALUES (0), (1), (2), (3)) AS s(state)
), walked(c, n, state, best) AS (
  SELECT c, 0::BIGINT, 0, {{'cost': 0, 'audit': ''}} FROM ids
  UNION ALL
  SELECT w.c, w.n + 1, o.following, min({{'cost': w.best.cost + i.cost + o.cost, 'audit': w.best.audit || i.edits || o.edit}})
  FROM walked w JOIN inserts i ON i.state = w.state JOIN options o ON o.c = w.c AND o.n = w.n + 1 AND o.state = i.following
  GROUP BY w.c, w.n, o.following
), ended AS (
  SELECT w.c, min({{'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.edits}}) AS best
  FROM walked w JOIN (SELECT c, count(n) AS rows FROM ids LEFT JOIN faults USING (c) GROUP BY c) r ON r.c = w.c AND r.rows = w.n
  JOIN inserts i ON i.state = w.state AND i.following IN (0, 3) GROUP BY w.c
), edits AS (
  SELECT c, place, audit[place] AS edit, length(replace(left(audit, place), 'I', '')) AS n,
         length(replace(left(audit, place), 'D', '')) AS out
  FROM (SELECT c, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS place FROM ended)
), lines AS (
  SELECT e.c, out, CASE WHEN edit = 'K' THEN f.role WHEN (out - coalesce(led.system, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
  FROM edits e LEFT JOIN faults f ON f.c = e.c AND f.n = e.n
  LEFT JOIN (SELECT e.c, 1 AS system FROM edits e JOIN faults f ON f.c = e.c AND f.n = e.n
             WHERE out = 1 AND edit = 'K' AND initial = 's') led ON led.c = e.c
  WHERE edit <> 'D'
), texts AS (
  SELECT c, string_agg(line, chr(10) ORDER BY out) AS text FROM lines GROUP BY c
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (illegal) AS illegal
  FROM faults GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
       sha256(coalesce(t.text, '')) AS repaired_sha256
FROM ids JOIN ended USING (c) LEFT JOIN counts USING (c) LEFT JOIN texts t USING (c)
"""


def licenses() -> str:
    """Words and grams as rows, joined on their text; spans are merged and covered as in the scan."""
    listed = [(2, 1.0, 0, *x) for x in scans.PHRASES] + [(5, scans.COVERAGE, scans.DRIFT, *x) for x in scans.PASSAGES]
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {k}, {need}, {drift}, {quoted(t)}, {quoted(label)})" for i, (k, need, drift, t, label) in enumerate(listed))
    split = (
        r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    return f"""
WITH templates AS (
  SELECT *, {split} AS w FROM (VALUES {values}) AS t(template, k, needed, drift, text, label)
), template_grams AS (
  SELECT template, k, needed, drift, label, len(w) - k + 1 AS grams, i AS position, array_to_string(w[i + 1:i + k], ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS i FROM templates)
), texts AS (
  SELECT doc_id, coalesce(text, '') AS text, count(*) AS copies FROM documents GROUP BY ALL
), split_texts AS (
  SELECT doc_id, text, copies, {split} AS w FROM texts
), doc_grams AS (
  SELECT doc_id, text, 2 AS k, i AS place, w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, text, w, unnest(range(0, len(w) - 1)) AS i FROM split_texts)
  UNION ALL
  SELECT doc_id, text, 5, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] || ' ' || w[i + 5]
  FROM (SELECT doc_id, text, w, unnest(range(0, len(w) - 4)) AS i FROM split_texts)
), votes AS (
  SELECT doc_id, text, template, t.k AS k, needed, drift, label, grams, place - position AS diagonal, list(DISTINCT position) AS met
  FROM doc_grams d JOIN template_grams t ON d.gram = t.gram AND d.k = t.k GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN coalesce(diagonal - lag(diagonal) OVER along <= drift, false) THEN 0 ELSE 1 END AS fresh
  FROM votes WINDOW along AS (PARTITION BY doc_id, text, template ORDER BY diagonal)
), numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, text, template ORDER BY diagonal) AS span FROM marked
), spans AS (
  SELECT doc_id, text, k, needed, label, min(diagonal) AS start, len(list_distinct(flatten(list(met)))) / grams AS covered
  FROM numbered GROUP BY doc_id, text, template, k, needed, label, grams, span
), found AS (
  SELECT doc_id, text, count(*) FILTER (k = 2) AS n_base, min(start) FILTER (k = 2) AS first_word,
         max(start) FILTER (k = 2) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (k = 2) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(covered) AS score
  FROM spans WHERE covered >= needed GROUP BY doc_id, text
)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM (SELECT *, unnest(range(copies)) AS copy FROM split_texts) s
LEFT JOIN found f ON f.doc_id IS NOT DISTINCT FROM s.doc_id AND f.text = s.text
"""
