"""DuckDB SQL of the operators on pairs, vectors and conversations."""

from __future__ import annotations

from textlake.llm import centroid_clusters as cc


def clusters_sql(rounds: int = cc.ROUNDS) -> str:
    distance = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({cc.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {cc.DIMS}
    AND len(embedding) = {cc.DIMS}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{cc.SEED}:' || vec_id)) - 1 AS INTEGER) AS k, v AS c
  FROM kept QUALIFY k < {cc.CLUSTERS})"""
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min({{'d': CAST({distance} AS BIGINT), 'k': k}}) AS near
  FROM kept, c{i} GROUP BY vec_id)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(new_c, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS new_c FROM (
      SELECT near.k AS k, i, sum(v[i]) AS s, count(*) AS n
      FROM a{i}, range(1, {cc.DIMS} + 1) AS r(i) GROUP BY ALL)
    GROUP BY k) USING (k))""")
    last = f"a{rounds}"
    return f"""WITH {", ".join(parts)}
SELECT vec_id, near.k AS cluster, near.d AS distance,
  CAST(sum(near.d) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} ON near.k = c{rounds}.k"""


# CRC-32 by its polynomial, over the bytes of an ASCII text.
CRC_TABLE_SQL = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, bit: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i)
    AS crc FROM range(256) AS r(i))"""
BLANK_SET = r"\x20\x09-\x0D"


def crc32_sql(text: str) -> str:
    letters = f"list_transform(string_split({text}, ''), lambda letter: CAST(ord(letter) AS BIGINT))"
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {letters}),
      lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])))"""


def repair_sql() -> str:
    """The table of conversations damaged, and the dynamic program as a recursive query.

    States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row.
    """
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    role = "CASE given WHEN 2 THEN 'user' ELSE 'assistant' END"
    return f"""WITH RECURSIVE {CRC_TABLE_SQL},
hit AS (SELECT *, {crc32_sql(key)} % 20 AS fault FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
      ELSE coalesce(text, ' ') END AS text
  FROM hit, range(2) AS copies(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faulty AS MATERIALIZED (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^{BLANK_SET}]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][{BLANK_SET}]*\\z') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id),
inserts(s, n, p) AS (
  VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2),
    (3, 0, 3), (3, 1, 2), (3, 2, 3)),
legal(p, initial, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
moves AS (
  SELECT conv_id, i, s, s AS t, 2 AS cost, 'D' AS label, CAST([] AS VARCHAR[]) AS lines FROM faulty, (SELECT DISTINCT s FROM inserts)
  UNION ALL
  SELECT conv_id, i, s, t, cost, label, list_concat(added, [line]) FROM (
    SELECT f.conv_id, f.i, s, t, 5 * n + given_cost + 5 * CAST(f.fault = 'truncated' AS INTEGER) AS cost,
      repeat('I', n) || letter AS label, line,
      CASE n WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [CASE p WHEN 2 THEN 'user:' ELSE 'assistant:' END]
        ELSE [CASE p WHEN 3 THEN 'user:' ELSE 'assistant:' END, CASE p WHEN 3 THEN 'assistant:' ELSE 'user:' END]
      END AS added
    FROM (
      SELECT f.*, l.p, l.t, 0 AS given_cost, 'K' AS letter, role || ':' || text AS line
      FROM faulty f JOIN legal l ON f.initial = l.initial
      UNION ALL
      SELECT f.*, p, given AS t, 1, 'R', {role} || ':' || text
      FROM faulty f, (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) AS g(p, given)) f
    JOIN inserts USING (p) WHERE f.fault NOT IN ('blank', 'duplicate'))),
best(conv_id, i, s, found) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} FROM counts
  UNION ALL
  SELECT b.conv_id, b.i + 1, m.t, min({{'cost': b.found.cost + m.cost, 'audit': b.found.audit || m.label,
    'lines': list_concat(b.found.lines, CAST(m.lines AS VARCHAR[]))}})
  FROM best b JOIN moves m ON b.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = b.i + 1 AND m.s = b.s
  GROUP BY b.conv_id, b.i + 1, m.t),
ended AS (
  SELECT conv_id, min(CASE s WHEN 1 THEN {{'cost': found.cost + 10, 'audit': found.audit || 'II',
        'lines': list_concat(found.lines, ['user:', 'assistant:'])}}
      WHEN 2 THEN {{'cost': found.cost + 5, 'audit': found.audit || 'I',
        'lines': list_concat(found.lines, ['assistant:'])}} ELSE found END) AS found
  FROM best JOIN counts USING (conv_id) WHERE i = n GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(found.cost, 0) AS BIGINT) AS cost, coalesce(found.audit, '') AS audit,
  sha256(coalesce(array_to_string(found.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN ended USING (conv_id)"""


def near_copies_sql(size: int, percent: int, more: str = "") -> str:
    """All pairs of documents that share a shingle, those that are similar enough, and what they reach."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({low}, '[^{BLANK_SET}]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + {size - 1}), ' ')) AS s
  FROM texts, LATERAL (SELECT unnest(range(1, greatest(len(w) - {size - 2}, CAST(len(w) > 0 AS INTEGER) + 1))) AS i)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sets x JOIN sets y USING (s)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id{more}
FROM documents LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)"""
