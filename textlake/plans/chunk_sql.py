"""Chunks and word weights as DuckDB SQL."""

from __future__ import annotations

from textlake.functions.fixed_values import CHUNK_SEPARATORS
from textlake.plans.views import strip_sql

_SEPARATORS = [f"'{s}'" if "\n" not in s else "||".join(["chr(10)"] * len(s)) for s in CHUNK_SEPARATORS]
_LAST = len(CHUNK_SEPARATORS) - 1


def _level(text: str, least: str) -> str:
    """The first separator from a level on that a text has; the last, which is empty, always."""
    found = " ".join(
        f"WHEN {least} <= {i} AND contains({text}, {s}) THEN {i}" for i, s in enumerate(_SEPARATORS[:-1])
    )
    return f"CASE {found} ELSE {_LAST} END"


def _spans(text: str, level: str) -> str:
    """A text cut before each separator; one that opens the text opens its first span."""
    cases = []
    for i, s in enumerate(_SEPARATORS[:-1]):
        parts = f"string_split({text}, {s})"
        cases.append(
            f"WHEN {i} THEN list_concat(CASE WHEN {parts}[1] = '' THEN [] ELSE [{parts}[1]] END, "
            f"list_transform({parts}[2:], lambda p: {s} || p))"
        )
    return f"CASE {level} {' '.join(cases)} ELSE string_split({text}, '') END"


def chunks_sql(size: int, overlap: int, source: str = "documents") -> str:
    """A CTE ``chunks`` of ``doc_id, chunk_no, text``: spans from paragraphs down to letters, then windows over each run.

    A run is a row of neighbouring spans of one parent without a longer span between them. A chunk takes spans
    while they fit; the next one starts at the first span from which no more than ``overlap`` is left, and the span
    to come fits.
    """
    parts = [
        f"""part0 AS (
  SELECT doc_id, [CAST(0 AS BIGINT)] AS path, text AS t, {_level("text", "0")} AS level FROM {source} WHERE text <> '')"""
    ]
    for i in range(_LAST + 1):
        parts.append(f"""spans{i} AS (
  SELECT doc_id, path, level, t, pos, length(t) >= {size} AND level < {_LAST} AS long FROM (
    SELECT doc_id, path, level, unnest(spans) AS t, unnest(range(1, len(spans) + 1)) AS pos
    FROM (SELECT *, {_spans("t", "level")} AS spans FROM part{i}))),
runs{i} AS (
  SELECT doc_id, path, pos, t, sum(CAST(long AS INTEGER)) OVER (PARTITION BY doc_id, path ORDER BY pos) AS run, long
  FROM spans{i}),
part{i + 1} AS (
  SELECT doc_id, list_append(path, pos) AS path, t, {_level("t", "level + 1")} AS level FROM spans{i} WHERE long)""")
    leaves = " UNION ALL ".join(
        f"SELECT doc_id, path, run, pos, t FROM runs{i} WHERE NOT long" for i in range(_LAST + 1)
    )
    return f"""{", ".join(parts)},
gathered AS MATERIALIZED (
  SELECT doc_id, list_append(path, min(pos)) AS place, list(t ORDER BY pos) AS spans,
    list_prepend(0, list(total ORDER BY pos)) AS ends
  FROM (SELECT *, CAST(sum(length(t)) OVER (PARTITION BY doc_id, path, run ORDER BY pos) AS BIGINT) AS total FROM ({leaves}))
  GROUP BY doc_id, path, run),
windows(doc_id, place, n, lo, hi) AS (
  SELECT doc_id, place, 0, 1, len(list_filter(ends, lambda e: e <= {size})) - 1 FROM gathered
  UNION ALL
  SELECT doc_id, place, n + 1, new_lo,
    greatest(hi + 1, len(list_filter(ends, lambda e: e <= ends[new_lo] + {size})) - 1)
  FROM (
    SELECT w.*, g.ends, list_min(list_filter(range(lo, hi + 2), lambda j:
      j = hi + 1 OR (ends[hi + 1] - ends[j] <= {overlap} AND ends[hi + 2] - ends[j] <= {size}))) AS new_lo
    FROM windows w JOIN gathered g USING (doc_id, place) WHERE hi + 1 < len(ends))),
cut AS (
  SELECT doc_id, place, n, {strip_sql("array_to_string(spans[lo:hi], '')")} AS text
  FROM windows JOIN gathered USING (doc_id, place)),
chunks AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place, n) - 1 AS INTEGER) AS chunk_no, text
  FROM cut WHERE text <> '')"""


def _rotated(x: str, by: int) -> str:
    return f"((({x} << {by}) | ({x} >> {32 - by})) & 4294967295)"


def _times(x: str, by: int) -> str:
    return f"CAST(CAST({x} AS HUGEINT) * {by} % 4294967296 AS BIGINT)"


def murmur3_sql(word: str) -> str:
    """The 32-bit MurmurHash3 of a text's UTF-8 bytes with seed 42, without sign."""
    size = f"octet_length(encode({word}))"
    byte = lambda at: f"CAST('0x' || substr(hex(encode({word})), 2 * ({at}) + 1, 2) AS BIGINT)"
    scramble = lambda k: _times(_rotated(f"({_times(k, 0xCC9E2D51)})", 15), 0x1B873593)
    block = " + ".join(f"{byte(f'4 * i + {j}')} * {1 << 8 * j}" for j in range(4))
    blocks = f"list_transform(range(0, {size} // 4), lambda i: {scramble(f'({block})')})"
    step = f"({_rotated('xor(h, k)', 13)} * 5 + 3864292196) % 4294967296"
    body = f"list_reduce(list_prepend(CAST(42 AS BIGINT), {blocks}), lambda h, k: {step})"
    tail = " + ".join(
        f"CASE WHEN {size} % 4 > {j} THEN {byte(f'{size} // 4 * 4 + {j}')} * {1 << 8 * j} ELSE 0 END" for j in range(3)
    )
    mixed = f"xor(xor({body}, {scramble(f'({tail})')}), {size})"
    # A list carries each step, so that no step is written out more than once.
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        mixed = f"list_transform([{mixed}], lambda x: {_times(f'xor(x, x >> {shift})', by)})[1]"
    return mixed


def tfidf_sql(dims: int, checksum: str) -> str:
    """Counts of hashed words weighted by ``ln((n + 1) / (df + 1))``, of length one, as a checksum."""
    return f"""WITH words AS (
  SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s+')) AS word FROM documents),
hashed AS (SELECT word, {murmur3_sql("word")} AS h FROM (SELECT DISTINCT word FROM words)),
places AS (
  SELECT word, CAST(((CASE WHEN h < 2147483648 THEN h ELSE h - 4294967296 END) % {dims} + {dims}) % {dims} AS INTEGER) AS place
  FROM hashed),
counts AS (SELECT doc_id, place, count(*) AS n FROM words JOIN places USING (word) GROUP BY ALL),
weights AS (
  SELECT place, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf FROM counts GROUP BY place),
weighted AS (SELECT doc_id, place, n * idf AS x FROM counts JOIN weights USING (place)),
lengths AS (SELECT doc_id, sqrt(sum(x * x ORDER BY place)) AS length FROM weighted GROUP BY doc_id)
SELECT doc_id, {dims} AS dims, {checksum} AS checksum
FROM (SELECT doc_id, place, CASE WHEN length > 0 THEN x / length ELSE x END AS x FROM weighted JOIN lengths USING (doc_id))
GROUP BY doc_id"""
