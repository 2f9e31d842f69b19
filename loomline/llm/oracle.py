"""SQL for the queries that SQL can express; the others are tested by brute force."""

from __future__ import annotations

from loomline.llm.near_dedup import PERCENT, SHINGLE
from loomline.llm.secrets import BASE_RULES, RULES, long_enough


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _matches(place: int) -> str:
    rule = RULES[place]
    pattern = _text(long_enough(rule))
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least,
         regexp_extract_all(text, {pattern}) AS found,
         regexp_extract_all(text, {pattern}, {rule.group}) AS judged,
         string_split_regex(text, {pattern}) AS gaps
  FROM texts"""


_BASE = ", ".join(_text(r.kind) for r in BASE_RULES)
_SPAN = "kind || ':' || start || ':' || stop"
_COUNTS = ",\n         ".join(
    f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES
)

SECRETS = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(_matches(k) for k in range(len(RULES)))}),
numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches),
sized AS (
  SELECT doc_id, kind, place, length(found[i]) AS size, length(judged[i]) >= least AS ok,
         sum(length(gaps[i]) + length(found[i])) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop
  FROM numbered),
spans AS (SELECT *, stop - size AS start FROM sized WHERE ok),
listed AS (
  SELECT doc_id, {_COUNTS},
         string_agg({_SPAN}, ',' ORDER BY start, place) FILTER (kind IN ({_BASE})) AS base,
         string_agg({_SPAN}, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT texts.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)"""

NEAR_COPIES = rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * m >= {PERCENT} * (x.n + y.n - m)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op5_secret_scan": SECRETS,
    "op9_near_dedup": NEAR_COPIES,
}
