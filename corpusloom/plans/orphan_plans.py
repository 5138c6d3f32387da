"""Queries of the orphan-reference operator."""

from __future__ import annotations

from ..operators.orphans import corpus_orphans, orphan_report
from ..session import table


def _orphans(spark, sf_dir):
    return corpus_orphans(*(table(spark, sf_dir, t) for t in ("fragments", "nas_confirmed", "fragment_content", "annotations")))


QUERIES = {
    "p5_found": lambda s, d: _orphans(s, d).drop("t"),
    "p5_report": lambda s, d: orphan_report(_orphans(s, d)),
}

CANON = r"nullif(regexp_replace(regexp_replace(lower(regexp_replace({0},'^\s+|\s+$','','g')),'^\[?\s*nas\s*:\s*|\s*\]$','','g'),'/+$',''),'')"
_FOUND = rf"""
WITH refs AS (
  SELECT 'fragments' AS table_name, fragment_id AS record_id, 'nas' AS field_name, nas AS r, recorded_at AS t FROM fragments
  UNION ALL SELECT 'fragments', fragment_id, 'parent_nas', parent_nas, recorded_at FROM fragments
  UNION ALL SELECT 'fragment_content', content_id, 'grounding_citations', unnest(grounding_citations), recorded_at FROM fragment_content
  UNION ALL SELECT 'annotations', annotation_id, 'evidence_citations', unnest(evidence_citations), recorded_at FROM annotations),
k AS (SELECT DISTINCT table_name, record_id, field_name, {CANON.format("r")} AS ref_nas, t FROM refs),
par AS (
  SELECT 'fragments' AS side, {CANON.format("nas")} AS nas, confirmed_at AS s, CAST(NULL AS TIMESTAMP) AS e FROM nas_confirmed
  UNION ALL SELECT 'other', {CANON.format("nas")}, recorded_at, deleted_at FROM fragments),
j AS (
  SELECT k.table_name, record_id, field_name, ref_nas, t, count(par.nas) AS n,
    count(*) FILTER (WHERE par.nas IS NOT NULL AND (s IS NULL OR s <= t)) AS began,
    count(*) FILTER (WHERE par.nas IS NOT NULL AND (s IS NULL OR s <= t) AND (e IS NULL OR e > t)) AS alive
  FROM k LEFT JOIN par ON par.nas = ref_nas AND side = CASE WHEN k.table_name = 'fragments' THEN 'fragments' ELSE 'other' END
  WHERE ref_nas IS NOT NULL GROUP BY ALL),
found AS (
  SELECT table_name, record_id, field_name, ref_nas, t,
    CASE WHEN n = 0 THEN 'missing' WHEN t IS NULL OR alive > 0 THEN '' WHEN began > 0 THEN 'deleted' ELSE 'late' END AS reason FROM j)
"""
ORACLES = {
    "p5_found": _FOUND + "SELECT DISTINCT table_name, record_id, field_name, ref_nas, reason FROM found WHERE reason <> ''",
    "p5_report": _FOUND
    + "SELECT table_name, field_name, strftime(t, '%Y-%m') AS month, reason, CAST(count(*) AS BIGINT) AS n_refs FROM (SELECT DISTINCT * FROM found) WHERE reason <> '' GROUP BY ALL",
}
