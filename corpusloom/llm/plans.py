"""Queries pN_... of the training-data operators over their whole tables."""

from __future__ import annotations

from ..session import table
from . import align, mojibake, ocr, packing, sentences, set_join, term_counts, tokenize, truncation


def _truncation(s, d):
    return truncation.score_truncation(table(s, d, "fragment_content"), table(s, d, "ingestion_reports"))


QUERIES = {
    "p1_found": lambda s, d: _truncation(s, d).filter("cut").select("content_id"),
    "p1_report": lambda s, d: truncation.truncation_report(_truncation(s, d)),
    "p2_counts": lambda s, d: term_counts.motif_counts(table(s, d, "fragment_features")),
    "p2_found": lambda s, d: term_counts.motif_counts(table(s, d, "fragment_features")).filter("mark is not null").select("tmi_code", "mark"),
    "p3_found": lambda s, d: align.align(table(s, d, "fragment_content")).filter("kind <> 'omission'").drop("kind"),
    "p3_links": lambda s, d: align.align(table(s, d, "fragment_content")),
    "p4_found": lambda s, d: ocr.defects(ocr.clean_pages(table(s, d, "fragment_content"), table(s, d, "ingestion_reports"))),
    "p4_repair": lambda s, d: ocr.repaired(ocr.clean_pages(table(s, d, "fragment_content"), table(s, d, "ingestion_reports"))),
    "p6_found": lambda s, d: sentences.segment(table(s, d, "fragment_content"), ["scholaria"]).select("content_id", "char_start", "char_end"),
    "p6_sentences": lambda s, d: sentences.segment(table(s, d, "fragment_content")),
    "p7_classes": lambda s, d: set_join.set_classes(table(s, d, "fragment_features")),
    "p7_found": lambda s, d: set_join.similar_records(table(s, d, "fragment_features")),
    "p10_found": lambda s, d: mojibake.repair_documents(table(s, d, "documents")).select("doc_id"),
    "p10_repair": lambda s, d: mojibake.repair_documents(table(s, d, "documents")),
    "p8_ids": lambda s, d: tokenize.encode(table(s, d, "documents")),
    "p8_decoded": lambda s, d: tokenize.decode(tokenize.encode(table(s, d, "documents"))),
    "p9_pack": lambda s, d: packing.pack_documents(table(s, d, "documents"), table(s, d, "container_sizes")),
    "p9_report": lambda s, d: packing.fill_report(packing.pack_documents(table(s, d, "documents"), table(s, d, "container_sizes")), table(s, d, "container_sizes")),
}

_CODE = r"upper(regexp_replace(x,'\s+','','g'))"
_TMI = rf"CASE WHEN regexp_matches({_CODE}, '^[A-Z]\d') THEN 'TMI-' || {_CODE} WHEN {_CODE} = '' THEN NULL ELSE regexp_replace({_CODE}, '^TMI-?', 'TMI-') END"
_PROPP = rf"CASE WHEN {_CODE} = '' THEN NULL ELSE regexp_replace({_CODE}, '^(PROPP-?)?', 'PROPP-') END"
_COUNTS = rf"""
WITH one AS (SELECT feature_id, min(tmi_codes) AS a FROM fragment_features GROUP BY 1),
t AS (SELECT feature_id, {_TMI} AS tmi_code FROM (SELECT feature_id, unnest(a) AS x FROM one)),
c AS (SELECT tmi_code, CAST(count(*) AS BIGINT) AS n_occurrences, CAST(count(DISTINCT feature_id) AS BIGINT) AS n_records FROM t WHERE tmi_code IS NOT NULL GROUP BY 1)
SELECT tmi_code, n_occurrences, n_records,
  CASE WHEN n_records < 3 THEN 'rare' WHEN n_records > 0.1 * (SELECT count(*) FROM one) THEN 'common' END AS mark FROM c
"""
_PAIRS = rf"""
WITH t AS (
  SELECT feature_id AS id, {_TMI} AS code FROM (SELECT feature_id, unnest(tmi_codes) AS x FROM fragment_features)
  UNION SELECT feature_id, {_PROPP} FROM (SELECT feature_id, unnest(propp_codes) AS x FROM fragment_features)),
s AS (SELECT * FROM t WHERE code IS NOT NULL),
n AS (SELECT id, count(*) AS n FROM s GROUP BY 1),
b AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM s x JOIN s y ON x.code = y.code AND x.id < y.id GROUP BY ALL)
SELECT a AS feature_id_a, b AS feature_id_b FROM b JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE k >= 0.6 * (p.n + q.n - k)
"""
ORACLES = {
    "p7_classes": f"""WITH pr AS ({_PAIRS}), cs AS (SELECT id, list(code ORDER BY code) AS k FROM (
  SELECT feature_id AS id, {_TMI} AS code FROM (SELECT feature_id, unnest(tmi_codes) AS x FROM fragment_features) UNION SELECT feature_id, {_PROPP} FROM (SELECT feature_id, unnest(propp_codes) AS x FROM fragment_features)) WHERE code IS NOT NULL GROUP BY 1),
rp AS (SELECT id, k, min(id) OVER (PARTITION BY k) AS rep FROM cs), ln AS (SELECT feature_id_a AS a, feature_id_b AS b FROM pr UNION ALL SELECT feature_id_b, feature_id_a FROM pr)
SELECT id AS feature_id, rep AS class_id, (SELECT count(DISTINCT y.rep) FROM ln JOIN rp y ON y.id = ln.b WHERE ln.a = rp.id AND y.rep <> rp.rep) AS n_links FROM rp""",
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p2_counts": _COUNTS,
    "p2_found": f"SELECT tmi_code, mark FROM ({_COUNTS}) WHERE mark IS NOT NULL",
    "p7_found": _PAIRS,
}
