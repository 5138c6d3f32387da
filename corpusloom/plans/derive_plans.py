"""Queries of the derived artifacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive as D
from . import views as V

_join = lambda c: F.array_join(c, "|", "~").alias(c)


def _sets(s, d):
    return D.code_sets(V.addresses(s, d), V.annotations(s, d))


def _sequence(s, d, track, gap):
    ann = D.confirmed(V.annotations(s, d), track)
    if track == "bakhtin":
        ann = ann.join(F.broadcast(D.profile_table(s)), "code", "left_anti")
    q = D.sequences(V.addresses(s, d), D.best_annotations(ann, ["nas"]), gap)
    return q.select("tradition_id", "island", "division", _join("episodes"), _join("sequence"), _join("gaps"), "n", "n_annotated")


def _severest(s, d):
    return D.severest_note(V.fragments(s, d), ["tradition_id"], "confidence_tier", "fragment_id")


QUERIES = {
    "a1_code_sets": lambda s, d: _sets(s, d).select("nas", _join("codes")),
    "a2_code_frequency": lambda s, d: D.code_frequency(_sets(s, d)),
    "a2_frequency_totals": lambda s, d: D.frequency_totals(_sets(s, d)),
    "o1_frequency_ranked": lambda s, d: D.code_frequency(_sets(s, d)).orderBy(F.desc("n"), "code"),
    "a3_stop_codes": lambda s, d: D.stop_codes(_sets(s, d), 0.005),
    "a4_best_annotation": lambda s, d: D.best_annotations(D.confirmed(V.annotations(s, d)), ["nas", "track"]),
    "a5_propp_sequences": lambda s, d: _sequence(s, d, "propp", ""),
    "a6_chronotope_sequences": lambda s, d: _sequence(s, d, "bakhtin", None),
    "a7_division_islands": lambda s, d: D.islands(V.addresses(s, d), "tradition_id", "ordinal", "division").groupBy("tradition_id", "island", "division").agg(F.count("*").alias("n"), F.min("ordinal").alias("first_ordinal")),
    "a8_bakhtin_profiles": lambda s, d: D.profiles(V.addresses(s, d), V.annotations(s, d)).select("nas", "chronotope_type", "polyphony", "carnivalesque", "heteroglossia", _join("raw_codes"), "source_annotation_count"),
    "a9_severest_note": _severest,
    "a22_annotation_counts": lambda s, d: V.annotations(s, d).filter("status = 'candidate'").groupBy("track").agg(F.count("*").alias("n")),
    "s12_traditions": lambda s, d: V.addresses(s, d).select("tradition_id").distinct(),
    "s7_addresses_in_order": lambda s, d: V.addresses(s, d).select("tradition_id", "ordinal", F.get(F.split("nas", "/"), F.lit(3)).alias("division"), "nas"),
    "s8_confirmed_annotations": lambda s, d: D.confirmed(V.annotations(s, d), "tmi").select("annotation_id", "nas", "position", "code"),
}

V_ = V.VIEWS
_CODES = "sets AS (SELECT a.nas, coalesce(list_sort(list_distinct(list(x.code) FILTER (WHERE x.code IS NOT NULL))), []) AS codes FROM (SELECT DISTINCT nas FROM addr) a LEFT JOIN (SELECT nas, code FROM ann WHERE status='confirmed' AND track='tmi') x USING (nas) GROUP BY a.nas), freq AS (SELECT code, count(DISTINCT nas) AS n FROM (SELECT nas, unnest(codes) AS code FROM sets) GROUP BY 1)"
_RANKED = "ranked AS (SELECT a.*, row_number() OVER (PARTITION BY nas, track ORDER BY coalesce(r, 3), position, annotation_id) AS rn FROM ann a LEFT JOIN rank_of ON tier = coalesce(proposed_tier,'inspired') WHERE status='confirmed' {0})"
_ISLES = "step AS (SELECT *, CASE WHEN lag(division) OVER w IS NOT DISTINCT FROM division AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS nw FROM addr WINDOW w AS (PARTITION BY tradition_id ORDER BY ordinal)), isle AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY tradition_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM step)"
_DIMS = "('BAKHTIN-POLYPHONY-LOW','BAKHTIN-POLYPHONY-MEDIUM','BAKHTIN-POLYPHONY-HIGH','BAKHTIN-CARNIVALESQUE-ABSENT','BAKHTIN-CARNIVALESQUE-PRESENT','BAKHTIN-CARNIVALESQUE-DOMINANT','BAKHTIN-HETEROGLOSSIA-MONOGLOSSIC','BAKHTIN-HETEROGLOSSIA-HETEROGLOSSIC','BAKHTIN-HETEROGLOSSIA-PLURIVALENT')"


def _seq_sql(cond: str, gap: str) -> str:
    return f"""{V_}, {_RANKED.format(cond)}, {_ISLES}
SELECT tradition_id, island, division, string_agg(i.nas, '|' ORDER BY ordinal, i.nas) AS episodes, string_agg(coalesce(code,'{gap}'), '|' ORDER BY ordinal, i.nas) AS sequence,
  coalesce(string_agg(CASE WHEN code IS NULL THEN i.nas END, '|' ORDER BY ordinal, i.nas), '') AS gaps, count(*) AS n, count(code) AS n_annotated
FROM isle i LEFT JOIN (SELECT nas, code FROM ranked WHERE rn = 1) b ON b.nas = i.nas GROUP BY 1, 2, 3"""


ORACLES = {
    "a1_code_sets": f"{V_}, {_CODES} SELECT nas, array_to_string(codes,'|') AS codes FROM sets",
    "a2_code_frequency": f"{V_}, {_CODES} SELECT code, n FROM freq",
    "a2_frequency_totals": f"{V_}, {_CODES} SELECT count(*) AS total_fragments, count(*) FILTER (WHERE len(codes) > 0) AS total_annotated_fragments FROM sets",
    "o1_frequency_ranked": f"{V_}, {_CODES} SELECT code, n FROM freq ORDER BY n DESC, code",
    "a3_stop_codes": f"{V_}, {_CODES} SELECT code FROM freq WHERE n > 0.005 * (SELECT count(*) FROM sets)",
    "a4_best_annotation": f"{V_}, {_RANKED.format('')} SELECT nas, track, code FROM ranked WHERE rn = 1",
    "a5_propp_sequences": _seq_sql("AND track='propp'", ""),
    "a6_chronotope_sequences": _seq_sql(f"AND track='bakhtin' AND code NOT IN {_DIMS}", "~"),
    "a7_division_islands": f"{V_}, {_ISLES} SELECT tradition_id, island, division, count(*) AS n, min(ordinal) AS first_ordinal FROM isle GROUP BY 1,2,3",
    "a8_bakhtin_profiles": f"""{V_}, b AS (SELECT a.*, coalesce(r,3) AS r FROM ann a LEFT JOIN rank_of ON tier = coalesce(proposed_tier,'inspired') WHERE status='confirmed' AND track='bakhtin'),
g AS (SELECT nas, arg_min(code, (r, position, annotation_id)) FILTER (WHERE code NOT IN {_DIMS}) AS chronotope_type,
  min(code) FILTER (WHERE code LIKE 'BAKHTIN-POLYPHONY-%' AND code IN {_DIMS}) AS p, min(code) FILTER (WHERE code LIKE 'BAKHTIN-CARNIVALESQUE-%' AND code IN {_DIMS}) AS c,
  min(code) FILTER (WHERE code LIKE 'BAKHTIN-HETEROGLOSSIA-%' AND code IN {_DIMS}) AS h, array_to_string(list_sort(list_distinct(list(code))),'|') AS raw_codes, count(*) AS k FROM b GROUP BY 1)
SELECT a.nas, chronotope_type, CASE right(p,3) WHEN 'LOW' THEN 0.2::DOUBLE WHEN 'IUM' THEN 0.5::DOUBLE WHEN 'IGH' THEN 0.9::DOUBLE END AS polyphony,
  CASE right(c,3) WHEN 'ENT' THEN CASE WHEN c LIKE '%ABSENT' THEN 0.0::DOUBLE ELSE 0.7::DOUBLE END WHEN 'ANT' THEN 0.95::DOUBLE END AS carnivalesque, lower(replace(h,'BAKHTIN-HETEROGLOSSIA-','')) AS heteroglossia,
  coalesce(raw_codes,'') AS raw_codes, coalesce(k,0) AS source_annotation_count FROM (SELECT DISTINCT nas FROM addr) a LEFT JOIN g USING (nas)""",
    "a9_severest_note": f"{V_} SELECT tradition_id, arg_max(methodology_fit_note, (coalesce(r,0), -fragment_id)) AS note FROM frag LEFT JOIN rank_of ON tier = confidence_tier WHERE methodology_fit_warning AND methodology_fit_note <> '' GROUP BY 1",
    "a22_annotation_counts": f"{V_} SELECT track, count(*) AS n FROM ann WHERE status='candidate' GROUP BY 1",
    "s12_traditions": f"{V_} SELECT DISTINCT tradition_id FROM addr",
    "s7_addresses_in_order": f"{V_} SELECT tradition_id, ordinal, split_part(nas,'/',4) AS division, nas FROM addr",
    "s8_confirmed_annotations": f"{V_} SELECT annotation_id, nas, position, code FROM ann WHERE status='confirmed' AND track='tmi'",
}
