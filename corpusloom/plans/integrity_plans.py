"""Queries of the integrity rules, gates and status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model.enums import HEDGES
from ..operators import integrity as I
from ..session import table
from . import similarity_plans as SP
from . import views as V


def _raw_fragments(s, d):
    return table(s, d, "fragments").select("fragment_id", "nas", "methodology_fit_warning", "methodology_fit_note").distinct()


def _raw_citations(s, d):
    return table(s, d, "fragment_content").select("content_id", "nas", "grounding_citations")


def _all(s, d):
    return I.validate(V.addresses(s, d), V.fragments(s, d), _raw_fragments(s, d), V.content(s, d), _raw_citations(s, d), V.annotations(s, d), V.features(s, d))


def _decisions(s, d):
    """Review decisions as annotations carry them: one a reviewed annotation."""
    a = V.annotations(s, d)
    return a.filter("status <> 'candidate'").select(
        F.concat(F.lit("a-"), "annotation_id").alias("audit_id"), "nas", F.when(F.col("status") == "deferred", "postponed").otherwise(F.col("status")).alias("action"),
        F.when(F.col("track") == "propp", "summary").otherwise("annotation").alias("record_type"), F.lit(None).cast("string").alias("layer"), F.col("proposed_tier").alias("confidence_tier_assigned"),
    )


def _status(s, d):
    c = V.content(s, d).groupBy(F.col("layer").alias("part")).agg(*(F.count_if(F.col("status") == x).alias(f"n_{x}") for x in ("candidate", "confirmed", "rejected", "deferred")))
    a = V.annotations(s, d).groupBy(F.col("track").alias("part")).agg(*(F.count_if(F.col("status") == x).alias(f"n_{x}") for x in ("candidate", "confirmed", "rejected", "deferred")))
    return c.unionByName(a)


def _coverage(s, d):
    ann = V.annotations(s, d).select("nas").distinct().withColumn("k", F.lit(1))
    return V.addresses(s, d).select("tradition_id", "nas").distinct().join(ann, "nas", "left").groupBy("tradition_id").agg(F.count("*").alias("n_total"), F.count("k").alias("n_annotated"))


QUERIES = {
    "c24_validate": _all,
    "v1_v9_v10_addresses": lambda s, d: I.union(I.address_rules(V.addresses(s, d), V.fragments(s, d))),
    "v2_v14_fragments": lambda s, d: I.union(I.fragment_rules(_raw_fragments(s, d), V.addresses(s, d))),
    "v3_v7_v18_content": lambda s, d: I.union(I.content_rules(V.content(s, d))),
    "v8_citations": lambda s, d: I.citation_rule(_raw_citations(s, d)),
    "v11_v13_annotations": lambda s, d: I.union(I.annotation_rules(V.annotations(s, d), V.addresses(s, d), V.fragments(s, d))),
    "v16_v20_decisions": lambda s, d: I.union(I.decision_rules(_decisions(s, d))),
    "v21_ranges": lambda s, d: I.range_rule(V.features(s, d).withColumn("polyphony", F.col("polyphony") * 1.25)),
    "v21_edges": lambda s, d: I.bounds_rule(SP._edges(s, d), F.concat_ws(" ", "member_a", "member_b"), F.col("member_a"), {"tmi_jaccard_leaf": (0, 1), "tmi_jaccard_branch": (0, 1), "propp_overlap": (0, 1), "qualifying_dimensions": (1, 3)}),
    "q11_constraints": lambda s, d: I.unique_rule(V.annotations(s, d), "annotation_id", ["nas", "track"], "status = 'confirmed'"),
    "v22_export_gate": lambda s, d: I.export_gate(_all(s, d), V.content(s, d), V.annotations(s, d)),
    "a23_status": _status,
    "a23_coverage": _coverage,
    "a24_candidates": lambda s, d: V.content(s, d).agg(F.count_if(F.col("status") == "candidate").alias("n")),
}

_VALID = "regexp_full_match({0}, 'nms://[a-z0-9-]+(/[a-z0-9-]+){{1,3}}')"
_H = "|".join(HEDGES)
_OUT = "SELECT '{0}' AS rule_id, '{1}' AS severity, {2}::VARCHAR AS record_id, nas, {3}::VARCHAR AS detail FROM {4}"


def _o(rule, key, detail, source, severity="error"):
    return _OUT.format(rule, severity, key, detail, source)


_rawf = "(SELECT DISTINCT fragment_id, nas, methodology_fit_warning, methodology_fit_note FROM fragments)"
_ok = f"(SELECT * FROM addr WHERE {_VALID.format('nas')})"
_known = f"(SELECT nas FROM addr WHERE {_VALID.format('nas')})"
_strip = r"regexp_replace(coalesce(body,''),'\s+','','g')"
_R = {
    "V1": _o("V1", "ordinal", "nas", f"addr WHERE NOT {_VALID.format('nas')}"),
    "V9": _o("V9", "ordinal", "nas", f"{_ok} WHERE nas NOT IN (SELECT nas FROM frag WHERE nas IS NOT NULL)"),
    "V10": _o("V10", "ordinal", "parent", f"(SELECT *, array_to_string(string_split(nas,'/')[1:5],'/') AS parent FROM {_ok} WHERE len(string_split(nas,'/'))=6) WHERE parent NOT IN {_known}"),
    "V2": _o("V2", "fragment_id", "'invalid'", f"{_rawf} WHERE NOT {_VALID.format('nas')}") + " UNION ALL " + _o("V2", "fragment_id", "'unconfirmed'", f"{_rawf} WHERE {_VALID.format('nas')} AND nas NOT IN {_known}"),
    "V14": _o("V14", "fragment_id", "methodology_fit_note", f"{_rawf} WHERE methodology_fit_note <> '' AND NOT coalesce(methodology_fit_warning,false)"),
    "V3": _o("V3", "content_id", "confidence_tier", "cont WHERE ai_generated AND confidence_tier='documented'"),
    "V4": _o("V4", "content_id", "coalesce(confidence_tier,'')", "cont WHERE ai_generated AND layer='surface' AND status='candidate' AND coalesce(confidence_tier,'')<>'inspired'"),
    "V5": _o("V5", "content_id", "confidence_tier", "cont WHERE ai_generated AND layer='surface' AND status='confirmed' AND confidence_tier='inspired'"),
    "V6": _o("V6", "content_id", "'truncated'", rf"cont WHERE layer='surface' AND status='confirmed' AND {_strip}<>'' AND NOT regexp_matches(regexp_replace(body,'\s+$',''), '[\].!?»""'']$')".replace('""', '"')),
    "V7": _o("V7", "content_id", "'unhedged'", rf"cont WHERE layer='surface' AND status='confirmed' AND contains(nas,'/lacuna') AND regexp_replace(regexp_replace(coalesce(body,''),'\[NAS:[^\]]*\]','','g'),'\s+','','g')<>'' AND NOT regexp_matches(lower(regexp_replace(body,'\[NAS:[^\]]*\]','','g')),'{_H}')", "warning"),
    "V18": _o("V18", "content_id", "reviewed_by", "cont WHERE ai_generated AND status='candidate' AND reviewed_by IS NOT NULL"),
    "V8": _o("V8", "content_id", "cite", f"(SELECT DISTINCT content_id, nas, unnest(grounding_citations) AS cite FROM fragment_content) WHERE NOT {_VALID.format('cite')}"),
    "V11": _o("V11", "annotation_id", "why", f"(SELECT *, CASE WHEN NOT {_VALID.format('nas')} THEN 'invalid' WHEN nas NOT IN {_known} THEN 'unconfirmed' WHEN nas NOT IN (SELECT nas FROM frag WHERE nas IS NOT NULL) THEN 'no fragment' END AS why FROM ann) WHERE why IS NOT NULL"),
    "V12": _o("V12", "annotation_id", "raw_code", r"ann WHERE track='tmi' AND coalesce(status<>'rejected',true) AND NOT regexp_full_match(coalesce(raw_code,''),'TMI-[A-Z]\d[\d.]*')"),
    "V13": _o("V13", "annotation_id", "proposed_tier", "ann WHERE status='confirmed' AND proposed_tier='inspired'"),
    "V21": _o("V21", "feature_id", "polyphony::VARCHAR||','||carnivalesque::VARCHAR", "feat WHERE polyphony NOT BETWEEN 0 AND 1 OR carnivalesque NOT BETWEEN 0 AND 1"),
}
_u = lambda *k: V.VIEWS + " " + " UNION ALL ".join(_R[x] for x in k)
_DEC = "dec AS (SELECT 'a-'||annotation_id AS audit_id, nas, CASE WHEN status='deferred' THEN 'postponed' ELSE status END AS action, CASE WHEN track='propp' THEN 'summary' ELSE 'annotation' END AS record_type, proposed_tier AS tier FROM ann WHERE status<>'candidate')"
_N = ", ".join(f"count(*) FILTER (WHERE status='{x}') AS n_{x}" for x in ("candidate", "confirmed", "rejected", "deferred"))
ORACLES = {
    "c24_validate": _u(*_R),
    "v1_v9_v10_addresses": _u("V1", "V9", "V10"),
    "v2_v14_fragments": _u("V2", "V14"),
    "v3_v7_v18_content": _u("V3", "V4", "V5", "V6", "V7", "V18"),
    "v8_citations": _u("V8"),
    "v11_v13_annotations": _u("V11", "V12", "V13"),
    "v16_v20_decisions": f"{V.VIEWS}, {_DEC} "
    + " UNION ALL ".join([
        _o("V16", "audit_id", "action", "dec WHERE action NOT IN ('confirmed','rejected','modified_confirmed','deferred')"),
        _o("V17", "audit_id", "tier", "dec WHERE action='confirmed' AND record_type='summary' AND tier<>'reconstructed'"),
        _o("V20", "audit_id", "coalesce(tier,'none')", "dec WHERE action='confirmed' AND (tier IS NULL OR (record_type='annotation' AND tier='inspired'))"),
    ]),
    "v21_ranges": V.VIEWS + " " + _o("V21", "feature_id", "polyphony::VARCHAR||','||carnivalesque::VARCHAR", "(SELECT * REPLACE (polyphony*1.25 AS polyphony) FROM feat) WHERE polyphony NOT BETWEEN 0 AND 1 OR carnivalesque NOT BETWEEN 0 AND 1").replace("polyphony::VARCHAR||','||carnivalesque::VARCHAR", "concat_ws(',', polyphony, carnivalesque)"),
    "v21_edges": f"{SP._E} SELECT 'V21' AS rule_id, 'error' AS severity, member_a||' '||member_b AS record_id, member_a AS nas, 'qualifying_dimensions' AS detail FROM e WHERE qualifying_dimensions > 3",
    "q11_constraints": f"{V.VIEWS} SELECT 'Q11' AS rule_id, 'error' AS severity, min(annotation_id)::VARCHAR AS record_id, nas, count(*)::VARCHAR AS detail FROM ann WHERE status='confirmed' GROUP BY nas, track HAVING count(*)>1",
    "v22_export_gate": f"{V.VIEWS}, v AS ({' UNION ALL '.join(_R.values())}), g AS (SELECT (SELECT count(*) FROM v WHERE severity='error') AS n_errors, (SELECT count(*) FROM cont WHERE status='candidate') AS n_content, (SELECT count(*) FROM ann WHERE status='candidate') AS n_annotations) SELECT *, n_errors=0 AND n_content+n_annotations=0 AS passes FROM g",
    "a23_status": f"{V.VIEWS} SELECT layer AS part, {_N} FROM cont GROUP BY 1 UNION ALL SELECT track, {_N} FROM ann GROUP BY 1",
    "a23_coverage": f"{V.VIEWS} SELECT tradition_id, count(*) AS n_total, count(k) AS n_annotated FROM (SELECT DISTINCT tradition_id, nas FROM addr) LEFT JOIN (SELECT DISTINCT nas, 1 AS k FROM ann) USING (nas) GROUP BY 1",
    "a24_candidates": f"{V.VIEWS} SELECT count(*) AS n FROM cont WHERE status='candidate'",
}
