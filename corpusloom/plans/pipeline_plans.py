"""Queries of the composed steps, with deterministic stand-ins for models, and of rules and lookups beside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus as C
from ..operators import integrity as I
from ..operators import pipeline as P
from ..operators import structure as S
from ..session import table
from . import similarity_plans as SP
from . import views as V

SIGNALS = ["ПРИМЕЧАНИЯ", "NOTES", "Двое", "ПЕСНЬ ПЕРВАЯ", "ПЕСНЬ ВТОРАЯ", "THE CATALOGUE OF SHIPS"]
BUDGET, OVERLAP, SLACK = 1000, 100, 500


def _texts(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("run_id"), "text").filter("text is not null and length(text) > 0")


def _segmenter(row: dict) -> list[dict]:
    """One segment a chunk, two neighbouring chunks of the same address; each fourth address is malformed."""
    k = row["chunk_index"] // 2
    nas = f"nms://t/d-{row['run_id']}/e-{k}" if k % 4 != 3 else f"nms://t/D {row['run_id']}"
    return [{"nas": nas, "passage_opening": row["chunk"][:40], "granularity": "lacuna" if k == 1 else "episode", "methodology_fit_warning": row["char_start"] % 2 == 1}]


def _segments(s, d):
    t = _texts(s, d)
    known = t.filter("length(text) > 900").select(F.concat(F.lit("nms://t/d-"), "run_id", F.lit("/e-0")).alias("nas"))
    old = t.filter("length(text) < 200").select(F.concat(F.lit("nms://t/d-"), "run_id", F.lit("/e-0")).alias("proposed_nas"), F.lit("confirmed").alias("status"))
    return P.segment(t, _segmenter, known, old, BUDGET, OVERLAP, SLACK)


def _summary(row: dict, attempt: int) -> dict:
    n = len(row["nas"]) % 4
    if n == 0:
        return {"body": None}
    if n == 3:
        return {"body": "Cut", "stop_reason": "max_tokens"}
    return {"body": "A tale." if n == 2 and attempt == 1 else f"A tale [NAS: nms://x/y] [NAS: {row['nas']}] of old."}


def _summaries(s, d):
    todo = C.to_summarise(V.addresses(s, d), V.content(s, d), ["en", "ru"])
    return P.summarise(todo, _summary).select("nas", "locale", "body", F.array_join("grounding_citations", "|").alias("cites"), "attempts", "error_type")


def _annotated(s, d):
    a = V.annotations(s, d).select("nas", "track", "position", "code", "label", "proposed_tier", "status")
    out = P.annotate(V.addresses(s, d), a, lambda r: [{"code": " k12.3", "label": r["nas"], "proposed_tier": "contested"}], ["propp", "bakhtin", "tmi", "campbell"], {"campbell_track": False})
    return out.select("nas", "track", "position", "code", "status")


def _files(s, d):
    c = V.content(s, d).filter("body is not null")
    return c.select(F.get(F.split("nas", "/"), F.lit(2)).alias("tradition"), P.record_path(F.col("nas"), "content", F.col("locale"), F.col("content_id").cast("string")).alias("path"), F.encode("body", "UTF-8").alias("content"))


def _manifest(s, d):
    living = table(s, d, "translations").select("tradition", (F.col("license") == "cc-by").alias("living_tradition"))
    m = P.export_manifest(_files(s, d), living)
    return m.select("tradition", "version", "living_tradition", F.size("checksums").alias("n_files"), F.md5(F.array_join(F.transform(F.map_entries("checksums"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "\n")).alias("h"))


def _confirmed_parallels(s, d):
    known = V.features(s, d).select("nas", F.split("nas", "#")[0].alias("plain")).join(V.addresses(s, d).select(F.col("nas").alias("plain")).distinct(), "plain", "left_semi")
    notes = SP._vector_edges(s, d).select("member_a", "member_b", F.col("qualifying_dimensions").alias("order"), F.concat(F.lit("dims "), "qualifying_dimensions").alias("note"))
    return P.confirmed_parallels(SP._parallels(s, d, True, 0.45), known, notes)


def _plain(c):
    return F.split(c, "#")[0].alias(c)


def _parallel_index(s, d):
    p = SP._parallels(s, d, True, 0.45).filter("meets_threshold")
    both = p.select(_plain("member_a"), _plain("member_b"))
    p = both.select(F.col("member_a").alias("nas"), F.col("member_b").alias("parallel_nas")).unionByName(both.select(F.col("member_b").alias("nas"), F.col("member_a").alias("parallel_nas")))
    return P.division_index(V.addresses(s, d), p)


def _detail(s, d):
    q = P.review_detail(C.review_queue(V.content(s, d), V.annotations(s, d)), V.content(s, d), V.annotations(s, d))
    return q.select("record_type", "record_id", "nas", "tier", F.md5(F.coalesce("text", F.lit(""))).alias("h"))


def _decisions(s, d):
    a = table(s, d, "annotations").groupBy("annotation_id").agg(F.min("recorded_at").alias("decided_at"))
    return V.annotations(s, d).filter("status <> 'candidate'").join(a, "annotation_id").select(F.col("annotation_id").alias("audit_id"), "nas", F.col("status").alias("action"), "decided_at")


def _back_matter(s, d):
    c = V.content(s, d).filter("body is not null").select("content_id", F.col("body").alias("passage_text"))
    return P.without_back_matter(c, SIGNALS).select("content_id")


def _framework(s, d):
    c = V.annotations(s, d).filter("label is not null").groupBy("track", "code").agg(F.min("label").alias("label"))
    c = c.withColumn("section_no", F.when(F.col("code") < "PROPP-2", 1).otherwise(2)).withColumn("heading", F.when(F.col("section_no") == 2, "More")).withColumn("item_no", F.col("code")).withColumn("description", F.lit(None).cast("string"))
    return P.framework_text(c)


def _tradition(s, d):
    return V.reports(s, d).withColumn("tradition", F.split("source_file", "-")[0])


def _merge_proposals(s, d):
    a = V.addresses(s, d).select(F.col("nas").alias("proposed_nas"), "granularity").distinct()
    status = F.when(F.col("granularity") == "episode", "confirmed").when(F.col("granularity") == "lacuna", "deferred").otherwise("proposed")
    new = V.fragments(s, d).filter("nas is not null").select(F.col("nas").alias("proposed_nas"), F.lit("proposed").alias("status")).distinct()
    return C.merge_proposals(a.select("proposed_nas", status.alias("status")).groupBy("proposed_nas").agg(F.min("status").alias("status")), new)


def _merge_annotations(s, d):
    a = V.annotations(s, d).select("nas", "track", "code", "status", "annotation_id")
    return C.merge_annotations(a, a.filter("status = 'candidate'")).select("annotation_id", "code", "status")


def _run_texts(s, d):
    c = V.content(s, d).filter("body is not null and run_id is not null").select("run_id", F.lpad(F.col("content_id").cast("string"), 12, "0").alias("name"), F.col("body").alias("text"))
    from ..sources.readers import concat_texts

    return concat_texts(c).select("run_id", F.length("text").alias("n"), F.md5("text").alias("h"))


def _ranges(s, d):
    ls = S.lines(_texts(s, d))
    r = s.createDataFrame([("a", 1, 2), ("b", 2, None)], "part string, first int, last int")
    return S.extract_range(ls, r, r"^\d+$").groupBy("part").agg(F.count("*").alias("n"), F.sum("run_id").alias("ids"))


def _flag(s, **values):
    return s.createDataFrame([tuple(values.values())], ", ".join(f"{k} boolean" for k in values))


def _gates(s, d):
    from .text_plans import _audit

    return _flag(s, clean=I.promotion_gate(_audit(s, d).filter("type = 'nothing'")), dirty=I.promotion_gate(_audit(s, d)), forced=I.promotion_gate(_audit(s, d), True), two=I.enough_traditions(V.features(s, d)), many=I.enough_traditions(V.features(s, d), least=1000))


def _extension(s, d):
    p = V.fragments(s, d).filter("parent_nas is not null and nas is not null").select(F.col("nas").alias("proposed_nas"), "parent_nas").distinct()
    return I.union(I.extension_rules(p, V.addresses(s, d), True, False))


QUERIES = {
    "f4_paths": lambda s, d: V.annotations(s, d).select("nas", "track").distinct().filter("nas is not null").select("nas", "track", P.record_path(F.col("nas"), "annotation-candidates", F.col("track")).alias("path")),
    "f16_checksums": lambda s, d: C.checksums(_files(s, d).select("path", "content")),
    "f34_salvaged": lambda s, d: V.annotations(s, d).select("annotation_id", T.structured_json(F.concat(F.lit('```json\nHere: [{"code": "'), "code", F.lit('"}] done\n```')), "array<struct<code string>>")[0]["code"].alias("code")),
    "f35_framework": _framework,
    "f37_locales": lambda s, d: V.content(s, d).select("locale").distinct().filter("locale is not null").select("locale", P.locale_phrase(F.col("locale")).alias("phrase")),
    "f38_runs": lambda s, d: _tradition(s, d).filter("ingested_at is not null").select("run_id", P.run_id(F.col("tradition"), F.col("ingested_at")).alias("made")),
    "j9_extended": lambda s, d: P.extended_parents(V.addresses(s, d), V.addresses(s, d)),
    "j19_merged": _merge_annotations,
    "j20_rules": lambda s, d: P.rules_of(_tradition(s, d).filter("source_type = 'tei-xml'").select("tradition").distinct(), _tradition(s, d).select("tradition").distinct()),
    "k4_translations": lambda s, d: P.upsert_translation(table(s, d, "translations").select("tradition", "id", "license"), table(s, d, "translations").filter("license is null").select("tradition", "id", F.lit("unknown").alias("license"))),
    "k5_proposals": _merge_proposals,
    "k6_log": lambda s, d: C.append_log(_decisions(s, d).select("audit_id", "action"), _decisions(s, d).select("audit_id", "nas")),
    "s14_run_texts": _run_texts,
    "s16_ranges": _ranges,
    "w10_first_wins": lambda s, d: S.first_wins(V.content(s, d).select("content_id", F.col("translation_id").alias("k")), "k", ["content_id"]),
    "c21_segments": lambda s, d: _segments(s, d).select("run_id", "proposed_nas", "chunk_index", "granularity", "collision_detected", F.md5("passage_text").alias("h")),
    "a21_report": lambda s, d: P.segmentation_report(_segments(s, d)),
    "c22_summaries": _summaries,
    "c23_annotated": _annotated,
    "c25_manifest": _manifest,
    "q4_confirmed_parallels": _confirmed_parallels,
    "q7_parallel_counts": _parallel_index,
    "q8_detail": _detail,
    "q8_audit_log": lambda s, d: P.audit_log(_decisions(s, d)).select("audit_id", "nas", "decision_no"),
    "q17_no_back_matter": _back_matter,
    "v15_versions": lambda s, d: I.version_rule(_tradition(s, d).select("tradition", F.when(F.col("source_type") == "scanned-pdf", "0.2").when(F.col("source_type") == "txt", "").otherwise("0.1").alias("version")).distinct()),
    "v19_revised": lambda s, d: I.proposal_rule(V.addresses(s, d).select(F.col("nas").alias("proposed_nas"), F.when(F.col("granularity") == "sub-episode", "revised").otherwise("confirmed").alias("status"), F.when(F.col("confirmed_by") != "bulk", F.col("nas")).alias("revised_nas"))),
    "v23_v26_gates": _gates,
    "v24_witness": lambda s, d: I.witness_rule(_tradition(s, d), V.addresses(s, d), table(s, d, "translations").select("tradition", "source_file").distinct()),
    "v25_extension": _extension,
}

_v = V.VIEWS
_PATH = "split_part(nas,'/',3)||'/{0}/'||split_part(nas,'/',4)||CASE WHEN len(string_split(nas,'/'))>4 THEN '/'||array_to_string(string_split(nas,'/')[5:6],'/') ELSE '' END"
CHUNKS = f"""WITH RECURSIVE doc AS (SELECT doc_id AS run_id, text, length(text) AS n FROM documents WHERE {{0}}),
cut AS (SELECT run_id, text, n, 0 AS chunk_index, 0 AS a, NULL::BIGINT AS b FROM doc
  UNION ALL SELECT run_id, text, n, chunk_index + CASE WHEN b IS NULL THEN 0 ELSE 1 END, CASE WHEN b IS NULL THEN a ELSE greatest(b - {OVERLAP}, a + 1) END,
    CASE WHEN b IS NOT NULL THEN NULL WHEN a + {BUDGET} >= n THEN n ELSE
      CASE WHEN contains(substring(text, greatest(a, a + {BUDGET} - {SLACK}) + 1, {BUDGET} - greatest(0, {BUDGET} - {SLACK})), chr(10)||chr(10))
           AND a + {BUDGET} - 1 - strpos(reverse(substring(text, greatest(a, a + {BUDGET} - {SLACK}) + 1, {BUDGET} - greatest(0, {BUDGET} - {SLACK}))), chr(10)||chr(10)) > a
      THEN a + {BUDGET} - 1 - strpos(reverse(substring(text, greatest(a, a + {BUDGET} - {SLACK}) + 1, {BUDGET} - greatest(0, {BUDGET} - {SLACK}))), chr(10)||chr(10)) ELSE a + {BUDGET} END END
  FROM cut WHERE b IS NULL OR b < n),
chunk AS (SELECT run_id, chunk_index, a::INT AS char_start, substring(text, a + 1, b - a) AS chunk FROM cut WHERE b IS NOT NULL)"""
_SEG = CHUNKS.format("text <> ''") + r""", k AS (SELECT *, chunk_index // 2 AS e, regexp_replace(chunk[1:40],'^\s+|\s+$','','g') AS o FROM chunk),
seg AS (SELECT run_id, chunk_index, 'nms://t/d-'||run_id||'/e-'||e AS proposed_nas, CASE WHEN e = 1 THEN 'lacuna' ELSE 'episode' END AS granularity, char_start % 2 = 1 AS w,
  CASE WHEN o = '' THEN '' ELSE regexp_replace(substring(chunk, strpos(chunk, o)),'^\s+|\s+$','','g') END AS t, row_number() OVER (PARTITION BY run_id, e ORDER BY chunk_index) AS rn FROM k WHERE e % 4 <> 3),
prop AS (SELECT seg.*, length(doc.text) > 900 AND e0 AS collision_detected FROM (SELECT *, proposed_nas LIKE '%/e-0' AS e0 FROM seg) seg JOIN doc USING (run_id) WHERE rn = 1 AND NOT (e0 AND length(doc.text) < 200))"""
_DEC = f"{_v}, dec AS (SELECT annotation_id AS audit_id, nas, status AS action, t AS decided_at FROM ann JOIN (SELECT annotation_id, min(recorded_at) AS t FROM annotations GROUP BY 1) USING (annotation_id) WHERE status <> 'candidate')"
_Q4 = rf"""{SP._P}, known AS (SELECT DISTINCT nas FROM feat WHERE split_part(nas,'#',1) IN (SELECT nas FROM addr)),
pp AS (SELECT member_a, member_b, parallel_score, framework_match_count AS k FROM par WHERE sc >= 0.45)"""
_TR = f"{_v}, rt AS (SELECT *, split_part(source_file,'-',1) AS tradition FROM rep)"
ORACLES = {
    "f4_paths": f"{_v} SELECT DISTINCT nas, track, {_PATH.format('annotation-candidates')}||'.'||track||'.yaml' AS path FROM ann WHERE nas IS NOT NULL",
    "f16_checksums": f"{_v} SELECT {_PATH.format('content')}||'.'||locale||'.'||content_id||'.yaml' AS path, sha256(body) AS sha256 FROM cont WHERE body IS NOT NULL",
    "f34_salvaged": f"{_v} SELECT annotation_id, code FROM ann",
    "f35_framework": f"{_v}, c AS (SELECT track, code, min(label) AS label, CASE WHEN code < 'PROPP-2' THEN 1 ELSE 2 END AS sec FROM ann WHERE label IS NOT NULL GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY track, sec ORDER BY code) AS rn FROM c) SELECT track, string_agg(CASE WHEN sec=2 AND rn=1 THEN chr(10)||'More codes:'||chr(10) ELSE '' END||'  '||code||': '||label||' — ', chr(10) ORDER BY sec, code) AS text FROM r GROUP BY 1",
    "f37_locales": f"{_v} SELECT DISTINCT locale, CASE locale WHEN 'en' THEN 'in English' WHEN 'ru' THEN 'in Russian' ELSE 'in locale '''||locale||'''' END AS phrase FROM cont WHERE locale IS NOT NULL",
    "f38_runs": f"{_TR} SELECT run_id, 'run-'||tradition||'-'||strftime(ingested_at,'%Y%m%d-%H%M%S') AS made FROM rt WHERE ingested_at IS NOT NULL",
    "j9_extended": f"{_v} SELECT DISTINCT nas FROM addr WHERE EXISTS (SELECT 1 FROM addr c WHERE starts_with(c.nas, addr.nas||'/') AND len(string_split(c.nas,'/'))=6) AND len(string_split(nas,'/'))=5",
    "j19_merged": f"{_v}, k AS (SELECT * FROM ann WHERE status='confirmed') SELECT annotation_id, code, status FROM k UNION ALL SELECT annotation_id, code, status FROM ann WHERE status='candidate' AND NOT EXISTS (SELECT 1 FROM k WHERE k.nas IS NOT DISTINCT FROM ann.nas AND k.track=ann.track AND k.code IS NOT DISTINCT FROM ann.code)",
    "j20_rules": f"{_TR} SELECT tradition, NOT bool_or(source_type='tei-xml') AS unconfirmed FROM rt GROUP BY 1",
    "k4_translations": "SELECT tradition, id, license FROM translations t WHERE NOT EXISTS (SELECT 1 FROM translations n WHERE n.license IS NULL AND n.tradition=t.tradition AND n.id=t.id) UNION ALL SELECT tradition, id, 'unknown' FROM translations WHERE license IS NULL",
    "k5_proposals": f"{_v}, o AS (SELECT nas, min(CASE granularity WHEN 'episode' THEN 'confirmed' WHEN 'lacuna' THEN 'deferred' ELSE 'proposed' END) AS status FROM addr GROUP BY 1), n AS (SELECT DISTINCT nas FROM frag WHERE nas IS NOT NULL) SELECT coalesce(o.nas,n.nas) AS proposed_nas, CASE WHEN o.status='confirmed' OR n.nas IS NULL THEN o.status ELSE 'proposed' END AS status FROM o FULL JOIN n ON n.nas=o.nas",
    "k6_log": f"{_DEC} SELECT audit_id, action, NULL AS nas FROM dec UNION ALL SELECT audit_id, NULL, nas FROM dec",
    "s14_run_texts": f"{_v}, r AS (SELECT run_id, string_agg(body, chr(10)||chr(10) ORDER BY content_id) AS t FROM cont WHERE body IS NOT NULL AND run_id IS NOT NULL GROUP BY 1) SELECT run_id, length(t) AS n, md5(t) AS h FROM r",
    "w10_first_wins": f"{_v} SELECT content_id, k FROM (SELECT content_id, translation_id AS k, row_number() OVER (PARTITION BY translation_id ORDER BY content_id) AS rn FROM cont) WHERE rn=1 OR coalesce(k,'')=''",
    "w6_chunks": CHUNKS.format("text IS NOT NULL") + " SELECT run_id, chunk_index, char_start, length(chunk) AS n FROM chunk",
    "c21_segments": f"{_SEG} SELECT run_id, proposed_nas, chunk_index, granularity, collision_detected, md5(t) AS h FROM prop",
    "a21_report": f"{_SEG} SELECT run_id, count(*) AS segment_count, count(*) FILTER (WHERE collision_detected) AS nas_collision_count, count(*) FILTER (WHERE w) AS methodology_fit_warnings, count(*) FILTER (WHERE granularity='lacuna') AS lacuna_count FROM prop GROUP BY 1",
    "c22_summaries": f"{_v}, todo AS (SELECT DISTINCT nas, unnest(['en','ru']) AS locale FROM addr WHERE division<>'' AND episode<>'' EXCEPT SELECT nas, locale FROM cont WHERE layer='surface' AND status IN ('candidate','confirmed')), r AS (SELECT *, length(nas)%4 AS m FROM todo) SELECT nas, locale, CASE WHEN m IN (1,2) THEN 'A tale [NAS: nms://x/y] [NAS: '||nas||'] of old.' END AS body, CASE WHEN m IN (1,2) THEN 'nms://x/y' END AS cites, CASE m WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS attempts, CASE m WHEN 0 THEN 'generation_failure' WHEN 3 THEN 'truncation_failure' END AS error_type FROM r",
    "c23_annotated": f"{_v}, todo AS (SELECT nas, track FROM (SELECT DISTINCT nas, granularity, unnest(['propp','bakhtin','tmi']) AS track FROM addr) WHERE NOT (track='propp' AND coalesce(granularity,'')='sub-episode') EXCEPT SELECT nas, track FROM ann) SELECT nas, track, position, code, status FROM ann UNION ALL SELECT nas, track, 0, CASE WHEN track='tmi' THEN 'TMI-K12.3' ELSE 'k12.3' END, 'candidate' FROM todo",
    "c25_manifest": f"{_v}, f AS (SELECT split_part(nas,'/',3) AS tradition, {_PATH.format('content')}||'.'||locale||'.'||content_id||'.yaml' AS path, sha256(body) AS s FROM cont WHERE body IS NOT NULL) SELECT tradition, '0.1' AS version, tradition IN (SELECT tradition FROM translations WHERE license='cc-by') AS living_tradition, count(*) AS n_files, md5(string_agg(path||'='||s, chr(10) ORDER BY path)) AS h FROM f GROUP BY 1",
    "q4_confirmed_parallels": f"{_Q4}, x AS (SELECT * FROM pp WHERE member_a IN (SELECT nas FROM known) AND member_b IN (SELECT nas FROM known)) SELECT member_a AS nas, member_b AS parallel_nas, parallel_score, CASE WHEN k>0 THEN 'dims '||k END AS note FROM x UNION ALL SELECT member_b, member_a, parallel_score, CASE WHEN k>0 THEN 'dims '||k END FROM x",
    "q7_parallel_counts": f"{_Q4}, b AS (SELECT split_part(member_a,'#',1) AS x, split_part(member_b,'#',1) AS y FROM pp), c AS (SELECT nas, count(DISTINCT o) AS n FROM (SELECT x AS nas, y AS o FROM b UNION ALL SELECT y, x FROM b) GROUP BY 1) SELECT tradition_id, division, ordinal, nas, coalesce(n,0) AS n_parallels FROM addr LEFT JOIN c USING (nas)",
    "q8_detail": f"{_v} SELECT CASE WHEN layer='surface' THEN 'summary' ELSE layer END AS record_type, content_id AS record_id, nas, confidence_tier AS tier, md5(coalesce(body,'')) AS h FROM cont WHERE status='candidate' UNION ALL SELECT 'annotation', annotation_id, nas, proposed_tier, md5(coalesce(label,'')) FROM ann WHERE status='candidate'",
    "q8_audit_log": f"{_DEC} SELECT audit_id, nas, row_number() OVER (PARTITION BY nas ORDER BY decided_at, audit_id) AS decision_no FROM dec",
    "q17_no_back_matter": rf"{_v} SELECT content_id FROM cont WHERE body IS NOT NULL AND regexp_replace(trim(split_part(trim(body,' '), chr(10), 1),' '),'[\s.:]+$','') NOT IN ({', '.join(repr(x) for x in SIGNALS)})",
    "v15_versions": f"{_TR} SELECT DISTINCT 'V15' AS rule_id, 'error' AS severity, tradition AS record_id, NULL AS nas, '0.2' AS detail FROM rt WHERE source_type='scanned-pdf'",
    "v19_revised": f"{_v} SELECT 'V19' AS rule_id, 'error' AS severity, nas AS record_id, nas, 'no revised address' AS detail FROM addr WHERE granularity='sub-episode' AND NOT coalesce(confirmed_by<>'bulk',false)",
    "v23_v26_gates": f"{_v} SELECT true AS clean, false AS dirty, true AS forced, (SELECT count(DISTINCT tradition)>=2 FROM feat) AS two, (SELECT count(DISTINCT tradition)>=1000 FROM feat) AS many",
    "v24_witness": f"{_TR}, h AS (SELECT tradition, arg_max(source_file, (ingested_at, run_id)) AS held FROM rt GROUP BY 1) SELECT DISTINCT 'V24' AS rule_id, 'error' AS severity, source_file AS record_id, NULL AS nas, held AS detail FROM (SELECT DISTINCT tradition, source_file FROM translations) JOIN h USING (tradition) WHERE source_file<>held AND tradition IN (SELECT tradition_id FROM addr)",
    "v25_extension": f"{_v} SELECT DISTINCT 'V25' AS rule_id, 'error' AS severity, nas AS record_id, nas, parent_nas AS detail FROM frag WHERE parent_nas IS NOT NULL AND nas IS NOT NULL AND parent_nas NOT IN (SELECT nas FROM addr)",
}
