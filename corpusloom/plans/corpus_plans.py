"""Queries of the corpus's life and of the specified lookups."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators import corpus as C
from ..operators import derive as D
from ..sources import readers as R
from ..streaming.incremental import event_counts
from ..session import table
from . import views as V

KEY = C.CONTENT_KEY


def _md5(df):
    return df.withColumn("body", F.md5(F.coalesce("body", F.lit(""))))


def _late(s, d):
    """Records that arrived more than a week after they came into being: the batch that comes in."""
    c = table(s, d, "fragment_content").groupBy("content_id").agg(F.min("loaded_at").alias("there"), F.min("recorded_at").alias("made"))
    return c.filter(F.col("there") > F.col("made") + F.expr("interval 7 days")).select("content_id")


def _upsert(s, d):
    new = V.content(s, d).join(_late(s, d), "content_id", "left_semi").select("content_id", "nas", F.lit("new").alias("status"))
    return C.upsert(V.content(s, d).select("content_id", "nas", "status"), new, ["content_id"])


def _absent(s, d):
    old = V.content(s, d).join(_late(s, d), "content_id", "left_anti").select("content_id", "nas", "status")
    new = V.content(s, d).select("content_id", "nas", F.lit("new").alias("status"))
    return C.append_absent(old, new, ["content_id"])


def _decided(s, d):
    c = V.content(s, d)
    keys = c.filter("status = 'candidate' and ai_generated").select(*KEY).distinct()
    n = F.pmod(F.length("nas"), F.lit(3))
    dec = keys.select(*KEY, F.when(n == 0, "confirmed").when(n == 1, "rejected").otherwise("modified_confirmed").alias("action"), F.lit("reconstructed").alias("confidence_tier_assigned"), F.lit("edited").alias("body"))
    return _md5(C.apply_decisions(c, dec)).select("content_id", "status", "confidence_tier", "body")


def _proposals(s, d):
    return V.addresses(s, d).select(F.col("nas").alias("proposed_nas"), "parent_nas", "tradition_id", "division", "episode", "granularity", F.lit("proposed").alias("status"), F.col("ordinal").alias("o"))


def _confirm(s, d):
    p = _proposals(s, d)
    g = F.col("granularity")
    dec = p.select("proposed_nas", F.when(g == "sub-episode", "revised").when(g == "lacuna", "deferred").otherwise("confirmed").alias("action"), F.concat("proposed_nas", F.lit("-r")).alias("revised_nas"), F.lit("me").alias("confirmed_by"), F.lit(None).cast("timestamp_ntz").alias("confirmed_at"))
    return C.confirm_addresses(p.drop("o"), dec).select("nas", "tradition_id", "confirmed_by")


def _segments(s, d):
    c = V.content(s, d).filter("layer = 'translated' and body is not null")
    return c.select("nas", F.get(F.split("nas", "/"), F.lit(3)).alias("division"), F.get(F.split("nas", "/"), F.lit(4)).alias("episode"), "run_id", F.col("translation_id").alias("label"), F.col("body").alias("passage_text"))


def _emit(s, d):
    p = C.passage_of(V.addresses(s, d).select("nas", "division", "episode").distinct(), _segments(s, d))
    out = C.emit_translated(p, V.content(s, d), {"locale": "en", "id": "new-1900", "author": "A", "year": 1900, "license": None})
    return _md5(out).select("nas", "locale", "translation_id", "body", "status", "confidence_tier", "ai_generated", "translation_year")


def _to_embed(s, d):
    c = V.content(s, d)
    have = c.filter("ai_generated and body is not null").select(F.sha2("body", 256).alias("content_hash"), F.lit("m1").alias("model_version"))
    return C.to_embed(c, have, "m1", ["surface", "translated"], ["en"]).select("content_id", "content_hash")


def _lookup(s, d):
    """Q-01 with aliases: an address, or the one that replaced it, or an error code."""
    ask = V.features(s, d).select(F.split("nas", "#")[0].alias("asked")).distinct()
    f = V.fragments(s, d).filter("deleted_at is null").groupBy("nas").agg(F.min("fragment_id").alias("fragment_id"))
    alias = V.addresses(s, d).filter("parent_nas is not null").select(F.col("nas").alias("asked"), F.col("parent_nas").alias("alias")).distinct()
    j = ask.join(f, ask.asked == f.nas, "left").drop("nas").join(alias, "asked", "left").join(f.select(F.col("nas").alias("alias"), F.col("fragment_id").alias("alias_id")), "alias", "left")
    return j.groupBy("asked").agg(F.min(F.coalesce("fragment_id", "alias_id")).alias("fragment_id")).withColumn("error", F.when(F.col("fragment_id").isNull(), "not_found"))


def _edition(s, d):
    """Q-02: of the confirmed editions of an address and locale the latest year, then the least id."""
    c = table(s, d, "fragment_content").select("content_id", F.lower(F.split("locale", "[-_]")[0]).alias("locale"), "nas", "layer", "status", "translation_id", "translation_year").distinct()
    w = W.partitionBy("nas", "locale").orderBy(F.desc_nulls_last("translation_year"), "translation_id", "content_id")
    return c.filter("layer = 'translated' and status = 'confirmed'").withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("nas", "locale", "content_id", "translation_id")


def _neighbours(s, d):
    return D.neighbours(V.addresses(s, d).select("tradition_id", "ordinal", "nas"), "tradition_id", "ordinal", "nas").select("ordinal", "nas", "prev_nas", "next_nas")


def _fallback(s, d):
    c = V.content(s, d).filter("layer = 'surface' and status = 'confirmed'")
    one = lambda g: c.filter(F.col("locale") == g).groupBy("nas").agg(F.min("content_id").alias(g))
    a = V.addresses(s, d).select("nas").distinct().join(one("ru"), "nas", "left").join(one("en"), "nas", "left")
    return a.select("nas", F.coalesce("ru", "en").alias("content_id"), (F.col("ru").isNull() & F.col("en").isNotNull()).alias("locale_fallback"))


def _ceiling(s, d):
    r = F.when(F.col("confidence_tier") == "documented", 0).when(F.col("confidence_tier") == "reconstructed", 1).when(F.col("confidence_tier") == "contested", 2).otherwise(3)
    return V.content(s, d).groupBy("nas").agg(F.max(r).alias("ceiling_rank"))


def _disclosure(s, d):
    text = F.when(F.col("ai_generated") & F.col("reviewed_by").isNotNull(), F.concat(F.lit("generated, reviewed by "), "reviewed_by")).when(F.col("ai_generated"), "generated, unreviewed").otherwise("human")
    return V.content(s, d).select("content_id", text.alias("disclosure"))


def _ocr(s, d):
    e = table(s, d, "events").select(F.concat(F.lit("f"), F.col("user_id") % 10).alias("path"), (F.col("event_id") % 7).cast("int").alias("page_no"), "value").groupBy("path", "page_no").agg(F.array_sort(F.collect_list(F.least("value", F.lit(100.0)))).alias("confidences"))
    return R.ocr_report(e.withColumn("text", F.lit("a b c")), 0.2).select("path", "page_count", F.bround("ocr_confidence_mean", 6).alias("mean"), F.bround("ocr_confidence_min", 6).alias("least"), F.array_join("flagged_pages", "|").alias("flagged"), "word_count")


QUERIES = {
    "k3_upsert": _upsert,
    "k9_write_if_absent": _absent,
    "k10_strip_edition": lambda s, d: C.layers(C.strip_edition(V.content(s, d), "en", "translated", "x")).select("nas", F.array_join("layers", "|").alias("layers")),
    "a16_layers": lambda s, d: C.layers(V.content(s, d), "status in ('candidate', 'confirmed')").select("nas", F.array_join("layers", "|").alias("layers")),
    "c13_review_queue": lambda s, d: C.review_queue(V.content(s, d), V.annotations(s, d)),
    "filter7_queue_en": lambda s, d: C.review_queue(V.content(s, d), V.annotations(s, d), "summary", "en").select("record_id", "nas"),
    "c14_decisions": _decided,
    "c15_confirm": _confirm,
    "c16_auto_confirm": lambda s, d: C.auto_confirm(V.annotations(s, d), "^BAKHTIN-(POLYPHONY|CARNIVALESQUE|HETEROGLOSSIA)-").select("annotation_id", "status"),
    "c17_emit_translated": _emit,
    "c18_clean_editions": lambda s, d: C.clean_editions(V.content(s, d)).select("content_id", F.md5("body").alias("h")),
    "c19_citation_backfill": lambda s, d: V.content(s, d).select("content_id", F.array_join(F.array_distinct(F.filter(F.split("cites", r"\|"), lambda x: (x != "") & (x != F.col("nas")))), "|").alias("cites")),
    "c20_to_embed": _to_embed,
    "s11_witnesses": lambda s, d: C.witnesses(V.addresses(s, d).select("nas", "division", "episode").distinct(), _segments(s, d)).select("nas", "label", F.md5("passage_text").alias("h")),
    "j16_passages": lambda s, d: C.passage_of(V.addresses(s, d).select("nas", "division", "episode").distinct(), _segments(s, d)).select("nas", F.col("passage_text").isNotNull().alias("found")),
    "i1_to_summarise": lambda s, d: C.to_summarise(V.addresses(s, d), V.content(s, d), ["en", "ru"]),
    "i2_to_annotate": lambda s, d: C.to_annotate(V.addresses(s, d), V.annotations(s, d), ["propp", "bakhtin", "tmi"]),
    "j15_collisions": lambda s, d: C.collisions(_proposals(s, d).drop("o"), V.fragments(s, d)).groupBy("collision_detected").agg(F.count("*").alias("n")),
    "a20_ocr_stats": _ocr,
    "a20_report_stats": lambda s, d: V.reports(s, d).groupBy("source_type").agg(F.count("*").alias("n"), F.bround(F.avg("ocr_confidence_mean"), 6).alias("mean"), F.min("ocr_confidence_min").alias("least"), F.sum("word_count").alias("words")),
    "a25_source_choice": lambda s, d: V.reports(s, d).withColumn("tradition", F.split("source_file", "-")[0]).groupBy("tradition").agg(F.min_by("run_id", F.struct(F.when(F.col("source_type") == "tei-xml", 1).when(F.col("source_type") == "txt", 2).when(F.col("source_type") == "digital-pdf", 3).otherwise(4), "run_id")).alias("run_id")),
    "s13_runs": lambda s, d: V.reports(s, d).join(V.content(s, d).select("run_id").distinct(), "run_id").select("run_id", "source_type").distinct(),
    "q1_lookup": _lookup,
    "q2_preferred_edition": _edition,
    "q3_neighbours": _neighbours,
    "q5_annotations_by_track": lambda s, d: V.annotations(s, d).filter("status = 'confirmed'").groupBy("nas", "track").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("code")), "|").alias("codes")),
    "q6_locale_fallback": _fallback,
    "q7_division_index": lambda s, d: V.addresses(s, d).select("tradition_id", "division", "nas").distinct().join(V.fragments(s, d).select("nas").distinct().withColumn("k", F.lit(1)), "nas", "left").groupBy("tradition_id", "division").agg(F.count("*").alias("n"), F.count("k").alias("n_with_fragment")),
    "q10_tier_ceiling": _ceiling,
    "q12_disclosure": _disclosure,
    "window_event_counts": lambda s, d: event_counts(table(s, d, "events")).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n"),
}

_v = V.VIEWS
_seg = f"{_v}, seg AS (SELECT nas, string_split(nas,'/')[4] AS division, string_split(nas,'/')[5] AS episode, run_id, translation_id AS label, body AS passage_text FROM cont WHERE layer='translated' AND body IS NOT NULL), ad AS (SELECT DISTINCT nas, division, episode FROM addr)"
_pass = _seg + r", sol AS (SELECT * FROM seg WHERE regexp_replace(passage_text,'\s+','','g')<>''), p1 AS (SELECT nas, arg_max(passage_text, (run_id, passage_text)) AS t1 FROM sol GROUP BY 1), p2 AS (SELECT division, episode, arg_max(passage_text, (run_id, passage_text)) AS t2 FROM sol GROUP BY ALL), pas AS (SELECT ad.nas, coalesce(t1,t2) AS t FROM ad LEFT JOIN p1 USING (nas) LEFT JOIN p2 ON p2.division=ad.division AND p2.episode=ad.episode)"
_lay = "SELECT nas, string_agg(layer,'|' ORDER BY o, layer) AS layers FROM (SELECT nas, layer, min(content_id) AS o FROM cont WHERE {0} GROUP BY ALL) GROUP BY 1"
_LATE = "late AS (SELECT content_id FROM fragment_content GROUP BY 1 HAVING min(loaded_at) > min(recorded_at) + INTERVAL 7 DAY)"
_CLEAN = r"regexp_replace(regexp_replace(array_to_string(list_filter(string_split({0},chr(10)), lambda x: NOT regexp_full_match(regexp_replace(x,'^\s+|\s+$','','g'),'\[PAGE \d+\]|\d{{1,5}}')),chr(10)),'\n{{3,}}',chr(10)||chr(10),'g'),'^\s+|\s+$','','g')"
ORACLES = {
    "c17_emit_translated": f"{_pass} SELECT nas, 'en' AS locale, 'new-1900' AS translation_id, md5({_CLEAN.format('t')}) AS body, 'candidate' AS status, 'documented' AS confidence_tier, false AS ai_generated, 1900 AS translation_year FROM pas WHERE regexp_replace(t,'\\s+','','g') <> ''",
    "c18_clean_editions": f"{_v}, c AS (SELECT content_id, body, {_CLEAN.format('body')} AS b FROM cont WHERE layer='translated') SELECT content_id, md5(b) AS h FROM c WHERE b <> body",
    "k3_upsert": f"{_v}, {_LATE} SELECT content_id, nas, CASE WHEN content_id IN (SELECT content_id FROM late) THEN 'new' ELSE status END AS status FROM cont",
    "k9_write_if_absent": f"{_v}, {_LATE} SELECT content_id, nas, CASE WHEN content_id IN (SELECT content_id FROM late) THEN 'new' ELSE status END AS status FROM cont",
    "k10_strip_edition": f"{_v} {_lay.format(chr(115) + 'tatus<>' + chr(39) + 'rejected' + chr(39))}",
    "a16_layers": f"{_v} {_lay.format('status IN (' + chr(39) + 'candidate' + chr(39) + ',' + chr(39) + 'confirmed' + chr(39) + ')')}",
    "c13_review_queue": f"{_v} SELECT CASE WHEN layer='surface' THEN 'summary' ELSE layer END AS record_type, content_id AS record_id, nas, locale, layer, NULL::VARCHAR AS track, NULL::VARCHAR AS code FROM cont WHERE status='candidate' UNION ALL SELECT 'annotation', annotation_id, nas, NULL, NULL, track, code FROM ann WHERE status='candidate'",
    "filter7_queue_en": f"{_v} SELECT content_id AS record_id, nas FROM cont WHERE status='candidate' AND layer='surface' AND locale='en'",
    "c14_decisions": f"""{_v}, r AS (SELECT *, row_number() OVER (PARTITION BY nas, locale, layer, translation_id, status ORDER BY content_id) AS rn FROM cont),
k AS (SELECT DISTINCT nas, locale, layer, translation_id, length(nas)%3 AS n FROM cont WHERE status='candidate' AND ai_generated),
j AS (SELECT r.*, k.n FROM r LEFT JOIN k ON r.nas IS NOT DISTINCT FROM k.nas AND r.locale IS NOT DISTINCT FROM k.locale AND r.layer IS NOT DISTINCT FROM k.layer AND r.translation_id IS NOT DISTINCT FROM k.translation_id AND r.status='candidate' AND rn=1)
SELECT content_id, CASE WHEN n=1 THEN 'rejected' WHEN n IS NOT NULL THEN 'confirmed' ELSE status END AS status, CASE WHEN n IN (0,2) THEN 'reconstructed' ELSE confidence_tier END AS confidence_tier, md5(CASE WHEN n=2 THEN 'edited' ELSE coalesce(body,'') END) AS body FROM j""",
    "c15_confirm": f"{_v} SELECT CASE WHEN granularity='sub-episode' THEN nas||'-r' ELSE nas END AS nas, tradition_id, 'me' AS confirmed_by FROM addr WHERE coalesce(granularity,'')<>'lacuna'",
    "c16_auto_confirm": f"{_v} SELECT annotation_id, CASE WHEN status='candidate' AND regexp_matches(code,'^BAKHTIN-(POLYPHONY|CARNIVALESQUE|HETEROGLOSSIA)-') THEN 'confirmed' ELSE status END AS status FROM ann",
    "c19_citation_backfill": f"{_v}, c AS (SELECT content_id, nas, string_split(coalesce(cites,''),'|') AS a, cites FROM cont) SELECT content_id, CASE WHEN cites IS NULL THEN NULL ELSE coalesce(array_to_string(list_filter(a, lambda x, i: x<>'' AND x<>nas AND list_position(a,x)=i),'|'),'') END AS cites FROM c",
    "c20_to_embed": rf"{_v} SELECT content_id, sha256(body) AS content_hash FROM cont WHERE layer IN ('surface','translated') AND locale='en' AND status='confirmed' AND regexp_replace(body,'\s+','','g')<>'' AND sha256(body) NOT IN (SELECT sha256(body) FROM cont WHERE ai_generated AND body IS NOT NULL)",
    "s11_witnesses": f"{_seg} SELECT ad.nas, label, md5(passage_text) AS h FROM ad JOIN seg USING (nas) UNION ALL SELECT ad.nas, label, md5(passage_text) FROM ad JOIN seg ON seg.division=ad.division AND seg.episode=ad.episode WHERE ad.nas NOT IN (SELECT nas FROM seg)",
    "j16_passages": f"{_pass} SELECT nas, t IS NOT NULL AS found FROM pas",
    "i1_to_summarise": f"{_v} SELECT DISTINCT nas, unnest(['en','ru']) AS locale FROM addr WHERE division<>'' AND episode<>'' EXCEPT SELECT nas, locale FROM cont WHERE layer='surface' AND status IN ('candidate','confirmed')",
    "i2_to_annotate": f"{_v} SELECT nas, track FROM (SELECT DISTINCT nas, granularity, unnest(['propp','bakhtin','tmi']) AS track FROM addr) WHERE NOT (track='propp' AND coalesce(granularity,'')='sub-episode') EXCEPT SELECT nas, track FROM ann",
    "j15_collisions": f"{_v} SELECT nas IN (SELECT nas FROM frag WHERE nas IS NOT NULL) AS collision_detected, count(*) AS n FROM addr GROUP BY 1",
    "a20_ocr_stats": "WITH p AS (SELECT 'f'||(user_id%10) AS path, (event_id%7)::INT AS page_no, avg(least(value,100.0)) FILTER (WHERE value<>-1)/100 AS c FROM events GROUP BY ALL) SELECT path, count(*) AS page_count, round_even(avg(c),6) AS mean, round_even(min(c),6) AS least, coalesce(string_agg(CASE WHEN c<0.2 THEN page_no::VARCHAR END,'|' ORDER BY page_no),'') AS flagged, count(*)*5 AS word_count FROM p GROUP BY 1",
    "a20_report_stats": f"{_v} SELECT source_type, count(*) AS n, round_even(avg(ocr_confidence_mean),6) AS mean, min(ocr_confidence_min) AS least, sum(word_count)::BIGINT AS words FROM rep GROUP BY 1",
    "a25_source_choice": f"{_v} SELECT split_part(source_file,'-',1) AS tradition, arg_min(run_id, (CASE source_type WHEN 'tei-xml' THEN 1 WHEN 'txt' THEN 2 WHEN 'digital-pdf' THEN 3 ELSE 4 END, run_id)) AS run_id FROM rep GROUP BY 1",
    "s13_runs": f"{_v} SELECT DISTINCT run_id, source_type FROM rep WHERE run_id IN (SELECT run_id FROM cont)",
    "q1_lookup": f"{_v}, f AS (SELECT nas, min(fragment_id) AS i FROM frag WHERE deleted_at IS NULL GROUP BY 1), a AS (SELECT DISTINCT split_part(nas,'#',1) AS asked FROM feat), l AS (SELECT DISTINCT nas, parent_nas FROM addr WHERE parent_nas IS NOT NULL) SELECT asked, min(coalesce(f.i,g.i)) AS fragment_id, CASE WHEN min(coalesce(f.i,g.i)) IS NULL THEN 'not_found' END AS error FROM a LEFT JOIN f ON f.nas=asked LEFT JOIN l ON l.nas=asked LEFT JOIN f g ON g.nas=l.parent_nas GROUP BY 1",
    "q2_preferred_edition": "WITH c AS (SELECT DISTINCT content_id, lower(split_part(replace(locale,'_','-'),'-',1)) AS locale, nas, layer, status, translation_id, translation_year FROM fragment_content), r AS (SELECT *, row_number() OVER (PARTITION BY nas, locale ORDER BY translation_year DESC NULLS LAST, translation_id NULLS FIRST, content_id) AS rn FROM c WHERE layer='translated' AND status='confirmed') SELECT nas, locale, content_id, translation_id FROM r WHERE rn=1",
    "q3_neighbours": f"{_v} SELECT ordinal, nas, lag(nas) OVER w AS prev_nas, lead(nas) OVER w AS next_nas FROM addr WINDOW w AS (PARTITION BY tradition_id ORDER BY ordinal)",
    "q5_annotations_by_track": f"{_v} SELECT nas, track, count(*) AS n, coalesce(array_to_string(list_sort(list_distinct(list(code))),'|'),'') AS codes FROM ann WHERE status='confirmed' GROUP BY ALL",
    "q6_locale_fallback": f"{_v}, c AS (SELECT nas, locale, min(content_id) AS i FROM cont WHERE layer='surface' AND status='confirmed' GROUP BY ALL) SELECT a.nas, coalesce(r.i,e.i) AS content_id, r.i IS NULL AND e.i IS NOT NULL AS locale_fallback FROM (SELECT DISTINCT nas FROM addr) a LEFT JOIN c r ON r.nas=a.nas AND r.locale='ru' LEFT JOIN c e ON e.nas=a.nas AND e.locale='en'",
    "q7_division_index": f"{_v} SELECT tradition_id, division, count(*) AS n, count(*) FILTER (WHERE nas IN (SELECT nas FROM frag WHERE nas IS NOT NULL)) AS n_with_fragment FROM (SELECT DISTINCT tradition_id, division, nas FROM addr) GROUP BY ALL",
    "q10_tier_ceiling": f"{_v} SELECT nas, max(coalesce(r,3)) AS ceiling_rank FROM cont LEFT JOIN rank_of ON tier=confidence_tier GROUP BY 1",
    "q12_disclosure": f"{_v} SELECT content_id, CASE WHEN ai_generated AND reviewed_by IS NOT NULL THEN 'generated, reviewed by '||reviewed_by WHEN ai_generated THEN 'generated, unreviewed' ELSE 'human' END AS disclosure FROM cont",
    "window_event_counts": "SELECT strftime(date_trunc('hour', ts),'%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
