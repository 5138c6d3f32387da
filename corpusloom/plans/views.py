"""Tables as the operators take them, and the same views in SQL: one row a record, canonical spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import canon_nas, canon_propp, canon_tmi, norm_locale
from ..session import table


def canon_code(track, code):
    plain = F.upper(F.regexp_replace(F.regexp_replace(code, r"^\s+|\s+$", ""), r"\s+", "-"))
    return F.when(track == "tmi", canon_tmi(code)).when(track == "propp", canon_propp(code)).otherwise(plain)


def fragments(s, d) -> DataFrame:
    f = table(s, d, "fragments")
    return f.select(
        "fragment_id", canon_nas(F.col("nas")).alias("nas"), canon_nas(F.col("parent_nas")).alias("parent_nas"), "tradition_id", "confidence_tier", "sequence_position",
        F.array_join("available_layers", "|").alias("layers"), "granularity", "manuscript_layer", "methodology_fit_warning", "methodology_fit_note", "recorded_at", "deleted_at",
    ).distinct()


def addresses(s, d) -> DataFrame:
    f = table(s, d, "nas_confirmed")
    return f.select("ordinal", canon_nas(F.col("nas")).alias("nas"), canon_nas(F.col("parent_nas")).alias("parent_nas"), "tradition_id", "division", "episode", "granularity", "confirmed_by", "confirmed_at").distinct()


def content(s, d) -> DataFrame:
    f = table(s, d, "fragment_content")
    return f.select(
        "content_id", canon_nas(F.col("nas")).alias("nas"), norm_locale(F.col("locale")).alias("locale"), "layer", "body", "status", "confidence_tier", "ai_generated", "reviewed_by",
        "translation_id", "run_id", "recorded_at", F.array_join(F.transform("grounding_citations", canon_nas), "|").alias("cites"),
    ).distinct()


def annotations(s, d) -> DataFrame:
    f = table(s, d, "annotations")
    return f.select(
        "annotation_id", canon_nas(F.col("nas")).alias("nas"), "track", "position", canon_code(F.col("track"), F.col("code")).alias("code"), "label", "status", "proposed_tier", "ai_generated",
        F.regexp_replace("code", r"^\s+|\s+$", "").alias("raw_code"),
    ).distinct()


def features(s, d) -> DataFrame:
    f = table(s, d, "fragment_features")
    return f.select("feature_id", canon_nas(F.col("nas")).alias("nas"), "tradition", "tmi_codes", "propp_codes", "chronotope_type", "polyphony", "carnivalesque").dropDuplicates(["feature_id"]).withColumn("nas", F.concat("nas", F.lit("#"), F.col("feature_id")))


def reports(s, d) -> DataFrame:
    f = table(s, d, "ingestion_reports")
    return f.select("run_id", "source_file", "source_type", "word_count", "page_count", "ocr_applied", "ocr_confidence_mean", "ocr_confidence_min", F.array_join("flagged_pages", "|").alias("flagged"), "ingested_at").distinct()


def vectors(s, d) -> DataFrame:
    """Vectors under the features' addresses: vector n belongs to feature n + 1; its label is a tradition too."""
    f = features(s, d).select(F.col("feature_id").alias("id"), "nas", "tradition")
    e = table(s, d, "embeddings").select((F.col("vec_id") + 1).alias("id"), F.col("embedding").alias("vector"), "label")
    return f.join(e, "id").select("nas", "tradition", "vector", "label")


# -- the same in SQL ---------------------------------------------------------

STRIP = r"regexp_replace({0},'^\s+|\s+$','','g')"
NAS = r"nullif(regexp_replace(regexp_replace(lower(regexp_replace({0},'^\s+|\s+$','','g')),'^\[?\s*nas\s*:\s*|\s*\]$','','g'),'/+$',''),'')"
_X = r"upper(regexp_replace({0},'\s+','','g'))"
TMI = rf"CASE WHEN {_X} IN ('','TMI','TMI-') THEN NULL WHEN starts_with({_X},'TMI') THEN regexp_replace({_X},'^TMI-?','TMI-') WHEN regexp_matches({_X},'^[A-Z]+\d') THEN 'TMI-'||{_X} ELSE {_X} END"
PROPP = rf"CASE WHEN {_X} IN ('','PROPP') THEN NULL WHEN regexp_matches({_X},'^\d+$') THEN 'PROPP-'||{_X} ELSE regexp_replace({_X},'^PROPP-?','PROPP-') END"
LOCALE = r"lower(split_part(replace(regexp_replace({0},'^\s+|\s+$','','g'),'_','-'),'-',1))"
_tmi, _propp = TMI.format("code"), PROPP.format("code")
VIEWS = rf"""
WITH frag AS (SELECT DISTINCT fragment_id, {NAS.format("nas")} AS nas, {NAS.format("parent_nas")} AS parent_nas, tradition_id, confidence_tier, sequence_position,
    array_to_string(available_layers,'|') AS layers, granularity, manuscript_layer, methodology_fit_warning, methodology_fit_note, recorded_at, deleted_at FROM fragments),
addr AS (SELECT DISTINCT ordinal, {NAS.format("nas")} AS nas, {NAS.format("parent_nas")} AS parent_nas, tradition_id, division, episode, granularity, confirmed_by, confirmed_at FROM nas_confirmed),
cont AS (SELECT DISTINCT content_id, {NAS.format("nas")} AS nas, {LOCALE.format("locale")} AS locale, layer, body, status, confidence_tier, ai_generated, reviewed_by, translation_id, run_id, recorded_at,
    array_to_string(list_transform(grounding_citations, lambda x: {NAS.format("x")}),'|') AS cites FROM fragment_content),
ann AS (SELECT DISTINCT annotation_id, {NAS.format("nas")} AS nas, track, position,
    CASE track WHEN 'tmi' THEN {_tmi} WHEN 'propp' THEN {_propp} ELSE upper(regexp_replace({STRIP.format("code")},'\s+','-','g')) END AS code,
    label, status, proposed_tier, ai_generated, {STRIP.format("code")} AS raw_code FROM annotations),
feat AS (SELECT feature_id, any_value({NAS.format("nas")})||'#'||feature_id AS nas, any_value(tradition) AS tradition, any_value(tmi_codes) AS tmi_codes, any_value(propp_codes) AS propp_codes,
    any_value(chronotope_type) AS chronotope_type, any_value(polyphony) AS polyphony, any_value(carnivalesque) AS carnivalesque FROM fragment_features GROUP BY feature_id),
rep AS (SELECT DISTINCT run_id, source_file, source_type, word_count, page_count, ocr_applied, ocr_confidence_mean, ocr_confidence_min, array_to_string(flagged_pages,'|') AS flagged, ingested_at FROM ingestion_reports),
vec AS (SELECT f.nas, f.tradition, e.embedding AS vector, e.label FROM feat f JOIN embeddings e ON e.vec_id + 1 = f.feature_id),
rank_of AS (SELECT * FROM (VALUES ('documented',0),('reconstructed',1),('contested',2),('inspired',3)) t(tier,r))
"""
