"""Explicit schemas of the logical tables; readers never infer."""

from __future__ import annotations

from pyspark.sql.types import StructType

DDL = {
    "nas_proposals": "proposed_nas string, parent_nas string, tradition_id string, division string, episode string, granularity string, status string, revised_nas string, collision_detected boolean, methodology_fit_warning boolean, methodology_fit_note string",
    "nas_confirmed": "ordinal bigint, nas string, parent_nas string, tradition_id string, division string, episode string, granularity string, confirmed_by string, confirmed_at timestamp",
    "nas_revisions": "old_nas string, new_nas string, tradition_id string, reason string, revised_by string, revised_at timestamp",
    "fragments": "nas string, parent_nas string, tradition_id string, confidence_tier string, sequence_position int, available_layers array<string>, source_language string, manuscript_layer string, granularity string, methodology_fit_warning boolean, methodology_fit_note string",
    "fragment_content": "nas string, locale string, layer string, translation_id string, body string, status string, confidence_tier string, ai_generated boolean, reviewed_by string, reviewed_at timestamp, translation_author string, translation_year int, translation_license string, grounding_citations array<string>, generated_by_model string",
    "annotations": "nas string, track string, position int, code string, label string, proposed_tier string, status string, rationale string, evidence_citations array<string>, methodology_fit_warning boolean, methodology_fit_note string, ai_generated boolean, generated_by_model string",
    "embeddings": "nas string, locale string, layer string, translation_id string, model_version string, dimension int, vector array<float>, content_hash string, granularity string",
    "translations": "tradition string, id string, author string, year int, locale string, license string, layer string, source_file string, ocr_applied boolean",
    "review_decisions": "audit_id string, timestamp timestamp, reviewer string, action string, record_type string, nas string, track string, code string, confidence_tier_assigned string, review_note string, layer string, translation_id string",
    "artifacts": "nas string, position int, institution string, accession_number string, license string, confidence_tier string, caption_en string, caption_ru string, view_url string, asset_path string, status string",
    "manifests": "tradition string, manuscript_layer string, living_tradition boolean, public_release boolean, pipeline_run_ids array<string>, checksums map<string,string>",
    "structure_divisions": "run_id string, heading_text string, slug_candidate string, char_start int, char_end int, confidence double, toc_detected boolean, toc_char_end int",
    "segments": "run_id string, nas string, passage_opening string, passage_text string, chunk_index int",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(DDL[name])
