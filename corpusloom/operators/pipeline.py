"""Composed steps of the corpus's life: segmenting, summarising, annotating, export, and the lookups over their results.

Models are injected functions; deterministic stubs stand in where there is none."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.address import nas_depth, nas_parent, nas_part, nas_valid
from ..functions.text import CITED, citations, clean_citations, sentences, uncited
from ..session import cut
from . import corpus as C
from . import structure as S


def record_path(nas: Column, kind: str, *suffix: Column) -> Column:
    """the stored path of a record of an address, one to one; ``suffix`` parts are set after dots, nulls left out."""
    rest = F.array_join(F.slice(F.split(nas, "/"), 5, 2), "/")
    head = F.concat_ws("/", nas_part(nas, 3), F.lit(kind), nas_part(nas, 4), F.when(rest != "", rest))
    return F.concat_ws(".", head, *suffix, F.lit("yaml"))


def run_id(tradition: Column, at: Column) -> Column:
    """F38."""
    return F.concat_ws("-", F.lit("run"), tradition, F.date_format(at, "yyyyMMdd-HHmmss"))


def locale_phrase(locale: Column) -> Column:
    """how a model is told its language."""
    return F.when(locale == "en", "in English").when(locale == "ru", "in Russian").otherwise(F.concat(F.lit("in locale '"), locale, F.lit("'")))


def framework_text(codes: DataFrame) -> DataFrame:
    """(track, text) of definitions: track, section_no, heading (null: none), item_no, code, label, description."""
    line = F.concat(F.lit("  "), "code", F.lit(": "), "label", F.lit(" — "), F.coalesce("description", F.lit("")))
    head = F.when(F.col("heading").isNotNull() & (F.row_number().over(W.partitionBy("track", "section_no").orderBy("item_no")) == 1), F.concat(F.lit("\n"), "heading", F.lit(" codes:\n"))).otherwise("")
    rows = codes.withColumn("t", F.concat(head, line))
    g = rows.groupBy("track").agg(F.array_sort(F.collect_list(F.struct("section_no", "item_no", "t"))).alias("x"))
    return g.select("track", F.array_join(F.transform("x", lambda s: s["t"]), "\n").alias("text"))


def tracks(wanted: list[str], flags: dict[str, bool]) -> list[str]:
    """A track that stands behind a flag takes part only if that is on."""
    return [t for t in wanted if t != "campbell" or flags.get("campbell_track")]


def rules_of(active: DataFrame, generated: DataFrame, key: str = "tradition") -> DataFrame:
    """Active rules, else generated ones; ``unconfirmed`` marks those. A tradition with neither has no row."""
    back = generated.join(active.select(key), key, "left_anti")
    return active.withColumn("unconfirmed", F.lit(False)).unionByName(back.withColumn("unconfirmed", F.lit(True)))


def extended_parents(parents: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Parents that have confirmed units below them, by an equi-join on the units' parent address."""
    below = confirmed.filter(nas_depth(F.col("nas")) == 4).select(nas_parent(F.col("nas")).alias("nas")).distinct()
    return parents.select("nas").distinct().join(below, "nas", "left_semi")


def segment(texts: DataFrame, provider: Callable[[dict], list[dict]], confirmed: DataFrame, old: DataFrame, budget: int = 40_000, overlap: int = 3_000, slack: int = 20_000) -> DataFrame:
    """Proposals of texts (run_id, text): chunks, a segmenter for each, passages, the first of each address.

    ``provider``: a chunk's row to segments (nas, passage_opening, granularity, methodology_fit_warning). Invalid
    addresses and those of final old proposals (proposed_nas, status) are dropped; known ones are marked."""
    parts = cut(S.chunks(texts, "run_id", "text", budget, overlap, slack))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["run_id", "chunk_index", "seq", "nas", "passage_opening", "granularity", "methodology_fit_warning"]
        for pdf in batches:
            rows = [(r["run_id"], r["chunk_index"], i, s.get("nas"), s.get("passage_opening"), s.get("granularity", "episode"), bool(s.get("methodology_fit_warning"))) for r in pdf.to_dict("records") for i, s in enumerate(provider(r))]
            yield pd.DataFrame(rows, columns=cols)

    kind = dict(texts.dtypes)["run_id"]
    got = cut(parts.mapInPandas(run, f"run_id {kind}, chunk_index int, seq int, nas string, passage_opening string, granularity string, methodology_fit_warning boolean"))
    by = ["run_id", "chunk_index"]
    text = S.passages(got, parts, by).join(got.drop("nas", "passage_opening"), [*by, "seq"])
    text = text.filter(nas_valid(F.col("nas")))
    first = S.first_wins(text, "nas", ["chunk_index", "passage_no", "run_id"])
    final = old.filter("status in ('confirmed', 'revised')").select(F.col("proposed_nas").alias("nas"))
    fresh = first.join(final, "nas", "left_anti").withColumnRenamed("nas", "proposed_nas")
    return C.collisions(fresh, confirmed)


def segmentation_report(proposals: DataFrame, by: str = "run_id") -> DataFrame:
    """Proposals, collisions, fit warnings and lacunae."""
    return proposals.groupBy(by).agg(
        F.count("*").alias("segment_count"), F.count_if("collision_detected").alias("nas_collision_count"), F.count_if("methodology_fit_warning").alias("methodology_fit_warnings"),
        F.count_if(F.col("granularity") == "lacuna").alias("lacuna_count"),
    )


def is_grounded(body: Column, threshold: float = 0.3) -> Column:
    marked = F.regexp_replace(F.regexp_replace(body, r"\[NAS: [^\]]+\]", CITED), r"nms://[a-z0-9-]+(/[a-z0-9-]+){1,3}", CITED)
    n = F.size(sentences(marked))
    return (n == 0) | (F.size(uncited(body)) <= threshold * n)


def summarise(todo: DataFrame, provider: Callable[[dict, int], dict], attempts: int = 3, threshold: float = 0.3) -> DataFrame:
    """(nas, locale, body, grounding_citations, attempts, error_type) for what is to be summarised (nas, locale).

    ``provider``: a row and the attempt's number to (body, stop_reason). Truncated and ungrounded answers are asked for
    again; what never comes right has a null body and the last error."""
    out, rest = [], todo.select("nas", "locale")
    for k in range(1, attempts + 1):

        def run(batches: Iterator[pd.DataFrame], k=k) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                got = [provider(r, k) for r in pdf.to_dict("records")]
                yield pdf.assign(body=[g.get("body") for g in got], stop_reason=[g.get("stop_reason") for g in got])

        made = cut(rest.mapInPandas(run, "nas string, locale string, body string, stop_reason string"))
        error = F.when(F.col("stop_reason") == "max_tokens", "truncation_failure").when(F.col("body").isNull(), "generation_failure").when(~is_grounded(F.col("body"), threshold), "grounding_validation_failure")
        made = made.withColumn("error_type", error).withColumn("attempts", F.lit(k))
        out.append(made if k == attempts else made.filter("error_type is null or error_type = 'generation_failure'"))
        rest = made.filter("error_type is not null and error_type <> 'generation_failure'").select("nas", "locale")
    all_ = reduce(DataFrame.unionByName, out)
    body = F.when(F.col("error_type").isNull(), F.col("body"))
    return all_.select("nas", "locale", body.alias("body"), clean_citations(citations(body), F.col("nas")).alias("grounding_citations"), "attempts", "error_type")


def annotate(addresses: DataFrame, annotations: DataFrame, provider: Callable[[dict], list[dict]], wanted: list[str], flags: dict[str, bool], force: bool = False) -> DataFrame:
    """Annotations after a run: tracks to do, an annotator for each, canonical codes, merged under the confirmed ones.

    ``provider``: a row (nas, track) to candidates (code, label, proposed_tier); their order is their position."""
    todo = C.to_annotate(addresses, annotations, tracks(wanted, flags), force)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r["nas"], r["track"], i, x.get("code"), x.get("label"), x.get("proposed_tier"), "candidate") for r in pdf.to_dict("records") for i, x in enumerate(provider(r))]
            yield pd.DataFrame(rows, columns=["nas", "track", "position", "code", "label", "proposed_tier", "status"])

    new = todo.mapInPandas(run, "nas string, track string, position int, code string, label string, proposed_tier string, status string")
    redone = annotations.join(todo, ["nas", "track"], "left_semi")
    kept = annotations.join(todo, ["nas", "track"], "left_anti")
    return kept.unionByName(C.merge_annotations(redone, new), allowMissingColumns=True)


def upsert_translation(manifest: DataFrame, entry: DataFrame) -> DataFrame:
    """K4: editions of manifests (tradition, id, ...): an entry replaces the one of its tradition and id."""
    return C.upsert(manifest, entry, ["tradition", "id"])


def export_manifest(files: DataFrame, rules: DataFrame, version: str = "0.1", at: str | None = None) -> DataFrame:
    """(tradition, version, living_tradition, checksums) of exported files (tradition, path, content).

    Checksums are by path in its order, manifests left out; ``rules`` (tradition, living_tradition) mark living traditions."""
    sums = files.filter(~F.endswith(F.col("path"), F.lit("/manifest.yaml"))).select("tradition", "path", F.sha2("content", 256).alias("sha256"))
    g = sums.groupBy("tradition").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "sha256")))).alias("checksums"))
    living = rules.filter("living_tradition").select("tradition", F.lit(True).alias("living_tradition")).distinct()
    out = g.join(living, "tradition", "left").select("tradition", F.lit(version).alias("version"), F.coalesce("living_tradition", F.lit(False)).alias("living_tradition"), "checksums")
    return out.withColumn("export_timestamp", F.lit(at).cast("timestamp")) if at else out


def export_archive(df: DataFrame, path: str, allowed: bool, name: str = "tradition") -> None:
    """K8: the exported table under its tradition, once the gate (``integrity.export_gate``) lets it; compressed files, no archive of archives."""
    if not allowed:
        raise RuntimeError("export is blocked by errors or unreviewed candidates")
    df.write.mode("errorifexists").option("compression", "gzip").partitionBy(name).json(path)


def promote(audit: DataFrame, active: DataFrame, generated: DataFrame, tradition: str, force: bool = False) -> DataFrame:
    """Rules (tradition, ...) with the generated ones of a tradition in place of the active ones, if the audit is clean or forced."""
    if not force and audit.take(1):
        raise RuntimeError("the generated taxonomy differs from the confirmed one")
    return active.filter(F.col("tradition") != tradition).unionByName(generated.filter(F.col("tradition") == tradition))


def confirmed_parallels(parallels: DataFrame, confirmed: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """Q4: (nas, parallel_nas, parallel_score, note) of parallels above the threshold whose ends are confirmed, from either end.

    ``notes`` (J6): member_a, member_b, order, note; of a pair the first note counts."""
    p = parallels.filter("meets_threshold").select("member_a", "member_b", "parallel_score")
    known = confirmed.select("nas").distinct()
    p = p.join(known.withColumnRenamed("nas", "member_a"), "member_a", "left_semi").join(known.withColumnRenamed("nas", "member_b"), "member_b", "left_semi")
    if notes is not None:
        first = notes.groupBy("member_a", "member_b").agg(F.min_by("note", "order").alias("note"))
        p = p.join(first, ["member_a", "member_b"], "left")
    else:
        p = p.withColumn("note", F.lit(None).cast("string"))
    ends = [p.select(F.col(a).alias("nas"), F.col(b).alias("parallel_nas"), "parallel_score", "note") for a, b in (("member_a", "member_b"), ("member_b", "member_a"))]
    return ends[0].unionByName(ends[1])


def division_index(addresses: DataFrame, parallels: DataFrame) -> DataFrame:
    """Q7: (tradition_id, division, ordinal, nas, n_parallels): addresses in order with their parallels (nas, parallel_nas)."""
    n = parallels.groupBy("nas").agg(F.countDistinct("parallel_nas").alias("n"))
    return addresses.select("tradition_id", "division", "ordinal", "nas").join(n, "nas", "left").select("tradition_id", "division", "ordinal", "nas", F.coalesce("n", F.lit(0)).alias("n_parallels"))


def review_detail(queue: DataFrame, content: DataFrame, annotations: DataFrame) -> DataFrame:
    """Q8: the queue's records with what a reviewer reads: body or rationale, tier and citations' number."""
    c = content.select(F.col("content_id").alias("record_id"), F.col("body").alias("text"), F.col("confidence_tier").alias("tier"))
    a = annotations.select(F.col("annotation_id").alias("record_id"), F.col("label").alias("text"), F.col("proposed_tier").alias("tier"))
    is_note = F.col("record_type") == "annotation"
    return queue.filter(~is_note).join(c, "record_id", "left").unionByName(queue.filter(is_note).join(a, "record_id", "left"))


def audit_log(decisions: DataFrame, nas: str | None = None) -> DataFrame:
    """Q8: decisions in the order they were made, of one address or all."""
    d = decisions.filter(F.col("nas") == nas) if nas else decisions
    return d.withColumn("decision_no", F.row_number().over(W.partitionBy("nas").orderBy("decided_at", "audit_id")))


def without_back_matter(segments: DataFrame, signals: list[str], text: str = "passage_text") -> DataFrame:
    """Q17: segments whose first line is not one of the headings of notes, indexes and glossaries."""
    line = F.trim(F.element_at(F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\n"), 1))
    return segments.filter(~F.coalesce(F.regexp_replace(line, r"[\s.:]+$", "").isin(signals), F.lit(False)))
