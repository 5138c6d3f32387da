"""Life of the corpus: merges, review, translated editions, embeddings, export. Decisions and generated
rows come in as tables; nothing asks or calls out. Results are new tables: a table read is never overwritten."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.address import canon_tmi
from ..functions.text import CITED, clean_translated, sentences, uncited

CONTENT_KEY = ["nas", "locale", "layer", "translation_id"]


def not_in(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among the other's; null keys equal each other."""
    o = other.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    c = F.lit(True)
    for k in keys:
        c = c & df[k].eqNullSafe(o[f"_{k}"])
    return df.join(o, c, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old ones of their key; columns that one side lacks are null."""
    return not_in(old, new, keys).unionByName(new, allowMissingColumns=True)


def append_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """First write wins."""
    return old.unionByName(not_in(new, old, keys), allowMissingColumns=True)


def append_log(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def merge_proposals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old ones stay if they are final or not proposed again; the rest is replaced, each once."""
    final = old.filter("status in ('confirmed', 'revised')")
    fresh = not_in(new, final, ["proposed_nas"])
    rest = not_in(old.filter("status not in ('confirmed', 'revised')"), new, ["proposed_nas"])
    return final.unionByName(rest).unionByName(fresh, allowMissingColumns=True)


def layers(content: DataFrame, only: str = "status <> 'rejected'", order: str = "content_id") -> DataFrame:
    """(nas, layers): distinct layers in first-seen order."""
    g = content.filter(only).groupBy("nas", "layer").agg(F.min(order).alias("o"))
    return g.groupBy("nas").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "layer"))), lambda s: s["layer"]).alias("layers"))


def strip_edition(content: DataFrame, locale: str, layer: str, translation_id: str) -> DataFrame:
    """All rows but those of one edition; layers are recomputed with ``layers``."""
    hit = (F.col("locale") == locale) & (F.col("layer") == layer) & (F.col("translation_id") == translation_id)
    return content.filter(~F.coalesce(hit, F.lit(False)))


def review_queue(content: DataFrame, annotations: DataFrame, kind: str | None = None, locale: str | None = None) -> DataFrame:
    """(record_type, record_id, nas, locale, layer, track, code): candidates; a kind or locale keeps its own."""
    none = F.lit(None).cast("string")
    c = content.filter("status = 'candidate'").select(
        F.when(F.col("layer") == "surface", "summary").otherwise(F.col("layer")).alias("record_type"), F.col("content_id").alias("record_id"), "nas", "locale", "layer", none.alias("track"), none.alias("code")
    )
    a = annotations.filter("status = 'candidate'").select(
        F.lit("annotation").alias("record_type"), F.col("annotation_id").alias("record_id"), "nas", none.alias("locale"), none.alias("layer"), "track", "code"
    )
    q = (c.filter(F.col("locale") == locale) if locale else c).unionByName(a)
    return q.filter(F.col("record_type") == kind) if kind else q


def apply_decisions(content: DataFrame, decisions: DataFrame) -> DataFrame:
    """Content with decided status, tier and, for a modification, the edited body.

    ``decisions``: nas, locale, layer, translation_id, action, confidence_tier_assigned, body. Only the first candidate
    of a key changes; a deferral changes nothing."""
    d = decisions.filter("action in ('confirmed', 'rejected', 'modified_confirmed')").dropDuplicates(CONTENT_KEY)
    d = d.select(*(F.col(k).alias(f"_{k}") for k in CONTENT_KEY), F.col("action").alias("_action"), F.col("confidence_tier_assigned").alias("_tier"), F.col("body").alias("_body"))
    w = W.partitionBy(*CONTENT_KEY, "status").orderBy("content_id")
    c = content.withColumn("_rn", F.row_number().over(w))
    on = F.lit(True)
    for k in CONTENT_KEY:
        on = on & c[k].eqNullSafe(d[f"_{k}"])
    j = c.join(d, on & (c["status"] == "candidate") & (c["_rn"] == 1), "left")
    hit = F.col("_action").isNotNull()
    good = F.col("_action").isin("confirmed", "modified_confirmed")
    j = j.withColumn("status", F.when(hit & good, "confirmed").when(hit, "rejected").otherwise(F.col("status")))
    j = j.withColumn("confidence_tier", F.when(hit & good, F.coalesce("_tier", "confidence_tier")).otherwise(F.col("confidence_tier")))
    j = j.withColumn("body", F.when(F.col("_action") == "modified_confirmed", F.coalesce("_body", "body")).otherwise(F.col("body")))
    return j.select(*content.columns)


def auto_confirm(annotations: DataFrame, pattern: str) -> DataFrame:
    """Candidates whose code is of a family become confirmed."""
    return annotations.withColumn("status", F.when((F.col("status") == "candidate") & F.col("code").rlike(pattern), "confirmed").otherwise(F.col("status")))


def confirm_addresses(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Confirmed addresses of decided proposals: a revision gives its new address, a deferral nothing.

    ``decisions``: proposed_nas, action (confirmed, revised, deferred), revised_nas, confirmed_by, confirmed_at."""
    j = proposals.filter("status = 'proposed'").drop("revised_nas").join(decisions, "proposed_nas").filter("action in ('confirmed', 'revised')")
    nas = F.when(F.col("action") == "revised", F.col("revised_nas")).otherwise(F.col("proposed_nas"))
    return j.filter(nas.isNotNull()).select(nas.alias("nas"), "parent_nas", "tradition_id", "division", "episode", "granularity", "confirmed_by", "confirmed_at")


def collisions(proposals: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Proposals with ``collision_detected``: the address is confirmed already."""
    known = confirmed.select(F.col("nas").alias("_k")).distinct().withColumn("_c", F.lit(True))
    return proposals.drop("collision_detected").join(known, F.col("proposed_nas") == F.col("_k"), "left").withColumn("collision_detected", F.coalesce("_c", F.lit(False))).drop("_k", "_c")


def passage_of(addresses: DataFrame, segments: DataFrame) -> DataFrame:
    """(nas, passage_text): by address, else by division and episode; blank text falls through."""
    solid = segments.filter(F.col("passage_text").rlike(r"\S"))
    by_nas = solid.groupBy("nas").agg(F.max_by("passage_text", F.struct("run_id", "passage_text")).alias("t1"))
    by_place = solid.groupBy("division", "episode").agg(F.max_by("passage_text", F.struct("run_id", "passage_text")).alias("t2"))
    j = addresses.join(by_nas, "nas", "left").join(by_place, ["division", "episode"], "left")
    return j.select("nas", F.coalesce("t1", "t2").alias("passage_text"))


def witnesses(addresses: DataFrame, segments: DataFrame) -> DataFrame:
    """(nas, label, passage_text): all runs' passages of an address; by place only where none has the address."""
    hit = addresses.select("nas", "division", "episode").join(segments.select("nas", "label", "passage_text"), "nas").select("nas", "label", "passage_text")
    rest = addresses.join(segments.select("nas").distinct(), "nas", "left_anti").select("nas", "division", "episode")
    back = rest.join(segments.select("division", "episode", "label", "passage_text"), ["division", "episode"]).select("nas", "label", "passage_text")
    return hit.unionByName(back)


def emit_translated(passages: DataFrame, content: DataFrame, edition: dict) -> DataFrame:
    """New content rows of an edition for passages that have none of it yet: cleaned, documented, candidate, not generated."""
    p = passages.filter(F.col("passage_text").rlike(r"\S")).select(
        "nas", F.lit(edition["locale"]).alias("locale"), F.lit("translated").alias("layer"), F.lit(edition["id"]).alias("translation_id"), clean_translated(F.col("passage_text")).alias("body"),
        F.lit("candidate").alias("status"), F.lit("documented").alias("confidence_tier"), F.lit(False).alias("ai_generated"), F.lit(edition.get("author")).alias("translation_author"),
        F.lit(edition.get("year")).cast("int").alias("translation_year"), F.lit(edition.get("license")).alias("translation_license"),
    )
    return not_in(p, content, CONTENT_KEY)


def clean_editions(content: DataFrame) -> DataFrame:
    """Translated rows that cleaning changes, cleaned."""
    c = content.filter("layer = 'translated'").withColumn("_b", clean_translated(F.col("body")))
    return c.filter("_b <> body").withColumn("body", F.col("_b")).drop("_b")


def to_embed(content: DataFrame, embeddings: DataFrame, model: str, layers_: list[str], locales: list[str]) -> DataFrame:
    """Confirmed, non-blank bodies of these layers and locales whose (hash, model) has no vector yet."""
    c = content.filter(F.col("layer").isin(layers_) & F.col("locale").isin(locales) & (F.col("status") == "confirmed") & F.col("body").rlike(r"\S"))
    c = c.withColumn("content_hash", F.sha2("body", 256))
    have = embeddings.filter(F.col("model_version") == model).select("content_hash").distinct()
    return c.join(have, "content_hash", "left_anti")


def embed(todo: DataFrame, model: str, provider: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """Vectors of rows through an injected provider, a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = provider(pdf["body"].tolist())
            yield pdf.drop(columns=["body"]).assign(vector=v, dimension=[len(x) for x in v], model_version=model)

    cols = todo.select("nas", "locale", "layer", "translation_id", "content_hash", "body")
    schema = "nas string, locale string, layer string, translation_id string, content_hash string, vector array<double>, dimension int, model_version string"
    return cols.mapInPandas(run, schema)


def to_summarise(addresses: DataFrame, content: DataFrame, locales: list[str]) -> DataFrame:
    """(nas, locale) without a candidate or confirmed summary; needs division and episode."""
    want = addresses.filter("division <> '' and episode <> ''").select("nas", F.explode(F.array(*map(F.lit, locales))).alias("locale")).distinct()
    have = content.filter("layer = 'surface' and status in ('candidate', 'confirmed')").select("nas", "locale")
    return not_in(want, have, ["nas", "locale"])


def to_annotate(addresses: DataFrame, annotations: DataFrame, tracks: list[str], force: bool = False, processed: DataFrame | None = None) -> DataFrame:
    """(nas, track) without annotations, ``propp`` not for sub-episodes; forced ones only honour the processed mark."""
    want = addresses.select("nas", "granularity", F.explode(F.array(*map(F.lit, tracks))).alias("track")).distinct()
    want = want.filter(~((F.col("track") == "propp") & (F.coalesce("granularity", F.lit("")) == "sub-episode"))).select("nas", "track")
    if not force:
        return not_in(want, annotations, ["nas", "track"])
    return not_in(want, processed, ["nas", "track"]) if processed is not None else want


def merge_annotations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Confirmed ones first and kept; new candidates unless their code is confirmed there."""
    kept = old.filter("status = 'confirmed'")
    n = new.withColumn("code", F.when(F.col("track") == "tmi", canon_tmi(F.col("code"))).otherwise(F.trim("code")))
    return kept.unionByName(not_in(n, kept, ["nas", "track", "code"]), allowMissingColumns=True)


def grounding(content: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(content_id, n_sentences, n_uncited, grounded): a body passes unless too large a share of its sentences cites nothing."""
    marked = F.regexp_replace(F.regexp_replace("body", r"\[NAS: [^\]]+\]", CITED), r"nms://[a-z0-9-]+(/[a-z0-9-]+){1,3}", CITED)
    n, u = F.size(sentences(marked)), F.size(uncited(F.col("body")))
    return content.select("content_id", n.alias("n_sentences"), u.alias("n_uncited"), ((n == 0) | (u <= threshold * n)).alias("grounded"))


def generate(todo: DataFrame, provider: Callable[[dict], dict], schema: str) -> DataFrame:
    """Rows that an injected model makes of the input rows; deterministic stubs stand in where there is none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([provider(r) for r in pdf.to_dict("records")])

    return todo.mapInPandas(run, schema)


def checksums(files: DataFrame, but: str = "manifest.yaml") -> DataFrame:
    """(path, sha256) of binary files, by path; a file of that name is left out."""
    return files.filter(~F.endswith(F.col("path"), F.lit(f"/{but}"))).select("path", F.sha2("content", 256).alias("sha256"))


def export(df: DataFrame, path: str, kind: str = "json") -> None:
    """Writes a table as JSON, CSV or Parquet."""
    {"json": df.write.mode("overwrite").json, "csv": df.write.mode("overwrite").option("header", True).csv, "parquet": df.write.mode("overwrite").parquet}[kind](path)
