"""Integrity rules: each a query that gives violations (rule_id, severity, record_id, nas, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import TMI_VALID, nas_depth, nas_parent, nas_valid
from ..functions.text import complete, hedged
from ..model.enums import REVIEW_ACTIONS


def _row(df: DataFrame, rule: str, key: str, detail: Column, severity: str = "error") -> DataFrame:
    return df.select(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), F.col(key).cast("string").alias("record_id"), F.col("nas"), detail.cast("string").alias("detail"))


def _lacuna(nas: Column) -> Column:
    return F.exists(F.split(nas, "/"), lambda x: F.startswith(x, F.lit("lacuna")))


def _checked(df: DataFrame, key: str, checks: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """Violations of several rules in one pass over the rows: (rule, severity, condition, detail) each."""
    hits = F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), detail.cast("string").alias("detail"))) for rule, severity, bad, detail in checks))
    rows = df.select(F.col(key).cast("string").alias("record_id"), "nas", F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("x"))
    return rows.select("x.rule_id", "x.severity", "record_id", "nas", "x.detail")


def _marked(df: DataFrame, other: DataFrame, column: str, name: str) -> DataFrame:
    """Adds whether a column's value is among the other's addresses."""
    o = other.select(F.col("nas").alias(f"_{name}")).filter(F.col(f"_{name}").isNotNull()).distinct()
    return df.join(o, F.col(column) == F.col(f"_{name}"), "left").withColumn(name, F.col(f"_{name}").isNotNull()).drop(f"_{name}")


def address_rules(confirmed: DataFrame, fragments: DataFrame) -> list[DataFrame]:
    """V1 well-formed confirmed addresses, V9 each with a fragment, V10 units with a confirmed parent."""
    ok = nas_valid(F.col("nas"))
    c = _marked(confirmed.withColumn("_up", nas_parent(F.col("nas"))), fragments, "nas", "_there")
    c = _marked(c, confirmed.filter(ok), "_up", "_known")
    return [_checked(c, "ordinal", [("V1", "error", ~ok, F.col("nas")), ("V9", "error", ok & ~F.col("_there"), F.col("nas")), ("V10", "error", ok & (nas_depth(F.col("nas")) == 4) & ~F.col("_known"), F.col("_up"))])]


def fragment_rules(fragments: DataFrame, confirmed: DataFrame) -> list[DataFrame]:
    """V2 well-formed and, where any are confirmed, confirmed; V14 a fit note needs a warning."""
    known = confirmed.filter(nas_valid(F.col("nas")))
    some = bool(known.take(1))
    ok = nas_valid(F.col("nas"))
    f = _marked(fragments, known, "nas", "_known")
    note = F.col("methodology_fit_note")
    return [_checked(f, "fragment_id", [
        ("V2", "error", ~ok, F.lit("invalid")), ("V2", "error", ok & ~F.col("_known") & F.lit(some), F.lit("unconfirmed")),
        ("V14", "error", note.isNotNull() & (note != "") & ~F.coalesce("methodology_fit_warning", F.lit(False)), note),
    ])]


def content_rules(content: DataFrame) -> list[DataFrame]:
    """V3-V5 tiers of generated content, V6 whole bodies, V7 hedging (a warning), V18 new rows unreviewed.

    ``content``: content_id, nas, layer, body, status, confidence_tier, ai_generated, reviewed_by."""
    ai, surface = F.coalesce("ai_generated", F.lit(False)), F.coalesce(F.col("layer") == "surface", F.lit(False))
    tier = F.coalesce("confidence_tier", F.lit(""))
    candidate, confirmed = F.col("status") == "candidate", F.col("status") == "confirmed"
    body = F.coalesce("body", F.lit(""))
    shown = F.regexp_replace(F.regexp_replace(body, r"\[NAS:[^\]]*\]", ""), r"\s+", "") != ""
    whole = F.regexp_replace(body, r"\s+", "") != ""
    return [_checked(content, "content_id", [
        ("V3", "error", ai & (tier == "documented"), tier), ("V4", "error", ai & surface & candidate & (tier != "inspired"), tier), ("V5", "error", ai & surface & confirmed & (tier == "inspired"), tier),
        ("V6", "error", surface & confirmed & whole & ~complete(body), F.lit("truncated")), ("V7", "warning", surface & confirmed & _lacuna(F.col("nas")) & shown & ~hedged(body), F.lit("unhedged")),
        ("V18", "error", ai & candidate & F.col("reviewed_by").isNotNull(), F.col("reviewed_by")),
    ])]


def citation_rule(content: DataFrame) -> DataFrame:
    """V8: every grounding citation well-formed as it stands."""
    c = content.select("content_id", "nas", F.explode("grounding_citations").alias("cite")).distinct()
    return _row(c.filter(~nas_valid(F.col("cite"))), "V8", "content_id", F.col("cite"))


def annotation_rules(annotations: DataFrame, confirmed: DataFrame, fragments: DataFrame) -> list[DataFrame]:
    """V11 the address is well-formed, else confirmed, else has a fragment; V12 code shape; V13 tier.

    ``raw_code`` is the code as stored."""
    j = _marked(_marked(annotations, confirmed.filter(nas_valid(F.col("nas"))), "nas", "_known"), fragments, "nas", "_there")
    why = F.when(~nas_valid(F.col("nas")), "invalid").when(~F.col("_known"), "unconfirmed").when(~F.col("_there"), "no fragment")
    live = F.coalesce(F.col("status") != "rejected", F.lit(True))
    return [_checked(j, "annotation_id", [
        ("V11", "error", why.isNotNull(), why), ("V12", "error", (F.col("track") == "tmi") & live & ~F.coalesce(F.col("raw_code"), F.lit("")).rlike(TMI_VALID), F.col("raw_code")),
        ("V13", "error", (F.col("status") == "confirmed") & (F.col("proposed_tier") == "inspired"), F.col("proposed_tier")),
    ])]


def version_rule(manifests: DataFrame, version: str = "0.1") -> DataFrame:
    """The stamped version, where there is one."""
    m = manifests.filter((F.col("version") != "") & (F.col("version") != version))
    return m.select(F.lit("V15").alias("rule_id"), F.lit("error").alias("severity"), F.col("tradition").alias("record_id"), F.lit(None).cast("string").alias("nas"), F.col("version").alias("detail"))


def decision_rules(decisions: DataFrame) -> list[DataFrame]:
    """V16 known actions, V17 confirmed surface summaries at reconstructed, V20 a confirmation names a tier, annotations not inspired."""
    tier = F.col("confidence_tier_assigned")
    summary = (F.col("record_type") == "summary") & (F.col("layer").isNull() | (F.col("layer") == "surface"))
    confirms = F.col("action").isin("confirmed", "modified_confirmed")
    return [
        _row(decisions.filter(~F.coalesce(F.col("action").isin(*REVIEW_ACTIONS), F.lit(False))), "V16", "audit_id", F.col("action")),
        _row(decisions.filter((F.col("action") == "confirmed") & summary & tier.isNotNull() & (tier != "reconstructed")), "V17", "audit_id", tier),
        _row(decisions.filter(confirms & (tier.isNull() | ((F.col("record_type") == "annotation") & (tier == "inspired")))), "V20", "audit_id", F.coalesce(tier, F.lit("none"))),
    ]


def proposal_rule(proposals: DataFrame) -> DataFrame:
    """A revised proposal names its new address."""
    p = proposals.filter("status = 'revised' and revised_nas is null").withColumn("nas", F.col("proposed_nas"))
    return _row(p, "V19", "proposed_nas", F.lit("no revised address"))


def range_rule(features: DataFrame) -> DataFrame:
    """Profile values within [0, 1]."""
    bad = F.coalesce(~F.col("polyphony").between(0, 1), F.lit(False)) | F.coalesce(~F.col("carnivalesque").between(0, 1), F.lit(False))
    return _row(features.filter(bad), "V21", "feature_id", F.concat_ws(",", "polyphony", "carnivalesque"))


def bounds_rule(df: DataFrame, key: Column, nas: Column, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """V21 for scores of edges and parallels: columns within their bounds; the detail names the column."""
    d = df.withColumn("_key", key).withColumn("nas", nas)
    return _checked(d, "_key", [("V21", "error", ~F.col(c).between(lo, hi), F.lit(c)) for c, (lo, hi) in bounds.items()])


def unique_rule(df: DataFrame, key: str, columns: list[str], where: str | None = None) -> DataFrame:
    """Q11: table constraints: key columns that occur more than once, under an optional condition."""
    g = (df.filter(where) if where else df).groupBy(*columns).agg(F.count("*").alias("k"), F.min(key).alias("first")).filter("k > 1")
    nas = F.col("nas") if "nas" in columns else F.lit(None).cast("string")
    return g.select(F.lit("Q11").alias("rule_id"), F.lit("error").alias("severity"), F.col("first").cast("string").alias("record_id"), nas.alias("nas"), F.col("k").cast("string").alias("detail"))


def witness_rule(reports: DataFrame, confirmed: DataFrame, incoming: DataFrame) -> DataFrame:
    """A second, different source into a tradition that has confirmed addresses.

    ``reports``: run_id, tradition, source_file, ingested_at; ``incoming``: tradition, source_file."""
    last = reports.groupBy("tradition").agg(F.max_by("source_file", F.struct("ingested_at", "run_id")).alias("held"))
    busy = confirmed.select(F.col("tradition_id").alias("tradition")).distinct()
    j = incoming.join(last, "tradition").join(busy, "tradition", "left_semi").filter("source_file <> held")
    return j.select(F.lit("V24").alias("rule_id"), F.lit("error").alias("severity"), F.col("source_file").alias("record_id"), F.lit(None).cast("string").alias("nas"), F.col("held").alias("detail"))


def extension_rules(proposals: DataFrame, confirmed: DataFrame, allowed: bool, living: bool) -> list[DataFrame]:
    """Sub-episode extension is allowed, not of a living tradition, under confirmed parents."""
    known = confirmed.select(F.col("nas").alias("x")).distinct()
    p = proposals.withColumn("nas", F.col("proposed_nas"))
    out = [_row(p.join(known, p.parent_nas == known.x, "left_anti"), "V25", "proposed_nas", F.col("parent_nas"))]
    if not allowed or living:
        out.append(_row(p, "V25", "proposed_nas", F.lit("not allowed" if not allowed else "living tradition")))
    return out


def union(rules: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def validate(confirmed: DataFrame, fragments: DataFrame, raw_fragments: DataFrame, content: DataFrame, raw_content: DataFrame, annotations: DataFrame, features: DataFrame) -> DataFrame:
    """All rules on stored tables in one violations table; the raw ones are as stored, spellings included."""
    return union([
        *address_rules(confirmed, fragments), *fragment_rules(raw_fragments, confirmed), *content_rules(content), citation_rule(raw_content), *annotation_rules(annotations, confirmed, fragments), range_rule(features),
    ])


def export_gate(violations: DataFrame, content: DataFrame, annotations: DataFrame) -> DataFrame:
    """Errors must be none, then unreviewed candidates; one row."""
    errors = violations.filter("severity = 'error'").agg(F.count("*").alias("n_errors"))
    c = content.agg(F.count_if(F.col("status") == "candidate").alias("n_content"))
    a = annotations.agg(F.count_if(F.col("status") == "candidate").alias("n_annotations"))
    one = errors.join(F.broadcast(c)).join(F.broadcast(a))  # one row each
    return one.withColumn("passes", (F.col("n_errors") == 0) & (F.col("n_content") + F.col("n_annotations") == 0))


def promotion_gate(audit: DataFrame, force: bool = False) -> bool:
    """No differences, or forced."""
    return force or not audit.take(1)


def enough_traditions(df: DataFrame, column: str = "tradition", least: int = 2) -> bool:
    """V26."""
    return len(df.select(column).distinct().limit(least).collect()) >= least
