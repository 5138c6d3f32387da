"""Structure of ingested texts: lines, headings, divisions, chunks, passages and taxonomy audits."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window as W

from ..functions.address import strip_ws
from ..functions.text import slugify
from ..model.enums import STRUCTURE_CONFIDENCE


def lines(df: DataFrame, key: str = "run_id", text: str = "text") -> DataFrame:
    """(key, line_no, line, char_start, char_end): every line with 0-based offsets, its break included."""
    parts = F.split(F.col(text), "\n", -1)
    n = F.size(parts)
    out = df.select(F.col(key), F.length(text).alias("_n"), n.alias("_k"), F.posexplode(parts).alias("line_no", "line"))
    size = F.length("line") + F.when(F.col("line_no") < F.col("_k") - 1, 1).otherwise(0)
    end = F.sum(size).over(W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0))
    out = out.withColumn("char_end", end.cast("int")).withColumn("char_start", (F.col("char_end") - size).cast("int"))
    return out.filter("char_end > char_start or line <> ''").select(key, "line_no", F.regexp_replace("line", r"\r$", "").alias("line"), "char_start", "char_end")


def boundary_patterns(signals: Column) -> Column:
    """Heading patterns of a map of lists; episode keywords are no headings."""
    return F.flatten(F.map_values(F.map_filter(signals, lambda k, v: k != "episode_keywords")))


def headings(ls: DataFrame, patterns: list[str]) -> DataFrame:
    """Lines that contain any pattern, as it is written."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.contains(strip_ws(F.col("line")), F.lit(p))
    return ls.filter((strip_ws(F.col("line")) != "") & hit)


def detect_toc(df: DataFrame, patterns: list[str], key: str = "run_id", text: str = "text", share: float = 0.2, most: int = 10_000, least: int = 5, gap: int = 150) -> DataFrame:
    """(key, toc_detected, toc_char_end): at least ``least`` headings close together within the first part of a text."""
    end = F.least(F.floor(F.length(text) * share), F.lit(most)).cast("int")
    window = df.select(key, F.substring(F.col(text), F.lit(1), end).alias("text"), end.alias("scan_end"))
    h = headings(lines(window, key), patterns).join(window, key)
    w = W.partitionBy(key).orderBy("char_start")
    between = F.substring(F.col("text"), F.col("char_end") + 1, F.lead("char_start").over(w) - F.col("char_end"))
    h = h.withColumn("gap", F.length(strip_ws(between)))
    g = h.groupBy(key).agg(F.count("*").alias("k"), F.avg("gap").alias("mean"), F.first("scan_end").alias("scan_end"))
    toc = g.select(key, ((F.col("k") >= least) & (F.coalesce("mean", F.lit(0.0)) < gap)).alias("toc_detected"), "scan_end")
    return df.select(key).join(toc, key, "left").select(key, F.coalesce("toc_detected", F.lit(False)).alias("toc_detected"), F.when(F.col("toc_detected"), F.col("scan_end")).otherwise(0).alias("toc_char_end"))


def scan_structure(df: DataFrame, patterns: list[str], key: str = "run_id", text: str = "text", source_type: str = "txt") -> DataFrame:
    """Divisions of every text: first heading of each slug behind a table of contents, each up to the next one."""
    if not patterns:
        return df.sparkSession.createDataFrame([], f"{key} {dict(df.dtypes)[key]}, heading_text string, slug_candidate string, char_start int, char_end int, confidence double, toc_detected boolean, toc_char_end int")
    toc = detect_toc(df, patterns, key, text)
    h = headings(lines(df, key, text), patterns).join(toc, key).filter("char_start >= toc_char_end")
    h = h.withColumn("heading_text", strip_ws(F.col("line"))).withColumn("slug_candidate", slugify(F.col("line"))).filter("slug_candidate <> ''")
    first = W.partitionBy(key, "slug_candidate").orderBy("char_start")
    h = h.withColumn("rn", F.row_number().over(first)).filter("rn = 1")
    size = df.select(key, F.length(text).alias("n"))
    end = F.coalesce(F.lead("char_start").over(W.partitionBy(key).orderBy("char_start")), F.col("n"))
    conf = STRUCTURE_CONFIDENCE.get(source_type, 0.7)
    return h.join(size, key).select(key, "heading_text", "slug_candidate", "char_start", end.alias("char_end"), F.lit(conf).alias("confidence"), "toc_detected", "toc_char_end")


def slice_text(text: Column, start: Column, end: Column, most: int = 4000) -> Column:
    return F.substring(text, start + 1, F.least(end - start, F.lit(most)))


def chunk_spans(text: str, budget: int = 40_000, overlap: int = 3_000, slack: int = 20_000) -> list[tuple[int, int]]:
    """Windows of at most ``budget`` characters that end at the last blank line of their last part and overlap."""
    spans, at = [], 0
    while True:
        end = min(at + budget, len(text))
        if end < len(text):
            blank = text.rfind("\n\n", max(at, at + budget - slack), end)
            end = blank if blank > at else end
        spans.append((at, end))
        if end >= len(text):
            return spans
        at = max(end - overlap, at + 1)


def chunks(df: DataFrame, key: str = "run_id", text: str = "text", budget: int = 40_000, overlap: int = 3_000, slack: int = 20_000) -> DataFrame:
    """(key, chunk_index, char_start, chunk): null texts give none; an empty one gives one empty chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, i, a, t[a:b]) for k, t in zip(pdf["k"], pdf["t"]) if t is not None for i, (a, b) in enumerate(chunk_spans(t, budget, overlap, slack))]
            yield pd.DataFrame(rows, columns=["k", "chunk_index", "char_start", "chunk"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, chunk_index int, char_start int, chunk string").withColumnRenamed("k", key)


def passages(segments: DataFrame, parts: DataFrame, by: list[str]) -> DataFrame:
    """Passage of every segment: from its opening, found by its first 80, 60, 40 or 20 characters, to the next found one.

    ``segments``: by, seq, nas, passage_opening; ``parts``: by, chunk. Of two at the same place the first gets '';
    those not found get '' and come last."""
    o = strip_ws(F.coalesce("passage_opening", F.lit("")))
    j = segments.join(parts.select(*by, "chunk"), by)
    pos = F.coalesce(*(F.expr(f"nullif(locate(substring(opening_, 1, {n}), chunk), 0)") for n in (80, 60, 40, 20)))
    j = j.withColumn("opening_", F.when(o == "", None).otherwise(o)).withColumn("pos", pos)
    w = W.partitionBy(*by).orderBy(F.asc_nulls_last("pos"), "seq")
    nxt = F.coalesce(F.lead("pos").over(w), F.length("chunk") + 1)
    text = F.when(F.col("pos").isNull(), "").otherwise(strip_ws(F.substring(F.col("chunk"), F.col("pos"), F.greatest(nxt - F.col("pos"), F.lit(0)))))
    return j.withColumn("passage_text", text).withColumn("passage_no", F.row_number().over(w)).select(*by, "seq", "nas", "pos", "passage_no", "passage_text")


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row of every key; blank keys are never merged."""
    blank = F.coalesce(F.col(key), F.lit("")) == ""
    w = W.partitionBy(key).orderBy(*order)
    named = df.filter(~blank).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return named.unionByName(df.filter(blank))


def derive_addresses(divisions: DataFrame) -> DataFrame:
    """Addresses of a generated taxonomy: tradition, division, ordinal, episode."""
    return divisions.filter("episode <> ''").select("tradition", "division", "ordinal", F.concat(F.lit("nms://"), "tradition", F.lit("/"), "division", F.lit("/"), "episode").alias("nas"))


def audit(confirmed: DataFrame, derived: DataFrame) -> DataFrame:
    """(type, confirmed_nas, derived_nas): same place and other slug, then what only one side has.

    Each side: ordinal, nas. Only addresses with an episode take part in the comparison by place."""

    def placed(df: DataFrame, name: str) -> DataFrame:
        parts = F.split("nas", "/")
        d = df.filter(F.size(parts) >= 5).withColumn("division", F.element_at(parts, 4))
        return d.withColumn("place", F.row_number().over(W.partitionBy("division").orderBy("ordinal"))).select("division", "place", F.col("nas").alias(name))

    pair = placed(confirmed, "c").join(placed(derived, "e"), ["division", "place"]).filter("c <> e")
    c0, d0 = confirmed.select("nas").distinct(), derived.select("nas").distinct()
    missing = c0.join(d0, "nas", "left_anti").join(pair.select(F.col("c").alias("nas")), "nas", "left_anti")
    new = d0.join(c0, "nas", "left_anti").join(pair.select(F.col("e").alias("nas")), "nas", "left_anti")
    none = F.lit(None).cast("string")
    return (
        pair.select(F.lit("slug_divergence").alias("type"), F.col("c").alias("confirmed_nas"), F.col("e").alias("derived_nas"))
        .unionByName(missing.select(F.lit("missing_in_source").alias("type"), F.col("nas").alias("confirmed_nas"), none.alias("derived_nas")))
        .unionByName(new.select(F.lit("new_in_source").alias("type"), none.alias("confirmed_nas"), F.col("nas").alias("derived_nas")))
    )


def extract_range(ls: DataFrame, ranges: DataFrame, chrome: str | None = None) -> DataFrame:
    """Lines of inclusive ranges (part, first, last; an open end is null), furniture dropped, blank runs squeezed.

    Neighbouring ranges may share a line, which then comes in both."""
    # the ranges are a hand-written list
    j = ls.join(F.broadcast(ranges), (ls.line_no + 1 >= ranges["first"]) & (ls.line_no + 1 <= F.coalesce(ranges["last"], F.lit(2**31 - 1))))
    if chrome:
        j = j.filter(~strip_ws(F.col("line")).rlike(chrome))
    blank = strip_ws(F.col("line")) == ""
    w = W.partitionBy("part").orderBy("line_no")
    return j.withColumn("_b", blank).withColumn("_p", F.lag("_b").over(w)).filter(~(F.col("_b") & F.coalesce("_p", F.lit(False)))).drop("_b", "_p")


#: Neighbouring functions and what they count for.
SUBSTITUTION = {("PROPP-1", "PROPP-2"): 1.0, ("PROPP-8", "PROPP-8A"): 1.5, ("PROPP-11", "PROPP-12"): 1.0, ("PROPP-15", "PROPP-16"): 1.0, ("PROPP-25", "PROPP-26"): 1.0, ("PROPP-29", "PROPP-30"): 1.0}


def local_alignment(a: list[str], b: list[str], opening: float = -0.5, extending: float = -0.1, mismatch: float = -1.0, match: float = 2.0) -> float:
    """Best local alignment of two code sequences with affine gaps, as a share of the best possible.

    An empty slot ('' or null) is unknown: against anything it counts 0, neither match nor mismatch."""
    if not len(a) or not len(b):
        return 0.0
    n = len(b)
    low = float("-inf")
    best, prev, gap_a = 0.0, [0.0] * (n + 1), [low] * (n + 1)
    for x in a:
        row, gap_b = [0.0] * (n + 1), low
        for j, y in enumerate(b, 1):
            s = 0.0 if not x or not y else match if x == y else SUBSTITUTION.get((x, y), SUBSTITUTION.get((y, x), mismatch))
            gap_a[j] = max(prev[j] + opening, gap_a[j] + extending)
            gap_b = max(row[j - 1] + opening, gap_b + extending)
            row[j] = max(0.0, prev[j - 1] + s, gap_a[j], gap_b)
            best = max(best, row[j])
        prev = row
    return best / (min(len(a), n) * match)


@F.pandas_udf(DoubleType())
def align_codes(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0.0 if x is None or y is None else local_alignment(list(x), list(y)) for x, y in zip(a, b)])
