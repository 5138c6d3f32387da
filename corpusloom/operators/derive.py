"""Derived artifacts of confirmed annotations: code sets, frequencies, sequences and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import tier_rank
from ..model.enums import PROFILE
from ..session import cut, shuffle_parts


def confirmed(annotations: DataFrame, track: str | None = None) -> DataFrame:
    out = annotations.filter("status = 'confirmed'")
    return out.filter(F.col("track") == track) if track else out


def code_sets(addresses: DataFrame, annotations: DataFrame, track: str = "tmi") -> DataFrame:
    """(nas, codes): distinct confirmed codes, sorted; an address without any keeps an empty array."""
    got = confirmed(annotations, track).groupBy("nas").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return addresses.select("nas").distinct().join(got, "nas", "left").select("nas", F.coalesce("codes", F.array().cast("array<string>")).alias("codes"))


def code_frequency(sets: DataFrame) -> DataFrame:
    """(code, n): fragments of each code; ordering is (-n, code)."""
    return sets.select("nas", F.explode("codes").alias("code")).groupBy("code").agg(F.countDistinct("nas").alias("n"))


def frequency_totals(sets: DataFrame) -> DataFrame:
    return sets.agg(F.count("*").alias("total_fragments"), F.count_if(F.size("codes") > 0).alias("total_annotated_fragments"))


def stop_codes(sets: DataFrame, share: float = 0.3) -> DataFrame:
    """Codes in strictly more than that share of all fragments, lacunae and unannotated ones included."""
    n = sets.agg(F.count("*")).first()[0]
    return code_frequency(sets).filter(F.col("n") > F.lit(share) * n).select("code")


def best_annotations(annotations: DataFrame, by: list[str]) -> DataFrame:
    """One annotation each: strongest tier, then first position, then id."""
    order = F.struct(tier_rank(F.col("proposed_tier")).alias("r"), F.col("position").alias("p"), F.col("annotation_id").alias("i"))
    return annotations.groupBy(*by).agg(F.min_by("code", order).alias("code"), F.min(order).alias("o")).select(*by, "code")


def ranges(df: DataFrame, part: str, order: list[str], carry: list[str]) -> tuple[DataFrame, list]:
    """Rows cut by ranges of (part, order), with their range, and a row a range and part: its first and last carried values.

    So no task holds a whole part, however many rows it has; the ends of the ranges tell what lies across their borders."""
    n = shuffle_parts(df.sparkSession)
    d = cut(df.repartitionByRange(n, part, *order).withColumn("_range", F.spark_partition_id()))
    at = F.struct(*order)
    ends = d.groupBy("_range", part).agg(F.min_by(F.struct(*carry), at).alias("first"), F.max_by(F.struct(*carry), at).alias("last"), F.count("*").alias("n"))
    return d, sorted(ends.collect(), key=lambda r: (r["_range"], r[part] is not None, r[part] or ""))  # two ends a range, and a row for each part within


def islands(df: DataFrame, part: str, order: str, value: str) -> DataFrame:
    """Adds ``island``: runs of equal values in order, numbered from 1 within the part.

    Rows are sorted range by range; what a range needs from those before it (the last value, the islands so far) is
    carried over, so one part that has a third of the rows is spread too."""
    order_by = [order, *([] if order == "nas" or "nas" not in df.columns else ["nas"])]
    d, ends = ranges(df, part, order_by, [value])
    w = W.partitionBy("_range", part).orderBy(*order_by)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    d = d.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    starts = {(r["_range"], r[part]): r["k"] for r in d.groupBy("_range", part).agg(F.max("island").alias("k")).collect()}  # as many rows as ``ends``
    shift, last, so_far = [], {}, {}
    for r in ends:
        p, before = r[part], so_far.get(r[part], 0)
        joined = p in last and last[p] == r["first"][0]
        shift.append((r["_range"], p, before - 1 if joined else before))
        so_far[p] = starts[r["_range"], p] + (before - 1 if joined else before)
        last[p] = r["last"][0]
    kind = dict(df.dtypes)[part]
    off = df.sparkSession.createDataFrame(shift, f"_r int, _p {kind}, _off bigint") if shift else df.sparkSession.createDataFrame([], f"_r int, _p {kind}, _off bigint")
    out = d.join(F.broadcast(off), (F.col("_range") == F.col("_r")) & F.col(part).eqNullSafe(F.col("_p")))
    return out.withColumn("island", (F.col("island") + F.col("_off")).cast("bigint")).drop("_new", "_range", "_r", "_p", "_off")


def neighbours(df: DataFrame, part: str, order: str, value: str) -> DataFrame:
    """Adds ``prev_`` and ``next_`` of a value in order within a part, range by range as ``islands``."""
    order_by = [order, *([] if value == order else [value])]
    d, ends = ranges(df, part, order_by, [value])
    w = W.partitionBy("_range", part).orderBy(*order_by)
    rows = []
    for i, r in enumerate(ends):
        before = next((x for x in reversed(ends[:i]) if x[part] == r[part]), None)
        after = next((x for x in ends[i + 1 :] if x[part] == r[part]), None)
        rows.append((r["_range"], r[part], before and before["last"][0], after and after["first"][0]))
    kinds = dict(df.dtypes)
    off = df.sparkSession.createDataFrame(rows, f"_r int, _p {kinds[part]}, _b {kinds[value]}, _a {kinds[value]}")
    d = d.withColumn("_prev", F.lag(value).over(w)).withColumn("_next", F.lead(value).over(w)).withColumn("_at", F.row_number().over(w)).withColumn("_n", F.count("*").over(W.partitionBy("_range", part)))
    out = d.join(F.broadcast(off), (F.col("_range") == F.col("_r")) & F.col(part).eqNullSafe(F.col("_p")))
    prev, nxt = F.when(F.col("_at") == 1, F.col("_b")).otherwise(F.col("_prev")), F.when(F.col("_at") == F.col("_n"), F.col("_a")).otherwise(F.col("_next"))
    return out.withColumn(f"prev_{value}", prev).withColumn(f"next_{value}", nxt).drop("_range", "_r", "_p", "_b", "_a", "_prev", "_next", "_at", "_n")


def sequences(addresses: DataFrame, best: DataFrame, gap: str | None) -> DataFrame:
    """(tradition_id, island, division, episodes, sequence, gaps, n, n_annotated), in narrative order.

    ``gap`` stands for an episode without code: '' or null, and stays in the sequence."""
    a = islands(addresses.select("tradition_id", "ordinal", "division", "nas"), "tradition_id", "ordinal", "division")
    j = a.join(best, "nas", "left")
    item = F.struct("ordinal", "nas", "code")
    got = j.groupBy("tradition_id", "island", "division").agg(F.array_sort(F.collect_list(item)).alias("x"), F.count("*").alias("n"), F.count("code").alias("n_annotated"))
    code = (lambda s: F.coalesce(s["code"], F.lit(gap))) if gap is not None else (lambda s: s["code"])
    return got.select(
        "tradition_id", "island", "division", F.transform("x", lambda s: s["nas"]).alias("episodes"), F.transform("x", code).alias("sequence"),
        F.transform(F.filter("x", lambda s: s["code"].isNull()), lambda s: s["nas"]).alias("gaps"), "n", "n_annotated",
    )


def profile_table(spark) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in PROFILE.items()], "code string, family string, value double, reading string")


def profiles(addresses: DataFrame, annotations: DataFrame) -> DataFrame:
    """Profile of every address: chronotope of the best non-dimension code, first mapped value of each family."""
    ann = confirmed(annotations, "bakhtin").join(F.broadcast(profile_table(annotations.sparkSession)), "code", "left")
    of = lambda family, c: F.min_by(c, F.when(F.col("family") == family, F.col("code")))
    order = F.when(F.col("family").isNull(), F.struct(tier_rank(F.col("proposed_tier")).alias("r"), F.col("position").alias("p"), F.col("annotation_id").alias("i")))
    got = ann.groupBy("nas").agg(
        F.min_by("code", order).alias("chronotope_type"), of("polyphony", "value").alias("polyphony"), of("carnivalesque", "value").alias("carnivalesque"),
        of("heteroglossia", "reading").alias("heteroglossia"), F.array_sort(F.collect_set("code")).alias("raw_codes"), F.count("*").alias("source_annotation_count"),
    )
    empty = F.array().cast("array<string>")
    return (
        addresses.select("nas").distinct().join(got, "nas", "left").withColumn("raw_codes", F.coalesce("raw_codes", empty)).na.fill(0, ["source_annotation_count"])
    )


def severest_note(df: DataFrame, by: list[str], tier: str, order: str) -> DataFrame:
    """Note of the weakest evidence among rows that warn and have a note; ties go to the first."""
    rank = F.when(F.col(tier).isNull(), 0).otherwise(tier_rank(F.col(tier), unknown=0))
    rows = df.filter("methodology_fit_warning and methodology_fit_note is not null and methodology_fit_note <> ''")
    return rows.groupBy(*by).agg(F.max_by("methodology_fit_note", F.struct(rank, -F.col(order))).alias("note"))
