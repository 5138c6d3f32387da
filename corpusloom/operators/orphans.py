"""References to records that do not exist.

Parents are range-partitioned on their key and kept as one sorted array per range; batches
of references are routed to their range, salted where a range has many, and probed by
vectorised binary search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import canon_nas
from ..session import cut, shuffle_parts

REF_SCHEMA = "table_name string, record_id bigint, field_name string, ref_nas string, t timestamp_ntz"
PACK_SCHEMA = "lo string, keys array<string>, off array<int>, starts array<bigint>, ends array<bigint>"
NEVER = np.iinfo(np.int64).max


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All rows of one range, sorted by key: unique keys, offsets, validity intervals."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    pdf = pd.concat(parts, ignore_index=True)
    keys, first = np.unique(pdf["k"].to_numpy(object), return_index=True)
    yield pd.DataFrame(
        {
            "lo": [keys[0]],
            "keys": [list(keys)],
            "off": [[*first.tolist(), len(pdf)]],
            "starts": [pdf["s"].tolist()],
            "ends": [pdf["e"].tolist()],
        }
    )


def _probe(refs: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    """Reason for every reference of one batch, '' where the target is there."""
    k, t = refs["k"].to_numpy(object), refs["t_us"].to_numpy(np.int64)
    known_t = refs["t"].notna().to_numpy()
    if parents.empty:
        reason = np.full(len(refs), "missing", object)
    else:
        p = parents.iloc[0]
        keys = np.asarray(p["keys"], object)
        off, s, e = (np.asarray(p[c], np.int64) for c in ("off", "starts", "ends"))
        pos = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        there = keys[pos] == k
        reason = np.where(there, "", "missing").astype(object)
        lo, n = off[pos], off[pos + 1] - off[pos]
        alive = np.zeros(len(k), bool)
        before = np.zeros(len(k), bool)
        for j in range(int(n[there].max(initial=0))):  # intervals of one key; sorted within the range
            has = there & (j < n)
            i = np.where(has, lo + j, 0)
            began = has & (s[i] <= t)
            before |= began
            alive |= began & (e[i] > t)
        reason[there & known_t & ~alive & ~before] = "late"
        reason[there & known_t & ~alive & before] = "deleted"
    out = refs[["table_name", "record_id", "field_name", "k"]].rename(columns={"k": "ref_nas"})
    return out.assign(reason=reason, t=refs["t"])[reason != ""]


def find_orphans(refs: DataFrame, parents: DataFrame, rows_per_range: int = 50_000, rows_per_batch: int = 50_000) -> DataFrame:
    """References without a target at their time: table_name, record_id, field_name, ref_nas, reason, t.

    ``refs``: table_name, record_id, field_name, ref_nas (any spelling), t.
    ``parents``: nas (any spelling), start, end (null: open). A target serves at t if start <= t < end.
    ``missing``: no row for the key; ``late``: rows start only after t; ``deleted``: every row that
    began is over at t. Null references are no cases; a null t can only be ``missing``; a null start
    counts as from ever. Repeated references give one row. No parents: every reference is missing.
    Extra columns of either input are ignored."""
    spark = refs.sparkSession
    us = lambda c, null: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(int(null)))
    par = (
        parents.select(canon_nas(F.col("nas")).alias("k"), us("start", np.iinfo(np.int64).min).alias("s"), us("end", NEVER).alias("e"))
        .filter("k is not null")
        .distinct()
    )
    par = cut(par)
    n_ranges = max(1, par.count() // rows_per_range + 1)
    packed = cut(par.repartitionByRange(n_ranges, "k").sortWithinPartitions("k", "s", "e").mapInPandas(_pack, PACK_SCHEMA))
    # one lower bound a range: at most n_ranges strings
    bounds = sorted(r["lo"] for r in packed.select("lo").collect())

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        b = np.asarray(bounds, object)
        return pd.Series(np.maximum(np.searchsorted(b, k.to_numpy(object), side="right") - 1, 0).astype("int32"))

    r = refs.select(
        F.col("table_name"), F.col("record_id").cast("bigint").alias("record_id"), F.col("field_name"), canon_nas(F.col("ref_nas")).alias("k"), F.col("t")
    ).filter("k is not null")
    r = r.withColumn("t_us", us("t", 0)).withColumn("rid", range_of("k") if len(bounds) > 1 else F.lit(0))
    r = cut(r)  # counted by range first, then probed
    per_range = r.groupBy("rid").count().withColumn("salts", (F.col("count") / rows_per_batch).cast("int") + 1).drop("count")
    salts = F.broadcast(per_range)  # at most n_ranges rows
    r = r.join(salts, "rid").withColumn("salt", F.pmod(F.xxhash64("record_id", "k", "field_name"), F.col("salts")).cast("int")).drop("salts")
    if bounds:
        ids = spark.createDataFrame([(i, b) for i, b in enumerate(bounds)], "rid int, lo string")
        p = packed.join(F.broadcast(ids), "lo").join(salts, "rid").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts", "lo")
    else:
        p = spark.createDataFrame([], "rid int, salt int, keys array<string>, off array<int>, starts array<bigint>, ends array<bigint>")
    out = (
        r.groupBy("rid", "salt")
        .cogroup(p.groupBy("rid", "salt"))
        .applyInPandas(lambda a, b: _probe(a, b), "table_name string, record_id bigint, field_name string, ref_nas string, reason string, t timestamp_ntz")
    )
    return out.distinct()


def corpus_orphans(fragments: DataFrame, confirmed: DataFrame, content: DataFrame, annotations: DataFrame) -> DataFrame:
    """Orphans of the four reference fields of the fragment corpus, with ``t`` the record's time."""
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias("t")

    def refs(df: DataFrame, table: str, key: str, field: str, array: bool) -> DataFrame:
        value = F.explode(F.array_distinct(F.col(field))) if array else F.col(field)
        return df.select(F.lit(table).alias("table_name"), F.col(key).alias("record_id"), F.lit(field).alias("field_name"), value.alias("ref_nas"), ntz("recorded_at"))

    to_confirmed = refs(fragments, "fragments", "fragment_id", "nas", False).unionByName(refs(fragments, "fragments", "fragment_id", "parent_nas", False))
    to_fragments = refs(content, "fragment_content", "content_id", "grounding_citations", True).unionByName(
        refs(annotations, "annotations", "annotation_id", "evidence_citations", True)
    )
    a = find_orphans(to_confirmed, confirmed.select("nas", F.col("confirmed_at").alias("start"), F.lit(None).cast("timestamp_ntz").alias("end")))
    b = find_orphans(to_fragments, fragments.select("nas", F.col("recorded_at").alias("start"), F.col("deleted_at").alias("end")))
    return a.unionByName(b)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Number of orphan references per table, field, month of the record and reason."""
    return (
        orphans.withColumn("month", F.date_format(F.col("t"), "yyyy-MM"))
        .groupBy("table_name", "field_name", "month", "reason")
        .agg(F.count("*").alias("n_refs"))
    )
