"""Frequency of every distinct term: heavy-light aggregation.

Heavy terms, found in a first pass, are broadcast (their number is bounded) and counted into
exact arrays inside each task; only the other terms are shuffled. Both count tables are united."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import canon_tmi

HEAVY_ITEMS = 256  # bound of the broadcast
TALLY = "term string, n_occurrences bigint, n_records bigint"


def term_counts(records: DataFrame, key: str, terms: str, canon=None, heavy_items: int = HEAVY_ITEMS) -> DataFrame:
    """(term, n_occurrences, n_records) over all records.

    A record counts once however often its row is repeated (rows of equal key: one of them is
    taken, the first in the order of its array). A term twice in one array occurs twice in one
    record. Null arrays, null, empty and blank terms count nothing. Which terms are held to be
    heavy changes the work, never the counts. No rows give no terms; other columns are dropped."""
    canon = canon or (lambda c: F.when(F.trim(c) == "", None).otherwise(c))
    one = records.groupBy(F.col(key).alias("k")).agg(F.min(F.col(terms)).alias("raw"))
    # a row for each distinct term of a record, with its occurrences there
    arr = F.filter(F.transform("raw", canon), lambda x: x.isNotNull())
    rows = one.select(F.explode(arr).alias("term"), F.col("k"))
    per_task = rows.select("term")
    found = per_task.agg(F.expr(f"approx_top_k(term, {heavy_items}, {heavy_items * 32})").alias("top"))
    top = found.select(F.explode("top")).select("col.item").filter("item is not null").collect()  # at most heavy_items terms
    heavy = sorted({r[0] for r in top})
    index = pa.array(heavy, pa.string())
    lists = one.select(arr.alias("terms")).filter(F.size("terms") > 0)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occ, rec = np.zeros(len(heavy), np.int64), np.zeros(len(heavy), np.int64)
        for b in batches:
            col = b.column(0)
            values, parent = col.flatten(), pc.list_parent_indices(col).to_numpy()
            at = pc.index_in(values, value_set=index)
            is_heavy = at.is_valid().to_numpy(zero_copy_only=False)
            h = at.filter(at.is_valid()).to_numpy(zero_copy_only=False).astype(np.int64)
            occ += np.bincount(h, minlength=len(heavy))
            pairs = np.unique(parent[is_heavy].astype(np.int64) * max(1, len(heavy)) + h)
            rec += np.bincount(pairs % max(1, len(heavy)), minlength=len(heavy))
            light = values.filter(pa.array(~is_heavy))
            if len(light):
                t = pa.table({"r": parent[~is_heavy], "term": light}).group_by(["r", "term"]).aggregate([([], "count_all")])
                t = t.group_by("term").aggregate([("count_all", "sum"), ("count_all", "count")])
                cols = [t["term"], t["count_all_sum"], t["count_all_count"]]
                for x in pa.table(cols, names=["term", "n_occurrences", "n_records"]).combine_chunks().to_batches():
                    yield x
        some = rec > 0
        if some.any():
            yield pa.RecordBatch.from_arrays([index.filter(pa.array(some)), pa.array(occ[some]), pa.array(rec[some])], ["term", "n_occurrences", "n_records"])

    # the union of both tables, each term from one of them: a row a task for the heavy terms, the rest shuffled
    sums = [F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_records").alias("n_records")]
    return lists.mapInArrow(tally, TALLY).groupBy("term").agg(*sums)


def mark(counts: DataFrame, n_records: int, rare_below: int = 3, common_above: float = 0.1) -> DataFrame:
    """Adds ``mark``: ``rare`` in fewer than ``rare_below`` records, ``common`` in more than that share, else null."""
    common = F.col("n_records") > F.lit(n_records * common_above)
    return counts.withColumn("mark", F.when(F.col("n_records") < rare_below, "rare").when(common, "common"))


def motif_counts(features: DataFrame, rare_below: int = 3, common_above: float = 0.1) -> DataFrame:
    """Motif codes of all feature records, every spelling as one code, with marks.

    The share of ``common`` is of all records, those without codes included."""
    total = features.agg(F.countDistinct("feature_id")).first()[0]  # one number
    counts = term_counts(features, "feature_id", "tmi_codes", canon_tmi)
    return mark(counts, total, rare_below, common_above).withColumnRenamed("term", "tmi_code")
