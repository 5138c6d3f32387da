"""All similar pairs of set-valued records by pigeonhole partitioning.

First, with single values as the parts: of two sets similar at t, the n - ceil(t n) + 1 rarest values of each hold one of the
other's. Sets meet on these prefixes, on every value that few prefixes hold. A pair whose prefixes share only crowded
values has a crowded one in both prefixes, and only such sets meet by segments:

Two sets of sizes a <= b with intersection / union >= t differ in at most
H = (1-t)/(1+t)(a+b) values. Sizes fall into groups that grow by a factor, so that a set has few
partner groups and its signatures grow with its size; for a pair of groups the value universe is
hashed into m(H) segments. By the pigeonhole principle some segment differs in at most its share of H.
Equal segments and segments that differ in one value (one-deletion signatures) are joined on their hashes. The side that
probes chooses per segment whether to skip it, want it equal or allow one difference, so that
frequent signatures (values in a third of the records, empty segments) are avoided; the sum of
what it allows always covers H. Every candidate is verified on the sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.address import canon_propp, canon_tmi
from ..session import cut


def most_apart(a: int, b: int, t: float) -> int:
    """Most values in which sets of sizes a and b may differ at similarity t or more; -1: never similar."""
    need = int(np.ceil(t / (1 + t) * (a + b) - 1e-9))
    return a + b - 2 * need if need <= min(a, b) else -1


def n_segments(apart: int) -> int:
    return max(1, apart // 2 + 1) if apart < 2 else apart // 2 + 2


HOT, FREQUENT, SELDOM = 65_536, 8, (1, 1)  # values and signatures with counts that every task holds, from which count on, and what the others count as
CROWD = 4_096  # prefixes on one value beyond which its sets meet by segments instead, so that meetings grow as the sets do
GROWTH = 1.15  # by which the sizes of a group may differ


@lru_cache(None)
def group_of(size: int) -> tuple[int, int]:
    """Least and most size of the group of a size; small sizes are groups of their own."""
    low = 1
    while True:
        high = max(low, int(low * GROWTH))
        if size <= high:
            return low, high
        low = high + 1


@lru_cache(None)
def segments_of(small: tuple[int, int], large: tuple[int, int], t: float) -> tuple[int, bool]:
    """(segments, whether any value may differ) for a pair of groups: enough for the sizes that may differ most."""
    most = max(most_apart(a, b, t) for a in range(small[0], small[1] + 1) for b in range(max(a, large[0]), large[1] + 1))
    return n_segments(most), most > 0


@lru_cache(None)
def below(b: int, t: float) -> tuple[tuple[int, int], ...]:
    """Groups of sets that a set of size b may match as the larger one."""
    least, out, a = max(1, int(np.ceil(t * b - 1e-9))), [], b
    while a >= least:
        g = group_of(a)
        ok = [most_apart(x, b, t) for x in range(max(least, g[0]), min(b, g[1]) + 1)]
        if ok and max(ok) >= 0:
            out.append(g)
        a = g[0] - 1
    return tuple(out)


@lru_cache(None)
def above(a: int, t: float) -> tuple[tuple[tuple[int, int], int], ...]:
    """(group, most that differ) for the groups that a set of size a may match as the smaller one."""
    out, b = [], a
    while most_apart(a, b, t) >= 0:
        g = group_of(b)
        out.append((g, max(most_apart(a, x, t) for x in range(max(a, g[0]), g[1] + 1))))
        b = g[1] + 1
    return tuple(out)


def _h(*x) -> int:
    return xxhash.xxh64_intdigest(repr(x)) - (1 << 63)


def _segments(values: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """Sorted value hashes of each segment."""
    out: list[list[int]] = [[] for _ in range(m)]
    for v in values:
        out[(v >> 7) % m].append(v)
    return [tuple(x) for x in out]


def _variants(seg: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
    for i in range(len(seg)):
        yield seg[:i] + seg[i + 1 :]


def index_signatures(values: np.ndarray, t: float) -> Iterator[tuple[int, int]]:
    """(signature, kind) of a set as the larger one: kind 0 whole segments, 1 one-deletions."""
    mine = group_of(len(values))
    for g in below(len(values), t):
        m, differ = segments_of(g, mine, t)
        for i, seg in enumerate(_segments(values, m)):
            yield _h(g[0], mine[0], i, seg), 0
            if differ:
                for v in _variants(seg):
                    yield _h(g[0], mine[0], i, v), 1


def probe_signatures(values: np.ndarray, t: float, often: dict[int, tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(signature, kind, pick) of a set as the smaller one: for each partner group the cheapest segments that cover what
    may differ. kind 0: the whole segment; 1: its one-deletions, where one difference is allowed (pick 1).

    ``often``: counts of the frequent signatures (whole, deletions); others count as seldom."""
    mine = group_of(len(values))
    for g, apart in above(len(values), t):
        m, differ = segments_of(mine, g, t)
        sigs, cost0, cost1 = [], [], []
        for i, seg in enumerate(_segments(values, m)):
            whole = _h(mine[0], g[0], i, seg)
            cut_ = [_h(mine[0], g[0], i, v) for v in _variants(seg)] if differ else []
            sigs.append((whole, cut_))
            f0, f1 = often.get(whole, SELDOM)
            cost0.append(f0 + 1e-6)
            cost1.append(f1 + sum(sum(often.get(s, SELDOM)) for s in cut_) + 1e-6)
        for (whole, cut_), pick in zip(sigs, choose(apart, cost0, cost1)):
            if pick >= 0:
                yield whole, 0, pick
            if pick == 1:
                for s in cut_:
                    yield s, 1, 1


def choose(apart: int, cost0: list[float], cost1: list[float]) -> list[int]:
    """Differences allowed per segment (-1 skip, 0 equal, 1 one) of least cost whose (x+1) sum to apart+1."""
    need = apart + 1
    best: list[tuple[float, tuple[int, ...]]] = [(0.0, ())] + [(float("inf"), ())] * need
    for c0, c1 in zip(cost0, cost1):
        new = [(float("inf"), ())] * (need + 1)
        for have, (cost, picks) in enumerate(best):
            if cost == float("inf"):
                continue
            for pick, more, c in ((-1, 0, 0.0), (0, 1, c0), (1, 2, c0 + c1)):
                at = min(need, have + more)
                if cost + c < new[at][0]:
                    new[at] = (cost + c, (*picks, pick))
        best = new
    return list(best[need][1])


def similar_pairs(sets: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(rep_a, rep_b, similarity): pairs of different sets with intersection / union >= threshold.

    ``sets``: rep (bigint, unique), codes (sorted array of distinct strings, not empty), read several times: a table or a cut."""
    hashes = F.array_sort(F.transform("codes", lambda c: F.xxhash64(c)))
    base = sets.select("rep", "codes", F.size("codes").alias("n"))
    cand = _candidates(sets.select("rep", hashes.alias("hs")), threshold)
    a, b = (base.select(F.col("rep").alias(f"rep_{x}"), F.col("codes").alias(f"c_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    both = F.size(F.array_intersect("c_a", "c_b"))  # the codes themselves, not their hashes
    sim = both / (F.col("n_a") + F.col("n_b") - both)
    return cand.join(a, "rep_a").join(b, "rep_b").select("rep_a", "rep_b", sim.alias("similarity")).filter(F.col("similarity") >= threshold)


def prefix(values: list[int], t: float, often: dict[int, int]) -> list[int]:
    """The rarest values of a set, of which a similar set's rarest hold one; ``often``: counts of the frequent values.

    Any order of the values would do, as long as it is the same for all sets."""
    return sorted(values, key=lambda v: (often.get(v, 0), v))[: len(values) - int(np.ceil(t * len(values) - 1e-9)) + 1]


def _candidates(slim: DataFrame, threshold: float) -> DataFrame:
    """(rep_a, rep_b), each once: pairs of the sets (rep, hs: value hashes) among which are all similar ones."""
    freq = slim.select(F.explode("hs").alias("v")).groupBy("v").agg(F.count("*").alias("k")).filter(F.col("k") > FREQUENT)
    hot = freq.orderBy(F.desc("k"), "v").limit(HOT).collect()
    often = slim.sparkSession.sparkContext.broadcast({r["v"]: r["k"] for r in hot})
    crowd = CROWD

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r, hs in zip(pdf["rep"], pdf["hs"]):
                hs = [int(x) for x in hs]
                bits = 0
                for v in hs:
                    bits |= 1 << (v & 63)
                bits -= (bits >> 63) << 64
                rows += [(v, r, len(hs), bits, often.value.get(v, 0) > crowd) for v in prefix(hs, threshold, often.value)]
            yield pd.DataFrame(rows, columns=["v", "rep", "n", "bits", "big"])

    pre = cut(slim.mapInPandas(run, "v bigint, rep bigint, n int, bits bigint, big boolean"))
    # only frequent values can be crowded in prefixes; there are HOT of them at most
    crowded = [r["v"] for r in pre.filter("big").groupBy("v").agg(F.count("*").alias("k")).filter(F.col("k") > crowd).select("v").collect()]
    held = F.broadcast(slim.sparkSession.createDataFrame([(v,) for v in crowded], "v bigint"))
    few = (pre.join(held, "v", "left_anti") if crowded else pre).select("v", "rep", "n", "bits")
    other = few.select("v", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "bits")])
    total = F.col("n") + F.col("n_b")
    apart = total - 2 * F.ceil(threshold / (1 + threshold) * total - 1e-9)
    # a value that only one of two sets has may leave a bit that only one has, never more than one
    near = few.join(other.hint("merge"), "v").filter((F.col("rep") < F.col("rep_b")) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("bits_b"))) <= apart))
    cand = near.select(F.col("rep").alias("rep_a"), F.col("rep_b"))
    if crowded:
        dense = pre.join(held, "v", "left_semi").select("rep").distinct()
        cand = cand.unionByName(_by_segments(cut(slim.join(dense, "rep", "left_semi")), threshold))
    return cand.distinct()


def _by_segments(slim: DataFrame, threshold: float) -> DataFrame:
    """(rep_a, rep_b): candidates among the sets (rep, hs), by signatures of segments."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r, s, k) for r, hs in zip(pdf["rep"], pdf["hs"]) for s, k in index_signatures([int(x) for x in hs], threshold)]
            yield pd.DataFrame(rows, columns=["rep", "sig", "kind"])

    idx = cut(slim.mapInPandas(index, "rep bigint, sig bigint, kind int"))
    # what a signature costs is what it meets; only the frequent ones matter, and their number is bounded
    freq = idx.groupBy("sig").agg(F.count_if(F.col("kind") == 0).alias("f0"), F.count_if(F.col("kind") == 1).alias("f1")).filter(F.col("f0") + F.col("f1") > FREQUENT)
    hot = freq.orderBy(F.desc(F.col("f0") + F.col("f1")), "sig").limit(HOT).collect()
    often = slim.sparkSession.sparkContext.broadcast({r["sig"]: (r["f0"], r["f1"]) for r in hot})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r, *o) for r, hs in zip(pdf["rep"], pdf["hs"]) for o in probe_signatures([int(x) for x in hs], threshold, often.value)]
            yield pd.DataFrame(rows, columns=["rep", "sig", "pk", "pick"])

    chosen = slim.mapInPandas(probe, "rep bigint, sig bigint, pk int, pick int")
    i = idx.select(F.col("rep").alias("other"), "sig", F.col("kind").alias("ik"))
    # equal: whole on whole; one difference: also a deletion on a whole, and both deleted
    return (
        chosen.join(i.hint("merge"), "sig")
        .filter((F.col("rep") != F.col("other")) & (F.col("ik") <= F.col("pick")))
        .select(F.least("rep", "other").alias("rep_a"), F.greatest("rep", "other").alias("rep_b"))
    )


def canonical_sets(records: DataFrame, key: str = "feature_id") -> DataFrame:
    """(key, codes): a record's distinct canonical codes, sorted; one row a record. Records without codes stay out."""
    arr = lambda c, canon: F.coalesce(F.transform(c, canon), F.array().cast("array<string>"))
    codes = F.array_sort(F.array_distinct(F.filter(F.concat(arr("tmi_codes", canon_tmi), arr("propp_codes", canon_propp)), lambda x: x.isNotNull())))
    return records.select(F.col(key).alias("id"), codes.alias("codes")).filter(F.size("codes") > 0).groupBy("id").agg(F.min("codes").alias("codes"))


def classes(sets: DataFrame) -> DataFrame:
    """(id, rep, codes): equal sets share the least id as representative."""
    return sets.select("id", F.min("id").over(W.partitionBy("codes")).alias("rep"), "codes")


def similar_records(records: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(feature_id_a, feature_id_b): every pair of different records alike enough, a < b.

    Empty and null arrays, gaps and repeated rows: a record counts once with the codes it has, and
    records without any code pair with none. Pairs of different sets are found once between
    representatives and then carried to the records of their classes; nothing is lost or capped."""
    members = cut(classes(canonical_sets(records)))
    pairs = similar_pairs(members.filter("id = rep").select("rep", "codes"), threshold)
    m = members.select("id", "rep")
    left, right = (m.select(F.col("id").alias(f"id_{x}"), F.col("rep").alias(f"rep_{x}")) for x in "ab")
    apart = pairs.join(left, "rep_a").join(right, "rep_b").select("id_a", "id_b")
    same = left.join(right.withColumnRenamed("rep_b", "rep_a"), "rep_a").filter("id_a < id_b").select("id_a", "id_b")
    out = apart.unionByName(same)
    return out.select(F.least("id_a", "id_b").alias("feature_id_a"), F.greatest("id_a", "id_b").alias("feature_id_b"))


def set_classes(records: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(feature_id, class_id, n_links): the class of equal sets and the number of other classes it is similar to."""
    members = cut(classes(canonical_sets(records)))
    pairs = similar_pairs(members.filter("id = rep").select("rep", "codes"), threshold)
    ends = pairs.select(F.col("rep_a").alias("rep")).unionAll(pairs.select(F.col("rep_b").alias("rep")))
    links = ends.groupBy("rep").agg(F.count("*").alias("n_links"))
    return members.join(links, "rep", "left").select(F.col("id").alias("feature_id"), F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
