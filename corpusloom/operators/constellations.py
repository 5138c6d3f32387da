"""Cross-tradition similarity: edges, components, candidates and scored pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.address import canon_propp, canon_tmi, nas_part, tmi_branch, tmi_root
from ..functions.text import cosine_units, cut_note, unit
from ..session import cut

EDGE = [
    "member_a", "member_b", "tradition_a", "tradition_b", "tmi_jaccard_leaf", "tmi_jaccard_branch", "tmi_jaccard_root", "propp_overlap", "chronotope_match",
    "qualifying_dimensions", "bakhtin_profile_available", "bakhtin_polyphony_delta", "bakhtin_carnivalesque_delta",
]


def stop_codes(df: DataFrame, share: float = 0.3) -> DataFrame:
    """Motif codes of strictly more than that share of all rows, lacunae and rows without codes included."""
    codes = F.array_distinct(F.filter(F.transform("tmi_codes", canon_tmi), lambda x: x.isNotNull()))
    counts = df.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(df.agg(F.count("*").alias("_all"))), F.col("n") > share * F.col("_all")).select("code")  # one row


def assemble(sets: DataFrame, sequences: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row an address from derived artifacts: the union of the keys of code sets, sequences and profiles; what is absent is empty or null.

    ``sets``: nas, codes; ``sequences``: episodes, sequence (gaps are '' or null); ``profiles``: nas, chronotope_type, polyphony, carnivalesque."""
    pair = F.explode(F.arrays_zip("episodes", "sequence")).alias("x")
    propp = sequences.select(pair).groupBy(F.col("x.episodes").alias("nas")).agg(F.collect_list(F.coalesce("x.sequence", F.lit(""))).alias("propp_codes"))
    empty = F.array().cast("array<string>")
    j = sets.select("nas", F.col("codes").alias("tmi_codes")).join(propp, "nas", "full_outer").join(profiles.select("nas", "chronotope_type", "polyphony", "carnivalesque"), "nas", "full_outer")
    return j.select("nas", nas_part(F.col("nas"), 3).alias("tradition"), F.coalesce("tmi_codes", empty).alias("tmi_codes"), F.coalesce("propp_codes", empty).alias("propp_codes"), "chronotope_type", "polyphony", "carnivalesque")


def features(df: DataFrame, stop_share: float | None = 0.3) -> DataFrame:
    """One row a fragment with its code sets by level; lacunae left out, gaps dropped, and so are motif codes that
    more than ``stop_share`` of all rows have (null: none are dropped)."""
    arr = lambda c, canon: F.array_distinct(F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), canon), lambda x: x.isNotNull()))
    f = df.filter(~F.contains(F.col("nas"), F.lit("/lacuna"))).select(
        "nas", "tradition", arr("tmi_codes", canon_tmi).alias("leaf"), arr("propp_codes", canon_propp).alias("propp"), "chronotope_type", "polyphony", "carnivalesque"
    )
    if stop_share is not None:
        # there are at most (codes a row) / share of them
        codes = [r[0] for r in stop_codes(df, stop_share).orderBy("code").collect()]
        if codes:
            f = f.withColumn("leaf", F.array_except("leaf", F.array(*map(F.lit, codes))))
    level = lambda key: F.array_distinct(F.filter(F.transform("leaf", key), lambda x: x.isNotNull()))
    return f.withColumn("branch", level(tmi_branch)).withColumn("root", level(tmi_root))


def _score(p: DataFrame, leaf: float, branch: float, propp: float, least: int, delta: float, keep: tuple[str, ...] = ()) -> DataFrame:
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    levels = ("leaf", "branch", "root", "propp")
    # a filter that depends on the row's number is not moved into the join, where the sets would be met again for each use
    s = p.select(
        a("nas").alias("member_a"), b("nas").alias("member_b"), a("tradition").alias("tradition_a"), b("tradition").alias("tradition_b"),
        *(F.size(F.array_intersect(a(c), b(c))).alias(f"n_{c}") for c in levels), *(F.size(x(c)).alias(f"n{n}_{c}") for c in levels for n, x in (("a", a), ("b", b))),
        F.coalesce(a("chronotope_type") == b("chronotope_type"), F.lit(False)).alias("chronotope_match"),
        (a("polyphony").isNotNull() & b("polyphony").isNotNull()).alias("bakhtin_profile_available"),
        F.bround(F.abs(a("polyphony") - b("polyphony")), 4).alias("bakhtin_polyphony_delta"),
        F.bround(F.abs(a("carnivalesque") - b("carnivalesque")), 4).alias("bakhtin_carnivalesque_delta"),
        *(x(c).alias(f"{c}_{n}") for c in keep for n, x in (("a", a), ("b", b))), F.monotonically_increasing_id().alias("_row"),
    )
    both, na, nb = (lambda c, i=i: F.col(f"n{i}_{c}") for i in ("", "a", "b"))
    share = lambda c, of: F.when((na(c) == 0) | (nb(c) == 0), 0.0).otherwise(both(c) / of)
    s = s.select("*", *(share(c, na(c) + nb(c) - both(c)).alias(f"tmi_jaccard_{c}") for c in levels[:3]), share("propp", F.greatest(na("propp"), nb("propp"))).alias("propp_overlap"))
    dims = [
        (F.col("tmi_jaccard_leaf") >= leaf) | (F.col("tmi_jaccard_branch") >= branch), F.col("propp_overlap") > propp, F.col("chronotope_match"),
        F.coalesce(F.col("bakhtin_polyphony_delta") < delta, F.lit(False)),
    ]
    s = s.withColumn("qualifying_dimensions", reduce(Column.__add__, [d.cast("int") for d in dims])).filter((F.col("_row") >= 0) & (F.col("qualifying_dimensions") >= least))
    for c in ("tmi_jaccard_leaf", "tmi_jaccard_branch", "tmi_jaccard_root", "propp_overlap"):
        s = s.withColumn(c, F.bround(c, 4))
    return s.select(*EDGE, *(f"{c}_{n}" for c in keep for n in "ab"))


def edges_theta(f: DataFrame, leaf: float = 0.1, branch: float = 0.25, propp: float = 0.0, least: int = 3, delta: float = 0.15, most: int = 20_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """All cross-tradition pairs scored, for reference on small inputs and where no key can block; larger ones are an error."""
    if f.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows, and thresholds that no key can block")
    on = F.col("a.tradition") < F.col("b.tradition")
    return _score(f.alias("a").join(f.alias("b"), on), leaf, branch, propp, least, delta, keep)


def _numbered(f: DataFrame) -> DataFrame:
    """Features whose codes and chronotopes are 64-bit hashes, which differ for all strings that occur: a seed with a collision is not used."""
    lists, odd = ("leaf", "branch", "root", "propp"), F.filter("leaf", lambda x: tmi_branch(x).isNull())
    f = cut(f.withColumn("odd", odd))
    codes = f.select(F.explode(F.concat(*lists, F.array("chronotope_type"))).alias("x")).filter("x is not null").distinct()
    for seed in range(8):
        number = partial(F.xxhash64, F.lit(seed))
        if not codes.groupBy(number("x")).count().filter("count > 1").take(1):
            chronotope = F.when(F.col("chronotope_type").isNotNull(), number("chronotope_type"))
            return f.withColumns({c: F.transform(c, lambda x: number(x)) for c in (*lists, "odd")} | {"chronotope_type": chronotope})
    raise RuntimeError("every seed makes two codes collide")


def edges(f: DataFrame, leaf: float = 0.1, branch: float = 0.25, propp: float = 0.0, least: int = 3, delta: float = 0.15, keep: tuple[str, ...] = ()) -> DataFrame:
    """Edges without pairing all: an edge agrees in ``least`` of the four dimensions, and each has a key on which two
    fragments that agree in it meet: motif branch (t), function code (p), chronotope (c), polyphony band (b). Of three
    dimensions an edge has three keys, so fragments meet in equi-joins on every three of the four (of fewer, on as many).

    A pair is scored where it meets, and only there: in the join on the first three keys that it has, at the least branch and
    function that it shares. So no pair is shuffled or compared with others. Polyphony bands are ``delta`` wide and meet
    their neighbours (those that occur), so any numbers are covered. member_a is of the tradition that comes first. With thresholds that let
    empty sets qualify no key blocks and ``edges_theta`` is used. ``keep``: columns of both ends to add, as name_a and name_b."""
    if least < 1 or leaf <= 0 or branch <= 0 or propp < 0:
        return edges_theta(f, leaf, branch, propp, least, delta, keep=keep)
    # a shared code means a shared branch, but for codes that have none
    base = _numbered(f).withColumns({"key_t": F.concat("branch", "odd"), "key_b": F.floor(F.col("polyphony") / delta).cast("int")}).drop("odd")
    key = {"t": "key_t", "p": "propp", "c": "chronotope_type", "b": "key_b"}
    bands = [r[0] for r in base.select("key_b").distinct().limit(1001).collect()]
    near_bands = F.array(*(F.col("key_b") + i for i in (-1, 0, 1)))
    if len(bands) < 1001:  # else a band that does not occur just meets none
        near_bands = F.filter(near_bands, lambda x: x.isin([x for x in bands if x is not None]))
    near = F.bround(F.abs(F.col("a.polyphony") - F.col("b.polyphony")), 4) < delta
    has = {"t": F.arrays_overlap("a.key_t", "b.key_t"), "p": F.arrays_overlap("a.propp", "b.propp"), "c": F.coalesce(F.col("a.chronotope_type") == F.col("b.chronotope_type"), F.lit(False)), "b": F.coalesce(near, F.lit(False))}
    width = min(least, 3)
    found, first = [], "tpcb"[: 4 - min(least, 4) + width]
    for keys in combinations(first, width):

        def side(n: str, keys=keys) -> DataFrame:
            x = base
            for k in keys:
                one = F.explode(key[k]) if k in "tp" else F.explode(near_bands) if k == "b" and n == "a" else F.col(key[k])
                x = x.withColumn(f"on_{k}", one)
            return x.dropna(subset=[f"on_{k}" for k in keys]).alias(n)

        lacks = [k for k in first[: first.index(keys[-1])] if k not in keys]
        rest = [has[k].cast("int") for k in "bc" if k not in keys and k not in lacks]  # those that cost little
        rest += [has[k].cast("int") for k in "pt" if k not in keys and k not in lacks]
        where = [F.col("a.tradition") < F.col("b.tradition")]
        if least > width:
            where.append(reduce(Column.__add__, rest) >= least - width)
        where += [has["b"]] if "b" in keys else []
        where += [~has[k] for k in lacks]
        where += [F.col(f"a.on_{k}") == F.array_min(F.array_intersect(f"a.{key[k]}", f"b.{key[k]}")) for k in keys if k in "tp"]
        met = side("a").join(side("b"), reduce(Column.__and__, [F.col(f"a.on_{k}") == F.col(f"b.on_{k}") for k in keys]))
        found.append(_score(met.filter(reduce(Column.__and__, where)), leaf, branch, propp, least, delta, keep))
    return reduce(DataFrame.unionByName, found)


FIGURES = ["tmi_jaccard_leaf", "tmi_jaccard_branch", "tmi_jaccard_root", "propp_overlap", "chronotope_match"]


def _forest(e: DataFrame, most: int = 200_000) -> DataFrame:
    """Of each task's edges (first two columns) those of a spanning forest, which connect what all of them connect.

    A task that has met ``most`` nodes starts a new forest, so what it holds is bounded."""
    kept = e.schema.names

    def run(batches):
        import pyarrow as pa

        up: dict[str, str] = {}

        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            held = []
            for i, (x, y) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if (a := root(x)) != (b := root(y)):
                    up[a] = b
                    held.append(i)
            if held:
                yield batch.select(kept).take(pa.array(held))
            if len(up) > most:
                up.clear()

    return e.mapInArrow(run, e.schema)


def _digest(e: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Edges read once and kept as rows of two kinds: those of spanning forests, and sums over a task's edges of one
    ``member_a`` (``member_b`` null), figures in units of their fourth digit."""
    sums = ["n", "dims", *FIGURES]
    names = ["member_a", "member_b", "tradition_a", "tradition_b", *sums]
    x = e.select(*names[:4], F.lit(1).cast("bigint").alias("n"), F.col("qualifying_dimensions").cast("bigint").alias("dims"), *(F.rint(F.col(c).cast("double") * 10_000).cast("bigint").alias(c) for c in FIGURES))

    def run(batches):
        import pyarrow as pa

        up: dict[str, str] = {}
        parts, rows = [], 0

        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        def merged():
            t = pa.concat_tables(parts).group_by("member_a").aggregate([(c, "sum") for c in sums])
            return pa.table({"member_a": t["member_a"]} | {c: t[f"{c}_sum"] for c in sums})

        def out(t):
            n = t.num_rows
            return pa.table([t[c] if c in t.column_names else pa.nulls(n, pa.int64() if c in sums else pa.string()) for c in names], names=names).to_batches()

        for batch in batches:
            held = []
            for i, (x, y) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if (a := root(x)) != (b := root(y)):
                    up[a] = b
                    held.append(i)
            t = pa.Table.from_batches([batch])
            if held:
                yield from out(t.select(names[:4]).take(pa.array(held)))
            if len(up) > most:
                up.clear()
            parts.append(pa.table({c: t[c] for c in ("member_a", *sums)}))  # with merged sums it has one schema only if no column is marked as without nulls
            rows += len(t)
            if rows > most:
                parts = [merged()]
                if (rows := parts[0].num_rows) > most // 2:
                    yield from out(parts[0])
                    parts, rows = [], 0
        if parts:
            yield from out(merged())

    return cut(x.mapInArrow(run, ", ".join(f"{c} {'bigint' if c in sums else 'string'}" for c in names)))


def components(pairs: DataFrame, a: str = "member_a", b: str = "member_b", rounds: int = 60) -> DataFrame:
    """(nas, component): the least member of each connected component, by alternating large and small stars.

    Tasks first leave out edges that close circles. Each round joins every node to the least of its neighbours; the number of rounds grows with the logarithm of a
    component's size, and labels that are not final after ``rounds`` are an error. Lineage is cut by written tables,
    so losing executors is harmless."""
    e = cut(_forest(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")))
    e = cut(_forest(e.coalesce(max(1, e.rdd.getNumPartitions() // 8))).distinct())
    mark = lambda x: tuple(x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = mark(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = mark(e)
        if now == was:
            return e.select(F.col("u").alias("nas"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("nas"), F.col("v").alias("component"))).distinct()
        was = now
    raise RuntimeError(f"components have not settled in {rounds} rounds")


def _members(e: DataFrame, c: DataFrame) -> DataFrame:
    e = e.filter("member_b is not null")
    m = e.select(F.col("member_a").alias("nas"), F.col("tradition_a").alias("tradition")).unionByName(e.select(F.col("member_b").alias("nas"), F.col("tradition_b").alias("tradition"))).distinct()
    return m.join(c, "nas")


def _ranked(e: DataFrame, c: DataFrame, oversized: int) -> DataFrame:
    """Components of two or more traditions with their figures, from ``_digest``, numbered; no members in the row."""
    m = _members(e, c).groupBy("component").agg(F.countDistinct("nas").alias("n_members"), F.countDistinct("tradition").alias("tradition_count"))
    total = e.filter("member_b is null").join(c.withColumnRenamed("nas", "member_a"), "member_a").groupBy("component").agg(*(F.sum(x).alias(x) for x in ("n", "dims", *FIGURES)))
    s = total.select(
        "component", F.col("n").alias("n_edges"), (F.col("dims") / F.col("n")).alias("mean_dims"), *(F.bround(F.col(x) / F.lit(10_000) / F.col("n"), 9).alias(x) for x in FIGURES)
    )
    primary = F.coalesce(*(F.when(F.col(x) == F.greatest(*FIGURES), F.lit(x)) for x in FIGURES))
    out = m.join(s, "component").filter("tradition_count >= 2").select(
        "component", "n_members", "tradition_count", "n_edges", (F.col("n_members") > oversized).alias("oversized"),
        F.when(F.col("mean_dims") >= 2.8, "very_high").when(F.col("mean_dims") >= 2.0, "high").otherwise("moderate").alias("dimensional_agreement"), primary.alias("primary_dimension"),
    )
    return number_rows(out, [F.desc("tradition_count"), F.desc("n_edges"), F.col("component")], "candidate_id", "C-%04d")


def candidates(e: DataFrame, notes: DataFrame | None = None, oversized: int = 20) -> DataFrame:
    """Components of two or more traditions, ranked; ``members`` joined by '|', for reading: ``candidate_members`` has them as rows.

    ``notes``: nas, track, note (null: a fixed phrase)."""
    e = _digest(e)
    c = cut(components(e.filter("member_b is not null")))
    out = _ranked(e, c, oversized)
    listed = c.groupBy("component").agg(F.array_join(F.array_sort(F.collect_set("nas")), "|").alias("members"))
    out = out.join(listed, "component")
    if notes is not None:
        text = F.concat(F.col("nas"), F.lit(" ["), F.col("track"), F.lit("]: "), F.coalesce("note", F.lit("methodology fit concern noted")))
        n = notes.join(c, "nas").groupBy("component").agg(F.array_sort(F.collect_list(F.struct("nas", "track", text.alias("t")))).alias("x"))
        out = out.join(n, "component", "left").withColumn("methodology_fit_note", cut_note(F.array_join(F.transform("x", lambda s: s["t"]), "\n"))).drop("x")
    return out.drop("component")


def candidate_members(e: DataFrame, oversized: int = 20) -> DataFrame:
    """(candidate_id, nas, tradition): a row a member, so that a component of any size is spread."""
    e = _digest(e)
    c = cut(components(e.filter("member_b is not null")))
    return _members(e, c).join(_ranked(e, c, oversized).select("component", "candidate_id"), "component").select("candidate_id", "nas", "tradition")


def pair_count(f: DataFrame) -> DataFrame:
    """Number of cross-tradition pairs without pairing: (N^2 - sum of squares) / 2."""
    per = f.groupBy("tradition").agg(F.count("*").alias("n"))
    return per.agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).cast("bigint").alias("n_pairs"))


SCORED = "member_a string, member_b string, tradition_a string, tradition_b string, cos double, k int, tmi double, propp double, chrono boolean, poly double"
BINS = "score double, n bigint, n_above bigint"


def _blocks(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _block_products(vectors: DataFrame, e: DataFrame, schema: str, make: Callable, block: int) -> DataFrame:
    """All cross-tradition pairs, a matrix product a pair of blocks: ``make`` gets the arrays of one and gives a table.

    Vectors go to blocks by hash; a vector is sent once for each other block, and edges to the block pair of their
    ends, so scored pairs are never shuffled. A task holds two blocks."""
    v = vectors.filter(~F.contains(F.col("nas"), F.lit("/lacuna"))).select("nas", "tradition", unit(F.col("vector")).alias("u"))
    n = max(1, v.count() // block + 1)
    ids = F.sequence(F.lit(0), F.lit(n - 1))
    left = v.withColumn("mine", _blocks("nas", n)).withColumn("other", F.explode(ids))
    left = left.select(F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"), "mine", "nas", "tradition", "u")
    a, b = _blocks("member_a", n), _blocks("member_b", n)
    right = e.select(
        F.least(a, b).alias("bi"), F.greatest(a, b).alias("bj"), "member_a", "member_b", F.col("qualifying_dimensions").cast("int").alias("k"), F.greatest(F.coalesce("tmi_jaccard_leaf", F.lit(0.0)), F.coalesce("tmi_jaccard_branch", F.lit(0.0))).alias("tmi"),
        F.col("propp_overlap").alias("propp"), F.col("chronotope_match").alias("chrono"), F.coalesce("bakhtin_polyphony_delta", F.lit(0.0)).alias("poly"),
    )

    def product(x, y):
        import numpy as np
        import pyarrow as pa

        empty = pa.Table.from_pylist([], schema=arrow)
        if not x.num_rows:
            return empty
        first = np.min(x["mine"].to_numpy())
        one = bool((x["mine"].to_numpy() == first).all())
        names, trad = x["nas"].combine_chunks(), x["tradition"].combine_chunks()
        code = trad.dictionary_encode()
        order = np.argsort(np.argsort(np.array(code.dictionary.to_pylist(), object).astype(str)))
        rank = order[code.indices.to_numpy(zero_copy_only=False)]
        vec = x["u"].to_pylist()
        size = np.array([0 if r is None else len(r) for r in vec])
        m = np.zeros((len(vec), max(1, int(size.max()))))
        for i, r in enumerate(vec):
            if r is not None:
                m[i, : len(r)] = r
        rows = np.arange(len(vec)) if one else np.flatnonzero(x["mine"].to_numpy() == first)
        cols = rows if one else np.flatnonzero(x["mine"].to_numpy() != first)
        at = {s: i for i, s in enumerate(names.to_pylist())}
        ea = np.array([at.get(s, -1) for s in y["member_a"].to_pylist()], np.int64)
        eb = np.array([at.get(s, -1) for s in y["member_b"].to_pylist()], np.int64)
        there = np.flatnonzero((ea >= 0) & (eb >= 0))
        where = dict(zip((ea[there] * len(vec) + eb[there]).tolist(), there.tolist()))
        cos = np.clip(m[rows] @ m[cols].T, 0.0, 1.0)
        cos[size[rows][:, None] != size[cols][None, :]] = 0.0
        keep = rank[rows][:, None] != rank[cols][None, :]
        if one:
            keep = np.triu(keep, 1)
        i, j = np.nonzero(keep)
        p, q = rows[i], cols[j]
        swap = rank[p] > rank[q]
        p, q, c = np.where(swap, q, p), np.where(swap, p, q), cos[i, j]
        # the edge of each pair, -1 where there is none
        key = p * len(vec) + q
        held = np.array(sorted(where), np.int64)
        edge = np.full(len(key), -1, np.int64)
        if len(held):
            spot = np.minimum(np.searchsorted(held, key), len(held) - 1)
            hit = held[spot] == key
            edge[hit] = np.array([where[k] for k in held.tolist()], np.int64)[spot[hit]]
        return make(names, trad, p, q, c, edge, y).cast(arrow)

    fields = [f.split(" ") for f in schema.split(", ")]
    import pyarrow as pa

    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
    arrow = pa.schema([(n, kinds[t]) for n, t in fields])
    return left.groupBy("bi", "bj").cogroup(right.groupBy("bi", "bj")).applyInArrow(product, schema)


def _scored(names, trad, p, q, cos, edge, y):
    import pyarrow as pa

    at = pa.array(edge, mask=edge < 0)
    return pa.table([names.take(pa.array(p)), names.take(pa.array(q)), trad.take(pa.array(p)), trad.take(pa.array(q)), pa.array(cos), *(y[c].combine_chunks().take(at) for c in ("k", "tmi", "propp", "chrono", "poly"))], names=[f.split(" ")[0] for f in SCORED.split(", ")])


def parallels(vectors: DataFrame, e: DataFrame, threshold: float = 0.65, everything: bool = False, block: int = 1024) -> DataFrame:
    """Pairs with score 0.5 * k / 4 + 0.5 * cosine, k the edge's dimensions.

    ``vectors``: nas, tradition, vector. Without an edge a score can't pass 0.5, so above that threshold vectors
    are joined to the edges only; ``everything`` scores all cross pairs in blocks, which is quadratic by contract."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    whole = everything or threshold <= 0.5
    if whole:
        p = _block_products(vectors, e, SCORED, _scored, block)
    else:
        v = vectors.filter(~F.contains(F.col("nas"), F.lit("/lacuna"))).select("nas", unit(F.col("vector")).alias("u"))
        x, y = (v.select(F.col("nas").alias(f"member_{s}"), F.col("u").alias(f"u{s}")) for s in "ab")
        p = e.join(x, "member_a").join(y, "member_b").select(
            "member_a", "member_b", "tradition_a", "tradition_b", cosine_units(F.col("ua"), F.col("ub")).alias("cos"), F.col("qualifying_dimensions").alias("k"), F.greatest(z("tmi_jaccard_leaf"), z("tmi_jaccard_branch")).alias("tmi"),
            F.col("propp_overlap").alias("propp"), F.col("chronotope_match").alias("chrono"), z("bakhtin_polyphony_delta").alias("poly"),
        )
    k = F.coalesce("k", F.lit(0))
    p = p.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.5) * (k / 4) + F.lit(0.5) * F.col("cos"))))
    out = p.select(
        "member_a", "member_b", "tradition_a", "tradition_b", k.alias("framework_match_count"), F.bround("cos", 4).alias("cosine_similarity"), F.bround("score", 4).alias("parallel_score"),
        (F.col("score") >= threshold).alias("meets_threshold"), z("tmi").alias("tmi_score"), z("propp").alias("propp_score"), F.coalesce("chrono", F.lit(False)).cast("double").alias("chronotope_score"), z("poly").alias("polyphony_score"),
    )
    return out if whole else out.filter("meets_threshold")


def parallel_report(vectors: DataFrame, e: DataFrame, threshold: float = 0.65, block: int = 1024) -> DataFrame:
    """Distribution of the scores of all pairs, rounded to four digits: block pairs give counts of the rounded scores,
    which add up, so no pair leaves its task and the percentiles are exact."""

    def bins(names, trad, p, q, cos, edge, y):
        import numpy as np
        import pyarrow as pa

        k = np.where(edge >= 0, np.append(y["k"].to_numpy(), 0)[edge], 0)
        score = np.clip(0.5 * (k / 4) + 0.5 * cos, 0.0, 1.0)
        at = np.rint(score * 10_000).astype(np.int64)
        n, above = np.bincount(at, minlength=10_001), np.bincount(at[score >= threshold], minlength=10_001)
        some = np.flatnonzero(n)
        return pa.table([pa.array(some / 10_000.0), pa.array(n[some].astype(np.int64)), pa.array(above[some].astype(np.int64))], names=["score", "n", "n_above"])

    g = _block_products(vectors, e, BINS, bins, block).groupBy("score").agg(F.sum("n").alias("n"), F.sum("n_above").alias("n_above"))
    q = lambda x: F.bround(F.percentile("score", F.lit(x), F.col("n")), 4)
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), F.coalesce(F.sum("n_above"), F.lit(0)).alias("n_above"), F.min("score").alias("min_score"), q(0.5).alias("median_score"), q(0.9).alias("p90_score"), F.max("score").alias("max_score"))


def pairs_by_tradition(p: DataFrame) -> DataFrame:
    label = F.concat_ws("-", F.least("tradition_a", "tradition_b"), F.greatest("tradition_a", "tradition_b"))
    return p.filter("meets_threshold").groupBy(label.alias("pair")).agg(F.count("*").alias("n"))


def number_rows(df: DataFrame, order: list[Column], name: str, form: str) -> DataFrame:
    """Adds numbers in that order from 1; ranges are sorted apart and offset, so no single task sees all."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    s = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()))
    sizes = sorted((r["part"], r["k"], r["lo"]) for r in s.groupBy("part").agg(F.count("*").alias("k"), F.min("seq").alias("lo")).collect())  # a row a partition
    base, rows = 0, []
    for part, k, lo in sizes:
        rows.append((part, base - lo))
        base += k
    off = df.sparkSession.createDataFrame(rows or [(0, 0)], "part int, off bigint")
    return s.join(F.broadcast(off), "part").withColumn(name, F.format_string(form, F.col("seq") + F.col("off") + 1)).drop("part", "seq", "off")


def number_pairs(p: DataFrame) -> DataFrame:
    """Adds ``parallel_id`` in (member_a, member_b) order."""
    return number_rows(p, [F.col("member_a"), F.col("member_b")], "parallel_id", "P-%04d")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, block: int = 16_384) -> DataFrame:
    """(query_nas, nas, similarity, rank): the k most similar of all vectors for each query, exact; ties go by ``nas``.

    Queries and vectors meet in pairs of bounded blocks. Each pair keeps k a query, all that tie with the k-th looked
    at, and these lists are merged; no scored pair is shuffled and nothing goes to the driver."""
    found = "query_nas string, nas string, similarity double"
    q = cut(queries.select("nas", unit(F.col("vector")).alias("u")).filter("u is not null"))
    v = cut(vectors.select("nas", unit(F.col("vector")).alias("u")).filter("u is not null"))
    nq, nv = (max(1, x.count() // block + 1) for x in (q, v))
    left = q.withColumn("bi", _blocks("nas", nq)).withColumn("bj", F.explode(F.sequence(F.lit(0), F.lit(nv - 1))))
    right = v.withColumn("bj", _blocks("nas", nv)).withColumn("bi", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    def run(a, b):
        import numpy as np
        import pandas as pd

        out = []
        if len(a) and len(b):
            who = b["nas"].to_numpy(object)
            by_name = np.argsort(who.astype(str), kind="stable")
            b, who = b.iloc[by_name], who[by_name]
            size = b["u"].str.len().to_numpy()
            for d, asked in a.groupby(a["u"].str.len()):
                cols = np.flatnonzero(size == d)
                if not len(cols):
                    continue
                y = np.array(b["u"].iloc[cols].tolist())
                for start in range(0, len(asked), 512):
                    part = asked.iloc[start : start + 512]
                    sim = np.clip(np.array(part["u"].tolist()) @ y.T, 0, 1)
                    for name, row in zip(part["nas"], sim):
                        at = np.arange(len(cols))
                        if len(cols) > k + 1:
                            low = np.partition(row, len(cols) - k - 1)[len(cols) - k - 1]
                            at = np.flatnonzero(row >= low)
                        at = at[np.argsort(-row[at], kind="stable")][: k + 1]  # names are in order, so ties are too
                        out += [(name, who[cols[j]], float(row[j])) for j in at if who[cols[j]] != name][:k]
        return pd.DataFrame(out, columns=["query_nas", "nas", "similarity"])

    lists = left.groupBy("bi", "bj").cogroup(right.groupBy("bi", "bj")).applyInPandas(run, found)
    w = W.partitionBy("query_nas").orderBy(F.desc("similarity"), "nas")
    return lists.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
