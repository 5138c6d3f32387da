"""Sentence alignment of bilingual editions by entropic optimal transport.

Word translations are learned from all editions: sparse co-occurrence counts over paired documents,
refined on the sentence pairs of a first alignment; they stay in the cluster and each document is joined
to those of its words. Statements (clauses) become vectors over shared features: words carried over by the
translations, numbers, transliterated names. The transport between the statements of the two sides has a
null mass on each, so one may stay alone; Sinkhorn scaling gives the plan, whose strong entries are the only
links. Sentences that hold linked statements form groups: one to one, merges, splits, omissions. Order plays
no part."""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.address import canon_nas, norm_locale
from ..session import cut

HEAVY = 4096  # most frequent words a side, whose translations every task holds; the others' are joined, with the same result
EVIDENCE = 3  # documents or linked sentences that a word needs to have translations
STEPS, HEAT, NULL = 40, 0.08, 0.30  # Sinkhorn rounds, entropy, similarity at which a null match is as good
LEAST, COVER = 0.15, 0.55  # least mass of a link, least share of one of the two statements that it covers

#: A plain transliteration of Cyrillic letters.
_CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "a b v g d e e zh z i i k l m n o p r s t u f kh ts ch sh sch _ y _ e yu ya".replace("_", "").split(" ")))
_TOKEN = re.compile(r"\d+|[^\W\d_]+")


def sentences(body: str) -> list[str]:
    """Sentences as the editions number them: every ``.``, ``!`` or ``?`` ends one."""
    out, at = [], 0
    for m in re.finditer(r"[.!?]", body):
        out.append(body[at : m.end()])
        at = m.end()
    if body[at:].strip():
        out.append(body[at:])
    return out


#: Words that join two statements in one sentence.
_JOIN = re.compile(r"[;,]\s+|\s(?:and|и)\s")


def latin(word: str) -> str:
    w = "".join(_CYRILLIC.get(c, c) for c in word)
    return re.sub(r"(.)\1", r"\1", w)


@lru_cache(100_000)
def _grams(word: str) -> frozenset[str]:
    w = f"^{latin(word)}$"
    return frozenset(w[i : i + 3] for i in range(len(w) - 2))


def pairs_of(content: DataFrame, sides: tuple[str, str] = ("en", "ru")) -> DataFrame:
    """(id_a, body_a, id_b, body_b): the two sides of every edition; a is the first language.

    A record counts once. Where a side has several records they are all paired with the other side's."""
    one = (
        content.filter("translation_id is not null and body is not null")
        .select("content_id", canon_nas(F.col("nas")).alias("nas"), "translation_id", norm_locale(F.col("locale")).alias("lang"), "body")
        .filter(F.col("lang").isin(*sides) & F.col("nas").isNotNull() & F.col("body").rlike(r"\S"))
        .groupBy("content_id")
        .agg(F.max(F.struct("body", "nas", "translation_id", "lang")).alias("x"))
        .select("content_id", "x.*")
    )
    side = lambda g, x: one.filter(F.col("lang") == g).select("nas", "translation_id", F.col("content_id").alias(f"id_{x}"), F.col("body").alias(f"body_{x}"))
    return side(sides[0], "a").join(side(sides[1], "b"), ["nas", "translation_id"]).select("id_a", "body_a", "id_b", "body_b")


def _words(text: str) -> list[str]:
    return [x.lower() for x in _TOKEN.findall(text) if not x.isdigit()]


@lru_cache(500_000)
def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


class Tally:
    """Counts of words and of word pairs of a task, in the order in which words came."""

    def __init__(self):
        self.ids: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.single: tuple[list[int], list[int]] = ([], [])
        self.codes: list[np.ndarray] = []
        self.size, self.total = 0, 0

    def add(self, a: set[str], b: set[str]) -> None:
        ends = []
        for side, words in enumerate((a, b)):
            ids, single = self.ids[side], self.single[side]
            at = []
            for w in words:
                k = ids.setdefault(w, len(ids))
                if k == len(single):
                    single.append(0)
                single[k] += 1
                at.append(k)
            ends.append(np.array(at, np.int64))
        self.codes.append(np.add.outer(ends[0] << 32, ends[1]).ravel())
        self.size += len(self.codes[-1])
        self.total += 1

    def drain(self) -> pd.DataFrame:
        """(a, b, n): word pairs, words of one side (the other null) and the number of sets (both null)."""
        code, n = np.unique(np.concatenate([*self.codes, np.zeros(0, np.int64)]), return_counts=True)
        ha, hb = (np.array([_hash(w) for w in ids], np.int64) for ids in self.ids)
        na, nb = (np.array(s, np.int64) for s in self.single)
        none = lambda k: pd.array([pd.NA] * k, "Int64")
        out = pd.concat([
            pd.DataFrame({"a": pd.array(ha[code >> 32], "Int64"), "b": pd.array(hb[code & 0xFFFFFFFF], "Int64"), "n": n}),
            pd.DataFrame({"a": pd.array(ha, "Int64"), "b": none(len(ha)), "n": na}),
            pd.DataFrame({"a": none(len(hb)), "b": pd.array(hb, "Int64"), "n": nb}),
            pd.DataFrame({"a": none(1), "b": none(1), "n": [self.total]}),
        ])
        self.__init__()
        return out


def _lexicon(tallies: DataFrame, keep: int = 8, least: float = 0.08) -> DataFrame:
    """(side, word, n, to): words by hash with their counts and, for side 0, translations with weights.

    A pair's weight is the correlation of its words' occurrences; the ``keep`` best of every word on either side stay."""
    counts = cut(tallies.groupBy("a", "b").agg(F.sum("n").alias("n")))
    total = max(1, counts.filter("a is null and b is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    na = counts.filter(f"a is not null and b is null and n >= {EVIDENCE}").select("a", F.col("n").alias("na"))
    nb = counts.filter(f"a is null and b is not null and n >= {EVIDENCE}").select("b", F.col("n").alias("nb"))
    both = counts.filter("a is not null and b is not null and n > 1").join(na, "a").join(nb, "b")
    pa, pb, p = (F.col(c) / total for c in ("na", "nb", "n"))
    phi = (p - pa * pb) / (F.sqrt(pa * (1 - pa) * pb * (1 - pb)) + 1e-9) * F.col("n") / (F.col("n") + 2)
    strong = both.select("a", "b", phi.alias("p")).filter(F.col("p") >= least)
    by_a, by_b = (W.partitionBy(k).orderBy(F.desc("p"), o) for k, o in (("a", "b"), ("b", "a")))
    best = strong.withColumn("ra", F.row_number().over(by_a)).withColumn("rb", F.row_number().over(by_b)).filter((F.col("ra") <= keep) | (F.col("rb") <= keep))
    to = best.groupBy("a").agg(F.collect_list(F.struct("b", "p")).alias("to"))
    first = na.join(to, "a", "left").select(F.lit(0).alias("side"), F.col("a").alias("word"), F.col("na").alias("n"), "to")
    return cut(first.unionByName(nb.select(F.lit(1).alias("side"), F.col("b").alias("word"), F.col("nb").alias("n"), F.lit(None).cast(first.schema["to"].dataType).alias("to"))))


Words = dict[tuple[int, int], tuple[int, list]]  # (side, hash): count, translations


def _with_words(pairs: DataFrame, lexicon: DataFrame) -> tuple[DataFrame, Words]:
    """Pairs with ``words``, the lexicon's rows of their words, but for those that every task holds."""
    few = F.coalesce(F.size("to"), F.lit(0)) <= 64
    rows = []
    for side in (0, 1):
        rows += lexicon.filter((F.col("side") == side) & few).orderBy(F.desc("n"), "word").limit(HEAVY).collect()
    heavy: Words = {(r["side"], r["word"]): (r["n"], [(x["b"], x["p"]) for x in r["to"] or []]) for r in rows}
    b = pairs.sparkSession.sparkContext.broadcast(set(heavy))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = b.value
        for pdf in batches:
            out = []
            for ka, ta, kb, tb in zip(pdf["id_a"], pdf["body_a"], pdf["id_b"], pdf["body_b"]):
                out += [(ka, kb, s, h) for s, t in ((0, ta), (1, tb)) for w in set(_words(t)) if (s, h := _hash(w)) not in held]
            yield pd.DataFrame(out, columns=["id_a", "id_b", "side", "word"])

    asked = pairs.select("id_a", "body_a", "id_b", "body_b").mapInPandas(run, "id_a bigint, id_b bigint, side int, word bigint")
    mine = asked.join(lexicon, ["side", "word"]).groupBy("id_a", "id_b").agg(F.collect_list(F.struct("side", "word", "n", "to")).alias("words"))
    return pairs.join(mine, ["id_a", "id_b"], "left"), heavy


def _lookup(heavy: Words, words) -> Words:
    if words is None or not len(words):
        return heavy
    return ChainMap({(r["side"], r["word"]): (r["n"], [(x["b"], x["p"]) for x in (r["to"] if r["to"] is not None else [])]) for r in words}, heavy)


class Side:
    """One body: its distinct tokens with weights, and which statement of which sentence holds which."""

    def __init__(self, body: str, side: int, words: Words, n: int):
        self.index: dict[str, int] = {}
        self.token: list[str] = []
        self.known: list[int | None] = []  # hash of a word with evidence, else none
        self.names: list[int] = []
        weight: list[float] = []
        rows: list[list[int]] = []
        self.owner: list[int] = []  # sentence of each statement
        self.n = 0
        for i, sentence in enumerate(sentences(body)):
            self.n = i + 1
            parts = [x for x in _JOIN.split(sentence) if _TOKEN.search(x)] or [sentence]
            for part in parts:
                row = []
                for w in _TOKEN.findall(part):
                    low = w.lower()
                    k = self.index.get(low)
                    if k is None:
                        number, h = w.isdigit(), _hash(low)
                        got = None if number else words.get((side, h))
                        if got is None and not number and not (w[0].isupper() and len(w) > 3):
                            continue
                        k = self.index[low] = len(self.token)
                        self.token.append(low)
                        self.known.append(None if got is None else h)
                        weight.append(3.0 if got is None else float(np.log(1 + n / got[0])))
                    if w[0].isupper() and len(w) > 3 and k not in self.names:
                        self.names.append(k)
                    row.append(k)
                rows.append(row)
                self.owner.append(i)
        self.weight = np.array(weight)
        self.clause = np.zeros((len(rows), len(weight)))
        for r, row in enumerate(rows):
            self.clause[r, row] = 1


def _match(a: Side, b: Side, words: Words) -> np.ndarray:
    """How well each token of a is matched by each of b: translation, equal number, like-sounding name."""
    t = np.zeros((len(a.token), len(b.token)))
    at = {v: j for j, v in enumerate(b.known) if v is not None}
    for i, v in enumerate(a.known):
        if v is not None:
            for w, p in words[0, v][1]:
                j = at.get(w)
                if j is not None:
                    t[i, j] = min(1.0, 1.6 * p)
        elif a.token[i].isdigit():
            j = b.index.get(a.token[i])
            if j is not None:
                t[i, j] = 1.0
    for i in a.names:
        x = _grams(a.token[i])
        for j in b.names:
            y = _grams(b.token[j])
            like = len(x & y) / max(1, min(len(x), len(y)))
            if like > 0.5:
                t[i, j] = max(t[i, j], like)
    return t


def similarity(a: Side, b: Side, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, cover) of every two statements: translated words, numbers and names, weighted by rarity.

    ``cover`` is the larger share that one covers of the other: statements that only have a place and a verb in
    common cover little of either. The similarity is the mean of it and of what both have in common."""
    t = _match(a, b, words)
    best_a = np.stack([(t * row).max(1) for row in b.clause], 1)
    best_b = np.stack([(t * row[:, None]).max(0) for row in a.clause], 1)
    got_a = a.clause @ (a.weight[:, None] * best_a)
    got_b = (b.clause @ (b.weight[:, None] * best_b)).T
    all_a, all_b = (a.clause @ a.weight)[:, None] + 1e-9, (b.clause @ b.weight)[None, :] + 1e-9
    cover = np.maximum(got_a / all_a, got_b / all_b)
    return 0.5 * (got_a + got_b) / (all_a + all_b) + 0.5 * cover, cover


def transport(sim: np.ndarray, steps: int = STEPS, heat: float = HEAT, null: float = NULL) -> np.ndarray:
    """Plan of the entropic transport with a null statement on each side that takes what has no partner.

    Statements carry mass 1; the null rows and columns carry enough for all, at cost 1 - ``null``."""
    n, m = sim.shape
    full = np.full((n + 1, m + 1), null)
    full[:n, :m] = sim
    full[n, m] = 0.0
    k = np.exp((full - 1) / heat)
    a = np.r_[np.ones(n), float(m)]
    b = np.r_[np.ones(m), float(n)]
    u, v = np.ones(n + 1), np.ones(m + 1)
    for _ in range(steps):
        u = a / (k @ v)
        v = b / (k.T @ u)
    return u[:, None] * k * v[None, :]


def links(ta: str, tb: str, words: Words, n: int) -> tuple[list[tuple[int, int]], int, int]:
    """Sentence pairs that share a statement, 0-based, and the number of sentences of either side.

    Each comes from a strong entry of the transport plan between the statements; of those, a check keeps the
    ones where one statement covers enough of the other."""
    a, b = Side(ta, 0, words, n), Side(tb, 1, words, n)
    if not a.n or not b.n or not a.token or not b.token:
        return [], a.n, b.n
    sim, cover = similarity(a, b, words)
    plan = transport(sim)[:-1, :-1]
    return sorted({(a.owner[i], b.owner[j]) for i, j in zip(*np.nonzero((plan >= LEAST) & (cover >= COVER)))}), a.n, b.n


def groups(pairs: list[tuple[int, int]]) -> dict[tuple[int, int], str]:
    """Kind of each link by its group of linked sentences: one, split (one to several), merge or many."""
    root: dict[tuple[int, int], tuple[int, int]] = {}

    def find(x: tuple[int, int]) -> tuple[int, int]:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in pairs:
        root[find((0, i))] = find((1, j))
    size: dict[tuple[int, int], list[int]] = {}
    for x in list(root):
        size.setdefault(find(x), [0, 0])[x[0]] += 1
    name = {(False, False): "one", (False, True): "split", (True, False): "merge", (True, True): "many"}
    return {(i, j): name[tuple(k > 1 for k in size[find((0, i))])] for i, j in pairs}


def align(content: DataFrame, sides: tuple[str, str] = ("en", "ru"), rounds: int = 2) -> DataFrame:
    """(content_id_a, sentence_a, content_id_b, sentence_b, kind): linked sentences of bilingual editions.

    Numbered from 1; ``content_id_a`` < ``content_id_b``. ``kind``: one, merge (several a to one b), split
    (one a to several b), many, or omission: a sentence without partner, the other number null. Null, blank and
    one-sided editions give none; no pairs give no rows; extra columns are ignored."""
    spark = content.sparkSession
    pairs = cut(pairs_of(content, sides))
    n = max(1, pairs.count())
    cols = ["id_a", "body_a", "id_b", "body_b"]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for pdf in batches:
            for ta, tb in zip(pdf["body_a"], pdf["body_b"]):
                tally.add(set(_words(ta)), set(_words(tb)))
                if tally.size > 4_000_000:
                    yield tally.drain()
        yield tally.drain()

    lexicon = _lexicon(pairs.select("body_a", "body_b").mapInPandas(count, "a bigint, b bigint, n bigint"))
    for _ in range(rounds - 1):
        todo, heavy = _with_words(pairs, lexicon)
        held = spark.sparkContext.broadcast(heavy)

        def recount(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            tally = Tally()
            for pdf in batches:
                for ta, tb, mine in zip(pdf["body_a"], pdf["body_b"], pdf["words"]):
                    got, _, _ = links(ta, tb, _lookup(held.value, mine), n)
                    sa, sb = ([set(_words(s)) for s in sentences(t)] for t in (ta, tb)) if got else ([], [])
                    for i, j in got:
                        tally.add(sa[i], sb[j])
                    if tally.size > 4_000_000:
                        yield tally.drain()
            yield tally.drain()

        sentence = _lexicon(todo.select("body_a", "body_b", "words").mapInPandas(recount, "a bigint, b bigint, n bigint"))
        # rarity stays that over documents
        docs = lexicon.select("side", "word", F.col("n").alias("n_docs"))
        lexicon = cut(docs.join(sentence, ["side", "word"], "left").select("side", "word", F.col("n_docs").alias("n"), "to"))
    todo, heavy = _with_words(pairs, lexicon)
    held = spark.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ka, ta, kb, tb, mine in zip(pdf["id_a"], pdf["body_a"], pdf["id_b"], pdf["body_b"], pdf["words"]):
                got, na, nb = links(ta, tb, _lookup(held.value, mine), n)
                rows = [(i + 1, j + 1, kind) for (i, j), kind in groups(got).items()]
                rows += [(i + 1, None, "omission") for i in sorted({*range(na)} - {i for i, _ in got})]
                rows += [(None, j + 1, "omission") for j in sorted({*range(nb)} - {j for _, j in got})]
                if ka < kb:
                    out += [(ka, i, kb, j, kind) for i, j, kind in rows]
                else:
                    out += [(kb, j, ka, i, {"merge": "split", "split": "merge"}.get(kind, kind)) for i, j, kind in rows]
            frame = pd.DataFrame(out, columns=["content_id_a", "sentence_a", "content_id_b", "sentence_b", "kind"])
            yield frame.astype({"sentence_a": "Int32", "sentence_b": "Int32"})

    schema = "content_id_a bigint, sentence_a int, content_id_b bigint, sentence_b int, kind string"
    return todo.select(*cols, "words").mapInPandas(run, schema)
