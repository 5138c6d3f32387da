"""Text cut off by field limits: hashed logistic regression on how a text ends.

Positives are made by cutting intact texts; features are the closing characters and word,
punctuation and brackets at the end, and the length's distance to the limits that the source's
lengths pile up at. Every record is scored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.address import norm_locale
from ..session import cut
from . import logistic

DIMS = 1 << 14
SAMPLE = 24_000  # bound of the labelled rows of the classifier
LONGEST = 20_000  # labelled rows are made of texts shorter than that; every text is scored

#: Marks that close a sentence, brackets and quotations in the scripts at hand.
STOPS = ".!?。！？।॥؟;՞።"
CLOSERS = "”’»“\"')]）」』】*"
DOTS = re.compile(r"(?:\.{3,}|…)$")
_FURNITURE = re.compile(r"^[\W_]*(?:(?:p|pp|стр|с|S)\.?\s*)?(?:\d{1,4}|[ivxlcdm]{1,7})[\W_]*$", re.I)
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")


def _kind(ch: str) -> str:
    if ch in STOPS:
        return "stop"
    if ch in CLOSERS:
        return "close"
    if ch == "…":
        return "dots"
    if ch == "�":
        return "lost"
    if ch.isdigit():
        return "digit"
    if ch.isalpha() or "ऀ" <= ch <= "๿":
        return "thai" if "฀" <= ch <= "๿" else "letter"
    return "other"


def features(text: str, lang: str, limit_share: float, at_limit: bool) -> list[str]:
    """Names of the features that hold for a text; one of the source's limits may be its length."""
    t = text.rstrip()
    tail = t[-160:]
    last = "…" if DOTS.search(tail) else tail[-1:]  # three dots are one mark, however they are written
    kind = _kind(last) if last else "none"
    words = _WORD.findall(tail)
    last_word = words[-1] if words else ""
    before = words[-2] if len(words) > 1 else ""
    opened = tail.rfind("[") > tail.rfind("]") or tail.rfind("(") > tail.rfind(")")
    quotes = max(tail.rfind(q) for q in "“«„「『")
    open_quote = quotes > max(tail.rfind(q) for q in "”»“」』") and quotes >= 0
    line = t.rsplit("\n", 1)[-1].strip() if "\n" in text[-160:] else ""
    furniture = bool(line) and bool(_FURNITURE.match(line))
    capital = bool(line) and len(line) < 60 and line == line.upper() and line != line.lower()
    space = text[-1:].isspace()
    f = [
        f"kind={kind}", f"lang={lang}|{kind}", f"last={last}", f"last2={last if kind == 'dots' else tail[-2:]}", f"opened={opened}|{kind}", f"quote={open_quote}|{kind}",
        f"word={last_word.lower()}", f"pair={before.lower()} {last_word.lower()}", f"furniture={furniture}", f"capital={capital}",
        f"space={space}|{kind}", f"len={min(len(last_word), 12)}|{kind}", f"limit={at_limit}|{kind}", f"share={int(limit_share * 10)}|{kind}",
        f"round={len(text) in ROUND}|{kind}", f"cap={last_word[:1].isupper()}|{kind}",
    ]
    if len(words) > 2 and last in ".)":
        f.append(f"abbr={before.lower()}{last_word}")
    f.append("ends3=" + " ".join(w.lower() for w in words[-4:-1]))
    return f


#: Usual field widths; the data's own limits are found from their lengths.
ROUND = {2**k - d for k in range(6, 16) for d in (0, 1)} | {100 * k for k in range(1, 101)} | {320, 640, 250, 750}


def hashed(names: list[str]) -> np.ndarray:
    return np.unique(np.array([zlib.crc32(n.encode()) % DIMS for n in names], np.int64))


def _limits(d: DataFrame, least: int = 4, lift: float = 4.0) -> DataFrame:
    """(source, n, share): lengths that occur far more often in a source than those beside them.

    Bodies (by their hash ``h``) count once a source, for copies of one text have its length by nature."""
    by = d.filter("n > 0").groupBy("source", "n").agg(F.count_distinct("h").alias("k"))
    total = by.groupBy("source").agg(F.sum("k").alias("all"))
    near = by.select("source", F.explode(F.sequence(F.col("n") - 8, F.col("n") + 8)).alias("n"), F.col("k").alias("kn"), F.col("n").alias("m")).filter("n <> m")
    side = near.groupBy("source", "n").agg((F.sum("kn") / 16).alias("beside"))
    out = by.join(side, ["source", "n"], "left").join(total, "source")
    return out.filter((F.col("k") >= least) & (F.col("k") >= lift * (1 + F.coalesce("beside", F.lit(0.0))))).select("source", "n", (F.col("k") / F.col("all")).alias("share"))


def _cuts(text: str, rng: np.random.Generator) -> str | None:
    """An intact text cut inside: at any place, or one that leaves a word or a citation open."""
    if len(text) < 40:
        return None
    for _ in range(6):
        short = text[: int(rng.integers(20, len(text) - 3))]
        if rng.random() < 0.12:
            short = short.rstrip() + ("…" if rng.random() < 0.5 else "...")
        elif rng.random() < 0.05:
            short += "�"
        if short.rstrip() and (_kind(short.rstrip()[-1]) != "stop" or DOTS.search(short) or rng.random() < 0.05):
            return short
    return None


def score_truncation(content: DataFrame, reports: DataFrame, sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """(content_id, source_file, score, cut) for all records.

    A record counts once however often it is repeated (of its rows the one with the longest body is taken).
    Null and blank bodies are no cases: score null, not cut. A record without a run has a null source,
    which counts as one source. ``sample`` bounds the classifier's labelled rows: texts of less than ``LONGEST`` characters that end well
    as negatives, the same texts cut as positives; lengths and limits are of all records.
    No rows, or none that end well, give no cut records. Other columns are dropped."""
    spark = content.sparkSession
    src = reports.groupBy("run_id").agg(F.max("source_file").alias("source"))
    rows_ = content.select("content_id", "body", F.length("body").alias("n"), F.xxhash64("body").alias("h"), "run_id", F.coalesce(norm_locale(F.col("locale")), F.lit("")).alias("lang"))
    pick = ["n", "h", "run_id", "lang"]
    # lengths and sources first, without the bodies: these are shuffled once only, on their key
    slim = cut(rows_.groupBy("content_id").agg(F.max(F.struct(*pick)).alias("x")).select("content_id", "x.*").join(src.hint("merge"), "run_id", "left").select("content_id", "source", "n", "h"))
    n_all = slim.count()
    if n_all == 0:
        return spark.createDataFrame([], "content_id bigint, source_file string, score double, cut boolean")
    share = slim.join(_limits(slim).hint("merge"), ["source", "n"], "left").select("content_id", "source", F.coalesce("share", F.lit(0.0)).alias("share"))
    one = rows_.groupBy("content_id").agg(F.max(F.struct(*pick, "body")).alias("x")).select("content_id", "x.lang", "x.body")
    d = cut(one.join(share.hint("merge"), "content_id").withColumn("some", F.coalesce(F.col("body").rlike(r"\S"), F.lit(False))))
    whole = F.regexp_replace("body", r"\s+$", "")
    ends = F.substring(whole, -1, 1)
    closed = ends.isin(*STOPS, *CLOSERS) | F.col("lang").isin("th", "lo", "km", "my")
    # closing remarks without a stop, and furniture, count as intact where many records end alike
    tail = F.regexp_replace(F.element_at(F.split(F.substring(whole, -60, 60), r"[.!?\]»”\n]\s*"), -1), r"[\dIVXLCDMivxlcdm]+", "9")
    least = max(5, n_all // 5000)
    # a remark has three words or is furniture; a lone last word or an open bracket is what cuts leave
    remark = (tail.rlike(r"^\S+\s+\S+\s+\S+") & ~tail.rlike(r"[\[(<]")) | tail.rlike(r"^[\W_]*((p|pp|стр|с|S)\.?\s*)?9[\W_]*$") | (tail.rlike(r"\S{3}.*\s") & (tail == F.upper(tail)))
    common = d.filter(F.col("some") & ~closed & remark).groupBy(tail.alias("tail")).agg(F.count("*").alias("k")).filter(F.col("k") >= least)
    common = F.broadcast(common.select("tail", F.lit(True).alias("often")))  # at most 5,000 rows, since each is that share of all
    intact = d.withColumn("tail", tail).join(common, "tail", "left").filter(F.col("some") & (closed | F.coalesce("often", F.lit(False))) & (F.col("share") == 0) & (F.length("body") < LONGEST))
    rate = min(1.0, sample / 2 / max(1, n_all) * 1.5)
    drawn = F.pmod(F.xxhash64("content_id", F.lit(seed)), F.lit(10**6))
    pdf = intact.filter(drawn < rate * 10**6).orderBy(drawn, "content_id").limit(sample // 2).select("body", "lang").toPandas()
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for body, lang in zip(pdf["body"], pdf["lang"]):
        rows.append(hashed(features(body, lang, 0.0, False)))
        labels.append(0.0)
        if short := _cuts(body, rng):
            limit = rng.random() < 0.5
            rows.append(hashed(features(short, lang, float(rng.uniform(0.02, 0.4)) if limit else 0.0, limit)))
            labels.append(1.0)
    # a few intact texts may have a limit's length too
    for body, lang in zip(pdf["body"].head(len(pdf) // 20), pdf["lang"]):
        rows.append(hashed(features(body, lang, 0.05, True)))
        labels.append(0.0)
    w = spark.sparkContext.broadcast(logistic.fit(rows, np.array(labels), DIMS) if rows else np.zeros(DIMS + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            some = b["some"].to_numpy(bool)
            x = [hashed(features(t, g, s, s > 0)) for t, g, s in zip(b["body"][some], b["lang"][some], b["share"][some])]
            score = np.full(len(b), np.nan)
            score[some] = logistic.score(x, w.value)
            yield pd.DataFrame({"content_id": b["content_id"], "source_file": b["source"], "score": score, "cut": score > 0.5})

    scored = d.select("content_id", "source", "lang", "body", "share", "some").mapInPandas(run, "content_id bigint, source_file string, score double, cut boolean")
    return scored.withColumn("score", F.when(F.isnan("score"), None).otherwise(F.col("score")))


def truncation_report(scored: DataFrame) -> DataFrame:
    """Number and share of cut records for each source."""
    g = scored.groupBy("source_file").agg(F.count("*").alias("n_records"), F.count_if("cut").alias("n_cut"))
    return g.withColumn("share_cut", F.col("n_cut") / F.col("n_records"))
