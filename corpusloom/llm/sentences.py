"""Sentence boundaries across scripts: a hidden-event n-gram language model.

Between words a text may hide the event "boundary". Slots where it may stand are those after a
closing mark, at line ends and, in scripts without stops, at white space. An n-gram model with back-off
gives the probability of the event after the words before it (with quotation and dash as part of what
is seen) and of the words after it with and without the event; a chain gives how the events of
neighbouring slots hang together (the clause that attributes a speech led by a dash goes on after it).
Both are trained by expectation-maximisation on counts of the whole corpus, which start from how often
each context meets a wide gap, for those are far likelier at boundaries. Forward-backward posteriors
over all slots of every text decide; there the gap is only white space and is not used."""

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

SLOTS = 1 << 19  # hashed model table, whatever the data
ROUNDS = 3

#: Closing marks of scripts; quotation pairs by language; scripts that set no spaces or stops.
STOPS = ".!?…。！？।॥؟።"
CLOSE = "”’»“\"')]）」』】"
QUOTES = {"de": "„“‚‘", "en": "“”‘’", "ru": "«»„“", "el": "«»“”", "fr": "«»“”", "zh": "“”《》‘’「」", "ja": "「」『』", "hi": "“”‘’", "ar": "«»“”", "th": "“”‘’"}
OTHER_QUOTES = "“”«»„”"
UNSPACED = {"zh", "ja"}
UNSTOPPED = {"th", "lo", "km", "my"}

_GREEK = re.compile(r"[.!?…;·]+[”’»“\"')\]]*(?=\s|$|[A-ZΑ-Ω«“])")
_SPACED = re.compile(r"(?:[.!?…।॥؟።。！？]+[”’»“‘\"')\]]*|(?<=[.!?…।॥؟])[”»“’]+)(?=\s|$)|(?<=[^\W\d_]{2})[.!?][”»“]?(?=[^\W\d_a-zа-яё])|\n+")
_TIGHT = re.compile(r"[。！？…!?]+[”’」』）)]*|[”」』](?![，、,。！？])|\n+")
_GAPS = re.compile(r"\s+")
_WORD = re.compile(r"\S+")


def _shape(word: str) -> str:
    """Class of a word: what is known of words never seen."""
    core = word.strip("“”«»„‘’\"'()[]—–-…")
    if not core:
        return "dash" if word[:1] in "—–-" else "mark" if word else "none"
    c = core[0]
    if c.isdigit():
        return "number" if core.rstrip(".,;:!?)").replace(".", "").replace(",", "").replace("٫", "").isdigit() else "ordinal"
    if c.isupper():
        letters = core.rstrip(".")
        return "initial" if len(letters) == 1 and core.endswith(".") else "capital"
    if c.islower():
        return "lower"
    return "letter"


class Slot:
    """A place that may hide a boundary: its offsets and what the model sees of it.

    ``kind``: 0 plain, 1 a dash and lower case follow, 2 a dash and anything else, 3 after a quotation, 4 within one."""

    __slots__ = ("end", "gap", "kind", "left", "right", "start")

    def __init__(self, end: int, start: int, left: tuple[str, ...], right: tuple[str, ...], gap: str, kind: int):
        self.end, self.start, self.left, self.right, self.gap, self.kind = end, start, left, right, gap, kind


def _gap(ws: str) -> str:
    return "wide" if ws.count("\n") > 1 else "line" if "\n" in ws else "wide" if len(ws) > 1 else "space"


_SAYS = re.compile(r"[^\s。！？।॥.!?؟，、,]+(?=[。！？।॥.!?؟]|$)")


_MARKS = {g: re.compile(f"[{q}]|\n\n") for g, q in [*QUOTES.items(), ("", OTHER_QUOTES)]}


def quotations(text: str, lang: str) -> list[tuple[int, int]]:
    """Outermost quotations of a text in order, as offsets of their two marks.

    Each mark is closed by its own kind within a paragraph, and one that is never closed opens nothing.
    A raised comma beside letters or after white space is an apostrophe."""
    lang = lang if lang in QUOTES else ""
    pairs = QUOTES.get(lang, OTHER_QUOTES)
    opens, closes = pairs[::2], pairs[1::2]
    spans: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []  # closing mark awaited, offset
    for m in _MARKS[lang].finditer(text):
        c, i = m.group(0), m.start()
        if c == "\n\n":
            stack.clear()
            continue
        before, behind = text[i - 1 : i], text[i + 1 : i + 2]
        if c in closes and any(c == k for k, _ in stack):
            if c == "’" and (before.isspace() or before.isalnum() and behind.isalnum()):
                continue
            while True:
                k, at = stack.pop()
                if k == c:
                    break
            while spans and spans[-1][0] > at:
                spans.pop()
            spans.append((at, i))
        elif c in opens and not (c == "‘" and before.isalnum()):
            stack.append((closes[opens.index(c)], i))
    return spans


def slots(text: str, lang: str) -> list[Slot]:
    """Slots of a text in order, without its end."""
    tight, bare = lang in UNSPACED, lang in UNSTOPPED
    pairs = QUOTES.get(lang, OTHER_QUOTES)
    opens, closes = pairs[::2], pairs[1::2]
    pattern = _TIGHT if tight else _GAPS if bare else _GREEK if lang == "el" else _SPACED
    n, out = len(text), []
    quotes, at = quotations(text, lang), 0
    last_end = -1
    for m in pattern.finditer(text):
        if bare or text[m.start()] == "\n":
            end = m.start()
            while end and text[end - 1].isspace():
                end -= 1
        else:
            end = m.end()
        start = end
        while start < n and text[start].isspace():
            start += 1
        if start >= n or end <= 0 or end <= last_end:
            continue
        last_end = end
        while at < len(quotes) and quotes[at][1] < end:
            at += 1
        gap = text[end:start]
        within = "in" if at < len(quotes) and quotes[at][0] < end else ""
        # words beside the slot
        if tight:
            mark = m.group(0).strip() if text[m.start()] != "\n" else text[end - 1]
            left = mark[:3]
            stop = re.compile(r"[。！？…!?\n]").search(text, start)
            clause = text[start : stop.start() if stop else n]
            nxt, tail = clause[:1], clause[-1:]
            prev = text[max(0, end - len(mark) - 1) : end - len(mark)]
            mark = left[-1:]
            quoted = mark in closes
            mark += within
            lk = (f"l{prev}{left}{within}", f"L{left}{within}", f"c{mark}")
            rk = (f"T{tail}|{mark}" if quoted else "", f"R{nxt}|{mark}", f"s|{mark}")
            dash = 0
        else:
            a = max(text.rfind(" ", 0, end), text.rfind("\n", 0, end)) + 1
            word = text[a:end]
            b = end
            mm = _WORD.match(text, start)
            nxt = mm.group(0) if mm else ""
            core = word.rstrip(CLOSE)
            close = word[len(core) :]
            quoted = close[:1] != "" and close[:1] in closes
            mark = (core[-1:] if core[-1:] in STOPS + ";·" else "") + ("q" if quoted else ")" if close else "")
            shape, rshape = _shape(word), _shape(nxt)
            dash = 0
            if rshape == "dash":
                after = _WORD.match(text, mm.end() + 1) if mm else None
                rshape = "dash" + _shape(after.group(0) if after else "")
                dash = 1 if rshape == "dashlower" else 2
            if bare:
                mark = ("num" if word[-1:].isdigit() else "q" if word[-1:] in closes else "abbr" if word.endswith(".") else "") + "|" + (
                    "num" if nxt[:1].isdigit() else "ditto" if nxt.startswith("ฯ") else "open" if nxt[:1] in opens else ""
                )
                mark += within
                lk = (f"W{word[-4:]}|{mark}", f"M|{mark}", f"c{mark}")
                rk = ("", f"N{nxt[:3]}|{mark}", f"s|{mark}")
            else:
                lex = core if shape not in ("number", "ordinal") and (len(core) < 8 or "." in core[:-1]) else shape
                tail = ""
                if quoted:
                    says = _SAYS.search(text, start)
                    tail = f"T{says.group(0) if says else ''}|{mark}"
                nw = nxt.rstrip(".,;:!?")
                kind = shape if shape in ("number", "initial", "ordinal") else "w"
                mark += within
                lk = (f"W{lex}|{mark}", f"M{shape}|{mark}", f"c{mark}")
                rk = (tail, f"N{nw if len(nw) < 10 else rshape}|{kind}|{mark[-1:]}", f"s{rshape}|{kind}|{mark}")
        if within:  # what holds within quotations holds in all languages
            lk, rk = (*lk[:2], "*in"), (*rk[:2], "*in")
        out.append(Slot(end, start, lk, rk, _gap(gap), 4 if within else dash or (3 if quoted else 0)))
    return out


def _h(lang: str, name: str) -> int:
    return zlib.crc32((name if name[0] == "*" else f"{lang}|{name}").encode()) % SLOTS


_KEYS: dict[tuple, tuple[int, ...]] = {}


def _hashed(lang: str, s: Slot) -> tuple[int, ...]:
    """Table slots of a slot's contexts: three of the left side, word to class, and three of the right."""
    key = (lang, s.left, s.right)
    got = _KEYS.get(key)
    if got is None:
        if len(_KEYS) > 300_000:
            _KEYS.clear()
        got = _KEYS[key] = tuple(_h(lang, k) if k else 0 for k in (*s.left, *s.right))
    return got


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 2e-3, 1 - 2e-3)
    return np.log(p / (1 - p))


class Model:
    """Expected boundaries and slots by hashed context, of the words before and after."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.left, self.right = left, right  # (slots, 2): boundaries, all

    def odds(self, keys: np.ndarray, weight: np.ndarray | float = 4.0) -> np.ndarray:
        """Log odds of a boundary at slots (n, 6) of hashed contexts.

        P(boundary | words before), each finer context smoothed by the coarser one, times the ratio of
        the words after with and without a boundary, which is their own odds over the closing mark's.
        ``weight``: slots that a coarser context counts for."""

        def backed(table: np.ndarray, p: np.ndarray, k: np.ndarray) -> np.ndarray:
            c = table[k]
            return (c[:, 0] + weight * p) / (c[:, 1] + weight)

        base = backed(self.left, np.full(len(keys), 0.7), keys[:, 2])
        left = backed(self.left, backed(self.left, base, keys[:, 1]), keys[:, 0])
        coarse = backed(self.right, base, keys[:, 5])
        right = backed(self.right, coarse, keys[:, 4])
        tail = np.where(keys[:, 3] > 0, _logit(backed(self.right, base, keys[:, 3])) - _logit(base), 0.0)
        return _logit(left) + _logit(right) - _logit(base) + tail

    def coarse(self, keys: np.ndarray, weight: float = 4.0) -> np.ndarray:
        """The odds where only the last back-off of either side is known."""
        l, r = self.left[keys[:, 2]], self.right[keys[:, 5]]
        base = (l[:, 0] + weight * 0.7) / (l[:, 1] + weight)
        return _logit((r[:, 0] + weight * base) / (r[:, 1] + weight))


def _evidence(wide: Model, keys: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Start odds from wide gaps alone: a context that is met often enough and never or hardly ever
    at one speaks against boundaries; the classes it belongs to speak in the same way."""
    odds = np.full(len(keys), 2.5)
    stray = 0.002  # wide gaps elsewhere
    up, down = np.log(rate / stray), np.log((1 - rate) / (1 - stray))
    for table, cols in ((wide.left, (0, 1, 2)), (wide.right, (3, 4, 5))):
        worst = np.zeros(len(keys))
        for c in cols:
            k, n = table[keys[:, c]].T
            worst = np.minimum(worst, np.where(keys[:, c] > 0, k * up + (n - k) * down, 0.0))
        odds += np.clip(worst + 2.0, -8.0, 0.0)  # few contexts speak against boundaries
    return odds


KINDS, STATES = 5, 3  # kinds of slots; states: 0 after a boundary, 1 within a unit, 2 within one and past a dash and lower case


def _follow(state: int, kind: int) -> int:
    """State after a slot that holds no boundary."""
    if kind == 1:
        return 2
    return 2 if state == 2 and kind not in (2,) else 1


_NEXT = np.array([[_follow(s, k) for s in range(STATES)] for k in range(KINDS)])


def posteriors(odds: list[np.ndarray], kinds: list[np.ndarray], chain: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of a boundary at every slot of every text, by forward-backward over the texts side by side.

    ``odds``: of the n-gram model at the slots; ``chain`` (kinds, states): what the state before adds to them."""
    order = sorted(range(len(odds)), key=lambda i: -len(odds[i]))
    lengths = np.array([len(odds[i]) for i in order])
    if not len(order) or not lengths[0]:
        return [np.zeros(0) for _ in odds]
    n, m = len(order), int(lengths[0])
    o, k = np.zeros((m, n)), np.zeros((m, n), np.int64)
    for c, i in enumerate(order):
        o[: lengths[c], c] = odds[i]
        k[: lengths[c], c] = kinds[i]
    add = np.stack([chain[i] for i in order])
    live = [int(np.searchsorted(-lengths, -x, side="left")) for x in range(m + 1)]  # texts with more than x slots
    p, f = np.zeros((m, n, STATES)), np.zeros((m + 1, n, STATES))
    f[0, :, 0] = 1  # a text starts a unit
    col = np.arange(n)
    for x in range(m):
        a = live[x]
        c = col[:a]
        p[x, :a] = 1 / (1 + np.exp(-np.clip(o[x, :a, None] + add[c, k[x, :a]], -30, 30)))
        stay = f[x, :a] * (1 - p[x, :a])
        new = np.zeros((a, STATES))
        new[:, 0] = (f[x, :a] * p[x, :a]).sum(1)
        for s in range(STATES):
            np.add.at(new, (c, _NEXT[k[x, :a], s]), stay[:, s])
        f[x + 1, :a] = new / new.sum(1, keepdims=True)
    b = np.ones((n, STATES))
    out = np.zeros((m, n))
    for x in range(m - 1, -1, -1):
        a = live[x]
        c = col[:a]
        after = b[:a]
        yes = f[x, :a] * p[x, :a] * after[:, :1]
        on = np.take_along_axis(after, _NEXT[k[x, :a]], 1)
        no = f[x, :a] * (1 - p[x, :a]) * on
        out[x, :a] = yes.sum(1) / (yes.sum(1) + no.sum(1) + 1e-300)
        back = p[x, :a] * after[:, :1] + (1 - p[x, :a]) * on
        b[:a] = back / back.sum(1, keepdims=True)
    got: list[np.ndarray] = [np.zeros(0)] * len(odds)
    for c, i in enumerate(order):
        got[i] = out[: lengths[c], c]
    return got


def decide(texts: list[str], langs: list[str], model: Model, chain: dict[str, np.ndarray]) -> list[list[tuple[int, int]]]:
    """Spans of the units of each text: the posteriors of the hidden events above one half."""
    found = [slots(text.rstrip(), lang) for text, lang in zip(texts, langs)]
    keys = [_hashed(lang, s) for x, lang in zip(found, langs) for s in x]
    odds = np.clip(model.odds(np.array(keys, np.int64).reshape(-1, 6)), -30, 30)
    parts = np.split(odds, np.cumsum([len(x) for x in found])[:-1]) if found else []
    none = np.zeros((KINDS, STATES))
    post = posteriors(parts, [np.array([s.kind for s in x], np.int64) for x in found], [chain.get(g, none) for g in langs])
    out = []
    for text, mine, p in zip(texts, found, post):
        end = len(text.rstrip())
        at = len(text) - len(text.lstrip())
        spans = []
        for s, x in zip(mine, p):
            if x > 0.5 and s.end > at:
                spans.append((at, s.end))
                at = s.start
        if at < end:
            spans.append((at, end))
        out.append(spans)
    return out


COLS = ["lang", "l0", "l1", "l2", "r0", "r1", "r2", "wide", "pl", "pr", "pwide", "pkind", "kind", "n"]
SCHEMA = "lang string, l0 int, l1 int, l2 int, r0 int, r1 int, r2 int, wide int, pl int, pr int, pwide int, pkind int, kind int, n bigint"


def _contexts(bodies: DataFrame) -> DataFrame:
    """Slot counts by hashed contexts and gap, and counts of neighbouring slots by their coarse contexts (``kind`` >= 0).

    Slots before dashes are left to the chain. ``wide``: 1 a wide gap, 0 a space, -1 a line end, which says nothing, for it may be a mere wrap."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: dict[tuple, int] = {}

        def frame() -> pd.DataFrame:
            return pd.DataFrame([(*k, n) for k, n in rows.items()], columns=COLS)

        for pdf in batches:
            for text, lang in zip(pdf["body"], pdf["lang"]):
                last = (-1, -1, -1, -1)
                for s in slots(text.rstrip(), lang):
                    key, wide = _hashed(lang, s), -1 if s.gap == "line" else int(s.gap == "wide")
                    if wide >= 0 and s.kind not in (1, 2):
                        k = (lang, *key, wide, -1, -1, -1, -1, -1)
                        rows[k] = rows.get(k, 0) + 1
                    k = (lang, -1, -1, key[2], -1, -1, key[5], wide, *last, s.kind)
                    rows[k] = rows.get(k, 0) + 1
                    last = (key[2], key[5], wide, s.kind)
            if len(rows) > 200_000:
                yield frame()
                rows.clear()
        yield frame()

    got = bodies.select("body", "lang").mapInPandas(run, SCHEMA)
    return got.groupBy(*COLS[:-1]).agg(F.sum("n").alias("n"))


def _chain(pairs: pd.DataFrame, model: Model, rates: dict[str, float], rounds: int = 4, trust: float = 20.0) -> dict[str, np.ndarray]:
    """What the state before a slot adds to its odds, by language, kind of slot and state: expectation-maximisation
    over the counts of neighbouring slots. A coarse context's odds are the n-gram model's at its last back-off.

    Only dashes depend on what lies before the n-gram; elsewhere nothing is added. The share of boundaries at a kind and state is that of wide gaps over their share at boundaries; the n-gram
    model's own expectation counts as ``trust`` slots."""
    out: dict[str, np.ndarray] = {}

    def coarse(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = np.zeros((len(left), 6), np.int64)
        keys[:, 2], keys[:, 5] = np.maximum(left, 0), np.maximum(right, 0)
        return model.coarse(keys)

    for lang, d in pairs.groupby("lang"):
        r, n = rates.get(lang, 0.2), d["n"].to_numpy(float)
        seen = lambda w: np.where(w > 0, 5.0, np.where(w == 0, np.log1p(-min(r, 0.9)), 0.0))
        kind, first = d["kind"].to_numpy(), d["pkind"].to_numpy() < 0
        before = np.where(first, 30.0, coarse(d["pl"].to_numpy(), d["pr"].to_numpy()) + seen(d["pwide"].to_numpy()))
        here, gap = coarse(d["l2"].to_numpy(), d["r2"].to_numpy()), seen(d["wide"].to_numpy())
        inside = np.where(d["pkind"].to_numpy() == 1, 2, 1)  # the state where no boundary was
        prior = 1 / (1 + np.exp(-np.clip(before, -30, 30)))
        add = np.zeros((KINDS, STATES))
        for _ in range(rounds):
            odds = [here + add[kind, 0], here + add[kind, inside]]
            yes = [1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in odds]
            # the slot's gap tells of both events
            like = [y * np.exp(gap) + 1 - y for y in yes]
            w0 = prior * like[0]
            w0 = w0 / (w0 + (1 - prior) * like[1])
            known = d["wide"].to_numpy() >= 0
            wide = np.maximum(d["wide"].to_numpy(), 0)
            total, met, want = np.zeros((3, KINDS * STATES))
            for state, w, y in ((0, w0, yes[0]), (inside, 1 - w0, yes[1])):
                at = kind * STATES + state
                for acc, x in ((total, 1.0), (met, wide), (want, y)):
                    acc += np.bincount(at, n * w * known * x, KINDS * STATES)
            p0 = np.clip(want / np.maximum(total, 1e-9), 0.01, 0.99)
            p1 = np.clip((met / r + trust * p0) / (total + trust), 0.01, 0.99)
            step = np.where(total > 0, np.log(p1 / (1 - p1)) - np.log(p0 / (1 - p0)), 0.0).reshape(KINDS, STATES)
            add[1:3] = np.clip(add + step, -6, 6)[1:3]
        out[lang] = add
    return out


def _joined(batches: Iterator[pd.DataFrame], rows: int = 500_000) -> Iterator[pd.DataFrame]:
    """Batches put together up to about that many rows, for sums over tables as large as these."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _expect(contexts: DataFrame, model: Model | None, rates: dict[str, float], first: bool = False) -> Model:
    """One round: expected boundaries over all contexts, added up in fixed tables.

    With no model wide gaps are counted; the first round judges by these."""
    b = contexts.sparkSession.sparkContext.broadcast((None if model is None else (model.left, model.right), rates))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, rate = b.value
        acc = np.zeros((2, 2, SLOTS))
        for pdf in _joined(batches):
            keys = pdf[COLS[1:7]].to_numpy(np.int64)
            n, wide = pdf["n"].to_numpy(float), pdf["wide"].to_numpy() > 0
            r = pdf["lang"].map(rate).to_numpy(float)
            if tables is None:
                e = n * wide
            else:
                m = Model(*tables)
                z = (_evidence(m, keys, r) if first else m.odds(keys)) + np.where(wide, 5.0, np.log1p(-np.minimum(r, 0.9)))
                e = n / (1 + np.exp(-np.clip(z, -30, 30)))
            for side, cols in ((0, (0, 1, 2)), (1, (3, 4, 5))):
                for c in cols:
                    k = keys[:, c]
                    acc[side, 0] += np.bincount(k, e, minlength=SLOTS)
                    acc[side, 1] += np.bincount(k, n, minlength=SLOTS)
        side, at = np.nonzero(acc[:, 1])
        yield pd.DataFrame({"side": side, "slot": at, "b": acc[side, 0, at], "n": acc[side, 1, at]})

    rows = contexts.mapInPandas(run, "side int, slot int, b double, n double").groupBy("side", "slot").agg(*(F.sum(c).alias(c) for c in ("b", "n"))).toPandas()
    tables = np.zeros((2, SLOTS, 2))
    n, b = rows["n"].to_numpy(float), rows["b"].to_numpy(float)
    tables[rows["side"], rows["slot"], 0] = np.minimum(b, n)
    tables[rows["side"], rows["slot"], 1] = n
    tables[:, 0] = 0
    return Model(tables[0], tables[1])


def train(bodies: DataFrame, rounds: int = ROUNDS) -> tuple[Model, dict[str, np.ndarray]]:
    """(n-gram model, chain) of all bodies (body, lang); the tables it collects have a size set by ``SLOTS`` and by
    the number of coarse contexts, which are classes of marks and words."""
    both = cut(_contexts(bodies))
    contexts = both.filter("kind < 0").select(*COLS[:8], "n")
    # the share of wide gaps at boundaries: that of the contexts which meet them most, by language
    by = contexts.groupBy("lang", "l1").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("wide")).alias("w")).filter("n >= 20")
    top = by.groupBy("lang").agg(F.expr("percentile(w / n, 0.75, n)").alias("rate"))
    rates = {r["lang"]: min(0.9, max(0.02, r["rate"])) for r in top.collect()}  # a row a language
    langs = [r["lang"] for r in contexts.select("lang").distinct().collect()]
    rates = {g: rates.get(g, 0.2) for g in langs}
    model = None
    for i in range(rounds):
        model = _expect(contexts, model, rates, i == 1)
    if model is None or not rates:
        return Model(np.zeros((SLOTS, 2)), np.zeros((SLOTS, 2))), {}
    return model, _chain(both.filter("kind >= 0").select("lang", "l2", "r2", "wide", "pl", "pr", "pwide", "pkind", "kind", "n").toPandas(), model, rates)


def segment(content: DataFrame, layers: list[str] | None = None) -> DataFrame:
    """(content_id, layer, char_start, char_end, sentence): units of every body, 0-based half-open code points.

    A record counts once (the greatest body of its rows); null, empty and blank bodies have no units. The
    locale's language sets quotation marks and script; an unknown or null one is read as spaced text.
    ``layers`` keeps the units of these layers; the model is of all bodies. Other columns are dropped."""
    one = (
        content.filter("body is not null")
        .groupBy("content_id")
        .agg(F.max(F.struct("body", F.coalesce(norm_locale(F.col("locale")), F.lit("")).alias("lang"), "layer")).alias("x"))
        .select("content_id", "x.*")
        .filter(F.col("body").rlike(r"\S"))
    )
    one = cut(one)
    m, chain = train(one)
    b = content.sparkSession.sparkContext.broadcast((m.left, m.right, chain))
    todo = one.filter(F.col("layer").isin(layers)) if layers else one

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, chain = b.value
        model = Model(left, right)
        for pdf in batches:
            out = []
            units = decide(pdf["body"].tolist(), pdf["lang"].tolist(), model, chain)
            for k, layer, text, spans in zip(pdf["content_id"], pdf["layer"], pdf["body"], units):
                out += [(k, layer, i, x, y, text[x:y]) for i, (x, y) in enumerate(spans, 1)]
            yield pd.DataFrame(out, columns=["content_id", "layer", "sentence_no", "char_start", "char_end", "sentence"])

    return todo.select("content_id", "layer", "body", "lang").mapInPandas(
        run, "content_id bigint, layer string, sentence_no int, char_start int, char_end int, sentence string"
    )
