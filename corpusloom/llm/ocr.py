"""Noise in text from scanned pages: running headers, page numbers, broken and misread words.

Line and line-pair classifiers (hashed logistic regression) find furniture and words broken over two
lines; their labels come from clean bodies of the corpus, wrapped and broken by us, and from lines that
recur over scanned records. Unknown words get candidates through an inverted join on the rarest character
q-grams; gradient-boosted ranking, trained on words misread by us, chooses a replacement or none."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.address import norm_locale
from ..session import cut
from . import logistic
from .boosting import Boosted

SAMPLE = 3_000  # clean bodies a language that the line classifiers learn from
RECURRING = 4_000  # recurring lines a language that they learn from
RANKER = 20_000  # words that the ranker learns from
HEAVY = 8_192  # most frequent words and lines, held by every task; the others are joined, with the same result
DIMS = 1 << 14
Q = 3
PAGES, TEXTS = 1_000, 5_000  # bodies of a language, scanned and clean, that counts stand for: of larger corpora they are taken down to that

#: Glyphs that scanning takes for one another (right, misread), by script.
CONFUSED = {
    "latin": [("o", "0"), ("l", "1"), ("i", "!"), ("i", "1"), ("s", "5"), ("b", "6"), ("g", "9"), ("e", "c"), ("m", "rn"), ("d", "cl"), ("h", "li"), ("w", "vv"), ("z", "2"), ("t", "+")],
    "cyrillic": [("о", "0"), ("з", "3"), ("а", "a"), ("е", "e"), ("о", "o"), ("р", "p"), ("с", "c"), ("х", "x"), ("т", "m"), ("у", "y"), ("ы", "ьі"), ("ы", "ьi"), ("к", "k"), ("и", "u"), ("п", "n"), ("б", "6"), ("ч", "4"), ("в", "b"), ("н", "h"), ("м", "m")],
}
HYPHENS = "-‐‑¬­"
_TOKEN = re.compile(r"[\w!+]*[^\W\d_][\w!+]*(?:-[^\W\d_]+)*")
_WORDS = re.compile(r"[^\W\d_]+")
_WIDE = re.compile(r"\s{2,}")
_ROMAN = re.compile(r"[ivxlcdm]+", re.I)
_DIGITS = re.compile(r"\d+")
_NUMERAL = re.compile(r"\d+|\b[IVXLCDM]+\b")
PIECE = 12  # most characters of a number set beside a header


CYRILLIC = ("ru", "uk", "bg", "sr", "be")


def script(lang: str) -> str:
    return "cyrillic" if lang in CYRILLIC else "latin"


def tokens(text: str) -> list[str]:
    return [t for t in (w.rstrip("!+").lower() for w in _TOKEN.findall(text)) if t]


def line_key(line: str) -> str:
    """A line as it recurs: white space squeezed, numbers alike, Roman ones too."""
    return _NUMERAL.sub("9", " ".join(unspaced(line).split()))


def unspaced(line: str) -> str:
    """Letter-spaced words written together."""
    parts = re.split(r"\s{2,}", line.strip())
    if len(parts) > 1 and all(len(x) == 1 for p in parts for x in p.split(" ")):
        return " ".join(p.replace(" ", "") for p in parts)
    return line


def pieces(line: str) -> list[tuple[str, str, str]]:
    """(side, piece, rest): short pieces with a number that wide white space parts from a line's either end."""
    if "  " not in line and "\t" not in line:
        return []
    gaps = [m.span() for m in _WIDE.finditer(line)]
    out = []
    if gaps:
        for side, piece, rest in (("head", line[: gaps[0][0]], line[gaps[0][1] :]), ("tail", line[gaps[-1][1] :], line[: gaps[-1][0]])):
            letters = "".join(_WORDS.findall(piece))
            if 0 < len(piece) <= PIECE and rest and (_DIGITS.search(piece) or len(letters) > 1 and _ROMAN.fullmatch(letters) or piece.strip("-–—[]() ") in ("i", "v", "x", "l", "c", "d", "m")):
                out.append((side, piece, rest))
    return out


def key_of(line: str) -> str:
    """The key under which a line's recurrence is counted: without a number set beside it."""
    found = pieces(line)
    return line_key(found[0][2] if found else line)


class Page:
    """Lines of a body and what stands around each."""

    def __init__(self, lines: list[str]):
        self.lines = [x.strip() for x in lines]
        filled = sorted(len(x) for x in self.lines if x)
        self.width = float(filled[len(filled) // 2]) if filled else 1.0
        n = len(lines)
        self.prev, self.next = [""] * n, [""] * n
        last = ""
        for i, x in enumerate(self.lines):
            self.prev[i] = last
            last = x or last
        last = ""
        for i in range(n - 1, -1, -1):
            self.next[i] = last
            last = self.lines[i] or last


def _style(text: str) -> str:
    """A short line or piece with its number as a sign: how page numbers are set."""
    if len(text) > PIECE:
        return "long"
    s = _DIGITS.sub(lambda m: "9" * min(4, len(m.group())), text)
    letters = "".join(_WORDS.findall(s))
    return s.replace(letters, "r") if letters and _ROMAN.fullmatch(letters) and "9" not in s else s


def line_features(page: Page, i: int, raw: str, side: str, freq: float, known: Callable[[str], bool]) -> list[str]:
    """What is seen of a line (or a piece at one ``side`` of it) and its neighbours."""
    line = unspaced(raw) if "  " in raw else raw
    words = _WORDS.findall(line)
    caps = long_caps = longs = 0
    upper = bool(words)
    for w in words:
        up = w[0].isupper()
        caps += up
        if len(w) > 3:
            longs += 1
            long_caps += up
        upper = upper and (len(w) == 1 or w.isupper())
    prev, nxt = page.prev[i], page.next[i]
    open_prev = bool(prev) and prev[-1] not in ".!?…»”\"]:"
    low_next = nxt[:1].islower()
    end = line[-1:]
    stop = "stop" if end in ".!?…" and end else "no"
    if _DIGITS.search(line[-4:]) and not line[-1:].isalpha():
        stop = "num"
    shape = "upper" if upper else "title" if caps and long_caps == longs else "cap" if words and words[0][0].isupper() else "low" if words else "none"
    n = min(len(words), 8)
    lone = (i == 0 or not page.lines[i - 1]) and (i + 1 >= len(page.lines) or not page.lines[i + 1])
    near = _style(prev) != "long" and bool(prev) or _style(nxt) != "long" and bool(nxt)
    place = "first" if not prev else "last" if not nxt else "num" if near else "in"
    f = f"f{min(12, round(freq).bit_length())}"
    style = _style(raw)
    seen = sum(map(known, words)) * 4 // max(1, len(words))
    return [
        f"shape={shape}|{stop}", f"spaced={line is not raw and line != raw}", f"n={n}|{shape}", f"short={int(4 * len(line) / max(page.width, 1))}|{shape}", f"place={place}|{shape}",
        f"break={open_prev}{low_next}|{shape}", f"lone={lone}|{shape}|{stop}", f"{f}|{shape}", f"{f}|{stop}", f"{f}|n={n}", f"prev={open_prev}|{stop}", f"place={place}|{stop}|{f}",
        f"first={words[0].lower() if words else ''}|{stop}", f"known={seen}|{shape}|{stop}", f"style={style}|{side}", f"long={style == 'long'}|{side}|{place}", f"{f}|{side}", f"inner={'. ' in line}|{shape}",
        f"roman={bool(words) and words[-1].isupper() and bool(_ROMAN.fullmatch(words[-1]))}|{shape}",
    ]


def pair_features(left: str, mark: str, right: str, known: Callable[[str], bool]) -> list[str]:
    """What is seen of two halves of a word at a line's end and the next one's start."""
    joined, kept = known(left + right), known(f"{left}-{right}")
    kind = "plain" if mark.strip() == "-" else "soft"
    return [
        f"kind={kind}", f"joined={joined}", f"kept={kept}", f"both={joined}{kept}|{kind}", f"halves={known(left)}{known(right)}|{joined}", f"lower={right[:1].islower()}",
    ]


_HYPHEN_END = re.compile(rf"([^\W\d_][\w!]*)([{HYPHENS}]\s*)$")
_WORD_START = re.compile(r"\s*([\w!]*[^\W\d_][\w!]*)")


def broken(lines: list[str]) -> list[tuple[str, str, str]]:
    """(left, mark, right) of every word that may go on in the next line."""
    out = []
    for a, b in itertools.pairwise(x for x in lines if x.strip()):
        if a.rstrip()[-1:] in HYPHENS and (m := _HYPHEN_END.search(a[-60:])) and (w := _WORD_START.match(b)):
            out.append((m[1], m[2], w[1]))
    return out


_INDEX: dict[str, int] = {}


def _index(name: str) -> int:
    got = _INDEX.get(name)
    if got is None:
        if len(_INDEX) > 500_000:
            _INDEX.clear()
        got = _INDEX[name] = zlib.crc32(name.encode()) % DIMS
    return got


class Lines:
    """Trained classifiers of one language: of lines (header, page number) and of line pairs (broken word)."""

    def __init__(self, header: np.ndarray, number: np.ndarray, join: np.ndarray):
        self.header, self.number, self.join = header.tolist(), number.tolist(), join.tolist()

    def odds(self, names: list[str], *models: list[float]) -> list[float]:
        at = {_index(n) for n in names}
        return [m[-1] + sum([m[i] for i in at]) for m in models]

    def clean(self, body: str, known: Callable[[str], bool], freq: Callable[[str], float]) -> tuple[str, set[str]]:
        """(continuous text, defects): furniture dropped, broken words joined, lines of a paragraph too.

        Every line is judged, and the piece beside wide white space apart from the rest of its line."""
        lines = body.split("\n")
        page = Page(lines)
        defects: set[str] = set()
        left: list[str] = []
        for i, (line, s) in enumerate(zip(lines, page.lines)):
            if not s:
                left.append(line)
                continue
            found = pieces(s)
            what: set[str] = set()
            for side, piece, rest in found:
                (n,) = self.odds(line_features(page, i, piece, side, 0, known), self.number)
                if n > 0 and self.odds(line_features(page, i, rest, "rest", freq(line_key(rest)), known), self.header)[0] > 0:
                    what = {"header", "page_number"}
            if not what:
                h, n = self.odds(line_features(page, i, s, "whole", freq(key_of(s)), known), self.header, self.number)
                if max(h, n) > 0:
                    what = {"page_number" if n > h else "header"}
            defects |= what
            if not what:
                left.append(line)
        # an emptied paragraph break between two halves of a sentence stays one paragraph
        out: list[str] = []
        for line in left:
            s = line.strip()
            if not s:
                if out and out[-1] != "":
                    out.append("")
                continue
            if out and out[-1] != "":
                tail = out[-1][-60:]
                m = _HYPHEN_END.search(tail) if tail.rstrip()[-1:] in HYPHENS else None
                w = _WORD_START.match(line) if m else None
                if m and w:
                    at = len(out[-1]) - len(tail) + m.start(2)
                    if self.odds(pair_features(m[1], m[2], w[1], known), self.join)[0] > 0:
                        defects.add("hyphen")
                        out[-1] = out[-1][:at] + s
                    else:
                        out[-1] = out[-1][:at] + "-" + s
                else:
                    out[-1] += " " + s
            else:
                out.append(s)
        return "\n\n".join(x for x in out if x), defects


def _wrap(text: str, width: int) -> list[str]:
    out: list[str] = []
    for para in text.split("\n\n"):
        line = ""
        for w in para.split():
            if line and len(line) + 1 + len(w) > width:
                out.append(line)
                line = w
            else:
                line = f"{line} {w}".strip()
        out += [line, ""]
    return out[:-1]


#: How page numbers are set.
_NUMBERS = ["{}", "{}", "{}", "- {} -", "— {} —", "– {} –", "[{}]", "({})", "p. {}", "стр. {}", "-{}-", "· {} ·"]


def _roman(k: int) -> str:
    out = ""
    for value, sign in ((50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (k // value)
        k %= value
    return out


def _number(rng: np.random.Generator) -> str:
    n = int(rng.integers(1, 400))
    if rng.random() < 0.25:
        roman = _roman(n % 60 + 1)
        return _NUMBERS[int(rng.integers(0, len(_NUMBERS)))].format(roman if rng.random() < 0.8 else roman.upper())
    return _NUMBERS[int(rng.integers(0, len(_NUMBERS)))].format(n)


def is_number(line: str) -> bool:
    """Label of a recurring line: a number with hardly anything beside it."""
    s = _style(line)
    return s != "long" and ("9" in s or "r" in s) and sum(c.isalpha() for c in s.replace("r", "")) <= 3


def is_furniture(line: str, seen: set[tuple[str, str]]) -> bool:
    """Label of a line that recurs over records: most of its word pairs never occur in clean text.

    A first word that goes on from the line before, and the last one before a hyphen, may be halves."""
    line = unspaced(line)
    words = [w.lower() for w in _WORDS.findall(line)]
    if words and line[:1].islower() and (words[0], "") not in seen:
        words = words[1:]
    if words and line[-1:] in HYPHENS:
        words = words[:-1]
    pairs = list(itertools.pairwise(words)) or [(w, "") for w in words]
    return sum(p in seen for p in pairs) < 0.6 * len(pairs)


def word_pairs(bodies: list[str]) -> set[tuple[str, str]]:
    seen: set[tuple[str, str]] = set()
    for b in bodies:
        words = [w.lower() for w in _WORDS.findall(b)]
        seen.update(itertools.pairwise(words))
        seen.update((w, "") for w in words)
    return seen


def wrapped(bodies: list[str], seed: int = 5) -> list[list[str]]:
    """Clean bodies set in lines, as the classifiers learn from them."""
    rng = np.random.default_rng(seed)
    return [_wrap(b, int(rng.integers(40, 72))) for b in bodies]


def _train_lines(set_lines: list[list[str]], recurring: list[tuple[str, int]], freq: dict[str, int], words: set[str], seed: int = 5) -> Lines:
    """Learns from clean bodies set in lines, with running headers (lines that recur) and page numbers put in by us.

    Headers also come in lower case and drawn out, so that neither case nor length decides by itself."""
    rng = np.random.default_rng(seed)
    known = lambda w: w.lower() in words
    rows: list[np.ndarray] = []
    as_header: list[float] = []
    as_number: list[float] = []

    numbers = [(x, n) for x, n in recurring if is_number(x)]
    recurring = [(x, n) for x, n in recurring if not is_number(x)]
    often = np.sqrt([n for _, n in numbers])

    def add(page: Page, i: int, text: str, side: str, n: int, header: float, number: float) -> None:
        rows.append(np.array(sorted({_index(x) for x in line_features(page, i, text, side, n, known)}), np.int64))
        as_header.append(header)
        as_number.append(number)

    for lines in set_lines:
        page = Page(lines)
        for i in {int(k) for k in rng.integers(0, len(lines), 6)} | {len(lines) - 1, 0}:
            if lines[i]:
                add(page, i, page.lines[i], "whole", freq.get(key_of(page.lines[i]), 0), 0.0, 0.0)
        at = 0 if rng.random() < 0.5 else int(rng.integers(0, len(lines) + 1))
        if recurring and rng.random() < 0.75:
            head, n = recurring[int(rng.integers(0, len(recurring)))]
            k = int(rng.integers(1, 30))
            head = head.replace("9", _roman(k).upper() if rng.random() < 0.5 else str(k))
            if (r := rng.random()) < 0.12:
                head = head.lower()
            elif r < 0.24:
                head = f"{head} {recurring[int(rng.integers(0, len(recurring)))][0]}"
            # seldom headers must be known without their count
            k = n if rng.random() < 0.6 or head == head.lower() else int(rng.integers(0, 4))
            number = _number(rng)
            side, line = ("head", f"{number}    {head}") if rng.random() < 0.5 else ("tail", f"{head}    {number}")
            if rng.random() < 0.5:
                page = Page([*lines[:at], line, *lines[at:]])
                add(page, at, number, side, 0, 0.0, 1.0)
                add(page, at, head, "rest", k, 1.0, 0.0)
            else:
                page = Page([*lines[:at], head, *lines[at:]])
                add(page, at, head, "whole", k, 1.0, 0.0)
        if rng.random() < 0.5:
            number, n = _number(rng), int(2 ** (rng.random() * 12))
            if numbers and rng.random() < 0.5:
                number, n = numbers[int(rng.choice(len(numbers), p=often / often.sum()))]
                number = number.replace("9", str(int(rng.integers(1, 400))))
            page = Page([*lines[:at], number, *lines[at:]])
            add(page, at, number, "whole", n, 0.0, 1.0)
    fit = lambda labels: logistic.fit(rows, np.array(labels), DIMS, 12) if any(labels) else np.concatenate([np.zeros(DIMS), [-9.0]])
    header, number = fit(as_header), fit(as_number)
    rows, labels = [], []
    whole = [w for lines in set_lines for w in re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", " ".join(lines))]
    for k in rng.permutation(len(whole))[:8000] if whole else []:
        w = whole[int(k)]
        hold = known
        if "-" in w:
            a, _, b = w.partition("-")
            mark, y = "-", 0.0
        elif len(w) > 4:
            at = int(rng.integers(2, len(w) - 2)) if len(w) > 5 else 2
            a, b, y = w[:at], w[at:], 1.0
            mark = "-" if rng.random() < 0.6 else "¬"
            if rng.random() < 0.2:
                hold = lambda x, w=w: known(x) and x.lower() != w.lower()
        else:
            continue
        rows.append(np.array(sorted({_index(x) for x in pair_features(a, mark, b, hold)}), np.int64))
        labels.append(y)
    join = logistic.fit(rows, np.array(labels), DIMS, 12) if rows else np.concatenate([np.zeros(DIMS), [9.0]])
    return Lines(header, number, join)


def skeleton(word: str, kind: str) -> str:
    """Glyphs that are taken for one another written alike."""
    s = word
    for right, wrong in sorted(CONFUSED[kind], key=lambda x: -len(x[1])):
        s = s.replace(wrong, right)
    return s


def _skeleton(word: Column, lang: Column) -> Column:
    """``skeleton`` as built-in functions."""

    def of(kind: str) -> Column:
        s = word
        for right, wrong in sorted(CONFUSED[kind], key=lambda x: -len(x[1])):
            s = F.replace(s, F.lit(wrong), F.lit(right))
        return s

    return F.when(lang.isin(*CYRILLIC), of("cyrillic")).otherwise(of("latin"))


def _edit(a: str, b: str, most: int = 2) -> int:
    """Edit distance up to ``most``; more gives most + 1. For the ranker's training sample only."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return min(row[-1], most + 1)


def _odd(word: str, kind: str) -> int:
    """Signs within a word that it can't have: digits, marks, letters of another script."""
    if kind == "cyrillic":
        return sum(not ("а" <= c <= "я" or c in "ё-") for c in word)
    return sum(not (c.isalpha() and c.isascii() or c in "-'’" or c > "\x7f") for c in word)


def rank_features(word: str, candidate: str, n_word: int, n_candidate: int, kind: str) -> list[float]:
    return _ranked(_edit(skeleton(word, kind), skeleton(candidate, kind)), _edit(word, candidate), n_word, n_candidate, _odd(word, kind), len(word))


def _ranked(apart_skeleton, apart, n_word, n_candidate, odd, size) -> list:
    """Features of a word and a candidate; numbers or columns of them alike."""
    return [apart_skeleton * 1.0, apart * 1.0, np.log1p(n_candidate), np.log1p(n_word), odd * 1.0, size * 1.0, np.log1p(n_candidate) - np.log1p(n_word)]


def _misread(word: str, kind: str, rng: np.random.Generator) -> str:
    can = [(r, w) for r, w in CONFUSED[kind] if r in word]
    if not can:
        return word
    r, w = can[int(rng.integers(0, len(can)))]
    places = [m.start() for m in re.finditer(re.escape(r), word)]
    at = places[int(rng.integers(0, len(places)))]
    return word[:at] + w + word[at + len(r) :]


def _train_ranker(vocabulary: list[tuple[str, str, int]], seed: int = 3) -> Boosted:
    """Learns from words misread by us (right candidate against near ones) and from sound words taken as unknown."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    by: dict[tuple[str, str], list[tuple[str, int]]] = {}
    for lang, w, n in vocabulary:
        s = skeleton(w, script(lang))
        for g in {s[:3], s[-3:]}:
            by.setdefault((lang, g), []).append((w, n))
    for k in rng.permutation(len(vocabulary))[:3000]:
        lang, w, n = vocabulary[int(k)]
        kind = script(lang)
        bad = _misread(w, kind, rng)
        if bad != w and len(w) > 2:
            count = 1 + int(rng.integers(0, 3))
            x.append(rank_features(bad, w, count, n if rng.random() < 0.85 else 0, kind))
            y.append(1.0)
            near = by.get((lang, skeleton(w, kind)[:3]), [])
            for _ in range(2):
                if near:
                    o, m = near[int(rng.integers(0, len(near)))]
                    if o != w:
                        x.append(rank_features(bad, o, count, m, kind))
                        y.append(0.0)
        near = by.get((lang, skeleton(w, kind)[-3:]), []) + by.get((lang, skeleton(w, kind)[:3]), [])
        close = [c for c in near[:60] if c[0] != w and _edit(c[0], w) <= 2][:3]
        for o, m in close:
            x.append(rank_features(w, o, max(1, n // 10), m, kind))
            y.append(0.0)
    if not x or not any(y):
        return Boosted(0)
    return Boosted().fit(np.array(x), np.array(y))


def uncut(text: str) -> str:
    """A body without a word that runs to its end, which may be half a word: bodies are cut."""
    return re.sub(r"[\w!+-]+\Z", "", text) if text[-1:].isalpha() else text


def _count_tokens(df: DataFrame, name: str) -> DataFrame:
    """Counts of the words of (lang, text), without words that a body's end may have cut: in a large corpus every half
    word occurs twice somewhere."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: dict[tuple[str, str], int] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                for w in tokens(uncut(text)):
                    count[lang, w] = count.get((lang, w), 0) + 1
            if len(count) > 500_000:
                yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["lang", "word", "n"])
                count.clear()
        yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["lang", "word", "n"])

    got = df.select("lang", "text").mapInPandas(run, "lang string, word string, n bigint")
    return got.groupBy("lang", "word").agg(F.sum("n").alias(name))


def _sample(df: DataFrame, by: str, key: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, the same ones whatever the order of the data.

    A share drawn by hash, a little over what is wanted, comes first, so that no task sees more than that."""
    sizes = df.groupBy(by).agg(F.count("*").alias("_all"))  # a row a language
    drawn = df.join(F.broadcast(sizes), by).withColumn("_h", F.xxhash64(*key))
    drawn = drawn.filter(F.pmod("_h", F.lit(1_000_000)) <= F.lit(1_500_000.0 * most) / F.col("_all") + 200)
    return drawn.withColumn("_r", F.row_number().over(W.partitionBy(by).orderBy("_h", *key))).filter(F.col("_r") <= most).drop("_all", "_h", "_r")


def _lookup(asked: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """(key, counts): map of the asked items (lang, item) that have a count."""
    got = asked.join(counts, ["lang", "item"])
    return got.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias("counts"))


def _down(counts: DataFrame, sizes: dict[str, int], to: int) -> Column:
    """Counts taken down to ``to`` bodies of a language; of fewer bodies they stay.

    What recurs in a share of the bodies has the same figure in a corpus of any size, as the classifiers learn it."""
    size = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, float(max(1, n)))]) if sizes else F.create_map(F.lit(""), F.lit(1.0))
    return counts["n"] * F.least(F.lit(1.0), F.lit(float(to)) / F.coalesce(F.try_element_at(size, counts["lang"]), F.lit(1.0)))


def _scan_pages(pages: DataFrame, heavy) -> DataFrame:
    """(content_id, lang, items): what must be looked up to judge a body: its words ('w...'), words joined over a line's
    end and the keys of its lines ('l...'), without the words that every task holds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = heavy.value
        for pdf in batches:
            out = []
            for lang, body in zip(pdf["lang"], pdf["body"]):
                lines = [x for x in (x.strip() for x in body.split("\n")) if x]
                words = set(tokens(body))
                words.update(w.lower() for w in _WORDS.findall(body))
                for a, _, b in broken(lines):
                    words |= {(a + b).lower(), f"{a}-{b}".lower(), a.lower(), b.lower()}
                keys = {line_key(rest) for x in lines for _, _, rest in pieces(x)} | {key_of(x) for x in lines}
                out.append([*("w" + w for w in words if (lang, "w" + w) not in held), *("l" + k for k in keys)])
            yield pd.DataFrame({"content_id": pdf["content_id"], "lang": pdf["lang"], "items": out})

    return pages.select("content_id", "lang", "body").mapInPandas(run, "content_id bigint, lang string, items array<string>")


def clean_pages(content: DataFrame, reports: DataFrame) -> DataFrame:
    """(content_id, lang, text, defects, fixes): records of scanned runs with what was found.

    A record counts once; a run is scanned if any of its rows says so; null and blank bodies have no defects.
    ``fixes``: misread word to replacement. ``text`` is continuous, misread words still as they were. Words of one
    or two letters have no candidates: one edit makes any of them any other. Classifiers learn from bounded samples
    of each language (``SAMPLE``, ``RECURRING``, ``RANKER``); counts of words and lines are of all records, and each
    body is joined to those of its own words and lines. Counts are judged by their share of the bodies (``PAGES``, ``TEXTS``),
    so that lines that recur by chance in a large corpus are no headers and misread words that recur are no words."""
    spark = content.sparkSession
    scanned = reports.groupBy("run_id").agg(F.max(F.coalesce("ocr_applied", F.lit(False))).alias("ocr"))
    one = content.filter("body is not null").groupBy("content_id").agg(F.max(F.struct("body", "run_id", norm_locale(F.col("locale")).alias("lang"), "layer")).alias("x")).select("content_id", "x.*")
    one = one.filter(F.col("body").rlike(r"\S")).withColumn("lang", F.coalesce("lang", F.lit("")))
    all_ = cut(one.join(scanned, "run_id", "left").select("content_id", "lang", "body", "layer", F.coalesce("ocr", F.lit(False)).alias("ocr")))
    pages, clean = all_.filter("ocr"), all_.filter("not ocr")
    groups = pages.groupBy("lang", "layer").agg(F.count("*").alias("n")).collect()  # languages and layers are few
    n_pages: dict[str, int] = {}
    for r in groups:
        n_pages[r["lang"]] = n_pages.get(r["lang"], 0) + r["n"]
    langs, layers = sorted({r["lang"] for r in groups}), [x for x in {r["layer"] for r in groups} if x is not None]
    clean = clean.filter(F.col("lang").isin(langs or [""]))
    n_clean = {r["lang"]: r["n"] for r in clean.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    vocabulary = _count_tokens(clean.withColumnRenamed("body", "text"), "n").filter("n > 1")
    vocabulary = cut(vocabulary.withColumn("n", _down(vocabulary, n_clean, TEXTS)))
    words = vocabulary.select("lang", F.concat(F.lit("w"), "word").alias("item"), "n")
    hold = lambda df: {(r["lang"], r["item"]): r["n"] for r in df.orderBy(F.desc("n"), "lang", "item").limit(HEAVY).collect()}
    heavy_words = hold(words)
    scan = cut(_scan_pages(pages, spark.sparkContext.broadcast(heavy_words)))
    asked = scan.select("content_id", "lang", F.explode("items").alias("item"))
    lines = asked.filter("item like 'l%'").groupBy("lang", "item").agg(F.count("*").alias("n"))
    recurring = cut(lines.withColumn("n", _down(lines, n_pages, PAGES)).filter("n > 1.5"))
    heavy_lines = hold(recurring)
    models = _models(clean, layers, recurring, words)
    b = spark.sparkContext.broadcast((models, heavy_words | heavy_lines))
    held = F.broadcast(spark.createDataFrame(list(heavy_lines) or [(None, None)], "lang string, item string"))  # at most HEAVY rows
    rest = _lookup(asked.join(held, ["lang", "item"], "left_anti"), words.unionByName(recurring), "content_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models, heavy = b.value
        for pdf in batches:
            out = []
            for k, lang, body, mine in zip(pdf["content_id"], pdf["lang"], pdf["body"], pdf["counts"]):
                mine = dict(mine) if mine is not None else {}

                def count(item: str, lang=lang, mine=mine) -> float:
                    return mine.get(item) or heavy.get((lang, item), 0)

                text, defects = models[lang].clean(body, lambda w: count("w" + w.lower()) > 0, lambda x: count("l" + x))
                out.append((k, lang, text, sorted(defects), sorted({w for w in tokens(text) if not count("w" + w)})))
            yield pd.DataFrame(out, columns=["content_id", "lang", "text", "defects", "unknown"])

    todo = pages.select("content_id", "lang", "body").join(rest, "content_id", "left")
    read = cut(todo.mapInPandas(run, "content_id bigint, lang string, text string, defects array<string>, unknown array<string>"))
    # unknown words (all of them are outside the vocabulary) and their candidates
    types = read.select("lang", F.explode("unknown").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    types = types.withColumn("n", F.greatest(F.lit(1.0), _down(types, n_pages, PAGES)))
    fixes = _fixes(types, vocabulary)
    per = read.select("content_id", "lang", F.explode("unknown").alias("word")).join(fixes, ["lang", "word"]).groupBy("content_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "fix"))).alias("fixes"))
    return read.select("content_id", "lang", "text", "defects").join(per, "content_id", "left")


def _models(clean: DataFrame, layers: list[str], recurring: DataFrame, words: DataFrame) -> dict[str, Lines]:
    """Line classifiers by language, from samples; the counts of the sample's words and lines are joined, not collected whole."""
    spark = clean.sparkSession
    if layers:
        clean = clean.filter(F.col("layer").isin(layers))
    sample = _sample(clean.select("lang", "content_id", "body"), "lang", ["content_id"], SAMPLE).orderBy("lang", "content_id").toPandas()
    often = _sample(recurring.filter("n > 2.5"), "lang", ["item"], RECURRING).orderBy("lang", "item").toPandas()
    ask, set_lines = [], {}
    for lang, bodies in sample.groupby("lang")["body"]:
        set_lines[lang] = wrapped([x for x in bodies if len(x) > 80])
        keys = {key_of(x.strip()) for lines in set_lines[lang] for x in lines if x.strip()}
        seen = {w.lower() for lines in set_lines[lang] for x in lines for w in _WORDS.findall(x)} | set(tokens(" ".join(bodies)))
        seen |= {w.lower() for x in often[often["lang"] == lang]["item"] for w in _WORDS.findall(x[1:])}
        ask += [(lang, "l" + k) for k in keys] + [(lang, "w" + w) for w in seen]
    asked = spark.createDataFrame(ask or [("", "")], "lang string, item string").withColumn("k", F.lit(0))
    got = asked.join(words.unionByName(recurring), ["lang", "item"]).select("lang", "item", "n").toPandas()
    models: dict[str, Lines] = {}
    for lang in {*sample["lang"], *often["lang"]} | {""}:
        mine = got[got["lang"] == lang]
        count = dict(zip(mine["item"], mine["n"]))
        seen = word_pairs(list(sample[sample["lang"] == lang]["body"]))
        heads = [(x[1:], n) for x, n in zip(often[often["lang"] == lang]["item"], often[often["lang"] == lang]["n"]) if is_furniture(x[1:], seen)]
        freq = {k[1:]: n for k, n in count.items() if k[0] == "l"}
        models[lang] = _train_lines(set_lines.get(lang, []), heads, freq, {k[1:] for k in count if k[0] == "w"})
    return _Models(models)


class _Models(dict):
    """Models by language; a language without clean text or recurring lines has the one that finds nothing."""

    def __missing__(self, lang: str) -> Lines:
        return self[""]


def _fixes(types: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, word, fix) for unknown words that are misread.

    Words and candidates meet in an inverted join on their rarest q-grams: one edit touches ``Q`` grams, so of two
    words one edit apart (glyphs alike counted as one) any ``Q`` + 1 rarest grams have one in common."""
    spark = types.sparkSession
    sampled = vocabulary.filter(F.length("word") > 2).orderBy(F.xxhash64("lang", "word"), "lang", "word").limit(RANKER)
    ranker = spark.sparkContext.broadcast(_train_ranker(sorted((r["lang"], r["word"], r["n"]) for r in sampled.collect())))

    def grams(df: DataFrame) -> DataFrame:
        s = df.filter(F.length("word") > 2).withColumn("s", _skeleton(F.col("word"), F.col("lang")))
        padded = F.concat(F.lit("^"), "s", F.lit("$"))
        g = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("s") + 3 - Q), lambda i: F.substring(padded, i, F.lit(Q))))
        return s.filter(F.length("s") > 0).withColumn("gram", F.explode(g))

    trusted = cut(grams(vocabulary))
    counts = trusted.groupBy("lang", "gram").agg(F.count("*").alias("k"))

    def rarest(df: DataFrame) -> DataFrame:
        x = df.join(counts, ["lang", "gram"], "left").groupBy("lang", "word", "s", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("k", F.lit(0)).alias("k"), "gram"))).alias("g"))
        return x.select("lang", "word", "s", "n", F.explode(F.transform(F.slice("g", 1, Q + 1), lambda y: y["gram"])).alias("gram"))

    a = rarest(grams(types))
    b = rarest(trusted).select("lang", "gram", F.col("word").alias("candidate"), F.col("s").alias("sc"), F.col("n").alias("n_candidate"))
    near = (F.abs(F.length("s") - F.length("sc")) <= 1) & (F.levenshtein("s", "sc", 1) >= 0)
    cand = a.join(b, ["lang", "gram"]).filter(near).select("lang", "word", "n", "candidate", "n_candidate", F.levenshtein("s", "sc").alias("apart_s")).distinct()
    apart = F.levenshtein("word", "candidate", 2)
    cand = cand.withColumn("apart", F.when(apart < 0, 3).otherwise(apart))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            odd = np.array([_odd(w, script(g)) for w, g in zip(pdf["word"], pdf["lang"])], float)
            x = np.column_stack(_ranked(pdf["apart_s"].to_numpy(float), pdf["apart"].to_numpy(float), pdf["n"].to_numpy(float), pdf["n_candidate"].to_numpy(float), odd, pdf["word"].str.len().to_numpy(float)))
            yield pdf[["lang", "word", "candidate", "n_candidate"]].assign(p=ranker.value.score(x))

    scored = cand.mapInPandas(run, "lang string, word string, candidate string, n_candidate double, p double")
    best = scored.groupBy("lang", "word").agg(F.max(F.struct("p", "n_candidate", "candidate")).alias("x"))
    return best.filter("x.p > 0.5").select("lang", "word", F.col("x.candidate").alias("fix"))


def defects(read: DataFrame) -> DataFrame:
    """(content_id, defect): each kind once."""
    kinds = F.when(F.col("fixes").isNotNull(), F.array_append("defects", F.lit("misread"))).otherwise(F.col("defects"))
    return read.select("content_id", F.explode(kinds).alias("defect"))


def repaired(read: DataFrame) -> DataFrame:
    """(content_id, text, defects): continuous readable paragraphs, misread words replaced in their case."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, text, found, fixes in zip(pdf["content_id"], pdf["text"], pdf["defects"], pdf["fixes"]):
                fixes = dict(fixes) if fixes is not None else {}
                if fixes:

                    def put(m: re.Match, fixes=fixes) -> str:
                        w = m.group(0)
                        core = w.rstrip("!+")
                        new = fixes.get(core.lower())
                        if new is None:
                            return w
                        new = new.upper() if core.isupper() and len(core) > 1 else new.capitalize() if core[0].isupper() else new
                        return new + w[len(core) :]

                    text = _TOKEN.sub(put, text)
                out.append((k, text, [*found, *(["misread"] if fixes else [])]))
            yield pd.DataFrame(out, columns=["content_id", "text", "defects"])

    return read.select("content_id", "text", "defects", "fixes").mapInPandas(run, "content_id bigint, text string, defects array<string>")
