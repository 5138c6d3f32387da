"""Garbled text from a wrong character encoding: round-trip repair.

A garbled stretch is encoded again as it was read and decoded strictly as it was meant; the
result is taken when a garbling cost drops, and the round is repeated for nested layers.
UTF-8 read as something else is found by its byte pattern and judged by the rarity of the
characters; one legacy encoding read as another is judged word by word with a character bigram
model of the corpus, and the best run of words is taken."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings in which UTF-8 gets read, and (read as, meant) pairs of legacy encodings.
UTF8_AS = ["cp1252", "latin-1", "cp437", "mac_roman", "cp1251", "cp850", "koi8-r", "cp866"]
LEGACY = [
    ("cp1252", "cp1251"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("cp1252", "koi8-r"),
    ("cp1252", "cp866"), ("koi8-r", "cp866"), ("cp866", "koi8-r"), ("cp1251", "iso8859-5"), ("cp1252", "iso8859-5"), ("cp437", "cp866"),
    ("cp1252", "cp1253"), ("cp1252", "iso8859-7"), ("cp1251", "cp1253"), ("cp1252", "cp1256"), ("cp1252", "iso8859-6"), ("cp1251", "cp1256"),
    ("cp1252", "gb18030"), ("cp1252", "shift_jis"), ("cp1252", "euc_jp"), ("cp1252", "big5"), ("cp1251", "gb18030"), ("cp1251", "shift_jis"),
    ("cp437", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp850", "cp1252"), ("cp1252", "cp850"),
    ("cp1251", "cp1252"), ("cp1252", "cp874"), ("cp1251", "mac_cyrillic"), ("mac_cyrillic", "cp1251"),
]
KNOWN = 50_000  # judged stretches that a task remembers; a longer list is begun anew, with the same result
SLOTS = 1 << 20  # least size of the bigram table; it grows with the distinct pairs


def _table(enc: str) -> list[str]:
    """Character of every byte; undefined ones as the C1 control of that number."""
    return [bytes([i]).decode(enc, "ignore") or chr(i) for i in range(256)]


_CHARS = {e: _table(e) for e in {*UTF8_AS, *(a for a, _ in LEGACY)}}
_BYTES = {e: {c: i for i, c in reversed(list(enumerate(t)))} for e, t in _CHARS.items()}
for _t in _BYTES.values():
    _t.update({chr(i): i for i in range(0x80, 0xA0) if chr(i) not in _t})


def _encode(text: str, enc: str) -> bytes | None:
    try:
        return bytes(map(_BYTES[enc].__getitem__, text))
    except KeyError:
        return None


def _class(enc: str, lo: int, hi: int) -> str:
    chars = {c for c, b in _BYTES[enc].items() if lo <= b < hi}
    return "[" + "".join(map(re.escape, sorted(chars))) + "]"


def _utf8_pattern(enc: str) -> str:
    c = _class(enc, 0x80, 0xC0)
    return f"(?:{_class(enc, 0xC2, 0xE0)}{c}|{_class(enc, 0xE0, 0xF0)}{c}{c}|{_class(enc, 0xF0, 0xF5)}{c}{c}{c})"


_UTF8 = {e: re.compile(_utf8_pattern(e) + "+") for e in UTF8_AS}
#: Kinds of characters, as bits, by which garbled texts are kept out of the model of clean text.
LOWER, UPPER, ALONE, LEAD, SYMBOL, HIGH, SIGN, ROOT, DAGGER, PAIR, MIXED = (1 << i for i in range(11))


def _kinds() -> np.ndarray:
    k = np.zeros(65536, np.uint16)
    for bit, spans in (
        (LOWER, ["а-я", "ё-ё"]), (UPPER, ["А-Я", "Ё-Ё"]), (ALONE, ["\x80-\x9f", "�-�", "─-■"]), (LEAD, ["Â-Ã"]), (SYMBOL, ["\xa0-¿"]), (HIGH, ["À-ÿ"]), (ROOT, ["√-√"]), (DAGGER, ["†-†", "´-´", "ª-ª"]),
        (PAIR, ["Р-С"]), (MIXED, ["Ђ-Џ", "ђ-џ", "‚-›", "°-»"]), (SIGN, [f"{c}-{c}" for c in "¤®¬±¶µ¦Ґ"]),
    ):
        for span in spans:
            k[ord(span[0]) : ord(span[2]) + 1] |= bit
    return k


_KINDS = _kinds()
_DASHES = [(ord(_CHARS[e][0xE2]), ord(_CHARS[e][0x80])) for e in UTF8_AS]


def clearly_garbled(u: np.ndarray) -> np.ndarray:
    """Places that only garbling makes: controls, frames, UTF-8 leads before symbols, runs of high letters,
    capitals within Cyrillic words, quotation marks and dashes in each encoding."""
    k = _KINDS[np.minimum(u, 65535)]
    has = lambda bits: (k & np.uint16(bits)) > 0
    bad = has(ALONE)
    lead, symbol, high, lower, upper, sign = has(LEAD), has(SYMBOL), has(HIGH), has(LOWER), has(UPPER), has(SIGN)
    cyrillic, pair, mixed = lower | upper, has(PAIR), has(MIXED)
    bad[:-1] |= (lead[:-1] & symbol[1:]) | (has(ROOT)[:-1] & (symbol | high)[1:]) | (sign[:-1] & has(DAGGER)[1:])
    bad[:-2] |= (lower[:-2] & upper[1:-1] & upper[2:]) | (cyrillic[:-2] & sign[1:-1] & (cyrillic | sign)[2:])
    bad[:-3] |= (high[:-3] & high[1:-2] & high[2:-1] & high[3:]) | (pair[:-3] & mixed[1:-2] & pair[2:-1] & mixed[3:])
    for a, b in _DASHES:
        bad[:-1] |= (u[:-1] == a) & (u[1:] == b)
    return np.flatnonzero(bad)


def _rarity() -> np.ndarray:
    """Garbling cost of every character of the basic plane: by block, higher where text seldom goes."""
    cost = np.full(65536, 7.0, np.float32)
    cost[:0x80] = 1.0
    cost[0x80:0xA0] = 9.0
    cost[0xA0:0xC0] = 4.0
    cost[0xC0:0x180] = 3.0
    cost[0xD7] = cost[0xF7] = 4.0
    cost[0x370:0x400] = cost[0x410:0x450] = 2.0
    cost[[0x401, 0x451]] = 2.0
    cost[0x400:0x460] = np.maximum(np.where(cost[0x400:0x460] == 7.0, 4.0, cost[0x400:0x460]), 2.0)
    for lo, hi in ((0x5D0, 0x5F0), (0x600, 0x700), (0x900, 0x980), (0xE00, 0xE60), (0x3000, 0x3100), (0x4E00, 0x9FB0), (0xAC00, 0xD7A4), (0xFF00, 0xFF60)):
        cost[lo:hi] = 2.5
    cost[0x300:0x330] = 3.0
    cost[0x2010:0x2040] = 2.5
    cost[0x200B:0x200F] = 3.0
    cost[0x2070:0x2190] = 4.0
    cost[0xFB00:0xFB07] = 4.0
    cost[0x1F00:0x2000] = cost[0x1E00:0x1F00] = 4.0
    cost[0x2500:0x25A1] = 6.0
    cost[0xFFFD] = 12.0
    return cost


_RARE = _rarity()


_COMMON = (_RARE <= 4.5).tolist()
_RARE_LIST = _RARE.tolist()


def rarity(text: str) -> float:
    if len(text) < 80:
        return sum(_RARE_LIST[o] if (o := ord(c)) < 65536 else 4.0 for c in text)
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return float(np.where(u > 0xFFFF, 4.0, _RARE[np.minimum(u, 0xFFFF)]).sum())


def _slots(u: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return ((u[..., :-1] * np.uint32(2654435761)) ^ (u[..., 1:] * np.uint32(40503))) & np.uint32(slots - 1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_SPACES = np.zeros(65536, bool)
_SPACES[[i for i in range(65536) if chr(i).isspace()]] = True


class Bigrams:
    """Bits of a text under character bigram counts hashed into a table of sixteen slots a distinct pair or more."""

    def __init__(self, pairs: np.ndarray, firsts: np.ndarray):
        self.slots = len(pairs)
        self.pair = np.log2(pairs + 0.02).astype(np.float32)
        self.first = np.log2(firsts + 4.0).astype(np.float32)
        self._pair, self._first = memoryview(self.pair), memoryview(self.first)
        self.known: dict[tuple[str, str, str, str], tuple[str, float]] = {}  # stretches judged before, which recur over texts

    def each(self, u: np.ndarray) -> np.ndarray:
        """Bits of every character after the first."""
        return self.first[u[..., :-1] & np.uint32(0xFFFF)] - self.pair[_slots(u, self.slots)]

    def odd(self, u: np.ndarray, rare: float = 12.0, rare_back: float = 7.0) -> np.ndarray:
        """Places of character pairs beyond ASCII that are unlikely seen from either character."""
        u = np.where(_SPACES[np.minimum(u, 65535)], np.uint32(32), u)
        pair = self.pair[_slots(u, self.slots)]
        low = np.uint32(0xFFFF)
        unlikely = (self.first[u[:-1] & low] - pair > rare) & (self.first[u[1:] & low] - pair > rare_back)
        return np.flatnonzero(unlikely & ((u[:-1] > 127) | (u[1:] > 127)))

    def bits(self, text: str) -> float:
        if len(text) < 24:  # as ``each``, without arrays
            u = [*map(ord, text)]
            pair, first, low = self._pair, self._first, self.slots - 1
            return sum([first[a & 0xFFFF] - pair[((a * 2654435761) ^ (b * 40503)) & low] for a, b in zip(u, u[1:])])
        return float(self.each(_points(text)).sum())


def undo_utf8(text: str, model: Bigrams, odd: np.ndarray | None = None) -> tuple[float, str, str] | None:
    """One layer of UTF-8 read in another encoding, wholly or in stretches: (bits saved, text, layer).

    A stretch is taken if its characters get less rare and the text around it more likely. ``odd``: the odd places of
    the text between two spaces, if they are known."""
    padded = f" {text} "
    odd = model.odd(_points(padded)) if odd is None else odd
    if not len(odd):
        return None
    seen = {c for i in odd.tolist() for c in padded[i : i + 2] if c > "\x7f"}
    # nothing is garbled outside of the odd pairs' hull
    head, tail = max(0, int(odd[0]) - 64), int(odd[-1]) + 64
    head, text, tail = text[:head], text[head:tail], text[tail:]
    best = None
    for enc in UTF8_AS:
        pat = _UTF8[enc]
        # no odd character of this encoding, nothing of it to undo
        if seen.isdisjoint(_BYTES[enc]) or not pat.search(text):
            continue
        data = _encode(text, enc)
        if data is not None:  # the whole text at once
            try:
                new = data.decode("utf-8")
            except UnicodeDecodeError:
                new = text
            if new != text and rarity(new) < 0.95 * rarity(text) and (got := model.bits(text) - model.bits(new)) > 4:
                if best is None or got > best[0]:
                    best = got, new, f"utf-8 as {enc}"
                continue
        known = model.known
        saved = [0.0]

        def turn(m: re.Match, enc: str = enc, text: str = text, known: dict = known, saved: list = saved) -> str:
            s, l, r = m.group(0), text[m.start() - 1 : m.start()] or " ", text[m.end() : m.end() + 1] or " "
            got = known.get((enc, s, l, r))
            if got is None:
                d, gain = s, 0.0
                try:
                    d = _encode(s, enc).decode("utf-8")
                except UnicodeDecodeError:
                    pass
                if not all(ord(c) < 65536 and _COMMON[ord(c)] for c in d):
                    d = s
                if d != s:
                    cost = rarity(d)
                    gain = model.bits(l + s + r) - model.bits(l + d + r)
                    if cost > min(4.5 * len(d), rarity(s) * 0.8) or gain < 4:
                        d, gain = s, 0.0
                if len(known) > KNOWN:
                    known.clear()
                got = d, gain
                if len(s) < 64:
                    known[enc, s, l, r] = got
            saved[0] += got[1]
            return got[0]

        new = pat.sub(turn, text)
        if new != text and (best is None or saved[0] > best[0]):
            best = saved[0], new, f"utf-8 as {enc}"
    return best and (best[0], head + best[1] + tail, best[2])


def _best_run(gain: np.ndarray) -> tuple[float, int, int]:
    """Largest sum of a run of items, with its ends."""
    sums = np.concatenate([[0.0], np.cumsum(gain)])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    start = int(np.argmin(sums[: end + 1]))
    return float(sums[end] - sums[start]), start, end


def _single(read: str, meant: str) -> tuple[np.ndarray, np.ndarray]:
    """(code point after the repair, whether it can be one) for all code points of the basic plane."""
    to, ok = np.arange(65536, dtype=np.uint32), np.zeros(65536, bool)
    ok[:128] = True
    for c, i in _BYTES[read].items():
        if i >= 128 and ord(c) < 65536:
            try:
                to[ord(c)], ok[ord(c)] = ord(bytes([i]).decode(meant)), True
            except UnicodeDecodeError:
                pass
    return to, ok


DOUBLE = {"gb18030", "shift_jis", "euc_jp", "big5"}
_SINGLE = {(r, m): _single(r, m) for r, m in LEGACY if m not in DOUBLE}
_PAIRS = list(_SINGLE)
_TO, _OK = (np.stack([_SINGLE[x][k] for x in _PAIRS]) for k in (0, 1))
_RUNS = {r: re.compile("[" + "".join(re.escape(c) for c in _BYTES[r] if c >= " ") + "]{4,}") for r in {r for r, m in LEGACY if m in DOUBLE}}


def undo_legacy(text: str, model: Bigrams, least: float, odd: np.ndarray | None = None) -> tuple[float, str, str] | None:
    """One legacy encoding read as another, for the pair and run of words whose bits drop most."""
    u = _points(" " + text + " ")
    plane = np.minimum(u, 65535)
    odd = model.odd(u) if odd is None else odd
    if not len(odd):
        return None
    each = model.each(u)
    space = _SPACES[plane]
    starts = np.flatnonzero(space[:-1] & ~space[1:])  # the space before each word
    ends = np.flatnonzero(~space[:-1] & space[1:])
    if not len(starts):
        return None
    lo = max(0, np.searchsorted(starts, odd[0], side="right") - 6)
    hi = min(len(starts), np.searchsorted(starts, odd[-1], side="right") + 5)
    starts, ends = starts[lo:hi], ends[lo:hi]
    a, b = int(starts[0]), int(ends[-1]) + 2
    seg, at = plane[a:b], starts - a
    before = np.add.reduceat(each[a : b - 1], at)
    high = seg > 127
    per_word = lambda x: np.add.reduceat(x[:-1].astype(np.float32), at)
    n_high = per_word(high)
    best = None
    found: dict[str, list[tuple[int, int]]] = {}

    def runs(read: str) -> list[tuple[int, int]]:
        """Stretches of the encoding's characters in which odd pairs are dense, as double bytes make them."""
        if read not in found:
            spans = [m.span() for m in _RUNS[read].finditer(text)] if len(odd) > 2 else []
            n = np.searchsorted(odd, [y for _, y in spans]) - np.searchsorted(odd, [x for x, _ in spans]) if spans else []
            found[read] = [(x, y) for (x, y), k in zip(spans, n) if k * 8 > y - x]
        return found[read]

    # a look at the odd words alone tells which pairs are worth the whole: those for which some run of them gains
    odd_words = np.unique(np.searchsorted(at, odd - a, side="right") - 1)
    odd_words = odd_words[(odd_words >= 0) & (odd_words < len(at))]
    parts = [seg[at[k] : ends[k] - a + 2] for k in odd_words]
    look = np.concatenate(parts) if parts else seg[:0]
    worth = set()
    if len(look) > 1:
        word_at = np.cumsum([0, *map(len, parts)])[:-1]
        looked = model.each(look)
        able = np.flatnonzero(_OK[:, np.unique(look[look > 127])].any(1))
        for block in np.array_split(able, max(1, len(able) * len(look) // 2_000_000)):
            can = _OK[block[:, None], look]
            gain = np.pad(looked - model.each(np.where(can, _TO[block[:, None], look], look)), ((0, 0), (0, 1)))
            words = np.add.reduceat(gain, word_at, axis=1) - 2.0
            words[np.add.reduceat(~can, word_at, axis=1, dtype=np.int32) > 0] = -30.0
            sums = np.pad(np.cumsum(words, axis=1), ((0, 0), (1, 0)))
            best_run = (sums - np.minimum.accumulate(sums, axis=1)).max(1)
            worth |= {_PAIRS[k] for k in block[best_run > 8]}
    for read, meant in LEGACY:
        if meant not in DOUBLE and (read, meant) not in worth:
            continue
        if meant in DOUBLE:
            for x, y in runs(read):
                s = text[x:y]
                for cut in range(3):
                    try:
                        d = _encode(s[: len(s) - cut], read).decode(meant)
                    except UnicodeDecodeError:
                        continue
                    got = model.bits(f" {s} ") - model.bits(f" {d}{s[len(s) - cut:]} ")
                    got *= 0.5  # strict decoding of double bytes proves less
                    if got > least and rarity(d) < rarity(s) and (best is None or got > best[0]):
                        best = (got, x, y - cut, d, read, meant)
                    break
            continue
        to, ok = _SINGLE[read, meant]
        can = ok[seg]
        after = np.add.reduceat(model.each(to[seg]), at)
        gain = before - after - 2.0
        gain[n_high == 0] = -0.5
        gain[per_word(~can) > 0] = -30.0
        got, i, j = _best_run(gain)
        if got > least and (best is None or got > best[0]):
            x, y = int(starts[i]), int(ends[j - 1])  # in the text: one less for the padding
            new = "".join(map(chr, to[plane[x + 1 : y + 1]]))
            best = (got, x, y, new, read, meant)
    if best is None:
        return None
    got, x, y, new, read, meant = best
    return got, text[:x] + new + text[y:], f"{meant} as {read}"


_LOST = re.compile(r"[�\x80-\x84\x86-\x9f]")


def repair(text: str, model: Bigrams, least: float = 25.0) -> tuple[str, list[str], bool]:
    """(text, layers, lost): the repaired text, what was undone, whether characters are lost for good.

    In each round the change that saves most bits is made, since layers nest either way; every round saves
    some, so there is a last one."""
    layers: list[str] = []
    while True:
        odd = model.odd(_points(f" {text} "))
        found = [x for x in (undo_utf8(text, model, odd), undo_legacy(text, model, least, odd)) if x]
        if not found:
            break
        _, text, layer = max(found)
        layers.append(layer)
    return text, layers, bool(_LOST.search(text))


def suspicious(texts: list[str], model: Bigrams) -> np.ndarray:
    """Which texts hold a character pair beyond ASCII that clean text seldom has, or lost characters."""
    u = _points("\n".join(texts) + "\n")
    odd = model.odd(u)
    ends = np.cumsum([len(t) + 1 for t in texts])
    out = np.array([bool(_LOST.search(t)) for t in texts], bool)
    out[np.searchsorted(ends, odd, side="right")] = True
    return out


REPAIRED = "doc_id bigint, text string, layers array<string>, lost boolean"


def bigram_model(documents: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Bigram and first-character counts over all distinct texts without strong signs of garbling.

    A text counts once however many rows copy it, else copies of a garbled one make its garbling normal.
    Exact counts of character pairs are summed in the tasks and then over them; there are as many as alphabets
    have pairs in use. The table they are put in is sized by their number."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def squeeze() -> None:
            code = np.concatenate([c for c, _ in held])
            n = np.concatenate([k for _, k in held])
            code, at = np.unique(code, return_inverse=True)
            held[:] = [(code, np.bincount(at, n).astype(np.int64))]

        for pdf in batches:
            texts = [t for t in pdf["t"] if t]
            for k in range(0, len(texts), 200):
                block = texts[k : k + 200]
                u = _points("\n".join(block) + "\n\n\n")
                ends = np.cumsum([len(t) + 1 for t in block])
                bad = np.zeros(len(block) + 1, bool)
                bad[np.searchsorted(ends, clearly_garbled(u), side="right")] = True
                if bad.any():
                    u = u[np.repeat(~bad, np.diff([0, *ends, len(u)]))]
                if len(u) < 2:
                    continue
                u = np.where(_SPACES[np.minimum(u, 65535)], np.uint32(32), u).astype(np.int64)
                held.append(np.unique((u[:-1] << 21) | u[1:], return_counts=True))
                if sum(len(c) for c, _ in held) > 2_000_000:
                    squeeze()
        if held:
            squeeze()
            yield pd.DataFrame({"code": held[0][0], "n": held[0][1]})

    rows = documents.select(F.col(text).alias("t")).distinct().mapInPandas(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    code, n = rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    slots = SLOTS
    while slots < 16 * len(code):
        slots *= 2
    u = np.column_stack([code >> 21, code & 0x1FFFFF]).astype(np.uint32)
    at = ((u[:, 0] * np.uint32(2654435761)) ^ (u[:, 1] * np.uint32(40503))) & np.uint32(slots - 1)
    return np.bincount(at, n, minlength=slots).astype(np.int64), np.bincount(u[:, 0] & 0xFFFF, n, minlength=65536).astype(np.int64)


def repair_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", least: float = 25.0) -> DataFrame:
    """(doc_id, text, layers, lost) of the documents that were read in a wrong encoding.

    ``layers`` names what was undone, outermost first; ``lost``: some characters can't be restored
    (replacement characters, controls), the rest is. Null, empty and blank texts are no cases, nor are
    genuine accented, capital or rare characters. ``least``: bits that a change must save."""
    model = documents.sparkSession.sparkContext.broadcast(bigram_model(documents, text))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lm = Bigrams(*model.value)
        for pdf in batches:
            out = []
            pdf = pdf[pdf["t"].notna()]
            texts = pdf["t"].tolist()
            for i in np.flatnonzero(suspicious(texts, lm)) if texts else []:
                k, t = pdf["k"].iloc[i], texts[i]
                new, layers, lost = repair(t, lm, least)
                if layers or lost:
                    out.append((k, new, layers, lost))
            yield pd.DataFrame(out, columns=["doc_id", "text", "layers", "lost"])

    return documents.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, REPAIRED)
