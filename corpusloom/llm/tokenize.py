"""Encoding with a public byte-level BPE vocabulary as a bounded-lookahead streaming transducer.

For every byte position the last token of the encoding of the text so far is kept. It is the
one vocabulary item that ends there and is compatible with the last token where it starts;
so the encodings of all prefixes form a tree. A token is stable once every position from
which a later token may still start (the merge list's lookahead: its longest item) agrees on
it, and is emitted then: memory is bounded by the lookahead, whatever the length of the text.

The merge list also tells which byte pairs no item ever spans. Between them no merge can
happen, so the stream is cut there and equal pieces are answered from a bounded memo."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ..session import tokenizer_path

#: The public split pattern of this vocabulary, and Unicode's White_Space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

MEMO_ITEMS = 400_000  # entries of a worker's memo; it is emptied when full
MEMO_LONGEST = 256  # longer pieces are not kept


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Rank file (base64 item, rank) as a dictionary."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Merges:
    """What the transducer needs of a merge list."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.items = {v: k for k, v in ranks.items()}
        self.lookahead = max(map(len, ranks))
        self.inner = {k[i : i + 2] for k in ranks for i in range(len(k) - 1)}
        self._fits: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def halves(self, item: int) -> tuple[int, int] | None:
        """The two items whose merge makes this one; null for a single byte."""
        if item in self._halves:
            return self._halves[item]
        data = self.items[item]
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        got = self._halves[item] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether ``b`` may follow ``a``: no merge across their border comes before those within them.

        The merges at the border are undone from the last one back; at each stage the merge
        of the two items that then touch must not have been due."""
        got = self._fits.get((a, b))
        if got is not None:
            return got
        if len(self._fits) > MEMO_ITEMS:
            self._fits.clear()
        key, due = (a, b), 1 << 60
        left, right = a, b
        while True:
            across = self.ranks.get(self.items[left] + self.items[right])
            if across is not None and across < due:
                got = False
                break
            x, y = self.halves(left), self.halves(right)
            if x is None and y is None:
                got = True
                break
            # of equal ranks the merge further left came first, so the right one is undone first
            if y is None or (x is not None and left > right):
                due, left = left, x[1]
            else:
                due, right = right + 1, y[0]
        self._fits[key] = got
        return got


class Transducer:
    """One piece of a text, fed in blocks of bytes; ``feed`` and ``end`` give the ids that are stable."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.data = b""  # from the last emitted position on
        self.last: list[tuple[int, int]] = [(-1, -1)]  # per position: (start of the last token, its id)
        self.before = -1  # id emitted last

    def _advance(self) -> None:
        data, last, get, fits, most = self.data, self.last, self.m.ranks.get, self.m.fits, self.m.lookahead
        for p in range(len(last), len(data) + 1):
            found = (-1, -1)  # no token ends here
            for q in range(p - most if p > most else 0, p):
                t = get(data[q:p])
                if t is not None:
                    left = last[q][1] if q else self.before
                    if left < 0 and q:
                        continue
                    if left < 0 or fits(left, t):
                        found = (q, t)
                        break
            last.append(found)

    def _path(self, p: int) -> list[int]:
        out = []
        while p > 0:
            out.append(p)
            p = self.last[p][0]
        return out[::-1]

    def feed(self, block: bytes) -> list[int]:
        out: list[int] = []
        size = 4 * self.m.lookahead
        for k in range(0, len(block), size):
            self.data += block[k : k + size]
            self._advance()
            if len(self.data) >= size:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        n = len(self.data)
        paths = [self._path(p) for p in range(n - self.m.lookahead, n + 1) if self.last[p][1] >= 0]
        shared = paths[0]
        for path in paths[1:]:
            k = 0
            while k < min(len(shared), len(path)) and shared[k] == path[k]:
                k += 1
            shared = shared[:k]
        if not shared:
            return []
        ids = [self.last[p][1] for p in shared]
        cut = shared[-1]
        self.data = self.data[cut:]
        self.last = [(-1, -1)] + [(q - cut, t) if q >= cut else (-1, -1) for q, t in self.last[cut + 1 :]]
        self.before = ids[-1]
        return ids

    def end(self) -> list[int]:
        ids = [self.last[p][1] for p in self._path(len(self.data))]
        self.__init__(self.m)
        return ids


class Encoder:
    """Texts to ids: pieces of the split pattern, cut where no merge can happen, through the transducer."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.split = regex.compile(SPLIT)
        self.runs = re.compile(f" [{SPACE}]")
        self.cuts = re.compile(f" (?=[^{SPACE}])")
        self._pieces: dict[str, tuple[int, ...]] = {}

    def _atom(self, data: bytes) -> list[int]:
        if (t := self.merges.ranks.get(data)) is not None and len(data) < 3:
            return [t]
        tr = Transducer(self.merges)
        return tr.feed(data) + tr.end()

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of the split pattern."""
        got = self._pieces.get(piece)
        if got is None:
            out, start, data, inner = [], 0, piece.encode(), self.merges.inner
            for i in range(1, len(data)):
                if data[i - 1 : i + 1] not in inner:
                    out += self._atom(data[start:i])
                    start = i
            got = tuple(out + self._atom(data[start:]))
            if len(piece) <= MEMO_LONGEST:
                if len(self._pieces) > MEMO_ITEMS:
                    self._pieces.clear()
                self._pieces[piece] = got
        return got

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a stretch that starts a text or with a space and ends before one."""
        return tuple(chain.from_iterable(map(self._piece, self.split.findall(chunk))))

    def stretches(self, text: str) -> list[str]:
        """Stretches that the split pattern never joins: the text cut at each space before a visible
        character. That space belongs to the stretch after it, but is left out here."""
        if self.runs.search(text) or text.endswith(" "):
            return self.cuts.split(text)
        return text.split(" ")

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; an empty or null text gives an empty list."""
        if not text:
            return []
        first, *rest = self.stretches(text)
        return [*self.chunk(first), *(i for c in rest for i in self.chunk(" " + c))]


class _Rows(dict):
    """Stretch to row number; a new one is encoded when it is first asked for."""

    def __init__(self, lead: str, encoder: Encoder, flat: array, start: array):
        super().__init__()
        self.lead, self.encoder, self.flat, self.start = lead, encoder, flat, start

    def __missing__(self, stretch: str) -> int:
        row = self[stretch] = len(self.start) - 1
        self.flat.extend(self.encoder.chunk(self.lead + stretch))
        self.start.append(len(self.flat))
        return row


class BatchEncoder:
    """Batches of texts; distinct stretches are encoded once and gathered with arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoder = Encoder(ranks)
        self._empty()

    def _empty(self) -> None:
        self.flat, self.start = array("i"), array("q", [0])
        self.first, self.index = (_Rows(lead, self.encoder, self.flat, self.start) for lead in ("", " "))

    def _lookup(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers of all stretches, the texts' ends among them, start offsets."""
        if len(self.start) > MEMO_ITEMS or len(self.flat) > 20 * MEMO_ITEMS:
            self._empty()
        rows: list[int] = []
        ends = []
        for t in texts:
            if t:
                first, *rest = self.encoder.stretches(t)
                rows.append(self.first[first])
                rows.extend(map(self.index.__getitem__, rest))
            ends.append(len(rows))
        return np.asarray(rows, np.int64), np.asarray(ends, np.int64), np.array(self.start, np.int64)

    def counts(self, texts: Iterable[str | None]) -> np.ndarray:
        rows, ends, start = self._lookup(texts)
        total = np.concatenate([[0], np.cumsum(start[rows + 1] - start[rows])]) if len(rows) else np.zeros(1, np.int64)
        return np.diff(np.concatenate([[0], total[ends]]))

    def ids(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, values) of the list column."""
        rows, ends, start = self._lookup(texts)
        if not len(rows):
            return np.zeros(len(ends) + 1, np.int32), np.zeros(0, np.int32)
        size = start[rows + 1] - start[rows]
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(total[-1]) + np.repeat(start[rows] - total[:-1], size)
        return np.concatenate([[0], total[ends]]).astype(np.int32), np.array(self.flat, np.int32)[at]


class Decoder:
    """Ids to text, incrementally: an unfinished UTF-8 character waits for its other bytes.

    Byte by byte with the state (bytes still due, smallest legal next byte); bytes that can't
    belong to a character give U+FFFD, as ``bytes.decode(errors="replace")`` does."""

    def __init__(self, items: dict[int, bytes]):
        self.items = items
        self.held = b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(self.items[i] for i in ids)
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            x = data[-back]
            if x < 0x80:
                break
            if x >= 0xC0:
                due = 2 if x < 0xE0 else 3 if x < 0xF0 else 4
                keep = back if due > back else 0
                break
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def _broadcast(df: DataFrame, path: str | None):
    """The rank file's bytes, about 1 MB whatever the data: workers need no copy of the file."""
    with open(path or tokenizer_path(), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


_WORKER: dict[int, BatchEncoder] = {}


def _batch_encoder(data) -> BatchEncoder:
    """One encoder a Python worker and vocabulary, kept between tasks."""
    key = hash(data.value)
    if key not in _WORKER:
        _WORKER[key] = BatchEncoder(read_ranks(data.value))
    return _WORKER[key]


def _slices(texts: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, list]]:
    """Blocks of a column of at most about ``most`` characters (or one text), to bound memory."""
    values, start, size = texts.to_pylist(), 0, 0
    for i, v in enumerate(values):
        if size > most:
            yield start, values[start:i]
            start, size = i, 0
        size += len(v or "")
    if start < len(values):
        yield start, values[start:]


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids): token ids of every text without special tokens, one row per input row.

    Text that looks like a special token is ordinary text. An empty or null text gives an
    empty list; other columns are dropped, so they can't clash; no rows give no rows."""
    data = _broadcast(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _batch_encoder(data)
        for b in batches:
            for start, texts in _slices(b.column(1)):
                off, val = enc.ids(texts)
                ids = pa.ListArray.from_arrays(pa.array(off), pa.array(val))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(texts)), ids], ["key", "ids"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_tokens): number of ids of every text; 0 for empty and null."""
    data = _broadcast(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _batch_encoder(data)
        for b in batches:
            for start, texts in _slices(b.column(1)):
                n = pa.array(enc.counts(texts).astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(texts)), n], ["key", "n_tokens"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"key {kind}, n_tokens bigint").withColumnRenamed("key", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None, block: int = 4096) -> DataFrame:
    """(key, text): texts of lists of ids; a null list gives null, an empty one ''."""
    data = _broadcast(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = {v: k for k, v in read_ranks(data.value).items()}
        for b in batches:
            texts = []
            for x in b.column(1).to_pylist():
                if x is None:
                    texts.append(None)
                    continue
                d = Decoder(items)
                texts.append("".join([*(d.feed(x[i : i + block]) for i in range(0, len(x), block)), d.end()]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = dict(df.dtypes)[key]
    return df.select(key, ids).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
