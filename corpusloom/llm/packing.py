"""Filling fixed-capacity containers: bounded-space online packing.

Every partition keeps a fixed number of open windows per container kind, places each item
into the fullest window that still takes it, and emits the fullest window when none does.
The windows still open at the end of the partitions are merged by the same rule."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .tokenize import count_tokens

MOST_ITEMS = 50_000  # items of a window, so that empty ones don't fill a task's memory

PACKED = "item_id bigint, container_kind string, container string, part int, token_start bigint, token_end bigint, open boolean, used bigint"


class Windows:
    """Open containers of one kind; an item goes into the one with the least room that is enough."""

    def __init__(self, capacity: int, windows: int):
        self.capacity, self.windows = capacity, windows
        self.room: list[tuple[int, int]] = []  # (room left, number), ascending
        self.made = 0

    def place(self, size: int) -> tuple[int, int | None]:
        """Number of the item's container; number of a container closed for it."""
        i = bisect_right(self.room, (size, -1))
        closed = None
        if i < len(self.room):
            room, number = self.room.pop(i)
        else:
            if len(self.room) >= self.windows:
                closed = self.room.pop(0)[1]
            room, number = self.capacity, self.made
            self.made += 1
        if room > size or size == 0:
            insort(self.room, (room - size, number))
        return number, closed

    def drop(self, number: int) -> None:
        self.room = [x for x in self.room if x[1] != number]


def _pieces(size: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(part, start, end): one piece, or full ones and a rest where the item exceeds the capacity."""
    if size <= capacity:
        yield 0, 0, size
        return
    for part, start in enumerate(range(0, size, capacity)):
        yield part, start, min(size, start + capacity)


def pack(sizes: DataFrame, capacities: dict[str, int], windows: int = 64, merge_fan: int = 256) -> DataFrame:
    """(item_id, container_kind, container, part, token_start, token_end, used) for all items and kinds.

    ``sizes``: item_id, n_tokens; a null size counts as 0, and an item of size 0 is placed like any
    other. An item is whole (part 0) unless it alone exceeds the capacity: then it is cut into full
    containers and a rest that shares one. ``used`` is the container's fill. Rows with equal ids
    are items of their own, told apart by their rows. ``merge_fan`` partitions' leftover windows
    (at most ``windows`` each) are merged in one task. Kinds with capacity < 1 are left out."""
    kinds = {k: int(c) for k, c in capacities.items() if k is not None and c is not None and int(c) > 0}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        state = {k: Windows(c, windows) for k, c in kinds.items()}
        held: dict[tuple[str, int], list] = {}
        used: dict[tuple[str, int], int] = {}
        out: list[tuple] = []

        def close(k: str, number: int, is_open: bool = False) -> None:
            n = used.pop((k, number))
            out.extend((*row, is_open, n) for row in held.pop((k, number)))

        for pdf in batches:
            for item, size in zip(pdf["item_id"], pdf["n_tokens"].fillna(0).astype("int64")):
                for k, w in state.items():
                    for part, a, b in _pieces(size, w.capacity):
                        number, closed = w.place(b - a)
                        held.setdefault((k, number), []).append((item, k, f"{k}-{pid}-{number}", part, a, b))
                        used[k, number] = used.get((k, number), 0) + b - a
                        if closed is not None:
                            close(k, closed)
                        if used[k, number] == w.capacity and b > a:
                            close(k, number)
                        elif len(held[k, number]) >= MOST_ITEMS:
                            w.drop(number)
                            close(k, number)
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=COLS)
                out.clear()
        for k, number in list(held):
            close(k, number, True)
        if out:
            yield pd.DataFrame(out, columns=COLS)

    rows = cut(sizes.select("item_id", "n_tokens").mapInPandas(run, PACKED))
    left = rows.filter("open").select("container_kind", "container", "used").distinct()
    group = F.floor(F.element_at(F.split("container", "-"), -2).cast("int") / merge_fan).cast("int")

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """Best fit of whole windows, fullest first; the window space is the group, at most fan x windows."""
        kind, g = key
        w = Windows(kinds[kind], len(pdf) + 1)
        pdf = pdf.sort_values(["used", "container"], ascending=[False, True])
        number = [w.place(int(n))[0] for n in pdf["used"]]
        return pd.DataFrame({"container": pdf["container"], "merged": [f"{kind}-m{g}-{n}" for n in number], "used": pdf["used"]})

    merged = left.withColumn("g", group).groupBy("container_kind", "g").applyInPandas(merge, "container string, merged string, used bigint")
    total = merged.groupBy("merged").agg(F.sum("used").alias("merged_used"))
    merged = merged.drop("used").join(total, "merged")
    keep = rows.filter("not open").drop("open")
    moved = rows.filter("open").drop("open").join(merged, "container").withColumn("container", F.col("merged")).withColumn("used", F.col("merged_used"))
    return keep.unionByName(moved.select(keep.columns))


COLS = ["item_id", "container_kind", "container", "part", "token_start", "token_end", "open", "used"]


def pack_documents(documents: DataFrame, container_sizes: DataFrame, path: str | None = None, windows: int = 64) -> DataFrame:
    """Documents, sized in tokens, in containers of every kind; see ``pack``."""
    kinds = {r[0]: r[1] for r in container_sizes.select("container_kind", "capacity_tokens").distinct().collect()}  # a fixed, tiny table
    sizes = cut(count_tokens(documents.select("doc_id", "text"), path=path).select(F.col("doc_id").alias("item_id"), "n_tokens"))
    return pack(sizes, kinds, windows).withColumnRenamed("item_id", "doc_id")


def fill_report(packed: DataFrame, container_sizes: DataFrame) -> DataFrame:
    """Containers, tokens and mean fill of each kind; ``container_sizes``: container_kind, capacity_tokens."""
    c = packed.select("container_kind", "container", "used").distinct()
    g = c.groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"))
    sizes = F.broadcast(container_sizes.select("container_kind", "capacity_tokens").distinct())  # a fixed, tiny table
    return g.join(sizes, "container_kind").select("container_kind", "n_containers", "n_tokens", F.bround(F.col("n_tokens") / F.col("n_containers") / F.col("capacity_tokens"), 6).alias("mean_fill"))
