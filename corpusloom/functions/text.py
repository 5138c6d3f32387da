"""Scalar functions on text and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model.enums import HEDGES
from .address import strip_ws

CITED = "\x00cited\x00"


def slugify(c: Column) -> Column:
    """Lower case, ASCII letters and digits, hyphens; '' where nothing is left."""
    s = F.regexp_replace(strip_ws(F.lower(c)), r"[^a-z0-9\s-]", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"[\s_]+", "-"), r"-+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))


def clean_translated(c: Column) -> Column:
    """Page marks and bare page numbers dropped, runs of blank lines squeezed, ends trimmed."""
    lines = F.filter(F.split(c, "\n"), lambda x: ~strip_ws(x).rlike(PAGE_MARK))
    return strip_ws(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


#: Patterns of citations, sentences and page marks.
PAGE_MARK = r"^(\[PAGE \d+\]|\d{1,5})$"
CITATION, ADDRESS, SENTENCE = r"\[NAS: ([^\]]+)\]", r"nms://[a-z0-9-]+(/[a-z0-9-]+){1,3}", r"[A-ZА-ЯЁ][^.!?]*[.!?]"


def citations(c: Column) -> Column:
    """Addresses cited in a body, in order."""
    return F.regexp_extract_all(c, F.lit(CITATION), 1)


def clean_citations(arr: Column, own: Column) -> Column:
    """Each once, in first order, without the record's own address."""
    return F.array_distinct(F.filter(arr, lambda x: x != own))


def sentences(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(SENTENCE), 0)


def uncited(c: Column) -> Column:
    """Sentences without a citation, cut to 80 characters."""
    marked = F.regexp_replace(F.regexp_replace(c, CITATION, CITED), ADDRESS, CITED)
    return F.transform(F.filter(sentences(marked), lambda s: ~F.contains(s, F.lit(CITED))), lambda s: F.substring(s, 1, 80))


def complete(c: Column) -> Column:
    """Whether a body ends as a whole one does."""
    return F.regexp_replace(c, r"\s+$", "").rlike("[\\].!?»\"']$")


def hedged(c: Column) -> Column:
    """Whether a body says that its text is damaged, citations aside."""
    return F.lower(F.regexp_replace(c, r"\[NAS:[^\]]*\]", "")).rlike("|".join(HEDGES))


def cut_note(c: Column, most: int = 800) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("…"))).otherwise(c)


def unit(v: Column) -> Column:
    """Vector of length one; an empty or zero one gives null."""
    d = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm))


def cosine_units(a: Column, b: Column) -> Column:
    """Cosine of unit vectors within [0, 1]; 0 where one is missing or lengths differ."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.when(a.isNull() | b.isNull() | (F.size(a) != F.size(b)), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 where either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def overlap(a: Column, b: Column) -> Column:
    """Shared values over the size of the larger set; 0 where either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b)))


def tier_rank(c: Column, unknown: int = 3) -> Column:
    """0 documented to 3 inspired; missing is inspired."""
    t = F.coalesce(c, F.lit("inspired"))
    return F.when(t == "documented", 0).when(t == "reconstructed", 1).when(t == "contested", 2).when(t == "inspired", 3).otherwise(unknown)


def structured_json(c: Column, schema: str) -> Column:
    """Array in a model's answer: code fences stripped, from the first ``[`` to the last ``]``; null where it can't be read."""
    body = F.regexp_replace(strip_ws(c), r"^```[a-zA-Z]*\s*|\s*```$", "")
    return F.from_json(F.regexp_extract(body, r"(?s)\[.*\]", 0), schema)
