"""Hierarchical addresses and motif codes: canonical spellings, parsing and validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The address pattern and the code patterns of the data model.
NAS_PATTERN = r"^nms://[a-z0-9-]+(/[a-z0-9-]+){1,3}\z"
TMI_VALID = r"^TMI-[A-Z]\d[\d.]*\z"


def strip_ws(c: Column) -> Column:
    """Both ends without any white space (``trim`` takes blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def canon_nas(c: Column) -> Column:
    """The canonical address of any spelling: case, outer space, ``NAS:`` prefix, brackets, trailing ``/``.

    Null and blank give null."""
    s = F.lower(strip_ws(c))
    s = F.regexp_replace(s, r"^\[?\s*nas\s*:\s*|\s*\]$", "")
    s = F.regexp_replace(s, r"/+$", "")
    return F.when(s == "", None).otherwise(s)


def canon_tmi(c: Column) -> Column:
    """``TMI-`` + capital letter + number for every spelling of a motif code; blank and null give null."""
    s = F.upper(F.regexp_replace(c, r"\s+", ""))
    s = F.regexp_replace(s, r"^TMI-?(?=.)", "TMI-")
    s = F.when(s.rlike(r"^[A-Z]+\d"), F.concat(F.lit("TMI-"), s)).otherwise(s)
    return F.when((s == "") | (s == "TMI-") | (s == "TMI"), None).otherwise(s)


def canon_propp(c: Column) -> Column:
    """``PROPP-`` + number for every spelling of a function code; blank and null give null."""
    s = F.upper(F.regexp_replace(c, r"\s+", ""))
    s = F.regexp_replace(s, r"^PROPP-?(?=.)", "PROPP-")
    s = F.when(s.rlike(r"^\d+$"), F.concat(F.lit("PROPP-"), s)).otherwise(s)
    return F.when((s == "") | (s == "PROPP"), None).otherwise(s)


def nas_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(NAS_PATTERN), F.lit(False))


def nas_part(c: Column, i: int) -> Column:
    """1-based: 3 tradition, 4 division, 5 episode, 6 unit; null where the address is shorter."""
    return F.get(F.split(c, "/"), F.lit(i - 1))


def nas_depth(c: Column) -> Column:
    return F.size(F.split(c, "/")) - 2


def nas_parent(c: Column) -> Column:
    """First five parts joined: the episode address of a unit."""
    return F.array_join(F.slice(F.split(c, "/"), 1, 5), "/")


def tmi_branch(c: Column) -> Column:
    """Motif branch: letters and the number floored to hundreds; null for anything else."""
    letters = F.regexp_extract(c, r"^TMI-([A-Z]+)(\d+)", 1)
    num = F.regexp_extract(c, r"^TMI-([A-Z]+)(\d+)", 2)
    return F.when(letters == "", None).otherwise(
        F.concat(letters, (F.floor(num.cast("bigint") / 100) * 100).cast("string"))
    )


def tmi_root(c: Column) -> Column:
    r = F.regexp_extract(c, r"^TMI-([A-Z]+)(\d+)", 1)
    return F.when(r == "", None).otherwise(r)


def norm_locale(c: Column) -> Column:
    """Language of a locale spelling: ``en_EN``, ``EN`` and ``en-EN`` are ``en``."""
    return F.lower(F.split(strip_ws(c), "[-_]")[0])
