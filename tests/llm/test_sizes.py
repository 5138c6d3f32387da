"""What must hold for corpora of any size."""

import os
import random

import pytest
from test_texts import REP, content, english  # noqa: F401

from corpusloom.llm import mojibake, ocr, set_join, truncation
from corpusloom.session import checkpoint_dir


def test_three_dots_at_a_limit_are_cuts(spark, english):  # noqa: F811
    whole = [(i, "n", "en", "surface", english(random.Random(i).randrange(2, 12)), None, "r1") for i in range(300)]
    dots = [(1000 + i, "n", "en", "surface", english(8)[:297] + "...", None, "r1") for i in range(80)]  # a share of 0.2 to 0.3 of the source
    rep = spark.createDataFrame([("r1", "one", False, "")], REP)
    got = {r["content_id"]: r["cut"] for r in truncation.score_truncation(content(spark, whole + dots), rep).collect()}
    assert all(got[k] for k, *_ in dots) and sum(got[k] for k, *_ in whole) <= 3


def test_copies_of_a_body_make_no_limit(spark):
    d = spark.createDataFrame([("s", 500 + 40 * (i % 5), i % 5) for i in range(100)] + [("s", 300, 1000 + i) for i in range(20)], "source string, n int, h bigint")
    assert [r["n"] for r in truncation._limits(d).collect()] == [300]


def test_counts_stand_for_a_fixed_number_of_bodies(spark):
    n = spark.createDataFrame([("en", 40), ("ru", 3), ("xx", 5)], "lang string, n bigint")
    assert [r[0] for r in n.select(ocr._down(n, {"en": 20_000, "ru": 500}, 1_000)).collect()] == [2.0, 3.0, 5.0]


def test_halves_of_cut_words_are_no_words(spark):
    texts = spark.createDataFrame([("en", "He saw the sce"), ("en", "The sce"), ("en", "The scene."), ("en", "The king said no")], "lang string, text string")
    assert {r["word"]: r["n"] for r in ocr._count_tokens(texts, "n").collect()} == {"he": 1, "saw": 1, "the": 4, "scene": 1, "king": 1, "said": 1}


def test_lines_that_recur_by_chance_are_no_headers(spark, english, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ocr, "PAGES", 40, raising=False)
    rep = spark.createDataFrame([("scan", "s.pdf", True, ""), ("text", "t.txt", False, "")], REP)
    clean = [(i, "n", "en", "translated", english(7), None, "text") for i in range(250)]
    page = lambda i: "\n".join(ocr._wrap(english(5), 50)) + ("\nthe shore." if i % 50 == 0 else "")
    pages = [(1000 + i, "n", "en", "translated", ("THE LAYS OF KINGS\n" if i % 4 == 0 else "") + page(i), None, "scan") for i in range(400)]
    got = {r["content_id"] for r in ocr.defects(ocr.clean_pages(content(spark, clean + pages), rep)).collect() if r["defect"] == "header"}
    assert got == {1000 + i for i in range(0, 400, 4)}


FEAT = "feature_id bigint, tmi_codes array<string>, propp_codes array<string>"


def _near_copies(n, size=8, seed=6):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3:
            base = set(rows[i - i % 3][1]) ^ {f"TMI-A{rnd.randrange(9 * n)}"}
        else:
            base = {f"TMI-A{rnd.randrange(9 * n)}" for _ in range(size)} if i % 2 else {f"TMI-B{rnd.randrange(12)}" for _ in range(6)}
        rows.append((i, sorted(base), []))
    return rows


def test_sets_take_little_scratch(spark):
    used = lambda: sum(os.path.getsize(os.path.join(at, f)) for at, _, fs in os.walk(checkpoint_dir(spark).removeprefix("file:")) for f in fs)
    before = used()
    assert set_join.similar_records(spark.createDataFrame(_near_copies(1500, 20), FEAT)).count() > 1000
    assert used() - before < 300_000


@pytest.mark.parametrize("crowd", [3, 4096])
def test_crowded_values_lose_no_pair(spark, monkeypatch, crowd):
    monkeypatch.setattr(set_join, "CROWD", crowd, raising=False)
    rows = _near_copies(300)
    got = [(r[0], r[1]) for r in set_join.similar_records(spark.createDataFrame(rows, FEAT)).collect()]
    want = {(a, b) for a, x, _ in rows for b, y, _ in rows if a < b and len({*x} & {*y}) >= 0.6 * len({*x} | {*y})}
    assert set(got) == want and len(got) == len(set(got)) and len(want) > 350


def test_a_stretch_that_recurs_is_judged_once():
    import numpy as np

    clean = " ".join(["кузнец нашёл печать у брода и спрятал весло"] * 50)
    u = mojibake._points(clean)
    pairs, firsts = np.zeros(mojibake.SLOTS), np.bincount(u & 0xFFFF, minlength=65536)
    np.add.at(pairs, mojibake._slots(u), 1)
    model = mojibake.Bigrams(pairs, firsts)
    bad = clean.encode().decode("cp1252", "replace").replace("�", "x") + " " + " ".join(w.encode().decode("latin-1") for w in clean.split())
    calls = []
    bits = model.bits
    model.bits = lambda t: calls.append(t) or bits(t)
    first = mojibake.undo_utf8(bad, model)
    n = len(calls)
    assert mojibake.undo_utf8(bad, model) == first and "кузнец нашёл" in first[1] and len(calls) - n < n / 3
    assert abs(bits("брода и ve") - float(model.each(mojibake._points("брода и ve")).sum())) < 1e-3
