import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import align, mojibake, ocr, sentences, truncation

CONT = "content_id bigint, nas string, locale string, layer string, body string, translation_id string, run_id string, text string, lang string, n int"
REP = "run_id string, source_file string, ocr_applied boolean, source string"


def content(spark, rows):
    """rows: (id, nas, locale, layer, body, translation, run)."""
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], CONT)


@pytest.fixture(scope="module")
def english():
    rnd = random.Random(3)
    who, what, where = ["The smith", "The old king", "A ferryman", "The weaver", "Dr. Isbel"], ["carried the silver oar", "hid the cedar door", "sold a drowned bell", "buried the red thread", "found the clay seal"], ["at the ford", "behind the mill", "near the well", "in the forest"]
    return lambda k: " ".join(f"{rnd.choice(who)} {rnd.choice(what)} {rnd.choice(where)} for {rnd.randrange(90)} days." for _ in range(k))


def test_truncation(spark, english):
    whole = [english(random.Random(i).randrange(3, 9)) for i in range(300)]
    rows = [(i, "n", "en", "surface", t, None, "r1") for i, t in enumerate(whole)]
    cut = [(1000 + i, "n", "en", "surface", english(8)[:255], None, "r2") for i in range(40)]
    odd = [(2000, "n", "en", "surface", None, None, "r1"), (2001, "n", "en", "surface", " ", None, "r1"), (2002, "n", None, "surface", english(3) + " [NAS: nms://a/b]", None, None), (2003, "n", "en", "surface", english(4000) + " And th", None, "r1")]
    rep = spark.createDataFrame([("r1", "one", False, ""), ("r1", "one", False, ""), ("r2", "two", False, "")], REP)
    got = {r["content_id"]: r for r in truncation.score_truncation(content(spark, rows + cut + odd + rows[:5]), rep).collect()}
    ends_mid = [k for k, *_, in cut if not got[k]["cut"] and not cut[k - 1000][4].endswith(".")]
    assert len(got) == 344 and not ends_mid and sum(got[i]["cut"] for i in range(300)) <= 3
    assert got[2000]["score"] is None and not got[2001]["cut"] and got[2003]["cut"]
    rpt = {r["source_file"]: r for r in truncation.truncation_report(truncation.score_truncation(content(spark, rows + cut), rep)).collect()}
    assert rpt["two"]["n_cut"] >= 38 and rpt["one"]["n_records"] == 300
    assert truncation.score_truncation(content(spark, []), rep).count() == 0


def test_sentences(spark):
    rnd = random.Random(7)
    unit = ["The smith hid the oar.", "Dr. Isbel came to St. Anne late.", "“Who goes there?” asked the king.", "See vol. 3, no. 4, for more.", "It cost 4.5 marks."]
    rows, want = [], {}
    for i in range(400):
        mine = [rnd.choice(unit) for _ in range(6)]
        text, spans = "", []
        for u in mine:
            text += rnd.choice([" ", " ", " ", "  ", "\n\n"]) if text else ""
            spans.append((len(text), len(text) + len(u)))
            text += u
        rows.append((i, "n", "en_EN", "scholaria", text, None, None))
        want[i] = spans
    rows += [(900, "n", "en", "scholaria", None, None, None), (901, "n", None, "scholaria", "  ", None, None), (902, "n", None, "scholaria", " One only ", None, None), (903, "n", "en", "surface", "Not asked. For.", None, None)]
    got = {}
    for r in sentences.segment(content(spark, rows + rows[:3]), ["scholaria"]).collect():
        got.setdefault(r["content_id"], []).append((r["char_start"], r["char_end"]))
    assert {k: sorted(v) for k, v in got.items() if k < 900} == want and got[902] == [(1, 9)] and 900 not in got and 901 not in got and 903 not in got
    assert sentences.segment(content(spark, [])).count() == 0


def test_sentence_slots_of_other_scripts():
    spans = lambda t, g: [t[s.end :].lstrip()[:2] for s in sentences.slots(t, g) if s.kind != 4]
    assert spans("一。二。", "zh") == ["二。"] and spans("ก 12 ข ค", "th") == ["12", "ข ", "ค"] and spans("«Стой! Я знаю.» Да.", "ru") == ["Да"]


def test_thai_spaces_beside_numerals_are_learned(spark):
    rnd = random.Random(8)
    who, did, what = ["ช่างเหล็ก", "กษัตริย์ชรา", "คนแจวเรือ", "ช่างทอ"], ["ซ่อน", "พบ", "ขโมย", "ตี"], ["พายเงิน", "ประตูไม้", "ด้ายสีแดง", "วัวสีขาว"]
    rows, want = [], {}
    for i in range(500):
        text, spans = "", []
        for _ in range(6):
            u = rnd.choice(who) + rnd.choice(did) + rnd.choice(what) + (f"หลังจาก {rnd.randrange(90)} วัน" if rnd.random() < 0.5 else "")
            text += rnd.choice([" ", " ", " ", "  ", "\n\n"]) if text else ""
            spans.append((len(text), len(text) + len(u)))
            text += u
        rows.append((i, "n", "th", "scholaria", text, None, None))
        want[i] = spans
    got = {}
    for r in sentences.segment(content(spark, rows)).collect():
        got.setdefault(r["content_id"], []).append((r["char_start"], r["char_end"]))
    assert sum(sorted(got[k]) == v for k, v in want.items()) > 490


def test_alignment(spark):
    nouns = {"oar": "весло", "door": "дверь", "bell": "колокол", "thread": "нить", "seal": "печать", "harp": "арфа", "crown": "венец", "lamp": "лампа"}
    verbs = {"hid": "спрятал", "sold": "продал", "broke": "сломал", "found": "нашёл", "burned": "сжёг", "washed": "омыл"}
    who = {"smith": "кузнец", "king": "царь", "weaver": "ткач", "wolf": "волк", "scribe": "писец", "exile": "изгнанник"}
    rnd = random.Random(9)
    rows, want = [], set()
    for d in range(120):
        facts = [(rnd.choice(list(who)), rnd.choice(list(verbs)), rnd.choice(list(nouns)), rnd.randrange(100)) for _ in range(5)]
        en = [f"The {w} {v} the {n} for {k} days." for w, v, n, k in facts]
        ru = [f"{who[w].capitalize()} {verbs[v]} {nouns[n]} за {k} дней." for w, v, n, k in facts]
        order = list(range(5))
        rnd.shuffle(order)
        drop = order.pop() if d % 3 == 0 else None
        rows += [(2 * d, f"nms://a/{d}", "en", "translated", " ".join(en), "t", None), (2 * d + 1, f"NMS://a/{d}/", "RU", "translated", "\n\n".join(ru[i] for i in order), "t", None)]
        want |= {(2 * d, i + 1, 2 * d + 1, j + 1) for j, i in enumerate(order) if i != drop}
    rows += [(900, "nms://z/z", "en", "translated", "Alone.", "t", None), (901, "nms://y/y", "en", "translated", None, "t", None), (902, None, "ru", "translated", "Да.", None, None)]
    found = align.align(content(spark, rows + rows[:2])).collect()
    got = {(r[0], r[1], r[2], r[3]) for r in found if r["kind"] != "omission"}
    alone = {(r["content_id_a"], r["sentence_a"]) for r in found if r["kind"] == "omission" and r["sentence_b"] is None}
    dropped = {(2 * d, i) for d in range(120) for i in range(1, 6)} - {w[:2] for w in want}
    assert len(alone & dropped) > 0.9 * len(dropped) and all(r["kind"] in ("one", "omission") for r in found if (r[0], r[1], r[2], r[3]) in want)
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.93
    assert align.align(content(spark, [])).count() == 0 and align.align(content(spark, rows[-3:])).count() == 0


def test_transport_leaves_strangers_alone():
    import numpy as np

    p = align.transport(np.array([[0.9, 0.05], [0.05, 0.02]]), null=0.24)
    assert p[0, 0] > 0.9 and p[1, 1] < 0.2 and p[1, 2] > 0.7


def test_scanned_pages(spark, english):
    rep = spark.createDataFrame([("scan", "s.pdf", True, ""), ("scan", "s.pdf", None, ""), ("text", "t.txt", False, "")], REP)
    clean = [(i, "n", "en", "translated", english(7), None, "text") for i in range(250)]
    body = "The smith carried the sil-\nver oar at the ford\nfor 3 days. The old king hid the\ncedar door behind the mill for 4 days."
    pages = [(1000 + i, "n", "en", "translated", "THE LAYS OF KINGS\n" + "\n".join(ocr._wrap(english(5), 50)), None, "scan") for i in range(30)]
    rows = [(2000, "n", "en", "translated", body, None, "scan"), (2001, "n", "en", "translated", "THE LAYS OF KINGS    17\n" + "\n".join(ocr._wrap(english(4), 50)), None, "scan"), (2002, "n", "en", "translated", "\n".join(ocr._wrap(english(4), 50)) + "\n- 12 -", None, "scan"),
            (2003, "n", "en", "translated", "The srnith h!d the\nceclar door at the ford.", None, "scan"), (2004, "n", "en", "translated", None, None, "scan"), (2005, "n", "en", "translated", " ", None, "scan"), (2006, "n", "en", "translated", "\n".join(ocr._wrap(english(900), 50)), None, "scan")]
    read = ocr.clean_pages(content(spark, clean + pages + rows + rows[:2]), rep).cache()
    got = {}
    for r in ocr.defects(read).collect():
        assert r["defect"] not in got.setdefault(r["content_id"], set())
        got[r["content_id"]].add(r["defect"])
    assert got[2000] == {"hyphen"} and got[2001] == {"header", "page_number"} and got[2002] == {"page_number"} and got[2003] == {"misread"}
    assert all(got.get(1000 + i) == {"header"} for i in range(30)) and not {2004, 2005, 2006, 3} & set(got)
    text = {r["content_id"]: r["text"] for r in ocr.repaired(read).collect()}
    assert text[2003] == "The smith hid the cedar door at the ford." and "silver oar at the ford for 3" in text[2000]
    assert ocr.defects(ocr.clean_pages(content(spark, []), rep)).count() == 0


def test_garbled_texts(spark):
    ru = "Старый царь спрятал серебряное весло у брода и вестник нашёл глиняную печать за мельницей. "
    de = "Der Färger stahl für den König die weiße Glocke über dem See, übel gelaunt. "
    fr = "L’âme du frère cacha la clé fêlée à l’aube et déroba le trône désert. "
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice([ru, de, fr]).split()[: rnd.randrange(5, 14)]) + ".") for i in range(600)]
    bad = {
        1001: (ru, ru.encode().decode("cp1251", "ignore")), 1002: (de, de.encode().decode("latin-1")), 1003: (fr, fr.encode().decode("cp437")), 1004: (ru, ru.encode("koi8-r").decode("cp1251")),
        1005: (ru, ru.encode("cp1251").decode("latin-1")), 1006: (de, de.encode().decode("latin-1").encode().decode("latin-1")), 1007: (de, "Kurz. " * 50 + de.encode().decode("latin-1")),
    }
    fine = [(2000, None), (2001, ""), (2002, " "), (2003, "ПЕСНЬ ПЕРВАЯ: РОССЫПЬ"), (2004, "GROẞ ﬁn é 🏺 ½"), (2005, ru * 400)]
    df = spark.createDataFrame([*rows, *((k, v[1]) for k, v in bad.items()), *fine, (3000, "Der alte K�nig.")], "doc_id bigint, text string").withColumn("layers", F.lit("clash"))
    got = {r["doc_id"]: r for r in mojibake.repair_documents(df).collect()}
    assert set(got) == {*bad, 3000} and got[3000]["lost"]
    for k in (1002, 1003, 1004, 1005, 1006):
        assert got[k]["text"] == bad[k][0], k
    assert mojibake.repair_documents(df.limit(0)).count() == 0


def test_copies_of_a_garbled_text(spark):
    fr = "La fiancée du frère cacha la clé fêlée à l aube et déroba le trône désert près du lac."
    el = "ΤΟ ΤΡΑΓΟΥΔΙ ΤΗΣ ΘΑΛΑΣΣΑΣ ΚΑΙ ΤΩΝ ΦΥΛΩΝ, Ωδή Θεών."
    rnd = random.Random(2)
    shuffled = lambda t: " ".join(rnd.sample(t[:-1].split(), len(t.split())))
    rows = [(i, f"{shuffled(fr)} {shuffled(fr)} {shuffled(el)} {i}.") for i in range(1200)]
    bad = fr.encode("cp1252").decode("cp437")
    fine = [(5000, None), (5001, ""), (5002, " ")]
    df = spark.createDataFrame([*rows, *((10_000 + i, bad) for i in range(600)), *fine], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in mojibake.repair_documents(df).collect()}
    assert got == {10_000 + i: fr for i in range(600)}
    few = spark.createDataFrame([(1, "Der alte K\ufffdnig."), (2, "Der alte K\u00f6nig.")], "doc_id bigint, text string")
    assert [(r["doc_id"], r["lost"]) for r in mojibake.repair_documents(few).collect()] == [(1, True)]


def test_sentence_slots_after_single_quotations():
    spans = lambda t, g="en": [t[s.end :].lstrip()[:4] for s in sentences.slots(t, g) if s.kind != 4]
    assert spans("The so-called ‘Yes?’ formula recurs. The archer kept it. He left.") == ["form", "The ", "He l"]
    assert spans("‘It isn’t here! Go!’ said he. The end.") == ["said", "The "]
    assert spans("“He cried ‘Stop! Now!’ to me. Then he left.” The end. Fin.") == ["The ", "Fin."]
    assert spans("He said ‘go. The king left. All slept.") == ["The ", "All "]
    assert spans("Ka‘ba fell. It rose.") == ["It r"] and spans("‘A! B!’ ग।  घ।", "hi") == ["ग।  ", "घ।"]


def test_garbled_words_after_many_lost_ones():
    import numpy as np

    ru = "Старый царь спрятал серебряное весло у брода и вестник нашёл глиняную печать за мельницей. "
    u = mojibake._points(ru * 20_000)
    pairs, firsts = np.bincount(mojibake._slots(u), minlength=mojibake.SLOTS), np.bincount(u[:-1], minlength=65536)
    # replaced letters that some texts hold, so that each makes an odd pair
    lost = " ".join(w[:2] + "\ufffd" + w[3:] for w in (ru * 12).split() if len(w) > 4)
    firsts[0xFFFD] = 10**6
    model = mojibake.Bigrams(pairs, firsts)
    text = f"{lost} {ru.encode('koi8-r').decode('cp1251')}"
    got = mojibake.undo_legacy(text, model, 25.0)
    assert got and got[2] == "koi8-r as cp1251" and got[1].endswith(ru.strip() + " ")


def test_headers_of_any_case_and_length(spark, english):
    rep = spark.createDataFrame([("scan", "s.pdf", True, ""), ("text", "t.txt", False, "")], REP)
    clean = [(i, "n", "en", "translated", english(7), None, "text") for i in range(200)]
    heads = ["the collected lays and laments of the river people as sung by the masters of that old house", "from older songs", "THE OLDER SONGS"]
    pages = []
    for i in range(60):
        lines = ocr._wrap(english(5), 50)
        at = 0 if i % 2 else len(lines) // 2
        pages.append((1000 + i, "n", "en", "translated", "\n".join([*lines[:at], heads[i % 3], *lines[at:]]), None, "scan"))
    plain = [(2000 + i, "n", "en", "translated", "\n".join(ocr._wrap(english(5), 50)), None, "scan") for i in range(30)]
    got = {(r["content_id"], r["defect"]) for r in ocr.defects(ocr.clean_pages(content(spark, clean + pages + plain), rep)).collect()}
    assert all((1000 + i, "header") in got for i in range(60)) and not any(k >= 2000 for k, _ in got)


def test_pieces_beside_headers():
    assert ocr.pieces("THE LAYS    17") == [("tail", "17", "THE LAYS")] and ocr.pieces("- 4 -   The Lays")[0][:2] == ("head", "- 4 -")
    assert ocr.pieces("T H E   L A Y S") == [] and ocr.key_of("Book IX") == ocr.key_of("Book 3")


def test_links_come_from_the_plan():
    import numpy as np

    word = lambda w: align._hash(w)
    lexicon = {(0, word("oar")): (2, [(word("весло"), 0.9)]), (0, word("hid")): (2, [(word("спрятал"), 0.9)]), (0, word("bell")): (2, [(word("колокол"), 0.9)]), (0, word("sold")): (2, [(word("продал"), 0.9)])}
    lexicon |= {(1, word(w)): (2, []) for w in ("весло", "спрятал", "колокол", "продал")}
    got, na, nb = align.links("He hid the oar. He sold the bell.", "Продал колокол и спрятал весло. Тишина.", lexicon, 100)
    assert got == [(0, 0), (1, 0)] and (na, nb) == (2, 2) and set(align.groups(got).values()) == {"merge"}
    assert align.links("", "Да.", lexicon, 1) == ([], 0, 1) and np.isfinite(align.transport(np.zeros((1, 1)))).all()


def test_boundaries_hang_together():
    import numpy as np

    chain = np.zeros((sentences.KINDS, sentences.STATES))
    chain[2, 2] = -9.0  # past an attributing clause a dash goes on
    kinds = [np.array([1, 2]), np.array([0, 2]), np.array([], int)]
    p = sentences.posteriors([np.array([-5.0, 2.0]), np.array([-5.0, 2.0]), np.array([])], kinds, [chain] * 3)
    assert p[0][1] < 0.1 and p[1][1] > 0.8 and len(p[2]) == 0


def test_foreign_words_ahead_of_a_garbled_stretch():
    import numpy as np

    ru = "Старый царь спрятал серебряное весло у брода и вестник нашёл глиняную печать за мельницей. "
    u = mojibake._points(ru * 20_000)
    model = mojibake.Bigrams(np.bincount(mojibake._slots(u), minlength=mojibake.SLOTS), np.bincount(u[:-1], minlength=65536))
    rnd = random.Random(1)
    foreign = " ".join("".join(rnd.choice("აბგდევზთიკლმნოპრს") for _ in range(6)) for _ in range(45))
    text, layers, lost = mojibake.repair(f"{foreign} {ru.strip().encode('koi8-r').decode('cp1251')}", model)
    assert layers == ["koi8-r as cp1251"] and text == f"{foreign} {ru.strip()}" and not lost
