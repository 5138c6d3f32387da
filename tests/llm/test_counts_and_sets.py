import random
from collections import Counter

from corpusloom.llm import set_join, term_counts

FEAT = "feature_id bigint, tmi_codes array<string>, propp_codes array<string>, n string, codes string"


def test_counts_by_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, [], ["TMI-J1"] * rnd.randrange(1, 3) + [f"tmi-a{rnd.randrange(40)}", "", None]]), [], "x", "y") for i in range(400)]
    df = spark.createDataFrame([*rows, *rows[:50]], FEAT)
    occ, rec = Counter(), Counter()
    for _, t, *_ in rows:
        c = [x.upper() for x in t or [] if x]
        occ.update(c)
        rec.update(set(c))
    for heavy in (8, 1024):
        got = term_counts.term_counts(df, "feature_id", "tmi_codes", term_counts.canon_tmi, heavy).collect()
        assert {r["term"]: (r["n_occurrences"], r["n_records"]) for r in got} == {k: (occ[k], rec[k]) for k in occ} and len(got) == len(occ)
    marks = {r["tmi_code"]: r["mark"] for r in term_counts.motif_counts(df).collect()}
    assert marks == {k: "rare" if rec[k] < 3 else "common" if rec[k] > 40 else None for k in occ}
    assert term_counts.motif_counts(df.limit(0)).count() == 0


def brute(sets, t):
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}


def test_pairs_by_brute_force(spark):
    rnd = random.Random(2)
    rows, sets = [], {}
    for i in range(350):
        if i % 3 and i > 10:  # near copies and copies of others
            base = set(sets[rnd.randrange(i)])
            for _ in range(rnd.randrange(3)):
                base ^= {f"TMI-A{rnd.randrange(60)}"}
        else:
            base = {f"TMI-A{int(rnd.random() ** 3 * 60)}" for _ in range(rnd.randrange(12))} | ({"TMI-J1"} if rnd.random() < 0.4 else set())
        sets[i] = base
        codes = [c if rnd.random() < 0.8 else rnd.choice([c.lower(), " " + c, c[4:]]) for c in base]
        rows.append((i, codes + ([""] if rnd.random() < 0.2 else []) if base else rnd.choice([None, []]), [None] if i % 50 == 0 else [], "x", "y"))
    df = spark.createDataFrame([*rows, *rows[:20]], FEAT)
    got = [(r[0], r[1]) for r in set_join.similar_records(df).collect()]
    assert set(got) == brute(sets, 0.6) and len(got) == len(set(got))
    links = set_join.set_classes(df).collect()
    assert len(links) == sum(bool(s) for s in sets.values()) and all(min(i for i in sets if sets[i] == sets[r["feature_id"]]) == r["class_id"] for r in links)
    assert set_join.similar_records(df.limit(0)).count() == 0


def test_many_copies(spark):
    df = spark.createDataFrame([(i, ["TMI-J1"], [], "", "") for i in range(300)], FEAT)
    assert set_join.similar_records(df).count() == 300 * 299 // 2 and set_join.set_classes(df).select("class_id").distinct().count() == 1


def test_long_sets(spark):
    rnd = random.Random(4)
    rows, sets = [], {}
    for i in range(60):
        if i % 3:
            base = set(sets[i - i % 3])
            for _ in range(rnd.randrange(70)):
                base ^= {f"TMI-B{rnd.randrange(400)}"}
        else:
            base = {f"TMI-B{rnd.randrange(400)}" for _ in range(200 + rnd.randrange(60))}
        sets[i] = base
        rows.append((i, sorted(base), None, "", ""))
    got = {(r[0], r[1]) for r in set_join.similar_records(spark.createDataFrame(rows, FEAT)).collect()}
    assert got == brute(sets, 0.6) and got
    assert sum(1 for _ in set_join.index_signatures(list(range(200)), 0.6)) < 200 * 8
