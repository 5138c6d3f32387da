import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from corpusloom.model import enums, schemas
from corpusloom.operators import constellations as C
from corpusloom.operators import corpus as K
from corpusloom.operators import derive as D
from corpusloom.operators import integrity as I
from corpusloom.operators import structure as S
from corpusloom.operators.orphans import find_orphans
from corpusloom.sources import readers as R

ANN = "annotation_id bigint, nas string, track string, position int, code string, status string, proposed_tier string"
ADDR = "tradition_id string, ordinal bigint, division string, nas string"


def ann(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ANN)


def test_code_sets_keep_unannotated(spark):
    a = spark.createDataFrame([("t", 1, "d", "n1"), ("t", 2, "d", "n2")], ADDR)
    got = dict(D.code_sets(a, ann(spark, [("n1", "tmi", 0, "TMI-A1", "confirmed", "documented"), ("n1", "tmi", 1, "TMI-A1", "confirmed", "documented"), ("n2", "tmi", 0, "TMI-B1", "rejected", "documented")])).collect())
    assert got == {"n1": ["TMI-A1"], "n2": []}


def test_best_annotation_prefers_evidence_then_position(spark):
    rows = [("n", "propp", 0, "P1", "confirmed", "contested"), ("n", "propp", 1, "P2", "confirmed", "reconstructed"), ("n", "propp", 2, "P3", "confirmed", "documented"), ("n", "propp", 3, "P4", "confirmed", "documented")]
    assert D.best_annotations(ann(spark, rows), ["nas"]).first()["code"] == "P3"


def test_sequences_have_gaps_and_islands(spark):
    a = spark.createDataFrame([("t", 1, "d1", "n1"), ("t", 2, "d1", "n2"), ("t", 3, "d2", "n3"), ("t", 4, "d1", "n4")], ADDR)
    best = spark.createDataFrame([("n1", "PROPP-8")], "nas string, code string")
    got = {r["island"]: r for r in D.sequences(a, best, "").collect()}
    assert got[1]["sequence"] == ["PROPP-8", ""] and got[1]["gaps"] == ["n2"] and got[1]["n_annotated"] == 1 and got[3]["division"] == "d1" and len(got) == 3
    assert {r["island"]: r["sequence"] for r in D.sequences(a, best, None).collect()}[1] == ["PROPP-8", None]


def test_profiles(spark):
    a = spark.createDataFrame([("t", 1, "d", "n1"), ("t", 2, "d", "n2")], ADDR)
    rows = [("n1", "bakhtin", 0, "BAKHTIN-ROAD", "confirmed", "contested"), ("n1", "bakhtin", 1, "BAKHTIN-POLYPHONY-LOW", "confirmed", "documented"), ("n1", "bakhtin", 2, "BAKHTIN-POLYPHONY-HIGH", "confirmed", "documented")]
    got = {r["nas"]: r for r in D.profiles(a, ann(spark, rows)).collect()}
    assert got["n1"]["chronotope_type"] == "BAKHTIN-ROAD" and got["n1"]["polyphony"] == 0.9 and got["n1"]["source_annotation_count"] == 3
    assert got["n2"]["chronotope_type"] is None and got["n2"]["raw_codes"] == [] and got["n2"]["source_annotation_count"] == 0


FEAT = "nas string, tradition string, tmi_codes array<string>, propp_codes array<string>, chronotope_type string, polyphony double, carnivalesque double"


def feat(spark, rows):
    return C.features(spark.createDataFrame(rows, FEAT))


def test_edges_equal_all_pairs(spark):
    import random

    rnd = random.Random(1)
    rows = [(f"n{i}", rnd.choice("abc"), [f"TMI-{rnd.choice('AB')}{rnd.randrange(400)}" for _ in range(rnd.randrange(4))] or None, [f"PROPP-{rnd.randrange(5)}" for _ in range(rnd.randrange(3))] + [""], rnd.choice(["R", "S", None]), rnd.choice([None, 0.2, 0.5, 0.33, 0.41]), None) for i in range(70)]
    f = feat(spark, rows).cache()
    for least in (2, 3, 4):
        a = sorted(map(str, C.edges(f, least=least).collect()))
        assert a == sorted(map(str, C.edges_theta(f, least=least).collect()))
    assert C.edges(f, least=1).count() == C.edges_theta(f, least=1).count()


def test_edges_never_shuffle_pairs(spark):
    rows = [("n1", "a", ["TMI-A1", "TMI-A2", "X"], ["PROPP-1", "PROPP-2"], "R", 0.5, None), ("n2", "b", ["TMI-A2", "X", "TMI-A1"], ["PROPP-2", "PROPP-1"], "R", 0.6, 0.1)]
    f = C.features(spark.createDataFrame(rows, FEAT), None)
    for least in (1, 2, 3, 4):
        e = C.edges(f, least=least, keep=("nas",))
        assert "Aggregate" not in e._jdf.queryExecution().optimizedPlan().toString()  # once, though they share many keys
        assert [(r["member_a"], r["nas_b"], r["qualifying_dimensions"], r["tmi_jaccard_leaf"]) for r in e.collect()] == [("n1", "n2", 4, 1.0)]


def test_candidates(spark):
    rows = [(f"nms://{t}/d/e{i}", t, ["TMI-A1335"], ["PROPP-8"], "ROAD", 0.5, None) for t in ("a", "b") for i in range(11)] + [("nms://c/d/lacuna-1", "c", ["TMI-A1335"], ["PROPP-8"], "ROAD", 0.5, None)]
    every = lambda r: C.features(spark.createDataFrame(r, FEAT), None)  # noqa: E731 - one code for all is none too common here
    c = C.candidates(C.edges(every(rows))).collect()
    assert len(c) == 1 and c[0]["n_members"] == 22 and c[0]["oversized"] and c[0]["candidate_id"] == "C-0001" and c[0]["dimensional_agreement"] == "very_high" and c[0]["primary_dimension"] == "tmi_jaccard_leaf"
    assert C.candidates(C.edges(every(rows[:3]))).count() == 0


def test_digest_keeps_sums_and_connections(spark):
    rows = [(f"n{i}", "ab"[i % 2], ["TMI-A1"], ["PROPP-1"], "R", 0.5, None) for i in range(40)]
    e = C.edges(C.features(spark.createDataFrame(rows, FEAT), None))
    whole, brief = C.candidates(e).first(), C._digest(e.coalesce(1), most=7).collect()
    assert (whole["n_edges"], whole["n_members"]) == (400, 40) and sum(r["n"] or 0 for r in brief) == 400
    kept = [r for r in C._digest(e.coalesce(1)).collect() if r["member_b"] is not None]  # 400 edges before
    assert len(kept) == 39 and {n for r in kept for n in (r["member_a"], r["member_b"])} == {f"n{i}" for i in range(40)}


@pytest.fixture
def often_merged(spark, monkeypatch):
    """Tasks of several batches that merge their sums, and go on after it, as on large tables."""
    monkeypatch.setattr(C, "_digest", partial(C._digest, most=120))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    rows = [(f"n{i:02}", "ab"[i % 2], ["TMI-A1"], ["PROPP-1"], "R", 0.5, None) for i in range(40)]
    yield C.edges(C.features(spark.createDataFrame(rows, FEAT), None)).coalesce(1)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_candidates_of_many_batches(often_merged):
    (c,) = C.candidates(often_merged).collect()
    assert (c["n_edges"], c["n_members"], c["tradition_count"], c["dimensional_agreement"], c["primary_dimension"]) == (400, 40, 2, "very_high", "tmi_jaccard_leaf")


def test_candidate_members_of_many_batches(often_merged):
    got = C.candidate_members(often_merged).collect()
    assert sorted((r["candidate_id"], r["nas"], r["tradition"]) for r in got) == [("C-0001", f"n{i:02}", "ab"[i % 2]) for i in range(40)]


def test_components_against_brute_force(spark):
    import random

    rnd = random.Random(2)
    pairs = [(f"x{rnd.randrange(80):02}", f"x{rnd.randrange(80):02}") for _ in range(60)] + [(f"y{i:02}", f"y{i + 1:02}") for i in range(30)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r["nas"]: r["component"] for r in C.components(spark.createDataFrame(pairs, "member_a string, member_b string")).collect()}
    assert got == {x: find(x) for x in parent}


def test_edges_of_parallels_have_vectors(spark, sf, tmp_path):
    from corpusloom.plans import similarity_plans as SP
    from corpusloom.plans import views as V

    (tmp_path / "fragment_features.parquet").symlink_to("/root/testdata/sf0.01/fragment_features.parquet")
    spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").filter("vec_id < 150").write.parquet(f"{tmp_path}/embeddings.parquet")
    d = str(tmp_path)
    held = {r["nas"] for r in V.vectors(spark, d).collect()}
    every, some = (sorted(map(str, (r for r in e.collect() if only or {r["member_a"], r["member_b"]} <= held))) for e, only in ((SP._edges(spark, d), False), (SP._vector_edges(spark, d), True)))
    assert some == every and len(some) > 0


def test_parallel_scores(spark):
    v = spark.createDataFrame([("a1", "a", [1.0, 0.0]), ("b1", "b", [0.3, (1 - 0.09) ** 0.5])], "nas string, tradition string, vector array<double>")
    e = C.edges(C.features(spark.createDataFrame([("a1", "a", ["TMI-A1"], ["PROPP-1"], "R", 0.5, None), ("b1", "b", ["TMI-A1"], ["PROPP-1"], "R", 0.5, None)], FEAT), None))
    r = C.parallels(v, e).collect()
    assert len(r) == 1 and r[0]["parallel_score"] == 0.65 and r[0]["framework_match_count"] == 4
    assert C.parallels(v, e.limit(0), everything=True).first()["parallel_score"] == 0.15
    assert [x["parallel_id"] for x in C.number_pairs(C.parallels(v, e)).collect()] == ["P-0001"]


def test_nearest_is_exact(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0]), ("d", None)], "nas string, vector array<double>")
    got = C.nearest(v, v, 1).collect()
    assert {r["query_nas"]: r["nas"] for r in got} == {"a": "b", "b": "a", "c": "b"}


T0 = dt.datetime(2024, 1, 1)
REF = "table_name string, record_id bigint, field_name string, ref_nas string, t timestamp_ntz, start string"
PAR = "nas string, start timestamp_ntz, end timestamp_ntz, k string"


def day(n):
    return T0 + dt.timedelta(days=n)


def test_orphans_by_brute_force(spark):
    parents = [("nms://a/b", day(0), None, "x"), ("nms://a/c", day(5), None, "x"), ("nms://a/d", day(0), day(3), "x"), ("NMS://A/D/", day(8), day(9), "x"), (None, day(0), None, "x"), ("nms://a/e", None, None, "x")]
    refs = [("t", 1, "f", "nms://a/b", day(2)), ("t", 2, "f", " NMS://A/B/", day(2)), ("t", 3, "f", "nms://a/c", day(2)), ("t", 4, "f", "nms://a/d", day(4)), ("t", 4, "f", "nms://a/d", day(4)), ("t", 5, "f", "nms://z/z", day(1)), ("t", 6, "f", None, day(1)), ("t", 7, "f", "nms://a/c", None), ("t", 8, "f", "nms://z/y", None), ("t", 9, "f", "nms://a/e", day(1)), ("t", 10, "f", "nms://a/d", day(3))]
    r = spark.createDataFrame([(*x, "clash") for x in refs], REF)
    p = spark.createDataFrame(parents, PAR)
    want = {(3, "late"), (4, "deleted"), (5, "missing"), (8, "missing"), (10, "deleted")}
    for rows in (50_000, 1):
        got = [(x["record_id"], x["reason"]) for x in find_orphans(r, p, rows_per_range=rows, rows_per_batch=rows).collect()]
        assert set(got) == want and len(got) == len(want)
    assert {x["reason"] for x in find_orphans(r, p.limit(0)).collect()} == {"missing"}
    assert find_orphans(r.limit(0), p).count() == 0


def test_orphans_with_a_hot_key(spark):
    r = spark.range(3000).select(F.lit("t").alias("table_name"), F.col("id").alias("record_id"), F.lit("f").alias("field_name"), F.lit("nms://hot/x").alias("ref_nas"), F.lit(day(1)).cast("timestamp_ntz").alias("t"))
    p = spark.createDataFrame([("nms://hot/y", day(0), None)], "nas string, start timestamp_ntz, end timestamp_ntz")
    assert find_orphans(r, p, rows_per_batch=500).count() == 3000


def test_toc_and_divisions(spark):
    toc = "".join(f"Book {i}\nintro {i}\n" for i in range(1, 7)) + "x" * 2000 + "\n" + "".join(f"Book {i}\n" + "y" * 800 + "\n" for i in range(1, 7))
    plain = "".join(f"## Book {i}\n" + "z" * 1000 + "\n" for i in range(1, 6))
    d = spark.createDataFrame([(1, toc), (2, plain), (3, "")], "run_id bigint, text string")
    got = S.scan_structure(d, ["Book"], source_type="digital-pdf").collect()
    a, b = [r for r in got if r["run_id"] == 1], sorted((r for r in got if r["run_id"] == 2), key=lambda r: r["char_start"])
    assert len(a) == 6 and all(r["toc_detected"] and r["char_start"] >= r["toc_char_end"] and r["confidence"] == 0.8 for r in a)
    assert len(b) == 5 and not b[0]["toc_detected"] and b[-1]["char_end"] == len(plain) and all(x["char_end"] == y["char_start"] for x, y in zip(b, b[1:]))
    assert S.scan_structure(d, []).count() == 0


def test_chunks():
    text = "\n\n".join("p" * 900 for _ in range(100))
    spans = S.chunk_spans(text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b - a <= 40_000 for a, b in spans) and all(y[0] <= x[1] for x, y in zip(spans, spans[1:]))
    assert S.chunk_spans("short") == [(0, 5)] and S.chunk_spans("") == [(0, 0)]


def test_passages(spark):
    seg = spark.createDataFrame([(1, 1, "b", "second part"), (1, 2, "a", "first part begins"), (1, 3, "x", "not there"), (1, 4, "c", "second part")], "run_id bigint, seq int, nas string, passage_opening string")
    part = spark.createDataFrame([(1, "zero. first part begins here. second part ends.")], "run_id bigint, chunk string")
    got = {r["seq"]: r["passage_text"] for r in S.passages(seg, part, ["run_id"]).collect()}
    assert got == {2: "first part begins here.", 1: "", 4: "second part ends.", 3: ""}


def test_alignment():
    assert S.local_alignment(["A", "B"], ["A", "B"]) == 1.0 and S.local_alignment([], ["A"]) == 0.0 and S.local_alignment(["A"], ["B"]) == 0.0
    assert S.local_alignment(["PROPP-1"], ["PROPP-2"]) == 0.5


def test_audit(spark):
    mk = lambda rows: spark.createDataFrame(rows, "ordinal bigint, nas string")
    a = mk([(1, "nms://t/d/e1"), (2, "nms://t/d/e2")])
    assert S.audit(a, a).count() == 0
    assert [r["type"] for r in S.audit(a, mk([(1, "nms://t/d/e1")])).collect()] == ["missing_in_source"]
    assert [r["type"] for r in S.audit(mk([(1, "nms://t/d/e1")]), a).collect()] == ["new_in_source"]
    assert [r["type"] for r in S.audit(a, mk([(1, "nms://t/d/e1"), (2, "nms://t/d/zz")])).collect()] == ["slug_divergence"]


CONT = "content_id bigint, nas string, locale string, layer string, translation_id string, body string, status string, confidence_tier string, ai_generated boolean, reviewed_by string"


def cont(spark, **kw):
    base = {"content_id": 1, "nas": "nms://a/b/c", "locale": "en", "layer": "surface", "translation_id": None, "body": "Whole.", "status": "confirmed", "confidence_tier": "reconstructed", "ai_generated": True, "reviewed_by": None} | kw
    return spark.createDataFrame([tuple(base.values())], CONT)


@pytest.mark.parametrize(
    ("change", "rules"),
    [({}, set()), ({"body": "Then he"}, {"V6"}), ({"body": "End [NAS: x]."}, set()), ({"confidence_tier": "inspired"}, {"V5"}), ({"confidence_tier": "documented"}, {"V3"}), ({"confidence_tier": "documented", "status": "candidate"}, {"V3", "V4"}),
     ({"nas": "nms://a/lacuna-1"}, {"V7"}), ({"nas": "nms://a/lacuna-1", "body": "Here the text is lost."}, set()), ({"status": "candidate", "confidence_tier": "inspired", "reviewed_by": "x"}, {"V18"})],
)
def test_content_rules(spark, change, rules):
    assert {r["rule_id"] for r in I.union(I.content_rules(cont(spark, **change))).collect()} == rules


def test_other_rules(spark):
    conf = spark.createDataFrame([(1, "nms://t/d/e"), (2, "nms://t/d/f/g"), (3, "bad")], "ordinal bigint, nas string")
    frag = spark.createDataFrame([(1, "nms://t/d/f/g", True, "n"), (2, "nms://t/x/y", False, "n")], "fragment_id bigint, nas string, methodology_fit_warning boolean, methodology_fit_note string")
    assert sorted((r["rule_id"], r["nas"]) for r in I.union(I.address_rules(conf, frag)).collect()) == [("V1", "bad"), ("V10", "nms://t/d/f/g"), ("V9", "nms://t/d/e")]
    assert sorted((r["rule_id"], r["detail"]) for r in I.union(I.fragment_rules(frag, conf)).collect()) == [("V14", "n"), ("V2", "unconfirmed")]
    a = spark.createDataFrame([(1, "nms://t/d/e", "tmi", "Q2", "confirmed", "inspired"), (2, "nms://t/d/f/g", "tmi", "TMI-Q2", "confirmed", "documented")], "annotation_id bigint, nas string, track string, raw_code string, status string, proposed_tier string")
    assert sorted(r["rule_id"] for r in I.union(I.annotation_rules(a, conf, frag)).collect()) == ["V11", "V12", "V13"]
    d = spark.createDataFrame([("1", "n", "confirmd", "annotation", None, "documented"), ("2", "n", "confirmed", "summary", None, "documented"), ("3", "n", "confirmed", "annotation", None, None)], "audit_id string, nas string, action string, record_type string, layer string, confidence_tier_assigned string")
    assert sorted(r["rule_id"] for r in I.union(I.decision_rules(d)).collect()) == ["V16", "V17", "V20"]
    m = spark.createDataFrame([("t", "0.2"), ("u", "0.1"), ("v", "")], "tradition string, version string")
    assert [r["record_id"] for r in I.version_rule(m).collect()] == ["t"]
    rep = spark.createDataFrame([("r1", "t", "one.txt", 1), ("r2", "t", "two.txt", 2)], "run_id string, tradition string, source_file string, ingested_at int")
    busy = spark.createDataFrame([("t",)], "tradition_id string")
    inc = spark.createDataFrame([("t", "two.txt"), ("t", "three.txt"), ("u", "x.txt")], "tradition string, source_file string")
    assert [r["record_id"] for r in I.witness_rule(rep, busy, inc).collect()] == ["three.txt"]
    assert I.promotion_gate(m.limit(0)) and not I.promotion_gate(m) and I.promotion_gate(m, True) and I.enough_traditions(m)


def test_corpus_life(spark):
    c = cont(spark, status="candidate").unionByName(cont(spark, content_id=2, status="candidate"))
    dec = spark.createDataFrame([("nms://a/b/c", "en", "surface", None, "modified_confirmed", "reconstructed", "new")], "nas string, locale string, layer string, translation_id string, action string, confidence_tier_assigned string, body string")
    got = {r["content_id"]: r for r in K.apply_decisions(c, dec).collect()}
    assert (got[1]["status"], got[1]["body"]) == ("confirmed", "new") and got[2]["status"] == "candidate"
    assert K.upsert(c, cont(spark, body="x"), ["content_id"]).count() == 2
    p = spark.createDataFrame([("n1", "proposed"), ("n2", "confirmed"), ("n3", "deferred")], "proposed_nas string, status string")
    new = spark.createDataFrame([("n1", "proposed"), ("n2", "proposed"), ("n3", "proposed"), ("n4", "proposed")], "proposed_nas string, status string")
    assert sorted(map(tuple, K.merge_proposals(p, new).collect())) == [("n1", "proposed"), ("n2", "confirmed"), ("n3", "proposed"), ("n4", "proposed")]
    e = K.embed(c.withColumn("content_hash", F.sha2("body", 256)), "m", lambda texts: [[float(len(t))] for t in texts]).collect()
    assert e[0]["dimension"] == 1 and K.to_embed(cont(spark), spark.createDataFrame([(K_HASH, "m")], "content_hash string, model_version string"), "m", ["surface"], ["en"]).count() == 0


K_HASH = __import__("hashlib").sha256(b"Whole.").hexdigest()


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one two \xff three")
    r = R.ingest(spark, str(tmp_path / "a.txt"), "txt").first()
    assert r["word_count"] == 4 and "�" in r["text"]
    (tmp_path / "t.xml").write_text('<TEI xmlns="u"><div n="Book 1"><l n="1">First <seg>inner</seg></l><p> </p></div></TEI>')
    r = R.ingest(spark, str(tmp_path / "t.xml"), "tei-xml").first()
    assert r["text"] == "[L 1] First inner\n[SEG] inner" and r["divisions"] == ["Book 1"]
    with pytest.raises(ValueError):
        R.ingest(spark, "x", "md")
    (tmp_path / "d.json").write_text('{"a": 1}')
    (tmp_path / "e.json").write_text(" ")
    got = {r["path"][-6:]: r["a"] for r in R.read_documents(spark, str(tmp_path / "*.json"), "a bigint").collect()}
    assert got == {"d.json": 1, "e.json": None}
    v = spark.createDataFrame([("p1", "n", "[1, 2]"), ("p2", "n", '{"vector": [3]}'), ("p3", "m", "oops")], "path string, nas string, payload string")
    assert [(r["nas"], r["vector"]) for r in R.usable_vectors(v).collect()] == [("n", [3.0])]


def test_model():
    assert enums.flags({"campbell_track": True})["campbell_track"] and not enums.flags()["derived_exports"]
    with pytest.raises(TypeError):
        enums.flags({"campbell_track": "yes"})
    assert all(schemas.schema(n).fields for n in schemas.DDL)


def test_stream_runs_once(spark, tmp_path):
    from corpusloom.streaming.incremental import process_new_files

    src, out, chk = (str(tmp_path / x) for x in ("src", "out", "chk"))
    spark.range(5).write.parquet(src)
    for _ in range(2):
        process_new_files(spark, src, "id bigint", out, chk, lambda b: b)
    assert spark.read.parquet(out).count() == 5


def test_nearest_ties_go_by_name(spark):
    v = spark.createDataFrame([(f"n{i:03}", [1.0, 0.0]) for i in range(60)] + [("q", [1.0, 0.0]), ("z", [-1.0, 0.0])], "nas string, vector array<double>")
    q = v.filter("nas = 'q'")
    for block in (16_384, 7):
        got = [r["nas"] for r in C.nearest(v, q, 4, block).orderBy("rank").collect()]
        assert got == ["n000", "n001", "n002", "n003"]


def test_block_products_equal_all_pairs(spark):
    import random

    rnd = random.Random(5)
    rows = [(f"n{i:02}", rnd.choice("abc"), [rnd.uniform(-1, 1) for _ in range(4)] if i % 9 else rnd.choice([None, [], [1.0]])) for i in range(50)]
    v = spark.createDataFrame(rows, "nas string, tradition string, vector array<double>")
    e = spark.createDataFrame([], "member_a string, member_b string, tradition_a string, tradition_b string, tmi_jaccard_leaf double, tmi_jaccard_branch double, propp_overlap double, chronotope_match boolean, qualifying_dimensions int, bakhtin_polyphony_delta double")
    small, whole = (sorted(map(str, C.parallels(v, e, everything=True, block=b).collect())) for b in (6, 1024))
    assert small == whole and len(whole) == C.pair_count(v).first()["n_pairs"]
    rep = C.parallel_report(v, e, block=6).first()
    assert rep["n_pairs"] == len(whole) and rep["n_above"] == 0


def test_stop_codes_are_left_out(spark):
    rows = [(f"n{i}", "a", ["TMI-J1"] + ([f"TMI-K{i}"] if i < 3 else []), [], None, None, None) for i in range(4)] + [(f"m{i}", "b", [], [], None, None, None) for i in range(6)]
    assert all("TMI-J1" not in r["leaf"] for r in feat(spark, rows).collect())
    assert sum("TMI-J1" in r["leaf"] for r in C.features(spark.createDataFrame(rows, FEAT), 0.4).collect()) == 4


def test_components_of_a_long_chain(spark):
    pairs = spark.range(900).selectExpr("lpad(cast(id as string), 4, '0') as member_a", "lpad(cast(id + 1 as string), 4, '0') as member_b")
    assert C.components(pairs).select("component").distinct().count() == 1
    with pytest.raises(RuntimeError):
        C.components(pairs, rounds=1)
    with pytest.raises(ValueError):
        C.edges_theta(feat(spark, [(f"n{i}", "a", [], [], None, None, None) for i in range(5)]), most=3)


def test_unknown_slots_are_wildcards():
    assert S.local_alignment(["A", "", "B"], ["A", "C", "B"]) == 4 / 6 and S.local_alignment([""], [""]) == 0.0 and S.local_alignment(["A"], [None]) == 0.0


def test_runs_across_ranges(spark):
    import random

    rnd = random.Random(6)
    rows = [("t" if i % 5 else "u", i, rnd.choice("xy") if i % 7 else None, f"n{i:03}") for i in range(300)]
    df = spark.createDataFrame(rows, "tradition_id string, ordinal bigint, division string, nas string")
    want, last, k = {}, {}, {}
    for t, i, d, n in rows:
        k[t] = k.get(t, 0) + (t not in last or last[t] != d)
        last[t] = d
        want[n] = k[t]
    assert {r["nas"]: r["island"] for r in D.islands(df, "tradition_id", "ordinal", "division").collect()} == want
    got = {r["nas"]: (r["prev_nas"], r["next_nas"]) for r in D.neighbours(df.select("tradition_id", "ordinal", "nas"), "tradition_id", "ordinal", "nas").collect()}
    for t in "tu":
        names = [n for x, _, _, n in rows if x == t]
        assert all(got[n] == (names[i - 1] if i else None, names[i + 1] if i + 1 < len(names) else None) for i, n in enumerate(names))
    assert D.islands(df.limit(0), "tradition_id", "ordinal", "division").count() == 0


def test_summaries_are_asked_for_again(spark):
    from corpusloom.operators import pipeline as P

    asked = spark.createDataFrame([("nms://a/b/c", "en"), ("nms://a/b/d", "en"), ("nms://a/b/e", "ru")], "nas string, locale string")

    def model(row, k):
        if row["locale"] == "ru":
            return {"body": "Half", "stop_reason": "max_tokens"}
        return {"body": "He went." if row["nas"].endswith("c") and k < 3 else "He went [NAS: nms://a/b/c]."}

    got = {r["nas"][-1]: r for r in P.summarise(asked, model).collect()}
    assert got["c"]["attempts"] == 3 and got["c"]["grounding_citations"] == [] and got["d"]["attempts"] == 1 and got["d"]["grounding_citations"] == ["nms://a/b/c"]
    assert got["e"]["body"] is None and got["e"]["error_type"] == "truncation_failure" and len(got) == 3
    assert P.tracks(["tmi", "campbell"], {}) == ["tmi"] and P.tracks(["campbell"], {"campbell_track": True}) == ["campbell"]


def test_written_cuts_can_be_deleted(spark):
    from corpusloom.session import cut, release

    df = cut(spark.range(5))
    assert df.count() == 5 and release(spark) >= 1 and release(spark) == 0
