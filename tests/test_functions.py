from pyspark.sql import functions as F

from corpusloom.functions import address as A
from corpusloom.functions import text as T


def one(spark, expr, **values):
    ddl = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], ddl).select(expr.alias("x")).first()["x"]


def s(spark, f, value):
    return one(spark, f(F.col("c")), c=("string", value))


def test_canonical_addresses(spark):
    for raw in (" nms://a/b/c", "NMS://A/B/C", "nms://a/b/c/", "NAS: nms://a/b/c", "[NAS: nms://a/b/c]", "nms://a/b/c\t"):
        assert s(spark, A.canon_nas, raw) == "nms://a/b/c"
    assert s(spark, A.canon_nas, "  ") is None and s(spark, A.canon_nas, None) is None


def test_canonical_codes(spark):
    for raw in ("TMI-K12.3", " TMI-K12.3", "tmi-k12.3", "TMI K12.3", "K12.3", "TMI-K12.3\t"):
        assert s(spark, A.canon_tmi, raw) == "TMI-K12.3"
    assert s(spark, A.canon_propp, "propp 8") == "PROPP-8" and s(spark, A.canon_tmi, "") is None and s(spark, A.canon_propp, None) is None


def test_address_shape(spark):
    ok = lambda v: s(spark, A.nas_valid, v)
    assert ok("nms://a/b") and ok("nms://a/b/c/d") and not ok("nms://a") and not ok("nms://a/b/c/d/e") and not ok("nms://A/b") and not ok("nms://a/b c") and not ok("nms://a/b\n") and not ok(None)
    assert s(spark, A.nas_parent, "nms://a/b/c/d") == "nms://a/b/c" and s(spark, A.nas_depth, "nms://a/b/c/d") == 4
    assert s(spark, lambda c: A.nas_part(c, 5), "nms://a/b") is None


def test_tmi_levels(spark):
    assert s(spark, A.tmi_branch, "TMI-A1335") == "A1300" and s(spark, A.tmi_branch, "TMI-Q2") == "Q0" and s(spark, A.tmi_branch, "TMI-H1376.3") == "H1300"
    assert s(spark, A.tmi_branch, "PROPP-1") is None and s(spark, A.tmi_root, "TMI-A1") == "A"


def test_slug_and_cleaning(spark):
    assert s(spark, T.slugify, "Tablet XI: The Flood") == "tablet-xi-the-flood" and s(spark, T.slugify, "Песнь") == ""
    assert s(spark, T.clean_translated, "[PAGE 3]\na\n\n\n\n12\nb\n ") == "a\n\nb"
    assert s(spark, T.word_count, " a  b\nc ") == 3


def test_citations(spark):
    body = "A. [NAS: nms://a/b] B [NAS: nms://a/c] [NAS: nms://a/b]"
    assert s(spark, T.citations, body) == ["nms://a/b", "nms://a/c", "nms://a/b"]
    assert one(spark, T.clean_citations(F.col("a"), F.col("n")), a=("array<string>", ["s", "c", "s", "c"]), n=("string", "s")) == ["c"]
    assert len(s(spark, T.uncited, "One is here. Two [NAS: nms://a/b]. Three.")) == 2


def test_bodies(spark):
    assert s(spark, T.complete, "So it ends [NAS: x].") and s(spark, T.complete, "it] ") and not s(spark, T.complete, "Then he")
    assert s(spark, T.hedged, "The tablet breaks off.") and not s(spark, T.hedged, "He went [NAS: nms://a/lacuna-1]")
    note = s(spark, T.cut_note, "x" * 900)
    assert len(note) == 798 and note.endswith("…") and s(spark, T.cut_note, "x" * 800) == "x" * 800


def test_set_scores(spark):
    two = lambda f, a, b: one(spark, f(F.col("a"), F.col("b")), a=("array<string>", a), b=("array<string>", b))
    assert abs(two(T.jaccard, ["A", "B"], ["A", "C"]) - 1 / 3) < 1e-12 and two(T.jaccard, [], ["A"]) == 0
    assert two(T.overlap, ["8", "3"], ["8", "16"]) == 0.5 and abs(two(T.overlap, ["8"], ["8", "4", "3"]) - 1 / 3) < 1e-12 and two(T.overlap, [], []) == 0


def test_cosine(spark):
    cos = lambda a, b: one(spark, T.cosine_units(T.unit(F.col("a")), T.unit(F.col("b"))), a=("array<double>", a), b=("array<double>", b))
    assert abs(cos([1.0, 0.0, 1.0], [0.0, 1.0, 1.0]) - 0.5) < 1e-9 and cos([1.0], [-1.0]) == 0 and cos([1.0], [1.0, 0.0]) == 0 and cos([0.0], [1.0]) == 0 and cos([], [1.0]) == 0


def test_json_salvage(spark):
    got = s(spark, lambda c: T.structured_json(c, "array<struct<code string>>"), '```json\nhere: [{"code": "A"}] done\n```')
    assert got[0]["code"] == "A" and s(spark, lambda c: T.structured_json(c, "array<string>"), "none") is None
