import random

import pytest

from corpusloom.llm import packing
from corpusloom.llm import tokenize as T
from corpusloom.session import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def encoder():
    with open(tokenizer_path(), "rb") as f:
        return T.Encoder(T.read_ranks(f.read()))


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


CASES = ["", " ", "a", "  a   b\n\n c \n d  ", "<|endoftext|> x", "a" * 3000, " " * 700 + "x", "don't 's  's", "x \n", "日本語のテスト" * 50, "ไทย ข้อความ", "Привет, мир!", "é 🏺👩‍👧", "\x1c\x85 y", "　x"]


def test_equals_the_public_encoder(encoder, reference):
    rnd = random.Random(4)
    more = ["".join(rnd.choice("ab  \n.'s1é中😀") for _ in range(rnd.randrange(60))) for _ in range(300)]
    for text in CASES + more:
        assert encoder.encode(text) == reference.encode(text, add_special_tokens=False).ids, repr(text[:40])


def test_stream_needs_bounded_memory(encoder, reference):
    text = "supercalifragilistic" * 400
    t, out, most = T.Transducer(encoder.merges), [], 0
    for i in range(0, len(text), 7):
        out += t.feed(text[i : i + 7].encode())
        most = max(most, len(t.data))
    assert out + t.end() == reference.encode(text, add_special_tokens=False).ids and most <= 8 * encoder.merges.lookahead


def test_round_trip(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*CASES, None])], "doc_id bigint, text string, ids string")
    enc = T.encode(docs)
    got = {r["doc_id"]: r["text"] for r in T.decode(enc, block=1).collect()}
    assert got == {i: t or "" for i, t in enumerate([*CASES, None])}
    n = {r["doc_id"]: r["n_tokens"] for r in T.count_tokens(docs).collect()}
    assert n == {r["doc_id"]: len(r["ids"]) for r in enc.collect()} and n[len(CASES)] == 0
    assert T.encode(docs.limit(0)).count() == 0


def test_packing_is_whole_and_tight(spark):
    rnd = random.Random(5)
    sizes = [rnd.choice([0, 1, 5, 30, 99, 100, 101, 250, None]) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(sizes)), "item_id bigint, n_tokens bigint").repartition(5)
    rows = packing.pack(df, {"s": 100, "l": 400, "none": 0}, windows=16, merge_fan=3).collect()
    for kind, cap in (("s", 100), ("l", 400)):
        mine = [r for r in rows if r["container_kind"] == kind]
        fill, parts = {}, {}
        for r in mine:
            fill[r["container"]] = fill.get(r["container"], 0) + r["token_end"] - r["token_start"]
            parts.setdefault(r["item_id"], []).append((r["part"], r["token_start"], r["token_end"]))
        assert max(fill.values()) <= cap and all(r["used"] == fill[r["container"]] for r in mine)
        for i, n in enumerate(sizes):
            p = sorted(parts[i])
            assert p[0][1] == 0 and p[-1][2] == (n or 0) and all(a[2] == b[1] for a, b in zip(p, p[1:])) and (len(p) == 1 or (n or 0) > cap)
        total = sum(n or 0 for n in sizes)
        assert len(fill) <= 1.08 * total / cap + 6
    assert packing.pack(df.limit(0), {"s": 100}).count() == 0
    assert packing.fill_report(packing.pack(df, {"s": 100}), spark.createDataFrame([("s", 100)], "container_kind string, capacity_tokens int")).first()["n_tokens"] == sum(n or 0 for n in sizes)
