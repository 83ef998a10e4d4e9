"""Training-data operators against public libraries, plain Python and exact results."""

import random

import numpy as np
import pyarrow.dataset as ds
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quaystone.llm import bpe, leaks, qdigest, queries, stuffing
from quaystone.llm.words import words

SF, VOCAB = "/root/testdata/sf0.001", "/opt/tokenizers"


@pytest.fixture(scope="module")
def encoder():
    with open(f"{VOCAB}/byte_bpe_50k.tiktoken", "rb") as f:
        return bpe.Encoder(f.read())


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{VOCAB}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def docs(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return df.select("*", F.lit("clash"), F.lit(1)).toDF("doc_id", "text", "TEXT", "run")


# 8


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_the_public_one(encoder, public, text):
    assert encoder.encode(text) == public(text)


def test_encoding_of_odd_texts(encoder, public):
    for text in ("", " ", "\n\n \t", "a" * 30_000, "<|endoftext|> x", "zero​width", "👩🏽‍✈️" * 50, "ab" * 5000, "é̈" * 300, "x  y   z\r\n"):
        assert encoder.encode(text) == public(text)
    assert encoder.encode(None) == []


def test_p8_on_every_document(spark, public):
    got = {r["doc_id"]: list(r["ids"]) for r in queries.p8_ids(spark, SF).collect()}
    t = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "text"])
    assert got == {i: public(x) if x else [] for i, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True)}
    d = docs(spark, [None, "", "one", "one"])
    assert [list(r["ids"]) for r in bpe.encode_texts(d, "doc_id", "text", f"{VOCAB}/byte_bpe_50k.tiktoken").orderBy("doc_id").collect()] == [[], [], public("one"), public("one")]
    assert bpe.encode_texts(d.limit(0), "doc_id", "text", f"{VOCAB}/byte_bpe_50k.tiktoken").count() == 0


def test_pair_tree():
    rng = random.Random(3)
    keys = [rng.randrange(1000) for _ in range(37)]
    tree = bpe.PairTree(list(keys))
    for _ in range(200):
        i, k = rng.randrange(37), rng.choice([bpe.NONE, rng.randrange(1000)])
        keys[i] = k
        tree.put(i, k)
        assert tree.least() == min(keys)


# 4


def test_digests_keep_their_bound_however_they_are_merged():
    rng = np.random.default_rng(4)
    values = np.sort(np.round(rng.lognormal(5, 2, 60_000)).astype(np.int64) + qdigest.HALF)
    k = qdigest.compression(0.02)
    total = {}
    for part in np.array_split(rng.permutation(values), 7):
        p, c = np.unique(part, return_counts=True)
        lv, pl, n = qdigest.compress_nodes(np.zeros(len(p), np.int64), p, c, k)
        assert n.sum() == len(part) and len(n) <= 3 * k
        for node in zip(lv.tolist(), pl.tolist(), n.tolist(), strict=True):
            total[node[:2]] = total.get(node[:2], 0) + node[2]
    lv, pl, n = (np.array(x) for x in zip(*[(*a, b) for a, b in total.items()], strict=True))
    lv, pl, n = qdigest.compress_nodes(lv, pl, n, k)
    assert n.sum() == len(values) and len(n) <= 3 * k
    end = ((pl + 1) << lv) - 1
    order = np.lexsort((lv, end))
    cum = np.cumsum(n[order])
    bound = len(values) // k * qdigest.DEPTH
    for q in (0.01, 0.25, 0.5, 0.9, 0.999):
        target = max(1, int(np.ceil(q * len(values))))
        v = end[order][np.searchsorted(cum, target)]
        lo, hi = np.searchsorted(values, v, "left"), np.searchsorted(values, v, "right")
        assert max(0, lo + 1 - target, target - hi) <= bound


def test_percentiles_in_spark(spark, monkeypatch):
    monkeypatch.setattr(qdigest, "PIECE_NODES", 4000)  # so that the pieces are used
    rng = np.random.default_rng(5)
    data = [("a", float(np.round(v, 2))) for v in rng.normal(20, 300, 9000)] + [("b", 1.5)] * 3 + [("b", None), ("b", float("nan")), (None, 7.0), ("a", 1e12)]
    df = spark.createDataFrame(data, "g string, v double").withColumn("f", F.spark_partition_id())
    k = qdigest.compression(0.05)
    nodes = qdigest.leaves(df, ["g", "f"], "v", 0.01).drop("f")
    monkeypatch.setattr(qdigest, "ROWS_AT_ONCE", 2500)
    parts = qdigest.partial_digests(df, ["g", "f"], ["v"], 0.01, k).drop("f", "field_name")
    for n in (nodes, parts):
        got = {(r["g"], r["percentile"]): r for r in qdigest.estimates(n, ["g"], [0.1, 0.5, 0.99, 1.0], 0.01, k).collect()}
        assert len(got) == 12 and got["b", 0.5]["value"] == 1.5 and got["b", 0.5]["rank_bound"] == 0 and got[None, 0.5]["value"] == 7.0
        assert got["a", 1.0]["value"] == float("inf")  # beyond the universe
        _check_ranks(np.sort([x for g, x in data if g == "a"]), got)
    assert qdigest.partial_digests(df.limit(0), ["g"], ["v"], 0.01, k).count() == 0


def _check_ranks(v, got):
    for q in (0.1, 0.5, 0.99):
        r = got["a", q]
        assert r["n"] == 9001
        target = int(np.ceil(q * 9001))
        lo, hi = np.searchsorted(v, r["value"] - 0.0051, "left"), np.searchsorted(v, r["value"] + 0.0051, "right")
        assert max(0, lo + 1 - target, target - hi) <= r["rank_bound"] <= 0.05 * 9001


def test_p4_runs_over_all_rows(spark):
    got = queries.p4_percentiles(spark, SF).where("scope = 'all' and percentile = 0.5").agg(F.sum(F.when(F.col("field_name") == "fare_amount", F.col("n")))).first()[0]
    t = ds.dataset(f"{SF}/yellow_trip.parquet").to_table(columns=["source_file_version_id", "source_row_ordinal", "fare_amount"]).to_pandas().drop_duplicates()
    assert got == t.fare_amount.notna().sum()


# 9


def exact(docs_, items):
    grams, out = {}, set()
    for i, x in items:
        w = words(x)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    for d, x in docs_:
        w = words(x)
        for k in range(len(w) - 11):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    return out


def test_p9_equals_brute_force(spark):
    read = lambda n, *c: list(zip(*[x.to_pylist() for x in ds.dataset(f"{SF}/{n}.parquet").to_table(columns=list(c)).columns], strict=True))
    want = exact(read("documents", "doc_id", "text"), read("eval_item", "item_id", "item_text"))
    assert {tuple(r) for r in queries.p9_found(spark, SF).collect()} == want


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_sql(spark, name):
    from tests.test_queries import same_as_sql

    same_as_sql(spark, queries, name)


def test_two_replaced_words_anywhere_are_found():
    item = [f"w{i}" for i in range(leaks.SPAN)]
    index = leaks.Index([("a", " ".join(item))])
    for i in range(leaks.SPAN):
        for j in range(i, leaks.SPAN):
            text = ["x", *[w if k not in (i, j) else "other" for k, w in enumerate(item)], "y"]
            (found,) = index.overlaps(leaks.word_hashes(text), np.array([len(text)]))
            assert found[3:] == (leaks.SPAN, len({i, j}))


def test_both_ways_find_the_same(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(40)]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [item(n) for n in (12, 20, 60, 60, 11)] + ["cab " * 40] * 3
    items = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(texts)] + [(None, "x"), ("n", None)], "item_id string, item_text string")
    pages = ["cab " * 300, None, " "]
    for t in texts:
        w = t.split()
        for _ in range(3):
            at = rng.randrange(max(1, len(w) - 13))
            cut = [x if rng.random() > 0.12 else "other" for x in w[at : at + rng.randrange(12, 30)]]
            pages.append(" ".join([item(rng.randrange(4)), *cut, item(rng.randrange(30))]))
    d = docs(spark, pages)
    got = []
    for most in (10**6, 0):
        monkeypatch.setattr(leaks, "BLOCK_CHARS", most)
        got.append({tuple(r) for r in leaks.overlaps(d, "doc_id", "text", items, "item_id", "item_text").collect()})
    assert got[0] == got[1] and len(got[0]) > 10 and {(0, f"i{k}", 40, 40, 0) for k in (5, 6, 7)} <= got[0]


def test_words_of_any_writing():
    plain = "the quick fee of 12 coins was ﬁne"
    for text in (plain.upper(), "the <b>qu</b>ick fee&nbsp;of １２ coins; was fine!", "the qu­ick​ fee of 12 co⁠ins was\r\n fine", "The—quick_fee…of 12 (coins) was &#102;ine"):
        assert words(text) == words(plain) == ["the", "quick", "fee", "of", "12", "coins", "was", "fine"]
    assert words(None) == words("") == words(" \n") == []
    assert words("Café STRASSE ẞ") == words("café strasse ss")


def test_leaks_at_the_limits(spark, monkeypatch):
    item = [f"w{i}" for i in range(40)]
    cut = lambda a, b: " ".join(item[a:b])
    swapped = " ".join(w if i % 6 else "other" for i, w in enumerate(item))  # two of any twelve words
    texts = [None, "", "  ", cut(0, 12), cut(5, 16), "x " * 5000 + cut(28, 40) + " y" * 5000, cut(0, 11) + " z " + cut(11, 22), swapped, cut(0, 12), "<p>" + ",".join(item[3:20]) + "</p>"]
    items = spark.createDataFrame([(7, " ".join(item)), (8, cut(0, 12)), (9, None), (10, "short"), (7, " ".join(item))], "item_id long, item_text string").withColumn("i", F.lit(1))
    d = docs(spark, texts)
    want = {(3, 7), (3, 8), (5, 7), (8, 7), (8, 8), (9, 7)}
    assert {tuple(r) for r in leaks.leaks(d, "doc_id", "text", items, "item_id", "item_text").collect()} == want
    over = {(r["doc_id"], r["item_id"]): r for r in leaks.overlaps(d, "doc_id", "text", items, "item_id", "item_text").collect()}
    assert tuple(over[7, 7])[2:] == (5, 40, 7)  # found through replaced words
    assert tuple(over[6, 7])[2:] == (11, 13, 2)
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 20)  # by shuffle
    assert {tuple(r) for r in leaks.leaks(d, "doc_id", "text", items, "item_id", "item_text").collect()} == want
    assert leaks.leaks(d.limit(0), "doc_id", "text", items, "item_id", "item_text").count() == 0
    assert leaks.leaks(d, "doc_id", "text", items.limit(0), "item_id", "item_text").count() == 0


# 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25))
def test_repeats_by_definition(symbols):
    n, want = len(symbols), bytearray(len(symbols))
    seen = {}
    for i in range(n):
        for j in range(i + 1, n + 1):
            seen.setdefault(tuple(symbols[i:j]), []).append((i, j))
    for places in seen.values():
        if len(places) > 1:
            for i, j in places:
                want[i:j] = b"\x01" * (j - i)
    assert stuffing.repeats(symbols) == want


SENTENCES = [
    "The dispatcher checked the meter before dawn and wrote the reading into the ledger.", "Nobody knew why the load had stopped, so the analyst called the base.", "Two riders shared a cab to the harbour and paid in cash.",
    "It is not clear whether the tip was booked twice or left out.", "La tabla se volverá a cargar mañana, señaló la analista.", "Der Fahrer prüfte das Taxameter, weil der Preis nicht zur Strecke passte.",
]


def page(kind, n, rng):
    keys = ["cheap taxi", "night cab", "book online", "best rates", "airport transfer"]
    zone = lambda: rng.choice(["Elm", "Oak", "Fen"]) + rng.choice(["wick", "ham", "port", "ley"])
    if kind == "run":
        return " ".join(rng.choice(keys) for _ in range(n))
    if kind == "bars":
        return " | ".join(rng.choice(keys) for _ in range(n))
    if kind == "tags":
        return " ".join("#" + "".join(w.title() for w in rng.choice(keys).split()) + zone() for _ in range(n))
    if kind == "links":
        return "\n".join(f"https://{zone().lower()}.test/{zone().lower()}-{i}" for i in range(n))
    if kind == "markdown":
        return "\n".join(f"- [{rng.choice(keys)} {zone()}](https://x{i}.example/p)" for i in range(n))
    if kind == "html":
        return "<ul>" + "".join(f'<li><a href="//x{i}.test/a">taxi de nuit</a></li>' for i in range(n)) + "</ul>"
    if kind == "products":
        return " / ".join(f"{rng.choice(['roof sign', 'seat cover', 'toll tag'])} SKU-{rng.randrange(9999)}" for _ in range(n))
    words_ = "taxi cab near me night cheap hire".split()
    return " ".join(" ".join(rng.choice(words_) for _ in range(5)).capitalize() + rng.choice(".!") for _ in range(n))


@pytest.mark.parametrize("kind", ["run", "bars", "tags", "links", "markdown", "html", "products", "sentences"])
def test_stuffed_pages(kind):
    rng = random.Random(kind)
    spam, prose = page(kind, 40, rng), " ".join(rng.choice(SENTENCES) for _ in range(12))
    assert stuffing.filler_share(spam)[0] > 0.8
    assert stuffing.filler_share(SENTENCES[0] + "\n" + spam)[0] > 0.5
    assert stuffing.filler_share(prose + "\n" + page(kind, 4, rng))[0] < 0.4


def test_pages_of_sentences_are_no_case():
    rng = random.Random(1)
    for text in ("\n".join(SENTENCES * 30), " ".join(SENTENCES), "Elmham taxi, Elmham taxi, Elmham taxi! The shout went on all night. " + " ".join(SENTENCES), "\n".join(f"Q: {a}\nA: {b}" for a, b in zip(SENTENCES, SENTENCES[1:], strict=False)), "# Title\n\n" + "\n".join(f"{i}. {s}" for i, s in enumerate(SENTENCES)), " ".join(SENTENCES * 2) + "\nLinks:\n" + page("links", 8, rng)):
        assert stuffing.filler_share(text)[0] < 0.4, text[:60]


def test_stuffed_pages_in_spark(spark):
    d = docs(spark, [None, "", " \n", "...", "word", page("run", 60, random.Random(2)), page("run", 60, random.Random(2)), " ".join(SENTENCES), "cab " * 50_000])
    assert {r["doc_id"] for r in stuffing.stuffed_pages(d, "doc_id", "text").collect()} == {5, 6, 8}
    assert stuffing.stuffed_pages(d.limit(0), "doc_id", "text").count() == 0
