"""Language masks, toxicity machine and URL filter: held-out accuracy, brute-force scores and defined cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm import langid, queries, toxicity, urlfilter

SF = "/root/testdata/sf0.01"
LANGS = {"aa": "nora tali sumo riva", "bb": "kezx quix zapf wulk", "cc": "ñandú señor año piñata"}
SCHEMA = "doc_id long, text string, lang string, score string, key string"


def corpus(spark, n=120):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(LANGS[k].split()) for _ in range(rng.randint(3, 30))), k, "x", None)
            for i, k in enumerate(rng.choice(list(LANGS)) for _ in range(n))]
    rows += [(None, None, "aa", None, None), (900, "", None, None, None), (901, "123 ..! \U0001F600", "bb", None, None), (902, "nora " * 60_000, None, None, None),
             (0, rows[0][1], rows[0][2], "x", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_language_cases(spark):
    docs = corpus(spark)
    model = langid.fit(docs, "text", "lang", "doc_id", F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False)), slot_bits=14)
    got = {r.doc_id: r for r in langid.identify(docs, "text", model, ["doc_id"]).collect()}
    truth = {r.doc_id: r.lang for r in docs.where("doc_id < 900").collect()}
    assert all(got[i].lang_pred == k for i, k in truth.items())
    assert [got[i].lang_pred for i in (None, 900, 901)] == ["und"] * 3
    assert got[902].lang_pred == "aa" and 0 <= got[902].score <= 1
    assert langid.identify(docs.limit(0), "text", model, ["doc_id"]).count() == 0


def test_no_training_rows(spark):
    docs = corpus(spark, 5)
    model = langid.fit(docs, "text", "lang", "doc_id", F.lit(False), slot_bits=10)
    assert {r.lang_pred for r in langid.identify(docs, "text", model, ["doc_id"]).collect()} == {"und"}


def test_filter_returns_all_languages_of_a_gram(spark):
    """The two lookups of an n-gram hold the bit of every language that it was fitted for."""
    docs = corpus(spark)
    model = langid.fit(docs, "text", "lang", "doc_id", F.lit(True), slot_bits=16)
    for k, words in LANGS.items():
        h, _ = langid.grams([words])
        low = np.uint64((1 << 16) - 1)
        mask = model.masks[h & low, 0] & model.masks[(h >> np.uint64(32)) & low, 0]
        assert (mask >> np.uint64(model.langs.index(k)) & np.uint64(1)).mean() > 0.9


def test_long_text_in_pieces():
    texts = ["alpha beta " * 400, "x"]
    model = langid.Filter(["aa"], 10, np.full((1024, 1), 1, dtype=np.uint64))
    whole = model.counts(texts)[1]
    old, langid.PIECE = langid.PIECE, 300
    try:
        parts = model.counts(texts)[1]
    finally:
        langid.PIECE = old
    assert abs(parts[0] - whole[0]) < 0.05 * whole[0] and parts[1] == whole[1]


def test_language_held_out(spark):
    got = queries.op1_language_masks(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    assert got.count() == docs.count()
    share = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98


def toy_labels():
    """Toxic only if an insult and a group name meet: additive weights cannot tell."""
    rng = random.Random(3)
    texts, y = [], []
    for _ in range(800):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice(["sun", "sea", "tree", "road"]) for _ in range(6)] + ["scum"] * insult + ["martians"] * group
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(int(insult and group))
    return texts, y


def toy_machine(texts, y, epochs=120):
    row, bucket = toxicity.terms(pa.array(texts), 16)
    y = np.array(y, dtype=float)
    z = toxicity.association(np.bincount(bucket, minlength=1 << 16), np.bincount(bucket, y[row], 1 << 16), y.sum(), len(y) - y.sum())
    kept = toxicity.choose(z, np.zeros(1 << 16))
    place = np.full(1 << 16, -1)
    place[kept] = np.arange(len(kept))
    used = place[bucket] >= 0
    return toxicity.train(row[used], place[bucket[used]], y, np.ones(len(y)), kept, 16, epochs=epochs), row, bucket


def test_machine_learns_pairs():
    machine, _, _ = toy_machine(*toy_labels())
    p = machine.score(pa.array(["sun scum", "martians road", "scum tree martians", ""]))
    assert p[0] < 0.5 and p[1] < 0.5 and p[2] > 0.8 and p[3] < 0.5


def test_margin_is_the_pair_sum():
    texts, y = toy_labels()
    machine, row, bucket = toy_machine(texts[:50], y[:50], epochs=3)
    kept = np.unique(bucket)[::2]
    machine.places[:] = -1
    machine.places[kept] = np.arange(len(kept))
    machine.weights, machine.vectors = np.arange(len(kept)) / 7, np.random.default_rng(1).normal(size=(len(kept), 3))
    got = machine.margins(row, bucket, 50)
    for i in range(50):
        used = [machine.places[b] for b in bucket[row == i] if machine.places[b] >= 0]
        want = machine.bias + sum(machine.weights[a] for a in used) + sum(
            machine.vectors[a] @ machine.vectors[b] for n, a in enumerate(used) for b in used[:n])
        assert math.isclose(got[i], want, abs_tol=1e-9)


def test_toxicity_cases(spark):
    texts, y = toy_labels()
    docs = spark.createDataFrame([*enumerate(texts), (5000, None), (5001, ""), (None, "scum martians"), (5002, "scum martians " * 50_000), (3, texts[3])], "doc_id long, text string")
    labels = spark.createDataFrame([*enumerate(y), (5000, None), (None, 1), (4, 1), (4, 0)], "doc_id long, toxic int")
    machine = toxicity.fit(docs, "text", "doc_id", labels, "doc_id", "toxic", F.col("key") % 3 != 1, bits=16)
    got = toxicity.score(docs.withColumnRenamed("doc_id", "key_0").withColumn("key", F.lit("k")), "text", machine, ["key_0", "key"], "y").collect()
    assert len(got) == len(texts) + 5
    by = {r.key_0: r.y for r in got}
    assert by[None] > 0.5 and by[5002] > 0.5 and by[5000] == by[5001] < 0.5
    none = toxicity.fit(docs, "text", "doc_id", labels.limit(0), "doc_id", "toxic", F.lit(True), bits=16)
    assert all(r.y < 1e-6 for r in toxicity.score(docs, "text", none, [], "y").collect())
    assert toxicity.score(docs.limit(0), "text", machine, ["doc_id"], "y").count() == 0


def test_toxicity_held_out(spark):
    got = queries.op3_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    n = got.join(labels, "doc_id").where("held_out").agg(
        F.sum(F.expr("int(predicted = 1 and toxic = 1)")), F.sum("predicted"), F.sum("toxic")).first()
    assert n[0] / n[1] > 0.95 and n[0] / n[2] > 0.8


def brute_segments(part, counts, total):
    if not part:
        return 0.0, []
    best = None
    for i in range(1, min(len(part), urlfilter.MAX_WORD) + 1):
        n = counts.get(part[:i])
        cost = math.log(n / total) if n else math.log(10 / total) - i * math.log(10)
        rest, words = brute_segments(part[i:], counts, total)
        if best is None or cost + rest > best[0] + 1e-12:
            best = cost + rest, [part[:i], *words]
    return best


@pytest.mark.parametrize("part", ["spamfarm", "casinowin", "abcab", "zz", "winspamx"])
def test_viterbi(part):
    counts = {"spam": 50, "farm": 30, "casino": 40, "win": 60, "a": 5, "ab": 9, "cab": 3}
    got = urlfilter.viterbi(part, counts, 200.0)
    cost = sum(math.log(counts[w] / 200) if w in counts else math.log(10 / 200) - len(w) * math.log(10) for w in got)
    assert "".join(got) == part and math.isclose(cost, brute_segments(part, counts, 200.0)[0])


def test_url_cases(spark):
    urls = ["http://A.Example.ORG/es/x?q", "https://example.org", "http://spamfarm.net/en/1", "http://good.net/en/2#f", None, "no scheme", "", "http://x.com/de/1",
            "http://x.com/fr/1", "http://notorg/", "http://org/", "://h/p", "http://b.net?x=/y", "http://é.net/" + "p" * 50_000]
    rows = [(i, u, "<p>good spam farm farm spam</p>", "c") for i, u in enumerate(urls)] + [(3, urls[3], None, "c"), (None, urls[2], "", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = urlfilter.classify(pages, "page_id", "url", queries.OP9_RULES, "html").collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert (by[0].host, by[0].path, by[0].rule, by[0].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert (by[1].path, by[1].rule) == ("", None)
    assert by[2].verdict == "block" == by[None].verdict and by[3].verdict == "allow"
    assert all((by[i].host, by[i].path) == ("", "") for i in (4, 5, 6))
    assert (by[7].verdict, by[8].verdict, by[9].rule, by[10].rule) == ("block", "allow", None, "org/")
    assert (by[11].host, by[11].path, by[12].host, by[12].path) == ("h", "/p", "b.net", "")
    assert by[13].host == "é.net" and len(by[13].path) == 50_001
    assert urlfilter.classify(pages.limit(0), "page_id", "url", queries.OP9_RULES, "html").count() == 0
