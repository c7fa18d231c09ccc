"""Personal data, bit-sliced search and benchmark containment against brute force, with defined cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import bitslice, containment, pii, queries
from tests.oracle import compare, connect

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits),
                    "phone": 9 <= len(digits) <= 15}[kind]:
                yield f"{kind}:{m.start()}:{m.end()}"


def texts():
    rng = random.Random(5)
    out = ["".join(rng.choice("a.@-+0123456789 1()b%C\né\U0001F600") for _ in range(rng.randint(0, 120))) for _ in range(600)]
    return out + ["a@b.c_d@e.f x@y.z@w.v", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111 1111 1111", "1" * 50_000, "1 " * 30_000,
                  "a." * 30_000 + "@" + "b." * 30_000 + "c", "+1" + "." * 20_000 + "5 +49 (0) 123 45678-9", "ab@c.de " * 3000, None, "", "4111-1111-1111-1111"]


def test_base_spans_equal_brute_force(spark, tmp_path):
    given = texts()
    spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op7_pii(spark, str(tmp_path)).collect()}
    for i, text in enumerate(given):
        want = list(base_spans(text or ""))
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(w.startswith(k) for w in want) for k in BASE]


def test_added_kinds_and_scores(spark):
    rows = [(1, "iban DE89 3704 0044 0532 0130 00 end"), (2, "iban DE89 3704 0044 0532 0130 01 end"), (3, "ssn 123-45-6789"), (4, "part 123-45-6789"), (5, "ssn 000-45-6789")]
    found = {r.id: r.findings for r in pii.scan(spark.createDataFrame(rows, "id int, text string"), "text").collect()}
    assert [f["kind"] for f in found[1]] == ["iban"] and found[1][0]["score"] == 1.0
    assert (found[1][0]["start"], found[1][0]["end"]) == (5, 32)
    assert found[2] == [] and [f["kind"] for f in found[3]] == ["ssn"] and found[4] == [] and found[5] == []


def test_redact(spark):
    rows = [(1, "mail bob@x.com now +1 (456) 555-2186 end", "s"), (2, None, "b"), (3, "", "c"), (4, "+4111111111111111", None), (1, "a@b.c", "s")]
    docs = spark.createDataFrame(rows, "found long, text string, row string")
    got = [tuple(r) for r in pii.redact(docs, "text").collect()]
    assert got == [(1, "mail [EMAIL] now [PHONE] end", "s"), (2, None, "b"), (3, "", "c"), (4, "+[CARD]", None), (1, "[EMAIL]", "s")]
    assert pii.redact(docs.limit(0), "text").count() == 0


def brute_top(rows, k, step=1):
    clean = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = {}
    for q, a in clean:
        if q % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in clean if i != q and len(a) == len(b))[:k]
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return {q: r for q, r in out.items() if r}


@pytest.mark.parametrize("block", [7, 64, 1000])
def test_top_k(spark, block):
    rng = np.random.default_rng(2)
    same = [0.5, -0.25, 0.125]
    rows = [(i, rng.normal(size=3).astype("float32").tolist() if i % 3 else same) for i in range(150)]
    rows += [(500, None), (501, [1.0, None, 2.0]), (502, [float("nan")] * 3), (503, [float("inf"), 0.0, 0.0]), (None, same), (504, [1.0, 2.0]), (506, [3.0, -1.0]), (505, [1000.0, -2000.0, 3.0])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in bitslice.top_k(vectors, "vec_id", "embedding", F.col("id") % 2 == 0, block_rows=block, query_rows=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute_top(rows, 5, 2)


def test_top_k_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bitslice.top_k(empty, "vec_id", "embedding", F.col("id") % 2 == 0).count() == 0


def test_adders():
    rng = np.random.default_rng(4)
    values = rng.integers(-50, 90, size=(130, 6))
    query = rng.integers(-9, 9, size=6)
    slices, low, bits = bitslice.slice_block(values)
    sums = bitslice.score_slices(query, np.stack([slices, ~slices]))
    total = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << i for i, s in enumerate(sums))
    shifted = values - low
    want = (np.where(query > 0, query, 0) * shifted + np.where(query < 0, -query, 0) * ((1 << bits) - 1 - shifted)).sum(axis=1)
    assert (total == want).all()


def shingle_set(text, width):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def test_containment_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 4, 5, 9, 20, 60])))) for i in range(30)] + [(90, None), (91, "..."), (3, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(120):
        w = [rng.choice(words) for _ in range(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items[:30])[1].split()
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = rng.choice(words)
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append((d, ", ".join(w).upper()))
    docs += [(500, None), (501, ""), (502, items[5][1] + " x" * 100_000), (7, docs[7][1])]
    got = {(r.doc, r.item): (r.n_common, r.n_item) for r in containment.contained(
        spark.createDataFrame([(*d, "h") for d in docs], "doc_id long, text string, h string"), "doc_id", "text",
        spark.createDataFrame([(*i, "item") for i in items], "item_id long, text string, item string"), "item_id", "text").collect()}
    want = {}
    merged = {}
    for i, text in items:
        n = len([x for x in re.split(r"[\W_]+", (text or "").lower()) if x])
        if n:
            merged.setdefault(i, set()).update((min(n, 5), s) for s in shingle_set(text, min(n, 5)))
    for d, text in docs:
        for i, shingles in merged.items():
            common = sum(s in shingle_set(text, k) for k, s in shingles) if d != 502 or i == 5 else 0
            if common and common >= 0.8 * len(shingles) - 1e-9:
                want[d, i] = (common, len(shingles))
    assert {k: v for k, v in got.items() if k[0] != 502 or k[1] == 5} == want and len(want) > 30


@pytest.mark.parametrize("name", ["op6_bit_sliced_top_k", "op8_benchmark_containment"])
def test_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, name, queries.queries()[name], queries.oracles()[name])["status"] == "match"
