"""Line dedup, spelling variants and vector codes against brute force, with defined cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lotwise.llm import linededup, queries, variants, vectorcodes
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_line_dedup", "op13_vector_codes"])
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, queries.queries()[name], queries.oracles()[name])["status"].startswith("match")


# --- lines ------------------------------------------------------------------------------------------

WHITE = " \t\n\r\x0b\x0c"


def lowered(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def lines_by_hand(rows, min_docs=2, min_chars=10):
    """rows in the order of documents"""
    held = {}
    for place, (_, text) in enumerate(rows):
        for key in {lowered(x.strip(WHITE)) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                held.setdefault(key, []).append(place)
    out = []
    for place, (key, text) in enumerate(rows):
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(h := held.get(lowered(x.strip(WHITE)), [])) >= min_docs and h[0] != place)]
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def line_rows():
    rng = random.Random(3)
    pool = ["Cookies make this site work ", "cookies make this SITE work", "short", "  ninechars", "exactly 10", "ÄÖÜ äöü Straße", " no strip  here", "a\rb inside the line", "", " ", "0123456789" * 40, "ééééé"]
    rows = [(i, "\n".join(rng.choice([*pool, f"line {rng.randint(0, 60)} of many"]) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "\n\n\n"), (503, "Cookies make this site work\n" * 5000 + "own last line here"), (504, "\r\n".join(pool))]


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    given = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "key long, at string, places string, high int, n_lines int")
    for docs, chars in ((2, 10), (3, 5)):
        got = {r.key: tuple(r) for r in linededup.drop_repeated_lines(given, "key", "at", docs, chars).collect()}
        assert got == {r[0]: r for r in lines_by_hand(rows, docs, chars)}


def test_lines_of_repeated_and_missing_ids(spark):
    rows = [(None, "a line of nobody\nb"), (1, "a line of nobody\nfirst of one"), (1, "first of one\na line of nobody"), (2, "first of one")]
    got = Counter(tuple(r) for r in linededup.drop_repeated_lines(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect())
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    assert got == Counter(lines_by_hand(ordered))
    assert linededup.drop_repeated_lines(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0


def test_a_line_of_every_document_stays_once(spark):
    rows = [(i, f"the licence of all documents\nown line number {i}") for i in range(3000)]
    got = linededup.drop_repeated_lines(spark.createDataFrame(rows, "id long, text string").repartition(7), "id", "text")
    assert got.agg({"n_dropped": "sum"}).first()[0] == 2999
    assert got.where("text like 'the licence%'").select("key").collect() == [(0,)]


# --- words ------------------------------------------------------------------------------------------

def is_letter(c):
    return "a" <= c <= "z" or "À" <= c <= "ÿ"


def words_by_hand(rows, noise=31):
    total = Counter()
    for key, text in rows:
        run = ""
        for c in lowered(text or "") + " ":
            if is_letter(c):
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                if noise and h % noise == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= 7:
                    total[run] += 1
            run = ""
    return {w: n for w, n in total.items() if n >= 2}


def near_by_hand(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:]


def groups_by_hand(words, ratio=10):
    out = {}
    for w, n in words.items():
        near = [x for x in words if near_by_hand(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if best and words[best] >= ratio * n else None, n, len(near))
    rows = set()
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, n_near, words[form] if form else None))
    return rows


def word_rows():
    rng = random.Random(7)
    base = ["letters", "Übermäßig", "aaaaaaaa", "aaaaaaab", "×÷×÷×÷×", "prefixes", "prefixed", "ÿÿÿÿÿÿÿ", "sixsix", "q" * 3000, "q" * 3001]

    def changed(w):
        at = rng.randrange(len(w))
        return rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at:], w[:at] + rng.choice("xyz") + w[at + 1:], w, w, w, w])

    rows = [(i, rng.choice([" ", ", ", "\n", "1", "Ā", "\U0001F600"]).join(changed(rng.choice(base)) for _ in range(25))) for i in range(150)]
    return rows + [(None, "letters letters"), (7, "letters LETTERS"), (7, None), (900, ""), (901, "letters " * 9000)]


@pytest.mark.parametrize("bound", [1024, 3])
def test_variants_equal_brute_force(spark, bound):
    rows = word_rows()
    words = words_by_hand(rows)
    given = spark.createDataFrame([(*r, 1, "g", 2) for r in rows], "word long, text string, n int, `group` string, tag int")
    counted = variants.word_counts(given, "word", "text", noise=31)
    assert {r.word: r.n for r in counted.collect()} == words
    assert {tuple(r) for r in variants.group_variants(counted, group_words=bound).collect()} == groups_by_hand(words)


def test_crowded_groups_are_cut(spark):
    """Words that share all of their first half: no group stays above the bound unless it is a single place."""
    rng = random.Random(1)
    words = sorted({"abcdefgh" + "".join(rng.choice("abcd") for _ in range(8)) for _ in range(1500)})
    given = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    rows = variants.candidate_groups(given, 7, 40)
    sizes = rows.groupBy("group", "low", "high").count().collect()
    assert all(r["count"] <= 40 or r["high"] - r["low"] == 1 for r in sizes)
    assert rows.count() <= len(words) * 4 * 2 ** math.ceil(math.log2(18))
    got = {(r.word, r.near) for r in variants.near_words(given, 7, 40).collect()}
    assert got == {(a, b) for a in words for b in words if near_by_hand(a, b)}
    assert variants.near_words(given, 7, 40).count() == len(got)


def test_forms_lead_to_roots(spark):
    rows = [("aaaaaaa", 1000), ("aaaaaab", 100), ("aaaaabb", 10), ("aaaabbb", 2), ("zzzzzzz", 5), ("aaaaaac", 100)]
    got = {r.word: (r.form, r.root) for r in variants.group_variants(spark.createDataFrame(rows, "word string, n long"), ratio=5).collect()}
    assert got == {"aaaaaaa": (None, "aaaaaaa"), "aaaaaab": ("aaaaaaa", "aaaaaaa"), "aaaaabb": ("aaaaaab", "aaaaaaa"), "aaaabbb": ("aaaaabb", "aaaaaaa"),
                   "zzzzzzz": (None, "zzzzzzz"), "aaaaaac": ("aaaaaaa", "aaaaaaa")}
    assert variants.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0


# --- vectors ----------------------------------------------------------------------------------------

def codes_by_hand(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows of (id, vector) that take part, in order of ids"""
    x = np.array([[math.floor(scale * v) for v in vec] for _, vec in rows], dtype=object).reshape(len(rows), parts, -1)
    books = [[x[i, p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def assign(p):
        return [min(range(len(books[p])), key=lambda e: (sum((x[i, p] - books[p][e]) ** 2), e)) for i in range(len(rows))]

    for _ in range(rounds):
        for p in range(parts):
            placed = assign(p)
            books[p] = [sum(x[i, p] for i in range(len(rows)) if placed[i] == e) // placed.count(e) if e in placed else books[p][e] for e in range(len(books[p]))]
    final = [assign(p) for p in range(parts)]
    return books, [([final[p][i] for p in range(parts)], sum(int(sum((x[i, p] - books[p][final[p][i]]) ** 2)) for p in range(parts))) for i in range(len(rows))]


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), np.round(rng.normal(size=8), 3).tolist()) for i in rng.permutation(140)]
    rows += [(200 + i, [0.25, -0.5] * 4) for i in range(70)] + [(300, [1e5, -1e5] * 4)]
    out = [(400, None), (401, []), (402, [1.0, None] * 4), (403, [float("nan")] * 8), (404, [float("inf")] * 8), (405, [1.0] * 4), (406, [3e5] * 8)]
    given = spark.createDataFrame([(*r, "a", 1, 2) for r in rows + out], "key long, part array<double>, code string, `row` int, entry int").repartition(5)
    for entries, rounds in ((16, 4), (256, 2), (5, 0)):
        found = vectorcodes.compress(given, "key", "part", ["row", "entry"], entries=entries, rounds=rounds)
        ordered = sorted(rows)
        books, want = codes_by_hand(ordered, entries=entries, rounds=rounds)
        assert found.books.tolist() == [[list(map(int, e)) for e in b] for b in books]
        assert {r.key: (r.code, r.error) for r in found.rows.collect()} == {k: w for (k, _), w in zip(ordered, want, strict=True)}
        assert {tuple(r) for r in found.rows.select("row", "entry").collect()} == {(1, 2)}
    assert found.digest() == hashlib.sha256(",".join(str(int(v)) for b in books for e in b for v in e).encode()).hexdigest()


def test_codes_of_repeated_and_missing_ids(spark):
    rows = [(1, [0.5, 0.5]), (1, [0.25, 0.5]), (None, [9.0, 9.0]), (None, [9.0, 8.0]), (2, [0.5, 0.5])]
    found = vectorcodes.compress(spark.createDataFrame(rows, "id long, v array<float>"), "id", "v", parts=2, entries=2, rounds=1)
    _, want = codes_by_hand([(1, [0.25, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [9.0, 8.0]), (None, [9.0, 9.0])], 2, 2, 1)
    assert Counter((r.key, tuple(r.code), r.error) for r in found.rows.collect()) == Counter((k, tuple(c), e) for k, (c, e) in zip([1, 1, 2, None, None], want, strict=True))
    empty = vectorcodes.compress(spark.createDataFrame([], "id long, v array<float>, label int"), "id", "v", ["label"])
    assert empty.rows.columns == ["key", "label", "code", "error"] and empty.rows.count() == 0 and empty.books.size == 0
    with pytest.raises(ValueError):
        vectorcodes.compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id long, v array<float>"), "id", "v")


def test_decoded_vectors_are_close(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    found = vectorcodes.compress(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v")
    given = dict(rows)
    for r in found.decoded().collect():
        error = sum((math.floor(1024 * a) - math.floor(1024 * b)) ** 2 for a, b in zip(given[r.key], r.vector, strict=True))
        assert error == r.error


def test_large_integers_are_exact():
    rng = np.random.default_rng(1)
    small = rng.integers(-2000, 2000, (300, 6))
    large = small * (1 << 15) + 1
    for parts, book in ((small, small[:20]), (large, large[:20] - 1)):
        want = ((parts[:, None].astype(object) - book[None].astype(object)) ** 2).sum(axis=2)
        index, distance = vectorcodes.nearest(parts, book)
        assert index.tolist() == [int(np.argmin(w)) for w in want] and distance.tolist() == [int(min(w)) for w in want]
