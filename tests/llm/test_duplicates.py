"""Passage chains, heavy-light join, suffix runs and connected components against brute force, with defined cases."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import chaining, common, heavylight, queries, suffixdedup, words
from tests.oracle import compare, connect

WORDS = [f"w{i}" for i in range(3000)]


def components_of(ids, edges):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(70)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    ids = {x for a, b in edges if a != b for x in (a, b)}
    assert got == components_of(ids, [e for e in edges if e[0] != e[1]])
    assert common.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def shingle_set(text, width):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for size in (1, 2, 3, 5, 9, 12, 20, 25, 40, 120, 700):
        for _ in range(3):
            base = [rng.choice(WORDS) for _ in range(size)]
            rows += [edited(rng, base, rng.randint(0, max(1, size // 25))) for _ in range(rng.randint(1, 6))]
            rows.append(" ".join(base[:-1]))
    line = " ".join(rng.choice(WORDS) for _ in range(12))
    rows += [f"{line}\n{' '.join(rng.choice(WORDS) for _ in range(rng.randint(1, 60)))}" for _ in range(60)]
    rows += [None, "", " \n\t", "One", "one", rows[0], rows[0].upper(), "one two"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_jaccard_links_through_rows_without_an_id_and_rows_of_one_id(spark):
    words = [f"w{i}" for i in range(60)]
    near = lambda low, high: " ".join([*(f"x{i}" for i in range(low)), *words[low:60 - high], *(f"y{i}" for i in range(high))])
    rows = [(5, near(0, 0)), (None, near(2, 0)), (7, near(2, 2)), (2, "a b c d"), (2, "e f g h"), (1, "a b c d"), (3, "e f g h"), (None, "lonely text of its own"), (None, None)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "id long, text string, number int")
    got = sorted(((r.id, r.component_id) for r in heavylight.jaccard_components(docs, "id", "text").collect()), key=str)
    assert got == sorted([(5, 5), (None, 5), (7, 5), (2, 1), (2, 1), (1, 1), (3, 1), (None, None), (None, None)], key=str)


@pytest.mark.parametrize(("width", "percent", "block"), [(3, 90, 256), (5, 80, 4)])
def test_jaccard_components(spark, width, percent, block):
    rows = near_copies(width)
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    edges = [(i, j) for (i, a), (j, b) in itertools.combinations(sets, 2) if a and b and 100 * len(a & b) >= percent * len(a | b)]
    want = components_of([i for i, _ in rows], edges)
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, component string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in heavylight.jaccard_components(docs, "doc_id", "text", width, percent, block).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets}
    assert len({v for v in want.values()}) < len(rows) - 40


def test_jaccard_cases(spark):
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (1, "q"), (5, "w " * 150_000), (6, "w " * 150_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in heavylight.jaccard_components(docs, "doc_id", "text").collect()), key=str)
    assert got == sorted([(3, 2, 3), (3, 2, 3), (None, 2, 3), (1, 1, 1), (5, 1, 5), (6, 1, 5)], key=str)
    assert heavylight.jaccard_components(docs.limit(0), "doc_id", "text").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(0, 60), st.integers(0, 60), st.sampled_from([80, 90]))
def test_light_and_heavy_bounds(common_size, a, b, percent):
    """Linked sets share a subset of an enumerated size if both are light, and a prefix element in any order."""
    s, t = set(range(common_size + a)), set(range(common_size)) | set(range(1000, 1000 + b))
    if 100 * common_size < percent * len(s | t) or s == t:
        return
    limit = max(len(s), len(t)) + 1
    shared = set(heavylight.subset_sizes(len(s), percent, limit)) & set(heavylight.subset_sizes(len(t), percent, limit))
    assert any(c <= common_size for c in shared)
    rng = random.Random(common_size)
    order = {x: rng.random() for x in s | t}
    heads = [set(sorted(x, key=order.get)[:heavylight.prefix_length(len(x), percent)]) for x in (s, t)]
    assert heads[0] & heads[1]
    assert set(heavylight.group_counts(len(s), percent)) & set(heavylight.group_counts(len(t), percent))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "b", "é", " ", "\n", "\x0b", "\x1c", "zz"]), max_size=30), st.lists(st.sampled_from(["a", " "]), max_size=5))
def test_word_hashes(one, two):
    import re

    texts = ["".join(one), "".join(two), None, "A b"]
    import pyarrow as pa

    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    hashed, begins, ends, cuts = words.word_hashes(data, offsets)
    every = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert np.diff(cuts).tolist() == [len(w) for w in every]
    lower = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for t in every for w in t]
    assert [bytes(data[b:e]).decode() for b, e in zip(begins, ends, strict=True)] == [w for t in every for w in t]
    assert len(set(zip(lower, hashed.tolist(), strict=True))) == len(set(lower)) == len(set(hashed.tolist()))


def test_long_texts_are_cut_alike(monkeypatch):
    import pyarrow as pa

    rng = random.Random(8)
    text = " ".join(rng.choice(WORDS) for _ in range(4000))
    data, offsets = words.text_bytes(pa.array([text]))
    whole = words.word_hashes(data, offsets)[0]
    anchors = suffixdedup.anchors(data, np.full(len(data), len(data)), 100, 32)
    monkeypatch.setattr(words, "SLICE_BYTES", 500)
    monkeypatch.setattr(suffixdedup, "PIECE", 700)
    assert (words.word_hashes(data, offsets)[0] == whole).all()
    again = suffixdedup.anchors(data, np.full(len(data), len(data)), 100, 32)
    assert all((a == b).all() for a, b in zip(anchors, again, strict=True))


def brute_removed(rows, length=100):
    first = {}
    for d, t in sorted(rows):
        for i in range(len(t) - length + 1):
            first.setdefault(t[i:i + length], (d, i))
    for d, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] != (d, i):
                gone[i:i + length] = True
        kept = bytes(b for b, x in zip(t, gone, strict=True) if not x)
        yield d, (len(t), int(gone.sum()), int((np.diff(np.append([0], gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest())


def repeated_bytes(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cdéxyz") for _ in range(400)) for _ in range(4)]
    out = []
    for _ in range(120):
        t = ""
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, 350)
            t += rng.choice(base)[at:at + rng.randint(20, 260)] + "".join(rng.choice("pqrs") for _ in range(rng.randint(0, 40)))
        out.append(t)
    return out + ["a" * 500, "a" * 300, "ab" * 200, "\x00" * 300, "q" * 99, "q" * 99, "", None, out[3], out[3], out[5]]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_runs(spark, seed):
    rows = list(enumerate(repeated_bytes(seed)))
    docs = spark.createDataFrame([(*r, "k", 0) for r in rows], "doc_id long, text string, key string, spans int").repartition(6)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.remove_repeats(docs, "doc_id", "text").collect()}
    assert got == dict(brute_removed([(i, (t or "").encode()) for i, t in rows]))


def test_suffix_cases(spark):
    rng = random.Random(1)
    part = "".join(rng.choice("abcdef") for _ in range(150))
    rows = [(2, part), (2, part), (None, part), (1, "x" + part), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffixdedup.remove_repeats(docs, "doc_id", "text", keep_text=True).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in out) == [("1", 150), ("2", 150), ("2", 150), ("7", 0), ("None", 0)]
    assert {r.doc_id: bytes(r.kept) for r in out}[1] == b"x"
    assert suffixdedup.remove_repeats(docs.limit(0), "doc_id", "text").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=6, max_size=6), max_size=12), min_size=1, max_size=7))
def test_loser_tree(runs):
    sorted_runs = []
    for r in runs:
        keys = np.frombuffer(b"".join(sorted(r)), dtype=np.uint8).reshape(-1, 6)
        blob = suffixdedup.encode_run(keys, suffixdedup.common_prefixes(keys), *[np.arange(len(r))] * 4) if r else None
        sorted_runs.append(suffixdedup.decode_run(blob, 6) if blob else ([], [], None))
    run_of, place_of, shared = suffixdedup.merge_runs([(k, s) for k, s, _ in sorted_runs])
    merged = [sorted_runs[a][0][b] for a, b in zip(run_of, place_of, strict=True)]
    assert merged == sorted(x for r in runs for x in r)
    for i in range(1, len(merged)):
        n = next((p for p in range(6) if merged[i][p] != merged[i - 1][p]), 6)
        assert shared[i] == n


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_common_words(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    assert chaining.common_words(a, b) == table[-1][-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=14, unique=True))
def test_best_chain(pairs):
    """The Fenwick tree finds the best score that trying all predecessors finds."""
    pairs.sort()
    score = []
    for j, (x, y) in enumerate(pairs):
        before = [score[i] - chaining.GAP_COST * (x - u + y - v) for i, (u, v) in enumerate(pairs[:j]) if u < x and v < y]
        score.append(1 + max([0, *before]))
    chain = chaining.chains([p[0] for p in pairs], [p[1] for p in pairs], 5)[0]
    got = len(chain) - sum(chaining.GAP_COST * (pairs[b][0] - pairs[a][0] + pairs[b][1] - pairs[a][1]) for a, b in itertools.pairwise(chain))
    assert abs(got - max(score)) < 1e-9
    assert sorted(i for c in chaining.chains([p[0] for p in pairs], [p[1] for p in pairs], 5) for i in c) == list(range(len(pairs)))


def test_passages(spark):
    rng = random.Random(2)
    shared = [[rng.choice(WORDS) for _ in range(60)] for _ in range(6)]
    rows, has = [], {}
    for d in range(150):
        t = [rng.choice(WORDS) for _ in range(rng.randint(5, 80))]
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(6)
            t += edited(rng, shared[i], rng.choice([0, 0, 0, 1, 3])).split() + [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
            has.setdefault(i, set()).add(d)
        rows.append((d, " ".join(t), d))
    rows += [(200, rows[3][1], 0), (201, None, 0), (202, "", 0), (200, rows[3][1], 0), (None, rows[3][1], 0)]
    got = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string, source long").repartition(5), "doc_id", "text").collect()
    linked = {x for r in got for x in (r.key, r.source)}
    with_any = set().union(*has.values())
    assert len(with_any - linked) <= 0.03 * len(with_any)
    assert {d for d in linked if d is not None and d < 150} <= with_any | {3}
    assert sum(r.key == 200 or r.source is None for r in got) >= 2
    texts = {d: t.split() for d, t, _ in rows[:150]}
    for r in got:
        if r.key in texts and r.source in texts:
            a, b = texts[r.key][r.start:r.end], texts[r.source][r.source_start:r.source_end]
            assert len(a) == r.end - r.start >= 50 and chaining.common_words(a, b) >= r.n_common >= 0.8 * max(len(a), len(b))
    assert chaining.passages(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0


def test_thinned():
    """Runs of matches keep one in k and the last, and the weights add up to all matches."""
    at, source = np.array([3, 1, 2, 0, 4, 5, 6, 9, 2]), np.array([13, 11, 12, 10, 14, 15, 16, 40, 30])
    assert chaining.thinned(at, source, 5) == ([0, 2, 5, 6, 9], [10, 30, 15, 16, 40], [1.0, 1.0, 5.0, 1.0, 1.0])


@pytest.mark.parametrize("identity,least", [(0.8, 0.95), (0.85, 0.97), (0.9, 0.97), (0.95, 0.97), (1.0, 1.0)])
def test_recall_of_passages(spark, identity, least):
    """Every planted passage by its place in both documents, with substituted words spread over 60."""
    rng = random.Random(7)
    rows, want = [], []
    for i in range(150):
        base = [rng.choice(WORDS) for _ in range(60)]
        copy = list(base)
        for x in rng.sample(range(60), round(60 * (1 - identity))):
            copy[x] = "edit" + copy[x]
        head = [[f"h{i}x{j}x{x}" for x in range(rng.randint(5, 60))] for j in range(2)]
        rows += [(2 * i + j, " ".join([*head[j], *w, *(f"t{i}x{j}x{x}" for x in range(30))])) for j, w in enumerate((base, copy))]
        want.append((2 * i, len(head[0]), 2 * i + 1, len(head[1])))
    found = {}
    for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect():
        found.setdefault((r.source, r.key), []).append(r)

    def covered(a, a0, b, b0):
        return any(min(r.source_end, a0 + 60) - max(r.source_start, a0) >= 45 and min(r.end, b0 + 60) - max(r.start, b0) >= 45 for r in found.get((a, b), []))

    share = sum(covered(*w) for w in want) / len(want)
    assert share >= least


def window_pairs(rows, n):
    """Places of runs of n words that an earlier document has, with those documents."""
    texts, seen, out = {d: t.split() for d, t in rows}, {}, []
    for d in sorted(texts):
        mine = [(i, tuple(texts[d][i:i + n])) for i in range(len(texts[d]) - n + 1)]
        out += [(d, i, set(seen[w])) for i, w in mine if w in seen]
        for _, w in mine:
            seen.setdefault(w, set()).add(d)
    return out


def test_passages_whose_parts_are_elsewhere(spark):
    """Every run of 50 words that an earlier document has, against brute force."""
    rng = random.Random(8)
    line = lambda n: [rng.choice(WORDS) for _ in range(n)]
    a, b = line(30), line(30)
    rows = [(2, [*line(9), *a, *b, *line(9)]), (1, [*line(4), *a, *line(20)]), (0, [*b, *line(20)]), (3, [*line(20), *a, *line(5)]), (4, [*line(7), *b, *line(30)]),
            (5, [*line(12), *a, *b, *line(40)])]
    lines = [line(25) for _ in range(5)]
    rows += [(d, [w for _ in range(rng.randint(1, 4)) for w in (*rng.choice(lines), *(line(20) if rng.random() < 0.2 else []))]) for d in range(6, 120)]
    rows = [(d, " ".join(t)) for d, t in rows]
    got = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert any((r.key, r.source) == (5, 2) and r.end - r.start >= 60 for r in got)
    want = window_pairs(rows, 50)
    assert len(want) > 300
    missed = [(d, i) for d, i, of in want if not any(r.key == d and r.start <= i and i + 50 <= r.end and r.source in of for r in got)]
    assert missed == []


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, "op4", queries.op4_heavy_light_join, queries.OP4_SQL)["status"] == "match"


@pytest.mark.parametrize("identity", [0.8, 0.9])
def test_recall_at_the_least_length_and_with_parts_elsewhere(spark, identity):
    """Passages of 50 words with edits between their first and last word; and of 60 words, edited on both sides, whose
    thirds stand unedited in six more documents."""
    rng = random.Random(11)
    rows, want = [], {50: [], 60: []}

    def document(words, n=30):
        head = [f"h{len(rows)}x{x}" for x in range(rng.randint(5, 60))]
        rows.append((len(rows), " ".join([*head, *words, *(f"t{len(rows)}x{x}" for x in range(n))])))
        return len(rows) - 1, len(head)

    def changed(words, share):
        words = list(words)
        for x in rng.sample(range(1, len(words) - 1), round(len(words) * share)):
            words[x] = f"edit{rng.randrange(10 ** 6)}"
        return words

    for _ in range(100):
        base = [rng.choice(WORDS) for _ in range(50)]
        want[50].append((*document(base), *document(changed(base, 1 - identity))))
        base = [rng.choice(WORDS) for _ in range(60)]
        want[60].append((*document(changed(base, (1 - identity) / 2)), *document(changed(base, (1 - identity) / 2))))
        for i in range(6):
            document(base[i % 3 * 20:i % 3 * 20 + 20], 10)
    found = {}
    for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect():
        found.setdefault((r.source, r.key), []).append(r)
    for n, pairs in want.items():
        hit = [any(min(r.source_end, a0 + n) - max(r.source_start, a0) >= 0.75 * n and min(r.end, b0 + n) - max(r.start, b0) >= 0.75 * n for r in found.get((a, b), []))
               for a, a0, b, b0 in pairs]
        assert sum(hit) >= 0.95 * len(hit)


def test_a_step_hashes_only_the_documents_it_needs(monkeypatch):
    read, hashes = [], chaining.word_hashes
    monkeypatch.setattr(chaining, "word_hashes", lambda data, *rest: (read.append(len(data)), hashes(data, *rest))[1])
    left = pa.table({"key": pa.array([2, 1, 3], pa.int64()), "text": pa.array(["a b c", "u v w x y z", None])})
    copies = pa.table({"key": pa.array([1], pa.int64()), "source": pa.array([2], pa.int64())})
    assert [tuple(r.values()) for r in chaining._whole(left, copies).to_pylist()] == [(1, 0, 6, 2, 0, 6, 6)]
    types = {"key": pa.int64(), "source": pa.int64(), "from": pa.int64(), "words": pa.binary(), "ats": pa.list_(pa.int32()), "source_ats": pa.list_(pa.int32())}
    assert chaining._passages(5, 50, 0.8)(left, pa.table({c: pa.array([], t) for c, t in types.items()})).num_rows == 0
    assert sum(read) == len("u v w x y z")
    keys, words, starts = chaining._block(left, 0)
    assert keys.tolist() == [1, 2, 3] and np.diff(starts).tolist() == [6, 3, 0] and len(words) == 9
    assert [x.tolist() for x in chaining._runs(starts, 3)] == [[0, 1, 2, 3, 6], [0, 0, 0, 0, 1]]  # none across documents
