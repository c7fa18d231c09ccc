"""Packing as an exact round trip, and the pipeline's stages against what their operators must decide."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import packing, queries, stages
from lotwise.llm.common import tokenizer_path

CHARS = ["a", "b", "'s", " ", "  ", "\n", "\t", "é", "1", "23", ".", "<|endoftext|>", "　", "\x1c", "the", " the", "😀"]
tokenizer = Tokenizer.from_file(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CHARS), max_size=25))
def test_ids(parts):
    text = "".join(parts)
    assert packing.Coder.load(tokenizer_path(), 1).ids(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_cache_bound(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 3)
    coder = packing.Coder(tokenizer_path(), 1)
    for text in ["one two three four five", "one two " + "x" * 100, "five four"]:
        assert coder.ids(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def check_pieces(rows, docs, window=2048):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    pad = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
        pad += 0 if at & (at - 1) == 0 else window - at
    return pad, sum(len(s) for s in sequences.values())


def test_round_trip(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "delta.\n"]) for _ in range(rng.randint(0, 900)))) for i in range(90)]
    docs += [(100, None), (101, ""), (102, "long " * 60_000), (103, docs[4][1])]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, length int").repartition(4)
    rows = packing.pack(frame, "doc_id", "text", tokenizer_path(), shard_tokens=5_000).collect()
    assert check_pieces(rows, docs)[0] == 0
    assert packing.pack(frame.limit(0), "doc_id", "text", tokenizer_path()).count() == 0


def test_repeated_ids(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = packing.pack(frame, "doc_id", "text", tokenizer_path()).collect()
    assert sum(r.length for r in rows) == 3 + 3 + 2 and {r.doc_id for r in rows} == {1, None}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert check_pieces(queries.op10_retrieval_packing(spark, sf).collect(), docs)[0] == 0


def test_neighbours_share_windows():
    """BM25 by hand: the seed's best unused neighbour follows it."""
    rng = np.random.default_rng(1)
    topics = [rng.integers(100 * t, 100 * t + 60, 300) for t in range(3)]
    rests = [rng.choice(topics[i % 3], 200).astype(np.uint16) for i in range(30)]
    idf = np.ones(400)
    index = packing.Shard(rests, idf, 200.0, 8)
    order = packing.fill_order(index, np.array([len(r) for r in rests]), 1000)
    assert sorted(order) == list(range(30)) and [i % 3 for i in order[:5]] == [0] * 5
    unused = np.ones(30, dtype=bool)
    unused[0] = False
    got = index.neighbours(0, unused)
    part = slice(index.cuts[0], index.cuts[1])
    terms = index.term[part][np.argpartition(-index.weight[part], 8)[:8]]

    def score(i):
        tf = np.array([(rests[i] == t).sum() for t in terms])
        return (idf[terms] * tf * (packing.K1 + 1) / (tf + packing.K1)).sum()

    want = sorted((i for i in range(1, 30) if score(i) > 0), key=lambda i: (-round(score(i), 9), i))
    assert [round(score(i), 9) for i in got] == [round(score(i), 9) for i in want]


def test_boundaries():
    assert packing._boundaries(5000, 2048).tolist() == [2048, 4096, 4608, 4864, 4992, 5000]
    assert packing._boundaries(0, 2048).tolist() == []


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Planted cases: copies, near copies, a benchmark passage, personal data, nulls and repeated rows."""
    rng = random.Random(4)
    words = [f"word{i}" for i in range(2000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(60)) for i in range(60)]
    item = text(30)
    rows += [(100, rows[0][1]), (101, rows[1][1].replace(rows[1][1].split()[5], "other", 1)), (102, f"{text(50)} {item} {text(50)}"), (103, "mail a@b.c " + text(20)),
             (104, None), (105, ""), (None, text(30)), (106, text(25) + " scum idiot"), (7, rows[7][1])]
    labels = [(i, 0) for i in range(60)]
    toxic = [(1000 + i, text(20) + " scum idiot " + text(5)) for i in range(40)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows + toxic], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels + [(i, 1) for i, _ in toxic], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    ids = lambda df: sorted((-1 if r.doc_id is None else r.doc_id for r in df.collect()))
    kept = stages.drop_toxic(spark, docs, corpus).cache()
    assert ids(kept) == sorted([-1, *range(60), *range(100, 106), 7])
    assert kept.columns == docs.columns
    single = stages.drop_near_duplicates(spark, kept, corpus).cache()
    assert ids(single) == sorted([-1, *range(60), 102, 103, 104, 105])
    clean = stages.drop_benchmark_leaks(spark, single, corpus).cache()
    assert ids(clean) == sorted([-1, *range(60), 103, 104, 105])
    safe = {r.doc_id: r for r in stages.redact_personal_data(spark, clean, corpus).collect()}
    assert safe[103].text.startswith("mail [EMAIL] ") and safe[103].n_chars == len(safe[103].text)
    assert {i: r.text for i, r in safe.items() if i != 103} == {r.doc_id: r.text for r in clean.collect() if r.doc_id != 103}
    for frame in (kept, single, clean):
        frame.unpersist()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, corpus).limit(0)
    assert empty.count() == 0


def test_run(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert {r.doc_id for r in rows} == {None, *range(60), 103, 104, 105}
    assert len(corpus_pipeline.STAGES) == 5


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
