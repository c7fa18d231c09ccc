"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: a slot holds one bit per language, so two lookups return every
language that may contain an n-gram. A text's n-grams are popcounted per language, the counts are corrected for the
filter's false positives, and the largest corrected count decides.

Fitting reads at most `fit_texts` texts of each language in expectation (chosen by a hash of the id); an n-gram
belongs to a language if `min_texts` of its texts have it and its share there is at least `keep_share` of its largest
share in any language. The filter has `2 ** slot_bits` slots whatever the input size, which bounds what is collected
and sent to the tasks. At most 62 languages a word of the mask; more words are added as needed.

Defined cases: a text that is null or has no letter gives `und` with score 0; a text none of whose n-grams is known
gives the most frequent language with score 0; ties go to the more frequent language, then to the smaller name; an
empty training set gives `und` everywhere. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import hash_share, pieces, small_batches, texts_of
from lotwise.llm.words import M1, M2, M3, mix

SIZES = (1, 2, 3, 4)
WORD_LANGS = 62
PIECE = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of lower-cased words with one blank on each side, and each one's text."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) for t in lowered), dtype=np.int64, count=len(lowered))
    code = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    owner = np.append(owner, len(texts) - 1)
    code = np.where(_letters()[code], code, np.uint32(0))
    kept = np.ones(len(code), dtype=bool)
    kept[1:] = (code[1:] != 0) | (code[:-1] != 0)
    code, owner = code[kept].astype(np.uint64), owner[kept]
    hashes, owners = [], []
    for size in SIZES:
        count = len(code) - size + 1
        if count <= 0:
            continue
        h = np.full(count, np.uint64(size), dtype=np.uint64)
        inner = code[:count] != 0 if size == 1 else np.ones(count, dtype=bool)
        for i in range(size):
            part = code[i:i + count]
            h = h * M1 + part
            if 0 < i < size - 1:
                inner &= part != 0
        if size == 2:
            inner &= (code[:count] != 0) | (code[1:1 + count] != 0)
        # An n-gram belongs to the text of its second character: the first may be the blank that ends the text before.
        hashes.append(mix(h[inner] * M2 + M3))
        owners.append(owner[min(1, size - 1):min(1, size - 1) + count][inner])
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


class Filter:
    """The fitted filter: slots x mask words, with the languages in order of falling frequency."""

    def __init__(self, langs: list[str], slot_bits: int, masks: np.ndarray):
        self.langs, self.slot_bits, self.masks = langs, slot_bits, masks
        bits = [(masks[:, i // WORD_LANGS] >> np.uint64(i % WORD_LANGS)) & np.uint64(1) for i in range(len(langs))]
        fill = np.array([b.sum() for b in bits], dtype=float) / masks.shape[0]
        self.false_positive = np.minimum(fill ** 2, 0.999)
        self.narrow = masks[:, 0].astype(np.uint8) if len(langs) <= 8 else None

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Popcounts (texts x languages) and number of n-grams."""
        found = np.zeros((len(texts), len(self.langs)))
        total = np.zeros(len(texts))
        low = np.uint64((1 << self.slot_bits) - 1)
        for rows, parts in pieces(texts, PIECE, SIZES[-1] - 1):
            h, owner = grams(parts)
            if not len(h):
                continue
            row = np.asarray(rows)
            total += np.bincount(row, np.bincount(owner, minlength=len(parts)), len(texts))
            first, second = h & low, (h >> np.uint64(32)) & low
            for word in range(self.masks.shape[1]):
                slots = self.narrow if self.narrow is not None else self.masks[:, word]
                got = slots[first] & slots[second]
                for i in range(word * WORD_LANGS, min(len(self.langs), (word + 1) * WORD_LANGS)):
                    bit = (got >> got.dtype.type(i % WORD_LANGS)) & got.dtype.type(1)
                    found[:, i] += np.bincount(row, np.bincount(owner, bit, len(parts)), len(texts))
        return found, total

    def decide(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        full = [t or "" for t in texts]
        found, total = self.counts(full)
        names, scores = [], []
        if not self.langs:
            return ["und"] * len(full), [0.0] * len(full)
        corrected = np.maximum(0, (found - total[:, None] * self.false_positive) / (1 - self.false_positive))
        best = corrected.argmax(axis=1)
        whole = corrected.sum(axis=1)
        for row, text in enumerate(full):
            if not total[row] or not any(map(str.isalpha, text)):
                names.append("und")
                scores.append(0.0)
            else:
                names.append(self.langs[best[row]])
                scores.append(float(corrected[row, best[row]] / whole[row]) if whole[row] > 0 else 0.0)
        return names, scores


def fit(
    docs: DataFrame, text: str, lang: str, key: str, train: Column, fit_texts: int = 5000, slot_bits: int = 20,
    min_texts: int = 2, keep_share: float = 0.25,
) -> Filter:
    """Fits on the rows where `train` holds and text and language are there; `key` only picks the bounded sample."""
    small_batches(docs.sparkSession)
    rows = docs.where(train).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes, key=lambda k: (-sizes[k], k))
    words = max(1, -(-len(langs) // WORD_LANGS))
    masks = np.zeros((1 << slot_bits, words), dtype=np.uint64)
    if not langs:
        return Filter(langs, slot_bits, masks)
    place = {k: i for i, k in enumerate(langs)}
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, fit_texts / sizes[k])))])[F.col("lang")]
    sample = rows.where(hash_share(F.col("key"), share)).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array([place[k] for k in texts_of(batch, "lang")], dtype=np.int64)
            for group, parts in pieces(texts_of(batch), PIECE, SIZES[-1] - 1):
                h, owner = grams(parts)
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                h, label = h[new], labels[np.asarray(group)[owner[new]]]
                order = np.lexsort((label, h))
                h, label = h[order], label[order]
                start = np.ones(len(h), dtype=bool)
                start[1:] = (h[1:] != h[:-1]) | (label[1:] != label[:-1])
                at = np.flatnonzero(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(label[at].astype(np.int32)), pa.array(np.diff(np.append(at, len(h))))],
                    names=["gram", "place", "n"])

    seen = sample.groupBy("lang").count().collect()
    read = {r["lang"]: r["count"] for r in seen}
    counts = sample.mapInArrow(count, "gram long, place int, n long").groupBy("gram", "place").agg(F.sum("n").alias("n"))
    rate = F.col("n") / F.create_map(*[x for k in langs for x in (F.lit(place[k]), F.lit(float(read.get(k, 1))))])[F.col("place")]
    rates = counts.where(F.col("n") >= min_texts).withColumn("rate", rate)
    top = rates.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("place", "rate")).alias("each"))
    kept = top.select("gram", F.explode(F.filter("each", lambda e: e["rate"] >= F.col("top") * keep_share)).alias("e"))
    scale = (1 << slot_bits) - 1
    slots = kept.select(
        F.explode(F.array(F.col("gram").bitwiseAND(F.lit(scale)), F.shiftright("gram", 32).bitwiseAND(F.lit(scale)))).alias("slot"),
        (F.col("e.place") / WORD_LANGS).cast("int").alias("word"), (F.col("e.place") % WORD_LANGS).alias("bit"))
    table = slots.groupBy("slot", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toPandas()
    masks[table["slot"].to_numpy(), table["word"].to_numpy()] = table["mask"].to_numpy().astype(np.uint64)
    return Filter(langs, slot_bits, masks)


def identify(docs: DataFrame, text: str, model: Filter, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs with lang_pred and score of every text; `keep` must not hold those two names."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    inner = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner, strict=True)], F.col(text).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.decide(texts_of(batch))
            columns = [batch.column(i) for i in range(len(inner))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*inner, "lang_pred", "score"])

    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in inner), "lang_pred string, score double"])
    out = rows.mapInArrow(judge, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, inner, strict=True)], "lang_pred", "score")
