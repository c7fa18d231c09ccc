"""Toxicity scores by a factorization machine over hashed terms.

Terms are runs of letters, lower-cased, and their first STEM bytes if they are longer, hashed to `2 ** bits` buckets. The machine keeps the buckets that are
associated with the label, either over all fitted texts or among the texts that already hold a strongly associated
term (so a group name that is harmless alone still gets its interactions), and learns a weight for each and a vector
of `factors` numbers whose inner products are the pairwise weights. A repeated term adds a second bucket, which interacts
with the first like any other pair.

Fitting reads at most `fit_rows` labelled texts of each class in expectation, chosen by a hash of the id and weighted
back to the true class sizes; the label sample is the only thing sent to all tasks and is bounded by that parameter.
Labels, language, source and id are never inputs of a score.

Defined cases: null and empty texts are scored by the bias alone; without labels every score is 0; with labels of one
class every score is that class; conflicting labels of one id count as toxic; rows without a label are not fitted.
Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import hash_share, small_batches, stored
from lotwise.llm.words import M1, M2, letter_tables, mix, slices, text_bytes, word_hashes

STRONG, ASSOCIATED, LEAST_TEXTS = 6.0, 3.5, 4  # standard errors, and texts that must have a bucket
REPEATED = 0x5851F42D
STEM = 4


def terms(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of every text: row and bucket, rows in order."""
    rows, buckets = [], []
    low_bits = np.int64((1 << bits) - 1)
    data, offsets = text_bytes(pc.utf8_lower(column.fill_null("") if column.null_count else column))
    for low, high in slices(offsets):
        begin, end = offsets[low], offsets[high]
        part = data[begin:end]
        hashed, starts, ends, cuts = word_hashes(part, offsets[low:high + 1] - begin, letter_tables())
        owner = np.repeat(np.arange(low, high), np.diff(cuts))
        long = ends - starts > STEM
        stem = np.full(long.sum(), M2, dtype=np.uint64)
        for i in range(STEM):
            stem = stem * M1 + part[starts[long] + i]
        key = np.append(owner, owner[long]) << bits
        key |= (np.append(hashed, mix(stem)) >> np.uint64(64 - bits)).astype(np.int64)
        key, n = np.unique(key, return_counts=True)
        twice = key[n > 1]
        key = np.unique(np.append(key, (twice & ~low_bits) | ((twice * REPEATED + 1) & low_bits)))
        rows.append(key >> bits)
        buckets.append(key & low_bits)
    if not rows:
        return (np.zeros(0, dtype=np.int64),) * 2
    return np.concatenate(rows), np.concatenate(buckets)


@dataclass
class Machine:
    """bias, weights and vectors of the kept buckets; `places` maps a bucket to its place or -1."""

    bits: int
    places: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margins(self, row: np.ndarray, bucket: np.ndarray, rows: int) -> np.ndarray:
        place = self.places[bucket]
        used = place >= 0
        row, place = row[used], place[used]
        out = self.bias + np.bincount(row, self.weights[place], rows)
        for f in range(self.vectors.shape[1]):
            part = self.vectors[place, f]
            out += 0.5 * (np.bincount(row, part, rows) ** 2 - np.bincount(row, part ** 2, rows))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(*terms(column, self.bits), len(column)), -30, 30)))


def association(hit: np.ndarray, pos: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Difference of a bucket's text shares in the two classes, in standard errors; 0 for rare buckets."""
    n1, n0 = max(1, n1), max(1, n0)
    p = (hit + 1) / (n1 + n0 + 2)
    z = (pos / n1 - (hit - pos) / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    return np.where(hit >= LEAST_TEXTS, z, 0)


def choose(z: np.ndarray, among_marked: np.ndarray, max_terms: int = 4096) -> np.ndarray:
    """Buckets associated with the label over all texts or among those with a strong bucket, strongest first."""
    size = np.maximum(np.abs(z), np.abs(among_marked))
    kept = np.argsort(-size, kind="stable")[:max_terms]
    return kept[size[kept] > ASSOCIATED]


def train(
    row: np.ndarray, place: np.ndarray, y: np.ndarray, weight: np.ndarray, kept: np.ndarray, bits: int, factors: int = 8,
    epochs: int = 120, rate: float = 0.2, decay: float = 1e-6, seed: int = 11,
) -> Machine:
    """Fits by mini-batch steps with per-parameter step sizes; `place` is a bucket's place among the kept ones."""
    base = float(np.average(y, weights=weight)) if len(y) else 0.0
    bias = float(np.log(max(base, 1e-13) / max(1 - base, 1e-13)))
    places = np.full(1 << bits, -1, dtype=np.int32)
    places[kept] = np.arange(len(kept))
    k = len(kept)
    rng = np.random.default_rng(seed)
    machine = Machine(bits, places, bias, np.zeros(k), rng.normal(0, 0.05, (k, factors)))
    if not k:
        return machine
    cuts = np.searchsorted(row, np.arange(len(y) + 1))
    square_w, square_v, square_b = np.full(k, 1e-6), np.full((k, factors), 1e-6), 1e-6
    weight = weight / weight.mean()
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for chunk in np.array_split(order, max(1, len(y) // 256)):
            lengths = cuts[chunk + 1] - cuts[chunk]
            at = np.repeat(cuts[chunk] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            r, p = np.repeat(np.arange(len(chunk)), lengths), place[at]
            vx = machine.vectors[p]
            sums = np.stack([np.bincount(r, vx[:, f], len(chunk)) for f in range(factors)], axis=1)
            squares = np.bincount(r, (vx ** 2).sum(axis=1), len(chunk))
            margin = machine.bias + np.bincount(r, machine.weights[p], len(chunk)) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[chunk]) * weight[chunk] / len(chunk)
            grad_w = np.bincount(p, error[r], k) + decay * machine.weights * (np.bincount(p, minlength=k) > 0)
            pull = error[r][:, None] * (sums[r] - vx)
            grad_v = np.stack([np.bincount(p, pull[:, f], k) for f in range(factors)], axis=1)
            grad_v += decay * machine.vectors * (np.bincount(p, minlength=k) > 0)[:, None]
            square_w += grad_w ** 2
            square_v += grad_v ** 2
            square_b += error.sum() ** 2
            machine.weights -= rate * grad_w / np.sqrt(square_w)
            machine.vectors -= rate * grad_v / np.sqrt(square_v)
            machine.bias -= rate * error.sum() / np.sqrt(square_b)
    return machine


def fit(
    docs: DataFrame, text: str, key: str, labels: DataFrame, label_key: str, label: str, train_rows: Column,
    fit_rows: int = 10_000, bits: int = 18, factors: int = 8,
) -> Machine:
    """Fits on the labels for whose key (named `key` in the condition `train_rows`) that condition holds."""
    spark = docs.sparkSession
    small_batches(spark)
    given = labels.select(F.col(label_key).alias("key"), F.col(label).cast("int").alias("y")).where(
        "key is not null and y is not null").where(train_rows).groupBy("key").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in given.groupBy("y").count().collect()}
    if not sizes:
        return Machine(bits, np.full(1 << bits, -1, dtype=np.int32), -30.0, np.zeros(0), np.zeros((0, factors)))
    shares = {y: min(1.0, fit_rows / n) for y, n in sizes.items()}
    share = F.create_map(*[v for y, s in shares.items() for v in (F.lit(y), F.lit(s))])[F.col("y")]
    sample = given.where(hash_share(F.col("key"), share))  # at most about fit_rows rows of each class
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key").select("y", "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket = terms(batch.column(1), bits)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            packed = bucket.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                names=["y", "bag"])

    held = stored(rows.mapInArrow(bags, "y int, bag binary"))
    n = {r["y"]: r["count"] for r in held.groupBy("y").count().collect()}
    size = 1 << bits
    hit, pos = _count(held, None, size)
    z = association(hit, pos, n.get(1, 0), n.get(0, 0))
    strong = np.flatnonzero(z > STRONG)
    near_hit, near_pos = _count(held, strong, size)
    # Every text with a strong bucket has that bucket, so the marked texts are counted along, in the last place.
    among = association(near_hit[:-1], near_pos[:-1], near_pos[-1], near_hit[-1] - near_pos[-1])
    kept = choose(z, among) if n.get(1, 0) and n.get(0, 0) else np.zeros(0, dtype=np.int64)
    taken = held.mapInArrow(_places(kept, size), "y int, bag binary").toPandas().sort_values(["y", "bag"])  # few terms of a bounded sample
    y = taken["y"].to_numpy().astype(float)
    bag = [np.frombuffer(b, dtype=np.int32) for b in taken["bag"]]
    row = np.repeat(np.arange(len(bag)), [len(b) for b in bag])
    place = np.concatenate(bag) if bag else np.zeros(0, dtype=np.int32)
    return train(row, place, y, np.array([1 / shares[int(v)] for v in y]), kept, bits, factors)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and row and bucket of every term."""
    bag = [np.frombuffer(b, dtype=np.int32) for b in batch.column(1).to_pylist()]
    row = np.repeat(np.arange(len(bag)), [len(b) for b in bag])
    return batch.column(0).to_numpy(), row, np.concatenate(bag) if bag else np.zeros(0, dtype=np.int32)


def _count(held: DataFrame, strong: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and positive texts of every bucket, and in one more place of all texts; with `strong`, only of texts that
    have one of those buckets. At most `size` + 1 rows come back."""
    mark = np.ones(size, dtype=bool) if strong is None else np.isin(np.arange(size), strong)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit, pos = np.zeros(size + 1), np.zeros(size + 1)
        for batch in batches:
            y, row, bucket = _unpacked(batch)
            marked = np.zeros(len(y), dtype=bool)
            marked[row[mark[bucket]]] = True
            inside = marked[row]
            hit[:size] += np.bincount(bucket[inside], minlength=size)
            pos[:size] += np.bincount(bucket[inside], y[row[inside]], size)
            hit[size] += marked.sum()
            pos[size] += y[marked].sum()
        at = np.flatnonzero(hit)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(hit[at]), pa.array(pos[at])], names=["bucket", "hit", "pos"])

    sums = held.mapInArrow(run, "bucket long, hit double, pos double").groupBy("bucket").agg(F.sum("hit").alias("hit"), F.sum("pos").alias("pos")).toPandas()
    out = np.zeros((2, size + 1))
    out[0, sums["bucket"].to_numpy(dtype=int)] = sums["hit"]
    out[1, sums["bucket"].to_numpy(dtype=int)] = sums["pos"]
    return (out[0, :-1], out[1, :-1]) if strong is None else (out[0], out[1])


def _places(kept: np.ndarray, size: int):
    places = np.full(size, -1, dtype=np.int32)
    places[kept] = np.arange(len(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = (places[np.frombuffer(b, dtype=np.int32)] for b in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b[b >= 0].tobytes() for b in bags], pa.binary())], names=["y", "bag"])

    return run


def score(docs: DataFrame, text: str, machine: Machine, keep: list[str], out: str = "score") -> DataFrame:
    """The columns `keep` of docs and the score of every text as column `out`."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(machine)
    inner = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inner, strict=True)], F.col(text).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(batch.column(len(inner)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(inner))], pa.array(scores)], names=[*inner, "score"])

    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in inner), "score double"])
    result = rows.mapInArrow(judge, schema)
    return result.select(*[F.col(n).alias(c) for c, n in zip(keep, inner, strict=True)], F.col("score").alias(out))
