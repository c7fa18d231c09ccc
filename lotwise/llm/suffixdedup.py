"""Exact removal of repeated byte strings with a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a `length`-byte string that covers it also starts earlier. Every such string holds an anchor: a position
whose `seed`-byte string has the smallest hash among the seeds of the string. Equal strings have equal anchors at equal
offsets, so only suffixes at anchors are sorted, about one in (length - seed) / 2 bytes, and of those only the ones
whose seed occurs again (the duplicate detection that shortens what such sorts exchange). A sort key is the suffix from
the anchor on, followed by the reversed text before it, each as far as a string around the anchor can reach.

Each task sorts its keys, keeps one entry of equal keys, front-codes the run (only what differs from the entry before)
and cuts it at sampled splitters; a range merges its runs with a loser tree that compares two heads only beyond the
prefix both are known to share with the last output. In the merged order, keys that agree in `length - x` bytes after and
x bytes before the anchor are equal strings; all but the first of them cover bytes that go.

Whole copies of a text are found first and never enter the sort, and equal keys collapse in every run, so a large group
of copies costs at most an entry a task. The texts are dealt by id once; the three steps that need them reuse that
exchange.

Defined cases: null text is empty; texts shorter than `length` lose nothing; rows that repeat an id or have none are
documents of their own, in order of id (null first), then of the text's digest. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import hash_share, numbered, partitions, small_batches, stored
from lotwise.llm.words import M2, byte_values, mix, powers, slices, text_bytes

LENGTH, SEED = 100, 32
SAMPLED_TEXTS, SAMPLED_HEADS = 1000, 64
PIECE = 2 << 20
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(x: np.ndarray, width: int, fill: int, pick: np.ufunc) -> np.ndarray:
    """pick over x[i:i + width] for every i; x is continued with `fill`."""
    blocks = -(-len(x) // width) + 1
    padded = np.full(blocks * width, np.uint64(fill), dtype=np.uint64)
    padded[:len(x)] = x
    table = padded.reshape(blocks, width)
    forward = pick.accumulate(table, axis=1).ravel()
    backward = pick.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(backward[:len(x)], forward[width - 1:width - 1 + len(x)])


def anchors(data: np.ndarray, ends: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and seed hashes of the anchors; `ends` gives for each byte the end of its text."""
    n = len(data)
    if n < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if n > PIECE + length:  # a very long text: the strings that start in each piece
        size = PIECE + length - 1
        found = [(start, *anchors(data[start:start + size], np.minimum(ends[start:start + size] - start, size), length, seed))
                 for start in range(0, n, PIECE)]
        at, first = np.unique(np.concatenate([a + s for s, a, _ in found]), return_index=True)
        return at, np.concatenate([h for _, _, h in found])[first]
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(byte_values()[data] * up[:n], out=sums[1:])
    place = np.arange(n)
    count = n - seed + 1
    h = np.full(n, TOP, dtype=np.uint64)
    h[:count] = mix((sums[seed:] - sums[:count]) * down[:count] + M2)
    h[place + seed > ends] = TOP
    width = length - seed + 1
    least = _sliding(h, width, int(TOP), np.minimum)
    least[place + length > ends] = 0
    # A seed is an anchor if it is the least of some string that holds it: look back over the strings' starts.
    most = _sliding(least[::-1].copy(), width, 0, np.maximum)[::-1]
    at = np.flatnonzero((most == h) & (h != TOP))
    return at, h[at]


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    for low, high in slices(offsets):
        yield low, high, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]


def _anchor_rows(length: int, seed: int):
    """Anchors by seed. Of a seed that repeats in one slice of texts only the first asks for partners elsewhere; all of
    its anchors are known to repeat and travel under hashes of their own, so no seed is a large group."""
    names = ["seed", "key", "at", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for low, high, data, offsets in _texts(batch.column(1)):
                at, h = anchors(data, np.repeat(offsets[1:], np.diff(offsets)), length, seed)
                row = np.searchsorted(offsets, at, side="right") - 1
                order = np.argsort(h, kind="stable")
                same = h[order[1:]] == h[order[:-1]]
                known, later = np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=bool)
                if len(order):
                    known[order[np.append(same, False) | np.append(False, same)]] = True
                later[order[1:][same]] = True
                h = np.where(later, mix(h + at.astype(np.uint64) * M2), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), keys.take(pa.array(row + low)), pa.array(at - offsets[row]), pa.array(known)], names=names)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one partition whose seed is known to repeat or occurs more than once."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    seed = table.column("seed").to_numpy()
    order = np.argsort(seed, kind="stable")
    same = seed[order[1:]] == seed[order[:-1]]
    found = table.column("known").to_numpy().copy()
    found[order[np.append(same, False) | np.append(False, same)]] = True
    yield from table.select(["key", "at"]).filter(pa.array(found)).to_batches()


def sort_keys(data: np.ndarray, at: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key bytes (zero-padded), and how many bytes after and before the anchors there are."""
    back = length - seed
    padded = np.concatenate([np.zeros(back, dtype=np.uint8), data, np.zeros(length, dtype=np.uint8)])
    after = padded[at[:, None] + back + np.arange(length)]
    before = padded[at[:, None] + back - 1 - np.arange(back)]
    return np.concatenate([after, before], axis=1), np.minimum(length, len(data) - at), np.minimum(back, at)


def common_prefixes(keys: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the row before; 0 for the first."""
    differ = keys[1:] != keys[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])
    return np.append(np.zeros(1, dtype=np.int64), shared)[:len(keys)]


def whole_spans(at: np.ndarray, after: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which anchors have a string around them, and the bytes covered if all their strings go."""
    return after + before >= length, at - np.minimum(before, length), at + np.minimum(after, length)


def _first_of_equal(keys: np.ndarray, shared: np.ndarray, after: np.ndarray, before: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mask of the earliest of the entries with equal key and reach."""
    group = np.cumsum(shared < keys.shape[1]) if len(keys) else np.zeros(0, dtype=np.int64)
    order = np.lexsort((at, doc, before, after, group))
    new = np.append(True, (group[order[1:]] != group[order[:-1]]) | (after[order[1:]] != after[order[:-1]]) | (before[order[1:]] != before[order[:-1]]))
    first = np.zeros(len(keys), dtype=bool)
    first[order[new[:len(order)]]] = True
    return first


def encode_run(keys: np.ndarray, shared: np.ndarray, after: np.ndarray, before: np.ndarray, doc: np.ndarray, at: np.ndarray) -> bytes:
    """A front-coded piece of a sorted run."""
    shared = shared.copy()
    shared[0] = 0
    tails = keys[np.arange(keys.shape[1]) >= shared[:, None]].tobytes()
    return b"".join([
        len(keys).to_bytes(8, "little"), shared.astype(np.uint16).tobytes(), after.astype(np.uint16).tobytes(), before.astype(np.uint16).tobytes(),
        doc.astype(np.int64).tobytes(), at.astype(np.int64).tobytes(), tails])


def decode_run(blob: bytes, size: int) -> tuple[list[bytes], list[int], np.ndarray]:
    """Keys, their common prefixes with the key before, and the rows (after, before, doc, at)."""
    n = int.from_bytes(blob[:8], "little")
    small = np.frombuffer(blob, dtype=np.uint16, count=3 * n, offset=8).reshape(3, n).astype(np.int64)
    large = np.frombuffer(blob[8 + 6 * n:8 + 22 * n], dtype=np.int64).reshape(2, n)
    shared, keys, at, last = small[0].tolist(), [], 8 + 22 * n, b""
    for s in shared:
        last = last[:s] + blob[at:at + size - s]
        at += size - s
        keys.append(last)
    return keys, shared, np.concatenate([small[1:], large])


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Loser-tree merge of sorted runs with known common prefixes: run, place and common prefix with the output before.

    Every head carries how many bytes it shares with the last output. Of two heads the one that shares more is smaller;
    only heads that share equally much are compared, from there on.
    """
    count = 1
    while count < len(runs):
        count *= 2
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (count - len(runs))
    shares = [0 if h is not None else -1 for h in heads]
    place = [0] * count

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share becomes what it has in common with the winner."""
        x, y = shares[a], shares[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        u, v = heads[a][x:], heads[b][x:]
        if u == v:
            shares[b] = x + len(u)
            return a, b
        differ = int.from_bytes(u, "big") ^ int.from_bytes(v, "big")
        common = x + (8 * len(u) - differ.bit_length()) // 8
        if u < v:
            shares[b] = common
            return a, b
        shares[a] = common
        return b, a

    losers = [0] * count
    winners = list(range(count))
    level = count
    while level > 1:
        following = []
        for i in range(0, level, 2):
            w, lost = play(winners[i], winners[i + 1])
            losers[level // 2 + i // 2] = lost
            following.append(w)
        winners, level = following, level // 2
    w = winners[0]
    run_of, place_of, common_of = [], [], []
    while shares[w] >= 0:
        run_of.append(w)
        place_of.append(place[w])
        common_of.append(shares[w])
        keys, shared = runs[w]
        place[w] += 1
        if place[w] < len(keys):
            heads[w], shares[w] = keys[place[w]], shared[place[w]]
        else:
            heads[w], shares[w] = None, -1
        node = (count + w) // 2
        while node:
            w, losers[node] = play(w, losers[node])
            node //= 2
    return run_of, place_of, common_of


def covered(
    keys: np.ndarray, shared: np.ndarray, after: np.ndarray, before: np.ndarray, doc: np.ndarray, at: np.ndarray, length: int, seed: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, start, end of what the strings around the anchors cover that start earlier elsewhere; keys are in order."""
    back = length - seed
    first = _first_of_equal(keys, shared, after, before, doc, at)
    whole, low, high = whole_spans(at, after, before, length)
    gone = ~first & whole
    out = [(doc[gone], low[gone], high[gone])]
    # Of the entries that stay, the prefix shared with the one before is the least over the removed ones in between.
    starts = np.flatnonzero(first)
    if len(starts):
        shared = np.minimum.reduceat(shared, np.append(0, starts[:-1] + 1))
    keys, after, before, doc, at = keys[first], after[first], before[first], doc[first], at[first]
    alone = shared < seed
    single = alone & np.append(alone[1:], True)
    number = np.cumsum(alone)
    keep = ~single
    keys, after, before, doc, at, number = keys[keep], after[keep], before[keep], doc[keep], at[keep], number[keep]
    shared = np.where(np.append(True, number[1:] != number[:-1])[:len(keys)], 0, shared[keep])
    n = len(keys)
    if n:
        left = np.ascontiguousarray(keys[:, length:])
        by_left = np.argsort(left.view(f"S{back}").ravel(), kind="stable")
        left_shared = common_prefixes(left[by_left])
        rank = np.lexsort((at, doc))
        lowest, highest = np.full(n, length), np.full(n, -1)
        for x in range(back + 1):
            valid = rank[(before[rank] >= x) & (after[rank] >= length - x)]
            if len(valid) < 2:
                continue
            left_class = np.empty(n, dtype=np.int64)
            left_class[by_left] = np.cumsum(left_shared < x)
            name = np.cumsum(shared < length - x)[valid] * (n + 1) + left_class[valid]
            order = np.argsort(name, kind="stable")
            later = valid[order[1:][name[order[1:]] == name[order[:-1]]]]
            lowest[later] = np.minimum(lowest[later], x)
            highest[later] = x
        hit = highest >= 0
        out.append((doc[hit], at[hit] - highest[hit], at[hit] + length - lowest[hit]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _runs(length: int, seed: int, splitters: list[bytes]):
    names = ["part", "run", "spans"]
    size = 2 * length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            docs = batch.column(0).to_pylist()
            for i, places in enumerate(batch.column(2)):
                at = places.values.to_numpy()
                keys, after, before = sort_keys(data[offsets[i]:offsets[i + 1]], at, length, seed)
                parts.append((keys, after, before, np.full(len(at), docs[i], dtype=np.int64), at))
        if not parts:
            return
        keys, after, before, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys.view(f"S{size}").ravel(), kind="stable")
        keys, after, before, doc, at = keys[order], after[order], before[order], doc[order], at[order]
        first = _first_of_equal(keys, common_prefixes(keys), after, before, doc, at)
        whole, low, high = whole_spans(at, after, before, length)
        gone = ~first & whole
        spans = np.stack([doc[gone], low[gone], high[gone]])
        keys, after, before, doc, at = keys[first], after[first], before[first], doc[first], at[first]
        shared = common_prefixes(keys)
        heads = keys[:, :seed].copy().view(f"S{seed}").ravel()
        cuts = [0, *np.searchsorted(heads, np.array(splitters, dtype=f"S{seed}")), len(keys)] if splitters else [0, len(keys)]
        for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b or part == 0:
                blob = encode_run(keys[a:b], shared[a:b], after[a:b], before[a:b], doc[a:b], at[a:b]) if a < b else None
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([blob], pa.binary()), pa.array([spans.tobytes() if part == 0 else None], pa.binary())], names=names)

    return run


def _merge(length: int, seed: int):
    size = 2 * length - seed

    def run(table: pa.Table) -> pa.Table:
        out = [np.frombuffer(s, dtype=np.int64).reshape(3, -1) for s in table.column("spans").to_pylist() if s]
        blobs = sorted(b for b in table.column("run").to_pylist() if b)
        runs = [decode_run(b, size) for b in blobs]
        if runs:
            run_of, place_of, common = merge_runs([(keys, shared) for keys, shared, _ in runs])
            begins = np.cumsum([0] + [len(r[0]) for r in runs])
            order = begins[np.array(run_of)] + np.array(place_of)
            keys = np.frombuffer(b"".join(b"".join(r[0]) for r in runs), dtype=np.uint8).reshape(-1, size)[order]
            after, before, doc, at = np.concatenate([r[2] for r in runs], axis=1)[:, order]
            out.append(np.stack(covered(keys, np.array(common), after, before, doc, at, length, seed)))
        doc, low, high = np.concatenate(out, axis=1) if out else np.zeros((3, 0), dtype=np.int64)
        return pa.table({"key": pa.array(doc), "low": pa.array(low), "high": pa.array(high)})

    return run


def merge_spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union; touching spans are one."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.append(True, low[1:] > reach[:-1])[:len(low)]
    return low[new], reach[np.append(new[1:], True)[:len(low)]]


def _apply(length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            removed, count, digest, texts = [], [], [], []
            spans, copy = batch.column(2), batch.column(3).to_pylist()
            for i in range(batch.num_rows):
                raw = data[offsets[i]:offsets[i + 1]]
                if copy[i] and len(raw) >= length:
                    low, high = np.zeros(1, dtype=np.int64), np.array([len(raw)])
                elif spans[i].is_valid:
                    pair = spans[i].values
                    low, high = merge_spans(pair.field("low").to_numpy(), pair.field("high").to_numpy())
                else:
                    low = high = np.zeros(0, dtype=np.int64)
                kept = b"".join(raw[a:b].tobytes() for a, b in zip(np.append(0, high), np.append(low, len(raw)), strict=True))
                removed.append(int((high - low).sum()))
                count.append(len(low))
                digest.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
            columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string())]
            names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.binary())] * keep_text, names=names + ["kept"] * keep_text)

    return run


def remove_repeats(
    docs: DataFrame, key: str, text: str, length: int = LENGTH, seed: int = SEED, keep_text: bool = False,
) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every row, and the remaining bytes as `kept` if asked for."""
    spark = docs.sparkSession
    small_batches(spark)
    rows, own = numbered(docs, key, text)
    texts_there = rows.count()
    # The condition always holds; stated here, it is the same above every use of the exchange, which is then made once.
    rows = rows.where("key is not null")
    count = partitions(spark)
    texts = rows.repartition(count, "key")  # the one exchange of whole texts
    digests = rows.select("key", F.md5("text").alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copies = stored(digests.join(firsts, "digest").where(F.col("key") != F.col("first")).select("key"))
    parts = max(1, count)
    sample = rows.where(hash_share(F.col("key"), min(1.0, SAMPLED_TEXTS / max(1, texts_there)))).mapInArrow(_sample(length, seed), "head binary")
    heads = sorted({bytes(r[0]) for r in sample.collect()})  # from about SAMPLED_TEXTS texts, at most SAMPLED_HEADS of each
    splitters = [heads[i * len(heads) // parts] for i in range(1, parts)] if len(heads) > parts else []
    small = lambda df: df.hint("shuffle_hash")
    marked = texts.join(small(copies.withColumn("copy", F.lit(True))), "key", "left")  # an anti join would pass below the exchange
    repeated = marked.where("copy is null").select("key", "text").mapInArrow(_anchor_rows(length, seed), "seed long, key long, at long, known boolean").repartition(
        count, "seed").mapInArrow(_repeated, "key long, at long")
    places = repeated.groupBy("key").agg(F.collect_list("at").alias("places"))
    runs = texts.join(small(places), "key").select("key", "text", "places").mapInArrow(_runs(length, seed, splitters), "part int, run binary, spans binary")
    spans = runs.groupBy("part").applyInArrow(_merge(length, seed), "key long, low long, high long")
    by_key = spans.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = marked.join(small(by_key), "key", "left")
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    out = joined.select("key", "text", "spans", F.coalesce("copy", F.lit(False)).alias("copy")).mapInArrow(_apply(length, keep_text), schema)
    if own is None:
        return out.withColumnRenamed("key", key)
    columns = [c for c in out.columns if c != "key"]
    return out.withColumnRenamed("key", "number").join(own, "number").select(F.col("key").alias(key), *columns)



def _sample(length: int, seed: int):
    """Seed strings of a few evenly spaced anchors of each sampled text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads: list[bytes] = []
            for _, _, data, offsets in _texts(batch.column(1)):
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    part = data[a:b]
                    at, _ = anchors(part, np.full(len(part), len(part)), length, seed)
                    at = at[::max(1, -(-len(at) // SAMPLED_HEADS))]
                    heads.extend(part[i:i + seed].tobytes() for i in at)
            yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary())], names=["head"])

    return run
