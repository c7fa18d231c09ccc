"""Exact n-gram Jaccard components by a size-aware heavy-light join.

A text becomes the set of its distinct word shingles. Equal sets collapse to one entry with a 64-bit set id. Sets below
a size boundary are *light*: they enumerate the fixed-size subsets a similar partner must share. Other sets are
*heavy*: they are found by scanning inverted lists of their prefix, in an order in which the corpus' most repeated
shingles come last; any order gives all links, this one keeps the lists short. The boundary is chosen by cost from the
size histogram and the list lengths. A large set is cut into groups by its shingles' hashes: the similarity of two sets
is a weighted mean of the similarities of their groups, so linked sets have a group that is as similar as they must be,
and groups of about GROUP shingles can be listed instead. Lists carry a 128-bit parity sketch of each group, a lower
bound on the difference of two, so a list only connects entries that may be linked, and only by a spanning forest: no
list emits its pairs.

The connected candidates form families. In a family the sets themselves are compared exactly: a family is dealt to blocks
of about `block_sets` sets or `block_items` shingles, each pair of blocks is one group, and it emits a spanning forest of
its true links. The components of those links are the result. The members' places are sent to all tasks only while they
are at most `broadcast_rows` rows; beyond that, texts and places are joined by an exchange.

Defined cases: null texts and texts without words have an empty set, no links and themselves as component; a text with
fewer words than `width` is one shingle; rows that repeat an id or have none are compared as documents of their own, then
rows of one id belong together whatever their texts; a component's name is its smallest id, null if none of its rows has
one, so a row without an id links others as any row does. Only id and text are read. Sets are told apart by the 64-bit sum of their
shingles' hashes together with their size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import components, numbered, partitions, small_batches, stored
from lotwise.llm.words import M1, M2, mix, shingles, slices, text_bytes, word_hashes

SKETCH_WORDS = 2
GROUP = 128
LATE = 1 << 16  # shingles that are ordered last: a fixed number, sent to all tasks
MASK = (1 << 64) - 1


def text_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(column)
    for low, high in slices(offsets):
        begin, end = offsets[low], offsets[high]
        words, _, _, cuts = word_hashes(data[begin:end], offsets[low:high + 1] - begin)
        for i in range(high - low):
            s = np.sort(shingles(words[cuts[i]:cuts[i + 1]], width))
            yield low + i, s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def set_id(s: np.ndarray) -> int:
    """Order-free: the mixed sum of the mixed elements and the size."""
    if not len(s):
        return 0
    total = (int(mix(s).sum()) + len(s) * int(M1)) & MASK
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def overlap(a: int, b: int, percent: int) -> int:
    """Least intersection of sets of these sizes that links them: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def group_counts(n: int, percent: int) -> list[int]:
    """Numbers of groups, powers of two, in which a set of size n meets its possible partners."""
    sizes = (n, -(-percent * n // 100), 100 * n // percent)
    return sorted({1 << max(0, (-(-size // GROUP) - 1).bit_length()) for size in sizes})


def prefix_length(n: int, percent: int) -> int:
    """Any partner shares one of so many first elements in a common order."""
    return n - -(-percent * n // 100) + 1


def subset_sizes(n: int, percent: int, limit: int) -> list[int]:
    """Sizes of the subsets that a set of size n below `limit` shares with some partner below `limit`."""
    partners = range(-(-percent * n // 100), min(limit - 1, 100 * n // percent) + 1)
    # A set shares all of itself with one of its own size only if they are equal, and equal sets are one entry.
    return sorted({c for t in partners if (c := overlap(n, t, percent)) <= min(n, t) and (t != n or c < n)})


def boundary(sizes: dict[int, int], list_length: float, percent: int, most: int = 64) -> int:
    """First size at which enumerating subsets costs more than scanning the lists of the prefix."""
    n = 1
    while n < most:
        subsets = sum(math.comb(n, c) for c in subset_sizes(n, percent, n + 2))
        if subsets * sizes.get(n, 1) > prefix_length(n, percent) * (1 + list_length) * sizes.get(n, 1):
            break
        n += 1
    return n


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of 128 classes."""
    h = mix(s * M2)
    bits = np.bincount((h & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def subset_keys(s: np.ndarray, sizes: list[int]) -> list[int]:
    """One key for each subset of the given sizes: the sum of its elements, mixed with its size."""
    h = mix(s ^ M1)
    total = h.sum()
    out = []
    for c in sizes:
        gone = len(s) - c
        if gone == 0:
            sums = np.array([total])
        elif gone == 1:
            sums = total - h
        else:
            picks = np.array(list(itertools.combinations(range(len(s)), gone)))
            sums = total - h[picks].sum(axis=1)
        out.append(mix(sums ^ mix(np.array([c * int(M2) & MASK], dtype=np.uint64))))
    return np.concatenate(out).view(np.int64).tolist() if out else []


def _describe(width: int, percent: int):
    """Per text: n, set id; per task: how often a shingle of the hash-ordered prefixes repeats in this task."""
    names = ["key", "n", "sid", "shingle", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, ids, heads = [], [], []
            for _, s in text_sets(batch.column(1), width):
                n.append(len(s))
                ids.append(set_id(s))
                if len(s) and ids[-1] not in seen:
                    seen.add(ids[-1])
                    heads.append(s[:prefix_length(len(s), percent)])
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int32()), pa.array(ids, pa.int64()), pa.nulls(count, pa.int64()), pa.nulls(count, pa.int64())], names=names)
            if heads:
                value, times = np.unique(np.concatenate(heads), return_counts=True)
                value, times = value[times > 1], times[times > 1]
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(len(value), batch.column(0).type), pa.nulls(len(value), pa.int32()), pa.nulls(len(value), pa.int64()),
                    pa.array(value.view(np.int64)), pa.array(times, pa.int64())], names=names)

    return run


def _post(width: int, percent: int, limit: int, late):
    """Entries of the lists: key of a subset or of a prefix shingle, set id, sizes of the set and of the group, sketch."""
    names = ["token", "sid", "sizes", *[f"s{i}" for i in range(SKETCH_WORDS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = late.value
        seen: set[int] = set()
        for batch in batches:
            token, ids, size, marks = [], [], [], []
            for _, s in text_sets(batch.column(0), width):
                n = len(s)
                if not n:
                    continue
                sid = set_id(s)
                if sid in seen:
                    continue
                seen.add(sid)
                entries: list[tuple[np.ndarray, np.ndarray]] = []  # keys of lists, and the shingles they stand for
                if n < limit:
                    entries.append((np.array(subset_keys(s, subset_sizes(n, percent, limit)), dtype=np.int64), s))
                if 100 * n // percent >= limit:  # it or a possible partner is heavy
                    place = np.searchsorted(last, s)
                    place[place == len(last)] = 0
                    is_late = last[place] == s if len(last) else np.zeros(n, dtype=bool)
                    ordered = np.concatenate([s[~is_late], s[is_late]])
                    group = mix(ordered)
                    for groups in group_counts(n, percent):
                        name = mix(np.array([groups], dtype=np.uint64))
                        own = (group >> np.uint64(20)) & np.uint64(groups - 1)
                        for part in (ordered[own == g] for g in range(groups)) if groups > 1 else [ordered]:
                            entries.append((mix(part[:prefix_length(len(part), percent)] ^ name).view(np.int64), part))
                for k, part in entries:
                    if len(k):
                        token.append(k)
                        ids.append(np.full(len(k), sid, dtype=np.int64))
                        size.append(np.full(len(k), n << 32 | len(part), dtype=np.int64))
                        marks.append(np.broadcast_to(sketch(part), (len(k), SKETCH_WORDS)))
            if token:
                mark = np.concatenate(marks)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (token, ids, size)] + [
                    pa.array(np.ascontiguousarray(mark[:, i])) for i in range(SKETCH_WORDS)], names=names)

    return run


def may_link(n: np.ndarray, m: np.ndarray, marks: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Which of the others may be linked with entry i, by set size and by the lower bound on the groups' difference."""
    differ = np.bitwise_count(marks[others] ^ marks[i]).sum(axis=1)
    small, large = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
    # 100 * (a + b - d) / 2 >= percent * (a + b + d) / 2
    return (100 * small >= percent * large) & ((100 + percent) * differ.astype(np.int64) <= (100 - percent) * (m[others] + m[i]))


def forest(n: np.ndarray, m: np.ndarray, marks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the possible links in one list: each found entry looks once at those not yet found."""
    left = np.argsort(n, kind="stable")
    size = n[left]
    edges: list[tuple[int, int]] = []
    while len(left):
        queue = [left[0]]
        left, size = left[1:], size[1:]
        while queue and len(left):
            i = queue.pop()
            a, b = np.searchsorted(size, [-(-percent * n[i] // 100), 100 * n[i] // percent + 1])
            hit = may_link(n, m, marks, i, left[a:b], percent)
            if hit.any():
                found = left[a:b][hit]
                edges.extend((int(i), int(j)) for j in found)
                queue.extend(found)
                keep = np.ones(len(left), dtype=bool)
                keep[a:b] = ~hit
                left, size = left[keep], size[keep]
    return edges


def _lists(percent: int):
    """Candidate edges of the lists in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        token, ids, sizes = (table.column(c).to_numpy() for c in ("token", "sid", "sizes"))
        marks = np.stack([table.column(f"s{i}").to_numpy() for i in range(SKETCH_WORDS)], axis=1).view(np.uint64)
        order = np.lexsort((ids, token))
        same = token[order[1:]] == token[order[:-1]]
        repeated = np.append(same, False) | np.append(False, same)
        order = order[repeated]
        starts = np.flatnonzero(np.append(True, token[order[1:]] != token[order[:-1]])) if len(order) else np.zeros(0, dtype=int)
        left, right = [], []
        for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
            rows = order[a:b]
            rows = rows[np.append(True, ids[rows[1:]] != ids[rows[:-1]])]
            if len(rows) < 2:
                continue
            for i, j in forest(sizes[rows] >> 32, sizes[rows] & 0xFFFFFFFF, marks[rows], percent):
                left.append(ids[rows[i]])
                right.append(ids[rows[j]])
        if left:
            pairs = np.unique(np.sort(np.array([left, right]).T, axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def linked(sets: list[np.ndarray], first: range, second: range, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the true links between two ranges of sets ordered by size, by counting common elements."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    every = np.concatenate([sets[j] for j in second])
    owner = np.repeat(np.arange(len(second)), [len(sets[j]) for j in second])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    size = np.array([len(sets[j]) for j in second])
    out = []
    for i in first:
        s = sets[i]
        low, high = np.searchsorted(every, s, "left"), np.searchsorted(every, s, "right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(second))
        for j in np.flatnonzero(100 * common >= percent * (size + len(s) - common)):
            a, b = find(i), find(second[j])
            if a != b:
                root[a] = b
                out.append((i, second[j]))
    return out


def _compare(percent: int):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        ids = table.column("sid").to_numpy()[order]
        blobs = table.column("items").to_pylist()
        sets = [np.frombuffer(blobs[i], dtype=np.uint64) for i in order]
        cut = int((side == 0).sum())
        inner = cut == len(sets)
        first, second = range(cut), range(len(sets)) if inner else range(cut, len(sets))
        edges = linked(sets, first, second, percent) if len(second) and len(first) else []
        return pa.table({"a": pa.array([ids[i] for i, _ in edges], pa.int64()), "b": pa.array([ids[j] for _, j in edges], pa.int64())})

    return run


def jaccard_components(
    docs: DataFrame, key: str, text: str, width: int = 3, percent: int = 90, block_sets: int = 256, block_items: int = 1 << 20,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """key, n_shingles, component_id of every row: the smallest id reachable by links and by rows of the same id."""
    small_batches(docs.sparkSession)
    rows, own = numbered(docs, key, text)
    found = _numbered_components(rows, width, percent, block_sets, block_items, broadcast_rows)
    if own is None:
        return found.select(F.col("key").alias(key), "n_shingles", "component_id")
    rows = stored(found.join(own.select("number", F.col("key").alias("real")), F.col("key") == F.col("number")).drop("number"))
    same = rows.where("real is not null").groupBy("real").agg(F.min("key").alias("first"))
    twins = rows.join(same, "real").select("key", F.col("first").alias("other"))
    merged = components(rows.select("key", F.col("component_id").alias("other")).unionByName(twins), "key", "other")
    grouped = rows.join(merged, F.col("key") == F.col("id"), "left").withColumn("of", F.coalesce("component", "key"))
    least = grouped.groupBy("of").agg(F.min("real").alias("least"))
    return grouped.join(least.withColumnRenamed("of", "named"), F.col("of") == F.col("named")).select(
        F.col("real").alias(key), "n_shingles", F.col("least").alias("component_id"))


def _numbered_components(rows: DataFrame, width: int, percent: int, block_sets: int, block_items: int, broadcast_rows: int) -> DataFrame:
    """The same for rows (key, text) whose keys are unique."""
    spark = rows.sparkSession
    described = stored(rows.mapInArrow(_describe(width, percent), "key long, n int, sid long, shingle long, times long"))
    texts = described.where("n is not null").select("key", "n", "sid")
    repeats = described.where("times is not null").groupBy("shingle").agg(F.sum("times").alias("times"))
    late = repeats.orderBy(F.desc("times"), "shingle").limit(LATE).toPandas()
    spread = float((late["times"].astype(float) ** 2).sum() / late["times"].sum()) if len(late) else 0.0
    sizes = {r["n"]: r["count"] for r in texts.where("n between 1 and 64").groupBy("n").count().collect()}
    limit = boundary(sizes, min(spread, 64.0), percent)
    shared = spark.sparkContext.broadcast(np.sort(late["shingle"].to_numpy(dtype=np.int64).view(np.uint64)))
    schema = "token long, sid long, sizes long, " + ", ".join(f"s{i} long" for i in range(SKETCH_WORDS))
    posted = rows.select("text").mapInArrow(_post(width, percent, limit, shared), schema)
    candidates = posted.repartition(partitions(spark), "token").mapInArrow(_lists(percent), "a long, b long").distinct()
    families = stored(components(candidates, "a", "b"))

    classes = texts.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), F.first("n").alias("n"))
    members = stored(classes.join(families, F.col("sid") == F.col("id")).select("sid", "key", "n", F.col("component").alias("family")))
    size = members.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / block_sets, F.sum("n") / block_items)).cast("int").alias("parts"))
    dealt = members.join(size, "family").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
    places = dealt.select("sid", F.col("key").alias("of"), "family", F.explode(F.expr("""
        transform(sequence(0, parts - 1), o -> named_struct('low', least(o, block), 'high', greatest(o, block), 'side', int(block > o)))""")).alias("p"))
    places = stored(places.select("sid", "of", "family", "p.low", "p.high", "p.side"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, blobs, ids = [], [], batch.column(0).to_pylist()
            for i, s in text_sets(batch.column(5), width):
                if set_id(s) == ids[i]:  # of rows that repeat an id, those with the wanted set
                    at.append(i)
                    blobs.append(s.tobytes())
            kept = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(kept) for i in range(5)], pa.array(blobs, pa.binary())], names=["sid", "family", "low", "high", "side", "items"])

    if places.count() <= broadcast_rows:  # six numbers a row; beyond that the texts are exchanged
        places = F.broadcast(places)
    items = rows.join(places, F.col("key") == F.col("of")).select("sid", "family", "low", "high", "side", "text").mapInArrow(
        collect, "sid long, family long, low int, high int, side int, items binary")
    links = items.groupBy("family", "low", "high").applyInArrow(_compare(percent), "a long, b long")
    merged = components(links, "a", "b")
    smallest = merged.join(classes, F.col("id") == F.col("sid")).groupBy("component").agg(F.min("key").alias("least"))
    found = merged.join(smallest, "component").select(F.col("id").alias("sid"), "least")
    classes = classes.select("sid", F.col("key").alias("own")).join(found, "sid", "left").select(
        F.col("sid").alias("set"), F.coalesce("least", "own").alias("least"))
    out = texts.join(classes, (F.col("sid") == F.col("set")) & (F.col("n") > 0), "left")
    return out.select("key", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "key").alias("component_id"))
