"""Vector compression by product codes, trained with member-resident Lloyd rounds.

Components become integers floor(scale * x); a vector is cut into equal parts, and each part position has a codebook. A
codebook starts as that part of the rows with the smallest ids. Every row's parts live with the owner of their entry:
rows are partitioned by (position, entry, salt), where an entry with many members has as many salts as it needs to fill
no more than one partition's share. A round is
- migrate: parts that changed their entry go to the new owner, the only rows that are exchanged,
- update: owners sum their resident members; the sums meet as one row for each (position, entry, component),
- assign: owners compare their members with the new codebooks where they are, and mark the parts that must leave.
Parts that stay are written where they are and never exchanged again. All arithmetic is on integers, so the result depends
neither on the order of rows nor on the partitions.

The driver holds the codebooks, their sums and the members of each entry: entries * dimension numbers, whatever the table.

Defined cases: vectors that are null or empty, hold null or non-finite components or components of 2**18 or more in size (their
distances would leave 64 bits) are left out, and so are vectors of another length than the kept row with the smallest id;
that length must divide by the number of parts. Rows that repeat an id are rows of their own; rows without an id are coded
too and come last in the order of ids; ties of ids are in order of the components. Entries without members stay as they
are; with fewer rows than entries the codebooks are as long as the rows. An empty table gives no rows and empty codebooks.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import partitions, small_batches, stored
from lotwise.session import shared_folder

LARGEST = 1 << 18
EXACT = 1 << 52  # integers below this are exact as doubles
ROWS_AT_ONCE = 4096
MEMBER = "row long, position int, entry int, part array<int>"


def _integers(scale: int):
    """Drops vectors that cannot take part and floors the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.num_columns - 1)
            batch = batch.filter(pa.compute.greater(pa.compute.fill_null(pa.compute.list_value_length(vectors), 0), 0))
            vectors = batch.column(batch.num_columns - 1)
            values = vectors.flatten()
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            ok = np.isfinite(x) & (np.abs(x) < LARGEST)
            length = pa.compute.list_value_length(vectors).to_numpy()
            starts = np.cumsum(length) - length
            good = np.logical_and.reduceat(ok, starts) if len(starts) else np.zeros(0, dtype=bool)
            floors = np.floor(np.where(ok, x, 0.0) * scale).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(x)).astype(np.int32)), pa.array(floors))
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "ints"])
            yield out.filter(pa.array(good))

    return run


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower one of ties, and the squared distance; exact on integers."""
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * parts.shape[1] * most * most < EXACT else np.int64
    entries = book.astype(kind)
    norms = (entries * entries).sum(axis=1)
    index, distance = np.empty(len(parts), dtype=np.int32), np.empty(len(parts), dtype=np.int64)
    for low in range(0, len(parts), ROWS_AT_ONCE):
        x = parts[low:low + ROWS_AT_ONCE].astype(kind)
        far = norms - 2 * (x @ entries.T)
        best = far.argmin(axis=1)
        index[low:low + len(x)] = best
        distance[low:low + len(x)] = far[np.arange(len(x)), best] + (x * x).sum(axis=1)
    return index, distance


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _members(row: pa.Array, position: np.ndarray, entry: np.ndarray, parts: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    width = parts.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, parts.size + 1, width, dtype=np.int32)), pa.array(np.ascontiguousarray(parts).ravel()))
    columns = {"row": row, "position": pa.array(position.astype(np.int32)), "entry": pa.array(entry), "part": lists} | {k: pa.array(v) for k, v in more.items()}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _first_entries(books: np.ndarray):
    """Cuts vectors into parts, each with its nearest entry of the starting codebooks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = _matrix(batch.column(1)).reshape(batch.num_rows, len(books), -1)
                for p, book in enumerate(books):
                    parts = whole[:, p]
                    yield _members(batch.column(0), np.full(len(parts), p), nearest(parts, book)[0], parts)

    return run


def _assigned(books: np.ndarray, final: bool):
    """Members with their entry in new codebooks: whether they leave their owner, or in the end how far they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            position, old, parts = batch.column(1).to_numpy(), batch.column(2).to_numpy(), _matrix(batch.column(3))
            entry, distance = np.empty(len(old), dtype=np.int32), np.empty(len(old), dtype=np.int64)
            for p in np.unique(position):
                mine = position == p
                entry[mine], distance[mine] = nearest(parts[mine], books[p])
            if final:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entry), pa.array(distance)], names=["row", "position", "entry", "distance"])
            else:
                yield _members(batch.column(0), position, entry, parts, moved=entry != old)

    return run


def _sums(shape: tuple[int, int, int]):
    """Sums of the members of one task: a row for each (position, entry, component); component -1 counts members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape[0] * shape[1], shape[2] + 1), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                owner = batch.column(0).to_numpy().astype(np.int64) * shape[1] + batch.column(1).to_numpy()
                order = np.argsort(owner, kind="stable")
                starts = np.flatnonzero(np.append(True, np.diff(owner[order]) != 0))
                sums = np.add.reduceat(_matrix(batch.column(2))[order].astype(np.int64), starts, axis=0)
                total[owner[order[starts]], 1:] += sums
                total[owner[order[starts]], 0] += np.diff(np.append(starts, len(order)))
        used = np.flatnonzero(total[:, 0])
        owner, component = np.repeat(used, shape[2] + 1), np.tile(np.arange(-1, shape[2]), len(used))
        columns = [(owner // shape[1]).astype(np.int32), (owner % shape[1]).astype(np.int32), component.astype(np.int32), total[used].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["position", "entry", "component", "total"])

    return run


def updated(books: np.ndarray, members: DataFrame) -> np.ndarray:
    """Codebooks whose entries are the floored means of their members; entries without members stay."""
    shape = books.shape
    found = members.select("position", "entry", "part").mapInArrow(_sums(shape), "position int, entry int, component int, total long").groupBy(
        "position", "entry", "component").agg(F.sum("total").alias("total")).toPandas()
    total = np.zeros((shape[0], shape[1], shape[2] + 1), dtype=np.int64)
    total[found["position"], found["entry"], found["component"] + 1] = found["total"]
    return np.where(total[:, :, :1] > 0, total[:, :, 1:] // np.maximum(total[:, :, :1], 1), books)


def with_owners(moving: DataFrame) -> DataFrame:
    """Deals parts to the owners (position, entry, salt): an entry that more parts move to than fill a partition's share
    gets as many salts as fill one each."""
    count = partitions(moving.sparkSession)
    arriving = {(r[0], r[1]): r[2] for r in moving.groupBy("position", "entry").count().collect()}
    total = sum(arriving.values())
    salts = {f"{p}-{e}": math.ceil(n * count / total) for (p, e), n in arriving.items() if n * count > total}
    salt = F.lit(0)
    if salts:  # at most as many entries as there are partitions
        wide = F.element_at(F.create_map(*[F.lit(x) for item in salts.items() for x in item]), F.concat_ws("-", "position", "entry"))
        salt = F.pmod(F.xxhash64("row"), F.coalesce(wide, F.lit(1)))
    return moving.repartition(count, "position", "entry", salt)


@dataclass(frozen=True)
class Codes:
    """`rows`: key, the kept columns, code (entry of each part) and error (squared distance); `books`: (part, entry, component)."""

    rows: DataFrame
    books: np.ndarray
    scale: int

    def digest(self) -> str:
        """sha256 of all components by part, entry, place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def decoded(self) -> DataFrame:
        """The rows with `vector`, the middle of the cell that each code stands for."""
        books, scale = self.books, self.scale
        @F.pandas_udf("array<double>")
        def vector(codes):
            return codes.map(lambda code: ((np.concatenate([books[p][e] for p, e in enumerate(code)]) + 0.5) / scale).tolist())

        return self.rows.withColumn("vector", vector("code"))


def compress(
    vectors: DataFrame, key: str, vector: str, keep: Sequence[str] = (), parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
) -> Codes:
    """Codes of all vectors, and the codebooks they refer to. Kept columns are not named key, code or error."""
    spark = vectors.sparkSession
    small_batches(spark)
    named: list[Column] = [F.col(key).cast("long").alias("key"), *[F.col(c).alias(f"kept_{c}") for c in keep]]
    chosen = vectors.select(*named, F.col(vector).cast("array<double>").alias("v"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1])
    kept = stored(chosen.mapInArrow(_integers(scale), f"{kinds}, ints array<int>").withColumn("row", F.monotonically_increasing_id()))
    start = kept.sort(F.col("key").asc_nulls_last(), "ints").select("ints").limit(1).first()
    size = len(start[0]) if start else parts
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("ints") == size)
    start = kept.sort(F.col("key").asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    books = np.array([r[0] for r in start], dtype=np.int64).reshape(len(start), parts, size // parts).transpose(1, 0, 2)
    told = [F.col("key"), *[F.col(f"kept_{c}").alias(c) for c in keep]]
    if not start:
        return Codes(kept.select(*told, F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error")), books, scale)
    schema = f"{MEMBER}, moved boolean"
    staying, moving = None, stored(kept.select("row", "ints").mapInArrow(_first_entries(books), MEMBER))
    members = moving
    for turn in range(rounds):
        arrived = stored(with_owners(moving))
        members = arrived if staying is None else staying.unionByName(arrived)
        books = updated(books, members)
        if turn < rounds - 1:
            path = f"{shared_folder(spark)}/members-{uuid.uuid4().hex}"
            members.mapInArrow(_assigned(books, False), schema).write.partitionBy("moved").option("compression", "zstd").parquet(path)
            after = spark.read.schema(schema).parquet(path)
            staying, moving = after.where("not moved").drop("moved"), after.where("moved").drop("moved")
    coded = members.mapInArrow(_assigned(books, True), "row long, position int, entry int, distance long").groupBy("row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"]).alias("code"), F.sum("distance").alias("error"))
    return Codes(stored(kept.drop("ints").join(coded, "row").select(*told, "code", "error")), books, scale)
