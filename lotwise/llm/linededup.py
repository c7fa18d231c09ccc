"""Line dedup over the whole corpus.

Every text is split into lines; a line's key is the line without white space at its ends, A-Z in lower case. Each document
sends the digest (128 bits) and first position of every distinct key that is long enough, so counting the rows of a
digest counts documents. A digest of `min_docs` documents or more stays with its smallest document; all other holders get
the position back, find the key there again and drop every line that has it. What remains is joined in its old order.

Counts are combined before the exchange. The few digests that many documents hold are sent to the tasks (at most
`common.HEAVY_KEYS` of them, whatever the data), the others are joined by exchange, so no line lands in one task with
all its documents. Texts are exchanged once, by document.

Defined cases: a null or empty text is one empty line; keys shorter than `min_chars` code points are never dropped; lines
that repeat inside one document only stay; a text that loses all lines becomes empty; rows that repeat an id or have none
are documents of their own, in order of id (null first), then of the text's digest; an empty table gives no rows. Only id
and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import join_skewed, numbered, small_batches, stored


def line_key(line: bytes) -> bytes:
    """bytes.strip and bytes.lower know \\x20, \\x09-\\x0D and A-Z alone."""
    return line.strip().lower()


def _line_digests(min_chars: int):
    """One row for each distinct key of a document: id, the digest's halves, the first line that has it."""
    def long_enough(key: bytes) -> bool:
        return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, digests, places = [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                first: dict[bytes, int] = {}
                for at, line in enumerate(text.split(b"\n")):
                    first.setdefault(line_key(line), at)
                for key, at in first.items():
                    if long_enough(key):
                        row.append(i)
                        digests.append(hashlib.md5(key, usedforsecurity=False).digest())
                        places.append(at)
            if row:
                halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), *(pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)), pa.array(places, pa.int32())],
                    names=["key", "high", "low", "at"])

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines that share a key with one of the given positions."""
    for batch in batches:
        texts, n_lines, n_dropped = [], [], []
        for text, places in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines = text.split(b"\n")
            gone = {line_key(lines[at]) for at in places or ()}
            kept = [line for line in lines if line_key(line) not in gone] if gone else lines
            texts.append(b"\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            names=["key", "text", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, key: str, text: str, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """key, text, n_lines, n_dropped: every document with what stays of its text."""
    small_batches(docs.sparkSession)
    rows, own = numbered(docs, key, text)
    held = stored(rows.mapInArrow(_line_digests(min_chars), "key long, high long, low long, at int"))
    shared = held.groupBy("high", "low").agg(F.min("key").alias("first"), F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    later = join_skewed(held, stored(shared), ["high", "low"], "n_docs").where(F.col("key") != F.col("first"))
    places = later.groupBy("key").agg(F.collect_list("at").alias("places"))
    kept = rows.join(places.hint("shuffle_hash"), "key", "left").select("key", "text", "places").mapInArrow(
        _without, "key long, text string, n_lines long, n_dropped long")
    if own is not None:
        kept = kept.join(own.withColumnRenamed("key", "real"), F.col("key") == F.col("number")).select(F.col("real").alias("key"), "text", "n_lines", "n_dropped")
    return kept
