"""Lexical retrieval packing: every token id of every document goes into a sequence of at most `window` ids.

A document is its ids followed by the end id. Its full windows are sequences of their own; only the rest travels. Rests
are dealt to shards by a lexical signature, so that documents with common words meet. A shard builds a BM25 inverted
index of its rests (document frequencies and average length are counted over the whole corpus); a seed's best unused
neighbours, cut where the window ends, fill its window, and the cut neighbour seeds the next one. What remains at the
end of a shard is cut into sequences whose lengths are powers of two, which need no padding.

A shard holds about `shard_tokens` ids whatever the corpus; equal rests are told apart by id, so a large group of
copies spreads over shards. Ids are kept as 16-bit numbers where the vocabulary allows.

Tokenizing splits a text at every blank between two characters that are no white space: there the tokenizer's own
pre-tokenizer always cuts, so the pieces can be cached.

Defined cases: null and empty texts consist of the end id alone; equal ids of different rows are packed as different
documents; an empty table gives no pieces. Only id and text are read.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import small_batches, stored, texts_of

CACHED, CACHED_CHARS = 800_000, 64
LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
RARE_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# Fixed value: the pre-tokenizer's pattern of byte-level vocabularies of this family.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
K1, B = 1.2, 0.75
FIRST_ASKED = 24
_coders: dict[tuple[str, int], Coder] = {}


class Coder:
    """A byte-level tokenizer file with a bounded cache of the ids of blank-separated pieces.

    Pieces outside the cache are encoded by rank merging over the file's own vocabulary, which gives the same ids several
    times faster; texts that hold an added token go through the tokenizer itself.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        place = {c: b for b, c in byte_characters().items()}
        ranks = {bytes(place[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if token not in added}
        self.encode = tiktoken.Encoding(path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leads = np.zeros(self.size, dtype=bool)  # ids that begin with a blank
        self.leads[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.later: dict[str, bytes] = {}

    @staticmethod
    def load(path: str, end: int) -> Coder:
        if (path, end) not in _coders:
            _coders[path, end] = Coder(path, end)
        return _coders[path, end]

    def piece(self, text: str) -> bytes:
        return array(self.code, self.encode(text)).tobytes()

    def fill(self, codes: list[bytes | None], parts: list[str], plain: bool) -> None:
        """Encodes the pieces that the cache lacks. Pieces without blanks are encoded in one go: each begins where the ids
        begin with a blank."""
        at = [i for i, code in enumerate(codes) if code is None]
        missing = [parts[i] for i in at]
        found = []
        if plain:
            ids = np.array(self.encode(" " + " ".join(missing)), dtype=self.kind)
            cuts = np.append(np.flatnonzero(self.leads[ids]), len(ids)) * self.kind.itemsize
            raw, cuts = ids.tobytes(), cuts.tolist()
            found = [raw[a:b] for a, b in zip(cuts, cuts[1:])]  # noqa: B905
        if len(found) != len(at):
            found = [self.piece(" " + part) for part in missing]
        for i, part, code in zip(at, missing, found, strict=True):
            codes[i] = code
            if len(part) <= CACHED_CHARS and len(self.later) < CACHED:  # the first ones are the frequent ones
                self.later[part] = code

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of the text with the end id."""
        text = text or ""
        last = self.end.to_bytes(self.kind.itemsize, "little")
        if self.added.search(text):
            return np.frombuffer(array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() + last, dtype=self.kind)
        plain = not ("  " in text or " \n" in text or "\n " in text or any(c in text for c in RARE_SPACES) or text[:1] == " " or text[-1:] == " ")
        parts = text.split(" ") if plain else LONE_BLANK.split(text)
        codes = [self.piece(parts[0]), *map(self.later.get, parts[1:])]
        if None in codes:
            self.fill(codes, parts, plain)
        codes.append(last)
        return np.frombuffer(b"".join(codes), dtype=self.kind)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _hash(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


@functools.lru_cache(maxsize=2)
def _signs(size: int) -> np.ndarray:
    """Per token, eight hash bits in lanes of 16 bits, so that one sum adds four of them."""
    bits = _hash(np.arange(size))
    return np.stack([sum(((bits >> np.uint64(40 + 4 * half + lane)) & np.uint64(1)) << np.uint64(16 * lane) for lane in range(4)) for half in range(2)])


def signature(ids: np.ndarray, size: int) -> int:
    """Sorts lexically similar texts together: 8 signs of the summed hashes of the ids, then a minimum over id pairs."""
    sums = [int(table[ids].sum()) for table in _signs(size)]
    lanes = np.array([s >> (16 * lane) & 0xFFFF for s in sums for lane in range(4)])
    signs = int(np.packbits(2 * lanes > len(ids))[0])
    wide = ids.astype(np.uint64)
    pairs = (wide[:-1] * np.uint64(1 << 20) + wide[1:] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) if len(ids) > 1 else wide + np.uint64(1)
    return (signs << 48) | (int((pairs ^ (pairs >> np.uint64(29))).min()) >> 16)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenize(path: str, end: int, window: int):
    names = ["key", "tokens", "full", "signature", "rest", "stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.load(path, end)
        counts, texts, length = np.zeros(coder.size, dtype=np.int64), 0, 0
        kind = None
        for batch in batches:
            tokens, full, signs, rest = [], [], [], []
            for ids in map(coder.ids, texts_of(batch)):
                counts[ids] += 1  # an assignment: once for a token however often the text has it
                length += len(ids)
                cut = len(ids) // window * window
                tokens.append(len(ids))
                full.append([_crc(ids[i:i + window]) for i in range(0, cut, window)])
                tail = ids[cut:]
                signs.append(signature(tail, coder.size) if len(tail) else None)
                rest.append(tail.tobytes() if len(tail) else None)
            texts += batch.num_rows
            kind = batch.column(0).type
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(tokens, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(signs, pa.int64()),
                pa.array(rest, pa.binary()), pa.nulls(batch.num_rows, pa.binary())], names=names)
        if kind is not None:  # one more row with what this task has counted
            used = np.flatnonzero(counts)
            stats = np.concatenate([[texts, length], used, counts[used]]).astype(np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                pa.array([stats], pa.binary())], names=names)

    return run


def _sum_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts of one partition's tasks; token -1 holds the texts, -2 their ids."""
    for batch in batches:
        for row in batch.column(0):
            x = np.frombuffer(row.as_py(), dtype=np.int64)
            half = (len(x) - 2) // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([[-1, -2], x[2:2 + half]])), pa.array(np.concatenate([x[:2], x[2 + half:]]))], names=["token", "n"])


class Shard:
    """BM25 inverted index of the rests of one shard."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, average: float, query_terms: int):
        self.n, self.query_terms = len(rests), query_terms
        doc, term, tf = [], [], []
        for i, ids in enumerate(rests):
            ordered = np.sort(ids, kind="stable")  # by counting, as ids have 16 bits
            first = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)
            doc.append(np.full(len(first), i, dtype=np.int32))
            term.append(ordered[first].astype(np.int32))
            tf.append(np.diff(np.append(first, len(ids))))
        self.cuts = np.concatenate([[0], np.cumsum([len(t) for t in term])])
        doc_, self.term, tf_ = np.concatenate(doc), np.concatenate(term), np.concatenate(tf)
        norm = K1 * (1 - B + B * np.array([len(r) for r in rests]) / average)
        self.weight = idf[self.term] * tf_ * (K1 + 1) / (tf_ + norm[doc_])
        order = np.argsort(self.term, kind="stable")
        self.posted, self.impact = doc_[order], self.weight[order]
        self.lists = np.searchsorted(self.term[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int, unused: np.ndarray, most: int | None = None) -> np.ndarray:
        """Unused rests that share one of the seed's weightiest terms, best first; all, or at least the `most` best."""
        part = slice(self.cuts[seed], self.cuts[seed + 1])
        terms = self.term[part]
        if len(terms) > self.query_terms:
            terms = terms[np.argpartition(-self.weight[part], self.query_terms)[:self.query_terms]]
        where = [slice(self.lists[t], self.lists[t + 1]) for t in terms]
        score = np.bincount(np.concatenate([self.posted[w] for w in where]), np.concatenate([self.impact[w] for w in where]), self.n)
        score[~unused] = 0
        hits = np.flatnonzero(score)
        if most is not None and len(hits) > most:
            hits = hits[score[hits] >= np.partition(score[hits], -most)[-most]]
        return hits[np.lexsort((hits, -score[hits]))]


def fill_order(index: Shard, lengths: np.ndarray, window: int) -> list[int]:
    """The order of the rests: each window's seed, then its unused neighbours until the window is full."""
    unused = np.ones(index.n, dtype=bool)
    order: list[int] = []
    following, seed, room = 0, None, window
    while len(order) < index.n:
        if seed is None:
            while not unused[following]:
                following += 1
            seed = following
            unused[seed] = False
            order.append(seed)
            room -= lengths[seed]
        for most in (FIRST_ASKED, None):  # mostly a few neighbours fill the window
            for other in index.neighbours(seed, unused, most) if room > 0 else ():
                unused[other] = False
                order.append(int(other))
                room -= lengths[other]
                if room <= 0:
                    break
        if room > 0:  # nobody left shares a term with the seed: the next in lexical order seeds the rest of the window
            seed = None
        else:  # a neighbour that was cut seeds the next window
            seed = order[-1] if room < 0 else None
            room = room + window if room < 0 else window
    return order


def _boundaries(total: int, window: int) -> np.ndarray:
    """Ends of the sequences: full windows, then powers of two."""
    ends = list(range(window, total + 1, window))
    at = ends[-1] if ends else 0
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        ends.append(at)
    return np.array(ends, dtype=np.int64)


def _pack(window: int, idf, average: float, query_terms: int, kind: str):
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("signature", "ascending"), ("key", "ascending"), ("tokens", "ascending")])
        rests = [np.frombuffer(x.as_py(), dtype=kind) for chunk in table.column("rest").chunks for x in chunk]
        tokens = table.column("tokens").to_numpy()
        lengths = np.array([len(r) for r in rests])
        order = np.array(fill_order(Shard(rests, idf.value, average, query_terms), lengths, window))
        begins = np.concatenate([[0], np.cumsum(lengths[order])])
        ends = _boundaries(int(begins[-1]), window)
        cuts = np.unique(np.concatenate([begins, ends]))
        at = np.searchsorted(begins, cuts[:-1], side="right") - 1
        sequence = np.searchsorted(ends, cuts[:-1], side="right")
        opened = np.concatenate([[0], ends])[sequence]
        length, inner = np.diff(cuts), cuts[:-1] - begins[at]
        doc = order[at]
        crc = [_crc(rests[d][i:i + n]) for d, i, n in zip(doc, inner, length, strict=True)]
        shard = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            table.column("key").combine_chunks().take(pa.array(doc)), pa.array(tokens[doc] - lengths[doc] + inner), pa.array(length), pa.array(crc, pa.int64()),
            pa.array(tokens[doc]), pa.array(((np.int64(shard) << 32) + sequence) * 2 + 1), pa.array(cuts[:-1] - opened)], names=names)

    return run


def pack(
    docs: DataFrame, key: str, text: str, tokenizer: str, window: int = 2048, end: int = 1, shard_tokens: int = 4_000_000, query_terms: int = 16,
) -> DataFrame:
    """One row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    coded = stored(rows.mapInArrow(
        _tokenize(tokenizer, end, window), f"key {kind}, tokens long, full array<long>, signature long, rest binary, stats binary"))
    counts = coded.where("stats is not null").select("stats").mapInArrow(_sum_stats, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")).toPandas().set_index("token")["n"]  # one row a token of the vocabulary at most
    coder = Coder.load(tokenizer, end)
    seen = np.zeros(coder.size)
    used = counts[counts.index >= 0]
    seen[used.index.to_numpy()] = used.to_numpy()
    texts, length = float(counts.get(-1, 1)), float(counts.get(-2, 1))
    idf = spark.sparkContext.broadcast(np.log1p((texts - seen + 0.5) / (seen + 0.5)).astype(np.float32))
    width = coder.kind.itemsize
    rest_tokens = coded.agg(F.sum(F.length("rest"))).first()[0] or 0
    shards = max(1, -(-rest_tokens // (width * shard_tokens)))
    packed = coded.where("rest is not null").select("key", "tokens", "signature", "rest").repartitionByRange(
        shards, "signature", "key").mapInArrow(
        _pack(window, idf, length / texts, query_terms, coder.kind.str),
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    full = coded.where("size(full) > 0").select("key", "tokens", F.posexplode("full").alias("place", "crc")).select(
        "key", (F.col("place") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"), (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed).withColumnRenamed("key", key)
