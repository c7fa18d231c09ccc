"""Spelling variants: words one edit apart, the frequent form of each, and the root that forms lead to.

Candidates. A pair that differs by one inserted, deleted or replaced character has its edit at one place j of the shorter
length m (the first place where the two differ). Places 0..m are cut into intervals; for each interval [lo, hi) words of
length m and m + 1 meet in the group of those with the same first lo and the same last m - hi characters. A group of more than
`group_words` words is cut into the halves of its interval, again and again, down to single places, where a group has no more
words than the alphabet allows. A word is in two groups an interval and length, so rows grow with the words, not with pairs.

Index. Groups are dealt to tasks, sorted, and read in blocks. A block has a bit-sliced position index: for each (position,
letter) a bitset over the words of the block. All words of length m search it together: with each of their letters the set
of words without an error so far, the set with one replaced letter and the set with one more letter (read at the shifted position)
follow from the last ones by a few operations on 64 words at a time. At the end, bitsets of the lengths m and m + 1 pick
the words that are one edit away. Of the hits, those of the same group whose edit lies in its interval count, so each pair is
found exactly once; both words are told.

Counting combines in the task and before the exchange. A word's partners are bounded by its length and the alphabet. Forms are
at least `ratio` times as frequent as their variants, so roots are reached in a few levels, from the top downward.

Defined cases: null and empty texts have no words; rows without an id write an empty one; rows that repeat an id count again;
an empty table gives no rows. Characters outside A-Z, a-z and U+00C0 to U+00FF end a word. Only id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import join_skewed, partitions, small_batches, stored

HELD_BYTES = 16 << 20  # of counted words in a task
BLOCK_CELLS = 1 << 17  # words times length in a block of the index, one group at least
BLOCK_WORDS = 2048


def _counted(min_chars: int, noise: int | None):
    """Words of a task with their occurrences. Latin-1 bytes stand for the characters; all others become '?'."""
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % min_chars)

    def told(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(runs.findall((text or "").encode("latin-1", "replace").lower()))
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in found.items():
                    if noise:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_chars:
                                continue
                    if word not in total:
                        size += len(word) + 100
                    total[word] += n
                if size > HELD_BYTES:
                    yield told(total)
                    total, size = Counter(), 0
        if total:
            yield told(total)

    return run


def word_counts(docs: DataFrame, key: str, text: str, min_chars: int = 7, min_count: int = 2, noise: int | None = None) -> DataFrame:
    """word, n: words of at least min_chars characters (only A-Z lower-cased) with min_count occurrences or more. `noise`
    misspells one in so many (document, word) pairs by one lost character, chosen by crc32, to plant known variants."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_counted(min_chars, noise), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- groups that one edit cannot leave -------------------------------------------------------------

def _group(tag: Column, low: Column, high: Column) -> Column:
    """Hash of what the words of a group share."""
    tail = F.greatest(tag - high, F.lit(0))
    return F.xxhash64(tag, low, high, F.substring("word", F.lit(1), low), F.substring(F.col("word"), F.length("word") - tail + 1, tail))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row of (word, n, tag, low, high) in the two halves of its interval."""
    middle = ((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    cut = rows.select("word", "n", "tag", F.explode(both).alias("i")).select("word", "n", "tag", "i.low", "i.high")
    return cut.withColumn("group", _group(F.col("tag"), F.col("low"), F.col("high")))


def candidate_groups(words: DataFrame, min_chars: int, group_words: int) -> DataFrame:
    """word, n, tag, low, high, group: every pair of words one edit apart is in a group whose interval holds the edit."""
    length = F.length("word")
    tags = F.when(length > min_chars, F.array(length - 1, length)).otherwise(F.array(length))
    rows = stored(_halves(words.select("word", "n", F.explode(tags).alias("tag")).select("word", "n", "tag", F.lit(0).alias("low"), (F.col("tag") + 1).alias("high"))))
    ready = []
    while True:
        sizes = stored(rows.groupBy("group").agg(F.count("*").alias("words"), F.max(F.col("high") - F.col("low")).alias("wide")).where(
            (F.col("words") > group_words) & (F.col("wide") > 1)))
        if sizes.isEmpty():
            break
        ready.append(join_skewed(rows, sizes, ["group"], "words", "left_anti"))
        rows = stored(_halves(join_skewed(rows, sizes, ["group"], "words", "left_semi")))
    for more in ready:
        rows = rows.unionByName(more)
    return rows


# --- bit-sliced position index -----------------------------------------------------------------------

def letter_matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the words, one word a row, 0 beyond its end; the words' lengths."""
    length = np.array([len(w) for w in words])
    out = np.zeros((len(words), int(length.max(initial=0)) + 2), dtype=np.uint8)
    out[np.arange(out.shape[1]) < length[:, None]] = np.frombuffer(b"".join(words), dtype=np.uint8)
    return out, length


def bitsets(codes: np.ndarray) -> np.ndarray:
    """Bitset over the words for each of 256 letters at one position; letter 0, beyond the end, has none."""
    rows = np.zeros((256, -(-len(codes) // 64) * 64), dtype=bool)
    rows[codes, np.arange(len(codes))] = True
    rows[0] = False
    return np.packbits(rows, axis=1, bitorder="little").view(np.uint64)


def one_edit(letters: np.ndarray, length: np.ndarray, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking word, word) where the word has one letter replaced or one letter more."""
    asking = asking[np.argsort(-length[asking], kind="stable")]
    own = length[asking]
    words = -(-len(letters) // 64)
    none = np.zeros((len(asking), words), dtype=np.uint64)  # words without an error so far
    none[:] = np.packbits(np.append(np.ones(len(letters), dtype=bool), np.zeros(words * 64 - len(letters), dtype=bool)), bitorder="little").view(np.uint64)
    replaced, longer = np.zeros_like(none), np.zeros_like(none)
    here = bitsets(letters[:, 0])
    for i in range(int(own.max(initial=0))):
        open_rows = int(np.searchsorted(-own, -i, side="left"))  # words that have a letter at i
        code = letters[asking[:open_rows], i]
        after = bitsets(letters[:, i + 1])
        same, shifted = here[code], after[code]
        clean = none[:open_rows]
        replaced[:open_rows] = (replaced[:open_rows] & same) | (clean & ~same)
        longer[:open_rows] = (longer[:open_rows] | clean) & shifted
        none[:open_rows] = clean & same
        here = after
    lengths = {int(m): np.packbits(np.append(length == m, np.zeros(words * 64 - len(letters), dtype=bool)), bitorder="little").view(np.uint64) for m in np.unique(np.append(own, own + 1))}
    for m in np.unique(own):
        rows = own == m
        replaced[rows] = (replaced[rows] & lengths[int(m)]) | ((longer[rows] | none[rows]) & lengths[int(m) + 1])
    q, w = np.nonzero(np.unpackbits(replaced.view(np.uint8), axis=1, bitorder="little"))
    return asking[q], w


def _pairs_of_block(word: list[bytes], n: np.ndarray, tag: np.ndarray, low: np.ndarray, high: np.ndarray, group: np.ndarray) -> pa.RecordBatch | None:
    letters, length = letter_matrix(word)
    a, b = one_edit(letters, length, np.flatnonzero(length == tag))
    kept = (group[a] == group[b]) & (tag[a] == tag[b])
    a, b = a[kept], b[kept]
    if not len(a):
        return None
    place = (letters[a] != letters[b]).argmax(axis=1)
    kept = (place >= low[a]) & (place < high[a])
    a, b = a[kept], b[kept]
    back = length[b] > length[a]  # equal lengths ask each other
    a, b = np.append(a, b[back]), np.append(b, a[back])
    text = pa.array([w.decode("latin-1") for w in word], pa.string())
    return pa.RecordBatch.from_arrays([text.take(pa.array(a)), text.take(pa.array(b)), pa.array(n[b])], names=["word", "near", "near_n"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of near words; rows come sorted by group and are taken in blocks of whole groups."""
    held: list[pa.RecordBatch] = []

    def searched(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = table.column("group").to_numpy()
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])[:len(group)])
        size = np.diff(np.append(starts, len(group)))
        alone = np.repeat(size == 1, size)
        table = table.filter(pa.array(~alone))
        if not table.num_rows:
            return
        n, tag, low, high, group = (table.column(c).to_numpy() for c in ("n", "tag", "low", "high", "group"))
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        at = 0
        while at < len(starts) - 1:
            stop = at + 1
            while stop < len(starts) - 1 and starts[stop + 1] - starts[at] <= BLOCK_WORDS and (starts[stop + 1] - starts[at]) * int(tag[starts[at]:starts[stop + 1]].max()) <= BLOCK_CELLS:
                stop += 1
            rows = slice(starts[at], starts[stop])
            found = _pairs_of_block(words[rows], n[rows], tag[rows], low[rows], high[rows], group[rows])
            if found is not None:
                yield found
            at = stop

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= 8 * BLOCK_WORDS:
            table = pa.Table.from_batches(held)
            group = table.column("group").to_numpy()
            last = int(np.flatnonzero(np.append(True, group[1:] != group[:-1]))[-1])  # the last group may go on
            if last:
                yield from searched(table.slice(0, last))
            held = table.slice(last).to_batches()
    if held:
        yield from searched(pa.Table.from_batches(held))


def near_words(words: DataFrame, min_chars: int = 7, group_words: int = 1024) -> DataFrame:
    """word, near, near_n: all ordered pairs of words one inserted, deleted or replaced character apart, each once."""
    rows = candidate_groups(words, min_chars, group_words)
    dealt = rows.repartition(partitions(words.sparkSession), "group").sortWithinPartitions("tag", "group")
    return dealt.mapInArrow(_near, "word string, near string, near_n long")


# --- forms and roots -----------------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """word, root of all words with a form, from the top downward: a level joins forms with the words above them."""
    found = level = stored(forms.join(forms.select(F.col("word").alias("form")), "form", "left_anti").select("word", F.col("form").alias("root")))
    while not level.isEmpty():
        level = stored(forms.join(level.select(F.col("word").alias("form"), "root"), "form").select("word", "root"))
        found = found.unionByName(level)
    return found


def group_variants(words: DataFrame, min_chars: int = 7, ratio: int = 10, group_words: int = 1024) -> DataFrame:
    """word, form, root, n, n_near, form_n: a word's form is its most frequent near word (ties: the smallest), if that
    is `ratio` times as frequent; its root is the last of the forms that follow, or the word itself."""
    words = stored(words.select("word", "n"))
    best = near_words(words, min_chars, group_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    told = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")))
    above = roots(told.where("form is not null").select("word", "form"))
    return told.join(above, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
