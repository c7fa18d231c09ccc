"""URL filter: rules first, then naive Bayes over segmented host and path tokens.

Host labels are cut at non-alphanumeric characters and each part is split into words by a unigram Viterbi search; word
counts come from all page texts, all URL parts and the seed words. The classifier is multinomial naive Bayes over the
words of the host and the tokens of the path (digits become #), hashed to `2 ** bits` buckets, which bounds the model
whatever the vocabulary. Its training labels are the pages themselves: a page counts as blocked if its segmented host
holds a seed word, else as allowed; what co-occurs with seeds is learned from there.

Only distinct host parts meet the word counts, each by its own substrings of at most MAX_WORD characters, so the
dictionary is never collected.

Defined cases: a null url or one without :// has empty host and path, no tokens, and the verdict of the class sizes
alone; the longest fitting rule wins, then the smaller text; a part without known words stays whole; without any
blocked or any allowed page every method verdict is allow. Input columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import small_batches

MAX_WORD = 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words that mark a host as unwanted.
SEEDS = ("adult", "ads", "bets", "casino", "gambling", "pills", "porn", "spam", "xxx")
# (verdict, host, path): fits the host and all its subdomains.
Rule = tuple[str, str, str]


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(after_scheme(url), r"^[^/?#]*", ""), r"^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, on, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == on) | F.endswith(host, F.lit(f".{on}"))) & F.startswith(path, F.lit(prefix))
        text = F.when(fits, F.lit(on + prefix)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def parts_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda p: p != "")


def viterbi(part: str, counts: dict[str, int], total: float) -> list[str]:
    """Most likely words; an unknown run of n characters costs as much as 10 / (total * 10**n)."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(part) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            word = part[start:end]
            n = counts.get(word)
            cost = math.log(n / total) if n else math.log(10 / total) - (end - start) * math.log(10)
            options.append((best[start][0] + cost, start))
        best.append(max(options))
    words, end = [], len(part)
    while end:
        words.append(part[best[end][1]:end])
        end = best[end][1]
    return words[::-1]


def word_counts(pages: DataFrame, html: str | None, hosts: DataFrame, paths: Column, seeds: Sequence[str]) -> DataFrame:
    """(word, n) over page texts, URL parts and seeds."""
    texts = [hosts.select(F.explode(parts_of(F.col("host"))).alias("word"), F.col("n")),
             pages.select(F.explode(parts_of(F.lower(paths))).alias("word"), F.lit(1).cast("long").alias("n"))]
    if html is not None:
        plain = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"<[^>]*+>", " ")
        texts.append(pages.select(F.explode(F.split(F.lower(plain), r"[^\p{L}]+")).alias("word"), F.lit(1).cast("long").alias("n")))
    spark = pages.sparkSession
    texts.append(spark.createDataFrame([(s, 1000) for s in seeds], "word string, n long"))
    every = texts[0]
    for more in texts[1:]:
        every = every.unionByName(more)
    return every.where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) of distinct hosts; each distinct part is segmented once."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    parts = hosts.select("host", F.posexplode(parts_of(F.col("host"))).alias("place", "part"))
    substrings = parts.select("part").distinct().select("part", F.explode(F.expr(f"""flatten(transform(sequence(1, length(part)),
        i -> transform(sequence(1, least({MAX_WORD}, length(part) - i + 1)), k -> substr(part, i, k))))""")).alias("word"))
    known = substrings.distinct().join(counts, "word").groupBy("part").agg(
        F.collect_list(F.struct("word", "n")).alias("known"))  # at most MAX_WORD entries a character of the part

    @F.pandas_udf("array<string>")
    def split(part: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([viterbi(p, {w["word"]: w["n"] for w in k}, total) if k is not None else [p] for p, k in zip(part, known, strict=True)])

    words = parts.join(known, "part", "left").select("host", "place", split("part", "known").alias("words"))
    return words.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda x: x["words"])).alias("words"))


def classify(
    pages: DataFrame, key: str, url: str, rules: Sequence[Rule], html: str | None = None, seeds: Sequence[str] = SEEDS, bits: int = 16,
) -> DataFrame:
    """key, host, path, rule, verdict and block_score of every page."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"))
    counts = word_counts(pages, html, hosts, F.coalesce(path_of(F.col(url)), F.lit("")), seeds)
    segmented = segment_hosts(hosts, counts)
    bucket = lambda kind: lambda t: F.pmod(F.xxhash64(F.lit(kind), t), F.lit(1 << bits)).cast("int")
    digits = F.transform(parts_of(F.lower("path")), lambda t: F.regexp_replace(t, r"[0-9]+", "#"))
    joined = rows.join(segmented, "host", "left").select(
        "key", "host", "path", F.coalesce(F.exists("words", lambda w: w.isin(*seeds)), F.lit(False)).alias("seeded"),
        F.concat(F.coalesce(F.transform("words", bucket("host")), F.array().cast("array<int>")), F.transform(digits, bucket("path"))).alias("tokens"))
    sizes = joined.agg(F.count("*"), F.coalesce(F.sum(F.col("seeded").cast("int")), F.lit(0))).first()
    table = joined.select("seeded", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum(F.col("seeded").cast("long")).alias("bad"), F.count("*").alias("every")).toPandas()  # at most 2**bits rows
    bad, good = np.zeros(1 << bits), np.zeros(1 << bits)
    bad[table["token"].to_numpy(dtype=int)] = table["bad"]
    good[table["token"].to_numpy(dtype=int)] = table["every"] - table["bad"]
    both = 0 < sizes[1] < sizes[0]
    used = max(1, len(table))
    odds = np.log((bad + 1) / (bad.sum() + used)) - np.log((good + 1) / (good.sum() + used))
    prior = math.log(sizes[1] / (sizes[0] - sizes[1])) if both else -30.0
    shared = pages.sparkSession.sparkContext.broadcast(odds if both else np.zeros(1 << bits))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(3)
            length = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), length)
            margin = prior + np.bincount(row, shared.value[tokens.flatten().to_numpy()], batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))], names=["key", "host", "path", "block_score"])

    kind = rows.schema["key"].dataType.simpleString()
    judged = joined.select("key", "host", "path", "tokens").mapInArrow(judge, f"key {kind}, host string, path string, block_score double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return judged.select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("block_score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "block_score")
