"""Registered queries of the training-data operators, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (
    bitslice, chaining, containment, heavylight, langid, linededup, packing, pii, suffixdedup, toxicity, urlfilter, variants, vectorcodes,
)
from lotwise.llm.common import crc_mod, join_skewed, stored, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the rows whose crc32 remainder is not 2."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.fit(docs, "text", "lang", "doc_id", ~held)
    return langid.identify(docs, "text", model, ["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_passage_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document shares with an earlier one at an identity of 0.8 or more."""
    found = chaining.passages(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumnRenamed("key", "doc_id").withColumnRenamed("source", "source_doc_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learned from the labels whose crc32 remainder is not 1."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, "text", "doc_id", labels, "doc_id", "toxic", crc_mod(F.col("key"), 3) != 1)
    return toxicity.score(docs, "text", machine, ["doc_id"]).select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_heavy_light_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return heavylight.jaccard_components(table(spark, sf_dir, "documents"), "doc_id", "text")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * i >= 90 * (u.n + v.n - i)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id AND r.c < e.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""


def op5_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every text when repeated 100-byte strings go."""
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")


def op6_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every vector whose id is divisible by 50 with all other vectors."""
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 50 == 0)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts and digest of the base kinds, and all spans."""
    found = pii.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    base = F.filter("findings", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(findings, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"), pii.span_text(F.col("findings")).alias("spans"))


def op8_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain at least 0.8 of a benchmark item's 5-word shingles, with the items."""
    found = containment.contained(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_common", "n_item")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), bs AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
    lambda i: array_to_string(w[i : i + least(len(w), 5) - 1], ' '))) AS s FROM b WHERE len(w) > 0
), ks AS (SELECT DISTINCT k FROM bs
), ds AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s
  FROM d, ks WHERE len(w) >= k
), n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, bs.item_id, count(*) AS n_common, any_value(n_item) AS n_item
FROM bs JOIN ds ON ds.k = bs.k AND ds.s = bs.s JOIN n ON n.item_id = bs.item_id
GROUP BY doc_id, bs.item_id HAVING count(*) >= 0.8 * any_value(n_item) - 1e-9
"""


OP9_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rules, else by naive Bayes over segmented host and path tokens."""
    return urlfilter.classify(table(spark, sf_dir, "pages"), "page_id", "url", OP9_RULES, "html")


def op10_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids, neighbours by BM25 together."""
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts with the form they are a variant of, and the root of their group."""
    words = variants.word_counts(table(spark, sf_dir, "documents"), "doc_id", "text", noise=31)
    return variants.group_variants(words)


# crc32 bit by bit: each byte is followed by seven zeros, one shift an element.
OP11_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]{7,}')) AS run
  FROM documents
), r AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM t GROUP BY doc_id, run
), c AS (
  SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(0, 4 * len(h)), lambda i:
      CASE WHEN i % 8 = 0 THEN CAST('0x' || h[i // 4 + 1 : i // 4 + 2] AS BIGINT) ELSE 0 END),
    lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1))), 4294967295) AS crc FROM r
), w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN crc % 31 = 0 THEN run[1 : crc % len(run)] || run[crc % len(run) + 2 : len(run)] ELSE run END AS word, n FROM c)
  WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), v AS MATERIALIZED (
  SELECT word, n, i, word[1 : i] || word[i + 2 : len(word)] AS less FROM (SELECT word, n, unnest(range(0, len(word))) AS i FROM w)
), p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM v a JOIN v b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT v.word, w.word, w.n FROM v JOIN w ON w.word = v.less
  UNION SELECT w.word, v.word, v.n FROM v JOIN w ON w.word = v.less
), b AS (SELECT word, count(*) AS n_near, max(near_n) AS best, arg_min(near, (-near_n, near)) AS near FROM p GROUP BY word
), f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= 10 * w.n THEN near END AS form, CASE WHEN best >= 10 * w.n THEN best END AS form_n
  FROM w LEFT JOIN b ON b.word = w.word
), u AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION ALL SELECT u.word, f.form FROM u JOIN f ON f.word = u.root WHERE f.form IS NOT NULL
), z AS (SELECT u.word, u.root FROM u JOIN f ON f.word = u.root WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(z.root, f.word) AS root, f.n, f.n_near, f.form_n FROM f LEFT JOIN z ON z.word = f.word
"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every text when lines that a smaller document holds go."""
    kept = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return kept.select(F.col("key").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH l AS (
  SELECT doc_id, line, place, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS place FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
), k AS (
  SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), j AS (SELECT l.*, k.first IS NOT NULL AND k.first <> doc_id AS gone FROM l LEFT JOIN k ON k.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors after four Lloyd rounds, with the error of each row and of its label."""
    codes = vectorcodes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", ["label"])
    rows = codes.rows.withColumn("group", F.struct("label"))  # a struct is never null: rows without a label are a group
    groups = stored(rows.groupBy("group").agg(F.sum("error").alias("label_error"), F.count("*").alias("members")))
    return join_skewed(rows, groups, ["group"], "members").select(
        F.col("key").alias("vec_id"), F.concat_ws("", F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0"))).alias("code"),
        "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def _op13_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Each round's assignment and new codebook as tables of their own; entries unroll into (part, entry, component list)."""
    steps = [f"""v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, part, e[part * (len(e) // {parts}) + 1 : (part + 1) * (len(e) // {parts})] AS x FROM v, (SELECT unnest(range({parts})) AS part)
), b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, p.part, any_value(p.x) AS x, min(struct_pack(d := CAST(list_inner_product(b.x, b.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(p.x, p.x) AS BIGINT), entry := b.entry)) AS best
  FROM p JOIN b{i} b ON b.part = p.part GROUP BY vec_id, p.part
)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT part, entry, list(floor(total / n) ORDER BY place) AS x FROM (
    SELECT part, best.entry AS entry, place, sum(x[place]) AS total, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS place) GROUP BY ALL) GROUP BY part, entry
), b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""WITH {', '.join(steps)}, c AS (
  SELECT vec_id, string_agg(lpad(lower(hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id
), h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c JOIN v ON v.vec_id = c.vec_id, h"""


def queries() -> dict[str, Query]:
    return {
        "op1_language_masks": op1_language_masks,
        "op2_passage_chains": op2_passage_chains,
        "op3_toxicity": op3_toxicity,
        "op4_heavy_light_join": op4_heavy_light_join,
        "op5_suffix_runs": op5_suffix_runs,
        "op6_bit_sliced_top_k": op6_bit_sliced_top_k,
        "op7_pii": op7_pii,
        "op8_benchmark_containment": op8_benchmark_containment,
        "op9_url_filter": op9_url_filter,
        "op10_retrieval_packing": op10_retrieval_packing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_line_dedup": op12_line_dedup,
        "op13_vector_codes": op13_vector_codes,
    }


def oracles() -> dict[str, str]:
    return {
        "op4_heavy_light_join": OP4_SQL,
        "op6_bit_sliced_top_k": OP6_SQL,
        "op8_benchmark_containment": OP8_SQL,
        "op11_spelling_variants": OP11_SQL,
        "op12_line_dedup": OP12_SQL,
        "op13_vector_codes": _op13_sql(),
    }
