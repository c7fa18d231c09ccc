"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Everything is a column expression. `split` and `regexp_extract_all` with one pattern give the text between the matches
and the matches; their running lengths are the code-point positions. Repetitions are bounded or possessive and starts
are anchored to the first character of a run, so long runs cost linear time and no deep recursion.

Kinds: email, ip (four numbers up to 255), card (13 to 19 digits, Luhn) and phone (+, 9 to 15 digits) are always kept;
iban (mod 97) and ssn are kept if their score reaches `threshold`. A span starts from its kind's prior; a confirmed
checksum and a context word among the `CONTEXT_CHARS` characters before it raise the score.

Defined cases: null text has no spans; positions are code points, ends exclusive; spans of one kind do not overlap,
spans of different kinds may. Input columns other than the text are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# A cheap test that every match of the pattern passes.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]-[0-9]{2}-[0-9]"}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.7, "iban": 0.2, "ssn": 0.3}
CONFIRMED = {"card": 0.4, "iban": 0.5}
CONTEXT = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|server|host", "card": "card|visa|credit|payment", "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta", "ssn": "ssn|social|security|insurance",
}
CONTEXT_BONUS = 0.3
BLOCK = 128


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _luhn(digits: str) -> str:
    one = f"cast(substr({digits}, -i, 1) as int)"
    return (f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + if(i % 2 = 1, {one}, {one} * 2 - if({one} > 4, 9, 0))) % 10 = 0")


def _mod97(code: str) -> str:
    moved = f"concat(substr({code}, 5), substr({code}, 1, 4))"
    return (f"aggregate(transform(sequence(1, length({code})), i -> ascii(substr({moved}, i, 1))), 0, "
            "(a, c) -> if(c >= 65, (a * 100 + c - 55) % 97, (a * 10 + c - 48) % 97)) = 1")


CHECKS = {
    "email": "true",
    "ip": "forall(split(s.m, '[.]'), p -> p rlike '^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})$')",
    "card": _luhn("regexp_replace(s.m, '[^0-9]', '')"),
    "phone": "length(regexp_replace(s.m, '[^0-9]', '')) between 9 and 15",
    "iban": _mod97("replace(s.m, ' ', '')"),
    "ssn": "not (s.m rlike '^(000|666|9)|-00-|-0000$')",
}


def _places(df: DataFrame, kind: str) -> DataFrame:
    """Adds the gaps, the hits and the ends of the hits of one kind; running sums in blocks keep long lists linear."""
    pattern, hint = PATTERNS[kind], HINTS[kind]
    seen = F.contains("text", F.lit(hint)) if kind == "email" else F.col("text").rlike(hint)
    df = df.withColumn("hits", F.when(seen, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn("gaps", F.when(F.size("hits") > 0, F.split("text", pattern, -1)))
    df = df.withColumn("steps", F.when(F.size("hits") > 0, F.expr(f"""transform(
        sequence(0, (size(hits) - 1) div {BLOCK}),
        b -> transform(slice(hits, b * {BLOCK} + 1, {BLOCK}), (h, j) -> cast(length(gaps[b * {BLOCK} + j]) + length(h) as bigint)))""")))
    df = df.withColumn("begins", F.expr("""aggregate(steps, array(0L), (a, c) -> concat(a, array(
        element_at(a, -1) + aggregate(c, 0L, (t, x) -> t + x))))"""))
    return df.withColumn("ends", F.expr(
        "flatten(transform(steps, (c, b) -> transform(c, (x, j) -> begins[b] + aggregate(slice(c, 1, j + 1), 0L, (t, y) -> t + y))))"))


def _findings(kind: str) -> tuple[Column, str]:
    """Confirmed spans of one kind in order, each with its score; an empty array without any."""
    spans = F.expr("""transform(hits, (m, i) -> named_struct(
        'm', m, 'start', ends[i] - length(m), 'end', ends[i], 'before', lower(right(gaps[i], %d))))""" % CONTEXT_CHARS)
    score = (f"least(1.0D, {PRIOR[kind] + CONFIRMED.get(kind, 0.0)}D + if(s.before rlike {_literal(CONTEXT[kind])}, {CONTEXT_BONUS}D, 0.0D))")
    return spans, (f"coalesce(transform(filter(spans, s -> {CHECKS[kind]}), "
                   f"s -> named_struct('kind', '{kind}', 'start', s.start, 'end', s.end, 'score', {score})), "
                   "cast(array() as array<struct<kind:string,start:bigint,end:bigint,score:double>>))")


def scan(df: DataFrame, text: str, threshold: float = 0.5, out: str = "findings") -> DataFrame:
    """df with the array column `out` of (kind, start, end, score): by kind as in KINDS, then by start."""
    current = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    for kind in KINDS:
        spans, confirmed = _findings(kind)
        current = _places(current, kind).withColumn("spans", spans).withColumn(f"of_{kind}", F.expr(confirmed)).select(
            "row", "text", *[f"of_{k}" for k in KINDS[:KINDS.index(kind) + 1]])
    found = F.concat(*[F.col(f"of_{k}") for k in BASE_KINDS], *[
        F.filter(f"of_{k}", lambda s: s["score"] >= threshold) for k in KINDS if k not in BASE_KINDS])
    return current.select("row.*", found.alias(out))


def span_text(findings: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str, threshold: float = 0.5) -> DataFrame:
    """df with every kept span of the text replaced by its kind in brackets; overlapping spans are replaced together.

    Null text stays null. The first kind, in order of start, names a replaced stretch.
    """
    names = df.columns
    found = scan(df.select(F.struct("*").alias("whole"), F.col(text).alias("body")), "body", threshold, "found")
    merged = F.expr("""aggregate(
        array_sort(transform(found, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind))),
        cast(array() as array<struct<start:bigint,end:bigint,kind:string>>),
        (a, s) -> if(size(a) > 0 and s.start < element_at(a, -1).end,
            concat(slice(a, 1, size(a) - 1), array(named_struct(
                'start', element_at(a, -1).start, 'end', greatest(s.end, element_at(a, -1).end), 'kind', element_at(a, -1).kind))),
            concat(a, array(s))))""")
    parts = F.expr("""concat(
        transform(merged, (s, i) -> concat(
            substr(body, cast(if(i = 0, 0L, merged[i - 1].end) + 1 as int), cast(s.start - if(i = 0, 0L, merged[i - 1].end) as int)),
            '[', upper(s.kind), ']')),
        array(substr(body, cast(element_at(merged, -1).end + 1 as int))))""")
    done = found.withColumn("merged", F.when(F.size("found") > 0, merged)).withColumn(
        "body", F.when(F.size("merged") > 0, F.array_join(parts, "")).otherwise(F.col("body")))
    return done.select(*[F.col("body").alias(n) if n == text else F.col("whole")[n].alias(n) for n in names])
