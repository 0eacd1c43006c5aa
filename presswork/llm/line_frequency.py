"""Quality rules with the frequency of lines across documents.

Lines are normalised (A-Z and other letters lower-cased, white space collapsed) and
hashed. For each host, the distinct texts that hold a line are counted; a line above the
host's limit is boilerplate and is removed from that host's documents; a document that
loses more than it keeps is depleted and rejected, as is one that fails the rules on
single texts. Copies of one text count once, so that a copied article is not taken for
boilerplate (copies are the business of de-duplication).

One pass reads the texts and leaves a slim table of numbers and line hashes. Counts are
pre-aggregated. Removal joins lines with the frequent lines by host, hash and a salt, so
that neither a host nor a line with a third of all rows meets in one task.

Defined cases: a null text has no words and fails; a null host is a host of its own; rows
with equal or null ids are judged one by one; lines without a word are no lines; other
columns pass through, those with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SHARE = 0.01  # of a host's distinct texts that may hold a line
MIN_DOCS = 10  # a line that fewer texts of a host hold is never frequent
LEAST_LEFT = 0.5  # of a document's words, else it is depleted
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
SALT = 16
MEASURES = "n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint"


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    size = len(numbers)
    pair = np.unique(code[:-1] * size + code[1:], return_inverse=True)[1]
    _, window, counts = np.unique(pair[:-1] * size + code[2:], return_inverse=True, return_counts=True)
    often = counts[window] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(often)] |= often
    return int(inside.sum())


def measure(text: bytes) -> tuple[list[int], list[int], list[int]]:
    """Measures of one text; hashes of its distinct lines and the words of each in total."""
    import xxhash

    words = text.split()
    seen, dup, lines = set(), 0, {}
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        dup += line in seen
        seen.add(line)
        key = xxhash.xxh3_64_intdigest(b" ".join(line.decode().lower().encode().split()))
        lines[key] = lines.get(key, 0) + len(parts)
    chars = len(text.decode()) - sum(text.count(WHITE[i : i + 1]) for i in range(len(WHITE)))
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    return [len(words), chars, symbols, dup, repeated_words(words)], list(lines), list(lines.values())


def measured(text: Column) -> Column:
    """Struct of the measures, ``lines`` and ``line_words`` of a text column."""

    @F.arrow_udf(f"struct<{MEASURES},lines:array<bigint>,line_words:array<int>>")
    def of(texts: pa.Array) -> pa.Array:
        rows = [measure(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        names = [x.split(":")[0] for x in MEASURES.split(",")]
        numbers = np.array([r[0] for r in rows], dtype=np.int64).reshape(-1, len(names))
        ends = np.cumsum([0, *(len(r[1]) for r in rows)]).astype(np.int32)
        keys = np.array([k for r in rows for k in r[1]], dtype=np.uint64).astype(np.int64)
        counts = np.array([n for r in rows for n in r[2]], dtype=np.int32)
        listed = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (keys, counts)]
        return pa.StructArray.from_arrays([*map(pa.array, numbers.T.copy()), *listed], names=[*names, "lines", "line_words"])

    return of(text)


def frequent_lines(stats: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS) -> DataFrame:
    """``host, line`` of lines above their host's limit, of ``host, content, lines`` rows."""
    once = stats.groupBy("host", "content").agg(F.first("lines").alias("lines"))
    limits = once.groupBy("host").agg(F.greatest(F.lit(min_docs), F.ceil(F.count(F.lit(1)) * max_share)).alias("limit"))
    counts = once.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    candidates = counts.filter(F.col("n") >= min_docs)
    return candidates.join(limits, "host").filter("n >= limit").select("host", "line")


def judge(
    docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, least_left: float = LEAST_LEFT, text: str = "text", host: str = "source"
) -> DataFrame:
    """``docs`` without ``text``, with the measures, ``words_left``, ``base_failed`` and ``kept``."""
    names = [x.split(":")[0] for x in MEASURES.split(",")]
    results = [*names, "words_left", "base_failed", "kept", "host", "content", "lines", "line_words", "row"]
    own = [c for c in docs.columns if c not in (text, *results)]
    # A host's name never equals the mark of the missing one.
    name = F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))
    stats = docs.select(*own, name.alias("host"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"), measured(F.col(text)).alias("m"))
    stats = stats.select(*own, "host", "content", "m.*").withColumn("row", F.monotonically_increasing_id())
    stats = materialize(stats, "measures")
    frequent = frequent_lines(stats, max_share, min_docs)
    salted = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    lines = stats.select("row", "host", F.pmod("row", F.lit(SALT)).cast("int").alias("salt"), F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    lines = lines.select("row", "host", "salt", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    removed = lines.join(salted, ["host", "line", "salt"]).groupBy("row").agg(F.sum("words").alias("removed"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        stats.join(removed, "row", "left")
        .withColumns({"words_left": left, "base_failed": failed, "kept": ~failed & (left >= least_left * F.col("n_words"))})
        .select(*own, *names, "words_left", "base_failed", "kept")
    )


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


WORD = r"[^\x20\x09-\x0D]+"
OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM d),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM split),
windows AS (
  SELECT r, p, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
often AS (SELECT r, p, count(*) OVER (PARTITION BY r, three) AS n FROM windows WHERE three IS NOT NULL),
repeated AS (SELECT r, count(DISTINCT p + k)::BIGINT AS n FROM often, range(3) AS t(k) WHERE often.n > 1 GROUP BY r),
words AS (SELECT r, count(*)::BIGINT AS n, sum(length(word))::BIGINT AS chars FROM w GROUP BY r),
split_lines AS (SELECT r, source, text, string_split(text, chr(10)) AS ls FROM d),
lines AS (SELECT r, source, text, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM split_lines),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY r, line ORDER BY p) > 1 AS dup,
    list_aggregate(regexp_extract_all(lower(line), '{WORD}'), 'string_agg', ' ') AS key, len(regexp_extract_all(line, '{WORD}')) AS n
  FROM lines WHERE regexp_matches(line, '{WORD}')),
dups AS (SELECT r, count(*) FILTER (dup) AS n FROM worded GROUP BY r),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
frequent AS (
  SELECT f.source, key FROM (SELECT source, key, count(DISTINCT text) AS n FROM worded GROUP BY source, key) f
  JOIN hosts ON f.source IS NOT DISTINCT FROM hosts.source WHERE f.n >= greatest({MIN_DOCS}, ceil(hosts.n * {MAX_SHARE}))),
removed AS (SELECT r, sum(n) AS n FROM worded JOIN frequent f ON worded.key = f.key AND worded.source IS NOT DISTINCT FROM f.source GROUP BY r),
m AS (
  SELECT doc_id, coalesce(words.n, 0) AS n_words, coalesce(words.chars, 0) AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
    (coalesce(words.n, 0) - coalesce(removed.n, 0))::BIGINT AS words_left
  FROM d LEFT JOIN words USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND words_left >= {LEAST_LEFT} * n_words AS kept FROM b
"""

QUERIES = {"op3_line_frequency": op3_line_frequency}
ORACLES = {"op3_line_frequency": OP3_SQL}
