"""Licence scan by canonical digests.

A text is brought into canonical form: lower case, no copyright lines, punctuation and
white space as single spaces, equivalent spellings as one. Its digest is joined with the
digests of known licences, so only entire texts match. Lines that are entire notices are
found in the same way. All of it is built-in expressions: one scan leaves a slim table of
digests, and the joins see digests only.

The known licences are a table ``licence, text, notice`` of any size, canonised by the
same expressions; small tables are broadcast by Spark's own size check.

Defined cases: a null text counts as empty; a text with nothing left has no digest and
matches nothing; with several licences of one digest the first by name counts; each row
is matched by itself, so null or repeated ids do not matter; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.functions.binding import let
from presswork.llm.common import table
from presswork.llm.licence_texts import NOTICES, SPELLINGS, TEXTS

COPYRIGHT_LINE = r"^[^\p{L}\p{N}(©]*(copyright|\(c\)|©)"
NOT_WORD = r"[^\p{L}\p{N}]+"


def known_licences(spark: SparkSession) -> DataFrame:
    rows = [(name, text, False) for name, text in TEXTS] + [(name, text, True) for name, text in NOTICES]
    return spark.createDataFrame(rows, "licence string, text string, notice boolean")


def canonical_lines(text: Column) -> Column:
    """Lines in canonical form but for spellings; copyright lines and empty ones are gone."""
    lines = F.split(F.lower(F.coalesce(text, F.lit(""))), "\n", -1)
    kept = F.filter(lines, lambda x: ~F.regexp_like(x, F.lit(COPYRIGHT_LINE)))
    return F.filter(F.transform(kept, lambda x: F.trim(F.regexp_replace(x, NOT_WORD, " "))), lambda x: x != "")


def spelled(words: Column) -> Column:
    """Canonical spellings of a text of words with single spaces between them."""
    # A space of its own on both sides of every word lets neighbours match one by one.
    out = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for seen, canonical in SPELLINGS:
        wide = lambda x: f" {x.replace(' ', '  ')} "
        out = F.replace(out, F.lit(wide(seen)), F.lit(wide(canonical)))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def digest(words: Column) -> Column:
    """128-bit digest of canonical words, null for none."""
    return F.when(words != "", F.md5(spelled(words).cast("binary")))


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``row, doc_id, digest, notices`` (distinct digests of lines) of every document."""
    lines = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("lines"))
    both = let(F.col("lines"), lambda x: F.struct(digest(F.array_join(x, " ")).alias("digest"), F.array_distinct(F.transform(x, digest)).alias("notices")))
    return lines.select(F.monotonically_increasing_id().alias("row"), "doc_id", both.alias("d")).select("row", "doc_id", "d.*")


def scan(docs: DataFrame, known: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, the text's ``digest`` and ``licence``, and the ``notices`` in its lines, comma-joined."""
    known = known_licences(docs.sparkSession) if known is None else known
    own = known.select("licence", "notice", digest(F.array_join(canonical_lines(F.col("text")), " ")).alias("digest")).filter("digest IS NOT NULL")
    whole = own.groupBy("digest").agg(F.min("licence").alias("licence"))
    notices = own.filter("notice").groupBy("digest").agg(F.min("licence").alias("licence"))
    rows = materialize(digests(docs, text, doc_id), "digests")
    hits = rows.select("row", F.explode("notices").alias("digest")).join(notices, "digest")
    by_row = hits.groupBy("row").agg(F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("notices"))
    found = rows.drop("notices").join(whole, "digest", "left").join(by_row, "row", "left")
    return found.select("doc_id", "digest", "licence", F.coalesce("notices", F.lit("")).alias("notices"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql() -> str:
    def canonical(lines: str) -> str:
        out = f"(' ' || replace(array_to_string({lines}, ' '), ' ', '  ') || ' ')"
        for seen, good in SPELLINGS:
            a, b = (f" {x.replace(' ', '  ')} " for x in (seen, good))
            out = f"replace({out}, '{a}', '{b}')"
        return f"md5(nullif(trim(replace({out}, '  ', ' ')), ''))"

    lines = (
        "list_filter(list_transform(list_filter(string_split(lower(coalesce(text, '')), chr(10)),"
        rf" lambda x: NOT regexp_matches(x, '{COPYRIGHT_LINE}')), lambda x: trim(regexp_replace(x, '{NOT_WORD}', ' ', 'g'))), lambda x: x <> '')"
    )
    known = ", ".join(f"({_quoted(n)}, {_quoted(t)}, {notice})" for rows, notice in ((TEXTS, "false"), (NOTICES, "true")) for n, t in rows)
    return f"""
WITH known AS (
  SELECT licence, notice, {canonical("ls")} AS digest
  FROM (SELECT licence, notice, {lines} AS ls FROM (VALUES {known}) AS v(licence, text, notice))),
d AS (SELECT row_number() OVER () AS r, doc_id, {lines} AS ls FROM documents),
whole AS (SELECT digest, min(licence) AS licence FROM known GROUP BY digest),
notices AS (SELECT digest, min(licence) AS licence FROM known WHERE notice GROUP BY digest),
by_line AS (SELECT r, {canonical("[line]")} AS digest FROM (SELECT r, unnest(ls) AS line FROM d)),
found AS (SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices FROM by_line JOIN notices USING (digest) GROUP BY r)
SELECT doc_id, x.digest, whole.licence, coalesce(found.notices, '') AS notices
FROM (SELECT r, doc_id, {canonical("ls")} AS digest FROM d) x LEFT JOIN whole USING (digest) LEFT JOIN found USING (r)
"""


QUERIES = {"op7_licences": op7_licences}
ORACLES = {"op7_licences": _sql()}
