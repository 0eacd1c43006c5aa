"""Line de-duplication over a whole corpus.

Every line becomes a 128-bit key. The keys are range-partitioned, sorted by key,
document and position, and streamed: a run of equal keys is decided as it passes by.
Since the range also covers document and position, a line that a third of the corpus
holds is spread over many partitions; the few runs that cross an Arrow batch or a
partition leave a one-row summary, and their rows are decided by a join with the
summed summaries. The result is one compressed bitmap of kept lines per touched
document; texts are only joined with their own bitmap at the end.

Defined cases: a null or empty text is one empty line; lines whose key has fewer than
``min_chars`` code points are always kept; rows with one id and one text are one
document here and all get the same result; a null id is an id of its own; other
columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import table, unused

NO_ID = -(2**63)
LINE = "k1 long, k2 long, doc long, content long, pos int, n_lines int"
DECIDED = "doc long, content long, pos int, n_lines int, state int, k1 long, k2 long, part int, n_docs long, first_doc long, last_doc long, from_pos int"
DROP, OPEN, SUMMARY = 0, 1, 2
SALT = 32


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Id, content hash and text of each document; the first two name it in all steps."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(whole).alias("content"),
        whole.alias("whole"),
    )


def line_keys(docs: DataFrame, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per line with a key: 128-bit hash of the stripped line with A-Z lower-cased."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            doc, content = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            digests, places, counts, lines_of = [], [], [], []
            for whole in batch.column(2).cast(pa.binary()).to_pylist():
                lines = whole.split(b"\n")
                before = len(places)
                for i, line in enumerate(lines):
                    key = line.strip().lower()
                    if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        places.append(i)
                counts.append(len(places) - before)
                lines_of.append(len(lines))
            both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                    pa.array(np.repeat(doc, counts)),
                    pa.array(np.repeat(content, counts)),
                    pa.array(np.array(places, dtype=np.int32)),
                    pa.array(np.repeat(np.array(lines_of, dtype=np.int32), counts)),
                ],
                names=["k1", "k2", "doc", "content", "pos", "n_lines"],
            )

    return keyed(docs, text, doc_id).mapInArrow(keys, LINE)


class _Run:
    """What is known of the run of one key so far, within one partition."""

    def __init__(self, key: tuple[int, int], doc: int, pos: int):
        self.key, self.n_docs, self.first, self.last, self.pos = key, 0, doc, None, pos

    def add(self, docs: np.ndarray) -> None:
        fresh = 1 + int(np.count_nonzero(docs[1:] != docs[:-1]))
        self.n_docs += fresh - (self.last is not None and self.last == docs[0])
        self.last = int(docs[-1])


def _stream(min_docs: int, keep_first: bool):
    """Decide the runs of a sorted partition; rows of cut runs stay open."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, open_run = TaskContext.get().partitionId(), None

        def summary(run: _Run):
            none = np.array([0])
            return _decided(none, none, none, none, SUMMARY, *run.key, part, run.n_docs, run.first, run.last, run.pos)

        for batch in batches:
            k1, k2, doc, content, pos, lines = (batch.column(i).to_numpy() for i in range(6))
            if not len(k1):
                continue
            new = np.ones(len(k1), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(k1))
            # The first and the last run of a batch may go on beyond it.
            for i in sorted({0, len(starts) - 1}):
                a, b = starts[i], ends[i]
                key = (int(k1[a]), int(k2[a]))
                if open_run is None or open_run.key != key:
                    if open_run is not None:
                        yield summary(open_run)
                    open_run = _Run(key, int(doc[a]), int(pos[a]))
                open_run.add(doc[a:b])
                yield _decided(doc[a:b], content[a:b], pos[a:b], lines[a:b], OPEN, *key, part)
            if len(starts) < 3:
                continue
            inner = slice(starts[1], starts[-1])
            other = new.copy()
            other[1:] |= doc[1:] != doc[:-1]
            run = np.cumsum(new[inner]) - 1
            n_docs = np.bincount(run, weights=other[inner]).astype(np.int64)
            drop = n_docs[run] >= min_docs
            if keep_first:
                drop &= ~new[inner]
            yield _decided(*(x[inner][drop] for x in (doc, content, pos, lines)), DROP, 0, 0, part)
        if open_run is not None:
            yield summary(open_run)

    return decide


def _decided(doc, content, pos, lines, state, k1, k2, part, n_docs=0, first=0, last=0, from_pos=0):
    n = len(doc)
    full = lambda x, kind: pa.array(np.full(n, x, dtype=kind))
    as_is = lambda x, kind: pa.array(np.asarray(x).astype(kind))
    columns = [
        as_is(doc, np.int64), as_is(content, np.int64), as_is(pos, np.int32), as_is(lines, np.int32),
        full(state, np.int32), full(k1, np.int64), full(k2, np.int64), full(part, np.int32),
        full(n_docs, np.int64), full(first, np.int64), full(last, np.int64), full(from_pos, np.int32),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in DECIDED.split(", ")])


def dropped_lines(lines: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """Rows of ``line_keys`` to drop: those of keys in at least ``min_docs`` documents.

    With ``keep_first`` the first line of a key, by document and position, stays.
    """
    order = ["k1", "k2", "doc", "pos", "content"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    decided = materialize(ranged.mapInArrow(_stream(min_docs, keep_first), DECIDED), "runs")
    final = decided.filter(F.col("state") == DROP).select("doc", "content", "pos", "n_lines")
    # A key leaves at most one summary per partition; a document on a border counts once.
    summaries = decided.filter(F.col("state") == SUMMARY)
    totals = (
        summaries.groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_list(F.struct("part", "n_docs", "first_doc", "last_doc", "from_pos"))).alias("parts"))
        .select(
            "k1",
            "k2",
            F.expr(
                "aggregate(parts, 0L, (n, x) -> n + x.n_docs)"
                " - aggregate(sequence(1, greatest(size(parts) - 1, 1)), 0L, (n, i) ->"
                " n + IF(i < size(parts) AND parts[i - 1].last_doc = parts[i].first_doc, 1L, 0L))"
            ).alias("total"),
            F.expr("parts[0].first_doc").alias("opening_doc"),
            F.expr("parts[0].from_pos").alias("opening_pos"),
        )
        .filter(F.col("total") >= min_docs)
    )
    pending = decided.filter(F.col("state") == OPEN).select("k1", "k2", "doc", "content", "pos", "n_lines")
    # A line that a third of the corpus holds meets its total in several tasks.
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    found = pending.withColumn("salt", F.pmod(F.xxhash64("doc", "pos"), F.lit(SALT)).cast("int")).join(salted, ["k1", "k2", "salt"])
    if keep_first:
        found = found.filter((F.col("doc") != F.col("opening_doc")) | (F.col("pos") != F.col("opening_pos")))
    return final.unionByName(found.select("doc", "content", "pos", "n_lines"))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """One row per touched document: ``n_dropped`` and the zlib-compressed bitmap of kept lines."""

    @F.pandas_udf("binary")
    def bitmap(positions: pd.Series, n_lines: pd.Series) -> pd.Series:
        def one(places, n):
            keep = np.ones(n, bool)
            keep[np.asarray(places, dtype=np.int64)] = False
            return zlib.compress(np.packbits(keep).tobytes())

        return pd.Series([one(p, n) for p, n in zip(positions, n_lines, strict=True)], dtype=object)

    gone = dropped.groupBy("doc", "content", "n_lines").agg(F.collect_set("pos").alias("gone"))
    return gone.select("doc", "content", F.size("gone").cast("long").alias("n_dropped"), bitmap("gone", "n_lines").alias("keep_bits"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id", counts: bool = True) -> DataFrame:
    """``docs`` with only the kept lines in ``text``, and ``n_lines`` and ``n_dropped`` added.

    Columns of these two names that ``docs`` already has are replaced; without ``counts``
    nothing is added and all columns stay.
    """

    @F.pandas_udf("string")
    def kept(texts: pd.Series, bits: pd.Series) -> pd.Series:
        def one(whole, packed):
            if packed is None:
                return None
            lines = whole.split("\n")
            keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=len(lines))
            return "\n".join([x for x, k in zip(lines, keep, strict=True) if k])

        return pd.Series([one(w, b) for w, b in zip(texts, bits, strict=True)], dtype=object)

    whole = F.coalesce(F.col(text), F.lit(""))
    doc, content, gone, bits = (unused(docs, name) for name in ("doc", "content", "gone", "bits"))
    plain = docs.drop("n_lines", "n_dropped") if counts else docs
    left = plain.withColumns({doc: F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), content: F.xxhash64(whole)})
    right = bitmaps.select(F.col("doc").alias(doc), F.col("content").alias(content), F.col("n_dropped").alias(gone), F.col("keep_bits").alias(bits))
    both = left.join(right, [doc, content], "left")
    newlines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit("")))
    results = {text: F.when(F.col(bits).isNull(), F.col(text)).otherwise(kept(F.when(F.col(bits).isNotNull(), whole), F.col(bits)))}
    if counts:
        results |= {"n_lines": (newlines + 1).cast("long"), "n_dropped": F.coalesce(F.col(gone), F.lit(0).cast("long"))}
    return both.withColumns(results).drop(doc, content, gone, bits)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, counts: bool = True) -> DataFrame:
    """Documents without the lines that at least ``min_docs`` documents hold."""
    lines = materialize(line_keys(docs, min_chars), "lines")
    return apply_bitmaps(docs, keep_bitmaps(dropped_lines(lines, min_docs, keep_first)), counts=counts)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP6_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, {SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 10),
kept AS (
  SELECT r, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '') AS text
  FROM keyed LEFT JOIN frequent f ON keyed.key = f.key GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept.text) AS kept_sha256 FROM docs JOIN kept USING (r)
"""

QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLES = {"op6_line_dedup": OP6_SQL}
