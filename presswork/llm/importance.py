"""Importance resampling towards a target distribution, over hashed runs of words.

A text's features are its runs of one to three words; a feature's bucket is the CRC-32 of
its bytes modulo the number of buckets. Source and target are counted per bucket, and a
bucket's gain is the logarithm of their smoothed ratio. A document weighs the sum of its
features' gains; Gumbel noise, seeded by the document's id, makes the highest scores a
sample without replacement.

CRCs are worked out in length buckets: the distinct features of a slice of texts that have
equal length are rows of one two-dimensional uint8 array, all their CRCs go on column by
column, and the results are scattered back to the places where the features occur. A
feature of more than ``LONGEST`` bytes (a word without end) goes through zlib instead, as
there a column is a single byte.

Texts are read twice: once for the counts, once for the weights. Only one number per
bucket reaches the driver and goes back to the tasks, whatever the size of the corpus.
Ranks come from range partitions.

Defined cases: a null or empty text has no features and weight 0; rows with the same id
are drawn one by one, in any order between themselves; a null id counts as empty text;
an empty table gives no rows; without any target the target's counts are all zero; other
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import byte_slices, table
from presswork.operators.ranking import number_rows

BUCKETS = 10_000
LONGEST_RUN = 3  # words of a feature
LONGEST = 1024  # bytes of a feature whose CRC is worked out by columns
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
MATRIX_CELLS = 1 << 22

#: A-Z lower-cased; whatever is no digit, letter or byte of another script is a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def crc_table() -> np.ndarray:
    """Remainders of the 256 bytes for the reflected CRC-32 polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1).astype(np.uint32)
    return x


TABLE = crc_table()


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[starts[i] : starts[i] + lengths[i]]`` for all i."""
    out = np.zeros(len(starts), np.uint32)
    if not len(starts):
        return out
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:]), strict=True):
        if size > LONGEST:
            out[rows] = [zlib.crc32(data[i : i + size]) for i in starts[rows].tolist()]
            continue
        step = max(1, MATRIX_CELLS // max(size, 1))
        for a in range(0, len(rows), step):
            some = rows[a : a + step]
            matrix = data[starts[some] + np.arange(size)[:, None]]  # one row per column of bytes
            crc = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = TABLE[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
            out[some] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each code in order of first occurrence, and where each number first occurs."""
    found = pa.array(codes).dictionary_encode()
    numbers = found.indices.to_numpy()
    first = np.empty(len(found.dictionary), np.int64)
    first[numbers[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return numbers.astype(np.int64), first


def features(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text; for runs of one, two, ... words the text and the bucket of each run."""
    raw = np.frombuffer(b" ".join([*texts, b""]).translate(FOLD), np.uint8)
    ends_of_texts = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    space = raw == 32
    kept = np.ones(len(raw), bool)
    if len(raw):
        kept[0] = not space[0]
        kept[1:] = ~(space[1:] & space[:-1])
    data = raw[kept]  # words, each with one space after it
    ends = np.flatnonzero(data == 32)
    owner = np.searchsorted(ends_of_texts, np.flatnonzero(kept)[ends], side="right")
    words = np.bincount(owner, minlength=len(texts))
    if not len(ends):
        return words, []
    starts = np.concatenate([[0], ends[:-1] + 1])
    offsets = np.append(starts, len(data))
    listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    word = pc.dictionary_encode(listed).indices.to_numpy().astype(np.int64)
    size = int(word.max()) + 1
    # A run's number comes from that of the run before its last word, and that word's.
    numbers, out, at = None, [], np.arange(len(ends))
    for k in range(1, LONGEST_RUN + 1):
        if k > 1:
            last = np.minimum(at + k - 1, len(ends) - 1)
            inside = (at + k - 1 == last) & (owner[at] == owner[last])
            at, numbers = at[inside], numbers[inside]
        if not len(at):
            break
        numbers, first = numbered(word[at] if k == 1 else numbers * size + word[at + k - 1])
        from_ = starts[at[first]]
        crc = crcs(data, from_, ends[at[first] + k - 1] - from_)
        out.append((owner[at], (crc.astype(np.int64) % buckets)[numbers]))
    return words, out


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in slices of a few megabytes of text, with their texts as bytes."""
    for batch in batches:
        for start, stop in byte_slices(batch.column(column)):
            rows = batch.slice(start, stop - start)
            yield rows, [x or b"" for x in rows.column(column).cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> dict[int, int]:
    """Features of all texts in each bucket that has any; added up in each task first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in slices(batches, 0):
            for _, bucket in features(texts, buckets)[1]:
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    per_task = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(counted, "bucket long, n long")
    return {r["bucket"]: r["n"] for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))`` of every bucket."""
    of_source, of_target = (float(sum(counts.values()) + buckets) for counts in (source, target))
    ratios = ((target.get(b, 0) + 1.0) * of_source / ((source.get(b, 0) + 1.0) * of_target) for b in range(buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, 1):
            words, runs = features(texts, buckets)
            n, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for owner, bucket in runs:
                n += np.bincount(owner, minlength=len(texts))
                # Sums stay whole numbers far below 2 ** 53.
                weight += np.bincount(owner, gains[bucket], minlength=len(texts)).astype(np.int64)
            columns = [rows.column(0), pa.array(words.astype(np.int64)), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2 ** 32)))``; h from the hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document with ``n_features, weight, score, n_words``; the drawn ones with their ``rank``.

    Of the documents of at least ``least_words`` words, ``percent`` per cent with the
    highest scores are drawn.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, text, buckets), buckets)
    # Ranges are found from a sample, which would work out all weights once more.
    weights = materialize(weighed(docs, gains, doc_id, text), "weights")
    scored = weights.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    enough = F.col("n_words") >= least_words
    placed = number_rows(scored, (~enough).cast("int"), F.col("score").desc(), F.col("doc_id"), name="place", start=1)
    eligible = placed.agg(F.count_if(enough)).first()[0]
    rank = F.when(F.col("place") <= percent * eligible // 100, F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"), "n_words")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 in SQL: the table by its rule, then one step per byte of each distinct feature.
OP13_SQL = rf"""
WITH bits AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS t
  FROM range(256) AS r(b)),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT side, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
words AS (SELECT side, r, unnest(ws) AS a, generate_subscripts(ws, 1) AS p FROM split),
next AS (SELECT side, r, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY side, r ORDER BY p)),
runs AS (
  SELECT side, r, a AS feature FROM next
  UNION ALL SELECT side, r, a || ' ' || b FROM next WHERE b IS NOT NULL
  UNION ALL SELECT side, r, a || ' ' || b || ' ' || c FROM next WHERE c IS NOT NULL),
counted AS (SELECT side, r, feature, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT feature, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(feature)) + 1),
      lambda i: ('0x' || substr(hex(encode(feature)), (2 * i - 1)::INT, 2))::BIGINT)),
    lambda x, y: xor(t[(xor(x, y) & 255) + 1], x >> 8)), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT feature FROM counted), bits),
c AS (SELECT side, r, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL),
sums AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM c),
per AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM c GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((per.t + 1)::DOUBLE * (sums.s + {BUCKETS})::DOUBLE / ((per.s + 1)::DOUBLE * (sums.t + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM per, sums),
w AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM c JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) AS n_words,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT)::BIGINT AS score
  FROM texts JOIN split USING (side, r) LEFT JOIN w USING (r) WHERE side = 'd'),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY n_words < {LEAST_WORDS}, score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS eligible FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN place <= {PERCENT} * eligible // 100 THEN place END AS rank, n_words::BIGINT AS n_words FROM ranked
"""

QUERIES = {"op13_importance": op13_importance}
ORACLES = {"op13_importance": OP13_SQL}
