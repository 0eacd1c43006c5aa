"""Near-duplicate documents by consistent weighted sampling.

A document is the multiset of its five-word shingles, each weighted by its count and
a damped inverse document frequency. Improved consistent weighted sampling draws one
shingle per hash function such that two documents draw the same with a probability
equal to their weighted Jaccard similarity. Draws are joined into bands; documents that
share a band are candidates, and a link is a pair whose weighted Jaccard similarity,
computed from all shingles, reaches the threshold. Linked texts form classes.

Scale: copies of one text are one node from the start. Within a band, rows are sorted by
value and total weight over range partitions, so that a crowded value is spread; each row
is compared with its predecessor and with the leader of its run. A leader is replaced once
the weights alone rule out the threshold. This first round only gathers the bulk of each
class. Where different classes still meet in a band, a second round settles every pair of
rows of different classes whose weights allow the threshold: bands of up to ``WINDOW`` + 1
rows in one task, larger ones block by block. Blocks are cut by weight and, for large
classes, by class, so two blocks of one class or of weights too far apart are never
paired; a pair of blocks is one matrix product, and a pair of texts belongs to the first
band it shares. The work in a crowded band grows with the pairs of rows of different
classes in it. So, weights given, classes do not depend on partitions or on the first round.

Words are runs of letters and digits, lower-cased; bytes above 127 count as letters. A
text of one to four words is one shingle. Document frequencies are exact counts over all
documents: a first pass finds every shingle that can have the least share of interest, a
second one counts these in all texts, so weights do not depend on partitions. Inverse
frequencies grow no further below ``RARE``, hence at most (mean shingles per document) /
``RARE`` shingles matter (in the first pass a third more), and only these are broadcast.

Defined cases: texts without words (null and empty ones too) are duplicates only of equal
texts, null counting as empty; rows with equal ids and different texts are separate;
a null id is never the class id where another exists; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import discard, materialize
from presswork.llm.common import byte_buffer, byte_slices, expand, forget, mix, table, unused
from presswork.llm.components import components, merged

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 10, 3
RARE = 0.01  # share of documents below which a shingle counts as rare
IDF_GAIN = 0.5  # a rare shingle weighs 1 + IDF_GAIN times one that every document holds
TABLE_BITS = 16
CHUNK = 1 << 22  # shingles of a task that are counted together
LOCAL = 0.25  # of the least share: a chunk reports no shingle that fewer of its texts hold
SLICE = 1 << 18  # bytes of texts whose shingles are worked out together
WINDOW = 16  # rows before it that each of a small band is compared with in the second round
BLOCK, MOST_BLOCK = 128, 1024  # rows of a block: an eighth of its band within these limits
BLOCK_WEIGHT = 1 << 20  # total weight of a block, which bounds its shingles
FEATURES = 4096  # columns of a block's matrix at a time
KEY_BITS = 52  # of a shingle's hash; the upper bits hold a row's number within a slice
NO_ID = -(2**63)

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
BASE = 0x9E3779B97F4A7C15 | 1


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64."""
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        both.append(np.multiply.accumulate(x))
    return both[0], both[1]


def shingle_counts(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of up to 4,096 texts: key, count, and offsets of the rows.

    Words are hashed by differences of one running polynomial sum, so no word becomes an
    object. Keys ascend within a row.
    """
    import pyarrow.compute as pc

    rows = len(texts)
    data, offsets = byte_buffer(pc.utf8_lower(texts.cast(pa.large_string())))
    inside = WORD_BYTE[data]
    # A word never goes over the border of two texts.
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    borders = offsets[1:-1]
    before[borders[borders < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[borders[borders > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
    size = 1 << max(16, int(len(data)).bit_length())
    power, inverse = _powers(size)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    words = mix((total[ends] - total[starts]) * inverse[starts])
    row = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(row, minlength=rows)
    first = np.cumsum(n_words) - n_words
    # The k-th word counts by its place; short texts stop early and keep their own length.
    n_shingles = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    at = expand(first, n_shingles)
    owner = np.repeat(np.arange(rows), n_shingles)
    length = np.minimum(n_words, width)[owner]
    joined = length.astype(np.uint64)
    for k in range(width):
        here = length > k
        odd = np.uint64(pow(BASE, 2 * k + 3, 1 << 64) | 1)
        if here.all():
            joined += words[at + k] * odd
        else:
            joined[here] += words[at[here] + k] * odd
    keys = (owner.astype(np.uint64) << np.uint64(KEY_BITS)) | (mix(joined) >> np.uint64(64 - KEY_BITS))
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    places = np.flatnonzero(new)
    counts = np.diff(np.append(places, len(keys)))
    keys = keys[places]
    found = np.bincount((keys >> np.uint64(KEY_BITS)).astype(np.int64), minlength=rows)
    return keys & np.uint64((1 << KEY_BITS) - 1), counts, np.append(0, np.cumsum(found))


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    for start, stop in byte_slices(column, SLICE):
        for a in range(start, stop, 4096):
            yield a, min(stop, a + 4096)


def frequent_shingles(texts: DataFrame, rare: float = RARE) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and exact document frequencies of shingles in at least ``rare`` of all texts; number of texts.

    ``texts`` has one text column. A first pass finds the shingles that can be so frequent,
    a second one counts these in all texts. Both tables are bounded: every text holds on
    average at least ``size * rare * (1 - LOCAL)`` of these shingles.
    """
    spark = texts.sparkSession

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for held, docs in _gathered(batches):
            keys, n = np.unique(held, return_counts=True)
            # A chunk keeps silent about shingles that at most so many of its texts hold.
            silent = math.floor(LOCAL * rare * docs)
            enough = n > silent
            # What a key can have beyond the silence goes with it; texts and silence have keys of their own.
            keys, n = np.append(keys[enough].astype(np.int64), [-1, -2]), np.append(n[enough] - silent, [docs, silent])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    counts = texts.mapInArrow(local, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "frequencies")
    totals = {r["key"]: r["n"] for r in counts.filter("key < 0").collect()}
    docs, silent = totals.get(-1, 0), totals.get(-2, 0)
    possible = counts.filter((F.col("key") >= 0) & (F.col("n") + silent >= rare * docs)).select("key").orderBy("key")
    wanted = spark.sparkContext.broadcast(possible.toPandas()["key"].to_numpy(np.uint64))
    discard(counts)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = wanted.value
        total = np.zeros(len(known) + 1, np.int64)
        for held, _ in _gathered(batches):
            at = np.searchsorted(known, held)
            at[known[np.minimum(at, len(known) - 1)] != held] = len(known)
            total += np.bincount(at, minlength=len(total))
        some = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(known[some].astype(np.int64)), pa.array(total[some])], names=["key", "n"])

    if not len(wanted.value):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), docs
    counted = texts.mapInArrow(exact, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = counted.filter(F.col("n") >= rare * docs).orderBy("key").toPandas()
    return found["key"].to_numpy(np.uint64), found["n"].to_numpy(np.int64), docs


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
    """Distinct shingles of each text, put together for about ``CHUNK``, at most twice that; number of these texts.

    What is left at the end goes with the chunk before it: a small chunk of its own would be
    silent about too little.
    """
    full, held, size, docs = ([], 0), [], 0, 0
    for batch in batches:
        for a, b in _slices(batch.column(0)):
            keys, _, _ = shingle_counts(batch.column(0).slice(a, b - a))
            held.append(keys)
            size += len(keys)
            docs += b - a
            if size >= CHUNK:
                if full[1]:
                    yield np.concatenate(full[0]), full[1]
                full, held, size, docs = (held, docs), [], 0, 0
    if full[1] + docs:
        yield np.concatenate(full[0] + held), full[1] + docs


class Weights:
    """Weight of a shingle: its count times a damped inverse document frequency."""

    def __init__(self, keys: np.ndarray, frequencies: np.ndarray, docs: int, rare: float = RARE, gain: float = IDF_GAIN):
        self.keys = keys
        share = np.maximum(frequencies / max(docs, 1), rare)
        self.idf = 1 + gain * np.log(np.minimum(1.0, share)) / np.log(rare)
        self.usual = 1 + gain

    def of(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = counts * self.usual
        if len(self.keys):
            at = np.searchsorted(self.keys, keys)
            at[at == len(self.keys)] = 0
            known = np.flatnonzero(self.keys[at] == keys)
            weights[known] = counts[known] * self.idf[at[known]]
        return weights


class Sampler:
    """Improved consistent weighted sampling (Ioffe, 2010) with tabulated random numbers.

    A shingle's hash chooses one of 65,536 draws of the random numbers per function; of
    shingles with the same draw and weight the least hash wins, in every document alike.
    """

    def __init__(self, functions: int, usual: float, seed: int = 42):
        rng = np.random.default_rng(seed)
        shape = (functions, 1 << TABLE_BITS)
        self.odd = (rng.integers(1, 1 << 63, functions, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.r = rng.gamma(2, 1, shape).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, shape)).astype(np.float32)
        self.beta = rng.random(shape, dtype=np.float32)
        self.usual = usual
        self.usual_a, self.usual_t = zip(*(self._draw(k, slice(None), np.float32(np.log(usual))) for k in range(functions)), strict=True)

    def _draw(self, k, index, log_weight):
        r = self.r[k][index]
        beta = self.beta[k][index]
        t = np.floor(log_weight / r + beta)
        return self.log_c[k][index] - r * (t - beta + np.float32(1)), t

    def signatures(self, keys: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of samples per non-empty row of ``offsets``."""
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes)
        starts, sizes = offsets[:-1][filled], sizes[filled]
        out = np.empty((len(filled), len(self.odd)), np.uint64)
        if not len(filled):
            return out
        odd_ones = np.flatnonzero(weights != self.usual)
        log_odd = np.log(weights[odd_ones]).astype(np.float32)
        for k, odd in enumerate(self.odd):
            index = ((keys * odd) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
            a = self.usual_a[k][index]
            if len(odd_ones):
                a[odd_ones] = self._draw(k, index[odd_ones], log_odd)[0]
            least = np.minimum.reduceat(a, starts)
            hit = np.flatnonzero(a == np.repeat(least, sizes))
            # Keys ascend within a row, so the first hit of a row has the least hash.
            best = hit[np.searchsorted(hit, starts)]
            t = self.usual_t[k][index[best]].copy()
            if len(odd_ones):
                at = np.minimum(np.searchsorted(odd_ones, best), len(odd_ones) - 1)
                other = np.flatnonzero(odd_ones[at] == best)
                t[other] = self._draw(k, index[best[other]], log_odd[at[other]])[1]
            out[:, k] = mix(keys[best] * np.uint64(0x9E3779B97F4A7C15) + t.astype(np.int64).astype(np.uint64))
        return out


def node_of(text: Column) -> Column:
    """128-bit name of a text; equal texts are one node."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def banded(texts: DataFrame, weights, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``node, doc_id, total, bands`` for every row of ``doc_id, node, text``; no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = weights.value
        sampler = Sampler(bands * rows, known.usual)
        for batch in batches:
            for a, b in _slices(batch.column(2)):
                part = batch.slice(a, b - a)
                keys, counts, offsets = shingle_counts(part.column(2))
                w = known.of(keys, counts)
                drawn = sampler.signatures(keys, w, offsets).reshape(-1, bands, rows)
                values = np.zeros(drawn.shape[:2], np.uint64)
                for i in range(rows):
                    values = mix(values + drawn[:, :, i] * np.uint64(2 * i + 1))
                filled = np.diff(offsets) > 0
                totals = np.add.reduceat(np.append(w, 0.0), np.minimum(offsets[:-1], len(w))) * filled
                ends = np.append(0, np.cumsum(filled * bands)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(0), pa.array(totals), listed], names=["node", "doc_id", "total", "bands"]
                )

    return texts.mapInArrow(run, "node binary, doc_id long, total double, bands array<long>")


def _meetings(threshold: float, window: int):
    """Pairs of a sorted partition: each row with its run's leader and the ``window`` rows before.

    The rows ascend by total weight; partners that are too light to reach ``threshold``
    are left out. The leaders at a partition's borders go out with an empty
    partner, so that a run that goes over partitions can be joined up.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = lead = None
        before: deque = deque(maxlen=window)
        first = True
        for batch in batches:
            a, b, kind = [], [], []
            for band, value, total, node, group in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                own = (total, node, group)
                if run != (band, value):
                    if run is not None and not first:
                        a.append(lead[1]), b.append(None), kind.append(run)
                    run, lead = (band, value), own
                    before.clear()
                    before.append(own)
                    if first:
                        a.append(node), b.append(None), kind.append(run)
                        first = False
                    continue
                if total * threshold > lead[0]:
                    lead = own
                partners = before if lead in before else [lead, *before]
                for other in partners:
                    if other[2] != group and total * threshold <= other[0]:
                        a.append(other[1]), b.append(node), kind.append(None)
                before.append(own)
            yield _pairs(a, b, kind)
        if run is not None:
            yield _pairs([lead[1]], [None], [run])

    return pairs


def _pairs(a, b, kind) -> pa.RecordBatch:
    run = [k or (None, None) for k in kind]
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([k[0] for k in run], pa.int32()), pa.array([k[1] for k in run], pa.int64())],
        names=["a", "b", "band", "value"],
    )


def candidate_pairs(rows: DataFrame, threshold: float, window: int) -> tuple[DataFrame, DataFrame]:
    """A stored table, and the distinct node pairs ``a < b`` to verify in it, of ``band, value, n, total, node, group`` rows.

    Bands of ``n`` rows that a window covers stay whole; larger ones are spread by range.
    """
    keys = ["band", "value", "total", "node"]
    whole = rows.filter(F.col("n") <= WINDOW + 1).repartition("band", "value")
    spread = rows.filter(F.col("n") > WINDOW + 1).repartitionByRange(*keys)
    met = [
        x.sortWithinPartitions(*keys)
        .select("band", "value", "total", "node", "group")
        .mapInArrow(_meetings(threshold, window), "a binary, b binary, band int, value long")
        for x in (whole, spread)
    ]
    found = materialize(met[0].unionByName(met[1]), "meetings")
    # Runs that go on in the next partition: the leaders there meet the least of them.
    leaders = found.filter("b IS NULL")
    least = leaders.groupBy("band", "value").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    over = leaders.drop("b").join(least, ["band", "value"]).select("a", "b")
    both = found.filter("b IS NOT NULL").select("a", "b").unionByName(over).filter("a <> b")
    return found, both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shingle_vectors(texts: DataFrame) -> DataFrame:
    """``node, keys, counts`` (packed 64- and 32-bit numbers) of ``node, text`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(batch.column(1)):
                part = batch.slice(a, b - a)
                keys, counts, offsets = shingle_counts(part.column(1))
                cuts = list(zip(offsets[:-1], offsets[1:], strict=True))
                packed = [pa.array([x[i:j].tobytes() for i, j in cuts], pa.binary()) for x in (keys, counts.astype(np.uint32))]
                yield pa.RecordBatch.from_arrays([part.column(0), *packed], names=["node", "keys", "counts"])

    return texts.mapInArrow(run, "node binary, keys binary, counts binary")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two vectors ``(keys, weights)`` with ascending keys."""
    (ka, wa), (kb, wb) = a, b
    if not len(ka) or not len(kb):
        return 0.0
    at = np.searchsorted(ka, kb)
    at[at == len(ka)] = 0
    both = np.flatnonzero(ka[at] == kb)
    low = np.minimum(wa[at[both]], wb[both]).sum()
    return float(low / (wa.sum() + wb.sum() - low))


def verified(pairs: DataFrame, vectors: DataFrame, weights, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the pairs that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.value

        def vector(keys, counts):
            keys = np.frombuffer(keys.as_buffer(), np.uint64)
            return keys, known.of(keys, np.frombuffer(counts.as_buffer(), np.uint32))

        for batch in batches:
            a, b, ka, ca, kb, cb = (batch.column(i) for i in range(6))
            values = np.array([similarity(vector(ka[i], ca[i]), vector(kb[i], cb[i])) for i in range(len(batch))])
            keep = pa.array(np.flatnonzero(values >= threshold))
            yield pa.RecordBatch.from_arrays([a.take(keep), b.take(keep), pa.array(values).take(keep)], names=["a", "b", "similarity"])

    side = lambda x: vectors.select(F.col("node").alias(x), F.col("keys").alias(f"k{x}"), F.col("counts").alias(f"c{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ka", "ca", "kb", "cb")
    return both.mapInArrow(run, "a binary, b binary, similarity double")


def overlaps(keys: list[np.ndarray], counts: list[np.ndarray], idf, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weight that rows ``a`` (down) and ``b`` (across) of the vectors have in common.

    ``min(x, y)`` of two counts of a key is the sum over the levels that both reach, so
    that it is a product of matrices with a column per key and distinct count.
    """
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.float64)
    order = np.lexsort((count, key))
    key, count, owner = key[order], count[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    # A key of one row is common to no two.
    several = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
    key, count, owner, new = key[several], count[several], owner[several], new[several]
    out = np.zeros((len(a), len(b)))
    if not len(key):
        return out
    level = new.copy()
    level[1:] |= count[1:] != count[:-1]
    before = np.where(new, 0.0, np.append(0.0, count[:-1]))
    step = ((count - before) * idf(key))[level]
    column = np.cumsum(level) - 1
    starts = np.flatnonzero(new)
    first = column[starts]
    done = 0
    while done < len(starts):
        stop = max(done + 1, int(np.searchsorted(first, first[done] + FEATURES)))
        lo, hi = starts[done], starts[stop] if stop < len(starts) else len(key)
        base = column[lo]
        least = np.repeat(first[done:stop], np.diff(np.append(starts[done:stop], hi)))
        reached = column[lo:hi] - least + 1
        held = np.zeros((len(keys), column[hi - 1] - base + 1))
        held[np.repeat(owner[lo:hi], reached), expand(least - base, reached)] = 1
        out += held[a] @ (held[b] * step[base : column[hi - 1] + 1]).T
        done = stop
    return out


def _settled_blocks(weights, threshold: float):
    """Links between the classes of two blocks of a band, as many as join these up."""

    def run(rows: pa.Table) -> pa.Table:
        known = weights.value
        rows = rows.combine_chunks()
        band = rows["band"][0].as_py()
        node, group = rows["node"].to_pylist(), rows["group"].to_pylist()
        total = rows["total"].to_numpy()
        drawn = np.array(rows["bands"].to_pylist(), np.int64)[:, : band + 1]
        numbers: dict[bytes, int] = {}
        root = [numbers.setdefault(g, len(numbers)) for g in group]
        a, b = (np.flatnonzero(rows[x].to_numpy()) for x in ("in_left", "in_right"))
        code = np.array(root)
        open_ = code[a][:, None] != code[b][None]
        open_ &= (total[a][:, None] * threshold <= total[b][None]) & (total[b][None] * threshold <= total[a][:, None])
        for k in range(band):
            open_ &= drawn[a, k][:, None] != drawn[b, k][None]
        if rows["left"][0] == rows["right"][0]:
            open_ = np.triu(open_, 1)
        down, across = open_.any(axis=1), open_.any(axis=0)
        a, b, open_ = a[down], b[across], open_[down][:, across]
        links: list[tuple] = []
        if len(a):
            used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            part = rows.take(pa.array(used))
            keys, counts = (
                [np.frombuffer(x.as_buffer(), kind) for x in part[name].combine_chunks()] for name, kind in (("keys", np.uint64), ("counts", np.uint32))
            )
            low = overlaps(keys, counts, lambda k: known.of(k, np.ones(len(k))), place[: len(a)], place[len(a) :])
            near = open_ & (low >= (threshold - 1e-9) * (total[a][:, None] + total[b][None] - low))
            vector = lambda i: (keys[i], known.of(keys[i], counts[i]))
            parent = list(range(len(numbers)))

            def find(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True):
                x, y = find(root[a[i]]), find(root[b[j]])
                if x != y and (found := similarity(vector(place[i]), vector(place[len(a) + j]))) >= threshold:
                    parent[x] = y
                    links.append((*sorted((node[a[i]], node[b[j]])), found))
        columns = list(zip(*links, strict=True)) or [(), (), ()]
        kinds = (pa.binary(), pa.binary(), pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["a", "b", "similarity"])

    return run


def _blocked(rows: DataFrame, threshold: float) -> DataFrame:
    """``rows`` with ``block``: rows of similar weight; large classes have blocks of their own."""
    # Rows whose weights allow the threshold are of the same or of neighbouring levels.
    step = math.log(1 / threshold) * 1.001 + 1e-6
    rows = rows.withColumn("level", F.floor(F.log("total") / step))
    cut = ["band", "value", "level"]
    size = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(BLOCK), F.ceil(F.first("n") / 8)))
    fill = F.greatest(F.count(F.lit(1)) / size, F.sum("total") / BLOCK_WEIGHT).alias("fill")
    parts = rows.groupBy(*cut, "group").agg(fill).withColumn("part", F.when(F.col("fill") >= 0.5, F.col("group")).otherwise(F.lit(b"")))
    blocks = parts.groupBy(*cut, "part").agg(F.ceil(F.sum("fill")).alias("blocks"))
    parts = parts.drop("fill").join(blocks, [*cut, "part"])
    block = F.xxhash64("level", "part", F.pmod(F.xxhash64("node"), F.col("blocks")))
    return rows.join(parts, [*cut, "group"]).select("band", "value", block.alias("block"), "total", "node", "group")


def crowded_links(rows: DataFrame, nodes: DataFrame, vectors: DataFrame, weights, threshold: float) -> DataFrame:
    """``a, b, similarity``: links that join up the classes of ``rows`` of large bands.

    Every pair of rows of a band with different classes takes part that can reach the
    threshold by its weights.
    """
    marked = materialize(_blocked(rows, threshold), "blocks")
    blocks = marked.groupBy("band", "value", "block").agg(
        F.min("total").alias("lo"), F.max("total").alias("hi"), F.min("group").alias("least"), F.max("group").alias("most")
    )
    blocks = materialize(blocks, "blocks")
    side = lambda x: blocks.select("band", "value", F.col("block").alias(x), F.struct("lo", "hi", "least", "most").alias(f"{x}_is"))
    pairs = side("left").join(side("right"), ["band", "value"]).filter(F.col("left") <= F.col("right"))
    one_class = "left_is.least = right_is.most AND left_is.most = right_is.least AND left_is.least = left_is.most"
    pairs = pairs.filter(f"left_is.hi >= right_is.lo * {threshold} AND right_is.hi >= left_is.lo * {threshold} AND NOT ({one_class})")
    ends = pairs.select("band", "value", "left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    whole = marked.join(nodes.select("node", "bands"), "node").join(vectors, "node").join(ends, ["band", "value", "block"])
    whole = whole.withColumns({"in_left": F.col("block") == F.col("left"), "in_right": F.col("block") == F.col("right")}).drop("block")
    return whole.groupBy("band", "value", "left", "right").applyInArrow(_settled_blocks(weights, threshold), "a binary, b binary, similarity double")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """One row per document (``doc_id, node, class_id, class_node``) and the verified links between different texts.

    ``class_id`` is the least id of the class; ``class_node`` names the class even if ids
    are null or repeated.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), node_of(F.col(text)).alias("node"), whole.alias("text"))
    weights = spark.sparkContext.broadcast(Weights(*frequent_shingles(texts.select("text"))))
    signed = materialize(banded(texts, weights, bands, rows), "signatures")
    nodes = materialize(
        signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("total").alias("total"), F.first("bands").alias("bands")), "nodes"
    )
    entries = nodes.select("node", "total", F.posexplode("bands").alias("band", "value"))
    shared = entries.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    entries = materialize(entries.join(shared, ["band", "value"]).select("band", "value", "n", "total", "node"), "entries")
    # Texts of nodes that share a band, once each: by the row with the node's least id.
    wanted = entries.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["node"] == wanted["node"])
    once = texts.join(wanted, same, "left_semi").select("node", "text").dropDuplicates(["node"])
    vectors = materialize(shingle_vectors(once), "vectors")
    # First by weight with little company; then where different classes still meet.
    met, pairs = candidate_pairs(entries.withColumn("group", F.col("node")), threshold, 1)
    pairs = materialize(pairs, "pairs")
    links = materialize(verified(pairs, vectors, weights, threshold), "links")
    labels = materialize(components(links), "labels")
    undecided = materialize(_undecided(entries, labels), "undecided")
    met_again, again = candidate_pairs(undecided.filter(F.col("n") <= WINDOW + 1), threshold, WINDOW)
    again = again.join(pairs, ["a", "b"], "left_anti")
    crowded = crowded_links(undecided.filter(F.col("n") > WINDOW + 1), nodes, vectors, weights, threshold)
    fresh = materialize(verified(again, vectors, weights, threshold).unionByName(crowded), "links")
    final = materialize(merged(labels, fresh), "labels")
    discard(met, pairs, labels, undecided, met_again, vectors, entries)
    return _classes(signed, nodes, final), links.unionByName(fresh)


def _undecided(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the bands in which different classes meet."""
    grouped = entries.join(labels, "node", "left").withColumn("group", F.coalesce("label", "node")).drop("label")
    mixed = grouped.groupBy("band", "value").agg((F.min("group") != F.max("group")).alias("mixed")).filter("mixed").drop("mixed")
    return grouped.join(mixed, ["band", "value"], "left_semi").select("band", "value", "n", "total", "node", "group")


def _classes(signed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Class of every row; a class of one text needs no label."""
    named = nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("class_node"))
    least = named.groupBy("class_node").agg(F.min("doc_id").alias("class_id"))
    by_node = materialize(named.drop("doc_id").join(least, "class_node"), "classes")
    return signed.select("doc_id", "node").join(by_node, "node")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: that with the least id, one of them if rows are equal."""
    classes, _ = near_duplicates(docs, threshold)
    # A null id is below all others, but is chosen only where the class has no other.
    row, node = (unused(docs, name) for name in ("row", "node"))
    name = lambda x: F.coalesce(F.col(x).cast("long"), F.lit(NO_ID)).alias(row)
    first = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_node", "class_id").agg(F.min("node").alias(node))
    chosen = first.select(node, name("class_id"))
    marked = docs.select("*", node_of(F.col("text")).alias(node), name("doc_id"))
    return marked.join(chosen, [node, row], "left_semi").dropDuplicates([node, row]).select(docs.columns)


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, class_id`` of every document, and whether it is the one of its class that stays."""
    classes, _ = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


QUERIES = {"op10_near_dup": op10_near_dup}
ORACLES: dict[str, str] = {}
