"""Sampled SentencePiece segmentations and their lossless decoding.

A text is split before every run of spaces; no piece of the vocabulary goes over such a
border, so a text's lattice is the chain of its chunks' lattices. Forward filtering sums
the weights of all paths to each place of a chunk, once per distinct chunk; backward
sampling then draws, for every occurrence, one path from the end, with the probability of
its weight. The random numbers are hashes of the seed, the row's key, the chunk's place in
the text and the place within the chunk: a row's sample depends on nothing else.

A piece of rank r weighs (r + RANK_SHIFT) ** -alpha (ranks of a merge vocabulary follow its
frequencies); alpha towards 0 draws all pieces alike, a large one prefers early merges. A
character outside the vocabulary becomes its UTF-8 byte pieces, so decoding restores every
text exactly, white space included.

Defined cases: a null text gives null ids, an empty one none; a null key counts as a key
of its own; rows with one key and one text get one sample; other columns pass through.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import lattice
from presswork.llm.common import TOKENIZERS, byte_slices, mix, table

VOCABULARY = f"{TOKENIZERS}/piece_bpe_32k.model"
ALPHA = 1.0
RANK_SHIFT = 100.0
SEED = 7
ROWS_AT_ONCE = 256
CHARS_AT_ONCE = 1 << 20
CHUNKS = re.compile(f"{lattice.SPACE}*[^{lattice.SPACE}]+|{lattice.SPACE}+")
NO_KEY = -(2**63)
KNOWN_EDGES = 12_000_000  # edges of chunks a worker remembers; it starts afresh beyond
#: Stands for a literal mark in a text; no valid text holds a surrogate.
LITERAL = "\ud800"


def chunks_of(text: str) -> list[str]:
    """A text in the vocabulary's spelling, split before every run of spaces."""
    if lattice.SPACE in text:
        text = text.replace(lattice.SPACE, LITERAL)
    return CHUNKS.findall(text.replace(" ", lattice.SPACE))


class Growing:
    """An array that rows are appended to."""

    def __init__(self, kind):
        self.held, self.size = np.zeros(1 << 16, kind), 0

    def append(self, rows: np.ndarray) -> None:
        if self.size + len(rows) > len(self.held):
            wider = np.zeros(max(2 * len(self.held), self.size + len(rows)), self.held.dtype)
            wider[: self.size] = self.held[: self.size]
            self.held = wider
        self.held[self.size : self.size + len(rows)] = rows
        self.size += len(rows)


class Sampler:
    """Encodes batches of texts and remembers the filtered lattices of their chunks.

    A cell is a place of a chunk. ``first`` has the first edge into each cell, ``upto`` the
    running shares of the cell's edges, which depend on nothing outside the chunk.
    """

    def __init__(self, path: str, alpha: float, seed: int):
        self.vocabulary = lattice.load_vocabulary(path)
        self.seed = np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        rank = np.arange(self.vocabulary.size + 1)
        self.log_weight = -alpha * np.log(rank + RANK_SHIFT)
        self.log_weight[-1] = 4 * self.log_weight[-2]  # a character outside the vocabulary
        self._forget()

    def _forget(self) -> None:
        self.cells: dict[str, int] = {}  # a chunk's last cell
        self.first, self.upto = Growing(np.int64), Growing(np.float64)
        self.start, self.piece = Growing(np.int32), Growing(np.int32)
        self.first.append(np.zeros(1, np.int64))

    def _learn(self, chunks: list[str]) -> None:
        chunks.sort(key=len)
        for a, b in lattice.batches(chunks):
            net = lattice.build(chunks[a:b], self.vocabulary)
            weight = self.log_weight[net.piece]
            alpha = lattice.forward(net, weight[:, None])[:, :, 0]
            order = np.lexsort((net.end, net.word))
            word, start, end, piece = (x[order] for x in (net.word, net.start, net.end, net.piece))
            share = np.exp(alpha[word, start] + weight[order] - alpha[word, end])
            cell = net.offsets[word] + end - 1
            counts = np.bincount(cell, minlength=net.offsets[-1])
            begin = np.cumsum(counts) - counts
            nth = np.arange(len(cell)) - begin[cell]
            for k in range(1, int(counts.max())):
                later = np.flatnonzero(nth == k)
                share[later] += share[later - 1]
            codes = net.codes[net.offsets[word] + end - 1].astype(np.int64)
            piece = np.where(piece < 0, -1 - codes, piece)
            base, edges = self.first.size - 1, self.upto.size
            self.cells.update(zip(chunks[a:b], (base + net.offsets[1:] - 1).tolist(), strict=True))
            self.first.append(edges + begin[1:])
            self.first.append(np.array([edges + len(cell)]))
            self.upto.append(share), self.start.append(end - start), self.piece.append(piece)

    def encode(self, keys: np.ndarray, texts: list[str]) -> list[np.ndarray]:
        """Ids of one sampled segmentation of each text."""
        if self.upto.size > KNOWN_EDGES:
            self._forget()
        split = [chunks_of(t) for t in texts]
        counts = np.array([len(x) for x in split], dtype=np.int64)
        if not counts.sum():
            return [np.zeros(0, np.int32) for _ in texts]
        missing = set().union(*split).difference(self.cells)
        if missing:
            self._learn(list(missing))
        get = self.cells.__getitem__
        cell = np.fromiter((c for x in split for c in map(get, x)), np.int64, int(counts.sum()))
        left = np.fromiter((n for x in split for n in map(len, x)), np.int64, len(cell))
        place = np.arange(len(cell)) - np.repeat(np.cumsum(counts) - counts, counts)
        row_key = mix(np.repeat(keys.astype(np.int64).astype(np.uint64) + self.seed, counts))
        hashes = mix(row_key + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        first, upto, back, piece = (x.held for x in (self.first, self.upto, self.start, self.piece))
        who, found = np.arange(len(cell)), []
        while len(who):
            draw = mix(hashes[who] + left.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
            u = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge, last = first[cell], first[cell + 1] - 1
            u *= upto[last]
            more = np.flatnonzero((edge < last) & (upto[edge] <= u))
            while len(more):
                edge[more] += 1
                more = more[(edge[more] < last[more]) & (upto[edge[more]] <= u[more])]
            found.append((who, left, piece[edge]))
            step = back[edge]
            left, cell = left - step, cell - step
            on = left > 0
            who, left, cell = who[on], left[on], cell[on]
        who, end, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((end, who))
        who, ids = who[order], ids[order]
        if (ids < 0).any():
            who, ids = self._bytes(who, ids)
        cuts = np.searchsorted(who, np.cumsum(counts)[:-1])
        return np.split(ids.astype(np.int32), cuts)

    def _bytes(self, who: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with each character outside the vocabulary spelled as bytes."""
        odd = np.flatnonzero(ids < 0)
        literal = ord(LITERAL)
        spelled = [(lattice.SPACE if c == literal else chr(c)).encode("utf-8", "surrogatepass") for c in (-1 - ids[odd]).tolist()]
        counts = np.ones(len(ids), np.int64)
        counts[odd] = [len(x) for x in spelled]
        out = np.repeat(ids, counts)
        out[np.repeat(ids < 0, counts)] = self.vocabulary.bytes_[np.frombuffer(b"".join(spelled), np.uint8)]
        return np.repeat(who, counts), out


def decode_ids(ids: np.ndarray, vocabulary: lattice.Vocabulary) -> str:
    """The text of a sequence of ids."""
    spelled = _spellings(vocabulary)
    return b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")


def _spellings(vocabulary: lattice.Vocabulary) -> list[bytes]:
    if id(vocabulary) not in _spelled:
        out = [b""] * vocabulary.size
        for i, p in zip(vocabulary.ids.tolist(), vocabulary.pieces, strict=True):
            out[i] = p.replace(lattice.SPACE, " ").encode()
        for b, i in enumerate(vocabulary.bytes_.tolist()):
            out[i] = bytes([b])
        _spelled[id(vocabulary)] = out
    return _spelled[id(vocabulary)]


_spelled: dict[int, list[bytes]] = {}
_samplers: dict[tuple, Sampler] = {}


def sampler(path: str, alpha: float, seed: int) -> Sampler:
    key = (path, alpha, seed)
    if key not in _samplers:
        _samplers[key] = Sampler(path, alpha, seed)
    return _samplers[key]


def encoded(key: Column, text: Column, alpha: float = ALPHA, seed: int = SEED, path: str = VOCABULARY) -> Column:
    """Ids of a sampled segmentation of ``text``, seeded by ``key`` (an integer)."""

    @F.arrow_udf("array<int>")
    def of(keys: pa.Array, texts: pa.Array) -> pa.Array:
        own, parts = sampler(path, alpha, seed), []
        for a, b in _ranges(texts):
            some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
            parts += own.encode(keys.slice(a, b - a).to_numpy(), some)
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32())
        return pa.ListArray.from_arrays(pa.array(ends), values, mask=texts.is_null() if texts.null_count else None)

    return of(F.coalesce(key.cast("long"), F.lit(NO_KEY)), text)


def _ranges(texts: pa.Array):
    """Ranges of a few rows of bounded length together, one row at least."""
    for start, stop in byte_slices(texts, CHARS_AT_ONCE):
        for a in range(start, stop, ROWS_AT_ONCE):
            yield a, min(stop, a + ROWS_AT_ONCE)


def decoded(ids: Column, path: str = VOCABULARY) -> Column:
    """The text of an id array."""

    @F.arrow_udf("string")
    def of(arrays: pa.Array) -> pa.Array:
        vocabulary = lattice.load_vocabulary(path)
        rows = (None if x is None else decode_ids(np.array(x, dtype=np.int64), vocabulary) for x in (y.as_py() for y in arrays))
        return pa.array(list(rows), pa.string())

    return of(ids)


def encode(docs: DataFrame, alpha: float = ALPHA, seed: int = SEED, path: str = VOCABULARY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with a column ``ids`` (replaced if there is one)."""
    return docs.withColumn("ids", encoded(F.col(doc_id), F.col(text), alpha, seed, path))


def decode(docs: DataFrame, path: str = VOCABULARY, ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``decoded`` (replaced if there is one)."""
    return docs.withColumn("decoded", decoded(F.col(ids), path))


def digests(key: Column, text: Column, alpha: float = ALPHA, seed: int = SEED, path: str = VOCABULARY) -> Column:
    """Struct of the number of ids, their crc32 and whether decoding restores the text.

    For tables that need no ids: these stay in the task.
    """

    @F.arrow_udf("struct<n_ids:bigint,ids_crc32:bigint,lossless:boolean>")
    def of(keys: pa.Array, texts: pa.Array) -> pa.Array:
        own, n, crc, same = sampler(path, alpha, seed), [], [], []
        for a, b in _ranges(texts):
            some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
            for ids, t in zip(own.encode(keys.slice(a, b - a).to_numpy(), some), some, strict=True):
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                same.append(decode_ids(ids, own.vocabulary) == t)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["n_ids", "ids_crc32", "lossless"])

    return of(F.coalesce(key.cast("long"), F.lit(NO_KEY)), text)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text, encoded and decoded: number and crc32 of its ids, and whether the text came back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", digests(F.col("doc_id"), F.col("text")).alias("d"))
    return docs.select("doc_id", "d.*")


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
ORACLES: dict[str, str] = {}
