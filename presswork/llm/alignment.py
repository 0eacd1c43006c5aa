"""Alignment of two tokenizers' tokens over the same texts.

Both token sequences of a text cover the same bytes. Places where a token of both ends
are cuts; they part a text into groups of tokens that stand for each other. A token of A
and one of B are linked if their bytes overlap.

Tokens are merged in lockstep: one state vector holds a pointer into A's tokens and one
into B's for every document of a slice. A step links the tokens under all pointers at once,
notes a cut where both end, and advances the pointer whose token ends first, or both.
Documents that are through leave the vector. A long document runs as several lanes, cut
between words where both tokenizers always cut, so that no slice waits for one document.

Both tokenizers end a token before every space that follows no white space, so texts are
encoded by such chunks and a worker remembers, within bounds, the ids of those it has met.

How often a pair of ids is linked is counted over the whole corpus: per slice, then by
pair. A document needs the counts of its own pairs. Its links are stored as numbers of its
slice's pairs, and the counts come back to each slice once per pair, so the join sees a
pair once per slice and not once per occurrence; no pair is crowded and nothing is broadcast.

Defined cases: a text that is null or empty, or whose bytes one of the tokenizers does not
reproduce, has no tokens, and zero everywhere; names of special tokens are plain text;
rows with equal or null ids are aligned one by one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import LATIN, byte_of_letter, byte_slices, expand, table

LANE = 64  # chunks of a lane
KNOWN_CHUNKS = 300_000  # that a worker remembers; beyond, only the more frequent ones stay
SLICE = 2 << 20  # bytes of text that are aligned together
LONG_CHUNK = 10_000
TOGETHER = 2_000  # chunks that are encoded as one text
RESULT = ("n_a", "n_b", "n_groups", "n_links")


class ByteTokens:
    """Byte-level tokenizer of a ``tokenizers`` file.

    Chunks of Latin letters go through a faster encoder over the same vocabulary, whose
    ids are its merges' order; others, and those without end, through the library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        with open(path) as file:
            added = {t["content"] for t in json.load(file).get("added_tokens", ())}
        ranks = {self.bytes[i]: i for piece, i in vocabulary.items() if piece not in added}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, each preceded by a space, and their numbers."""
        simple = np.array([bool(c) and not c[-1].isspace() and len(c) < LONG_CHUNK and (c.isascii() or max(c) < LATIN) for c in chunks], bool)
        ids, counts = [np.zeros(0, np.int64)], np.zeros(len(chunks), np.int64)
        plain, others = np.flatnonzero(simple), np.flatnonzero(~simple).tolist()
        for a in range(0, len(plain), TOGETHER):
            some = plain[a : a + TOGETHER]
            texts = [" " + chunks[i] for i in some.tolist()]
            ids.append(self.fast.encode_to_numpy("".join(texts)).astype(np.int64))
            ends = np.searchsorted(np.cumsum(self.size[ids[-1]]), np.cumsum([len(t.encode()) for t in texts])) + 1
            counts[some] = np.diff(ends, prepend=0)
        for i, got in zip(others, self.tokenizer.encode_batch([" " + chunks[i] for i in others], add_special_tokens=False), strict=True):
            ids.append(np.array(got.ids, np.int64))
            counts[i] = len(got.ids)
        order = np.append(plain, others).astype(np.int64)
        first = np.empty(len(chunks), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(ids)[expand(first, counts)], counts


class PieceTokens:
    """Tokenizer of a SentencePiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        named = [self.model.id_to_piece(i) for i in range(n)]
        if any("▁" in p.lstrip("▁") for p in named):
            raise ValueError("a piece reaches over a space")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(named)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(chunks, num_threads=1)
        return flat(found)[1], np.array([len(x) for x in found], np.int64)


class Memory:
    """Chunks that a worker has met, with their ids in both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self._start()

    def forget(self) -> None:
        """Keep the more frequent chunks, half as many as the bound at most."""
        often = np.argsort(-self.seen, kind="stable")[: KNOWN_CHUNKS // 2]
        kept = np.sort(often[self.seen[often] > 1])
        chunks = list(self.known)
        self.known = {chunks[i]: n for n, i in enumerate(kept.tolist())}
        for side, first in enumerate(self.first):
            counts = first[kept + 1] - first[kept]
            self.ids[side] = self.ids[side][expand(first[kept], counts)]
            self.first[side] = np.append(0, np.cumsum(counts))
        self.good, self.open, self.empty = self.good[kept], self.open[kept], self.empty[kept]
        self.seen = np.zeros(len(kept), np.int64)

    def _start(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.first = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # of each chunk, and the end
        self.good, self.open, self.empty = (np.zeros(0, bool) for _ in range(3))
        self.seen = np.zeros(0, np.int64)  # occurrences since the last time something was forgotten

    def learn(self, chunks: list[str]) -> None:
        texts = [(" " + c).encode() for c in chunks]
        good = np.ones(len(chunks), bool)
        for side, tokens in enumerate((self.a, self.b)):
            ids, counts = tokens.encode(chunks)
            self.ids[side] = np.concatenate([self.ids[side], ids.astype(np.int32)])
            self.first[side] = np.concatenate([self.first[side], self.first[side][-1] + np.cumsum(counts)])
            good &= reproduced(tokens, ids, counts, texts)
        self.good = np.concatenate([self.good, good])
        self.open = np.concatenate([self.open, np.array([c[-1:].isspace() for c in chunks], bool)])
        self.empty = np.concatenate([self.empty, np.array([not c for c in chunks], bool)])
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))

    def numbers(self, lists: list[list[str]]) -> list[list[int]]:
        """Numbers of chunks; new ones are encoded together."""
        get = self.known.get
        found = [list(map(get, chunks)) for chunks in lists]
        missing = {c for chunks, ns in zip(lists, found, strict=True) if None in ns for c, n in zip(chunks, ns, strict=True) if n is None}
        if missing:
            self.learn(list(missing))
            found = [list(map(get, chunks)) if None in ns else ns for chunks, ns in zip(lists, found, strict=True)]
        return found

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Text and number of every chunk, for texts that both tokenizers reproduce."""
        if len(self.known) > KNOWN_CHUNKS:
            self.forget()
        words = [t.split(" ") if t else [] for t in texts]
        found = self.numbers(words)
        owner, number = flat(found)
        # A space belongs to the white space before it, if there is any, and to that at the end.
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        again = np.unique(owner[self.open[number] & ~last | self.empty[number]]).tolist()
        for i, ns in zip(again, self.numbers([joined(words[i]) for i in again]), strict=True):
            found[i] = ns
        owner, number = flat(found) if again else (owner, number)
        bad = np.zeros(len(texts), bool)
        bad[owner[~self.good[number]]] = True
        self.seen = np.bincount(number, minlength=len(self.known)) + np.pad(self.seen, (0, len(self.known) - len(self.seen)))
        kept = ~bad[owner]
        return owner[kept], number[kept]


def reproduced(tokens: ByteTokens | PieceTokens, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Whether the bytes of each text's tokens are the text's."""
    data = b"".join([tokens.bytes[i] for i in ids.tolist()])
    ends = np.append(0, np.cumsum(tokens.size[ids]))[np.append(0, np.cumsum(counts))]
    if data == b"".join(texts) and np.array_equal(np.diff(ends), [len(t) for t in texts]):
        return np.ones(len(texts), bool)
    return np.array([data[i:j] == t for i, j, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts, strict=True)], bool)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and value of every entry."""
    counts = np.array([len(x) for x in lists], np.int64)
    return np.repeat(np.arange(len(lists)), counts), np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum()))


def joined(words: list[str]) -> list[str]:
    """Chunks of a text split at spaces: one begins where there is no white space around the space."""
    out = [[words[0]]]
    for before, w in itertools.pairwise(words):
        if w and before and not before[-1].isspace():
            out.append([w])
        else:
            out[-1].append(w)
    return [" ".join(parts) for parts in out]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stop_a: np.ndarray):
    """Links and cuts of lanes that begin at given tokens and end before ``stop_a``.

    ``end_a`` and ``end_b`` are the bytes at which tokens end. Returns the two tokens of
    every link, and for each token whether a cut follows it.
    """
    a, b, stop = first_a, first_b, stop_a
    links_a, links_b = [], []
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    while len(a):
        links_a.append(a)
        links_b.append(b)
        at_a, at_b = end_a[a], end_b[b]
        both = at_a == at_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a, b = a + (at_a <= at_b).astype(a.dtype), b + (at_b <= at_a).astype(b.dtype)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    none = [first_a]
    return np.concatenate(links_a or none), np.concatenate(links_b or none), cut_a, cut_b


def spelled(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size_a: int, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all groups, ``a1,a2|b1;...``, and the number of bytes for each token in order."""
    after_a, after_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    # A's tokens of a group stand before B's.
    order[np.arange(len(ids_a)) + np.append(0, after_b)[group_a]] = ids_a * 2 + cut_a
    order[np.arange(len(ids_b)) + after_a[group_b]] = (ids_b + size_a) * 2 + cut_b
    letters = names[order]
    shown = letters != 0
    return letters[shown], shown.sum(axis=1)


def name_table(size_a: int, size_b: int) -> np.ndarray:
    """Row ``2 id`` (A, then B): the id and a comma; the next one: the id and the end of its side."""
    sides = [(i, e) for i in range(size_a) for e in ",|"] + [(i, e) for i in range(size_b) for e in ",;"]
    named = np.array([f"{i}{e}".encode() for i, e in sides])
    return named.view(np.uint8).reshape(len(named), -1)


def packed(numbers: np.ndarray) -> bytes:
    """Small non-negative numbers, compressed byte by byte of their value."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


_memories: dict[tuple[str, str], tuple[Memory, np.ndarray]] = {}


def memory(path_a: str, path_b: str) -> tuple[Memory, np.ndarray]:
    """One memory per worker, kept from task to task, and the spelling of ids."""
    if (path_a, path_b) not in _memories:
        known = Memory(path_a, path_b)
        _memories[path_a, path_b] = known, name_table(len(known.a.bytes), len(known.b.bytes))
    return _memories[path_a, path_b]


def align_texts(texts: list[str], known: Memory, names: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, list[bytes]]:
    """Counts of every text; owner and pair ``a << 32 | b`` of every link; spelled groups."""
    owner, number = known.split(texts)
    n, ids, chunk_first, of_text = len(texts), [], [], []
    for side in (0, 1):
        first = known.first[side]
        counts = first[number + 1] - first[number]
        ids.append(known.ids[side][expand(first[number], counts)].astype(np.int64))
        chunk_first.append(np.cumsum(counts) - counts)
        of_text.append(np.bincount(owner, counts, minlength=n).astype(np.int64))
    end_a, end_b = np.cumsum(known.a.size[ids[0]]), np.cumsum(known.b.size[ids[1]])
    # Lanes begin with a text and after every LANE chunks of it.
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    lanes = np.flatnonzero(place % LANE == 0)
    stop = np.append(chunk_first[0][lanes[1:]], len(ids[0])) if len(lanes) else lanes
    narrow = np.int32 if len(end_a) == 0 or end_a[-1] < 1 << 31 else np.int64
    pointers = (end_a, end_b, chunk_first[0][lanes], chunk_first[1][lanes], stop)
    link_a, link_b, cut_a, cut_b = lockstep(*(x.astype(narrow) for x in pointers))
    token_owner = np.repeat(np.arange(n), of_text[0])
    links_of = token_owner[link_a]
    letters, sizes = spelled(ids[0], ids[1], cut_a, cut_b, len(known.a.bytes), names)
    ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(of_text[0] + of_text[1]))]
    text = letters.tobytes()
    groups = [text[i : j - 1] if j > i else b"" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    counts = (*of_text, np.bincount(token_owner[cut_a], minlength=n), np.bincount(links_of, minlength=n))
    return dict(zip(RESULT, counts, strict=True)), links_of, ids[0][link_a] << 32 | ids[1][link_b], groups


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its groups and, packed, its links.

    ``links`` holds steps between the numbers of its pairs in the slice's sorted ``pairs``, then
    how often each is linked. ``pairs`` and ``times`` of a slice stand in its first row.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slice_id = TaskContext.get().partitionId() << 32
        known, names = memory(path_a, path_b)
        for batch in batches:
            for start, stop in byte_slices(batch.column(1), SLICE):
                rows = batch.slice(start, stop - start)
                counts, owner, pair, groups = align_texts([x or "" for x in rows.column(1).to_pylist()], known, names)
                found = pa.array(pair).dictionary_encode()
                pairs = found.dictionary.to_numpy()
                order = np.argsort(pairs)
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                local = rank[found.indices.to_numpy()] if len(pair) else pair
                times = np.bincount(local, minlength=len(pairs))
                mine, often = np.unique(owner * max(len(pairs), 1) + local, return_counts=True)
                at, local = np.divmod(mine, max(len(pairs), 1))
                ends = np.searchsorted(at, np.arange(len(rows) + 1))
                links = [
                    packed(np.concatenate([np.diff(local[i:j], prepend=0), often[i:j]])) if j > i else b""
                    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                heads = [[pairs[order]] + [None] * (len(rows) - 1), [times] + [None] * (len(rows) - 1)]
                columns = [
                    rows.column(0), pa.array(np.full(len(rows), slice_id)), *(pa.array(counts[c]) for c in RESULT),
                    pa.array([g.decode() for g in groups]), pa.array(links, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in heads),
                ]
                slice_id += 1
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "slice", *RESULT, "groups", "links", "pairs", "times"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    numbers = ", ".join(f"{c} long" for c in RESULT)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(align, f"doc_id {kind}, slice long, {numbers}, groups string, links binary, pairs array<long>, times array<long>")


def digest(groups) -> F.Column:
    """SHA-256 of a text in hexadecimal, of the empty text the empty text."""
    return F.when(groups == "", "").otherwise(F.sha2(groups.cast("binary"), 256))


def pair_counts(slices: DataFrame) -> DataFrame:
    """``pair, n, best``: links over the corpus, and whether no pair of that B id has more."""
    counts = materialize(slices.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_corpus(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """Every document with its counts, how its links stand in the corpus, and its groups' digest.

    ``count_sum`` adds up how often the pairs of its links are linked in the corpus, ``n_best``
    counts links whose pair is linked as often as any of its B id. ``with_groups`` adds the
    groups themselves.
    """
    kept = ["groups"] if with_groups else []
    rows = aligned(docs, path_a, path_b, doc_id, text).withColumn("groups_sha256", digest(F.col("groups")))
    rows = materialize(rows if with_groups else rows.drop("groups"), "aligned")
    slices = rows.filter("pairs IS NOT NULL").select("slice", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))).alias("x"))
    slices = slices.select("slice", "x.pair", "x.n")
    found = slices.select(F.col("slice").alias("of"), "pair").join(pair_counts(slices), "pair")
    chosen = rows.select("doc_id", "slice", *RESULT, "groups_sha256", *kept, "links")
    out = ["doc_id", *RESULT, "groups_sha256", *kept, "n_best", "count_sum"]

    def add_up(mine: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("pair").to_numpy())
        n, best = (pairs.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
        sums = np.zeros((2, len(mine)), np.int64)
        for i, data in enumerate(mine.column("links").to_pylist()):
            if data:
                steps, often = unpacked(data).reshape(2, -1)
                local = np.cumsum(steps)
                sums[:, i] = best[local] @ often, n[local] @ often
        table_ = mine.drop_columns(["links", "slice"])
        for name, column in zip(("n_best", "count_sum"), sums, strict=True):
            table_ = table_.append_column(name, pa.array(column))
        return table_.select(out)

    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}
    schema = ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in out)
    return chosen.groupBy("slice").cogroup(found.groupBy("of")).applyInArrow(add_up, schema)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_corpus(table(spark, sf_dir, "documents"), a, b).select("doc_id", *RESULT, "n_best", "count_sum", "groups_sha256")


QUERIES = {"op11_alignment": op11_alignment}
ORACLES: dict[str, str] = {}
