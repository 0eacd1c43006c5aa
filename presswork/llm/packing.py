"""Packing of token sequences by their length histogram.

Each document becomes its token ids and an end id, and is cut into full sequences and
a rest. Only the histogram of piece lengths (at most ``max_length`` numbers) reaches
the driver. There, lengths are placed longest first, always into the pack that is
filled least; equal packs are one pattern with a count, so the work depends on the
number of lengths and not of documents. The patterns go back to the pieces by rank:
the n-th piece of a length takes the n-th place that the patterns have for it. Ranks
come from one count per task and length, not from a global sort.

Defined cases: a null or empty text is the end id alone; rows with the same id are
packed one by one; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import LATIN, TOKENIZERS, byte_of_letter, kept, table

MAX_LENGTH = 2048
END_ID = 1
KNOWN_WORDS = 1_500_000  # words a worker remembers; it starts afresh beyond
TOGETHER = 200  # new words that are encoded as one text
#: Lines of letters that both pattern libraries and Python lower-case alike.
LATIN_WORDS = re.compile("^[" + "".join(c for c in map(chr, range(ord(LATIN))) if c.isalpha() and c != "İ") + "]+$", re.MULTILINE)
PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"


class WordMerges:
    """Ids of lower-cased words of Latin letters, by the merges of the tokenizer's file.

    Such a word is one word to the tokenizer as well. A zero byte stands for its end, which
    merges with the last letter before anything else does, as ids come in merge order.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path) as file:
            model = json.load(file)["model"]
        letters, end = byte_of_letter(), model["end_of_word_suffix"]
        ranks = {}
        for piece, i in model["vocab"].items():
            stem = piece.removesuffix(end)
            if all(c in letters for c in stem):
                ranks[bytes(letters[c] for c in stem) + b"\0" * (stem != piece)] = i
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or any(ranks[bytes([b, 0])] > merged[0] for b in range(1, 256)):
            raise ValueError(f"{path}: ids are not in the order of merges")
        self.fast = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for b, i in ranks.items() if b[-1:] == b"\0"]] = True

    def encode(self, words: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        if not words:
            return []
        ids = self.fast.encode_to_numpy("\0".join(words) + "\0").astype("<u4")
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)]


class WordEncoder:
    """Ids of whole texts, with the ids of each word remembered.

    This tokenizer drops white space and never joins words over it, so a text's ids are
    those of its words in order. A-Z are lower-cased first, as the tokenizer does itself.
    Texts that may hold a special token's name are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.merges = WordMerges(path)

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, encoded as one text and cut where a word begins."""
        together = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        owner = np.array(together.word_ids)
        cuts = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
        if len(cuts) != len(words) + 1:  # a letter turned into more than letters
            return self._plain(words)
        ids = array("I", together.ids).tobytes()
        cuts = (4 * cuts).tolist()
        return [ids[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, words: list[bytes]) -> None:
        texts = b"\n".join(words).decode().split("\n")
        # A full stop or comma after a letter is always an own word to the tokenizer.
        stems = [t[:-1] if t[-1] in ".," and t[-2:-1].isalpha() and t[-2:-1].isascii() else t for t in texts]
        fresh = {*stems, ".", ","}
        latin = LATIN_WORDS.findall("\n".join(fresh))
        ids = dict(zip(latin, self.merges.encode("\0".join(latin).lower().split("\0") if latin else []), strict=True))
        rest = fresh.difference(latin)
        letters = [w for w in rest if w.isalpha()]
        for i in range(0, len(letters), TOGETHER):
            group = letters[i : i + TOGETHER]
            ids.update(zip(group, self._letters(group), strict=True))
        others = [w for w in rest if not w.isalpha()]
        ids.update(zip(others, self._plain(others), strict=True))
        self.known.update(
            (word, ids[stem] if len(stem) == len(text) else ids[stem] + ids[text[-1]])
            for word, text, stem in zip(words, texts, stems, strict=True)
        )

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        special = [b"<|" in x for x in texts]
        split = [[] if s else x.lower().split() for x, s in zip(texts, special, strict=True)]
        missing = set(itertools.chain.from_iterable(split)).difference(self.known)
        if missing:
            self._learn(list(missing))
        known = self.known.__getitem__
        out = [b"".join(map(known, words)) for words in split]
        for i in np.flatnonzero(special):
            out[i] = self._plain([texts[i].decode()])[0]
        return out


def encoder(path: str) -> WordEncoder:
    """One encoder per worker, which keeps its words from task to task."""
    return kept(("words", path), lambda: WordEncoder(path))


def cut_pieces(docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pieces of all documents: full sequences and a rest, numbered per task and length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, encode = TaskContext.get().partitionId(), np.zeros(max_length + 1, np.int64), encoder(tokenizer).encode
        end = np.array([END_ID], dtype="<u4").tobytes()
        step = 4 * max_length
        for batch in batches:
            for a in range(0, len(batch), 500):
                rows = batch.slice(a, 500)
                encoded = [x + end for x in encode([x or b"" for x in rows.column(1).cast(pa.binary()).to_pylist()])]
                tokens = np.array([len(x) // 4 for x in encoded], dtype=np.int64)
                counts = -(-tokens // max_length)
                doc = np.repeat(np.arange(len(rows)), counts)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * max_length
                length = np.minimum(max_length, tokens[doc] - start)
                crc = np.array([zlib.crc32(x[i : i + step]) for x in encoded for i in range(0, len(x), step)], dtype=np.int64)
                nth = np.empty(len(doc), np.int64)
                order = np.argsort(length, kind="stable")
                by_length = length[order]
                first = np.searchsorted(by_length, by_length)
                nth[order] = seen[by_length] + np.arange(len(doc)) - first
                seen += np.bincount(length, minlength=max_length + 1)
                columns = [rows.column(0).take(pa.array(doc)), *map(pa.array, (start, length, crc, tokens[doc], np.full(len(doc), part, np.int32), nth))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(pieces, PIECES.format(id=chosen.schema["doc_id"].dataType.simpleString()))


def pack_lengths(histogram: dict[int, int], max_length: int = MAX_LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, count)`` that hold every length as often as it occurs.

    Longest lengths first; each goes to the shortest pack there is, if it fits, else it
    opens packs of its own. A pattern is split when only some of its packs are used.
    """
    packs: list[tuple[int, int, tuple[int, ...], int]] = []  # filled, tie, lengths, count
    tie = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if packs and packs[0][0] + length <= max_length:
                filled, _, lengths, count = heapq.heappop(packs)
                if count > left:
                    heapq.heappush(packs, (filled, tie, lengths, count - left))
                    tie += 1
                used = min(left, count)
            else:
                filled, lengths, used = 0, (), left
            heapq.heappush(packs, (filled + length, tie, (*lengths, length), used))
            tie += 1
            left -= used
    return sorted((lengths, count) for _, _, lengths, count in packs)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length and run of ranks: the first sequence and the offset within it."""
    rows, taken, base = [], {}, 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, taken.get(length, 0), base, offset))
            taken[length] = taken.get(length, 0) + count
            offset += length
        base += count
    table_ = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table_.T, strict=True))


def pack(pieces: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Stored rows of ``cut_pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    per_task = materialize(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = spark.sparkContext.broadcast(places(pack_lengths(histogram, max_length)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = found.value
        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(x)).to_numpy() for x in ("length", "rank"))
            # Rows of `at` are sorted by length, then rank: find the last one not beyond.
            row = np.empty(len(length), np.int64)
            for x in np.unique(length):
                a, b = np.searchsorted(at["length"], [x, x + 1])
                mine = length == x
                row[mine] = a + np.searchsorted(at["rank"][a:b], rank[mine], side="right") - 1
            kept = [batch.column(names.index(x)) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            sequence = at["sequence"][row] + rank - at["rank"][row]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(at["offset"][row])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        placed, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, max_length: int = MAX_LENGTH) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``max_length`` ids."""
    path = tokenizer or f"{TOKENIZERS}/word_bpe_49k.json"
    return pack(materialize(cut_pieces(docs, path, max_length), "pieces"), max_length)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op9_packing": op9_packing}
ORACLES: dict[str, str] = {}
