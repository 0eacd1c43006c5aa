"""Lattices of vocabulary pieces over many words at once.

Edges of all words of a batch are found by comparing hashes of substrings with those of
the pieces, one array operation per piece length. Rows of the result are sorted by the
place where an edge ends, then by word, so that a forward pass is one step per place for
all words together.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

SPACE = "▁"  # the mark that stands for a space in the vocabulary
BASE = np.uint64(0x9E3779B97F4A7C15)
BATCH_CELLS = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces by id, and the ids of the 256 byte pieces."""

    pieces: tuple[str, ...]
    ids: np.ndarray
    bytes_: np.ndarray
    size: int

    @functools.cached_property
    def index(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By piece length: sorted hashes and the ids in that order."""
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(self.pieces):
            by_length.setdefault(len(p), []).append(i)
        out = {}
        for n, rows in by_length.items():
            text = "".join(self.pieces[i] for i in rows)
            total, power = _running(code_points(text))
            at = np.arange(len(rows)) * n
            keys = (total[at + n] - total[at]) * power[at]
            order = np.argsort(keys)
            out[n] = keys[order], self.ids[np.array(rows)][order]
        return out


@functools.lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    """Pieces of a SentencePiece model file; control and unknown pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    bytes_ = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    return Vocabulary(tuple(model.id_to_piece(i) for i in plain), np.array(plain), bytes_, size)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _running(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sum and the factors that make substrings comparable."""
    base, inverse = int(BASE), pow(int(BASE), -1, 1 << 64)
    power = _geometric(base, len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    return total, _geometric(inverse, len(codes) + 1)


def _geometric(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64, kept between calls."""
    have = _known.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, BATCH_CELLS + 64), base, np.uint64)
        x[0] = 1
        _known[base] = have = np.multiply.accumulate(x)
    return have[:n]


_known: dict[int, np.ndarray] = {}


@dataclass
class Lattice:
    """Edges of a batch of words, sorted by end, then word.

    ``sizes`` are the words' lengths; ``word``, ``start``, ``end`` and ``piece`` describe
    an edge; a piece of -1 is a single code point that the vocabulary lacks. Edges that
    end at place j are ``bounds[j] .. bounds[j + 1] - 1``.
    """

    sizes: np.ndarray
    codes: np.ndarray
    offsets: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    bounds: np.ndarray


def batches(words: Sequence[str], most: int = BATCH_CELLS) -> Iterator[tuple[int, int]]:
    """Ranges of words, which ascend in length, of at most ``most`` places in all, padded.

    One word at least; words of very different length never share padding.
    """
    a = 0
    while a < len(words):
        b = a + 1
        # The last word of a range is its longest one.
        low, high = b, len(words)
        while low < high:
            middle = (low + high + 1) // 2
            if (middle - a) * (len(words[middle - 1]) + 1) <= most:
                low = middle
            else:
                high = middle - 1
        b = max(b, low)
        yield a, b
        a = b


def build(words: Sequence[str], vocabulary: Vocabulary) -> Lattice:
    """All edges of the words; every single code point has one, so every word has a path."""
    text = "".join(words)
    codes = code_points(text)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    total, power = _running(codes)
    word_at = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - offsets[word_at]
    left = sizes[word_at] - place
    parts = []
    for n, (keys, ids) in sorted(vocabulary.index.items()):
        at = np.flatnonzero(left >= n) if n > 1 else np.arange(len(codes))
        if not len(at):
            continue
        own = (total[at + n] - total[at]) * power[at]
        slot = np.searchsorted(keys, own)
        slot[slot == len(keys)] = 0
        hit = keys[slot] == own
        if n == 1:
            piece = np.where(hit, ids[slot], -1)
        else:
            at, piece = at[hit], ids[slot[hit]]
        parts.append((word_at[at], place[at], place[at] + n, piece))
    word, start, end, piece = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4
    order = np.lexsort((word, end))
    end = end[order]
    longest = int(sizes.max()) if len(sizes) else 0
    bounds = np.searchsorted(end, np.arange(longest + 2))
    return Lattice(sizes, codes, offsets, word[order], start[order], end, piece[order], bounds)


def _sum_by_word(word: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the sums of exp(values) over equal neighbouring words; rows are edges."""
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    most = np.maximum.reduceat(values, first, axis=0)
    counts = np.diff(np.append(first, len(word)))
    spread = np.exp(values - np.repeat(most, counts, axis=0))
    return word[first], most + np.log(np.add.reduceat(spread, first, axis=0))


def forward(lattice: Lattice, log_p: np.ndarray) -> np.ndarray:
    """``[word, place, model]``: log of the summed weight of all paths to a place.

    ``log_p`` is ``[edge, model]``.
    """
    longest = len(lattice.bounds) - 2
    alpha = np.full((len(lattice.sizes), longest + 1, log_p.shape[1]), -np.inf)
    alpha[:, 0] = 0.0
    for j in range(1, longest + 1):
        e = slice(lattice.bounds[j], lattice.bounds[j + 1])
        if e.stop > e.start:
            words, sums = _sum_by_word(lattice.word[e], alpha[lattice.word[e], lattice.start[e]] + log_p[e])
            alpha[words, j] = sums
    return alpha


def backward(lattice: Lattice, log_p: np.ndarray) -> np.ndarray:
    """``[word, place, model]``: log of the summed weight of all paths from a place to the end."""
    longest = len(lattice.bounds) - 2
    beta = np.full((len(lattice.sizes), longest + 1, log_p.shape[1]), -np.inf)
    beta[np.arange(len(lattice.sizes)), lattice.sizes] = 0.0
    order = np.lexsort((lattice.word, lattice.start))
    bounds = np.searchsorted(lattice.start[order], np.arange(longest + 2))
    for j in range(longest - 1, -1, -1):
        e = order[bounds[j] : bounds[j + 1]]
        if len(e):
            words, sums = _sum_by_word(lattice.word[e], beta[lattice.word[e], lattice.end[e]] + log_p[e])
            beta[words, j] = sums
    return beta


def totals(lattice: Lattice, alpha: np.ndarray) -> np.ndarray:
    """``[word, model]``: log of the summed weight of all segmentations."""
    return alpha[np.arange(len(lattice.sizes)), lattice.sizes]
