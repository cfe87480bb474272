"""Words and character n-grams of many texts at once, as numpy arrays of hashes.

Texts are worked on in blocks of bounded size: a long text is cut at white space, which no word and no n-gram here
crosses, so the cut changes nothing.  A piece without white space is taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np

BLOCK = 1 << 18
_SPACE = re.compile(r"\s")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@cache
def word_characters() -> np.ndarray:
    """For each code point, whether it is a letter or digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), np.bool_, 0x110000)


@cache
def space_characters() -> np.ndarray:
    """For each code point, whether it is white space."""
    return np.fromiter((chr(c).isspace() for c in range(0x110000)), np.bool_, 0x110000)


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > BLOCK:
        found = _SPACE.search(text, at + BLOCK)
        if not found:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:] if at else text


def blocks(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row of each piece, pieces): blocks of about BLOCK characters; null and empty texts have no piece."""
    rows: list[int] = []
    pieces: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        for piece in _pieces(text) if text else ():
            rows.append(row)
            pieces.append(piece)
            size += len(piece) + 1
            if size >= BLOCK:
                yield np.array(rows), pieces
                rows, pieces, size = [], [], 0
    if pieces:
        yield np.array(rows), pieces


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _runs(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each run of characters that are inside."""
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.flatnonzero(inside)
    power = np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint64))
    values = (codes[place].astype(np.uint64) + np.uint64(1)) * power[np.arange(len(place)) - np.repeat(first, lengths)]
    return starts, mix(np.add.reduceat(values, first) ^ lengths.astype(np.uint64))


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words (runs of letters and digits) in order, and the bounds of each text's words."""
    counts = np.zeros(len(texts), np.int64)
    hashes = []
    for rows, pieces in blocks(texts):
        pieces = [p.lower() for p in pieces]
        codes = code_points("\n".join(pieces))
        starts, values = _runs(codes, word_characters()[codes])
        ends = np.cumsum([len(p) + 1 for p in pieces])
        owner = rows[np.searchsorted(ends, starts, side="right")]
        counts += np.bincount(owner, minlength=len(texts))
        hashes.append(values)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), bounds


class Grams:
    """Character n-grams inside white-space bounded words (one space counts on either side), hashed to 2**bits buckets.

    With `words`, also the words themselves, and one common bucket for a word that repeats the word before it.
    """

    def __init__(self, orders: Sequence[int], bits: int, words: bool = False, fold: bool = True):
        self.orders, self.bits, self.words, self.fold = tuple(orders), bits, words, fold
        self.size = 1 << bits
        self.repeat = 1

    def _block(self, pieces: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(buckets, first place of each piece) for each order; `size` stands for no n-gram."""
        if self.fold:
            pieces = [p.lower() for p in pieces]
        lengths = np.array([len(p) + 1 for p in pieces])
        firsts = np.cumsum(lengths) - lengths
        codes = code_points(" " + " ".join(pieces) + " " * (1 + max(self.orders, default=1)))
        space = space_characters()[codes]
        codes = np.where(space, np.uint32(32), codes)
        m = int(lengths.sum())
        after = np.where(space, np.arange(len(codes)), len(codes))
        after = np.minimum.accumulate(after[::-1])[::-1]  # place of the next white space
        rolling = np.zeros(m, np.uint32)
        place = np.arange(m)
        for n in range(1, max(self.orders, default=0) + 1):
            rolling = rolling * np.uint32(0x01000193) + codes[n - 1 : n - 1 + m]
            if n in self.orders:
                if n == 1:
                    valid = ~space[:m]
                elif n == 2:
                    valid = ~(space[:m] & space[1 : m + 1])
                else:
                    valid = after[1 : m + 1] >= place + (n - 1)
                value = (rolling ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
                value ^= value >> np.uint32(15)
                value = (value * np.uint32(0x27D4EB2F)) >> np.uint32(32 - self.bits)
                yield np.where(valid, value, np.uint32(self.size)), firsts
        if self.words:
            starts, hashes = _runs(codes, ~space)
            bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.uint32)
            owner = np.searchsorted(firsts + 1, starts, side="right") - 1
            same = np.zeros(len(starts), np.bool_)
            same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
            at = np.searchsorted(owner, np.arange(len(pieces)))
            yield bucket, at
            yield np.where(same, np.uint32(self.repeat), np.uint32(self.size)), at

    def sums(self, texts: Sequence[str | None], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the sum of its n-grams' rows of `weights` (size x k), and how many n-grams it has."""
        padded = np.vstack([weights, np.zeros((1, weights.shape[1]), weights.dtype)])
        total, count = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts), np.int64)
        for rows, pieces in blocks(texts):
            for buckets, at in self._block(pieces):
                if not len(buckets):
                    continue
                some = np.flatnonzero(np.diff(at, append=len(buckets)))  # pieces that have a place of their own
                real = (buckets != self.size).astype(np.int64)
                np.add.at(count, rows[some], np.add.reduceat(real, at[some]))
                for j in range(weights.shape[1]):
                    np.add.at(total[:, j], rows[some], np.add.reduceat(padded[buckets, j].astype(np.float64), at[some]))
        return total, count

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of one text and how often each occurs."""
        total = np.zeros(self.size, np.int64)
        for _, pieces in blocks([text]):
            for buckets, _ in self._block(pieces):
                total += np.bincount(buckets, minlength=self.size + 1)[: self.size]
        found = np.flatnonzero(total)
        return found.astype(np.int32), total[found].astype(np.int32)
