"""An FM-index over the words of one shard of documents: built, searched and located with numpy.

Symbols are the shard's own word numbers from 1; 0 ends a document. Suffixes are sorted by doubling, and
only those still equal are sorted again; every document's end sorts by its place, so no comparison goes on
into the next document and copies cost no more rounds than their length asks for. The transform is kept as
the bit levels of a wavelet tree (its levels as one bit vector each, zeros first), with ranks by counts of
64-bit words. Every ``RATE``-th position and every document's first are sampled, so a walk to a sample
never steps over a document's end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RATE = 16
POSITION_BITS = 20  # symbols of a shard: two ranks and a position are sorted as one number
MOST = 1 << POSITION_BITS
CHUNK = 1 << 18  # occurrences located at a time


def suffix_array(keys: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes of ``keys``: numbers below ``2 * MOST`` of which the last is unique."""
    n = len(keys)
    place = np.arange(n, dtype=np.int64)
    rank, order, at, width = keys.astype(np.int64), place.copy(), place, 1
    while len(at):
        # the suffixes at these places, by what is known of them and of what follows
        here = order[at]
        after = np.zeros(len(here), dtype=np.int64)
        inside = here + width < n
        after[inside] = rank[here[inside] + width]
        if width == 1:
            packed = np.sort((rank[here] << (POSITION_BITS + 21)) | (after << POSITION_BITS) | here)
            here, key = packed & (MOST - 1), packed >> POSITION_BITS
        else:
            # what is known is a place already, groups stand together: sorting by (group, after) keeps them so
            packed = np.sort((rank[here] << (2 * POSITION_BITS)) | (after << POSITION_BITS) | here)
            here, key = packed & (MOST - 1), packed >> POSITION_BITS
        order[at] = here
        first = np.ones(len(at), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        group = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        if width == 1:
            rank = np.empty(n, dtype=np.int64)
        rank[here] = group
        alone = first & np.append(first[1:], True)
        at = at[~alone]
        width *= 2
    return order


def _words_of(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, one more than is full, so that a rank at the end reads one too."""
    packed = np.packbits(bits, bitorder="little")
    padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
    padded[:len(packed)] = packed
    return padded.view(np.uint64)


def _counts(words: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1]


def _rank(words: np.ndarray, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ones before ``at``."""
    word = at >> 6
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return counts[word] + np.bitwise_count(words[word] & below).astype(np.int64)


def _bit(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


@dataclass
class FMIndex:
    """``tree`` is (levels, words) of bits, the highest bit of a symbol first; ``totals`` counts each symbol."""

    size: int
    tree: np.ndarray
    totals: np.ndarray
    marked: np.ndarray
    samples: np.ndarray

    def __post_init__(self) -> None:
        self.counts = [_counts(level) for level in self.tree]
        self.zeros = [self.size - int(np.bitwise_count(level).sum()) for level in self.tree]
        self.marked_counts = _counts(self.marked)
        self.before = np.concatenate([[0], np.cumsum(self.totals)])[:-1]
        levels, symbols = len(self.tree), np.arange(len(self.totals))
        turned = np.zeros(len(symbols), dtype=np.int64)
        for level in range(levels):  # the tree's last level has the symbols by their bits in reverse
            turned |= ((symbols >> level) & 1) << (levels - 1 - level)
        last = np.argsort(turned, kind="stable")
        self.first = np.empty(len(symbols), dtype=np.int64)
        self.first[last] = np.concatenate([[0], np.cumsum(self.totals[last])])[:-1]

    @classmethod
    def of(cls, symbols: np.ndarray, n_symbols: int, starts: np.ndarray) -> FMIndex:
        """``symbols`` of whole documents, each with its 0 at the end; ``starts`` are their first positions."""
        n = len(symbols)
        ends = symbols == 0
        keys = symbols.astype(np.int64) + int(ends.sum())
        keys[ends] = np.arange(ends.sum())
        order = suffix_array(keys)
        last = symbols[order - 1]
        sampled = order % RATE == 0
        is_start = np.zeros(n, dtype=bool)
        is_start[starts] = True
        sampled |= is_start[order]
        levels = max(1, int(n_symbols - 1).bit_length())
        tree, row = np.empty((levels, n // 64 + 1), dtype=np.uint64), last
        for level in range(levels):
            bits = (row >> (levels - 1 - level)) & 1 == 1
            tree[level] = _words_of(bits)
            row = np.concatenate([row[~bits], row[bits]])
        return cls(n, tree, np.bincount(symbols, minlength=n_symbols), _words_of(sampled), order[sampled].astype(np.int32))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before row ``at``."""
        levels = len(self.tree)
        for level in range(levels):
            ones = _rank(self.tree[level], self.counts[level], at)
            is_one = (symbol >> (levels - 1 - level)) & 1 == 1
            at = np.where(is_one, self.zeros[level] + ones, at - ones)
        return at - self.first[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of each phrase, a row of symbols; equal where it does not occur.
        Words are taken from the last to the first; a phrase that is gone is not carried on."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.flatnonzero(lengths > 0)
        for step in range(phrases.shape[1]):
            alive = alive[lengths[alive] > step]
            if not len(alive):
                break
            symbol = phrases[alive, lengths[alive] - 1 - step]
            low[alive] = self.before[symbol] + self._descend(symbol, low[alive])
            high[alive] = self.before[symbol] + self._descend(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        lost = lengths <= 0
        high[lost] = low[lost]
        return low, np.maximum(low, high)

    def _step_back(self, at: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are one word longer."""
        levels, symbol = len(self.tree), np.zeros(len(at), dtype=np.int64)
        for level in range(levels):
            ones = _rank(self.tree[level], self.counts[level], at)
            is_one = _bit(self.tree[level], at)
            symbol |= is_one.astype(np.int64) << (levels - 1 - level)
            at = np.where(is_one, self.zeros[level] + ones, at - ones)
        return self.before[symbol] + at - self.first[symbol]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in ``rows``, by walks back to the next sample."""
        found = np.empty(len(rows), dtype=np.int64)
        for begin in range(0, len(rows), CHUNK):
            at = rows[begin:begin + CHUNK].astype(np.int64)
            waiting = np.arange(len(at))
            steps = 0
            while len(waiting):
                here = _bit(self.marked, at)
                done = waiting[here]
                found[begin + done] = self.samples[_rank(self.marked, self.marked_counts, at[here])] + steps
                waiting, at = waiting[~here], at[~here]
                if len(waiting):
                    at = self._step_back(at)
                    steps += 1
        return found
