"""Elias-Fano sequences and a two-level n-gram trie over them, in numpy, memory-mapped."""

from __future__ import annotations

import os
import tempfile

import numpy as np

SAMPLE = 1 << 14          # elements per directory entry; a search decodes the directory ranges it touches


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each value, one after another, as bytes."""
    if bits == 0 or not len(values):
        return np.zeros(0, np.uint8)
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little", count=bits), bitorder="little")


def _unpack(data: np.ndarray, start: int, count: int, bits: int) -> np.ndarray:
    if bits == 0 or count == 0:
        return np.zeros(count, np.uint64)
    first = start * bits
    raw = np.unpackbits(data[first // 8:(first + count * bits + 7) // 8], bitorder="little")[first % 8:][:count * bits]
    wide = np.zeros((count, 64), np.uint8)
    wide[:, :bits] = raw.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


class EliasFano:
    """A sorted sequence of integers below 2**63: low bits as they are, high bits in unary.

    Element i sets bit (value >> l) + i of the high bits; l is chosen so that there are about two high bits for each
    element. The directory keeps the value and the high-bit place of every ``SAMPLE``-th element.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, values: np.ndarray, places: np.ndarray):
        self.n, self.bits, self.low, self.high, self.values, self.places = n, bits, low, high, values, places

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        v = values.astype(np.uint64)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        places = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        flags[places] = 1
        return cls(n, bits, _pack(v, bits), np.packbits(flags, bitorder="little"), v[::SAMPLE].copy(), places[::SAMPLE].copy())

    def decode(self, block: int) -> np.ndarray:
        """Values of directory range ``block``."""
        start = block * SAMPLE
        count = min(SAMPLE, self.n - start)
        first = int(self.places[block])
        last = int(self.places[block + 1]) if block + 1 < len(self.places) else len(self.high) * 8
        flags = np.unpackbits(np.asarray(self.high[first // 8:(last + 7) // 8]), bitorder="little")[first % 8:]
        high = np.flatnonzero(flags)[:count] + first - np.arange(start, start + count)
        return (high.astype(np.uint64) << np.uint64(self.bits)) | _unpack(self.low, start, count, self.bits)

    def all(self) -> np.ndarray:
        return np.concatenate([self.decode(b) for b in range(len(self.places))]) if self.n else np.zeros(0, np.uint64)

    def successors(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted ``wanted``: index of the first element not below each one, and whether it is equal."""
        index, equal = np.full(len(wanted), self.n), np.zeros(len(wanted), bool)
        if not self.n:
            return index, equal
        block = np.maximum(np.searchsorted(self.values, wanted, "right") - 1, 0)
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for s, e in zip(cuts[:-1], cuts[1:]):
            values = self.decode(int(block[s]))
            at = np.searchsorted(values, wanted[s:e])
            index[s:e] = int(block[s]) * SAMPLE + at
            inside = at < len(values)
            equal[s:e][inside] = values[at[inside]] == wanted[s:e][inside]
        return index, equal


class Trie:
    """Contexts -> their successors -> quantised probabilities; each level one Elias-Fano sequence.

    Level 1: context keys and the pointers to their successor ranges. Level 2: successors as their rank among
    the words of the trie, made one monotone sequence by adding (rank of the context) * (number of words), so the
    range of a context is searched relative to it. ``codes`` holds one quantised log probability per successor.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.words, self.successors, self.codes = contexts, pointers, words, successors, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> "Trie":
        """From distinct (context, word) pairs sorted by both (context keys and words below 2**63)."""
        contexts, first, rank = np.unique(context, return_index=True, return_inverse=True)
        words, place = np.unique(word, return_inverse=True)
        return cls(EliasFano.build(contexts), EliasFano.build(np.append(first, len(context))), EliasFano.build(words),
                   EliasFano.build(rank.astype(np.uint64) * np.uint64(max(1, len(words))) + place.astype(np.uint64)), codes)

    def map_to(self, folder: str | None = None) -> "Trie":
        """The same trie with its levels in one memory-mapped file (removed from its folder at once)."""
        parts = [x for ef in (self.contexts, self.pointers, self.words, self.successors) for x in (ef.low, ef.high)] + [self.codes.view(np.uint8)]
        with tempfile.TemporaryFile(dir=folder) as f:
            f.write(b"\0")                                # an empty file can't be mapped
            for x in parts:
                f.write(x.tobytes())
            f.flush()
            data = np.memmap(f, np.uint8, "r", shape=(os.fstat(f.fileno()).st_size,))
        cut = np.cumsum([1, *(len(x) for x in parts)])
        view = [data[s:e] for s, e in zip(cut[:-1], cut[1:])]
        levels = [EliasFano(ef.n, ef.bits, view[2 * i], view[2 * i + 1], ef.values, ef.places)
                  for i, ef in enumerate((self.contexts, self.pointers, self.words, self.successors))]
        return Trie(*levels, view[-1].view(self.codes.dtype))

    def degrees(self, wanted: np.ndarray) -> np.ndarray:
        """Number of successors of each of the sorted contexts (0: unknown)."""
        at, known = self.contexts.successors(wanted)
        ends = self.pointers.all().astype(np.int64)
        return np.where(known, np.diff(ends, append=0)[np.minimum(at, len(ends) - 1)], 0)

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each (context, word), 0 if absent; pairs sorted by both."""
        out = np.zeros(len(context), self.codes.dtype)
        at, known = self.contexts.successors(context)
        order = np.argsort(word, kind="stable")
        rank, there = np.empty(len(word), np.int64), np.empty(len(word), bool)
        rank[order], there[order] = self.words.successors(word[order])
        ask = np.flatnonzero(known & there)
        place, found = self.successors.successors(at[ask].astype(np.uint64) * np.uint64(max(1, self.words.n)) + rank[ask].astype(np.uint64))
        out[ask[found]] = self.codes[place[found]]
        return out
