"""Word shingles of whole texts as 64-bit numbers, for many texts at once.

Words are what lies between ASCII white space after A-Z are lower-cased. A word's number
comes from two polynomials over its bytes modulo a prime, taken from running sums over a piece
of text, and a shingle's number from those of its words. All of it is array arithmetic. Texts
are taken in pieces of words, so that of a long text only the numbers are held as a whole.

Sums modulo 2**64 (`running`, `powers`) are cheaper, but there are words of a thousand bytes
that collide in them by their form, whatever the base. They are for ranges that are compared
byte by byte afterwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

_U = np.uint64
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
# A random odd number for each byte, so that neighbouring letters are far apart.
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_cache: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2**64."""
    known = _cache.get(base, np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, known * _U(pow(base, len(known), 1 << 64))])
    _cache[base] = known
    return known[:n]


def running(data: np.ndarray) -> np.ndarray:
    """Running sums such that any range's number is a difference times a power."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_INVERSE, len(data)), out=sums[1:])
    return sums


PIECE = 1 << 18
"""Bytes of text that are numbered together. A word of as many bytes is numbered by a digest."""

_PRIME = _U((1 << 31) - 1)
_BASES = (1_103_515_247, 826_366_249)
_VALUES = np.random.default_rng(21).integers(1, (1 << 31) - 1, 256, dtype=np.uint64)
_tables: list[tuple[np.ndarray, np.ndarray]] = []
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def _folded(x: np.ndarray) -> np.ndarray:
    """Congruent modulo the prime 2**31 - 1, and much smaller."""
    return (x & _PRIME) + (x >> _U(31))


def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """For both bases, the powers of its inverse and its own, for the places of a piece."""
    if not _tables:
        prime = int(_PRIME)
        for base in _BASES:
            pair = []
            for factor in (pow(base, -1, prime), base):
                known = np.ones(1, np.uint64)
                while len(known) < PIECE + 2:
                    known = np.concatenate([known, known * _U(pow(factor, len(known), prime)) % _PRIME])
                pair.append(known[: PIECE + 2])
            _tables.append(tuple(pair))
    return _tables


def _numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for the bytes of each range, the same wherever they stand; at most a piece of data."""
    values, residues = _VALUES[data], []
    for inverse, own in _powers():
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_folded(values * inverse[: len(data)]), out=sums[1:])
        residues.append(_folded(_folded(sums[end] - sums[start])) * own[start] % _PRIME)
    return mix((residues[0] << _U(32)) ^ residues[1] ^ ((end - start).astype(np.uint64) << _U(45)))


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """A text cut at white space into pieces of at most `most` bytes; a longer word is a piece of its own."""
    start = 0
    while len(text) - start > most:
        cut = max(text.rfind(c, start, start + most) for c in b" \t\n\v\f\r")
        if cut < start:
            found = _WHITE.search(text, start + most)
            cut = found.start() if found else len(text)
        else:
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words in order, and of which text each one is."""
    numbers, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def number(parts: list[bytes], whose: list[int]) -> None:
        joined = b" ".join(parts).lower() + b" "
        data = np.frombuffer(joined, np.uint8)
        edge = np.flatnonzero(np.diff(_SPACE[data], prepend=True))
        start, end = edge[0::2], edge[1::2]
        long = np.flatnonzero(end - start >= PIECE)
        if len(long):
            # Such a word stands alone in its piece.
            found = [int.from_bytes(hashlib.blake2b(joined[start[i] : end[i]], digest_size=8).digest(), "little") for i in long]
            numbers.append(np.array(found, np.uint64))
        else:
            numbers.append(_numbered(data, start, end))
        places = np.cumsum([0, *(len(p) + 1 for p in parts)])
        owners.append(np.array(whose, np.int64)[np.searchsorted(places, start, "right") - 1])

    waiting, whose, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text, PIECE - 1):
            if size + len(piece) >= PIECE and waiting:
                number(waiting, whose)
                waiting, whose, size = [], [], 0
            waiting.append(piece)
            whose.append(i)
            size += len(piece) + 1
    if waiting:
        number(waiting, whose)
    return np.concatenate(numbers), np.concatenate(owners)


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `k` words of each text: (numbers, text), sorted by text and number.

    A text of fewer words, but at least one, has a single shingle: all of it.
    """
    words, owner = word_numbers(texts)
    n = np.bincount(owner, minlength=len(texts))
    numbers, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for size in sorted({min(k, c) for c in n.tolist() if c}):
        first = np.arange(max(len(words) - size + 1, 0))
        first = first[(owner[first] == owner[first + size - 1]) & ((n[owner[first]] == size) | (size == k))]
        number = np.full(len(first), size, np.uint64)
        for j in range(size):
            number = mix(number * _U(3) + words[first + j])
        numbers, owners = np.append(numbers, number), np.append(owners, owner[first])
    order = np.lexsort((numbers, owners))
    numbers, owners = numbers[order], owners[order]
    new = np.ones(len(numbers), bool)
    new[1:] = (numbers[1:] != numbers[:-1]) | (owners[1:] != owners[:-1])
    return numbers[new], owners[new]
