"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Texts of a batch are put into one byte array; word boundaries come from a table of byte classes, and the hash of
every word is read off running sums, so no work is done word by word in Python. A word is a polynomial of its bytes (each
replaced by a random number) at a random point, modulo the prime 2**31 - 1; two such values, with numbers and points of their own, make
62 bits. Modulo a prime, two different words of n bytes agree at no more than n of the points, so a pair of them shares both
values with a probability of at most (n / 2**31)**2; with V distinct words, some two share a hash with a probability of about V * V / 2**63.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_PRIME = (1 << 31) - 1
_SEEDED = np.random.default_rng(20240517)
_NUMBERS = [_SEEDED.integers(1, _PRIME, 256, dtype=np.uint64) for _ in range(2)]
_POINTS = [int(x) for x in _SEEDED.integers(1 << 20, _PRIME, 2)]
CHUNK_BYTES = 256 << 10


def _table(is_word) -> bytes:
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if is_word(b) else 0x20 for b in range(256))


# A-Z are lowered in both. Words between ASCII white space:
BY_SPACE = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
# Words of digits, letters and everything outside ASCII:
BY_LETTER = _table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _fold(x: np.ndarray) -> np.ndarray:
    """Products of two residues, brought below 2**32 without changing what they are modulo the prime."""
    return (x & _U(_PRIME)) + (x >> _U(31))


class _Powers:
    """Powers of the points and of their inverses, grown when a longer text comes."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in _POINTS]
        self.down = [np.ones(1, np.uint64) for _ in _POINTS]

    @staticmethod
    def _grown(known: np.ndarray, point: int, size: int) -> np.ndarray:
        while len(known) < size:
            known = np.concatenate((known, known * _U(pow(point, len(known), _PRIME)) % _U(_PRIME)))
        return known

    def upto(self, size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        if len(self.up[0]) < size:
            self.up = [self._grown(x, p, size) for x, p in zip(self.up, _POINTS)]
            self.down = [self._grown(x, pow(p, -1, _PRIME), size) for x, p in zip(self.down, _POINTS)]
        return self.up, self.down


_powers = _Powers()


def encode(text: object) -> bytes:
    """UTF-8 of a text; NULL is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def hashes(texts: Sequence[bytes], table: bytes = BY_SPACE, prefixes: Sequence[int] = ()) -> tuple:
    """(hash of each word, first word of each text and the total, prefix hashes).

    Prefix hashes are one array of (text number, hash) per length, for the words that are longer.
    """
    data = b" ".join(texts) + b" "
    array = np.frombuffer(data.translate(table), np.uint8)
    word = array != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word)).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    ups, downs = _powers.upto(len(array) + 1)
    # A sum of values below 2**32 stays below 2**64 for any text that fits into memory.
    running = []
    for numbers, up in zip(_NUMBERS, ups):
        total = np.zeros(len(array) + 1, np.uint64)
        np.cumsum(_fold(numbers[array] * up[: len(array)]), out=total[1:])
        running.append(total)

    def between(begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        both = [(t[stops] - t[begins]) % _U(_PRIME) * down[begins] % _U(_PRIME) for t, down in zip(running, downs)]
        return both[0] << _U(31) | both[1]

    found = mix(between(starts, ends))
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    first = np.searchsorted(starts, begin)
    extra = []
    if prefixes:
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        for n in prefixes:
            longer = np.flatnonzero(ends - starts > n)
            with np.errstate(over="ignore"):
                extra.append((owner[longer], mix(between(starts[longer], starts[longer] + n) + (_U(n) << _U(62)))))
    return found, first, extra


def chunks(texts: Sequence[object], size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Texts in order as lists of about ``size`` bytes; a longer text is a list of its own."""
    part, used = [], 0
    for text in texts:
        data = encode(text)
        if part and used + len(data) > size:
            yield part
            part, used = [], 0
        part.append(data)
        used += len(data)
    if part:
        yield part


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct hashes of the n-word sequences of one text, sorted; a shorter text is one sequence."""
    if not len(words):
        return words
    n = min(n, len(words))
    size = len(words) - n + 1
    with np.errstate(over="ignore"):
        value = np.full(size, _U(n))
        for i in range(n):
            value = value * _U(_P) + words[i : i + size]
    return np.unique(mix(value))
